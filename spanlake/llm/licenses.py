"""License scans: base phrases, and an exact set-similarity join of text blocks with license templates.

A block is a window of BLOCK words of the whole text, line breaks or not, that starts at a multiple of half of that (all
of a shorter text), so a notice of up to half a block lies in one. A template matches a block in which a stretch of about the
template's own length, room() words, contains at least `threshold` of its distinct words, those that tell its license from
others among them: words strewn over prose are no notice. Of several stretches the one that shares most counts, the first of
equals; where the words shared with one template are all shared with another and more, the other one alone counts. Words are ordered by
their frequency in the whole corpus, rarest first; a template of n words that needs a of them can only match a block
that has one of its n - a + 1 rarest (prefix filter), that has at least a words in any template (length filter), and in
which enough words are left from that one on in both (positional filter). Candidates are verified in full, so the
join is exact. The templates are a fixed list: they are sent to every task.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, column, map_batches, text_bytes
from .words import words

THRESHOLD, BLOCK = 0.8, 64

#: Base phrases and their labels, as agreed.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Sentences of public license notices: label, sentence, and the words of it that no other license's notice has in their place.
TEMPLATES = [
    ("mit", "Released under the MIT License", "mit license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "free charge obtaining"),
    ("apache", "Licensed under the Apache License, Version 2.0", "apache license"),
    ("apache", "you may not use this file except in compliance with the License", "except compliance license"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", "gnu general public"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "redistribute gnu general"),
    ("bsd", "Released under the BSD License", "bsd license"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "redistribution binary permitted"),
    ("mpl", "Licensed under the Mozilla Public License, Version 2.0", "mozilla public"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "permission distribute fee"),
    ("unlicense", "This is free and unencumbered software released into the public domain", "unencumbered domain"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", "creative commons attribution"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "creative commons sharealike"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License", "creative commons noncommercial"),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution NonCommercial ShareAlike 4.0 International License", "creative commons noncommercial sharealike"),
    ("cc-by", "Licensed under CC BY 4.0", "cc by"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc sa"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc nc"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0", "cc nc sa"),
    ("all-rights-reserved", "All rights reserved", "all rights reserved"),
]


def blocks(w: list[bytes], size: int = BLOCK) -> Iterator[tuple[int, list[bytes]]]:
    """(start, words) of the blocks of a text's words."""
    half = size // 2
    for s in range(0, max(len(w) - half, min(len(w), 1)), half):
        yield s, w[s : s + size]


def room(n: int) -> int:
    """Words of a text among which those of a template of n words are looked for."""
    return n + max(1, n // 4)


@dataclass
class Index:
    """Templates as (label, word set, words needed, words that must be there, room), and what their prefixes point to: word -> (template, place)."""

    templates: list[tuple[str, frozenset[bytes], int, frozenset[bytes], int]]
    rank: dict[bytes, int]
    prefix: dict[bytes, list[tuple[int, int]]]


def build_index(templates: list[tuple[str, str, str]], freq: dict[bytes, int], threshold: float = THRESHOLD) -> Index:
    kept, prefix = [], defaultdict(list)
    sets = [(label, frozenset(w := words(text.encode())), frozenset(words(own.encode())), room(len(w))) for label, text, own in templates]
    if any(n > BLOCK // 2 for *_, n in sets):
        raise ValueError("a template doesn't fit half a block")
    vocabulary = sorted({w for _, s, *_ in sets for w in s}, key=lambda w: (freq.get(w, 0), w))
    rank = {w: i for i, w in enumerate(vocabulary)}
    for number, (label, s, own, words_of) in enumerate(sets):
        need = next(k for k in range(len(s) + 1) if k >= threshold * len(s) - 1e-9)
        kept.append((label, s, need, own, words_of))
        for place, w in enumerate(sorted(s, key=rank.__getitem__)[: len(s) - need + 1]):
            prefix[w].append((number, place))
    return Index(kept, rank, dict(prefix))


def _stretch(block: list[bytes], s: frozenset[bytes], own: frozenset[bytes], size: int) -> frozenset[bytes]:
    """The words of a template in the first stretch of `size` words that has most of them, those that must be there among them."""
    best: frozenset[bytes] = frozenset()
    for i in range(max(1, len(block) - size + 1)):
        both = s.intersection(block[i : i + size])
        if len(both) > len(best) and own <= both:
            best = both
    return best


def match_block(index: Index, block: list[bytes]) -> list[tuple[int, float]]:
    """(template, containment) of every template that the block meets."""
    have = sorted((w for w in set(block) if w in index.rank), key=index.rank.__getitem__)
    seen, met = set(), {}
    for j, w in enumerate(have):
        for number, i in index.prefix.get(w, ()):
            if number in seen:
                continue
            _, s, need, own, size = index.templates[number]
            if len(have) < need or min(len(s) - i, len(have) - j) < need:
                continue
            seen.add(number)
            both = s.intersection(have)
            if len(both) >= need and own <= both and len(both := _stretch(block, s, own, size)) >= need:
                met[number] = both
    return [(n, len(x) / len(index.templates[n][1])) for n, x in met.items() if not any(x < y for y in met.values())]


def word_counts(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """Occurrences of the templates' words in all texts; the result is no longer than that list of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in by_bytes(batches, "text"):
            for text in text_bytes(column(batch, "text")):
                got = Counter(words(text))
                for w in vocabulary & got.keys():
                    total[w] += got[w]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word binary, n long")
    return {bytes(r.word): r.n for r in found.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _phrases(w: list[bytes], phrases: list[tuple[list[bytes], str]]) -> list[tuple[int, str]]:
    out = []
    for phrase, label in phrases:
        last, n = phrase[-1], len(phrase)
        at = -1
        while True:
            try:
                at = w.index(last, at + 1)
            except ValueError:
                break
            if at >= n - 1 and w[at - n + 1 : at + 1] == phrase:
                out.append((at - n + 1, label))
    return sorted(out)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str, str]] | None = None, threshold: float = THRESHOLD, phrases: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, n_words, places, matches) of each row.

    places: (word, label) where a base phrase starts, ascending; matches: (start, end, label, template, containment)
    of every block and template that meet, words counted over the whole text. Null and empty texts have neither;
    repeated rows come back as often, other columns aren't looked at, and an empty table gives an empty one.
    """
    templates = TEMPLATES if templates is None else templates
    base = [(words(p.encode()), label) for p, label in (PHRASES if phrases is None else phrases).items()]
    index = build_index(templates, word_counts(docs, {w for _, t, _ in templates for w in words(t.encode())}, text_col), threshold)
    ends, starters = {p[-1] for p, _ in base}, set(index.prefix)
    place_t = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    match_t = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("template", pa.int32()), ("containment", pa.float64())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, places, matches = [], [], []
        for text in text_bytes(column(batch, "text")):
            w = words(text)
            kinds = set(w)
            n_words.append(len(w))
            places.append([{"word": i, "label": label} for i, label in _phrases(w, base)] if kinds & ends else [])
            found = []
            for s, block in blocks(w) if kinds & starters else ():
                if not starters.isdisjoint(block):
                    for number, share in match_block(index, block):
                        found.append({"start": s, "end": s + len(block), "label": index.templates[number][0], "template": number, "containment": share})
            matches.append(found)
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(n_words, pa.int64()), pa.array(places, place_t), pa.array(matches, match_t)], names=["doc_id", "n_words", "places", "matches"])

    schema = "doc_id long, n_words long, places array<struct<word:long,label:string>>, matches array<struct<start:long,end:long,label:string,template:int,containment:double>>"
    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), work, schema, "text")


def verdict(found: DataFrame) -> DataFrame:
    """Of scan(): n_base, first_word, last_word, base_labels, labels, and score: 1 with a base phrase, else the largest containment, else 0."""
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    base = F.transform("places", lambda p: p["label"])
    own = F.transform("matches", lambda m: m["label"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["word"])).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, own)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0))).alias("score"),
    )
