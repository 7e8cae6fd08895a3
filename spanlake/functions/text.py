"""Text, label and JSON expressions: Column in, Column out, all inside the JVM.

White space is Unicode's ((?U) in patterns); offsets and lengths count code points, as Spark's string functions do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Longest term and longest context of a term, context to either side of a mention, longest payload context.
TERM_CHARS, TERM_CONTEXT_CHARS, CONTEXT_CHARS, PAYLOAD_CONTEXT_CHARS = 500, 200, 100, 1000
SOFT_HYPHEN = "­"


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_filled(*cols: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def normalize_text(c: Column) -> Column:
    """A paragraph: no soft hyphens, runs of blanks as one space, none before closing punctuation, stripped."""
    c = F.regexp_replace(F.replace(c, F.lit(SOFT_HYPHEN), F.lit("")), r"[ \t\r\f\x0B]+", " ")
    return strip(F.regexp_replace(c, r"(?U)\s+([,.;:!?])", "$1"))


def normalize_markdown(c: Column) -> Column:
    """A page: no soft hyphens, runs of blanks as one space, at most one empty line in a row, stripped."""
    c = F.regexp_replace(F.replace(c, F.lit(SOFT_HYPHEN), F.lit("")), r"[ \t\r\f\x0B]+", " ")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def collapse_blank_lines(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def collapse_blanks(c: Column) -> Column:
    """Spaces and tabs as one space, stripped; null where nothing is left."""
    return blank_to_null(strip(F.regexp_replace(c, r"[ \t]+", " ")))


def clean_text(c: Column) -> Column:
    """One line: null as empty, line ends as spaces, runs of blanks as one space, stripped."""
    c = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"\r\n|\r|\n", " ")
    return strip(F.regexp_replace(c, r"[ \t]+", " "))


def sanitize_term(c: Column, most: int = TERM_CHARS) -> Column:
    """clean_text() without characters that are neither printable nor white space, cut to `most` characters."""
    c = F.regexp_replace(clean_text(c), r"(?U)[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}&&[^\s\x1C-\x1F]]", "")
    return F.regexp_replace(F.substring(strip(c), 1, most), r"(?U)\s+\z", "")


def folded(c: Column) -> Column:
    """For comparing surfaces: lower case (sharp s as ss), white space as single spaces, stripped."""
    return strip(F.regexp_replace(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), r"(?U)\s+", " "))


def clean_label(c: Column) -> Column:
    """A model's label: stripped, white space as underscores, only ASCII letters, digits and underscores."""
    return F.regexp_replace(F.regexp_replace(strip(c), r"(?U)\s+", "_"), "[^A-Za-z0-9_]", "")


def markup_label(c: Column) -> Column:
    """A label as it stands in inline markup."""
    return F.replace(strip(c), F.lit(" "), F.lit("_"))


def label_set(labels: Column, most: int = 30) -> Column:
    """Generated labels: upper case with underscores, empty ones dropped, each kept once in first place, at most `most`."""

    def one(x: Column) -> Column:
        x = F.upper(F.replace(strip(F.regexp_replace(x, "[^A-Za-z0-9_ ]+", "")), F.lit(" "), F.lit("_")))
        return F.regexp_replace(x, "_+", "_")

    return F.slice(F.array_distinct(F.filter(F.transform(labels, one), lambda x: x != "")), 1, most)


def parse_labels(c: Column) -> Column:
    """Labels of a comma list or a JSON array: stripped, empty ones dropped, each once in first place; null if none is left."""
    c = strip(c)
    listed = F.when(F.startswith(c, F.lit("[")), F.from_json(c, "array<string>")).otherwise(F.split(c, ","))
    kept = F.array_distinct(F.filter(F.transform(listed, strip), lambda x: x.isNotNull() & (x != "")))
    return F.when(F.size(kept) > 0, kept)


def one_line(c: Column) -> Column:
    """White space as single spaces, stripped."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def entity_text(c: Column) -> Column:
    """A discovered entity on one line; null if it holds mask characters."""
    c = one_line(c)
    return F.when(~F.contains(c, F.lit("*")), c)


def context(text: Column, start: Column, end: Column, width: int = CONTEXT_CHARS) -> Column:
    """The mention and `width` characters to either side on one line; null unless 0 <= start < end <= length."""
    left, right = F.greatest(start - width, F.lit(0)), F.least(end + width, F.length(text))
    cut = one_line(F.substring(text, left + 1, right - left))
    return F.when((start >= 0) & (end <= F.length(text)) & (start < end), cut)


def term_context(c: Column) -> Column:
    return F.when(c.isNotNull() & (c != ""), F.substring(sanitize_term(c), 1, TERM_CONTEXT_CHARS))


def strip_fences(c: Column) -> Column:
    """Without a code fence around the whole: its first line, and its last line if that is a fence."""
    c = strip(c)
    inner = F.regexp_replace(F.regexp_replace(c, r"\A```[^\n]*(\n|\z)", ""), r"(?U)(\A|\n)\s*```\s*\z", "")
    return F.when(F.startswith(c, F.lit("```")), strip(inner)).otherwise(c)


def lenient_json(c: Column, lists: bool = True) -> Column:
    """A reply's JSON as text: the whole, else from the first { to the last }, else from the first [ to the last ].

    A bare list becomes {"entities": list} if `lists`. Null where nothing parses.
    """

    def valid(x: Column) -> Column:
        return F.when(F.try_parse_json(x).isNotNull(), x)

    braces = F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    brackets = F.regexp_extract(c, r"(?s)(\[.*\])", 1)
    found = F.coalesce(valid(c), F.when(braces != "", valid(braces)))
    if not lists:
        return found
    found = F.coalesce(found, F.when((braces == "") & (brackets != ""), valid(brackets)))
    return F.when(F.startswith(F.ltrim(found), F.lit("[")), F.concat(F.lit('{"entities": '), found, F.lit("}"))).otherwise(found)


def chunk_number(name: Column) -> Column:
    """NNN of a name that ends in chunk_NNN; null else."""
    return F.regexp_extract(name, r"chunk_(\d+)\z", 1).try_cast("long")


def safe_name(c: Column) -> Column:
    """A file name's stem made safe, with .json."""
    stem = F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"(?<=.)\.[^.]*\z", "")
    return F.concat(F.regexp_replace(first_filled(stem, F.lit("document")), "[^A-Za-z0-9_.-]+", "_"), F.lit(".json"))


def path_segment_error(c: Column) -> Column:
    """Why a path segment is refused; null if it isn't. Plain spaces pass."""
    return F.when(F.coalesce(strip(c), F.lit("")) == "", "empty").when(c.rlike(r"[/\\\n\r\t]|\.\."), "separator or white space")


def result_count(c: Column, default: int = 1, most: int = 20) -> Column:
    """A requested number of results as text, held to 1..most; the default if it is no number."""
    return F.coalesce(F.least(F.greatest(c.try_cast("int"), F.lit(1)), F.lit(most)), F.lit(default))


def count_tokens(c: Column) -> Column:
    """White-space tokens."""
    return F.size(F.regexp_extract_all(c, F.lit(r"(?U)\S+"), F.lit(0)))
