import random

from spanlake.llm import lines as L
from tests.llm.test_lines import levenshtein


def planted():
    """Lines of 6 to 20 words, each with a variant of which one letter in one word is another; short words count too."""
    rng = random.Random(8)
    vocab = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(400)]
    base = [" ".join(rng.choices(vocab, k=rng.choice([6, 8, 10, 15, 20]))) for _ in range(60)]
    out = list(base)
    for x in base:
        at = rng.choice([i for i, c in enumerate(x) if c != " "])
        out.append(x[:at] + "z" + x[at + 1 :])
    return out


def test_against_edit_similarity_alone(spark):
    lines = planted()
    gone = {j for j in range(len(lines)) for i in range(j) if 1 - levenshtein(lines[i], lines[j]) / max(len(lines[i]), len(lines[j])) >= L.SIMILAR - 1e-9}
    assert len(gone) >= 60
    got = L.deduplicate(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    found = {r.doc_id for r in got if r.n_removed}
    assert found <= gone and len(found) >= 0.98 * len(gone)


def test_recall_of_one_edit():
    """Of lines with one letter changed or added, nearly all share a key with the line they come from."""
    rng = random.Random(3)
    vocab = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 9))) for _ in range(3000)]
    for n in (5, 6, 10, 15, 20, 30, 60):
        met = 0
        for _ in range(300):
            x = " ".join(rng.choices(vocab, k=n))
            at = rng.choice([i for i, c in enumerate(x) if c != " "])
            y = x[:at] + rng.choice("xyz") + x[at + rng.randint(0, 1) :]
            p, q = L.line_keys([x.encode(), y.encode()])
            met += bool(set(p.tolist()) & set(q.tolist())) and bool(L._near(L._bits_apart(*L.simhashes([x.encode(), y.encode()])), len(x), len(y), L.RADIUS))
        assert met >= 0.9 * 300, n
