"""Small tables with nulls, empty and very long texts, ties, repeated rows and clashing column names."""

import random

DOC_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "component string, row int, nth int, removed string, part int, score double, sequence_id int, h1 int"
)
_WORDS = [a + b for a in ("ka", "lo", "mi", "re", "su", "ta", "ne", "vo") for b in ("n", "r", "st", "la", "dem", "fi")]


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join(rng.choice(_WORDS) for _ in range(words))


def edited(text, seed, every):
    """One word in ``every`` replaced."""
    rng = random.Random(seed)
    words = text.split(" ")
    for k in range(rng.randrange(every), len(words), every):
        words[k] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def texts():
    """(doc_id, text) rows: copies, near copies, repeated rows, ids with two texts, and odd texts."""
    base, other = prose(1, 120), prose(2, 90)
    lines = "\n".join(prose(k, 25) for k in range(3, 9))
    rows = [(10 + k, edited(base, k, 60)) for k in range(6)]
    rows += [(30 + k, base) for k in range(4)] + [(40, base.upper()), (41, base.replace(" ", "\t \n"))]
    rows += [(50, other), (51, edited(other, 3, 12)), (52, other + " " + prose(7, 3))]
    rows += [(60, lines), (61, lines + "\n\n" + prose(11, 25)), (62, "   " + lines.upper() + "   ")]
    rows += [(70, None), (71, ""), (72, " \n\t"), (73, "one"), (74, "one two"), (75, "one two"), (76, "été 日本")]
    rows += [(80, prose(20, 6000)), (81, prose(20, 6000) + " end"), (82, "a" * 30_000), (83, "x " * 9000)]
    rows += [(None, base), (None, base), (None, None), (90, other), (90, other), (91, other), (91, prose(30, 40))]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [
        (id_, text, None if k % 3 else "en", "s", None if text is None else len(text), "c", k, 7, "x", 1, 0.5, 3, 4)
        for k, (id_, text) in enumerate(rows)
    ]
    return spark.createDataFrame(full, DOC_SCHEMA)


def union(parents, a, b):
    a, b = root(parents, a), root(parents, b)
    parents[max(a, b)] = min(a, b)


def root(parents, a):
    while parents[a] != a:
        a = parents[a]
    return a
