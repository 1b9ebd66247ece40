"""Small tables with the awkward rows every operator has to stand."""

import random

BASE = "documents"


def words(seed, n):
    rng = random.Random(seed)
    return [rng.choice(["the", "of", "ann", "thor", "ent", "ing", "ouan", "lle", "ció", "über"]) + rng.choice(["", "a", "er", "st", "ly"]) + str(rng.randrange(40)) for _ in range(n)]


def texts():
    """Texts with copies, near copies, shared passages, white space, blanks, nulls and one very long word."""
    base = words(1, 300)
    near = base[:150] + ["changed"] + base[151:]
    passage = " ".join(words(2, 60))
    out = [
        " ".join(base),
        " ".join(base),
        " ".join(near),
        " ".join(base[:140]) + " " + " ".join(words(3, 160)),
        passage + " " + " ".join(words(4, 100)),
        " ".join(words(5, 100)) + "\n" + passage,
        "One  two\tTHREE",
        "one two three",
        "a b c d e",
        "a b c d e f",
        "",
        "   \n\t ",
        None,
        "x" * 30_000,
        "é" * 120 + " tail",
        "ab" * 400,
        "line one\nline two\nline three\nline four",
        "first\nline one\nline two\nline three\nlast",
        "\n\n\n\n",
        passage,
        "nul\x00byte " * 12,
    ]
    for k in range(12):  # a chain of near copies with edits here and there
        edited = list(base)
        for place in random.Random(k + 50).sample(range(300), k):
            edited[place] = f"edit{k}"
        out.append(" ".join(edited))
    return out


def documents(spark, extra=True):
    """The texts with ids in no order, a repeated row, a null id, and columns whose names clash with the operators' own."""
    rows = [((i * 37) % 101, t) for i, t in enumerate(texts())]
    rows += [rows[0], (None, rows[0][1]), (None, None)]
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    clashing = "score double, doc long, uid long, n long, label int, shard int, items array<string>, gone int, found int, size int, copy string"
    filler = (0.5, 1, 2, 3, 1, 7, ["x"], 1, 2, 3, "c")
    return spark.createDataFrame([r + filler for r in rows], "doc_id long, text string, " + clashing)


def empty(spark, schema="doc_id long, text string"):
    return spark.createDataFrame([], schema)
