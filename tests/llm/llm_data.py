"""Small made-up texts with every odd case, shared by the tests of the corpus operators."""

import random

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "id long, th long, pos int, k int, score double, leaf string")


def prose(seed, words, vocab=400):
    r = random.Random(seed)
    syl = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "i", "o", "an", "er")]
    pool = ["".join(r.choice(syl) for _ in range(r.randint(1, 4))) for _ in range(vocab)]
    out = []
    for i in range(words):
        w = r.choice(pool)
        out.append(w.capitalize() if i % 11 == 0 else w + ("." if i % 11 == 10 else ""))
    return " ".join(out)


def rows(texts):
    """Documents with ids 1, 2, ... and further columns whose names operators use inside."""
    return [(i, t, "en", "src0", len(t or ""), -(i or 0), 7, 3, 1, 0.5, "leaf") for i, t in texts]


def odd_texts():
    base = prose(1, 120)
    long = prose(2, 30_000, vocab=3000)
    return [(1, base), (2, base), (2, base), (3, None), (4, ""), (5, "   \n\t "), (6, "one two"), (7, "One TWO"),
            (8, long), (9, long + " end"), (10, base.replace(base.split()[60], "changed", 1)), (None, base),
            (11, "Ünïcode wörd 漢字 𝒳 " + prose(3, 40))]


def frame(spark, texts):
    return spark.createDataFrame(rows(texts), DOC_SCHEMA)
