"""Small document tables with everything that may go wrong in them."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, _id long, _text string, bucket int, shard int, length long"


def documents(spark, rows):
    """Rows (doc_id, text) with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", None, 1, True, 7, "x", 3, 4, 5) for i, t in rows], SCHEMA)


def words(seed, n, vocabulary=400):
    random_ = random.Random(seed)
    return " ".join("w" + format(random_.randrange(vocabulary), "x") for _ in range(n))


def awkward():
    """(doc_id, text): nulls, empty and very long texts, copies, near copies, ties and odd characters."""
    base = words(1, 120)
    return [
        (5, None), (6, ""), (7, "  \n\t"), (8, base), (9, base), (10, base.replace(" ", "  ", 3)), (11, base + " tail"),
        (12, words(2, 30)), (13, words(3, 4000)), (14, "É à ß 日本語 😀 x " * 20), (15, "one"), (16, "one two"), (17, "a " * 300),
        (18, words(4, 60) + " " + base[:200]), (19, "\x00\x1f odd  marks     end"), (3, base),
        (20, words(2, 30).upper()), (21, "line\n" * 60),
    ]
