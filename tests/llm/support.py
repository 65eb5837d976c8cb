"""Small tables with the awkward cases, and plain versions of what the operators compute."""

import re

WORD = re.compile("[^ \t-\r]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text, fold=True):
    return WORD.findall((text or "").translate(FOLD) if fold else (text or ""))


def prose(seed, n):
    import random

    pick = random.Random(seed)
    return " ".join("".join(pick.choice(["the", "an", "er", "on", "ti", "st", "é", "X"]) for _ in range(pick.randint(1, 3))) for _ in range(n))


LONG = prose(99, 30_000)
TEXTS = [None, "", "  \n\t ", "one", prose(1, 80), prose(1, 80), prose(2, 200), LONG, LONG + " tail", "a b c a b c a b c", prose(3, 60) + "\n" + prose(3, 60)]
ROWS = [(i, t, ["en", "fr", None][i % 3], ["a", "b", None][i % 3], None if t is None else len(t)) for i, t in enumerate(TEXTS)]


def awkward(spark, ids=True):
    """Nulls, empty and very long texts, copies, a row repeated whole, and columns whose names operators use inside."""
    rows = ROWS + [ROWS[4]] + ([(None, prose(5, 70), "en", "a", 1)] if ids else [])
    frame = spark.createDataFrame(rows, COLUMNS)
    for name in ("size", "score", "row", "shard", "node", "n", "key", "counts", "part", "carried", "stratum"):
        frame = frame.selectExpr("*", f"'{name}' AS {name}")
    return frame


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
