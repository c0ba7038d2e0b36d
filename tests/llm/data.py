"""Small awkward tables for the operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# the same with columns whose names the operators use inside
CLASHING = DOCS + ", row long, _row long, score string, n_tokens string, tokens int, host string, topic int, line string, weight int"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["on", "re", "the", "ti", "é", "an", "Wh"]) for _ in range(r.randint(1, 4))) for _ in range(words))


def awkward_docs(spark, clashing: bool = False):
    """Nulls in every column, empty and very long texts, copies, repeated rows."""
    long = prose(1, 30_000)
    copy = prose(2, 80)
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, long, "en", "a", len(long)), (4, copy, None, "a", 9), (5, copy, "fr", None, 9),
        (None, copy, "en", "b", 9), (None, None, None, None, None), (6, "One word", "de", "b", 8), (7, " \n\t ", "de", "b", 4),
        (8, prose(3, 60), "en", "a", 1), (8, prose(3, 60), "en", "a", 1), (8, prose(4, 60), "en", "a", 1), (9, "é中\n\nx\n", "en", "a", 6),
        (10, copy + " end", "en", "a", 1), (11, prose(5, 400) + "\n" + copy, "es", "b", 1),
    ]
    if not clashing:
        return spark.createDataFrame(rows, DOCS)
    return spark.createDataFrame([(*r, 7, 8, "s", "t", 1, "h", 2, "l", 3) for r in rows], CLASHING)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def on_disk(df, folder, name="documents"):
    path = f"{folder}/{name}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
