"""Small hand-made tables for the operators of ``sigfleet.llm``."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# Names that operators use inside; a table may bring them along.
CLASH = ["row", "key", "size", "digest", "spans", "qstat", "kept", "id", "class", "bin", "h", "a"]


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}x" for _ in range(n))


def messy(spark, clash=True):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows."""
    rng = random.Random(5)
    body = sentence(rng, 60)
    rows = [
        (1, body, "en", "s1", 10),
        (1, body, "en", "s1", 10),
        (2, body, "en", "s2", 10),
        (3, body.upper(), "en", None, 10),
        (4, None, "en", "s1", None),
        (5, "", None, "s1", 0),
        (6, " \n\t ", "de", "s2", 4),
        (7, "one", "de", "s2", 3),
        (None, sentence(rng, 30), None, None, None),
        (None, None, None, None, None),
        (8, sentence(rng, 30_000), "fr", "s3", 5),
        (9, "x" * 200_000, "fr", "s3", 5),
        (10, "7" * 5_000 + "." * 3 + "a@" * 2_000, "fr", "s3", 5),
    ]
    df = spark.createDataFrame(rows, DOCS)
    if clash:
        for i, c in enumerate(CLASH):
            df = df.selectExpr("*", f"{i} as `{c}`")
    return df, rows


def empty(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
