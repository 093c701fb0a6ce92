"""Fixtures of the operator tests: small tables with awkward rows and clashing column names."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use inside; a table may carry them as columns of its own.
CLASH = ["rep", "key", "id", "t", "bucket", "digest", "row", "size", "n", "a", "b", "pos", "block", "label", "score", "rank"]


def docs_frame(spark, rows, clash=True):
    """rows: (doc_id, text[, lang, source])."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, *(None, None)[len(r) - 2:])[:4] if len(r) < 4 else r
        full.append((doc_id, text, lang, source, None if text is None else len(text)))
    df = spark.createDataFrame(full, DOC_SCHEMA)
    if clash:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit("x") for c in CLASH})
    return df


def words(n, seed, vocabulary=5000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def sentence(n, seed):
    return " ".join(words(n, seed))


AWKWARD = [(2001, None), (2002, ""), (2003, " \t\n"), (2004, "one"), (2005, "One"), (None, "no id here at all today"),
           (2006, "no id here at all today"), (2007, "ß Ünïcode \U0001f600 text\x00with odd   marks")]
