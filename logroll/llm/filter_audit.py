"""How filters interact: what each removes, in every order, from posting lists of failing rows.

A row is judged once (one Arrow pass over whole texts) and gets a number.  For every part (here: a
language), filter and range of 65,536 numbers the failing rows form one sorted posting list; the
wanted rows (good, toxic) have lists of their own.  A part's ranges are independent: sets of filters
are united range by range and differences taken by galloping (each list is searched in the other
from the last hit on), and only their sizes are summed.  A part with a third of all rows is thus many
ranges, and no list is longer than a range.

All orders follow from the sizes of ``failing f, but none of S`` for every filter f and set S.
"""

from __future__ import annotations

import hashlib
import math
from itertools import combinations, permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from logroll.llm.common import freeze

FILTERS = "ABCDE"
RANGE_BITS = 16
_SYMBOLS = b"#$%&*|"
_UPPER = bytes(range(65, 91))
_WANTED = ("good", "toxic")


# -- verdicts ----------------------------------------------------------------------------------------

def failing(text: bytes) -> str:
    """Letters of the filters A to D that ``text`` (UTF-8) fails."""
    words = text.split()                               # at ASCII white space, as bytes do
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.decode()) if not text.isascii() else len(text)
    return ("A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
            + "C" * (100 * upper > 3 * points) + "D" * (len(text.translate(None, _SYMBOLS)) < len(text)))


def _judge(batches):
    for batch in batches:
        out, digests = [], []
        for t in batch.column(2):
            raw = t.as_py() or b""
            out.append(failing(raw))
            digests.append(hashlib.sha256(raw).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(digests, pa.binary())],
            names=["doc_id", "part", "fails", "digest"])


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per row of ``docs``: number, part, fails (letters of A to E), good, toxic.

    E compares with every smaller doc_id of the table; a row without doc_id has no place in that order:
    it neither fails E nor makes another row fail.  An id is good (toxic) if any of its labels says so.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                       F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("t"))
    judged = freeze(read.mapInArrow(_judge, "doc_id long, part string, fails string, digest binary")
                    .withColumn("number", F.monotonically_increasing_id()), "audit-judged")
    first = (judged.where("doc_id IS NOT NULL").groupBy(F.col("digest").alias("same"))
             .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
             .where("last_id > first_id").select("same", "first_id"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("of")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    yes = lambda c: F.coalesce(F.col(c) == 1, F.lit(False)).alias(c)                        # noqa: E731
    again = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return (judged.join(first, F.col("digest") == F.col("same"), "left")
            .join(marks, F.col("doc_id") == F.col("of"), "left")
            .select("number", "part", F.concat("fails", F.when(again, "E").otherwise("")).alias("fails"),
                    yes("good"), yes("toxic")))


# -- posting lists -----------------------------------------------------------------------------------

def postings(judged: DataFrame) -> DataFrame:
    """part, span, list, ids: the sorted numbers of each list within each range (``span``).  Lists are
    the filters' letters, ``all``, ``good`` and ``toxic``."""
    lists = F.concat(F.filter(F.split("fails", ""), lambda c: c != ""), F.array(F.lit("all")),
                     *[F.when(F.col(w), F.array(F.lit(w))).otherwise(F.array().cast("array<string>")) for w in _WANTED])
    return (judged.select("part", F.shiftright("number", RANGE_BITS).alias("span"), "number", F.explode(lists).alias("list"))
            .groupBy("part", "span", "list").agg(F.sort_array(F.collect_list("number")).alias("ids")))


def gallop(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each element of sorted ``a`` is in sorted ``b``: the shorter list's elements are looked
    for in the longer one, each from the place of the one before."""
    hit = np.zeros(len(a), bool)
    if not len(a) or not len(b) or a[-1] < b[0] or b[-1] < a[0]:
        return hit
    if len(a) <= len(b):
        at = np.searchsorted(b, a)
        at[at == len(b)] = 0
        return b[at] == a
    at = np.searchsorted(a, b)
    at, want = at[at < len(a)], b[at < len(a)]
    hit[at[a[at] == want]] = True
    return hit


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of sorted lists without common elements."""
    if len(a) < len(b):
        a, b = b, a
    return np.insert(a, np.searchsorted(a, b), b) if len(b) else a


def interactions(lists: dict[str, np.ndarray], filters: str = FILTERS) -> list[tuple]:
    """(f, S, removed, good, toxic) for every filter f and set S (a sorted string) of other filters:
    the sizes of the rows that fail f and none of S, and of the wanted rows among them."""
    empty = np.empty(0, np.int64)
    get = lambda k: lists.get(k, empty)                                                     # noqa: E731
    unions, out = {"": empty}, []
    for size in range(len(filters)):
        for s in map("".join, combinations(filters, size)):
            for f in filters:
                if f in s:
                    continue
                rest = get(f)[~gallop(get(f), unions[s])]
                out.append((f, s, len(rest), *(int(gallop(rest, get(w)).sum()) for w in _WANTED)))
                whole = "".join(sorted(s + f))
                if whole not in unions and size + 1 < len(filters):
                    unions[whole] = merge(unions[s], rest)
    return out


def _sizes(key, pdf: pd.DataFrame) -> pd.DataFrame:
    lists = {k: np.asarray(v, np.int64) for k, v in zip(pdf["list"], pdf["ids"])}
    rows = [("", "", len(lists["all"]), 0, 0), *interactions(lists)]
    return pd.DataFrame([(key[0], *r) for r in rows], columns=["part", "f", "s", "removed", "good", "toxic"])


# -- orders ------------------------------------------------------------------------------------------

def orders(spark: SparkSession, filters: str = FILTERS) -> DataFrame:
    """filter_order, step, f, s for every order of the filters: a fixed table of n * n! rows."""
    rows = [("".join(p), i + 1, p[i], "".join(sorted(p[:i]))) for p in permutations(filters) for i in range(len(p))]
    return spark.createDataFrame(rows, "filter_order string, step int, f string, s string")


def audit(posted: DataFrame) -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley.  Only sizes are shuffled: 81 rows per range, summed before."""
    spark, n = posted.sparkSession, len(FILTERS)
    sizes = freeze(posted.groupBy("part", "span").applyInPandas(
        _sizes, "part string, f string, s string, removed long, good long, toxic long")
        .groupBy("part", "f", "s").agg(*[F.sum(c).alias(c) for c in ("removed", "good", "toxic")]), "audit-sizes")
    # Of n! orders, |S|! (n - 1 - |S|)! have exactly the filters S before f.
    weight = F.element_at(F.array(*[F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n)]), F.length("s") + 1)
    per_filter = sizes.where("f <> ''").groupBy("part", "f").agg(
        F.sum(F.col("removed") * weight).alias("shapley"), F.max(F.when(F.col("s") == "", F.col("removed"))).alias("fails"),
        F.max(F.when(F.length("s") == n - 1, F.col("removed"))).alias("unique_fails"))
    total = sizes.where("f = ''").select("part", F.col("removed").alias("docs"))
    # A few hundred rows of constants, whatever the input.
    steps = sizes.where("f <> ''").join(per_filter, ["part", "f"]).join(total, "part").join(F.broadcast(orders(spark)), ["f", "s"])
    # Removed up to a step: the sizes along the order.  120 * 5 rows a part, so windows stay small.
    so_far = F.sum("removed").over(Window.partitionBy("part", "filter_order").orderBy("step"))
    return steps.select("part", "filter_order", "step", (F.col("docs") - so_far).cast("long").alias("kept"), "removed",
                        (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails",
                        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
                        F.col("shapley").cast("long").alias("shapley"))


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over ``docs`` (doc_id, lang, text), marks from ``labels`` (doc_id,
    quality, toxic).

    A null text is empty; a null lang is the part ''.  Repeated rows count each; extra columns of both
    tables are ignored; no documents give no rows, no labels zeros.
    """
    judged = freeze(verdicts(docs.select("doc_id", "lang", "text"), labels.select("doc_id", "quality", "toxic")), "audit-verdicts")
    return audit(freeze(postings(judged), "audit-postings"))
