"""Exact top-k inner products: vectors by descending length, partial sums in an SVD-rotated basis,
Cauchy-Schwarz bounds on what is left.

Vectors are sorted into length classes (a factor of 2**(1/8) wide) and, within a class, into even
blocks.  The longest vectors of all (one block) give every query a first k-th score.  A query
block then meets only the blocks of classes whose upper length times the query's length can still
reach that score.  Inside a block the first rotated coordinates give a partial sum; partial sum
plus the product of the residual lengths bounds the score; who passes is scored in whole numbers.

All queries against all rows is the stated task; rows reach a task as blocks of fixed size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from logroll.llm.common import freeze
from logroll.llm.vectors import matrix, usable, width_of

BLOCK, QUERY_BLOCK = 4096, 256
STEPS = (16, 32)                       # rotated coordinates after which bounds are tested
_LONG = (1 << 63) - 1


def whole(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, v: components floor(scale * x) as doubles; unusable vectors are left out."""
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("e"))
            .where(usable(F.col("e")) & F.col("vec_id").isNotNull())
            .select("vec_id", F.transform("e", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
                    .alias("v")))


def _gram(batches, width):
    total = np.zeros((width, width))
    for batch in batches:
        m = matrix(batch.column(0), width, np.float64)
        total += m.T @ m
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.reshape(-1))], ["cell", "x"])


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of the whole table, strongest first: width² sums, whatever the rows."""
    cells = (vectors.select("v").mapInArrow(lambda it: _gram(it, width), "cell long, x double")
             .groupBy("cell").agg(F.sum("x").alias("x")).collect())
    g = np.zeros(width * width)
    for r in cells:
        g[r["cell"]] = r["x"]
    if not np.isfinite(g).all():
        return np.eye(width)
    values, basis = np.linalg.eigh(g.reshape(width, width))
    return np.ascontiguousarray(basis[:, np.argsort(-values)])


def _blocks(key, pdf, width):
    import pandas as pd
    pdf = pdf.sort_values(["norm", "vec_id"], ascending=[False, True])
    v = np.zeros((len(pdf), width))
    for i, x in enumerate(pdf["v"]):
        v[i, :len(x)] = x
    return pd.DataFrame({"part": [key[0]], "no": [key[1]], "m": [len(pdf)],
                         "ids": [pdf["vec_id"].to_numpy("<i8").tobytes()], "v": [v.astype("<f8").tobytes()]})


_BLOCK = "part int, no long, m long, ids binary, v binary"


def _load(ids, v, width):
    ids = np.frombuffer(ids, "<i8")
    return ids, np.frombuffer(v, "<f8").reshape(len(ids), width)


def scores(c: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows ``c`` with ``q`` (saturating at 64 bits)."""
    peak = float(np.abs(c).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, len(q))
    if peak < 2.0**53:
        return (c @ q).astype(np.int64)
    qi = [int(x) for x in q]
    return np.array([max(-_LONG, min(_LONG, sum(int(x) * y for x, y in zip(row, qi)))) for row in c], np.int64)


def _best(ids, s, k):
    o = np.lexsort((ids, -s))[:k]
    return ids[o], s[o]


def _floor(c_ids, c, q_ids, q, k):
    """k-th best score of each query among some vectors; -inf with fewer."""
    out = np.full(len(q_ids), -np.inf)
    for i in range(len(q_ids)):
        other = c_ids != q_ids[i]
        if other.sum() >= k:
            s = scores(c[other], q[i])
            out[i] = np.partition(s, len(s) - k)[len(s) - k]
    return out


def _seeded(batches, head, width, k):
    c_ids, c = _load(*head, width) if head else (np.empty(0, np.int64), np.empty((0, width)))
    for batch in batches:
        rows = []
        for ids, v in zip(batch.column("ids").to_pylist(), batch.column("v").to_pylist()):
            q_ids, q = _load(ids, v, width)
            low = _floor(c_ids, c, q_ids, q, k)
            norm = np.sqrt((q * q).sum(1))
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where((low <= 0) | (norm == 0), 0.0, low / norm)
            rows.append((ids, v, low.astype("<f8").tobytes(), float(need.min(initial=np.inf))))
        cols = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c_, t) for c_, t in zip(cols, [pa.binary()] * 3 + [pa.float64()])],
                                         names=["q_ids", "q", "low", "need"])


def search_block(c_ids, c, q_ids, q, low, basis, k):
    """(query, id, score) of the up to k best of each query in one block, none below its ``low``."""
    cr, qr = c @ basis, q @ basis
    with np.errstate(over="ignore"):
        size = np.sqrt((c * c).sum(1)).max(initial=0.0) * np.sqrt((q * q).sum(1)) + 1.0
    alive, part, done = np.ones((len(q), len(c)), bool), np.zeros((len(q), len(c))), 0
    for d in STEPS:
        if d >= c.shape[1] or not np.isfinite(size).all():
            break
        part += qr[:, done:d] @ cr[:, done:d].T
        done = d
        rest = np.outer(np.sqrt((qr[:, d:] ** 2).sum(1)), np.sqrt((cr[:, d:] ** 2).sum(1)))
        alive &= part + rest + (1e-9 * size)[:, None] >= low[:, None]
    out_q, out_i, out_s = [], [], []
    for i in range(len(q)):
        at = np.flatnonzero(alive[i] & (c_ids != q_ids[i]))
        s = scores(c[at], q[i])
        ok = s >= low[i]
        ids, s = _best(c_ids[at][ok], s[ok], k)
        out_q += [q_ids[i]] * len(ids)
        out_i.append(ids)
        out_s.append(s)
    return np.array(out_q, np.int64), np.concatenate([np.empty(0, np.int64), *out_i]), np.concatenate(
        [np.empty(0, np.int64), *out_s])


def _searched(batches, basis, width, k):
    for batch in batches:
        for r in batch.to_pylist():
            c_ids, c = _load(r["ids"], r["v"], width)
            q_ids, q = _load(r["q_ids"], r["q"], width)
            a, b, s = search_block(c_ids, c, q_ids, q, np.frombuffer(r["low"], "<f8"), basis, k)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s)], ["query_id", "vec_id", "score"])


def top_inner_products(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every row but the query's own.

    Ties go to the smaller vec_id; with fewer than k candidates all are returned.  Null vectors,
    vectors with a null or non-finite component and rows without vec_id take no part; vectors of
    different widths are padded with zeros (an empty one scores 0).  Rows that repeat a vec_id are
    one vector: the smallest in component order.  No usable vector: no rows.
    """
    v = freeze(whole(vectors, scale).groupBy("vec_id").agg(F.min("v").alias("v"))
               .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))
               .withColumn("part", F.floor(F.log2(F.greatest(F.col("norm"), F.lit(1e-3))) * 8).cast("int")), "topk-vectors")
    width = max(1, width_of(v, "v"))
    basis = rotation(v, width)
    sizes = {r["part"]: r["n"] for r in v.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = v.sparkSession.createDataFrame([(p, math.ceil(n / BLOCK)) for p, n in sizes.items()] or [(0, 1)],
                                             "part int, blocks int")      # as many rows as length classes (< 20,000)
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks").cast("long"))
    cand = freeze(v.join(F.broadcast(classes), "part").withColumn("no", block).groupBy("part", "no")
                  .applyInPandas(lambda key, pdf: _blocks(key, pdf, width), _BLOCK), "topk-blocks")
    top = cand.orderBy(F.col("part").desc(), "no").select("ids", "v").first()
    n_query = v.where(F.col("vec_id") % every == 0)
    lots = max(1, math.ceil(n_query.count() / QUERY_BLOCK))
    queries = (n_query.withColumn("part", F.lit(0)).withColumn("no", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(lots)))
               .groupBy("part", "no").applyInPandas(lambda key, pdf: _blocks(key, pdf, width), _BLOCK))
    head = (bytes(top["ids"]), bytes(top["v"])) if top else None
    seeded = freeze(queries.select("ids", "v").mapInArrow(
        lambda it: _seeded(it, head, width, k), "q_ids binary, q binary, low binary, need double"), "topk-queries")
    ranges = F.broadcast(classes.withColumn("reach", F.pow(F.lit(2.0), (F.col("part") + 1) / 8) * (1 + 1e-9)))
    pairs = (seeded.select("*", F.lit(1).alias("one")).join(ranges.withColumn("one", F.lit(1)), "one")
             .where(F.col("reach") >= F.col("need"))
             .select("q_ids", "q", "low", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1))
                     .alias("no")))
    found = (pairs.join(cand, ["part", "no"]).select("ids", "v", "q_ids", "q", "low")
             .mapInArrow(lambda it: _searched(it, basis, width, k), "query_id long, vec_id long, score long"))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
