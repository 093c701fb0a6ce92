"""Approximate nearest neighbours with a hash-prefix forest.

Each tree names a vector by a long bit string (signs of random orthogonal projections of the
centred vector) and keeps the strings as sorted arrays.  A query descends every tree to its
longest prefix match, then all trees ascend together, one bit at a time, until the matches of all
trees number ``effort`` times the vectors; everything under the prefixes reached is scored exactly
on the original vectors.  Matches and vectors are counted as distinct vectors, as on the sample that
sets ``effort``: copies of one vector do not use up the effort.

A tree's sorted array is cut by leading bits into blocks, crowded prefixes by a hash of the id as
well, so a block is bounded whatever the data.  A query that has to climb above the bits of a
block goes to all blocks under its prefix, so no bucket is capped.  Equal vectors are one entry
with their k + 1 smallest ids.  ``effort`` is set on a bounded sample (at most ``SAMPLE`` vectors)
as the least that reaches ``goal`` recall there; every row is indexed and can be found.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from logroll.llm.common import freeze, release
from logroll.llm.vectors import matrix, usable, width_of

TREES, BITS, BLOCK, QUERY_BLOCK, SAMPLE = 16, 32, 4096, 256, 4096
EFFORTS = (0.05, 0.1, 0.2, 0.4, 0.7, 1.0, 1.4, 2.0, 3.0, 5.0, 8.0, float(TREES))


class Forest:
    """Projections of the trees and the strings they give."""

    def __init__(self, width: int, centre: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        rows = []
        for _ in range(TREES):
            need, got = BITS, []
            while need > 0:
                basis, _ = np.linalg.qr(rng.standard_normal((width, width)))
                got.append(basis[:, :need])
                need -= got[-1].shape[1]
            rows.append(np.concatenate(got, axis=1))
        self.planes, self.centre = np.concatenate(rows, axis=1), centre

    def strings(self, x: np.ndarray) -> np.ndarray:
        """(rows, TREES) unsigned strings, first projection as the highest bit."""
        with np.errstate(over="ignore", invalid="ignore"):
            bits = ((x - self.centre) @ self.planes > 0).reshape(len(x), TREES, BITS)
        return (bits.astype(np.uint64) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of strings."""
    x = (a ^ b).astype(np.float64)
    return BITS - np.where(x > 0, np.floor(np.log2(np.maximum(x, 1.0))) + 1, 0).astype(np.int64)


def distances(c: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, components added in order."""
    total = np.zeros(len(c))
    with np.errstate(over="ignore"):
        for j in range(c.shape[1]):
            total += (c[:, j] - q[j]) ** 2
    return np.sqrt(total)


def settle_effort(forest: Forest, x: np.ndarray, k: int, goal: float, probes: int = 200) -> float:
    """Least effort whose recall on the sample reaches ``goal``."""
    if len(x) <= k + 1:
        return float(TREES)
    s = forest.strings(x)
    hit = np.zeros(len(EFFORTS))
    at = np.linspace(0, len(x) - 1, min(probes, len(x))).astype(int)
    for i in at:
        d = distances(x, x[i])
        d[i] = np.inf
        near = np.argpartition(d, k)[:k]
        lcp = _shared(s, s[i])
        count = np.bincount(lcp.ravel(), minlength=BITS + 1)[::-1].cumsum()[::-1]     # matches at each level or above
        best = lcp[near].max(axis=1)
        for e, effort in enumerate(EFFORTS):
            ok = np.flatnonzero(count >= min(effort, TREES) * len(x))
            hit[e] += (best >= (ok.max() if len(ok) else 0)).mean()
    good = np.flatnonzero(hit / len(at) >= goal)
    return EFFORTS[good[0]] if len(good) else float(TREES)


def _hashed(batches, forest, width, lead, vectors=True):
    """One row per vector and tree: string, its leading bits, the vector.  A batch per tree, so what goes to
    the JVM at once is no larger than what came, and the vectors are not copied."""
    for batch in batches:
        ids, v = batch.column(0), batch.column(1)
        s = forest.strings(matrix(v, width, "<f8"))
        for tree in range(TREES):
            own = s[:, tree]
            head = (own >> np.uint64(BITS - lead)).astype(np.int64) if lead else np.zeros(len(own), np.int64)
            cols = {"vec_id": ids, "tree": pa.array(np.full(len(own), tree, np.int32)), "s": pa.array(own.astype(np.int64)),
                    "lead": pa.array(head)}
            yield pa.RecordBatch.from_pydict({**cols, "v": v} if vectors else cols)
    release()


def _packed(table, name, kind):
    return table.column(name).to_numpy().astype(kind, copy=False)


def _tree_block(key, table, width):
    """A sorted array: strings, ids (the smallest of each group of equal vectors), vectors."""
    s, ids = _packed(table, "s", "<i8"), _packed(table, "vec_id", "<i8")
    o = np.lexsort((ids, s))
    v = matrix(table.column("v").combine_chunks(), width, "<f8")[o]
    tree, lead, salt = (k.as_py() for k in key)
    return pa.table({"tree": pa.array([tree], pa.int32()), "lead": pa.array([lead], pa.int64()),
                     "salt": pa.array([salt], pa.int64()), "s": [s[o].tobytes()], "ids": [ids[o].tobytes()],
                     "v": [v.tobytes()]})


def _query_lot(key, table, width):
    tree, lead = key[0].as_py(), key[1].as_py()
    v = matrix(table.column("v").combine_chunks(), width, "<f8")
    return pa.table({"tree": pa.array([tree], pa.int32()), "lead": pa.array([lead], pa.int64()),
                     "q_s": [_packed(table, "s", "<i8").tobytes()], "q_ids": [_packed(table, "vec_id", "<i8").tobytes()],
                     "level": [_packed(table, "level", "<i4").tobytes()], "q": [v.tobytes()]})


def _range(s, q, level):
    """Slice of the sorted strings that share ``level`` leading bits with ``q``."""
    shift = BITS - level
    low = (q >> shift) << shift
    return np.searchsorted(s, low), np.searchsorted(s, low + (1 << shift))


def _counted(batches, lead):
    """Descend: for each query and level from the block's leading bits down, the matches there."""
    for batch in batches:
        for r in batch.to_pylist():
            s = np.frombuffer(r["s"], "<i8")
            ids, out = np.frombuffer(r["q_ids"], "<i8"), []
            for qid, q in zip(ids.tolist(), np.frombuffer(r["q_s"], "<i8").tolist()):
                for level in range(lead, BITS + 1):
                    a, b = _range(s, q, level)
                    if a == b:
                        break
                    out.append((qid, level, int(b - a)))
            cols = list(zip(*out)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64()))],
                                             names=["query_id", "level", "n"])
    release()


def _scored(batches, width, k):
    """Matches under each query's prefix, k + 1 nearest groups of equal vectors of each block."""
    for batch in batches:
        for r in batch.to_pylist():
            s, ids = np.frombuffer(r["s"], "<i8"), np.frombuffer(r["ids"], "<i8")
            v = np.frombuffer(r["v"], "<f8").reshape(len(ids), width)
            q = np.frombuffer(r["q"], "<f8").reshape(-1, width)
            out_q, out_i, out_d = [], [], []
            rows = zip(np.frombuffer(r["q_ids"], "<i8").tolist(), np.frombuffer(r["q_s"], "<i8").tolist(),
                       np.frombuffer(r["level"], "<i4").tolist())
            for j, (qid, qs, level) in enumerate(rows):
                a, b = _range(s, qs, level)
                if a == b:
                    continue
                d = distances(v[a:b], q[j])
                o = np.lexsort((ids[a:b], d))[:k + 1] if b - a > k + 1 else np.arange(b - a)
                out_q += [qid] * len(o)
                out_i.append(ids[a:b][o])
                out_d.append(d[o])
            none = np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_q, pa.int64()), pa.array(np.concatenate([none, *out_i]).astype(np.int64)),
                 pa.array(np.concatenate([none, *out_d]))], ["query_id", "rep", "score"])
    release()


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, goal: float = 0.97) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance): the nearest found of every row but the query's own.

    Queries are the rows whose vec_id is divisible by ``every``.  Ties go to the smaller vec_id.
    Null and zero vectors, vectors with a null or non-finite component and rows without vec_id
    take no part; different widths are padded with zeros.  Rows that repeat a vec_id are one
    vector (the smallest in component order).  With at most k candidates all are returned.
    """
    spark = vectors.sparkSession
    raw = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("e"))
    doubles = F.transform("e", lambda x: x.cast("double") + F.lit(0.0))                 # -0.0 becomes 0.0
    all_ = freeze(raw.where(usable(F.col("e")) & F.col("vec_id").isNotNull() & F.exists("e", lambda x: x != 0))
                  .select("vec_id", doubles.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v")),
                  "ann-vectors")
    width = max(1, width_of(all_, "v"))
    # Equal vectors once, with their k + 1 smallest ids (a query leaves out its own).
    heads = all_.groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
    entries = freeze(heads, "ann-entries")
    many = entries.where("copies > 1").select(F.col("v").alias("w"), F.col("vec_id").alias("rep"))
    # Copies are thinned per task-sized salt before they meet, so a huge group stays cheap.
    salted = all_.join(many, all_["v"].eqNullSafe(many["w"])).select(
        "rep", "vec_id", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("salt"))
    few = (salted.withColumn("r", F.row_number().over(W.partitionBy("rep", "salt").orderBy("vec_id")))
           .where(F.col("r") <= k + 1)
           .withColumn("r", F.row_number().over(W.partitionBy("rep").orderBy("vec_id"))).where(F.col("r") <= k + 1)
           .select("rep", "vec_id"))
    copies = freeze(few.union(entries.where("copies = 1").select(F.col("vec_id").alias("rep"), "vec_id")), "ann-copies")

    n = entries.count()
    sample = np.array([r["v"] + [0.0] * (width - len(r["v"])) for r in
                       entries.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").select("v").limit(SAMPLE).collect()])
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    forest = Forest(width, sample.mean(axis=0))
    effort = settle_effort(forest, sample, k, goal)
    lead = max(0, min(BITS, int(math.log2(max(1, n / BLOCK)))))

    places = "vec_id long, tree int, s long, lead long"
    shape = places + ", v array<double>"
    hashed = entries.select("vec_id", "v").mapInArrow(lambda it: _hashed(it, forest, width, lead), shape)
    placed = entries.select("vec_id", "v").mapInArrow(lambda it: _hashed(it, forest, width, lead, vectors=False), places)
    crowd = freeze(placed.groupBy("tree", "lead").agg(F.count(F.lit(1)).alias("n")), "ann-crowd")
    salts = F.ceil(F.col("n") / F.lit(BLOCK)).cast("long")
    blocks = freeze(hashed.join(crowd.select("tree", "lead", salts.alias("salts")), ["tree", "lead"])
                    .withColumn("salt", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("salts")))
                    .groupBy("tree", "lead", "salt").applyInArrow(
                        lambda key, table: _tree_block(key, table, width),
                        "tree int, lead long, salt long, s binary, ids binary, v binary"), "ann-blocks")

    asked = all_.where(F.col("vec_id") % every == 0)
    lots = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    q = freeze(asked.select("vec_id", "v")
               .mapInArrow(lambda it: _hashed(it, forest, width, lead), shape), "ann-queries")
    lot_shape = "tree int, lead long, q_s binary, q_ids binary, level binary, q binary"

    def in_lots(rows):
        return (rows.withColumn("lot", F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(lots)))
                .groupBy("tree", "lead", "lot").applyInArrow(lambda key, table: _query_lot(key, table, width), lot_shape))

    deep = (in_lots(q.withColumn("level", F.lit(lead))).select("tree", "lead", "q_s", "q_ids")
            .join(blocks.select("tree", "lead", "s"), ["tree", "lead"])
            .mapInArrow(lambda it: _counted(it, lead), "query_id long, level int, n long"))
    # Levels above a block's leading bits: sums over blocks.
    prefixes = F.explode(F.transform(F.sequence(F.lit(0), F.lit(lead)), lambda i: F.struct(i.alias("level"), F.floor(
        F.col("lead") / F.pow(F.lit(2.0), F.lit(lead) - i)).cast("long").alias("prefix")))).alias("p")
    tops = (crowd.select("tree", F.col("n").alias("w"), prefixes).groupBy("tree", "p.level", "p.prefix").agg(F.sum("w").alias("n")))
    shallow = (q.select(F.col("vec_id").alias("query_id"), "tree", prefixes)
        .select("query_id", "tree", "p.level", "p.prefix").where(F.col("level") < lead)
        .join(tops, ["tree", "level", "prefix"]).select("query_id", "level", "n"))
    goal_n = min(effort, float(TREES)) * n
    levels = (deep.union(shallow).groupBy("query_id", "level").agg(F.sum("n").alias("n"))
              .where(F.col("n") >= F.lit(goal_n) - 0.5).groupBy("query_id").agg(F.max("level").cast("int").alias("level")))
    climbed = (q.join(levels, F.col("vec_id") == F.col("query_id"), "left")
               .select("vec_id", "v", "tree", "s", "lead", F.coalesce("level", F.lit(0)).alias("level")))
    up = F.greatest(F.lit(0), F.lit(lead) - F.col("level"))
    span = F.pow(F.lit(2.0), up).cast("long")
    base = (F.floor(F.col("lead") / span) * span).cast("long")
    spread = climbed.withColumn("lead", F.explode(F.sequence(base, base + span - 1)))
    found = (in_lots(spread).join(blocks.select("tree", "lead", "s", "ids", "v"), ["tree", "lead"])
             .select("s", "ids", "v", "q_s", "q_ids", "level", "q")
             .mapInArrow(lambda it: _scored(it, width, k), "query_id long, rep long, score double")
             .distinct())
    best = (found.withColumn("r", F.row_number().over(W.partitionBy("query_id").orderBy("score", "rep")))
            .where(F.col("r") <= k + 1))
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return (best.join(copies, "rep").where("vec_id != query_id").withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
