"""Mixing sources to target weights over fixed-length blocks of words.

Each source's documents form one stream (by doc_id) cut into blocks of ``BLOCK`` words.  A source
gets as many slots as its target needs blocks.  Slots are drawn into output shards by a keyed
pseudorandom permutation of all slots, so a shard's source counts are a multinomial draw
conditioned on the targets: a free draw would miss small sources' targets and could exceed three
passes.  The t-th slot of a source maps to a block by the source's own index permutation, one per
epoch, and slots join blocks on (source, index).  A block is thus taken floor or ceil of
slots / blocks times, at most 3.

Prefix sums use one total per partition; slots are generated in chunks; a hot source is spread
over its block indices in the join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from logroll.llm.common import WORD, freeze, partitions
from logroll.llm.sharding import prefix_sums

BLOCK, SHARD_SLOTS, CHUNK = 64, 4096, 1 << 16
MAX_PASSES = 3


def permuted(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Keyed permutation of 0..n-1 applied to ``x``: a Feistel network, walking back into range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(xxhash.xxh64_intdigest(f"{seed}:{r}")) for r in range(6)]

    def once(v):
        a, b = v >> np.uint64(half), v & mask
        for k in keys:
            h = (b ^ k) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            a, b = b, a ^ ((h >> np.uint64(32)) & mask)
        return (a << np.uint64(half)) | b

    v = once(x.astype(np.uint64))
    while (out := v >= np.uint64(n)).any():
        v[out] = once(v[out])
    return v.astype(np.int64)


def source_plan(sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """key, source_size, target, base (words of earlier sources), blocks, slots, slot0 per source.

    Sources by code point, null last, weigh 1, 2, 3, repeating; no target is above MAX_PASSES
    times the source's size and the excess is shared anew by weight.  Sorted by size over weight,
    the stopped sources are a prefix, so one running sum over the source table settles it.
    """
    s = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    by_key = W.orderBy("key")
    s = (s.withColumn("w", (F.row_number().over(by_key) - 1) % 3 + 1)
         .withColumn("base", F.coalesce(F.sum("source_size").over(by_key.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("cap", F.lit(MAX_PASSES) * F.col("source_size"))
         .withColumn("fill", F.col("cap") / F.col("w")))
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = W.orderBy("fill", "key").rowsBetween(W.unboundedPreceding, -1)
    s = (s.withColumn("total", F.sum("source_size").over(everything)).withColumn("all_w", F.sum("w").over(everything))
         .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                     / (F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0))))
         .withColumn("stopped", F.col("fill") <= F.col("level")))
    level = F.coalesce(F.min(F.when(~F.col("stopped"), F.struct("fill", "key", "level"))).over(everything)["level"], F.lit(0.0))
    s = (s.withColumn("target", F.when(F.col("stopped"), F.col("cap").cast("double")).otherwise(F.col("w") * level))
         .withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block)).cast("long"))
         .withColumn("slots", F.when(F.col("source_size") > 0, F.least(F.col("blocks") * MAX_PASSES, F.round(
             F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"))).otherwise(F.lit(0).cast("long"))))
    return s.select("key", "source_size", "target", "base", "blocks", "slots", F.coalesce(F.sum("slots").over(
        by_key.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("slot0"), F.sum("slots").over(everything).alias("all_slots"))


def _slots(batches, seed):
    for batch in batches:
        for r in batch.to_pylist():
            t = np.arange(r["lo"], min(r["lo"] + CHUNK, r["slots"]), dtype=np.int64)
            block = np.empty(len(t), np.int64)
            for e in range(int(t[0] // r["blocks"]), int(t[-1] // r["blocks"]) + 1):
                at = t // r["blocks"] == e
                block[at] = permuted(t[at] % r["blocks"], r["blocks"], xxhash.xxh32_intdigest(f"{seed}/{r['key']}/{e}"))
            place = permuted(t + r["slot0"], r["all_slots"], xxhash.xxh32_intdigest(f"{seed}/slots"))
            n = len(t)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["key"]] * n, pa.string()), pa.array(block), pa.array((t // r["blocks"]).astype(np.int32)),
                 pa.array(place // SHARD_SLOTS), pa.array((place % SHARD_SLOTS).astype(np.int32))],
                names=["key", "block", "epoch", "shard", "slot"])


def sized(docs: DataFrame, carry: str | None = None) -> DataFrame:
    """doc_id, key (source, null last), size (words), digest of the text; ``carry`` as it is."""
    return docs.select(*([carry] if carry else []),F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("t")).alias("key"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.md5(F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))).alias("digest"))


def mix(docs: DataFrame, seed: int = 20250611, block: int = BLOCK,
        carry: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, plan, pieces): documents with their place, the source plan, the mixture.

    ``pieces``: shard, slot, epoch, row, doc_id, digest, start, length in words, and a column ``carry`` of
    ``docs`` if named.  Null or word-free
    texts have size 0 and are never taken; repeated rows count each; a null source is one source.
    """
    rows = freeze(prefix_sums(sized(docs, carry), ["key", "doc_id", "digest"], "size", "mix-sized"), "mix-rows")
    plan = freeze(source_plan(rows, block), "mix-plan")
    of = F.broadcast(plan) if plan.limit(100_001).count() <= 100_000 else plan
    placed = rows.join(of.select("key", "base"), "key").where("size > 0").withColumn("at", F.col("before") - F.col("base"))
    first, last = F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block)
    own = [carry] if carry else []
    cut = (placed.select(*own, "key", "row", "doc_id", "digest", "size", "at", F.explode(F.sequence(first, last)).alias("block"))
           .withColumn("start", F.greatest(F.lit(0), F.col("block") * block - F.col("at")))
           .withColumn("length", F.least("size", (F.col("block") + 1) * block - F.col("at")) - F.col("start"))
           .select(*own, "key", "block", "row", "doc_id", "digest", "start", "length"))
    chunks = (plan.where("slots > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1,
                                                                     F.lit(CHUNK).cast("long"))).alias("lo"))
              .repartition(partitions(plan.sparkSession), "key", "lo"))      # a stated number is not coalesced
    slots = chunks.mapInArrow(lambda it: _slots(it, seed), "key string, block long, epoch int, shard long, slot int")
    # Slots come out of few chunks, so the optimizer takes them for a small table: no broadcast.
    return rows, plan, slots.hint("merge").join(cut.hint("merge"), ["key", "block"]).drop("key", "block")


def taken(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per row of ``docs``."""
    rows, plan, pieces = mix(docs)
    words = pieces.groupBy("row").agg(F.sum("length").alias("taken"))
    of = F.broadcast(plan) if plan.limit(100_001).count() <= 100_000 else plan
    return (rows.join(of.select("key", "source_size", "target"), "key").join(words, "row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def _cut(frames, columns):
    import re
    word = re.compile(rb"[^\x20\x09-\x0D]+")
    for pdf in frames:
        at, texts = [], []
        for i, (text, size, marks) in enumerate(zip(pdf["text"], pdf["__size"], pdf["__marks"])):
            by_epoch: dict[int, list] = {}
            for m in marks:
                by_epoch.setdefault(m["epoch"], []).append((m["start"], m["start"] + m["length"]))
            raw = (text or "").encode()
            spans = None
            for epoch in sorted(by_epoch):
                runs: list[list[int]] = []
                for a, b in sorted(by_epoch[epoch]):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(b, runs[-1][1])
                    else:
                        runs.append([a, b])
                if runs == [[0, size]]:
                    out = text
                else:
                    spans = spans or [m.span() for m in word.finditer(raw)]
                    out = b"\n".join(raw[spans[a][0]:spans[b - 1][1]] for a, b in runs).decode()
                at.append(i)
                texts.append(out)
        made = pdf.iloc[at].reset_index(drop=True)
        made["text"] = texts
        if "n_chars" in columns:
            made["n_chars"] = [len(t) for t in texts]
        yield made[columns]


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mixture as documents, in the columns of ``docs``: one row per document and pass, with
    the words that pass took (the text itself where it took all).  Repeated rows and rows without doc_id
    each come with their own words."""
    kept = freeze(docs.withColumn("__rid", F.monotonically_increasing_id()), "mix-docs")      # rows by number: copies are apart
    _, _, pieces = mix(kept, carry="__rid")
    marks = pieces.groupBy("__rid").agg(F.collect_set(F.struct("epoch", "start", "length")).alias("__marks"))
    both = kept.withColumn("__size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))).join(marks, "__rid")
    columns = docs.columns
    return both.drop("__rid").mapInPandas(lambda it: _cut(it, columns), docs.schema)
