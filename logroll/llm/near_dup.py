"""Near-duplicate classes by b-bit MinHash.

Per document 24 bands of 5 full minima over its distinct word shingles give the candidates.  Of
512 more minima only 4 (mixed) low bits are kept, 16 to a ``long``; the similarity of a candidate
pair is read from the bit count of the XOR, corrected for chance collisions of 4-bit values.  What
may reach the threshold within about five standard errors is confirmed on the full sets, so no
estimate decides a link.

Cost under hot groups: equal sets are collapsed first; a bucket has one leader, chosen by a map-side
minimum per round (no pairs within a bucket), and a member asks its leaders in rounds until one is
confirmed.  Of the buckets that still hold several components, members whose rarest shingles are all
their own leave (prefix filtering, which loses no pair: documents that share much repeated text, but too
little to be linked, do not meet all with all); members that are not in a bucket's largest component
meet the rest of the bucket in a join whose condition holds the bit-count test and a bound on the
symmetric difference from parity bitmaps, which loses no pair: what comes out of it is close to the links.

Two documents at similarity 0.85 share no band with probability (1 - 0.85^5)^24 < 1e-6.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from logroll.llm.common import WORD, connected_components, freeze, small, tidy_driver

BANDS, ROWS = 24, 5
HASHES, BITS = 512, 4
LONGS = HASHES * BITS // 64
PARITY = 16                     # longs of the parity bitmap
MARGIN = 0.09
WORDS = [f"w{j}" for j in range(LONGS)] + [f"p{j}" for j in range(PARITY)]
_MULT = 0x9E3779B97F4A7C15
_CACHE: dict[bytes, int] = {}
_CACHE_WORDS = 100_000


def _mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes | None, k: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles (ASCII letters lower-cased, words split
    at ASCII white space); fewer than k words: the whole sequence as one; no words: empty."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(_CACHE) > _CACHE_WORDS:
        _CACHE.clear()
    get = _CACHE.get
    hashes = []
    for w in words:
        h = get(w)
        if h is None:
            h = _CACHE[w] = xxhash.xxh64_intdigest(w)
        hashes.append(h)
    a = np.array(hashes, np.uint64)
    k = min(k, len(a))
    n = len(a) - k + 1
    h = np.full(n, k, np.uint64)
    for j in range(k):
        h = h * np.uint64(_MULT) + a[j:n + j]
    return np.unique(_mix64(h))


def minima(sets: list[np.ndarray], count: int, seed: int) -> np.ndarray:
    """(documents, count) uint32 minima of non-empty sets."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**32, count, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 2**32, count, dtype=np.uint32)
    out = np.empty((count, len(sets)), np.uint32)
    lo = 0
    while lo < len(sets):                      # chunks that stay in the CPU cache
        hi, total = lo, 0
        while hi < len(sets) and (hi == lo or total + len(sets[hi]) <= 1 << 16):
            total += len(sets[hi])
            hi += 1
        g = (np.concatenate(sets[lo:hi]) >> np.uint64(17)).astype(np.uint32)
        at = np.concatenate([[0], np.cumsum([len(s) for s in sets[lo:hi - 1]])]).astype(np.int64)
        v = np.empty_like(g)
        for i in range(count):
            np.multiply(g, a[i], out=v)
            v += b[i]
            out[i, lo:hi] = np.minimum.reduceat(v, at)
        lo = hi
    return out.T


def _signature_batches(batches, k):
    for batch in batches:
        ids = batch.column(0)
        sets = [shingle_set(t, k) for t in batch.column(1).to_pylist()]
        full = [i for i, s in enumerate(sets) if len(s)]
        n = len(sets)
        bands = np.zeros((n, BANDS), np.uint64)
        if full:
            m = minima([sets[i] for i in full], BANDS * ROWS, 20250611)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(full), BANDS)).copy()
            rows = m.reshape(len(full), BANDS, ROWS).astype(np.uint64)
            for r in range(ROWS):
                key = _mix64(key * np.uint64(_MULT) + rows[:, :, r])
            bands[full] = key
        flat = pa.array(bands.view(np.int64).reshape(-1))
        digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()),
             pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)), flat), batch.column(2)],
            names=["doc_id", "n_shingles", "digest", "bands", "th"])


def _set_batches(batches, k):
    for batch in batches:
        sets = [shingle_set(t, k) for t in batch.column(1).to_pylist()]
        at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
        words = np.zeros((len(sets), LONGS), np.uint64)
        full = [i for i, s in enumerate(sets) if len(s)]
        if full:
            m = minima([sets[i] for i in full], HASHES, 77)
            low = m ^ (m >> np.uint32(16))
            low = (low * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)      # mixed before bits are kept
            planes = (low.astype(np.uint8).reshape(len(full), HASHES // 64, 1, 64)
                      >> np.arange(BITS, dtype=np.uint8).reshape(BITS, 1)) & np.uint8(1)
            words[full] = np.packbits(planes, axis=3, bitorder="little").reshape(len(full), -1).view(np.uint64)
        odd = [np.bincount((s >> np.uint64(54)).astype(np.int64) % (64 * PARITY), minlength=64 * PARITY) & 1 for s in sets]
        parity = np.packbits(np.array(odd, np.uint8).reshape(len(sets), 64 * PARITY), axis=1, bitorder="little").view(np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(flat)), pa.array([len(s) for s in sets], pa.int64())]
            + [pa.array(words[:, j].view(np.int64)) for j in range(LONGS)]
            + [pa.array(parity[:, j].view(np.int64)) for j in range(PARITY)],
            names=["id", "shingles", "n"] + WORDS)


def signatures(docs: DataFrame, k: int = 5) -> DataFrame:
    """One row per row of ``docs``: set size, 128-bit digest of the set, band keys, hash of the text."""
    cols = "doc_id long, n_shingles long, digest binary, bands array<long>, th long"
    return (docs.select(F.col("doc_id").cast("long"), F.encode("text", "UTF-8").alias("t"), F.xxhash64("text").alias("th"))
            .mapInArrow(lambda it: _signature_batches(it, k), cols))


def mismatches(left: str, right: str) -> Column:
    """Number of the 512 positions whose 4-bit values differ.  A word holds one bit of 64 positions, so
    64 positions cost four XORs and one bit count."""
    total = F.lit(0)
    for g in range(0, LONGS, BITS):
        differ = [F.col(f"{left}.w{j}").bitwiseXOR(F.col(f"{right}.w{j}")) for j in range(g, g + BITS)]
        total = total + F.bit_count(reduce(Column.bitwiseOR, differ))
    return total


def similarity(mismatch: Column) -> Column:
    """Resemblance estimate, corrected for chance agreement of BITS-bit values."""
    chance = 2.0 ** -BITS
    return ((1 - mismatch / F.lit(float(HASHES))) - chance) / (1 - chance)


def max_mismatches(threshold: float) -> int:
    chance = 2.0 ** -BITS
    return int(HASHES * (1 - (max(threshold - MARGIN, 0.0) * (1 - chance) + chance)))


def within(left: str, right: str, percent: int) -> Column:
    """False only for pairs that cannot reach ``percent``, whatever the estimate says.

    A bit of the parity bitmap tells whether an odd number of the set's shingles fall on it, so bits that
    differ number at most the shingles that only one set has; and similarity is at least ``percent``
    exactly if these number at most (100 - percent) / (100 + percent) of both sizes together.
    """
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"{left}.p{j}").bitwiseXOR(F.col(f"{right}.p{j}"))) for j in range(PARITY)])
    return (100 + percent) * apart <= (100 - percent) * (F.col(f"{left}.n") + F.col(f"{right}.n"))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union on the full sets."""
    sa = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(sa, "a").join(sb, "b").select(
        "a", "b", F.size(F.array_intersect("sa", "sb")).cast("long").alias("i"),
        (F.size("sa") + F.size("sb")).cast("long").alias("n"))
    return both.where(100 * F.col("i") >= percent * (F.col("n") - F.col("i"))).select("a", "b")


def _split(placed: DataFrame) -> DataFrame:
    """Buckets of ``placed`` (key, rep, c) that hold several components, and the largest one there."""
    return (placed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n")).groupBy("key")
            .agg(F.max(F.struct("n", "c"))["c"].alias("top"), F.count(F.lit(1)).alias("cs")).where("cs > 1").select("key", "top"))


def _with_partner(some: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``some`` (rep) that may reach ``percent`` with another one.

    With shingles ordered by how many of these sets hold them, two sets of that similarity share one of
    their rarest ``n - ceil(percent * n) + 1`` shingles; a set whose rarest are all its own has no
    partner.  Documents that share much repeated text and are otherwise their own go here.
    """
    held = freeze(some.join(sets.select(F.col("id").alias("rep"), "shingles"), "rep")
                  .select("rep", F.expr(f"cast(size(shingles) - ceil(size(shingles) * {percent} / 100.0) + 1 as long)").alias("p"),
                          F.explode("shingles").alias("s")), "held")
    alone = held.groupBy("s").agg(F.count(F.lit(1)).alias("f"), F.min("rep").alias("rep")).where("f = 1").groupBy("rep").agg(
        F.count(F.lit(1)).alias("own"))
    need = held.groupBy("rep").agg(F.first("p").alias("p"))
    return need.join(alone, "rep", "left").where(F.coalesce("own", F.lit(0)) < F.col("p")).select("rep")


def _judged(docs: DataFrame, percent: int, k: int) -> tuple[DataFrame, DataFrame]:
    """Signatures of the rows, and the class of every distinct set: (digest, component, doc_id, th).

    A class goes by a number of its own, not by a doc_id, which may be missing or shared by unlike
    texts.  ``doc_id`` is the smallest of the component (null if it has none); that id and ``th``
    tell the one text of the component that stays.
    """
    tidy_driver(docs.sparkSession)
    sig = freeze(signatures(docs.select("doc_id", "text"), k), "sig")
    named = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "th"))).alias("named")
    classes = freeze(sig.where("digest is not null").groupBy("digest").agg(
        named, F.min("th").alias("any"), F.first("bands").alias("bands"))
        .select("digest", "bands", F.col("named.doc_id").alias("doc_id"), F.coalesce("named.th", "any").alias("th"))
        .withColumn("rep", F.monotonically_increasing_id()), "classes")

    # A bucket is led by its members of least hash, so the buckets of a large group of near copies mostly
    # have one leader; a member asks its leaders in rounds, the one of most of its buckets first.
    keyed = classes.select("rep", F.explode("bands").alias("key"))
    least = lambda s: F.min(F.struct(F.xxhash64("rep", F.lit(s)), "rep"))["rep"]            # noqa: E731
    heads = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), least(0).alias("head"), least(1).alias("second"))
             .where("n > 1").drop("n"))
    members = freeze(keyed.join(heads, "key"), "members")
    asked = F.sort_array(F.collect_list(F.struct((-F.col("c")).alias("c"), F.xxhash64("head").alias("h"), "head")))
    leaders = freeze(members.where("rep != head").groupBy("rep", "head").agg(F.count(F.lit(1)).alias("c"))
                     .groupBy("rep").agg(asked.alias("l")).select(F.col("rep").alias("a"), F.col("l.head").alias("heads")), "leaders")
    rounds = [leaders.select("a", F.slice("heads", 1, 1).alias("heads")),
              leaders.select("a", F.slice("heads", 2, BANDS).alias("heads")).where(F.size("heads") > 0),
              members.where("rep != second").groupBy(F.col("rep").alias("a")).agg(F.collect_set("second").alias("heads"))]

    ids = freeze(classes.join(members.select("rep").distinct(), "rep", "left_semi").select(
        F.col("rep").alias("id"), F.col("doc_id").alias("of_doc"), F.col("th").alias("of_th")), "ids")
    sets = freeze(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
                  .join(small(ids), F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("th") == F.col("of_th")))
                  .select("id", F.encode("text", "UTF-8").alias("t"))
                  .mapInArrow(lambda it: _set_batches(it, k), "id long, shingles array<long>, n long, " + ", ".join(f"{w} long" for w in WORDS)), "sets")
    if sets.count() > ids.count():                             # repeated rows of one id (or of none) and text
        sets = freeze(sets.dropDuplicates(["id"]), "sets-once")
    reps = sets.select(F.col("id").alias("rep"), F.struct("n", *WORDS).alias("w"))

    limit = max_mismatches(percent / 100)
    may = lambda x, y: (mismatches(x, y) <= limit) & within(x, y, percent)                   # noqa: E731
    # (a, heads): one row per asking set meets its words, and only then one per leader it asks.
    likely = lambda asks: (asks.join(reps.select(F.col("rep").alias("a"), F.col("w").alias("x")), "a")      # noqa: E731
                           .select("a", "x", F.explode("heads").alias("b"))
                           .join(reps.select(F.col("rep").alias("b"), F.col("w").alias("y")), "b")
                           .where(may("x", "y")).select("a", "b"))
    links = None
    for i, asks in enumerate(rounds):                          # who is confirmed by a leader asks no more
        tidy_driver(docs.sparkSession)
        still = asks if links is None else asks.join(links.select("a").distinct(), "a", "left_anti")
        tested = freeze(likely(still), f"tested{i}")
        found = freeze(_confirm(tested, sets, percent), f"links{i}")
        links = found if links is None else links.unionByName(found)
    first = freeze(connected_components(links), "first")

    placed = (members.select("key", "rep").join(first, F.col("rep") == F.col("node"), "left")
              .select("key", "rep", F.coalesce("component", "rep").alias("c")))
    mixed = freeze(placed.join(_split(placed), "key").drop("top"), "mixed")
    tidy_driver(docs.sparkSession)
    placed = mixed.join(_with_partner(mixed.select("rep").distinct(), sets, percent), "rep")
    rooms = freeze(placed.join(_split(placed), "key"), "rooms")
    # Once more, who is not in a bucket's largest component asks two members of that.
    picks = (rooms.where("c = top").groupBy("key").agg(least(2).alias("p"), least(3).alias("q"))
             .select("key", F.explode(F.array("p", "q")).alias("b")))
    asks = rooms.where("c != top").join(picks, "key").groupBy(F.col("rep").alias("a")).agg(F.collect_set("b").alias("heads"))
    late = freeze(_confirm(freeze(likely(asks), "tested-late"), sets, percent), "late")
    first = freeze(connected_components(first.where("node != component").select(
        F.col("node").alias("a"), F.col("component").alias("b")).unionByName(late)), "second")
    placed = (rooms.select("key", "rep").join(first, F.col("rep") == F.col("node"), "left")
              .select("key", "rep", F.coalesce("component", "rep").alias("c")))
    apart = freeze(placed.join(_split(placed), "key").join(reps, "rep").join(classes.select("rep", "bands"), "rep")
                   .select("key", "rep", "c", "top", "bands", "w"), "apart")
    tidy_driver(docs.sparkSession)
    x, y = apart.where("c != top").alias("x"), apart.alias("y")
    same = (F.col("x.key") == F.col("y.key")) & (F.col("x.c") != F.col("y.c")) & (
        (F.col("y.c") == F.col("y.top")) | (F.col("x.rep") < F.col("y.rep")))
    once = F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.key")     # of all buckets they share
    rest = (x.join(y, same & may("x.w", "y.w") & once)
            .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct())
    more = freeze(_confirm(rest, sets, percent), "more")
    final = connected_components(first.where("node != component").select(F.col("node").alias("a"),
                                                                       F.col("component").alias("b")).union(more))
    placed = classes.join(final, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("component"), "doc_id", "th")
    first = F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "th"))),
                       F.min(F.struct("doc_id", "th")))
    linked = freeze(placed, "placed")
    heads = freeze(linked.groupBy("component").agg(first.alias("head")), "heads")
    return sig, (linked.select("digest", "component").join(small(heads), "component")
                 .select("digest", "component", F.col("head.doc_id").alias("doc_id"), F.col("head.th").alias("th")))


def near_duplicates(docs: DataFrame, percent: int = 85, k: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``.

    Links: ``100 * |A ∩ B| >= percent * |A ∪ B|`` on distinct k-word shingle sets.  Null or
    word-free texts have an empty set and no link.  Repeated rows and equal sets share a class
    whatever their number.  A row without doc_id takes part in its class but never names it; it
    is kept only if its class has no id at all.  Other columns of ``docs`` are ignored.
    """
    sig, classes = _judged(docs, percent, k)
    named = classes.select("digest", F.col("doc_id").alias("component_id"))
    own = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (sig.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
            .select("doc_id", "n_shingles", own.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame, percent: int = 80, k: int = 5) -> DataFrame:
    """One row of each near-duplicate class, all columns.

    It has the smallest doc_id of the class (any of its rows, if none has one), and of that id the
    text with the least hash.  Word-free texts are in no class: all rows without an id stay, and of
    repeated rows (doc_id and text) one.
    """
    sig, classes = _judged(docs, percent, k)
    # The texts that stay, by id and hash of the text: never a text because of another one's id.
    stay = classes.select("component", "doc_id", "th").distinct().select(
        F.col("doc_id").alias("__stay_id"), F.col("th").alias("__stay_th"))
    rows = docs.withColumn("__th", F.xxhash64("text"))
    worded = F.coalesce(F.regexp_like("text", F.lit(WORD)), F.lit(False))
    kept = rows.where(worded).join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col("__stay_id")) & (
        F.col("__th") == F.col("__stay_th")), "left_semi").withColumn("__n", F.lit(0).cast("long"))
    bare = rows.where(~worded).withColumn("__n", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
                                          .otherwise(F.when(F.col("text").isNull(), F.lit(-1)).otherwise(F.lit(0))).cast("long"))
    return kept.union(bare).dropDuplicates(["doc_id", "__th", "__n"]).select(*docs.columns)
