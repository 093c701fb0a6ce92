"""Merkle manifest of a dataset: hash trees over its rows, with proofs for every row.

Rows of one group (here: of one language) are the leaves of a tree, in the order of their ids; the
groups' roots are the leaves of a last tree, whose root names the dataset.  Levels are built by
sibling-shift self-joins: every node meets the nodes of its run by an equijoin on computed indices
(index XOR 1 for runs of two, slot offsets for longer runs), and the nodes at slot zero, which then
hold their whole run, emit the parents.  A level is a written table, so a lost executor costs one
level.  Proofs go down the same levels: a node's proof is its siblings followed by its parent's.

Leaf positions come from a range partition and prefix sums of partition totals; nothing but one
count, the number of levels and the root reaches the driver.  No join key is shared by more rows
than a run has: a group with a third of all rows is spread like any other.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from logroll.llm.common import freeze, small
from logroll.llm.sharding import prefix_sums

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Proof joins are written out after this many levels, so that no plan grows with the tree.
LEVELS_PER_TABLE = 6


def encoded(value: Column) -> Column:
    """``-`` for null, else byte count, ``:``, value: no two lists of values share an encoding."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(encoded, values)), 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def node_hash(children: Column) -> Column:
    """Digest of the concatenated digests, taken as hex text."""
    return F.unhex(F.sha2(hex_text(children), 256))


def number(rows: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``grp`` (the group's first global position), ``idx`` and ``n`` (position in and
    size of the group), and the groups: (group, grp, n)."""
    placed = freeze(prefix_sums(rows.withColumn("one", F.lit(1)), [group, *order], "one", f"{name}-rows")
                    .drop("one", "before"), f"{name}-placed")
    groups = freeze(placed.groupBy(group).agg(F.min("row").alias("grp"), F.count(F.lit(1)).alias("n")), f"{name}-groups")
    own = small(groups.withColumnRenamed(group, "own"))
    numbered = (placed.join(own, placed[group].eqNullSafe(F.col("own"))).drop("own")
                .withColumn("idx", F.col("row") - F.col("grp")).drop("row"))
    return numbered, groups


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` (grp, n, idx, node, ...) with ``sibs``: the digests of the rest of each node's run,
    left to right, concatenated."""
    other = nodes.select(F.col("grp").alias("_g"), F.col("idx").alias("_i"), F.col("node").alias("_s"))
    if fanout == 2:
        shifted = other.withColumn("_i", F.col("_i").bitwiseXOR(F.lit(1).cast("long")))
        return (nodes.join(shifted, (F.col("grp") == F.col("_g")) & (F.col("idx") == F.col("_i")), "left")
                .withColumn("sibs", F.coalesce("_s", F.lit(b""))).drop("_g", "_i", "_s"))
    out, slot = nodes, F.col("idx") % fanout
    for off in range(1, fanout):
        met = other.toDF("_g", f"_i{off}", f"_s{off}")
        there = F.col("idx") - slot + (slot + off) % fanout
        out = out.join(met, (F.col("grp") == F.col("_g")) & (there == F.col(f"_i{off}")), "left").drop("_g")
    run = F.array_sort(F.filter(F.array(*[F.struct(F.col(f"_i{o}").alias("i"), F.col(f"_s{o}").alias("s"))
                                          for o in range(1, fanout)]), lambda x: x["s"].isNotNull()))
    drop = [f"{c}{o}" for o in range(1, fanout) for c in ("_i", "_s")]
    return out.withColumn("sibs", F.aggregate(run, F.lit(b""), lambda a, x: F.concat(a, x["s"]))).drop(*drop)


def parents(level: DataFrame, fanout: int) -> DataFrame:
    """Slot-zero nodes of a level emit their run's parent."""
    up = lambda c: F.expr(f"{c} div {fanout}")                                      # noqa: E731
    return level.where((F.col("idx") % fanout == 0) & (F.col("n") > 1)).select(
        "grp", up(f"(n + {fanout - 1})").alias("n"), up("idx").alias("idx"),
        node_hash(F.concat("node", "sibs")).alias("node"))


def climb(nodes: DataFrame, largest: int, fanout: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels below the roots, written, and the roots (grp, height, node).

    The lowest level holds all of ``nodes`` with their other columns, higher ones only nodes of
    groups that have more than one there.
    """
    levels, roots = [], []
    level = freeze(with_siblings(nodes, fanout), f"{name}-0")
    while True:
        roots.append((level.where("n = 1") if not levels else level.where("false"))
                     .select("grp", F.lit(0).alias("height"), "node"))
        levels.append(level)
        if largest <= 1:
            break
        above = parents(level, fanout)
        roots.append(parents(level.where(F.col("n") <= fanout), fanout)
                     .select("grp", F.lit(len(levels)).alias("height"), "node"))
        largest = -(-largest // fanout)
        if largest <= 1:
            break
        level = freeze(with_siblings(above.where("n > 1"), fanout), f"{name}-{len(levels)}")
    return levels, freeze(reduce(DataFrame.unionByName, roots), f"{name}-roots")


def descend(levels: list[DataFrame], roots: DataFrame, fanout: int, name: str) -> DataFrame:
    """The lowest level's rows with ``proof`` and the other columns of ``roots`` (grp, height, proof,
    ...): the siblings from the node to its root, then the root's own proof."""
    carried = [c for c in roots.columns if c != "grp"]
    proved = None
    for at in range(len(levels) - 1, -1, -1):
        ends = F.col("height") == at + 1 if at else F.col("height") <= 1
        above = roots.where(ends).select("grp", F.lit(0).cast("long").alias("idx"), *carried)
        if proved is not None:
            above = above.unionByName(proved.select("grp", "idx", *carried))
        above = above.select(F.col("grp").alias("_g"), F.col("idx").alias("_i"), F.col("proof").alias("_p"),
                             *[c for c in carried if c != "proof"])
        proved = (levels[at].join(above, (F.col("grp") == F.col("_g")) & (F.expr(f"idx div {fanout}") == F.col("_i")))
                  .withColumn("proof", F.concat("sibs", "_p")).drop("_g", "_i", "_p", "sibs"))
        if at and (len(levels) - at) % LEVELS_PER_TABLE == 0:
            proved = freeze(proved, f"{name}-{at}")
    return proved


def folded(node: Column, proof: Column, idx: Column, n: Column, height: Column, fanout: int) -> Column:
    """(h, at): the root that ``node`` (hex text) and the proof's first ``at`` bytes lead to."""
    start = F.struct(node.alias("h"), idx.cast("long").alias("i"), n.cast("long").alias("n"), F.lit(1).alias("at"))

    def step(s, _):
        slot = s["i"] % fanout
        others = F.least(F.lit(fanout).cast("long"), s["n"] - (s["i"] - slot)) - 1
        sibs = hex_text(F.substring(proof, s["at"], (others * 32).cast("int")))
        left = (slot * 64).cast("int")
        joined = F.concat(F.substring(sibs, F.lit(1), left), s["h"], F.substring(sibs, left + 1, F.lit(64 * fanout)))
        return F.struct(F.sha2(joined, 256).alias("h"), F.floor(s["i"] / fanout).cast("long").alias("i"),
                        F.floor((s["n"] + (fanout - 1)) / fanout).cast("long").alias("n"),
                        (s["at"] + others * 32).cast("int").alias("at"))

    steps = F.when(height > 0, F.sequence(F.lit(1), height)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, start, step)


@dataclass
class Manifest:
    """``root`` (hex text, None without rows); ``rows``: the leaves (grp, n, idx, node, and the columns
    carried along), ``levels`` above them, ``groups`` (group, grp, n, pos, height, node): the sub-roots;
    ``top``: the levels over those."""

    root: str | None
    fanout: int
    groups: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]
    n_groups: int
    top_height: int

    def proofs(self) -> DataFrame:
        """Every leaf with ``proof``, ``subroot``, ``pos`` and ``height``."""
        whole = self.groups.select(F.col("grp").alias("sub"), "pos", "height", F.col("node").alias("subroot"))
        above = self.top[0].sparkSession.range(1).select(F.col("id").alias("grp"), F.lit(self.top_height).alias("height"),
                                                         F.lit(b"").alias("proof"))
        subs = descend(self.top, above, self.fanout, "merkle-top").select(F.col("idx").alias("at"), F.col("proof"))
        roots = freeze(whole.join(subs, F.col("pos") == F.col("at"))
                       .select(F.col("sub").alias("grp"), "height", "proof", "pos", "subroot"), "merkle-subs")
        return descend(self.levels, roots, self.fanout, "merkle-proofs")

    def refold(self, node: Column) -> Column:
        """The dataset's root as recomputed from ``node`` (digest) and a row of ``proofs()``."""
        sub = folded(hex_text(node), F.col("proof"), F.col("idx"), F.col("n"), F.col("height"), self.fanout)
        rest = F.expr("substring(proof, _sub.at)")
        top = folded(F.col("_sub.h"), rest, F.col("pos"), F.lit(self.n_groups), F.lit(self.top_height), self.fanout)
        return sub, top

    def verify(self, candidates: Column, proofs: DataFrame, out: str = "folded_root") -> DataFrame:
        """``proofs`` with the recomputed root and ``verified``: whether it is the manifest's."""
        sub, top = self.refold(candidates)
        return (proofs.withColumn("_sub", sub).withColumn(out, top["h"]).drop("_sub")
                .withColumn("verified", F.col(out) == F.lit(self.root)))


def build(rows: DataFrame, group: str, order: list[str], fanout: int = 2) -> Manifest:
    """Manifest of ``rows``: a column ``node`` (leaf digest), ``group`` and ``order`` columns, any others.

    Nulls come first among groups and ids.  Rows that share all of ``order`` are ordered by digest,
    equal ones in any order: they are interchangeable.  No rows: no root.
    """
    if fanout < 2:
        raise ValueError("a run has at least two nodes")
    numbered, groups = number(rows, group, [*order, "node"], "merkle")
    most, m = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    levels, roots = climb(numbered, most or 0, fanout, "merkle-level")
    ranked = prefix_sums(groups.withColumn("one", F.lit(1)), [group], "one", "merkle-order").select(
        group, "grp", "n", F.col("row").alias("pos"))
    groups = freeze(ranked.join(roots.withColumnRenamed("grp", "_g"), F.col("grp") == F.col("_g")).drop("_g"), "merkle-groups-done")
    subs = groups.select(F.lit(0).cast("long").alias("grp"), F.lit(m).cast("long").alias("n"), F.col("pos").alias("idx"), "node")
    top, last = climb(subs, m, fanout, "merkle-top")
    done = last.select("height", hex_text(F.col("node"))).first()
    return Manifest(done[1] if done else None, fanout, groups, levels, top, m, done[0] if done else 0)


def audit_rows(docs: DataFrame, fanout: int = 2) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per row of ``docs``.

    Leaves cover doc_id, source, lang, n_chars and text; a tree per lang (null is a lang), by doc_id.
    Rows whose id's CRC-32 is a multiple of 7 get ``n_chars + 1`` before
    their root is recomputed (a null stays null, so such a row is as good as before; a row without
    doc_id is left alone).  Repeated rows are leaves of their own.  Other columns are
    ignored; an empty table gives no rows.
    """
    c = {f: F.col(f) for f in FIELDS}
    hit = F.coalesce(F.crc32(c["doc_id"].cast("string").cast("binary")) % 7 == 0, F.lit(False)) & c["n_chars"].isNotNull()
    bad = leaf_hash([c["n_chars"].cast("long") + 1 if f == "n_chars" else c[f] for f in FIELDS])
    leaves = freeze(docs.select("doc_id", "lang", leaf_hash([c[f] for f in FIELDS]).alias("node"),
                                F.when(hit, bad).alias("tampered")), "merkle-leaves")
    made = build(leaves, "lang", ["doc_id"], fanout)
    if made.root is None:
        return leaves.sparkSession.createDataFrame([], "doc_id long, leaf string, subroot string, root string, "
                                                       "proof_sha256 string, folded_root string, verified boolean")
    proofs = freeze(made.proofs(), "merkle-proved")
    return made.verify(F.coalesce("tampered", "node"), proofs).select(
        "doc_id", hex_text(F.col("node")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
        F.lit(made.root).alias("root"), F.sha2(hex_text(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root", "verified")
