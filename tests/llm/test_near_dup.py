import random
import re
from collections import Counter

import pytest

from logroll.llm import near_dup
from logroll.llm.common import prepare, tidy_driver, trim_jvm
from tests.llm.helpers import AWKWARD, docs_frame, sentence, words


def brute_set(text, k=5):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not ws:
        return frozenset()
    k = min(k, len(ws))
    return frozenset(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))


def brute(rows, percent=85):
    sets = [brute_set(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                inter = len(sets[i] & sets[j])
                if 100 * inter >= percent * (len(sets[i]) + len(sets[j]) - inter):
                    comp[root(i)] = root(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root(i)] = min(ids.get(root(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = d if not sets[i] else ids.get(root(i))
        out.append((d, len(sets[i]), c, d == c))
    return Counter(out)


@pytest.fixture(scope="module")
def corpus():
    rows = list(AWKWARD)
    base = words(120, 1)
    nid = 100
    for copies in range(40):                                   # a group of near copies, one or two words changed
        w = list(base)
        for e in range(copies % 3):
            w[(copies * 7 + e * 31) % len(w)] = f"edit{copies}_{e}"
        rows.append((nid, " ".join(w)))
        nid += 1
    rows += [(nid + i, sentence(60, 5)) for i in range(30)]    # equal texts
    rows += [(500 + i, sentence(30 + i, 100 + i)) for i in range(25)]
    shared = words(120, 9)                                     # alike, but each with 30 words of its own: no links
    rows += [(600 + i, " ".join(shared + words(30, 300 + i, 10**9))) for i in range(60)]
    rng = random.Random(4)
    for i in range(90):                                        # a wide group: most pairs are unlikely, chains link them
        w = words(100, 11)
        for _ in range(i % 9):
            w[rng.randrange(100)] = f"other{rng.randrange(10**9)}"
        rows.append((700 + i, " ".join(w)))
    rows.append((900, sentence(30000, 77)))                    # a very long text and its near copy
    rows.append((901, sentence(30000, 77) + " tail"))
    rows.append((901, sentence(30000, 77) + " tail"))          # a repeated row
    return rows


def test_matches_brute_force(spark, corpus):
    prepare(spark)
    got = near_dup.near_duplicates(docs_frame(spark, corpus).repartition(3)).collect()
    assert Counter(tuple(r) for r in got) == brute(corpus)


def test_empty_table(spark):
    prepare(spark)
    assert near_dup.near_duplicates(docs_frame(spark, [])).collect() == []


def test_keep_one_keeps_columns_and_one_of_each_group(spark, corpus):
    prepare(spark)
    df = docs_frame(spark, corpus)
    out = near_dup.keep_one(df, percent=85)
    assert out.columns == df.columns
    kept = [r["doc_id"] for r in out.collect()]
    want = {d for (d, _, c, k) in brute(corpus) if k}
    assert sorted(x for x in kept if x is not None) == sorted(want)


def test_estimate_is_close_to_the_resemblance():
    import numpy as np
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[400:2400])
    m = near_dup.minima([a, b], 512, 77)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((m[0] == m[1]).mean() - true) < 0.08
    assert near_dup.max_mismatches(0.85) > near_dup.HASHES * 0.15


def test_rows_without_id_and_shared_ids_are_judged_by_text(spark):
    prepare(spark)
    near = lambda seed: sentence(200, seed) + " tail"
    rows = [(1, sentence(200, 1)), (None, sentence(200, 1)), (2, sentence(200, 2)), (None, near(2)),
            (None, sentence(200, 3)), (None, near(3)), (None, sentence(200, 4)), (None, sentence(200, 4)),
            (7, sentence(200, 5)), (7, sentence(200, 6)), (8, near(5)), (9, near(6)), (7, sentence(200, 6)),
            (None, ""), (None, None), (None, " "), (10, ""), (10, "")]
    rows += [(None, sentence(60, 50 + i)) for i in range(5)]
    df = docs_frame(spark, rows).repartition(3)
    assert Counter(tuple(r) for r in near_dup.near_duplicates(df).collect()) == brute(rows)
    kept = Counter((r["doc_id"], r["text"]) for r in near_dup.keep_one(df).collect())
    sure = [rows[i] for i in (0, 2, 6, 8, 9, 13, 14, 15, 16)] + rows[18:]
    either = [k for k in kept if k in (rows[4], rows[5])]
    assert len(either) == 1 and kept == Counter(sure + either)


def test_keep_one_with_clashing_columns(spark):
    prepare(spark)
    text = " ".join(words(40, 3))
    df = docs_frame(spark, [(1, text), (2, text), (3, " ".join(words(40, 4)))])
    df = df.selectExpr("*", "'a' as stay_id", "'b' as stay_th", "'c' as th", "'d' as component")
    got = near_dup.keep_one(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"], r["stay_id"], r["stay_th"], r["component"]) for r in got.collect()) == [
        (1, "a", "b", "d"), (3, "a", "b", "d")]


def test_parity_bound_loses_no_pair_and_drops_near_misses(spark):
    """Near copies of one text that are all a little below the threshold do not come out of the pair tests."""
    from pyspark.sql import functions as F
    prepare(spark)
    base, texts = words(300, 900), []
    for i in range(12):
        copy, rng = list(base), random.Random(i)
        for j in range(5 if i < 8 else 1):
            copy[rng.randrange(300)] = f"own{i}x{j}"
        texts.append(" ".join(copy))
    raw = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "id long, t binary")
    shape = "id long, shingles array<long>, n long, " + ", ".join(f"{w} long" for w in near_dup.WORDS)
    sets = raw.mapInArrow(lambda it: near_dup._set_batches(it, 5), shape)
    x, y = sets.alias("x"), sets.alias("y")
    got = {tuple(r) for r in x.join(y, (F.col("x.id") < F.col("y.id")) & near_dup.within("x", "y", 85)).select("x.id", "y.id").collect()}
    full = [brute_set(t) for t in texts]
    near = {(i, j) for i in range(12) for j in range(i + 1, 12)
            if 100 * len(full[i] & full[j]) >= 85 * len(full[i] | full[j])}
    assert near and near <= got and len(got - near) <= 3
    likely = {(i, j) for i in range(12) for j in range(i + 1, 12)
              if len(full[i] & full[j]) / len(full[i] | full[j]) >= 0.79}
    assert len(likely) > len(got) + 5                   # the estimate alone lets those through


def _jvm_mb(pid):
    rollup = open(f"/proc/{pid}/smaps_rollup").read()
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", rollup))) / 1024


def test_the_driver_hands_back_what_its_plans_took_outside_the_heap(spark):
    from pyspark.sql import functions as F
    pid = spark._jvm.java.lang.ProcessHandle.current().pid()
    for k in range(12):             # wide plans, each compiled anew
        wide = spark.range(2000).select((F.col("id") * k).alias("a"), *[(F.col("id") + i * k).alias(f"c{i}") for i in range(30)])
        sums = wide.groupBy((F.col("a") % 7).alias("g")).agg(*[F.sum(f"c{i}") for i in range(30)])
        sums.join(wide, F.col("g") == F.col("a")).count()
    spark._jvm.System.gc()
    before, after = _jvm_mb(pid), (tidy_driver(spark), _jvm_mb(pid))[1]
    said = trim_jvm(spark)
    assert said is None or after < before - 20      # None: a JVM that cannot trim
