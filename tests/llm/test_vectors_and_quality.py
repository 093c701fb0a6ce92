import math

import numpy as np
import pytest

from logroll.llm import ann, quality, topk
from logroll.llm.common import prepare
from tests.llm.helpers import docs_frame, sentence


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 12)).astype(np.float32)
    x[100:140] = x[100]                                        # copies
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(600, None), (601, [1.0, None] * 6), (602, [float("nan")] * 12), (603, [float("inf")] * 12),
             (604, [0.0] * 12), (605, [0.5] * 5), (606, []), (None, [1.0] * 12), (607, [3.0] * 12), (607, [3.0] * 12)]
    return rows


def usable(rows):
    out = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            out[i] = np.array(list(v) + [0.0] * (12 - len(v)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0, "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, score double, part string")


def test_exact_top_k(spark, vectors):
    prepare(spark)
    v = {i: np.floor(256 * x).astype(np.int64) for i, x in usable(vectors).items()}
    want = set()
    for q in v:
        if q % 50 == 0:
            best = sorted(((-int(v[q] @ v[c]), c) for c in v if c != q))[:5]
            want |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(best)}
    got = topk.top_inner_products(frame(spark, vectors).repartition(4)).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk.top_inner_products(frame(spark, vectors[:0])).collect() == []


def test_top_k_blocks_prune_without_loss(monkeypatch):
    rng = np.random.default_rng(1)
    c = np.floor(rng.standard_normal((3000, 64)) * 256 * rng.uniform(0.1, 2, 3000)[:, None])
    ids = np.arange(3000)
    basis = np.linalg.eigh(c.T @ c)[1][:, ::-1]
    q = c[:20]
    low = topk._floor(ids[:500], c[:500], ids[:20], q, 5)
    a, b, s = topk.search_block(ids, c, ids[:20], q, low, basis, 5)
    full = c @ q.T
    for i in range(20):
        best = sorted((-full[j, i], j) for j in range(3000) if j != i)[:5]
        assert sorted(zip(-s[a == i], b[a == i])) == best


def test_forest_recall_and_scores(spark, vectors):
    prepare(spark)
    v = {i: x for i, x in usable(vectors).items() if x.any()}
    got = ann.nearest(frame(spark, vectors).repartition(3), k=10, every=20).collect()
    ids = sorted(v)
    hit = total = 0
    for q in ids:
        if q % 20:
            continue
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and q not in [m[1] for m in mine]
        for _, c, s in mine:
            assert s == ann.distances(v[c][None], v[q])[0]
        best = sorted((ann.distances(v[c][None], v[q])[0], c) for c in ids if c != q)[:10]
        hit += len({c for _, c in best} & {m[1] for m in mine})
        total += 10
        assert sorted((s, c) for _, c, s in mine) == [(s, c) for _, c, s in mine]
    assert hit / total >= 0.9
    assert ann.nearest(frame(spark, vectors[:0])).collect() == []


def labelled(n, seed):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = sentence(60, seed + i)
        rows.append((i, text.upper().replace(" ", "!! ") if bad else text, "en", f"src{i % 7}"))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_quality_held_out_accuracy_and_edges(spark):
    prepare(spark)
    rows, labels = labelled(600, 1000)
    extra = [(None, None, None, None), (5000, "", "en", None), (5001, None, None, "src1"), (5002, sentence(20000, 1), "en", "src1"),
             (10, rows[10][1], "en", "src3")]
    df = docs_frame(spark, rows + extra)
    told = spark.createDataFrame([x for x in labels if x[0] < 400] + [(9999, 1, 0), (3, None, 0)],
                                 "doc_id long, quality int, toxic int")
    got = quality.classify(df, told).collect()
    assert len(got) == len(rows) + len(extra)
    score = {r["doc_id"]: r["accepted"] for r in got}
    truth = {i: q for i, q, _ in labels if i >= 400}
    assert sum(score[i] == bool(q) for i, q in truth.items()) / len(truth) >= 0.97
    none = quality.classify(df, told.limit(0)).collect()
    assert all(r["accepted"] for r in none)
    assert quality.classify(docs_frame(spark, []), told).collect() == []


def test_weak_view_does_not_harm():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 600)
    strong = np.c_[y * 2.0 - 1 + rng.normal(0, 0.3, 600), rng.normal(size=600)]
    weak = rng.normal(size=(600, 3))
    held = np.arange(600) % 4 == 0
    known = y.copy()
    known[300:450] = -1
    m = quality.co_train(strong, weak, known, held & (known >= 0))
    assert ((m.score(strong[450:], weak[450:]) > 0.5) == (y[450:] == 1)).mean() > 0.95


def test_forest_recall_beside_a_vector_with_a_third_of_the_rows(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((60, 64)) * 4
    x = (centres[np.arange(4500) % 60] + rng.standard_normal((4500, 64))).astype(np.float32)
    ids = np.arange(4500) * 2 + 1                                        # odd: asked only if made even below
    near = np.flatnonzero(np.arange(4500) % 60 == 7)[1:61]               # 60 queries in the copied vector's cluster
    ids[near] = 20 * np.arange(1, 61)
    hot = [(100_001 + 2 * i, x[7]) for i in range(2250)]
    rows = [(int(i), v.tolist()) for i, v in [*zip(ids, x), *hot]]
    prepare(spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = {}
    for r in ann.nearest(df, k=10, every=20).collect():
        got.setdefault(r["query_id"], []).append(r["score"])
    every = np.array([v for _, v in rows], np.float32).astype(float)
    recall = []
    for i in near:
        d = np.sort(np.sqrt(((every - x[i].astype(float)) ** 2).sum(axis=1)))[1:11]
        recall.append((np.array(got[int(ids[i])]) <= d[-1] + 1e-9).mean())
    assert len(recall) == 60 and np.mean(recall) >= 0.9 and min(recall) >= 0.5


def test_unlabelled_rows_teach_in_full_and_sums_match(spark):
    prepare(spark)
    rows, labels = labelled(500, 4000)
    # A source that only unlabelled documents have, all of them bad: only the exchange can tell.
    fresh = [(1000 + i, sentence(60, 9000 + i).upper().replace(" ", "!! "), "en", "onlyhere") for i in range(300)]
    df = docs_frame(spark, rows + fresh).repartition(5)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.fit(df, told)
    # Uncalibrated: on held-out rows this view tells nothing, so calibration rightly flattens it.
    new, old = (model.views[1].raw(np.array([quality.meta_features("en", s, 400)]))[0] for s in ("onlyhere", "src1"))
    assert new < old - 1

    every = [(r["at"], r["val"]) for r in df.select("doc_id", *quality._inputs(df)).mapInArrow(
        quality._feature_rows, "doc_id long, at binary, val binary").orderBy("doc_id").collect()]
    x = quality._dense([bytes(a) for a, _ in every], [bytes(v) for _, v in every])
    y = np.array([q for _, q, _ in labels] + [-1] * len(fresh))
    held = (np.arange(len(y)) % 5 == 1) & (y >= 0)
    stored = spark.createDataFrame(every[500:], "at binary, val binary").repartition(7)
    near = quality.co_train(*x, y, held)
    far = quality.co_train(*x, y, held, lambda work: quality._summed(stored, work))
    assert all(np.allclose(a.w, b.w, atol=1e-4) for a, b in zip(near.views, far.views))
    assert np.array_equal(near.score(*x) >= 0.5, far.score(*x) >= 0.5)
    assert quality._summed(stored.limit(0), quality._moments) is None


def test_exchange_with_many_unlabelled_rows_settles():
    rng = np.random.default_rng(5)
    y = (rng.random(6000) < 0.87).astype(int)
    strong = np.c_[y[:, None] * 4.0 + rng.normal(0, 0.4, (6000, 8)), rng.normal(size=(6000, 30))]
    weak = np.c_[rng.integers(0, 4, 6000) == 2, rng.normal(size=6000) + 0.3 * y]
    known = np.where(np.arange(6000) < 800, y, -1)
    model = quality.co_train(strong, weak, known, (np.arange(6000) % 4 == 0) & (known >= 0))
    assert ((model.score(strong, weak) >= 0.5) == (y == 1))[800:].mean() > 0.995
    assert all(np.isfinite(v.w).all() and np.abs(v.w).max() < 100 for v in model.views)


def test_hashing_hands_over_no_more_rows_at_once_than_it_got():
    """A batch of vectors comes back as one batch per tree, not as one of all trees."""
    import pyarrow as pa
    rng = np.random.default_rng(5)
    x = rng.standard_normal((50, 12))
    forest = ann.Forest(12, np.zeros(12))
    batch = pa.RecordBatch.from_pydict({"vec_id": pa.array(range(50), pa.int64()), "v": pa.array(x.tolist())})
    out = list(ann._hashed([batch], forest, 12, 3))
    assert [b.num_rows for b in out] == [50] * ann.TREES
    want = forest.strings(x)
    for tree, b in enumerate(out):
        assert b.column("s").to_pylist() == want[:, tree].tolist() and set(b.column("tree").to_pylist()) == {tree}
        assert b.column("lead").to_pylist() == (want[:, tree] >> np.uint64(ann.BITS - 3)).tolist()
        assert np.array(b.column("v").to_pylist()).tobytes() == x.tobytes()
    bare = list(ann._hashed([batch], forest, 12, 0, vectors=False))
    assert bare[0].schema.names == ["vec_id", "tree", "s", "lead"] and set(bare[0].column("lead").to_pylist()) == {0}
