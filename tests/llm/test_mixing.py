from collections import Counter

import numpy as np

from logroll.llm import mixing
from logroll.llm.common import prepare
from tests.llm.helpers import AWKWARD, docs_frame, sentence


def brute_targets(sizes):
    """sizes: {source or None: words}; iterative resharing."""
    keys = sorted((k for k in sizes if k is not None)) + ([None] if None in sizes else [])
    w = {k: i % 3 + 1 for i, k in enumerate(keys)}
    total, target, stopped = float(sum(sizes.values())), {}, set()
    while True:
        left = total - sum(3.0 * sizes[k] for k in stopped)
        free = sum(w[k] for k in keys if k not in stopped)
        target = {k: 3.0 * sizes[k] if k in stopped else (left * w[k] / free) for k in keys}
        new = {k for k in keys if k not in stopped and target[k] > 3.0 * sizes[k]}
        if not new:
            return target
        stopped |= new


def corpus():
    rows = [(i, sentence(40 + i % 90, i), "en", f"src{i % 5}") for i in range(200)]
    rows += [(300 + i, sentence(30, 300 + i), "en", "tiny") for i in range(3)]
    rows += [(400 + i, sentence(200, 400 + i), "en", None) for i in range(30)]
    rows += [(d, t, None, "odd") for d, t in AWKWARD] + [(500, sentence(50, 1), "en", "src1")] * 3
    rows += [(600, sentence(20000, 6), "en", "src2"), (601, None, None, "void")]
    return rows


def test_targets_and_taken(spark):
    prepare(spark)
    rows = corpus()
    got = mixing.taken(docs_frame(spark, rows).repartition(3)).collect()
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    src = {(d, t): s for d, t, _, s in rows}
    for r, s in ((r, None) for r in got):
        assert 0 <= r["taken"] <= 3 * r["size"]
    df = {}
    for d, t, _, s in rows:
        n = len((t or "").encode().split())
        sizes[s] = sizes.get(s, 0) + n
        df.setdefault((d, n), s)
    for r in got:
        s = df[(r["doc_id"], r["size"])]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
        assert r["source_size"] == sizes[s]
    want = brute_targets(sizes)
    for s in sizes:
        assert abs(want[s] - target[s]) < 1e-6 * max(1.0, want[s])
        assert abs(taken[s] - target[s]) <= 2 * mixing.BLOCK + 0.02 * target[s], s
    assert src


def test_reruns_agree_whatever_the_partitions(spark):
    prepare(spark)
    a = sorted(map(tuple, mixing.taken(docs_frame(spark, corpus())).collect()), key=str)
    b = sorted(map(tuple, mixing.taken(docs_frame(spark, corpus()).repartition(7)).collect()), key=str)
    assert a == b


def test_permutations_are_bijections():
    for n in (1, 2, 3, 17, 64, 1000):
        for seed in (1, 2):
            assert sorted(mixing.permuted(np.arange(n), n, seed)) == list(range(n))


def test_mixed_documents(spark):
    prepare(spark)
    rows = corpus()
    assert max(Counter(r[0] for r in rows).values()) > 1
    df = docs_frame(spark, [*rows, (None, sentence(300, 8), "en", "web"), (None, sentence(500, 9), "en", "web")])
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words, wanted = Counter(), Counter()
    for r in out.collect():
        words[r["doc_id"]] += len(r["text"].encode().split())
        assert r["n_chars"] == len(r["text"])
    for r in mixing.taken(df).collect():
        wanted[r["doc_id"]] += r["taken"]
    assert +words == +wanted                                   # repeated rows and rows without id included


def test_empty_table(spark):
    prepare(spark)
    assert mixing.taken(docs_frame(spark, [])).collect() == []
    assert mixing.mixed_documents(docs_frame(spark, [])).collect() == []
