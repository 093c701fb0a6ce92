"""Merkle manifest, token store and filter audit against brute force."""

import hashlib
import random
import struct
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from logroll.llm import filter_audit, manifest, token_store
from logroll.llm.common import prepare
from tests.llm.helpers import AWKWARD, docs_frame, sentence

PATH = public_tokenizers.path("byte_bpe_50k.json")
LANGS = ["en", None, "de", "", "ß"]


def corpus():
    rows = [(i, sentence(5 + i % 40, i), LANGS[i % 3], f"s{i % 2}") for i in range(40)]
    rows += [(d, t, "de", None) for d, t in AWKWARD] + [(7, "other text of id 7", "en", "s1"), (99, "alone", "ß", None)]
    rows += [(50, "twice", "", "x")] * 2 + [(None, "no id", "en", None)] * 2 + [(2**60, sentence(20000, 3), "en", "x")]
    return rows


# -- manifest ----------------------------------------------------------------------------------------

def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves, k):
    """(root, [siblings' digests by level, with the slot] per leaf)."""
    level, paths = [(d, [i]) for i, d in enumerate(leaves)], [[] for _ in leaves]
    while len(level) > 1:
        above = []
        for at in range(0, len(level), k):
            run = level[at:at + k]
            for s, (_, members) in enumerate(run):
                for i in members:
                    paths[i].append((s, [d for j, (d, _) in enumerate(run) if j != s]))
            above.append((h("".join(d for d, _ in run)), [i for _, m in run for i in m]))
        level = above
    return level[0][0], paths


def brute_manifest(rows, k):
    leaf = lambda r, more=0: h("".join(map(enc, (r[0], r[3], r[2], None if r[1] is None else len(r[1]) + more, r[1]))))
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs]
    trees = [tree([leaf(r) for r in g], k) for g in groups]
    root, tops = tree([t[0] for t in trees], k)
    out = []
    for g, (sub, paths), top in zip(groups, trees, tops):
        for r, path in zip(g, paths):
            bad = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf(r, bad)
            for s, sibs in path + top:
                node = h("".join(sibs[:s] + [node] + sibs[s:]))
            proof = h("".join(d for _, sibs in path + top for d in sibs))
            out.append((r[0], leaf(r), sub, root, proof, node, node == root))
    return Counter(out)


@pytest.mark.parametrize("fanout", [2, 3])
def test_manifest(spark, fanout):
    prepare(spark)
    got = Counter(tuple(r) for r in manifest.audit_rows(docs_frame(spark, corpus()).repartition(3), fanout).collect())
    assert got == brute_manifest(corpus(), fanout)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_one_row_and_of_none(spark):
    prepare(spark)
    (r,) = manifest.audit_rows(docs_frame(spark, [(1, None, None, None)])).collect()
    assert r["leaf"] == r["subroot"] == r["root"] == h("1:1----") and r["proof_sha256"] == h("") and r["verified"]
    assert manifest.audit_rows(docs_frame(spark, [])).collect() == []


# -- token store -------------------------------------------------------------------------------------

def test_store_holds_the_tokenizers_ids(spark, scratch):
    from tokenizers import Tokenizer
    prepare(spark)
    tk = Tokenizer.from_file(PATH)
    rows = corpus() + [(3000, "it's  fine\n\n here <|endoftext|> 日本 \x1c x   "), (3001, "we'll see"), (3002, "a  b\xa0c")]
    docs = docs_frame(spark, rows).repartition(3)
    store = token_store.TokenStore.write(docs, scratch("store") + "/s", PATH, shard_ids=300)
    want, texts = Counter(), {}
    for r in rows:
        ids = [*tk.encode(r[1] or "", add_special_tokens=False).ids, 0]
        want[(r[0], len(ids), struct.pack(f"<{len(ids)}I", *ids))] += 1
        texts.setdefault(r[0], []).append(ids)
    read = store.read(store.keys).collect()
    assert Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in read) == want
    at = 0
    for r in sorted(read, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(read, key=lambda r: r["start"])] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    assert store.shards().count() > 3

    again = token_store.TokenStore.open(spark, store.path)
    assert again.get(3001) == texts[3001][0] and again.get(None, 1) in texts[None] and again.get(2**60) == texts[2**60][0]
    assert again.get(3001, 1) is None and again.get(-5) is None
    asked = spark.createDataFrame([(3001, 0), (3001, 1), (123456, 0), (None, 0)], "doc_id long, nth long")
    assert {(r["doc_id"], r["nth"]) for r in again.locate(asked).collect()} == {(3001, 0), (None, 0)}


def test_store_of_no_documents(spark, scratch):
    prepare(spark)
    assert token_store.stored_ids(docs_frame(spark, []), scratch("store") + "/s", PATH).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_index_is_minimal_and_refuses_strangers(n):
    rng = np.random.default_rng(n)
    keys, others = rng.integers(0, 2**64, (n, 2), np.uint64), rng.integers(0, 2**64, (4000, 2), np.uint64)
    rec = np.zeros(n, token_store.RECORD)
    rec["fp"], rec["offset"] = token_store.fingerprints(keys), np.arange(n)
    data = token_store.build_index(keys, rec)
    index = token_store.Index(data)
    found, got = index.find(keys)
    assert found.all() and (got["offset"] == np.arange(n)).all() and len(index.records) == n
    assert index.find(others)[0].sum() <= 1
    assert len(data) <= 24 + n * (token_store.RECORD.itemsize + 1.5) + 200


# -- filter audit ------------------------------------------------------------------------------------

def brute_audit(rows, labels):
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    docs = []
    for d, t, lang in rows:
        t = t or ""
        ws = t.encode().split()
        fails = {c for c, bad in (("A", len(ws) < 200), ("B", 100 * len(set(ws)) < 50 * len(ws)),
                                  ("C", 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t)),
                                  ("D", any(c in "#$%&*|" for c in t)), ("E", d is not None and d > first[t])) if bad}
        mine = [x for x in labels if x[0] == d and d is not None]
        docs.append((lang or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = {}
    for part in {x[0] for x in docs}:
        mine, sums = [x for x in docs if x[0] == part], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for i, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                sums[f] += len(gone)
                out[part, order, i + 1] = [len(left), len(gone), sum(f in x[1] for x in mine) - len(gone),
                                           sum(x[1] == {f} for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone), f]
        for k, v in out.items():
            if k[0] == part:
                v[-1] = sums[v[-1]]
    return {k: tuple(v) for k, v in out.items()}


def test_audit(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(filter_audit, "RANGE_BITS", 3)                       # many ranges
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["Word", "x", "y%"]) if i % 3 else f"w{rng.randrange(10**6)}" for _ in range(rng.choice([3, 250]))),
             LANGS[i % 4]) for i in range(60)]
    rows += [(100 + i, rows[i][1], "en") for i in range(0, 60, 4)] + [(d, t, None) for d, t in AWKWARD]
    rows += [(None, rows[0][1], "de"), (5, rows[0][1], "de"), (5, rows[0][1], "de")]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 110, 3)] + [(9, None, 1), (9, 1, None), (None, 1, 1)]
    docs = docs_frame(spark, [(d, t, lang, None) for d, t, lang in rows]).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x")).withColumn("of", F.lit(1))
    got = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"],
                                                       r["toxic_lost"], r["shapley"])
           for r in filter_audit.filter_interactions(docs, marks).collect()}
    assert got == brute_audit(rows, labels)


def test_audit_of_empty_tables(spark):
    prepare(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_interactions(docs_frame(spark, []), none).collect() == []
    assert {r["good_lost"] for r in filter_audit.filter_interactions(docs_frame(spark, [(1, "x", None, None)]), none).collect()} == {0}


def test_gallop_and_merge():
    rng = np.random.default_rng(1)
    for na, nb in ((0, 5), (5, 0), (3, 400), (400, 3), (100, 120), (1, 1)):
        a, b = (np.sort(rng.choice(500, n, replace=False)).astype(np.int64) for n in (na, nb))
        assert (filter_audit.gallop(a, b) == np.isin(a, b)).all()
        rest = a[~np.isin(a, b)]
        assert (filter_audit.merge(rest, b) == np.union1d(a, b)).all()
