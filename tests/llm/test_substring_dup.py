import hashlib
from collections import Counter

from logroll.llm import substring_dup
from logroll.llm.common import prepare
from tests.llm.helpers import AWKWARD, docs_frame, sentence

W = 100


def brute(rows):
    """Rows with one doc_id count as one document (the first text of an id judges its windows)."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    first, gone = {}, {}
    for i in order:
        d, raw = rows[i][0], (rows[i][1] or "").encode()
        marks = bytearray(len(raw))
        for p in range(len(raw) - W + 1):
            key = raw[p:p + W]
            at = first.setdefault(key, (d, p))
            if at != (d, p):
                marks[p:p + W] = b"\x01" * W
        gone[i] = marks
    out = []
    for i, (d, t) in enumerate(rows):
        raw, m = (t or "").encode(), gone[i]
        kept = bytes(b for b, g in zip(raw, m) if not g)
        runs = sum(1 for k in range(len(m)) if m[k] and (k == 0 or not m[k - 1]))
        out.append((d, len(raw), sum(m), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def corpus():
    passage = sentence(40, 3)
    rows = list(AWKWARD)
    rows += [(20, sentence(200, 1)), (21, sentence(200, 1)), (22, sentence(50, 2) + passage + sentence(50, 4)),
             (23, sentence(30, 5) + passage + sentence(30, 6) + passage), (24, passage), (25, passage[:99]),
             (26, passage[:100]), (27, "x" + passage[1:101]), (28, "a" * 500), (29, "a" * 150), (30, "ab" * 300),
             (31, "é" * 120), (32, "é" * 49 + "z"), (33, sentence(30, 9) + passage[20:150])]
    rows += [(100 + i, f"{i} " + passage + f" {i} end") for i in range(80)]     # one passage, many contexts
    rows += [(300 + i, sentence(60, 8)) for i in range(20)]                    # equal texts
    rows += [(400, sentence(20, 700)), (400, sentence(20, 700))]               # a repeated row
    return rows


def run(spark, rows, parts):
    prepare(spark)
    out = substring_dup.remove_repeats(docs_frame(spark, rows).repartition(parts))
    return out.collect()


def check(rows, got):
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == brute(rows)
    for r in got:
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]
        assert sum(s["length"] for s in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]


def test_matches_brute_force(spark):
    check(corpus(), run(spark, corpus(), 4))


def test_crowded_anchors_and_small_chunks(monkeypatch):
    """The hot-anchor path and texts longer than a chunk, on the task functions themselves."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa
    monkeypatch.setattr(substring_dup, "CROWDED", 4)
    monkeypatch.setattr(substring_dup, "CHUNK", 1500)
    monkeypatch.setattr(substring_dup, "FLUSH", 200)
    rows = [(d, t) for d, t in corpus() if d is not None] + [(999, sentence(3000, 50)), (1000, "q " + sentence(3000, 50))]
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.int64()),
                                        pa.array([(t or "").encode() for _, t in rows], pa.binary())], ["id", "t"])
    buckets = 5

    def frames(parts):
        pdf = pd.concat([b.to_pandas() for b in parts])
        return [g for _, g in pdf.groupby("bucket")]

    judged = pd.concat([substring_dup._judge_spans(g) for g in frames(substring_dup._span_blocks([batch], buckets))])
    left = judged[judged["kind"] == 1]
    texts = dict((d, (t or "").encode()) for d, t in rows)
    by = {d: [{"pos": int(p), "n": int(n)} for p, n in zip(g["pos"], g["n"])] for d, g in left.groupby("id")}
    named = pa.RecordBatch.from_arrays([pa.array(list(by), pa.int64()), pa.array([texts[d] for d in by], pa.binary()),
                                        pa.array(list(by.values()))], ["id", "t", "spans"])
    windows = pd.concat([substring_dup._judge_names(g) for g in frames(substring_dup._name_blocks([named], buckets))])
    marks = pd.concat([judged[judged["kind"] == 0], windows])
    got = Counter()
    for d, t in {d: t for d, t in rows}.items():
        m = marks[marks["id"] == d]
        raw, cover = texts[d], np.zeros(len(texts[d]), bool)
        for p, n in zip(m["pos"], m["n"]):
            cover[p:p + n + W - 1] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~cover]) if raw else b""
        got[(d, int(cover.sum()), hashlib.sha256(kept).hexdigest())] += 1
    want = Counter((d, n, h) for d, _, n, _, h in brute(list({d: t for d, t in rows}.items())))
    assert got == want


def test_empty_table(spark):
    assert run(spark, [], 1) == []


def test_rows_without_id_and_shared_ids_are_marked_by_row(spark):
    one, two, p = sentence(120, 1000), sentence(120, 1001), sentence(40, 1002)
    rows = [(None, p + one), (None, p + two), (None, sentence(150, 1003) + p), (None, sentence(160, 1004)),
            (5, sentence(150, 1005) + p), (5, sentence(170, 1006)), (6, one), (-(1 << 63), sentence(90, 1007))]
    got = run(spark, rows, 3)
    kept = {bytes(r["kept"]).decode() for r in got if r["doc_id"] is None}
    assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == [-(1 << 63), 5, 5, 6]
    assert sum(p in k for k in kept) == 1 and sum(r["n_removed"] > 0 for r in got if r["doc_id"] is None) == 2
    assert all(any(t in k for k in kept) for t in (one[1:], two[1:], sentence(150, 1003)[:-1], sentence(160, 1004)))
    fives = {bytes(r["kept"]).decode() for r in got if r["doc_id"] == 5}
    assert sentence(170, 1006) in fives and not any(p in k for k in fives)
    assert [r["n_removed"] for r in got if r["doc_id"] == 6] == [len(one)]
