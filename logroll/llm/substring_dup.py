"""Exact repeated-substring removal by windowed fingerprints, in place of a suffix sort.

The sampled and the remaining positions below get the same names; there are no ranks and no merge.

A byte goes when a window of ``width`` (100) bytes covering it also starts earlier, in a smaller
doc_id or earlier in the same document.  Windows never cross documents; all windows are judged on
the input.  A document is a pair (id, row): ``row`` is 0 but for rows without doc_id, each a
document of its own, and for unlike texts that share a doc_id.  Order is only needed up to ``width`` bytes, so suffixes are named, sorted and compared
to that depth.

1. *Reduction.*  Sorting every suffix of the corpus would move about 80 bytes per byte of text.
   So regions that cannot matter are set aside first.  Each window has one anchor, the window's
   leftmost smallest ``gram``-byte fingerprint; equal windows have equal anchors at equal offsets.
   Neighbouring windows with one anchor form a span.  A span whose anchor occurs nowhere else
   holds no repeated window; a span equal to an earlier one is repeated as a whole.  What is left
   (first copies whose anchor also occurs in another context: the edges of copied passages) goes
   to the suffix sort.
2. *Sampled triples, names, recursion.*  In each remaining piece the positions 1 and 2 modulo 3
   are the difference-cover sample.  Triples of bytes get names, triples of names get names
   (3, 9, 27, 81 bytes) up to 99 bytes.  A name is a pair of 64-bit polynomial fingerprints, so
   it needs no global counter and equal strings get equal names in every task.
3. *Remaining suffixes* (0 modulo 3) are named from their first byte and the name of the next,
   sampled position.
4. *Sort and compare.*  Names are dealt to buckets, sorted, and adjacent equal names compared:
   all but the smallest (doc_id, start) of a name mark their window.

Each task first combines its own equal spans and equal names, so a passage found in a third of
all documents reaches a bucket once per task, not once per document; an anchor with very many
different contexts in one task skips its bucket and goes straight to step 2.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logroll.llm.common import bucket_count, freeze, small

WIDTH, GRAM = 100, 36
CHUNK = 1 << 20               # bytes of text handled at once
FLUSH = 1_200_000             # spans or names combined within a task before they are dealt out
CROWDED = 64                  # contexts of one anchor in one task beyond which it skips its bucket
NULL_ID = -(1 << 63)          # a null doc_id sorts first
_POS = np.uint64((1 << 21) - 1)
_U = np.uint64


def _power(base: int, n: int) -> np.ndarray:
    a = np.full(n, base, np.uint64)
    a[0] = 1
    return np.cumprod(a, dtype=np.uint64)


class _Fingerprint:
    """Polynomial fingerprints modulo 2**64 over random byte values."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.bytes = rng.integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
        self.p = int(rng.integers(2**62, 2**63, dtype=np.uint64)) * 2 + 5
        self.p %= 1 << 64
        self.p |= 1
        n = CHUNK + WIDTH + 1
        self.pow, self.inv = _power(self.p, n), _power(pow(self.p, -1, 1 << 64), n)

    def prefix(self, buf: np.ndarray) -> np.ndarray:
        c = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.bytes[buf] * self.pow[:len(buf)], out=c[1:])
        return c

    def names(self, buf: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Names of the ``WIDTH``-byte windows at each position of ``buf`` (its tail excluded).
        ``first``: start, in the buffer, of the piece that holds a position."""
        p = [_U(pow(self.p, k, 1 << 64)) for k in range(WIDTH)]
        name, step = self.bytes[buf], 1
        levels = {}
        while step * 3 < WIDTH:                               # triples of names, 3 to 81 bytes
            name = name[:-2 * step] + p[step] * name[step:-step] + p[2 * step] * name[2 * step:]
            step *= 3
            levels[step] = name
        n = len(buf) - WIDTH + 1
        tail = levels[9][81:81 + n + 1] + p[9] * levels[9][90:90 + n + 1]
        n99 = levels[81][:n + 1] + p[81] * tail[:n + 1]         # 81 + 18 bytes
        at = np.arange(n)
        sampled = (at - first[:n]) % 3 != 0
        one = self.bytes[buf]
        out = np.empty(n, np.uint64)
        s = at[sampled]
        out[s] = n99[s] + p[99] * one[s + 99]
        r = at[~sampled]
        out[r] = one[r] + p[1] * n99[r + 1]                    # first byte, then a sampled name
        return out


_FP: dict[int, _Fingerprint] = {}


def _fp(seed: int) -> _Fingerprint:
    if seed not in _FP:
        _FP[seed] = _Fingerprint(seed)
    return _FP[seed]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _documents(batch) -> np.ndarray:
    """(documents, 2): id and row; a batch without the column ``row`` has one row an id."""
    ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if "row" not in batch.schema.names:
        return np.stack([ids, np.zeros_like(ids)], axis=1)
    row = batch.column(batch.schema.get_field_index("row")).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.stack([ids, row], axis=1)


def _pieces(batch):
    """Chunks of a batch: byte buffer, piece starts in it, their documents and start positions.
    Documents longer than a chunk continue in the next one with ``WIDTH - 1`` bytes repeated."""
    ids = _documents(batch)
    texts = batch.column(1).to_pylist()
    parts, starts, docs, base, total = [], [], [], [], 0
    for doc, text in zip(ids, texts):
        if not text or len(text) < WIDTH:
            continue
        for at in range(0, len(text) - WIDTH + 1, CHUNK):
            part = text[at:at + CHUNK + WIDTH - 1] if len(text) > CHUNK else text
            if total and total + len(part) > CHUNK:
                yield np.frombuffer(b"".join(parts), np.uint8), np.array(starts), np.array(docs), np.array(base)
                parts, starts, docs, base, total = [], [], [], [], 0
            parts.append(part)
            starts.append(total)
            docs.append(doc)
            base.append(at)
            total += len(part)
            if len(text) <= CHUNK:
                break
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), np.array(starts), np.array(docs), np.array(base)


def spans(buf, starts, docs, base):
    """Anchor fingerprint, span fingerprint, doc_id, start and number of windows of each span."""
    fp, n = _fp(1), len(buf)
    c = fp.prefix(buf)
    g = _mix((c[GRAM:] - c[:-GRAM]) * fp.inv[:n - GRAM + 1])
    v = (g & ~_POS) | np.arange(len(g), dtype=np.uint64)
    reach, w = WIDTH - GRAM + 1, 1
    while 2 * w <= reach:                                      # sliding minimum by doubling
        v = np.minimum(v[:-w], v[w:])
        w *= 2
    if w < reach:
        v = np.minimum(v[:len(v) - (reach - w)], v[reach - w:])
    piece = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, n)))
    inside = piece[:n - WIDTH + 1] == piece[WIDTH - 1:]
    anchor = np.where(inside, (v & _POS).astype(np.int64), -1)
    cut = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
    lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [len(anchor)]])
    ok = anchor[lo] >= 0
    lo, hi = lo[ok], hi[ok]
    at = anchor[lo]
    body = (c[hi - 1 + WIDTH] - c[lo]) * fp.inv[lo]
    shape = (hi - lo).astype(np.uint64) * _U(128) + (at - lo).astype(np.uint64)
    of = piece[lo]
    return g[at], _mix(body ^ _mix(shape)), docs[of], lo - starts[of] + base[of], hi - lo


def _later(key: tuple, doc: np.ndarray, pos: np.ndarray):
    """Order by (key, doc, pos); which entries of that order have an earlier equal key, which start a key."""
    order = np.lexsort((pos, doc[:, 1], doc[:, 0], *key[::-1]))
    new = np.ones(len(order), bool)
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in key:
        k = k[order]
        same &= k[1:] == k[:-1]
    new[1:] = ~same
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else np.empty(0, np.int64)
    d, p = doc[order], pos[order]
    return order, (d != d[head]).any(axis=1) | (p != p[head]), new


def _runs(doc, pos, n):
    """Merge adjoining (doc, pos, length) entries."""
    if not len(doc):
        return doc, pos, n
    o = np.lexsort((pos, doc[:, 1], doc[:, 0]))
    doc, pos, n = doc[o], pos[o], n[o]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]).any(axis=1) | (pos[1:] > pos[:-1] + n[:-1])
    at = np.flatnonzero(new)
    end = np.maximum.reduceat(pos + n, at)
    return doc[at], pos[at], end - pos[at]


_KEYED = "bucket long, a binary, b binary, doc binary, pos binary, n binary, row binary"


def _row_bytes(doc: np.ndarray) -> bytes:
    """Rows of documents; empty where all are 0, as is usual."""
    return doc[:, 1].astype("<i8").tobytes() if doc[:, 1].any() else b""


def _documents_of(docs, rows) -> np.ndarray:
    """Documents from the columns ``doc`` and ``row`` of blocks."""
    ids = np.frombuffer(b"".join(docs), "<i8")
    row = np.frombuffer(b"".join(r or bytes(len(d)) for d, r in zip(docs, rows)), "<i8")
    return np.stack([ids, row], axis=1)


def _deal(buckets: int, a, b, doc, pos, n):
    """Rows of one block per bucket."""
    of = (a % _U(buckets)).astype(np.int64)
    o = np.argsort(of, kind="stable")
    of = of[o]
    edge = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]]) if len(of) else [0]
    doc = doc[o]
    cols = [x.astype(t) for x, t in ((a[o], "<u8"), (b[o], "<u8"), (doc[:, 0], "<i8"), (pos[o], "<u4"), (n[o], "u1"))]
    rows = [(int(of[i]), *[x[i:j].tobytes() for x in cols], _row_bytes(doc[i:j])) for i, j in zip(edge[:-1], edge[1:])]
    return rows


def _marked(buckets: int, doc, pos, n, seed: int):
    """Rows that only pass on what a task already knows (no keys), dealt evenly."""
    doc, pos, n = _runs(doc, pos, n)
    rows = []
    for i in range(0, len(doc), 20_000):
        s = slice(i, i + 20_000)
        rows.append(((seed + i // 20_000 * 7919) % buckets, b"", b"", doc[s, 0].astype("<i8").tobytes(),
                     pos[s].astype("<u4").tobytes(), n[s].astype("<u4").tobytes(), _row_bytes(doc[s])))
    return rows


def _batch(rows):
    cols = list(zip(*rows)) if rows else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64())] + [pa.array(c, pa.binary()) for c in cols[1:]],
                                      names=["bucket", "a", "b", "doc", "pos", "n", "row"])


def _combine_spans(buckets, held, seed):
    a, b, doc, pos, n = (np.concatenate(x) for x in zip(*held))
    order, later, new = _later((a, b), doc, pos)
    a, b, doc, pos, n = (x[order] for x in (a, b, doc, pos, n))
    rows = _marked(buckets, doc[later], pos[later], n[later], seed)
    a, b, doc, pos, n = (x[new] for x in (a, b, doc, pos, n))
    if len(a):
        head = np.concatenate([[0], np.flatnonzero(a[1:] != a[:-1]) + 1])
        size = np.diff(np.append(head, len(a)))
        crowded = np.repeat(size > CROWDED, size)
        if crowded.any():
            # One stand-in per crowded anchor makes the others of that anchor ambiguous as well.
            stand = np.flatnonzero(crowded & np.isin(np.arange(len(a)), head))
            rows += [(r[0], r[1], b"", *r[3:]) for r in _deal(buckets, a[stand], b[stand], doc[stand], pos[stand],
                                                             n[stand])]
            d, p, m = doc[crowded], pos[crowded], n[crowded]
            for i in range(0, len(d), 20_000):
                s = slice(i, i + 20_000)
                rows.append(((seed + 31 * i) % buckets, b"", b"?", d[s, 0].astype("<i8").tobytes(),
                             p[s].astype("<u4").tobytes(), m[s].astype("<u4").tobytes(), _row_bytes(d[s])))
            a, b, doc, pos, n = (x[~crowded] for x in (a, b, doc, pos, n))
    o = np.lexsort((pos, doc[:, 1], doc[:, 0]))
    return _batch(rows + _deal(buckets, *(x[o] for x in (a, b, doc, pos, n))))


def _span_blocks(batches, buckets):
    held, size, seed = [], 0, 0
    for batch in batches:
        for piece in _pieces(batch):
            s = spans(*piece)
            held.append(s)
            size += len(s[0])
            if size >= FLUSH:
                seed += 104729
                yield _combine_spans(buckets, held, seed)
                held, size = [], 0
    if size:
        yield _combine_spans(buckets, held, seed + 13)


def _unpack(pdf: pd.DataFrame):
    get = lambda c, t: np.frombuffer(b"".join(pdf[c]), t)
    return (get("a", "<u8"), get("b", "<u8"), _documents_of(pdf["doc"], pdf["row"]), get("pos", "<u4").astype(np.int64),
            get("n", "u1").astype(np.int64))


def _frame(doc, pos, n, kind):
    return pd.DataFrame({"id": doc[:, 0], "row": doc[:, 1], "pos": pos, "n": n, "kind": np.full(len(doc), kind, np.int32)})


def _no_frame():
    none = np.empty(0, np.int64)
    return _frame(none.reshape(0, 2), none, none, 0)


_OUT = "id long, row long, pos long, n long, kind int"


def _told(pdf: pd.DataFrame):
    """The rows of a bucket that carry no keys."""
    for kind, flag in ((0, b""), (1, b"?")):
        part = pdf[(pdf["a"] == b"") & (pdf["b"] == flag)]
        if len(part):
            yield _frame(_documents_of(part["doc"], part["row"]),
                         np.frombuffer(b"".join(part["pos"]), "<u4").astype(np.int64),
                         np.frombuffer(b"".join(part["n"]), "<u4").astype(np.int64), kind)


def _judge_spans(pdf: pd.DataFrame) -> pd.DataFrame:
    """kind 0: repeated as a whole; kind 1: to be sorted by suffix."""
    out = list(_told(pdf))
    pdf = pdf[pdf["a"] != b""]
    stand = pdf[pdf["b"] == b""]
    pdf = pdf[pdf["b"] != b""]
    if len(pdf):
        a, b, doc, pos, n = _unpack(pdf)
        order, later, new = _later((a, b), doc, pos)
        a, doc, pos, n = (x[order] for x in (a, doc, pos, n))
        out.append(_frame(doc[later], pos[later], n[later], 0))
        a, doc, pos, n = (x[new] for x in (a, doc, pos, n))
        shared = np.zeros(len(a), bool)
        shared[1:] = a[1:] == a[:-1]
        shared[:-1] |= shared[1:]
        if len(stand):
            shared |= np.isin(a, np.frombuffer(b"".join(stand["a"]), "<u8"))
        out.append(_frame(doc[shared], pos[shared], n[shared], 1))
    return pd.concat(out) if out else _no_frame()


def _name_blocks(batches, buckets):
    """Windows of the remaining spans, named; equal names within the task are settled here."""
    held, size, seed = [], 0, 0

    def combined(held, seed):
        a, b, doc, pos = (np.concatenate(x) for x in zip(*held))
        order, later, new = _later((a, b), doc, pos)
        d, p = doc[order][later], pos[order][later]
        rows = _marked(buckets, d, p, np.ones(len(d), np.int64), seed)
        keep = np.sort(order[new])
        return _batch(rows + _deal(buckets, a[keep], b[keep], doc[keep], pos[keep], np.ones(len(keep), np.int64)))

    for batch in batches:
        ids = _documents(batch)
        parts, doc, pos, n, total = [], [], [], [], 0

        def named():
            buf = np.frombuffer(b"".join(parts), np.uint8)
            m = np.array(n)
            start = np.concatenate([[0], np.cumsum(m + WIDTH - 1)[:-1]])
            first = np.repeat(start, m + WIDTH - 1)
            take = np.repeat(start - np.concatenate([[0], np.cumsum(m)[:-1]]), m) + np.arange(m.sum())
            a, b = (_mix(_fp(s).names(buf, first)[take]) for s in (2, 3))
            return a, b, np.repeat(np.array(doc), m, axis=0), np.repeat(np.array(pos), m) + take - np.repeat(start, m)

        for d, text, list_ in zip(ids, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            for s in list_ or ():
                k = min(s["n"], len(text or b"") - WIDTH + 1 - s["pos"])
                while k > 0:                                   # a span is at most 65 windows; runs may be longer
                    step = min(k, CHUNK // 2)
                    at = s["pos"]
                    parts.append(text[at:at + step + WIDTH - 1])
                    doc.append(d)
                    pos.append(at)
                    n.append(step)
                    total += step + WIDTH - 1
                    k -= step
                    s = {"pos": at + step, "n": k}
                    if total >= CHUNK // 2:
                        held.append(named())
                        size += len(held[-1][0])
                        parts, doc, pos, n, total = [], [], [], [], 0
            if size >= FLUSH:
                seed += 104729
                yield combined(held, seed)
                held, size = [], 0
        if parts:
            held.append(named())
            size += len(held[-1][0])
    if size:
        yield combined(held, seed + 17)


def _judge_names(pdf: pd.DataFrame) -> pd.DataFrame:
    out = list(_told(pdf))
    pdf = pdf[pdf["a"] != b""]
    if len(pdf):
        a, b, doc, pos, _ = _unpack(pdf)
        order, later, _ = _later((a, b), doc, pos)
        d, p = doc[order][later], pos[order][later]
        out.append(_frame(*_runs(d, p, np.ones(len(d), np.int64)), 0))
    return pd.concat(out) if out else _no_frame()


def repeated_windows(src: DataFrame, buckets: int) -> DataFrame:
    """id, row, pos, n: runs of window starts that have an earlier occurrence (``src``: of ``_bytes``)."""
    blocks = src.mapInArrow(lambda it: _span_blocks(it, buckets), _KEYED)
    judged = freeze(blocks.groupBy("bucket").applyInPandas(_judge_spans, _OUT), "spans")
    left = judged.where("kind = 1").groupBy("id", "row").agg(F.collect_list(F.struct("pos", "n")).alias("spans"))
    named = (src.join(left, ["id", "row"]).select("id", "t", "spans", "row")
             .mapInArrow(lambda it: _name_blocks(it, buckets), _KEYED))
    windows = named.groupBy("bucket").applyInPandas(_judge_names, _OUT)
    return judged.where("kind = 0").select("id", "row", "pos", "n").union(windows.select("id", "row", "pos", "n"))


def _bytes(docs: DataFrame) -> DataFrame:
    """id, t, row.  Rows without doc_id are frozen with a (negative) number of their own; of a doc_id
    found in several rows the hash of the text tells the documents apart, so that repeated rows are one."""
    plain = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")).alias("t"))
    none = freeze(plain.where("id is null").select(F.lit(NULL_ID).alias("id"), "t", (
        -1 - F.monotonically_increasing_id()).alias("row")), "null-ids")
    shared = freeze(plain.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
                    .select(F.col("id").alias("shared_id")), "shared-ids")
    src, row = plain.where("id is not null"), F.lit(0).cast("long")
    if shared.limit(1).count():
        src = src.join(small(shared), F.col("id") == F.col("shared_id"), "left")
        row = F.when(F.col("shared_id").isNotNull(), F.xxhash64("t").bitwiseAND(F.lit((1 << 63) - 1))).otherwise(row)
    src = src.select("id", "t", row.alias("row"))
    return src.union(none) if none.limit(1).count() else src


def _removed(batches, with_text):
    for batch in batches:
        out = []
        for d, t, marks, row in zip(*(batch.column(i).to_pylist() for i in range(4))):
            n = len(t)
            cover = np.zeros(n + 1, np.int64)
            if marks:
                lo = np.array([m["pos"] for m in marks])
                hi = lo + np.array([m["n"] for m in marks]) + WIDTH - 1
                np.add.at(cover, np.minimum(lo, n), 1)
                np.add.at(cover, np.minimum(hi, n), -1)
            gone = np.cumsum(cover[:n]) > 0
            edge = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
            lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            kept = np.frombuffer(t, np.uint8)[~gone].tobytes() if len(lo) else t
            out.append((None if d == NULL_ID and row < 0 else d, n, int((hi - lo).sum()), len(lo), hashlib.sha256(kept).hexdigest(),
                        [{"start": int(x), "length": int(y - x)} for x, y in zip(lo, hi)], kept if with_text else None))
        cols = list(zip(*out)) if out else [[]] * 7
        span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        kinds = [pa.int64()] * 4 + [pa.string(), span, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[
            "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed byte runs), kept (bytes).

    Null and empty texts have no bytes and lose nothing, nor do texts under 100 bytes.  A null
    doc_id sorts before all others, and each row without one is a document.  Rows that repeat both
    doc_id and text count as one document: they are not each other's earlier copies; unlike texts of
    one doc_id are documents, in the order of a hash of the text.  Other columns are ignored.  ``with_text=False`` leaves ``kept`` null.
    """
    src = _bytes(docs)
    buckets = bucket_count(docs.select("doc_id", "text"))
    marks = repeated_windows(src, buckets).groupBy("id", "row").agg(F.collect_list(F.struct("pos", "n")).alias("marks"))
    return (src.join(marks, ["id", "row"], "left").select("id", "t", "marks", "row")
            .mapInArrow(lambda it: _removed(it, with_text),
                        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                        "spans array<struct<start: long, length: long>>, kept binary"))
