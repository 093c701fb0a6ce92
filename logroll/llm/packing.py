"""Bounded-space online packing of tokenized documents into fixed-length sequences.

Each partition keeps ``WINDOWS`` open windows.  Whole windows of a long document are emitted at
once; the rest goes to the best-fitting open window.  When none fits and no more may be opened,
the fullest is emitted: with its gap filled by the head of the piece, or as it is when the gap is
at most ``MAX_GAP``.  What is left open at the end of a partition is merged in groups of
``MERGE`` partitions by the same rules; the very last window of a group is cut into sequences
whose lengths are powers of two, which need no padding.

Memory per task: the open windows.  Only leftovers are shuffled.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from logroll.llm.common import freeze, release

LENGTH, WINDOWS, MAX_GAP, MERGE, END_ID = 4096, 32, 32, 64, 2
_CACHE_WORDS, _CACHE_RUNS = 300_000, 500_000
_LOT_BYTES = 4 << 20            # text tokenized at once
_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
           "ids binary")


# Words of these letters and ASCII punctuation (no apostrophe, "<" or digit) are split by the tokenizer
# exactly into runs of letters and runs of punctuation, whatever the case of the letters.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[{_LETTERS}!-&(-/:;=-@\[-`{{-~]+")
_RUNS = re.compile(rf"[{_LETTERS}]+|[^{_LETTERS}]+")
# A byte-level vocabulary writes printable bytes as themselves and the others from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


_PACKS = [struct.Struct(f"<{n}I").pack for n in range(33)]


def _pack(ids: list[int]) -> bytes:
    """Little-endian 32-bit ids."""
    return _PACKS[len(ids)](*ids) if len(ids) < len(_PACKS) else struct.pack(f"<{len(ids)}I", *ids)


class _Known(dict):
    """Ids by word; ``extra`` has those found last, of which there may be no room for."""

    extra: dict[bytes, bytes] = {}


class WordTokens:
    """Token ids, as little-endian 32-bit bytes, by white-space-separated word.

    The tokenizer drops white space and never joins across it, so a text's ids are its words' ids
    in order.  Words, and the lower-cased runs plain words consist of, are kept in bounded caches;
    a full cache keeps what it has (frequent words come early) and the rest is encoded each time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        self.encode, self.model = tokenizer.encode_batch, tokenizer.model
        self.words = _Known({b"": b""})
        self.runs: dict[str, bytes] = {}

    def _resolve(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words not in the cache: plain words run by run from the vocabulary's merges,
        others through the whole tokenizer."""
        runs, got, odd, tokenize = self.runs, {}, [], self.model.tokenize
        for w in new:
            s = w.decode()
            if s.isalpha() and s.isascii():
                found = (s.lower(),)
            elif _PLAIN.fullmatch(s):
                found = _RUNS.findall(s.lower())
            else:
                odd.append((w, s))
                continue
            parts = []
            for r in found:
                ids = runs.get(r)
                if ids is None:
                    text = r if r.isascii() else r.encode().decode("latin-1").translate(_BYTES)    # ASCII is itself
                    ids = _pack([t.id for t in tokenize(text)])
                    if len(runs) < _CACHE_RUNS:
                        runs[r] = ids
                parts.append(ids)
            got[w] = parts[0] if len(parts) == 1 else b"".join(parts)
        for i in range(0, len(odd), 4096):
            lot = odd[i:i + 4096]
            for (w, _), e in zip(lot, self.encode([s for _, s in lot], add_special_tokens=False)):
                got[w] = _pack(e.ids)
        if len(self.words) < _CACHE_WORDS:
            self.words.update(got)
        return got

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        coded = split.flatten().dictionary_encode()             # each word is looked up once a lot
        words = coded.dictionary.view(pa.large_binary()).to_pylist()
        ids = [*map(self.words.get, words)]
        new = [w for w, x in zip(words, ids) if x is None]
        self.words.extra = got = self._resolve(new) if new else {}
        if new:
            ids = [got[w] if x is None else x for w, x in zip(words, ids)]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, flat = np.cumsum(size) - size, np.frombuffer(b"".join(ids), "<u4")
        word = coded.indices.to_numpy()
        n = size[word]
        ends = np.concatenate([[0], np.cumsum(n)])              # of the words, in the lot's ids
        lot = flat[np.repeat(first[word] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
        cut = (4 * ends[split.offsets.to_numpy() - split.offsets[0].as_py()]).tolist()
        end = struct.pack("<I", END_ID)
        return [lot[i:j] + end for i, j in zip(cut, cut[1:])]


class Packer:
    """Open windows of one task; ``done`` gets (sequence, pieces) as windows are emitted."""

    def __init__(self, first_id: int):
        self.next, self.open, self.done = first_id, [], []

    def emit(self, pieces):
        at = 0
        for p in pieces:
            self.done.append((*p, self.next, at))
            at += p[2]
        self.next += 1

    def add(self, doc, start, n, total, ids):
        """A piece of ``n`` tokens of a document; ``ids`` are exactly its bytes."""
        while n >= LENGTH:
            self.emit([(doc, start, LENGTH, total, ids[:4 * LENGTH])])
            start, n, ids = start + LENGTH, n - LENGTH, ids[4 * LENGTH:]
        while n:
            best = min((w for w in self.open if w[0] >= n), key=lambda w: w[0], default=None)
            if best is None and len(self.open) < WINDOWS:
                best = [LENGTH, []]
                self.open.append(best)
            if best is None:
                full = min(self.open, key=lambda w: w[0])
                gap = full[0]
                if gap > MAX_GAP:
                    full[1].append((doc, start, gap, total, ids[:4 * gap]))
                    start, n, ids = start + gap, n - gap, ids[4 * gap:]
                self.open.remove(full)
                self.emit(full[1])
                continue
            best[0] -= n
            best[1].append((doc, start, n, total, ids))
            if best[0] == 0:
                self.open.remove(best)
                self.emit(best[1])
            return

    def merge_rest(self):
        """Close what is open: full windows by cutting, the last one as powers of two."""
        rest = [p for w in sorted(self.open, key=lambda w: w[0]) for p in w[1]]
        self.open, room, window, left = [], 0, [], sum(p[2] for p in rest)

        def size():
            return LENGTH if left >= LENGTH else 1 << (left.bit_length() - 1)

        room = size() if left else 0
        for doc, start, n, total, ids in rest:
            while n:
                k = min(n, room)
                window.append((doc, start, k, total, ids[:4 * k]))
                start, n, ids, room = start + k, n - k, ids[4 * k:], room - k
                left -= k
                if room == 0:
                    self.emit(window)
                    window, room = [], size() if left else 0


def _rows(done, with_ids):
    out = []
    for doc, start, n, total, ids, seq, at in done:
        out.append((doc, start, n, zlib.crc32(ids), total, seq, at, ids if with_ids else None))
    return out


def _arrow(rows, kinds, names):
    cols = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def _pack_partition(batches, path, with_ids):
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    tokens, packer = WordTokens(path), Packer(part << 32)
    names, kinds = [*_COLUMNS, "part"], [*_KINDS, pa.int64()]
    for batch in batches:
        docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = 0
        while at < len(docs):
            lot, size = [], 0
            while at + len(lot) < len(docs) and (not lot or size < _LOT_BYTES):
                lot.append(texts[at + len(lot)] or b"")
                size += len(lot[-1])
            for doc, ids in zip(docs[at:], tokens(lot)):
                packer.add(doc, 0, len(ids) // 4, len(ids) // 4, ids)
            at += len(lot)
            yield _arrow([(*r, None) for r in _rows(packer.done, with_ids)], kinds, names)
            packer.done = []
    left = [(doc, start, n, zlib.crc32(ids), total, None, None, ids, part)
            for w in packer.open for doc, start, n, total, ids in w[1]]
    yield _arrow(left, kinds, names)
    del tokens, packer, left
    release()


def _merge_group(key, pdf, with_ids):
    packer = Packer((1 << 62) | (int(key[0]) << 32))
    pdf = pdf.sort_values(["part", "doc_id", "start", "ids_crc32"], na_position="first")
    for doc, start, n, total, ids in zip(pdf["doc_id"], pdf["start"], pdf["length"], pdf["doc_tokens"], pdf["ids"]):
        packer.add(None if pd.isna(doc) else int(doc), int(start), int(n), int(total), bytes(ids))
    packer.merge_rest()
    out = pd.DataFrame(_rows(packer.done, with_ids), columns=_COLUMNS)
    out["doc_id"] = out["doc_id"].astype("Int64")
    return out


def pack(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A document is its token ids and a final id 2; a null or empty text is that id alone.  Repeated
    rows are separate documents; other columns are ignored; an empty table gives no rows.  A
    sequence is padded to 4096 unless its length is a power of two.  ``with_ids=False`` leaves the
    ids out (they are still checksummed).
    """
    first = freeze(docs.select(F.col("doc_id").cast("long"), F.encode("text", "UTF-8").alias("t"))
                   .mapInArrow(lambda it: _pack_partition(it, path, with_ids), f"{_PIECES}, part long"), "packed")
    whole = first.where("part is null").drop("part")
    rest = (first.where("part is not null").withColumn("lot", F.floor(F.col("part") / MERGE).cast("long"))
            .groupBy("lot").applyInPandas(lambda key, pdf: _merge_group(key, pdf, with_ids), _PIECES))
    return whole.union(rest)
