"""Token ids of documents as raw binary shards with a minimal perfect hash index.

A store is a folder with

* ``payload/shard=N/``  one file: a head (MAGIC, width, number of documents; their ids, validity and lengths)
  and then the raw token ids of the documents, ascending by document, as little-endian integers of
  ``width`` bytes, each document closed by the end id 0;
* ``shards/``           a Parquet row per shard: shard, base (ids of all shards before), n_ids, n_docs;
* ``meta/``             width and number of index parts;
* ``index/part=N/``     one file: the index of the keys whose digest falls to part N.

Spark's text writer writes the raw files (a row is a file, the zero byte after it its line end), so they
land on any file system Spark knows and its commit protocol covers lost executors.  Texts are shuffled
once, into ranges of doc_id; a range is encoded and written in the same task.

A document's key is (doc_id, occurrence): the occurrence tells rows of one id apart.  An index part
is a minimal perfect hash of its keys in levels: a level's bit array marks the cells that exactly one
of the remaining keys hashes to, the others go on; a key's slot is the rank of its bit.  A slot holds
a fingerprint of the key (so an absent key is refused but for one in 2^32), the shard, the offset and
the length in ids.  A lookup reads a constant number of words, whatever the size of the store.

Parts hold a bounded number of keys, shards a bounded number of ids (and one document at least).
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from logroll.llm.common import freeze, partitions, plan_bytes
from logroll.llm.sharding import prefix_sums

END_ID = 0
SHARD_IDS = 2_000_000
RANGE_BYTES = 16 << 20           # of the stored table, per range of documents
KEYS_PER_PART = 20_000
LEVELS, LOAD = 48, 2.0
MAGIC, SHARD_MAGIC = b"TOKIDX01", b"TOKIDS01"
RECORD = np.dtype([("fp", "<u4"), ("shard", "<u8"), ("offset", "<u8"), ("length", "<u8")])
_LOT_BYTES = 4 << 20
_CACHE_PIECES, _CACHE_CHUNKS = 600_000, 100_000


# -- token ids ---------------------------------------------------------------------------------------

# White space as the byte-level splitter knows it, and what only some engines call white space.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RARE = re.compile(r"[\x1c-\x1f\u180e\u200b\ufeff]")
# Letters whose class no Unicode version has changed: Latin, Greek, Cyrillic, Hebrew, Arabic, kana, Han, Hangul.
_LETTERS = ("A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0391-\u03a1\u03a3-\u03ce\u0400-\u0481\u048a-\u0523"
            "\u05d0-\u05ea\u0621-\u063a\u0641-\u064a\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3")
_SIGNS = r"!-/:-@\[-`{-~"
#: Texts of known characters are cut by the splitter's own rule, stated over those characters.
_KNOWN = re.compile(rf"[{_LETTERS}{_SIGNS}0-9\t-\r ]*")
_SPECIAL = "<|"
_SHORT = re.compile("'(?:s|t|re|ve|m|ll|d)")
#: Byte classes over known characters: 0 letters (all bytes beyond ASCII), 1 digits, 2 signs, 3 white space.
_CLASS = np.array([3 if b == 32 or 9 <= b <= 13 else 1 if 48 <= b <= 57 else 2 if b < 128 and not chr(b).isalpha() else 0
                   for b in range(256)], np.uint8)
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[{_SIGNS}]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
#: Other texts are cut before blanks, unless a blank lies inside a run of white space.
_UNSAFE = re.compile(rf"[{_WS}] (?:[{_WS}]|\Z)")
_CHUNK = re.compile(rf" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
# A byte-level vocabulary writes printable bytes as themselves and the others from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class TextIds:
    """Ids of whole texts, little-endian in ``width`` bytes, equal to the tokenizer's.

    The tokenizer splits a text into pieces and merges inside each, so a text's ids are those of its
    pieces.  Pieces are kept in a bounded cache; a full cache keeps what it has.  Texts with characters
    beyond the known ones go by chunks (a blank and what follows) through the whole tokenizer, those
    with special strings or rare separators as a whole.
    """

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code = "H" if width == 2 else "I"
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _packed(self, ids) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _piece(self, s: str) -> bytes:
        shown = (s.replace(" ", chr(_BYTES[32])) if s.isascii() and s.isprintable()
                 else s.encode().decode("latin-1").translate(_BYTES))
        return self._packed([t.id for t in self.model.tokenize(shown)])

    def _chunk(self, s: str) -> bytes:
        return self._packed(self.tokenizer.encode(s, add_special_tokens=False).ids)

    @staticmethod
    def _joined(parts: list[str], known: dict[str, bytes], make, limit: int) -> bytes:
        found = list(map(known.get, parts))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    s = parts[i]
                    found[i] = ids = known.get(s) or make(s)
                    if len(known) < limit and len(s) < 48:
                        known[s] = ids
        return b"".join(found)

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if _SPECIAL in text or _RARE.search(text):
            return self._chunk(text)
        if _KNOWN.fullmatch(text):
            return self._joined(_PIECES.findall(text), self.pieces, self._piece, _CACHE_PIECES)
        if _UNSAFE.search(text):
            chunks = _CHUNK.findall(text)
        else:
            first, *rest = text.split(" ")
            chunks = [first] if first else []
            chunks += [" " + c for c in rest]
        return self._joined(chunks, self.chunks, self._chunk, _CACHE_CHUNKS)

    def lot(self, texts: list[str]) -> list[bytes]:
        """Ids of several texts: those of known characters (and no contractions) are cut together over
        their bytes, and each distinct piece of the lot is looked up once."""
        plain = [i for i, t in enumerate(texts)
                 if t and _KNOWN.fullmatch(t) and _SPECIAL not in t and not _SHORT.search(t)]
        out = [None] * len(texts)
        for i, ids in zip(plain, self._cut([texts[i].encode() for i in plain]) if plain else ()):
            out[i] = ids
        return [self(t) if ids is None else ids for t, ids in zip(texts, out)]

    def _cut(self, raws: list[bytes]) -> list[bytes]:
        data = b"".join(raws)
        ends = np.cumsum([len(r) for r in raws])
        starts = ends - [len(r) for r in raws]
        b = np.frombuffer(data, np.uint8)
        kind = _CLASS[b]
        space = kind == 3
        before = np.concatenate([[False], space[:-1]])
        opened = np.zeros(len(b), bool)                    # first bytes of pieces
        opened[1:] = ~space[1:] & ~space[:-1] & (kind[1:] != kind[:-1])
        opened[1:] |= ~space[1:] & space[:-1] & (b[:-1] != 32)     # a blank goes with what follows it
        last = np.zeros(len(b), bool)                      # last white space of a run that a word follows
        last[:-1] = space[:-1] & ~space[1:]
        last[ends - 1] = False
        opened |= space & (~before | last)
        opened[starts] = True
        at = np.flatnonzero(opened)
        pieces = pa.StringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(b)).astype(np.int32)), pa.py_buffer(data))
        coded = pieces.dictionary_encode()
        known, ids = self.pieces, []
        for s in coded.dictionary.to_pylist():
            found = known.get(s)
            if found is None:
                found = self._piece(s)
                if len(known) < _CACHE_PIECES and len(s) < 48:
                    known[s] = found
            ids.append(found)
        width = 2 if self.code == "H" else 4
        values = np.frombuffer(b"".join(ids), f"<u{width}")
        count = np.array([len(x) for x in ids], np.int64) // width
        first = np.cumsum(count) - count
        index = coded.indices.to_numpy()
        n = count[index]
        stop = np.cumsum(n)
        tokens = values[np.repeat(first[index] - (stop - n), n) + np.arange(stop[-1])]
        bounds = np.append((stop - n)[np.searchsorted(at, starts)], stop[-1])
        return [tokens[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:])]


_IDS: dict[tuple, TextIds] = {}


def _shard(number: int, width: int, docs: list, ids: list[bytes]) -> pa.RecordBatch:
    known = np.array([d is not None for d in docs], "<u1")
    head = struct.pack("<8sIQ", SHARD_MAGIC, width, len(docs))
    body = b"".join([head, np.array([d or 0 for d in docs], "<i8").tobytes(), known.tobytes(),
                     np.array([len(x) // width for x in ids], "<u8").tobytes(), *ids])
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([body], pa.binary())], names=["shard", "raw"])


def _head(data) -> tuple[int, list, np.ndarray, int]:
    """(width, doc_ids, lengths, where the ids begin) of a payload file."""
    magic, width, n = struct.unpack_from("<8sIQ", data, 0)
    if magic != SHARD_MAGIC:
        raise ValueError("no payload file")
    ids, known = np.frombuffer(data, "<i8", n, 20), np.frombuffer(data, "<u1", n, 20 + 8 * n)
    return width, [i if k else None for i, k in zip(ids.tolist(), known)], np.frombuffer(data, "<u8", n, 20 + 9 * n), 20 + 17 * n


def _shard_batches(batches, path, width, shard_ids):
    """Payload files of a sorted partition of (doc_id, text); a file is closed at ``shard_ids`` ids."""
    from pyspark import TaskContext
    number = TaskContext.get().partitionId() << 20
    encoder = _IDS.get((path, width)) or _IDS.setdefault((path, width), TextIds(path, width))
    end = END_ID.to_bytes(width, "little")
    docs, ids, size = [], [], 0
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), batch.column(1)
        at, n = 0, batch.num_rows
        while at < n:
            lot, taken, start = [], 0, at
            while at < n and taken < _LOT_BYTES:
                lot.append(texts[at].as_py() or "")
                taken += len(lot[-1])
                at += 1
            for doc, got in zip(keys[start:at], encoder.lot(lot)):
                docs.append(doc)
                ids.append(got + end)
                size += len(ids[-1]) // width
                if size >= shard_ids:
                    yield _shard(number, width, docs, ids)
                    number, docs, ids, size = number + 1, [], [], 0
    if docs:
        yield _shard(number, width, docs, ids)


def _head_batches(batches):
    for batch in batches:
        for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            _, docs, lengths, _ = _head(content.as_buffer())
            n, lengths = len(docs), lengths.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array([shard] * n, pa.int64()), pa.array(np.arange(n)),
                 pa.array(np.cumsum(lengths) - lengths), pa.array(lengths)],
                names=["doc_id", "shard", "pos", "offset", "length"])


# -- minimal perfect hash ----------------------------------------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _cells(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Cell of each 128-bit key (two columns) in a level."""
    with np.errstate(over="ignore"):
        a = _mix(keys[:, 0] + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15))
        return (_mix(a ^ keys[:, 1]) % np.uint64(size)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys[:, 0] ^ (keys[:, 1] << np.uint64(1))) >> np.uint64(32)).astype(np.uint32)


def build_index(keys: np.ndarray, records: np.ndarray) -> bytes:
    """Bytes of an index part: distinct 128-bit ``keys`` (n, 2) and their ``records``."""
    n = len(keys)
    left, bits, sizes = np.arange(n), [], []
    slot, placed = np.empty(n, np.int64), 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(64, int(len(left) * LOAD) + 63 & ~63)
        cells = _cells(keys[left], level, size)
        alone = np.bincount(cells, minlength=size) == 1
        ok = alone[cells]
        slot[left[ok]] = placed + (np.cumsum(alone) - 1)[cells[ok]]
        placed += int(ok.sum())
        bits.append(np.packbits(alone, bitorder="little"))
        sizes.append(size)
        left = left[~ok]
    # What no level could part (equal digests to the last) is listed and searched.
    left = left[np.lexsort((keys[left, 1], keys[left, 0]))]
    slot[left] = placed + np.arange(len(left))
    out = np.zeros(n, RECORD)
    out[slot] = records
    ranks = np.cumsum([0, *(int(np.unpackbits(b).sum()) for b in bits)])
    words = np.concatenate([np.empty(0, "<u8"), *(b.view("<u8") for b in bits)])
    below = np.concatenate([[0], np.cumsum(np.bitwise_count(words))[:-1]]).astype("<u4") if len(words) else np.empty(0, "<u4")
    head = struct.pack("<8sIIII", MAGIC, n, len(sizes), len(left), int(ranks[-1]))
    return b"".join([head, np.array(sizes, "<u4").tobytes(), words.tobytes(), below.tobytes(),
                     np.ascontiguousarray(keys[left]).astype("<u8").tobytes(), out.tobytes()])


class Index:
    """One index part over its bytes (a memory map serves as well)."""

    def __init__(self, data):
        magic, self.n, levels, rest, self.ranked = struct.unpack_from("<8sIIII", data, 0)
        if magic != MAGIC:
            raise ValueError("no index part")
        at = 24
        take = lambda kind, count: np.frombuffer(data, kind, count, at)                     # noqa: E731
        self.sizes = take("<u4", levels)
        at += 4 * levels
        self.first = np.concatenate([[0], np.cumsum(self.sizes.astype(np.int64) // 64)])
        words = int(self.first[-1])
        self.words = take("<u8", words)
        at += 8 * words
        self.below = take("<u4", words)
        at += 4 * words
        self.rest = take("<u8", 2 * rest).reshape(rest, 2)
        at += 16 * rest
        self.records = take(RECORD, self.n)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, records) of 128-bit keys."""
        slot = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            cell = _cells(keys[left], level, int(size))
            word, bit = int(self.first[level]) + (cell >> 6), (cell & 63).astype(np.uint64)
            w = self.words[word]
            hit = (w >> bit) & np.uint64(1) == 1
            under = np.bitwise_count(w & ((np.uint64(1) << bit) - np.uint64(1)))
            slot[left[hit]] = (self.below[word] + under)[hit]
            left = left[~hit]
        for i in left if len(self.rest) else ():
            at = np.flatnonzero((self.rest == keys[i]).all(axis=1))
            slot[i] = self.ranked + at[0] if len(at) else -1
        got = np.zeros(len(keys), RECORD)
        known = slot >= 0
        got[known] = self.records[slot[known]]
        return known & (got["fp"] == fingerprints(keys)), got


def _digests(hexes) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(hexes)), ">u8").reshape(-1, 2).astype(np.uint64)


def _key_hex(doc_id, nth):
    """Digest of a document's key; a document without id has a key of its own kind."""
    return F.md5(F.concat(nth.cast("string"), F.coalesce(F.concat(F.lit(":"), doc_id.cast("string")), F.lit(""))).cast("binary"))


def _part_of(key_hex, parts: int):
    return F.pmod(F.conv(F.substring(key_hex, 1, 8), 16, 10).cast("long"), F.lit(parts)).cast("int")


# -- store -------------------------------------------------------------------------------------------

def _write_raw(df: DataFrame, path: str, by: str) -> None:
    """A file per row of ``df`` (``by``, raw): the bytes of ``raw`` and a zero byte."""
    (df.select(by, F.col("raw").cast("string").alias("value")).write.partitionBy(by)
     .option("lineSep", "\0").option("compression", "none").text(path))


def _raw(spark: SparkSession, path: str) -> DataFrame:
    """(N, content) of the files below ``path``, N as their folders name it."""
    return spark.read.format("binaryFile").load(path).drop("path", "modificationTime", "length")


class TokenStore:
    """A written store: lookups by key, in bulk as joins or one at a time from the driver."""

    def __init__(self, spark: SparkSession, path: str, width: int, parts: int, keys: DataFrame | None = None):
        self.spark, self.path, self.width, self.parts, self.keys = spark, path, width, parts, keys

    @staticmethod
    def open(spark: SparkSession, path: str) -> TokenStore:
        meta = spark.read.parquet(f"{path}/meta").first()
        return TokenStore(spark, path, meta["width"], meta["parts"])

    @staticmethod
    def write(docs: DataFrame, path: str, tokenizer: str, width: int = 2, shard_ids: int = SHARD_IDS) -> TokenStore:
        """Encode ``docs`` (doc_id, text) and write a store below ``path``.

        Documents ascend by doc_id (null first), rows of one id by where they are stored.  A null text
        is the end id alone.  ``width`` is 2 bytes for vocabularies below 65,536 ids, else 4.
        """
        spark = docs.sparkSession
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("rid", F.monotonically_increasing_id())
        size = plan_bytes(docs)                                    # beyond 2^50 the optimizer knows no size
        ranges = max(partitions(spark), size // RANGE_BYTES if size < 1 << 50 else 0)
        files = (rows.repartitionByRange(ranges, "doc_id", "rid").sortWithinPartitions("doc_id", "rid").select("doc_id", "text")
                 .mapInArrow(lambda it: _shard_batches(it, tokenizer, width, shard_ids), "shard long, raw binary"))
        _write_raw(files, f"{path}/payload", "shard")

        empty = not spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/payload").select("length").head(1)
        heads = "doc_id long, shard long, pos long, offset long, length long"
        found = freeze(spark.createDataFrame([], heads) if empty else _raw(spark, f"{path}/payload")
                       .select(F.col("shard").cast("long"), "content").mapInArrow(_head_batches, heads), "token-heads")
        sums = freeze(found.groupBy("shard").agg(F.sum("length").alias("n_ids"), F.count(F.lit(1)).alias("n_docs")), "token-sums")
        based = prefix_sums(sums, ["shard"], "n_ids", "token-ids-before").select("shard", F.col("before").alias("base"), "n_ids", "n_docs")
        ahead = prefix_sums(sums.select("shard", "n_docs"), ["shard"], "n_docs", "token-docs-before").select("shard", F.col("before").alias("docs_before"))
        based.join(ahead, "shard").write.parquet(f"{path}/shards")
        # Rows of one id count from its first; a hot id is a skewed side that Spark may split.
        placed = found.join(spark.read.parquet(f"{path}/shards").select("shard", "docs_before"), "shard") \
            .withColumn("row", F.col("docs_before") + F.col("pos")).drop("docs_before", "pos")
        again = placed.groupBy(F.col("doc_id").alias("of")).agg(F.min("row").alias("r0"), F.count(F.lit(1)).alias("c")).where("c > 1")
        keyed = freeze(placed.join(again, F.col("doc_id").eqNullSafe(F.col("of")), "left")
                       .withColumn("nth", F.col("row") - F.coalesce("r0", "row")).drop("of", "r0", "c", "row"), "token-keys")

        total = keyed.count()
        parts = max(2 * partitions(spark), -(-total // KEYS_PER_PART))
        located = (keyed.select(_key_hex(F.col("doc_id"), F.col("nth")).alias("key"), "shard", "offset", "length")
                   .withColumn("part", _part_of(F.col("key"), parts)))

        def index(pdf: pd.DataFrame) -> pd.DataFrame:
            keys, rec = _digests(pdf["key"]), np.zeros(len(pdf), RECORD)
            rec["fp"] = fingerprints(keys)
            for c in ("shard", "offset", "length"):
                rec[c] = pdf[c]
            return pd.DataFrame({"part": [pdf["part"].iloc[0]], "raw": [build_index(keys, rec)]})

        made = located.groupBy("part").applyInPandas(index, "part int, raw binary")
        _write_raw(made, f"{path}/index", "part")
        spark.range(1).select(F.lit(width).alias("width"), F.lit(parts).cast("int").alias("parts")).write.parquet(f"{path}/meta")
        return TokenStore(spark, path, width, parts, keyed.select("doc_id", "nth"))

    def shards(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/shards")

    def locate(self, keys: DataFrame) -> DataFrame:
        """``keys`` (doc_id, nth) that the store has, with shard, offset and length, read from the index
        files alone."""
        asked = keys.select("doc_id", "nth").withColumn("key", _key_hex(F.col("doc_id"), F.col("nth"))) \
            .withColumn("part", _part_of(F.col("key"), self.parts))

        def look(asked: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
            names = ["doc_id", "nth", "shard", "offset", "length"]
            if not len(asked) or not len(parts):
                return pd.DataFrame({c: pd.Series(dtype="Int64") for c in names})
            found, rec = Index(parts["content"].iloc[0]).find(_digests(asked["key"]))
            out = asked[["doc_id", "nth"]].astype("Int64")
            for c in names[2:]:
                out[c] = rec[c].astype(np.int64)
            return out[found]

        return (asked.groupBy("part").cogroup(_raw(self.spark, f"{self.path}/index").groupBy("part"))
                .applyInPandas(look, "doc_id long, nth long, shard long, offset long, length long"))

    def read(self, keys: DataFrame) -> DataFrame:
        """``locate`` with the ids themselves (binary, little-endian unsigned 32-bit) cut from the payload,
        and ``start``: the ids of all documents before."""
        width = self.width

        def cut(rows: pd.DataFrame, files: pd.DataFrame) -> pd.DataFrame:
            names = ["doc_id", "nth", "shard", "offset", "length", "ids"]
            if not len(rows) or not len(files):
                return pd.DataFrame({c: pd.Series(dtype=object if c == "ids" else "Int64") for c in names})
            data = files["content"].iloc[0]
            ids = np.frombuffer(data, f"<u{width}", int(_head(data)[2].sum()), _head(data)[3])
            out = rows[names[:-1]].copy()
            out["doc_id"] = out["doc_id"].astype("Int64")
            out["ids"] = [ids[o:o + n].astype("<u4").tobytes() for o, n in zip(rows["offset"], rows["length"])]
            return out

        files = _raw(self.spark, f"{self.path}/payload").withColumn("shard", F.col("shard").cast("long"))
        got = (self.locate(keys).groupBy("shard").cogroup(files.groupBy("shard"))
               .applyInPandas(cut, "doc_id long, nth long, shard long, offset long, length long, ids binary"))
        return got.join(self.shards().select("shard", "base"), "shard").select(
            "doc_id", "nth", (F.col("base") + F.col("offset")).alias("start"), F.col("length").alias("n_tokens"), "ids")

    def get(self, doc_id: int | None, nth: int = 0) -> list[int] | None:
        """Ids of one document (with its end id), or None: two files are opened, whatever the store's
        size, and of the payload only the document is read."""
        import hashlib
        key = hashlib.md5(f"{nth}{'' if doc_id is None else f':{doc_id}'}".encode()).hexdigest()
        part = int(key[:8], 16) % self.parts
        data = self._bytes(f"{self.path}/index/part={part}")
        if data is None:
            return None
        found, rec = Index(data).find(_digests([key]))
        if not found[0]:
            return None
        r = rec[0]
        folder = f"{self.path}/payload/shard={r['shard']}"
        at = 20 + 17 * struct.unpack("<Q", self._bytes(folder, 12, 8))[0]
        raw = self._bytes(folder, at + int(r["offset"]) * self.width, int(r["length"]) * self.width)
        return np.frombuffer(raw, f"<u{self.width}").tolist()

    def _bytes(self, folder: str, at: int = 0, length: int | None = None) -> bytes | None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(folder)
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            return None
        file = next(s for s in fs.listStatus(p) if s.getPath().getName().startswith("part-"))
        stream = fs.open(file.getPath())
        try:
            stream.seek(at)
            return bytes(stream.readNBytes(int(file.getLen()) - at if length is None else length))
        finally:
            stream.close()


def stored_ids(docs: DataFrame, path: str, tokenizer: str, width: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per row of ``docs``, from a store written below ``path`` and
    read back by key.

    A null or empty text is the end id alone; rows of one doc_id (or without) are documents of their
    own; other columns are ignored; an empty table gives an empty store and no rows.
    """
    docs = docs.select("doc_id", "text")
    store = TokenStore.write(docs, path, tokenizer, width)
    if not store.keys.head(1):
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return store.read(store.keys).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
