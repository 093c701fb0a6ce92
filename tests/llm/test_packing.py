import zlib
from collections import defaultdict

import numpy as np
import pytest

from logroll.llm import packing
from logroll.llm.common import prepare
from tests.llm.helpers import AWKWARD, docs_frame, sentence

P = pytest.importorskip("public_tokenizers")


def corpus():
    rows = [(i, sentence(20 + (i * 37) % 700, i)) for i in range(150)]
    rows += [(200, sentence(9000, 200)), (201, "café l’été <|endoftext|> it's 42  x\x1cy Ünï"), *AWKWARD]
    return rows


def ids_of(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    return t.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("parts", [1, 5])
def test_pieces_cover_every_id_once(spark, parts):
    prepare(spark)
    rows = corpus() + [(300, "twice")] * 2
    got = packing.pack(docs_frame(spark, rows).repartition(parts), P.path("word_bpe_49k.json")).collect()
    by_seq = defaultdict(list)
    for r in got:
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        raw = bytes(r["ids"])
        assert len(raw) == 4 * r["length"] and zlib.crc32(raw) == r["ids_crc32"]
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
        padding += 0 if at & (at - 1) == 0 else packing.LENGTH - at
    total = sum(r["length"] for r in got)
    assert padding <= 0.01 * total
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    for d, t in rows:
        want = ids_of(t)
        mine = sorted(pieces[d], key=lambda r: r["start"])
        if d == 300:
            assert [r["length"] for r in mine] == [len(want)] * 2
            continue
        assert np.concatenate([np.frombuffer(bytes(r["ids"]), "<u4") for r in mine]).tolist() == want
        assert all(r["doc_tokens"] == len(want) for r in mine)
        at = 0
        for r in mine:
            assert r["start"] == at
            at += r["length"]


def test_without_ids_and_empty(spark):
    prepare(spark)
    got = packing.pack(docs_frame(spark, [(1, None), (2, "")]), P.path("word_bpe_49k.json"), with_ids=False).collect()
    assert sorted((r["doc_id"], r["length"], r["ids"]) for r in got) == [(1, 1, None), (2, 1, None)]
    assert packing.pack(docs_frame(spark, []), P.path("word_bpe_49k.json")).collect() == []


@pytest.mark.parametrize("room", [0, 3, 1000])
def test_ids_of_words_that_found_no_room(monkeypatch, room):
    """Words beyond a full cache are looked up beside it, and plain words take the short way to the same ids."""
    monkeypatch.setattr(packing, "_CACHE_WORDS", room)
    monkeypatch.setattr(packing, "_CACHE_RUNS", room)
    tokens = packing.WordTokens(P.path("word_bpe_49k.json"))
    texts = ["Plain WORDS here, Здесь naïve ÀÉ a,b... x1 (ok) <s> it's " + "z" * 300, "", "Plain again, words! naïve", "𝔘 ﬁ K İ"]
    for _ in range(2):
        got = tokens([t.encode() for t in texts])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids_of(t) for t in texts]
    assert room or not isinstance(tokens.words.extra.get(b"again,"), type(None))


def test_a_lot_looks_each_word_up_once():
    class Counted(packing._Known):
        asked = 0

        def get(self, word):
            self.asked += 1
            return super().get(word)

    tokens = packing.WordTokens(P.path("word_bpe_49k.json"))
    tokens.words = Counted(tokens.words)
    texts = ["the cat, " * 400, "\x0b cat,\x0c\x1cthe the\x85x  ", "", "the"]
    for _ in range(2):
        got = tokens([t.encode() for t in texts])
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [ids_of(t) for t in texts]
    assert 0 < tokens.words.asked <= 2 * 5          # the; cat,; two odd ones; nothing, beside white space
    assert tokens([]) == []
