import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from derrick.llm import packing, token_files
from derrick.llm.encode import Encoder, tokenizer_file
from tests.llm.conftest import EDGE, EDGE_IDS, make

ODD = ["a  b   c\n\n d", " lead", "trail \n ", "tab\there", "x y  z", "don't we'll I'M", "12 345,6 ½²",
       "日本語 テキスト", "a<|endoftext|>b <|startoftext|> c", "é ﬁ ΑΣ ", "\x1c odd \x85 space", "", "\n", "  "]


def plain(name, texts):
    t = Tokenizer.from_file(tokenizer_file(name))
    return [np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


@pytest.mark.parametrize("name", [token_files.TOKENIZER, packing.TOKENIZER])
def test_encoder_equals_the_library(name, sample, monkeypatch):
    texts = ODD + EDGE + [r.text for r in sample[0][:60]]
    expected = plain(name, texts)
    enc = Encoder(name)
    assert enc.ids(texts) == expected and enc.ids(texts) == expected
    monkeypatch.setattr("derrick.llm.encode.CACHE", 10)
    assert Encoder(name).ids(texts) == expected


def order(i, th):
    return (i is not None, i or 0, th)


def test_token_files_round_trip(spark, sample, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_IDS", 3000)
    rows, df = sample
    at, expected = 0, []
    for r, ids in zip(rows, plain(token_files.TOKENIZER, [r.text for r in rows])):
        ids += (2).to_bytes(4, "little")
        expected.append((r.doc_id, at, len(ids) // 4, zlib.crc32(ids), ids))
        at += len(ids) // 4
    got = sorted(tuple(r) for r in token_files.round_trip(df.repartition(5)).collect())
    assert [(*r[:4], bytes(r[4])) for r in got] == expected


def test_token_files_edges(spark):
    got = token_files.round_trip(make(spark, EDGE, EDGE_IDS)).orderBy("start").collect()
    assert sorted(bytes(r.ids) for r in got) == sorted(x + b"\2\0\0\0" for x in plain(token_files.TOKENIZER, EDGE))
    assert [r.doc_id for r in got] == sorted(EDGE_IDS, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    assert token_files.round_trip(make(spark, [])).count() == 0


@pytest.mark.parametrize("edges", [False, True])
def test_packing(spark, sample, edges):
    texts = EDGE if edges else [r.text for r in sample[0]]
    ids = EDGE_IDS if edges else [r.doc_id for r in sample[0]]
    df = make(spark, texts, ids).repartition(4)
    got = packing.pack(df).collect()
    size = {}
    for r in got:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        size.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(size) == list(range(len(size)))
    for k, pieces in size.items():
        ends = [0] + [a + n for a, n in sorted(pieces)]
        assert [a for a, _ in sorted(pieces)] == ends[:-1]
        assert ends[-1] == 2048 or k == len(size) - 1 and ends[-1] <= 2048
    # pieces of a document joined are its ids (documents of equal ids are told apart by content)
    expected = sorted((str(i), x + b"\1\0\0\0") for i, x in zip(ids, plain(packing.TOKENIZER, texts)))
    flow = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    joined, at = [], None
    for r in flow:
        if r.start == 0:
            joined.append([str(r.doc_id), b"", r.doc_tokens])
        joined[-1][1] += bytes(r.ids)
    assert sorted((i, x) for i, x, n in joined) == expected and all(len(x) == 4 * n for _, x, n in joined)


def test_packing_pads_unless_a_power_of_two(spark):
    texts = ["one"] * 4                                  # 4 x (1 id + end) = 8
    assert {r.padded_tokens for r in packing.pack(make(spark, texts)).collect()} == {8}
    assert {r.padded_tokens for r in packing.pack(make(spark, texts[:3])).collect()} == {2048}
    assert packing.pack(make(spark, [])).count() == 0
