import hashlib
import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from beaconflow.llm import bpe
from beaconflow.llm.bpe import Encoder, Vocabulary, decode, encode, token_digests
from tests.llm import brute

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(4)
    pools = ["ab", "the re'll ", " \t\n\x0b\x85\xa0 ", "0123456789²½Ⅷ", "éüñßçÀЖ", "!?.,<|>endoftext", "漢字かな한글", "\x00\x1c\x1d\x1f\x7f﻿", "🙂👍🏽‍", "''s't've", "՘\U0003fc3f࢏"]
    for _ in range(400):
        yield "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(1, 60)))
    yield from ("", " ", "<|endoftext|>", "a<|endoftext|> b  <|endoftext|><|endoftext|>  ", "<|endoftext", "don't  won't\n\n  x", "a" * 5000, " " * 3000 + "x", "ab" * 4000, "\n" * 999)


@pytest.mark.parametrize("memory, slab", [(bpe.MEMORY, bpe.SLAB), (300, 40)])
def test_encodes_as_the_library_does(vocabulary, library, monkeypatch, memory, slab):
    """Also with a memory that is turned over often and texts of many slabs."""
    monkeypatch.setattr(bpe, "MEMORY", memory)
    monkeypatch.setattr(bpe, "SLAB", slab)
    encoder, texts = Encoder(vocabulary), list(odd_texts())
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(encoder) <= memory and all(len(piece) <= bpe.LONG for piece in encoder)
    assert list(encoder.encode([])) == []


def test_every_code_point(vocabulary, library):
    encoder = Encoder(vocabulary)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 16384):
        text = " ".join(f"a{c}1" for c in points[i : i + 16384])
        assert next(encoder.encode([text])).tolist() == library.encode(text, add_special_tokens=False).ids


def test_whole_table(spark, vocabulary, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {}
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), brute.digest(",".join(map(str, ids))), brute.digest(library.decode(ids, skip_special_tokens=False)))
    assert {r.doc_id: tuple(r)[1:4] for r in token_digests(docs, vocabulary).collect()} == want


def test_edge_cases(spark, vocabulary, library):
    long = " ".join(f"wörd{i}" for i in range(200_000))
    rows = [(1, None, 5), (2, "", 5), (None, "a b", 5), (3, "a b", 5), (3, "a b", 5), (4, long, 5)]
    out = encode(spark.createDataFrame(rows, "doc_id long, text string, tokens int"), vocabulary)
    got = [(r.doc_id, r.tokens) for r in out.collect()]
    ids = lambda t: library.encode(t, add_special_tokens=False).ids
    assert got == [(1, []), (2, []), (None, ids("a b")), (3, ids("a b")), (3, ids("a b")), (4, ids(long))]
    back = [r.decoded for r in decode(out, vocabulary).collect()]
    assert back == ["", "", "a b", "a b", "a b", long]
    assert encode(spark.createDataFrame([], "text string"), vocabulary).collect() == []
    empty = token_digests(spark.createDataFrame([(1, None)], "doc_id long, text string"), vocabulary).first()
    assert empty.ids_sha256 == empty.decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_decodes_any_ids(spark, vocabulary, library):
    rng = random.Random(8)
    lists = [[rng.randrange(50257) for _ in range(rng.randrange(30))] for _ in range(300)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, tokens array<int>")
    got = {r.i: r.decoded for r in decode(df, vocabulary).collect()}
    assert got == {i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(lists)}
    odd = spark.createDataFrame([(0, None), (1, [-5, 10**6, None])], "i int, tokens array<int>")
    assert [r.decoded for r in decode(odd, vocabulary).collect()] == ["", ""]


def test_other_tokenizers_are_refused(tmp_path):
    spec = json.load(open(PATH))
    for part, value in (("normalizer", {"type": "NFC"}), ("pre_tokenizer", {"type": "Whitespace"})):
        path = tmp_path / f"{part}.json"
        path.write_text(json.dumps(spec | {part: value}))
        with pytest.raises(ValueError):
            Vocabulary(str(path))
