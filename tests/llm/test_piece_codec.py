"""Encoding, spans and decoding against the sentencepiece library."""
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from conftest import SF0001
from loomtext.llm import piece_codec, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def digests(text):
    ids = LIBRARY.encode(text, add_bos=True, add_eos=True)
    spans = [(p.begin, p.end) for p in LIBRARY.encode(text, return_type="proto").pieces]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(LIBRARY.decode(ids).encode()), len(text.encode()),
            zlib.crc32(np.array(spans, "<u4").reshape(-1, 2).tobytes()))


def strings(seed, n):
    pick = random.Random(seed)
    signs = [*"abcdeth  ▁\n\t.é😀執န\x00<s>0123'", "　", "the", "ing", "한", "<0x41>", "</s>", "\U0010ffff", "ﬁ", "Ａ①", "é"]
    return ["".join(pick.choice(signs) for _ in range(pick.randrange(60))) for _ in range(n)]


def test_given_documents(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_piece_codec(spark, SF0001).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    assert got == {d: digests(t) for d, t in texts.items()}


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "x" * 30000), (4, "x" * 30000), (None, "no id"), (5, "word " * 20000), (6, "<s> </s> <unk>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x")).withColumn("n_tokens", F.lit(1))
    got = sorted((tuple(r) for r in piece_codec.round_trip(docs, PATH).collect()), key=repr)
    assert got == sorted([(d, *digests(t or "")) for d, t in rows], key=repr)
    encoded = piece_codec.encode_spans(docs, PATH)
    back = {r.doc_id: r.text for r in piece_codec.decode_ids(encoded, PATH).collect()}
    assert back == {d: t or "" for d, t in rows}
    one = next(r for r in encoded.collect() if r.doc_id is None)
    assert ["no id"[a:b] for a, b in zip(one.starts, one.ends)] == ["no", " id"]
    assert piece_codec.round_trip(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("kept", [600_000, 40])
def test_ids_and_spans_of_any_text(monkeypatch, kept):
    monkeypatch.setattr(piece_codec, "KEPT_UNITS", kept)
    with open(PATH, "rb") as f:
        codec = piece_codec.PieceCodec(f.read())
    for seed in range(20):
        texts = strings(seed, 40)
        for text, (ids, offsets) in zip(texts, codec.encode(texts)):
            pieces = LIBRARY.encode(text, return_type="proto").pieces
            assert ids.tolist() == [p.id for p in pieces]
            assert list(zip(*map(list, codec.spans(ids, offsets)))) == [(p.begin, p.end) for p in pieces]
            assert codec.decode(ids) == LIBRARY.decode([p.id for p in pieces])


def field(number, blob):
    size, out = len(blob), b""
    while True:
        out += bytes([size & 127 | (128 if size > 127 else 0)])
        size >>= 7
        if not size:
            return bytes([number << 3 | 2]) + out + blob


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf"])
def test_compiled_character_map(rule):
    """Another normaliser put into the model: text, offsets, ids and spans are the library's."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    with open(PATH, "rb") as f:
        fields = list(piece_codec._message(f.read()))
    model = b"".join(field(k, v) for k, v in fields if k != 3) + field(3, library.serialized_normalizer_spec())
    codec = piece_codec.PieceCodec(model)
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = strings(5, 300) + ["Ⅷ ½ ㍿ ＡＢＣ  ", "ÀÉ ǅ ﷺ", "a­b ​ c", "ｶﾞ ﾊﾟ"]
    for text, (ids, offsets) in zip(texts, codec.encode(texts)):
        pieces = processor.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in pieces], text
        assert list(zip(*map(list, codec.spans(ids, offsets)))) == [(p.begin, p.end) for p in pieces], text
        assert codec.decode(ids) == processor.decode([p.id for p in pieces])
