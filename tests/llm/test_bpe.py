"""Byte-level BPE: ids as the tiktoken library gives them, exact round trip, defined cases."""

import base64
import hashlib

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from shortfall.llm import bpe

TEXTS = [
    "", None, " ", "\n\n  x", "It's we'll  they'd\tgo\r\n", "Äpfel & Öl: 3.14 €", "日本語のテキスト", "🙂👩‍👩‍👧 ok",
    "  ​﻿\x00\x1c", "<|endoftext|><unk><s>▁", "a" * 3000, "wort " * 70_000, "x́y" * 40,
    "def f(x):\n    return x ** 2\n\n\n", "Āǿ" * 5,
]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def model(ranks):
    return bpe.ByteBPE(ranks, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_rows_equal_the_library(spark, model, library):
    rows = [(i, t, "clash", "clash") for i, t in enumerate(TEXTS)] + [(None, "ab ab", "c", "c")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string")
    want = []
    for doc, text, _, _ in rows:
        ids = library.encode_ordinary(text or "")
        joined = ",".join(map(str, ids)).encode()
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        want.append((doc, len(ids), hashlib.sha256(joined).hexdigest(), digest))
    got = bpe.digests(bpe.encoded(docs, model))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert bpe.digests(bpe.encoded(docs.limit(0), model)).count() == 0


def test_whole_table_equals_the_library(spark, model, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for row in bpe.encoded(docs, model).join(docs, "doc_id").collect():
        assert row.ids == library.encode_ordinary(row.text)
        assert bytes(row.decoded) == row.text.encode()


def test_every_code_point_equals_the_library(model, library):
    worker = model.worker()
    for start in range(0, 0x110000, 4096):
        text = " ".join(f"a{chr(c)}b1{chr(c)}{chr(c)}2 {chr(c)} {chr(c)}x" for c in range(start, start + 4096) if not 0xD800 <= c < 0xE000)
        assert worker.encode(text) == library.encode_ordinary(text)


def test_pieces_do_not_change_ids(model, library, monkeypatch):
    worker = model.worker()
    monkeypatch.setattr(worker, "group_length", 50)
    monkeypatch.setattr(worker, "cached", 20)
    texts = [t or "" for t in TEXTS]
    for group in (texts, texts[::-1], [], [""]):
        assert [i.tolist() for i in worker.encode_all(group)] == [library.encode_ordinary(t) for t in group]
    pieces = [p for g in bpe.grouped(texts, 50) for p in g]
    assert "".join(p for p, _ in pieces) == "".join(texts) and sum(last for _, last in pieces) == len(texts)


def test_tokens_that_merges_do_not_reach(tmp_path):
    """A pre-token of the vocabulary is its token; ranks with gaps keep their values."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"abcd": 301, b"ab": 302}
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    assert bpe.read_ranks(str(path)) == ranks
    worker = bpe.ByteBPE(ranks, public_tokenizers.PATTERN).worker()
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "abcde", "abcabc ab", "bcd"):
        assert worker.encode(text) == library.encode_ordinary(text)
        assert worker.decode(worker.encode(text)) == text.encode()
    assert worker.encode("abcd") == [301]
    with pytest.raises(KeyError):
        worker.decode([299])


def test_vocabulary_without_a_byte_or_with_equal_ranks():
    with pytest.raises(ValueError):
        bpe.ByteBPE({b"a": 0}, public_tokenizers.PATTERN)
    with pytest.raises(ValueError):
        bpe.ByteBPE({bytes([b]): 0 for b in range(256)}, public_tokenizers.PATTERN)


def test_serialised_model_is_a_plain_bpe_model(model):
    parsed = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto.FromString(model.model)
    assert parsed.trainer_spec.model_type == 2 and parsed.trainer_spec.unk_id == len(model.tokens)
    assert parsed.normalizer_spec.name == "identity" and not parsed.normalizer_spec.add_dummy_prefix
    assert [p.score for p in parsed.pieces[:3]] == [0, -1, -2]
    loaded = sentencepiece.SentencePieceProcessor(model_proto=model.model)
    assert loaded.get_piece_size() == len(model.tokens) + 1


def test_null_ids_decode_to_nothing(spark, model):
    rows = spark.createDataFrame([(None,), ([],), (model.worker().encode("so"),)], "ids array<int>")
    got = [bytes(r[0]) for r in rows.select(bpe.decode(model, F.col("ids"))).collect()]
    assert got == [b"", b"", b"so"]


def test_each_text_is_encoded_once(spark):
    """The ids and the bytes they decode to come from one call on the text, not from two."""
    docs = spark.createDataFrame([(1, "one text"), (2, None), (3, "")], "doc_id long, text string")
    model = bpe.ByteBPE({bytes([b]): b for b in range(256)}, r"\s+|\S+")
    out = bpe.encoded(docs, model)
    plan = bpe.digests(out)._jdf.queryExecution().executedPlan().toString()
    calls = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert len(calls) == 1 and calls[0].count("(text#") == 1
    got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in out.collect()}
    assert got == {1: (list(b"one text"), b"one text"), 2: ([], b""), 3: ([], b"")}
