"""SentencePiece: equal to the library on whole texts, spans that cover the original, any character map."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from tallyhouse.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "a", "a  b\tc\n\n d ", "▁x ▁", "日本語 🙂👩‍👩‍👧 é", "\u0000\u0001x", "ﬁ Å　wide", "the " * 4000,
         "x" * 20000, "<s> </s> <unk> <0x41>", "Ünïcödé ñandú", "the the\nthe"]


def _bytes():
    with open(MODEL, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def whole():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_ids_and_spans(whole):
    own = pieces.Pieces(_bytes())
    for text, (ids, begins, ends) in zip(TEXTS, own.encode(TEXTS), strict=True):
        assert ids.tolist() == whole.encode(text)
        assert own.decode(ids) == whole.decode(whole.encode(text))
        data = text.encode()
        if len(ids):
            assert begins[0] == 0 and ends[-1] == len(data)
            assert (begins[1:] == ends[:-1]).all()
            assert b"".join(data[b:e] for b, e in zip(begins, ends, strict=True)) == data


def _with(rule, **spec):
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(_bytes())
    made = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    table = sentencepiece_model_pb2.ModelProto()
    table.ParseFromString(made.serialized_model_proto())
    proto.normalizer_spec.precompiled_charsmap = table.normalizer_spec.precompiled_charsmap
    for name, value in spec.items():
        setattr(proto.normalizer_spec, name, value)
    return proto.SerializeToString()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_compiled_map(rule, squeeze):
    model = _with(rule, remove_extra_whitespaces=squeeze)
    own, lib = pieces.Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    assert own.map.units
    for text in TEXTS:
        text = text[:2000]
        norm, origin = own.normalise(text)
        assert norm == lib.normalize(text)
        assert len(origin) == len(norm.encode()) + 1
        assert (np.diff(origin) >= 0).all() and (origin <= len(text.encode())).all()
        ids, begins, ends = next(own.encode([text]))
        assert ids.tolist() == lib.encode(text)


def test_offsets_of_a_rule():
    own = pieces.Pieces(_with("nmt_nfkc"))
    norm, origin = own.normalise("ﬁx")
    assert norm == "▁fix"
    # The prefix and both letters of the ligature come from its first byte, x from the fourth.
    assert origin.tolist() == [0, 0, 0, 0, 0, 3, 4]


def test_query(spark, whole):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([*TEXTS, None, "twice", "twice"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, ids string, n_chars int")
    got = {r["doc_id"]: r for r in pieces.query(docs, MODEL).collect()}
    for i, text, *_ in rows:
        ids = whole.encode(text or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(whole.decode(ids).encode()).hexdigest()
    full = pieces.encode(docs, MODEL)
    assert full.columns == ["doc_id", "text", "lang", "n_chars", "ids", "begins", "ends"]
    assert {r["doc_id"]: list(r["ids"]) for r in full.collect()} == {i: whole.encode(t or "") for i, t, *_ in rows}
    back = pieces.decode(pieces.encode(docs, MODEL, spans=False).selectExpr("doc_id", "ids"), MODEL)
    assert {r["doc_id"]: r["decoded"] for r in back.collect()} == {i: whole.decode(whole.encode(t or "")) for i, t, *_ in rows}
    assert pieces.encode(docs.limit(0), MODEL).count() == 0
    assert pieces.query(docs.limit(0), MODEL).count() == 0
