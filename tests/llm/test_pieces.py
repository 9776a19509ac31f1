"""SentencePiece operator against the library on whole texts."""

import random

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from eventfeat.llm import pieces
from eventfeat.llm.queries import QUERIES
from tests.llm.helpers import SCHEMA, awkward_docs, rows_of, sha


def proto(rule=None, **spec):
    """The given model, with the character map of a rule and other settings."""
    model = pb.ModelProto()
    model.ParseFromString(open(pieces.default_model(), "rb").read())
    if rule:
        part = pb.ModelProto()
        part.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        model.normalizer_spec.CopyFrom(part.normalizer_spec)
    for k, v in spec.items():
        setattr(model.normalizer_spec, k, v)
    return model.SerializeToString()


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    alphabet = "aab  ▁▁\n\t é中🙂ﬁＡ\x00<s>xyz①ｶﾞéㅎ"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)] + [
        "", " ", " " * 70, "▁" * 33, "the " * 5000, "x" * 3000, "<s></s><unk><0x41>", "　Ａ  ", "中" * 500]


@pytest.mark.parametrize("rule", [None, "nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("prefix", [False, True])
def test_ids_and_spans_equal_the_library(rule, squeeze, prefix):
    data = proto(rule, remove_extra_whitespaces=squeeze, add_dummy_prefix=prefix, escape_whitespaces=True)
    lib, texts = sentencepiece.SentencePieceProcessor(model_proto=data), odd_texts(600)
    for text, (ids, starts, stops) in zip(texts, pieces.PieceEncoder(data).encode(texts)):
        want = lib.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in want]
        for p, a, b in zip(want, starts.tolist(), stops.tolist()):
            assert p.piece.startswith("<0x") or (p.begin, p.end) == (a, b)
        assert starts.tolist()[1:] == stops.tolist()[:-1]


def test_alignment_equals_the_library():
    data = proto("nmt_nfkc")
    enc, lib = pieces.PieceEncoder(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in odd_texts(500, 3):
        norm, align = enc.normalise(text.encode())
        assert norm.decode() == lib.normalize(text) and len(align) == len(norm) + 1


def test_unknown_pieces_without_byte_fallback():
    model = pb.ModelProto()
    model.ParseFromString(proto())
    model.trainer_spec.byte_fallback = False
    for p in model.pieces:
        if p.type == pb.ModelProto.SentencePiece.BYTE:
            p.type, p.piece = pb.ModelProto.SentencePiece.UNUSED, f"{p.piece}"
    data = model.SerializeToString()
    lib, texts = sentencepiece.SentencePieceProcessor(model_proto=data), odd_texts(300, 5)
    for text, (ids, starts, stops) in zip(texts, pieces.PieceEncoder(data).encode(texts)):
        want = lib.encode(text, return_type="proto").pieces
        assert [(p.id, p.begin, p.end) for p in want] == list(zip(ids.tolist(), starts.tolist(), stops.tolist()))


def test_spans_rebuild_the_text(spark):
    rows = [(k, t) for k, t in enumerate(odd_texts(100, 7))]
    for r in pieces.encode_pieces(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        raw = rows[r.doc_id][1].encode()
        assert b"".join(raw[a:b] for a, b in zip(r.starts, r.stops)) == raw


def test_whole_query_on_awkward_rows(spark, tmp_path):
    rows = [*awkward_docs(), *((1000 + k, t, "en", "s", len(t)) for k, t in enumerate(odd_texts(80, 9)))]
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS ids", "'x' AS decoded").write.parquet(f"{tmp_path}/documents.parquet")
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    want = []
    for doc_id, text, *_ in rows:
        ids = lib.encode(text or "")
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)), len((text or "").encode())))
    got = QUERIES["op13_sentencepiece_encoding"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "span_bytes"]
    assert rows_of(got) == sorted(want, key=repr)


def test_empty_table_and_null_ids(spark):
    assert pieces.piece_digest(pieces.encode_pieces(spark.createDataFrame([], "doc_id long, text string"))).count() == 0
    got = pieces.decode_pieces(spark.createDataFrame([(1, None), (2, []), (3, [306, 29])], "k long, ids array<int>"))
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    assert rows_of(got) == [(1, ""), (2, ""), (3, lib.decode([306, 29]))]
