"""The rebuilt tokenizer against the sentencepiece library."""

import numpy as np
import pyarrow as pa
import sentencepiece
import zlib
from pyspark.sql import functions as F

from slotloom.llm import pieces
from slotloom.llm.tokens import default_path

TEXTS = [
    None, "", " ", "  ", "a", " a", "a  b   c ", "line\nbreak\ttab\r\n", "naïve café ŉ ☃ 漢字 \U0001F600", "x" * 3000, "▁ mark ▁▁", "aaaa aaaaa aaaaaaa",
    "if (x == 1) { return y; }    // ok", "Der schnelle Fuchs, el zorro", "\u0000 nul", "word " * 2000,
]


def test_against_the_other_library(spark):
    other = sentencepiece.SentencePieceProcessor(model_file=default_path("piece_bpe_32k.model"))
    df = spark.createDataFrame([(None if i == 5 else i, t, 1, "k") for i, t in enumerate(TEXTS)], "doc_id int, text string, n_tokens int, ids string").repartition(2)
    got = pieces.encode(df).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        text = TEXTS[5 if r.row.doc_id is None else r.row.doc_id] or ""
        want = other.encode(text)
        assert r.ids == want and r.n_tokens == len(want) and r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        assert r.parity and (r.round_trip or "▁" in text)
    back = pieces.decode(pieces.encode(df).select("row.doc_id", "ids")).collect()
    assert all(r.text == (TEXTS[5 if r.doc_id is None else r.doc_id] or "").replace("▁", " ") for r in back)
    assert pieces.encode(df.where(F.lit(False))).count() == 0


def unigram_model(strip: bool):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.trainer_spec.model_type, proto.trainer_spec.byte_fallback, proto.trainer_spec.unk_id = pieces.UNIGRAM, True, 0
    proto.normalizer_spec.name, proto.normalizer_spec.add_dummy_prefix, proto.normalizer_spec.remove_extra_whitespaces = "identity", True, strip
    for piece, score, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [(f"<0x{b:02X}>", 0, 6) for b in range(256)] + [
            (p, -1.0 - i / 7, 1) for i, p in enumerate(["▁", "a", "b", "ab", "▁a", "▁ab", "ba", "abab", "▁b", "bb"])]:
        proto.pieces.add(piece=piece, score=score, type=kind)
    return proto


def test_unigram_with_byte_fallback(tmp_path):
    for strip in (False, True):
        path = tmp_path / f"unigram{strip}.model"
        path.write_bytes(unigram_model(strip).SerializeToString())
        other = sentencepiece.SentencePieceProcessor(model_file=str(path))
        texts = ["abab ba", "", "a  b", " ab ", "abc é", "bbbbabababa", "z"]
        codec = pieces.Codec(str(path))
        ids, offsets, parity, _ = next(codec.encode(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == other.encode(texts)
        assert codec.by_chunk == (not strip) and parity.all()


def test_a_wrong_rebuild_shows_in_ids_and_parity(tmp_path):
    """Ids come from the rebuilt model: one piece too few, and other ids and a false parity come out."""
    path = tmp_path / "m.model"
    path.write_bytes(unigram_model(False).SerializeToString())
    codec, texts = pieces.Codec(str(path)), pa.array(["abab ba", "bb", "z abab", None, ""])
    broken = unigram_model(False)
    next(p for p in broken.pieces if p.piece == "abab").score = -50.0
    codec.tokenizer = pieces.rebuild(broken, prefix=False)
    ids, offsets, parity, round_trip = next(codec.encode(texts))
    right, right_offsets, _, _ = next(pieces.Codec(str(path)).encode(texts))
    spans = lambda x, o: [x[a:b].tolist() for a, b in zip(o, o[1:])]
    assert parity.tolist() == [False, True, False, True, True] and round_trip.all()
    assert [a == b for a, b in zip(spans(ids, offsets), spans(right, right_offsets))] == parity.tolist()


def test_whole_texts_equal_the_other_library_on_the_given_tables(spark):
    """Parity by chunk is parity of whole texts: every given text of a small table, encoded whole by the other library."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    other = sentencepiece.SentencePieceProcessor(model_file=default_path("piece_bpe_32k.model"))
    for r in pieces.encode(docs).collect():
        assert r.parity == (list(r.ids) == other.encode(texts[r.row.doc_id])) and r.parity
