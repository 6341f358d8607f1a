"""SentencePiece models on the tokenizers library.

The model's protobuf is parsed and rebuilt: its normaliser, the marker for spaces, the pieces with their unigram scores (or
the merges that their order implies, for a model of merges), and byte fallback. Where no piece holds a marker behind
other characters, and the normaliser changes nothing, a text's pieces are those of its *chunks* (spaces and what follows
them), so each distinct chunk of a slice is encoded once, in batches that the library deals to its threads. Other
models encode whole texts in batches.

*Parity.* The ids are those of the rebuilt model. Each distinct chunk (or text) is also encoded by the sentencepiece library, which
decides ``parity`` alone: it is false for a document with a chunk where the two differ. Chunks are joined by place only, so
parity of all chunks is parity of the text; the tests compare whole texts.

Defined results: null and empty texts have no ids, parity and a faithful round trip; control pieces are never found in a text.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotloom.llm.tokens import Memory, default_path
from slotloom.llm.words import Slice, slices

MARK = "▁"
REMEMBERED = 1_000_000
SLICE_BYTES = 2 << 20
# Kinds of pieces and models in the protobuf.
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
UNIGRAM, MERGES = 1, 2


def parse(path: str):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    return proto


def chunked(proto) -> bool:
    """Whether chunks can be encoded one by one."""
    spec = proto.normalizer_spec
    crossing = any(MARK in p.piece.lstrip(MARK) for p in proto.pieces if p.type in (NORMAL, USER_DEFINED))
    return not (crossing or spec.precompiled_charsmap or spec.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix)


def rebuild(proto, prefix: bool = True):
    """The model as a tokenizer of the other library; without ``prefix`` texts come with their first space."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    pieces = [(p.piece, p.score) for p in proto.pieces]
    vocab = {piece: i for i, (piece, _) in enumerate(pieces)}
    fallback, unknown = proto.trainer_spec.byte_fallback, proto.trainer_spec.unk_id
    if proto.trainer_spec.model_type == UNIGRAM:
        model = models.Unigram(pieces, unknown, fallback)
    elif proto.trainer_spec.model_type == MERGES:
        whole = {p.piece for p in proto.pieces if p.type in (NORMAL, USER_DEFINED)}
        merges = []
        for piece, _ in sorted(((p.piece, -p.score) for p in proto.pieces if p.type == NORMAL and len(p.piece) > 1), key=lambda x: x[1]):
            cuts = [(piece[:i], piece[i:]) for i in range(1, len(piece)) if piece[:i] in whole and piece[i:] in whole]
            merges += sorted(cuts, key=lambda c: (vocab[c[0]], vocab[c[1]]))
        model = models.BPE(vocab, merges, unk_token=pieces[unknown][0], fuse_unk=True, byte_fallback=fallback)
    else:
        raise ValueError("only unigram and merge models are rebuilt")
    out, spec, steps = Tokenizer(model), proto.normalizer_spec, []
    if spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    steps.append(normalizers.Replace(" ", MARK))
    if prefix and spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    out.normalizer = normalizers.Sequence(steps)
    if chunked(proto):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *(
        [decoders.Strip(" ", 1, 0)] if prefix and spec.add_dummy_prefix else [])])
    own = [AddedToken(p.piece, normalized=True) for p in proto.pieces if p.type == USER_DEFINED]
    if own:
        out.add_tokens(own)
    return out


def _chunks(part: Slice) -> Slice:
    """The slice's texts cut before each run of spaces."""
    space = part.data == 0x20
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[part.offsets[:-1][part.offsets[:-1] < len(space)]] = True
    starts = np.flatnonzero(begins)
    return Slice(part.low, part.high, part.data, part.offsets, starts, np.append(starts[1:], len(space))[:len(starts)], np.searchsorted(starts, part.offsets))


class Codec:
    """Ids, parity and round trips of slices of texts."""

    def __init__(self, path: str):
        import sentencepiece

        path = path if os.path.exists(path) else default_path(os.path.basename(path))
        proto = parse(path)
        self.by_chunk = chunked(proto) and proto.normalizer_spec.add_dummy_prefix
        self.tokenizer = rebuild(proto, prefix=not self.by_chunk)
        self.other = sentencepiece.SentencePieceProcessor(model_file=path)
        self.mark = {p.piece: i for i, p in enumerate(proto.pieces)}.get(MARK, proto.trainer_spec.unk_id)
        self.memory = Memory(REMEMBERED)

    def _both(self, texts: list[str]):
        """(ids, parity, round trip) of each text, by the rebuilt model."""
        before = os.environ.get("TOKENIZERS_PARALLELISM")
        os.environ["TOKENIZERS_PARALLELISM"] = "true"  # whatever another operator set in this worker
        try:
            mine = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        finally:
            os.environ.pop("TOKENIZERS_PARALLELISM") if before is None else os.environ.update(TOKENIZERS_PARALLELISM=before)
        if self.by_chunk:  # the other library puts the first space there itself, but for an empty text
            theirs = self.other.encode([t[1:] for t in texts], num_threads=1)
            theirs = [[self.mark] if t == " " else ids for t, ids in zip(texts, theirs)]
        else:
            theirs = self.other.encode(texts, num_threads=1)
        same = [a == b for a, b in zip(mine, theirs)]
        decoded = self.tokenizer.decode_batch(mine, skip_special_tokens=False)
        return mine, same, [a == b for a, b in zip(decoded, texts)]

    def _learn(self, chunks: list[str]):
        ids, same, faithful = self._both(chunks)
        return ids, np.array(same, np.uint8) + 2 * np.array(faithful, np.uint8)

    def encode(self, texts: pa.Array):
        """(ids, offsets, parity, round trip) of every slice of a column of texts."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        if not self.by_chunk:
            whole = [t.decode("utf-8", "replace") for t in texts.to_pylist()]
            ids, same, faithful = self._both(whole)
            yield np.array([i for x in ids for i in x], np.uint32), np.cumsum([0, *map(len, ids)]), np.array(same, bool), np.array(faithful, bool)
            return
        spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar(b" ", pa.large_binary()), texts, pa.scalar(b"", pa.large_binary())))
        for part in slices(spaced, SLICE_BYTES):
            cut = _chunks(part)
            ids, offsets, flags = self.memory.gather(cut, self._learn)
            wrong = [np.concatenate([[0], np.cumsum(flags & bit == 0)])[cut.first] for bit in (1, 2)]
            yield ids, offsets, *(np.diff(w) == 0 for w in wrong)


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec for a model file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, text: str = "text", path: str = "piece_bpe_32k.model", with_ids: bool = True) -> DataFrame:
    """Each row of ``docs`` as ``row``, with n_tokens, ids_crc32 (of little-endian unsigned 32-bit ids), parity, round_trip and, if asked for, ids.

    ``round_trip``: whether decoding the ids gives the text again.
    """
    names = ["row", "n_tokens", "ids_crc32", "parity", "round_trip", *["ids"] * with_ids]

    def run(batches):
        own = codec(path)
        for batch in batches:
            out: list[list] = [[] for _ in names[1:]]
            for ids, offsets, parity, faithful in own.encode(batch.column("text")):
                raw = memoryview(ids.astype("<u4").tobytes())
                spans = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
                for into, values in zip(out, (np.diff(offsets), [zlib.crc32(raw[4 * a:4 * b]) for a, b in spans], parity, faithful,
                                              [ids[a:b].astype(np.int32) for a, b in spans])):
                    into.extend(values)
            types = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(x, t) for x, t in zip(out, types))], names)

    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(F.struct(*(others or [F.lit(0).alias("_")])).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean" + ", ids array<int>" * with_ids)


def decode(ids: DataFrame, column: str = "ids", path: str = "piece_bpe_32k.model") -> DataFrame:
    """``ids`` with ``text``, decoded by the rebuilt tokenizer; null ids give a null text."""
    def run(batches):
        tokenizer = rebuild(parse(path if os.path.exists(path) else default_path(os.path.basename(path))))
        for batch in batches:
            found = tokenizer.decode_batch([x or [] for x in batch.column(column).to_pylist()], skip_special_tokens=False)
            gone = batch.column(column).is_null().to_pylist()
            yield batch.append_column("text", pa.array([None if g else t for t, g in zip(found, gone)], pa.string()))

    if "text" in ids.columns:
        raise ValueError("there is a column text already")
    return ids.mapInArrow(run, ids.withColumn("text", F.lit("")).schema)
