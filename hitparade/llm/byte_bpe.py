"""Byte-level BPE encoding and decoding through a generated sentencepiece model.

The model is serialised straight from a rank file: every vocabulary entry is a
piece whose bytes are mapped to the characters ``chr(256 + byte)``, scored by
its negative rank, with identity normalisation. The best-scored merge is then
the lowest-ranked one, so a pre-token gets the ids that rank-based byte-pair
merging gives it. Pre-tokens are the matches of the tokenizer's pattern; a
pre-token that is itself a vocabulary entry takes that entry's id, as rank
encoders do. Decoding maps ids to pieces and pieces back to bytes.

Rows: a null text encodes like an empty one (no ids, no bytes). Texts are never
cut; repeated rows give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor
from sentencepiece import sentencepiece_model_pb2 as pb

from hitparade.llm.arrow import append_columns

#: Pre-tokens remembered in a task; when full, the shorter half stays (results do not change).
MEMORY = 50_000
#: Longer pre-tokens are encoded without being remembered.
LONGEST_REMEMBERED = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in (line.split() for line in f if line.strip())}


_SHIFT = {b: b + 256 for b in range(256)}


def _mapped(data: bytes) -> str:
    return data.decode("latin-1").translate(_SHIFT)


def shorter_half(known: dict) -> dict:
    """The half of a memory with the shorter (so, the more frequent) keys."""
    keys = sorted(known, key=len)
    return {k: known[k] for k in keys[: len(keys) // 2]}


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised BPE model whose piece ids are the ranks (which must be 0..n-1)."""
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0..n-1 without gaps")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"single bytes without a rank: {missing}")
    m = pb.ModelProto()
    for rank, tok in enumerate(tokens):
        m.pieces.add(piece=_mapped(tok), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    m.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    m.trainer_spec.model_type = pb.TrainerSpec.BPE
    m.trainer_spec.vocab_size = len(m.pieces)
    m.trainer_spec.unk_id = len(tokens)
    m.trainer_spec.bos_id = m.trainer_spec.eos_id = m.trainer_spec.pad_id = -1
    m.normalizer_spec.name = "identity"
    m.normalizer_spec.add_dummy_prefix = False
    m.normalizer_spec.remove_extra_whitespaces = False
    m.normalizer_spec.escape_whitespaces = False
    return m.SerializeToString()


class Codec:
    """Encoder and decoder of one task (a worker process keeps nothing of it)."""

    def __init__(self, model: bytes, pattern: str):
        self.sp = SentencePieceProcessor(model_proto=model)
        n = self.sp.get_piece_size() - 1
        self.bytes_of = [bytes(ord(c) - 256 for c in self.sp.id_to_piece(i)) for i in range(n)]
        self.whole = {b: i for i, b in enumerate(self.bytes_of)}
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def _ids(self, tokens: list[str]) -> list[bytes]:
        """The ids of pre-tokens as little-endian unsigned 32-bit integers."""
        data = [t.encode() for t in tokens]
        got = [self.whole.get(d) for d in data]
        rest = [i for i, g in enumerate(got) if g is None]
        for i, ids in zip(rest, self.sp.encode([_mapped(data[i]) for i in rest], num_threads=1), strict=True):
            got[i] = ids
        return [array("I", (g,) if isinstance(g, int) else g).tobytes() for g in got]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each whole text's ids."""
        split = [self.find(t) if t else [] for t in texts]
        new = list(set().union(*split).difference(self.known))
        large = {}
        if new:
            for t, ids in zip(new, self._ids(new), strict=True):
                (self.known if len(t) <= LONGEST_REMEMBERED else large)[t] = ids
        if large:
            known = self.known
            out = [b"".join(known[t] if t in known else large[t] for t in tokens) for tokens in split]
        else:
            out = [b"".join(map(self.known.__getitem__, tokens)) for tokens in split]
        if len(self.known) > MEMORY:
            self.known = shorter_half(self.known)
        return out

    def decode(self, ids: list[bytes | None]) -> list[bytes]:
        """The bytes of each id sequence; an id outside the vocabulary is an error."""
        return [b"".join(map(self.bytes_of.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in ids]


class ByteBPE:
    """A byte-level BPE vocabulary as a Spark operator.

    The serialised model (about a megabyte, bounded by the vocabulary) is the
    only thing broadcast.
    """

    def __init__(self, spark: SparkSession, ranks_path: str, pattern: str):
        self.pattern = pattern
        self.model = spark.sparkContext.broadcast(sentencepiece_model(read_ranks(ranks_path)))

    def encode(self, docs: DataFrame, text_col: str = "text", ids_col: str = "ids", keep_text: bool = True) -> DataFrame:
        """``docs`` with ``ids_col``: the ids as little-endian unsigned 32-bit integers."""
        model, pattern = self.model, self.pattern

        def kernel():
            codec = Codec(model.value, pattern)
            return lambda texts: [pa.array(codec.encode(texts), pa.binary())]

        return append_columns(docs, text_col, kernel, [T.StructField(ids_col, T.BinaryType())], keep_text)

    def decode(self, docs: DataFrame, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
        """``docs`` with ``out_col``: the bytes of the ids."""
        model, pattern = self.model, self.pattern

        def kernel():
            codec = Codec(model.value, pattern)
            return lambda ids: [pa.array(codec.decode(ids), pa.binary())]

        return append_columns(docs, ids_col, kernel, [T.StructField(out_col, T.BinaryType())])

    def round_trip(self, docs: DataFrame, text_col: str = "text", keep_text: bool = False) -> DataFrame:
        """``docs`` with ``ids`` and the ``decoded`` bytes of those ids, in one pass."""
        model, pattern = self.model, self.pattern

        def kernel():
            codec = Codec(model.value, pattern)

            def run(texts):
                ids = codec.encode(texts)
                return [pa.array(ids, pa.binary()), pa.array(codec.decode(ids), pa.binary())]

            return run

        fields = [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())]
        return append_columns(docs, text_col, kernel, fields, keep_text)
