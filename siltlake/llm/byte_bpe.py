"""Byte-level BPE through a sentencepiece model made from the vocabulary.

A rank file lists byte strings in the order in which merges made them. Mapped
byte by byte to printable characters they are the pieces of a sentencepiece BPE
model, scored by negative rank, so that the model merges the pair of least rank
first. The model is serialised here, with a normaliser that changes nothing;
nothing is trained. Texts are cut into pre-tokens by the pattern, each encoded
by itself; ids decode by the inverse map.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.llm.common import whole_row

# Field numbers and codes of the public model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, TYPE = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
MODEL_TYPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 3, 4, 40, 41, 42, 43
BPE = 2
NAME, CHARSMAP, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 1, 2, 3, 4, 5

# A space between two letters: every pattern of this kind begins a pre-token there.
SAFE_CUT = regex.compile(r"(?<=\p{L}) (?=\p{L})")
# Pre-tokens whose ids a worker remembers.
REMEMBERED = 300_000
_CODECS: dict[tuple[str, str], Codec] = {}


# Bytes and characters


def byte_characters() -> list[str]:
    """A printable character for each byte: printable Latin-1 stands for itself,
    the others in order for the characters from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


CHARACTERS = dict(enumerate(byte_characters()))
BYTES = {ord(c): b for b, c in CHARACTERS.items()}


def mapped(data: bytes) -> str:
    return data.decode("latin-1").translate(CHARACTERS)


def unmapped(piece: str) -> bytes:
    return piece.translate(BYTES).encode("latin-1")


# The model


def _varint(n: int) -> bytes:
    n &= 2**64 - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _data(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _piece(piece: str, score: float, kind: int) -> bytes:
    return _data(PIECES, _data(PIECE, piece.encode()) + _varint(SCORE << 3 | 5) + struct.pack("<f", score) + _number(TYPE, kind))


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, in the order of their ranks 0, 1, ..."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    return [ranks[i] for i in range(len(ranks))]


def model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece model whose ids are the ranks; the id after the
    last stands for anything unknown, which never occurs as all bytes are pieces."""
    pieces = [_piece(mapped(token), -float(rank), NORMAL) for rank, token in enumerate(tokens)]
    pieces.append(_piece("<unk>", 0.0, UNKNOWN))
    trainer = _number(MODEL_TYPE, BPE) + _number(VOCAB_SIZE, len(pieces)) + _number(UNK_ID, len(tokens))
    trainer += b"".join(_number(field, -1) for field in (BOS_ID, EOS_ID, PAD_ID))
    normalizer = _data(NAME, b"identity") + _data(CHARSMAP, b"")
    normalizer += b"".join(_number(field, 0) for field in (DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES))
    return b"".join(pieces) + _data(TRAINER, trainer) + _data(NORMALIZER, normalizer)


class Codec:
    """Encodes and decodes by a vocabulary; made once per worker."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model(tokens))
        self.split = regex.compile(pattern).findall
        self.whole = {token: i for i, token in enumerate(tokens)}
        size = self.processor.get_piece_size() - 1
        self.tokens = [unmapped(self.processor.id_to_piece(i)) for i in range(size)]
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        data = [piece.encode() for piece in pieces]
        split = [i for i, x in enumerate(data) if x not in self.whole]
        found = {i: [self.whole[x]] for i, x in enumerate(data) if x in self.whole}
        found |= zip(split, self.processor.encode([mapped(data[i]) for i in split], out_type=int, num_threads=1))
        for i, piece in enumerate(pieces):
            self.known[piece] = np.array(found[i], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return b"".join([self._encode(part) for part in self._parts(text)])

    def _parts(self, text: str, limit: int = 1 << 20) -> Iterator[str]:
        """A very long text in parts, cut where no pre-token can reach across."""
        start = 0
        while len(text) - start > limit and (cut := SAFE_CUT.search(text, start + limit)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def _encode(self, text: str) -> bytes:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        pieces, known = self.split(text), self.known
        if new := {piece for piece in pieces if piece not in known}:
            self._learn(list(new))
        return b"".join([known[piece] for piece in pieces])

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(read_ranks(path), pattern)
    return _CODECS[path, pattern]


# Documents


def encode_column(text, path: str, pattern: str):
    """Ids of each text as bytes, four for each, little-endian."""

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        return pa.array([codec(path, pattern).encode(x or "") for x in texts.to_pylist()], pa.binary())

    return encode(text)


def decode_column(ids, path: str, pattern: str):
    """The bytes that ids stand for."""

    @F.arrow_udf("binary")
    def decode(values: pa.Array) -> pa.Array:
        return pa.array([codec(path, pattern).decode(x or b"") for x in values.to_pylist()], pa.binary())

    return decode(ids)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row of ``docs``:
    encoded, and decoded from the ids.

    Null texts are empty and have no tokens. Repeated rows and ids stay as they
    are. Other columns are not read.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            lengths, ids_digests, text_digests = [], [], []
            for text in batch.column("text"):
                ids = own.encode(text.as_py() or "")
                lengths.append(len(ids) // 4)
                ids_digests.append(hashlib.sha256(ids).hexdigest())
                text_digests.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        digests, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def with_ids(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """All columns of ``docs``, and token_ids (bytes) and n_tokens in their place
    if there are columns of these names already."""
    rows = docs.select(whole_row(docs.drop("token_ids", "n_tokens")).alias("row"), encode_column(F.col("text"), path, pattern).alias("ids"))
    return rows.select("row.*", F.col("ids").alias("token_ids"), (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"))
