"""Token ids in files of fixed-width bit-packed blocks.

Each id takes the least bits that hold the vocabulary. A file is

    magic (8 bytes), header length (4 bytes, little-endian), header (JSON: bits,
    block, n_docs, n_ids), the documents' ids and lengths (int64 each), and the
    blocks: ``block`` ids each, most significant bit first, padded to a byte

so that block b starts at b times the bytes of a block, any block can be read
alone, and numpy unpacks it in one go. Files hold documents in ascending order
of their ids, each file a range of them.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltlake.llm.common import stored
from siltlake.session import scratch_path

MAGIC = b"BITPACK1"
BLOCK = 4096
# Pieces of text, and words, whose ids a worker remembers.
REMEMBERED_PIECES = 800_000
REMEMBERED_WORDS = 700_000


# Packing


def bits_for(vocabulary: int) -> int:
    """The least bits that hold ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):  # the same bytes, without single bits
        return ids.astype(f">u{bits // 8}").tobytes()
    lanes = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(lanes, axis=1)[:, 32 - bits :].ravel()).tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", count).astype(np.uint32)
    single = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits).reshape(count, bits)
    lanes = np.zeros((count, 32), np.uint8)
    lanes[:, 32 - bits :] = single
    return np.packbits(lanes, axis=1).view(">u4").ravel().astype(np.uint32)


class Writer:
    """Collects documents; blocks are packed as they fill."""

    def __init__(self, bits: int, block: int = BLOCK):
        self.bits, self.block, self.n_ids = bits, block, 0
        self.docs: list[tuple[int, int]] = []
        self.packed, self.open = bytearray(), []
        self.waiting = 0

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.n_ids += len(ids)
        self.open.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            ids = np.concatenate(self.open)
            whole = len(ids) - len(ids) % self.block
            for start in range(0, whole, self.block):
                self.packed += pack(ids[start : start + self.block], self.bits)
            self.open, self.waiting = [ids[whole:]], len(ids) - whole

    def write(self, out: pa.NativeFile) -> None:
        rest = pack(np.concatenate(self.open), self.bits) if self.waiting else b""
        head = {"bits": self.bits, "block": self.block, "n_docs": len(self.docs), "n_ids": self.n_ids}
        header = json.dumps(head).encode()
        out.write(MAGIC + struct.pack("<I", len(header)) + header)
        out.write(np.array(self.docs, "<i8").reshape(-1, 2).tobytes())
        out.write(self.packed)
        out.write(rest)


class Reader:
    """Random access to a file: ``ids(start, stop)`` reads the blocks it needs."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        if source.read(8) != MAGIC:
            raise ValueError("not a file of packed ids")
        (length,) = struct.unpack("<I", source.read(4))
        head = json.loads(source.read(length))
        self.bits, self.block, self.n_ids = head["bits"], head["block"], head["n_ids"]
        index = np.frombuffer(source.read(16 * head["n_docs"]), "<i8").reshape(-1, 2)
        self.doc_ids, self.lengths = index[:, 0], index[:, 1]
        self.first = 12 + length + 16 * head["n_docs"]
        self.block_bytes = (self.block * self.bits + 7) // 8

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, np.uint32)
        low, high = start // self.block, -(-stop // self.block)
        self.source.seek(self.first + low * self.block_bytes)
        data = self.source.read((high - low) * self.block_bytes)
        parts = [
            unpack(data[i * self.block_bytes : (i + 1) * self.block_bytes], self.bits, min(self.block, self.n_ids - b * self.block))
            for i, b in enumerate(range(low, high))
        ]
        return np.concatenate(parts)[start - low * self.block : stop - low * self.block]

    def documents(self, most: int = 1 << 20) -> Iterator[tuple[int, int, Iterator[np.ndarray]]]:
        """(id, first id's place, ids in parts of about ``most``) of each document."""
        start, held, low, high = 0, np.zeros(0, np.uint32), 0, 0
        for doc_id, length in zip(self.doc_ids.tolist(), self.lengths.tolist()):
            if length <= most and start + length > high:
                low, high = start, min(self.n_ids, max(start + length, start + most))
                held = self.ids(low, high)
            if length <= most:
                parts = iter([held[start - low : start + length - low]])
            else:
                end = start + length
                parts = (self.ids(i, min(i + most, end)) for i in range(start, end, most))
            yield doc_id, start, parts
            start += length


# Encoding

_ENCODERS: dict[str, PieceEncoder] = {}
# Fixed value: the pattern by which byte-level tokenizers split a text.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# White space by anybody's rule but line ends, as ranges of code points.
_BLANKS = [
    (0x09, 0x09), (0x0B, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x180E, 0x180E),
    (0x2000, 0x200B), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
_OTHER = "".join(f"{chr(a)}-{chr(b)}" for a, b in _BLANKS)
_BLANK = f"\n{_OTHER}"
# White space in a row, but for two line ends before a word.
_UNSAFE = f"[{_BLANK}][{_OTHER}]|[{_OTHER}][{_BLANK}]|\n\n\n|\n\n\\z"
_SAFE_SPACE = re.compile(f"(?<=[^{_BLANK}]) (?=[^{_BLANK}])")
_ANY_BLANK = re.compile(f"[{_BLANK}]")


class PieceEncoder:
    """Encodes texts with a byte-level tokenizer of the tokenizers library.

    Its pattern puts a single space before the word that follows, and a single
    line end by itself. Texts are cut there with Arrow, and only the different
    pieces of a batch are looked at. Ids of pieces, and of the tokens that the
    pattern cuts them into, are remembered, so that a worker encodes a word
    once; new words are encoded together, a line each. Texts that hold an added
    token (such as ``<|endoftext|>``) go through the library whole: it finds these
    before the pattern cuts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = regex.compile(BYTE_LEVEL).findall
        self.line_end = self._one_by_one(["\n"])[0]
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _one_by_one(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _learn_words(self, words: list[str]) -> None:
        lines = [word for word in words if not _ANY_BLANK.search(word, 1 if word[0] == " " else 0) and word != " "]
        parts = [lines[i : i + 200] for i in range(0, len(lines), 200)]
        found = self.tokenizer.encode_batch_fast(["\n".join(part) for part in parts], add_special_tokens=False)
        line_end = np.frombuffer(self.line_end, "<u4")[0]
        for part, encoded in zip(parts, found):
            ids = np.array(encoded.ids, "<u4")
            ends = np.flatnonzero(ids == line_end)
            data, edges = ids.tobytes(), [-1, *ends.tolist(), len(ids)]
            self.words.update((w, data[4 * a + 4 : 4 * b]) for w, a, b in zip(part, edges[:-1], edges[1:], strict=True))
        others = [word for word in words if word not in self.words]
        self.words.update(zip(others, self._one_by_one(others)))

    def _cut(self, text: str) -> list[str]:
        """By the pattern; a piece with more white space in it stays whole."""
        return [text] if text and _ANY_BLANK.search(text, 1) else self.split(text)

    def _learn(self, pieces: list[str]) -> None:
        """A piece that starts with a line end begins a line, and the line end is
        its first id; any other follows a space."""
        texts = [piece[1:] if piece[:1] == "\n" else " " + piece for piece in pieces]
        split = [[x] if x[1:].isalpha() and (x[0] == " " or x[0].isalpha()) else self._cut(x) for x in texts]
        if len(self.words) > REMEMBERED_WORDS:
            self.words.clear()
        words = self.words
        self._learn_words(list({word for row in split for word in row if word not in words}))
        for piece, row in zip(pieces, split):
            data = b"".join([words[word] for word in row])
            self.pieces[piece] = self.line_end + data if piece[:1] == "\n" else data

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        marked = np.zeros(len(texts), bool)
        for token in self.added:
            marked |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not marked.any():
            return self._encode(texts)
        ids = self._encode(pc.if_else(pa.array(marked), "", texts))
        for i in np.flatnonzero(marked).tolist():
            ids[i] = np.frombuffer(self._one_by_one([texts[i].as_py()])[0], "<u4")
        return ids

    def _encode(self, texts: pa.Array) -> list[np.ndarray]:
        cut = pc.replace_substring(texts, "\n", " \n")
        if pc.any(unsafe := pc.match_substring_regex(texts, _UNSAFE)).as_py():
            # Elsewhere than between two words a cut could change the ids.
            rows = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("\n"), cut, ""), " ").to_pylist()
            for i in np.flatnonzero(unsafe.to_numpy(zero_copy_only=False)).tolist():
                first, *rest = _SAFE_SPACE.split(texts[i].as_py())
                rows[i] = ["\n" + first, *rest]
            split = pa.array(rows, pa.list_(pa.string()))
        else:
            split = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("\n"), cut, ""), " ")
        coded = pc.list_flatten(split).dictionary_encode()
        different, where = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self.pieces) > REMEMBERED_PIECES:
            self.pieces.clear()
        known = self.pieces
        self._learn([piece for piece in different if piece not in known])
        data = [known[piece] for piece in different]
        flat = np.frombuffer(b"".join(data), "<u4")
        lengths = np.fromiter(map(len, data), np.int64, len(data)) // 4
        starts = np.cumsum(lengths) - lengths
        # The ids of all pieces, one after the other.
        each = lengths[where]
        ends = np.cumsum(each)
        ids = flat[np.repeat(starts[where] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
        pieces = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        edges = np.concatenate([[0], ends])[pieces].tolist()
        # A text was given a line end in front, which goes again.
        return [ids[a + 1 : b] for a, b in zip(edges[:-1], edges[1:])]


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


# Files


def _in_order(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows of one id may be many: the hash lets ranges end among them.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    return rows.repartitionByRange(width, *order).sortWithinPartitions(*order, "text")


def write_files(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int, end_id: int, file_ids: int = 1 << 24) -> DataFrame:
    """Encodes ``docs`` and writes their ids, each document closed by ``end_id``.

    Returns a row for each file: file, part and number (their order), n_docs,
    n_ids. Only files named there count: a task that is run again writes files
    of its own, and names replace nothing. A file is closed after about
    ``file_ids`` ids; a document is never cut.
    """
    bits = bits_for(max(vocabulary, end_id + 1))
    end = np.array([end_id], np.uint32)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, writer, names = TaskContext.get().partitionId(), 0, Writer(bits), []
        system, root = pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)

        def close() -> None:
            nonlocal number, writer
            name = f"{part:06d}-{number:04d}-{uuid.uuid4().hex}.ids"
            with system.open_output_stream(f"{root}/{name}") as out:
                writer.write(out)
            names.append({"file": name, "part": part, "number": number, "n_docs": len(writer.docs), "n_ids": writer.n_ids})
            number, writer = number + 1, Writer(bits)

        for batch in batches:
            for rows in (batch.slice(i, 2500) for i in range(0, batch.num_rows, 2500)):
                ids = rows.column("doc_id").to_pylist()
                for doc_id, found in zip(ids, encoder(tokenizer).encode(rows.column("text"))):
                    writer.add(NO_ID if doc_id is None else doc_id, np.concatenate([found, end]))
                    if writer.n_ids >= file_ids:
                        close()
        if writer.docs:
            close()
        if names:
            yield pa.RecordBatch.from_pylist(names, schema=FILES)

    return stored(_in_order(docs).mapInArrow(write, "file string, part int, number int, n_docs bigint, n_ids bigint"), "files")


# The id in a file of a document without one.
NO_ID = -(2**63)
FILES = pa.schema([("file", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def read_files(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of all
    documents in the files of ``write_files``, each file read by one task."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each file goes through the prefix sum.
    placed = files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        system, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                rows = []
                with system.open_input_file(f"{root}/{name}") as source:
                    reader = Reader(source)
                    for (doc_id, start, parts), length in zip(reader.documents(), reader.lengths.tolist()):
                        crc = 0
                        for ids in parts:
                            crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                        rows.append((None if doc_id == NO_ID else doc_id, base + start, length, crc))
                columns = [pa.array(x, pa.int64()) for x in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    width = max(1, files.count())
    spread = placed.select("file", "base").repartition(width, "file")
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def packed(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int, folder: str | None = None) -> DataFrame:
    """Writes all ``docs`` and reads them back: see ``read_files``.

    Null texts are empty: their only id is the closing one. Null ids come first;
    rows of equal ids follow each other in an order that their texts decide.
    Without rows there is no file.
    Other columns are not read.
    """
    folder = folder or _uri(docs.sparkSession, "ids")
    return read_files(write_files(docs, folder, tokenizer, vocabulary, end_id), folder)


def _uri(spark: SparkSession, purpose: str) -> str:
    path = scratch_path(spark, purpose)
    return path if ":" in path else f"file://{path}"
