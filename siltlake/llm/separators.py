"""Token counts by a scan for end-of-document ids.

Flat token files are ids and nothing else: no index says where documents end.
The files are cut into blocks of equal size, each scanned by itself with numpy
for separators. Where the document that is open at the start of a block began
follows from a prefix scan over one number per block: the last separator so far.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltlake.llm.bitpack import _uri
from siltlake.llm.byte_bpe import codec
from siltlake.llm.common import stored

# Ids to a block that one step of the scan holds.
BLOCK_IDS = 1 << 22
_ENCODINGS: dict[str, object] = {}
# White space in a row that the tokenizer's own matcher is not given: it recurses
# over a run, and its stack ends before a run of a million.
RUN = 100_000
_LONG_RUN = re.compile(r"\s{%d}" % RUN)


def encoding(path: str, pattern: str):
    """The tiktoken encoding of a file of ranks, once per worker."""
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def encoded(text: str, ranks: str, pattern: str, dtype: str) -> bytes:
    """The ids of a text as bytes; texts with long runs of white space go through
    ``byte_bpe``, which gives the same ids."""
    if len(text) >= RUN and _LONG_RUN.search(text):
        return np.frombuffer(codec(ranks, pattern).encode(text), "<u4").astype(dtype).tobytes()
    return np.array(encoding(ranks, pattern).encode_ordinary(text), dtype).tobytes()


def write_flat(docs: DataFrame, folder: str, ranks: str, pattern: str, end_id: int, dtype: str = "<u2") -> DataFrame:
    """Encodes ``docs`` as they come into flat files, one for each task.

    Returns file, ordinal (place in the file) and doc_id of each document. A
    task that is run again writes a file of its own; only files named count.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        end = np.array([end_id], dtype).tobytes()
        system, root = pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name, out = f"{uuid.uuid4().hex}.bin", None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                out = out or system.open_output_stream(f"{root}/{name}")
                for text in batch.column("text"):
                    text = text.as_py()
                    out.write((encoded(text, ranks, pattern, dtype) if text else b"") + end)
                ordinals = pa.array(range(at, at + batch.num_rows), pa.int64())
                at += batch.num_rows
                names = pa.array([name] * batch.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([names, ordinals, batch.column("doc_id")], ["file", "ordinal", "doc_id"])
        finally:
            if out is not None:
                out.close()

    return stored(docs.select("doc_id", "text").mapInArrow(write, "file string, ordinal bigint, doc_id bigint"), "flat")


def scan(files: DataFrame, folder: str, end_id: int, dtype: str = "<u2", block_ids: int = BLOCK_IDS) -> DataFrame:
    """file, ordinal and n_tokens (without the separator) of each document of the
    flat files named in ``files`` (column file).

    Two separators in a row are an empty document; ids after the last one are a
    document if there are any. A file without ids has none.
    """
    width = np.dtype(dtype).itemsize

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                n = system.get_file_info(f"{root}/{name}").size // width
                n_blocks = max(1, -(-n // block_ids))
                columns = [[name] * n_blocks, range(n_blocks), [n] * n_blocks]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0]), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["file", "block", "n"]
                )

    def separators(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, block, n in zip(*(batch.column(x).to_pylist() for x in ("file", "block", "n"))):
                start, stop = block * block_ids, min(n, (block + 1) * block_ids)
                with system.open_input_file(f"{root}/{name}") as source:
                    ids = np.frombuffer(source.read_at((stop - start) * width, start * width), dtype)
                ends = start + np.flatnonzero(ids == end_id)
                if stop == n and n and (not len(ids) or ids[-1] != end_id):
                    ends = np.append(ends, n)  # a document that nothing closes
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(ends), pa.string()),
                        pa.array(np.full(len(ends), block, np.int64)),
                        pa.array(np.arange(len(ends), dtype=np.int64)),
                        pa.array(ends.astype(np.int64)),
                        # Within a block the document before has ended here; -1: look further back.
                        pa.array(np.concatenate([[-1], ends[:-1]]).astype(np.int64)[: len(ends)]),
                    ],
                    ["file", "block", "place", "stop", "previous"],
                )

    parts = files.select("file").distinct().mapInArrow(blocks, "file string, block bigint, n bigint")
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stored(
        parts.repartition(tasks, "file", "block").mapInArrow(
            separators, "file string, block bigint, place bigint, stop bigint, previous bigint"
        ),
        "separators",
    )
    # One row for each block: documents that end in blocks before, and the last separator there.
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per_block = found.groupBy("file", "block").agg(F.count("*").alias("ends"), F.max("stop").alias("last"))
    carried = per_block.select(
        "file", "block",
        F.coalesce(F.sum("ends").over(ahead), F.lit(0)).alias("before"),
        F.coalesce(F.max("last").over(ahead), F.lit(-1)).alias("carry"),
    )
    began = F.when(F.col("place") == 0, F.col("carry")).otherwise(F.col("previous")) + 1
    return found.join(carried, ["file", "block"]).select(
        "file", (F.col("before") + F.col("place")).alias("ordinal"), (F.col("stop") - began).alias("n_tokens")
    )


def token_counts(docs: DataFrame, ranks: str, pattern: str, end_id: int, folder: str | None = None) -> DataFrame:
    """doc_id, file, ordinal and n_tokens of each row of ``docs``, which is written
    to flat files and counted from them.

    Null and empty texts have no tokens. Ids may be null or repeat; texts are
    told apart by their place in a file. Texts of any length, and runs of white
    space of any length, are encoded whole. Other columns are not read.
    """
    folder = folder or _uri(docs.sparkSession, "flat")
    written = write_flat(docs, folder, ranks, pattern, end_id)
    return written.join(scan(written, folder, end_id), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens")
