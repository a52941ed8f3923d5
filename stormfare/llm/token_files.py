"""Token ids as flat binary files with 64-bit offsets.

Documents are range-partitioned by key and sorted, each task encodes its own and
writes, in the folder given,

* ``tokens-NNNNN.bin``: ids as unsigned little-endian integers, 16 bits wide
  where the vocabulary allows, else 32;
* ``offsets-NNNNN.bin``: unsigned 64-bit, where each document starts within the
  part, and the part's length as the last one;
* ``keys-NNNNN.bin``: the documents' keys as signed 64-bit integers. Documents
  without a key come last, so those beyond the end of this file have none.

``parts.json`` lists the parts with their number of documents and the number of
ids before them, the prefix sum of the parts' lengths: one row per part reaches
the driver. Files are written under a passing name and renamed, so a task that
runs twice leaves one whole file. Readers map the files into memory.

The folder must be on a file system that all machines mount, as memory mapping
asks for. Defined results: null text has the end id alone; documents without a
key are stored after all others and read back with a null key; equal keys, and
null ones, are ordered by the first ``PREFIX`` characters of their texts, then by
a hash of these, and may fill several parts; an empty table writes no parts.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from stormfare.llm.text import whole_text
from stormfare.llm.vocabulary import built, sent
from stormfare.session import scratch_path

END_ID = 2
CHARS_PER_ROUND = 4_000_000
CHUNKS_PER_CALL = 2_000
#: Chunks of a worker's generation; the one before is kept too, so frequent chunks are never forgotten.
KNOWN = 600_000
#: Characters by which documents of one key are ordered, and dealt to parts.
PREFIX = 16


def local_folder(path: str) -> str:
    """The folder as a mounted path."""
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"token files need a mounted folder, not {path}")
    return parsed.path


class WordBpe:
    """Encodes with the tokenizers library, distinct chunks once.

    The normalizer turns white space into single spaces and the pre-tokenizer
    drops it, so a text has the ids of its chunks between spaces and line feeds.
    """

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode())
        self.type = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, in the width of the files."""
        if len(self.known) > KNOWN:
            self.known, self.older = {}, self.known
        split = [t.replace("\n", " ").split(" ") for t in texts]
        missing = set().union(*split) - self.known.keys()
        back = missing & self.older.keys()
        self.known.update((c, self.older[c]) for c in back)
        new = list(missing - back)
        for i in range(0, len(new), CHUNKS_PER_CALL):
            self._learn(new[i:i + CHUNKS_PER_CALL])
        return [b"".join(map(self.known.__getitem__, s)) for s in split]


    def _learn(self, chunks: list[str]) -> None:
        """Ids of many chunks from one call; offsets tell where each chunk's ids end."""
        found = self.tokenizer.encode(" ".join(chunks), add_special_tokens=False)
        starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(found))
        ends = np.cumsum(np.fromiter((len(c) + 1 for c in chunks), np.int64, len(chunks)))
        ids = np.array(found.ids, self.type).tobytes()
        width, begin = int(self.type[-1]), 0
        for chunk, end in zip(chunks, (np.searchsorted(starts, ends) * width).tolist()):
            self.known[chunk] = ids[begin:end]
            begin = end


def _put(folder: str, name: str, chunks: Iterator[bytes]) -> None:
    passing = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    with open(passing, "wb") as file:
        for chunk in chunks:
            file.write(chunk)
    os.replace(passing, os.path.join(folder, name))


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, key: str = "doc_id",
                      text: str = "text", end_id: int = END_ID) -> list[dict]:
    """Writes the files of all documents; the list of parts."""
    spark = docs.sparkSession
    target = local_folder(folder)
    os.makedirs(target, exist_ok=True)
    content = sent(spark, vocabulary)

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = built(WordBpe, content.value)
        end = np.array([end_id], machine.type).tobytes()
        part = TaskContext.get().partitionId()
        lengths, keys = [], []

        def tokens() -> Iterator[bytes]:
            for batch in batches:
                keys.append(batch.column(0).drop_null().to_numpy())
                round_, size = [], 0
                for value in batch.column(1):
                    round_.append(value.as_py())
                    size += len(round_[-1])
                    if size >= CHARS_PER_ROUND:
                        yield from done(round_)
                        round_, size = [], 0
                yield from done(round_)

        def done(texts: list[str]) -> Iterator[bytes]:
            for ids in machine.encode(texts) if texts else ():
                ids += end
                lengths.append(len(ids) // len(end))
                yield ids

        _put(target, f"tokens-{part:05d}.bin", tokens())
        if not lengths:
            os.remove(os.path.join(target, f"tokens-{part:05d}.bin"))
            return
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
        _put(target, f"offsets-{part:05d}.bin", iter([offsets.tobytes()]))
        _put(target, f"keys-{part:05d}.bin", (k.astype("<i8").tobytes() for k in keys))
        keyed = sum(map(len, keys))
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "docs": pa.array([keyed], pa.int64()),
            "unkeyed": pa.array([len(lengths) - keyed], pa.int64()),
            "tokens": pa.array([int(offsets[-1])], pa.int64()),
            "width": pa.array([len(end)], pa.int32()),
        })

    ready = docs.select(F.col(f"`{key}`").cast("long").alias("key"), whole_text(text).alias("text"))
    order = F.asc_nulls_last("key"), F.substring("text", 1, PREFIX), F.xxhash64("text")
    sorted_ = ready.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = sorted_.mapInArrow(write_part, "part int, docs long, unkeyed long, tokens long, width int").collect()
    before, listed = 0, []
    for row in sorted(parts):
        listed.append({**row.asDict(), "start": before})
        before += row["tokens"]
    _put(target, "parts.json", iter([json.dumps(listed).encode()]))
    return listed


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Key, start, length and checksum of every stored document, from the mapped files."""
    target = local_folder(folder)
    with open(os.path.join(target, "parts.json")) as file:
        parts = json.load(file)
    schema = "part int, docs long, tokens long, width int, start long"
    listed = spark.createDataFrame([tuple(p[c] for c in ("part", "docs", "tokens", "width", "start")) for p in parts], schema)

    def read_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                def mapped(name: str, kind: str) -> np.ndarray:
                    path = os.path.join(target, f"{name}-{row['part']:05d}.bin")
                    # An empty file cannot be mapped: the keys of a part whose documents have none.
                    return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)

                ids, offsets, keys = mapped("tokens", f"<u{row['width']}"), mapped("offsets", "<u8"), mapped("keys", "<i8")
                ends = offsets.astype(np.int64)
                for i in range(0, len(ends) - 1, 10_000):
                    own = ends[i:i + 10_001]
                    known = pa.array(np.asarray(keys[i:i + 10_000]), pa.int64())
                    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(own[:-1], own[1:])]
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.concat_arrays([known, pa.nulls(len(sums) - len(known), pa.int64())]),
                        "start": pa.array(own[:-1] + row["start"]),
                        "n_tokens": pa.array(np.diff(own)),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    })

    return listed.repartition(max(1, len(parts)), "part").mapInArrow(
        read_parts, "key long, start long, n_tokens long, ids_crc32 long")


def token_file_report(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Write the documents' ids to the shared folder and read them back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    write_token_files(docs, folder, vocabulary, end_id=end_id)
    return read_token_files(spark, folder).withColumnRenamed("key", "doc_id")
