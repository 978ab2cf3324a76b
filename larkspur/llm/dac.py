"""Token files with directly addressable codes.

Ids are written in segments of whole documents, in ascending order of doc_id.  A segment splits each id into bytes:
level 0 holds the lowest byte of every id, level k the next byte of the ids that need it.  A continuation bitmap on each
level says which ids go on, and a rank directory counts the set bits before each block, so the place of an id on the next level
is one lookup away: ``Segment.get(i)`` reads any id without decoding others.

The files are a Parquet table of segments, so that they can lie in any store Spark reaches:
``part``, ``segment``, ``before`` (ids of the part before the segment), ``n_ids``, ``doc_ids`` and ``doc_ends`` (little-endian longs), ``codes`` (the format above).

Edge cases: a null or empty text consists of the end id; rows with equal ids are kept side by side, in order of their text; rows
with a null id are left out; an empty table gives no segments.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.llm import arrays as A
from larkspur.llm.tables import scratch_path, text_of
from larkspur.llm.tokens import encoder

MAGIC = b"DAC1"
BLOCK = 512  # bits for each entry of a rank directory
SEGMENT_IDS = 1 << 20
END_ID = 2
SEGMENTS = "part int, segment int, before long, n_ids long, doc_ids binary, doc_ends binary, codes binary"


def pack(ids: np.ndarray) -> bytes:
    """The codes of a segment: magic, number of levels, then the levels (count, codes, bitmap, directory)."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        bitmap = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(more.astype(np.int64), np.arange(0, len(more), BLOCK)) if len(more) else np.zeros(0, np.int64)
        directory = (np.cumsum(blocks) - blocks).astype("<u8")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 255).astype(np.uint8).tobytes() + bitmap.tobytes() + directory.tobytes())
        if not more.any():
            return MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)
        rest = rest[more] >> np.uint32(8)


class Segment:
    """Read access to packed codes."""

    def __init__(self, codes: bytes):
        if codes[:4] != MAGIC:
            raise ValueError("not a segment")
        (count,) = struct.unpack_from("<I", codes, 4)
        self.levels, at = [], 8
        for _ in range(count):
            (n,) = struct.unpack_from("<Q", codes, at)
            sizes = (n, -(-n // 8), -(-n // BLOCK) * 8)
            level = []
            at += 8
            for size, kind in zip(sizes, (np.uint8, np.uint8, "<u8"), strict=True):
                level.append(np.frombuffer(codes, kind, size // np.dtype(kind).itemsize, at))
                at += size
            self.levels.append(level)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def get(self, i: int) -> int:
        """One id: a byte, a bit and a rank on each level it has."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        out = 0
        for k, (codes, bitmap, directory) in enumerate(self.levels):
            out |= int(codes[i]) << (8 * k)
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            bits = np.unpackbits(bitmap[block * BLOCK // 8 : (i >> 3) + 1], bitorder="little")[: i - block * BLOCK]
            i = int(directory[block]) + int(bits.sum())
        return out

    def all(self) -> np.ndarray:
        out = np.zeros(len(self), np.uint32)
        at = np.arange(len(self))
        for k, (codes, bitmap, _) in enumerate(self.levels):
            out[at] |= codes.astype(np.uint32) << np.uint32(8 * k)
            at = at[np.unpackbits(bitmap, bitorder="little")[: len(at)].astype(bool)]
        return out


def in_order(docs: DataFrame) -> DataFrame:
    """Documents dealt out by ranges of doc_id and sorted in each."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return text_of(docs).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Tokenise whole texts and write them, with an end id after each, to ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        part, number, before = TaskContext.get().partitionId(), 0, 0
        parts, docs_in, ends, total = [], [], [], 0

        def segment() -> pa.RecordBatch:
            ids, stops = np.concatenate(docs_in), np.concatenate(ends)
            return pa.RecordBatch.from_pylist([{"part": part, "segment": number, "before": before, "n_ids": total, "doc_ids": ids.astype("<i8").tobytes(), "doc_ends": stops.astype("<i8").tobytes(), "codes": pack(np.concatenate(parts))}], SCHEMA)

        for batch in batches:
            raw, offsets = A.flat(batch["text"])
            doc_ids = batch["doc_id"].to_numpy()
            for i, j in A.slices(offsets):
                ids, first = encode(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                ids = np.insert(ids, first[1:], end_id)
                parts.append(ids)
                docs_in.append(doc_ids[i:j])
                ends.append(first[1:] + np.arange(1, j - i + 1) + total)
                total += len(ids)
                if total >= SEGMENT_IDS:
                    yield segment()
                    before, number = before + total, number + 1
                    parts, docs_in, ends, total = [], [], [], 0
        if total:
            yield segment()

    in_order(docs).mapInArrow(run, SEGMENTS).write.parquet(path)


SCHEMA = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.binary()), ("doc_ends", pa.binary()), ("codes", pa.binary())])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files at ``path``: (doc_id, start, n_tokens, ids_crc32)."""
    files = spark.read.schema(SEGMENTS).parquet(path)
    # one row for each part that was written, so no more than there were tasks
    totals = {r.part: r.n for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    starts, at = [], 0
    for part in sorted(totals):
        starts.append((part, at))
        at += totals[part]
    parts = F.broadcast(spark.createDataFrame(starts, "part int, part_start long"))
    placed = files.join(parts, "part").withColumn("first", F.col("before") + F.col("part_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, ends = Segment(row["codes"]).all().astype("<u4"), np.frombuffer(row["doc_ends"], "<i8")
                view = memoryview(ids.tobytes())
                begins = np.r_[0, ends[:-1]]
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row["doc_ids"], "<i8")), pa.array(begins + row["first"]), pa.array(ends - begins), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.select("doc_ids", "doc_ends", "codes", "first").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write the token files and read every document back from them."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, path)
    return read_tokens(docs.sparkSession, path)
