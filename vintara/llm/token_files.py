"""Token-id files: one id array per file, with Elias-Fano encoded document boundaries.

A file holds, in this order (little-endian): ``MAGIC``, the header (see ``HEADER``), the ids as unsigned 16 or 32
bits, and two Elias-Fano lists, the ends of the documents in the id array and the document ids. An Elias-Fano
list of n ascending numbers below u keeps the low bits of each number in a packed array and the high bits in
unary in a bitmap: about 2 + log2(u / n) bits a number. ``select`` finds any number from samples of the
bitmap, so no table of 64-bit offsets is kept or built.

Texts are put in order of their ids by range over many tasks; each task encodes its texts in chunks and
writes one file under a name of its own, so a task that runs twice leaves a file that nobody refers to. The
manifest (one row per file) gives the ids before each file.

Defined cases: null and empty texts consist of the end id; null ids come first and are counted in the
header; rows that repeat an id are stored one after another; an empty table gives an empty manifest; other columns are not
read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vintara.llm.common import files_at, new_folder
from vintara.llm.token_ids import encoder

MAGIC = b"VTOK0001"
HEADER = "<QQQqQ"  # documents, of these without id, ids, first document id, bytes an id
LIST = "<QQB"  # numbers, greatest number, low bits
SAMPLE = 64  # every so many numbers select has a sample
MANIFEST = "path string, documents long, ids long, first long, nulls long"


class EliasFano:
    """Ascending numbers in near-minimal space."""

    def __init__(self, size: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.size, self.low_bits, self.low, self.high = size, low_bits, low, high
        self._samples: np.ndarray | None = None

    @classmethod
    def encoded(cls, numbers: np.ndarray) -> bytes:
        numbers = np.asarray(numbers, dtype=np.uint64)
        n, top = len(numbers), int(numbers[-1]) if len(numbers) else 0
        low_bits = max(0, ((top + 1) // n).bit_length() - 1) if n else 0
        bits = (numbers[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = np.zeros((top >> low_bits) + n + 1 if n else 0, dtype=np.uint8)
        ones[(numbers >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        return struct.pack(LIST, n, top, low_bits) + low + np.packbits(ones, bitorder="little").tobytes()

    @classmethod
    def read(cls, data: memoryview) -> tuple[EliasFano, int]:
        """The list at the start of ``data`` and how many bytes it takes."""
        n, top, low_bits = struct.unpack_from(LIST, data)
        lows = -(-n * low_bits // 8)
        highs = -(-((top >> low_bits) + n + 1) // 8) if n else 0
        at = struct.calcsize(LIST)
        return cls(n, low_bits, np.frombuffer(data[at:at + lows], dtype=np.uint8),
                   np.frombuffer(data[at + lows:at + lows + highs], dtype=np.uint8)), at + lows + highs

    def _low(self, i: int) -> int:
        first, value = i * self.low_bits, 0
        for k in range(self.low_bits):
            value |= int(self.low[(first + k) >> 3] >> ((first + k) & 7) & 1) << k
        return value

    def select(self, i: int) -> int:
        """The ``i``-th number."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        if self._samples is None:  # byte of the bitmap, and ones before it, for each sampled number
            before = np.cumsum(np.bitwise_count(self.high), dtype=np.uint32)
            at = np.searchsorted(before, np.arange(0, self.size, SAMPLE, dtype=np.uint32), side="right")
            self._samples = np.stack([at.astype(np.uint32), np.where(at > 0, before[at - 1], 0).astype(np.uint32)], axis=1)
        byte, ones = map(int, self._samples[i // SAMPLE])
        while ones + (count := int(self.high[byte]).bit_count()) <= i:
            ones, byte = ones + count, byte + 1
        rest = int(self.high[byte])
        for _ in range(i - ones):
            rest &= rest - 1
        position = byte * 8 + (rest & -rest).bit_length() - 1
        return (position - i) << self.low_bits | self._low(i)

    def all(self) -> np.ndarray:
        """Every number, decoded at once."""
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.size] - np.arange(self.size)
        bits = np.unpackbits(self.low, count=self.size * self.low_bits, bitorder="little").reshape(self.size, self.low_bits)
        low = (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1) if self.low_bits else 0
        return (high.astype(np.int64) << self.low_bits) + low


class TokenFile:
    """A file's documents, by position: ids of one document without reading the others' boundaries."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        if view[:8] != MAGIC:
            raise ValueError("no token file")
        self.documents, self.nulls, self.n_ids, self.first, self.width = struct.unpack_from(HEADER, view, 8)
        at = 8 + struct.calcsize(HEADER)
        self.ids = np.frombuffer(view[at:at + self.n_ids * self.width], dtype=f"<u{self.width}")
        at += self.n_ids * self.width
        self.ends, used = EliasFano.read(view[at:])
        self.doc_ids, _ = EliasFano.read(view[at + used:])

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0:self.ends.select(i)]


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, width: int = 2, text: str = "text",
                      identifier: str = "doc_id", tasks: int | None = None) -> DataFrame:
    """Write the files into ``folder``; returns the manifest, itself written there."""
    spark = docs.sparkSession
    tasks = tasks or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], dtype="<u4")
        filesystem, base = files_at(folder)
        path = f"{base}/{uuid.uuid4().hex}.vtok"
        lengths: list[np.ndarray] = []
        known: list[np.ndarray] = []
        nulls, body = 0, None
        chunks: list[np.ndarray] = []
        for frame in frames:
            sizes = []
            for content in frame["_text"]:
                ids = np.frombuffer(encode(content), dtype="<u4")
                if width < 4 and len(ids) and int(ids.max()) >> (8 * width):
                    raise ValueError(f"ids of this tokenizer need more than {width} bytes")
                chunks += [ids.astype(f"<u{width}"), end.astype(f"<u{width}")]
                sizes.append(len(ids) + 1)
            lengths.append(np.array(sizes, dtype=np.int64))
            none = frame["_none"].to_numpy(dtype=bool)
            nulls += int(none.sum())
            known.append(frame["_id"].to_numpy(dtype=np.int64)[~none])
            chunks = [np.concatenate(chunks)] if chunks else []
        if not lengths or not sum(map(len, lengths)):
            return
        ends, ids = np.cumsum(np.concatenate(lengths)), np.concatenate(known)
        first = int(ids[0]) if len(ids) else 0
        with filesystem.open_output_stream(path) as body:
            body.write(MAGIC + struct.pack(HEADER, len(ends), nulls, int(ends[-1]), first, width))
            for chunk in chunks:
                body.write(chunk.tobytes())
            body.write(EliasFano.encoded(ends))
            body.write(EliasFano.encoded(ids.astype(object) - first if len(ids) else ids))
        yield pd.DataFrame({"path": [path], "documents": [len(ends)], "ids": [int(ends[-1])], "first": [first], "nulls": [nulls]})

    filesystem, base = files_at(folder)
    filesystem.create_dir(base, recursive=True)
    rows = docs.select(F.col(identifier).cast("long").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    files = rows.repartitionByRange(tasks, F.col("_key").asc_nulls_first()).sortWithinPartitions(
        F.col("_key").asc_nulls_first()).select(
        F.coalesce("_key", F.lit(0)).alias("_id"), F.col("_key").isNull().alias("_none"), "_text").mapInPandas(run, MANIFEST)
    files.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_token_files(manifest: DataFrame, identifier: str = "doc_id") -> DataFrame:
    """One row per stored document: ``identifier``, start (ids of all documents before it), n_tokens, ids_crc32 (CRC of the
    ids as unsigned 32 bits). Rows of one file come from that file alone."""
    order = [F.col("nulls").desc(), F.col("first"), F.col("path")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    based = manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, base in zip(frame["path"], frame["base"], strict=True):
                filesystem, where = files_at(path)
                with filesystem.open_input_stream(where) as stream:
                    stored = TokenFile(stream.read())
                ends = stored.ends.all()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                sums = [zlib.crc32(stored.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=True)]
                ids = pd.array([None] * stored.nulls + list(stored.doc_ids.all() + stored.first), dtype="Int64")
                yield pd.DataFrame({"doc_id": ids, "start": starts + base, "n_tokens": ends - starts, "ids_crc32": sums})

    # a file is the unit of work, so each gets a task of its own
    spark = manifest.sparkSession
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return based.repartition(tasks, "path").select("path", "base").mapInPandas(run, READ).withColumnRenamed("doc_id", identifier)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    return read_token_files(write_token_files(docs, tokenizer, new_folder(spark, "token-files"), end_id))
