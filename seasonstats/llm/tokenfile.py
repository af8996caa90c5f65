"""Token ids of documents in a binary form: blocks of ids in one run, document ends in Elias-Fano code.

A file row is a block of whole documents in ascending order of their ids: ``ids`` holds all their token ids (2 bytes
each while they fit, else 4; little-endian), ``low`` and ``high`` the ends of the documents, and ``marks`` the place of
every 256th set bit of ``high``, from which any end is found. ``shard`` and ``before`` place the block: ids of earlier
shards, then ``before`` ids of the same shard, come first. Spark writes the rows as Parquet wherever it can write.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonstats.llm.text import chunks, subwords

END = 1
BLOCK_IDS = 1 << 20
BLOCKS = (
    "shard int, block int, before long, n_ids long, width int, doc_ids array<long>, low_bits int, low binary, "
    "high binary, marks binary, ids binary"
)


class EliasFano:
    """Ascending numbers in about 2 + log2(last / count) bits each: low bits as they are, high bits as gaps in unary."""

    EVERY = 256

    def __init__(self, count: int, low_bits: int, low: bytes, high: bytes, marks: bytes):
        self.count, self.low_bits = count, low_bits
        self.low, self.high, self.marks = low, high, np.frombuffer(marks, "<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n, last = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (last // n).bit_length() - 1) if n else 0
        lows = (values[:, None] >> np.arange(low_bits)) & 1
        ones = (values >> low_bits) + np.arange(n)
        bits = np.zeros((last >> low_bits) + n + 1, np.uint8)
        bits[ones] = 1
        marks = ones[:: cls.EVERY].astype("<u4").tobytes()
        pack = lambda b: np.packbits(b.astype(np.uint8).ravel(), bitorder="little").tobytes()
        return cls(n, low_bits, pack(lows), pack(bits), marks)

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        part = self.low[first // 8 : (first + self.low_bits + 7) // 8]
        return (int.from_bytes(part, "little") >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The number at place ``i``, by a walk from the nearest mark."""
        place, left = int(self.marks[i // self.EVERY]), i % self.EVERY
        byte = place // 8
        value = self.high[byte] >> (place % 8) << (place % 8)
        while value.bit_count() <= left:
            left -= value.bit_count()
            byte += 1
            value = self.high[byte]
        for _ in range(left):
            value &= value - 1
        place = byte * 8 + (value & -value).bit_length() - 1
        return (place - i) << self.low_bits | self._low(i)

    def values(self) -> np.ndarray:
        """All numbers."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.count]
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.count * self.low_bits]
        lows = bits.reshape(self.count, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits))
        return ((ones - np.arange(self.count)) << self.low_bits) | lows.astype(np.int64)


def with_ends(ids: np.ndarray, offsets: np.ndarray, end: int = END) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets with ``end`` after every text."""
    n = len(offsets) - 1
    out = np.empty(len(ids) + n, np.int32)
    last = offsets[1:] + np.arange(n)
    kept = np.ones(len(out), bool)
    kept[last] = False
    out[last], out[kept] = end, ids
    return out, offsets + np.arange(n + 1)


def encoded(batches, path: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(doc_ids, ids with ends, offsets) for parts of the batches, in order."""
    encoder = subwords(path)
    for batch in batches:
        for part in chunks(batch):
            yield part.column("doc_id"), *with_ends(*encoder.encode(part.column("text")))


def _block(shard: int, block: int, before: int, doc_ids: list, ids: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    fano = EliasFano.of(ends)
    width = 2 if int(ids.max()) < 1 << 16 else 4
    row = [shard, block, before, len(ids), width, doc_ids, fano.low_bits, fano.low, fano.high, fano.marks.tobytes(),
           ids.astype(f"<u{width}").tobytes()]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int32(), *[pa.binary()] * 4]
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)


def write_token_file(
    docs: DataFrame, target: str, path: str, id_column: str = "doc_id", text_column: str = "text", block_ids: int = BLOCK_IDS
) -> None:
    """Write the blocks of all rows of ``docs`` to ``target`` with the tokenizer file ``path``.

    Null text is empty and is its end id alone; a null id comes last; rows with one id follow one another. A text longer
    than a block is a block of its own. Other columns are not read; no rows give no blocks.
    """
    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    place = F.col("doc_id").asc_nulls_last()

    def blocks(batches):
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        names, parts, ends, size = [], [], [], 0
        for doc_ids, ids, offsets in encoded(batches, path):
            doc_ids, start = doc_ids.to_pylist(), 0
            while start < len(doc_ids):
                stop = int(np.searchsorted(offsets, offsets[start] + block_ids - size, "right")) - 1
                stop = max(stop, start + (not names))
                names += doc_ids[start:stop]
                parts.append(ids[offsets[start] : offsets[stop]])
                ends.append(offsets[start + 1 : stop + 1] - offsets[start] + size)
                size += len(parts[-1])
                start = stop
                if start < len(doc_ids):
                    yield _block(shard, number, before, names, np.concatenate(parts), np.concatenate(ends))
                    number, before = number + 1, before + size
                    names, parts, ends, size = [], [], [], 0
        if names:
            yield _block(shard, number, before, names, np.concatenate(parts), np.concatenate(ends))

    dealt = chosen.repartitionByRange(place).sortWithinPartitions(place)
    dealt.mapInArrow(blocks, BLOCKS).write.option("compression", "zstd").parquet(target)


def read_token_file(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of each document, read off the blocks."""
    rows = spark.read.schema(BLOCKS).parquet(target)
    # A row per shard, of which there are no more than the writing tasks.
    shards = rows.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
    placed = rows.join(F.broadcast(shards), "shard").withColumn("first", F.col("first") + F.col("before"))

    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["doc_ids"])
                ends = EliasFano(n, row["low_bits"], row["low"], row["high"], row["marks"]).values()
                starts = np.concatenate([[0], ends[:-1]])
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first"]), pa.array(ends - starts),
                     pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    columns = ["first", "doc_ids", "width", "low_bits", "low", "high", "marks", "ids"]
    return placed.select(*columns).mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")
