"""Exchange of n-gram hashes between buckets of documents.

Documents are dealt once into buckets by id and text. Each bucket sends its distinct hashes, cut by value into as many ranges,
and gets back what the other buckets know of them. A hash thus travels once per bucket however many documents hold it,
and in sorted arrays rather than in rows. All passes over the documents read the same shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BYTES, MOST_BUCKET_BYTES = 8 << 20, 64 << 20
NO_ID = np.iinfo(np.int64).max  # stands for a null id, after all others

MESSAGE = "part int, bucket int, hashes binary, extra binary"


@dataclass(frozen=True)
class Message:
    """Sorted distinct hashes of one bucket, with a number for each."""

    bucket: int
    hashes: np.ndarray
    extra: np.ndarray | None


def bucket_count(docs: DataFrame, text_column: str = "text") -> int:
    """Buckets of some 8 MB of text; larger ones, up to 64 MB, as the input grows beyond a gigabyte."""
    size = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0  # one number
    each = min(MOST_BUCKET_BYTES, int(BUCKET_BYTES * math.sqrt(max(1.0, size / 1e9))))
    return max(1, math.ceil(size / each))


def deal(docs: DataFrame, buckets: int, id_column: str = "doc_id", text_column: str = "text", *more: Column) -> DataFrame:
    """(bucket, doc_id, text, *more) shuffled into buckets by id and text, so that the rows of a frequent id, or without
    one, spread over all buckets. Every job deals alike."""
    bucket = F.pmod(F.xxhash64(F.col(id_column), F.col(text_column)), F.lit(buckets)).cast("int").alias("bucket")
    named = docs.select(bucket, F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), *more)
    return named.repartition(buckets, "bucket")


def packed(values: np.ndarray) -> bytes:
    """Bytes of the same place side by side, so that the shuffle's compression finds the slowly growing ones."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _table(rows: list[tuple]) -> pa.Table:
    part, bucket, hashes, extra = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table(
        {
            "part": pa.array(part, pa.int32()), "bucket": pa.array(bucket, pa.int32()),
            "hashes": pa.array(hashes, pa.binary()), "extra": pa.array(extra, pa.binary()),
        }
    )


def _messages(table: pa.Table, kind: type | None) -> list[Message]:
    return [
        Message(bucket, unpacked(hashes, np.uint64), None if kind is None else unpacked(extra, kind))
        for bucket, hashes, extra in zip(*(table.column(c).to_pylist() for c in ("bucket", "hashes", "extra")), strict=True)
    ]


def cut(bucket: int, found: tuple | list, buckets: int, kind: type | None = None, limit: int = 1 << 64) -> pa.Table:
    """Messages of a bucket, by range of hashes below ``limit``: part p has the hashes from p * width on."""
    width = -(-limit // buckets)
    bounds = np.array([min(p * width, (1 << 64) - 1) for p in range(1, buckets)], np.uint64)
    rows = []
    for name, hashes, extra in found if isinstance(found, list) else [(bucket, *found)]:
        at = [0, *np.searchsorted(hashes, bounds).tolist(), len(hashes)]
        rows += [
            (p, name, packed(hashes[a:b]), None if kind is None else packed(extra[a:b].astype(kind)))
            for p, (a, b) in enumerate(zip(at, at[1:], strict=False)) if b > a
        ]
    return _table(rows)


def send(
    dealt: DataFrame, buckets: int, find: Callable, replies: DataFrame | None = None, kind: type | None = None,
    reply_kind: type | None = None, limit: int = 1 << 64,
) -> DataFrame:
    """Messages of ``find(table[, hashes, extra]) -> (sorted hashes, extra)`` for every bucket, by range of hashes below
    ``limit``. With ``replies`` it gets what they say for the bucket. A list of (name, hashes, extra) sends messages under
    other, negative names than the bucket's, too."""
    if replies is None:
        return dealt.groupBy("bucket").applyInArrow(
            lambda key, table: cut(key[0].as_py(), find(table), buckets, kind, limit), MESSAGE
        )

    def with_replies(key, table, said):
        return cut(key[0].as_py(), find(table, *gathered(said, reply_kind)), buckets, kind, limit)

    return with_their_replies(dealt, replies, buckets).applyInArrow(with_replies, MESSAGE)


def with_their_replies(dealt: DataFrame, replies: DataFrame, buckets: int):
    """Documents and replies of each bucket side by side; only the replies are shuffled."""
    return dealt.groupBy("bucket").cogroup(replies.repartition(buckets, "bucket").groupBy("bucket"))


def gathered(said: pa.Table, kind: type | None) -> tuple[np.ndarray, np.ndarray | None]:
    """(sorted hashes, their numbers) of all replies to a bucket."""
    messages = _messages(said, kind)
    if not messages:
        return np.zeros(0, np.uint64), None if kind is None else np.zeros(0, kind)
    hashes = np.concatenate([m.hashes for m in messages])
    order = np.argsort(hashes)
    extra = None if kind is None else np.concatenate([m.extra for m in messages])[order]
    return hashes[order], extra


def answer(messages: DataFrame, reply: Callable, kind: type | None = None, reply_kind: type | None = None) -> DataFrame:
    """Replies: for each range of hashes ``reply(messages)`` yields (bucket, hashes, extra)."""

    def ranged(key, table):
        return _table([
            (key[0].as_py(), bucket, packed(hashes), None if reply_kind is None else packed(extra.astype(reply_kind)))
            for bucket, hashes, extra in reply(_messages(table, kind)) if len(hashes)
        ])

    return messages.groupBy("part").applyInArrow(ranged, MESSAGE)


def shared_by_buckets(messages: list[Message]) -> Iterator[tuple[int, np.ndarray, None]]:
    """Each bucket's hashes that another bucket has too."""
    every, counts = np.unique(np.concatenate([m.hashes for m in messages]), return_counts=True)
    shared = every[counts > 1]
    for m in messages:
        yield m.bucket, m.hashes[member(m.hashes, shared)], None


def totals(messages: list[Message], least: int = 1) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each bucket's hashes with their sums over all buckets, if these reach ``least``."""
    every, place = np.unique(np.concatenate([m.hashes for m in messages]), return_inverse=True)
    sums = np.zeros(len(every), np.int64)
    np.add.at(sums, place, np.concatenate([m.extra for m in messages]).astype(np.int64))
    start = 0
    for m in messages:
        own = sums[place[start : start + len(m.hashes)]]
        start += len(m.hashes)
        kept = own >= least
        yield m.bucket, m.hashes[kept], own[kept]


def found_at(values: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is it in the sorted array, where) for each value."""
    if not len(among):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values, at


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    return found_at(values, among)[0]
