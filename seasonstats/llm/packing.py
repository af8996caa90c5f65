"""Packing of token sequences into windows by minimum bin slack.

Each task packs the documents of its partition. Parts that fill a window are cut off first; the rests wait in a pool.
The longest rest opens a window, and a bitset of reachable sums over the lengths in the pool finds the multiset that
comes closest to what is left of it, read back as counts per length; the same window is repeated while the counts last.
Only when the pool runs out is a rest cut to close a window, and the very last one is cut at powers of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonstats.llm.tokenfile import encoded

WINDOW = 2048
POOL = 8192  # rests that wait at most; each is shorter than a window
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part long"
)


def closest_multiset(counts: dict[int, int], room: int) -> dict[int, int]:
    """Counts of lengths, within ``counts``, whose sum comes closest to ``room`` from below."""
    full = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for length in sorted((k for k in counts if k <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            after = (reached | reached << length) & full
            if after == reached:
                break
            steps.append((length, reached))
            reached = after
        if reached >> room & 1:
            break
    left, chosen = reached.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> left & 1:  # not reached without this item
            chosen[length] = chosen.get(length, 0) + 1
            left -= length
    return chosen


def fill_windows(counts: dict[int, int], size: int, least_left: int = 0) -> Iterator[tuple[dict[int, int], int]]:
    """(counts of lengths, how many windows of this kind), taken out of ``counts`` until ``least_left`` rests stay.

    Rests of a length that opens no full window are set aside and left for the caller.
    """
    waiting = sum(counts.values())
    while counts and waiting > least_left:
        longest = max(counts)
        counts[longest] -= 1
        rest = {k: c for k, c in counts.items() if c}
        chosen = closest_multiset(rest, size - longest)
        counts[longest] += 1
        kind = dict(chosen)
        kind[longest] = kind.get(longest, 0) + 1
        if sum(k * c for k, c in kind.items()) < size:
            waiting -= counts.pop(longest)
            continue
        times = min(counts[k] // c for k, c in kind.items())
        for k, c in kind.items():
            counts[k] -= c * times
            if not counts[k]:
                del counts[k]
        waiting -= sum(kind.values()) * times
        yield kind, times


class _Packer:
    def __init__(self, size: int, first: int):
        self.size, self.next = size, first
        self.pool: dict[int, list] = {}
        self.rows: list[tuple] = []

    def _place(self, pieces: list[tuple]) -> None:
        """One sequence of (doc_id, start, ids, doc_tokens, row)."""
        offset = 0
        for doc_id, start, ids, tokens, row in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4")), tokens, self.next, offset, row))
            offset += len(ids)
        self.next += 1

    def add(self, doc_id, ids: np.ndarray, row: int) -> None:
        n, size = len(ids), self.size
        for start in range(0, n - size + 1, size):
            self._place([(doc_id, start, ids[start : start + size], n, row)])
        if start := n % size:
            rest = (doc_id, n - start, ids[n - start :].astype(np.uint32), n, row)
            self.pool.setdefault(start, []).append(rest)

    def waiting(self) -> int:
        return sum(map(len, self.pool.values()))

    def pack(self, least_left: int = 0) -> None:
        counts = {k: len(v) for k, v in self.pool.items()}
        for kind, times in fill_windows(counts, self.size, least_left):
            for _ in range(times):
                self._place([self.pool[k].pop() for k, c in sorted(kind.items(), reverse=True) for _ in range(c)])
        self.pool = {k: v for k, v in self.pool.items() if v}

    def close(self) -> None:
        """Windows of the best fit, closed with part of one more rest; the last one in powers of two."""
        self.pack()
        left = [p for k in sorted(self.pool, reverse=True) for p in self.pool[k]]
        self.pool = {}
        total = sum(len(p[2]) for p in left)
        sizes = [self.size] * (total // self.size)
        sizes += [1 << b for b in reversed(range(self.size.bit_length())) if total % self.size >> b & 1]
        at, used = 0, 0
        for size in sizes:
            pieces = []
            while size:
                doc_id, start, ids, tokens, row = left[at]
                part = ids[used : used + size]
                pieces.append((doc_id, start + used, part, tokens, row))
                size, used = size - len(part), used + len(part)
                if used == len(ids):
                    at, used = at + 1, 0
            self._place(pieces)

    def taken(self) -> pa.RecordBatch:
        names = [c.split()[0] for c in PIECES.split(", ")]
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(names)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pack_documents(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", size: int = WINDOW, pool: int = POOL
) -> DataFrame:
    """The pieces of all rows of ``docs`` by the tokenizer file ``path``: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and part (the row's number within its task, which keeps rows with one id apart).

    Each task numbers its sequences from its partition's number on. Null text is empty, and so its end id alone; a null
    id stays null. ``size`` is a power of two. No text is shuffled; memory is bounded by the pool, a batch and the longest
    document. Other columns are not read; no rows give no pieces.
    """

    def packed(batches):
        packer = _Packer(size, TaskContext.get().partitionId() << 40)
        row = TaskContext.get().partitionId() << 40
        for doc_ids, ids, offsets in encoded(batches, path):
            for doc_id, a, b in zip(doc_ids.to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                packer.add(doc_id, ids[a:b], row)
                row += 1
            if packer.waiting() >= pool:
                packer.pack(pool // 8)
                if packer.waiting() >= pool:  # nothing fits exactly
                    packer.close()
            yield packer.taken()
        packer.close()
        yield packer.taken()
        pa.default_memory_pool().release_unused()

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(packed, PIECES)
