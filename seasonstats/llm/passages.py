"""Substring dedup: repeated passages found, compiled into automata and removed from all but the first document.

1. Every window of ``size`` words has an anchor, the least hash of its five-word sequences. Buckets exchange anchors;
   only windows whose anchor another document has too can be repeated.
2. Buckets exchange the hashes of these windows with the first document that holds each, which confirms the passages.
3. Each bucket compiles the confirmed passages of its documents, as runs of words, into Aho-Corasick automata of bounded
   size and streams all its documents through them; every word of an occurrence goes if the passage's windows start in
   earlier documents.
"""

from __future__ import annotations


import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from seasonstats.llm import exchange as X
from seasonstats.llm.text import gram_hashes, gram_starts, word_hashes, words

WINDOW, SEED = 13, 5
AUTOMATON_WORDS = 1_000_000  # words of the passages of one automaton


class Bucket:
    """The documents of a bucket in ascending order of their ids, as word numbers."""

    def __init__(self, table: pa.Table, size: int):
        ids = pc.fill_null(table.column("doc_id"), int(X.NO_ID)).to_numpy()
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order]
        texts = table.column("text").take(pa.array(self.order))
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        self.known, self.codes, self.offsets = words(texts)
        hashes = word_hashes(self.known)[self.codes]
        seeds = gram_hashes(hashes, SEED)
        # Only windows that lie within a document are read from here on.
        self.starts, self.texts = gram_starts(self.offsets, size)
        low, span, width = seeds, 1, size - SEED + 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:]) if len(low) > span else low[:0]
            span *= 2
        rest = width - span
        low = np.minimum(low[: len(low) - rest], low[rest:]) if rest and len(low) > rest else low
        self.anchors = low[self.starts] if len(self.starts) else np.zeros(0, np.uint64)
        self.seeds, self.size = seeds, size

    def windows(self, chosen: np.ndarray) -> np.ndarray:
        """Hashes of the chosen windows from those of the sequences that cover them."""
        value = np.zeros(int(chosen.sum()), np.uint64)
        first = self.starts[chosen]
        for at in sorted({*range(0, self.size - SEED + 1, SEED), self.size - SEED}):
            value = (value ^ self.seeds[first + at]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(31)
        return value

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Windows whose anchor occurs in another document, of this bucket or of others."""
        anchors, texts = self.anchors, self.texts
        if not len(anchors):
            return np.zeros(0, bool)
        new = np.ones(len(anchors), bool)  # runs of windows have one anchor
        new[1:] = (anchors[1:] != anchors[:-1]) | (texts[1:] != texts[:-1])
        a, t = anchors[new], texts[new]
        order = np.argsort(a, kind="stable")
        a, t = a[order], t[order]
        twice = (a[1:] == a[:-1]) & (t[1:] != t[:-1])
        known = np.union1d(shared, a[1:][twice])
        return X.member(anchors, known)

    def firsts(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(candidate windows, their distinct hashes, the first document of each)."""
        chosen = self.candidates(shared)
        hashes, first = np.unique(self.windows(chosen), return_index=True)
        return chosen, hashes, self.ids[self.texts[chosen][first]]


def _earlier(messages: list[X.Message]):
    """For each bucket the windows that start in a document of another bucket before its own first one."""
    hashes = np.concatenate([m.hashes for m in messages])
    firsts = np.concatenate([m.extra for m in messages])
    order = np.lexsort((firsts, hashes))
    every, at = np.unique(hashes[order], return_index=True)
    least = firsts[order][at]
    for m in messages:
        first = least[np.searchsorted(every, m.hashes)]
        kept = first < m.extra
        yield m.bucket, m.hashes[kept], first[kept]


def _as_text(codes: np.ndarray) -> str:
    """One character for each word number; surrogates are left out."""
    return (codes + np.where(codes >= 0xD800, 0x800, 0)).astype("<u4").tobytes().decode("utf-32-le")


def covered_words(codes: np.ndarray, offsets: np.ndarray, ids: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Words within an occurrence of a passage that starts earlier. ``runs``: (first word, end, last of the first
    documents of its windows) of every confirmed passage."""
    covered = np.zeros(len(codes), bool)
    begin = 0
    while begin < len(runs):
        stop, total = begin, 0
        while stop < len(runs) and (stop == begin or total + runs[stop][1] - runs[stop][0] <= AUTOMATON_WORDS):
            total += runs[stop][1] - runs[stop][0]
            stop += 1
        shard, begin = runs[begin:stop], stop
        used = np.unique(np.concatenate([codes[a:b] for a, b, _ in shard]))
        small = np.zeros(int(codes.max()) + 1, np.int64)  # 0: in no passage
        small[used] = np.arange(1, len(used) + 1)
        local = small[codes]
        automaton = ahocorasick.Automaton()
        for a, b, first in shard:
            automaton.add_word(_as_text(local[a:b]), (b - a, first))
        automaton.make_automaton()
        for i, own in enumerate(ids.tolist()):
            a, b = int(offsets[i]), int(offsets[i + 1])
            for end, (length, first) in automaton.iter(_as_text(local[a:b])):
                if first < own:
                    covered[a + end + 1 - length : a + end + 1] = True
    return covered


def _removed(table: pa.Table, size: int, shared: tuple, earlier: tuple) -> pa.Table:
    bucket = Bucket(table, size)
    chosen, hashes, own = bucket.firsts(shared[0])
    known, at = X.found_at(hashes, earlier[0])
    first = own.copy()
    first[known] = np.minimum(own[known], earlier[1][at[known]])
    where = np.flatnonzero(chosen)
    least = first[np.searchsorted(hashes, bucket.windows(chosen))]
    repeated = least < bucket.ids[bucket.texts[where]]
    where, least = where[repeated], least[repeated]
    starts, texts = bucket.starts[where], bucket.texts[where]
    runs = {}
    if len(starts):
        edge = np.flatnonzero((np.diff(starts) != 1) | (np.diff(texts) != 0)) + 1
        begins, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(starts)]])
        last = np.maximum.reduceat(least, begins)
        for a, b, f in zip(starts[begins].tolist(), (starts[ends - 1] + size).tolist(), last.tolist(), strict=True):
            runs.setdefault(bucket.codes[a:b].tobytes(), (a, b, f))
    covered = covered_words(bucket.codes, bucket.offsets, bucket.ids, list(runs.values()))
    upto = np.concatenate([[0], np.cumsum(~covered)])[bucket.offsets]
    kept = bucket.known.take(pa.array(bucket.codes[~covered]))
    lists = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), kept)
    joined = pc.binary_join(lists, " ")
    n_words = np.diff(bucket.offsets)
    return pa.table(
        {
            "doc_id": pa.array(bucket.ids, pa.int64(), mask=bucket.ids == X.NO_ID),
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_words - np.diff(upto), pa.int64()),
            "kept_text": joined.cast(pa.string()),
        }
    )


def remove_repeated_passages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = WINDOW
) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (the words that stay, joined by blanks) of every row of ``docs``.

    A word goes if a window of ``size`` words covers it whose sequence also starts in a document with a smaller id;
    windows are judged on the input. Null and empty texts have no words. A null id counts as later than all others;
    rows with the same id remove nothing from each other. Hashes of 64 bits choose the candidates and confirm the
    passages; occurrences are matched word by word. Other columns are not read.
    """
    buckets = X.bucket_count(docs, text_column)
    dealt = X.deal(docs, buckets, id_column, text_column)

    def anchors(table):
        return np.unique(Bucket(table, size).anchors), None

    def confirmable(table, shared, _):
        _, hashes, first = Bucket(table, size).firsts(shared)
        return hashes, first

    shared = X.answer(X.send(dealt, buckets, anchors), X.shared_by_buckets)
    windows = X.send(dealt, buckets, confirmable, shared, kind=np.int64)
    earlier = X.answer(windows, _earlier, np.int64, np.int64)
    # One list of replies a bucket; only the second kind has numbers.
    replies = shared.unionByName(earlier)

    def removed(_, table, said):
        confirmed = said.column("extra").is_valid()
        return _removed(
            table, size, X.gathered(said.filter(pc.invert(confirmed)), None), X.gathered(said.filter(confirmed), np.int64)
        )

    schema = "doc_id long, n_words long, n_removed long, kept_text string"
    return X.with_their_replies(dealt, replies, buckets).applyInArrow(removed, schema)


