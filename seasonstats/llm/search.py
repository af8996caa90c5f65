"""Ranked lexical search over an index of document shards, by a hybrid of term-at-a-time and document-at-a-time.

Every few megabytes of text become a shard with an inverted index of its own, so indexing shuffles nothing. A search
takes the items in blocks of bounded size to all shards. In a shard, an item's short lists are added up term by term
into one array of sums, which from then on is a list like any other, with its largest sum as bound. This list and the
long ones are walked document by document, a window of documents at a time: lists whose bounds together stay below the
score of the last place are not walked but only probed at the documents the others bring up, the largest bound first,
and documents drop out as soon as the bounds left cannot lift them to the last place. A task keeps its best from shard
to shard, so that the last place rises, and hands on no more rows than places.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonstats.functions.ordering import with_running_totals
from seasonstats.llm.text import chunks, words
from seasonstats.sources.shared import materialize

SHARD_BYTES = 4 << 20
PLACES = 20
BLOCK_BYTES = 4 << 20  # text of the items that are sent to all shards at once
ITEM_BYTES = 1 << 10  # what an item counts for beside its text
SHORT = 64  # a list is short if it holds at most one in so many of the shard's documents
WINDOWS = 8  # of the documents of a shard; the first are the smallest

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_SHARD = (
    "n_docs long, n_terms long, doc_ids array<long>, sizes binary, terms array<string>, starts binary, postings binary, "
    "counts binary"
)
# Shards are megabytes each, and Parquet's writer would hold 100 of them before it looks at their size; its reader holds a group.
_STORED = {
    "compression": "zstd", "parquet.block.size": str(2 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1",
}


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct terms, number of each term in them, where each text's terms start) of texts without an offset."""
    filled = pc.fill_null(texts, "")
    _, offsets, values = filled.buffers()
    plain = (values.to_pybytes() if values else b"").translate(_PLAIN)
    return words(pa.Array.from_buffers(filled.type, len(filled), [None, offsets, pa.py_buffer(plain)], offset=filled.offset))


def item_terms(text: str | None) -> list[str]:
    return [t.encode().translate(_PLAIN).decode() for t in TERM.findall(text or "")]


def _shard(part: pa.RecordBatch) -> pa.RecordBatch:
    part = part.take(pc.sort_indices(part, sort_keys=[("doc_id", "ascending")], null_placement="at_end"))
    known, codes, offsets = _terms(part.column("text"))
    n = part.num_rows
    sizes = np.diff(offsets)
    keys, counts = np.unique(codes.astype(np.int64) * n + np.repeat(np.arange(n), sizes), return_counts=True)
    starts = np.searchsorted(keys, np.arange(len(known) + 1) * n)
    row = [int((sizes > 0).sum()), len(codes), part.column("doc_id").to_pylist(), sizes.astype("<i8").tobytes(), known.to_pylist(),
           starts.astype("<i8").tobytes(), (keys % max(n, 1)).astype("<i4").tobytes(), counts.astype("<i8").tobytes()]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.string()), *[pa.binary()] * 3]
    names = [c.split()[0] for c in _SHARD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)


def build_index(docs: DataFrame, folder: str, id_column: str = "doc_id", text_column: str = "text", shard_bytes: int = SHARD_BYTES) -> None:
    """Write the inverted index of the whole texts of all rows of ``docs``, one row per shard.

    Terms are runs of letters and digits, in which all characters beyond ASCII count as letters; A to Z are
    lower-cased. Null text has no term and stands in no list. A text larger than a shard is a shard of its own. Other
    columns are not read. No rows give no shards.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, size=shard_bytes):
                yield _shard(part)

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    chosen.mapInArrow(index, _SHARD).write.options(**_STORED).parquet(folder)


@dataclass
class Postings:
    """A list of documents of a shard in ascending order, what each adds to a score, and the most that any adds."""

    documents: np.ndarray
    adds: np.ndarray
    bound: int

    def between(self, first: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.searchsorted(self.documents, [first, stop])
        return self.documents[a:b], self.adds[a:b]

    def at(self, documents: np.ndarray) -> np.ndarray:
        """What this list adds to each of some ascending documents, found by skips."""
        place = np.minimum(np.searchsorted(self.documents, documents), len(self.documents) - 1)
        return np.where(self.documents[place] == documents, self.adds[place], 0)


def summed(lists: list[Postings]) -> Postings:
    """Term at a time: one list of the sums of ``lists``."""
    documents, place = np.unique(np.concatenate([p.documents for p in lists]), return_inverse=True)
    sums, start = np.zeros(len(documents), np.int64), 0
    for p in lists:  # a document stands once in a list
        sums[place[start : start + len(p.adds)]] += p.adds
        start += len(p.adds)
    return Postings(documents, sums, int(sums.max()))


@dataclass
class Best:
    """The places of one item so far: highest score first, then the smallest id, a null id last."""

    places: int
    scores: np.ndarray
    ids: list

    @property
    def least(self) -> int:
        """The score from which a document may still come in."""
        return int(self.scores[-1]) if len(self.scores) == self.places else 1

    def take(self, scores: np.ndarray, ids: list) -> None:
        scores, ids = np.concatenate([self.scores, scores]), [*self.ids, *ids]
        order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i] is None, ids[i] or 0))[: self.places]
        self.scores, self.ids = scores[order], [ids[i] for i in order]


def _walk(lists: list[Postings], n_docs: int, doc_ids: list, best: Best) -> None:
    """Document at a time: let the documents of ``lists`` that reach a place of ``best`` in."""
    lists = sorted(lists, key=lambda p: p.bound)
    within = np.cumsum([p.bound for p in lists])  # the most that the lists up to this one add together
    first, width = 0, max(256, n_docs >> WINDOWS)
    while first < n_docs and within[-1] >= best.least:
        stop = min(n_docs, first + width)
        probed = int(np.searchsorted(within, best.least))  # these alone reach no place
        sums = np.zeros(stop - first, np.int64)
        for p in lists[probed:]:
            documents, adds = p.between(first, stop)
            sums[documents - first] += adds
        found = np.flatnonzero(sums)
        scores = sums[found]
        found += first
        for i in range(probed - 1, -1, -1):
            kept = scores + within[i] >= best.least
            found, scores = found[kept], scores[kept]
            if not len(found):
                break
            scores = scores + lists[i].at(found)
        kept = scores >= best.least
        if kept.any():
            found, scores = found[kept], scores[kept]
            if len(found) > best.places:  # all that tie with the last place stay
                enough = scores >= -np.partition(-scores, best.places - 1)[best.places - 1]
                found, scores = found[enough], scores[enough]
            best.take(scores, [doc_ids[i] for i in found.tolist()])
        first, width = stop, 2 * width


@dataclass(frozen=True)
class Block:
    """Items that are searched together: their distinct terms in order, with weights, and what each item asks for."""

    terms: list[str]
    weights: np.ndarray
    asked: list[list[tuple[int, int]]]
    places: int
    documents: int
    all_terms: int

    def adds(self, weight: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What a term that a document of ``sizes`` terms holds ``counts`` times adds to its score."""
        if len(sizes) and int(sizes.max()) * 25 * self.documents >= 1 << 63:
            share = np.array([25 * n * self.documents // self.all_terms for n in sizes.tolist()], np.int64)
        else:
            share = 25 * sizes * self.documents // max(1, self.all_terms)
        return weight * ((1_000_000_000 * counts) // (1000 * counts + 12 * (75 + share)))

    def search(self, row: dict, best: list[Best]) -> None:
        """Let the documents of a shard into the places of all items."""
        place = pc.index_in(pa.array(self.terms, pa.string()), pa.array(row["terms"], pa.string())).to_numpy(zero_copy_only=False)
        held = np.flatnonzero(~np.isnan(place))
        if not len(held):
            return
        place = place[held].astype(np.int64)
        starts, sizes = np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["sizes"], "<i8")
        documents, counts = np.frombuffer(row["postings"], "<i4"), np.frombuffer(row["counts"], "<i8")
        lists = {}
        for term, at in zip(held.tolist(), place.tolist(), strict=True):
            own = documents[starts[at] : starts[at + 1]]
            adds = self.adds(self.weights[term], counts[starts[at] : starts[at + 1]], sizes[own])
            lists[term] = Postings(own, adds, int(adds.max()))
        n_docs, doc_ids = len(sizes), row["doc_ids"]
        for wanted, found in zip(self.asked, best, strict=True):
            own = [
                lists[t] if times == 1 else Postings(lists[t].documents, times * lists[t].adds, times * lists[t].bound)
                for t, times in wanted if t in lists
            ]
            if sum(p.bound for p in own) < found.least:
                continue
            short = [p for p in own if len(p.documents) * SHORT <= n_docs]
            if len(short) > 1:
                own = [summed(short), *[p for p in own if len(p.documents) * SHORT > n_docs]]
            _walk(own, n_docs, doc_ids, found)


def _document_counts(shards: DataFrame, terms: list[str]) -> dict[int, int]:
    """Number of documents with each of ``terms``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total = pa.array(terms, pa.string()), np.zeros(len(terms), np.int64)
        for batch in batches:
            for known, starts in zip(batch.column("terms"), batch.column("starts"), strict=True):
                place = pc.index_in(wanted, known.values).to_numpy(zero_copy_only=False)
                held = np.flatnonzero(~np.isnan(place))
                total[held] += np.diff(np.frombuffer(starts.as_py(), "<i8"))[place[held].astype(np.int64)]
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "documents"])

    found = shards.select("terms", "starts").mapInArrow(count, "term long, documents long")
    return dict(found.groupBy("term").agg(F.sum("documents")).collect())  # a row per term of the block


def _blocks(items: DataFrame, id_column: str, text_column: str, block_bytes: int) -> Iterator[list]:
    """The items in blocks of about ``block_bytes``."""
    chosen = items.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + ITEM_BYTES
    order = [F.col("item_id"), F.xxhash64("text")]
    placed = with_running_totals(chosen, [], order, {"size": size.cast("long")})
    placed = materialize(placed.select("item_id", "text", F.floor(F.col("size_before") / block_bytes).alias("part")), "items")
    for part in range((placed.agg(F.max("part")).first()[0] or 0) + 1):  # one number
        yield placed.where(F.col("part") == part).orderBy("item_id").collect()


def search(
    spark: SparkSession, folder: str, items: DataFrame, places: int = PLACES, id_column: str = "item_id", text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``places`` documents of the index with the highest scores above 0 for every item.

    Equal scores rank by ascending id, a null id last. Repeated items, and items without an id, are items of their own;
    an item without a term has no rows. Scores are whole numbers, exact up to 64 bits. Without items or documents
    there are no rows.
    """
    shards = spark.read.schema(_SHARD).parquet(folder)
    documents, all_terms = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()  # two numbers
    documents, all_terms = documents or 0, all_terms or 0
    found = []
    for part, rows in enumerate(_blocks(items, id_column, text_column, block_bytes)):
        wanted = [Counter(item_terms(r["text"])) for r in rows]
        terms = sorted(set().union(*wanted))
        held = _document_counts(shards, terms)
        weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * held.get(i, 0) + 1))) for i in range(len(terms))]
        place = {t: i for i, t in enumerate(terms)}
        block = Block(
            terms, np.array(weights, np.int64), [[(place[t], n) for t, n in w.items()] for w in wanted], places, documents, all_terms
        )
        numbers = [r["item_id"] for r in rows]
        found.append(materialize(_searched(shards, block, numbers).withColumn("part", F.lit(part)), "found"))
    best = Window.partitionBy("part", "item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = [f.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= places) for f in found]
    whole = ranked[0]
    for more in ranked[1:]:
        whole = whole.unionByName(more)
    return whole.select("item_id", "rank", "doc_id", "score")


def _searched(shards: DataFrame, block: Block, numbers: list) -> DataFrame:
    """The best of each task for every item of ``block``."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(block.places, np.zeros(0, np.int64), []) for _ in block.asked]
        for batch in batches:
            for at in range(batch.num_rows):
                block.search(batch.slice(at, 1).to_pylist()[0], best)
        items = [i for i, b in enumerate(best) for _ in b.ids]
        columns = [pa.array(items, pa.int64()), pa.array([numbers[i] for i in items], pa.int64()),
                   pa.array([d for b in best for d in b.ids], pa.int64()),
                   pa.array([s for b in best for s in b.scores.tolist()], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "doc_id", "score"])

    columns = ["doc_ids", "sizes", "terms", "starts", "postings", "counts"]
    return shards.select(*columns).mapInArrow(walk, "item long, item_id long, doc_id long, score long")
