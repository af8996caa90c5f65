"""Similarity join of documents on the sets of their word n-grams, exact at the given threshold.

Two sets that reach the threshold share an n-gram within the first quarter or so of both (the prefix), whatever order all
n-grams are put in; in the order of how many sets hold them, a document whose prefix holds only n-grams of its own has no
partner. This is judged twice: over all documents on a fixed half of the n-grams (by hash), then exactly among the sets
that are left, equal sets being one.

The prefixes form the sparse document by n-gram incidence. Its product with itself is taken in blocks: first each column
against one leader per size class, the document whose n-grams are the most common, then, after the documents linked so
are merged, only between documents of a column that are not yet in one component. Pairs below the bounds from size and
place are discarded before their sets are multiplied.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonstats.llm import exchange as X
from seasonstats.llm.components import components
from seasonstats.llm.text import gram_hashes, word_hashes, words
from seasonstats.sources.shared import materialize

WORDS, OVER, UNDER = 5, 3, 4  # five words, similarity of 3 / 4
COUNTED = 1 << 63  # n-grams with hashes below are counted over all documents


def shingle_sets(texts: pa.Array, n: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``n``-word sequences of each text, A-Z in lower case; a shorter text is one."""
    known, codes, offsets = words(texts)
    low = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in known.to_pylist()]
    hashes = word_hashes(pa.array(low, pa.string()))[codes] if len(codes) else np.zeros(0, np.uint64)
    grams = gram_hashes(hashes, n)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            out.append(gram_hashes(hashes[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _texts(table: pa.Table) -> pa.Array:
    texts = table.column("text")
    return texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts


def _prefix_length(n: int, over: int, under: int) -> int:
    """So many first n-grams of a set of ``n`` are sure to hold one of any set that it links with."""
    return n - -(-n * over // under) + 1


_SETS = "doc_id long, n long, key string, members binary"


def _survivors(table: pa.Table, known: np.ndarray, n: int, over: int, under: int) -> pa.Table:
    """Every row's set size, and the set unless its n-grams of its own fill its prefix."""
    rows = []
    for doc_id, grams in zip(table.column("doc_id").to_pylist(), shingle_sets(_texts(table), n), strict=True):
        counted = grams[: np.searchsorted(grams, np.uint64(COUNTED))]
        own = len(counted) - int(X.member(counted, known).sum())
        if not len(grams) or own >= _prefix_length(len(grams), over, under):
            rows.append((doc_id, len(grams), None, None))
        else:
            members = grams.tobytes()
            rows.append((doc_id, len(grams), xxhash.xxh3_128_hexdigest(members), members))
    kinds, names = [pa.int64(), pa.int64(), pa.string(), pa.binary()], ["doc_id", "n", "key", "members"]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def surviving_sets(docs: DataFrame, n: int, over: int, under: int, id_column: str, text_column: str) -> DataFrame:
    """Every row's set size and, if it may have a partner, its set."""
    buckets = X.bucket_count(docs, text_column)
    dealt = X.deal(docs, buckets, id_column, text_column)

    def counted(table):
        below = [s[: np.searchsorted(s, np.uint64(COUNTED))] for s in shingle_sets(_texts(table), n)]
        return np.unique(np.concatenate(below), return_counts=True) if below else (np.zeros(0, np.uint64), None)

    counts = X.send(dealt, buckets, counted, kind=np.uint32, limit=COUNTED)
    known = X.answer(counts, repeated, np.uint32)

    def survivors(_, table, said):
        return _survivors(table, X.gathered(said, None)[0], n, over, under)

    return X.with_their_replies(dealt, known, buckets).applyInArrow(survivors, _SETS)


def repeated(messages: list[X.Message]):
    for bucket, hashes, _ in X.totals(messages, 2):
        yield bucket, hashes, None


def incidence(sets: DataFrame, over: int, under: int) -> DataFrame:
    """(node, n, centre, grams, places): the prefixes of ``sets`` (node, n, members) that have n-grams in common with
    another set. All n-grams are in the order of the number of sets that hold them; ``centre`` is the mean logarithm."""
    buckets = X.bucket_count(sets, "members")
    dealt = sets.select(
        F.pmod(F.xxhash64("node"), F.lit(buckets)).cast("int").alias("bucket"), "node", "n", "members"
    ).repartition(buckets, "bucket")

    def members(table):
        return [np.frombuffer(m, np.uint64) for m in table.column("members").to_pylist()]

    def counted(table):
        own = members(table)
        return np.unique(np.concatenate(own), return_counts=True) if own else (np.zeros(0, np.uint64), None)

    def prefixes(_, table, said):
        known, counts = X.gathered(said, np.uint32)
        rows = []
        for node, grams in zip(table.column("node").to_pylist(), members(table), strict=True):
            held, at = X.found_at(grams, known)
            n, own = len(grams), len(grams) - int(held.sum())
            length = _prefix_length(n, over, under)
            if own < length:
                shared, count = grams[held], counts[at[held]]
                first = shared[np.lexsort((shared, count))][: length - own]
                centre = float(np.log2(count).sum() / n)
                rows.append((node, n, centre, first.view(np.int64), np.arange(own, own + len(first), dtype=np.int32)))
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        names = ["node", "n", "centre", "grams", "places"]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    counts = X.send(dealt, buckets, counted, kind=np.uint32)
    known = X.answer(counts, lambda messages: X.totals(messages, 2), np.uint32, np.uint32)
    schema = "node long, n long, centre double, grams array<long>, places array<int>"
    return X.with_their_replies(dealt, known, buckets).applyInArrow(prefixes, schema)


def _overlaps(batches):
    """Pairs whose sets reach the threshold: one row of the left block against its rows of the right block at a time."""
    for batch in batches:
        left, right = batch.column("left"), batch.column("right")
        keep = np.zeros(batch.num_rows, bool)
        need = batch.column("need").to_pylist()
        last, row = None, None
        for i in range(batch.num_rows):
            a = left[i].as_buffer()
            if last is None or not a.equals(last):
                last, row = a, np.frombuffer(a, np.uint64)
            other = np.frombuffer(right[i].as_buffer(), np.uint64)
            small, large = (row, other) if len(row) < len(other) else (other, row)
            keep[i] = int(X.member(small, large).sum()) >= need[i]
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, need) whose overlap reaches ``need``."""
    right = pairs.join(sets.select(F.col("node").alias("b"), F.col("members").alias("right")), "b")
    both = right.join(sets.select(F.col("node").alias("a"), F.col("members").alias("left")), "a")
    return both.select("a", "b", "need", "left", "right").mapInArrow(_overlaps, "a long, b long")


def _bounded(pairs: DataFrame, over: int, under: int) -> DataFrame:
    """Distinct pairs (a, b, need) within the bounds. ``pairs`` have the sizes and the places of a common n-gram."""
    need = F.ceil(F.lit(over) * (F.col("na") + F.col("nb")) / F.lit(over + under)).cast("long")
    first = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= F.col("need")
    sizes = F.least("na", "nb") * under >= F.greatest("na", "nb") * over
    return pairs.where(sizes).withColumn("need", need).where(first).select("a", "b", "need").distinct()


def similarity_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = WORDS, over: int = OVER, under: int = UNDER
) -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id reachable by links) of every row of ``docs``.

    Two rows link when ``under`` * |intersection| >= ``over`` * |union| of their sets. Null and blank texts have empty
    sets and no links. Rows with the same set are one node, so that copies are never paired. A row with a null id links
    others but has the least id that is not null as component, null if there is none. Rows with one id but other sets
    are told apart. Other columns are not read.
    """
    found = materialize(surviving_sets(docs, n, over, under, id_column, text_column), "survivors")
    # Equal sets: one node, numbered by its key; ids may be missing, or stand for many texts.
    alike = found.where("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("members").alias("members")
    )
    sets = materialize(alike.withColumn("node", F.xxhash64("key")), "sets")
    # Sets whose sizes allow a link are in the same or in neighbouring classes.
    size_class = F.floor(F.log(F.col("n").cast("double")) / math.log(under / over)).cast("int")
    held = incidence(sets, over, under).select(
        "node", "n", "centre", size_class.alias("size"), F.explode(F.arrays_zip("grams", "places")).alias("at")
    ).select("node", "n", "centre", "size", F.col("at.grams").alias("gram"), F.col("at.places").alias("place"))
    held = materialize(held, "prefix_grams")
    # Stored aggregates leave both sides of a join free to be split where a column is long.
    columns = held.groupBy("gram").agg(F.count(F.lit(1)).alias("held")).where("held > 1").select("gram")
    held = materialize(held.join(materialize(columns, "columns"), "gram"), "incidence")
    leader = F.min(F.struct((-F.col("centre")).alias("far"), F.col("node").alias("a"), F.col("n").alias("na"),
                            F.col("place").alias("pa")))
    leaders = held.groupBy("gram", "size").agg(leader.alias("l")).select("gram", "size", "l.a", "l.na", "l.pa")
    # A leader meets its own class and the one below.
    leaders = materialize(leaders.unionByName(leaders.withColumn("size", F.col("size") - 1)), "leaders")
    side = held.select("gram", "size", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"))
    stars = side.join(leaders, ["gram", "size"]).where("a <> b")
    tried = materialize(_bounded(stars, over, under), "tried")
    links = materialize(_linked(tried, sets), "links")
    merged = materialize(components(links), "merged")
    # What is left: documents of one column in different components. Both orders of a star's pair count as tried.
    placed = held.join(merged, "node", "left").select(
        "gram", "node", "n", "place", F.coalesce("component", "node").alias("component")
    )
    placed = materialize(placed, "placed")
    apart = placed.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    placed = materialize(placed.join(materialize(apart.select("gram"), "split_columns"), "gram"), "apart")
    one = placed.select("gram", F.col("node").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("component").alias("ca"))
    two = placed.select("gram", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("component").alias("cb"))
    rest = _bounded(one.join(two, "gram").where("ca < cb"), over, under)
    known = tried.select("a", "b").unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = materialize(rest.join(known, ["a", "b"], "left_anti"), "rest")
    more = links.unionByName(_linked(rest, sets))
    classes = components(more)
    named = sets.select("key", "node", "least").join(classes, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    # The component's name is its least id.
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(named.join(names, "component").select("key", "component_id"), "classes")
    return found.select("doc_id", "n", "key").join(named, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
