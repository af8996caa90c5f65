"""Merkle manifest of a table: hash trees kept as append logs in postorder, inclusion proofs, and their verification.

Every group of rows (a language) is a binary tree over its rows in order of their ids; the groups' roots are the leaves
of one more tree. A tree is cut into aligned segments of ``2 ** levels`` leaves. One builder per segment hashes its
leaves from left to right and appends each node when it is complete, so that a segment's log is its subtree in
postorder. The roots of the segments are the leaves of the next layer, which is cut in the same way.

Where a node stands in its log follows from the sizes of the subtrees before it, without any pointer or search
(``position``). A leaf's siblings are therefore read straight from the log of its segment, and the rest of its proof,
from the segment's root upwards, is the same for all leaves of the segment and found once, in the layer above.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonstats.functions.ordering import with_row_number
from seasonstats.sources.shared import materialize

LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ROWS_PER_TASK = 1 << 18
BARE, LEFT, RIGHT = 0, 1, 2  # where the sibling of a step stands: nowhere, before or after the node
STEP = 33  # bytes of a step: one of these three and the sibling's digest

_SEGMENT = "tree string, segment long, size long, root binary, log binary, ids array<long>, claims array<binary>"
_PROOF = "tree string, place long, id long, node binary, claim binary, root binary, above binary"


def record_digest(columns: list[Column]) -> Column:
    """Lowercase hex sha256 of a row: of each value ``-`` if null, else its bytes' number, ``:`` and the value."""
    written = [c.cast("string") for c in columns]
    return F.sha2(
        F.concat(*[F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in written]),
        256,
    )


def height(leaves: int) -> int:
    """Levels above the leaves of a whole tree."""
    return max(0, leaves - 1).bit_length()


def position(level: np.ndarray | int, index: np.ndarray, leaves: int) -> np.ndarray:
    """Place in the log of the node ``index`` of ``level``, in a log of ``leaves`` leaves.

    A node with all its leaves follows its last leaf, ahead of which every leaf and every complete node of the leaves
    before stand: ``2 * last - (ones in last)`` in all. The nodes cut off by the right edge are appended at the end, from
    the level above the lowest that divides the leaves evenly.
    """
    last = ((index + 1) << level) - 1
    complete = 2 * last - np.bitwise_count(last).astype(np.int64) + level
    even = (leaves & -leaves).bit_length() - 1
    return np.where(last < leaves, complete, 2 * leaves - leaves.bit_count() + level - even - 1)


def _joined(*digests: bytes) -> bytes:
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def append_log(leaves: list[bytes], levels: int) -> list[bytes]:
    """All nodes in the order in which they are completed, up to the one node of level ``levels``, which is the last."""
    log: list[bytes] = []
    waiting: list[tuple[int, bytes]] = []  # complete subtrees without a right neighbour yet, the largest first
    for node in leaves:
        level = 0
        log.append(node)
        while waiting and waiting[-1][0] == level:
            node, level = _joined(waiting.pop()[1], node), level + 1
            log.append(node)
        waiting.append((level, node))
    level, node = waiting.pop()
    while level < levels:  # the right edge
        beside = [waiting.pop()[1]] if waiting and waiting[-1][0] == level else []
        node, level = _joined(*beside, node), level + 1
        log.append(node)
    return log


def _levels(size: int, levels: int) -> int:
    """Levels of a segment of a tree with ``size`` leaves: to the root if the tree is one segment."""
    return height(size) if size <= 1 << levels else levels


def _segments(nodes: DataFrame, tasks: int, levels: int) -> DataFrame:
    """One row per segment with its log. ``nodes``: tree, place, size, node, id, claim."""

    def build(key, table):
        table = table.sort_by("place")
        size = table.column("size")[0].as_py()
        leaves = table.column("node").to_pylist()
        log = append_log(leaves, _levels(size, levels))
        row = [key[0].as_py(), key[1].as_py(), size, log[-1], b"".join(log), table.column("id").to_pylist(),
               table.column("claim").to_pylist()]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary())]
        names = [c.split()[0] for c in _SEGMENT.split(", ")]
        return pa.table([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    placed = nodes.withColumn("segment", F.shiftright("place", levels)).repartition(tasks, "tree", "segment")
    return placed.groupBy("tree", "segment").applyInArrow(build, _SEGMENT)


def _grow(nodes: DataFrame, folder: str, levels: int) -> DataFrame:
    """Store the logs of all layers above ``nodes`` and return (tree, root) of the finished trees."""
    spark = nodes.sparkSession
    nodes = materialize(nodes, "leaves")
    rows, most = nodes.agg(F.count(F.lit(1)), F.max("size")).first()  # two numbers
    least, most, layer = int(spark.conf.get("spark.sql.shuffle.partitions")), most or 0, 0
    while True:
        path = f"{folder}/layer={layer}"
        _segments(nodes, max(least, math.ceil(rows / ROWS_PER_TASK)), levels).write.parquet(path)
        if most <= 1 << levels:
            break
        segments = F.ceil(F.col("size") / (1 << levels))
        nodes = spark.read.schema(_SEGMENT).parquet(path).where(~_whole(levels)).select(
            "tree", F.col("segment").alias("place"), segments.cast("long").alias("size"), F.col("root").alias("node"),
            F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("claim"),
        )
        rows, most, layer = rows >> levels, -(-most >> levels), layer + 1
    return _layers(spark, folder).where(_whole(levels)).select("tree", "root")


def write_manifest(
    docs: DataFrame, folder: str, claimed: Column | None = None, id_column: str = "doc_id", group_column: str = "lang",
    fields: tuple[str, ...] = FIELDS, levels: int = LEVELS,
) -> None:
    """Store the trees of all rows of ``docs`` below ``folder``.

    ``claimed`` is the digest of another version of a row, kept beside its leaf (not in the tree) for a later check
    against the root; null where there is none. Null ids come first in their group, rows with one id in order of their
    digests, and a null group is a group of its own, the first. Repeated rows are as many leaves. Other columns are
    not read. No rows give empty logs.
    """
    digest = F.unhex(record_digest([F.col(f) for f in fields]))
    claim = F.lit(None).cast("binary") if claimed is None else F.unhex(claimed)
    leaves = docs.select(
        F.col(group_column).cast("string").alias("tree"), F.col(id_column).cast("long").alias("id"), digest.alias("node"),
        claim.alias("claim"),
    )
    order = [F.col("id").asc_nulls_first(), F.col("node")]
    numbered = with_row_number(leaves, ["tree"], order, "place").withColumnRenamed("place_all", "size")
    roots = _grow(numbered.withColumn("place", F.col("place") - 1), f"{folder}/groups", levels)
    # Strings are ordered by their UTF-8 bytes.
    ordered = with_row_number(roots, [], [F.col("tree").asc_nulls_first()], "nth")
    ordered.select("tree", (F.col("nth") - 1).alias("place"), F.col("nth_all").alias("size"), "root").write.parquet(f"{folder}/names")
    named = roots.sparkSession.read.schema("tree string, place long, size long, root binary").parquet(f"{folder}/names")
    none = {"tree": "string", "id": "long", "claim": "binary"}
    _grow(
        named.select("place", "size", F.col("root").alias("node"), *[F.lit(None).cast(k).alias(c) for c, k in none.items()]),
        f"{folder}/root", levels,
    )


def _steps(count: int, levels: int, log: bytes) -> list[bytes]:
    """The steps of each of a segment's ``count`` leaves up to the segment's root."""
    places = np.arange(count)
    steps = np.zeros((count, levels, STEP), np.uint8)
    nodes = np.frombuffer(log, np.uint8).reshape(-1, STEP - 1)
    for level in range(levels):
        own = places >> level
        beside = own ^ 1
        held = beside << level < count
        steps[:, level, 0] = np.where(held, np.where(own & 1, LEFT, RIGHT), BARE)
        steps[held, level, 1:] = nodes[position(level, beside[held], count)]
    flat, width = steps.tobytes(), levels * STEP
    return [flat[i * width : (i + 1) * width] for i in range(count)]


def _extracted(segments: DataFrame, levels: int) -> DataFrame:
    """The whole proof of every leaf of ``segments``, which carry the steps above them and the root these lead to."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _PROOF.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
        for batch in batches:
            for row in batch.to_pylist():
                ids, log, n = row["ids"], row["log"], len(row["ids"])
                below = _steps(n, _levels(row["size"], levels), log)
                width = STEP - 1
                leaves = [log[p : p + width] for p in (position(0, np.arange(n), n) * width).tolist()]
                first = row["segment"] << levels
                columns = [[row["tree"]] * n, list(range(first, first + n)), ids, leaves, row["claims"],
                           [row["top"]] * n, [b + row["above"] for b in below]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    read = ["tree", "segment", "size", "log", "ids", "claims", "top", "above"]
    return segments.select(*read).mapInArrow(extract, _PROOF)


def _layers(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{_SEGMENT}, layer int").parquet(folder)


def _whole(levels: int) -> Column:
    """Whether a segment is all that its layer has of a tree, so that its root is the tree's."""
    return F.col("size") <= 1 << levels


def _proofs(layers: DataFrame, tops: DataFrame, levels: int) -> DataFrame:
    """Proofs of the leaves of all trees of ``layers``, from the upper layers down; ``tops`` has (tree, root, above) for the
    root of each tree."""
    last = layers.agg(F.max("layer")).first()[0] or 0  # one number
    tops = tops.select(F.col("tree").alias("of"), F.col("root").alias("top"), "above")
    upper = None
    for layer in range(last, -1, -1):
        segments = layers.where(F.col("layer") == layer).drop("layer", "root")
        found = segments.where(_whole(levels)).join(tops, F.col("tree").eqNullSafe(F.col("of"))).drop("of")
        if upper is not None:
            ends = upper.select(F.col("tree").alias("of"), "place", F.col("root").alias("top"), "above")
            same = F.col("tree").eqNullSafe(F.col("of")) & (F.col("segment") == F.col("place"))
            found = found.unionByName(segments.where(~_whole(levels)).join(ends, same).drop("of", "place"))
        proofs = _extracted(found, levels)
        if layer:
            upper = materialize(proofs, "upper_proofs")  # of segments only; its true size decides how it is joined
    return proofs


def inclusion_proofs(spark: SparkSession, folder: str, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, claim, subroot, root and the proof of every leaf of a manifest stored with the same ``levels``.

    ``path`` has a step of 33 bytes per level from the leaf to the root: where the sibling stands (0 none, 1 before, 2
    after) and its digest. Digests are binary. Siblings come from the logs alone, by their positions.
    """
    root = _layers(spark, f"{folder}/root")
    groups = _proofs(root, root.where(_whole(levels)).select("tree", "root", F.lit(b"").alias("above")), levels)
    names = spark.read.schema("tree string, place long, root binary").parquet(f"{folder}/names")
    names = names.select("tree", "place", F.col("root").alias("subroot"))
    tops = materialize(names.join(groups.select("place", "root", "above"), "place"), "groups")
    proofs = _proofs(_layers(spark, f"{folder}/groups"), tops, levels)
    subroots = tops.select(F.col("tree").alias("of"), "subroot")
    return proofs.join(subroots, F.col("tree").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("doc_id"), F.col("node").alias("leaf"), "claim", "subroot", "root", F.col("above").alias("path")
    )


def fold(node: bytes, path: bytes) -> bytes:
    """The root that ``path`` leads to from ``node``."""
    for at in range(0, len(path), STEP):
        side, sibling = path[at], path[at + 1 : at + STEP]
        node = _joined(node) if side == BARE else _joined(sibling, node) if side == LEFT else _joined(node, sibling)
    return node


def siblings_digest(path: bytes) -> str:
    """Hex sha256 of the siblings' hex digests in a row, from the leaf up."""
    held = [path[at + 1 : at + STEP].hex() for at in range(0, len(path), STEP) if path[at] != BARE]
    return sha256("".join(held).encode()).hexdigest()


def verified(proofs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and whether that is the root, for all rows of ``inclusion_proofs``.

    What is folded is the claimed digest where there is one, else the leaf. Digests are lowercase hex.
    """

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, leaf, claim, subroot, root, path = (batch.column(i) for i in range(6))
            paths, roots = path.to_pylist(), root.to_pylist()
            shown = [leaf if c is None else c for c, leaf in zip(claim.to_pylist(), leaf.to_pylist(), strict=True)]
            folded = [fold(n, p) for n, p in zip(shown, paths, strict=True)]
            texts = [[v.hex() for v in c.to_pylist()] for c in (leaf, subroot, root)]
            yield pa.RecordBatch.from_arrays(
                [doc_id, *[pa.array(t, pa.string()) for t in texts], pa.array([siblings_digest(p) for p in paths], pa.string()),
                 pa.array([f.hex() for f in folded], pa.string()),
                 pa.array([f == r for f, r in zip(folded, roots, strict=True)], pa.bool_())],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    kinds = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return proofs.select("doc_id", "leaf", "claim", "subroot", "root", "path").mapInArrow(verify, kinds)
