"""A classification tree grown exactly: every level tries all distinct values of all features, without bins.

A level is one pass over the rows. The rows' nodes follow from the splits found so far, as an expression; the rows are
added up per (node, feature, value), and running totals along the values give the two sides of every possible split.
The totals are made in blocks, so that no task holds all values of a feature. The tree is a table of nodes, from which
scores and importances are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonstats.functions.ordering import with_next, with_running_totals
from seasonstats.operators.evaluation import filled
from seasonstats.operators.sampling import LABEL
from seasonstats.sources.shared import materialize

MOST_LEVELS = 12  # at most 4,095 splits, which are one expression
ROOT = 1  # the children of node i are 2 i and 2 i + 1

NODES = (
    "node long, feature string, threshold double, rows long, positives long, impurity double, decrease double"
)


def _mixed(rows: Column, positives: Column) -> Column:
    """Rows times Gini impurity of a 0/1 label."""
    return F.coalesce(F.try_divide(2.0 * positives * (rows - positives), rows), F.lit(0.0))


def _node_of(splits: dict[int, tuple[str, float]]) -> Column:
    """The node that a row has come to."""

    def below(node: int) -> Column:
        if node not in splits:
            return F.lit(node).cast("long")
        feature, threshold = splits[node]
        return F.when(F.col(feature) <= threshold, below(2 * node)).otherwise(below(2 * node + 1))

    return below(ROOT)


def _best_splits(rows: DataFrame, features: list[str], min_leaf: int) -> DataFrame:
    """(node, feature, threshold, decrease) of the best split of every node of ``rows`` that has one.

    The best split leaves the least impurity; of equal ones the first in the order of ``features``, then the lowest
    threshold counts. A threshold lies halfway between two values.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("place"), F.col(f).alias("value")) for i, f in enumerate(features)])
    long = rows.select("node", LABEL, F.explode(pairs).alias("at")).select("node", LABEL, "at.place", "at.value")
    sums = long.groupBy("node", "place", "value").agg(F.count(F.lit(1)).alias("n"), F.sum(LABEL).alias("p"))
    key, order = ["node", "place"], [F.col("value")]
    totals = with_running_totals(sums, key, order, {"n": F.col("n"), "p": F.col("p")})
    stepped = with_next(totals, key, order, F.col("value"), "next").where(F.col("next").isNotNull())
    left_n, left_p = F.col("n_before") + F.col("n"), F.col("p_before") + F.col("p")
    right_n, right_p = F.col("n_all") - left_n, F.col("p_all") - left_p
    split = stepped.where((left_n >= min_leaf) & (right_n >= min_leaf)).select(
        "node", "place", "value", "next", "n_all", "p_all", (_mixed(left_n, left_p) + _mixed(right_n, right_p)).alias("left_over")
    )
    best = split.groupBy("node").agg(F.min(F.struct("left_over", "place", "value", "next", "n_all", "p_all")).alias("b"))
    names = F.array(*map(F.lit, features))
    decrease = _mixed(F.col("b.n_all"), F.col("b.p_all")) - F.col("b.left_over")
    return best.select(
        "node", F.element_at(names, F.col("b.place") + 1).alias("feature"), ((F.col("b.value") + F.col("b.next")) / 2).alias("threshold"),
        decrease.alias("decrease"),
    ).where("decrease > 0")


def prepared(rows: DataFrame, features: list[str]) -> DataFrame:
    """Features as doubles without missing values, as the models read them, and the label."""
    return rows.select(*[F.expr(filled(f)).alias(f) for f in features], F.col(LABEL).cast("long").alias(LABEL))


def grow_tree(rows: DataFrame, features: list[str], max_depth: int, min_leaf: int = 1) -> DataFrame:
    """The stored nodes of a tree on the 0/1 label of ``rows``: a split has its feature, threshold and decrease of
    impurity (times its rows), a leaf has none. Missing feature values count as in the forest. Rows without a label are
    left out; without rows there are no nodes.
    """
    if not 0 <= max_depth <= MOST_LEVELS:
        raise ValueError(f"max_depth must be between 0 and {MOST_LEVELS}")
    stored = materialize(prepared(rows, features).where(F.col(LABEL).isNotNull()), "tree_rows")
    splits: dict[int, tuple[str, float]] = {}
    decreases: dict[int, float] = {}
    for level in range(max_depth):
        open_ = stored.withColumn("node", _node_of(splits)).where(F.col("node") >= 1 << level)
        found = _best_splits(open_, features, min_leaf).collect()  # at most 2 ** level rows
        for r in found:
            splits[r["node"]], decreases[r["node"]] = (r["feature"], r["threshold"]), r["decrease"]
        if not found:
            break
    # A row belongs to its leaf and to all nodes above it.
    leaves = stored.groupBy(_node_of(splits).alias("leaf")).agg(F.count(F.lit(1)).alias("n"), F.sum(LABEL).alias("p"))
    depth = F.floor(F.log2(F.col("leaf"))).cast("int")
    above = F.transform(F.sequence(F.lit(0), depth), lambda i: F.call_function("shiftright", F.col("leaf"), i))
    counts = leaves.withColumn("node", F.explode(above)).groupBy("node").agg(F.sum("n").alias("rows"), F.sum("p").alias("positives"))
    spark = rows.sparkSession
    listed = [(n, f, t, decreases[n]) for n, (f, t) in splits.items()]
    chosen = spark.createDataFrame(listed, "of long, feature string, threshold double, decrease double")
    nodes = counts.join(chosen, F.col("node") == F.col("of"), "left").withColumn(
        "impurity", F.try_divide(_mixed(F.col("rows"), F.col("positives")), F.col("rows"))
    )
    return materialize(nodes.select(*[c.split()[0] for c in NODES.split(", ")]), "tree")


def splits_of(tree: DataFrame) -> dict[int, tuple[str, float]]:
    return {r["node"]: (r["feature"], r["threshold"]) for r in tree.where("feature IS NOT NULL").collect()}  # below 4,096


def score_tree(tree: DataFrame, rows: DataFrame, id_columns: tuple[str, ...] = ("dt_ref", "driverid")) -> DataFrame:
    """(id, proba): the share of label 1 in each row's leaf. No row is moved: the tree is an expression, and its leaves'
    shares, one row a leaf, are broadcast."""
    splits = splits_of(tree)
    features = sorted({f for f, _ in splits.values()})
    named = rows.select(*id_columns, *[F.expr(filled(f)).alias(f) for f in features])
    placed = named.select(*id_columns, _node_of(splits).alias("__leaf"))
    leaves = tree.where("feature IS NULL").select(F.col("node").alias("__of"), F.try_divide("positives", "rows").alias("proba"))
    return placed.join(F.broadcast(leaves), F.col("__leaf") == F.col("__of")).select(*id_columns, "proba")


def tree_importances(tree: DataFrame, features: list[str]) -> DataFrame:
    """(feature, importance): the share of each feature in all decrease of impurity, 0 for features without a split and
    for all if nothing is split."""
    named = tree.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    split = tree.where("feature IS NOT NULL")

    def total() -> Column:
        # In ascending order, so that the sum repeats; a tree has below 4,096 splits.
        return F.aggregate(F.array_sort(F.collect_list("decrease")), F.lit(0.0), lambda a, b: a + b)

    whole = split.agg(total()).first()[0]  # one number
    own = split.groupBy("feature").agg(total().alias("own"))
    share = F.coalesce(F.try_divide("own", F.lit(whole)), F.lit(0.0))
    return named.join(own, "feature", "left").select("feature", share.alias("importance"))
