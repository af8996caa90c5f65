"""Ranks and running totals over a whole large order, without one task holding the order.

The rows are range-partitioned by the order and written with their block number. Inside a block a window
does the work; across blocks only one summary row per block (and key) is needed, and there are no more
blocks than shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonstats.sources.shared import materialize

BLOCK = "__block"


def ordered_blocks(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``df`` with a block number that grows along (keys, order). ``order`` should be unique per key:
    rows that tie share one block."""
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    return materialize(ranged.withColumn(BLOCK, F.spark_partition_id()), "ordered_blocks")


def _same(left: str, right: str, names: list[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def with_running_totals(df: DataFrame, keys: list[str], order: list[Column], totals: dict[str, Column]) -> DataFrame:
    """Number the blocks and add for each total ``<name>_before``, the sum over the rows ahead of this one within its key, and
    ``<name>_all``, the sum over the whole key. Rows with NULL totals count as 0."""
    blocks = ordered_blocks(df, keys, order)
    place = [*keys, BLOCK]
    ahead = Window.partitionBy(*place).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    by_block = Window.partitionBy(*keys)
    blocks_ahead = by_block.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    sums = blocks.groupBy(*place).agg(*[F.coalesce(F.sum(c), zero).alias(f"__{n}") for n, c in totals.items()])
    sums = sums.select(
        *place,
        *[F.coalesce(F.sum(f"__{n}").over(blocks_ahead), zero).alias(f"__{n}_offset") for n in totals],
        *[F.sum(f"__{n}").over(by_block).alias(f"{n}_all") for n in totals],
    )
    sums = materialize(sums, "block_sums")  # small: a row per block, and one more per key
    local = blocks.select(
        "*", *[F.coalesce(F.sum(c).over(ahead), zero).alias(f"__{n}_local") for n, c in totals.items()]
    )
    return (
        local.alias("l")
        .join(sums.alias("s"), _same("l", "s", place))
        .select(
            *[F.col(f"l.{c}") for c in (*df.columns, BLOCK)],
            *[(F.col(f"__{n}_local") + F.col(f"__{n}_offset")).alias(f"{n}_before") for n in totals],
            *[F.col(f"s.{n}_all") for n in totals],
        )
    )


def with_row_number(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Distributed ``row_number`` per key; also keeps the number of rows of the key as ``<name>_all``."""
    counted = with_running_totals(df, keys, order, {name: F.lit(1)})
    return counted.withColumn(name, (F.col(f"{name}_before") + 1).cast("long")).drop(f"{name}_before", BLOCK)


def with_next(blocks: DataFrame, keys: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """Add ``value`` of the following row of the key, NULL for its last row, across blocks as well as inside."""
    place = [*keys, BLOCK]
    inside = Window.partitionBy(*place).orderBy(*order)
    numbered = blocks.select(
        "*",
        F.lead(F.struct(value.alias("v"))).over(inside).alias("__inside"),
        F.row_number().over(inside).alias("__row"),
    )
    firsts = numbered.where("__row = 1").select(*place, F.struct(value.alias("v")).alias("__first"))
    after = F.lead("__first").over(Window.partitionBy(*keys).orderBy(BLOCK)).alias("__after")
    firsts = materialize(firsts.select(*place, after), "block_firsts")
    return (
        numbered.alias("l")
        .join(firsts.alias("s"), _same("l", "s", place))
        .select(*[F.col(f"l.{c}") for c in blocks.columns], F.coalesce("__inside", "__after")["v"].alias(name))
    )
