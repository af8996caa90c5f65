"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks, in DataFrame functions only.

Each source is split into shards of some thousand documents. Every shard claims its part of its source's target, and
blocks of ``block`` tokens go to the shards with the highest quotients claim / (2 * blocks so far + 1). A shard's
documents, in seeded order, form a ring of tokens; its quota of blocks is read off the ring from a seeded block on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonstats.functions.ordering import with_row_number
from seasonstats.sources.shared import materialize

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2  # words of the mix per word of input; the most copies of a document
BLOCK, SHARD_ROWS, SEED = 16, 4096, 42


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _number(digest: Column) -> Column:
    """The first 48 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """(source, source_size, docs, target) from (source, size). A row per source, so ordering them in one task is small.

    The common level rises until the targets add up: with sources ordered by cap per weight, a source is capped when
    the level that the rest would get, were it not, passes its cap.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank - 1, F.lit(len(weights))) + 1)
    weighed = totals.withColumn("weight", weight).withColumn("cap", most * F.col("source_size").cast("double"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = weighed.select(
        "*",
        (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weights_left"),
    ).withColumn("level", F.col("left") / F.col("weights_left"))
    open_ = F.col("level") * F.col("weight") < F.col("cap")
    level = F.max(F.when(open_, F.struct(-F.col("cap") / F.col("weight"), "level"))).over(everything)["level"]
    target = F.when(open_, level * F.col("weight")).otherwise(F.col("cap"))
    return levels.select("source", "source_size", "docs", target.alias("target"))


def apportion(cells: DataFrame, keys: list[str], claim: str, seats: int, claims: float, n: int, cap: str) -> DataFrame:
    """``cells`` with ``quota``: ``seats`` blocks by highest quotient, at most ``cap`` to a cell, ties by key.

    For n cells, a claim's exact share of the seats and its quota differ by at most its part of 1.5 n and one (a cap
    costs a cell less than one block), so all blocks but a few are certain and some seven quotients a cell are ranked.
    """
    share = F.col(claim) / F.lit(claims) if claims else F.lit(0.0)
    sure = F.greatest(F.lit(0), F.floor(share * (seats - n / 2.0)) - 2)
    last = F.floor(share * (seats + 1.5 * n)) + 2
    counted = cells.withColumn("sure", F.least(sure, F.col(cap)).cast("long")).withColumn(
        "last", F.least(last, F.col(cap)).cast("long")
    )
    counted = materialize(counted, "cells")
    given = counted.agg(F.sum("sure")).first()[0] or 0  # one number
    open_ = counted.where("last > sure").select(
        *keys, claim, F.explode(F.sequence("sure", F.col("last") - 1)).alias("k")
    )
    open_ = open_.withColumn("quotient", F.col(claim) / (2 * F.col("k") + 1))
    order = [F.col("quotient").desc(), *[F.col(k).asc_nulls_last() for k in keys], F.col("k")]
    ranked = with_row_number(open_, [], order, "place").where(F.col("place") <= seats - given)
    won = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("won"))
    same = F.lit(True)
    for k in keys:
        same = same & counted[k].eqNullSafe(won[k])
    return counted.join(won, same, "left").select(
        *[counted[c] for c in cells.columns], (F.col("sure") + F.coalesce("won", F.lit(0))).alias("quota")
    )


def _rest_of_target(block: int, most: int) -> Column:
    """What a shard takes beside its blocks: the source's target less all its blocks, as far as shards have room, in order."""
    of_source = Window.partitionBy("source")
    ahead = of_source.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    missing = F.round(F.max("target").over(of_source)).cast("long") - F.sum(F.col("quota") * block).over(of_source)
    room = most * F.col("tokens") - F.col("quota") * block
    left = missing - F.coalesce(F.sum(room).over(ahead), F.lit(0))
    return F.greatest(F.lit(0), F.least(left, room))


def mix_sources(
    docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text",
    weights=WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK, shard_rows: int = SHARD_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes of the row, repeats counted) and source.

    A null source is a source, the last. Null or empty text has size 0 and gives 0. Repeated rows are rows of their
    own. What whole blocks leave of a source's target is given to its shards as parts of a block. Other columns are not read.
    """
    sized = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), word_count(F.col(text_column)).alias("size")
    )
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("size").cast("string")))
    sized = materialize(sized.withColumn("draw", _number(digest)), "sizes")  # narrow; the texts are read once
    targets = materialize(source_targets(sized, weights, share, most), "targets")
    t = targets.select(F.col("source").alias("of"), "source_size", "docs", "target")
    # Copies share an id, so the shard is drawn from the id's digest: about shard_rows rows each.
    shards = F.ceil(F.col("docs") / shard_rows)
    placed = sized.join(t, F.col("source").eqNullSafe(F.col("of"))).withColumn("shard", F.pmod("draw", shards))
    cells = placed.groupBy("source", "shard").agg(
        F.sum("size").alias("tokens"), F.first("source_size").alias("source_size"), F.first("target").alias("target")
    )
    cells = cells.where("tokens > 0").select(
        "source", "shard", "tokens", "target",
        (F.col("target") * F.col("tokens") / F.col("source_size")).alias("claim"),
        F.floor(most * F.col("tokens") / block).alias("cap"),
    )
    cells = materialize(cells, "claims")
    claims, n = cells.agg(F.sum("claim"), F.count(F.lit(1))).first()
    claims = claims or 0.0
    quotas = apportion(cells, ["source", "shard"], "claim", int(claims / block + 0.5), claims, n, "cap")
    start = _number(F.md5(F.concat_ws("|", F.lit(f"{seed} start"), F.coalesce("source", F.lit("")), F.col("shard"))))
    blocks = F.ceil(F.col("tokens") / block)
    quotas = quotas.withColumn("words", F.col("quota") * block + _rest_of_target(block, most))
    words = F.col("words")
    quotas = quotas.select(
        F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "tokens", "quota",
        F.floor(words / F.col("tokens")).alias("rounds"), F.pmod(words, F.col("tokens")).alias("rest"),
        (F.pmod(start, blocks) * block).alias("first"),
    )
    joined = placed.join(
        quotas, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard")), "left"
    )
    ring = Window.partitionBy("source", "shard").orderBy("draw", F.col("doc_id").asc_nulls_last(), "size")
    upto = F.sum("size").over(ring.rowsBetween(Window.unboundedPreceding, 0))
    laid = joined.withColumn("stop", upto).withColumn("begin", F.col("stop") - F.col("size"))

    def inside(low: Column, high: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("stop"), high) - F.greatest(F.col("begin"), low))

    end = F.col("first") + F.col("rest")
    cut = inside(F.col("first"), F.least(end, F.col("tokens"))) + inside(F.lit(0), end - F.col("tokens"))
    taken = F.coalesce(F.col("rounds") * F.col("size") + cut, F.lit(0)).cast("long")
    return laid.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source")
