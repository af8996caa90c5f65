"""Exact dedup with a two-pass Bloom filter, in DataFrame functions only.

The first pass hashes every row into ``PROBES`` cells of a bit field and finds the cells hit more than once (sums per
task first, so a text held by a third of all rows is one row per task). These cells, packed into 64-bit words, are the
filter. The second pass probes it: a row with a cell hit once has no equal and goes straight to the result; only the
others are shuffled and compared by digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonstats.sources.shared import materialize

PROBES = 2
CELLS_PER_ROW = 16
MOST_CELLS = 1 << 27  # at most 2 million words are ever broadcast; a fuller filter lets more rows through, never fewer


def without_white_space(text: Column) -> Column:
    """``text`` without blanks and the control characters 9 to 13; null is empty."""
    kept = F.coalesce(text, F.lit(""))
    for code in (32, 9, 10, 11, 12, 13):
        kept = F.replace(kept, F.lit(chr(code)), F.lit(""))
    return kept


def possibly_repeated(rows: DataFrame, key: str, cells: int) -> DataFrame:
    """``rows`` with ``__maybe``: false only where no other row has the same ``key``."""
    names = [f"__cell{i}" for i in range(PROBES)]
    probed = rows.select(
        "*", *[F.pmod(F.xxhash64(F.lit(i), key), F.lit(cells)).alias(n) for i, n in enumerate(names)]
    )
    hits = probed.select(F.explode(F.array(*[F.struct(F.lit(i).alias("probe"), F.col(n).alias("cell"))
                                             for i, n in enumerate(names)])).alias("at")).select("at.*")
    twice = hits.groupBy("probe", "cell").count().where("`count` > 1")
    # PROBES separate bit fields of cells / 64 words each.
    words = twice.groupBy("probe", F.shiftright("cell", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(cell & 63 AS INT))")).alias("bits")
    )
    words = materialize(words, "bloom")
    maybe = F.lit(True)
    for i, n in enumerate(names):
        field = words.where(F.col("probe") == i).select(F.col("word").alias(f"__word{i}"), F.col("bits").alias(f"__bits{i}"))
        probed = probed.join(F.broadcast(field), F.shiftright(n, 6) == F.col(f"__word{i}"), "left")
        bit = F.expr(f"(__bits{i} & shiftleft(1L, CAST({n} & 63 AS INT))) <> 0")
        maybe = maybe & F.coalesce(bit, F.lit(False))
    return probed.withColumn("__maybe", maybe).select(*rows.columns, "__maybe")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same without white space; the longest original text (code points), then the
    smallest id stays, a null id last. Null text is empty text, and all empty texts are one group. Of rows that agree
    in id and text one stays. Other columns, also of the result's names, are not read. No rows give no rows.
    """
    bare = without_white_space(F.col(text_column))
    digests = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.char_length(F.col(text_column)), F.lit(0)).alias("points"),
        F.sha2(bare, 256).alias("text_sha256"),
    ).withColumn("row", F.monotonically_increasing_id())
    digests = materialize(digests, "digests")  # narrow; the texts are read once
    cells = min(MOST_CELLS, max(1 << 12, CELLS_PER_ROW * digests.count()))
    probed = materialize(possibly_repeated(digests, "text_sha256", cells), "probed")
    alone = probed.where(~F.col("__maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    others = probed.where("__maybe")
    best = F.min(F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("n"), "doc_id", "row"))
    groups = others.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    groups = materialize(groups, "groups")  # a stored side leaves the join free to split a text with very many copies
    compared = others.join(groups, "text_sha256").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(compared)
