"""From raw documents to packed sequences: each stage applies one operator to all that the stage before has kept."""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from seasonstats.llm import jaccard, langid, linededup, mixing, packing  # noqa: E402
from seasonstats.llm.queries import tokenizer_path  # noqa: E402
from seasonstats.llm.shipping import ship  # noqa: E402
from seasonstats.sources.shared import materialize  # noqa: E402

# A text is in a language if its score is so many times chance (one in as many as there are languages), or this much;
# short clean texts score little above chance.
TIMES_CHANCE, ENOUGH = 1.2, 0.9

# SQL can express neither the kernel model nor the packing; the stages are tested against brute force.
ORACLE_SQL = None


_ADDED = ("held_out", "lang_pred", "score", "n_lines", "n_removed")  # columns that the operators add


def _aside(docs: DataFrame) -> DataFrame:
    """``docs`` with its own columns of these names under others."""
    return docs.withColumnsRenamed({c: f"__own_{c}" for c in _ADDED if c in docs.columns})


def _back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"__own_{c}").alias(c) if c in _ADDED else F.col(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without a letter, or for which no language stands out, go."""
    ship(spark)
    languages = docs.where(F.col("lang").isNotNull()).select("lang").distinct().count()
    least = min(ENOUGH, TIMES_CHANCE / max(1, languages))
    found = langid.identify_languages(_aside(docs))
    clear = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= least)
    return _back(found.where(clear), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated lines, also of single ones; a text of which nothing is left goes."""
    kept = linededup.drop_repeated_runs(_aside(docs), run=1)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(linededup.WRITTEN)
    return _back(kept.where(left).withColumn("n_chars", F.char_length("text").cast("long")), docs)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number ``__row`` of each row. Stored, as it depends on how a job cuts the input and several read it."""
    return materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word Jaccard similarity of 0.75 or more: the one with the least id."""
    ship(spark)
    # Rows that share an id, or have none, are told apart by a number.
    numbered = _numbered(docs)
    classes = jaccard.similarity_classes(numbered, "__row")
    grouped = materialize(classes, "groups")
    rows = numbered.select("__row", "doc_id").join(
        grouped.select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group")), "__row"
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row"))
    kept = rows.groupBy("__group").agg(first["__row"].alias("__row")).select("__row")
    # By shuffle at every size, here and below: the rows to join grow with the documents.
    return numbered.join(materialize(kept, "kept").hint("merge"), "__row", "left_semi").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes of it, to the nearest: none, one or two."""
    numbered = _numbered(docs)
    mixed = mixing.mix_sources(numbered, "__row").select(
        F.col("doc_id").alias("__row"),
        F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int").alias("__copies"),
    )
    mixed = materialize(mixed.where("__copies > 0"), "copies").hint("merge")
    copied = numbered.join(mixed, "__row").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return copied.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 2048 tokens that all documents are packed into."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language identification", language),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing to target weights", mixture),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
