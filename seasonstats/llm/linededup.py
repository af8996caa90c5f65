"""Line dedup: maximal repeated runs of lines from a suffix array of line sequences, in DataFrame functions only.

Written lines get places in one global order, with a gap after each document. Prefix doubling names the sequences of the
first 1, 2, 4, ... lines of each suffix by the names of their two halves; the name is the first place that has the
sequence. Suffixes of one name are an interval of the suffix array in which that many lines are common (the names of all
lengths, one after the other, are a suffix's key in the array; branches of an interval follow in the order of their first
places, where the alphabet's order would do no more). A suffix whose lines occur once leaves, and doubling ends when
none is left, so the rounds follow the longest repeated run.

A suffix that is not the first of its interval has an earlier copy of that length at least. The longest-common-prefix
interval between two lengths of doubling is found by halving: half as many lines more are tried, then a quarter, by the
names that are stored. What is found is the longest run at each place that also starts earlier. Runs that reach further
than those before them are maximal; what they cover is deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seasonstats.functions.ordering import with_running_totals
from seasonstats.sources.shared import materialize

RUN = 2  # lines; a single line that is repeated is usual in clean text
WRITTEN = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _documents(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(start, doc_id, text_hash, cells): the written lines (no, a, b) of each document and the place of its first line.
    Rows that agree in id and text are one document; a null id comes last."""
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )
    numbered = F.transform(_lines(F.col("text")), lambda x, i: F.struct(i.alias("no"), x.alias("line")))
    written = F.filter(numbered, lambda x: x["line"].rlike(WRITTEN))
    cells = F.transform(
        written,
        lambda x: F.struct(
            x["no"].alias("no"), F.xxhash64(x["line"]).alias("a"), F.xxhash64(F.lit(1), x["line"]).alias("b")
        ),
    )
    held = texts.select("doc_id", "text_hash", cells.alias("cells")).where(F.size("cells") > 0)
    held = held.dropDuplicates(["doc_id", "text_hash"])
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash")]
    placed = with_running_totals(held, [], order, {"place": F.size("cells").cast("long") + 1})
    return placed.select(F.col("place_before").alias("start"), "doc_id", "text_hash", "cells")


def _named(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` whose ``key`` occurs more than once, with the ``first`` place that has it, which also names the key."""
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("held"), F.min("pos").alias("first")).where("held > 1")
    # Stored, so that the join may split a key that very many rows have.
    return rows.join(materialize(groups.drop("held"), "intervals"), key).drop(*key)


def _suffixes(documents: DataFrame, longest: int | None = None) -> list[DataFrame]:
    """For each k the suffixes (pos, first) whose first 2**k lines occur elsewhere, too; also start for k = 0. Doubling ends
    when there are none, or beyond ``longest`` lines."""
    lines = documents.select("start", F.posexplode("cells").alias("place", "at"))
    lines = lines.select((F.col("start") + F.col("place")).alias("pos"), "start", "at.a", "at.b")
    found, levels = materialize(_named(materialize(lines, "lines"), ["a", "b"]), "suffixes"), []
    while not levels or not found.isEmpty():
        levels.append(found)
        if longest is not None and 1 << len(levels) > longest:
            break
        ahead = 1 << (len(levels) - 1)
        rows = found.select("pos", F.col("first").alias("begin"))
        after = found.select((F.col("pos") - ahead).alias("pos"), F.col("first").alias("then"))
        pairs = materialize(rows.join(after, "pos"), "pairs")
        if pairs.isEmpty():
            break
        found = materialize(_named(pairs, ["begin", "then"]), "suffixes")
    return levels


def _earlier_runs(levels: list[DataFrame]) -> DataFrame:
    """(pos, start, length, first): the longest run of lines at each place that also starts earlier, and where first."""
    at = None
    for k, level in enumerate(levels):
        start = F.col("start") if k == 0 else F.lit(None).cast("long")
        later = level.where("first < pos").select("pos", start.alias("start"), F.lit(k).alias("k"), "first")
        at = later if at is None else at.unionByName(later)
    longest = at.groupBy("pos").agg(F.max("start").alias("start"), F.max(F.struct("k", "first")).alias("best"))
    length = F.expr("shiftleft(1L, best.k)")
    doubled = materialize(
        longest.select("pos", "start", F.col("best.k").alias("k"), length.alias("length"), F.col("best.first").alias("first")),
        "runs",
    )
    runs = doubled.where(F.col("k") == len(levels) - 1)
    for j in range(len(levels) - 2, -1, -1):
        # Suffixes of one run so far are compared with one another and with its first copy. The first suffix of the longer
        # run is among them: were its own run longer still, that run's first would be the first here.
        firsts = runs.select(F.col("first").alias("pos"), "length", "first").distinct()
        tried = runs.unionByName(firsts, allowMissingColumns=True)
        names = levels[j].select(F.col("pos").alias("next"), F.col("first").alias("then"))
        tried = materialize(
            tried.withColumn("next", F.col("pos") + F.col("length")).join(names, "next", "left").drop("next"), "tried"
        )
        key = ["length", "first", "then"]
        sooner = materialize(tried.where("then IS NOT NULL").groupBy(*key).agg(F.min("pos").alias("sooner")), "sooner")
        grown = F.coalesce(F.col("sooner") < F.col("pos"), F.lit(False))
        tested = tried.where("k IS NOT NULL").join(sooner, key, "left").select(
            "pos", "start", "k",
            F.when(grown, F.col("length") + (1 << j)).otherwise(F.col("length")).alias("length"),
            F.when(grown, F.col("sooner")).otherwise(F.col("first")).alias("first"),
        )
        runs = tested.unionByName(doubled.where(F.col("k") == j))
    return runs.drop("k")


def _along() -> WindowSpec:
    """The places of one document."""
    return Window.partitionBy("start").orderBy("pos")


def later_copies(
    docs: DataFrame, run: int = RUN, id_column: str = "doc_id", text_column: str = "text", longest: int | None = None
) -> DataFrame:
    """(doc_id, text_hash, gone): of each document that holds any, the numbers, from 0, of the lines within a run of at
    least ``run`` lines that also starts earlier."""
    documents = _documents(docs, id_column, text_column)
    runs = _earlier_runs(_suffixes(documents, longest))
    reach = F.max(F.when(F.col("length") >= run, F.col("pos") + F.col("length"))).over(_along())
    covered = runs.select("start", "pos", reach.alias("reach")).where("reach > pos")
    places = covered.groupBy("start").agg(F.collect_list((F.col("pos") - F.col("start")).cast("int")).alias("places"))
    return documents.join(places, "start").select(
        "doc_id", "text_hash", F.transform("places", lambda p: F.col("cells")[p]["no"]).alias("gone")
    )


def maximal_runs(docs: DataFrame, run: int = RUN, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The repeated runs of at least ``run`` written lines that are within no other such run of their document: doc_id,
    line (number, from 0), length (written lines), first_doc_id and first_line, where the same lines start first.

    Ids, repeated rows and texts without a line are taken as in ``drop_repeated_runs``; no runs give no rows.
    """
    documents = _documents(docs, id_column, text_column)
    levels = _suffixes(documents)
    runs = _earlier_runs(levels).where(F.col("length") >= run)
    before = F.max(F.col("pos") + F.col("length")).over(_along().rowsBetween(Window.unboundedPreceding, -1))
    ends = F.col("pos") + F.col("length")
    most = runs.withColumn("before", before).where(F.col("before").isNull() | (ends > F.col("before"))).drop("before")
    starts = levels[0].select(F.col("pos").alias("first"), F.col("start").alias("first_start"))
    most = materialize(most.join(starts, "first"), "maximal_runs")
    own = documents.select("start", "doc_id", "cells")
    firsts = documents.select(F.col("start").alias("first_start"), F.col("doc_id").alias("first_doc_id"), F.col("cells").alias("first_cells"))
    line = lambda cells, pos, start: F.col(cells)[(F.col(pos) - F.col(start)).cast("int")]["no"]
    found = most.join(own, "start").withColumn("line", line("cells", "pos", "start")).drop("cells")
    return found.join(firsts, "first_start").select(
        "doc_id", "line", "length", "first_doc_id", line("first_cells", "first", "first_start").alias("first_line")
    )


def drop_repeated_runs(
    docs: DataFrame, run: int = RUN, id_column: str = "doc_id", text_column: str = "text", longest: int | None = None
) -> DataFrame:
    """All columns of ``docs`` with the text without later copies of repeated runs, and n_lines and n_removed (these
    replace columns of the same names).

    A run is ``run`` or more lines that follow one another, blank lines left out; it is judged on the input, and its
    first copy in the order of ids, then of places, stays. Blank lines and lines outside of runs stay as they are. Null
    text stays null, with no lines. A null id comes last; rows that agree in id and text are one document and are treated
    alike; other rows with one id follow in the order of a hash of their texts.

    With ``longest`` (at least ``run``) doubling ends at so many lines. The text is the same: a longer run is the union of
    its parts of ``run`` lines.
    """
    gone = materialize(later_copies(docs, run, id_column, text_column, longest), "gone").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("gone").alias("__gone")
    )
    named = docs.drop("n_lines", "n_removed")
    # Split before the join, whose output the lambda reads; a text in a lambda would be split again for every line.
    split = named.withColumn("__text_hash", F.xxhash64(text_column)).withColumn(text_column, F.split(text_column, "\n", -1))
    # By shuffle at every size: these numbers grow with the documents, so a broadcast would only hold for small inputs.
    joined = split.join(
        gone.hint("merge"), F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")), "left"
    )
    lines = F.col(text_column)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__gone")
    left = F.when(F.col("__gone").isNull(), lines).otherwise(F.transform(kept, lambda i: lines[i]))
    return joined.select(
        *[F.array_join(left, "\n").alias(c) if c == text_column else F.col(c) for c in named.columns],
        F.when(lines.isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("__gone").isNull(), F.lit(0)).otherwise(F.size("__gone")).cast("long").alias("n_removed"),
    )
