"""Quality rules: text statistics, and an ordered list of threshold rules learned from labelled ones.

The statistics of whole texts are counted by arrays in tasks. Rules are learned by sequential covering: a rule is grown
condition by condition on two thirds of the labelled statistics until it covers (nearly) no good text, pruned on the
other third, and kept if it is right there often enough; then the texts it covers are set aside and the next rule is
grown. The result is a list that people can read and change, and it is applied as one Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonstats.llm.text import chunks, gram_starts, words
from seasonstats.sources.shared import materialize

SAMPLE = 50_000  # labelled statistics (distinct ones) that rules are learned from, at most about
CHUNK = 2 << 20
REPEATED = 3  # words in a window
MOST_RULES, MOST_CONDITIONS = 24, 5
LEAST_PRECISION = 0.9  # of a rule on the rows it is pruned on: clean texts should stay
LEAST_COVERED = 3
CUTS = 64  # thresholds tried per statistic and condition

FEWEST_WORDS, MOST_REPEATED = 50, 50  # percent

_SPACE = [32, *range(9, 14)]
_COUNTED = {  # bytes that each number counts; all but the last are characters of ASCII
    "n_symbols": b"#*$%&|<>",
    "n_upper": bytes(range(65, 91)),
    "n_digits": bytes(range(48, 58)),
    "n_marks": bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]),
    "word_chars": bytes(b for b in range(256) if b not in _SPACE and not 128 <= b < 192),
}
_TABLES = {name: np.isin(np.arange(256), list(held)) for name, held in _COUNTED.items()}
COUNTS = ("n_words", *_COUNTED, "n_lines", "n_dup_lines", "n_distinct_words", "n_repeat_words")

# What rules may ask for: shares of the counts above. A text without words has 0 everywhere.
FEATURES = {
    "n_words": "CAST(n_words AS DOUBLE)",
    "word_length": "coalesce(try_divide(word_chars, n_words), 0)",
    "symbol_share": "coalesce(try_divide(n_symbols, word_chars), 0)",
    "upper_share": "coalesce(try_divide(n_upper, word_chars), 0)",
    "digit_share": "coalesce(try_divide(n_digits, word_chars), 0)",
    "mark_share": "coalesce(try_divide(n_marks, word_chars), 0)",
    "dup_line_share": "coalesce(try_divide(n_dup_lines, n_lines), 0)",
    "words_per_line": "coalesce(try_divide(n_words, n_lines), 0)",
    "distinct_share": "coalesce(try_divide(n_distinct_words, n_words), 0)",
    "repeat_share": "coalesce(try_divide(n_repeat_words, n_words), 0)",
}


def _key(columns: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """One number for each combination of the columns' values, which are below the given sizes."""
    key, span = np.zeros(len(columns[0][0]), np.int64), 1
    for values, size in columns:
        if span * size >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            span = len(key)
        key, span = key * size + values, span * size
    return key


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """``COUNTS`` of each text; null has none."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    _, ends, values = texts.buffers()
    ends = np.frombuffer(ends, np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset : texts.offset + n + 1]
    ends = ends.astype(np.int64)
    data = np.frombuffer(values, np.uint8)[ends[0] : ends[-1]] if values else np.zeros(0, np.uint8)
    found = {}
    for name, table in _TABLES.items():
        found[name] = np.diff(np.concatenate([[0], np.cumsum(table[data])])[ends - ends[0]])

    known, codes, offsets = words(texts)
    found["n_words"] = np.diff(offsets)
    of_word = np.repeat(np.arange(n), found["n_words"])
    size = max(1, len(known))
    distinct = np.unique(_key([(of_word, n), (codes, size)])) // size if len(codes) else of_word
    found["n_distinct_words"] = np.bincount(distinct, minlength=n)

    starts, of_window = gram_starts(offsets, REPEATED)
    windows = _key([(of_window, n), *[(codes[starts + i].astype(np.int64), size) for i in range(REPEATED)]]) if len(starts) else starts
    _, place, often = np.unique(windows, return_inverse=True, return_counts=True)
    again = starts[often[place] > 1]
    covered = np.zeros(len(codes), bool)
    for i in range(REPEATED):
        covered[again + i] = True
    found["n_repeat_words"] = np.bincount(of_word[covered], minlength=n)

    lists = pc.split_pattern(texts, "\n")
    of_line = np.repeat(np.arange(n), pc.list_value_length(lists).to_numpy())
    lines = lists.flatten()
    written = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    coded = lines.dictionary_encode()
    of_line, line = of_line[written], coded.indices.to_numpy()[written].astype(np.int64)
    size = max(1, len(coded.dictionary))
    found["n_lines"] = np.bincount(of_line, minlength=n)
    first = np.unique(of_line * size + line) // size
    found["n_dup_lines"] = found["n_lines"] - np.bincount(first, minlength=n)
    return found


def with_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and ``COUNTS`` of the whole text of every row. Null text has no words and counts 0 everywhere; other
    columns are not read; no rows give no rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, size=CHUNK):
                found = text_counts(part.column("text"))
                columns = [part.column("doc_id"), *[pa.array(found[c].astype(np.int64)) for c in COUNTS]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *COUNTS])

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(count, ", ".join(f"{c} long" for c in ("doc_id", *COUNTS)))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        values = rows[self.feature]
        return values > self.threshold if self.above else values <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}"

    def column(self) -> Column:
        return F.expr(f"({FEATURES[self.feature]}) {'>' if self.above else '<='} CAST('{self.threshold!r}' AS DOUBLE)")


Rule = tuple[Condition, ...]


def covers(rule: Rule, rows: dict[str, np.ndarray]) -> np.ndarray:
    held = np.ones(len(rows["weight"]), bool)
    for condition in rule:
        held &= condition.holds(rows)
    return held


def _sums(rows: dict[str, np.ndarray], held: np.ndarray) -> tuple[float, float]:
    """Weights of (bad, good) rows among those held."""
    weight = rows["weight"][held]
    bad = rows["bad"][held]
    return float(weight[bad].sum()), float(weight[~bad].sum())


def _best_condition(rows: dict[str, np.ndarray], held: np.ndarray) -> Condition | None:
    """The condition of the highest information gain (bad rows that stay, times what they gain in bits)."""
    bad, good = _sums(rows, held)
    now = np.log2(bad / (bad + good))
    weight, is_bad = rows["weight"][held], rows["bad"][held]
    best, found = 1e-9, None
    for feature in FEATURES:
        values = rows[feature][held]
        order = np.argsort(values, kind="stable")
        values = values[order]
        bads, goods = np.cumsum((weight * is_bad)[order]), np.cumsum((weight * ~is_bad)[order])
        ends = np.flatnonzero(np.diff(values) > 0)  # the last row of each value but the highest
        for above in (False, True):
            p = bad - bads[ends] if above else bads[ends]
            n = good - goods[ends] if above else goods[ends]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - now), 0.0)
            if len(gain) and gain.max() > best:
                at = int(gain.argmax())
                best = float(gain[at])
                low, high = float(values[ends[at]]), float(values[ends[at] + 1])
                middle = float(f"{(low + high) / 2:.6g}")
                found = Condition(feature, above, middle if low <= middle < high else low)
    return found


def grow(rows: dict[str, np.ndarray]) -> Rule:
    """Add the best condition until no good row is covered, or none helps."""
    rule, held = (), np.ones(len(rows["weight"]), bool)
    while len(rule) < MOST_CONDITIONS and _sums(rows, held)[1] > 0:
        found = _best_condition(rows, held)
        if found is None:
            break
        rule, held = (*rule, found), held & found.holds(rows)
    return rule


def _worth(rule: Rule, rows: dict[str, np.ndarray]) -> float:
    bad, good = _sums(rows, covers(rule, rows))
    return (bad - good) / (bad + good) if bad + good else -1.0


def prune(rule: Rule, rows: dict[str, np.ndarray]) -> Rule:
    """The shortest beginning of ``rule`` that is worth most on rows it was not grown on."""
    return max((rule[:n] for n in range(1, len(rule) + 1)), key=lambda r: (_worth(r, rows), -len(r)), default=())


def learn(rows: dict[str, np.ndarray]) -> list[Rule]:
    """An ordered list of rules for bad rows. ``rows``: features, ``bad``, ``weight`` and ``part`` (0 to 2; 2 prunes)."""
    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        pruning = rows["part"] == 2
        growing = {k: v[~pruning] for k, v in rows.items()}
        others = {k: v[pruning] for k, v in rows.items()}
        if not growing["bad"].any():
            break
        rule = grow(growing)
        rule = prune(rule, others) if len(others["weight"]) else rule
        if not rule:
            break
        held = covers(rule, rows)
        seen_bad, seen_good = _sums(rows, held)
        bad, good = _sums(others, covers(rule, others))
        if seen_bad < LEAST_COVERED or bad < LEAST_PRECISION * (bad + good) or seen_bad < LEAST_PRECISION * (seen_bad + seen_good):
            break
        rules.append(rule)
        rows = {k: v[~held] for k, v in rows.items()}
    return rules


def learn_rules(counts: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> list[Rule]:
    """Rules for texts whose label is 0, from all labelled rows of ``counts`` (as ``with_counts`` gives them), or from about
    ``sample`` distinct ones drawn by their hash. Rows without a label or id teach nothing; a text labelled more than once
    counts as often, whatever its labels say. Without rows there are no rules.
    """
    asked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    asked = asked.groupBy(F.col("doc_id").alias("of"), (F.col(label) == 0).alias("bad")).agg(F.count(F.lit(1)).alias("times"))
    known = counts.join(materialize(asked, "labels"), F.col("doc_id") == F.col("of"))
    # Equal statistics are one row with a weight, so that copies and hot ids cost one row each.
    rows = known.groupBy(*COUNTS, "bad").agg(F.sum("times").alias("weight"))
    hashed = F.pmod(F.xxhash64(*COUNTS), F.lit(1 << 30))
    rows = materialize(rows.withColumn("drawn", hashed), "labelled")
    share = min(1.0, sample / max(1, rows.count()))  # one number
    drawn = rows.where(F.col("drawn") < int(share * (1 << 30))).select(
        *[F.expr(f).cast("double").alias(name) for name, f in FEATURES.items()], "bad", F.col("weight").cast("double").alias("weight"),
        (F.col("drawn") % 3).cast("int").alias("part"), "drawn",
    )
    table = drawn.toArrow().sort_by([("drawn", "ascending"), ("bad", "ascending")])
    return learn({c: table.column(c).to_numpy() for c in (*FEATURES, "bad", "weight", "part")})


def verdict(rules: list[Rule]) -> Column:
    """Whether a text is kept, as one conditional expression over ``COUNTS``: the first rule that holds drops it."""
    found = F.lit(True)
    for rule in reversed(rules):
        held = F.lit(True)
        for condition in rule:
            held = held & condition.column()
        found = F.when(held, F.lit(False)).otherwise(found)
    return found


def base_failed() -> Column:
    """Fixed rules ahead of the learned ones: too few words, or most of them in repeated windows."""
    return (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """doc_id, all counts, base_failed and kept for every row of ``docs``, with rules learned from ``labels``.

    Rules are learned from labelled texts that the fixed rules let pass, as only these are left to them.
    """
    counts = materialize(with_counts(docs), "text_counts").withColumn("base_failed", base_failed())
    rules = learn_rules(counts.where(~F.col("base_failed")), labels, label, sample)
    return counts.withColumn("kept", ~F.col("base_failed") & verdict(rules))
