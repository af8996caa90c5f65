"""Quality rules: counts against a plain version, learned rules against what was planted, and the expression against the rules."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from seasonstats.llm import quality as Q
from seasonstats.llm.shipping import ship
from tests.conftest import SF, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, n_words string, kept int, weight string, of long, bad int"


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_upper": sum("A" <= c <= "Z" for c in text or ""), "n_digits": sum("0" <= c <= "9" for c in text or ""),
        "n_marks": sum(33 <= ord(c) < 127 and not c.isalnum() for c in text or ""), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)), "n_distinct_words": len(set(words)), "n_repeat_words": len(covered),
    }


def texts():
    draw = random.Random(6)
    words = ["a", "bb", "É", "中文", "x1", "#", "A|B", "<p>", "don't", "a b", "Z9%"]
    made = [None, "", " \t\n\x0b\x0c\r", "a", "a a a a", "a b\n\na b\n a b\na b\r", "\n\n", "x y   z", "a b c a b c d"]
    made += [draw.choice([" ", "\n", " \n"]).join(draw.choices(words, k=draw.randrange(60))) for _ in range(60)]
    return made + ["\n".join(" ".join(draw.choices(words, k=4)) for _ in range(5000))]


def test_counts_equal_the_plain_form():
    made = texts()
    for kind in (pa.string(), pa.large_string()):
        found = Q.text_counts(pa.array(["first", *made], kind).slice(1))
        for i, text in enumerate(made):
            assert {c: int(found[c][i]) for c in Q.COUNTS} == plain_counts(text)


def test_keys_of_many_values_stay_apart():
    draw = np.random.default_rng(2)
    columns = [(draw.integers(0, 1 << 40, 500) % 7 + (1 << 39), 1 << 40) for _ in range(4)]
    found = Q._key(columns)
    rows = list(zip(*[c.tolist() for c, _ in columns], strict=True))
    assert len(set(found.tolist())) == len(set(rows)) == len({(a, b) for a, b in zip(found.tolist(), rows, strict=True)})


def planted(n, noise=0.0):
    """Bad rows: many symbols; or short words with many repeats."""
    draw = np.random.default_rng(5)
    rows = {f: draw.random(n) for f in Q.FEATURES} | {"weight": np.ones(n), "part": draw.integers(0, 3, n)}
    bad = (rows["symbol_share"] > 0.8) | ((rows["word_length"] <= 0.3) & (rows["repeat_share"] > 0.6))
    rows["bad"] = bad ^ (draw.random(n) < noise)
    return rows, bad


@pytest.mark.parametrize("noise", [0.0, 0.03])
def test_planted_rules_are_found(noise):
    rows, bad = planted(6000, noise)
    rules = Q.learn(rows)
    found = np.zeros(6000, bool)
    for rule in rules:
        found |= Q.covers(rule, rows)
    assert (found == bad).mean() > 0.97
    assert (found & ~bad).sum() <= 0.01 * (~bad).sum()  # good rows stay
    used = {c.feature for rule in rules[:2] for c in rule}
    assert used == {"symbol_share", "word_length", "repeat_share"}


def test_no_rules_without_a_pattern_or_rows():
    rows, _ = planted(900)
    rows["bad"] = np.random.default_rng(1).random(900) < 0.2
    assert Q.learn(rows) == []
    assert Q.learn({k: v[:0] for k, v in rows.items()}) == []
    assert Q.learn(rows | {"bad": np.zeros(900, bool)}) == []


def test_pruning_drops_what_does_not_hold_elsewhere():
    rows, bad = planted(3000)
    right, stray = Q.Condition("symbol_share", True, 0.8), Q.Condition("digit_share", True, 0.5)
    assert Q.prune((right, stray), rows) == (right,)


def test_expression_equals_the_rules(spark):
    ship(spark)
    made = texts()
    docs = spark.createDataFrame([(i, t, "x", 1, "y", 2, 3) for i, t in enumerate(made)], DOCS)
    counts = Q.with_counts(docs)
    rules = [
        (Q.Condition("symbol_share", True, 0.1), Q.Condition("n_words", False, 30.0)),
        (Q.Condition("repeat_share", True, 0.25),),
        (Q.Condition("word_length", False, 1.4), Q.Condition("words_per_line", True, 3.0), Q.Condition("distinct_share", False, 0.7)),
    ]
    shares = counts.select("doc_id", *[F.expr(f).cast("double").alias(n) for n, f in Q.FEATURES.items()]).orderBy("doc_id").toPandas()
    rows = {c: shares[c].to_numpy() for c in Q.FEATURES} | {"weight": np.ones(len(shares))}
    expected = [not any(Q.covers(rule, rows)[i] for rule in rules) for i in range(len(made))]
    assert [r["kept"] for r in counts.withColumn("kept", Q.verdict(rules)).orderBy("doc_id").collect()] == expected
    assert 5 < sum(expected) < len(made) - 5


def test_judge_learns_from_labels(spark):
    ship(spark)
    draw = random.Random(3)
    prose = lambda n: " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 9))) for _ in range(n))
    rows = [(i, prose(80) if i % 4 else prose(40) + " | # ".join([""] * 30) + prose(20)) for i in range(240)]
    rows += [(None, prose(80)), (7, rows[4][1]), (500, None), (501, ""), (502, "a b c " * 60), (503, prose(49)), (504, prose(50))]
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in rows], DOCS).repartition(4)
    labels = [(i, int(i % 4 != 0), 0) for i in range(0, 200, 2)] + [(0, 0, 1)] * 30 + [(None, 0, 0), (4, None, 0), (999, 1, 1)]
    labels += [(i, 1, 0) for i in range(1, 200, 6)]
    found = Q.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    expected = []
    for doc_id, text in rows:
        c = plain_counts(text)
        failed = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        expected.append((doc_id, c["n_words"], c["n_symbols"], c["n_repeat_words"], failed, not failed and "|" not in text))
    columns = ["doc_id", "n_words", "n_symbols", "n_repeat_words", "base_failed", "kept"]
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr) == sorted(expected, key=repr)


def test_empty_tables(spark):
    ship(spark)
    no_docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.judge(no_docs, labels).count() == 0
    docs = spark.createDataFrame([(1, "word " * 10, "", 1, "", 1, 1), (2, " ".join(map(str, range(60))), "", 1, "", 1, 1)], DOCS)
    assert [(r["doc_id"], r["kept"]) for r in Q.judge(docs, labels).orderBy("doc_id").collect()] == [(1, False), (2, True)]


def test_query_counts_and_held_out_labels(spark):
    found = entry.queries()["op13_quality_rules"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    counts = {r["doc_id"]: plain_counts(r["text"]) for r in docs}
    rows = found.collect()
    assert len(rows) == len(docs)
    for r in rows:
        c = counts[r["doc_id"]]
        assert all(r[k] == c[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert r["base_failed"] == (c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_rules_of_half_the_labels_hold_for_the_other(spark):
    ship(spark)
    folder = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = Q.judge(spark.read.parquet(f"{folder}/documents.parquet"), labels.where("doc_id % 2 = 0"))
    held_out = judged.where("NOT base_failed").join(labels.where("doc_id % 2 = 1"), "doc_id")
    right = [(r["quality"] == 1) == r["kept"] for r in held_out.collect()]
    assert len(right) > 100 and sum(right) / len(right) > 0.98
    assert rows_of(held_out.where("quality = 1 AND NOT kept").select("doc_id")) == []
