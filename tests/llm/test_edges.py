"""Cases at the edges of earlier operators: ties of vectors, tiny sources, quotas of many shards, names of columns, few languages."""

from __future__ import annotations

import random
from heapq import nlargest

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from seasonstats.llm import hnsw, langid, linededup, mixing, text
from seasonstats.llm.queries import tokenizer_path
from seasonstats.llm.shipping import ship
from tests.conftest import SF


def cosines(rows, query, k):
    own = {i: np.array(v) for i, v in rows}
    scale = lambda v: v / np.abs(v).max()
    q = scale(own[query])
    found = [(-(scale(v) @ q) / (np.linalg.norm(scale(v)) * np.linalg.norm(q)), i) for i, v in own.items() if i != query]
    return sorted(found)[:k]


def test_vectors_of_one_direction_tie_by_id(spark):
    ship(spark)
    draw = np.random.default_rng(2)
    base = draw.normal(size=12)
    rows = [(i, draw.normal(size=12).tolist()) for i in range(1, 200)]
    rows += [(50 * 7, base.tolist())]
    rows += [(1000 - i, (base * 2.0 ** ((i % 40) - 20)).tolist()) for i in range(90)]
    rows += [(2000, (base * 2.0**600).tolist()), (2001, (base * 2.0**-900).tolist())]
    found = hnsw.nearest_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = [r["vec_id"] for r in found.where("query_id = 350").orderBy("rank").collect()]
    assert got == [911, 912, 913, 914, 915]
    for query in (50, 100, 2000):
        mine = found.where(f"query_id = {query}").orderBy("rank").collect()
        expected = cosines(rows, query, 5)
        assert [r["score"] for r in mine] == pytest.approx([-s for s, _ in expected], rel=1e-14)


def naive(claims, seats, caps):
    """Seat by seat to the highest quotient that has room."""
    quota = [0] * len(claims)
    for _ in range(seats):
        open_ = [i for i in range(len(claims)) if quota[i] < caps[i]]
        if not open_:
            break
        quota[nlargest(1, open_, key=lambda i: (claims[i] / (2 * quota[i] + 1), -i))[0]] += 1
    return quota


@pytest.mark.parametrize(("n", "seats"), [(1, 7), (9, 40), (60, 500), (60, 11)])
def test_quotas_equal_seat_by_seat(spark, n, seats):
    draw = random.Random(n + seats)
    claims = [draw.randrange(1, 900) / 4 for _ in range(n)]
    whole = sum(claims)
    caps = [int(2 * seats * c / whole) + 3 for c in claims]
    cells = spark.createDataFrame([(i, c, m) for i, (c, m) in enumerate(zip(claims, caps, strict=True))], "key long, claim double, cap long")
    found = mixing.apportion(cells, ["key"], "claim", seats, whole, n, "cap").orderBy("key").collect()
    assert [r["quota"] for r in found] == naive(claims, seats, caps)


@pytest.mark.parametrize(("sources", "words", "shard_rows"), [(40, 3, 4096), (7, 1, 4096), (5, 400, 16), (3, 90, 4)])
def test_sources_of_any_size_come_near_their_targets(spark, sources, words, shard_rows):
    draw = random.Random(words)
    rows = []
    for s in range(sources):
        left = words
        while left:
            size = min(left, draw.randrange(1, 9))
            rows.append((len(rows), " ".join(["w"] * size), f"s{s:02}"))
            left -= size
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix_sources(table, shard_rows=shard_rows).collect()
    taken, target, size = {}, {}, {}
    for r in found:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    for s in target:
        assert -1 <= taken[s] - target[s] <= mixing.BLOCK * (1 + 0.1 * size[s] / mixing.BLOCK)
    assert sum(taken.values()) >= 1.45 * sum(size.values())


def test_lines_of_a_table_with_the_names_of_the_operator(spark):
    kind = "doc_id long, text string, gone string, rank int, place int, no int, text_hash long, at string, n_lines int"
    rows = [(i, "one line\ntwo line\nown %d" % i, "g", 1, 2, 3, 4, "x", 5) for i in range(3)]
    found = linededup.drop_repeated_runs(spark.createDataFrame(rows, kind)).orderBy("doc_id").collect()
    assert [r["text"] for r in found] == ["one line\ntwo line\nown 0", "own 1", "own 2"]
    assert {(r["gone"], r["rank"], r["n_lines"]) for r in found} == {("g", 1, 3)}


def test_stages_keep_the_columns_of_the_input(spark):
    ship(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "77.0D AS score", "'x' AS lang_pred", "doc_id AS n_lines", "5 AS n_removed")
    kept = corpus_pipeline.language(spark, docs, SF)
    assert kept.columns == docs.columns
    assert {(r["score"], r["lang_pred"]) for r in kept.select("score", "lang_pred").distinct().collect()} == {(77.0, "x")}
    after = corpus_pipeline.lines(spark, kept, SF)
    assert after.columns == docs.columns and after.where("n_lines <> doc_id OR n_removed <> 5").count() == 0


@pytest.mark.parametrize("languages", [1, 2, 4])
def test_clean_texts_of_few_languages_stay(spark, languages):
    ship(spark)
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    names = sorted(r[0] for r in docs.where("lang IS NOT NULL").select("lang").distinct().collect())[:languages]
    clean = docs.where(docs.lang.isin(names) & (docs.n_chars > 200)).unionByName(docs.limit(1).selectExpr(
        "-1L AS doc_id", "'12 34 !!' AS text", "lang", "source", "n_chars"))
    kept = corpus_pipeline.language(spark, clean, SF)
    assert kept.where("doc_id = -1").count() == 0
    assert kept.count() >= 0.97 * (clean.count() - 1)


def test_symbols_keep_every_byte_beyond_ascii_apart():
    assert len(set(langid._FOLD[128:].tolist())) == 128 and langid._FOLD.max() == langid.SYMBOLS - 1
    assert langid._FOLD[ord("Q")] == langid._FOLD[ord("q")] > 0 == langid._FOLD[ord("5")]


def _maximal_by_hand(texts: list[tuple], run: int) -> set[tuple]:
    """Runs of each document by comparing every two places."""
    order = sorted(texts, key=lambda t: (t[0] is None, t[0] or 0))
    lines = [(d, [(n, x) for n, x in enumerate((t or "").split("\n")) if x.strip()]) for d, t in order]
    places = [(i, p) for i, (_, own) in enumerate(lines) for p in range(len(own))]
    found = set()
    for at, (i, p) in enumerate(places):
        best = (0, None)
        for j, q in places[:at]:
            size = 0
            while (p + size < len(lines[i][1]) and q + size < len(lines[j][1])
                   and lines[i][1][p + size][1] == lines[j][1][q + size][1]):
                size += 1
            if size > best[0]:
                best = (size, (j, q))
        if p == 0:
            reach = 0
        if best[0] >= run and p + best[0] > reach:
            reach = p + best[0]
            j, q = best[1]
            found.add((lines[i][0], lines[i][1][p][0], best[0], lines[j][0], lines[j][1][q][0]))
    return found


@pytest.mark.parametrize("run", [1, 2, 5])
def test_maximal_runs(spark, run):
    draw = random.Random(run)
    texts = [(i, "\n".join(draw.choice("abc" if i % 3 else "abcdefgh") for _ in range(draw.randint(0, 14)))) for i in range(14)]
    long = [f"line {i}" for i in range(37)]
    texts += [(20, "\n".join(long)), (21, "\n".join(["x", *long[3:30], "", *long[30:35]])), (22, None), (23, " \n\n"),
              (24, "\n".join(long[5:20] + long[4:21])), (None, "\n".join(long[::-1] + long)), (25, "\n".join(["same"] * 21))]
    docs = spark.createDataFrame(texts + texts[:3], "doc_id long, text string").repartition(3)
    found = [tuple(r) for r in linededup.maximal_runs(docs, run).collect()]
    assert len(found) == len(set(found)) and set(found) == _maximal_by_hand(texts, run)
    assert any(r[2] > 16 for r in found)
    assert linededup.maximal_runs(docs.limit(0), run).count() == 0


def test_line_stage_doubles_to_the_longest_run(spark, monkeypatch):
    levels, suffixes = [], linededup._suffixes
    monkeypatch.setattr(linededup, "_suffixes", lambda *a: levels.append(suffixes(*a)) or levels[-1])
    rows = [(i, "first\nsecond\nthird\nfourth", "en", "web", 25) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.lines(spark, docs, SF).collect()
    assert [(r["doc_id"], r["text"]) for r in kept] == [(0, rows[0][1])]
    assert len(levels[0]) == 3  # runs of 1, 2 and 4 lines


def test_words_kept_by_an_encoder_are_given_back():
    encoder = text.subwords(tokenizer_path())
    texts = pa.array(["some words, some twice", None])
    ids = encoder.encode(texts)[0].tolist()
    assert encoder.kept
    text.release()
    assert not encoder.kept and text.subwords(tokenizer_path()).encode(texts)[0].tolist() == ids
