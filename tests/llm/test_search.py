"""Lexical search against a plain scoring of every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from seasonstats.llm import search
from seasonstats.llm.queries import SQL
from seasonstats.llm.shipping import ship
from seasonstats.sources.shared import new_folder
from tests.conftest import SF, duck_rows, rows_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, terms string, sizes int, item_id long, score string"
ITEMS = "item_id long, text string, part int, size long, doc_id long"


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def plain(docs, items, places=20):
    held = [(d[0], Counter(terms(d[1]))) for d in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item in items:
        scores = []
        for doc_id, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = sum(weight[t] * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(item[1]) if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(s[3], item[0], rank, -s[0]) for rank, s in enumerate(sorted(scores)[:places], start=1)]
    return sorted(out, key=repr)


def tables():
    draw = random.Random(8)
    words = ["the", "a", "of", *(f"w{i}" for i in range(60)), "Été", "été", "中文", "x9"]
    share = [200, 150, 120, *(60 // (i + 1) + 1 for i in range(60)), 3, 3, 2, 2]
    text = lambda n: draw.choice([" ", "-", ", "]).join(draw.choices(words, share, k=n))
    docs = [(i * 3 % 401, text(draw.choice([1, 3, 20, 90]))) for i in range(400)]
    docs += [(500 + i, docs[7][1].upper()) for i in range(60)]  # many documents tie
    docs += [(None, docs[7][1]), (None, docs[7][1]), (3, docs[7][1]), (9, None), (10, ""), (11, " .,!\x7f"), (12, text(30_000))]
    items = [(i, text(draw.choice([1, 4, 30]))) for i in range(40)]
    items += [(40, docs[7][1]), (40, docs[7][1]), (None, "W1 w1 w1 the"), (41, None), (42, ""), (43, "?"), (44, "unheardof"), (45, text(900))]
    return [(*d, "t", 1, 2, "s") for d in docs], [(*i, 1, 2, 3) for i in items]


@pytest.mark.parametrize(("shard", "block", "places"), [(1 << 22, 1 << 22, 20), (3000, 9000, 20), (500, 1 << 22, 3), (1 << 22, 2000, 1)])
def test_search_equals_plain_scores(spark, shard, block, places):
    ship(spark)
    docs, items = tables()
    folder = new_folder(spark, "index")
    search.build_index(spark.createDataFrame(docs, DOCS).repartition(3), folder, shard_bytes=shard)
    found = search.search(spark, folder, spark.createDataFrame(items, ITEMS), places, block_bytes=block)
    assert rows_of(found) == plain(docs, items, places)


def test_empty_tables(spark):
    ship(spark)
    docs, items = tables()
    for d, i in (([], items), (docs, []), ([(1, None, "", 1, 1, "")], items)):
        folder = new_folder(spark, "index")
        search.build_index(spark.createDataFrame(d, DOCS), folder)
        found = search.search(spark, folder, spark.createDataFrame(i, ITEMS))
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_walk_skips_but_loses_nothing():
    draw = np.random.default_rng(3)
    for _ in range(60):
        lists = []
        for size in draw.integers(1, 900, 6):
            documents = np.sort(draw.choice(1000, size, replace=False)).astype(np.int32)
            adds = draw.integers(0, 50 if size > 300 else 2000, size)
            lists.append(search.Postings(documents, adds, int(adds.max())))
        sums = np.zeros(1000, np.int64)
        for p in lists:
            sums[p.documents] += p.adds
        best = search.Best(7, np.zeros(0, np.int64), [])
        search._walk([search.summed(lists[:2]), *lists[2:]], 1000, list(range(1000)), best)
        order = sorted(range(1000), key=lambda i: (-sums[i], i))[:7]
        assert best.ids == order and best.scores.tolist() == sums[order].tolist()


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    found = entry.queries()["op12_lexical_search"](spark, SF)
    expected, names = duck_rows(con, SQL["op12_lexical_search"])
    assert sorted(found.columns) == names and rows_of(found) == expected
