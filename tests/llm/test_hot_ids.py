"""Ids that a third of all rows have, or none, and links that meet in one node."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from seasonstats.llm import exchange, jaccard, passages
from seasonstats.llm.components import components
from seasonstats.llm.shipping import ship

KIND = "doc_id long, text string"


def _rows() -> list[tuple]:
    """A third without an id, a third with id 7, the rest with ids of their own; groups of near copies run across them."""
    draw = random.Random(9)
    vocabulary = ["".join(draw.choice("abcdef") for _ in range(draw.randint(2, 7))) for _ in range(500)]
    prose = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    bases, passage, texts = [prose(60) for _ in range(9)], prose(20), [None, "", " \n", "a b"]
    while len(texts) < 180:
        text = list(draw.choice(bases)) if draw.random() < 0.5 else prose(draw.randint(1, 60))
        text[draw.randrange(len(text))] = draw.choice(vocabulary)
        texts.append(" ".join(text + (passage if draw.random() < 0.1 else [])))
    rows = [((None, 7, 100 + i)[i % 3], t) for i, t in enumerate(texts)]
    return rows + [(None, texts[20]), (7, texts[20]), (7, texts[20])]


@pytest.fixture
def hot(spark, monkeypatch):
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 4096)
    ship(spark)
    return _rows(), spark.createDataFrame(_rows(), KIND).repartition(3)


def test_rows_of_one_id_spread_over_the_buckets(hot):
    rows, df = hot
    buckets = exchange.bucket_count(df)
    held = [r["count"] for r in exchange.deal(df, buckets).groupBy("bucket").count().collect()]
    assert buckets > 8 and len(held) == buckets and max(held) < 4 * len(rows) / buckets


def _parts(nodes: int, links: list[tuple[int, int]]) -> list[int]:
    """Of each node the least one it reaches."""
    least = list(range(nodes))
    while True:
        before = list(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            return least


def test_jaccard_classes_of_rows_that_share_ids(hot):
    rows, df = hot
    sets = []
    for _, text in rows:
        w = (text or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    links = [
        (i, j) for i, s in enumerate(sets) for j in range(i)
        if s & sets[j] and 100 * len(s & sets[j]) >= 75 * len(s | sets[j])
    ]
    part = _parts(len(rows), links)
    names: dict = {}
    for (own, _), p in zip(rows, part, strict=True):
        if own is not None:
            names[p] = min(names.get(p, own), own)
    expected = Counter((own, len(s), names.get(p)) if s else (own, 0, own) for (own, _), s, p in zip(rows, sets, part, strict=True))
    found = Counter(tuple(r) for r in jaccard.similarity_classes(df).collect())
    assert found == expected
    assert len(set(part)) < len(rows) - 40


def test_passages_of_rows_that_share_ids(hot):
    rows, df = hot
    key = lambda own: float("inf") if own is None else own
    first: dict = {}
    for own, text in rows:
        w = (text or "").split()
        for i in range(len(w) - 12):
            at = tuple(w[i : i + 13])
            first[at] = min(first.get(at, float("inf")), key(own))
    expected = Counter()
    for own, text in rows:
        w = (text or "").split()
        gone = {k for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < key(own) for k in range(i, i + 13)}
        expected[own, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    assert Counter(tuple(r) for r in passages.remove_repeated_passages(df).collect()) == expected
    assert sum(n[2] for n in expected) > 500


def test_components_with_a_hub(spark):
    draw = random.Random(5)
    links = [(500, i) for i in range(0, 900, 3)] + [(i, i + 1) for i in range(901, 960)]
    links += [(draw.randrange(1000, 1300), draw.randrange(1000, 1300)) for _ in range(120)] + [(3, 3)]
    draw.shuffle(links)
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    least = _parts(1300, links)
    assert found == {n: least[n] for link in links if link[0] != link[1] for n in link}
