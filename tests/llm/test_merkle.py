"""Merkle manifest: every tree, proof and verdict against a plain level-by-level version."""

from __future__ import annotations

import zlib
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from seasonstats.llm import merkle
from seasonstats.llm.queries import SQL
from seasonstats.llm.shipping import ship
from seasonstats.sources.shared import new_folder
from tests.conftest import SF, duck_rows, rows_of

KIND = "doc_id long, text string, lang string, source string, n_chars long, tree string, segment int, place string, node string"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def record(row, extra=0):
    doc_id, text, lang, source, n_chars = row[:5]
    values = [doc_id, source, lang, None if n_chars is None else n_chars + extra, text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def plain(rows):
    if not rows:
        return []
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, record(r)))
    trees = {name: levels_of([record(r) for r in groups[name]]) for name in names}
    top = levels_of([trees[name][-1][0] for name in names])
    root, out = top[-1][0], []
    for g, name in enumerate(names):
        for i, row in enumerate(groups[name]):
            shown = record(row)
            node = record(row, 1) if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 else shown
            siblings = []
            for levels, place in ((trees[name], i), (top, g)):
                for level in levels[:-1]:
                    beside = level[place ^ 1] if place ^ 1 < len(level) else ""
                    siblings.append(beside)
                    node = H(beside, node) if place % 2 else H(node, beside)
                    place //= 2
            out.append((row[0], node, shown, H(*siblings), root, trees[name][-1][0], node == root))
    return sorted(out, key=repr)


def table(n):
    rows = [(i * 5 % 1009, f"text {i} é\n", ["en", "en", "fr", None, "日本"][i % 5], None if i % 11 == 0 else f"s{i % 3}",
             None if i % 13 == 0 else i, "t", 1, "p", "n") for i in range(n)]
    return rows + [(None, None, None, None, None, "t", 1, "p", "n"), (None, "", "en", "", 0, None, 2, "p", None)] * 2 + rows[:3]


@pytest.mark.parametrize("leaves", [*range(1, 35), 63, 64, 65, 100])
def test_positions_address_the_log(leaves):
    levels = levels_of([sha256(str(i).encode()).hexdigest() for i in range(leaves)])
    log = [d.hex() for d in merkle.append_log([bytes.fromhex(d) for d in levels[0]], merkle.height(leaves))]
    assert len(log) == sum(map(len, levels)) and log[-1] == levels[-1][0]
    for level, nodes in enumerate(levels):
        at = merkle.position(level, np.arange(len(nodes)), leaves)
        assert [log[p] for p in at] == nodes


@pytest.mark.parametrize("levels", [1, 2, 3, 10])
def test_proofs_equal_the_plain_form(spark, levels):
    ship(spark)
    rows = table(77)
    docs = spark.createDataFrame(rows, KIND).repartition(5)
    longer = [F.col(f) + 1 if f == "n_chars" else F.col(f) for f in merkle.FIELDS]
    claim = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.record_digest(longer))
    folder = new_folder(spark, "manifest")
    merkle.write_manifest(docs, folder, claim, levels=levels)
    found = merkle.verified(merkle.inclusion_proofs(spark, folder, levels))
    assert rows_of(found) == plain([r[:5] for r in rows])


def test_small_and_empty_tables(spark):
    ship(spark)
    for rows in ([], table(1)[:1], table(2)[:2]):
        folder = new_folder(spark, "manifest")
        merkle.write_manifest(spark.createDataFrame(rows, KIND), folder)
        found = merkle.inclusion_proofs(spark, folder)
        expected = plain([r[:5] for r in rows])
        assert sorted((r["doc_id"], r["leaf"].hex(), r["root"].hex()) for r in found.collect()) == sorted((r[0], r[2], r[4]) for r in expected)
        assert all(r["verified"] for r in merkle.verified(found).collect())


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = entry.queries()["op11_merkle_manifest"](spark, SF)
    expected, names = duck_rows(con, SQL["op11_merkle_manifest"])
    assert sorted(found.columns) == names and rows_of(found) == expected
