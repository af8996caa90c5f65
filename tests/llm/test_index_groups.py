"""The stored index is read a few megabytes at a time, however many shards one task wrote."""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow.parquet as pq

from seasonstats.llm import search


def test_shards_of_one_task_do_not_share_a_group_of_rows(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(i, " ".join(f"{rnd.getrandbits(48):x}" for _ in range(30_000))) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    search.build_index(docs, f"file://{tmp_path}/index", shard_bytes=1 << 16)
    (file,) = Path(tmp_path).rglob("*.parquet")
    stored = pq.ParquetFile(file).metadata
    groups = [stored.row_group(i) for i in range(stored.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 24
    assert len(groups) >= 4 and max(g.total_byte_size for g in groups) < 8 << 20
    items = spark.createDataFrame([(1, rows[7][1][:200]), (2, rows[20][1][-200:])], "item_id long, text string")
    found = search.search(spark, f"file://{tmp_path}/index", items).where("rank = 1").collect()
    assert {r["item_id"]: r["doc_id"] for r in found} == {1: 7, 2: 20}
