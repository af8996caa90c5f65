"""op8: texts are split into words and subwords once, and a class is predicted in two short steps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seasonstats.llm import lm
from seasonstats.llm.queries import tokenizer_path
from seasonstats.llm.shipping import ship
from seasonstats.llm.text import subwords
from seasonstats.llm.tokenfile import with_ends


def test_scores_read_stored_subwords_not_texts(spark):
    ship(spark)
    source = "/root/testdata/sf0.001/documents.parquet"
    files = lm.score_documents(spark.read.parquet(source), tokenizer_path()).inputFiles()
    assert files and not [f for f in files if f.endswith("documents.parquet")]


def test_stored_rows_give_the_subwords_of_every_training_text(spark):
    ship(spark)
    path, end = tokenizer_path(), subwords(tokenizer_path()).tokenizer.get_vocab_size()
    rows = [(1, "Some words, some WORDS."), (2, None), (3, " "), (4, "held out"), (None, "no id"), (5, "É ß don't x\x00y"), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("learn", F.coalesce(F.col("doc_id") != 4, F.lit(True)))
    found = list(lm._rows(lm._coded(docs, path).toArrow().to_batches()))
    learnt = sorted(t or "" for i, t in rows if i != 4)
    assert sum(len(r["starts"]) - 1 for r in found) == len(rows)
    ids = np.concatenate([lm._learnt_ids(r, end) for r in found])
    expected = with_ends(*subwords(path).encode(pa.array(learnt)), end)[0]
    assert sorted(ids.tolist()) == sorted(expected.tolist())
    scored = {(r["doc_id"], r["n_tokens"]) for r in lm.score_documents(docs.select("doc_id", "text"), path).collect()}
    assert scored == {(1, 5), (2, 1), (3, 1), (4, 3), (None, 3), (5, 5), (5, 1)}


@pytest.mark.parametrize("classes", [1, 2, 5, 150])
def test_two_steps_give_the_shares_of_the_pairs(classes):
    vocabulary = lm.Vocabulary(np.ones(classes), classes)
    c = vocabulary.size
    pairs = np.random.default_rng(1).integers(0, 50, (c, c))
    model = lm.Attention(vocabulary, pairs=pairs)
    model.w["out"][:], model.w["top"][:] = 0, 0
    share = (pairs.sum(axis=0) + 0.1) / (pairs.sum() + 0.1 * c)
    chance = (pairs + c * share) / (pairs.sum(axis=1, keepdims=True) + c)
    ids = np.random.default_rng(2).integers(0, len(vocabulary.group), 70)
    of = vocabulary.group[np.concatenate([[len(vocabulary.group) - 1], ids])]
    expected = np.log10(chance[of[:-1], of[1:]]).sum() + vocabulary.share[ids].sum() / np.log(10)
    assert model.score(ids, np.array([0, 70]))[0] == pytest.approx(expected, rel=1e-4)
    # A place costs two rows of about the root of the classes, not one of all.
    order, block, at = model._by_block(of[1:])
    top, inside = model._logits(np.zeros((70, lm.WIDTH), np.float32), of[:-1][order], block, at)
    assert top.shape[1] + inside.shape[1] <= 2 * np.ceil(np.sqrt(c))
