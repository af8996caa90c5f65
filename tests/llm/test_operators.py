"""Every operator against a brute-force version on a small table with the awkward cases, and on empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from seasonstats.llm import exact, hnsw, jaccard, langid, linededup, lm, mixing, packing, passages, tokenfile
from seasonstats.llm.queries import SQL, tokenizer_path
from seasonstats.llm.shipping import ship
from seasonstats.llm.text import subwords
from tests.conftest import SF, duck_rows, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KIND = "doc_id long, text string, lang string, source string, n_chars long, row long, bucket string, part string"


def _documents() -> list[tuple]:
    draw = random.Random(4)
    vocabulary = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    base, passage = prose(120).split(), prose(30)
    texts = [None, "", " \t\n", "1 2 3 !", "a", "A b", "It's <|endoftext|>x, don't... ÀÉ é́ 中文。", prose(9000)]
    texts += [prose(draw.randint(1, 80)) for _ in range(40)]
    texts += [" ".join(base)] * 6 + [" ".join(base).upper(), "\n".join(base)]
    for _ in range(25):
        near = list(base)
        for _ in range(draw.randint(1, 6)):
            near[draw.randrange(len(near))] = draw.choice(vocabulary)
        texts.append(" ".join(near))
    texts += [f"{prose(10)} {passage} {prose(5)}" for _ in range(10)]
    lines = [prose(4) for _ in range(12)]
    texts += ["\n".join(lines[i : i + draw.randint(1, 5)] + ["", prose(3)]) for i in range(10) for _ in range(2)]
    rows = [
        (i * 3, t, draw.choice(["en", "fr", None]), draw.choice(["s0", "s0", "s1", None]), 0, i, "x", "y")
        for i, t in enumerate(texts)
    ]
    draw.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame(_documents(), KIND).repartition(3).cache()


@pytest.fixture(scope="module")
def texts():
    return {r[0]: r[1] for r in _documents()}


@pytest.fixture(scope="module")
def none(spark):
    ship(spark)
    return spark.createDataFrame([], KIND)


def _low(word: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in word)


def _words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


@pytest.fixture(scope="module")
def token_ids(texts):
    tokenizer = subwords(tokenizer_path()).tokenizer
    return {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t in texts.items()}


def test_mixing_comes_near_the_targets(docs, texts, none):
    found = mixing.mix_sources(docs).collect()
    sources: dict = {}
    for r in found:
        assert r["size"] == len(_words(texts[r["doc_id"]])) and 0 <= r["taken"] <= 2 * r["size"]
        taken, size, target = sources.get(r["source"], (0, 0, 0))
        sources[r["source"]] = (taken + r["taken"], size + r["size"], r["target"])
    assert len(found) == len(texts)
    weights = dict(zip([s for s in sorted(filter(None, sources))] + [None], [3, 1, 2], strict=False))
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        total = sum(min(2 * size, level * weights[s]) for s, (_, size, _) in sources.items())
        low, high = (level, high) if total < 1.5 * sum(s[1] for s in sources.values()) else (low, level)
    for s, (taken, size, target) in sources.items():
        assert target == pytest.approx(min(2 * size, low * weights[s]), rel=1e-6)
        assert abs(taken - target) <= mixing.BLOCK * 2
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(docs.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in found}
    assert mixing.mix_sources(none).count() == 0


def test_exact_duplicates(docs, texts, none):
    bare = {d: re.sub(r"[\x20\x09-\x0D]+", "", t or "") for d, t in texts.items()}
    groups: dict = {}
    for d, t in bare.items():
        groups.setdefault(t, []).append(d)
    for r in exact.exact_duplicates(docs).collect():
        own = groups[bare[r["doc_id"]]]
        keep = min(own, key=lambda d: (-len(texts[d] or ""), d))
        digest = hashlib.sha256(bare[r["doc_id"]].encode()).hexdigest()
        assert tuple(r) == (r["doc_id"], keep, len(own), r["doc_id"] == keep, digest)
    twice = exact.exact_duplicates(docs.unionByName(docs)).groupBy("kept").count().collect()
    assert {r["kept"]: r["count"] for r in twice}[True] == len(groups)
    assert exact.exact_duplicates(none).count() == 0


def test_jaccard_classes(docs, texts, none):
    def grams(t):
        w = [_low(x) for x in _words(t)]
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])

    sets = {d: grams(t) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    found = jaccard.similarity_classes(docs).collect()
    assert {tuple(r) for r in found} == {(d, len(s), root(d)) for d, s in sets.items()} and len(found) == len(ids)
    assert max(Counter(root(d) for d in ids).values()) > 15
    assert jaccard.similarity_classes(none).count() == 0


def test_passages(docs, texts, none):
    first: dict = {}
    for d in sorted(texts):
        w = _words(texts[d])
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), d)
    total = 0
    for r in passages.remove_repeated_passages(docs).collect():
        w = _words(texts[r["doc_id"]])
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < r["doc_id"]:
                gone.update(range(i, i + 13))
        total += len(gone)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert (r["n_words"], r["n_removed"], r["kept_text"]) == (len(w), len(gone), kept)
    assert total > 500
    assert passages.remove_repeated_passages(none).count() == 0


def test_passage_automata_are_sharded(monkeypatch):
    monkeypatch.setattr(passages, "AUTOMATON_WORDS", 3)
    codes, offsets = np.array([1, 2, 3, 9, 1, 2, 3, 4, 5, 6]), np.array([0, 4, 10])
    runs = [(0, 3, 5), (7, 10, 99)]
    assert np.flatnonzero(passages.covered_words(codes, offsets, np.array([5, 8]), runs)).tolist() == [4, 5, 6]


def test_line_runs(docs, texts, none):
    seen, gone = set(), {}
    for d in sorted(texts):
        written = [i for i, x in enumerate((texts[d] or "").split("\n")) if WORD.search(x)]
        lines = (texts[d] or "").split("\n")
        for a, b in zip(written, written[1:], strict=False):
            if (lines[a], lines[b]) in seen:
                gone.setdefault(d, set()).update((a, b))
            seen.add((lines[a], lines[b]))
    found = linededup.drop_repeated_runs(docs).collect()
    for r in found:
        lines = None if texts[r["doc_id"]] is None else texts[r["doc_id"]].split("\n")
        lost = gone.get(r["doc_id"], set())
        assert r["n_removed"] == len(lost) and r["n_lines"] == len(lines or [])
        assert r["text"] == (None if lines is None else "\n".join(x for i, x in enumerate(lines) if i not in lost))
    assert gone and len(found) == len(texts)
    assert linededup.drop_repeated_runs(none).count() == 0


@pytest.mark.parametrize("run", [1, 3, 4])
def test_runs_of_any_length(spark, run):
    docs = spark.createDataFrame([(1, "a\nb\nc\nd\ne"), (2, "x\nb\nc\nd\ny\na\nb"), (None, "b\nc\nd\ne")], "doc_id long, text string")
    gone = {r["doc_id"]: r["text"] for r in linededup.drop_repeated_runs(docs, run).collect()}
    assert gone[1] == "a\nb\nc\nd\ne"
    assert gone[2] == {1: "x\ny", 3: "x\ny\na\nb", 4: "x\nb\nc\nd\ny\na\nb"}[run]
    assert gone[None] == ""
    short = linededup.drop_repeated_runs(docs, run, longest=run).collect()
    assert {r["doc_id"]: r["text"] for r in short} == gone


def test_language(spark, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = langid.identify_languages(docs).where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in held)
    odd = [(None, "12 !", "en"), (1, None, "en"), (2, "ç", None)]
    odd = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    found = langid.identify_languages(odd).where("doc_id IS NULL OR text IS NULL").collect()
    assert {(r["lang_pred"], r["score"]) for r in found} == {("und", 0.0)}
    assert langid.identify_languages(none).count() == 0


def test_subwords_are_the_library_s(texts, token_ids):
    ids, offsets = subwords(tokenizer_path()).encode(pa.array(list(texts.values()), pa.string()))
    for i, d in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == token_ids[d][:-1]


def test_elias_fano():
    draw = np.random.default_rng(2)
    for n, step in [(1, 5), (700, 1), (3000, 900), (600, 1 << 20)]:
        values = np.cumsum(draw.integers(0, step + 1, n))
        code = tokenfile.EliasFano.of(values)
        assert (code.values() == values).all() and [code.select(i) for i in range(n)] == values.tolist()


def test_token_file_round_trip(spark, docs, none, token_ids, tmp_path):
    tokenfile.write_token_file(docs, str(tmp_path / "ids"), tokenizer_path(), block_ids=500)
    found = {r["doc_id"]: r for r in tokenfile.read_token_file(spark, str(tmp_path / "ids")).collect()}
    start = 0
    for d in sorted(token_ids):
        ids = np.array(token_ids[d], "<u4")
        assert tuple(found[d]) == (d, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    tokenfile.write_token_file(none, str(tmp_path / "none"), tokenizer_path())
    assert tokenfile.read_token_file(spark, str(tmp_path / "none")).count() == 0


def test_closest_multiset():
    draw = random.Random(3)
    for _ in range(60):
        items = [draw.randint(1, 40) for _ in range(draw.randint(0, 9))]
        room = draw.randint(0, 90)
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums}
        chosen = packing.closest_multiset(dict(Counter(items)), room)
        assert sum(k * c for k, c in chosen.items()) == max(s for s in sums if s <= room)
        assert all(c <= items.count(k) for k, c in chosen.items())


@pytest.mark.parametrize("pool", [8192, 8])
def test_packing(docs, none, token_ids, pool):
    pieces, sequences = {}, {}
    for r in packing.pack_documents(docs, tokenizer_path(), pool=pool).collect():
        ids = np.array(token_ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert (r["ids_crc32"], r["doc_tokens"]) == (zlib.crc32(ids.tobytes()), len(token_ids[r["doc_id"]]))
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for kind, ends in ((pieces, {d: len(t) for d, t in token_ids.items()}), (sequences, None)):
        for name, parts in kind.items():
            at = 0
            for begin, length in sorted(parts):
                assert begin == at
                at += length
            assert at == ends[name] if ends else at <= 2048 and at & (at - 1) == 0
    assert set(pieces) == set(token_ids)
    assert packing.pack_documents(none, tokenizer_path()).count() == 0


def test_scores(docs, texts, none):
    tokens = {d: [_low(w) for w in _words(t)] + ["\0"] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in texts}
    counts = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for r in lm.score_documents(docs, tokenizer_path()).collect():
        own = tokens[r["doc_id"]]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held[r["doc_id"]], len(own), sum(counts[w] > 0 for w in own), n,
        )
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0
    assert lm.score_documents(none, tokenizer_path()).count() == 0


def test_attention_scores_are_probabilities_and_causal():
    model = lm.Attention(lm.Vocabulary(np.array([5.0, 3, 0, 8, 1]), 3))
    text = np.array([0, 1, 4])
    each = [model.score(np.array([*text[:2], last]), np.array([0, 3]))[0] for last in range(5)]
    shorter = model.score(text[:2], np.array([0, 2]))[0]
    assert sum(10.0**e for e in each) == pytest.approx(10.0**shorter, rel=1e-4)
    windows = np.tile(np.arange(lm.WINDOW + 1) % 5, (600, 1)).astype(np.int32)
    losses = model.fit(windows, epochs=20)
    assert losses[-1] < losses[0] / 2
    long = np.arange(200) % 5
    assert model.score(long, np.array([0, 200]))[0] == pytest.approx(sum(model.score(long, np.array([0, 200]))), rel=1e-9)


@pytest.mark.parametrize("pairs", [None, np.ones((4, 4))])
def test_gradients_are_the_same_in_parts_and_by_differences(monkeypatch, pairs):
    vocabulary = lm.Vocabulary(np.arange(20.0, 0, -1), 4)
    model = lm.Attention(vocabulary, width=6, own=7, pairs=pairs)
    ids = np.random.default_rng(4).integers(0, 20, (5, lm.WINDOW + 1))
    ids, target = ids[:, :-1], vocabulary.group[ids[:, 1:]]
    found = {}
    for windows in (1, 2, 100):
        monkeypatch.setattr(lm, "FITTED", windows)
        found[windows] = model.gradients(ids, target)
        assert found[windows][0] == pytest.approx(found[1][0], rel=1e-5)
    for name, whole in found[100][1].items():
        assert whole == pytest.approx(found[1][1][name], abs=1e-6) and whole == pytest.approx(found[2][1][name], abs=1e-6)
        m, at = model.w[name], np.unravel_index(np.abs(whole).argmax(), whole.shape)
        kept, sides = m[at], []
        for step in (0.02, -0.02):
            m[at] = kept + step
            sides.append(model.gradients(ids, target)[0])
        m[at] = kept
        assert whole[at] == pytest.approx((sides[0] - sides[1]) / 0.04, rel=0.05)


def test_nearest_vectors(spark):
    ship(spark)
    draw = np.random.default_rng(8)
    vectors = draw.standard_normal((700, 16)).astype(np.float32).tolist()
    vectors += [vectors[3]] * 20 + [[0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, None, [None] * 16, [1.0, 2.0], [2.0, 1.0]]
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(None, vectors[5], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    found: dict = {}
    for r in hnsw.nearest_vectors(table, shard_points=300).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    good = [i for i in range(720)]
    m = np.array([vectors[i] for i in good], np.float64)
    unit = m / np.linalg.norm(m, axis=1)[:, None]
    hits = 0
    for q in range(0, 720, 50):
        near = np.round(unit @ unit[q], 12)
        near[q] = -2
        best = np.lexsort((good, -near))[:5]
        assert [found[q][k][1] for k in sorted(found[q])] == sorted((s for _, s in found[q].values()), reverse=True)
        hits += len({v for v, _ in found[q].values()} & set(best.tolist()))
    assert sorted(found) == list(range(0, 720, 50)) and hits >= 0.95 * 75
    assert hnsw.nearest_vectors(table.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = entry.queries()[name](spark, SF)
    expected, names = duck_rows(con, SQL[name])
    assert sorted(df.columns) == names and rows_of(df) == expected and expected


def test_one_query_for_each_operator():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names


def test_pipeline_stages(spark, docs, none):
    """Each stage's decisions are those of its operator, and columns stay until the last stage."""
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns and 0 < kept.count() <= 2 * before.count()
        if stage is corpus_pipeline.near_duplicates:
            sizes = jaccard.similarity_classes(kept).where("n_shingles > 0").groupBy("component_id").count()
            assert sizes.where("`count` > 1").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    sizes = kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    whole = pieces.groupBy("doc_id", "part").agg(F.sum("length").alias("s"), F.max("doc_tokens").alias("t"))
    assert whole.where("s <> t").count() == 0 and whole.groupBy("doc_id").count().count() == sizes.count()
    empty = none
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0


def test_pipeline_drops_single_repeated_lines(spark, docs):
    rows = [(1, "a\nlicense\nb"), (2, "c\nlicense\nd"), (3, "license"), (4, "e\n\nlicense\n a"), (5, None)]
    table = spark.createDataFrame([(i, t, "en", "s", 0, 0, "x", "y") for i, t in rows], KIND)
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.lines(spark, table, SF).collect()}
    assert found == {1: ("a\nlicense\nb", 11), 2: ("c\nd", 3), 4: ("e\n\n a", 5), 5: (None, None)}
    left = [x for r in corpus_pipeline.lines(spark, docs, SF).collect() for x in (r["text"] or "").split("\n") if WORD.search(x)]
    assert len(left) == len(set(left))


def test_windows_have_every_subword_as_a_target():
    for n in (0, 1, lm.WINDOW, lm.WINDOW + 1, 3 * lm.WINDOW, 100):
        windows = lm._windows(np.arange(n), 999)
        assert windows.shape[1] == lm.WINDOW + 1 and set(range(n)) <= set(windows[:, 1:].ravel().tolist())
        assert len(windows) == -(-n // lm.WINDOW)


def test_context_is_counted_and_fitted_over_all_training_documents(spark, monkeypatch):
    """With next to nothing in the sample, scores still know which word follows which, and every bucket moves the weights."""
    ship(spark)
    draw = random.Random(9)
    words = [c * 2 for c in "abcdefghijklmnopqrst"]
    rows = []
    for i in range(300):
        at = draw.randrange(20)
        rows.append((i, " ".join(words[(at + k) % 20] for k in range(draw.randint(1, 60)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path, end = tokenizer_path(), subwords(tokenizer_path()).tokenizer.get_vocab_size()
    ids = {i: [*subwords(path).tokenizer.encode(t, add_special_tokens=False).ids, end] for i, t in rows}
    counts = np.bincount(np.concatenate(list(ids.values())), minlength=end + 1).astype(float)
    vocabulary, learnt = lm.Vocabulary(counts), docs.withColumn("learn", F.col("doc_id") % 2 == 0)
    expected = np.zeros((vocabulary.size, vocabulary.size), np.int64)
    for i, own in ids.items():
        for a, b in zip([end, *own], own, strict=False):
            expected[vocabulary.group[a], vocabulary.group[b]] += i % 2 == 0
    pairs = lm._pair_counts(learnt, path, vocabulary, end)
    assert (pairs == expected).all()
    start = lm.Attention(vocabulary, pairs=pairs)
    buckets = learnt.withColumn("bucket", (F.col("doc_id") % 3).cast("int")).repartition(3, "bucket")
    changes, windows = 0, 0
    for bucket in range(3):
        own = start.moved(np.zeros(len(start.flat())))
        found = lm._windows(np.concatenate([ids[i] for i in ids if i % 2 == 0 and i % 3 == bucket]), end)
        own.fit(found, epochs=1, rate=lm.ON_RATE)
        changes, windows = changes + (own.flat() - start.flat()) * len(found), windows + len(found)
    fitted = lm._fitted_on(buckets, path, start, end).flat()
    assert fitted == pytest.approx(start.flat() + changes / windows, abs=1e-5) and not np.allclose(fitted, start.flat())
    monkeypatch.setattr(lm, "TRAINING_WINDOWS", 0)
    held = lm.score_documents(docs, path).where("held_out").collect()
    unigram = np.log10((counts + 0.1) / (counts + 0.1).sum())
    assert sum(r["score"] for r in held) > 0.5 * sum(unigram[ids[r["doc_id"]]].sum() for r in held)


def test_held_out_scores_use_their_context(spark):
    """Held out, scores are far above subword unigrams; base_score, of smoothed whole words, is the other mark."""
    ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    path, end = tokenizer_path(), subwords(tokenizer_path()).tokenizer.get_vocab_size()
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    held = [d for d in texts if zlib.crc32(str(d).encode()) % 10 == 0]
    encoded = lambda ds: tokenfile.with_ends(*subwords(path).encode(pa.array([texts[d] for d in ds], pa.string())), end)
    counts = np.bincount(encoded([d for d in texts if d not in set(held)])[0], minlength=end + 1) + 0.1
    ids, _ = encoded(held)
    unigram = np.log10(counts / counts.sum())[ids].sum()
    found = lm.score_documents(docs, path).where("held_out").collect()
    score, base = sum(r["score"] for r in found), sum(r["base_score"] for r in found)
    # Log10 a subword: unigrams -2.50, base_score -1.80; the scores have -1.99, and -2.10 with 96 classes and a stride of 28.
    assert score > 0.82 * unigram and score > 1.12 * base


@pytest.mark.parametrize("stage", [corpus_pipeline.near_duplicates, corpus_pipeline.mixture])
def test_row_numbers_outlast_another_cut_of_the_input(spark, stage, tmp_path, monkeypatch):
    """A job that cuts the input otherwise than the job before, as after a lost executor, still finds the same rows."""
    ship(spark)
    rows = [(i, f"text {i} of its own " + " ".join(f"w{i}x{k}" for k in range(i % 9 + 5)), "en", f"s{i % 3}", 0, i, "x", "y")
            for i in range(120)]
    spark.createDataFrame(rows, KIND).repartition(12).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    size = "spark.sql.files.maxPartitionBytes"
    before, keep = spark.conf.get(size), corpus_pipeline.materialize

    def kept(df, name):
        # From the stage's last stored table on, each file is a task of its own; before, several were in one.
        found = keep(df, name)
        if name in ("kept", "copies"):
            spark.conf.set(size, "1m")
        return found

    monkeypatch.setattr(corpus_pipeline, "materialize", kept)
    try:
        found = sorted(r["doc_id"] for r in stage(spark, docs, SF).collect())
    finally:
        spark.conf.set(size, before)
    monkeypatch.undo()
    if stage is corpus_pipeline.mixture:
        assert found == sorted(r["doc_id"] for r in stage(spark, docs, SF).collect())
    else:
        assert found == list(range(120))
