"""The registered queries of this subpackage, and their SQL for DuckDB where SQL can say them over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonstats.llm import exact, hnsw, jaccard, langid, linededup, lm, merkle, mixing, packing, passages, quality, search, tokenfile
from seasonstats.llm.shipping import ship
from seasonstats.sources.shared import new_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query()
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_read(spark, sf_dir, "documents"))


@query(r"""
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size,
       row_number() OVER best = 1 AS kept, sha AS text_sha256
FROM (SELECT doc_id, coalesce(length(text), 0) AS points,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS sha FROM documents)
WINDOW best AS (PARTITION BY sha ORDER BY points DESC, doc_id NULLS LAST)""")
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_read(spark, sf_dir, "documents"))


@query()
def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = passages.remove_repeated_passages(_read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_classes(_read(spark, sf_dir, "documents"))


@query()
def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_folder(spark, "token_file")
    tokenfile.write_token_file(_read(spark, sf_dir, "documents"), target, tokenizer_path())
    return tokenfile.read_token_file(spark, target)


@query()
def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), tokenizer_path())


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify_languages(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query()
def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest_vectors(_read(spark, sf_dir, "embeddings"))


@query()
def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_read(spark, sf_dir, "documents"), tokenizer_path())


@query(r"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                      generate_subscripts(string_split(text, chr(10)), 1) AS no
               FROM documents WHERE text IS NOT NULL),
  written AS (SELECT *, lead(line) OVER along AS next, row_number() OVER along AS place
              FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') WINDOW along AS (PARTITION BY doc_id ORDER BY no)),
  later AS (SELECT doc_id, place FROM written WHERE next IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY line, next ORDER BY doc_id, place) > 1),
  gone AS (SELECT doc_id, place FROM later UNION SELECT doc_id, place + 1 FROM later),
  marked AS (SELECT l.doc_id, l.no, l.line, g.doc_id IS NOT NULL AS removed
             FROM lines l LEFT JOIN written w ON w.doc_id = l.doc_id AND w.no = l.no
             LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.place = w.place),
  kept AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed,
                  sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT removed), '')) AS kept_sha256
           FROM marked GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)""")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_repeated_runs(_read(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "n_lines", "n_removed", digest.alias("kept_sha256"))


_CRC = """list_reduce(flatten([[4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [256 + ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))]),
    lambda crc, x: CASE WHEN x > 0 THEN xor(crc, x - 256) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END)"""


def _record(n_chars: str) -> str:
    columns = ["doc_id", "source", "lang", n_chars, "text"]
    values = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns]
    return f"sha256({' || '.join(values)})"


# A level is a list of a tree's nodes; every node keeps the list of its siblings' digests from the level below.
_TREE = """{0} AS (
  SELECT tree, 0 AS level, nodes FROM {1}
  UNION ALL
  SELECT tree, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM {0} WHERE len(nodes) > 1)"""
# A leaf's node at each level is known by its place, the sibling is the other one of its pair.
_PATH = """{0} AS (
  SELECT l.tree, l.place, string_agg(nodes[xor(l.place >> level, 1) + 1], '' ORDER BY level) AS siblings,
         list([xor(l.place >> level, 1) < len(nodes), (l.place >> level) % 2 = 1] ORDER BY level) AS sides,
         list(coalesce(nodes[xor(l.place >> level, 1) + 1], '') ORDER BY level) AS path
  FROM {1} l JOIN {2} t ON t.tree IS NOT DISTINCT FROM l.tree AND len(nodes) > 1 GROUP BY l.tree, l.place)"""
_FOLD = """list_reduce(list_concat([{0}], list_transform(range(1, len(path) + 1), lambda i:
    CASE WHEN NOT sides[i][1] THEN '0' WHEN sides[i][2] THEN '1' || path[i] ELSE '2' || path[i] END)), lambda node, step:
    sha256(CASE step[1] WHEN '0' THEN node WHEN '1' THEN step[2:] || node ELSE node || step[2:] END))"""


@query(f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT doc_id, lang AS tree, {_record("n_chars")} AS leaf,
           CASE WHEN xor({_CRC}, 4294967295) % 7 = 0 THEN {_record("(n_chars + 1)")} END AS claim FROM documents),
  placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
  lists AS (SELECT tree, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY tree),
  {_TREE.format("trees", "lists")},
  subroots AS MATERIALIZED (
    SELECT tree AS lang, nodes[1] AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place, NULL AS tree
    FROM trees WHERE len(nodes) = 1),
  tops AS (SELECT NULL AS tree, list(subroot ORDER BY place) AS nodes FROM subroots),
  {_TREE.format("top", "tops")},
  {_PATH.format("below", "placed", "trees")}, {_PATH.format("above", "subroots", "top")},
  proofs AS (
    SELECT p.doc_id, p.leaf, p.claim, s.subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root,
           coalesce(b.siblings, '') || coalesce(a.siblings, '') AS siblings,
           list_concat(coalesce(b.path, []), coalesce(a.path, [])) AS path,
           list_concat(coalesce(b.sides, []), coalesce(a.sides, [])) AS sides
    FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.tree
    LEFT JOIN below b ON b.tree IS NOT DISTINCT FROM p.tree AND b.place = p.place
    LEFT JOIN above a ON a.place = s.place),
  folded AS (SELECT *, {_FOLD.format("coalesce(claim, leaf)")} AS folded_root FROM proofs)
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded""")
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    longer = F.try_add(F.col("n_chars"), F.lit(1))
    fields = [longer if f == "n_chars" else F.col(f) for f in merkle.FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    folder = new_folder(spark, "manifest")
    merkle.write_manifest(docs, folder, F.when(tampered, merkle.record_digest(fields)))
    return merkle.verified(merkle.inclusion_proofs(spark, folder))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@query(f"""
WITH held AS MATERIALIZED (
    SELECT row, doc_id, term, count(*) AS tf FROM (
      SELECT row, doc_id, unnest({_TERMS}) AS term FROM (SELECT *, row_number() OVER () AS row FROM documents))
    GROUP BY ALL),
  sizes AS MATERIALIZED (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY row),
  whole AS MATERIALIZED (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
  weights AS MATERIALIZED (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, whole GROUP BY term),
  asked AS MATERIALIZED (
    SELECT item, item_id, term, count(*) AS times FROM (
      SELECT item, item_id, unnest({_TERMS}) AS term FROM (SELECT *, row_number() OVER () AS item FROM benchmark))
    GROUP BY ALL),
  scores AS (
    SELECT item, item_id, row, doc_id,
           CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (row), whole GROUP BY item, item_id, row, doc_id)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) QUALIFY row_number() OVER best <= 20""")
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "lexical_index")
    search.build_index(_read(spark, sf_dir, "documents"), folder)
    return search.search(spark, folder, _read(spark, sf_dir, "benchmark"))


@query()
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    asked = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *asked, "base_failed", "kept")
