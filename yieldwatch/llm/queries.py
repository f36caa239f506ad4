"""The queries over these operators, each on whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(n: int):
    """crc32 of the doc_id as text, modulo n; -1 for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n, F.lit(-1))


# 6 ------------------------------------------------------------------------------------


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from yieldwatch.llm import bpe

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(documents, vocabulary_path(), decoded="decoded")
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# 7 ------------------------------------------------------------------------------------

# The rules of the query, (verdict, host, path prefix).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

URL_SQL = r"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
rules(verdict, rule_host, prefix) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT s.*, r.rule_host || r.prefix AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id, s.host, s.path ORDER BY length(r.rule_host || r.prefix) DESC) AS nr
  FROM split s LEFT JOIN rules r
    ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.prefix))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE nr = 1
"""


# The pages have no canonical links or redirects, so that aliases change no verdict in this SQL;
# tests with links compare against a plain search.
@query("op7_redirect_equivalence", URL_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from yieldwatch.llm import urls

    pages = table(spark, sf_dir, "pages")
    links = urls.page_links(pages)
    judged = urls.judge_urls(pages.select("page_id", "url"), urls.rules_frame(spark, URL_RULES), links)
    return judged.select("page_id", "host", "path", "rule", "verdict")


# 9 ------------------------------------------------------------------------------------


@query("op9_feistel_shards")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from yieldwatch.llm import shards

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = shards.assign_shards(documents, ["doc_id", "size", "text_crc32"], 8, seed=9)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


# 10 -----------------------------------------------------------------------------------


@query("op10_pii_spans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from yieldwatch.llm import pii

    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(pii.BASE_KINDS))

    def count(kind: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.BASE_KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.span_list(base).cast("binary"), 256).alias("base_sha256"),
        pii.span_list(F.col("pii")).alias("spans"),
    )


# 2 ------------------------------------------------------------------------------------


@query("op2_centroid_language")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from yieldwatch.llm import language

    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    documents = documents.withColumn("held_out", crc_mod(3) == 1)
    model = language.fit(documents.filter(~F.col("held_out")))
    found = language.predict(documents.select("doc_id", "text", "held_out"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


# 4 ------------------------------------------------------------------------------------


@query("op4_quadratic_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from yieldwatch.llm import quality
    from yieldwatch.sources.scratch import settle

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = settle(documents.select("doc_id", crc_mod(3).alias("part"), quality.text_statistics("text").alias("statistics")))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(rows.filter("part <> 1").join(labels, "doc_id"))
    score = model.score_statistics("statistics")
    scored = rows.select("doc_id", (F.col("part") == 1).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


# 5 ------------------------------------------------------------------------------------


JACCARD_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM split),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS s FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT a AS doc_id, any_value(n) AS n_shingles, min(b) AS component_id FROM reach JOIN sizes ON doc_id = a GROUP BY a
"""


@query("op5_adaptive_prefix_join", JACCARD_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from yieldwatch.llm import jaccard

    return jaccard.similarity_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


# 3 ------------------------------------------------------------------------------------


@query("op3_spaced_seeds")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from yieldwatch.llm import decontaminate

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_overlaps(documents, table(spark, sf_dir, "benchmark"))


# 8 ------------------------------------------------------------------------------------


@query("op8_multi_index_hashing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from yieldwatch.llm import hamming

    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hamming.nearest_neighbours(embeddings, F.col("vec_id") % 20 == 0, k=20)


# 1 ------------------------------------------------------------------------------------


@query("op1_backoff_automaton")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from yieldwatch.llm import scoring

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    documents = documents.withColumn("held_out", crc_mod(5) == 1)
    scored = scoring.score_texts(documents, ~F.col("held_out"), keys=("doc_id", "held_out"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


# 13 -----------------------------------------------------------------------------------


# The recursion over levels, pairs (proofs) and steps (folding); crc32 bit by bit.
MERKLE_SQL = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, n_chars,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS kept,
         coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS changed,
         coalesce(strlen(text) || ':' || text, '-') AS tail,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
             lambda a, c: list_reduce(list_prepend(xor(a, c), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
               lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::UBIGINT) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(head || kept || tail) AS leaf,
         sha256(head || CASE WHEN crc % 7 = 0 THEN changed ELSE kept END || tail) AS shown,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i,
         count(*) OVER (PARTITION BY lang) AS size
  FROM fields),
nodes(lang, level, i, digest, size) AS (
  SELECT lang, 0, i, leaf, size FROM leaves
  UNION ALL
  SELECT lang, max(level) + 1, i // 2, sha256(string_agg(digest, '' ORDER BY i)), (max(size) + 1) // 2
  FROM nodes WHERE size > 1 GROUP BY lang, i // 2),
trees AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i, count(*) OVER () AS size
  FROM nodes WHERE size = 1),
tops(level, i, digest, size) AS (
  SELECT 0, i, subroot, size FROM trees
  UNION ALL
  SELECT max(level) + 1, i // 2, sha256(string_agg(digest, '' ORDER BY i)), (max(size) + 1) // 2
  FROM tops WHERE size > 1 GROUP BY i // 2),
walk(doc_id, shown, leaf, lang, level, i, place, size, folded, siblings) AS (
  SELECT doc_id, shown, leaf, lang, 0, i, 0, size, shown, '' FROM leaves
  UNION ALL
  SELECT w.doc_id, w.shown, w.leaf, w.lang,
         CASE WHEN w.size > 1 THEN w.level + 1 ELSE 0 END,
         CASE WHEN w.size > 1 THEN w.i // 2 ELSE t.i END,
         CASE WHEN w.size > 1 THEN w.place ELSE 1 END,
         CASE WHEN w.size > 1 THEN (w.size + 1) // 2 ELSE t.size END,
         CASE WHEN w.size = 1 THEN w.folded WHEN w.i % 2 = 0 THEN sha256(w.folded || coalesce(s.digest, p.digest, ''))
              ELSE sha256(coalesce(s.digest, p.digest, '') || w.folded) END,
         w.siblings || CASE WHEN w.size = 1 THEN '' ELSE coalesce(s.digest, p.digest, '') END
  FROM walk w
  LEFT JOIN nodes s ON w.place = 0 AND w.size > 1 AND s.lang IS NOT DISTINCT FROM w.lang AND s.level = w.level AND s.i = xor(w.i, 1)
  LEFT JOIN tops p ON w.place = 1 AND w.size > 1 AND p.level = w.level AND p.i = xor(w.i, 1)
  LEFT JOIN trees t ON w.place = 0 AND w.size = 1 AND t.lang IS NOT DISTINCT FROM w.lang
  WHERE w.size > 1 OR w.place = 0)
SELECT w.doc_id, w.leaf, t.subroot, r.digest AS root, sha256(w.siblings) AS proof_sha256, w.folded AS folded_root, w.folded = r.digest AS verified
FROM walk w JOIN trees t ON t.lang IS NOT DISTINCT FROM w.lang, (SELECT digest FROM tops WHERE size = 1) r
WHERE w.place = 1 AND w.size = 1
"""


@query("op13_merkle_intervals", MERKLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from yieldwatch.llm import merkle

    changed = (crc_mod(7) == 0) & F.col("n_chars").isNotNull()
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [(F.col("n_chars") + 1) if f == "n_chars" else f for f in fields]
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        merkle.leaf_digest(fields).alias("leaf"),
        F.when(changed, merkle.leaf_digest(tampered)).alias("tampered"),
    )
    proved = merkle.build(documents, "lang", ["doc_id"], "leaf").leaves
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    proved = proved.withColumn("folded_root", folded)
    return proved.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


# 11 -----------------------------------------------------------------------------------


@query("op11_polarisation_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from yieldwatch.llm import whitening

    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    models = whitening.fit(embeddings)
    errors = [whitening.identity_error(embeddings, "embedding", width, model) for width, model in models.items()]
    rows = whitening.transform(embeddings, models).drop("embedding")
    cells = rows.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "cell"))
    return cells.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        "n",
        F.col("deviation").cast("bigint").alias("deviation"),
        F.col("cell.whitened").alias("whitened"),
        F.col("cell.explained").alias("explained"),
        F.lit(max(errors, default=0.0)).alias("identity_error"),
    )


# 12 -----------------------------------------------------------------------------------


# The pages of the tables hold one article each, of headings and paragraphs, and few character
# references, so patterns can cut them out; other layouts are tested on small tables.
ARTICLE_SQL = r"""
WITH articles AS (
  SELECT page_id, url, regexp_split_to_array(coalesce(regexp_extract(html, '(?s)<article>(.*)</article>', 1), ''), '</?(?:p|h1)>') AS parts
  FROM pages),
blocks AS (
  SELECT page_id, url, list_filter(list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(replace(
    regexp_replace(x, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') AS parts
  FROM articles)
SELECT page_id, url, array_to_string(parts, chr(10) || chr(10)) AS text,
       CAST(length(array_to_string(parts, chr(10) || chr(10))) AS BIGINT) AS n_chars FROM blocks
"""


@query("op12_consensus_paths", ARTICLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from yieldwatch.llm import html

    pages = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
