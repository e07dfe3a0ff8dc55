"""Registered queries of the operators, each over the whole of its tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlane.llm import align, decontaminate, dialogue, labelled, language_model, line_dedup, main_text, near_dups, nearest, personal, pieces, quality, toxicity, url_rules

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


URL_RULES = url_rules.listed(
    allow=("org/", "com/fr/"), block=("example.org/es/", "example.org/en/1", "com/de/")
) + [url_rules.Rule(t) for t in url_rules.PATTERNS]

_UPPER, _LOWER = url_rules.UPPER, url_rules.LOWER
_PATTERNS_SQL = " OR ".join(f"regexp_matches(subject, '{url_rules.Rule(t).pattern}')" for t in url_rules.PATTERNS)
URL_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '(?s)^[^?#]*(.*)', 1) AS tail FROM cut),
rules(rule, verdict) AS (
  VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'),
         ('com/fr/', 'allow'), ('com/de/', 'block')),
fits AS (
  SELECT u.host, u.path, max_by(r.rule, length(r.rule)) AS rule, max_by(r.verdict, length(r.rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM split) u, rules r
  WHERE (u.host = split_part(r.rule, '/', 1) OR ends_with(u.host, '.' || split_part(r.rule, '/', 1)))
    AND starts_with(u.path, substr(r.rule, strpos(r.rule, '/')))
  GROUP BY ALL),
judged AS (SELECT *, host || path || tail AS subject FROM split)
SELECT page_id, j.host, j.path, f.rule,
       coalesce(f.verdict, CASE WHEN {_PATTERNS_SQL} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN fits f ON j.host = f.host AND j.path = f.path
"""


@query("op9_url_filter", URL_SQL)
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's address judged by the listed rules, else by the pattern rules."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_rules.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def _scored(spark: SparkSession, folder: str, module, parts: int, held, threshold: float) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    left = labelled.remainder("doc_id", parts)
    model = module.train(docs, table(spark, folder, "labels"), ~held(left))
    return module.score(docs, model).select(
        "doc_id",
        held(left).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


TOXIC_FROM, GOOD_FROM = 0.7, 0.3


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from labelled documents outside the held-out third."""
    return _scored(spark, folder, toxicity, 3, lambda left: left == 1, TOXIC_FROM)


@query("op6_quality")
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learnt from labelled documents outside the held-out fifth."""
    return _scored(spark, folder, quality, 5, lambda left: left == 0, GOOD_FROM)


LINE_DOCUMENTS = 10

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINES_SQL = f"""
WITH line AS (
  SELECT row_id, doc_id, pos, line, translate(trim(line, {_SPACE}), '{_UPPER}', '{_LOWER}') AS key
  FROM (SELECT row_id, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
        FROM (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
              FROM documents))),
frequent AS (
  SELECT key FROM line WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row_id) >= {LINE_DOCUMENTS})
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM line l LEFT JOIN frequent f ON l.key = f.key
GROUP BY row_id, doc_id
"""


@query("op2_line_dedup", LINES_SQL)
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that stand in ten documents or more."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = line_dedup.drop(docs, line_dedup.build(docs, LINE_DOCUMENTS))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


NEAR_PERCENT = 85


@query("op8_near_dups")
def op8_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the component of its near-duplicates."""
    return near_dups.link(table(spark, folder, "documents").select("doc_id", "text"), NEAR_PERCENT)


@query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, and whether they decode to its text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.encode(docs, pieces.read()).select("doc_id", "ids", "n_tokens", "lossless")


@query("op10_nearest")
def op10_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest found for every twentieth vector."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest.search(vectors, F.col("vec_id") % 20 == 0, 20)


@query("op1_main_text")
def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    out = main_text.with_text(pages)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and test item that align."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.matches(docs, table(spark, folder, "benchmark"))


@query("op7_personal_data")
def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's personal data."""
    found = personal.find(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, personal.BASE),
        F.sha2(personal.listing(base).cast("binary"), 256).alias("base_sha256"),
        personal.listing(F.col("spans")).alias("spans"),
    )


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with some rows dropped, emptied, cut, repeated or given another role; and which rows are still there.

    Null texts, roles and parts of the row's name count as one space.
    """
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.col("damage")
    text, role = (F.coalesce(c, F.lit(" ")) for c in ("text", "role"))
    out = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name) % 20).alias("damage")).select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        "damage",
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return out, kind != 0


@query("op12_dialogue_repair")
def op12_dialogue_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, damaged and repaired."""
    return dialogue.audit(dialogue.repair(*damaged(table(spark, folder, "conversations"))))


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's alignment of byte-level and piece ids, and how common its links are in the corpus."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return align.align(docs, align.read(), listing=_sha256).withColumnRenamed("groups", "groups_sha256")


@query("op13_language_model")
def op13_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's log-likelihood, learnt from nine tenths of the documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = labelled.remainder("doc_id", 10) == 0
    out = language_model.score(docs, ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
