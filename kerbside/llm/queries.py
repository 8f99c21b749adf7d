"""The checked queries of the text operators, and the SQL that gives the same results where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import (
    collocations,
    conversations,
    fingerprints,
    maxent,
    mixing,
    nearest,
    pieces,
    quality,
    simhash,
    token_counts,
    token_files,
    toxicity,
    web_archives,
)
from kerbside.llm.common import fold, table

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    fitted = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, fitted).select(
        "doc_id",
        (fold("doc_id", toxicity.FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = web_archives.pages_through_archives(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Grades from the two labels: 0 junk, 1 readable but toxic, 2 good.
GRADES = 3


def grade() -> Column:
    return F.greatest(F.lit(0), 2 * F.col("quality") - F.coalesce("toxic", F.lit(0)))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    rated = quality.rated_documents(documents, table(spark, sf_dir, "labels"), grade())
    model = quality.fit_ordinal(rated.filter(fold("doc_id", toxicity.FOLDS) != 0), GRADES)
    return quality.grade_texts(documents, model).select(
        "doc_id",
        (fold("doc_id", toxicity.FOLDS) == 0).alias("held_out"),
        "expected_grade",
        "tail_1",
        "tail_2",
        (F.col("tail_1") >= 0.5).alias("selected"),
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.grouped(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    return found.select("doc_id", F.size("pieces").alias("n_pieces"), "pieces", "scores", "others", "decodes")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(conversations.damaged(table(spark, sf_dir, "conversations")))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    return counted.withColumn("over_limit", F.col("n_tokens") > token_counts.LIMIT)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_toxicity,
        op2_web_archives,
        op3_quality,
        op4_fingerprints,
        op5_simhash,
        op6_mixing,
        op7_token_files,
        op8_maxent,
        op9_pieces,
        op10_nearest,
        op11_conversations,
        op12_token_counts,
        op13_collocations,
    )
}

OP6_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-')), 1, 15))::BIGINT AS place
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS INT) + 1] AS weight
  FROM docs GROUP BY source
), dealt AS (  -- sources fill up in the order of size by weight
  SELECT *, (SELECT CAST(sum(source_size) AS BIGINT) FROM sources) AS total,
         coalesce(CAST(sum(2 * source_size) OVER before AS BIGINT), 0) AS filled,
         CAST(sum(weight) OVER (ORDER BY source_size / weight DESC, source DESC) AS BIGINT) AS open
  FROM sources WINDOW before AS (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT (1.5::DOUBLE * total - filled) / open AS level FROM dealt
  WHERE (1.5::DOUBLE * total - filled) / open * weight <= 2 * source_size
  ORDER BY source_size / weight, source LIMIT 1
), budgets AS (
  SELECT source, source_size, least((SELECT level FROM level) * weight, (2 * source_size)::DOUBLE) AS target FROM sources
), base AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies
  FROM budgets
), line AS (
  SELECT docs.*, source_size, target, copies, target - copies * source_size AS rest,
         sum(size) OVER (PARTITION BY docs.source ORDER BY place) AS with_it
  FROM docs JOIN base ON docs.source IS NOT DISTINCT FROM base.source
), tied AS (
  SELECT *, with_it - sum(size) OVER (PARTITION BY source, place) AS without_it FROM line
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * least(copies + CASE WHEN rest > 0 AND (with_it <= rest
            OR (without_it <= rest AND with_it - rest < rest - without_it)) THEN 1 ELSE 0 END, 2) AS BIGINT) AS taken
FROM tied
"""

OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, row_number() OVER () AS piece_no, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
  SELECT lang, piece_no, unnest(w) AS word, unnest(range(len(w))) AS i FROM words
), starts AS (
  SELECT lang, word, lead(word) OVER line AS second, lead(word, 2) OVER line AS third
  FROM placed WINDOW line AS (PARTITION BY piece_no ORDER BY i)
), phrases AS (
  SELECT lang, 1 AS k, word AS phrase FROM starts
  UNION ALL SELECT lang, 2, concat(word, ' ', second) FROM starts WHERE second IS NOT NULL
  UNION ALL SELECT lang, 3, concat(word, ' ', second, ' ', third) FROM starts WHERE third IS NOT NULL
), counts AS (
  SELECT lang, k, phrase, count(*) AS f FROM phrases GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, x.f AS l, y.f AS r, 1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f) AS score
  FROM candidates c JOIN (VALUES (1), (2)) AS places(cut) ON cut < c.k
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1 :], ' ')
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), covered AS (
  SELECT lang, array_to_string(w[first : first + 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, (VALUES (1), (2)) AS places(first) WHERE k = 3 GROUP BY ALL
), ranked AS (
  SELECT lang, phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM weakest LEFT JOIN covered USING (lang, phrase)
  WHERE longer IS NULL OR k = 3 OR 100 * longer < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {"op6_mixing": OP6_SQL, "op13_collocations": OP13_SQL}
