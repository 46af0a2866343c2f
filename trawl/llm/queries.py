"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm.alignment import align
from trawl.llm.bytepairs import DIGESTS, digests, encoded, read_ranks
from trawl.llm.decontaminate import contaminations
from trawl.llm.fingerprints import edited_fingerprints
from trawl.llm.html_text import extract
from trawl.llm.language import identify
from trawl.llm.lines import without_spread_lines
from trawl.llm.mixing import mix
from trawl.llm.near_dup import near_duplicates
from trawl.llm.pii import find_personal_data
from trawl.llm.ranking import ranked
from trawl.llm.substrings import repeated_passages
from trawl.llm.tokens import token_counts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "size", "source_size", "target", "taken")
    return mix(_table(spark, sf_dir, "documents")).select(*columns)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_table(spark, sf_dir, "documents"))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), 85)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents")
    return token_counts(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, total, removed = without_spread_lines(_table(spark, sf_dir, "documents"))
    return docs.select(
        "doc_id", F.col(total).alias("n_lines"), F.col(removed).alias("n_removed"), "text"
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = [str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    found = align(_table(spark, sf_dir, "documents"), *files, groups=digest)
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(str(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    docs = _table(spark, sf_dir, "documents")
    return encoded(docs, ranks, public_tokenizers.PATTERN, digests(ranks), DIGESTS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_pii": op2_pii,
    "op3_near_dup": op3_near_dup,
    "op4_token_counts": op4_token_counts,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_fingerprints": op6_fingerprints,
    "op7_html_text": op7_html_text,
    "op8_line_dedup": op8_line_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_language_id": op10_language_id,
    "op11_ranked_search": op11_ranked_search,
    "op12_alignment": op12_alignment,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLE_SQL: dict[str, str] = {
    "op3_near_dup": r"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM word WHERE len(w) > 0)),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT x, y FROM shared JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
  WHERE 100 * shared.n >= 85 * (a.n + b.n - shared.n)),
reach AS (
  SELECT x AS doc_id, x AS other FROM link
  UNION SELECT reach.doc_id, link.y FROM reach JOIN link ON link.x = reach.other),
lowest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles,
       coalesce(lowest.component_id, d.doc_id) AS component_id,
       coalesce(lowest.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN size USING (doc_id) LEFT JOIN lowest USING (doc_id)
""",
    "op8_line_dedup": r"""
WITH line AS (
  SELECT doc_id, source, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
spread AS (
  SELECT line FROM line WHERE NOT regexp_full_match(line, '[\x20\x09-\x0D]*') GROUP BY line
  HAVING count(DISTINCT coalesce(source, chr(0))) >= 5 AND count(DISTINCT text) >= 5),
marked AS (
  SELECT doc_id, pos, line, line IN (SELECT line FROM spread) AS gone,
         NOT regexp_full_match(line, '[\x20\x09-\x0D]*') AS is_filled
  FROM line)
SELECT d.doc_id, count(*) FILTER (is_filled) AS n_lines,
       count(*) FILTER (gone AND is_filled) AS n_removed,
       CASE WHEN count(*) FILTER (gone) = 0 THEN any_value(d.text)
            ELSE coalesce(string_agg(m.line, chr(10) ORDER BY pos) FILTER (NOT gone), '') END AS text
FROM documents d JOIN marked m USING (doc_id) GROUP BY d.doc_id
""",
    "op11_ranked_search": r"""
WITH held AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL),
doc AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, terms, len(terms)::BIGINT AS n FROM held WHERE len(terms) > 0),
corpus AS MATERIALIZED (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM doc),
item AS MATERIALIZED (
  SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM benchmark),
posting AS MATERIALIZED (
  SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(terms) AS term FROM doc)
  WHERE term IN (SELECT term FROM item) GROUP BY ALL),
weight AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM posting, corpus GROUP BY term, big_n),
score AS (
  SELECT item_id, row, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))))::BIGINT AS score
  FROM item JOIN weight USING (term) JOIN posting USING (term) JOIN doc USING (row), corpus
  GROUP BY item_id, row, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM score WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
""",
}
