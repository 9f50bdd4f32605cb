"""The operators of this package as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candlemill.llm.bpe import bpe
from candlemill.llm.common import table
from candlemill.llm.fingerprints import fingerprints
from candlemill.llm.jaccard_join import jaccard_join
from candlemill.llm.language import language_id
from candlemill.llm.line_dedup import drop_templates
from candlemill.llm.mixing import mix
from candlemill.llm.nearest import nearest
from candlemill.llm.packing import pack
from candlemill.llm.quality import quality
from candlemill.llm.ranked import ranked_search
from candlemill.llm.runs import periodic_runs, run_digests, with_planted_runs
from candlemill.llm.secrets import secrets
from candlemill.llm.toxicity import toxicity

Run = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where this machine keeps a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard_join(docs, width=3, num=90, den=100)[1]


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_templates(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe(table(spark, sf_dir, "documents"), tokenizer_path())


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def llm_queries() -> dict[str, Run]:
    operators = (
        op1_jaccard_join,
        op2_line_dedup,
        op3_packing,
        op4_mixing,
        op5_quality,
        op6_toxicity,
        op7_secrets,
        op8_language,
        op9_fingerprints,
        op10_nearest,
        op11_bpe,
        op12_runs,
        op13_ranked_search,
    )
    return {f.__name__: f for f in operators}


# The same rules with tokens, lines and shingles themselves in place of their hashes. Templates
# are counted twice: by different texts, then with near copies as one.
_OP2_COUNT = r"""
leaves{n} AS (
  SELECT words, head FROM parsed JOIN source{n} USING (text)
  GROUP BY words, head, needed HAVING count(DISTINCT source) >= needed),
tokens{n} AS (
  SELECT text, source, line, words, head, needed, fields,
         unnest(tok) AS token, generate_subscripts(tok, 1) AS position
  FROM parsed JOIN leaves{n} USING (words, head) JOIN source{n} USING (text)),
constant{n} AS (
  SELECT words, head, position, token FROM tokens{n} WHERE token <> '<*>'
  GROUP BY words, head, position, token, needed HAVING count(DISTINCT source) >= needed),
templates{n} AS (
  SELECT text, source, line, words, head, needed,
         list((position, token) ORDER BY position) AS template
  FROM tokens{n} JOIN constant{n} USING (words, head, position, token)
  GROUP BY text, source, line, words, head, needed, fields
  HAVING (count(*) + fields) * 100 >= words * 70 AND count(*) * 100 >= words * 25),
often{n} AS (
  SELECT words, head, template FROM templates{n}
  GROUP BY words, head, template, needed HAVING count(DISTINCT source) >= needed),
gone{n} AS (
  SELECT text, list(line) AS gone, max(words) AS longest,
         sum(words) * 100 > len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) * 50 AS heavy
  FROM templates{n} JOIN often{n} USING (words, head, template) GROUP BY text)"""

OP2_SQL = (
    r"""
WITH RECURSIVE texts AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
split AS (
  SELECT text, unnest(string_split(text, chr(10))) AS l,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
  FROM texts),
parsed AS (
  SELECT text, line, tok, len(tok) AS words, tok[1:3] AS head,
         len([x FOR x IN tok IF x = '<*>']) AS fields,
         CASE WHEN len(tok) > 50 THEN 2 ELSE 5 END AS needed
  FROM (SELECT text, line,
               [CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END
                FOR x IN regexp_extract_all(l, '[^\x20\x09-\x0D]+')] AS tok
        FROM split)
  WHERE len(tok) > 0),
source1 AS (SELECT text, text AS source FROM texts),"""
    + _OP2_COUNT.format(n=1)
    + r""",
losing AS (
  SELECT row_number() OVER (ORDER BY text) AS id, text,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM gone1 WHERE longest > 50 OR heavy),
sets AS (
  SELECT id, CASE WHEN len(w) < 5 THEN [w]
                  ELSE list_distinct([w[i:i + 4] FOR i IN range(1, len(w) - 3)]) END AS s
  FROM losing),
shingles AS (SELECT id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.id AS a, b.id AS b FROM shingles a JOIN shingles b USING (shingle)
  GROUP BY a.id, b.id, a.n, b.n HAVING count(*) * 100 >= (a.n + b.n - count(*)) * 80),
reach AS (
  SELECT id, id AS other FROM losing
  UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a),
groups AS (
  SELECT id, min(other) AS first, count(*) > 1 AS copied FROM reach GROUP BY id),
near AS (
  SELECT l.text, f.text AS source FROM groups g JOIN losing l USING (id) JOIN losing f ON f.id = g.first
  WHERE copied),
source2 AS (SELECT text, coalesce(near.source, text) AS source FROM texts LEFT JOIN near USING (text)),"""
    + _OP2_COUNT.format(n=2)
    + r""",
judged AS (
  SELECT d.*, string_split(d.text, chr(10)) AS parts, g.gone,
         g.gone IS NOT NULL AND NOT (g.heavy AND near.source IS NOT NULL) AS cut
  FROM documents d LEFT JOIN gone2 g ON d.text = g.text LEFT JOIN near ON d.text = near.text)
SELECT doc_id, lang, source, n_chars,
       CASE WHEN cut THEN array_to_string(
         list_filter(parts, lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) ELSE text END AS text,
       CASE WHEN coalesce(length(text), 0) = 0 THEN 0 ELSE len(parts) END::INT AS n_lines,
       CASE WHEN cut THEN len(gone) ELSE 0 END::INT AS n_dropped
FROM judged
"""
)


def llm_sql() -> dict[str, str]:
    return {"op2_line_dedup": OP2_SQL}
