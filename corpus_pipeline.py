"""From raw documents to packed training windows, in five stages.

Each stage works on all that its predecessor kept. Its result is written as Parquet below
``spark.checkpoint.dir`` and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlemill.llm.common import saved, table, work_tables
from candlemill.llm.jaccard_join import jaccard_rows, text_row
from candlemill.llm.line_dedup import drop_templates
from candlemill.llm.mixing import mix
from candlemill.llm.packing import pack
from candlemill.llm.queries import tokenizer_path
from candlemill.llm.toxicity import THRESHOLD, below, fit

_WORD = r"[^\x20\x09-\x0D]"
# A word with the white space before it.
_STEP = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject, as they are."""
    return below(docs, fit(docs, table(spark, sf_dir, "labels")), THRESHOLD)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines whose template recurs across documents.

    Near copies count as one document, so what only they share stays. Only a near copy may
    keep lines that recur elsewhere: if they are more than half of its words. Null and empty
    texts and repeated rows stay as they are.
    """
    return _counted(drop_templates(docs).select(*docs.columns))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, once: that of the smallest id.

    Groups are linked by sets of five-word shingles with a similarity of 0.8 or more. An id
    that comes with several texts has each of them in a group of its own; of equal ids in a
    group the text of the smaller hash stays, of equal rows one. Rows without an id, and
    texts without words, null or empty, are in no group and stay.
    """
    rows = jaccard_rows(docs, width=5, num=80, den=100)[1]
    kept = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("row").alias("row"))
    kept = saved(kept.select("row.*"), "kept").select(F.struct("doc_id", "t1", "t2").alias("row"))
    given = docs.select(F.struct(*docs.columns).alias("given"), text_row(docs).alias("row"), "text")
    in_group = F.col("row.doc_id").isNotNull() & F.coalesce(F.col("text").rlike(_WORD), F.lit(False))
    equal = Window.partitionBy("row").orderBy(F.to_json("given"))
    first = given.where(in_group).join(kept, "row", "left_semi").withColumn("place", F.row_number().over(equal))
    return first.where("place = 1").select("given.*").union(given.where(~in_group).select("given.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a document as often as it is taken whole, and its parts.

    A part holds the words of its range with the white space between them. Documents that
    the mix takes nothing of go.
    """
    taken = mix(docs).where("taken > 0").select("doc_id", "size", "copies", "parts")
    # Rows alike in id and size are taken in any order; they are numbered on both sides.
    alike = Window.partitionBy("_id", "_size").orderBy("_order")
    taken = taken.select(
        F.coalesce("doc_id", F.lit(-1)).alias("_id"),
        F.col("size").alias("_size"),
        "copies",
        "parts",
        F.to_json("parts").alias("_order"),
    )
    taken = taken.withColumn("_n", F.row_number().over(alike)).drop("_order")
    words = F.regexp_extract_all("text", F.lit(_STEP), 0)
    rows = docs.withColumn("_id", F.coalesce("doc_id", F.lit(-1)))
    rows = rows.withColumn("_size", F.coalesce(F.size(words), F.lit(0)).cast("long"))
    rows = rows.withColumn("_order", F.col("text")).withColumn("_n", F.row_number().over(alike))
    out = rows.join(taken, ["_id", "_size", "_n"]).withColumn("_words", words)
    pieces = F.expr(
        "concat(array_repeat(text, cast(copies AS int)), transform(parts, p ->"
        " ltrim(' \\t\\n\\u000B\\f\\r', array_join("
        "slice(_words, cast(p.a AS int) + 1, cast(p.b - p.a AS int)), ''))))"
    )
    out = out.withColumn("text", F.explode(pieces))
    return _counted(out.select(*docs.columns))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 tokens."""
    return pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_each_group),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

# A trained classifier decides in the first stage: SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with work_tables(spark):
            docs = saved(stage(spark, docs, sf_dir), f"stage-{name}", outlives=True)
    return docs
