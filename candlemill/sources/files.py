"""Input files: which there are, what they hash to, how many lines they have."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.functions.parsing import instrument_of, market_of
from candlemill.session import fresh_dir

# Lines whose hashes make one piece of a tree checksum: two megabytes of hashes.
PIECE_LINES = 1 << 16

FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def base_name(path: Column) -> Column:
    """File name without folders."""
    return F.substring_index(path, "/", -1)


def described(files: DataFrame) -> DataFrame:
    """The columns used here; ``file_uri`` is how a scan names the file of a row."""
    return files.select(
        "path",
        F.col("_metadata.file_path").alias("file_uri"),
        "length",
        F.col("modificationTime").alias("modified"),
        "content",
    )


def list_files(
    spark: SparkSession, root: str, glob: str = "*.csv", name_pattern: str | None = None
) -> DataFrame:
    """Regular files below ``root`` by name glob and, if given, a regex on the name.

    ``content`` is read only by a query that uses it.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    if name_pattern is not None:
        files = files.filter(base_name(F.col("path")).rlike(name_pattern))
    return described(files)


def literal_path(path: str) -> str:
    """A path with the characters escaped that a reader would take for a glob."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def with_checksum(files: DataFrame) -> DataFrame:
    """SHA-256 of each file's bytes beside what describes the file.

    Every file takes this one path, inside the JVM and by Spark's own file systems. A file
    is one value, so the source refuses one that is longer than an array can be (2 GB).
    """
    about = [c for c in files.columns if c != "content"]
    return files.select(*about, F.sha2("content", 256).alias("checksum"))


def _numbered_lines(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(file_uri, line, digest) of every line: its number from 0 and the SHA-256 of its bytes.

    Spark cuts a file into splits, and a task reads a split from first line to last, so a
    line's number is its place in the split after the lines of the splits before.
    """
    read = (
        spark.read.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("lineSep", "\n")
        .text(root)
    )
    read = read.select(
        F.col("_metadata.file_path").alias("file_uri"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
        F.unhex(F.sha2(F.col("value").cast("binary"), 256)).alias("digest"),
    )
    # Written once: places hold for one reading only.
    path = fresh_dir(spark, "line-hashes")
    read.write.parquet(path)
    lines = spark.read.schema(read.schema).parquet(path)
    splits = lines.groupBy("file_uri", "split").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("lines")
    )
    # One row for each split of a file.
    before = Window.partitionBy("file_uri").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        "file_uri",
        "split",
        (F.coalesce(F.sum("lines").over(before), F.lit(0)) - F.col("first")).alias("shift"),
    )
    return lines.join(splits, ["file_uri", "split"]).select(
        "file_uri", (F.col("place") + F.col("shift")).alias("line"), "digest"
    )


def with_tree_checksum(
    spark: SparkSession, root: str, glob: str = "*.csv", piece_lines: int = PIECE_LINES
) -> DataFrame:
    """(path, file_uri, length, modified, lines, tree_checksum) of the files below ``root``.

    For files of any size: tasks share the lines of a file, and none holds more than
    ``piece_lines`` hashes or the piece hashes of one file. A line is what lies between two
    line feeds, a carriage return included. The hash of a piece is the SHA-256 of the
    SHA-256 values of its lines in order, as bytes; the tree checksum is the SHA-256 of the
    text ``tree:PIECE_LINES:LENGTH:LINES:`` and the hashes of the pieces in lowercase hex.
    The length tells a file that ends with a line feed from one that does not, and one with
    a byte order mark, which the reader leaves out, from one without.

    Equal bytes have equal checksums under any name and in any splits. Spark lists no empty
    files, so they have no row. A single line is one value, so one of over 2 GB fails the job. Another number of
    ``piece_lines`` gives other checksums; they are not those of ``with_checksum``.
    """
    if piece_lines < 1:
        raise ValueError("a piece needs one line at least")
    lines = _numbered_lines(spark, root, glob)
    piece = F.floor(F.col("line") / piece_lines).alias("piece")
    pieces = lines.groupBy("file_uri", piece).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sort_array(F.collect_list(F.struct("line", "digest"))).alias("held"),
    )
    in_order = F.expr("unhex(array_join(transform(held, h -> hex(h.digest)), ''))")
    pieces = pieces.select("file_uri", "piece", "lines", F.sha2(in_order, 256).alias("digest"))
    whole = pieces.groupBy("file_uri").agg(
        F.sum("lines").alias("lines"),
        F.sort_array(F.collect_list(F.struct("piece", "digest"))).alias("held"),
    )
    files = list_files(spark, root, glob).drop("content").join(whole, "file_uri")
    text = F.concat(
        F.lit(f"tree:{piece_lines}:"),
        F.col("length").cast("string"),
        F.lit(":"),
        F.col("lines").cast("string"),
        F.lit(":"),
        F.array_join("held.digest", ""),
    )
    return files.select(
        "path",
        "file_uri",
        "length",
        "modified",
        "lines",
        F.sha2(text.cast("binary"), 256).alias("tree_checksum"),
    )


def manifest(files: DataFrame, name: Column | None = None) -> DataFrame:
    """One row per distinct content: checksum, path, file_uri, length, modified, file_name,
    market, instrument.

    Copies of the same bytes under several names are one entry.
    """
    about = [c for c in files.columns if c != "content"]
    one = F.min(F.struct(*about)).alias("one")
    found = with_checksum(files).groupBy("checksum").agg(one).select("checksum", "one.*")
    return named(found, name)


def named(files: DataFrame, name: Column | None = None) -> DataFrame:
    """Adds file_name and what it says: market and instrument."""
    name = base_name(F.col("path")) if name is None else name
    files = files.withColumn("file_name", name)
    return files.withColumn("market", market_of(F.col("file_name"))).withColumn(
        "instrument", instrument_of(F.col("file_name"))
    )


def files_at(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files at these paths, with their content."""
    return described(spark.read.format("binaryFile").load([literal_path(p) for p in paths]))


def line_counts(spark: SparkSession, root: str, glob: str = "*.csv", with_header: bool = True) -> DataFrame:
    """Lines of each file; large files are counted by several tasks."""
    lines = (
        spark.read.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .text(root)
        .select(F.col("_metadata.file_path").alias("file_path"))
    )
    header = 0 if with_header else 1
    return lines.groupBy("file_path").agg((F.count(F.lit(1)) - header).alias("lines"))
