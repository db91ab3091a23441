"""Readers for host lists, URL lists, scraped rows, saved pages and page tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PAGE_ROW = "url string, title string, h1 string, article string"


def _placed_text(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """Records of text files with their place: file, block of the file, and order in the block."""
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"), "value",
    )


def _counted_before(rows: DataFrame, count: Column, within: tuple[str, ...]) -> DataFrame:
    """``_before``: the sum of ``count`` over all earlier records, files in path order; or, with ``within``, over those of the same one.

    Sums per block are added up first: one row a block, as many as the files have splits. Inside a
    block, which one task has read, records are counted in their order.
    """
    blocks = rows.groupBy("_file", "_block").agg(F.sum(count).alias("_n"))
    earlier = Window.partitionBy(*within).orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_file", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_file", "_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.withColumn("_inside", F.coalesce(F.sum(count).over(inside), F.lit(0)))
    return counted.join(offsets, ["_file", "_block"]).withColumn("_before", F.col("_offset") + F.col("_inside")).drop("_offset", "_inside")


def read_host_list(spark: SparkSession, path: str) -> DataFrame:
    """JSON arrays of strings, one row per entry: ``pos, host``, however the arrays are laid out in lines.

    Files are split at quotes, so an array written on one line is read by as many tasks as its size
    asks for. Whether a piece is text of an entry follows from the number of quotes before it;
    escaped ones do not count, and the pieces around them are put together again. ``pos`` counts
    from 0 without gaps over all files in path order.
    """
    pieces = _placed_text(spark, path, '"')
    # A quote behind an odd number of backslashes belongs to the entry.
    escaped = F.length(F.regexp_extract("value", r"(\\*)$", 1)) % 2 == 1
    quotes = _counted_before(pieces.withColumn("_escaped", escaped), F.when(F.col("_escaped"), 0).otherwise(1), ("_file",))
    entries = quotes.filter(F.col("_before") % 2 == 1)
    parts = F.array_sort(F.collect_list(F.struct("_block", "_at", "value")))
    texts = entries.groupBy("_file", "_before").agg(parts.alias("_parts"))
    text = F.array_join(F.transform("_parts", lambda p: p["value"]), '"')
    host = F.get(F.from_json(F.concat(F.lit('["'), text, F.lit('"]')), "array<string>"), F.lit(0))
    files = texts.groupBy("_file").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    # One row a file.
    files = files.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    return texts.join(files, "_file").select((F.col("_first") + F.floor(F.col("_before") / 2)).cast("bigint").alias("pos"), host.alias("host"))


def read_url_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files with one URL per line: ``pos, url``; ``pos`` counts from 0 without gaps over all files in path order."""
    lines = _counted_before(_placed_text(spark, path), F.lit(1), ())
    return lines.select(F.col("_before").cast("bigint").alias("pos"), F.col("value").alias("url"))


def read_page_rows(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """JSON rows ``{url, title, h1, article}``.

    ``multi_line`` reads a pretty-printed array, one file per task; without it each line is
    an object or an array and large files split.
    """
    return (
        spark.read.schema(PAGE_ROW + ", _corrupt_record string")
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def read_html_files(
    spark: SparkSession,
    path: str,
    glob: str = "*.html",
    site_pattern: str = r"/samples/([^/]+)/",
    name_pattern: str = r"([^/]+)$",
) -> DataFrame:
    """Tree of saved pages: ``path, site, name, page_type, html``."""
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    )
    site = F.regexp_extract("path", site_pattern, 1)
    name = F.regexp_extract("path", name_pattern, 1)
    return files.select(
        "path",
        F.when((site == "") | (site == name), "unknown").otherwise(site).alias("site"),
        name.alias("name"),
        page_type(name).alias("page_type"),
        "html",
    )


def page_type(name):
    """Kind of a saved page by its file name: listing before job."""
    return (
        F.when(name.contains("listing"), "LISTING PAGE")
        .when(name.contains("job"), "JOB DETAIL PAGE")
        .otherwise("UNKNOWN PAGE")
    )


def stream_pages(spark: SparkSession, path: str, schema, glob: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """Page tables that keep arriving as parquet files."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def stream_table(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """A parquet table as a stream, be it one file or a folder to which files are added.

    A plain path has to be a folder, a pattern may stand for either: the last letter is written as one.
    """
    return stream_pages(spark, f"{path[:-1]}[{path[-1]}]", schema, "*", files_per_batch)
