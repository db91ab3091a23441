"""Streaming queries: the given pages arrive as files, results are read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import links
from ..session import scratch_path
from ..sources.readers import stream_table
from ..sources.seen import SeenTable
from ..streaming import stream as S
from .base import Family, sql_base, sql_join, sql_site, table
from .links import ANCHORS

family = Family()
QUERIES, SQL = family.queries, family.sql
add = family.add

STATUS = "CASE page_id % 10 WHEN 0 THEN 404 WHEN 1 THEN 401 WHEN 2 THEN 503 ELSE 200 END"
VERDICT = "CASE page_id % 10 WHEN 0 THEN 'PAGE_NOT_FOUND' WHEN 1 THEN 'UNAUTHORIZED' WHEN 2 THEN 'SERVER_ERROR' ELSE 'PASS' END"


def arriving(spark, sf_dir, name):
    return stream_table(spark, f"{sf_dir}/{name}.parquet", table(spark, sf_dir, name).schema)


def pages(spark, sf_dir):
    return arriving(spark, sf_dir, "pages").withColumn("status_code", F.expr(STATUS))


@add("stream_gate", f"SELECT page_id, url, {VERDICT} AS verdict FROM pages")
def stream_gate(spark, sf_dir):
    path = S.run(spark, S.gate_stream, pages(spark, sf_dir))
    good, bad = S.read_gate(spark, path, True), S.read_gate(spark, path, False)
    return good.unionByName(bad).select("page_id", "url", "verdict")


def resolved(found):
    return found.select("page_id", "pos", U.resolve_url(U.base_url(F.col("url")), F.col("href")).alias("url"))


@add("stream_links", f"SELECT page_id, pos, {sql_join(sql_base('url'), 'href')} AS url FROM ({ANCHORS})")
def stream_links(spark, sf_dir):
    path = S.run(spark, S.links_stream, pages(spark, sf_dir), extract=lambda p: resolved(links.anchors(p)))
    return spark.read.parquet(path).select("page_id", "pos", "url")


@add("stream_first_seen", f"SELECT DISTINCT {sql_join(sql_base('url'), 'href')} AS url_key FROM ({ANCHORS})")
def stream_first_seen(spark, sf_dir):
    found = resolved(links.anchors(pages(spark, sf_dir))).select("url")
    path = S.run(spark, S.first_seen_stream, found)
    return spark.read.parquet(path).select("url_key")


@add("stream_first_seen_table", f"SELECT DISTINCT {sql_join(sql_base('url'), 'href')} AS url_key FROM ({ANCHORS}) WHERE page_id % 2 = 1")
def stream_first_seen_table(spark, sf_dir):
    """Links of odd pages but for those the table has from even ones; both together are all of the odd pages' links."""
    seen = SeenTable(spark, scratch_path(spark, "seen"), spark.sparkContext.defaultParallelism)
    found = resolved(links.anchors(pages(spark, sf_dir))).select("page_id", "url")
    before = resolved(links.anchors(table(spark, sf_dir, "pages").filter("page_id % 2 = 0"))).select("url")
    seen.add(before, 0, "url")
    path = S.run(spark, S.first_seen_table_stream, found.filter("page_id % 2 = 1").select("url"), seen=seen)
    fresh = spark.read.parquet(path).select("url_key")
    odd = resolved(links.anchors(table(spark, sf_dir, "pages").filter("page_id % 2 = 1"))).select(U.url_unique_key(F.col("url")).alias("url_key"))
    known = odd.join(seen.keys(1), "url_key", "left_semi").distinct()
    return fresh.unionByName(known)


VISITS = "concat('https://h', user_id % 50, '.example.net/', event_type, '/#', event_id)"


@add("stream_first_seen_watermark", "SELECT DISTINCT 'https://h' || user_id % 50 || '.example.net/' || event_type AS url_key FROM events")
def stream_first_seen_watermark(spark, sf_dir):
    """Pages users came to, by the time they came: no two visits are further apart than the delay."""
    found = arriving(spark, sf_dir, "events").select(F.expr(VISITS).alias("url"), F.col("ts").cast("timestamp").alias("arrived"))
    path = S.run(spark, S.first_seen_stream, found, arrival="arrived", delay="3650 days")
    return spark.read.parquet(path).select("url_key")


@add("stream_current_counts", f"SELECT {sql_site('url')} AS site, {VERDICT} AS verdict, count(*) AS n FROM pages GROUP BY 1, 2")
def stream_current_counts(spark, sf_dir):
    path = S.run(spark, S.status_counts_stream, pages(spark, sf_dir))
    return S.current_counts(spark, S.checkpoint_of(path)).select("site", "verdict", "n")


@add("stream_status_counts", f"SELECT {sql_site('url')} AS site, {VERDICT} AS verdict, count(*) AS n FROM pages GROUP BY 1, 2")
def stream_status_counts(spark, sf_dir):
    path = S.run(spark, S.status_counts_stream, pages(spark, sf_dir))
    return S.latest_counts(spark, path).select("site", "verdict", "n")
