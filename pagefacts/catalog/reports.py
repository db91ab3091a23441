"""Queries on counts, coverage and sorted reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import report
from ..session import scratch_path
from ..sources import sinks
from .base import ATTEMPT_VERDICTS, ATTEMPTS, BOARD_URLS, HOST_CHECKS, JOB_PAGES, Family, derived, sql_site, table, twin
from .gate import ENTRY_VERDICTS, entry_verdicts, resolve_attempts

family = Family()
QUERIES, SQL = family.queries, family.sql
add = family.add

CHECKS = twin(HOST_CHECKS, verdicts=twin(ATTEMPT_VERDICTS, attempts=ATTEMPTS))
POSITION = "CAST(replace(replace(host, 'h', ''), '.example.net', '') AS BIGINT)"


def checks(spark, sf_dir):
    """Host checks with the place of the host in the input list."""
    return resolve_attempts(spark, sf_dir).withColumn("pos", F.regexp_extract("host", "^h([0-9]+)", 1).cast("bigint"))


def counts_sql(rows, statuses):
    return f"SELECT s.status, count(r.status) AS n FROM (SELECT unnest({list(statuses)}) AS status) s LEFT JOIN ({rows}) r ON r.status = s.status GROUP BY 1"


@add("status_counts", counts_sql(ENTRY_VERDICTS, report.DATASET_STATUSES))
def status_counts(spark, sf_dir):
    return report.status_counts(entry_verdicts(spark, sf_dir))


@add("host_status_counts", counts_sql(CHECKS, report.STATUSES))
def host_status_counts(spark, sf_dir):
    return report.host_status_counts(checks(spark, sf_dir))


@add("valid_hosts", f"SELECT host FROM ({CHECKS}) WHERE status = 'working' AND (total_jobs IS NULL OR total_jobs > 0)")
def valid_hosts(spark, sf_dir):
    return report.valid_hosts(checks(spark, sf_dir)).select("host")


@add("valid_domains", f"SELECT domain FROM ({ENTRY_VERDICTS}) WHERE status = 'valid'")
def valid_domains(spark, sf_dir):
    return report.valid_domains(entry_verdicts(spark, sf_dir))


@add("js_domains", f"SELECT domain FROM ({ENTRY_VERDICTS}) WHERE status = 'js_required'")
def js_domains(spark, sf_dir):
    return report.js_domains(entry_verdicts(spark, sf_dir))


@add("sort_dataset_status", f"SELECT page_id, status FROM ({ENTRY_VERDICTS}) ORDER BY CASE status WHEN 'valid' THEN 0 WHEN 'js_required' THEN 1 ELSE 2 END, page_id")
def sort_dataset_status(spark, sf_dir):
    return report.sort_dataset_status(entry_verdicts(spark, sf_dir), "page_id").select("page_id", "status")


HOST_RANK = "CASE status WHEN 'working' THEN 0 WHEN 'auth_required' THEN 1 WHEN 'blocked' THEN 2 WHEN 'not_working' THEN 3 ELSE 4 END"


@add("sort_host_status", f"SELECT host, status, total_jobs FROM ({CHECKS}) ORDER BY {HOST_RANK}, coalesce(total_jobs, 0) DESC, {POSITION}")
def sort_host_status(spark, sf_dir):
    return report.sort_host_status(checks(spark, sf_dir)).select("host", "status", "total_jobs")


@add("top_hosts_by_jobs", f"SELECT host, total_jobs FROM ({CHECKS}) WHERE status = 'working' AND total_jobs > 0 ORDER BY total_jobs DESC, {POSITION} LIMIT 50")
def top_hosts_by_jobs(spark, sf_dir):
    return report.top_hosts_by_jobs(checks(spark, sf_dir), 50).select("host", "total_jobs")


@add("unique_jobs", twin(f"""WITH j AS (SELECT DISTINCT {sql_site('url')} AS site, nullif(regexp_extract(url, '/([0-9]+)(?:[/?#]|$)', 1), '') AS job FROM
  (SELECT url FROM {{board}} UNION ALL SELECT url FROM pages UNION ALL SELECT url FROM pages))
SELECT site, count(*) AS unique_jobs FROM j WHERE job IS NOT NULL GROUP BY GROUPING SETS ((site), ())""", board=BOARD_URLS))
def unique_jobs(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("url")
    every = derived(spark, sf_dir, BOARD_URLS).select("url").unionByName(pages).unionByName(pages)
    jobs = every.select(U.site_key(F.col("url")).alias("site"), U.job_id(F.col("url")).alias("job"))
    return report.unique_jobs(jobs, "site", "job")


SKETCHED = f"""SELECT DISTINCT CASE WHEN l_orderkey % 3 = 0 THEN 'board' ELSE 's' || l_suppkey % 4 END AS site, l_orderkey * 8 + l_linenumber % 4 AS job FROM lineitem"""


@add("unique_jobs_sketched", f"""SELECT site, count(*) AS unique_jobs, TRUE AS near FROM ({SKETCHED}) GROUP BY GROUPING SETS ((site), ())""")
def unique_jobs_sketched(spark, sf_dir):
    """Exact counts, and whether those united from the sketches of three overlapping runs come within three hundredths."""
    key, site = F.col("l_orderkey"), F.concat(F.lit("s"), F.col("l_suppkey") % 4)
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber")
    jobs = lines.select(F.when(key % 3 == 0, "board").otherwise(site).alias("site"), (key * 8 + F.col("l_linenumber") % 4).alias("job"), (key % 5).alias("part"))
    path = scratch_path(spark, "sketches")
    for run_id, some in (("r1", jobs.filter("part < 3")), ("r2", jobs.filter("part > 1")), ("r3", jobs.filter("part = 2")), ("r1", jobs.filter("part < 3"))):
        sinks.write_run(report.job_sketches(some, "site", "job"), path, run_id)
    counted = report.unique_jobs_of(spark.read.parquet(path), "site").withColumnRenamed("unique_jobs", "estimate")
    exact = report.unique_jobs(jobs, "site", "job")
    near = F.abs(F.col("estimate") - F.col("unique_jobs")) <= 0.03 * F.col("unique_jobs")
    return exact.alias("e").join(counted.alias("c"), F.col("e.site").eqNullSafe(F.col("c.site"))).select("e.site", "unique_jobs", near.alias("near"))


COVERED = twin("""SELECT CASE WHEN page_id % 3 = 0 THEN 'board' ELSE 's' || page_id % 40 END AS site, title, CASE WHEN page_id % 4 <> 0 THEN location END AS location,
  CASE WHEN page_id % 5 <> 0 THEN description ELSE '' END AS description FROM {jobs}""", jobs=JOB_PAGES)


@add("field_coverage", f"""SELECT site, count(*) AS jobs, count(nullif(title, '')) AS has_title, count(nullif(location, '')) AS has_location,
  count(nullif(description, '')) AS has_description FROM ({COVERED}) GROUP BY site""")
def field_coverage(spark, sf_dir):
    k = F.col("page_id")
    jobs = derived(spark, sf_dir, JOB_PAGES).select(
        F.when(k % 3 == 0, "board").otherwise(F.concat(F.lit("s"), k % 40)).alias("site"),
        "title",
        F.when(k % 4 != 0, F.col("location")).alias("location"),
        F.when(k % 5 != 0, F.col("description")).otherwise("").alias("description"),
    )
    return report.field_coverage(jobs, ("title", "location", "description"), "site")
