"""Queries that write a derived table in a file format and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gate as G
from ..operators import jobs, seeds
from ..operators.report import dataset_order, host_order, valid_hosts
from ..functions import nodes as N
from ..functions.urls import site_key
from ..session import scratch_path
from ..sources import readers, sinks
from .base import JOB_PAGES, Family, derived, sql_site, table, twin
from .gate import ENTRIES, ENTRY_VERDICTS, MARK_TYPES, MARKED_PAGES, STATUS_TYPES, entry_verdicts, marked
from .reports import CHECKS, checks
from .urls import HOSTS

family = Family()
QUERIES, SQL = family.queries, family.sql
add = family.add

# Host names as a JSON file may spell them.
ODD_HOSTS = """SELECT c_custkey AS pos, concat(CASE c_custkey % 4 WHEN 0 THEN 'a "b", ' WHEN 1 THEN concat('x', chr(92), 'y.') WHEN 2 THEN 'ü[1].' ELSE '' END, c_name, '.example.net') AS host
FROM {customer}"""


@add("src_host_list", twin("SELECT host FROM {odd}", odd=ODD_HOSTS))
def src_host_list(spark, sf_dir):
    path = scratch_path(spark, "hosts")
    # Lines of a pretty-printed array: several entries on some of them.
    entry = F.to_json(F.array(F.col("host"), F.col("host")))
    lines = derived(spark, sf_dir, ODD_HOSTS).select(
        F.when(F.col("pos") % 3 == 0, F.concat(F.lit("  "), F.regexp_replace(entry, r"^\[|\]$", ""), F.lit(",")))
        .otherwise(F.concat(F.lit("["), F.to_json(F.array("host")), F.lit("]"))).alias("value")
    )
    lines.write.text(path)
    return readers.read_host_list(spark, path).select("host").distinct()


@add("src_host_array", twin("SELECT row_number() OVER (ORDER BY pos % 3, pos) - 1 AS pos, host FROM {odd}", odd=ODD_HOSTS))
def src_host_array(spark, sf_dir):
    """Three files, each one array on one line."""
    path = scratch_path(spark, "array")
    entries = F.transform(F.array_sort(F.collect_list(F.struct("pos", "host"))), lambda e: e["host"])
    arrays = derived(spark, sf_dir, ODD_HOSTS).groupBy((F.col("pos") % 3).alias("file")).agg(F.to_json(entries).alias("value"))
    for file in range(3):
        arrays.filter(F.col("file") == file).select("value").coalesce(1).write.text(f"{path}/file-{file}")
    return readers.read_host_list(spark, f"{path}/*").select("pos", "host")


@add("src_url_positions", "SELECT row_number() OVER (ORDER BY page_id % 3, page_id) - 1 AS pos, url FROM pages")
def src_url_positions(spark, sf_dir):
    """Positions over three files."""
    path = scratch_path(spark, "urls")
    rows = table(spark, sf_dir, "pages", "page_id", "url")
    for file in range(3):
        rows.filter(F.col("page_id") % 3 == file).repartition(1).sortWithinPartitions("page_id").select("url").write.text(f"{path}/file-{file}")
    return readers.read_url_lines(spark, f"{path}/*").select("pos", "url")


@add("src_url_lines", "SELECT url FROM pages")
def src_url_lines(spark, sf_dir):
    path = scratch_path(spark, "urls")
    table(spark, sf_dir, "pages", "url").write.text(path)
    return readers.read_url_lines(spark, path).select("url")


@add("src_page_rows", f"SELECT url, title, h1, article FROM ({twin(ENTRIES)})")
def src_page_rows(spark, sf_dir):
    path = scratch_path(spark, "rows")
    row = F.to_json(F.array(F.struct("url", "title", "h1", "article")))
    derived(spark, sf_dir, ENTRIES).select(row.alias("value")).write.text(path)
    return readers.read_page_rows(spark, path, multi_line=False).select("url", "title", "h1", "article")


@add("src_html_samples", f"""SELECT {sql_site('url')} AS site, CASE page_id % 3 WHEN 0 THEN 'LISTING PAGE' WHEN 1 THEN 'JOB DETAIL PAGE' ELSE 'UNKNOWN PAGE' END AS page_type,
  html || chr(10) AS html FROM pages""")
def src_html_samples(spark, sf_dir):
    path = scratch_path(spark, "samples")
    kind = F.element_at(F.array(F.lit("job-listing"), F.lit("job"), F.lit("page")), (F.col("page_id") % 3 + 1).cast("int"))
    files = table(spark, sf_dir, "pages").select(site_key(F.col("url")).alias("site"), kind.alias("name"), "html")
    # One file per page, which the text writer names itself, in a folder per site and kind: to list a folder per page
    # costs a task each. Tasks put their files in place, as the driver would do it one by one.
    writer = files.write.partitionBy("site", "name").option("maxRecordsPerFile", 1)
    writer.option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)
    found = readers.read_html_files(spark, path, "*.txt", "/site=([^/]+)/", "/name=([^/]+)/")
    return found.select("site", "page_type", "html")


@add("sink_jobs", twin("SELECT page_id, title, location, posted_date, 'board' AS site FROM {jobs}", jobs=JOB_PAGES))
def sink_jobs(spark, sf_dir):
    path = scratch_path(spark, "jobs")
    docs = N.with_doc(derived(spark, sf_dir, JOB_PAGES).select("url", "html"))
    sinks.write_jobs(jobs.job_records(docs), path)
    back = spark.read.parquet(path)
    return back.select(
        F.col("jobId").cast("bigint").alias("page_id"), "title", "location", F.col("postedDate").alias("posted_date"), "site"
    )


@add("sink_jobs_repeated", twin("""SELECT run_id, 'b' || page_id % 7 AS site, page_id, title FROM {jobs}, (SELECT unnest(['r1', 'r2']) AS run_id) runs
WHERE run_id = 'r2' OR page_id % 7 < 5""", jobs=JOB_PAGES))
def sink_jobs_repeated(spark, sf_dir):
    """Two runs, both written twice; the first one with fewer sites at last."""
    path = scratch_path(spark, "jobs")
    found = derived(spark, sf_dir, JOB_PAGES).select("page_id", "title", F.concat(F.lit("b"), F.col("page_id") % 7).alias("subdomain"))
    for run_id, rows in (("r1", found), ("r2", found), ("r1", found.filter("page_id % 7 < 5")), ("r2", found)):
        sinks.write_jobs(rows, path, run_id=run_id)
    return spark.read.parquet(path).select("run_id", "site", "page_id", "title")


@add("sink_quarantine", twin(f"""SELECT url, {sql_site('url')} AS site, error_type, CASE WHEN status_code >= 400 THEN 'HTTP ' || status_code || ' error' ELSE 'Detected error pattern: ' || error_type END AS error_message,
  coalesce(CAST(status_code AS VARCHAR), 'N/A') AS http_status, {sql_site('url')} || '-' || lower(error_type) || '-2024-05-06T07-08-09-000Z' AS sample_name, length(html) AS n_chars
FROM (SELECT *, coalesce({STATUS_TYPES}, {MARK_TYPES}) AS error_type FROM {{marked}}) WHERE error_type IS NOT NULL""", marked=MARKED_PAGES))
def sink_quarantine(spark, sf_dir):
    path = scratch_path(spark, "quarantine")
    bad = G.quarantine(G.page_gate(marked(spark, sf_dir)))
    stamped = bad.withColumn("fetched_at", F.lit("2024-05-06 07:08:09").cast("timestamp"))
    sinks.write_quarantine(sinks.quarantine_rows(stamped, captured_at="fetched_at"), path)
    return spark.read.parquet(path).select(
        "url", "site", "error_type", "error_message", "http_status", "sample_name", F.length("html").cast("bigint").alias("n_chars")
    )


@add("sink_gated", twin(f"""SELECT page_id, coalesce({STATUS_TYPES}, {MARK_TYPES}, 'PASS') AS verdict FROM {{marked}}""", marked=MARKED_PAGES))
def sink_gated(spark, sf_dir):
    path = scratch_path(spark, "gated")
    sinks.write_gated(G.page_gate(marked(spark, sf_dir)), path)
    return spark.read.parquet(path).select("page_id", "verdict")


REPORT = f"""SELECT host, CASE WHEN hash_pick = 0 THEN error || ', see "log"' || chr(10) || ' next' ELSE error END AS error, status, total_jobs FROM (
  SELECT *, CAST(replace(replace(host, 'h', ''), '.example.net', '') AS BIGINT) % 3 AS hash_pick FROM ({CHECKS}))"""


@add("sink_csv", REPORT)
def sink_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    rows = checks(spark, sf_dir).withColumn(
        "error",
        F.when(F.col("pos") % 3 == 0, F.concat("error", F.lit(', see "log"\n next'))).otherwise(F.col("error")),
    )
    sinks.write_csv(rows.select("host", "status", "total_jobs", "error", "pos"), path, host_order())
    back = sinks.read_csv(spark, path, "host string, status string, total_jobs bigint, error string, pos bigint")
    return back.select("host", "error", "status", "total_jobs")


@add("sink_dataset_csv", f"SELECT domain, url, status FROM ({ENTRY_VERDICTS})")
def sink_dataset_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    rows = entry_verdicts(spark, sf_dir).select("domain", "url", "status", "page_id")
    sinks.write_csv(rows, path, dataset_order("page_id"))
    back = sinks.read_csv(spark, path, "domain string, url string, status string, page_id bigint")
    return back.select("domain", "url", "status")


@add("sink_host_json", f"SELECT host FROM ({CHECKS}) WHERE status = 'working' AND (total_jobs IS NULL OR total_jobs > 0)")
def sink_host_json(spark, sf_dir):
    path = scratch_path(spark, "json")
    sinks.write_hosts(valid_hosts(checks(spark, sf_dir)), path)
    return readers.read_host_list(spark, path).select("host")


@add("sink_host_list", f"""SELECT DISTINCT host FROM (SELECT string_split(url, '/')[3] AS host FROM pages UNION ALL SELECT host FROM ({twin(HOSTS)}))
WHERE ends_with(host, '.example.net')""")
def sink_host_list(spark, sf_dir):
    path = scratch_path(spark, "json")
    found = seeds.host_union(seeds.url_hosts(table(spark, sf_dir, "pages", "url")), derived(spark, sf_dir, HOSTS))
    sinks.write_hosts(seeds.host_suffix_filter(found, ".example.net"), path)
    return readers.read_host_list(spark, path).select("host")
