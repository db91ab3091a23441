"""Counts, coverage, filters and sort orders of the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from .hosts import STATUSES, dataset_status

# Report order of the states.
DATASET_STATUSES = ("valid", "not_valid", "js_required")
DATASET_ORDER = ("valid", "js_required", "not_valid")
HOST_ORDER = STATUSES


def rank_of(col: Column, order: Sequence[str]) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("int"))
    for i, value in enumerate(order):
        out = out.when(col == value, F.lit(i))
    return out


def _counts(rows: DataFrame, statuses: Sequence[str], status: str) -> DataFrame:
    """One row per known status, zero counts included: one pass, one row per task shuffled."""
    totals = rows.agg(*[F.count_if(F.col(status) == s).alias(s) for s in statuses])
    pairs = F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("n")) for s in statuses])
    return totals.select(F.explode(pairs).alias("_p")).select("_p.*")


def status_counts(rows: DataFrame, status: str = "status") -> DataFrame:
    return _counts(rows, DATASET_STATUSES, status)


def host_status_counts(rows: DataFrame, status: str = "status") -> DataFrame:
    return _counts(rows, STATUSES, status)


def dataset_verdicts(entries: DataFrame) -> DataFrame:
    return entries.select(
        *[c for c in entries.columns if c not in ("url", "title", "h1", "article", "_corrupt_record")],
        urls.host_or_raw(F.col("url")).alias("domain"),
        "url",
        dataset_status(F.col("h1"), F.col("article")).alias("status"),
    )


def with_status(rows: DataFrame, wanted: str, status: str = "status") -> DataFrame:
    return rows.filter(F.col(status) == wanted)


def valid_domains(verdicts: DataFrame) -> DataFrame:
    return with_status(verdicts, "valid").select("domain")


def js_domains(verdicts: DataFrame) -> DataFrame:
    return with_status(verdicts, "js_required").select("domain")


def valid_hosts(checks: DataFrame, jobs: str = "total_jobs") -> DataFrame:
    """Working hosts, unless they state that they have no jobs."""
    return with_status(checks, "working").filter(F.col(jobs).isNull() | (F.col(jobs) > 0))


def dataset_order(pos: str = "pos", status: str = "status") -> list[Column]:
    return [rank_of(F.col(status), DATASET_ORDER), F.col(pos)]


def host_order(pos: str = "pos", status: str = "status", jobs: str = "total_jobs") -> list[Column]:
    return [
        rank_of(F.col(status), HOST_ORDER),
        F.coalesce(F.col(jobs), F.lit(0)).desc(),
        F.col(pos),
    ]


def sort_dataset_status(verdicts: DataFrame, pos: str = "pos") -> DataFrame:
    return verdicts.orderBy(*dataset_order(pos))


def sort_host_status(checks: DataFrame, pos: str = "pos") -> DataFrame:
    return checks.orderBy(*host_order(pos))


def top_hosts_by_jobs(checks: DataFrame, n: int, pos: str = "pos", jobs: str = "total_jobs") -> DataFrame:
    return (
        with_status(checks, "working")
        .filter(F.col(jobs) > 0)
        .orderBy(F.col(jobs).desc(), pos)
        .limit(n)
    )


def unique_jobs(jobs: DataFrame, site: str = "subdomain", job: str = "jobId", approximate: bool = False) -> DataFrame:
    """Distinct jobs per site and, in the row with a null site, in total.

    Distinct pairs are counted in two steps, so a site with most of the jobs is spread
    over tasks by job id first.
    """
    if approximate:
        per_site = jobs.filter(F.col(job).isNotNull()).groupBy(site).agg(
            F.approx_count_distinct(job).alias("unique_jobs")
        )
    else:
        pairs = jobs.filter(F.col(job).isNotNull()).select(site, job).distinct()
        per_site = pairs.groupBy(site).agg(F.count("*").alias("unique_jobs"))
    return _with_total(per_site, site)


def _with_total(per_site: DataFrame, site: str) -> DataFrame:
    both = F.explode(F.array(F.col(site), F.lit(None).cast("string"))).alias(site)
    return per_site.select(both, "unique_jobs").groupBy(site).agg(F.sum("unique_jobs").alias("unique_jobs"))


def job_sketches(jobs: DataFrame, site: str = "subdomain", job: str = "jobId", slots_log2: int = 14) -> DataFrame:
    """Per site a sketch of its different jobs: a few KB however many jobs, made in each task before the shuffle.

    Sketches of other runs or parts unite with it, so a run is counted once and its rows need not be
    read again. The relative error is about 0.8 / sqrt(2 ** slots_log2), a hundredth here at two deviations.
    """
    known = jobs.filter(F.col(job).isNotNull())
    return known.groupBy(site).agg(F.hll_sketch_agg(job, F.lit(slots_log2)).alias("sketch"))


def unique_jobs_of(sketches: DataFrame, site: str = "subdomain") -> DataFrame:
    """As ``unique_jobs``, from sketches of any number of runs: a job counts once for its site."""
    per_site = sketches.groupBy(site).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_jobs"))
    return _with_total(per_site, site)


def field_coverage(jobs: DataFrame, columns: Sequence[str], site: str = "subdomain") -> DataFrame:
    """Per site: number of jobs and, per column, how many have a value. One pass."""
    return jobs.groupBy(site).agg(
        F.count("*").alias("jobs"),
        *[F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).alias(f"has_{c}") for c in columns],
    )
