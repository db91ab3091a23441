"""Hosts and start URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls


def url_hosts(lines: DataFrame, url: str = "url") -> DataFrame:
    """Distinct host tokens of a URL list."""
    return (
        lines.select(urls.host_token(F.col(url)).alias("host"))
        .filter(F.col("host").isNotNull())
        .distinct()
    )


def host_suffix_filter(hosts: DataFrame, suffix: str, host: str = "host") -> DataFrame:
    return hosts.filter(urls.host_has_suffix(F.col(host), suffix))


def host_exclude_filter(
    hosts: DataFrame, patterns: Sequence[str] = urls.EXCLUDED_HOSTS, host: str = "host"
) -> DataFrame:
    return hosts.filter(~urls.host_is_excluded(F.col(host), patterns))


def host_union(left: DataFrame, right: DataFrame, host: str = "host", ignore_case: bool = False) -> DataFrame:
    """Distinct hosts of two sources."""
    both = left.select(host).unionByName(right.select(host))
    if ignore_case:
        both = both.select(F.lower(host).alias(host))
    return both.distinct()


def seed_urls(domains: DataFrame, path: str = urls.LISTING_PATH, domain: str = "domain") -> DataFrame:
    return domains.select(urls.seed_url(F.col(domain), path).alias("url"))


def seed_union(domain_urls: DataFrame, start_urls: DataFrame, default_url: str) -> DataFrame:
    """Both lists one after the other, or the default when both are empty."""
    both = domain_urls.select("url").unionByName(start_urls.select("url"))
    # One row is enough to know that there are seeds.
    empty = both.limit(1).agg(F.count("*").alias("n")).filter("n = 0")
    return both.unionByName(empty.select(F.lit(default_url).alias("url")))


def label_start_urls(start_urls: DataFrame, url: str = "url") -> DataFrame:
    """Add the route label; a start URL without one counts as a listing."""
    return start_urls.withColumn(
        "label", F.coalesce(urls.route_label(F.col(url)), F.lit(urls.LISTING))
    )


def crawl_budget(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows in the given order; 0 means no limit.

    Spark keeps the best ``n`` of each partition and merges them, so ``n`` is meant for a
    budget of one run (thousands), not for cutting a corpus in half.
    """
    return rows if n == 0 else rows.orderBy(*order).limit(n)
