"""Queries on links, cards and the frontier."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import nodes as N
from ..functions import urls as U
from ..session import scratch_path
from ..sources.seen import SeenTable
from ..operators import hosts, jobs, links
from .base import (
    ATTEMPTS, JOB_PAGES, LISTING_PAGES, Family, derived, sql_base, sql_join, sql_markup,
    sql_site, table, twin,
)

family = Family()
QUERIES, SQL = family.queries, family.sql
add = family.add

# Anchors of the given pages: href values are always in double quotes there.
ANCHORS = f"""SELECT page_id, url, pos, regexp_extract(piece, '^[^>]*\\bhref="([^"]*)"', 1) AS href,
  trim(regexp_replace(regexp_extract(piece, '(?is)^[^>]*>(.*?)(?:</a>|$)', 1), '<[^>]+>', '', 'g')) AS text FROM (
  SELECT page_id, url, unnest(pieces) AS piece, generate_subscripts(pieces, 1) - 1 AS pos FROM (
    SELECT page_id, url, string_split_regex({sql_markup('html')}, '(?i)<a\\s')[2:] AS pieces FROM pages))"""


@add("anchors", f"SELECT page_id, pos, href, text FROM ({ANCHORS})")
def anchors(spark, sf_dir):
    return links.anchors(table(spark, sf_dir, "pages")).select("page_id", "pos", "href", "text")


@add("anchors_per_site", f"SELECT {sql_site('url')} AS site, count(*) AS links, count(DISTINCT {sql_join(sql_base('url'), 'href')}) AS targets FROM ({ANCHORS}) GROUP BY 1")
def anchors_per_site(spark, sf_dir):
    found = links.anchors(table(spark, sf_dir, "pages"))
    link = U.resolve_url(U.base_url(F.col("url")), F.col("href"))
    return (
        found.select(U.site_key(F.col("url")).alias("site"), link.alias("link"))
        .groupBy("site", "link").agg(F.count("*").alias("n"))
        .groupBy("site").agg(F.sum("n").alias("links"), F.count("*").alias("targets"))
    )


@add("page_nodes", f"""WITH m AS (SELECT page_id, {sql_markup('html')} AS h FROM pages), t AS (SELECT unnest(['a', 'article', 'b', 'body', 'br', 'div', 'footer', 'h1', 'head', 'html', 'li', 'meta', 'nav', 'p', 'title', 'ul']) AS tag)
SELECT page_id, tag, len(regexp_extract_all(h, '<' || tag || '[ >]')) AS n FROM m, t WHERE n > 0""")
def page_nodes(spark, sf_dir):
    nodes = N.page_nodes(table(spark, sf_dir, "pages"))
    return nodes.groupBy("page_id", "tag").agg(F.count("*").alias("n"))


def listing(spark, sf_dir):
    return derived(spark, sf_dir, LISTING_PAGES)


def cards(spark, sf_dir):
    return links.listing_cards(N.with_doc(listing(spark, sf_dir).select("page_id", "url", "html")))


CARDS = """SELECT c_custkey AS page_id, 0 AS pos, 'https://board.example.net/careers/JobDetail/part-' || c_custkey || '/' || c_custkey AS url, c_name || ' & more' AS title FROM customer
UNION ALL SELECT c_custkey, 1, 'https://board.example.net/careers/JobDetail/part-' || (c_custkey + 1) || '/' || (c_custkey + 1), 'Second ' || c_custkey FROM customer
UNION ALL SELECT c_custkey, 2, 'https://board.example.net/careers/JobDetail/part-' || c_custkey || '/' || c_custkey, 'Repeated' FROM customer
UNION ALL SELECT c_custkey, 3, 'https://board.example.net/careers/JobDetail/part-' || (c_custkey + 2) || '/' || (c_custkey + 2), 'Third' FROM customer"""


@add("listing_cards", CARDS)
def listing_cards(spark, sf_dir):
    return cards(spark, sf_dir).select("page_id", "pos", "url", "title")


@add("card_dedupe", f"SELECT * FROM ({CARDS}) WHERE pos <> 2")
def card_dedupe(spark, sf_dir):
    return links.page_cards(N.with_doc(listing(spark, sf_dir).select("page_id", "url", "html"))).select("page_id", "pos", "url", "title")


@add("card_subtitles", """SELECT c_custkey AS page_id, 0 AS pos, 'location' AS key, c_mktsegment || ' Office' AS value FROM customer
UNION ALL SELECT c_custkey, 0, 'ref', 'REF #' || c_custkey FROM customer
UNION ALL SELECT c_custkey, 1, 'default', 'Just text ' || c_nationkey FROM customer
UNION ALL SELECT c_custkey, 3, 'workingTime', 'Part time' FROM customer""")
def card_subtitles(spark, sf_dir):
    return links.card_subtitles(cards(spark, sf_dir))


PAGINATION = """SELECT c_custkey AS page_id, 0 AS pos, 'https://board.example.net/careers/SearchJobs/?jobOffset=' || (c_custkey + 20) AS url, 'LISTING' AS label FROM customer
UNION ALL SELECT c_custkey, 1, 'https://board.example.net/?pageNumber=' || c_nationkey || '&x=1', 'LISTING' FROM customer
UNION ALL SELECT c_custkey, 2, 'https://board.example.net/n/?pageNumber=' || c_custkey, 'LISTING' FROM customer
UNION ALL SELECT c_custkey, 3, 'https://board.example.net/b/?jobOffset=9', 'LISTING' FROM customer"""


@add("pagination_links", PAGINATION)
def pagination_links(spark, sf_dir):
    return links.pagination_links(listing(spark, sf_dir))


# The given pages with two job links and a search link, in place of what follows the nav.
UNROUTED = """SELECT page_id, url, replace(html, '</nav>', concat('<a href="/x/JobDetail/a/', page_id, '">j</a><a href=''JobDetail/', page_id, '/2''>j2</a>',
  '<a data-href="/JobDetail/z/1" href="/x/JobDetail/a/', page_id, '">again</a><p class="visibility--hidden--visually"><a href="/x/JobDetail/h/1">h</a></p>',
  '<noscript><a href="/x/JobDetail/n/', page_id, '">n</a></noscript><a href="https://h.example.net/SearchJobs">s</a></nav>')) AS html FROM {pages}"""
FALLBACK_JOBS = f"""SELECT page_id, 0 AS pos, {sql_base('url')} || '/x/JobDetail/a/' || page_id AS url, 'JOB_DETAIL' AS label FROM pages
UNION ALL SELECT page_id, 1, {sql_base('url')} || '/x/JobDetail/n/' || page_id, 'JOB_DETAIL' FROM pages"""
FALLBACK_LISTING = "SELECT page_id, 0 AS pos, 'https://h.example.net/SearchJobs' AS url, 'LISTING' AS label FROM pages"


@add("fallback_job_links", FALLBACK_JOBS)
def fallback_job_links(spark, sf_dir):
    return links.fallback_job_links(derived(spark, sf_dir, UNROUTED))


@add("fallback_listing_links", FALLBACK_LISTING)
def fallback_listing_links(spark, sf_dir):
    return links.fallback_listing_links(derived(spark, sf_dir, UNROUTED))


@add("route_dispatch", f"""SELECT page_id, url, label FROM ({PAGINATION}) UNION ALL SELECT page_id, url, label FROM ({FALLBACK_JOBS})
UNION ALL SELECT page_id, url, label FROM ({FALLBACK_LISTING})""")
def route_dispatch(spark, sf_dir):
    columns = ("page_id", "url", "html")
    pages = (
        listing(spark, sf_dir).select(*columns)
        .unionByName(derived(spark, sf_dir, JOB_PAGES).select(*columns))
        .unionByName(derived(spark, sf_dir, UNROUTED).select(*columns))
    )
    return links.route_links(pages).select("page_id", "url", "label")


@add("frontier_new_links", f"""
WITH l AS (SELECT {sql_join(sql_base('url'), 'href')} AS url FROM ({ANCHORS}) UNION ALL SELECT url FROM pages),
k AS (SELECT url, rtrim(regexp_replace(regexp_replace(url, '#.*$', ''), '[?]utm_source=feed$', ''), '/') AS url_key FROM l),
s AS (SELECT rtrim(regexp_replace(regexp_replace(url, '#.*$', ''), '[?]utm_source=feed$', ''), '/') AS url_key FROM pages WHERE starts_with(url, 'https:'))
SELECT url_key, min(url) AS url FROM k WHERE url_key NOT IN (SELECT url_key FROM s) GROUP BY url_key""")
def frontier_new_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = links.anchors(pages).select(U.resolve_url(U.base_url(F.col("url")), F.col("href")).alias("url"))
    every = found.unionByName(pages.select("url"))
    seen = pages.filter(F.startswith("url", F.lit("https:"))).select("url")
    return links.frontier_new_links(every, seen)


ROUND_LINKS = f"SELECT page_id % 3 + 1 AS round, {sql_join(sql_base('url'), 'href')} AS url FROM ({ANCHORS}) UNION ALL SELECT page_id % 3 + 1 AS round, url FROM pages"


@add("frontier_rounds", f"""
WITH k AS (SELECT round, url, rtrim(regexp_replace(regexp_replace(url, '#.*$', ''), '[?]utm_source=feed$', ''), '/') AS url_key FROM ({ROUND_LINKS})),
f AS (SELECT url_key, min(round) AS round FROM k GROUP BY url_key)
SELECT f.round, f.url_key, min(k.url) AS url FROM f JOIN k ON f.url_key = k.url_key AND f.round = k.round GROUP BY ALL""")
def frontier_rounds(spark, sf_dir):
    """A crawl of three rounds against its table of seen URLs, compacted after the second."""
    pages = table(spark, sf_dir, "pages")
    found = links.anchors(pages).select("page_id", U.resolve_url(U.base_url(F.col("url")), F.col("href")).alias("url"))
    every = found.unionByName(pages.select("page_id", "url")).withColumn("round", F.col("page_id") % 3 + 1)
    seen = SeenTable(spark, scratch_path(spark, "seen"), spark.sparkContext.defaultParallelism)
    out = scratch_path(spark, "rounds")
    for turn in (1, 2, 3):
        seen.new_links(every.filter(F.col("round") == turn), turn).write.parquet(f"{out}/round={turn}")
        seen.add(spark.read.parquet(f"{out}/round={turn}"), turn)
        if turn == 2:
            seen.compact()
    return spark.read.parquet(out).select(F.col("round").cast("bigint").alias("round"), "url_key", "url")


@add("job_link_count", twin("SELECT event_id, CASE WHEN kind = 18 THEN 2 ELSE 0 END AS n FROM {attempts}", attempts=ATTEMPTS))
def job_link_count(spark, sf_dir):
    pages = derived(spark, sf_dir, ATTEMPTS)
    return pages.select("event_id", hosts.job_link_count(H.visible_markup(F.col("html"))).alias("n"))


APPLY_PAGES = """SELECT s_suppkey AS page_id, concat('https://board.example.net:8443/careers/JobDetail/x/', s_suppkey) AS url, concat('<body><a>Apply</a><a href="/x">no</a>',
  CASE s_suppkey % 5 WHEN 0 THEN concat('<a href="/m/ApplicationMethods?id=', s_suppkey, '">go</a>') WHEN 1 THEN concat('<a href="/b/', s_suppkey, '"><i>Apply</i> now</a>')
    WHEN 2 THEN concat('<a class="x button--primary" href="c/', s_suppkey, '">go</a>') WHEN 3 THEN concat('<a href="https://e.example.net/apply&amp;id=', s_suppkey, '">go</a>')
    ELSE '<a href="/APPLY">APPLY</a>' END, '<a href="/d">or apply here</a></body>') AS html FROM {supplier}"""


@add("apply_url", """SELECT s_suppkey AS page_id, CASE s_suppkey % 5 WHEN 0 THEN 'https://board.example.net:8443/m/ApplicationMethods?id=' || s_suppkey
  WHEN 1 THEN 'https://board.example.net:8443/b/' || s_suppkey WHEN 2 THEN 'https://board.example.net:8443c/' || s_suppkey
  WHEN 3 THEN 'https://e.example.net/apply&id=' || s_suppkey ELSE 'https://board.example.net:8443/d' END AS apply_url FROM supplier""")
def apply_url(spark, sf_dir):
    docs = N.with_doc(derived(spark, sf_dir, APPLY_PAGES))
    return docs.select("page_id", links.apply_url(F.col("doc"), F.col("url")).alias("apply_url"))


def card_jobs(spark, sf_dir):
    """Detail pages with the card of the listing page that names them first."""
    pages = derived(spark, sf_dir, JOB_PAGES).select("page_id", "url", "html")
    return jobs.card_job_join(pages, cards(spark, sf_dir))


# Listing page k names part k and part k + 1, and part k + 2 as a third.
FIRST_CARDS = """SELECT p.p_partkey AS page_id,
  CASE WHEN c2.c_custkey IS NOT NULL THEN 'Third' WHEN c1.c_custkey IS NOT NULL THEN 'Second ' || c1.c_custkey WHEN c0.c_custkey IS NOT NULL THEN c0.c_name || ' & more' END AS card_title,
  CASE WHEN c2.c_custkey IS NOT NULL OR c1.c_custkey IS NOT NULL THEN NULL WHEN c0.c_custkey IS NOT NULL THEN c0.c_mktsegment || ' Office' END AS card_location,
  CASE WHEN c2.c_custkey IS NOT NULL THEN 'Part time' END AS card_time,
  CASE WHEN c2.c_custkey IS NULL AND c1.c_custkey IS NULL AND c0.c_custkey IS NOT NULL THEN c0.c_custkey END AS card_ref
FROM part p LEFT JOIN customer c0 ON c0.c_custkey = p.p_partkey LEFT JOIN customer c1 ON c1.c_custkey = p.p_partkey - 1
  LEFT JOIN customer c2 ON c2.c_custkey = p.p_partkey - 2"""


@add("card_job_join", f"SELECT page_id, card_title, card_location, card_time FROM ({FIRST_CARDS})")
def card_job_join(spark, sf_dir):
    card = F.col("card")
    return card_jobs(spark, sf_dir).select(
        "page_id",
        card["title"].alias("card_title"),
        F.try_element_at(card["subtitles"], F.lit("location")).alias("card_location"),
        F.try_element_at(card["subtitles"], F.lit("workingTime")).alias("card_time"),
    )
