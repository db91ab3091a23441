"""Queries on hosts, URLs and seeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import seeds
from .base import BOARD_URLS, Family, derived, sql_base, sql_concat, sql_host, sql_join, sql_site, table, twin

family = Family()
QUERIES, SQL = family.queries, family.sql
add = family.add

COMPANY_NAMES = (r"small\s*ring", "red widget", "blue.*")


def board(spark, sf_dir):
    return derived(spark, sf_dir, BOARD_URLS)


def scalar(name, column, fn, expression):
    """A query that computes one value per board URL."""
    sql = twin(f"SELECT id, {expression} AS {column} FROM {{board}}", board=BOARD_URLS)
    family.add(name, sql)(
        lambda spark, sf_dir: board(spark, sf_dir).select("id", fn(F.col("url")).alias(column))
    )


scalar("url_host_token", "host", U.host_token, "CASE WHEN len(string_split(url, '/')) > 2 THEN string_split(url, '/')[3] END")
scalar("route_label", "label", U.route_label,
       "CASE WHEN regexp_matches(url, '(?i)/careers/jobdetail/[^/]+/[0-9]+') THEN 'JOB_DETAIL' "
       "WHEN contains(lower(url), '/careers/searchjobs') THEN 'LISTING' END")
scalar("base_url", "base", U.base_url, sql_base("url"))
scalar("site_key", "site", lambda u: U.site_key(u, invalid="unknown"), f"coalesce({sql_site('url')}, 'unknown')")
scalar("host_or_raw", "domain", U.host_or_raw, f"coalesce({sql_host('url')}, url)")
scalar("job_id", "job_id", U.job_id, "nullif(regexp_extract(url, '/([0-9]+)(?:[/?#]|$)', 1), '')")
scalar("slug_title", "title", U.slug_title,
       "replace(nullif(regexp_extract(url, '/JobDetail/([^/]+)/[0-9]+', 1), ''), '-', ' ')")


@add("url_unique_key", """
WITH u AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN replace(url, 'http', 'HTTP') || '&b=2&a=1'
      ELSE replace(url, '.example', '.EXAMPLE') || '?z=1&utm_medium=x&b=&a=3#frag' END AS url FROM pages),
p AS (SELECT page_id, url, lower(regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1)) AS origin,
      regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '/$', '') AS path,
      string_split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '&') AS params FROM u),
q AS (SELECT page_id, string_agg(param, '&' ORDER BY split_part(param, '=', 1), i) AS query FROM (
      SELECT page_id, unnest(params) AS param, generate_subscripts(params, 1) AS i FROM p)
      WHERE param <> '' AND NOT starts_with(param, 'utm_') GROUP BY page_id)
SELECT p.page_id, origin || path || coalesce('?' || query, '') AS url_key FROM p LEFT JOIN q ON p.page_id = q.page_id
""")
def url_unique_key(spark, sf_dir):
    pages = derived(spark, sf_dir, """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN replace(url, 'http', 'HTTP') || '&b=2&a=1'
  ELSE replace(url, '.example', '.EXAMPLE') || '?z=1&utm_medium=x&b=&a=3#frag' END AS url FROM {pages}""")
    return pages.select("page_id", U.url_unique_key(F.col("url")).alias("url_key"))


@add("host_suffix_filter", f"SELECT DISTINCT {sql_host('url')} AS host FROM pages WHERE ends_with({sql_host('url')}, '.example.com')")
def host_suffix_filter(spark, sf_dir):
    hosts = table(spark, sf_dir, "pages", "url").select(U.host(F.col("url")).alias("host"))
    return seeds.host_suffix_filter(hosts, ".example.com").distinct()


HOSTS = """
SELECT concat(CASE p_partkey % 16 WHEN 0 THEN 'www.' WHEN 1 THEN 'SMTP1.' WHEN 2 THEN 'uat-' WHEN 3 THEN 'uat' WHEN 4 THEN 'qa2'
  WHEN 5 THEN 'qatar' WHEN 6 THEN 'x-sso.' WHEN 7 THEN 'Sandbox' WHEN 8 THEN 'my.label-studio' WHEN 9 THEN 'label-'
  WHEN 10 THEN 'docs.' WHEN 11 THEN 'docs' WHEN 12 THEN 'api.' WHEN 13 THEN 'aintegrations.' WHEN 14 THEN 'latest' ELSE '' END,
  replace(lower(p_brand), '#', ''), '-', p_partkey, '.example.net') AS host, p_partkey AS pos FROM {part}"""


# Which of the sixteen kinds of host names are to stay.
@add("host_exclude_filter", twin("SELECT host FROM {hosts} WHERE pos % 16 IN (3, 5, 11, 14, 15)", hosts=HOSTS))
def host_exclude_filter(spark, sf_dir):
    return seeds.host_exclude_filter(derived(spark, sf_dir, HOSTS)).select("host")


@add("first_n_hosts", twin("""
SELECT host FROM {hosts} WHERE pos % 16 IN (3, 5, 11, 14, 15) ORDER BY pos LIMIT 20
""", hosts=HOSTS))
def first_n_hosts(spark, sf_dir):
    hosts = seeds.host_exclude_filter(derived(spark, sf_dir, HOSTS))
    return seeds.crawl_budget(hosts, 20, "pos").select("host")


@add("listing_url_build", twin("SELECT host, 'https://' || host || '/careers/SearchJobs' AS listing_url FROM {hosts}", hosts=HOSTS))
def listing_url_build(spark, sf_dir):
    return derived(spark, sf_dir, HOSTS).select("host", U.listing_url(F.col("host")).alias("listing_url"))


DOMAINS = """
SELECT s_suppkey AS id, concat(CASE s_suppkey % 4 WHEN 0 THEN ' https://' WHEN 1 THEN 'http://' WHEN 2 THEN chr(160) ELSE 'HTTP://' END,
  's', s_nationkey, '.example.net', CASE s_suppkey % 3 WHEN 0 THEN '//' WHEN 1 THEN concat('/', chr(9)) ELSE '' END) AS domain FROM {supplier}"""

SEED_EXPRESSION = """'https://' || regexp_replace(regexp_replace(trim(domain, ' ' || chr(9) || chr(160)), '^https?://', ''), '/+$', '')"""


@add("seed_url_build", twin(f"SELECT id, {SEED_EXPRESSION} || '/jobs/All' AS url FROM {{domains}}", domains=DOMAINS))
def seed_url_build(spark, sf_dir):
    return derived(spark, sf_dir, DOMAINS).select("id", U.seed_url(F.col("domain"), "jobs/All").alias("url"))


@add("seed_union_default", twin(f"""
SELECT url, 'given' AS source FROM (SELECT {SEED_EXPRESSION} || '/careers/SearchJobs' AS url FROM {{domains}}
  UNION ALL SELECT url FROM pages)
UNION ALL SELECT 'https://board.example.net/careers/SearchJobs', 'default'
""", domains=DOMAINS))
def seed_union_default(spark, sf_dir):
    default = "https://board.example.net/careers/SearchJobs"
    domain_urls = seeds.seed_urls(derived(spark, sf_dir, DOMAINS))
    start_urls = table(spark, sf_dir, "pages", "url")
    both = seeds.seed_union(domain_urls, start_urls, default)
    # The same union over hosts no page has is empty and gives the default.
    none = start_urls.filter(F.col("url") == "")
    empty = seeds.seed_union(none, none, default)
    return both.withColumn("source", F.lit("given")).unionByName(empty.withColumn("source", F.lit("default")))


@add("start_label_default", twin("""
SELECT id, url, CASE WHEN regexp_matches(url, '(?i)/careers/jobdetail/[^/]+/[0-9]+') THEN 'JOB_DETAIL' ELSE 'LISTING' END AS label
FROM {board}""", board=BOARD_URLS))
def start_label_default(spark, sf_dir):
    return seeds.label_start_urls(board(spark, sf_dir).select("id", "url"))


@add("effective_url", twin("""
SELECT id, CASE WHEN id % 2 = 0 THEN 'https://moved.example.net/' || id ELSE url END AS url FROM {board}""", board=BOARD_URLS))
def effective_url(spark, sf_dir):
    loaded = F.when(F.col("id") % 2 == 0, F.concat(F.lit("https://moved.example.net/"), "id"))
    return board(spark, sf_dir).select("id", U.effective_url(loaded, F.col("url")).alias("url"))


HREFS = """
SELECT id, url, CASE id % 6 WHEN 0 THEN concat('/a/', id) WHEN 1 THEN concat('b/', id) WHEN 2 THEN concat('https://x.example.net/', id)
  WHEN 3 THEN concat('?jobOffset=', id) WHEN 4 THEN '#top' ELSE concat('HTTP://x/', id) END AS href FROM {board}"""


@add("resolve_url_join", twin(f"SELECT id, {sql_join(sql_base('url'), 'href')} AS link FROM {{hrefs}}", hrefs=twin(HREFS, board=BOARD_URLS)))
def resolve_url_join(spark, sf_dir):
    hrefs = derived(spark, sf_dir, twin_board(HREFS))
    return hrefs.select("id", U.resolve_url(U.base_url(F.col("url")), F.col("href")).alias("link"))


@add("resolve_url_concat", twin(f"SELECT id, {sql_concat(sql_base('url'), 'href')} AS link FROM {{hrefs}}", hrefs=twin(HREFS, board=BOARD_URLS)))
def resolve_url_concat(spark, sf_dir):
    hrefs = derived(spark, sf_dir, twin_board(HREFS))
    return hrefs.select("id", U.resolve_url(U.base_url(F.col("url")), F.col("href"), "concat").alias("link"))


# Links of every form on a page in a folder, and where they lead.
REFERENCES = """
SELECT p_partkey AS id, concat('https://b', p_size, '.example.net:8443/a/b/page;x?old=', p_size, '#old') AS page, CASE p_partkey % 16
  WHEN 0 THEN concat('//o', p_size, '.example.net/') WHEN 1 THEN concat('?jobOffset=', p_size) WHEN 2 THEN concat('  ../c/', p_size, ' ') WHEN 3 THEN concat('./', p_size, '/.')
  WHEN 4 THEN concat('/x/./y/../', p_size) WHEN 5 THEN concat('../../../../', p_size) WHEN 6 THEN concat('#part', p_size) WHEN 7 THEN '' WHEN 8 THEN concat('g;k=', p_size, '/../h')
  WHEN 9 THEN concat('mailto:a', p_size, '@example.net') WHEN 10 THEN concat('HTTPS://x.example.net/./a/../b?q=/../', p_size) WHEN 11 THEN concat('c//d/../', p_size)
  WHEN 12 THEN '..' WHEN 13 THEN concat('.hidden/..', p_size) WHEN 14 THEN concat('a:b/', p_size) ELSE concat('c?x=../', p_size, '#../y') END AS href, p_size FROM {part}"""


@add("resolve_url_standard", twin("""
SELECT id, concat(CASE WHEN id % 16 NOT IN (0, 9, 10, 14) THEN concat('https://b', p_size, '.example.net:8443') ELSE '' END, CASE id % 16
  WHEN 0 THEN concat('https://o', p_size, '.example.net/') WHEN 1 THEN concat('/a/b/page;x?jobOffset=', p_size) WHEN 2 THEN concat('/a/c/', p_size) WHEN 3 THEN concat('/a/b/', p_size, '/')
  WHEN 4 THEN concat('/x/', p_size) WHEN 5 THEN concat('/', p_size) WHEN 6 THEN concat('/a/b/page;x?old=', p_size, '#part', p_size) WHEN 7 THEN concat('/a/b/page;x?old=', p_size)
  WHEN 8 THEN '/a/b/h' WHEN 9 THEN concat('mailto:a', p_size, '@example.net') WHEN 10 THEN concat('HTTPS://x.example.net/b?q=/../', p_size) WHEN 11 THEN concat('/a/b/c//', p_size)
  WHEN 12 THEN '/a/' WHEN 13 THEN concat('/a/b/.hidden/..', p_size) WHEN 14 THEN concat('a:b/', p_size) ELSE concat('/a/b/c?x=../', p_size, '#../y') END) AS link
FROM {refs}""", refs=REFERENCES))
def resolve_url_standard(spark, sf_dir):
    refs = derived(spark, sf_dir, REFERENCES)
    return refs.select("id", U.resolve_url(F.col("page"), F.col("href"), "standard").alias("link"))



def twin_board(sql: str) -> str:
    return sql.replace("{board}", "(" + BOARD_URLS + ")")


@add("is_company_name", """
SELECT p_partkey AS id, regexp_matches(trim(title), '(?i)^(?:small *ring|red widget|blue.*)$') AS is_company FROM (
  SELECT p_partkey, ' ' || upper(p_name) || CASE WHEN p_partkey % 5 = 0 THEN ' X ' ELSE '  ' END AS title FROM part)""")
def is_company_name(spark, sf_dir):
    tail = F.when(F.col("p_partkey") % 5 == 0, " X ").otherwise("  ")
    title = F.concat(F.lit(" "), F.upper("p_name"), tail)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), U.is_company_name(title, COMPANY_NAMES).alias("is_company")
    )


# A budget that cuts, and one of 0, which does not.
@add("crawl_budget", "SELECT page_id, url, 40 AS n FROM (SELECT * FROM pages ORDER BY page_id LIMIT 40) UNION ALL SELECT page_id, url, 0 FROM pages")
def crawl_budget(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    cut, whole = (seeds.crawl_budget(pages, n, "page_id").withColumn("n", F.lit(n)) for n in (40, 0))
    return cut.unionByName(whole)


@add("host_union", f"""
SELECT lower(host) AS host FROM (SELECT string_split(url, '/')[3] AS host FROM pages)
UNION SELECT lower(host) FROM ({twin(HOSTS)})""")
def host_union(spark, sf_dir):
    first = seeds.url_hosts(table(spark, sf_dir, "pages", "url"))
    return seeds.host_union(first, derived(spark, sf_dir, HOSTS), ignore_case=True)
