"""Queries on the page gate and the host check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import nodes as N
from ..functions.text import decode_entities
from ..operators import gate as G
from ..operators import hosts
from ..operators.report import dataset_verdicts
from .base import (
    ATTEMPT_VERDICTS, ATTEMPTS, HOST_CHECKS, LISTING_PAGES, Family, derived, sql_host, table, twin,
)

family = Family()
QUERIES, SQL = family.queries, family.sql
add = family.add

# Pages with a status, and one error sentence for each pattern put into the body.
MARKED_PAGES = """
SELECT page_id, url, CAST(CASE page_id % 11 WHEN 0 THEN 404 WHEN 1 THEN 401 WHEN 2 THEN 403 WHEN 3 THEN 429 WHEN 4 THEN 499 WHEN 5 THEN 503
    WHEN 6 THEN 418 WHEN 7 THEN NULL ELSE 200 END AS INT) AS status_code,
  CASE WHEN page_id % 31 >= 25 THEN html ELSE replace(html, '<body>', concat('<body><p>', CASE page_id % 31
    WHEN 0 THEN 'Page<b> not</b> found' WHEN 1 THEN 'A 404 error' WHEN 2 THEN 'It was Not&nbsp;Found' WHEN 3 THEN 'Access  denied' WHEN 4 THEN 'Forbidden!'
    WHEN 5 THEN '403 Error' WHEN 6 THEN 'Unauthorized' WHEN 7 THEN '401error' WHEN 8 THEN 'Login required' WHEN 9 THEN 'Sign in required'
    WHEN 10 THEN 'Authentication required' WHEN 11 THEN 'Session expired' WHEN 12 THEN 'Internal server error' WHEN 13 THEN '500 error'
    WHEN 14 THEN 'Service unavailable' WHEN 15 THEN '503 error' WHEN 16 THEN 'Temporarily unavailable' WHEN 17 THEN 'Maintenance'
    WHEN 18 THEN 'Under construction' WHEN 19 THEN 'Job has been filled' WHEN 20 THEN 'Position is no longer available'
    WHEN 21 THEN 'This posting was not, yet this posting has been removed' WHEN 22 THEN 'Multiple users connecting from your IP' WHEN 23 THEN 'Rate limit'
    ELSE 'Too many requests' END, '</p>')) END AS html
FROM {pages}"""

MARK_TYPES = """CASE WHEN page_id % 31 < 3 THEN 'PAGE_NOT_FOUND' WHEN page_id % 31 < 6 THEN 'ACCESS_DENIED' WHEN page_id % 31 < 8 THEN 'UNAUTHORIZED'
  WHEN page_id % 31 < 11 THEN 'AUTH_REQUIRED' WHEN page_id % 31 = 11 THEN 'SESSION_EXPIRED' WHEN page_id % 31 < 14 THEN 'SERVER_ERROR'
  WHEN page_id % 31 < 17 THEN 'SERVICE_UNAVAILABLE' WHEN page_id % 31 < 19 THEN 'MAINTENANCE' WHEN page_id % 31 < 22 THEN 'JOB_CLOSED'
  WHEN page_id % 31 = 22 THEN 'PROXY_RATE_LIMITED' WHEN page_id % 31 < 25 THEN 'RATE_LIMITED' END"""

STATUS_TYPES = """CASE WHEN status_code = 401 THEN 'UNAUTHORIZED' WHEN status_code = 403 THEN 'ACCESS_DENIED' WHEN status_code = 404 THEN 'PAGE_NOT_FOUND'
  WHEN status_code = 429 THEN 'RATE_LIMITED' WHEN status_code = 499 THEN 'PROXY_RATE_LIMITED' WHEN status_code >= 500 THEN 'SERVER_ERROR'
  WHEN status_code >= 400 THEN 'HTTP_ERROR' END"""

GATED = f"""SELECT page_id, url, status_code, coalesce({STATUS_TYPES}, {MARK_TYPES}) AS error_type,
  CASE WHEN status_code >= 400 THEN 'HTTP ' || status_code || ' error' ELSE 'Detected error pattern: ' || ({MARK_TYPES}) END AS error_message
  FROM {{marked}}"""


def marked(spark, sf_dir):
    return derived(spark, sf_dir, MARKED_PAGES)


@add("http_error_type", twin(f"""SELECT page_id, {STATUS_TYPES} AS error_type,
  CASE WHEN status_code >= 400 THEN 'HTTP ' || status_code || ' error' END AS message FROM {{marked}}""", marked=MARKED_PAGES))
def http_error_type(spark, sf_dir):
    code = F.col("status_code")
    return marked(spark, sf_dir).select(
        "page_id", G.http_error_type(code).alias("error_type"), G.http_error_message(code).alias("message")
    )


@add("page_title_text", "SELECT page_id, trim(regexp_extract(html, '(?i)<title[^>]*>([^<]*)</title>', 1)) AS title FROM pages")
def page_title_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", H.title_text(F.col("html")).alias("title"))


@add("body_text_5000", """SELECT page_id, substring(regexp_replace(regexp_extract(html, '(?is)<body[^>]*>(.*?)</body>', 1), '<[^>]+>', ' ', 'g'), 1, 5000) AS body_text
FROM pages""")
def body_text_5000(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", H.body_text(F.col("html"), "tags", G.TEXT_LIMIT).alias("body_text")
    )


@add("content_error_type", twin(f"SELECT page_id, {MARK_TYPES} AS error_type FROM {{marked}}", marked=MARKED_PAGES))
def content_error_type(spark, sf_dir):
    return marked(spark, sf_dir).select("page_id", G.content_error_type(F.col("html")).alias("error_type"))


# The same sentences in pages without a written body, with a body tag in a head script, and behind 6,000 characters.
ODD_PAGES = f"""SELECT page_id, url, status_code, CASE page_id % 3 WHEN 0 THEN regexp_replace(html, '</?body>', '')
  WHEN 1 THEN replace(html, '<head>', '<head><script>var t = "<body>x</body>";</script>')
  ELSE replace(html, '<body>', concat('<body><p>', repeat('lorem ', 1000), '</p>')) END AS html FROM ({MARKED_PAGES})"""


@add("content_error_type_odd", twin(f"SELECT page_id, {MARK_TYPES} AS error_type FROM {{marked}}", marked=MARKED_PAGES))
def content_error_type_odd(spark, sf_dir):
    return derived(spark, sf_dir, ODD_PAGES).select("page_id", G.content_error_type(F.col("html")).alias("error_type"))


@add("content_error_type_5000", twin(f"SELECT page_id, CASE WHEN page_id % 3 < 2 THEN {MARK_TYPES} END AS error_type FROM {{marked}}", marked=MARKED_PAGES))
def content_error_type_5000(spark, sf_dir):
    pages = derived(spark, sf_dir, ODD_PAGES)
    return pages.select("page_id", G.content_error_type(F.col("html"), text_limit=G.TEXT_LIMIT).alias("error_type"))


# The same sentences where something is never closed: the rest of such a page shows nothing.
BROKEN_PAGES = f"""SELECT page_id, url, status_code, concat(replace(replace(html, '</body>', ''), '</html>', ''), CASE page_id % 5
  WHEN 0 THEN '<!-- page not found' WHEN 1 THEN '<p title="forbidden' WHEN 2 THEN '<!forbidden' WHEN 3 THEN concat('<style>', repeat('<!-- ', 50))
  ELSE concat('<!-- x', repeat(' <!-- forbidden <p>', 50)) END) AS html FROM ({MARKED_PAGES})"""


@add("content_error_type_broken", twin(f"SELECT page_id, {MARK_TYPES} AS error_type FROM {{marked}}", marked=MARKED_PAGES))
def content_error_type_broken(spark, sf_dir):
    return derived(spark, sf_dir, BROKEN_PAGES).select("page_id", G.content_error_type(F.col("html")).alias("error_type"))


# Text between what is not shown, and each kind of end that is never closed.
BROKEN_TEXTS = """SELECT p_partkey AS page_id, p_name, p_type, p_brand, p_size, concat('<html><head><script>var a = "<b>" + "<!--";</script><style>p > b</style></head><body>',
  '<p title="1 > 0">', p_name, '</p><!-- gone <p>', p_brand, ' --><noscript>', p_brand, '</noscript><div>', p_type, ' 1 < 2 &eacute;&ensp;&amp;lt;&#8364;</div>',
  CASE p_partkey % 6 WHEN 0 THEN concat('<!-- never <p>', p_brand) WHEN 1 THEN concat('<script>never <p>', p_brand) WHEN 2 THEN concat('<p title="', p_brand)
    WHEN 3 THEN concat('<style media=x', p_brand) WHEN 4 THEN concat('<noscript><p>', p_brand) ELSE concat('</p>', p_size) END) AS html FROM {part}"""


@add("visible_text", twin("""SELECT page_id, concat(p_name, p_type, ' 1 < 2 é', chr(8194), '&lt;€', CASE WHEN page_id % 6 = 5 THEN concat('', p_size) ELSE '' END) AS text,
  text AS reader_text FROM {broken}""", broken=BROKEN_TEXTS))
def visible_text(spark, sf_dir):
    pages = derived(spark, sf_dir, BROKEN_TEXTS).select("page_id", H.visible_text(F.col("html")).alias("text"), "html")
    return N.with_doc(pages).select("page_id", "text", N.page_text(F.col("doc")).alias("reader_text"))


# Character references as pages write them: named, rare, without a semicolon, numbers of both kinds, none.
REFERENCES = """SELECT p_partkey AS id, p_name, concat(p_name, CASE p_partkey % 12 WHEN 0 THEN '&ensp;x' WHEN 1 THEN '&eacute;x' WHEN 2 THEN '&copy2024' WHEN 3 THEN '&#8364;x'
  WHEN 4 THEN '&#x1F600x' WHEN 5 THEN '&amp;eacute;' WHEN 6 THEN '&unknown;' WHEN 7 THEN '&#0;&#128;' WHEN 8 THEN '&notit;' WHEN 9 THEN 'a & b &&lt;'
  WHEN 10 THEN '&NotEqualTilde;' ELSE '&;&#;&#xg' END) AS written FROM {part}"""


@add("decoded_references", twin("""SELECT id, concat(p_name, CASE id % 12 WHEN 0 THEN concat(chr(8194), 'x') WHEN 1 THEN 'éx' WHEN 2 THEN '©2024' WHEN 3 THEN '€x'
  WHEN 4 THEN concat(chr(128512), 'x') WHEN 5 THEN '&eacute;' WHEN 6 THEN '&unknown;' WHEN 7 THEN concat(chr(65533), '€') WHEN 8 THEN '¬it;' WHEN 9 THEN 'a & b &<'
  WHEN 10 THEN concat(chr(8770), chr(824)) ELSE '&;&#;&#xg' END) AS text FROM {refs}""", refs=REFERENCES))
def decoded_references(spark, sf_dir):
    return derived(spark, sf_dir, REFERENCES).select("id", decode_entities(F.col("written")).alias("text"))


FAILURES = """SELECT event_id, user_id, concat('https://h', user_id, '.example.net/') AS url, CASE event_type WHEN 'view' THEN concat('net::timeout after ', event_id)
  WHEN 'click' THEN 'connect ECONNREFUSED' WHEN 'error' THEN concat('getaddrinfo ENOTFOUND h', user_id) ELSE
  CASE WHEN event_id % 3 = 0 THEN 'bad certificate' WHEN event_id % 3 = 1 THEN 'Timeout' END END AS error_message FROM {events}"""
FAILURE_TYPE = """CASE event_type WHEN 'view' THEN 'TIMEOUT' WHEN 'click' THEN 'CONNECTION_REFUSED' WHEN 'error' THEN 'DNS_ERROR'
  ELSE CASE WHEN event_id % 3 = 0 THEN 'SSL_ERROR' WHEN event_id % 3 = 1 THEN 'REQUEST_FAILED' END END"""


@add("fetch_error_type", f"SELECT event_id, {FAILURE_TYPE} AS error_type FROM events")
def fetch_error_type(spark, sf_dir):
    return derived(spark, sf_dir, FAILURES).select("event_id", G.fetch_error_type(F.col("error_message")).alias("error_type"))


@add("failed_fetch_rows", twin(f"""
SELECT f.event_id, f.url, CAST(NULL AS INT) AS status_code, ({FAILURE_TYPE}) AS error_type, f.error_message,
  '<title>No page</title><p>' || f.error_message || '</p>' AS html
FROM {{failures}} f JOIN (SELECT event_id AS id, event_type FROM events) e ON e.id = f.event_id WHERE f.error_message IS NOT NULL""", failures=FAILURES))
def failed_fetch_rows(spark, sf_dir):
    rows = G.failed_fetch_rows(derived(spark, sf_dir, FAILURES))
    return rows.select("event_id", "url", "status_code", "error_type", "error_message", "html")


@add("page_gate", twin(f"SELECT * FROM ({GATED})", marked=MARKED_PAGES))
def page_gate(spark, sf_dir):
    return G.page_gate(marked(spark, sf_dir)).select("page_id", "url", "status_code", "error_type", "error_message")


HIDDEN_PAGES = """SELECT p_partkey AS page_id, concat('<body><div>', p_name, '<p class="x visibility--hidden--visually">gone <b>', p_brand, '</b></p><span>', p_type,
  '</span><span class="visibility--hidden--visually">gone<br>too</span></div>', p_size, '</body>') AS html FROM {part}"""


@add("strip_hidden", "SELECT p_partkey AS page_id, p_name || p_type || p_size AS text, 3 AS n_nodes FROM part")
def strip_hidden(spark, sf_dir):
    docs = N.with_doc(derived(spark, sf_dir, HIDDEN_PAGES))
    return docs.select("page_id", N.page_text(F.col("doc")).alias("text"), F.size("doc.nodes").alias("n_nodes"))


@add("strip_scripts", """SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script.*?</script>', '', 'g'), '(?is)<style.*?</style>', '', 'g') AS html FROM pages""")
def strip_scripts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", H.strip_scripts(F.col("html")).alias("html"))


def judged(spark, sf_dir):
    attempts = derived(spark, sf_dir, ATTEMPTS).drop("kind", "jobs", "wording")
    return hosts.judge_attempts(attempts)


VERDICTS = twin(ATTEMPT_VERDICTS, attempts=ATTEMPTS)


@add("host_status", f"SELECT event_id, status FROM ({VERDICTS})")
def host_status(spark, sf_dir):
    return judged(spark, sf_dir).select("event_id", "status")


@add("host_error_text", f"SELECT event_id, error, retryable FROM ({VERDICTS})")
def host_error_text(spark, sf_dir):
    return judged(spark, sf_dir).select("event_id", "error", "retryable")


@add("total_jobs", twin("SELECT event_id, CASE WHEN kind = 16 THEN jobs WHEN kind = 18 THEN 2 END AS total_jobs FROM {attempts}", attempts=ATTEMPTS))
def total_jobs(spark, sf_dir):
    page = F.col("html")
    pages = derived(spark, sf_dir, ATTEMPTS).select(
        "event_id", H.body_text(page, "content").alias("_text"), H.visible_markup(page).alias("_markup")
    )
    return pages.select("event_id", hosts.total_jobs(F.col("_text"), F.col("_markup")).alias("total_jobs"))


@add("resolve_attempts", twin("SELECT host, attempt, status, error, total_jobs FROM {checks}", checks=twin(HOST_CHECKS, verdicts=VERDICTS)))
def resolve_attempts(spark, sf_dir):
    return hosts.resolve_attempts(judged(spark, sf_dir)).select("host", "attempt", "status", "error", "total_jobs")


@add("listing_total", "SELECT c_custkey AS page_id, 10 + c_custkey AS total FROM customer")
def listing_total(spark, sf_dir):
    pages = derived(spark, sf_dir, LISTING_PAGES)
    return pages.select("page_id", hosts.listing_total(H.body_text(F.col("html"), "content")).alias("total"))


ENTRIES = """SELECT page_id, CASE WHEN page_id % 9 = 8 THEN concat('no url ', page_id) ELSE url END AS url, 'title' AS title,
  CASE WHEN page_id % 7 = 0 THEN 'JavaScript is disabled in your browser' ELSE 'Jobs' END AS h1,
  CASE WHEN page_id % 5 = 0 THEN concat(' ', chr(160), chr(10)) ELSE html END AS article FROM {pages}"""
ENTRY_VERDICTS = f"""SELECT page_id, coalesce({sql_host('url')}, url) AS domain, url, CASE WHEN page_id % 7 = 0 THEN 'js_required'
  WHEN page_id % 5 = 0 THEN 'not_valid' ELSE 'valid' END AS status FROM ({twin(ENTRIES)})"""


def entry_verdicts(spark, sf_dir):
    return dataset_verdicts(derived(spark, sf_dir, ENTRIES))


@add("dataset_status", ENTRY_VERDICTS)
def dataset_status(spark, sf_dir):
    return entry_verdicts(spark, sf_dir)
