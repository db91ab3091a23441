"""Tables and derived inputs shared by the queries and their SQL twins.

Derived inputs are SQL texts that mean the same in both engines: the given tables do not
hold job markup, so pages are rendered from their columns and read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Tables whose rows hold whole pages or texts.
WITH_MARKUP = ("pages", "documents", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def dealt(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Narrow rows dealt out over ``tasks`` (all cores unless given), before pages are rendered from them.

    The given tables are single files of one row group, so one task would render and read all
    pages. Rows that hold markup are not dealt out: they stay where they are read.
    They are counted where they arrive: a filter on the pages, which would otherwise move down to
    the scan and have one task judge them all, stays above the count.
    """
    spread = df.repartition(tasks or df.sparkSession.sparkContext.defaultParallelism)
    return spread.observe(f"dealt_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("n"))


def derived(spark: SparkSession, sf_dir: str, sql: str, tasks: int | None = None) -> DataFrame:
    """Run a shared SQL text on the tables of ``sf_dir``, those without markup dealt out over ``tasks``."""
    used = {name: table(spark, sf_dir, name) for name in TABLES if "{" + name + "}" in sql}
    return spark.sql(sql, **{name: df if name in WITH_MARKUP else dealt(df, tasks) for name, df in used.items()})


def twin(sql: str, **inputs: str) -> str:
    """SQL for the check: ``{input}`` becomes a sub-select, ``{table}`` the table's name."""
    for name, text in inputs.items():
        sql = sql.replace("{" + name + "}", "(" + text + ")")
    for name in TABLES:
        sql = sql.replace("{" + name + "}", name)
    return sql


class Family:
    """Collects the queries of one module."""

    def __init__(self):
        self.queries, self.sql = {}, {}

    def add(self, name: str, sql: str | None = None):
        def register(fn):
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register


# --- expressions of the SQL twins ---------------------------------------------------------


def sql_host(u: str) -> str:
    return (
        f"nullif(lower(regexp_extract({u}, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '')"
    )


def sql_base(u: str) -> str:
    scheme = f"lower(regexp_extract({u}, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1))"
    port = f"regexp_extract({u}, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?[^/?#:]+:([0-9]+)', 1)"
    return (
        f"({scheme} || '://' || {sql_host(u)} || CASE WHEN {port} = '' OR ({scheme} = 'http' AND {port} = '80') "
        f"OR ({scheme} = 'https' AND {port} = '443') THEN '' ELSE ':' || {port} END)"
    )


def sql_site(u: str) -> str:
    h = sql_host(u)
    return f"(CASE WHEN len(string_split({h}, '.')) > 2 THEN string_split({h}, '.')[1] ELSE {h} END)"


def sql_join(base: str, href: str) -> str:
    return (
        f"(CASE WHEN starts_with({href}, 'http') THEN {href} WHEN starts_with({href}, '/') "
        f"THEN {base} || {href} ELSE {base} || '/' || {href} END)"
    )


def sql_concat(base: str, href: str) -> str:
    return f"(CASE WHEN starts_with({href}, 'http') THEN {href} ELSE {base} || {href} END)"


def sql_markup(html: str) -> str:
    for tag in ("script", "style", "noscript"):
        html = f"regexp_replace({html}, '(?is)<{tag}\\b[^>]*>.*?</{tag}[ \\t\\r\\n]*>', '', 'g')"
    return f"regexp_replace({html}, '(?s)<!--.*?-->', '', 'g')"


# --- derived inputs -----------------------------------------------------------------------

# Addresses as a crawl meets them: routed, near misses, ports, user info, no URL at all.
BOARD_URLS = """
SELECT p_partkey AS id, p_name, p_brand,
  CASE p_partkey % 9
    WHEN 0 THEN concat('https://b', p_size, '.jobs.example.net/careers/JobDetail/', replace(p_name, ' ', '-'), '/', p_partkey)
    WHEN 1 THEN concat('https://b', p_size, '.jobs.example.net/en_US/careers/SearchJobs/?jobOffset=', p_size)
    WHEN 2 THEN concat('http://b', p_size, '.jobs.example.net:8080/internalcareers/JobDetail/x/', p_partkey)
    WHEN 3 THEN concat('HTTPS://User@B', p_size, '.Jobs.Example.net:443/CAREERS/jobdetail/', p_size, '/', p_partkey, '?src=x')
    WHEN 4 THEN concat('http://example', p_size, '.net:80/about/', p_size, '/team#', p_partkey)
    WHEN 5 THEN concat('10.0.0.', p_size)
    WHEN 6 THEN concat('https://uat', p_size, '.example.net/x/65.html')
    WHEN 7 THEN concat('https://mail.sandbox-', p_size, '.example.net/', p_partkey, '/', p_size)
    ELSE concat('ftp://b_', p_size, '.example.net//', p_partkey, '/')
  END AS url
FROM {part}
"""

# Fetch attempts of hosts: three per host, one of 22 kinds of outcome each.
ATTEMPTS = """
SELECT event_id, concat('h', CAST(floor(event_id / 4) AS BIGINT), '.example.net') AS host,
  CAST(event_id % 4 AS INT) + 1 AS attempt, CAST(event_id % 22 AS INT) AS kind,
  CAST(10 + event_id % 83 AS BIGINT) AS jobs, CAST(floor(event_id / 22) % 9 AS INT) AS wording,
  CAST(CASE event_id % 22 WHEN 0 THEN 499 WHEN 1 THEN 429 WHEN 4 THEN 404 WHEN 5 THEN 401 WHEN 6 THEN 403
    WHEN 7 THEN 503 WHEN 3 THEN NULL WHEN 21 THEN NULL ELSE 200 END AS INT) AS status_code,
  CASE event_id % 22 WHEN 3 THEN 'AbortError: timeout' WHEN 21 THEN 'connect timeout of proxy' END AS error_message,
  concat('<html><head><title>',
    CASE event_id % 22 WHEN 8 THEN '' WHEN 11 THEN 'SSO gateway' WHEN 18 THEN 'Open roles' ELSE 'Acme page' END,
    '</title><script>var a = "<form action=login>";</script></head><body>',
    CASE event_id % 22
      WHEN 2 THEN '<p>We detected multiple users connecting from your IP address.</p>'
      WHEN 8 THEN '<p>short</p>'
      WHEN 9 THEN '<form method="post" action="/portal/signin"><p>Welcome back, colleague, to this very internal portal</p></form>'
      WHEN 10 THEN '<div><input name="p" type="password"> Enter here and wait for the door to open for you</div>'
      WHEN 12 THEN '<p>To go on, <b>please log in</b> with the account of your company today.</p>'
      WHEN 13 THEN '<p>Type your Username and then your Password to go on to the next page.</p>'
      WHEN 14 THEN '<p>Sorry, the page you asked for does not exist, go back to the start.</p>'
      WHEN 15 THEN '<p>Error 404: we could not show the page that you wanted to have.</p>'
      WHEN 16 THEN concat('<ul><li class="article">Role</li></ul><p>',
        CASE CAST(floor(event_id / 22) % 9 AS INT)
          WHEN 0 THEN concat('There are ', 10 + event_id % 83, ' jobs matching your criteria')
          WHEN 1 THEN concat('We have ', 10 + event_id % 83, ' jobs matching')
          WHEN 2 THEN concat('Showing 1-9 of ', 10 + event_id % 83, ' rows')
          WHEN 3 THEN concat('Page 1 of ', 10 + event_id % 83, ' results')
          WHEN 4 THEN concat('About ', 10 + event_id % 83, ' results')
          WHEN 5 THEN concat('In all, ', 10 + event_id % 83, ' jobs found')
          WHEN 6 THEN concat('We found ', 10 + event_id % 83, ' job for you')
          WHEN 7 THEN concat('We have ', 10 + event_id % 83, ' open positions')
          ELSE concat('0 results here, but ', 10 + event_id % 83, ' opportunities') END,
        '</p>')
      WHEN 17 THEN '<section><span class="big job-tile">A role with us</span> and some more words to read</section>'
      WHEN 18 THEN concat('<a class="x" href="/careers/JobDetail/a/', event_id, '">A</a> <a href=/careers/JobDetail/b/', event_id + 1,
        '>B</a> <a href="https://h.example.net/JobDetail/a/', event_id, '?x=1">A again</a> and some more words to read')
      WHEN 19 THEN '<form action="/careers/SearchJobs"><p>Look for something that you like in our house</p></form>'
      ELSE '<p>Nothing to see for visitors of this site, but enough words to be a page.</p>'
    END, '</body></html>') AS html
FROM {events}
"""

# What the check of one such attempt has to say.
ATTEMPT_VERDICTS = """
SELECT event_id, host, attempt,
  CASE WHEN kind IN (0, 1, 2) THEN 'blocked' WHEN kind IN (3, 7, 21) THEN 'error'
    WHEN kind IN (4, 14, 15, 20) THEN 'not_working' WHEN kind IN (5, 6, 8, 9, 10, 11, 12, 13) THEN 'auth_required'
    ELSE 'working' END AS status,
  CASE WHEN kind IN (0, 1) THEN 'Rate limited after 3 retries' WHEN kind = 2 THEN 'Proxy rate limited after 3 retries'
    WHEN kind = 3 THEN 'Timeout' WHEN kind = 4 THEN 'Page not found' WHEN kind IN (5, 6) THEN 'Access denied'
    WHEN kind = 7 THEN 'Server error 503' WHEN kind = 8 THEN 'Empty page (likely requires auth)'
    WHEN kind BETWEEN 9 AND 13 THEN 'Requires login' WHEN kind IN (14, 15) THEN 'Page not found (in content)'
    WHEN kind = 20 THEN 'No job elements found' WHEN kind = 21 THEN 'connect timeout of proxy' END AS error,
  CASE WHEN kind = 16 THEN jobs WHEN kind = 18 THEN 2 WHEN kind = 19 THEN 0 END AS total_jobs,
  kind IN (0, 1, 2, 3) AS retryable
FROM {attempts}
"""

# The deciding attempt of each host; a fourth one never counts.
HOST_CHECKS = """
SELECT host, attempt, status, error, total_jobs FROM (
  SELECT *, row_number() OVER (PARTITION BY host ORDER BY retryable,
    CASE WHEN retryable THEN -attempt ELSE attempt END) AS rn FROM {verdicts} WHERE attempt <= 3) WHERE rn = 1
"""

# Listing pages: hidden links and words, links for readers without scripts, a repeated card, a card without a link, a link without a leading slash.
LISTING_PAGES = """
SELECT c_custkey AS page_id, c_name, c_mktsegment, concat('https://board.example.net/careers/SearchJobs/?jobOffset=', c_custkey) AS url,
  concat('<html><body><script>var t = "<div class=article>";</script><main><div class="section__content__results">',
    '<article class="article article--result"><div class="article__header__text"><h3 class="article__header__text__title"><a href="/careers/JobDetail/part-',
    c_custkey, '/', c_custkey, '"> ', c_name, ' &amp; more </a></h3><div class="article__header__text__subtitle">',
    '<span class="list-item-location first">Old</span><span class="list-item-ref">REF #', c_custkey, '</span>',
    '<span class="list-item-location">', c_mktsegment, ' Office</span></div></div></article>',
    '<article class="article"><h3 class="article__header__text__title"><a href="https://board.example.net/careers/JobDetail/part-', c_custkey + 1, '/', c_custkey + 1,
    '">Second ', c_custkey, '</a></h3><p class="article__header__text__subtitle"> Just text ', c_nationkey, ' </p></article>',
    '<article class="article"><h3 class="article__header__text__title"><a href="/careers/JobDetail/part-', c_custkey, '/', c_custkey, '">Repeated</a></h3></article>',
    '<article class="article"><h3 class="article__header__text__title">No link</h3></article></div>',
    '<article class="article"><h3 class="article__header__text__title"><a href="/out">Outside</a></h3></article>',
    '<ul class="list"><li class="list__item"><div class="list__item__text__title"><a href="careers/JobDetail/part-', c_custkey + 2, '/', c_custkey + 2, '">Third</a></div>',
    '<div class="list__item__text__subtitle"><span class="list-item-workingTime">Part time</span></div></li></ul>',
    '<p>Showing 1-3 of ', 10 + c_custkey, ' results</p></main><nav><a href="/careers/SearchJobs/?jobOffset=', c_custkey + 20, '">Next</a>',
    '<a href="?jobOffset=', c_custkey, '">&lt;&lt; Prev</a><a href="#">', c_nationkey, '</a><a class=x href=''/careers/SearchJobs/?jobOffset=', c_custkey + 20,
    '''>More</a><a href="?pageNumber=', c_nationkey, '&amp;x=1">', c_nationkey, '</a><a href="/careers/Login">Go back</a>',
    '<div class="x visibility--hidden--visually"><a href="/careers/SearchJobs/?jobOffset=1">Hidden</a></div><noscript><a href="/n/?pageNumber=', c_custkey, '">Plain</a></noscript>',
    '<a href="/b/?jobOffset=9">On<span class="visibility--hidden--visually"> back</span></a></nav></body></html>') AS html
FROM {customer}
"""

# Detail pages with fields in all five layouts, sections, titles of six kinds; next to the
# HTML stand the values that have to come out.
JOB_PAGES = """
SELECT page_id, url, title, location, work_type, salary_raw, salary_min, salary_max, employment_type,
  department, category, entity, posted_date, ref_number, description, qualifications, duties, apply_url, full_content,
  concat('<!DOCTYPE html><html><head>', head_html, '<script>var s = "<p><b>Location</b> twigConfig</p>";</script></head><body>',
    '<header><h1>Careers home page</h1></header><p class="visibility--hidden--visually"><strong>Shift:</strong> Hidden</p>',
    '<a href="/careers/SearchJobs">All jobs</a><main class="main">', title_html, location_html, fields_html, sections_html,
    '<h2>Next</h2><a class="button button--primary" href="/careers/ApplicationMethods?jobId=', page_id, '">Send</a></main></body></html>') AS html
FROM (
SELECT p_partkey AS page_id, concat('https://board.example.net/careers/JobDetail/part-', p_partkey, '/', p_partkey) AS url,
  CASE p_partkey % 6 WHEN 0 THEN concat('<meta property="og:title" content=" Og ', p_name, ' &amp; co "/><title>No - 1 - Board</title>')
    WHEN 1 THEN concat('<title>', p_name, ' role - ', p_partkey, ' - Board</title>')
    WHEN 2 THEN concat('<title>', p_name, ' role | Board</title>') ELSE '<title>Jobs</title>' END AS head_html,
  CASE p_partkey % 6 WHEN 3 THEN concat('<div class="article__content__view__field__value--font"><i class="article__content__view__field__value"> ', p_name, ' styled</i></div>')
    WHEN 4 THEN concat('<h1> ', p_name, ' heading </h1>') ELSE '' END AS title_html,
  CASE p_partkey % 6 WHEN 0 THEN concat('Og ', p_name, ' & co') WHEN 1 THEN concat(p_name, ' role') WHEN 2 THEN concat(p_name, ' role')
    WHEN 3 THEN concat(p_name, ' styled') WHEN 4 THEN concat(p_name, ' heading') ELSE concat('part ', p_partkey) END AS title,
  concat(p_brand, ' Plant') AS location,
  CASE p_partkey % 5
    WHEN 0 THEN concat('<div class="article__content__view__field"><i class="article__content__view__field__label"> Work Location: </i><i class="article__content__view__field__value">', p_brand, ' Plant</i></div>')
    WHEN 1 THEN concat('<p><strong>Work Location:</strong> ', p_brand, ' Plant</p>')
    WHEN 2 THEN concat('<dl><dt>Work Location<dd>', p_brand, ' Plant</dl>')
    WHEN 3 THEN concat('<table><tr><th>Work Location<td>', p_brand, ' Plant</table>')
    ELSE concat('<span>Work Location:</span><span>', p_brand, ' Plant</span>') END AS location_html,
  lower(p_type) AS work_type,
  concat('$', CAST(p_retailprice AS DECIMAL(12,2)), ' - $', CAST(p_retailprice + 100 AS DECIMAL(12,2)), ' per year') AS salary_raw,
  concat('', CAST(p_retailprice AS DECIMAL(12,2))) AS salary_min, concat('', CAST(p_retailprice + 100 AS DECIMAL(12,2))) AS salary_max,
  concat('Full ', p_size) AS employment_type, concat('Area ', p_size) AS department, concat('Family ', p_type) AS category,
  concat('Acme ', p_brand) AS entity,
  concat(CASE WHEN p_partkey % 3 = 2 THEN '2025-' ELSE '2024-' END, lpad(concat('', 1 + p_partkey % 12), 2, '0'), '-', lpad(concat('', 1 + p_partkey % 28), 2, '0')) AS posted_date,
  concat('R-', p_partkey, '-', p_size) AS ref_number,
  concat('<div class="article__content__view__field"><i class="article__content__view__field__label">Workplace Type</i><i class="article__content__view__field__value">', lower(p_type), '</i></div>',
    '<div class="article__content__view__field"><i class="article__content__view__field__label">Business Area</i><i class="article__content__view__field__value">Area ', p_size, '</i></div>',
    '<div class="article__content__view__field"><i class="article__content__view__field__label">Requisition:</i><i class="article__content__view__field__value">R-', p_partkey, '-', p_size, '</i></div>',
    '<div class="article__content__view__field"><i class="article__content__view__field__label">Posted Date</i><i class="article__content__view__field__value">',
    CASE p_partkey % 3 WHEN 0 THEN concat(1 + p_partkey % 12, '/', 1 + p_partkey % 28, '/2024')
      WHEN 1 THEN concat(1 + p_partkey % 28, '-', substring('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(1 + 3 * (p_partkey % 12) AS INT), 3), '-2024')
      ELSE concat('Monday, ', CASE p_partkey % 12 WHEN 0 THEN 'January' WHEN 1 THEN 'February' WHEN 2 THEN 'March' WHEN 3 THEN 'April' WHEN 4 THEN 'May'
        WHEN 5 THEN 'June' WHEN 6 THEN 'July' WHEN 7 THEN 'August' WHEN 8 THEN 'September' WHEN 9 THEN 'October' WHEN 10 THEN 'November' ELSE 'December' END,
        ' ', 1 + p_partkey % 28, ', 2025') END, '</i></div>',
    '<p><b>Salary Range</b>: $', CAST(p_retailprice AS DECIMAL(12,2)), ' - $', CAST(p_retailprice + 100 AS DECIMAL(12,2)), ' per year</p>',
    '<table><tr><th>Employment Type</th><td>Full ', p_size, '</td></tr></table>',
    '<dl><dt>Job Family</dt><dd>Family ', p_type, '</dd><dt>Team</dt></dl>',
    '<ul><li><strong>Legal Entity:</strong> Acme ', p_brand, '</li></ul>') AS fields_html,
  concat('<h3>Position Overview</h3><p>', p_name, ' is what this job is all about</p><p>Press space or enter</p><p>and more of it</p>',
    '<h3>Primary Duties</h3><ul><li>Carry the ', p_name, '</li><li>Sweep the floor</li></ul>',
    '<h3>What you will do</h3><p>Smile at every customer, ', p_type, '</p>',
    '<h3>Required Qualifications</h3><p>', p_size, ' years of honest work</p>',
    CASE WHEN p_partkey % 2 = 0 THEN concat('<section class="about"><h2>Summary</h2><p>', p_name, ' is a long word, and ', p_type, ' is one that is longer still.</p></section>') ELSE '' END) AS sections_html,
  CASE WHEN p_partkey % 2 = 0 THEN concat(p_name, ' is a long word, and ', p_type, ' is one that is longer still.')
    ELSE concat(p_name, ' is what this job is all about', chr(10), 'and more of it') END AS description,
  concat(p_size, ' years of honest work') AS qualifications_core,
  CASE WHEN p_partkey % 2 = 0 THEN concat(p_size, ' years of honest work', chr(10), 'Summary', p_name, ' is a long word, and ', p_type, ' is one that is longer still.')
    ELSE concat(p_size, ' years of honest work') END AS qualifications,
  concat('Carry the ', p_name, 'Sweep the floor', chr(10), 'Smile at every customer, ', p_type) AS duties,
  concat('https://board.example.net/careers/ApplicationMethods?jobId=', p_partkey) AS apply_url,
  concat(CASE p_partkey % 6 WHEN 3 THEN concat(p_name, ' styled') WHEN 4 THEN concat(p_name, ' heading ') ELSE '' END,
    CASE WHEN p_partkey % 5 = 0 AND p_partkey % 6 NOT IN (3, 4) THEN 'Work Location: ' WHEN p_partkey % 5 = 0 THEN ' Work Location: ' WHEN p_partkey % 5 = 1 THEN 'Work Location: '
      WHEN p_partkey % 5 = 4 THEN 'Work Location:' ELSE 'Work Location' END,
    p_brand, ' PlantWorkplace Type', lower(p_type), 'Business AreaArea ', p_size, 'Requisition:R-', p_partkey, '-', p_size, 'Posted Date',
    CASE p_partkey % 3 WHEN 0 THEN concat(1 + p_partkey % 12, '/', 1 + p_partkey % 28, '/2024')
      WHEN 1 THEN concat(1 + p_partkey % 28, '-', substring('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(1 + 3 * (p_partkey % 12) AS INT), 3), '-2024')
      ELSE concat('Monday, ', CASE p_partkey % 12 WHEN 0 THEN 'January' WHEN 1 THEN 'February' WHEN 2 THEN 'March' WHEN 3 THEN 'April' WHEN 4 THEN 'May'
        WHEN 5 THEN 'June' WHEN 6 THEN 'July' WHEN 7 THEN 'August' WHEN 8 THEN 'September' WHEN 9 THEN 'October' WHEN 10 THEN 'November' ELSE 'December' END,
        ' ', 1 + p_partkey % 28, ', 2025') END,
    'Salary Range: $', CAST(p_retailprice AS DECIMAL(12,2)), ' - $', CAST(p_retailprice + 100 AS DECIMAL(12,2)), ' per yearEmployment TypeFull ', p_size,
    'Job FamilyFamily ', p_type, 'TeamLegal Entity: Acme ', p_brand,
    'Position Overview', p_name, ' is what this job is all aboutPress space or enterand more of itPrimary DutiesCarry the ', p_name,
    'Sweep the floorWhat you will doSmile at every customer, ', p_type, 'Required Qualifications', p_size, ' years of honest work',
    CASE WHEN p_partkey % 2 = 0 THEN concat('Summary', p_name, ' is a long word, and ', p_type, ' is one that is longer still.') ELSE '' END, 'NextSend') AS full_content
FROM {part}) j
"""
