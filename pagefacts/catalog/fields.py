"""Queries on labelled fields, titles, dates, salaries and sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nodes as N
from ..functions import parse
from ..functions.text import first_text as first_text_of
from ..operators import fields, jobs, sections, titles
from .base import JOB_PAGES, Family, derived, table, twin

family = Family()
QUERIES, SQL = family.queries, family.sql
add = family.add


def job_docs(spark, sf_dir):
    return N.with_doc(derived(spark, sf_dir, JOB_PAGES).select("page_id", "url", "html"))


# One page per part and layout; the second label of each page has no value that counts.
METHOD_PAGES = {
    0: """concat('<div class="article__content__view__field x"><p class="article__content__view__field__label"> Plant: </p><p class="article__content__view__field__value">', p_name,
      ' &lt;', p_brand, '></p></div><div class="article__content__view__field"><p class="article__content__view__field__label">Size</p><p class="article__content__view__field__value"> </p></div>')""",
    1: """concat('<p>In <b>Plant</b> : &bull; ', p_name, ' <i>&lt;', p_brand, '></i></p><p><b>Size</b> twigConfig ', p_size, '</p>')""",
    2: """concat('<dl><dt>Plant<dd>', p_name, ' &lt;', p_brand, '><dt>Size</dt><dt>Next</dt></dl>')""",
    3: """concat('<table><tr><th>Pla<th>nt<td>', p_name, '<td> &lt;', p_brand, '></tr><tr><td>', p_size, '</table>')""",
    4: """concat('<div>Plant:</div><div>', p_name, ' &lt;', p_brand, '></div><div>Size</div><div>Ref # ', p_size, '</div><span>Size</span><p>', p_size, '</p>')""",
}
METHOD_LABEL = {0: "plant:", 1: "plant", 2: "plant", 3: "plant", 4: "plant:"}
PLANT = {"plant": ("plant",), "size": ("size",)}


def _method(k):
    pages = "SELECT p_partkey AS page_id, concat('<body>', " + METHOD_PAGES[k] + ", '</body>') AS html FROM {part}"
    sql = f"SELECT p_partkey AS page_id, {k} AS method, '{METHOD_LABEL[k]}' AS label, p_name || ' <' || p_brand || '>' AS value FROM part"

    def query(spark, sf_dir):
        found = fields.candidates(F.col("doc"), (k,), PLANT)
        docs = N.with_doc(derived(spark, sf_dir, pages))
        return docs.select("page_id", F.explode(found).alias("c")).select("page_id", "c.method", "c.label", "c.value")

    add(f"field_method_{k}", sql)(query)


for _k in METHOD_PAGES:
    _method(_k)

# Fields whose labels, layouts and places compete for the same targets.
RIVAL_PAGES = """SELECT p_partkey AS page_id, concat('<body><dl><dt>City</dt><dd>city ', p_size, '</dd><dt>Location</dt><dd>dd ', p_size, '</dd></dl>',
  '<p><strong>Location:</strong> bold ', p_brand, '</p><p><strong>Location:</strong> later ', p_brand, '</p>',
  '<div class="article__content__view__field"><i class="article__content__view__field__label">Job #</i><i class="article__content__view__field__value">N', p_partkey, '</i></div>',
  '<div class="article__content__view__field"><i class="article__content__view__field__label"> </i><i class="article__content__view__field__value">no label</i></div>',
  '<table><tr><th>Group<td>', p_type, '<tr><th>Team<td>team ', p_size, '</table></body>') AS html FROM {part}"""


def rivals(spark, sf_dir):
    return N.with_doc(derived(spark, sf_dir, RIVAL_PAGES))


@add("field_dictionary_join", """
SELECT p_partkey AS page_id, x.target, x.prio, x.method, CASE x.v WHEN 'city' THEN 'city ' || p_size WHEN 'dd' THEN 'dd ' || p_size WHEN 'bold' THEN 'bold ' || p_brand
  WHEN 'later' THEN 'later ' || p_brand WHEN 'n' THEN 'N' || p_partkey WHEN 'group' THEN p_type ELSE 'team ' || p_size END AS value
FROM part, (VALUES ('location', 4, 2, 'city'), ('location', 2, 2, 'dd'), ('location', 2, 1, 'bold'), ('location', 2, 1, 'later'), ('location', 3, 0, 'n'),
  ('employmentType', 2, 0, 'n'), ('category', 2, 0, 'n'), ('category', 3, 0, 'n'), ('refNumber', 1, 0, 'n'), ('refNumber', 2, 0, 'n'),
  ('department', 5, 3, 'group'), ('department', 4, 3, 'team')) AS x(target, prio, method, v)""")
def field_dictionary_join(spark, sf_dir):
    return fields.field_dictionary_join(rivals(spark, sf_dir)).select("page_id", "target", "prio", "method", "value")


@add("field_by_labels", """SELECT p_partkey AS page_id, 'bold ' || p_brand AS location, 'N' || p_partkey AS employment_type, 'N' || p_partkey AS category,
  'team ' || p_size AS department, 'N' || p_partkey AS ref_number, CAST(NULL AS VARCHAR) AS duration FROM part""")
def field_by_labels(spark, sf_dir):
    found = fields.field_by_labels(rivals(spark, sf_dir))
    return found.select(
        "page_id", "location", F.col("employmentType").alias("employment_type"), "category", "department",
        F.col("refNumber").alias("ref_number"), "duration",
    )


@add("field_by_labels_strict", """SELECT p_partkey AS page_id, 'bold ' || p_brand AS location, CAST(NULL AS VARCHAR) AS employment_type, CAST(NULL AS VARCHAR) AS category,
  'team ' || p_size AS department, 'N' || p_partkey AS ref_number FROM part""")
def field_by_labels_strict(spark, sf_dir):
    found = fields.field_by_labels(rivals(spark, sf_dir), strict=True)
    return found.select(
        "page_id", "location", F.col("employmentType").alias("employment_type"), "category", "department",
        F.col("refNumber").alias("ref_number"),
    )


@add("first_text", """SELECT page_id, nullif(trim(replace(replace(regexp_replace(regexp_extract(html, '(?is)<article><h1>(.*?)</h1>', 1), '<[^>]+>', '', 'g'), '&lt;', '<'), '&amp;', '&')), '') AS heading FROM pages""")
def first_text(spark, sf_dir):
    docs = N.with_doc(table(spark, sf_dir, "pages", "page_id", "html"))
    heads = F.filter(F.col("doc")["nodes"], lambda n: n["tag"] == "h1")
    return docs.select("page_id", first_text_of(N.raw_text(F.col("doc"), F.get(heads, F.lit(0)))).alias("heading"))


# Running text with a posting date, a reference and labels without any markup.
TEXT_PAGES = """SELECT o_orderkey AS page_id, concat('<html><head><title>x</title></head><body>', CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE '<main>' END, '<p>Some words about order ', o_orderkey,
  CASE WHEN o_orderkey % 2 = 0 THEN concat(', POSTED: ', lpad(concat('', 1 + o_orderkey % 28), 2, '0'), '-Feb-1998 by us') ELSE ' and nothing more' END, '</p>', chr(10), 'Location: City ', o_custkey, chr(10),
  'Business Area', chr(10), '  Area ', o_orderpriority, chr(10), CASE o_orderkey % 3 WHEN 0 THEN concat('Reference: AB', o_custkey, chr(10)) WHEN 1 THEN concat('Job # ', o_orderkey, chr(10)) ELSE '' END, 'Salary: open', chr(10),
  CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE '</main>' END, '<footer>end of page</footer></body></html>') AS html FROM {orders}"""


def text_docs(spark, sf_dir):
    docs = N.with_doc(derived(spark, sf_dir, TEXT_PAGES))
    return docs.select("page_id", "doc", fields.content_text(F.col("doc")).alias("content"), N.body_text(F.col("doc")).alias("body"))


@add("text_by_pattern", """SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 3 = 1 THEN CAST(o_orderkey AS VARCHAR) END AS ref FROM orders""")
def text_by_pattern(spark, sf_dir):
    return text_docs(spark, sf_dir).select("page_id", fields.text_by_pattern(F.col("content"), fields.REF_PATTERN).alias("ref"))


@add("posted_date_raw", """SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 2 = 0 THEN lpad(CAST(1 + o_orderkey % 28 AS VARCHAR), 2, '0') || '-Feb-1998' END AS raw,
  CASE WHEN o_orderkey % 2 = 0 THEN '1998-02-' || lpad(CAST(1 + o_orderkey % 28 AS VARCHAR), 2, '0') END AS posted FROM orders""")
def posted_date_raw(spark, sf_dir):
    found = fields.best_value(fields.matches(fields.candidates(F.col("doc"))), "postedDate")
    raw = F.coalesce(found, fields.text_by_pattern(F.col("content"), fields.POSTED_PATTERN))
    pages = text_docs(spark, sf_dir).select("page_id", raw.alias("raw"))
    return pages.select("page_id", "raw", parse.parse_date(F.col("raw")).alias("posted"))


@add("field_from_text", """SELECT o_orderkey AS page_id, 'City ' || o_custkey AS location, CASE WHEN o_orderkey % 3 <> 1 THEN 'Area ' || o_orderpriority END AS department FROM orders""")
def field_from_text(spark, sf_dir):
    body = F.col("body")
    return text_docs(spark, sf_dir).select(
        "page_id",
        fields.field_from_text(body, fields.TEXT_LABELS["location"]).alias("location"),
        fields.field_from_text(body, fields.TEXT_LABELS["department"]).alias("department"),
    )


@add("ref_number", """SELECT o_orderkey AS page_id, CASE o_orderkey % 3 WHEN 0 THEN 'AB' || o_custkey WHEN 1 THEN CAST(o_orderkey AS VARCHAR) END AS ref FROM orders""")
def ref_number(spark, sf_dir):
    labelled = fields.best_value(fields.matches(fields.candidates(F.col("doc"))), "refNumber")
    ref = F.coalesce(
        labelled,
        fields.field_from_text(F.col("body"), fields.TEXT_LABELS["refNumber"]),
        fields.text_by_pattern(F.col("content"), fields.REF_PATTERN),
    )
    return text_docs(spark, sf_dir).select("page_id", ref.alias("ref"))


@add("ref_not_job_id", "SELECT o_orderkey AS id, CASE WHEN o_orderkey <> o_custkey THEN CAST(o_custkey AS VARCHAR) END AS ref FROM orders")
def ref_not_job_id(spark, sf_dir):
    ref, job_id = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), jobs.ref_not_job_id(ref, job_id).alias("ref"))


# Order dates in seven spellings; what cannot be read stays as it is.
DATE_TEXTS = """SELECT o_orderkey AS id, CASE o_orderkey % 7 WHEN 0 THEN concat(y, '-', lpad(concat('', m), 2, '0'), '-', lpad(concat('', d), 2, '0'), 'T10:00')
  WHEN 1 THEN concat('on ', m, '/', d, '/', y, '.') WHEN 2 THEN concat(d, '-', substring('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * m - 2 AS INT), 3), '-', y)
  WHEN 3 THEN concat('Tuesday, ', CASE m WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March' WHEN 4 THEN 'April' WHEN 5 THEN 'May' WHEN 6 THEN 'June'
    WHEN 7 THEN 'JULY' WHEN 8 THEN 'August' WHEN 9 THEN 'September' WHEN 10 THEN 'October' WHEN 11 THEN 'November' ELSE 'December' END, chr(160), d, CASE WHEN d > 15 THEN ',' ELSE '' END, ' ', y)
  WHEN 4 THEN concat('Sept ', d, ', ', y) WHEN 5 THEN concat(d + 12, '/45/', y) ELSE CASE WHEN d > 15 THEN '' ELSE concat(d, '-Foo-', y) END END AS text, y, m, d, o_orderkey % 7 AS style
FROM (SELECT o_orderkey, CAST(extract(YEAR FROM o_orderdate) AS INT) AS y, CAST(extract(MONTH FROM o_orderdate) AS INT) AS m, CAST(extract(DAY FROM o_orderdate) AS INT) AS d FROM {orders}) o"""


@add("parse_date", twin("""SELECT id, text, CASE WHEN style IN (1, 2, 3) THEN y || '-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(d::VARCHAR, 2, '0')
  WHEN style = 5 THEN y || '-' || lpad((d + 12)::VARCHAR, 2, '0') || '-45' ELSE nullif(text, '') END AS parsed,
  CASE WHEN style < 4 THEN CAST(make_date(y, m, d) AS VARCHAR) END AS day FROM {dates}""", dates=DATE_TEXTS))
def parse_date(spark, sf_dir):
    texts = derived(spark, sf_dir, DATE_TEXTS).select("id", "text", parse.parse_date(F.col("text")).alias("parsed"))
    return texts.select("id", "text", "parsed", parse.date_value(F.col("parsed")).cast("string").alias("day"))


SALARY_TEXTS = """SELECT l_orderkey, l_linenumber, style, price, CASE style WHEN 0 THEN concat('$', price, ' - $', price + 5, ' per hour') WHEN 1 THEN concat('Up to ', price, ' USD annually')
  WHEN 2 THEN concat('$1,', 100 + l_linenumber, ',000 TO 2,', 100 + l_linenumber, ',000.50 a Month') WHEN 3 THEN 'Competitive, DOE' WHEN 4 THEN concat(l_linenumber, '01k-', l_linenumber, '02k weekly')
  WHEN 5 THEN 'Please ask us' WHEN 6 THEN concat(l_linenumber, chr(160), 't ', l_linenumber + 1, ' each year, paid by the hour') ELSE NULL END AS text
FROM (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, (l_orderkey + l_linenumber) % 8 AS style FROM {lineitem}) l"""


@add("parse_salary", twin("""SELECT l_orderkey, l_linenumber, low, high, period, CAST(low AS DOUBLE) AS low_num FROM (SELECT *,
  CASE style WHEN 0 THEN price::VARCHAR WHEN 1 THEN price::VARCHAR WHEN 2 THEN '1' || (100 + l_linenumber) || '000' WHEN 4 THEN l_linenumber || '01' WHEN 6 THEN l_linenumber::VARCHAR END AS low,
  CASE style WHEN 0 THEN (price + 5)::VARCHAR WHEN 1 THEN price::VARCHAR WHEN 2 THEN '2' || (100 + l_linenumber) || '000.50' WHEN 4 THEN l_linenumber || '01' WHEN 6 THEN (l_linenumber + 1)::VARCHAR END AS high,
  CASE style WHEN 0 THEN 'hourly' WHEN 1 THEN 'yearly' WHEN 2 THEN 'monthly' WHEN 4 THEN 'weekly' WHEN 6 THEN 'hourly' END AS period FROM {salaries})""", salaries=SALARY_TEXTS))
def parse_salary(spark, sf_dir):
    texts = derived(spark, sf_dir, SALARY_TEXTS)
    parsed = texts.select("l_orderkey", "l_linenumber", parse.parse_salary(F.col("text")).alias("s"))
    return parsed.select(
        "l_orderkey", "l_linenumber", F.col("s.min").alias("low"), F.col("s.max").alias("high"), "s.period",
        parse.amount_value(F.col("s.min")).cast("double").alias("low_num"),
    )


@add("job_title", twin("SELECT page_id, title FROM {jobs}", jobs=JOB_PAGES))
def job_title(spark, sf_dir):
    return job_docs(spark, sf_dir).select("page_id", titles.job_title(F.col("doc"), F.col("url")).alias("title"))


@add("page_title_cascade", """WITH t AS (SELECT p_partkey AS id, p_name || CASE p_partkey % 5 WHEN 0 THEN ' - ' || p_partkey || ' - Board' WHEN 1 THEN ' | Board'
  WHEN 2 THEN ' - board - 12 | x' WHEN 3 THEN '' ELSE ' -Part-time - Board' END AS t FROM part)
SELECT id, CASE WHEN length(regexp_extract(t, '^(.+?) *[-|] *[0-9]+ *[-|]', 1)) > 5 THEN trim(regexp_extract(t, '^(.+?) *[-|] *[0-9]+ *[-|]', 1))
  WHEN length(regexp_extract(t, '^(.+?) *[-|] *[A-Z]', 1)) BETWEEN 6 AND 149 THEN trim(regexp_extract(t, '^(.+?) *[-|] *[A-Z]', 1)) END AS title FROM t""")
def page_title_cascade(spark, sf_dir):
    k = F.col("p_partkey") % 5
    tail = (
        F.when(k == 0, F.concat(F.lit(" - "), "p_partkey", F.lit(" - Board"))).when(k == 1, " | Board")
        .when(k == 2, " - board - 12 | x").when(k == 3, "").otherwise(" -Part-time - Board")
    )
    text = F.concat("p_name", tail)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), titles.title_from_page_title(text).alias("title"))


@add("sections_h3", twin("""SELECT page_id, 'description' AS kind, split_part(full_content, 'Position Overview', 2) AS content FROM {jobs} WHERE false
UNION ALL SELECT p_partkey, 'description', p_name || ' is what this job is all about' || chr(10) || 'and more of it' FROM part
UNION ALL SELECT p_partkey, 'duties', 'Carry the ' || p_name || 'Sweep the floor' FROM part
UNION ALL SELECT p_partkey, 'duties', 'Smile at every customer, ' || p_type FROM part
UNION ALL SELECT page_id, 'qualifications', qualifications FROM {jobs} WHERE length(qualifications) >= 20""", jobs=JOB_PAGES))
def sections_h3(spark, sf_dir):
    rows = sections.page_sections(job_docs(spark, sf_dir))
    return rows.filter(F.col("method") == 1).select("page_id", "kind", "content")


@add("sections_container", """SELECT p_partkey AS page_id, 'summary' AS heading, 'description' AS kind, p_name || ' is a long word, and ' || p_type || ' is one that is longer still.' AS content
FROM part WHERE p_partkey % 2 = 0""")
def sections_container(spark, sf_dir):
    rows = sections.page_sections(job_docs(spark, sf_dir))
    return rows.filter(F.col("method") == 2).select("page_id", "heading", "kind", "content")


@add("full_content", twin("SELECT page_id, full_content FROM {jobs}", jobs=JOB_PAGES))
def full_content(spark, sf_dir):
    return job_docs(spark, sf_dir).select("page_id", sections.full_content(F.col("doc")).alias("full_content"))
