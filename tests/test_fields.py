"""Labelled fields, titles, sections and records on hand-made pages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pagefacts.functions import nodes as N
from pagefacts.operators import fields, jobs, links, sections, titles

URL = "https://board.example.net/careers/JobDetail/Night-Nurse/4711"


@pytest.fixture
def page(spark):
    def run(column, html, url=URL):
        df = spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")
        return N.with_doc(df).select(column.alias("x")).first()["x"]

    return run


def value(target, **options):
    D = F.col("doc")
    labels = options.pop("labels", fields.LABELS)
    return fields.best_value(fields.matches(fields.candidates(D, labels=labels), labels, **options), target)


def block(label, text):
    return (
        f"<div class='article__content__view__field'><div class='article__content__view__field__label'>{label}</div>"
        f"<div class='article__content__view__field__value'>{text}</div></div>"
    )


def test_label_order_beats_method_and_place(page):
    html = block("City", "field") + "<table><tr><th>Location</th><td>table</td></tr></table>"
    assert page(value("location"), html) == "table"


def test_method_beats_place(page):
    html = "<dl><dt>Location</dt><dd>term</dd></dl>" + block("Location", "field")
    assert page(value("location"), html) == "field"


def test_first_place_wins(page):
    html = block("Location", " ") + block("Location", "one") + block("Location", "two")
    assert page(value("location"), html) == "one"


def test_label_contained_in_the_dictionary_label(page):
    html = block("Job #", "28435")
    assert page(value("location"), html) == "28435"
    assert page(value("location", strict=True), html) is None
    assert page(value("refNumber", strict=True), html) == "28435"


def test_empty_label_matches_nothing(page):
    assert page(value("location"), block(" :# ", "x")) is None


def test_value_limits(page):
    assert page(value("location"), block("Location", "x" * 500)) is None
    assert page(value("location"), block("Location", "x" * 499)) == "x" * 499
    assert page(value("location"), "<div>location</div><div>" + "x" * 200 + "</div>") is None
    assert page(value("location"), "<div>location</div><span>here</span>") == "here"
    assert page(value("location"), "<div>location</div><span>Business area</span>") is None


def test_bold_label_takes_the_text_behind_it(page):
    assert page(value("salaryRaw"), "<p>Our <b>Salary Range</b> : – $5 <i>a day</i></p>") == "$5 a day"
    assert page(value("salaryRaw"), "<p><b>Salary</b> twigConfig 5</p>") is None
    # The outer container is tried first, as long as its rest is short.
    assert page(value("salaryRaw"), "<div><p><b>Salary</b> 5</p><p>more</p></div>") == "5more"
    assert page(value("salaryRaw"), "<div><p><b>Salary</b> 5</p><p>" + "m" * 500 + "</p></div>") == "5"


def test_term_needs_its_value_next_to_it(page):
    assert page(value("location"), "<dl><dt>Location</dt><dt>x</dt><dd>no</dd></dl>") is None


def test_own_dictionary(page):
    labels = {"color": ("colour", "color")}
    assert page(value("color", labels=labels), block("Color", "red")) == "red"


def test_values_by_number_are_those_of_the_rows(page):
    labels = {"a": ("site", "place", "work place"), "b": ("place", "type", "job type"), "c": ("ref #",)}
    html = (
        block("Place", "1") + block("Work", "2") + block(" Job # ", "3") + "<dl><dt>Job type<dd>4<dt>Site<dd>5</dl>"
        "<p><b>Work place:</b> 6</p><table><tr><th>Ref #<td>7<tr><th>Type<td>8</table><span>Site:</span><span> 9 </span><div>type</div><div>10</div>"
    )
    for strict in (False, True):
        keys = fields.match_keys(fields.candidates(F.col("doc"), labels=labels), labels, strict)
        cands = fields.candidates(F.col("doc"), labels=labels)
        got = page(F.struct(*[fields.value_by_key(cands, keys, t, labels).alias(t) for t in labels]), html)
        want = page(F.struct(*[value(t, labels=labels, strict=strict).alias(t) for t in labels]), html)
        assert got == want and got["a"] is not None


def test_text_fields(page):
    D = F.col("doc")
    html = "<body>x\nLocation: Rome, Italy\n Department: Sales\n</body>"
    body = N.body_text(D)
    assert page(fields.field_from_text(body, ("Location",)), html) == "Rome, Italy"
    assert page(fields.field_from_text(body, ("Department",)), html) == "Sales"
    assert page(fields.field_from_text(body, ("Ref #",)), html) is None
    html = "<body>Location: " + "y" * 300 + "</body>"
    assert page(fields.field_from_text(body, ("Location",)), html) is None


def test_pattern_on_content_then_body(page):
    D = F.col("doc")
    content = fields.text_by_pattern(fields.content_text(D), fields.REF_PATTERN)
    assert page(content, "<body>Ref # 1<main>Job # 2</main></body>") == "2"
    assert page(content, "<body>Ref # 1<main></main></body>") == "1"


@pytest.mark.parametrize(
    "html, want",
    [
        ("<meta property='og:title' content=' Chief Cook '><title>No - 1 - X</title>", "Chief Cook"),
        ("<meta property='og:title' content='Cook'><title>Head Cook - 12 - Site</title>", "Head Cook"),
        ("<title>Head Cook | Site</title>", "Head Cook"),
        ("<title>Cook - Site</title><main><h1>Our Careers</h1></main><article><h1>Main Cook</h1></article>", "Main Cook"),
        ("<header><h1>Some Header</h1></header>", "Some Header"),
        ("<h1 class=sr-only>Hidden one</h1><h1>Big Board</h1>", "Hidden one"),
        ("<h1>Acme  Foods</h1>", "Night Nurse"),
        ("<div class='a-detail-b'><h1>" + "x" * 200 + "</h1></div>", "Night Nurse"),
    ],
)
def test_titles(page, html, want):
    D = F.col("doc")
    assert page(titles.job_title(D, F.col("url"), (r"acme\s*foods",)), html) == want


def test_sections(page):
    D = F.col("doc")
    html = (
        "<h3>About the role</h3><p>short description text</p><p>Press space or enter keys</p><div>second part</div>"
        "<h3>Your skills</h3><p>can juggle five balls</p><h2>x</h2><p>not this</p>"
        "<h3>Experience</h3><p>juggled for many years</p>"
        "<section><h4>Duties</h4><ul><li>throw</li></ul><p>and catch the balls</p></section>"
        "<details><summary>Overview</summary><p>a description that is a good deal longer than the first one</p></details>"
    )
    h3, boxes = sections.heading_sections(D), sections.container_sections(D)
    assert page(sections.description(h3, boxes), html).startswith("a description that")
    # The section and the details follow the last h3, so they belong to it.
    assert page(sections.qualifications(h3, boxes), html).startswith("can juggle five balls\njuggled for many years\nDuties")
    assert page(sections.duties(h3, boxes), html) == "throwand catch the balls"
    only = "<h3>Job description</h3><p>exactly this one, twenty</p><h3>Overview</h3><p>exactly that one, twenty</p>"
    assert page(sections.description(h3, boxes), only) == "exactly this one, twenty"
    assert page(sections.duties(h3, boxes), only) is None


def test_full_content(page):
    D = F.col("doc")
    assert page(sections.full_content(D), "<div role=main> a <b>b</b> </div><main>c</main>") == "a b"
    assert page(sections.full_content(D), "<p>x</p>") == ""


def test_apply_link(page):
    D = F.col("doc")
    found = links.apply_url(D, F.col("url"))
    assert page(found, "<a>Apply</a><a href='x'>Apply</a>") == "https://board.example.netx"
    assert page(found, "<a href='/n'>APPLY</a>") is None


def test_record_columns_and_values(spark):
    html = (
        "<body><main>" + block("Location", "Oslo") + block("Posted", "02-Feb-2026") + block("Job number", "4711")
        + "<p><strong>Salary</strong>: $10 - $12.50 hourly</p></main></body>"
    )
    df = spark.createDataFrame(
        [(1, "https://old.example.net/", URL, html, dt.datetime(2026, 1, 2, 3, 4, 5))],
        "page_id long, url string, loaded_url string, html string, scraped_at timestamp",
    )
    records = jobs.job_records(N.with_doc(df))
    assert tuple(records.columns) == jobs.JOB_COLUMNS + jobs.TYPED_COLUMNS
    row = records.first()
    assert (row.url, row.jobId, row.refNumber, row.subdomain) == (URL, "4711", None, "board")
    assert (row.title, row.location, row.postedDate) == ("Night Nurse", "Oslo", "2026-02-02")
    assert (row.salaryMin, row.salaryMax, row.salaryPeriod) == ("10", "12.50", "hourly")
    assert (str(row.salary_max_num), row.posted_date) == ("12.5000", dt.date(2026, 2, 2))
    assert row.additional is None and row.scrapedAt == dt.datetime(2026, 1, 2, 3, 4, 5)


def test_card_values_come_first_unless_empty(spark):
    html = "<body>" + block("Location", "Oslo") + block("Department", "Sea") + "</body>"
    card = {"title": "", "subtitles": {"location": "", "locationBuiltIn": "Bergen", "department": "", "ref": "Ref #77"}}
    df = spark.createDataFrame([(1, URL, html, card)], f"page_id long, url string, html string, card {jobs.CARD_TYPE}")
    row = jobs.job_records(N.with_doc(df)).first()
    assert (row.title, row.location, row.department, row.refNumber) == ("Night Nurse", "Bergen", "Sea", "77")
    assert row.additional["ref"] == "Ref #77"


def test_later_subtitle_wins_and_default(spark):
    html = (
        "<div class='section__content__results'><article class='article'><h3 class='article__header__text__title'><a href='j/1'>T</a></h3>"
        "<p class='article__header__text__subtitle'><i class='list-item-a b'>1</i><i class='x list-item-a'>no</i><i class='list-item-a'>2</i>"
        "<i class='list-item-'>none</i></p><p class='article__header__text__subtitle'>plain</p></article></div>"
    )
    df = spark.createDataFrame([(1, URL, html)], "page_id long, url string, html string")
    cards = links.listing_cards(N.with_doc(df))
    row = cards.select("url", "title", links.subtitle_map(F.col("entries")).alias("m")).first()
    assert (row.url, row.title) == ("https://board.example.net/j/1", "T")
    assert row.m == {"a": "2", "default": "plain"}


def test_cards_after_the_page_equal_cards_before(spark):
    """Joining cards to records gives what reading the pages with their cards gives."""
    html = "<body>" + block("Location", "Oslo") + block("Department", "Sea") + block("Requisition", "R9") + "</body>"
    pages = spark.createDataFrame(
        [(1, URL, html), (2, URL + "?x", html), (3, URL, "<body></body>")], "page_id long, url string, html string"
    )
    entries = [("location", ""), ("department", "Air"), ("ref", "REF #4711")]
    cards = spark.createDataFrame(
        [(7, 0, URL, "Card title", entries)],
        "page_id long, pos int, url string, title string, entries array<struct<key:string,value:string>>",
    )
    before = jobs.job_records(N.with_doc(jobs.card_job_join(pages, cards)))
    records = jobs.job_records(N.with_doc(pages.withColumn("request_url", F.col("url"))), keep=("request_url", "page_id"))
    after = jobs.with_cards(records, cards)

    def rows(df):
        return sorted((r.asDict() for r in df.collect()), key=str)

    assert before.columns == after.columns and rows(before) == rows(after)
    row = [r for r in rows(after) if r["location"] == "Oslo" and r["title"] == "Card title"][0]
    assert (row["department"], row["refNumber"], row["additional"]["ref"]) == ("Air", None, "REF #4711")


def test_link_flags(spark):
    html = "<a href='mailto:x?SearchJobs'>m</a><a href='//cdn/SearchJobs'>c</a><a href='/SearchJobs'>s</a><a href='https://o.net/SearchJobs'>o</a>"
    df = spark.createDataFrame([(1, URL, html)], "page_id long, url string, html string")
    compat = [r.url for r in links.pagination_links(df).orderBy("pos").collect()]
    base = "https://board.example.net"
    assert compat == [base + "/mailto:x?SearchJobs", base + "//cdn/SearchJobs", base + "/SearchJobs", "https://o.net/SearchJobs"]
    pages = links.pagination_links(df, pages_only=True)
    assert [r.url for r in pages.orderBy("pos").collect()] == compat[2:]
    paired = pages.withColumn("page", F.lit(URL))
    assert [r.url for r in links.same_host_links(paired, "page").collect()] == [base + "/SearchJobs"]
