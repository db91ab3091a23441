"""Physical plans: what is shuffled, what is broadcast, what Python sees."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pagefacts.functions import nodes as N
from pagefacts.functions import urls
from pagefacts.operators import gate, jobs, links
from pagefacts.plans import flows, skew
from pagefacts.session import shared_folder
from pagefacts.sources.seen import SeenTable


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def test_records_use_python_once_and_no_shuffle(pages):
    plan = plan_of(jobs.job_records(N.with_doc(pages)))
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan and "Join" not in plan


def test_records_look_up_elements_by_their_places(pages):
    plan = plan_of(jobs.job_records(N.with_doc(pages)))
    assert re.search(r"doc#\d+\.places", plan)
    # No expression goes through all elements of a page.
    assert not re.search(r"(filter|transform|exists)\(doc#\d+\.nodes", plan)


def test_link_operators_read_a_page_once_without_shuffle(pages):
    for op in (links.anchors, links.pagination_links, links.fallback_job_links, links.route_links):
        plan = plan_of(op(pages))
        assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def test_cards_of_a_page_are_deduplicated_in_their_row(pages):
    cards = links.page_cards(N.with_doc(pages))
    for df in (cards, links.card_subtitles(cards)):
        assert "Exchange" not in plan_of(df)


def test_flows_start_no_job_while_they_are_built(spark, pages):
    pages = pages.withColumn("status_code", F.lit(200))
    spark.sparkContext.setJobGroup("building", "building")
    out = flows.crawl(pages.groupBy("page_id", "url", "status_code").agg(F.first("html").alias("html")))
    jobs.with_cards(jobs.job_records(N.with_doc(pages.withColumn("request_url", F.col("url"))), keep=("request_url", "page_id")), links.page_cards(N.with_doc(pages)))
    assert out.jobs.columns and out.links.columns and out.quarantine.columns
    assert not list(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))


def test_gate_reads_only_what_it_needs(pages):
    gated = gate.page_gate(pages.withColumn("status_code", F.lit(200)))
    plan = plan_of(gate.good_pages(gated).select("page_id"))
    assert "Python" not in plan and "Exchange" not in plan
    assert re.search(r"ReadSchema: struct<page_id:bigint,html:string>", plan)
    url_plan = plan_of(links.anchors(pages.select("page_id", "url", "html")).select("page_id"))
    assert "url:string" not in url_plan


def test_frontier_groups_before_it_joins(pages, no_broadcast):
    found = links.anchors(pages).select(F.col("href").alias("url"))
    plan = plan_of(links.frontier_new_links(found, pages.select("url")))
    join = plan.index("SortMergeJoin") if "SortMergeJoin" in plan else plan.index("ShuffledHashJoin")
    # One grouping per side; the join adds no exchange.
    assert plan.count("Exchange hashpartitioning") == 3
    assert "Aggregate" in plan[join:] and "Aggregate" not in plan[:join]
    # Before the first shuffle links collapse by hash and are not sorted.
    first = plan[: plan.index("FileScan")]
    first = first[first.rindex("Exchange hashpartitioning") :]
    assert "HashAggregate" in first and "Sort" not in first


def test_no_cartesian_products(spark, sf_dir):
    for name in ("card_job_join", "crawl_frontier", "field_dictionary_join", "seed_union_default", "resolve_attempts"):
        plan = plan_of(entry.queries()[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hot_url_is_split_by_adaptive_execution(spark, no_broadcast):
    # One key has a third of the rows; both sides are shuffled and its partition is dealt out.
    left = spark.range(60_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("load")
    ).repartition(8)
    right = spark.range(500).select(F.concat(F.lit("k"), "id").alias("url"), F.col("id").alias("v")).unionAll(
        spark.createDataFrame([("hot", 1000)], "url string, v long")
    )
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = skew.splittable_left_join(left, right.groupBy("url").agg(F.max("v").alias("v")), "url")
        rows = joined.collect()
        final = plan_of(joined).split("Initial Plan")[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "skew=true" in final
    assert len(rows) == 60_000 and sum(r.v == 1000 for r in rows) == 20_000


def test_every_copy_of_a_page_gets_the_first_card(spark):
    cards = spark.createDataFrame(
        [(1, 0, "u1", "A", [("k", "v")]), (2, 0, "u1", "later", [])],
        "page_id long, pos int, url string, title string, entries array<struct<key:string,value:string>>",
    )
    pages = spark.createDataFrame([(i, "u1") for i in range(50)] + [(99, "u2")], "page_id long, url string")
    out = jobs.card_job_join(pages, cards).collect()
    assert len(out) == 51
    assert {r.card.title for r in out if r.url == "u1"} == {"A"} and [r.card for r in out if r.url == "u2"] == [None]


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == named if named else shared_folder(spark)


def test_rows_are_dealt_out_before_they_hold_markup(spark, sf_dir, pages):
    for name in ("card_job_join", "job_record", "pagination_links", "resolve_attempts"):
        plan = plan_of(entry.queries()[name](spark, sf_dir))
        dealt = re.findall(r"RoundRobinPartitioning\(\d+\)[^\n]*\n(?:[^\n]*Filter[^\n]*\n)?[^\n]*FileScan[^\n]*ReadSchema: (\S+)", plan)
        assert len(dealt) == plan.count("RoundRobinPartitioning") > 0
        assert not [d for d in dealt if "html" in d or "text" in d]
    # The library's operators deal out nothing, nor do queries on given pages.
    assert "RoundRobinPartitioning" not in plan_of(entry.queries()["anchors"](spark, sf_dir))
    assert "RoundRobinPartitioning" not in plan_of(jobs.job_records(N.with_doc(pages)))


def test_nodes_are_read_once_per_page(spark, pages):
    docs = N.with_doc(pages.select("page_id", "url", "html"))
    assert plan_of(docs.select(F.size("doc.nodes"), "doc.chunks")).count("ArrowEvalPython") == 1


def test_a_round_does_not_shuffle_the_urls_seen(spark, tmp_path):
    seen = SeenTable(spark, str(tmp_path / "seen"), 4)
    found = spark.range(100).select(F.concat(F.lit("https://h.example.net/"), "id").alias("url"))
    seen.add(found, 0, "url")
    plan = plan_of(seen.new_links(found, 1))
    # What stands under the last sort is the side of the seen keys: filter and scan.
    side = plan[plan.rindex("+- Sort [url_key"):]
    assert "Bucketed: true" in side and "Exchange" not in side and "Broadcast" not in plan
    assert "Exchange" not in plan_of(seen.keys().groupBy("url_key").agg(F.min("round")))


def test_filters_on_pages_stay_above_the_dealing(spark, sf_dir):
    plan = entry.queries()["crawl_quarantine"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    below = [part.split("Relation [")[0] for part in plan.split("Repartition ")[1:]]
    assert len(below) > 3 and "maintenance" in plan
    assert not [part for part in below if "maintenance" in part]


def test_pages_are_judged_after_their_route(spark, pages):
    gated = flows._gated(pages.withColumn("status_code", F.lit(200)), gate.ERROR_PATTERNS, None)
    plan = flows._cards(gated)._jdf.queryExecution().optimizedPlan().toString()
    condition = plan[plan.rindex("Filter ") :]
    assert 0 < condition.index("LISTING") < condition.index("maintenance")


def test_staged_crawl_reads_a_listing_page_once(spark, monkeypatch, tmp_path):
    page = "<ul class=list><li class=list__item><div class=list__item__text__title><a href=/careers/JobDetail/x/7>X</a></div></ul>"
    page += "<a href=?jobOffset=20>Next</a><noscript><p>No <a href='?pageNumber=3'>3<a>open</noscript><a href='?jobOffset=9'>Go<noscript> back</noscript></a>"
    rows = [(i, f"https://b.example.net/careers/SearchJobs/?jobOffset={i}", 200, page + f"<a href='?jobOffset=1{i}'>&amp;</a>") for i in range(3)]
    rows.append((7, "https://b.example.net/careers/JobDetail/x/7", 200, "<h1>X</h1>"))
    given = spark.createDataFrame(rows, "page_id long, url string, status_code int, html string")
    plain, good = flows._good, []
    monkeypatch.setattr(flows, "_good", lambda gated, route: good.append(route) or plain(gated, route))
    out = flows.crawl_to(given, str(tmp_path))
    assert good.count(urls.LISTING) == 1
    listings = spark.read.parquet(f"{tmp_path}/listings").drop("url").join(given, "page_id")
    assert listings.filter(F.col("anchors") == N.page_anchors(F.col("html"))).count() == 3
    whole = flows.crawl(given)
    for a, b in ((out.links, whole.links), (out.jobs.drop("site"), whole.jobs)):
        assert sorted(map(str, a.select(b.columns).collect())) == sorted(map(str, b.collect()))
    assert [r.href for r in listings.filter("page_id = 0").selectExpr("inline(anchors)").collect()][1:5] == ["?jobOffset=20", "?pageNumber=3", None, "?jobOffset=9"]
