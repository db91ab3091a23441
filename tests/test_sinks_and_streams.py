"""Files as they lie on disk, and streams against their batch results."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from pagefacts.functions import urls
from pagefacts.operators import gate, hosts, links, report
from pagefacts.plans import flows
from pagefacts.sources import readers, sinks
from pagefacts.sources.seen import SeenTable
from pagefacts.streaming import stream as S


def lines(path):
    return [line for f in sorted(glob.glob(f"{path}/part-*")) for line in open(f, encoding="utf-8").read().splitlines()]


def test_csv_quotes_only_where_needed(spark, tmp_path):
    rows = spark.createDataFrame(
        [("b", " x ", 1, 2), ("a", 'say "hi", now', None, 1), ("c", None, 3, 3), ("d", "", 4, 4)],
        "host string, error string, jobs int, pos int",
    )
    sinks.write_csv(rows, str(tmp_path / "c"), [F.col("pos")])
    text = [line for line in lines(tmp_path / "c") if not line.startswith("host,")]
    assert text == ['a,"say ""hi"", now",,1', "b, x ,1,2", "c,,3,3", "d,,4,4"]


def test_host_lists(spark, tmp_path):
    df = spark.createDataFrame([('b"x',), ("a",)], "host string")
    sinks.write_hosts(df, str(tmp_path / "l"))
    assert sorted(json.loads(line) for line in lines(tmp_path / "l")) == ["a", 'b"x']
    assert sorted(r.host for r in readers.read_host_list(spark, str(tmp_path / "l")).collect()) == ["a", 'b"x']


def test_host_list_keeps_file_order(spark, tmp_path):
    path = tmp_path / "hosts.json"
    path.write_text(json.dumps([f"h{i}" for i in range(50)], indent=2))
    got = [r.host for r in readers.read_host_list(spark, str(path)).orderBy("pos").collect()]
    assert got == [f"h{i}" for i in range(50)]


def test_page_rows_pretty_printed_and_corrupt(spark, tmp_path):
    rows = [{"url": "u", "title": "t", "h1": "h", "article": " a "}, {"url": "v", "title": "", "h1": "", "article": ""}]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=2))
    got = readers.read_page_rows(spark, str(tmp_path / "a.json")).orderBy("url")
    assert [tuple(r)[:4] for r in got.collect()] == [("u", "t", "h", " a "), ("v", "", "", "")]
    (tmp_path / "b.json").write_text("not json\n" + json.dumps(rows[0]))
    bad = readers.read_page_rows(spark, str(tmp_path / "b.json"), multi_line=False).cache()
    assert bad.filter(F.col("_corrupt_record").isNotNull()).count() == 1 and bad.filter("url = 'u'").count() == 1


def test_html_files(spark, tmp_path):
    for name in ("samples/acme/job-1.html", "samples/acme/x/job-listing.html", "samples/beta/other.html", "samples/no.txt", "samples/top.html"):
        f = tmp_path / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("<p>" + name)
    got = {(r.site, r.name, r.page_type) for r in readers.read_html_files(spark, str(tmp_path)).collect()}
    assert got == {
        ("acme", "job-1.html", "JOB DETAIL PAGE"), ("acme", "job-listing.html", "LISTING PAGE"),
        ("beta", "other.html", "UNKNOWN PAGE"), ("unknown", "top.html", "UNKNOWN PAGE"),
    }


def test_pattern_order_of_the_gate(spark):
    texts = {
        "not found, job closed": "PAGE_NOT_FOUND", "job has been closed": "JOB_CLOSED", "a maintenance technician": "MAINTENANCE",
        "jobclosed": "JOB_CLOSED", "the position\nis no longer available": "JOB_CLOSED", "fine": None,
    }
    df = spark.createDataFrame([(k,) for k in texts], "t string")
    got = {r.t: r.e for r in df.select("t", gate.error_type_of_text(F.col("t")).alias("e")).collect()}
    assert got == texts


def test_every_needle_is_in_its_pattern():
    for p in gate.ERROR_PATTERNS:
        assert p.needle in p.pattern


def test_the_whole_body_counts_unless_a_limit_is_given(spark):
    df = spark.createDataFrame([(1, "<body>" + "x " * 2600 + "not found</body>", 200), (2, "<body>not found", None)], "page_id int, html string, status_code int")
    got = {r.page_id: r.error_type for r in gate.page_gate(df).collect()}
    assert got == {1: "PAGE_NOT_FOUND", 2: "PAGE_NOT_FOUND"}
    cut = {r.page_id: r.error_type for r in gate.page_gate(df, text_limit=gate.TEXT_LIMIT).collect()}
    assert cut == {1: None, 2: "PAGE_NOT_FOUND"}


def test_a_failed_fetch_is_no_good_page(spark):
    rows = [(1, None, None, None), (2, "<p>ok</p>", 200, None), (3, "<p>ok</p>", None, "ENOTFOUND x"), (4, None, 503, None)]
    df = spark.createDataFrame(rows, "page_id int, html string, status_code int, error_message string")
    gated = gate.page_gate(df, error="error_message")
    assert {r.page_id: r.error_type for r in gated.collect()} == {1: "REQUEST_FAILED", 2: None, 3: "DNS_ERROR", 4: "SERVER_ERROR"}
    assert {r.page_id: r.html for r in gate.quarantine(gated).collect()}[1] == "<title>No page</title><p>no page</p>"


def test_a_pattern_needs_no_needle(spark):
    df = spark.createDataFrame([("<body>gone away",)], "html string")
    own = (gate.ErrorPattern(None, "(gone|lost)", "GONE"),)
    assert df.select(gate.content_error_type(F.col("html"), own).alias("e")).first().e == "GONE"


def test_total_jobs_traps(spark):
    cases = {"1,234 results": 234, "0 jobs matching, 7 results": 7, "607 results found": 607, "no number": None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.n for r in df.select("t", hosts.total_from_text(F.col("t")).alias("n")).collect()}
    assert got == cases


def test_attempts_all_retryable_take_the_last(spark):
    rows = [("a", 1, 429, "", None), ("a", 2, None, None, "AbortError"), ("a", 4, 404, "", None), ("c", 1, None, None, "proxy timeout"), ("c", 2, 404, "", None), ("b", 1, 499, "", None), ("b", 2, 404, "", None), ("b", 3, 200, "x", None)]
    df = spark.createDataFrame(rows, "host string, attempt int, status_code int, html string, error_message string")
    got = {r.host: (r.attempt, r.status, r.error, r.listing_url) for r in flows.host_check(df).collect()}
    assert got["a"] == (2, "error", "Timeout", "https://a/careers/SearchJobs")
    assert got["c"][:3] == (1, "error", "proxy timeout")
    assert got["b"][:3] == (2, "not_working", "Page not found")


def test_zero_counts_are_shown(spark):
    df = spark.createDataFrame([("valid",)], "status string")
    assert {tuple(r) for r in report.status_counts(df).collect()} == {("valid", 1), ("not_valid", 0), ("js_required", 0)}


@pytest.fixture
def arriving(spark, sf_dir, tmp_path):
    """The given pages in five files, so that a stream sees several batches."""
    path = str(tmp_path / "pages")
    df = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumn("status_code", F.expr("CASE WHEN page_id % 5 = 0 THEN 404 ELSE 200 END"))
    df.repartition(5).write.parquet(path)
    return df, lambda: readers.stream_pages(spark, path, df.schema, files_per_batch=2)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_gate_equals_batch(spark, arriving, tmp_path):
    batch, source = arriving
    out = S.run(spark, S.gate_stream, source())
    want = gate.page_gate(batch)
    assert same(S.read_gate(spark, out, True).select("page_id", "html"), gate.good_pages(want).select("page_id", "html"))
    assert same(S.read_gate(spark, out, False).select("page_id", "error_type"), gate.quarantine(want).select("page_id", "error_type"))


def test_stream_first_seen_equals_batch_and_survives_a_restart(spark, arriving, tmp_path):
    batch, source = arriving

    def found(pages):
        return links.anchors(pages).select(urls.resolve_url(urls.base_url(F.col("url")), F.col("href")).alias("url"))

    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    for _ in range(2):
        S.run_to_end(S.first_seen_stream(found(source()), out, checkpoint))
    got = spark.read.parquet(out)
    want = found(batch).select(urls.url_unique_key(F.col("url")).alias("url_key")).distinct()
    assert same(got.select("url_key"), want)


def test_stream_counts_equal_batch(spark, arriving):
    batch, source = arriving
    out = S.run(spark, S.status_counts_stream, source())
    gated = gate.page_gate(batch)
    want = gated.groupBy(
        urls.site_key(F.col("url"), invalid="unknown").alias("site"), F.coalesce("error_type", F.lit("PASS")).alias("verdict")
    ).count()
    assert same(S.latest_counts(spark, out).select("site", "verdict", "n"), want.select("site", "verdict", F.col("count").alias("n")))


def test_a_batch_that_runs_twice_counts_once(spark, tmp_path):
    df = spark.range(3)
    for _ in range(2):
        df.write.mode("overwrite").parquet(str(tmp_path / "batch_id=0"))
    assert spark.read.parquet(str(tmp_path)).count() == 3


def test_first_seen_with_a_watermark(spark, arriving, tmp_path):
    _, source = arriving
    stamped = source().select("url", F.to_timestamp(F.lit("2024-01-01")).alias("arrived"))
    out = S.run(spark, S.first_seen_stream, stamped, arrival="arrived")
    keys = spark.read.parquet(out)
    assert keys.count() == keys.select("url_key").distinct().count() > 0


def keys_of(df):
    return sorted(r.url_key for r in df.select("url_key").collect())


def test_seen_table_gives_each_key_once_and_outlives_its_session(spark, tmp_path):
    path = str(tmp_path / "seen")
    found = spark.range(900).select(F.concat(F.lit("https://h.example.net/"), F.col("id") % 300, F.lit("/#"), F.col("id")).alias("url"))
    seen = SeenTable(spark, path, 4)
    assert seen.keys().count() == 0
    seen.add(found.filter("url like '%7'"), 0, "url")
    first = keys_of(seen.keys())
    fresh = seen.new_links(found, 1)
    assert keys_of(fresh) == sorted(set(keys_of(links.frontier_new_links(found, seen.keys().withColumnRenamed("url_key", "url")))))
    seen.add(fresh, 1)
    seen.add(seen.new_links(found, 1), 1)  # the round again: the same links, and nothing changes
    assert seen.new_links(found, 2).count() == 0 and len(set(keys_of(seen.keys()))) == 300
    assert keys_of(seen.keys(1)) == first
    # A compaction that stopped half way does not count.
    (tmp_path / "seen" / "generation=1").mkdir()
    (tmp_path / "seen" / "generation=1" / "part-00000-junk_00000.c000.snappy.parquet").write_bytes(b"half")
    assert SeenTable(spark, path, 4).generation == 0
    seen.compact()
    assert keys_of(seen.keys()) == sorted(set(keys_of(seen.keys()))) and seen.keys().count() == 300 and len(seen.keys().inputFiles()) <= 4
    again = SeenTable(spark, path, 4)
    assert again.generation == 1 and again.new_links(found, 2).count() == 0 and again.new_links(found, 1).count() == 300 - len(first)
    again.add(found.limit(0), 2, "url")
    assert again.keys().count() == 300


def test_first_seen_by_table_equals_batch_and_repeats(spark, arriving, tmp_path):
    batch, source = arriving

    def found(pages):
        return links.anchors(pages).select(urls.resolve_url(urls.base_url(F.col("url")), F.col("href")).alias("url"))

    want = keys_of(found(batch).select(urls.url_unique_key(F.col("url")).alias("url_key")).distinct())
    out, seen = str(tmp_path / "o"), SeenTable(spark, str(tmp_path / "seen"), 4)
    S.run_to_end(S.first_seen_table_stream(found(source()), out, str(tmp_path / "c"), seen))
    assert keys_of(spark.read.parquet(out)) == want
    # A fresh checkpoint stands for batches that run again: the same rounds write the same links.
    S.run_to_end(S.first_seen_table_stream(found(source()), out, str(tmp_path / "c2"), seen))
    assert keys_of(spark.read.parquet(out)) == want
    S.run_to_end(S.first_seen_table_stream(found(source()), str(tmp_path / "o2"), str(tmp_path / "c3"), seen, first_round=1000))
    assert spark.read.parquet(str(tmp_path / "o2")).count() == 0


def test_counts_from_the_state_equal_those_from_batches(spark, arriving):
    _, source = arriving
    out = S.run(spark, S.status_counts_stream, source())
    assert same(S.current_counts(spark, S.checkpoint_of(out)), S.latest_counts(spark, out).select("site", "verdict", "n"))


def test_a_run_written_again_replaces_itself(spark, tmp_path):
    jobs = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z")], "id long, subdomain string, title string")
    path = str(tmp_path)
    for run_id, rows in (("r1", jobs), ("r2", jobs), ("r1", jobs), ("r1", jobs.filter("id <> 2"))):
        sinks.write_jobs(rows, path, run_id=run_id)
    got = sorted((r.run_id, r.site, r.id) for r in spark.read.parquet(path).collect())
    assert got == [("r1", "a", 1), ("r1", "unknown", 3), ("r2", "a", 1), ("r2", "b", 2), ("r2", "unknown", 3)]
    with pytest.raises(ValueError):
        sinks.write_jobs(jobs, path, run_id="a/b")


def test_one_line_arrays_are_split_over_tasks(spark, tmp_path):
    odd = ["", ",", '"', "\\", '\\"', '","', "],[", "ü", " x ", '\\\\"']
    hosts_ = [[f"h{i}.example.net{odd[i % len(odd)] if i % 7 == 0 else ''}" if i % 11 else odd[i % len(odd)] for i in range(n)] for n in (20_000, 0, 3000, 1)]
    for i, names in enumerate(hosts_):
        text = json.dumps(names, ensure_ascii=False) if i % 2 == 0 else json.dumps(names, indent=1)
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key, value in zip(before, ("65536", "1024")):
            spark.conf.set(key, value)
        assert spark.read.option("lineSep", '"').text(str(tmp_path / "0.json")).rdd.getNumPartitions() >= 4
        for _ in range(2):
            got = readers.read_host_list(spark, str(tmp_path)).orderBy("pos").collect()
            assert [r.pos for r in got] == list(range(sum(map(len, hosts_))))
            assert [r.host for r in got] == [h for names in hosts_ for h in names]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_positions_count_over_files(spark, tmp_path):
    for i, n in enumerate((3, 1000, 1)):
        (tmp_path / f"{i}.txt").write_text("".join(f"https://h{i}/{k}\n" for k in range(n)))
    for _ in range(2):
        got = readers.read_url_lines(spark, str(tmp_path)).orderBy("pos").collect()
        assert [(r.pos, r.url) for r in got] == list(enumerate(f"https://h{i}/{k}" for i, n in enumerate((3, 1000, 1)) for k in range(n)))


def test_sketches_of_runs_unite_to_the_exact_count_nearly(spark, tmp_path):
    jobs = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("subdomain"), (F.col("id") % 90_000).alias("jobId"))
    jobs = jobs.unionByName(jobs.limit(10).select("subdomain", F.lit(None).cast("long").alias("jobId")))
    for run_id, some in (("a", jobs.filter("jobId % 2 = 0 or jobId is null")), ("b", jobs), ("b", jobs.filter("jobId % 5 < 4"))):
        sinks.write_run(report.job_sketches(some), str(tmp_path), run_id)
    united = spark.read.parquet(str(tmp_path))
    assert united.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    got = {r.subdomain: r.unique_jobs for r in report.unique_jobs_of(united).collect()}
    want = {r.subdomain: r.unique_jobs for r in report.unique_jobs(jobs.filter("jobId % 2 = 0 or jobId % 5 < 4")).collect()}
    errors = {k: abs(got[k] - want[k]) / want[k] for k in want}
    assert set(got) == set(want) and max(errors.values()) < 0.03, errors
    assert report.unique_jobs_of(united.limit(0)).collect() == []


def test_a_stream_reads_tables_of_several_files(spark, tmp_path, sf_dir):
    from pagefacts import catalog

    for table in ("pages", "events"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    for name, query in catalog.queries().items():
        if name.startswith("stream_"):
            got, want = (sorted(query(spark, folder).collect()) for folder in (str(tmp_path), sf_dir))
            assert want and got == want, name


def test_saved_pages_are_one_file_each_in_few_folders(spark, tmp_path, sf_dir, monkeypatch):
    from pagefacts.catalog import sources

    monkeypatch.setattr(sources, "scratch_path", lambda spark, name: str(tmp_path / name))
    found = sources.src_html_samples(spark, sf_dir)
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert found.count() == rows == len(glob.glob(f"{tmp_path}/samples/*/*/part-*"))
    assert len(glob.glob(f"{tmp_path}/samples/*/*")) == found.select("site", "page_type").distinct().count() < rows


def test_count_patterns_run_only_where_their_word_is(spark):
    assert set(hosts.COUNT_NEEDLES) == set(hosts.COUNT_PATTERNS) and all(n in p for p, n in hosts.COUNT_NEEDLES.items())
    texts = {"12 OPEN Positions": 12, "We FOUND 7 jobs": 7, "showing 1 - 9 OF 33": 33, "0 results, 4 Opportunities": 4, "9 lives": None, "": None}
    df = spark.createDataFrame([(k,) for k in texts], "t string")
    assert {r.t: r.n for r in df.select("t", hosts.total_from_text(F.col("t")).alias("n")).collect()} == texts
