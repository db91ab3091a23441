"""Fill-in-middle, filter audit and license scans against SQL, brute force and odd rows."""

import hashlib
import itertools
import random
import re
from fractions import Fraction

import duckdb
import pyarrow as pa
import pytest
from check_queries import rows_of
from pyspark.sql import functions as F

from pagefacts.llm import common, fill_in_middle, filter_audit, licenses

SCHEMA = "doc_id long, text string, lang string, source string, n string, output int, part int, row int"
LONG = "word and line\n" * 30_000 + "é end"
GPL = licenses.TEMPLATES[0].text
ODD = [
    (1, None, None, None, None, None, None, None),
    (2, "", "en", "a", "x", 1, 1, 1),
    (2, "", "en", "a", "x", 1, 1, 1),
    (3, "one two\nthree é\n\nfour", "en", "a", "x", 1, 1, 1),
    (4, "one two\nthree é\n\nfour", "fr", "a", "x", 1, 1, 1),
    (4, "one two\nthree é\n\nfour", "fr", "a", "x", 1, 1, 1),
    (4, "another text of one id\r\n", "fr", None, "x", 1, 1, 1),
    (None, "one two\nthree é\n\nfour", "fr", "a", "x", 1, 1, 1),
    (None, "\n\n\n", "", "a", "x", 1, 1, 1),
    (7, LONG, "de", "b", "x", 1, 1, 1),
    (8, "holds <S> and\nmore", "de", "b", "x", 1, 1, 1),
    (9, "< <P <M\nM> S>\x00\x0b日本", "de", "b", "x", 1, 1, 1),
    (10, "SHOUTING & SIGNS #1\n" * 60, "en", "b", "x", 1, 1, 1),
    (11, "GNU  General-Public License, cc by; MIT License. apache\nlicense CC BY-NC", "en", "b", "x", 1, 1, 1),
    (12, "plain words " * 300 + GPL.replace("terms", "rules") + " more words" * 300, "en", "b", "x", 1, 1, 1),
    (13, " ".join(f"{w} x{i}" for i, w in enumerate(GPL.split())), "en", "b", "x", 1, 1, 1),
]
LABELS = [(2, 1, 0), (2, 1, 1), (3, 1, 1), (4, None, None), (10, 1, 0), (None, 1, 1), (99, 1, 1)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def by_sql(sql, docs=ODD, marks=LABELS):
    con = duckdb.connect()
    columns = list(zip(*docs)) or [[], []]
    documents = pa.table({"doc_id": pa.array(columns[0], pa.int64()), "text": pa.array(columns[1], pa.string()), "lang": pa.array(columns[2] if docs else [], pa.string())})
    found = list(zip(*marks)) or [[], [], []]
    held = pa.table({k: pa.array(v, pa.int64()) for k, v in zip(("doc_id", "quality", "toxic"), found)})
    con.register("documents", documents)
    con.register("labels", held)
    res = con.execute(sql)
    return rows_of([d[0] for d in res.description], res.fetchall())


def by_spark(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def fim_digests(rows):
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(back).alias("restored_sha256"))


def test_fill_in_middle_on_odd_rows_equals_sql(spark, odd):
    sql = fill_in_middle.SQL["op11_fill_in_middle"]
    assert by_spark(fim_digests(fill_in_middle.fill_in_middle(odd))) == by_sql(sql)
    assert fill_in_middle.fill_in_middle(odd.limit(0)).collect() == []
    with pytest.raises(ValueError):
        fill_in_middle.fill_in_middle(odd, keep=("doc_id", "output"))


def test_fill_in_middle_gives_the_texts_back(spark, odd):
    rows = fill_in_middle.fill_in_middle(odd.filter("doc_id is not null").dropDuplicates(["doc_id"]), keep=("doc_id", "text"), rate=50).collect()
    forms = set()
    for r in rows:
        text = r.text or ""
        if r.form == "plain":
            assert r.output == text and r.prefix_chars is None
            continue
        forms.add(r.form)
        p, m = text[: r.prefix_chars], text[r.prefix_chars : r.prefix_chars + r.middle_chars]
        s = text[r.prefix_chars + r.middle_chars :]
        assert r.output == (f"<P>{p}<S>{s}<M>{m}" if r.form == "psm" else f"<S>{s}<P>{p}<M>{m}")
        assert all(x == "" or x == text or x[-1] == "\n" or text.endswith(x) for x in (p, p + m))
    assert {r.form for r in rows} > forms


def test_chunks_follow_content_and_count_like_the_whole():
    rng = random.Random(3)
    passage = bytes(rng.randrange(32, 127) for _ in range(9000))
    texts = [b"", b"x", passage, b"other start\n" * 40 + passage + b"<P>", passage[:500] + b"<" * 70_000 + "é日\n".encode() * 50_000]
    ends = fill_in_middle.chunk_ends(texts)
    assert ends == [fill_in_middle.chunk_ends([t])[0] for t in texts]
    cut = [[t[a:b] for a, b in zip([0, *e], e)] for t, e in zip(texts, ends)]
    assert [b"".join(c) for c in cut] == texts
    assert len(set(cut[2]) & set(cut[3])) >= len(cut[2]) - 2
    assert all(0 < len(c) <= fill_in_middle.LONGEST for parts in cut for c in parts)
    for size in (1, 2, 3, 7):  # marks and characters over every border
        data = "a<P\n>é<M>日\n<<S>".encode() * 3
        total = fill_in_middle.NOTHING
        for i in range(0, len(data), size):
            total = fill_in_middle.combined(total, fill_in_middle.summary_of(data[i : i + size]))
        assert total == fill_in_middle.summary_of(data)
    few = fill_in_middle.Chunks(most=3000)
    for data, e in zip(texts, ends):
        text = fill_in_middle.Text(data, e, few)
        lines = re.findall(rb"[^\n]*\n|[^\n]+", data)
        assert text.n == len(lines) and text.total == fill_in_middle.summary_of(data)
        for units in {0, 1, len(lines) // 2, len(lines)}:
            start = b"".join(lines[:units])
            assert text.after(min(units, len(lines))) == (len(start), len(start.decode()))
    assert len(b"".join(few.new)) <= 3000 + fill_in_middle.LONGEST
    shared = fill_in_middle.Chunks()
    fill_in_middle.Text(texts[2], ends[2], shared)
    fill_in_middle.Text(texts[3], ends[3], shared)
    assert shared.hits >= len(ends[2]) - 2


def test_filter_audit_on_odd_rows_equals_sql(odd, labels):
    got = filter_audit.audit(filter_audit.failures(odd, labels))
    want = by_sql(filter_audit.SQL["op12_filter_audit"])
    assert by_spark(got) == want
    assert got.count() == 600 * len({r[2] or "" for r in ODD})
    assert filter_audit.audit(filter_audit.failures(odd.limit(0), labels)).collect() == []
    none = filter_audit.audit(filter_audit.failures(odd, labels.limit(0)))
    assert by_spark(none) == by_sql(filter_audit.SQL["op12_filter_audit"], marks=[])


def test_filter_audit_counts_every_order_by_walking_it(spark):
    rng = random.Random(5)
    rows = [(rng.choice("xy"), rng.randrange(8), rng.random() < 0.4, rng.random() < 0.2, 1) for _ in range(200)]
    patterns = spark.createDataFrame(rows, "part string, fails int, good boolean, toxic boolean, docs long")
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit(patterns, "ABC").collect()}
    shares = {}
    for part in "xy":
        for order in itertools.permutations("ABC"):
            left = [r for r in rows if r[0] == part]
            everyone = len(left)
            for step, name in enumerate(order, 1):
                bit = 1 << "ABC".index(name)
                gone = [r for r in left if r[1] & bit]
                left = [r for r in left if not r[1] & bit]
                r = got[part, "".join(order), step]
                all_failing = sum(1 for x in rows if x[0] == part and x[1] & bit)
                assert (r.kept, r.removed, r.redundant) == (len(left), len(gone), all_failing - len(gone)) and everyone >= r.kept
                assert (r.good_lost, r.toxic_lost) == (sum(x[2] for x in gone), sum(x[3] for x in gone))
                assert r.unique_fails == sum(1 for x in rows if x[0] == part and x[1] == bit)
                shares[part, name] = shares.get((part, name), 0) + len(gone)
    assert {(p, o[s - 1]): r.shapley for (p, o, s), r in got.items()} == shares


def test_least_squares_give_the_shapley_weights():
    import math

    for n in (2, 3, 5):
        weights = filter_audit.shapley_weights(n)
        for i in range(n):
            for c in range(1 << n):
                s = c.bit_count()
                want = Fraction(math.factorial(s - 1) * math.factorial(n - s), math.factorial(n)) if c >> i & 1 else -Fraction(math.factorial(s) * math.factorial(n - s - 1), math.factorial(n))
                assert weights[i][c] == want or c == 0


def test_pieces_of_long_texts_end_at_words():
    text = b"ab cde\tf\n" * 50 + b"x" * 100 + b" end"
    for size in (1, 5, 64, 10_000):
        parts = list(filter_audit.pieces(text, size))
        assert b"".join(parts) == text and [w for p in parts for w in p.split()] == text.split()


def test_license_scan_on_odd_rows_equals_sql(odd):
    got = licenses.scan_licenses(odd)
    assert by_spark(got) == by_sql(licenses.SQL["op13_licenses"])
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[11].base_labels == "apache,cc-by,gpl,mit" and by_id[11].n_base == 5 and by_id[11].first_word == 0 and by_id[11].last_word == 10
    assert by_id[12].n_base == 1 and by_id[13].base_labels == "" and by_id[13].labels == "gpl" and 0.8 <= by_id[13].score <= 1
    assert by_id[1].n_words == 0 and by_id[1].first_word is None and by_id[1].labels == "" and by_id[1].score == 0
    assert licenses.scan_licenses(odd.limit(0)).collect() == []


def test_license_join_finds_what_comparing_all_finds(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    templates = tuple(licenses.Template(f"t{i % 4}", " ".join(rng.choices(words, k=rng.randrange(4, 20)))) for i in range(12))
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 3, 10, 30, 100, 400])))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in (0.6, 0.8, 1.0):
        got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(docs, phrases=(), templates=templates, threshold=threshold).collect()}
        half = max(len(t.text.split()) for t in templates)
        for i, text in rows:
            held, labels, best = text.split(), set(), 0.0
            for at in range(0, len(held), half):
                block = set(held[at : at + 2 * half])
                for t in templates:
                    own = set(t.text.split())
                    if 100 * len(block & own) >= round(100 * threshold) * len(own):
                        labels.add(t.label)
                        best = max(best, len(block & own) / len(own))
            assert got[i] == (",".join(sorted(labels)), best)


def test_license_scan_has_no_python_in_its_plan(odd):
    plan = licenses.scan_licenses(odd.select("doc_id", "text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_batches_are_cut_and_joined():
    rows = [bytes(n) for n in (5, 0, 100, 3, 3, 3, 3, 50, 1)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r], pa.binary())], names=["x"]) for r in rows[:4]]
    batches += [pa.RecordBatch.from_arrays([pa.array(rows[4:], pa.binary())], names=["x"]), pa.RecordBatch.from_arrays([pa.array([], pa.binary())], names=["x"])]
    out = [b.column("x").to_pylist() for b in common.slices(iter(batches), "x", 10)]
    assert [x for b in out for x in b] == rows and [len(b) for b in out] == [2, 1, 3, 1, 1, 1]
    assert hashlib.sha256(b"".join(rows)).digest()
