"""The page reader: tolerance, ranges and structure."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagefacts.functions import nodes as N

FIELD = {name: i for i, (name, _) in enumerate(N.NODE_FIELDS)}


def read(page, **options):
    text, rows = N.read_page(page, **options)
    return text, [dict(zip(FIELD, row)) for row in rows]


def tags(rows):
    return [r["tag"] for r in rows]


def test_text_and_ranges():
    text, rows = read("<div> a <p>b&amp;c</p> </div>d")
    assert text == " a b&c d"
    div, p = rows
    assert text[div["text_start"]:div["text_end"]] == "a b&c"
    assert text[div["raw_start"]:div["raw_end"]] == " a b&c "
    assert text[p["text_start"]:p["text_end"]] == "b&c"
    assert (div["last"], p["parent"], p["last"]) == (2, 1, 2)


def test_implied_end_tags():
    _, rows = read("<ul><li>a<li>b<ul><li>c</ul></ul><p>x<p>y<div>z</div><table><tr><th>h<td>d<tr><td>e</table>")
    parents = {r["seq"]: r["parent"] for r in rows}
    by_tag = {t: [r for r in rows if r["tag"] == t] for t in tags(rows)}
    assert [parents[r["seq"]] for r in by_tag["li"]] == [1, 1, 4]
    assert all(r["parent"] == 0 for r in by_tag["p"] + by_tag["div"])
    assert [r["parent"] for r in by_tag["td"]] == [by_tag["tr"][0]["seq"], by_tag["tr"][1]["seq"]]


def test_unclosed_inline_ends_with_its_parent():
    text, rows = read("<div><p><b>x</div>y")
    assert text == "xy" and [r["last"] for r in rows] == [3, 3, 3]
    assert rows[2]["raw_end"] == 1


def test_dropped_parts_leave_no_trace():
    page = "<p>a<script>if (1 < 2) { '</p>' }</script><noscript><i>n</i></noscript><span class='x visibility--hidden--visually'>h<b>i</b></span>b</p>"
    text, rows = read(page)
    assert text == "ab" and tags(rows) == ["p"]
    text, rows = read(page, drop_hidden=False)
    assert text == "ahib" and tags(rows) == ["p", "span", "b"]


def test_broken_markup():
    for page in ("<a href='x", "< p>1 < 2</ p>", "<!-- open", "</div></p>", "<a b=\"c>d", "", "<title>x", "&#xZZ;"):
        read(page)
    text, rows = read("<title>A &lt; <b></title><a title=\"x > y\" href=z>q</a>")
    assert text == "A < <b>q" and rows[1]["href"] == "z"


def test_siblings_and_headings():
    _, rows = read("<div><h3>a</h3><p>1</p><h2>b</h2><i>2</i><h3>c</h3></div>")
    seq = {(r["tag"], i): r for i, r in enumerate(rows)}
    h3a, p, h2, i, h3c = rows[1:]
    assert [r["next"] for r in rows[1:]] == [p["seq"], h2["seq"], i["seq"], h3c["seq"], 0]
    assert (h3a["until"], h2["until"], h3c["until"]) == (h2["seq"], h3c["seq"], 7)
    assert len(seq) == 6


def test_bold_points_to_the_first_inside():
    _, rows = read("<div><p>x</p><p><strong>a</strong><b>b</b></p></div>")
    assert [r["bold"] for r in rows] == [4, 0, 4, 0, 0]


def test_marks():
    _, rows = read("<main><div class='a article__content__view__field'><i id=content role='main'></i></div></main>")
    assert rows[1]["own"] == N.mask("field") and rows[1]["within"] == N.mask("main")
    assert rows[2]["own"] == N.mask("content_id", "role_main")
    assert rows[2]["within"] == N.mask("main", "field")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/ab pi=\"'!-&; d", max_size=80))
def test_any_input_keeps_the_invariants(page):
    text, rows = read(page)
    for r in rows:
        assert r["parent"] < r["seq"] <= r["last"] <= len(rows)
        assert 0 <= r["raw_start"] <= r["text_start"] <= r["text_end"] <= r["raw_end"] <= len(text)
        if r["parent"]:
            parent = rows[r["parent"] - 1]
            assert parent["last"] >= r["last"]
            assert parent["raw_start"] <= r["raw_start"] and r["raw_end"] <= parent["raw_end"]
        assert text[r["text_start"]:r["text_end"]] == text[r["raw_start"]:r["raw_end"]].strip(N.BLANKS)


@settings(max_examples=100, deadline=None)
@given(st.recursive(st.text(alphabet="xy z", min_size=1, max_size=5), lambda c: st.lists(c, max_size=4), max_leaves=20))
def test_well_formed_trees_come_back(tree):
    def render(t):
        return t if isinstance(t, str) else "<div>" + "".join(render(c) for c in t) + "</div>"

    def plain(t):
        return t if isinstance(t, str) else "".join(plain(c) for c in t)

    def count(t):
        return 0 if isinstance(t, str) else 1 + sum(count(c) for c in t)

    text, rows = read(render(tree))
    assert text == plain(tree) and len(rows) == count(tree)


def test_one_python_step_and_null_pages(spark):
    df = spark.createDataFrame([(1, "<p>x</p>"), (2, None)], "page_id long, html string")
    docs = N.with_doc(df)
    assert docs.select("page_id", N.page_text(F.col("doc")), F.size("doc.nodes")).orderBy("page_id").collect() == [(1, "x", 1), (2, "", 0)]


def test_deep_and_long_pages_stay_linear():
    import time

    start = time.time()
    text, rows = read("<div><b>x" * 20000)
    read("<a " * 20000)
    read("<!--" * 20000 + ">")
    read("<p a=\"" * 20000 + ">")
    assert len(rows) == 40000 and time.time() - start < 20


def test_new_addresses_are_not_tried_against_the_selectors(monkeypatch):
    plain, tried = N._fitting, []
    monkeypatch.setattr(N, "_fitting", lambda *args: tried.append(args) or plain(*args))
    _, rows = read("".join(f"<a class=title href='/p/{i}?a&amp;b'>{i}</a>" for i in range(300)))
    assert [r["href"] for r in rows] == [f"/p/{i}?a&b" for i in range(300)]
    assert len({r["own"] for r in rows}) == 1 and rows[0]["own"] != 0
    assert len(tried) == 2  # marks and places, once for all
