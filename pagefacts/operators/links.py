"""Links: anchors, pagination, fallback links, cards, and the crawl frontier.

Links of one page sit in one row, so they are cleaned and deduplicated there and only the
short results leave the page; the frontier is the first shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nodes as N
from ..functions import urls
from ..functions.text import contains_any, let
from ..plans.skew import distinct_keys

# What marks a link to more listing pages, and one that leads back.
PAGINATION_PARTS = ("jobOffset", "SearchJobs", "pageNumber")
BACKWARD_WORDS = ("prev", "<<", "back")
SUBTITLE_PREFIX = "list-item-"

LINK_TYPE = "array<struct<url:string,label:string>>"


def anchors(pages: DataFrame, keys=("page_id", "url"), html: str = "html") -> DataFrame:
    """All ``<a href>`` of a page in order, with their text."""
    found = F.filter("_anchors", lambda a: a["href"].isNotNull())
    read = pages.select(*keys, N.page_anchors(F.col(html)).alias("_anchors"))
    return read.select(*keys, F.explode(found).alias("_a")).select(*keys, "_a.pos", "_a.href", "_a.text")


def _distinct_links(
    found: Column, url: Column, accept, mode: str, label: str, pages_only: bool = False
) -> Column:
    """Distinct absolute links of one page, first seen first, as an array; ``mode`` as in ``resolve_url``.

    ``pages_only`` leaves out mail, phone and script links and bare fragments, which the plain
    rules turn into addresses of no page.
    """
    base = url if mode == "standard" else urls.base_url(url)

    def keep(a: Column) -> Column:
        wanted = (a["href"] != "") & accept(a["href"], a["text"])
        return wanted & urls.is_page_link(a["href"]) if pages_only else wanted

    kept = F.filter(found, keep)
    links = F.array_distinct(
        F.transform(kept, lambda a: urls.resolve_url(base, a["href"], mode))
    )
    return F.transform(
        F.filter(links, lambda u: u.isNotNull()),
        lambda u: F.struct(u.alias("url"), F.lit(label).alias("label")),
    )


def pagination_array(found: Column, url: Column, pages_only: bool = False, mode: str = "join") -> Column:
    def accept(href: Column, text: Column) -> Column:
        return (
            contains_any(href, PAGINATION_PARTS)
            & (href != "#")
            & ~contains_any(F.lower(text), BACKWARD_WORDS)
        )

    return _distinct_links(found, url, accept, mode, urls.LISTING, pages_only)


def fallback_job_array(found: Column, url: Column, pages_only: bool = False, mode: str = "concat") -> Column:
    return _distinct_links(
        found, url, lambda href, _: href.contains("/JobDetail/"), mode, urls.JOB_DETAIL, pages_only
    )


def fallback_listing_array(found: Column, url: Column, pages_only: bool = False, mode: str = "concat") -> Column:
    return _distinct_links(
        found, url, lambda href, _: href.contains("SearchJobs"), mode, urls.LISTING, pages_only
    )


def _link_rows(pages: DataFrame, html: Column, links: Column, page_id: str, anchors: str | None = None) -> DataFrame:
    """Links made from ``_anchors``, which is read once per page, or before."""
    read = pages.withColumn("_anchors", F.col(anchors) if anchors else N.page_anchors(html))
    return read.select(page_id, F.posexplode(links).alias("pos", "_link")).select(
        page_id, "pos", "_link.url", "_link.label"
    )


def pagination_links(
    pages: DataFrame, url: str = "url", html: str = "html", page_id: str = "page_id", pages_only: bool = False, mode: str = "join"
) -> DataFrame:
    """Links to further listing pages."""
    return _link_rows(pages, F.col(html), pagination_array(F.col("_anchors"), F.col(url), pages_only, mode), page_id)


def fallback_job_links(
    pages: DataFrame, url: str = "url", html: str = "html", page_id: str = "page_id", pages_only: bool = False
) -> DataFrame:
    """Detail links on pages no route knows."""
    return _link_rows(pages, F.col(html), fallback_job_array(F.col("_anchors"), F.col(url), pages_only), page_id)


def fallback_listing_links(
    pages: DataFrame, url: str = "url", html: str = "html", page_id: str = "page_id", pages_only: bool = False
) -> DataFrame:
    return _link_rows(pages, F.col(html), fallback_listing_array(F.col("_anchors"), F.col(url), pages_only), page_id)


def route_links(
    pages: DataFrame, url: str = "url", html: str = "html", page_id: str = "page_id", label: str | None = None, pages_only: bool = False, standard: bool = False,
    anchors: str | None = None,
) -> DataFrame:
    """Links the handler of each page's route asks for, in one scan; ``standard`` resolves them as browsers do.

    Listing pages give pagination links, detail pages none, all others the fallback links.
    Card links need the page tree: see ``listing_cards``. ``anchors`` names a column with what
    ``page_anchors`` gives, for pages that were read before; they need no ``html`` then.
    """
    route = F.col(label) if label else urls.route_label(F.col(url))
    given = (F.col("_anchors"), F.col(url), pages_only)
    repaired, plain = ("standard", "standard") if standard else ("join", "concat")
    links = (
        F.when(route == urls.LISTING, pagination_array(*given, repaired))
        .when(route == urls.JOB_DETAIL, F.array().cast(LINK_TYPE))
        .otherwise(F.concat(fallback_job_array(*given, plain), fallback_listing_array(*given, plain)))
    )
    # Detail pages lead nowhere: they are not read.
    leads = F.when(F.coalesce(route, F.lit("")) != urls.JOB_DETAIL, F.col(html))
    return _link_rows(pages, leads, links, page_id, anchors)


# --- listing cards ----------------------------------------------------------------------


def cards_array(doc: Column, url: Column) -> Column:
    """Cards of a listing page with title, link and subtitle entries."""
    base = urls.base_url(url)
    nodes = doc["nodes"]
    roots = F.filter(
        N.placed(doc, "card"),
        lambda n: (N.is_marked(n, "card") & N.is_within(n, "results"))
        | (N.is_marked(n, "list_item") & N.is_within(n, "list")),
    )

    def entries(part: Column) -> Column:
        def of_wrapper(wrapper: Column) -> Column:
            named = F.filter(
                N.inside(nodes, wrapper), lambda n: n["cls"].startswith(SUBTITLE_PREFIX)
            )
            pairs = F.transform(
                named,
                lambda n: F.struct(
                    F.regexp_extract(n["cls"], "^list-item-([^ ]*)", 1).alias("key"),
                    N.node_text(doc, n).alias("value"),
                ),
            )
            whole = F.array(
                F.struct(F.lit("default").alias("key"), N.node_text(doc, wrapper).alias("value"))
            )
            return F.when(F.size(named) == 0, whole).otherwise(
                F.filter(pairs, lambda e: e["key"] != "")
            )

        wrappers = F.filter(part, lambda n: N.is_marked(n, "subtitle"))
        return F.flatten(F.transform(wrappers, of_wrapper))

    def card(root: Column) -> Column:
        part = N.inside(nodes, root)
        links = F.filter(part, lambda n: (n["tag"] == "a") & N.is_within(n, "title"))
        titles = F.filter(part, lambda n: N.is_marked(n, "title"))
        href = F.get(links, F.lit(0))["href"]
        return F.struct(
            F.when(href != "", urls.resolve_url(base, href)).alias("url"),
            F.coalesce(N.node_text(doc, F.get(titles, F.lit(0))), F.lit("")).alias("title"),
            entries(part).alias("entries"),
        )

    return F.filter(F.transform(roots, card), lambda c: c["url"].isNotNull())


def listing_cards(docs: DataFrame, url: str = "url", page_id: str = "page_id", cards: str | None = None) -> DataFrame:
    """One row per card with a link: ``pos``, ``url``, ``label``, ``title``, ``entries``.

    ``cards`` names a column with what ``cards_array`` gives, for pages that were read before.
    """
    found = F.col(cards) if cards else cards_array(F.col("doc"), F.col(url))
    return docs.select(page_id, F.posexplode(found).alias("pos", "_card")).select(page_id, "pos", "_card.url", F.lit(urls.JOB_DETAIL).alias("label"), "_card.title", "_card.entries")


def first_cards(cards: Column) -> Column:
    """Cards of one page, of equal URLs the first, with their place: sorted inside the row, no shuffle."""
    placed = F.transform(cards, lambda c, i: F.struct(c["url"].alias("url"), i.alias("pos"), c.alias("card")))

    def firsts(rows: Column) -> Column:
        return F.filter(rows, lambda r, i: (i == 0) | (F.get(rows, i - 1)["url"] != r["url"]))

    kept = let(F.array_sort(placed), firsts)
    return F.array_sort(F.transform(kept, lambda r: F.struct(r["pos"].alias("pos"), r["card"].alias("card"))))


def page_cards(docs: DataFrame, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """As ``listing_cards``, each URL once per page."""
    found = docs.select(page_id, cards_array(F.col("doc"), F.col(url)).alias("_cards"))
    rows = found.select(page_id, F.explode(first_cards(F.col("_cards"))).alias("_one"))
    return rows.select(page_id, "_one.pos", "_one.card.url", F.lit(urls.JOB_DETAIL).alias("label"), "_one.card.title", "_one.card.entries")


def card_dedupe(cards: DataFrame, keys=("page_id", "url"), order=("pos",)) -> DataFrame:
    """First card per key. Partial aggregation keeps one candidate per key and task."""
    rest = [c for c in cards.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return cards.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*cards.columns)


def card_subtitles(cards: DataFrame, keys=("page_id", "pos")) -> DataFrame:
    """Subtitle entries as rows; of equal keys in a card the later one stays. No shuffle: a card is one row."""
    return cards.select(*keys, F.explode(subtitle_map(F.col("entries"))).alias("key", "value"))


def subtitle_map(entries: Column) -> Column:
    """Entries as a MAP, the later of equal keys wins whatever the session's policy."""
    count = F.size(entries)
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.greatest(count - i - 1, F.lit(0))), lambda x: x["key"] == e["key"]
        ),
    )
    return F.map_from_entries(last)


# --- frontier ---------------------------------------------------------------------------


def frontier_new_links(links: DataFrame, seen: DataFrame, url: str = "url", keep=("url",)) -> DataFrame:
    """Links to pages not fetched yet, each key once; of equal links the smallest stays.

    Equal links collapse by hash inside each task before the shuffle: a URL that a third of all
    pages link to costs one row per task, and only different links are sorted. ``seen`` is reduced the same way and both sides meet
    partitioned by key, so the join adds no shuffle. A left join with a null test stands for
    the anti join, which the optimizer would move below the grouping, where the hot keys
    still are.
    """
    fresh = (
        links.select(urls.url_unique_key(F.col(url)).alias("url_key"), *keep)
        .distinct()
        .groupBy("url_key")
        # Before a plain minimum the optimizer takes the distinct out again.
        .agg(F.min_by(F.struct(*keep), F.struct(*keep)).alias("_link"))
    )
    known = distinct_keys(seen.select(urls.url_unique_key(F.col(url)).alias("url_key")), "url_key")
    return _unseen(fresh, known)


def unseen_links(links: DataFrame, seen: DataFrame, buckets: int, url: str = "url", keep=("url",)) -> DataFrame:
    """As ``frontier_new_links``, against keys that lie in ``buckets`` by ``url_key`` (see ``sources.seen``).

    Only the new links are shuffled, to the partitions the seen keys already lie in.
    """
    fresh = (
        links.select(urls.url_unique_key(F.col(url)).alias("url_key"), *keep)
        .distinct()
        .repartition(buckets, "url_key")
        .groupBy("url_key")
        .agg(F.min_by(F.struct(*keep), F.struct(*keep)).alias("_link"))
    )
    return _unseen(fresh, seen.select("url_key").hint("merge"))


def _unseen(fresh: DataFrame, known: DataFrame) -> DataFrame:
    return (
        fresh.join(known.withColumn("_seen", F.lit(True)), "url_key", "left")
        .filter(F.col("_seen").isNull())
        .select("url_key", "_link.*")
    )


def same_host_links(links: DataFrame, page_url: str, url: str = "url") -> DataFrame:
    return links.filter(urls.host(F.col(url)) == urls.host(F.col(page_url)))


def apply_url(doc: Column, url: Column) -> Column:
    """First link that leads to the application, made absolute without slash repair."""

    def accept(n: Column) -> Column:
        href, text = n["href"], N.node_text(doc, n)
        return (
            (href != "")
            & (
                contains_any(href, ("ApplicationMethods", "Apply", "apply"))
                | N.is_marked(n, "primary_button")
                | contains_any(text, ("Apply", "apply"))
            )
        )

    first = F.get(F.filter(N.placed(doc, "link"), accept), F.lit(0))["href"]
    return let(first, lambda href: F.when(href.isNotNull(), urls.resolve_url(urls.base_url(url), href, "concat")))
