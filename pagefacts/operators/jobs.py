"""Job records: everything known about a detail page in 26 columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nodes as N
from ..functions import parse, urls
from ..functions.text import WS
from ..plans.skew import splittable_left_join
from . import fields, links, sections, titles

CARD_TYPE = "struct<title:string,subtitles:map<string,string>>"

JOB_COLUMNS = (
    "url", "jobId", "refNumber", "subdomain", "title", "location", "workType", "schedule",
    "salaryMin", "salaryMax", "salaryPeriod", "salaryRaw", "employmentType",
    "employmentClassification", "duration", "department", "category", "entity", "postedDate",
    "description", "qualifications", "duties", "fullContent", "applyUrl", "additional",
    "scrapedAt",
)
TYPED_COLUMNS = ("salary_min_num", "salary_max_num", "posted_date")

# Card subtitles that come before the page's own fields.
CARD_KEYS: dict[str, tuple[str, ...]] = {
    "location": ("location", "locationBuiltIn"),
    "employmentType": ("workingTime",),
    "duration": ("contractType",),
    "department": ("department",),
    "entity": ("legalEntity",),
}


def cards_by_url(cards: DataFrame) -> DataFrame:
    """First-seen card of each URL, as ``url, card``."""
    first = links.card_dedupe(
        cards.select("url", "page_id", "pos", "title", "entries"), ("url",), ("page_id", "pos")
    )
    return first.select(
        "url",
        F.struct(F.col("title"), links.subtitle_map(F.col("entries")).alias("subtitles"))
        .cast(CARD_TYPE)
        .alias("card"),
    )


def card_job_join(pages: DataFrame, cards: DataFrame) -> DataFrame:
    """Attach the card of a listing page to the page it links to, by requested URL.

    ``pages`` are moved when there are too many cards to broadcast: give it finished records
    (``with_cards``) or key columns, not HTML.
    """
    return splittable_left_join(pages, cards_by_url(cards), "url")


def with_cards(
    records: DataFrame, cards: DataFrame, request_url: str = "request_url", drop: Sequence[str] = ("page_id",)
) -> DataFrame:
    """Let the values of listing cards come before those of the pages.

    ``records`` carry the requested URL (``job_records(keep=...)``); it and ``drop`` are dropped.
    Same result as reading the pages with their cards, but the rows on the move hold
    extracted text and not markup.
    """
    final = [c for c in records.columns if c not in (request_url, *drop)]
    keyed = records.withColumnRenamed("url", "_url").withColumnRenamed(request_url, "url")
    joined = card_job_join(keyed, cards).drop("url").withColumnRenamed("_url", "url")
    card, ref = F.col("card"), card_ref(F.col("card"))
    over = {t: F.coalesce(_card_value(card, keys), F.col(t)) for t, keys in CARD_KEYS.items()}
    over["title"] = F.coalesce(F.nullif(card["title"], F.lit("")), F.col("title"))
    over["refNumber"] = F.when(ref.isNotNull(), ref_not_job_id(ref, F.col("jobId"))).otherwise(F.col("refNumber"))
    over["additional"] = card["subtitles"]
    return joined.select(*[over[c].alias(c) if c in over else c for c in final])


def _card_value(card: Column, keys: Sequence[str]) -> Column:
    values = [F.nullif(F.try_element_at(card["subtitles"], F.lit(k)), F.lit("")) for k in keys]
    return F.coalesce(*values)


def card_ref(card: Column) -> Column:
    ref = F.lower(F.try_element_at(card["subtitles"], F.lit("ref")))
    return F.nullif(F.regexp_replace(ref, f"ref{WS}#", ""), F.lit(""))


def ref_not_job_id(ref: Column, job_id: Column) -> Column:
    return F.nullif(ref, job_id)


def job_records(
    docs: DataFrame,
    labels: Mapping[str, Sequence[str]] = fields.LABELS,
    company_names: Sequence[str] = (),
    strict: bool = False,
    typed: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Records of parsed detail pages; columns named in ``keep`` come along.

    ``docs`` has ``url`` and ``doc``; ``loaded_url``, ``card`` and ``scraped_at`` count when present.
    One row in, one row out: nothing here shuffles.
    """
    have = set(docs.columns)
    url = urls.effective_url(F.col("loaded_url"), F.col("url")) if "loaded_url" in have else F.col("url")
    card = F.col("card") if "card" in have else F.lit(None).cast(CARD_TYPE)
    scraped = F.col("scraped_at") if "scraped_at" in have else F.lit(None)

    # Each step is a projection of its own, so that no array is computed twice.
    step = docs.select(
        url.alias("url"),
        card.alias("card"),
        scraped.cast("timestamp").alias("scrapedAt"),
        "doc",
        *keep,
    )
    doc = F.col("doc")
    step = step.select(
        "*",
        fields.candidates(doc, labels=labels).alias("_candidates"),
        fields.content_text(doc).alias("_content"),
        N.body_text(doc).alias("_body"),
        sections.heading_sections(doc).alias("_h3"),
        sections.container_sections(doc).alias("_boxes"),
        titles.job_title(doc, F.col("url"), company_names).alias("_title"),
        sections.full_content(doc).alias("fullContent"),
        links.apply_url(doc, F.col("url")).alias("applyUrl"),
        urls.job_id(F.col("url")).alias("jobId"),
        urls.site_key(F.col("url")).alias("subdomain"),
    ).drop("doc")
    found, keys = F.col("_candidates"), F.col("_keys")
    step = step.withColumn("_keys", fields.match_keys(found, labels, strict))
    step = step.select("*", *[fields.value_by_key(found, keys, t, labels).alias(f"_{t}") for t in labels])
    step = step.drop("_candidates", "_keys")

    def from_page(target: str) -> Column:
        value = F.col(f"_{target}")
        text_labels = fields.TEXT_LABELS.get(target)
        if text_labels:
            value = F.coalesce(value, fields.field_from_text(F.col("_body"), text_labels))
        return value

    def value_of(target: str) -> Column:
        keys = CARD_KEYS.get(target)
        page = from_page(target)
        return F.coalesce(_card_value(F.col("card"), keys), page) if keys else page

    ref = F.coalesce(
        card_ref(F.col("card")),
        from_page("refNumber"),
        fields.text_by_pattern(F.col("_content"), fields.REF_PATTERN),
    )
    posted = F.coalesce(
        F.col("_postedDate"), fields.text_by_pattern(F.col("_content"), fields.POSTED_PATTERN)
    )
    h3, boxes = F.col("_h3"), F.col("_boxes")
    step = step.withColumn("_salary", parse.parse_salary(F.col("_salaryRaw")))
    record = step.select(
        "url",
        "jobId",
        ref_not_job_id(ref, F.col("jobId")).alias("refNumber"),
        "subdomain",
        F.coalesce(F.nullif(F.col("card")["title"], F.lit("")), F.col("_title")).alias("title"),
        value_of("location").alias("location"),
        value_of("workType").alias("workType"),
        value_of("schedule").alias("schedule"),
        F.col("_salary")["min"].alias("salaryMin"),
        F.col("_salary")["max"].alias("salaryMax"),
        F.col("_salary")["period"].alias("salaryPeriod"),
        F.col("_salary")["raw"].alias("salaryRaw"),
        value_of("employmentType").alias("employmentType"),
        value_of("employmentClassification").alias("employmentClassification"),
        value_of("duration").alias("duration"),
        value_of("department").alias("department"),
        value_of("category").alias("category"),
        value_of("entity").alias("entity"),
        parse.parse_date(posted).alias("postedDate"),
        sections.description(h3, boxes).alias("description"),
        sections.qualifications(h3, boxes).alias("qualifications"),
        sections.duties(h3, boxes).alias("duties"),
        "fullContent",
        "applyUrl",
        F.col("card")["subtitles"].alias("additional"),
        "scrapedAt",
        *keep,
    )
    if not typed:
        return record
    return record.select(
        "*",
        parse.amount_value(F.col("salaryMin")).alias("salary_min_num"),
        parse.amount_value(F.col("salaryMax")).alias("salary_max_num"),
        parse.date_value(F.col("postedDate")).alias("posted_date"),
    )
