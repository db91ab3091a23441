"""Host check: which hosts run a working job board, and how many jobs they show.

Every attempt is judged where it was read; only the verdicts are shuffled to pick the
deciding attempt of a host, never the pages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.text import WS, blank_to_null, contains_any, let, trim

# How a page words its number of jobs, first count above zero wins.
COUNT_PATTERNS = tuple(
    "(?i)" + p.replace(r"\s", WS)
    for p in (
        r"there\s+are\s+([0-9]+)\s+jobs?\s+matching",
        r"([0-9]+)\s+jobs?\s+matching",
        r"showing\s+[0-9]+\s*[-\x{2013}]\s*[0-9]+\s+of\s+([0-9]+)",
        r"of\s+([0-9]+)\s+results?",
        r"([0-9]+)\s+results?(?!\s*found)",
        r"([0-9]+)\s+jobs?\s+found",
        r"found\s+([0-9]+)\s+jobs?",
        r"([0-9]+)\s+open\s+positions?",
        r"([0-9]+)\s+opportunit(?:y|ies)",
    )
)
# A word each of these patterns needs, in lower case.
COUNT_NEEDLES = dict(
    zip(COUNT_PATTERNS, ("matching", "matching", "showing", "result", "result", "found", "found", "position", "opportunit"), strict=True)
)
LISTING_TOTAL = rf"(?i)of{WS}+([0-9]+){WS}+results?"

# Signs of a login page, of a missing page and of a job board.
PROXY_LIMIT_TEXT = "multiple users connecting from your IP"
LOGIN_ACTIONS = ("login", "Login", "signin", "auth")
LOGIN_TITLES = ("login", "sign in", "authentication", "access denied", "sso", "single sign-on")
LOGIN_PHRASES = (
    "please log in", "please sign in", "enter your credentials", "authentication required",
)
MISSING_PHRASES = ("page not found", "page was not found", "404")
CAREER_TITLES = ("career", "job", "search")

STATUSES = ("working", "auth_required", "blocked", "not_working", "error")
ATTEMPTS = 3

_DETAIL_HREF = r"""<[aA]\s(?:[^>]*[\s"'])?(?i:href)\s*=\s*["']?[^"'>]*?/JobDetail/"""
_JOB_LINK = _DETAIL_HREF + r"""[^/"'>]+/([0-9]+)"""


def total_from_text(text: Column, patterns: Sequence[str] = COUNT_PATTERNS) -> Column:
    """First count above zero. Patterns only run on texts that hold their word."""

    def first_count(lower: Column) -> Column:
        counts = []
        for p in patterns:
            count = F.nullif(F.regexp_extract(text, p, 1).try_cast("bigint"), F.lit(0))
            needle = COUNT_NEEDLES.get(p)
            counts.append(count if needle is None else F.when(lower.contains(needle), count))
        return F.coalesce(*counts)

    return let(F.lower(text), first_count)


def listing_total(text: Column) -> Column:
    """The N of 'of N results'."""
    return blank_to_null(F.regexp_extract(text, LISTING_TOTAL, 1)).try_cast("bigint")


def job_link_count(markup: Column) -> Column:
    """Distinct job ids among the detail links of one page."""
    ids = F.regexp_extract_all(markup, F.lit(_JOB_LINK), 1)
    return F.size(F.array_distinct(ids))


def total_jobs(text: Column, markup: Column) -> Column:
    """Count stated by the page, else the number of its job links, else null."""
    links = job_link_count(markup).cast("bigint")
    return F.coalesce(total_from_text(text), F.nullif(links, F.lit(0).cast("bigint")))


def _class_part(markup: Column, *parts: str) -> Column:
    return markup.rlike("|".join(H.attribute_pattern("[a-z][a-z0-9]*", "class", p) for p in parts))


def judge_attempts(
    attempts: DataFrame, html: str = "html", status: str = "status_code",
    error: str = "error_message", retries: int = ATTEMPTS,
) -> DataFrame:
    """Replace each attempt's page by ``status``, ``error``, ``total_jobs``, ``retryable``.

    ``retryable`` attempts carry the verdict they get when no later attempt decides.
    """
    code, page, message = F.col(status), F.col(html), F.col(error)
    # Features are separate steps, so each text is computed once.
    facts = (
        attempts.withColumn("_title", F.lower(H.title_text(page)))
        .withColumn("_text", trim(H.body_text(page, "content")))
        .withColumn("_lower", F.lower("_text"))
        .withColumn("_markup", H.tags_of(H.visible_markup(page)))
    )
    title, text, lower, markup = (F.col(c) for c in ("_title", "_text", "_lower", "_markup"))

    # Only a request that was given up is tried again; other failures that speak of time are final.
    timeout = message.contains("AbortError")
    limited = code.isin(429, 499)
    proxy_limited = page.contains(PROXY_LIMIT_TEXT)
    login_form = markup.rlike("|".join(H.attribute_pattern("form", "action", p) for p in LOGIN_ACTIONS))
    login_text = contains_any(lower, LOGIN_PHRASES) | (
        lower.contains("username") & lower.contains("password")
    )
    needs_login = (
        login_form
        | markup.rlike(H.attribute_pattern("input", "type", "password", whole=True))
        | contains_any(title, LOGIN_TITLES)
        | login_text
    )
    missing = contains_any(lower, MISSING_PHRASES) | (
        lower.contains("sorry") & lower.contains("not exist")
    )
    has_jobs = (
        markup.rlike(_DETAIL_HREF)
        | markup.rlike(H.token_pattern("article"))
        | _class_part(markup, "job", "position")
    )
    has_search = (
        markup.rlike(H.attribute_pattern("form", "action", "SearchJobs"))
        | _class_part(markup, "search")
        | contains_any(title, CAREER_TITLES)
    )

    def verdict(state: str, reason, retryable: bool = False, total=None) -> Column:
        reason = F.lit(reason) if reason is None or isinstance(reason, str) else reason
        return F.struct(
            F.lit(state).alias("status"),
            reason.cast("string").alias("error"),
            (F.lit(None) if total is None else total).cast("bigint").alias("total_jobs"),
            F.lit(retryable).alias("retryable"),
        )

    # The reasons as reports name them.
    judged = (
        F.when(timeout, verdict("error", "Timeout", True))
        .when(message.isNotNull(), verdict("error", message))
        .when(limited, verdict("blocked", f"Rate limited after {retries} retries", True))
        .when(code == 404, verdict("not_working", "Page not found"))
        .when(code.isin(401, 403), verdict("auth_required", "Access denied"))
        .when(code >= 500, verdict("error", F.concat(F.lit("Server error "), code.cast("string"))))
        .when(proxy_limited, verdict("blocked", f"Proxy rate limited after {retries} retries", True))
        .when(
            (F.length(text) < 50) & (title == ""),
            verdict("auth_required", "Empty page (likely requires auth)"),
        )
        .when(needs_login, verdict("auth_required", "Requires login"))
        .when(missing, verdict("not_working", "Page not found (in content)"))
        .when(has_jobs, verdict("working", None, total=total_jobs(text, markup)))
        .when(has_search, verdict("working", None, total=F.lit(0)))
        .otherwise(verdict("not_working", "No job elements found"))
    )
    kept = [c for c in attempts.columns if c not in (html, error)]
    return facts.select(*kept, judged.alias("_v")).select(
        *[c for c in kept if c != "status"], "_v.*"
    )


def resolve_attempts(judged: DataFrame, host: str = "host", attempt: str = "attempt", retries: int = ATTEMPTS) -> DataFrame:
    """One row per host: its first attempt that decides, else its last one; none beyond ``retries`` counts."""
    payload = F.struct(*[c for c in judged.columns if c not in (host, "retryable")])
    order = F.col(attempt)
    return (
        judged.filter(order <= retries)
        .groupBy(host)
        .agg(
            F.min_by(F.when(~F.col("retryable"), payload), F.when(~F.col("retryable"), order)).alias("_first"),
            F.max_by(payload, order).alias("_last"),
        )
        .select(host, F.coalesce("_first", "_last").alias("_r"))
        .select(host, "_r.*")
    )


def host_check(attempts: DataFrame, host: str = "host", retries: int = ATTEMPTS, **columns) -> DataFrame:
    return resolve_attempts(judge_attempts(attempts, retries=retries, **columns), host, retries=retries)


def dataset_status(h1: Column, article: Column) -> Column:
    return (
        F.when(F.contains(h1, F.lit("JavaScript is disabled")), "js_required")
        .when(trim(article) != "", "valid")
        .otherwise("not_valid")
    )
