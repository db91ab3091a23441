"""URL column functions.

All of them are regular expressions inside generated code. ``parse_url`` is avoided: it
fails on malformed input and returns null for hosts with an underscore.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, extract, let, rlike_any, trim

# The routes and paths of the hosted career sites.
LISTING_PATH = "/careers/SearchJobs"
DETAIL_ROUTE = "(?i)/careers/JobDetail/[^/]+/[0-9]+"
LISTING_ROUTE = "(?i)/careers/SearchJobs"
LISTING, JOB_DETAIL = "LISTING", "JOB_DETAIL"

SCHEME = "^([a-zA-Z][a-zA-Z0-9+.-]*)://"
AUTHORITY = "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?"

# Hosts that never carry a public job board, matched on the lower-cased name.
EXCLUDED_HOSTS = (
    r"^www\.", "^smtp", r"^mail\.", r"^docs\.", r"^api\.", "^cdn", "^analytics",
    r"^marketing\.", r"^sales\.", "^training", "^sandbox", "^pentest", "^uat[^a-z]",
    "^qa[^a-z]", "^staging", "^demo", "^test", r"integrations\.", "clientcertificate",
    r"-sso\.", "broadbeanjobexport", "label-studio", "rocketchat", "^label-",
)


def host(url: Column) -> Column:
    """Lower-cased host name without port and user info; null when there is none."""
    return blank_to_null(F.lower(F.regexp_extract(url, AUTHORITY + "([^/?#:]+)", 1)))


def host_token(url: Column) -> Column:
    """Third part of the URL split at '/', as it stands; null when there are fewer."""
    return F.get(F.split(url, "/"), F.lit(2))


def host_or_raw(url: Column) -> Column:
    return F.coalesce(host(url), url)


def effective_url(loaded_url: Column, url: Column) -> Column:
    return F.coalesce(loaded_url, url)


def base_url(url: Column) -> Column:
    """``scheme://host`` with the port only when it is not the scheme's default."""
    scheme = F.lower(F.regexp_extract(url, SCHEME, 1))
    port = F.regexp_extract(url, AUTHORITY + "[^/?#:]+:([0-9]+)", 1)
    default = F.when(scheme == "http", "80").when(scheme == "https", "443").otherwise("")
    suffix = F.when((port == "") | (port == default), "").otherwise(F.concat(F.lit(":"), port))
    return F.concat(scheme, F.lit("://"), host(url), suffix)


def site_key_of_host(host_col: Column) -> Column:
    """First label of a host with more than two labels, else the whole host."""
    labels = F.split(host_col, r"\.")
    return F.when(F.size(labels) > 2, F.get(labels, F.lit(0))).otherwise(host_col)


def site_key(url: Column, invalid: str | None = None) -> Column:
    """Site of a URL; ``invalid`` replaces the null of a malformed one."""
    key = site_key_of_host(host(url))
    return key if invalid is None else F.coalesce(key, F.lit(invalid))


def host_has_suffix(host_col: Column, suffix: str) -> Column:
    return F.endswith(host_col, F.lit(suffix))


def host_is_excluded(host_col: Column, patterns: Sequence[str] = EXCLUDED_HOSTS) -> Column:
    return rlike_any(F.lower(host_col), patterns)


def listing_url(host_col: Column, path: str = LISTING_PATH) -> Column:
    return F.concat(F.lit("https://"), host_col, F.lit(path))


def seed_url(domain: Column, path: str = LISTING_PATH) -> Column:
    """Clean a host name typed by hand and turn it into a start URL."""
    bare = F.regexp_replace(trim(domain), "^https?://", "")
    bare = F.regexp_replace(bare, "/+$", "")
    return F.concat(F.lit("https://"), bare, F.lit(path if path.startswith("/") else "/" + path))


def route_label(url: Column, detail: str = DETAIL_ROUTE, listing: str = LISTING_ROUTE) -> Column:
    """JOB_DETAIL before LISTING, null for every other URL."""
    return F.when(url.rlike(detail), JOB_DETAIL).when(url.rlike(listing), LISTING)


def job_id(url: Column) -> Column:
    """First path part made of digits only."""
    return extract(url, "/([0-9]+)(?:[/?#]|$)")


def slug_title(url: Column) -> Column:
    """Title spelled in the detail route: dashes become spaces."""
    return F.replace(extract(url, "/JobDetail/([^/]+)/[0-9]+"), F.lit("-"), F.lit(" "))


def resolve_url(base: Column, href: Column, mode: str = "join") -> Column:
    """Make a link absolute.

    ``join`` repairs a missing slash, ``concat`` does not; both take ``scheme://host`` as the base.
    ``standard`` resolves as browsers do and takes the page's own URL.
    """
    if mode == "standard":
        return resolve_reference(base, href)
    if mode == "join":
        glue = F.when(href.startswith("/"), "").otherwise("/")
    elif mode == "concat":
        glue = F.lit("")
    else:
        raise ValueError(f"unknown mode: {mode}")
    return F.when(href.startswith("http"), href).otherwise(F.concat(base, glue, href))


def _url_parts(url: Column) -> Column:
    """scheme with ':', authority with '//', path, query with '?' and fragment with '#'; '' where there is none."""

    def of(rest: Column, scheme: Column) -> Column:
        return F.struct(
            scheme.alias("scheme"),
            F.regexp_extract(rest, "^//[^/?#]*+", 0).alias("authority"),
            F.regexp_extract(rest, "^(?://[^/?#]*+)?([^?#]*+)", 1).alias("path"),
            F.regexp_extract(rest, r"^[^?#]*+(\?[^#]*+)", 1).alias("query"),
            F.regexp_extract(rest, "(?s)#.*$", 0).alias("fragment"),
        )

    scheme = F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*+:", 0)
    return let(scheme, lambda s: of(F.substr(url, F.length(s) + 1), s))


def _without_dots(path: Column) -> Column:
    """An absolute path without '.' and '..' segments; '..' at the top is dropped. Other paths stay."""

    def walked(segments: Column) -> Column:
        step = lambda kept, s: (
            F.when(s == ".", kept).when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(s)))
        )
        kept = F.aggregate(segments, F.array().cast("array<string>"), step)
        last = F.element_at(segments, -1)
        # A dot at the end names the folder itself.
        return F.concat(F.lit("/"), F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/"))

    dotted = path.rlike(r"^/(?:.*/)?\.\.?(?:/|$)")
    return F.when(dotted, let(F.split(F.substr(path, F.lit(2)), "/"), walked)).otherwise(path)


def resolve_reference(url: Column, href: Column) -> Column:
    """The address a link on the page ``url`` leads to, by the generic syntax of URIs.

    Links with a scheme stand for themselves, ``//host`` takes the page's scheme, ``?query`` and
    ``#part`` its path, other ones are merged with its folder, and dot segments are taken out.
    Blanks around a link do not count. Null where the page's URL or the link is null.
    """

    def joined(b: Column, r: Column) -> Column:
        folder = F.regexp_extract(b["path"], "^(?:.*/)?", 0)
        merged = F.when((b["authority"] != "") & (b["path"] == ""), F.concat(F.lit("/"), r["path"])).otherwise(F.concat(folder, r["path"]))
        own_scheme, own_host = r["scheme"] != "", r["authority"] != ""
        scheme = F.when(own_scheme, r["scheme"]).otherwise(b["scheme"])
        authority = F.when(own_scheme | own_host, r["authority"]).otherwise(b["authority"])
        path = (
            F.when(own_scheme | own_host | r["path"].startswith("/"), _without_dots(r["path"]))
            .when(r["path"] == "", b["path"])
            .otherwise(let(merged, _without_dots))
        )
        inherits = ~own_scheme & ~own_host & (r["path"] == "") & (r["query"] == "")
        query = F.when(inherits, b["query"]).otherwise(r["query"])
        return F.concat(scheme, authority, path, query, r["fragment"])

    return let(_url_parts(trim(url)), lambda b: let(_url_parts(trim(href)), lambda r: joined(b, r)))


def is_page_link(href: Column) -> Column:
    """False for mail, phone and script links, bare fragments and protocol-relative links."""
    return ~href.rlike("(?i)^(?:mailto:|tel:|javascript:|data:|#|//)")


def is_company_name(title: Column, patterns: Sequence[str]) -> Column:
    """True when the trimmed title is nothing but one of the given names."""
    if not patterns:
        return F.lit(False)
    return trim(title).rlike("(?i)^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")$")


def url_unique_key(url: Column) -> Column:
    """Key under which two URLs count as one request.

    Lower-case scheme and host, no fragment, no trailing slash, no ``utm_*`` parameters,
    the other parameters in order of their names. A malformed URL is its own key.
    """
    clean = trim(url)
    path = F.regexp_extract(clean, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(clean, r"^[^?#]*\?([^#]*)", 1)
    params = F.transform(
        F.split(query, "&"),
        lambda p, i: F.struct(
            F.regexp_extract(p, "^([^=]*)", 1).alias("name"), i.alias("i"), p.alias("param")
        ),
    )
    kept = F.filter(
        params, lambda p: (p["param"] != "") & ~p["name"].startswith("utm_")
    )
    joined = F.array_join(F.transform(F.array_sort(kept), lambda p: p["param"]), "&")
    tail = F.when(query == "", "").when(joined == "", "").otherwise(F.concat(F.lit("?"), joined))
    key = F.concat(base_url(clean), F.regexp_replace(path, "/$", ""), tail)
    return F.coalesce(key, clean)


