"""HTML column functions that need no tree: they stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import decode_entities, let, trim

# Every pattern ends at its delimiter or at the end of the text, and gives nothing back: however
# broken the markup is, a page is read once and not once for each opening that is never closed.
# What stands in a tag behind its name: '>' may stand in quotes.
ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+"""
COMMENT = r"!--.*?(?:-->|\z)"
TITLE = r"(?i)<title[^>]*+(?:>([^<]*+</title>)?+|\z)"
BODY = r"(?is)<body[^>]*+>(.*?</body>|.*+)"
TAG = "<[^>]+>"


def _raw(names: str, group: int = 1) -> str:
    """An element whose content is no markup; without its end, or that of its tag, it is all that follows."""
    return rf"({names})(?=[\s/>]){ATTRS}(?:>(.*?)(?:</\{group}\s*+>|\z)|\z)"


OTHER = rf"(?:[!?][^>]*+(?:>|\z)|/?[a-z]{ATTRS}(?:>|\z))"
# Comments, declarations and tags; group 2 is the text of a script or style.
MARKUP = rf"(?is)<(?:{_raw('script|style')}|{COMMENT}|{OTHER})"
# What a page does not show: comments, scripts, styles, and what is for readers without scripts; group 3 is any other tag.
UNSEEN = rf"(?is)<(?:{_raw('script|style|noscript')}|{COMMENT})|(<{OTHER})"
# All before the body's own tag: text, comments, elements whose content is no markup, other tags.
HEAD_PART = rf"(?:[^<]++|<(?:{COMMENT}|{_raw('script|style|title')}|(?!body[\s>/])))*+"
BEFORE_BODY = rf"(?is)^{HEAD_PART}<body{ATTRS}(?:>|\z)"
HEAD_END = r"(?is)^.*?</head\s*+>"
BODY_END = r"(?is)</body\s*+>.*"


def title_text(html: Column) -> Column:
    """Trimmed text of the first title element that holds nothing but text; '' without one."""
    whole = F.get(F.filter(F.regexp_extract_all(html, F.lit(TITLE), 1), lambda t: t != ""), F.lit(0))
    return F.when(html.isNotNull(), trim(F.coalesce(F.left(whole, F.length(whole) - len("</title>")), F.lit(""))))


def strip_scripts(html: Column) -> Column:
    """Remove script, style and noscript elements with their content; an open one reaches to the end."""
    return F.regexp_replace(html, rf"(?is)<{_raw('script|style|noscript')}", "")


def visible_markup(html: Column) -> Column:
    """Markup that can carry links and forms: no scripts, styles or comments."""
    return F.regexp_replace(html, UNSEEN, "$3")


def visible_text(html: Column) -> Column:
    """Text a page shows, as the page reader gives it but for hidden elements."""
    return decode_entities(F.regexp_replace(html, UNSEEN, ""))


def tags_of(markup: Column) -> Column:
    """All start tags, one after the other, each with the only '<' it holds at its start.

    Patterns on attributes look up to the tag's end; here that is never another tag's.
    """
    tags = F.regexp_extract_all(markup, F.lit(rf"<([a-zA-Z]{ATTRS}(?:>|\z))"), 1)
    return F.array_join(F.transform(tags, lambda t: F.concat(F.lit("<"), F.translate(t, "<", " "))), "")


def body_markup(html: Column) -> Column:
    """What a browser takes for the inside of the body; a body tag in a head's script is none."""

    def inner(rest: Column) -> Column:
        unwritten = F.length(rest) == F.length(html)
        return F.when(unwritten, F.regexp_replace(html, HEAD_END, "")).otherwise(rest)

    return F.regexp_replace(let(F.regexp_replace(html, BEFORE_BODY, ""), inner), BODY_END, "")


def _tags_as_blanks(html: Column) -> Column:
    """Each tag as a blank; what no '>' follows holds no tag and is not searched for one."""

    def parts(tail: Column) -> Column:
        return F.concat(F.regexp_replace(F.left(html, F.length(html) - F.length(tail)), TAG, " "), tail)

    return let(F.substring_index(html, ">", -1), parts)


def body_text(html: Column, mode: str = "tags", limit: int | None = None) -> Column:
    """Text of the body element.

    ``tags`` puts a blank in place of every tag and keeps character references;
    ``content`` joins the text as a browser's ``textContent`` does, decodes them and does not
    need a written body: without its tag all behind the head counts, without a head the page.
    Script text of the body counts in both.
    """
    if mode == "tags":
        # Nothing behind the last '>' can be part of a written body, nor is there one without its end.
        closed = F.left(html, F.length(html) - F.length(F.substring_index(html, ">", -1)))
        inner = let(
            F.regexp_extract(closed, BODY, 1), lambda x: F.when(F.lower(F.right(x, F.lit(7))) == "</body>", F.left(x, F.length(x) - 7)).otherwise("")
        )
        text = let(inner, _tags_as_blanks)
    elif mode == "content":
        text = decode_entities(F.regexp_replace(body_markup(html), MARKUP, "$2"))
    else:
        raise ValueError(f"unknown mode: {mode}")
    return text if limit is None else F.substring(text, 1, limit)


def attribute_pattern(tag: str, name: str, part: str, whole: bool = False) -> str:
    """Regex for a ``<tag>`` with an attribute that contains (or is) the literal part."""
    if whole:
        value = rf"""(?:"{part}"|'{part}'|{part}[\s>])"""
    else:
        value = rf"""(?:"[^"]*{part}|'[^']*{part}|[^\s"'>]*{part})"""
    return rf"""(?:<(?i:{tag})\s(?:[^>]*[\s"'])?(?i:{name})\s*=\s*{value})"""


def token_pattern(token: str) -> str:
    """Regex for any element with the given class name."""
    value = rf"""(?:"(?:[^"]*\s)?{token}[\s"]|'(?:[^']*\s)?{token}[\s']|{token}[\s>])"""
    return rf"""(?:<(?i:[a-z][a-z0-9]*)\s(?:[^>]*[\s"'])?(?i:class)\s*=\s*{value})"""
