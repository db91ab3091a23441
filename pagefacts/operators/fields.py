"""Labelled fields: label/value candidates of a page and the label dictionary.

Candidates come from five page layouts ("methods"). A target takes the candidate of its
first matching label; among equal labels the lower method, then the earlier element wins.
All of that happens on the page's own row: nothing is joined or shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nodes as N
from ..functions.text import BLANK_CLASS, BLANKS, WS, blank_to_null, contains_any, let, trim

# What each target is called on pages, best label first.
LABELS: dict[str, tuple[str, ...]] = {
    "location": ("work location", "location", "job location", "city", "office location"),
    "workType": ("work type", "remote", "workplace type", "work arrangement", "location type"),
    "schedule": ("work schedule", "schedule", "shift", "hours", "working hours"),
    "salaryRaw": (
        "salary range", "salary", "compensation", "pay range", "base pay rate", "pay rate",
        "base pay", "hourly rate", "annual salary",
    ),
    "employmentType": (
        "employment type", "job type", "position type", "full/part time", "full time/part time",
        "type",
    ),
    "employmentClassification": (
        "employment classification", "classification", "flsa status", "exempt status",
    ),
    "duration": ("duration", "contract length", "term", "assignment length"),
    "department": (
        "department", "business area", "division", "team", "group", "organization",
    ),
    "category": ("category", "job family", "job category", "function", "area"),
    "entity": ("entity", "company", "subsidiary", "business unit", "legal entity"),
    "postedDate": ("posted date", "posted", "date posted", "posting date", "published"),
    "refNumber": (
        "job #", "job number", "requisition", "req id", "position id", "opening id", "ref", "ref #",
    ),
}

# Labels looked for in running text, and the words that end such a value.
TEXT_LABELS = {
    "location": ("Location",),
    "department": ("Business Area", "Department"),
    "refNumber": ("Ref #", "Ref#", "Reference"),
}
STOP_WORDS = ("Location", "Business Area", "Ref", "Posted", "Salary", "Department")
POSTED_PATTERN = rf"(?i)posted[:{BLANK_CLASS}]+([0-9]{{1,2}}[-/][A-Za-z0-9]{{2,3}}[-/][0-9]{{2,4}})"
REF_PATTERN = rf"(?i)(?:job{WS}*#|ref{WS}*#|requisition[:{BLANK_CLASS}]*#?){WS}*([0-9]+)"

# Limits and words of the candidate rules.
MAX_VALUE = 500
MAX_NEXT_VALUE = 200
SCRIPT_TRACE = "twigConfig"
VALUE_LEAD = ":-\u2013|\u2022" + BLANKS
NOT_A_VALUE = ("location", "business area", "ref #")

METHODS = (0, 1, 2, 3, 4)


def _candidate(method: int, node: Column, label: Column, value: Column) -> Column:
    return F.struct(
        F.lit(method).alias("method"),
        node["seq"].alias("pos"),
        label.alias("label"),
        value.alias("value"),
    )


def _method_0(doc: Column) -> Column:
    """Field blocks with a label part and a value part."""
    nodes = doc["nodes"]

    def of_field(field: Column) -> Column:
        part = N.inside(nodes, field)
        label = N.joined_text(doc, F.filter(part, lambda n: N.is_marked(n, "label")))
        value = N.joined_text(doc, F.filter(part, lambda n: N.is_marked(n, "value")))
        return _candidate(0, field, F.lower(label), value)

    found = F.transform(N.placed(doc, "field"), of_field)
    return F.filter(found, lambda c: (c["value"] != "") & (F.length(c["value"]) < MAX_VALUE))


def _method_1(doc: Column) -> Column:
    """Containers whose first bold text is the label and the rest the value."""
    nodes = doc["nodes"]

    def of_container(node: Column) -> Column:
        def parted(label: Column, whole: Column) -> Column:
            # The rest starts behind the first place where the label's text occurs.
            rest = F.substring(whole, F.instr(whole, label) + F.length(label), F.length(whole))
            value = trim(F.ltrim(rest, F.lit(VALUE_LEAD)))
            return _candidate(1, node, F.lower(label), value)

        label = let(N.node_at(nodes, node["bold"]), lambda n: N.node_text(doc, n))
        return let(label, lambda bold: let(N.node_text(doc, node), lambda whole: parted(bold, whole)))

    boxes = F.filter(N.placed(doc, "bold_container"), lambda n: n["bold"] > 0)
    found = F.transform(boxes, of_container)
    return F.filter(
        found,
        lambda c: (c["value"] != "")
        & (F.length(c["value"]) < MAX_VALUE)
        & ~c["value"].contains(SCRIPT_TRACE),
    )


def _method_2(doc: Column) -> Column:
    """dt followed directly by dd."""
    nodes = doc["nodes"]

    def of_term(node: Column) -> Column:
        value = let(N.node_at(nodes, node["next"]), lambda after: F.when(after["tag"] == "dd", N.node_text(doc, after)))
        return _candidate(2, node, F.lower(N.node_text(doc, node)), value)

    found = F.transform(N.placed(doc, "term"), of_term)
    return F.filter(found, lambda c: (c["value"] != "") & (F.length(c["value"]) < MAX_VALUE))


def _method_3(doc: Column) -> Column:
    """Table rows with header cells and data cells."""
    nodes = doc["nodes"]

    def of_row(node: Column) -> Column:
        part = N.inside(nodes, node)
        label = N.joined_text(doc, F.filter(part, lambda n: n["tag"] == "th"))
        value = N.joined_text(doc, F.filter(part, lambda n: n["tag"] == "td"))
        return _candidate(3, node, F.lower(label), value)

    found = F.transform(N.placed(doc, "row"), of_row)
    return F.filter(found, lambda c: (c["label"] != "") & (c["value"] != "") & (F.length(c["value"]) < MAX_VALUE))


def _method_4(doc: Column, longest: int) -> Column:
    """div or span that holds nothing but the label, followed by another one."""
    nodes = doc["nodes"]
    box = ("div", "span")

    def of_box(node: Column) -> Column:
        def text(after: Column) -> Column:
            near = after["tag"].isin(*box) & (N.text_length(after) < MAX_NEXT_VALUE)
            return F.when(near, N.node_text(doc, after))

        return _candidate(4, node, F.lower(N.node_text(doc, node)), let(N.node_at(nodes, node["next"]), text))

    boxes = F.filter(
        N.placed(doc, "box"), lambda n: (n["next"] > 0) & N.text_length(n).between(1, longest + 1)
    )
    found = F.transform(boxes, of_box)
    return F.filter(
        found, lambda c: (c["value"] != "") & let(F.lower(c["value"]), lambda v: ~contains_any(v, NOT_A_VALUE))
    )


def candidates(
    doc: Column, methods: Sequence[int] = METHODS, labels: Mapping[str, Sequence[str]] = LABELS
) -> Column:
    """ARRAY<STRUCT<method, pos, label, value>> of a page, labels in lower case."""
    longest = max(len(label) for names in labels.values() for label in names)
    build = {
        0: lambda: _method_0(doc),
        1: lambda: _method_1(doc),
        2: lambda: _method_2(doc),
        3: lambda: _method_3(doc),
        4: lambda: _method_4(doc, longest),
    }
    return F.concat(*[build[m]() for m in methods])


def dictionary(labels: Mapping[str, Sequence[str]] = LABELS) -> dict[str, list[dict]]:
    """The words of the dictionary, each with the places it has there: target, its number, and rank."""
    words: dict[str, list[dict]] = {}
    for no, (target, names) in enumerate(labels.items()):
        for prio, label in enumerate(names, 1):
            words.setdefault(label.lower(), []).append({"target": target, "no": no, "prio": prio})
    return words


def _constant(value, type_: str) -> Column:
    """Folded into the plan, not shipped as a table."""
    return F.from_json(F.lit(json.dumps(value)), type_)


def bare_label(label: Column) -> Column:
    return blank_to_null(trim(F.translate(label, ":#", "")))


def label_matches(label: Column, bare: Column, method: Column, wanted: Column, strict: bool = False) -> Column:
    """Does the label found on the page stand for the dictionary's ``wanted`` label?

    Field blocks also match when the dictionary's label contains the page's bare label
    (``strict`` turns that off); stand-alone labels must be equal.
    """
    part_of = F.contains(label, wanted)
    in_block = part_of if strict else part_of | F.coalesce(F.contains(wanted, bare), F.lit(False))
    return (
        F.when(method == 0, in_block)
        .when(method == 4, (label == wanted) | (label == F.concat(wanted, F.lit(":"))))
        .otherwise(part_of)
    )


def _matching(c: Column, words: Mapping[str, Sequence], of_word: Sequence, type_: str, strict: bool) -> Column:
    """What ``of_word`` has for the words a candidate stands for, as one array."""
    all_words = _constant([{"word": w, "has": x} for w, x in zip(words, of_word)], f"array<struct<word:string,has:array<{type_}>>>")

    def hits(label: Column, bare: Column) -> Column:
        # Few words pass the plain tests on strings; only those get the method's own rule.
        part_of = F.filter(all_words, lambda w: F.contains(label, w["word"]))
        either = F.filter(all_words, lambda w: F.contains(label, w["word"]) | F.contains(w["word"], bare))
        near = F.when(c["method"] == 0, part_of if strict else either).otherwise(part_of)
        return F.filter(near, lambda w: label_matches(label, bare, c["method"], w["word"], strict))

    found = let(c["label"], lambda label: let(bare_label(label), lambda bare: hits(label, bare)))
    return F.flatten(F.transform(found, lambda w: w["has"]))


def matches(
    cands: Column, labels: Mapping[str, Sequence[str]] = LABELS, strict: bool = False
) -> Column:
    """ARRAY<STRUCT<target, prio, method, pos, label, value>>: candidates x matching labels."""
    words = dictionary(labels)

    def of_candidate(c: Column) -> Column:
        return F.transform(
            _matching(c, words, list(words.values()), "struct<target:string,prio:int>", strict),
            lambda e: F.struct(
                e["target"].alias("target"),
                e["prio"].alias("prio"),
                c["method"].alias("method"),
                c["pos"].alias("pos"),
                c["label"].alias("label"),
                c["value"].alias("value"),
            ),
        )

    return F.flatten(F.transform(cands, of_candidate))


# A match as one number that orders by target, rank of the label, place of the candidate.
_TARGET, _PRIO = 1 << 48, 1 << 32


def match_keys(cands: Column, labels: Mapping[str, Sequence[str]] = LABELS, strict: bool = False) -> Column:
    """ARRAY<BIGINT>: the matches as numbers, which cost less to compare than rows. See ``value_by_key``."""
    words = dictionary(labels)
    keys = [[e["no"] * _TARGET + e["prio"] * _PRIO for e in entries] for entries in words.values()]
    return F.flatten(
        F.transform(cands, lambda c, i: F.transform(_matching(c, words, keys, "bigint", strict), lambda k: k + i))
    )


def value_by_key(cands: Column, keys: Column, target: str, labels: Mapping[str, Sequence[str]] = LABELS) -> Column:
    """As ``best_value``, for candidates that stand in the order of their methods."""
    low = list(labels).index(target) * _TARGET
    first = F.array_min(F.filter(keys, lambda k: k.between(low, low + _TARGET - 1)))
    return F.get(cands, first.bitwiseAND(F.lit(_PRIO - 1)).cast("int"))["value"]


def best_value(found: Column, target: str) -> Column:
    """Value of the first match of a target: label order, then method, then position."""
    own = F.filter(found, lambda m: m["target"] == target)
    return F.array_min(own)["value"]


def page_fields(docs: DataFrame, keys=("page_id",), methods: Sequence[int] = METHODS) -> DataFrame:
    """Candidates as rows."""
    return docs.select(*keys, F.explode(candidates(F.col("doc"), methods)).alias("_c")).select(
        *keys, "_c.*"
    )


def field_dictionary_join(
    docs: DataFrame, keys=("page_id",), labels: Mapping[str, Sequence[str]] = LABELS,
    strict: bool = False, methods: Sequence[int] = METHODS,
) -> DataFrame:
    """Candidates with every dictionary label they stand for."""
    found = docs.select(*keys, candidates(F.col("doc"), methods, labels).alias("_c"))
    return found.select(*keys, F.explode(matches(F.col("_c"), labels, strict)).alias("_m")).select(
        *keys, "_m.*"
    )


def field_by_labels(
    docs: DataFrame, keys=("page_id",), labels: Mapping[str, Sequence[str]] = LABELS,
    strict: bool = False, methods: Sequence[int] = METHODS,
) -> DataFrame:
    """One row per page with one column per target."""
    found = docs.select(*keys, candidates(F.col("doc"), methods, labels).alias("_c"))
    matched = found.select(*keys, matches(F.col("_c"), labels, strict).alias("_m"))
    return matched.select(*keys, *[best_value(F.col("_m"), t).alias(t) for t in labels])


# --- running text -----------------------------------------------------------------------


def content_text(doc: Column) -> Column:
    """Text of the content areas one after the other, or of the body when they are empty."""
    areas = F.array_join(F.transform(N.placed(doc, "content"), lambda n: N.raw_text(doc, n)), "")
    return let(areas, lambda text: F.when(text != "", text).otherwise(N.body_text(doc)))


def text_by_pattern(text: Column, pattern: str) -> Column:
    """First group of the first match, or the whole match when the group is empty."""
    return F.coalesce(
        blank_to_null(trim(F.regexp_extract(text, pattern, 1))),
        blank_to_null(trim(F.regexp_extract(text, pattern, 0))),
    )


def text_field_pattern(label: str) -> str:
    stops = "|".join((*STOP_WORDS, r"\z"))
    return rf"(?i){label}[:{BLANK_CLASS}]*([^\n]{{3,100}})(?={WS}*(?:{stops}))"


def field_from_text(text: Column, labels: Sequence[str]) -> Column:
    """Value behind a label in running text, up to the next known label or the end."""
    found = []
    for label in labels:
        value = trim(F.regexp_extract(text, text_field_pattern(label), 1))
        kept = (value != "") & (F.length(value) < 200) & ~value.contains(SCRIPT_TRACE)
        # The regex only runs on texts that hold the label at all.
        found.append(F.when(text.rlike(f"(?i){label}"), F.when(kept, value)))
    return F.coalesce(*found)
