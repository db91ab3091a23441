"""page_nodes: the one place where Python sees a page.

An Arrow UDF turns HTML into ``STRUCT<nodes, chunks>``. The chunks are the pieces between tags of
the page's text without scripts, styles and hidden parts; each node is an element with its place in
document order and the range of that text it covers. A node's subtree is a contiguous slice of
``nodes`` and its text a slice of ``chunks``: reading it costs
its own length, where a substring would walk the page from its start. So the output is
linear in the page and everything after it (selectors, fields, sections, titles) is Spark
expressions on one row. For the selectors met most, ``places`` lists the elements, so that
an expression looks at those and not at all elements of the page.
"""

from __future__ import annotations

import html as _html
import re
import sys
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import BLANKS, let

# Workers need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What an element must look like to carry a mark. A rule is
# (kind, value) with kind in tag, token (whole class name), part (piece of the class
# attribute), id, role.
MARKS = {
    "main": [("tag", "main")],
    "article": [("tag", "article")],
    "role_main": [("role", "main")],
    "content_id": [("id", "content")],
    "content_class": [("token", "content")],
    "job_class": [("part", "job")],
    "detail_class": [("part", "detail")],
    "header": [("tag", "header")],
    "nav": [("tag", "nav")],
    "results": [("token", "section__content__results")],
    "list": [("token", "list")],
    "card": [("token", "article")],
    "list_item": [("token", "list-item"), ("token", "list__item")],
    "title": [("token", "article__header__text__title"), ("token", "list__item__text__title")],
    "subtitle": [
        ("token", "article__header__text__subtitle"),
        ("token", "list__item__text__subtitle"),
    ],
    "field": [("token", "article__content__view__field")],
    "label": [("token", "article__content__view__field__label")],
    "value": [("token", "article__content__view__field__value")],
    "value_font": [("token", "article__content__view__field__value--font")],
    "section": [
        ("tag", "section"), ("tag", "details"), ("role", "region"),
        ("part", "section"), ("part", "collapsible"),
    ],
    "heading": [
        ("tag", "h2"), ("tag", "h3"), ("tag", "h4"), ("tag", "summary"),
        ("part", "header"), ("part", "title"),
    ],
    "screen_reader": [("token", "sr-only")],
    "primary_button": [("token", "button--primary")],
}
MARK_BIT = {name: 1 << i for i, name in enumerate(MARKS)}

# What is looked for on whole pages, by the same rules. The elements of each stand in ``places``.
PLACES = {
    "body": [("tag", "body")],
    "head": [("tag", "head")],
    "page_title": [("tag", "title")],
    "meta": [("tag", "meta")],
    "h1": [("tag", "h1")],
    "h3": [("tag", "h3")],
    "link": [("tag", "a")],
    "term": [("tag", "dt")],
    "row": [("tag", "tr")],
    "box": [("tag", "div"), ("tag", "span")],
    "bold_container": [("tag", "p"), ("tag", "div"), ("tag", "span"), ("tag", "li")],
    "field": MARKS["field"],
    "value": MARKS["value"],
    "section": MARKS["section"],
    "content": [rule for name in ("main", "article", "role_main", "content_id", "content_class") for rule in MARKS[name]],
    "card": MARKS["card"] + MARKS["list_item"],
}
PLACE_AT = {name: i for i, name in enumerate(PLACES)}

HIDDEN_CLASS = "visibility--hidden--visually"

# HTML elements without content, and the open elements a start tag ends.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCKS = (
    "address article aside blockquote details div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul"
).split()
ENDS = {tag: frozenset(["p"]) for tag in _BLOCKS}
ENDS.update(
    {
        "li": frozenset(["li", "p"]),
        "dt": frozenset(["dt", "dd", "p"]),
        "dd": frozenset(["dt", "dd", "p"]),
        "tr": frozenset(["tr", "td", "th", "p"]),
        "td": frozenset(["td", "th", "p"]),
        "th": frozenset(["td", "th", "p"]),
        "tbody": frozenset(["thead", "tbody", "tr", "td", "th"]),
        "tfoot": frozenset(["thead", "tbody", "tr", "td", "th"]),
        "option": frozenset(["option"]),
        "optgroup": frozenset(["option", "optgroup"]),
        "body": frozenset(["head"]),
    }
)

NODE_FIELDS = [
    ("seq", "int"),        # place in document order, from 1
    ("parent", "int"),     # seq of the parent, 0 at the top
    ("last", "int"),       # seq of the last descendant, own seq when there is none
    ("next", "int"),       # seq of the next sibling element, 0 when there is none
    ("until", "int"),      # h1-h3 only: seq where the next h1-h3 sibling or the parent's end is
    ("bold", "int"),       # seq of the first strong/b inside, 0 when there is none
    ("own", "int"),        # marks of the element itself
    ("within", "int"),     # marks of its ancestors
    ("raw_start", "int"), ("raw_end", "int"),      # range of text
    ("text_start", "int"), ("text_end", "int"),    # the same without blanks at the ends
    ("tag", "string"), ("id", "string"), ("cls", "string"), ("role", "string"),
    ("href", "string"), ("property", "string"), ("content", "string"),
    ("chunk", "int"), ("n_chunks", "int"),         # range of chunks
    ("size", "int"),       # length of the text without blanks at the ends
    ("loose", "int"),      # 1 when there are blanks at the ends
]
# What ``page_nodes`` gives out, and what the expressions on a page read.
OUTPUT_FIELDS = [f for f in NODE_FIELDS if f[0] not in ("chunk", "n_chunks", "size", "loose")]
DOC_FIELDS = [f for f in NODE_FIELDS if f[0] not in ("raw_start", "raw_end", "text_start", "text_end", "id", "role")]
_SPARK = {"int": T.IntegerType(), "string": T.StringType()}


def _doc_type(fields):
    node = T.StructType([T.StructField(n, _SPARK[t]) for n, t in fields])
    return T.StructType(
        [
            T.StructField("nodes", T.ArrayType(node)), T.StructField("chunks", T.ArrayType(T.StringType())),
            T.StructField("places", T.ArrayType(T.ArrayType(T.IntegerType()))),
        ]
    )


_ARROW = {"int": pa.int32(), "string": pa.string()}

# A comment or declaration, an element whose content is plain text, or any other tag.
_ATTRS = r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)"
_INNER = _ATTRS.replace("((?:", "(?:(?:", 1)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    rf"|<(script|style|title|textarea)(?=[\s/>]){_ATTRS}>(.*?)(?:</\1\s*>|\Z)"
    rf"|<(/?[a-z][^\s/>]*{_INNER})(?:>|\Z)",
    re.S | re.I,
)
_STEP = _TOKEN.groups + 1  # of the list that ``_TOKEN.split`` gives: the groups of a token, and the text behind it
_NAME = re.compile(r"(/?)([a-z][^\s/>]*)", re.I)
_ATTR = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*))""")
_DROPPED = frozenset(["script", "style", "noscript"])
_NO_MARKUP = frozenset(["script", "style"])
_FIELD_AT = {name: i for i, (name, _) in enumerate(NODE_FIELDS)}
# Fields of a node that its start tag says: what the reader makes of an element has the tag's number in their place.
_SAID = ("own", "tag", "id", "cls", "role", "href", "property", "content")
_MADE = [n for n, _ in NODE_FIELDS if n not in _SAID]
_MAX_LOOKS = 50_000


def _fitting(selectors, tag, ident, cls, role):
    """Names of the selectors of which a rule fits the element."""
    tokens = cls.split() if cls else ()
    found = []
    for name, rules in selectors.items():
        for kind, value in rules:
            if (
                (kind == "tag" and tag == value)
                or (kind == "token" and value in tokens)
                or (kind == "part" and cls is not None and value in cls)
                or (kind == "id" and ident == value)
                or (kind == "role" and role == value)
            ):
                found.append(name)
                break
    return found


class _Look:
    """What a tag says: its name, dropped or not, its marks, the attributes that are kept, and its places."""

    __slots__ = ("tag", "ends", "void", "level", "bold", "dropped", "silent", "own", "said", "places", "number")


def _fit(tag, ident, cls, role, drop_hidden, dropped_tags):
    """Dropped or not, unheard or not, marks and places of an element: what addresses and contents do not change."""
    hidden = drop_hidden and cls is not None and HIDDEN_CLASS in cls.split()
    own = sum(MARK_BIT[name] for name in _fitting(MARKS, tag, ident, cls, role))
    places = tuple(PLACE_AT[name] for name in _fitting(PLACES, tag, ident, cls, role))
    return tag in dropped_tags or hidden, tag in _NO_MARKUP or hidden, own, places


class _Looks:
    """Remembers tags from page to page: by their text, and by number what those of elements say."""

    def __init__(self, drop_hidden=True, dropped_tags=_DROPPED):
        self.known, self.said, self.fits, self.rules = {}, [], {}, (drop_hidden, dropped_tags)

    def start(self, key, tag, attr_text):
        if len(self.known) > _MAX_LOOKS:
            self.known.clear()
            self.fits.clear()
        tag = tag.lower()
        attrs = {}
        if "=" in attr_text:
            for name, a, b, c in _ATTR.findall(attr_text):
                value = a or b or c
                attrs.setdefault(name.lower(), _html.unescape(value) if "&" in value else value)
        get = attrs.get
        fitting = tag, get("id"), get("class"), get("role")
        fit = self.fits.get(fitting)
        if fit is None:
            fit = self.fits[fitting] = _fit(*fitting, *self.rules)
        look = self.known[key] = _Look()
        look.dropped, look.silent, look.own, look.places = fit
        look.tag, look.ends, look.void, look.number = tag, ENDS.get(tag), tag in VOID, len(self.said)
        look.level, look.bold = tag in ("h1", "h2", "h3"), tag in ("strong", "b")
        look.said = (look.own, *fitting, get("href"), get("property"), get("content") if tag == "meta" else None)
        self.said.append(look.said)
        return look

    def mark(self, text):
        """What stands between the brackets of a tag: of an end tag its name alone."""
        slash, tag = _NAME.match(text).groups()
        if not slash:
            return self.start(text, tag, text[len(tag) :])
        tag = self.known[text] = tag.lower()
        return tag


def read_page(source, drop_hidden=True):
    """Text and node rows of one page."""
    chunks, rows = read_chunks(source, drop_hidden)
    return "".join(chunks), rows


def read_chunks(source, drop_hidden=True):
    """As ``read_page``, the text in its chunks; a row has all of ``NODE_FIELDS``."""
    looks = _Looks(drop_hidden)
    chunks, rows = _read(source, looks, [[] for _ in PLACES])
    made = [dict(zip(_MADE, row)) | dict(zip(_SAID, looks.said[row[-1]])) for row in rows]
    return chunks, [[row[name] for name, _ in NODE_FIELDS] for row in made]


def _read(source, looks, places=None, anchors=None):
    """Chunks of a page's text, and a row for each element: ``_MADE`` and the number of its tag.

    ``places`` has a list for each of ``PLACES`` to be filled. ``anchors`` gets [href, text] of each ``<a>``,
    markup for readers without scripts included, whose text and elements are else left out.
    """
    known = looks.known
    rows, chunks, starts = [], [], []
    length = 0
    # What anchors are read from: their first and last pieces of ``heard``, in which all text of the page stands.
    heard, links = [], []
    # Open elements: [tag, row or None when dropped, marks for children, last child, open heading, heard or not, link]
    top = ["", [0] * 12, 0, None, None, anchors is not None, None]
    stack = [top]
    open_tags = {}

    def close():
        """End the innermost open element."""
        tag, row, _, _, heading, _, link = stack.pop()
        open_tags[tag] -= 1
        if row is not None:
            row[2] = len(rows)
            row[8] = length
            row[10] = len(chunks)
            if heading is not None:
                heading[4] = len(rows) + 1
        if link is not None:
            link[2] = len(heard)
        return stack[-1]

    parts = _TOKEN.split(source)
    if parts[-1] == "" and len(parts) > 1 and parts[-2] is not None and source[-1] != ">":
        del parts[-_STEP:]  # the text ends inside a tag
    data = parts[0]
    tokens = iter(parts)
    next(tokens)
    for raw_tag, raw_attrs, raw_text, mark, after in zip(tokens, tokens, tokens, tokens, tokens):
        if data:
            if "&" in data:
                data = _html.unescape(data)
            if top[1] is not None:
                chunks.append(data)
                starts.append(length)
                length += len(data)
            if top[5]:
                heard.append(data)
        data = after
        if mark is not None:
            look = known.get(mark) or looks.mark(mark)
            if look.__class__ is str:
                if open_tags.get(look):
                    while top[0] != look:
                        top = close()
                    top = close()
                continue
        elif raw_tag is not None:
            key = (raw_tag, raw_attrs)
            look = known.get(key) or looks.start(key, raw_tag, raw_attrs)
        else:
            continue

        ends = look.ends
        if ends is not None:
            while top[0] in ends:
                top = close()

        row, link, parent, inherited = None, None, top[1], top[2]
        if parent is not None and not look.dropped:
            seq, at_chunk = len(rows) + 1, len(chunks)
            row = [seq, parent[0], seq, 0, 0, 0, inherited, length, length, at_chunk, at_chunk]
            rows.append(row)
            for i in look.places:
                places[i].append(seq)
            inherited |= look.own
            if top[3] is not None:
                top[3][3] = seq
            top[3] = row
            if look.level:
                if top[4] is not None:
                    top[4][4] = seq
                top[4] = row
            elif look.bold:
                # Tell the elements around it, up to one that knows of an earlier bold.
                for entry in reversed(stack):
                    if entry[1][5]:
                        break
                    entry[1][5] = seq
        is_heard = top[5] and not look.silent
        if is_heard and look.tag == "a":
            link = [look.said[5], len(heard), 0]
            links.append(link)
        if mark is None:
            if raw_text:
                text = _html.unescape(raw_text) if "&" in raw_text else raw_text
                if row is not None:
                    chunks.append(text)
                    starts.append(length)
                    length += len(text)
                    row[8], row[10] = length, len(chunks)
                if is_heard:
                    heard.append(text)
        elif not look.void:
            tag = look.tag
            top = [tag, row, inherited, None, None, is_heard, link]
            stack.append(top)
            open_tags[tag] = open_tags.get(tag, 0) + 1
        if row is not None:
            row.append(look.number)

    if data:
        data = _html.unescape(data)
        if top[1] is not None:
            chunks.append(data)
            starts.append(length)
            length += len(data)
        if top[5]:
            heard.append(data)
    while len(stack) > 1:
        top = close()
    if top[4] is not None:
        top[4][4] = len(rows) + 1
    if anchors is not None:
        # An anchor left open ends where the next one starts.
        ends = [link[1] for link in links[1:]] + [len(heard)]
        anchors += ([href, "".join(heard[first : min(last, end)]).strip(BLANKS)] for (href, first, last), end in zip(links, ends))
    _trim_ranges(rows, chunks, starts, length)
    return chunks, rows


def _trim_ranges(rows, chunks, starts, length):
    """Turn the chunk numbers of each row into its text range without outer blanks; they move to its end."""
    n = len(chunks)
    # Where the next text that is not blank starts, and where the last one ended.
    ahead, behind = [length] * (n + 1), [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        kept = len(chunks[i].lstrip(BLANKS))
        ahead[i] = starts[i] + len(chunks[i]) - kept if kept else ahead[i + 1]
    for i in range(n):
        kept = len(chunks[i].rstrip(BLANKS))
        behind[i + 1] = starts[i] + kept if kept else behind[i]
    for row in rows:
        chunk, end, number = row[9:]
        first, last = ahead[chunk], behind[end]
        raw = row[7]
        if first >= last:
            first = last = raw
        row[9:] = first, last, chunk, end - chunk, last - first, int(first != raw or last != row[8]), number


def _lists(offsets, values):
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _parse_batch(pages, drop_hidden, fields, with_anchors=False):
    rows, offsets, pieces, piece_offsets, looks = [], [0], [], [0], _Looks(drop_hidden)
    seqs, seq_offsets, place_offsets = [], [0], [0]
    anchors = [] if with_anchors else None
    for source in pages.to_pylist():
        places = [[] for _ in PLACES]
        found_anchors = [] if with_anchors else None
        chunks, found = _read(source or "", looks, places, found_anchors)
        rows += found
        offsets.append(len(rows))
        pieces += chunks
        piece_offsets.append(len(pieces))
        for place in places:
            seqs += place
            seq_offsets.append(len(seqs))
        place_offsets.append(len(seq_offsets) - 1)
        if with_anchors:
            anchors.append(found_anchors)
    made = np.fromiter(chain.from_iterable(rows), np.int32, len(rows) * (len(_MADE) + 1)).reshape(-1, len(_MADE) + 1)
    numbers = pa.array(np.ascontiguousarray(made[:, -1]))
    said = list(zip(*looks.said)) or [()] * len(_SAID)

    def column(name, kind):
        if name in _SAID:
            return pa.array(said[_SAID.index(name)], _ARROW[kind]).take(numbers)
        return pa.array(np.ascontiguousarray(made[:, _MADE.index(name)]))

    nodes = pa.StructArray.from_arrays([column(n, t) for n, t in fields], names=[n for n, _ in fields])
    places = _lists(place_offsets, _lists(seq_offsets, pa.array(seqs, pa.int32())))
    parts = {"nodes": _lists(offsets, nodes), "chunks": _lists(piece_offsets, pa.array(pieces, pa.string())), "places": places}
    if with_anchors:
        parts["anchors"] = _anchor_lists(anchors)
    return pa.StructArray.from_arrays(list(parts.values()), names=list(parts))


def _anchor_lists(pages):
    """[href, text] of each page's anchors as rows with their place."""
    offsets = np.cumsum([0, *map(len, pages)])
    href, text = zip(*chain.from_iterable(pages)) if offsets[-1] else ((), ())
    pos = pa.array([i for page in pages for i in range(len(page))], pa.int32())
    rows = pa.StructArray.from_arrays([pos, pa.array(href, pa.string()), pa.array(text, pa.string())], names=["pos", "href", "text"])
    return _lists(offsets, rows)


def _parser(fields, drop_hidden):
    @F.arrow_udf(_doc_type(fields))
    def parse(pages: pa.Array) -> pa.Array:
        return _parse_batch(pages, drop_hidden, fields)

    return parse


_parse_visible, _parse_all, _parse_output = _parser(DOC_FIELDS, True), _parser(DOC_FIELDS, False), _parser(NODE_FIELDS, True)


def parse_html(html: Column, drop_hidden: bool = True) -> Column:
    return _parse_visible(html) if drop_hidden else _parse_all(html)


ANCHORS_TYPE = T.ArrayType(
    T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType()), T.StructField("text", T.StringType())])
)


@F.arrow_udf(ANCHORS_TYPE)
def _read_anchors(pages: pa.Array) -> pa.Array:
    looks, out = _Looks(), []
    for source in pages.to_pylist():
        out.append([])
        _read(source or "", looks, [[] for _ in PLACES], out[-1])
    return _anchor_lists(out)


def page_anchors(html: Column) -> Column:
    """All ``<a>`` of a page in order. Hidden elements are left out; markup for readers without scripts is read."""
    return _read_anchors(html)


@F.arrow_udf(T.StructType([*_doc_type(DOC_FIELDS).fields, T.StructField("anchors", ANCHORS_TYPE)]))
def _parse_with_anchors(pages: pa.Array) -> pa.Array:
    return _parse_batch(pages, True, DOC_FIELDS, with_anchors=True)


def with_doc_and_anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    """As ``with_doc``; ``doc.anchors`` holds what ``page_anchors`` gives, from the same reading."""
    return pages.withColumn("doc", _parse_with_anchors(F.col(html))).drop(html)


def with_doc(pages: DataFrame, html: str = "html", drop_hidden: bool = True) -> DataFrame:
    """Replace the HTML column by ``doc``. Filter first: this is the expensive step."""
    return pages.withColumn("doc", parse_html(F.col(html), drop_hidden)).drop(html)


def page_nodes(pages: DataFrame, keys=("page_id",), html: str = "html") -> DataFrame:
    """One row per element with its trimmed text."""
    doc = pages.select(*keys, _parse_output(F.col(html)).alias("doc"))
    # Texts are taken before the explode, which would copy the page to each of its elements.
    texts = F.transform("doc.nodes", lambda n: node_text(F.col("doc"), n)).alias("text")
    pairs = doc.select(*keys, F.explode(F.arrays_zip(F.col("doc.nodes").alias("node"), texts)).alias("_one"))
    fields = [F.col(f"_one.node.{n}") for n, _ in OUTPUT_FIELDS]
    return pairs.select(*keys, *fields, F.col("_one.text").alias("text"))


# --- reading a parsed page ------------------------------------------------------------


def mask(*names: str) -> int:
    bits = 0
    for name in names:
        bits |= MARK_BIT[name]
    return bits


def is_marked(node: Column, *names: str) -> Column:
    """The element carries at least one of the marks."""
    return node["own"].bitwiseAND(F.lit(mask(*names))) != 0


def is_within(node: Column, *names: str) -> Column:
    """Some ancestor carries at least one of the marks."""
    return node["within"].bitwiseAND(F.lit(mask(*names))) != 0


def placed(doc: Column, name: str) -> Column:
    """The elements of one of ``PLACES`` in document order: no look at the others."""
    return F.transform(F.get(doc["places"], F.lit(PLACE_AT[name])), lambda seq: node_at(doc["nodes"], seq))


def first_placed(doc: Column, name: str) -> Column:
    """First element of one of ``PLACES``, null without one."""
    return node_at(doc["nodes"], F.get(F.get(doc["places"], F.lit(PLACE_AT[name])), F.lit(0)))


def node_text(doc: Column, node: Column) -> Column:
    """Trimmed text of an element; to trim is dear, and the reader knows where there is something to trim."""
    raw = raw_text(doc, node)
    return F.when(node["loose"] == 0, raw).otherwise(F.btrim(raw, F.lit(BLANKS)))


def raw_text(doc: Column, node: Column) -> Column:
    joined = F.array_join(F.slice(doc["chunks"], node["chunk"] + 1, node["n_chunks"]), "")
    return F.when(node["n_chunks"] == 1, F.get(doc["chunks"], node["chunk"])).otherwise(joined)


def text_length(node: Column) -> Column:
    return node["size"]


def node_at(nodes: Column, seq: Column) -> Column:
    """Element by its place, null for 0."""
    return F.get(nodes, seq - 1)


def inside(nodes: Column, node: Column) -> Column:
    """All descendants of an element: a slice, no search."""
    return F.slice(nodes, node["seq"] + 1, node["last"] - node["seq"])


def page_text(doc: Column) -> Column:
    """All text of the page."""
    return F.array_join(doc["chunks"], "")


def joined_text(doc: Column, nodes: Column) -> Column:
    """Texts of several elements put together, then trimmed."""
    return F.btrim(
        F.array_join(F.transform(nodes, lambda n: raw_text(doc, n)), ""), F.lit(BLANKS)
    )


def body_text(doc: Column) -> Column:
    """Text of the body; without its tag all behind the head, without a head the page."""
    start = let(first_placed(doc, "head"), lambda head: F.coalesce(head["chunk"] + head["n_chunks"], F.lit(0)))
    rest = F.array_join(F.slice(doc["chunks"], start + 1, F.greatest(F.size(doc["chunks"]), F.lit(1))), "")
    bodies = F.transform(placed(doc, "body"), lambda n: raw_text(doc, n))
    return F.when(F.size(F.get(doc["places"], F.lit(PLACE_AT["body"]))) == 0, rest).otherwise(F.array_join(bodies, ""))
