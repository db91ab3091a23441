"""Every query with its SQL twin, by family."""

from __future__ import annotations

from . import fields, gate, jobs, links, reports, sources, streams, urls

_FAMILIES = (urls, gate, links, fields, jobs, reports, sources, streams)


def queries():
    return {name: fn for family in _FAMILIES for name, fn in family.QUERIES.items()}


def oracle_sql():
    return {name: sql for family in _FAMILIES for name, sql in family.SQL.items()}
