"""Registered queries: each operator run on the sample tables, with equivalent SQL."""

from __future__ import annotations

from docquarry.catalog.registry import Catalog
from docquarry.catalog import aggregations, predicates, searching, writes


def catalog() -> Catalog:
    full = Catalog()
    for part in (searching, predicates, aggregations, writes):
        full.add_all(part.QUERIES)
    return full
