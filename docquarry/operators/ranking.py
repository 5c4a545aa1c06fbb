"""Relevance ranking: BM25 over text clauses, constants for the rest."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.functions.analysis import analyzer
from docquarry.functions.fields import FieldRef
from docquarry.functions.predicates import Fields, bool_, holds
from docquarry.operators.search import ID

# The usual BM25 saturation and length parameters.
K1, B = 1.2, 0.75


@dataclass(frozen=True)
class Scored:
    """A predicate with its contribution to the score.

    Without ``words`` the clause is worth ``boost``; with them it is worth
    ``boost`` times the BM25 score of the words in ``ref``.  ``zero_unless_met``
    says that this is 0 by itself on rows where the clause does not hold.
    """

    where: Column
    boost: float = 1.0
    ref: FieldRef | None = None
    words: tuple[str, ...] = ()
    zero_unless_met: bool = False


@dataclass(frozen=True)
class _Text:
    """Tokens of a scored field, and the collection statistics of its words."""

    tokens: Column
    docs: Column
    mean_length: Column
    found: dict[str, Column]


def scored_match(fields: Fields, field: str, value: Any, boost: float = 1.0,
                 **options: Any) -> Scored:
    """A ``match`` clause that scores by BM25 on a text field."""
    where = fields.match(field, value, **options)
    ref = fields.field(field)
    boost *= ref.boost
    if ref.analyzer is None or options.get("fuzziness") is not None:
        return Scored(where, boost)
    searcher = analyzer(options["analyzer"]) if options.get("analyzer") else ref.search_analyzer
    words = tuple(dict.fromkeys(searcher.split(str(value))))
    any_word = (options.get("operator", "OR").upper() == "OR"
                and options.get("minimum_should_match") is None)
    return Scored(where, boost, ref, words, zero_unless_met=any_word and bool(words))


def scored(where: Column, boost: float = 1.0) -> Scored:
    """A clause worth a constant."""
    return Scored(where, boost)


def score_all(df: DataFrame, must: Iterable[Scored] = (), should: Iterable[Scored] = (),
              filter: Iterable[Column] = (), must_not: Iterable[Column] = (),
              minimum_should_match: int | str | None = None) -> DataFrame:
    """Every matching document with its ``_score``.

    Collection statistics come from ``df`` as a whole in one aggregation, used
    as a scalar subquery; a second pass reads and scores matching rows only.
    """
    # A must clause holds on every hit, so its condition need not be tested again.
    must = [replace(c, zero_unless_met=True) for c in must]
    should = [*should]
    scoring = must + should
    where = bool_([c.where for c in must], filter, [c.where for c in should], must_not,
                  minimum_should_match)
    texts = _texts(scoring)
    hits = df.where(where)
    if not scoring:
        return hits.withColumn("_score", F.lit(0.0))
    if not texts:
        return hits.withColumn("_score", _total(scoring, {}))
    # One subquery expression, read field by field: Spark runs it once.
    stats = _statistics(df, texts).scalar()
    lookup = {path: _Text(F.col(f"__tokens{i}"), stats.getField(f"n{i}"),
                          stats.getField(f"len{i}"),
                          {w: stats.getField(f"df{i}_{j}") for j, w in enumerate(words)})
              for i, (path, (_, words)) in enumerate(texts.items())}
    # A column of its own, so that a text is split once and not once per use.
    split = {f"__tokens{i}": ref.tokens() for i, (ref, _) in enumerate(texts.values())}
    return hits.withColumns(split).withColumn("_score", _total(scoring, lookup)).drop(*split)


def rank(df: DataFrame, *, size: int = 10, from_: int = 0, key: str = ID,
         **clauses: Any) -> DataFrame:
    """One page of :func:`score_all`, best first, ties by ``key``."""
    hits = score_all(df, **clauses).orderBy(F.desc("_score"), F.asc(key))
    return (hits.offset(from_) if from_ else hits).limit(size)


def max_score(scored_hits: DataFrame) -> DataFrame:
    """Best score over all hits, whatever the page."""
    return scored_hits.agg(F.max("_score").alias("max_score"))


def _texts(clauses: list[Scored]) -> dict[str, tuple[FieldRef, list[str]]]:
    texts: dict[str, tuple[FieldRef, list[str]]] = {}
    for clause in clauses:
        if clause.words:
            _, words = texts.setdefault(clause.ref.path, (clause.ref, []))
            words += [w for w in clause.words if w not in words]
    return texts


def _statistics(df: DataFrame, texts: dict[str, tuple[FieldRef, list[str]]]) -> DataFrame:
    split, measures = [], []
    for i, (ref, words) in enumerate(texts.values()):
        tokens = F.col(f"__tokens{i}")
        split.append(ref.tokens().alias(f"__tokens{i}"))
        measures += [F.count(tokens).alias(f"n{i}"), F.avg(F.size(tokens)).alias(f"len{i}")]
        measures += [F.count_if(F.array_contains(tokens, w)).alias(f"df{i}_{j}")
                     for j, w in enumerate(words)]
    totals = df.select(*split).agg(*measures)
    return totals.select(F.struct(*totals.columns).alias("stats"))


def _total(clauses: list[Scored], lookup: dict[str, _Text]) -> Column:
    parts = [_score(c, lookup) if c.zero_unless_met else
             F.when(holds(c.where), _score(c, lookup)).otherwise(F.lit(0.0)) for c in clauses]
    return reduce(lambda a, b: a + b, parts)


def _score(clause: Scored, lookup: dict[str, _Text]) -> Column:
    if not clause.words:
        return F.lit(float(clause.boost))
    text = lookup[clause.ref.path]
    length = F.size(text.tokens)
    parts = []
    for word in clause.words:
        # Counting by removal stays in generated code; a lambda would not.
        tf = (length - F.size(F.array_remove(text.tokens, word))).cast("double")
        found = text.found[word]
        idf = F.log(1 + (text.docs - found + 0.5) / (found + 0.5))
        parts.append(idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / text.mean_length)))
    return F.lit(float(clause.boost)) * reduce(lambda a, b: a + b, parts)
