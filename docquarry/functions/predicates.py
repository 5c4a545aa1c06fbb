"""Query predicates: every function returns a boolean ``Column``.

A predicate follows SQL null logic, which keeps it pushable to the Parquet
reader; :func:`bool_` makes it two-valued where that matters, under negation and
when clauses are counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.functions import addresses, geo
from docquarry.functions.analysis import Analyzer, analyzer as find_analyzer, quote
from docquarry.functions.fields import FieldRef, FieldScope
from docquarry.functions.fuzzy import lengths, max_edits, within
from docquarry.functions.values import Unparsable, literal

_RANGE_KEYS = {"gt", "gte", "lt", "lte"}
_NOTHING, _EVERYTHING = False, True


def holds(predicate: Column) -> Column:
    """Two-valued form of a predicate: null counts as false."""
    return F.coalesce(predicate, F.lit(False))


def all_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def any_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates)


def required_matches(spec: int | str, clauses: int) -> int:
    """Read ``minimum_should_match``: ``2``, ``-1``, ``75%``, ``-25%`` or ``3<90%``."""
    text = str(spec).strip()
    if "<" in text:
        need = clauses
        for rule in text.split():
            bound, _, inner = rule.partition("<")
            if clauses > int(bound):
                need = required_matches(inner, clauses)
        return need
    if text.endswith("%"):
        percent = int(text[:-1])
        part = clauses * abs(percent) // 100
        need = clauses - part if percent < 0 else part
    else:
        need = int(text)
        if need < 0:
            need += clauses
    return max(need, 0)


def at_least(predicates: list[Column], need: int) -> Column:
    """At least ``need`` of the predicates hold."""
    if need <= 0:
        return F.lit(_EVERYTHING)
    if need > len(predicates):
        return F.lit(_NOTHING)
    if need == 1:
        return any_of(predicates)
    if need == len(predicates):
        return all_of(predicates)
    return reduce(lambda a, b: a + b, [holds(p).cast("int") for p in predicates]) >= need


def bool_(must: Iterable[Column] = (), filter: Iterable[Column] = (),
          should: Iterable[Column] = (), must_not: Iterable[Column] = (),
          minimum_should_match: int | str | None = None) -> Column:
    """Combine clauses; an empty combination matches every row.

    With no ``must`` and no ``filter`` at least one ``should`` has to hold;
    otherwise ``should`` is optional unless ``minimum_should_match`` says so.
    """
    needed, optional, never = [*must, *filter], [*should], [*must_not]
    parts = list(needed)
    if optional:
        if minimum_should_match is not None:
            need = required_matches(minimum_should_match, len(optional))
        else:
            need = 0 if needed else 1
        if need:
            parts.append(at_least(optional, need))
    parts += [~holds(p) for p in never]
    return all_of(parts) if parts else F.lit(_EVERYTHING)


class Fields(FieldScope):
    """Predicate factory for one collection.

    ``Fields(df)`` reads field types and options from the schema, so the same
    call works on scalars, arrays, objects and analysed text.
    """

    # -- full text -------------------------------------------------------
    def match(self, field: str, value: Any, *, operator: str = "OR",
              minimum_should_match: int | str | None = None,
              fuzziness: int | str | None = None, prefix_length: int = 0,
              max_expansions: int | None = None, fuzzy_transpositions: bool = True,
              lenient: bool = False, zero_terms_query: str = "none",
              analyzer: str | Analyzer | None = None) -> Column:
        """Full-text match; on a field that is not text, equality.

        ``max_expansions`` is accepted and not needed: every spelling within the
        edit bound is matched.
        """
        ref = self.field(field)
        if ref.analyzer is None:
            return self._match_value(ref, value, fuzziness, prefix_length,
                                     fuzzy_transpositions, lenient)
        searcher = find_analyzer(analyzer) if analyzer else ref.search_analyzer
        words = list(dict.fromkeys(searcher.split(str(value))))
        if not words:
            return F.lit(zero_terms_query == "all")
        if operator.upper() == "AND":
            need = len(words)
        elif minimum_should_match is None:
            need = 1
        else:
            need = max(required_matches(minimum_should_match, len(words)), 1)

        def test(group: list[str]) -> Column:
            if fuzziness is None:
                return _any_word(ref, group)
            return self._fuzzy_words(ref, group, fuzziness, prefix_length, fuzzy_transpositions)

        if need == 1:
            return test(words)
        return at_least([test([w]) for w in words], need)

    def _match_value(self, ref: FieldRef, value: Any, fuzziness: int | str | None,
                     prefix_length: int, transpositions: bool, lenient: bool) -> Column:
        if fuzziness is not None and isinstance(ref.dtype, T.StringType):
            return self._fuzzy_value(ref, str(value), fuzziness, prefix_length, transpositions)
        try:
            if ref.is_address:
                return ref.any_value(lambda c: _in_block(c, ref, value))
            wanted = literal(ref.query(value), ref.dtype)
        except Unparsable:
            if lenient:
                return F.lit(_NOTHING)
            raise
        return ref.any_value(lambda c: c == wanted)

    def fuzzy(self, field: str, value: str, *, fuzziness: int | str = "AUTO",
              prefix_length: int = 0, max_expansions: int | None = None,
              transpositions: bool = True, rewrite: str | None = None) -> Column:
        """Whole value, or one token of a text field, within the edit distance."""
        ref = self.field(field)
        if ref.analyzer is None:
            return self._fuzzy_value(ref, value, fuzziness, prefix_length, transpositions)
        return self._fuzzy_words(ref, [value], fuzziness, prefix_length, transpositions)

    def _fuzzy_value(self, ref: FieldRef, value: str, fuzziness: int | str,
                     prefix_length: int, transpositions: bool) -> Column:
        value = ref.query(value)
        edits = max_edits(fuzziness, value)
        if edits == 0:
            return ref.any_value(lambda c: c == F.lit(value))
        return ref.any_value(lambda c: within(c, value, edits, prefix_length, transpositions))

    def _fuzzy_words(self, ref: FieldRef, words: list[str], fuzziness: int | str,
                     prefix_length: int, transpositions: bool) -> Column:
        rule = ref.analyzer
        exact, near = [], []
        for word in words:
            edits = max_edits(fuzziness, word)
            if edits == 0:
                exact.append(word)
            else:
                near.append((word, edits))
        tests = []
        if exact:
            tests.append(ref.any_value(lambda c: rule.has_any(c, exact)))
        if near:
            bounds = [lengths(word, edits) for word, edits in near]
            shortest, longest = min(b[0] for b in bounds), max(b[1] for b in bounds)

            def close(token: Column) -> Column:
                return any_of([within(token, word, edits, prefix_length, transpositions)
                               for word, edits in near])

            tests.append(ref.any_value(
                lambda c: F.exists(rule.tokens(c, shortest, longest), close)))
        return any_of(tests)

    # -- exact values ----------------------------------------------------
    def term(self, field: str, value: Any, *, case_insensitive: bool = False) -> Column:
        ref = self.field(field)
        if ref.is_address:
            return ref.any_value(lambda c: _in_block(c, ref, value))
        if ref.analyzer is not None:
            if case_insensitive:
                return ref.any_value(lambda c: ref.analyzer.lowered().has_any(c, [str(value).lower()]))
            return _any_word(ref, [str(value)])
        if case_insensitive:
            if not isinstance(ref.dtype, T.StringType):
                raise TypeError(f"{field!r} is not a string field")
            return ref.any_value(lambda c: F.lower(c) == F.lit(str(value).lower()))
        wanted = literal(ref.query(value), ref.dtype)
        if ref.many:
            return F.array_contains(ref.column, wanted)
        return ref.column == wanted

    def terms(self, field: str, values: Iterable[Any]) -> Column:
        """Any of the values; see ``relations.terms_lookup`` for a list held in a table."""
        ref, values = self.field(field), list(values)
        if not values:
            return F.lit(_NOTHING)
        if ref.is_address:
            return ref.any_value(lambda c: any_of([_in_block(c, ref, v) for v in values]))
        if ref.analyzer is not None:
            return _any_word(ref, [str(v) for v in values])
        wanted = [literal(ref.query(v), ref.dtype) for v in values]
        if ref.many:
            return F.arrays_overlap(ref.column, F.array(*wanted).cast(T.ArrayType(ref.dtype)))
        return ref.column.isin(wanted)

    def range(self, field: str, *, gt: Any = None, gte: Any = None, lt: Any = None,
              lte: Any = None, format: str | None = None, time_zone: str | None = None,
              relation: str = "INTERSECTS") -> Column:
        """Bounds on a value, or on a range-typed field by ``relation``.

        Addresses are compared as addresses; a field of their bytes (``addresses.ordered``)
        lets the reader skip row groups.
        """
        ref = self.field(field)
        if _is_range(ref.dtype):
            return self._range_relation(ref, gt, gte, lt, lte, format, time_zone, relation)

        def bound(value: Any) -> Column:
            return addresses.literal(value) if ref.is_address else literal(value, ref.dtype, format, time_zone)

        bounds: list[Callable[[Column], Column]] = []
        if gt is not None:
            bounds.append(lambda c: c > bound(gt))
        if gte is not None:
            bounds.append(lambda c: c >= bound(gte))
        if lt is not None:
            bounds.append(lambda c: c < bound(lt))
        if lte is not None:
            bounds.append(lambda c: c <= bound(lte))
        if not bounds:
            return self.exists(field)
        return ref.any_value(lambda c: all_of([b(_place(c, ref)) for b in bounds]))

    def _range_relation(self, ref: FieldRef, gt: Any, gte: Any, lt: Any, lte: Any,
                        fmt: str | None, zone: str | None, relation: str) -> Column:
        inner = ref.dtype["gte"].dataType
        of_addresses = ref.kind == "ip_range"

        def bound(value: Any) -> Column | None:
            if value is None:
                return None
            return addresses.literal(value) if of_addresses else literal(value, inner, fmt, zone)

        low, high = bound(gte if gt is None else gt), bound(lte if lt is None else lt)
        kind = relation.upper()

        def test(col: Column) -> Column:
            first, last = col.getField("gte"), col.getField("lte")
            start, end = ((addresses.ordered(first), addresses.ordered(last)) if of_addresses
                          else (first, last))
            # A missing end of the stored range is open.
            def start_ok(p: Column) -> Column:
                return first.isNull() | p
            def end_ok(p: Column) -> Column:
                return last.isNull() | p
            parts = [col.isNotNull()]
            if kind == "INTERSECTS":
                if low is not None:
                    parts.append(end_ok(end > low if gt is not None else end >= low))
                if high is not None:
                    parts.append(start_ok(start < high if lt is not None else start <= high))
            elif kind == "WITHIN":
                if low is not None:
                    parts.append(start > low if gt is not None else start >= low)
                if high is not None:
                    parts.append(end < high if lt is not None else end <= high)
            elif kind == "CONTAINS":
                parts.append(first.isNull() if low is None else start_ok(start <= low))
                parts.append(last.isNull() if high is None else end_ok(end >= high))
            else:
                raise ValueError(f"unknown relation {relation!r}")
            return all_of(parts)

        return ref.any_value(test)

    def exists(self, field: str) -> Column:
        ref = self.field(field)
        if ref.many:
            return F.exists(ref.column, lambda e: e.isNotNull())
        return ref.column.isNotNull()

    # -- patterns --------------------------------------------------------
    def prefix(self, field: str, value: str, *, case_insensitive: bool = False,
               rewrite: str | None = None) -> Column:
        ref = self.field(field)
        if ref.analyzer is not None:
            value = value.lower() if case_insensitive else value
            if not ref.analyzer.whole and not all(map(ref.analyzer.is_inside, value)):
                return F.lit(_NOTHING)
            body = f"{quote(value)}{ref.analyzer.any_char()}*"
            return self._token_pattern(ref, body, value, case_insensitive)
        value = ref.query(value)
        if case_insensitive:
            return ref.any_value(lambda c: F.lower(c).startswith(value.lower()))
        return ref.any_value(lambda c: c.startswith(value))

    def wildcard(self, field: str, pattern: str, *, case_insensitive: bool = False) -> Column:
        """``*`` for any run and ``?`` for one character, over the whole value."""
        ref = self.field(field)
        parts = _wildcard_parts(pattern)
        if ref.analyzer is not None:
            rule, any_char = ref.analyzer, ref.analyzer.any_char()
            body = ""
            for kind, text in parts:
                if kind == "text":
                    text = text.lower() if case_insensitive else text
                    if not rule.whole and not all(map(rule.is_inside, text)):
                        return F.lit(_NOTHING)
                    body += quote(text)
                else:
                    body += any_char + ("*" if kind == "run" else "")
            return self._token_pattern(ref, body, "", case_insensitive)
        like = "".join({"run": "%", "one": "_"}.get(kind) or _like_escape(ref.query(text))
                       for kind, text in parts)
        if case_insensitive:
            return ref.any_value(lambda c: c.ilike(like))
        return ref.any_value(lambda c: c.like(like))

    def regexp(self, field: str, pattern: str, *, case_insensitive: bool = False) -> Column:
        """Java regular expression over the whole value, or over one token."""
        ref = self.field(field)
        flags = "(?siu)" if case_insensitive else "(?s)"
        whole = rf"{flags}\A(?:{pattern})\z"
        if ref.analyzer is not None:
            return ref.any_value(
                lambda c: F.exists(ref.analyzer.tokens(c), lambda t: t.rlike(whole)))
        return ref.any_value(lambda c: c.rlike(whole))

    def _token_pattern(self, ref: FieldRef, body: str, hint: str = "",
                       lowered: bool = False) -> Column:
        rule = ref.analyzer.lowered() if lowered else ref.analyzer
        if rule.stop_words:
            whole = rf"(?s)\A(?:{body})\z"
            return ref.any_value(lambda c: F.exists(rule.tokens(c), lambda t: t.rlike(whole)))
        pattern = rule.token_regex(body)

        def test(col: Column) -> Column:
            found = rule.text(col).rlike(pattern)
            return rule.text(col).contains(hint) & found if hint else found

        return ref.any_value(test)

    # -- geo -------------------------------------------------------------
    def geo_distance(self, field: str, *, distance: str | float, lat: float | None = None,
                     lon: float | None = None, point: Mapping | None = None) -> Column:
        if point is not None:
            lat, lon = point["lat"], point["lon"]
        ref = self.field(field)
        return ref.any_value(lambda c: geo.within_distance(
            c.getField("lat"), c.getField("lon"), distance, lat, lon))

    def geo_bounding_box(self, field: str, *, top_left: Mapping,
                         bottom_right: Mapping) -> Column:
        ref = self.field(field)
        return ref.any_value(lambda c: geo.within_box(
            c.getField("lat"), c.getField("lon"), top_left["lat"], top_left["lon"],
            bottom_right["lat"], bottom_right["lon"]))

    # -- compound --------------------------------------------------------
    def clause(self, field: str, value: Any, **options: Any) -> Column:
        """One field/value clause: bounds make a range, a list any-of, else a term."""
        if isinstance(value, Mapping):
            if not _RANGE_KEYS & value.keys():
                raise ValueError("an object value needs one of gt, gte, lt, lte")
            return self.range(field, **value)
        if isinstance(value, (list, tuple, set, frozenset)):
            return self.terms(field, value)
        return self.term(field, value, **options)

    def bool(self, must: Iterable = (), filter: Iterable = (), should: Iterable = (),
             must_not: Iterable = (), minimum_should_match: int | str | None = None) -> Column:
        """:func:`bool_` whose clauses may also be ``(field, value)`` pairs."""
        def read(clauses: Iterable) -> list[Column]:
            return [self.clause(c[0], c[1]) if isinstance(c, tuple) else c for c in clauses]
        return bool_(read(must), read(filter), read(should), read(must_not),
                     minimum_should_match)

    def match_each(self, query: Mapping[str, Any]) -> Column:
        """All fields match; the condition form of update and delete by query."""
        return all_of([self.match(f, v) for f, v in query.items()])

    def nested(self, path: str, inner: Callable[[Fields], Column]) -> Column:
        """One element of ``path`` satisfies the whole inner predicate."""
        ref = self.field(path)
        if not isinstance(ref.dtype, T.StructType):
            raise TypeError(f"{path!r} holds no sub-documents")
        return ref.any_value(lambda e: inner(self.element(ref.path, ref.dtype, e)))


def _any_word(ref: FieldRef, words: list[str]) -> Column:
    if ref.many and ref.analyzer.plain:
        return F.arrays_overlap(ref.column, F.array(*map(F.lit, words)))
    return ref.any_value(lambda c: ref.analyzer.has_any(c, words))


def _place(col: Column, ref: FieldRef) -> Column:
    """A value in the form that compares."""
    return addresses.ordered(col) if ref.is_address and isinstance(ref.dtype, T.StringType) else col


def _in_block(col: Column, ref: FieldRef, value: Any) -> Column:
    """An address is the one given, however spelled, or lies in the block given."""
    low, high = addresses.block(value)
    place = _place(col, ref)
    return place == F.lit(low) if low == high else place.between(F.lit(low), F.lit(high))


def _is_range(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StructType) and {"gte", "lte"} <= set(dtype.fieldNames())


def _wildcard_parts(pattern: str) -> list[tuple[str, str]]:
    parts, escaped = [], False
    for ch in pattern:
        if escaped or ch not in "*?\\":
            parts.append(("text", ch))
            escaped = False
        elif ch == "\\":
            escaped = True
        else:
            parts.append(("run" if ch == "*" else "one", ch))
    return parts


def _like_escape(text: str) -> str:
    return "\\" + text if text in "%_\\" else text
