"""Resolving document field paths against a DataFrame schema."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.functions.analysis import Analyzer, Normalizer, analyzer, normalizer

# Key of the field options inside StructField.metadata (see sources.schema).
OPTIONS = "field"


@dataclass(frozen=True)
class FieldRef:
    """A resolved field: its column, element type and text analysis."""

    path: str
    column: Column
    dtype: T.DataType
    many: bool
    analyzer: Analyzer | None = None
    search_analyzer: Analyzer | None = None
    normalizer: Normalizer | None = None
    boost: float = 1.0
    kind: str | None = None

    @property
    def is_address(self) -> bool:
        """Internet addresses kept as text, or as the bytes of ``addresses.ordered``."""
        return self.kind == "ip" and isinstance(self.dtype, (T.StringType, T.BinaryType))

    def query(self, value: Any) -> Any:
        """A searched value in the form the field stores it."""
        return self.normalizer.query(value) if self.normalizer and isinstance(value, str) else value

    def tokens(self) -> Column:
        """All tokens of the field, over every value it holds."""
        if self.many and self.analyzer.plain:
            return self.column
        if self.many:
            return F.flatten(F.transform(self.column, self.analyzer.tokens))
        return self.analyzer.tokens(self.column)

    def any_value(self, test: Callable[[Column], Column]) -> Column:
        """The test holds for the value, or for one element of an array."""
        return F.exists(self.column, test) if self.many else test(self.column)


class FieldScope:
    """Field lookup over a collection, or over one element of a nested array.

    ``text`` names the analysed fields of a frame that carries no field options:
    an iterable of paths, or a mapping from path to analyzer.
    """

    def __init__(self, source: DataFrame | T.StructType,
                 text: Iterable[str] | Mapping[str, str | Analyzer] = (), *,
                 _base: Column | None = None, _prefix: str = "") -> None:
        self.schema = source if isinstance(source, T.StructType) else source.schema
        self._text = dict(text) if isinstance(text, Mapping) else dict.fromkeys(text, "standard")
        self._base = _base
        self._prefix = _prefix

    def element(self, path: str, dtype: T.StructType, column: Column) -> FieldScope:
        return type(self)(dtype, self._text, _base=column, _prefix=path + ".")

    def field(self, path: str) -> FieldRef:
        name = path
        if self._prefix and path.startswith(self._prefix):
            name = path[len(self._prefix):]
        column, dtype, many, meta = None, self.schema, False, {}
        parts = name.split(".")
        for depth, part in enumerate(parts):
            if isinstance(dtype, T.ArrayType):
                dtype, many = dtype.elementType, True
            step = _member(dtype, part)
            if step is None:
                return self._sub_field(path, parts[depth:], column, dtype, many, meta)
            column = self._step(column, part, dtype, many)
            dtype, meta = step.dataType, step.metadata.get(OPTIONS, {})
            if isinstance(dtype, T.ArrayType) and many:
                column, dtype = F.flatten(column), dtype.elementType
        return self._ref(self._prefix + name, column, dtype, many, meta)

    def _step(self, column: Column | None, part: str, dtype: T.DataType, many: bool) -> Column:
        if column is None:
            return F.col(f"`{part}`") if self._base is None else self._base.getField(part)
        return column.getField(part)

    def _ref(self, path: str, column: Column, dtype: T.DataType, many: bool,
             meta: Mapping) -> FieldRef:
        if isinstance(dtype, T.ArrayType):
            dtype, many = dtype.elementType, True
        name = meta.get("analyzer") if meta.get("type") in ("text", "search_as_you_type") else None
        if path in self._text:
            name = self._text[path]
        elif meta.get("type") not in ("text", "search_as_you_type"):
            clean = meta.get("normalizer")
            return FieldRef(path, column, dtype, many, boost=meta.get("boost", 1.0),
                            normalizer=normalizer(clean) if clean else None, kind=meta.get("type"))
        index = analyzer(name)
        search = analyzer(meta["search_analyzer"]) if meta.get("search_analyzer") else index
        return FieldRef(path, column, dtype, many, index, search, boost=meta.get("boost", 1.0))

    def _sub_field(self, path: str, rest: list[str], column: Column | None,
                   dtype: T.DataType, many: bool, meta: Mapping) -> FieldRef:
        """``name.keyword`` and declared multi-fields read the base column."""
        declared = meta.get("fields", {})
        if column is not None and len(rest) == 1 and not isinstance(dtype, T.StructType):
            if rest[0] in declared:
                return self._ref(path, column, dtype, many, declared[rest[0]])
            if rest[0] == "keyword":
                return FieldRef(path, column, dtype, many)
        raise KeyError(f"no field {path!r}")


def _member(dtype: T.DataType, name: str) -> T.StructField | None:
    if not isinstance(dtype, T.StructType):
        return None
    return dtype[name] if name in dtype.fieldNames() else None
