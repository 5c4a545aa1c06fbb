"""Document constraints as one narrow pass over the rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.functions.predicates import holds
from docquarry.operators.search import ID
from docquarry.sources.schema import Field, Schema


def violations(df: DataFrame, schema: Schema, key: str = ID) -> DataFrame:
    """One row ``(key, field, rule)`` per broken rule; rules are required and validate."""
    broken = F.explode(_broken(df, schema)).alias("v")
    return df.select(key, broken).select(key, "v.field", "v.rule")


def valid(df: DataFrame, schema: Schema) -> DataFrame:
    """Rows that break no rule."""
    return df.where(F.size(_broken(df, schema)) == 0)


def rejected(df: DataFrame, schema: Schema) -> DataFrame:
    """Rows that break a rule, with the broken rules in ``violations``."""
    return df.withColumn("violations", _broken(df, schema)).where(F.size("violations") > 0)


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill missing values: a constant, a Column, or a function returning one."""
    def filled(name: str, value: object) -> Column:
        if callable(value) and not isinstance(value, Column):
            value = value()
        value = value if isinstance(value, Column) else F.lit(value)
        if name not in df.columns:
            return value
        return F.coalesce(F.col(name), value.cast(df.schema[name].dataType))
    return df.withColumns({n: filled(n, v) for n, v in defaults.items()})


def _broken(df: DataFrame, schema: Schema) -> Column:
    marks: list[Column] = []
    for name, f in schema.items():
        col = F.col(f"`{name}`") if name in df.columns else F.lit(None)
        marks += [_mark(fails, name, rule) for rule, fails in _rules(col, f)]
        if f.type in ("object", "nested"):
            marks += _member_marks(col, name, f)
    if not marks:
        return F.array().cast("array<struct<field:string,rule:string>>")
    return F.array_compact(F.array(*marks))


def _rules(col: Column, f: Field) -> list[tuple[str, Column]]:
    out = []
    if f.required:
        out.append(("required", col.isNull()))
    if f.validate is not None:
        # A missing value is the business of `required`; an undecided test fails.
        out.append(("validate", col.isNotNull() & ~holds(f.validate(col))))
    return out


def _member_marks(col: Column, name: str, f: Field) -> list[Column]:
    out = []
    for sub, p in f.properties.items():
        for rule in [r for r, _ in _rules(F.lit(None), p)]:
            def fails(e: Column, rule: str = rule, sub: str = sub, p: Field = p) -> Column:
                return dict(_rules(e.getField(sub), p))[rule]
            out.append(_mark(_any_element(col, f, fails), f"{name}.{sub}", rule))
    return out


def _any_element(col: Column, f: Field, fails) -> Column:
    if f.type == "nested" or f.many:
        return F.exists(col, lambda e: e.isNotNull() & fails(e))
    return col.isNotNull() & fails(col)


def _mark(fails: Column, field: str, rule: str) -> Column:
    return F.when(fails, F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule")))
