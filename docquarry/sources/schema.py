"""Declared document schemas: field options, typed loading and mapping.

A schema is a dict from field name to :class:`Field`.  It yields a Spark
``StructType`` whose fields carry their options as metadata, so a loaded frame
knows which of its columns are analysed text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field as dc_field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.functions import addresses
from docquarry.functions.analysis import Normalizer, normalizer
from docquarry.functions.fields import OPTIONS

# Spark type of each scalar field type.
SCALARS: dict[str, T.DataType] = {
    "text": T.StringType(),
    "keyword": T.StringType(),
    "search_as_you_type": T.StringType(),
    "ip": T.StringType(),
    "geo_shape": T.StringType(),
    "long": T.LongType(),
    "integer": T.IntegerType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "half_float": T.FloatType(),
    "scaled_float": T.DoubleType(),
    "rank_feature": T.FloatType(),
    "date": T.TimestampType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
}

# Bound type of each range field type.
RANGES: dict[str, T.DataType] = {
    "integer_range": T.IntegerType(),
    "long_range": T.LongType(),
    "float_range": T.FloatType(),
    "double_range": T.DoubleType(),
    "ip_range": T.StringType(),
    "date_range": T.TimestampType(),
}

# Members of the remaining composite field types.
COMPOSITES: dict[str, T.StructType] = {
    "geo_point": T.StructType().add("lat", T.DoubleType()).add("lon", T.DoubleType()),
    "xy_point": T.StructType().add("x", T.DoubleType()).add("y", T.DoubleType()),
    "completion": T.StructType().add("input", T.ArrayType(T.StringType()))
                                .add("weight", T.IntegerType()),
    "join": T.StructType().add("name", T.StringType()).add("parent", T.StringType()),
}

FIELD_TYPES = {*SCALARS, *RANGES, *COMPOSITES, "object", "nested", "alias"}


@dataclass(frozen=True)
class Field:
    """Options of one field.

    ``default`` is a constant, a ``Column`` or a function returning one (for
    example ``F.uuid`` or ``F.current_timestamp``).  ``validate`` maps the field's
    column to a boolean column.  ``many`` declares a multi-valued field.
    """

    type: str = "keyword"
    required: bool = False
    default: Any = None
    validate: Callable[[Column], Column] | None = None
    properties: Mapping[str, Field] = dc_field(default_factory=dict)
    fields: Mapping[str, Field] = dc_field(default_factory=dict)
    many: bool = False
    analyzer: str | None = None
    search_analyzer: str | None = None
    normalizer: str | Normalizer | None = None
    boost: float | None = None
    null_value: Any = None
    coerce: bool = True
    ignore_malformed: bool = False
    ignore_above: int | None = None
    scaling_factor: float | None = None
    format: str | None = None
    path: str | None = None
    copy_to: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.type not in FIELD_TYPES:
            raise ValueError(f"unknown field type {self.type!r}")
        if self.type == "alias" and not self.path:
            raise ValueError("an alias needs a path")
        if self.type == "scaled_float" and not self.scaling_factor:
            raise ValueError("a scaled_float needs a scaling_factor")

    def options(self) -> dict[str, Any]:
        """The part of the options kept as column metadata."""
        out: dict[str, Any] = {"type": self.type}
        for name in ("analyzer", "search_analyzer", "boost", "scaling_factor", "path"):
            if getattr(self, name) is not None:
                out[name] = getattr(self, name)
        if self.normalizer is not None:
            out["normalizer"] = asdict(normalizer(self.normalizer))
        if self.fields:
            out["fields"] = {n: f.options() for n, f in self.fields.items()}
        return out

    @property
    def data_type(self) -> T.DataType:
        """Spark type of one value."""
        if self.type in SCALARS:
            return SCALARS[self.type]
        if self.type in RANGES:
            bound = RANGES[self.type]
            return T.StructType().add("gte", bound).add("lte", bound)
        if self.type in COMPOSITES:
            return COMPOSITES[self.type]
        inner = struct_type(self.properties)
        return T.ArrayType(inner) if self.type == "nested" else inner


Schema = Mapping[str, Field]


def struct_type(schema: Schema) -> T.StructType:
    """The Spark schema a declared schema loads into."""
    out = T.StructType()
    for name, f in schema.items():
        if f.type == "alias":
            target = _at_path(schema, f.path)
            dtype, options = target.data_type, {**target.options(), "path": f.path}
        else:
            dtype, options = f.data_type, f.options()
        if f.many and not isinstance(dtype, T.ArrayType):
            dtype = T.ArrayType(dtype)
        out.add(T.StructField(name, dtype, True, {OPTIONS: options}))
    return out


def _at_path(schema: Schema, path: str) -> Field:
    head, _, rest = path.partition(".")
    f = schema[head]
    return _at_path(f.properties, rest) if rest else f


# -- loading ------------------------------------------------------------------
def typed_load(df: DataFrame, schema: Schema, key: str | None = "_id") -> DataFrame:
    """Apply a declared schema to raw rows.

    Undeclared columns are dropped (``key`` stays), values are converted to their
    declared type, and ``null_value`` and ``default`` fill what is missing.  It is
    one projection: nothing moves between executors.
    """
    return _loaded(df, schema, key, convert)


def _loaded(df: DataFrame, schema: Schema, key: str | None, load: Any) -> DataFrame:
    values = {n: load(_raw(df, n), f, _raw_type(df, n)) for n, f in schema.items()
              if f.type != "alias"}
    for name, f in schema.items():
        for target in f.copy_to:
            if target not in values:
                raise ValueError(f"copy_to names an undeclared field {target!r}")
            values[target] = _append(values[target], values[name], schema[target])
    types = struct_type(schema)
    kept = [F.col(key)] if key and key in df.columns and key not in schema else []
    loaded = df.select(*kept, *[v.cast(types[n].dataType).alias(n, metadata=types[n].metadata)
                                for n, v in values.items()])
    aliases = {n: F.col(f.path) for n, f in schema.items() if f.type == "alias"}
    if not aliases:
        return loaded
    loaded = loaded.withColumns(aliases)
    for name in aliases:
        loaded = loaded.withMetadata(name, types[name].metadata)
    return loaded.select(*[k for k in [key] if kept], *schema)


def load_json(df: DataFrame, column: str, schema: Schema, key: str | None = "_id") -> DataFrame:
    """Parse a column of JSON documents and apply the schema.

    Every form a field accepts is read: one value or a list for a multi-valued field, one
    object or a list for a nested one, text, list or object for points, and text or
    object for completions and joins.  Documents that are no JSON objects load as rows
    without values; :func:`rejected_json` lists them.
    """
    raw = T.StructType()
    for name, f in schema.items():
        if f.type != "alias":
            raw.add(name, _json_type(f))
    parsed = df.withColumn("__doc", F.from_json(column, raw))
    kept = [key] if key and key in df.columns else []
    return _loaded(parsed.select(*kept, "__doc.*"), schema, key, _from_json)


def rejected_json(df: DataFrame, column: str) -> DataFrame:
    """Rows whose document is not a JSON object."""
    text = F.col(column)
    kind = F.schema_of_variant(F.try_parse_json(text))
    return df.where(text.isNotNull() & ~F.coalesce(kind.startswith("OBJECT"), F.lit(False)))


def _json_type(f: Field) -> T.DataType:
    """What may have several forms is read as text, and so are scalars, so that malformed
    values reach the conversion."""
    if f.type == "object" and not f.many:
        inner = T.StructType()
        for n, p in f.properties.items():
            inner.add(n, _json_type(p))
        return inner
    return T.StringType()


def _from_json(col: Column, f: Field, raw: T.DataType) -> Column:
    """A field of a document read by its :func:`_json_type`, as declared."""
    if f.type == "object" and not f.many:
        members = [_from_json(col.getField(n), p, raw[n].dataType).cast(
            struct_type({n: p})[n].dataType).alias(n) for n, p in f.properties.items() if p.type != "alias"]
        return F.when(col.isNotNull(), F.struct(*members))
    one = replace(f, many=False, null_value=None, default=None)
    if f.type in ("object", "nested"):
        inner = _json_type(replace(one, type="object"))
        load = lambda e: _from_json(e, replace(one, type="object"), inner)
        listed = F.from_json(col, T.ArrayType(inner))
        out = F.transform(F.when(col.startswith("["), listed).when(
            col.startswith("{"), F.array(F.from_json(col, inner))), load)
    elif f.many:
        texts = F.when(col.startswith("["), F.from_json(col, T.ArrayType(T.StringType()))).when(
            col.isNotNull(), F.array(col))
        out = F.transform(texts, lambda e: _from_json(e, one, T.StringType()))
    elif f.type in COMPOSITES or f.type in RANGES:
        kind = COMPOSITES.get(f.type) or T.StructType().add("gte", T.StringType()).add("lte", T.StringType())
        forms = [("{", kind)] + [("[", T.ArrayType(T.StringType()))] * (f.type in COMPOSITES and f.type != "join")
        out = F.lit(None).cast(f.data_type) if f.type in RANGES and f.type != "ip_range" else convert(
            F.when(~col.startswith("["), col), one, T.StringType()).cast(f.data_type)
        for sign, form in forms:
            out = F.when(col.startswith(sign), convert(F.from_json(col, form), one, form).cast(f.data_type)).otherwise(out)
    else:
        return convert(col, f, raw)
    if f.null_value is not None:
        out = F.coalesce(out, _constant(f.null_value, f))
    if f.default is not None:
        out = F.coalesce(out, _constant(f.default, f))
    return out


def _raw(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None)


def _raw_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType if name in df.columns else T.NullType()


def convert(col: Column, f: Field, raw: T.DataType) -> Column:
    """A raw column as the declared field, missing values filled."""
    if f.type == "nested":
        out = _load_nested(col, f, raw)
    elif f.many:
        many = raw if isinstance(raw, T.ArrayType) else T.ArrayType(raw)
        values = col if isinstance(raw, T.ArrayType) else F.when(col.isNotNull(), F.array(col))
        out = F.transform(values, lambda e: _convert(e, f, many.elementType))
    else:
        out = _convert(col, f, raw)
    if f.null_value is not None:
        out = F.coalesce(out, _constant(f.null_value, f))
    if f.default is not None:
        out = F.coalesce(out, _constant(f.default, f))
    return out


def _constant(value: Any, f: Field) -> Column:
    if callable(value) and not isinstance(value, Column):
        value = value()
    if isinstance(value, Mapping):
        value = F.struct(*[F.lit(v).alias(n) for n, v in value.items()])
    elif f.type in ("geo_point", "xy_point") and isinstance(value, str):
        value = _point(F.lit(value), f, T.StringType())
    col = value if isinstance(value, Column) else F.lit(value)
    return col if isinstance(f.data_type, T.ArrayType) else col.cast(
        T.ArrayType(f.data_type) if f.many else f.data_type)


def _load_nested(col: Column, f: Field, raw: T.DataType) -> Column:
    if isinstance(raw, T.StructType):
        # A single object stands for a one-element array.
        col, raw = F.when(col.isNotNull(), F.array(col)), T.ArrayType(raw)
    if not isinstance(raw, T.ArrayType):
        return F.lit(None).cast(f.data_type)
    return F.transform(col, lambda e: _object(e, f, raw.elementType))


def _object(col: Column, f: Field, raw: T.DataType) -> Column:
    if not isinstance(raw, T.StructType):
        return F.lit(None).cast(struct_type(f.properties))
    members = []
    for name, p in f.properties.items():
        present = name in raw.fieldNames()
        value = col.getField(name) if present else F.lit(None)
        dtype = raw[name].dataType if present else T.NullType()
        members.append(convert(value, p, dtype).cast(
            struct_type({name: p})[name].dataType).alias(name))
    return F.when(col.isNotNull(), F.struct(*members))


def _convert(col: Column, f: Field, raw: T.DataType) -> Column:
    if isinstance(raw, T.NullType):
        return F.lit(None).cast(f.data_type)
    if f.type == "object":
        return _object(col, f, raw)
    if f.type in RANGES and isinstance(raw, T.StructType):
        inner = Field({"integer_range": "integer", "long_range": "long", "float_range": "float",
                       "double_range": "double", "ip_range": "ip",
                       "date_range": "date"}[f.type], format=f.format,
                      coerce=f.coerce, ignore_malformed=f.ignore_malformed)
        return F.when(col.isNotNull(), F.struct(*[
            _convert(col.getField(s), inner, raw[s].dataType).alias(s) for s in ("gte", "lte")]))
    if f.type == "ip_range" and isinstance(raw, T.StringType):
        return _checked(col, addresses.bounds(col), f, "block of addresses")
    if f.type == "ip" and isinstance(raw, T.StringType):
        return _checked(col, addresses.checked(col), f, "address")
    if f.type in ("geo_point", "xy_point"):
        return _point(col, f, raw)
    if f.type == "completion" and not isinstance(raw, T.StructType):
        inputs = col if isinstance(raw, T.ArrayType) else F.array(col.cast("string"))
        return F.when(col.isNotNull(), F.struct(
            inputs.alias("input"), F.lit(None).cast("int").alias("weight")))
    if f.type == "join" and isinstance(raw, T.StringType):
        return F.when(col.isNotNull(), F.struct(
            col.alias("name"), F.lit(None).cast("string").alias("parent")))
    if f.type in ("text", "keyword", "search_as_you_type"):
        return _string(col.cast("string"), f)
    if f.type == "binary":
        if not isinstance(raw, T.StringType):
            return col
        return F.try_to_binary(col, F.lit("base64")) if f.ignore_malformed else F.unbase64(col)
    if f.type == "date" and f.format and isinstance(raw, T.StringType):
        if f.ignore_malformed:
            return F.try_to_timestamp(col, F.lit(f.format))
        return F.to_timestamp(col, f.format)
    return _scalar(col, f, raw)


def _string(col: Column, f: Field) -> Column:
    if f.normalizer is not None:
        col = normalizer(f.normalizer).apply(col)
    if f.ignore_above is not None:
        col = F.when(F.char_length(col) <= f.ignore_above, col)
    return col


def _checked(raw: Column, value: Column, f: Field, what: str) -> Column:
    """A value read from text, or an error if the text can't be read."""
    if f.ignore_malformed:
        return value
    return F.coalesce(value, F.when(raw.isNotNull(), F.raise_error(F.concat(F.lit(f"malformed {what}: "), raw))))


def _scalar(col: Column, f: Field, raw: T.DataType) -> Column:
    target = f.data_type
    number = isinstance(target, T.NumericType)
    if number and not f.coerce and isinstance(raw, T.StringType):
        if f.ignore_malformed:
            return F.lit(None).cast(target)
        raise TypeError("the field does not coerce strings to numbers")
    whole = isinstance(target, T.IntegralType)
    if whole and isinstance(raw, (T.StringType, T.FractionalType)):
        # "10.7" is cut to 10; exact text is read directly so that long values stay exact.
        out = col.try_cast("double").try_cast(target)
        if isinstance(raw, T.StringType):
            out = F.coalesce(col.try_cast(target), out)
        if f.ignore_malformed:
            return out
        return F.when(col.isNull() | out.isNotNull(), out).otherwise(
            F.raise_error(F.concat(F.lit("malformed number: "), col.cast("string"))))
    out = col.try_cast(target) if f.ignore_malformed else col.cast(target)
    if f.scaling_factor:
        out = F.round(out * F.lit(float(f.scaling_factor))) / F.lit(float(f.scaling_factor))
    return out


def _point(col: Column, f: Field, raw: T.DataType) -> Column:
    first, second = COMPOSITES[f.type].fieldNames()
    if isinstance(raw, T.StructType):
        parts = [col.getField(first), col.getField(second)]
    elif isinstance(raw, T.ArrayType):
        # Arrays hold the horizontal coordinate first.
        order = (1, 0) if f.type == "geo_point" else (0, 1)
        parts = [F.get(col, order[0]), F.get(col, order[1])]
    else:
        bits = F.split(col, r"\s*,\s*")
        parts = [F.get(bits, 0), F.get(bits, 1)]
    parts = [p.try_cast("double") if f.ignore_malformed else p.cast("double") for p in parts]
    whole = col.isNotNull() & parts[0].isNotNull() & parts[1].isNotNull()
    return F.when(whole, F.struct(parts[0].alias(first), parts[1].alias(second)))


def _append(target: Column, extra: Column, f: Field) -> Column:
    if f.many:
        return F.array_compact(F.concat(F.coalesce(target, F.array()), F.array(extra)))
    joined = F.concat_ws(" ", target, extra.cast("string"))
    return F.when(target.isNotNull() | extra.isNotNull(), joined)


# -- mapping ------------------------------------------------------------------
def type_name(f: T.StructField) -> str:
    """Declared field type, or the one a plain Spark type stands for."""
    declared = f.metadata.get(OPTIONS, {}).get("type")
    if declared:
        return declared
    dtype = f.dataType
    if isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
        if isinstance(dtype, T.StructType):
            return "nested"
    if isinstance(dtype, T.StructType):
        return "object"
    return {"string": "keyword", "bigint": "long", "int": "integer", "smallint": "short",
            "tinyint": "byte", "timestamp": "date", "timestamp_ntz": "date",
            "decimal": "scaled_float"}.get(dtype.simpleString().split("(")[0],
                                           dtype.simpleString())


def mapping_rows(schema: T.StructType, prefix: str = "") -> list[tuple[str, str, str]]:
    """``(path, field type, Spark type)`` of every field, sub-fields included."""
    out = []
    for f in schema.fields:
        path = prefix + f.name
        out.append((path, type_name(f), f.dataType.simpleString()))
        inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if isinstance(inner, T.StructType):
            out += mapping_rows(inner, path + ".")
    return out


def mapping(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """The mapping of a collection as a frame."""
    return spark.createDataFrame(mapping_rows(schema),
                                 "path string, type string, spark_type string")
