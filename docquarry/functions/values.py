"""Turning Python values into Spark literals of a column's own type.

A literal of the exact column type keeps the comparison free of casts on the
column, so the filter still reaches the Parquet reader.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


class Unparsable(ValueError):
    """A query value that cannot be read as the field's type."""


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), use), 0)


def is_time(dtype: T.DataType) -> bool:
    return isinstance(dtype, _TIMES)


def literal(value: Any, dtype: T.DataType, fmt: str | None = None,
            time_zone: str | None = None) -> Column:
    """``value`` as a literal comparable with a column of ``dtype``."""
    if isinstance(value, Column):
        return value
    if value is None:
        raise ValueError("null never matches a value; negate exists() instead")
    if is_time(dtype):
        return _time(value, dtype, fmt, time_zone)
    if isinstance(dtype, T.StringType):
        if isinstance(value, bool):
            value = str(value).lower()
        return F.lit(str(value))
    if isinstance(dtype, T.BooleanType):
        return F.lit(_boolean(value))
    if isinstance(dtype, T.NumericType):
        return F.lit(_number(value))
    return F.lit(value)


def _boolean(value: Any) -> bool:
    if isinstance(value, bool):
        return value
    if value in ("true", "false"):
        return value == "true"
    raise Unparsable(f"{value!r} is not a boolean")


def _number(value: Any) -> Any:
    if not isinstance(value, str):
        return value
    for parse in (int, float):
        try:
            return parse(value)
        except ValueError:
            pass
    raise Unparsable(f"{value!r} is not a number")


def _time(value: Any, dtype: T.DataType, fmt: str | None, zone: str | None) -> Column:
    if isinstance(value, str) and fmt:
        wall = F.coalesce(*[_formatted(value, f) for f in fmt.split("||")])
    else:
        wall = F.lit(_parse_time(value).isoformat(sep=" ")).cast("timestamp_ntz")
    if zone and not (isinstance(value, datetime) and value.tzinfo):
        wall = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    if isinstance(dtype, T.TimestampNTZType):
        return wall
    if isinstance(dtype, T.DateType):
        return wall.cast("date")
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), wall).cast("timestamp")


def _formatted(value: str, fmt: str) -> Column:
    if fmt in ("epoch_millis", "epoch_second"):
        try:
            number = int(value)
        except ValueError:
            return F.lit(None).cast("timestamp_ntz")
        at = _from_epoch(number if fmt == "epoch_millis" else number * 1000)
        return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.try_to_timestamp(F.lit(value), F.lit(fmt)).cast("timestamp_ntz")


def _from_epoch(millis: int | float) -> datetime:
    return datetime.fromtimestamp(millis / 1000, timezone.utc).replace(tzinfo=None)


def _parse_time(value: Any) -> datetime:
    if isinstance(value, bool):
        raise Unparsable(f"{value!r} is not a date")
    if isinstance(value, (int, float)):
        return _from_epoch(value)
    if isinstance(value, str):
        text = value.strip()
        if len(text) == 4:
            text += "-01-01"
        elif len(text) == 7:
            text += "-01"
        try:
            value = datetime.fromisoformat(text)
        except ValueError:
            raise Unparsable(f"{value!r} is not a date") from None
    elif isinstance(value, date) and not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value
