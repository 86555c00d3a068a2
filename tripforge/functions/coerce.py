"""Type coercion expressions.

Casts are ``try_cast`` so bad input becomes NULL instead of failing the task
under ANSI mode; numeric ids are rounded half-to-even (``bround``) first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATETIME_COLS = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
INT8_COLS = ("VendorID", "payment_type")
INT16_COLS = ("PULocationID", "DOLocationID", "RatecodeID")
ROUNDED_INT8_COLS = ("passenger_count",)


def parse_datetime(c: Column, dtype: T.DataType) -> Column:
    """Text or zoned timestamps -> TimestampNTZ; unparseable -> NULL."""
    if isinstance(dtype, T.TimestampNTZType):
        return c
    return c.try_cast(T.TimestampNTZType())


def coerce_exprs(schema: T.StructType) -> dict[str, str]:
    """Each column's coerced expression; columns that stay as they are give themselves."""
    out = {}
    for f in schema.fields:
        c = "`" + f.name.replace("`", "``") + "`"
        if f.name in DATETIME_COLS and not isinstance(f.dataType, T.TimestampNTZType):
            e = f"try_cast({c} AS TIMESTAMP_NTZ)"
        elif f.name in INT8_COLS:
            e = f"try_cast({c} AS TINYINT)"
        elif f.name in INT16_COLS:
            e = f"try_cast(bround({c}, 0) AS SMALLINT)"
        elif f.name in ROUNDED_INT8_COLS:
            e = f"try_cast(bround({c}, 0) AS TINYINT)"
        else:
            e = c
        out[f.name] = e
    return out


def coerce_sql(schema: T.StructType) -> list[str]:
    """Projection keeping every column, coercing only those that are present."""
    return [f"{e} AS `{name.replace('`', '``')}`" for name, e in coerce_exprs(schema).items()]


def coerce_projection(schema: T.StructType) -> list[Column]:
    return [F.expr(s) for s in coerce_sql(schema)]
