"""Declared schemas of the file inputs, limited to the columns that are used. Inference would cost a pass and drift."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def business(attributes: T.DataType | None = None) -> T.StructType:
    """Business records.

    ``attributes`` is an open set of named texts, read as a map so that no name has to be known beforehand; pass a
    struct type to read named fields.
    """
    return _struct(
        business_id=_S,
        name=_S,
        address=_S,
        city=_S,
        state=_S,
        postal_code=_S,
        latitude=_D,
        longitude=_D,
        stars=_D,
        is_open=_L,
        attributes=attributes or T.MapType(_S, _S),
        categories=_S,
    )


CHECKIN = _struct(business_id=_S, date=_S)

TIP = _struct(user_id=_S, business_id=_S, text=_S, date=T.TimestampType(), compliment_count=T.IntegerType())
