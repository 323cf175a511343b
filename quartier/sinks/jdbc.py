"""JDBC sink. The target is created with declared column types, or truncated when it exists."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartier.plans.mart import TABLES, Mart, warehouse_names

# Digits of the database's number type per Spark type (fixed values). Floating values keep four decimals.
_DIGITS = {
    T.BooleanType: (1, 0),
    T.ByteType: (3, 0),
    T.ShortType: (5, 0),
    T.IntegerType: (10, 0),
    T.LongType: (19, 0),
    T.FloatType: (19, 4),
    T.DoubleType: (19, 4),
}
#: Bytes that the database's text type holds (fixed value).
TEXT_BYTES = 4000
_TEXT = f"VARCHAR({TEXT_BYTES})"


def _number(kind: T.DataType) -> str | None:
    digits = _DIGITS.get(type(kind))
    return None if digits is None else "DECIMAL({}, {})".format(*digits)


def column_types(df: DataFrame) -> str:
    """Declared column types of the target table, in Spark's type syntax; other types are left to Spark's dialect."""
    declared = []
    for field in df.schema:
        kind = _number(field.dataType)
        if isinstance(field.dataType, T.StringType):
            kind = _TEXT
        elif isinstance(field.dataType, T.DateType):
            kind = "DATE"
        if kind is not None:
            declared.append(f"{field.name} {kind}")
    return ", ".join(declared)


def cut_text(value: Column, limit: int = TEXT_BYTES) -> Column:
    """The longest beginning of a text that has at most ``limit`` UTF-8 bytes and no broken character."""
    raw = F.encode(value, "utf-8")

    def goes_on(place: int) -> Column:
        """Whether the byte at ``place`` belongs to the character before it: it is between 0x80 and 0xBF."""
        return F.hex(F.substring(raw, place, 1)).between("80", "BF")

    # A character has four bytes at most, so one of four places begins one.
    end = F.lit(max(limit - 3, 0))
    for back in (2, 1, 0):
        if limit - back >= 0:
            end = F.when(~goes_on(limit - back + 1), limit - back).otherwise(end)
    return F.when(F.octet_length(value) <= limit, value).otherwise(F.decode(F.substring(raw, F.lit(1), end), "utf-8"))


def split_long_texts(df: DataFrame, limit: int = TEXT_BYTES) -> tuple[DataFrame, DataFrame]:
    """Rows whose texts all fit, and the others with the names of the columns that do not, in ``too_long``."""
    texts = [field.name for field in df.schema if isinstance(field.dataType, T.StringType)]
    over = F.concat_ws(", ", *(F.when(F.octet_length(name) > limit, F.lit(name)) for name in texts))
    return df.where(over == ""), df.withColumn("too_long", over).where(F.col("too_long") != "")


def _sink_value(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, T.BooleanType):
        value = value.cast("int")
    kind = _number(field.dataType)
    if kind is not None:
        # Rounds half-up here: some databases truncate surplus digits instead.
        value = value.cast(kind)
    elif isinstance(field.dataType, T.StringType):
        value = F.nullif(cut_text(value), F.lit(""))
    return value.alias(field.name)


def sink_values(df: DataFrame) -> DataFrame:
    """Values as the database keeps them: numbers in its number type, texts cut to its limit of bytes, empty text as NULL.

    Use :func:`split_long_texts` first where a row with a longer text shall be set aside instead.
    """
    return df.select(*[_sink_value(field) for field in df.schema])


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper() for name in df.columns])


def attributes_as_json(business: DataFrame) -> DataFrame:
    """The nested attributes as JSON text, absent ones left out; text is passed on."""
    kind = business.schema["attributes"].dataType
    attributes = F.col("attributes")
    if isinstance(kind, T.StringType):
        return business
    if isinstance(kind, T.MapType):
        attributes = F.map_filter(attributes, lambda _, value: value.isNotNull())
    return business.withColumn("attributes", F.to_json(attributes))


def sink_shape(df: DataFrame, name: str) -> DataFrame:
    """Columns of a mart table as its database table names them."""
    if name == "business":
        df = attributes_as_json(df)
    return upper_columns(warehouse_names(df, name))


#: Connections open at once, unless the caller says otherwise.
CONNECTIONS = 16


def write_table(
    df: DataFrame,
    options: Mapping[str, str],
    table: str,
    types: str,
    batch_size: int = 420,
    connections: int | None = CONNECTIONS,
) -> None:
    """Replace the rows of ``table``, keeping its definition when it exists.

    Every task inserts over its own connection; ``connections`` bounds how many there are at once (None: one for each
    task). A task that fails after part of its rows went in repeats them when it is retried: a table without a primary
    key can then hold rows twice.
    """
    writer = (
        df.write.format("jdbc")
        .mode("overwrite")
        .options(**options, dbtable=table, createTableColumnTypes=types)
        .option("truncate", True)
        .option("batchsize", batch_size)
    )
    if connections is not None:
        writer = writer.option("numPartitions", connections)
    writer.save()


def load_warehouse(
    mart: Mart,
    options: Mapping[str, str],
    tables: Mapping[str, str] = TABLES,
    batch_size: int = 420,
    connections: int | None = CONNECTIONS,
    set_aside: Callable[[DataFrame, str], None] | None = None,
) -> None:
    """Load the six tables, dimensions first and the fact last.

    Texts over the database's limit are cut at a character's edge. With ``set_aside`` (``Store.save``, say) their rows are not loaded
    but handed to it, with the name of the table and ``_too_long``.
    """
    for name in TABLES:
        rows = sink_shape(getattr(mart, name), name)
        if set_aside is not None:
            rows, long = split_long_texts(rows)
            set_aside(long, f"{name}_too_long")
        write_table(sink_values(rows), options, tables[name], column_types(rows), batch_size, connections)
