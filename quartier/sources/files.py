"""File readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartier.operators.dims import split_dates
from quartier.sources import schemas


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Newline-delimited JSON, one record per line, so that large files stay splittable."""
    return spark.read.schema(schema).option("multiLine", False).json(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, required: list[str], multi_line: bool = False, escape: str = "\\",
) -> DataFrame:
    r"""CSV with a header, ``"`` quotes and ``\`` escapes; ``escape='"'`` reads doubled quotes.

    A line is kept when every ``required`` column is present and parses, whichever columns a query then selects.
    (Spark's own drop-malformed mode judges only the selected columns, so the same line could be kept by one query and
    dropped by another.) :func:`rejected_csv` has the lines left out. The file stays splittable; with ``multi_line`` quoted
    line breaks are read, but each file is then one task, which suits many files of moderate size.
    """
    rows = spark.read.schema(schema).options(
        header=True, sep=",", quote='"', escape=escape, mode="PERMISSIVE", multiLine=multi_line
    ).csv(path)
    for column in required:
        rows = rows.filter(F.col(column).isNotNull())
    return rows


def load_business(spark: SparkSession, path: str, attributes: T.DataType | None = None) -> DataFrame:
    return read_ndjson(spark, path, schemas.business(attributes))


def load_checkins(spark: SparkSession, path: str) -> DataFrame:
    """One row per check-in; the file holds all check-ins of a business in one text."""
    return split_dates(read_ndjson(spark, path, schemas.CHECKIN))


def load_tips(
    spark: SparkSession, path: str, schema: T.StructType = schemas.TIP, multi_line: bool = False, escape: str = "\\",
) -> DataFrame:
    return read_csv(spark, path, schema, ["business_id", "date"], multi_line, escape)


#: Columns of a checked read: why a record is set aside (null for good ones), and its text.
REASON, TEXT = "reject_reason", "reject_text"
_CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])


def _reason(required: list[str], kind: str) -> Column:
    """Null where every required value is there; else whether the record parses at all, or what it lacks."""
    absent = F.concat_ws(", ", *(F.when(F.col(name).isNull(), F.lit(name)) for name in required))
    broken = F.col(_CORRUPT).isNotNull() & F.lit(kind != "")
    return F.when(absent != "", F.when(broken, F.lit(kind)).otherwise(F.concat(F.lit("no "), absent)))


def check_ndjson(spark: SparkSession, path: str, schema: T.StructType, required: list[str]) -> DataFrame:
    """Every record of an NDJSON file, parsed once, with ``reject_reason`` and ``reject_text``; blank lines are no records.

    A record is good when its required values are there and parse, whatever else is wrong with it. Write the result before
    splitting it with :func:`accepted` and :func:`rejects`: then the file is read once.
    """
    lines = spark.read.text(path).where(F.col("value").rlike(r"\S"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    read = lines.select(F.col("value"), F.from_json("value", _with_corrupt(schema), options).alias("_read")).select("value", "_read.*")
    read = read.withColumn(REASON, _reason(required, "not JSON"))
    return read.withColumn(TEXT, F.when(F.col(REASON).isNotNull(), F.col("value"))).drop("value", _CORRUPT)


def check_csv(
    spark: SparkSession, path: str, schema: T.StructType, required: list[str], multi_line: bool = False, escape: str = "\\",
) -> DataFrame:
    """Every record of a CSV file with header, with ``reject_reason`` and ``reject_text``, as :func:`check_ndjson` does.

    With ``multi_line`` a record may run over several lines, and is set aside as a whole; each file is then one task. The
    text of a record that does not fit the schema is as in the file; of one that fits but lacks a value it is written anew.
    """
    rows = spark.read.schema(_with_corrupt(schema)).options(
        header=True, sep=",", quote='"', escape=escape, mode="PERMISSIVE", multiLine=multi_line,
        columnNameOfCorruptRecord=_CORRUPT, columnPruning=False,
    ).csv(path)
    written = {"quote": '"', "escape": escape, "timestampFormat": "yyyy-MM-dd HH:mm:ss"}
    fields = F.to_csv(F.struct(*schema.fieldNames()), written)
    rows = rows.withColumn(REASON, _reason(required, ""))
    return rows.withColumn(TEXT, F.when(F.col(REASON).isNotNull(), F.coalesce(_CORRUPT, fields))).drop(_CORRUPT)


def accepted(checked: DataFrame) -> DataFrame:
    """The good records of a checked read; all rows of another frame."""
    return checked.where(F.col(REASON).isNull()).drop(REASON, TEXT) if REASON in checked.columns else checked


def rejects(checked: DataFrame, source: str) -> DataFrame:
    """(source, reason, text) of the records set aside; none of a frame that was not read with checks."""
    if REASON not in checked.columns:
        checked = checked.select(F.lit("").alias(REASON), F.lit("").alias(TEXT)).limit(0)
    return checked.where(F.col(REASON).isNotNull()).select(F.lit(source).alias("source"), F.col(REASON).alias("reason"), F.col(TEXT).alias("text"))


def check_business(spark: SparkSession, path: str, attributes: T.DataType | None = None) -> DataFrame:
    return check_ndjson(spark, path, schemas.business(attributes), ["business_id"])


def check_checkins(spark: SparkSession, path: str) -> DataFrame:
    """Check-in records; their dates are split by ``split_dates`` once rejects are apart."""
    return check_ndjson(spark, path, schemas.CHECKIN, ["business_id", "date"])


def check_tips(
    spark: SparkSession, path: str, schema: T.StructType = schemas.TIP, multi_line: bool = False, escape: str = "\\",
) -> DataFrame:
    return check_csv(spark, path, schema, ["business_id", "date"], multi_line, escape)


def _rejects(lines: DataFrame, record: Column, required: list[str], source: str) -> DataFrame:
    read = lines.withColumn("_record", record)
    missing = [F.when(F.col("_record")[name].isNull(), F.lit(name)) for name in required]
    reason = F.concat_ws(", ", *missing)
    return read.where(reason != "").select(
        F.lit(source).alias("source"), F.concat(F.lit("no "), reason).alias("reason"), F.col("value").alias("text")
    )


def rejected_ndjson(spark: SparkSession, path: str, schema: T.StructType, required: list[str], source: str) -> DataFrame:
    """(source, reason, text) of the lines that do not parse or lack a required value; blank lines are no records.

    For a file that is not read with checks: it is read once more.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    return _rejects(lines, F.from_json("value", schema, {"mode": "PERMISSIVE"}), required, source)


def rejected_csv(
    spark: SparkSession, path: str, schema: T.StructType, required: list[str], source: str, escape: str = "\\",
) -> DataFrame:
    """(source, reason, text) of the lines that :func:`read_csv` leaves out when it reads line by line."""
    header = ",".join(schema.fieldNames())
    lines = spark.read.text(path).where((F.trim("value") != "") & (F.col("value") != header))
    options = {"sep": ",", "quote": '"', "escape": escape, "mode": "PERMISSIVE"}
    return _rejects(lines, F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), options), required, source)
