"""CSV scans with declared types. Paths may be anything Spark can open, ``s3a://`` included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmetrics.functions import finite
from tripmetrics.schema import TRIP_COLUMNS, WEATHER_COLUMNS, ZIP_COLUMNS, SourceColumn


# Names the unreadable fields of a row.
UNREADABLE = "unreadable"
# The text of a row that has too few or too many fields; NULL for a whole one.
BROKEN = "broken"


def read_csv(
    spark: SparkSession, path: str, columns: tuple[SourceColumn, ...], flag_unreadable: bool = False
) -> DataFrame:
    """Read the declared columns by header name, whatever else the file holds and in whatever order.

    Only the header line is looked at up front; there is no pass over the data to guess types. A number that
    can't be read, NaN and infinities included, becomes NULL. Whole numbers may be written with decimals, as in
    ``900.0``; decimals are cut off. Files whose header differs from the first one's are an error, not silently
    shifted columns.

    With ``flag_unreadable`` the column ``unreadable`` has the names of the fields that are filled and yet NULL,
    so that they can be told from missing ones. Numbers are then read as text and converted here. The column
    ``broken`` has the text of a row with fewer or more fields than the header: its values may be in the wrong
    columns. ``whole_records`` and ``broken_records`` tell the two kinds apart. All fields of a row are split for
    this, whatever columns a query uses.
    """
    header = spark.read.option("header", True).csv(path).columns
    absent = [c.header for c in columns if c.required and c.header not in header]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}; it has {header}")
    kinds = {c.header: _read_as(c) for c in columns if not flag_unreadable}
    in_file_order = T.StructType([T.StructField(h, kinds.get(h, T.StringType())) for h in header])
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if flag_unreadable:
        record = BROKEN
        while record in header:
            record += "_"
        in_file_order = in_file_order.add(record, T.StringType())
        # With pruning only the fields that a query uses are split, and rows look whole.
        reader = reader.option("columnNameOfCorruptRecord", record).option("columnPruning", False)
    table = reader.schema(in_file_order).csv(path)
    present = [c for c in columns if c.header in header]
    values = [
        (_value(c) if c.header in header else F.lit(None).cast(c.type)).alias(c.name)
        for c in columns
    ]
    if flag_unreadable:
        numbers = [c for c in present if c.type != T.StringType()]
        flags = [F.when((F.trim(_field(c)) != "") & _value(c).isNull(), F.lit(c.name)) for c in numbers]
        values.append(F.array_compact(F.array(*flags)).cast("array<string>").alias(UNREADABLE))
        # Spark refuses a query of the broken records alone; this names another column and is never true.
        never = F.length(F.col(f"`{header[0]}`").cast("string")) < 0
        values.append(F.coalesce(F.when(never, F.lit("")), F.col(f"`{record}`")).alias(BROKEN))
    return table.select(*values)


def _read_as(column: SourceColumn) -> T.DataType:
    return column.type if column.type == T.StringType() else T.DoubleType()


def _field(column: SourceColumn) -> Column:
    return F.col(f"`{column.header}`")


def _value(column: SourceColumn) -> Column:
    """A field in its declared type, read as text or as a double before."""
    if column.type == T.StringType():
        return _field(column)
    number = finite(_field(column).try_cast("double"))
    return number if column.type == T.DoubleType() else number.try_cast(column.type)


def unreadable_fields(flagged: DataFrame, columns: tuple[SourceColumn, ...] = TRIP_COLUMNS) -> DataFrame:
    """How many rows of a table read with ``flag_unreadable`` have an unreadable value, by column, 0 included.

    One aggregate with a count per column; rows are not multiplied.
    """
    names = [c.name for c in columns if c.type != T.StringType()]
    counts = flagged.agg(*[F.count_if(F.array_contains(UNREADABLE, n)).alias(n) for n in names])
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("unreadable")) for n in names])
    return counts.select(F.inline(pairs))


def whole_records(flagged: DataFrame) -> DataFrame:
    """Rows with as many fields as the header, of a table read with ``flag_unreadable`` or of a stage made from it."""
    return flagged.where(F.col(BROKEN).isNull()).drop(BROKEN) if BROKEN in flagged.columns else flagged


def broken_records(flagged: DataFrame) -> DataFrame:
    """The quarantine: the texts of the rows with too few or too many fields, for whoever mends the file."""
    if BROKEN not in flagged.columns:
        return flagged.limit(0).select(F.lit(None).cast("string").alias(BROKEN))
    return flagged.where(F.col(BROKEN).isNotNull()).select(BROKEN)


def record_summary(flagged: DataFrame) -> DataFrame:
    """Whole rows, broken rows, and whole rows with an unreadable field, of a table read with ``flag_unreadable``."""
    whole = F.col(BROKEN).isNull()
    return flagged.agg(
        F.count_if(whole).alias("whole"),
        F.count_if(~whole).alias("broken"),
        F.count_if(whole & (F.size(UNREADABLE) > 0)).alias("unreadable"),
    )


def read_trips(spark: SparkSession, path: str, flag_unreadable: bool = False) -> DataFrame:
    """Taxi trips as in the file: times still text, numbers may be NULL."""
    return read_csv(spark, path, TRIP_COLUMNS, flag_unreadable)


def read_weather(spark: SparkSession, path: str, flag_unreadable: bool = False) -> DataFrame:
    """Weather-station measurements as in the file."""
    return read_csv(spark, path, WEATHER_COLUMNS, flag_unreadable)


def read_zips(spark: SparkSession, path: str) -> DataFrame:
    """Postcode reference: one row per postcode with the position of its centre."""
    return read_csv(spark, path, ZIP_COLUMNS)
