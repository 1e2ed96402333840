"""CSV sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or "")


#: RFC 4180: a quote inside a quoted value is doubled.
QUOTES = {"quote": '"', "escape": '"'}


def in_file_order(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, **options: bool
) -> T.StructType:
    """The schema in the order of the files' header; columns it does not name are text."""
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    reader = spark.read.option("header", True).options(**QUOTES, **options)
    header = reader.csv(path if isinstance(path, str) else list(path)).columns
    known = {field.name: field for field in wanted}
    return T.StructType([known.get(name, T.StructField(name, T.StringType())) for name in header])


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
    types: dict[str, str] | None = None,
    repartition: int | None = None,
    order_column: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Headered CSV (plain or compressed, told by the file name).

    Pass ``schema`` for anything large: without it Spark reads the data once more to infer
    types. Its columns are found by the header's names, whatever their order; a column that the
    files lack is null, one that the schema lacks is not returned. All files have one header.
    ``multi_line`` allows line breaks inside quoted values; such a file is read by one task. ``types`` overrides single columns (bad values become null). Only the asked-for
    columns are parsed. A gzip file cannot be split, so one task reads it: ``repartition``
    spreads its rows afterwards. ``order_column`` adds the place of each row in the input (file,
    split, row), for operators that keep the first or last of several rows.
    """
    reader = spark.read.option("header", True).option("nanValue", "NaN").options(**QUOTES)
    reader = reader.option("multiLine", multi_line)
    try:
        if schema:
            found = in_file_order(spark, path, schema, multiLine=multi_line)
            reader = reader.schema(found).option("enforceSchema", False)
        else:
            reader = reader.option("inferSchema", True)
        df = reader.csv(path if isinstance(path, str) else list(path))
    except AnalysisException as error:
        if _missing(error):
            raise FileNotFoundError(path) from error
        raise
    if schema:
        asked = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        lacking = {f.name: F.lit(None).cast(f.dataType) for f in asked if f.name not in df.columns}
        df = df.withColumns(lacking) if lacking else df
        columns = asked.names if columns is None else columns
    if columns is not None or order_column:
        kept = [F.col(c) for c in (df.columns if columns is None else columns)]
        if order_column:
            # the id grows along each split; splits are told apart by file and offset
            place = F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("split"),
                F.monotonically_increasing_id().alias("row"),
            )
            kept.append(place.alias(order_column))
        df = df.select(*kept)
    wanted = {c: F.col(c).try_cast(t) for c, t in (types or {}).items() if c in df.columns}
    df = df.withColumns(wanted) if wanted else df
    return df.repartition(repartition) if repartition else df


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Headered CSV directory, one file per partition; values keep their white space."""
    writer = df.write.mode("overwrite").option("header", True).options(**QUOTES)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def read_parquet_or_csv(
    spark: SparkSession,
    parquet: str,
    csv: str,
    schema: T.StructType | str | None = None,
    date: str = "date",
) -> DataFrame:
    """The Parquet table if it exists, else the CSV one; ``date`` as a date."""
    try:
        df = spark.read.parquet(parquet)
    except AnalysisException as error:
        if not _missing(error):
            raise
        df = read_csv(spark, csv, schema)
    return df.withColumn(date, F.to_date(date)) if date in df.columns else df
