"""Delimited extracts: one header row, commas, no quoting, columns taken by position."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.schemas import EXTRACTS
from smelter.session import shuffles_go

MALFORMED = "_malformed"
REASON = "_reason"


def read_extract(spark: SparkSession, table: str, base_path: str) -> DataFrame:
    """Columns of the extract, plus ``_malformed`` (raw line) and ``_reason`` for rows that break its declaration.

    A row is broken if a field does not parse, the number of fields is wrong or a text is over its declared length.
    """
    extract = EXTRACTS[table]
    raw = (
        spark.read.schema(T.StructType([*extract.schema.fields, T.StructField(MALFORMED, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", ",")
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("dateFormat", "yyyy-MM-dd")
        .option("timestampNTZFormat", "yyyy-MM-dd[[ ]['T']HH:mm:ss[.SSS]]")
        .csv(extract.path(base_path))
    )
    return raw.withColumn(REASON, _reason(table))


def read_schema(table: str) -> T.StructType:
    """The columns that ``read_extract`` gives."""
    return T.StructType([*EXTRACTS[table].schema.fields, T.StructField(MALFORMED, T.StringType()), T.StructField(REASON, T.StringType())])


def _reason(table: str) -> Column:
    reason = F.when(F.col(MALFORMED).isNotNull(), F.lit("malformed row"))
    too_long = EXTRACTS[table].max_length.items()
    return reduce(lambda r, c: r.when(F.length(c[0]) > c[1], F.lit(f"{c[0]} over {c[1]} characters")), too_long, reason)


def rejected(rows: DataFrame, table: str) -> DataFrame:
    """Broken rows as ``(table_name, reason, record)``."""
    fields = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in EXTRACTS[table].columns])
    return rows.filter(F.col(REASON).isNotNull()).select(
        F.lit(table).alias("table_name"),
        F.col(REASON).alias("reason"),
        F.coalesce(F.col(MALFORMED), fields).alias("record"),
    )


def write_extract(df: DataFrame, table: str, base_path: str, compression: str = "none") -> None:
    """Write a table in the extracts' own format, as a folder of part files under the extract's name.

    Compressed files are read as plain ones are, but each by one task.
    """
    extract = EXTRACTS[table]
    writer = (
        df.select(*extract.columns)
        .write.mode("overwrite")
        .option("header", True)
        .option("quote", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", compression)
    )
    with shuffles_go(df.sparkSession):
        writer.csv(extract.path(base_path))
