"""Customer table: scan, lenient cast, label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stayline.columns import PUBLIC_NAME

_INT = {"senior_citizen", "tenure"}
_DOUBLE = {"monthly_charges"}


def _type_of(name: str) -> T.DataType:
    if name in _INT:
        return T.IntegerType()
    return T.DoubleType() if name in _DOUBLE else T.StringType()


CSV_SCHEMA = T.StructType([T.StructField(p, _type_of(n)) for n, p in PUBLIC_NAME.items()])
TABLE_SCHEMA = T.StructType([T.StructField(n, _type_of(n)) for n in PUBLIC_NAME])


def read_customers(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Scan customers from CSV (public header names) or Parquet (ours), with an explicit schema.

    ``total_charges_raw`` stays text: the file holds blanks. No inference pass over the data.
    """
    if fmt == "csv":
        raw = spark.read.schema(CSV_SCHEMA).option("header", True).option("enforceSchema", False).csv(path)
        return raw.withColumnsRenamed({p: n for n, p in PUBLIC_NAME.items()})
    return spark.read.schema(TABLE_SCHEMA).format(fmt).load(path)


def write_customers_csv(df: DataFrame, path: str) -> None:
    """Write a customer table back with its public header names."""
    named = df.select(list(PUBLIC_NAME)).withColumnsRenamed(PUBLIC_NAME)
    # Blanks are data here, so the writer and the reader must not trim them.
    (named.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
