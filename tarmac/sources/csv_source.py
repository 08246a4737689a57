"""Raw delay files: CSV with a header, read with an explicit schema.

No inference: a schema pass over a large input costs a full extra scan,
and inference can silently turn one bad value into a string column. The
default mode is FAILFAST (a malformed row stops the job); PERMISSIVE and
DROPMALFORMED are available for exploratory loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.schemas import BRONZE_CSV, CSV_COLUMNS


def read_raw_csv(spark: SparkSession, path: str, schema=BRONZE_CSV, mode: str = "FAILFAST") -> DataFrame:
    """Read one file, a directory or a glob of delay-cause CSV files."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", mode)
        .option("enforceSchema", False)  # header names must match the schema
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Write the 21 source columns as header CSV (the raw file format)."""
    (
        df.select(*CSV_COLUMNS)
        .write.mode("overwrite")
        .option("header", True)
        # keep codes byte for byte: the writer trims by default
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
