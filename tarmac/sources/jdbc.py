"""Reading an existing relational table (e.g. a bronze table kept in a
database) in parallel over JDBC.

Not exercised here: no database may run in this environment. The call is
Spark's own JDBC source; a numeric or date ``partition_column`` with
bounds splits the read into ``num_partitions`` range queries instead of
one connection pulling the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower_bound=None, upper_bound=None, num_partitions: int | None = None,
              properties: dict[str, str] | None = None, fetch_size: int = 10_000) -> DataFrame:
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    if None in (lower_bound, upper_bound, num_partitions) or num_partitions <= 0:
        raise ValueError("a partitioned read needs lower_bound, upper_bound and a positive num_partitions")
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound, upperBound=upper_bound,
                           numPartitions=num_partitions, properties=props)
