"""A catalog of stored tables (Parquet directories) and SQL over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class TableStore:
    """Tables live as Parquet directories under one root (one per table,
    optionally partitioned).  ``scan`` is lazy; filters and projections on
    the result are pushed into the Parquet reader by Catalyst.  ``suffix``
    ends every table's name on disk."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.suffix = suffix

    def path(self, name: str) -> str:
        return f"{self.root}/{name}{self.suffix}"

    def scan(self, name: str) -> DataFrame:
        """Lazy reference to a stored table."""
        return self.spark.read.parquet(self.path(name))

    def sql(self, text: str, tables: list[str]) -> DataFrame:
        """SQL text over the named tables (registered as temp views)."""
        for t in tables:
            self.scan(t).createOrReplaceTempView(t)
        return self.spark.sql(text)


def read_parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")
