"""Where raw history comes from: a frame, a catalog table, Parquet files or a database."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flowgauge.schemas import JDBC_BATCH_ROWS


@dataclass(frozen=True)
class JdbcSource:
    """One table of a database, read in parallel slices of ``partition_column``.

    Without bounds Spark would read the table in a single task, so a read needs
    them: either a load window or ``lower`` and ``upper``.  Bounds only place
    the slices; rows outside them are still read.

    Spark slices by dates and instants only, so times without zone are read as
    instants, with the session and the JVM in UTC; the extracts turn them back
    into plain times after the window filter, which the database then gets.
    """

    url: str
    table: str
    driver: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    partition_column: str = "execution_date"
    partitions: int = 32
    fetch_rows: int = 10_000
    lower: datetime | None = None
    upper: datetime | None = None

    def connection(self) -> dict[str, str]:
        given = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        return {key: value for key, value in given.items() if value is not None}

    def read_options(
        self, start: datetime | None = None, end: datetime | None = None
    ) -> dict[str, str]:
        lower, upper = start or self.lower, end or self.upper
        if lower is None or upper is None:
            raise ValueError("a database read needs a window, or lower and upper bounds")
        return {
            **self.connection(),
            "dbtable": self.table,
            "partitionColumn": self.partition_column,
            "lowerBound": lower.isoformat(sep=" "),
            "upperBound": upper.isoformat(sep=" "),
            "numPartitions": str(self.partitions),
            "fetchsize": str(self.fetch_rows),
            "pushDownPredicate": "true",
        }

    def write_options(self) -> dict[str, str]:
        return {
            **self.connection(),
            "dbtable": self.table,
            "batchsize": str(JDBC_BATCH_ROWS),
            "numPartitions": str(self.partitions),
        }


Source = DataFrame | JdbcSource | str


def scan(
    spark: SparkSession,
    source: Source,
    schema: T.StructType | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Open a source lazily.  Text with a slash is a Parquet path, other text a table name.

    With a ``schema`` no file is opened to infer one.
    """
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, JdbcSource):
        return spark.read.format("jdbc").options(**source.read_options(start, end)).load()
    if "/" in source:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(source)
    return spark.table(source)


def write_jdbc(df: DataFrame, target: JdbcSource, mode: str = "append") -> None:
    """Write to a database table, one connection per partition, statements sent in batches.

    Whether a batch becomes one multi-row INSERT is up to the database's driver and its own options.
    """
    df.write.format("jdbc").options(**target.write_options()).mode(mode).save()
