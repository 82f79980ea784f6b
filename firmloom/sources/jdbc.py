"""Company lists in a relational database, read and written in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_input_companies(
    spark: SparkSession, url: str, table: str, options: dict[str, str] | None = None, partition_column: str | None = None,
    bounds: tuple[int, int] | None = None, partitions: int = 32,
) -> DataFrame:
    """(matched_keyword, company_name) of a table; feed it to ``operators.intake``.

    Filters put on the frame are pushed to the database.  With a numeric
    ``partition_column`` and its ``bounds`` the table is read in ``partitions``
    ranges; without, by one task.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {}))
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load().select("matched_keyword", "company_name")


def write_records(records: DataFrame, url: str, table: str, options: dict[str, str] | None = None) -> None:
    """Append the record rows made by ``sources.tables.record_rows``."""
    records.write.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {})).mode("append").save()
