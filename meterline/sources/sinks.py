"""Materialising a layer: Parquet files plus a catalog entry with comment and
properties (the layer name, e.g. ``quality = silver``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _quote(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def materialize(df: DataFrame, path: str, *, name: str | None = None, comment: str | None = None,
                properties: dict | None = None, partition_by: tuple = (), mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as Parquet at ``path`` and return a fresh read of it.

    The write goes through Spark's commit protocol, so a lost executor only
    retries its tasks and no half-written file is ever read; ``overwrite`` of a
    path that is being read takes the old files away first, so layers that have
    readers go to new folders (``plans.layers``).  The returned frame
    reads the files, which also cuts the lineage for anything built on it.
    With ``name`` the table is registered in the session catalog with its
    comment and properties.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    spark = df.sparkSession
    if name:
        register_table(spark, name, path, comment=comment, properties=properties,
                       partitioned=bool(partition_by))
        return spark.table(name)
    return spark.read.parquet(path)


def register_table(spark: SparkSession, name: str, path: str, *, comment: str | None = None,
                   properties: dict | None = None, partitioned: bool = False,
                   partitions: list[dict] | None = None) -> None:
    """A catalog table over the files at ``path``: all partitions found there,
    or only those of ``partitions`` (column -> value)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    clauses = [f"CREATE TABLE {name} USING parquet LOCATION {_quote(path)}"]
    if comment:
        clauses.append(f"COMMENT {_quote(comment)}")
    if properties:
        props = ", ".join(f"{_quote(k)} = {_quote(v)}" for k, v in properties.items())
        clauses.append(f"TBLPROPERTIES ({props})")
    spark.sql(" ".join(clauses))
    if partitions:
        each = " ".join("PARTITION (" + ", ".join(f"{c} = {_quote(v)}" for c, v in p.items()) + ")" for p in partitions)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {each}")
    elif partitioned and partitions is None:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")


def table_properties(spark: SparkSession, name: str) -> dict:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"]: r["value"] for r in rows}
