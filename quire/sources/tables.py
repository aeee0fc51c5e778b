"""Reading the driver's parquet tables (column pruning and filters are pushed
into the parquet scan by Catalyst; callers select only what they use)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.session import ship_package

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def literal_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small table of literal rows planned on the JVM (``inline`` of an
    array of structs), instead of a Python-side RDD scan."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(ddl)
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
