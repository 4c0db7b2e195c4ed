"""The driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the tables to ``spark.sql`` under their own names."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def spread(df: DataFrame) -> DataFrame:
    """Round-robins a scan over the session's shuffle partitions before texts are
    split, where the session asks for it (``eventide.spreadTexts=true``, as local
    sessions do: a table of one row group is one task otherwise).  Off by default:
    a large table has splits enough, and its texts are not shuffled."""
    conf = df.sparkSession.conf
    if conf.get("eventide.spreadTexts", "false").lower() != "true":
        return df
    return df.repartition(int(conf.get("spark.sql.shuffle.partitions")))
