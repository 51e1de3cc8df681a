"""Register the driver's parquet tables as session views."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Tables below this size are read as they are, whatever their split count.
#: A table stored as one file with one row group is read by one task. Where that is
#: known (the test tables), this setting deals the rows of all inputs to so many.
INPUT_PARTITIONS = "spark.attestor.inputPartitions"


def spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    n = spark.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """Create (or replace) one temp view per driver table.

    Reads are lazy: a view costs nothing until a query touches it, and the
    parquet scan then gets column pruning and filter pushdown as usual.
    """
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if exists(spark, path):
            spread(spark, spark.read.parquet(path)).createOrReplaceTempView(name)
