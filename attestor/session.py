"""Session helpers.

Cluster settings always win: every helper here only fills in a value when the
session has none, so the same code runs under spark-submit on a cluster and in
local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults for a local run; a cluster's spark-defaults take precedence.
LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def get_spark(master: str | None = None, app: str = "attestor") -> SparkSession:
    """Return the active session or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or "local[8]")
    for key, value in LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, object
    store); we never override it. Only when nothing is configured (tests,
    a laptop) do we pick a fresh temporary folder.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="attestor-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def _stage_path(spark, name: str) -> str:
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/attestor-{name}-{uuid.uuid4().hex}"


#: Stages hold hashes and repeated texts, which other codecs leave almost as they are.
STAGE_CODEC = "zstd"


def write_stage(df, name: str = "stage") -> str:
    """Write ``df`` as Parquet under the shared checkpoint folder; returns the path."""
    path = _stage_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path, compression=STAGE_CODEC)
    return path


def materialize(df, name: str = "stage"):
    """Cut lineage by writing ``df`` under the shared checkpoint folder and reading it
    back. Survives executor loss (the files are on the shared store) and keeps iterative
    plans from growing level by level."""
    return df.sparkSession.read.parquet(write_stage(df, name))


def materialize_by(df, key: str, name: str = "stage"):
    """``materialize``, with the rows dealt to buckets by ``key``: what is read back joins and
    groups by ``key`` without another shuffle. For tables with few rows per key (a bucket is
    read by one task). The catalog knows the table only until it has been looked up."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = _stage_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    df.repartition(parts, key).write.bucketBy(parts, key).saveAsTable(
        table, format="parquet", path=path, compression=STAGE_CODEC)
    stored = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    return stored


def replace_parts(rows, path: str, column: str) -> None:
    """Write ``rows``, which may come from ``path`` itself, over the partitions of the table
    there that they belong to (``column=``); files of other partitions stay as they are. The
    rows are written under the checkpoint folder first, so nothing that is read is deleted
    before it has been read, and each partition becomes one file."""
    stored = materialize(rows, "parts")
    (stored.repartition(column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))


# Largest side we broadcast on purpose, in bytes of its rows in memory: the driver holds a
# broadcast's rows, their hash table and its blocks, and a plan has several. Above it the
# planner's shuffle join (with AQE's own runtime broadcast/skew handling) takes over.
BROADCAST_MAX_BYTES = 16 * 1024 * 1024


def estimated_bytes(df) -> int | None:
    """Optimizer's size estimate for ``df`` (an upper bound for scans and
    filters), without running a job."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # noqa: BLE001 - Spark Connect or an unusual plan
        return None


def stored_bytes(df) -> int:
    """Bytes of the files that ``df`` reads, as the file systems report them."""
    spark = df.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for name in df.inputFiles():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


# Bytes that a row of a broadcast takes besides its texts: its places in the hash table, and
# a word for each field.
ROW_BYTES, FIELD_BYTES = 64, 16


def row_bytes(df):
    """The bytes that a row of ``df`` takes in memory, as a column: files say little about
    it, for repeated texts are stored once there."""
    from pyspark.sql import functions as F

    size = F.lit(ROW_BYTES + FIELD_BYTES * len(df.columns)).cast("long")
    for f in df.schema.fields:
        simple = f.dataType.typeName() in ("string", "binary")
        size = size + F.coalesce(F.octet_length(F.col(f"`{f.name}`") if simple else F.to_json(F.struct(f"`{f.name}`"))),
                                 F.lit(0))
    return size


def fits(*frames, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether the rows of all ``frames`` (of stored tables; an action) are together within
    ``max_bytes`` in memory."""
    from pyspark.sql import functions as F

    left = max_bytes
    for df in frames:
        left -= df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0]
        if left < 0:
            return False
    return True


def small_side(df, max_bytes: int = BROADCAST_MAX_BYTES):
    """``df`` written once under the checkpoint folder (an action), and whether the size of
    its rows in memory shows it fit to be broadcast. A side that the optimizer's estimate
    already puts beyond ``max_bytes`` is not written but returned as it is."""
    size = estimated_bytes(df)
    if size is None or size > max_bytes:
        return df, False
    stored = materialize(df, "small-side")
    return stored, stored_bytes(stored) <= max_bytes and fits(stored, max_bytes=max_bytes)


def checked_broadcast(df, max_bytes: int = BROADCAST_MAX_BYTES):
    """``df`` for a join: written once and broadcast when its stored size is within
    ``max_bytes``; otherwise unchanged, so the join shuffles."""
    from pyspark.sql import functions as F

    stored, fits = small_side(df, max_bytes)
    return F.broadcast(stored) if fits else stored
