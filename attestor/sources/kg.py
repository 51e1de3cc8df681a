"""Knowledge-graph file readers (S2-S5 companions): nodes, names, predicates.

Nodes come as JSON lines (KG2 or KGX flavour, optionally gzipped) or as one
pre-built ``{curie: {...}}`` JSON object. Line order matters for the node
match (a later node overwrites an earlier one), so every reader attaches a
file-order position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

NODE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    # a list arrives as its JSON text and is normalised by entities.normalize_category
    T.StructField("category", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("equivalent_curies", T.ArrayType(T.StringType())),
    T.StructField("equivalent_identifiers", T.ArrayType(T.StringType())),
    T.StructField("all_names", T.ArrayType(T.StringType())),
])
NODE_DICT = "map<string, struct<name:string, category:string, description:string>>"
SUFFIXES = (".jsonl", ".jsonl.gz", ".json", ".json.gz")


def positioned(df: DataFrame) -> DataFrame:
    """File-order position: (file, block start, id within the split)."""
    return df.withColumn("line", F.struct(
        F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("i"),
    ))


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """S3: node records with ``line``. Other suffixes raise ValueError.

    The pre-built dict form is one JSON object; its entries are cut apart by many tasks, and
    ``line`` is an entry's place."""
    if not path.endswith(SUFFIXES):
        raise ValueError(f"Unsupported file format: {path}. "
                         "Expected .jsonl, .jsonl.gz, .json.gz, or .json")
    if path.endswith((".jsonl", ".jsonl.gz")):
        df = positioned(spark.read.schema(NODE_SCHEMA).json(path))
        if path.endswith(".gz"):
            df = df.repartition(spark.sparkContext.defaultParallelism)
        return df
    entries = dict_entries(spark, path).select(
        "entry", F.posexplode(F.map_entries(F.from_json("text", NODE_DICT))).alias("at", "e"))
    return entries.select(
        F.struct("entry", "at").alias("line"),
        F.col("e.key").alias("id"), "e.value.name", "e.value.category", "e.value.description",
        F.lit(None).cast("array<string>").alias("equivalent_curies"),
        F.lit(None).cast("array<string>").alias("equivalent_identifiers"),
        F.lit(None).cast("array<string>").alias("all_names"),
    )


def _running(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over all rows before, in the order of
    (file, block, i). Blocks are added up where they lie; only one total per block meets the
    others, as in a parallel prefix sum."""
    inside = Window.partitionBy("file", "block").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    valued = rows.withColumn("value", value)
    starts = valued.groupBy("file", "block").agg(F.sum("value").alias("total")).select(
        "file", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    own = valued.withColumn("own", F.coalesce(F.sum("value").over(inside), F.lit(0)))
    return own.join(F.broadcast(starts), ["file", "block"]).withColumn(name, F.col("start") + F.col("own")).drop(
        "value", "own", "start")


def dict_entries(spark: SparkSession, path: str) -> DataFrame:
    """``entry``, ``text``: the entries of ``{key: {…}, …}`` files in order, each as an object
    of its own, however large the files are.

    The files are read in blocks and cut at every closing brace. Whether such a piece starts
    inside a string, how deep it lies and which entry it belongs to are sums over the pieces
    before it: of its quotes, of its braces outside strings, and of the ends of entries."""
    read = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("i"), F.col("value").alias("piece"))
    # without escaped characters every quote opens or closes a string
    parts = F.split(F.regexp_replace("piece", r"(?s)\\.", ""), '"', -1)

    def opened(odd: int) -> Column:
        braces = F.transform(F.filter(parts, lambda _, k: k % 2 == odd), lambda x: F.length(F.regexp_replace(x, r"[^{]", "")))
        return F.aggregate(braces, F.lit(0), lambda n, x: n + x)

    pieces = materialize(read.withColumns({
        "quotes": F.size(parts) - 1, "even": opened(0), "odd": opened(1)}), "pieces")
    rows = _running(pieces, F.col("quotes"), "quotes_before")
    inside = F.col("quotes_before") % 2 == 1
    closes = (F.col("quotes_before") + F.col("quotes")) % 2 == 0  # the brace after the piece is no text
    change = F.when(inside, F.col("odd")).otherwise(F.col("even")) - closes.cast("int")
    rows = rows.withColumns({"closes": closes, "change": change})
    rows = _running(rows, F.col("change"), "depth_before")
    rows = rows.withColumn("depth", F.col("depth_before") + F.col("change"))
    ends = F.col("closes") & F.col("depth").isin(0, 1)
    rows = _running(rows.withColumn("ends", ends), F.col("ends").cast("int"), "number")
    entry = rows.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "i", "piece"))).alias("pieces"),
        F.bool_or(F.col("ends") & (F.col("depth") == 1)).alias("whole"))
    text = F.concat(F.array_join(F.transform("pieces", lambda p: p["piece"]), "}"), F.when(F.col("whole"), "}").otherwise(""))
    body = F.regexp_replace(text, r"^[\s,{]+", "")
    return entry.select(F.struct("file", "number").alias("entry"), body.alias("body")).where(
        F.trim(F.regexp_replace("body", r"\s", "")) != "").select("entry", F.concat(F.lit("{"), "body", F.lit("}")).alias("text"))


def read_names_tsv(spark: SparkSession, path: str) -> DataFrame:
    """``curie_id, all_names`` with the pipe list split, empty pieces dropped, and
    ``line``, the place in the file: a later row replaces an earlier one."""
    df = positioned(spark.read.csv(path, sep="\t", header=True, escape='"'))
    return df.select(
        "curie_id", "line",
        F.filter(F.split(F.coalesce("all_names", F.lit("")), "\\|"), lambda x: x != "")
        .alias("all_names"),
    )


def read_predicates_tsv(spark: SparkSession, path: str) -> DataFrame:
    """``predicate, description``; a later row for the same predicate wins.
    A missing file gives an empty table (the caller may warn)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], "predicate string, description string")
    df = positioned(spark.read.csv(path, sep="\t", header=True, escape='"'))
    return df.groupBy("predicate").agg(
        F.coalesce(F.max_by("description", "line"), F.lit("")).alias("description"))


def write_names_tsv(names: DataFrame, path: str) -> None:
    """``curie_id, all_names`` (pipe-joined, '' when empty), sorted by curie."""
    (names.select("curie_id", F.array_join("all_names", "|").alias("all_names"))
     .orderBy("curie_id").write.mode("overwrite").csv(path, sep="\t", header=True))


def write_predicates_tsv(predicates: DataFrame, path: str) -> None:
    """``predicate, description`` in the frame's order."""
    predicates.select("predicate", "description").write.mode("overwrite").csv(
        path, sep="\t", header=True, escape='"', emptyValue="")


def request_batches(ids: DataFrame, col: str, size: int) -> DataFrame:
    """Fixed-size request batches of the sorted ids: ``batch`` = rank // size.

    Exact ranks without a single task: the ids are dealt by ranges (equal ids too, by a row
    number, so many copies of one id do not make one task), the rows of each range counted,
    and a row's rank is its place in its range behind the rows of the ranges before. Only
    the counts, one per range, are added up in one place."""
    rows = materialize(ids.select(F.col(col).alias("id"), F.monotonically_increasing_id().alias("row")), "ids")
    dealt = rows.repartitionByRange("id", "row").withColumn("range", F.spark_partition_id())
    ranged = materialize(dealt, "ranges")
    counts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("range").orderBy("id", "row")) - 1
    return ranged.join(F.broadcast(starts), "range").select(
        F.col("id").alias(col), F.floor((F.col("start") + place) / size).cast("long").alias("batch"))
