"""Edge extraction (O1 = S2 + J7 + A1): KGX edge records to one row per
(subject, predicate, object, PMID) with the distinct evidence sentences in
first-seen order, joined by `` | `` ('' when none).

Per record publications and texts meet in the row (no shuffle): compared one by one where
they are few, else in a multimap. Sentences are first reduced to distinct (key,
sentence) pairs with their first position (map-side partial aggregation absorbs a hot key's
repeats), then one group per key orders and joins them; the counts of A1 come from the same
pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import let

SEP = " | "
EDGE_SCHEMA = T.StructType([
    T.StructField("subject", T.StringType()),
    T.StructField("predicate", T.StringType()),
    T.StructField("object", T.StringType()),
    T.StructField("publications", T.ArrayType(T.StringType())),
    T.StructField("has_supporting_studies", T.MapType(T.StringType(), T.StructType([
        T.StructField("has_study_results", T.ArrayType(T.StructType([
            T.StructField("xref", T.ArrayType(T.StringType())),
            T.StructField("supporting_text", T.ArrayType(T.StringType())),
        ]))),
    ]))),
    T.StructField("publications_info", T.MapType(T.StringType(), T.StructType([
        T.StructField("sentence", T.StringType()),
    ]))),
])
#: Up to so many pairs of a publication and a text are compared one by one; a record with more
#: is sorted, so that its cost does not grow with publications x texts.
FEW_PAIRS = 64
OUT_COLUMNS = ("subject_curie", "predicate", "object_curie", "PMID", "SemMedDB_sentences")


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """KGX edge JSON lines (plain or .gz; blank lines are skipped by the
    reader) with a file-order position ``_pos`` = (file, block start, row id).
    A .gz file is one split, so it is repartitioned after the read."""
    df = spark.read.schema(EDGE_SCHEMA).json(path)
    pos = F.struct(
        F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("i"),
    )
    df = df.withColumn("_pos", pos)
    if path.endswith(".gz"):
        df = df.repartition(spark.sparkContext.defaultParallelism)
    return df


def _pairs(record_studies: Column, legacy: Column) -> Column:
    """(pmid, text) pairs of one record in reading order."""
    results = F.flatten(F.transform(F.map_values(record_studies),
                                    lambda s: F.coalesce(s.getField("has_study_results"),
                                                         F.array().cast(
                                                             "array<struct<xref:array<string>,"
                                                             "supporting_text:array<string>>>"))))
    usable = F.filter(results, lambda r: (F.coalesce(F.size(r.getField("xref")), F.lit(0)) > 0)
                      & (F.coalesce(F.size(r.getField("supporting_text")), F.lit(0)) > 0))
    study_pairs = F.transform(usable, lambda r: F.struct(
        F.get(r.getField("xref"), 0).alias("pmid"),
        F.get(r.getField("supporting_text"), 0).alias("text")))
    legacy_pairs = F.filter(
        F.transform(F.map_entries(legacy), lambda e: F.struct(
            e.getField("key").alias("pmid"),
            e.getField("value").getField("sentence").alias("text"))),
        lambda p: p.getField("text").isNotNull() & (p.getField("text") != ""))
    empty = F.array().cast("array<struct<pmid:string,text:string>>")
    return F.when(F.coalesce(F.size(record_studies), F.lit(0)) > 0, study_pairs) \
        .otherwise(F.coalesce(legacy_pairs, empty))


def _by_pmid(entries: Column) -> Column:
    """A multimap: the entries (structs with ``pmid``) of each pmid, in their order, null for
    none. Sorted once and cut into runs, so its cost does not grow with pmids × entries."""
    numbered = F.transform(F.filter(entries, lambda e: e["pmid"].isNotNull()),
                           lambda e, i: F.struct(e["pmid"].alias("pmid"), i.alias("at"), e.alias("entry")))

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                          lambda i: (i == 0) | (F.get(s, i)["pmid"] != F.get(s, i - 1)["pmid"]))
        return let(starts, lambda at: F.map_from_arrays(
            F.transform(at, lambda i: F.get(s, i)["pmid"]),
            F.transform(at, lambda i, k: F.slice(s, i + 1, F.coalesce(F.get(at, k + 1), F.size(s)) - i))))

    return let(F.array_sort(numbered), lambda s: F.when(F.size(s) > 0, runs(s)))


def _cited(publications: Column, pairs: Column) -> Column:
    """Per distinct publication of a record, in order: PMID, its first place, how often it
    stands there, and its texts in reading order; what stands for null comes last."""
    given = F.coalesce(publications, F.array().cast("array<string>"))
    few = (F.size(given).cast("long") + 1) * (F.size(pairs) + F.size(given)) <= FEW_PAIRS
    return F.when(few, _cited_few(given, pairs)).otherwise(_cited_many(given, pairs))


def _cited_few(given: Column, pairs: Column) -> Column:
    def of(named: Column) -> Column:
        return let(pairs, lambda texts: F.transform(F.array_sort(F.array_distinct(named)), lambda p: F.struct(
            p.alias("PMID"), (F.array_position(named, p) - 1).cast("int").alias("pub"),
            F.size(F.filter(named, lambda x: x == p)).alias("n"),
            F.transform(F.filter(texts, lambda x: (x["pmid"] == p) & x["text"].isNotNull()),
                        lambda x: x["text"]).alias("texts"))))

    unnamed = F.size(given) - F.size(F.array_compact(given))
    none = F.array().cast("array<string>")
    return let(F.array_compact(given), lambda named: F.when(unnamed == 0, of(named)).otherwise(F.concat(
        of(named), F.array(F.struct(F.lit(None).cast("string").alias("PMID"), F.lit(0).alias("pub"),
                                    unnamed.alias("n"), none.alias("texts"))))))


def _cited_many(publications: Column, pairs: Column) -> Column:
    places = F.transform(F.coalesce(publications, F.array().cast("array<string>")),
                         lambda p, i: F.struct(p.alias("pmid"), i.alias("place")))
    none = F.array().cast("array<string>")
    kind = "map<string, array<struct<pmid: string, at: int, entry: struct<pmid: string, text: string>>>>"
    matched = F.map_zip_with(_by_pmid(places), F.coalesce(_by_pmid(pairs), F.create_map().cast(kind)),
                             lambda _, pubs, texts: F.struct(pubs.alias("pubs"), texts.alias("texts")))
    found = F.transform(F.filter(F.map_entries(matched), lambda e: e["value"]["pubs"].isNotNull()), lambda e: F.struct(
        e["key"].alias("PMID"), F.get(e["value"]["pubs"], F.lit(0))["at"].alias("pub"),
        F.size(e["value"]["pubs"]).alias("n"),
        F.coalesce(F.filter(F.transform(e["value"]["texts"], lambda t: t["entry"]["text"]),
                            lambda t: t.isNotNull()), none).alias("texts")))
    nulls = F.filter(places, lambda p: p["pmid"].isNull())
    unnamed = F.struct(F.lit(None).cast("string").alias("PMID"), F.lit(0).alias("pub"), F.size(nulls).alias("n"),
                       none.alias("texts"))
    kind = "array<struct<PMID: string, pub: int, n: int, texts: array<string>>>"
    return F.concat(F.coalesce(found, F.array().cast(kind)), F.when(F.size(nulls) > 0, F.array(unnamed)).otherwise(F.array().cast(kind)))


def edge_keys(edges: DataFrame, pos: str = "_pos") -> DataFrame:
    """One pass over the records: per key its distinct texts in first-seen order
    (``texts``), and counts: ``n_records`` that are counted at this key (each record at one
    key), ``n_no_text`` publications without text. Records without publications are counted
    in a group with ``cited`` false.

    Texts are first made distinct per key, which spreads a hot key over all tasks; each of
    those gathers its own part of a key's texts, and only the parts are merged and ordered."""
    rec = edges.select("subject", "predicate", "object", F.col(pos).alias("rec"), F.posexplode_outer(
        _cited(F.col("publications"), _pairs(F.col("has_supporting_studies"), F.col("publications_info")))).alias("j", "c"))
    rows = rec.select("subject", "predicate", "object", "rec", "j", "c.PMID", "c.pub", "c.n",
                      F.col("c").isNotNull().alias("cited"), F.posexplode_outer("c.texts").alias("t", "text"))
    rows = rows.withColumns({
        "first": ((F.coalesce("j", F.lit(0)) == 0) & (F.coalesce("t", F.lit(0)) == 0)).cast("int"),
        "bare": F.when(F.col("cited") & F.col("text").isNull(), F.col("n")).otherwise(0)})
    key = ["subject", "predicate", "object", "PMID", "cited"]
    distinct = rows.groupBy(*key, "text").agg(
        F.min(F.struct("rec", "pub", "t")).alias("o"), F.sum("first").alias("first"), F.sum("bare").alias("bare"))
    return distinct.groupBy(*key).agg(
        F.collect_list(F.when(F.col("text").isNotNull(), F.struct("o", "text"))).alias("l"),
        F.sum("first").alias("n_records"), F.sum("bare").alias("n_no_text"),
    ).withColumn("texts", F.transform(F.array_sort("l"), lambda x: x["text"])).drop("l")


def extract_edges(edges: DataFrame, pos: str = "_pos", limit: int | None = None) -> DataFrame:
    """O1: ``subject_curie, predicate, object_curie, PMID, SemMedDB_sentences``.

    ``limit`` keeps the first N records in file order (the ``--limit`` option).
    """
    if limit is not None:
        edges = edges.orderBy(pos).limit(limit)
    return _extracted(edge_keys(edges, pos))


def _extracted(keys: DataFrame) -> DataFrame:
    return keys.where("cited").select(
        F.col("subject").alias("subject_curie"),
        "predicate",
        F.col("object").alias("object_curie"),
        "PMID",
        F.array_join("texts", SEP).alias("SemMedDB_sentences"),
    )


def edge_stats(edges: DataFrame, pos: str = "_pos") -> DataFrame:
    """A1 counts: records, unique keys, keys with several sentences,
    publications without any text; from one pass over the records."""
    zero = F.lit(0).cast("long")
    return edge_keys(edges, pos).agg(
        F.coalesce(F.sum("n_records"), zero).alias("records"),
        F.count_if("cited").alias("unique_keys"),
        F.count_if(F.col("cited") & (F.size("texts") > 1)).alias("multi_sentence"),
        F.coalesce(F.sum("n_no_text"), zero).alias("publications_without_text"),
    )
