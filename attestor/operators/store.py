"""Abstract store (O5) and abstract availability.

The store is a table with one row per ``bare_pmid``:
``bare_pmid, title, abstract, fetch_date, error``. A stored one is Parquet in parts by the
hash of the pmid; a change rewrites the parts it touches (``upsert_stored``).

Only ``bare_pmid`` travels through shuffles until the last join that needs the
abstract text; the store key is renamed from ``pmid`` so it cannot collide with
the case-insensitive ``PMID`` column of the triples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import normalize_pmid, py_strip
from ..session import materialize, replace_parts

STORE_COLUMNS = ("bare_pmid", "title", "abstract", "fetch_date", "error")

# Fixed values that must match the source pipeline.
NO_ABSTRACT = "No abstract available"
NOT_FOUND = "PMID not found or could not be retrieved"
NOT_IN_RESULTS = "PMID not found in results"
RETRYABLE_LIKE = ("Extraction failed:%", "PMID not found or could not be retrieved")


def is_valid(store: DataFrame | None = None) -> Column:
    """Bulk validity rule: no error and a non-empty abstract."""
    return (
        F.col("error").isNull()
        & F.col("abstract").isNotNull()
        & (F.col("abstract") != "")
    )


def valid_pmids(store: DataFrame) -> DataFrame:
    """Distinct ``bare_pmid`` of valid rows (the filter reaches the scan)."""
    return store.filter(is_valid()).select("bare_pmid").distinct()


def with_bare_pmid(triples: DataFrame, col: str = "PMID") -> DataFrame:
    return triples.withColumn("bare_pmid", normalize_pmid(F.col(col).cast("string")))


def abstract_index(store: DataFrame) -> DataFrame:
    """Valid abstracts as (bare_pmid, abstract_sha, abstract_len): the text is
    hashed once per document here, so later stages carry 40 bytes, not text.
    The store holds one row per pmid (``upsert`` keeps it so); no aggregate,
    hence no sort of the text."""
    return store.filter(is_valid()).select(
        "bare_pmid",
        F.unhex(F.sha2(F.col("abstract"), 256)).alias("abstract_sha"),
        F.length("abstract").cast("long").alias("abstract_len"),
        F.lit(True).alias("has_abstract"),
    )


def flag_abstract(triples: DataFrame, store: DataFrame) -> DataFrame:
    """Add ``bare_pmid``, ``has_abstract`` and the abstract's hash/length.

    One left join against the valid-abstract index. AQE turns the join into a broadcast when the index is small at runtime and
    splits a hot PMID on the triple side otherwise.
    """
    ids = abstract_index(store)
    out = with_bare_pmid(triples).join(ids, "bare_pmid", "left")
    # the flag is a column of its own: a plan that needs no hash computes none
    return out.withColumn("has_abstract", F.coalesce("has_abstract", F.lit(False)))


def split_by_abstract(triples: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a valid abstract, rows without). Columns as input +
    bare_pmid; the first also carries abstract_sha and abstract_len."""
    flagged = flag_abstract(triples, store)
    with_abs = flagged.filter("has_abstract").drop("has_abstract")
    without = flagged.filter(~F.col("has_abstract")).drop(
        "has_abstract", "abstract_sha", "abstract_len")
    return with_abs, without


def abstract_status(triples: DataFrame, store: DataFrame) -> DataFrame:
    """F20 and J2 in one left join: ``bare_pmid``, ``has_abstract``, ``status``.

    status: absent -> ``PMID not found in results``; error -> ``Error: <error>``;
    blank abstract -> ``No abstract available``; otherwise ``valid``.
    has_abstract follows the bulk rule (no error, non-empty abstract).
    """
    meta = store.select(
        "bare_pmid",
        F.col("error").alias("_error"),
        (py_strip(F.coalesce(F.col("abstract"), F.lit(""))) == "").alias("_blank"),
        is_valid().alias("_valid"),
    )
    out = with_bare_pmid(triples).join(meta, "bare_pmid", "left")
    status = (
        F.when(F.col("_valid").isNull(), F.lit(NOT_IN_RESULTS))
        .when(F.coalesce(F.col("_error"), F.lit("")) != "",
              F.concat(F.lit("Error: "), F.col("_error")))
        .when(F.col("_blank"), F.lit(NO_ABSTRACT))
        .otherwise(F.lit("valid"))
    )
    return (
        out.withColumn("has_abstract", F.coalesce(F.col("_valid"), F.lit(False)))
        .withColumn("status", status)
        .drop("_error", "_blank", "_valid")
    )


def attach_abstracts(rows: DataFrame, store: DataFrame, how: str = "inner",
                     chars: str | None = None, hashed: bool = False) -> DataFrame:
    """Bring title and abstract to rows that carry ``bare_pmid``, and as ``chars`` the
    abstract's characters, counted once per document.

    This is the one shuffle that moves abstract text; it happens last. ``hashed``: the
    abstracts of a partition are kept in memory, so neither wide rows nor texts are sorted.
    """
    count = [F.length("abstract").cast("long").alias(chars)] if chars else []
    text = store.filter(is_valid()).select("bare_pmid", "title", "abstract", *count)
    return rows.join(text.hint("shuffle_hash") if hashed else text, "bare_pmid", how)


# ---------------------------------------------------------------- upkeep


def upsert(store: DataFrame, new: DataFrame, order_col: str | None = None) -> DataFrame:
    """Insert-or-replace by ``bare_pmid``; the newest batch wins.

    ``new`` may carry an ordering column (position in the batch); within a
    batch the last row for a pmid wins, as repeated single-row upserts would.
    The old store is never windowed or sorted: its rows only pass an anti-join
    against the batch's ids (a small side in practice, which AQE broadcasts),
    and only the batch itself is reduced to one row per pmid.
    """
    cols = list(STORE_COLUMNS)
    # without an order column the rows' own order counts
    pos = F.col(order_col).cast("long") if order_col else F.monotonically_increasing_id()
    latest = (
        new.select(*cols, pos.alias("_pos"))
        .groupBy("bare_pmid")
        .agg(F.max_by(F.struct(*cols[1:]), F.col("_pos")).alias("_row"))
        .select("bare_pmid", *[F.col(f"_row.{c}").alias(c) for c in cols[1:]])
    )
    kept = store.select(*cols).join(latest.select("bare_pmid"), "bare_pmid", "left_anti")
    return kept.unionByName(latest)


#: Parts that a stored table is dealt to by the hash of its key.
PARTS = 256


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("bare_pmid"), F.lit(parts)).cast("int").alias("part")


def write_store(store: DataFrame, path: str, parts: int = PARTS) -> None:
    """A store as a table in ``parts`` parts by hash of the pmid, one file each."""
    rows = store.select(*STORE_COLUMNS, _part(parts))
    rows.repartition("part").write.mode("overwrite").partitionBy("part").parquet(path)


def read_store(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*STORE_COLUMNS)


def upsert_stored(spark, path: str, new: DataFrame, order_col: str | None = None, parts: int = PARTS) -> None:
    """S6 on a table of ``write_store`` (with the same ``parts``): only the parts that the
    batch falls into are read and rewritten; the files of all others stay."""
    new = materialize(new.select(*STORE_COLUMNS, *([order_col] if order_col else [])), "batch")
    touched = [r.part for r in new.select(_part(parts)).distinct().collect()]  # at most ``parts`` numbers
    old = spark.read.parquet(path).where(F.col("part").isin(touched))
    merged = upsert(old, new, order_col)
    replace_parts(merged.select(*STORE_COLUMNS, _part(parts)), path, "part")


def clear(store: DataFrame) -> DataFrame:
    """An empty store with the same schema."""
    return store.limit(0)


def failed_abstracts(store: DataFrame) -> DataFrame:
    """Rows with an error or a blank abstract; error text filled in, sorted by pmid."""
    bad = store.filter(
        F.col("error").isNotNull()
        | F.col("abstract").isNull()
        | (F.col("abstract") == "")
    )
    reason = F.when(F.col("error").isNotNull() & (F.col("error") != ""), F.col("error")).when(
        F.coalesce(py_strip(F.col("abstract")), F.lit("")) == "", F.lit(NO_ABSTRACT)
    )
    return (
        bad.select("bare_pmid", reason.alias("error"), "title")
        .filter(F.col("error").isNotNull())
        .orderBy("bare_pmid")
    )


def retryable(store: DataFrame, limit: int | None = None) -> DataFrame:
    """Pmids whose error is transient (``Extraction failed:%`` or not found)."""
    cond = F.lit(False)
    for pattern in RETRYABLE_LIKE:
        cond = cond | F.col("error").like(pattern)
    out = store.filter(cond).select("bare_pmid")
    if limit is not None:
        out = out.orderBy("bare_pmid").limit(limit)
    return out


def drop_pmids(store: DataFrame, ids: DataFrame) -> DataFrame:
    """Delete the rows of the given pmids (anti-join, then rewrite)."""
    return store.join(ids.select("bare_pmid").distinct(), "bare_pmid", "left_anti")


def wanted_pmids(triples: DataFrame, col: str = "PMID") -> DataFrame:
    """A3: distinct normalised pmids of the input, blanks removed."""
    raw = triples.select(F.col(col).cast("string").alias("_raw")).filter(
        F.col("_raw").isNotNull() & (py_strip(F.col("_raw")) != "")
    )
    return raw.select(normalize_pmid("_raw").alias("bare_pmid")).distinct()


def missing_abstracts(triples: DataFrame, store: DataFrame, force: bool = False) -> DataFrame:
    """Wanted pmids minus validly stored ones (all of them with ``force``)."""
    wanted = wanted_pmids(triples)
    if force:
        return wanted
    return wanted.join(valid_pmids(store), "bare_pmid", "left_anti")


def never_stored(triples: DataFrame, store: DataFrame) -> DataFrame:
    """Wanted pmids with no store row at all (normalised, see Q9)."""
    return wanted_pmids(triples).join(
        store.select("bare_pmid").distinct(), "bare_pmid", "left_anti"
    )


def store_counts(store: DataFrame) -> DataFrame:
    """One row of store counts."""
    return store.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("error").isNull()).alias("cached"),
        F.count_if(is_valid()).alias("valid"),
        F.count_if(F.col("error").isNotNull()).alias("with_error"),
    )


def ingest_stats(requested: DataFrame, store_before: DataFrame, store_after: DataFrame,
                 force: bool = False) -> DataFrame:
    """One row of ingest statistics for a set of requested pmids.

    ``requested`` has ``bare_pmid``; already stored = valid before the run,
    fetched = the rest (or all with ``force``), successful = valid after.
    """
    req = requested.select("bare_pmid").distinct()
    before = valid_pmids(store_before).withColumn("_before", F.lit(True))
    after = valid_pmids(store_after).withColumn("_after", F.lit(True))
    j = req.join(before, "bare_pmid", "left").join(after, "bare_pmid", "left")
    already = F.col("_before").isNotNull() & F.lit(not force)
    fetched = ~already
    return j.agg(
        F.count(F.lit(1)).alias("total_pmids"),
        F.count_if(already).alias("already_cached"),
        F.count_if(fetched).alias("newly_fetched"),
        F.count_if(fetched & F.col("_after").isNotNull()).alias("successful"),
        F.count_if(fetched & F.col("_after").isNull()).alias("failed"),
    ).withColumn(
        "success_rate",
        F.coalesce(F.try_divide(F.col("successful").cast("double"), F.col("newly_fetched")),
                   F.lit(0.0)),
    )
