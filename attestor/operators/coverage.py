"""Coverage audit (A15, X1-X3): is every input 4-key accounted for?

Instead of five set operations (five shuffles) every source is tagged, the
three tagged key streams are unioned and grouped once on the 4-key with
partial aggregation, and a final one-row aggregate reads the per-key counts.
No key set ever reaches the driver; only the (bounded) samples do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import KEY_COLUMNS

_SOURCES = ("input", "results", "no_abstract")


def _tag(df: DataFrame, source: str) -> DataFrame:
    flags = [F.lit(1 if s == source else 0).alias(f"n_{s}") for s in _SOURCES]
    return df.select(*[F.col(c).cast("string").alias(c) for c in KEY_COLUMNS], *flags)


def per_key(input_keys: DataFrame, results: DataFrame, no_abstract: DataFrame) -> DataFrame:
    """Row counts per 4-key in each of the three sources (one shuffle)."""
    tagged = (
        _tag(input_keys, "input")
        .unionByName(_tag(results, "results"))
        .unionByName(_tag(no_abstract, "no_abstract"))
    )
    return tagged.groupBy(*KEY_COLUMNS).agg(
        *[F.sum(f"n_{s}").alias(f"n_{s}") for s in _SOURCES]
    )


def per_key_flagged(flagged: DataFrame, flag: str = "has_abstract") -> DataFrame:
    """As ``per_key`` where results and no-abstract rows are the input rows with and without
    ``flag``: one pass over them, one shuffle."""
    has = F.col(flag).cast("int")
    return flagged.groupBy(*[F.col(c).cast("string").alias(c) for c in KEY_COLUMNS]).agg(
        F.count(F.lit(1)).alias("n_input"), F.sum(has).alias("n_results"),
        F.sum(1 - has).alias("n_no_abstract"))


def coverage(input_keys: DataFrame, results: DataFrame, no_abstract: DataFrame) -> DataFrame:
    """One row: totals, unique keys and duplicates per source, overlap,
    combined, extra, missing, matched, coverage percent, perfect flag."""
    return coverage_of(per_key(input_keys, results, no_abstract))


def coverage_of(k: DataFrame) -> DataFrame:
    """``coverage`` from the counts per key."""
    in_in = F.col("n_input") > 0
    in_res = F.col("n_results") > 0
    in_na = F.col("n_no_abstract") > 0
    in_any = in_res | in_na
    agg = k.agg(
        F.sum("n_input").cast("long").alias("input_rows"),
        F.count_if(in_in).alias("input_unique"),
        F.sum("n_results").cast("long").alias("results_rows"),
        F.count_if(in_res).alias("results_unique"),
        F.sum("n_no_abstract").cast("long").alias("no_abstract_rows"),
        F.count_if(in_na).alias("no_abstract_unique"),
        F.count_if(in_res & in_na).alias("overlap"),
        F.count_if(in_any).alias("combined_unique"),
        F.count_if(in_any & ~in_in).alias("in_results_not_input"),
        F.count_if(in_in & ~in_any).alias("in_input_not_results"),
        F.count_if(in_in & in_any).alias("matched"),
    )
    rows = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return agg.select(
        rows("input_rows").alias("input_rows"),
        "input_unique",
        (rows("input_rows") - F.col("input_unique")).alias("input_duplicates"),
        rows("results_rows").alias("results_rows"),
        "results_unique",
        (rows("results_rows") - F.col("results_unique")).alias("results_duplicates"),
        rows("no_abstract_rows").alias("no_abstract_rows"),
        "no_abstract_unique",
        (rows("no_abstract_rows") - F.col("no_abstract_unique")).alias("no_abstract_duplicates"),
        "overlap",
        "combined_unique",
        "in_results_not_input",
        "in_input_not_results",
        "matched",
        F.coalesce(
            F.round(F.try_divide(F.col("matched") * 100.0, F.col("input_unique")), 4),
            F.lit(0.0),
        ).alias("coverage_pct"),
        (
            (F.col("in_results_not_input") == 0)
            & (F.col("in_input_not_results") == 0)
            & (F.col("overlap") == 0)
        ).alias("perfect"),
    )


def coverage_samples(input_keys: DataFrame, results: DataFrame, no_abstract: DataFrame,
                     n: int = 10) -> tuple[DataFrame, DataFrame]:
    """Up to ``n`` missing and ``n`` extra keys, ordered by key for stability."""
    k = per_key(input_keys, results, no_abstract)
    in_any = (F.col("n_results") > 0) | (F.col("n_no_abstract") > 0)
    missing = k.filter((F.col("n_input") > 0) & ~in_any).select(*KEY_COLUMNS)
    extra = k.filter((F.col("n_input") == 0) & in_any).select(*KEY_COLUMNS)
    return missing.orderBy(*KEY_COLUMNS).limit(n), extra.orderBy(*KEY_COLUMNS).limit(n)
