"""Label binarisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import py_strip

# Fixed values that must match the source pipeline, per mode.
TRUE_WORDS = {"strict": ("true", "yes"), "eval_script": ("true",), "lenient": ("true", "1", "yes")}
FALSE_WORDS = {"strict": ("false", "no"), "eval_script": ("false",)}


def binarize(col: Column, mode: str = "strict") -> Column:
    """1 / 0 / null (unknown) for a label column.

    ``strict``: true/yes -> 1, false/no -> 0, anything else unknown.
    ``eval_script``: only true/false are known.
    ``lenient``: true/1/yes -> 1, everything else 0.
    """
    if mode not in TRUE_WORDS:
        raise ValueError(f"unknown label mode {mode!r}")
    v = F.lower(py_strip(col.cast("string")))
    one = F.when(v.isin(*TRUE_WORDS[mode]), F.lit(1))
    if mode == "lenient":
        return one.otherwise(F.lit(0))
    return one.when(v.isin(*FALSE_WORDS[mode]), F.lit(0))
