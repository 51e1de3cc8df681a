"""URL filter: pattern rules indexed by their rarest literal token.

Every rule names literal tokens that any URL it fits must contain. The rarest of
them, counted over all URLs, becomes the rule's one index entry; a URL's tokens
fetch candidate rules from the index and only those run their regular expression.
The rule table is broadcast if its measured size is within ``BROADCAST_BYTES`` and
joined by a shuffle on the token otherwise; both give the same rows.

Defined results: a null URL, or one without ``://``, has an empty host and path, so
it fits no rule and gets the default verdict; a rule without a literal token is a
candidate of every URL; of several fitting rules the highest ``weight`` wins, ties
by rule text. Repeated rows are judged each for themselves; an empty table gives
none. Other columns are kept; of those that clash with a result the result stands.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name

BROADCAST_BYTES = 32 << 20
TOKEN = r"[^\p{L}\p{N}]+"
RULE_SCHEMA = ("rule string, verdict string, pattern string, tokens array<string>, "
               "weight int, named boolean")


def split_url(url):
    """(host, path) of a URL column; both empty if it has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def literal_tokens(text: str) -> list[str]:
    return [x for x in re.split(r"[\W_]+", text.lower()) if x]


def host_rule(host: str, path: str, verdict: str) -> tuple:
    """Fits ``host`` and its subdomains where the path starts with ``path``. The last
    path segment counts as a token only if a ``/`` closes it."""
    whole = path[:path.rfind("/") + 1]
    return (host + path, verdict, rf"\A(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}",
            literal_tokens(host) + literal_tokens(whole), len(host + path), True)


def label_rule(label: str, verdict: str) -> tuple:
    """A rule of the method's own: fits where a host label is ``label``. It weighs less
    than any host rule and is not shown as one."""
    return (label, verdict, rf"\A(?:[^/]*\.)?{re.escape(label)}(?:\.|/|\z)",
            literal_tokens(label), 0, False)


def rules_frame(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rules, RULE_SCHEMA)


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow",
               url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the winning named rule, else null) and
    ``verdict``. ``rules`` has the columns of ``RULE_SCHEMA``."""
    host, path = split_url(F.col(url_col))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    site = F.struct(host.alias("host"), path.alias("path"))
    s, rid, won = (free_name(pages, x) for x in ("_site", "_row", "_best"))
    rows = pages.select(*kept, site.alias(s))
    text = F.concat(F.col(f"{s}.host"), F.col(f"{s}.path"))
    tokens = F.array_distinct(F.concat(F.split(F.lower(text), TOKEN), F.array(F.lit(""))))

    index = rules.withColumn("token", F.explode(
        F.when(F.size("tokens") > 0, F.array_distinct("tokens")).otherwise(F.array(F.lit("")))))
    index, bound = _bounded(index)
    # how often the tokens that rules name occur; '' stands for "every URL"
    seen = rows.select(F.explode(tokens).alias("token"))
    seen = seen.join(bound(index.select("token").distinct()), "token", "left_semi")
    counts = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (index.join(counts, "token", "left")
              .groupBy("rule", "verdict", "pattern", "weight", "named")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("x"))
              .select(F.col("x.token").alias("token"),
                      F.struct("weight", "rule", "verdict", "pattern", "named").alias("r")))

    # one row per distinct site, so a site on a third of all pages is judged once
    sites = rows.select(s).distinct()
    sites = sites.select(s, text.alias("_text"), F.explode(tokens).alias("token"))
    hits = sites.join(bound(rarest), "token").where(F.expr("rlike(_text, r.pattern)"))
    best = hits.groupBy(s).agg(F.max(F.struct(
        "r.weight", "r.rule", "r.verdict", "r.named")).alias(won))
    best = best.withColumnRenamed(s, rid)
    out = rows.join(best, F.col(s) == F.col(rid), "left")
    return out.select(
        *kept, F.col(f"{s}.host").alias("host"), F.col(f"{s}.path").alias("path"),
        F.when(F.col(f"{won}.named"), F.col(f"{won}.rule")).alias("rule"),
        F.coalesce(f"{won}.verdict", F.lit(default)).alias("verdict"))


def _bounded(index: DataFrame):
    """The rule index, and the hint its measured size allows."""
    size = index.agg(F.sum(F.length("pattern") + F.length("token") + 64)).first()[0] or 0
    return index, F.broadcast if size <= BROADCAST_BYTES else (lambda df: df)
