"""The registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, dart, decontam, fim, langid, line_dedup, packing, quality, search, substring, suffix, url_filter, winnow


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: host, path and verdict of the rules; the longest that fits wins.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Host labels that the filter blocks where none of those rules fits.
URL_LABELS = ["spam-farm", "casino", "tracker", "adserver"]


def op1_substring(spark, sf_dir):
    return substring.dedup_substrings(table(spark, sf_dir, "documents"), texts=False).drop("spans")


def op2_line_dedup(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def _tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op3_bpe(spark, sf_dir):
    return bpe.token_digests(table(spark, sf_dir, "documents"), *_tokenizer())


def op5_language(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op9_winnow(spark, sf_dir):
    return winnow.edited_report(table(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), *_tokenizer())


def op4_decontam(spark, sf_dir):
    out = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.drop("hit")


def op6_suffix(spark, sf_dir):
    return suffix.dedup_bytes(table(spark, sf_dir, "documents"), texts=False).drop("spans")


def op7_dart(spark, sf_dir):
    return dart.near_duplicates(table(spark, sf_dir, "documents"))


def op8_url_filter(spark, sf_dir):
    rules = [url_filter.host_rule(*r) for r in URL_RULES]
    rules += [url_filter.label_rule(x, "block") for x in URL_LABELS]
    out = url_filter.url_filter(table(spark, sf_dir, "pages"), url_filter.rules_frame(spark, rules))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op11_fim(spark, sf_dir):
    return fim.digests(table(spark, sf_dir, "documents"))


def op12_quality(spark, sf_dir):
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_search(spark, sf_dir):
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark, sf_dir):
    import corpus_pipeline  # at the top of the repository; it imports the operators

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_substring, op2_line_dedup, op3_bpe, op4_decontam, op5_language, op6_suffix,
    op7_dart, op8_url_filter, op9_winnow, op10_packing, op11_fim, op12_quality, op13_search, pipeline)}
