"""Article XML ingest (S8): stored literature-service answers -> store rows.

Spark's XML source separates mixed content (text around inline markup), so a task reads
each answer as a stream of parser events and emits what it finds as they end: ids, titles
and abstract parts. Spark puts the rows together: the last article of an id wins, ids that
were asked for and not answered become "not found" rows, and an answer that is no XML
becomes an "Extraction failed" row for each id of its request.
"""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import normalize_pmid, py_strip

# Fixed values that must match the source pipeline.
NO_ABSTRACT = "No abstract available"
NOT_FOUND = "PMID not found or could not be retrieved"
FAILED = "Extraction failed: {}"
ARTICLE, PMID, TITLE, PART, LABEL = "PubmedArticle", "PMID", "ArticleTitle", "AbstractText", "Label"

EVENTS = "request string, doc long, article int, tag string, label string, body string"


def article_events(xml_text: str) -> Iterator[tuple[int, str, str, str]]:
    """(article number, tag, label, inner text) of each element of interest, as it ends. An
    element outside any article is not of interest."""
    article, open_articles = -1, 0
    for event, element in ET.iterparse(io.StringIO(xml_text), events=("start", "end")):
        if element.tag == ARTICLE:
            open_articles += 1 if event == "start" else -1
            article += event == "start"
            if event == "end":
                element.clear()
        elif event == "end" and open_articles and element.tag in (PMID, TITLE, PART):
            yield article, element.tag, element.get(LABEL, ""), "".join(
                element.itertext() if element.tag != PMID else [element.text or ""])


def _events(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for request, doc, text in zip(pdf["request"], pdf["doc"], pdf["xml"]):
            try:
                rows += [(request, doc, *e) for e in article_events(text)]
            except ET.ParseError as e:
                # what was read before the fault does not count
                rows = [r for r in rows if r[1] != doc]
                rows.append((request, doc, -1, "", "", str(e)))
        yield pd.DataFrame(rows, columns=["request", "doc", "article", "tag", "label", "body"])


def _stamp(fetch_date: str | None):
    return F.lit(fetch_date) if fetch_date else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")


def parsed_articles(xml_docs: DataFrame, request: str | None = None, order: str | None = None):
    """(articles, faults): bare_pmid, title, abstract, error of each id's last article, by
    ``order`` of the answers and place in them; request and message of bad answers."""
    docs = xml_docs.where(F.col("xml").isNotNull()).select(
        (F.col(request).cast("string") if request else F.lit(None).cast("string")).alias("request"),
        (F.col(order).cast("long") if order else F.monotonically_increasing_id()).alias("doc"), "xml")
    # one row per element, numbered as read, so that parts keep their order
    events = docs.mapInPandas(_events, EVENTS).withColumn("n", F.monotonically_increasing_id())
    faults = events.where("article < 0").select("request", F.col("body").alias("message"))
    text = py_strip("body")
    part = F.when((F.col("tag") == PART) & (text != ""), F.struct(
        "n", F.when(F.col("label") != "", F.concat("label", F.lit(": "), text)).otherwise(text).alias("x")))

    def first(tag: str):
        return F.min_by(text, F.when(F.col("tag") == tag, F.col("n")))

    whole = events.where("article >= 0").groupBy("doc", "article").agg(
        first(PMID).alias("bare_pmid"), F.coalesce(first(TITLE), F.lit("")).alias("title"),
        F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["x"]), " ").alias("abstract"))
    last = whole.where(F.col("bare_pmid") != "").groupBy("bare_pmid").agg(
        F.max_by(F.struct("title", "abstract"), F.struct("doc", "article")).alias("a"))
    return last.select("bare_pmid", "a.title", "a.abstract",
                       F.when(F.col("a.abstract") == "", NO_ABSTRACT).alias("error")), faults


def ingest_articles(xml_docs: DataFrame, requested: DataFrame | None = None, fetch_date: str | None = None,
                    request: str | None = None, order: str | None = None) -> DataFrame:
    """Store rows from XML answers (column ``xml``); with ``requested`` (``bare_pmid``),
    unseen ids are added: as failed if the answer to their ``request`` (a column of both
    tables, if given) is no XML, else as not found. ``order`` numbers the answers; the
    last article of an id wins."""
    rows, faults = parsed_articles(xml_docs, request, order)
    if requested is not None:
        own = F.col(request).cast("string") if request else F.lit(None).cast("string")
        asked = requested.select(normalize_pmid("bare_pmid").alias("bare_pmid"), own.alias("request"))
        why = faults.groupBy("request").agg(F.min("message").alias("message"))
        unseen = asked.join(rows.select("bare_pmid"), "bare_pmid", "left_anti").join(why, "request", "left")
        unseen = unseen.groupBy("bare_pmid").agg(F.min("message").alias("message")).select(
            "bare_pmid", F.lit("").alias("title"), F.lit("").alias("abstract"),
            F.when(F.col("message").isNull(), NOT_FOUND)
            .otherwise(F.concat(F.lit(FAILED.format("")), "message")).alias("error"))
        rows = rows.unionByName(unseen)
    return rows.select("bare_pmid", "title", "abstract", _stamp(fetch_date).alias("fetch_date"), "error")


def failed_batch(requested: DataFrame, message: str, fetch_date: str | None = None) -> DataFrame:
    """Rows for a request batch whose call failed: ``Extraction failed: ...``."""
    return requested.select(
        normalize_pmid("bare_pmid").alias("bare_pmid"), F.lit("").alias("title"),
        F.lit("").alias("abstract"), _stamp(fetch_date).alias("fetch_date"),
        F.lit(FAILED.format(message)).alias("error"))
