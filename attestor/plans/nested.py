"""Nested fixture shapes built from the flat fixture views.

KGX edge records, node records, name-service answers: the JSON shapes the
source pipeline reads, assembled with built-in array/map/struct functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import packed, unpacked
from ..operators.store import is_valid
from .fixtures import fixture

STRS = "array<string>"


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node records: line, id, name, category (text or JSON list), description,
    equivalent_curies / equivalent_identifiers, all_names."""
    r = fixture(spark, sf_dir, "node_rows")
    eq = F.filter(F.array("eq1", "eq2"), lambda x: x.isNotNull())
    return r.select(
        "line", "id", "name", "category", "description",
        F.when(F.col("kg2"), eq).alias("equivalent_curies"),
        F.when(~F.col("kg2"), eq).alias("equivalent_identifiers"),
        F.when(F.col("an1").isNotNull(), F.array("an1", "an2")).alias("all_names"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name-service answers: curie, answer struct (null when unresolvable)."""
    r = fixture(spark, sf_dir, "answer_rows")
    eq = F.filter(
        F.array(*[F.struct(F.col(f"l{i}").alias("label")) for i in range(1, 5)]),
        lambda e: e.getField("label").isNotNull(),
    )
    ans = F.struct(F.struct(F.col("l0").alias("label")).alias("id"),
                   eq.alias("equivalent_identifiers"))
    return r.select("curie", F.when(F.col("answered"), ans).alias("answer"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KGX edge records with a position column ``_pos`` (file order)."""
    r = fixture(spark, sf_dir, "edge_rows")
    results = F.array(
        F.struct(F.array("PMID", F.lit("PMID:0")).alias("xref"),
                 F.array("text_a").alias("supporting_text")),
        F.struct(F.array("PMID").alias("xref"),
                 F.array("text_b", F.lit("second text is ignored")).alias("supporting_text")),
    )
    studies = F.create_map(F.lit("semmeddb"), F.struct(results.alias("has_study_results")))
    legacy = F.create_map(F.col("PMID"), F.struct(F.col("text_legacy").alias("sentence")))
    return r.select(
        "subject", "predicate", "object",
        F.array("PMID").alias("publications"),
        F.when(F.col("has_studies"), studies).alias("has_supporting_studies"),
        F.when(F.col("has_legacy"), legacy).alias("publications_info"),
        F.col("line_id").alias("_pos"),
    )


# ---------------------------------------------------------------- responses

# Fixed fixture texts (the recorded model answers are assembled from these).
INVENTED = "Zorblax quintessence modulates the hyperflux"
QUOTE_EXCLUDE = '[\\\\"{}`\\[\\]]'
QUOTE_WORDS = "(?i)true|false|null"
N_FORMS = 11


def first_quote(abstract):
    """The first '.'-sentence of the abstract that a JSON answer can carry
    unchanged through the repair step (no quotes, braces, brackets, backslash,
    backtick or true/false/null words)."""
    parts = F.transform(F.split(abstract, "\\."), lambda s: F.regexp_replace(
        s, "(?U)^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$", ""))
    ok = F.filter(parts, lambda s: (s != "") & ~s.rlike(QUOTE_EXCLUDE) & ~s.rlike(QUOTE_WORDS))
    return F.get(ok, 0)


def _json(**fields):
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def responses(prompts: DataFrame, store: DataFrame) -> DataFrame:
    """Recorded answers for rounds 1 and 2, one per distinct prompt (packed keys, too), in eleven
    shapes chosen by key arithmetic (think + fence, bare, single quotes, legacy,
    broken, empty, scorer error, yes without quotes, no with quotes, prose
    around capitalised literals, non-object JSON)."""
    key = F.col("prompt_key") if dict(prompts.dtypes)["prompt_key"] == "binary" else packed("prompt_key")
    p = prompts.select(key.alias("prompt_key"), "subject_curie", "object_curie", "bare_pmid",
                       "abstract_len", "est_tokens").dropDuplicates(["prompt_key"])
    # the quote is a property of the document: computed once per abstract
    quotes = store.filter(is_valid()).select("bare_pmid", first_quote(F.col("abstract")).alias("q"))
    p = p.join(quotes, "bare_pmid", "left")
    supp = F.substring("subject_curie", 6, 1 << 30).cast("long")
    part = F.substring("object_curie", 6, 1 << 30).cast("long")
    # only prompt-determined values choose the shape: copies of a document
    # under two PMIDs give one prompt, hence one recorded answer
    n = F.col("abstract_len")
    p = p.select("*",
                 ((supp + 3 * part + 7 * n) % N_FORMS).alias("sel"),
                 ((supp + part + n) % 4).alias("sel2"),
                 ((n % 97).cast("double") / 10 + 1).alias("rt"))
    q = F.col("q")
    sel = F.when(q.isNull() & F.col("sel").isin(0, 3, 8, 9), F.lit(1)).otherwise(F.col("sel"))
    q_arr = F.array(q)
    q9 = F.when(q.rlike("^[ -~]+$"), F.upper(q)).otherwise(q)
    t, f = F.lit(True), F.lit(False)
    forms = {
        0: F.concat(F.lit("<think>Checking "), F.col("subject_curie"), F.lit(" against "),
                    F.col("object_curie"), F.lit(".</think>\n```json\n"),
                    _json(support=F.lit("yes"), sentences=q_arr, subject_mentioned=t,
                          object_mentioned=t, reasoning=F.lit("The abstract states it directly.")),
                    F.lit("\n```")),
        1: F.lit('{"support": "no", "sentences": [], "subject_mentioned": true, '
                 '"object_mentioned": false, "reasoning": "No relation is described."}'),
        2: F.lit("{'support': 'maybe', 'sentences': [], 'subject_mentioned': true, "
                 "'object_mentioned': true, 'reasoning': 'Only indirect evidence.'}"),
        3: _json(is_supported=t, evidence_category=F.lit("direct_support"),
                 supporting_sentence=q, subject_mentioned=F.lit("yes"),
                 object_mentioned=F.lit("no"), reasoning=F.lit("Legacy answer.")),
        4: F.lit('Result: {"support": "yes", "sentences": ["' + INVENTED + '"], '
                 '"subject_mentioned": true, "object_mentioned": false, "reasoning": "cut off'),
        5: F.lit("  \n "),
        6: F.lit(None).cast("string"),
        7: F.lit('{"support": "YES ", "sentences": [], "subject_mentioned": false, '
                 '"object_mentioned": true, "reasoning": "Stated but not quoted."}'),
        8: _json(support=F.lit("no"), sentences=q_arr, subject_mentioned=f, object_mentioned=f,
                 reasoning=F.lit("Contradicted.")),
        9: F.concat(F.lit('Here is my answer: {"support": "yes", "sentences": '),
                    F.to_json(F.array(q9)),
                    F.lit(', "subject_mentioned": True, "object_mentioned": False, '
                          '"reasoning": "Direct statement."} Thanks.')),
        10: F.lit('```json\n["yes"]\n```'),
    }
    content1 = F.lit(None).cast("string")
    for k in sorted(forms, reverse=True):
        content1 = F.when(sel == k, forms[k]).otherwise(content1)
    empty = F.array().cast("array<string>")
    forms2 = {
        0: _json(support=F.lit("yes"), sentences=F.when(q.isNull(), empty).otherwise(q_arr),
                 subject_mentioned=t, object_mentioned=t,
                 reasoning=F.lit("Confirmed in round two.")),
        1: F.lit('{"support": "no", "sentences": [], "subject_mentioned": false, '
                 '"object_mentioned": false, "reasoning": "Rejected in round two."}'),
        2: F.lit(None).cast("string"),
        3: _json(support=F.lit("maybe"), sentences=F.array(F.lit(INVENTED)), subject_mentioned=f,
                 object_mentioned=t, reasoning=F.lit("Unsure.")),
    }
    content2 = F.lit(None).cast("string")
    for k in sorted(forms2, reverse=True):
        content2 = F.when(F.col("sel2") == k, forms2[k]).otherwise(content2)

    def shape(rnd, content, error):
        return F.struct(
            F.lit(rnd).alias("round"), F.lit(f"fixture-r{rnd}").alias("model"),
            F.col(content).alias("content"), error.alias("error"),
            F.floor(F.coalesce(F.length(content), F.lit(0)) / 4).cast("long")
            .alias("completion_tokens"),
        )

    # both rounds of a prompt from one row: prompts are made and shuffled once
    rounds = F.array(shape(1, "content1", F.when(F.col("sel1") == 6, F.lit("timeout"))),
                     shape(2, "content2", F.when(F.col("sel2") == 2, F.lit("rate limited"))))
    made = p.select("*", sel.alias("sel1"), content1.alias("content1"), content2.alias("content2"))
    return made.select(
        unpacked("prompt_key").alias("prompt_key"), F.col("rt").alias("runtime_seconds"), F.col("est_tokens").alias("prompt_tokens"),
        F.explode(rounds).alias("r")).select(
        "prompt_key", "r.round", "r.model", "r.content", "r.error", "runtime_seconds", "prompt_tokens",
        "r.completion_tokens")


# ---------------------------------------------------------------- article XML


def _xml_escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One XML answer per document: the title's first word in inline markup,
    one AbstractText per line (labelled on even ids), no abstract every 13th."""
    d = fixture(spark, sf_dir, "xml_rows")
    title = F.regexp_replace(_xml_escape(F.col("title")), "^(\\S+)", "<i>$1</i>")
    paras = F.transform(F.split(F.col("text"), "\n"), lambda p, i: F.concat(
        F.lit("<AbstractText"),
        F.when(F.col("labelled"), F.concat(F.lit(' Label="P'), (i + 1).cast("string"), F.lit('"')))
        .otherwise(F.lit("")),
        F.lit(">"), _xml_escape(p), F.lit("</AbstractText>")))
    body = F.when(F.col("has_abstract"),
                  F.concat(F.lit("<Abstract>"), F.array_join(paras, ""), F.lit("</Abstract>"))) \
        .otherwise(F.lit(""))
    xml = F.concat(
        F.lit("<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>"),
        F.col("bare_pmid"), F.lit("</PMID><Article><ArticleTitle>"), title,
        F.lit("</ArticleTitle>"), body,
        F.lit("</Article></MedlineCitation></PubmedArticle></PubmedArticleSet>"))
    return d.select(xml.alias("xml"))
