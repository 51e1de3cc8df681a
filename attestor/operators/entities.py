"""Entities: node match (O2, J4, F6, F7), names (O3, F8, J5) and name columns
(F32, F33, J6).

Node files are huge and the wanted curies are comparatively few, so the node
scan is exploded to (curie, line) pairs and semi-joined against the targets
before anything is grouped; only survivors reach the shuffle on ``curie``.
They are written once, so the node files are scanned once (the stop line needs a second
look at the survivors). Lookups of the (small) entity table into triples are broadcast
below a size bound, a shuffle join above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import KEY_COLUMNS
from ..session import fits, materialize, small_side

ENTITY_INFO = "struct<name:string,category:string,description:string>"


def normalize_category(cat: Column) -> Column:
    """a string category, or the first element of a list (JSON text), or ''."""
    as_list = F.from_json(cat, "array<string>")
    return F.when(F.trim(cat).startswith("["), F.coalesce(F.get(as_list, 0), F.lit(""))) \
        .otherwise(F.coalesce(cat, F.lit("")))


def equivalent_ids(curies: Column, identifiers: Column) -> Column:
    """equivalent_curies if non-empty, else equivalent_identifiers, else []."""
    empty = F.array().cast("array<string>")
    return F.when(F.coalesce(F.size(curies), F.lit(0)) > 0, curies) \
        .when(F.coalesce(F.size(identifiers), F.lit(0)) > 0, identifiers) \
        .otherwise(empty)


def node_info(nodes: DataFrame) -> DataFrame:
    """Per node line: the info record the loader keeps."""
    name = F.coalesce(F.col("name"), F.lit(""))
    names = F.when(F.coalesce(F.size("all_names"), F.lit(0)) > 0, F.col("all_names")) \
        .when(name != "", F.array(name)) \
        .otherwise(F.array().cast("array<string>"))
    return nodes.select(
        "line",
        F.coalesce(F.col("id"), F.lit("")).alias("id"),
        equivalent_ids(F.col("equivalent_curies"), F.col("equivalent_identifiers")).alias("equiv"),
        name.alias("name"),
        normalize_category(F.col("category")).alias("category"),
        F.coalesce(F.col("description"), F.lit("")).alias("description"),
        names.alias("all_names"),
    )


def load_entities(nodes: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """``curie, name, category, description, all_names``.

    A node qualifies for each target among its id and equivalent ids; a later
    node overwrites an earlier one. The source loader stops scanning once every
    target has been found, so nodes after that line never overwrite (Q3):
    ``stop`` = the largest first-match line over targets when all are found,
    else no stop. Without targets only the node's own id counts.
    """
    info = node_info(nodes)
    if targets is None:
        hits = info.select(F.col("id").alias("curie"), "line", "name", "category",
                           "description", "all_names")
        return _winner(hits, None)
    t = materialize(targets.select("curie").distinct(), "targets")
    few = F.broadcast(t) if fits(t) else t
    pairs = info.select(
        F.explode(F.array_distinct(F.concat(F.array("id"), "equiv"))).alias("curie"),
        "line", "name", "category", "description", "all_names",
    )
    # the one scan of the nodes; all that follows reads the survivors
    hits = materialize(pairs.join(few, "curie", "left_semi"), "node-hits")
    first = hits.groupBy("curie").agg(F.min("line").alias("first"))
    n_targets = t.select(F.count(F.lit(1))).scalar()
    stop = first.select(
        F.when(F.count(F.lit(1)) == n_targets, F.max("first"))
    ).scalar()
    return _winner(hits, stop)


def _winner(hits: DataFrame, stop: Column | None) -> DataFrame:
    """Of each curie the row of the last line up to ``stop``."""
    kept = hits if stop is None else hits.filter(stop.isNull() | (F.col("line") <= stop))
    row = F.struct("name", "category", "description", "all_names")
    return kept.groupBy("curie").agg(F.max_by(row, "line").alias("r")).select(
        "curie", "r.name", "r.category", "r.description", "r.all_names"
    )


def answer_labels(answer: Column) -> Column:
    """F8: primary label then equivalent labels, empties dropped, lower-cased,
    first-seen order, unique; a null answer gives []."""
    primary = F.array(answer.getField("id").getField("label"))
    eq = F.transform(
        F.coalesce(answer.getField("equivalent_identifiers"),
                   F.array().cast("array<struct<label:string>>")),
        lambda e: e.getField("label"),
    )
    labels = F.filter(F.concat(primary, eq), lambda x: x.isNotNull() & (x != ""))
    return F.when(answer.isNull(), F.array().cast("array<string>")) \
        .otherwise(F.array_distinct(F.transform(labels, lambda x: F.lower(x))))


def collect_names(curies: DataFrame, answers: DataFrame) -> DataFrame:
    """O3 + S15: ``curie_id, all_names`` for every requested curie; curies
    without an answer get [] (one left join, no driver round trip)."""
    a = answers.select(F.col("curie").alias("curie_id"), answer_labels(F.col("answer")).alias("n"))
    return curies.select(F.col("curie").alias("curie_id")).distinct().join(
        a, "curie_id", "left"
    ).select("curie_id", F.coalesce("n", F.array().cast("array<string>")).alias("all_names"))


def merge_names(entities: DataFrame, names: DataFrame) -> DataFrame:
    """A non-empty names list replaces ``all_names`` of a loaded curie
    (per curie, see Q2); names for unknown curies are ignored. Of several lists for one
    curie the one with the largest ``line`` (the place in the file, as ``read_names_tsv``
    gives it) wins; without such a column the largest list, so that every run takes the same."""
    order = "line" if "line" in names.columns else "all_names"
    n = names.filter(F.size("all_names") > 0).groupBy(F.col("curie_id").alias("curie")).agg(
        F.max_by("all_names", order).alias("_n"))
    return entities.join(n, "curie", "left").select(
        "curie", "name", "category", "description",
        F.coalesce("_n", "all_names").alias("all_names"),
    )


def unique_curies(triples: DataFrame) -> DataFrame:
    """A2: distinct non-null subject and object curies."""
    s = triples.select(F.col("subject_curie").alias("curie"))
    o = triples.select(F.col("object_curie").alias("curie"))
    return s.union(o).filter(F.col("curie").isNotNull()).distinct()


def _looked_up(entities: DataFrame, side: str, given: bool) -> DataFrame:
    """The entity table as it is joined to one side of the triples, with the rendered prompt
    section unless the triples have names of their own (``given``)."""
    from ..functions.prompt import entity_section

    info = F.struct("name", "category", "description")
    names = F.when(F.coalesce(F.size("all_names"), F.lit(0)) > 0, F.col("all_names")) \
        .otherwise(F.array(F.col("curie")))
    cols = [F.col("curie").alias(f"{side}_curie"), info.alias(f"{side}_info"),
            F.col("all_names").alias(f"_{side}_all")]
    if not given:
        cols.append(entity_section(side.capitalize(), F.col("curie"), info, names).alias(f"_{side}_section"))
    return entities.select(*cols)


def with_entities(triples: DataFrame, entities: DataFrame | None) -> DataFrame:
    """Name columns plus the info and names used by the prompt.

    Adds ``subject_name`` / ``object_name`` ('' when unknown), ``subject`` /
    ``object`` display values (given value else curie), ``subject_info`` /
    ``object_info`` structs (null when unknown) and ``subject_names`` /
    ``object_names`` (entity names, else ``[subject]``). When the display value
    is the curie itself (no given name column), the prompt section of each
    entity is rendered once in the entity table (``_subject_section``) instead
    of once per row.
    """
    out = triples
    tables = {}
    if entities is not None:  # written once for both sides
        entities, small = small_side(entities.select("curie", "name", "category", "description", "all_names"))
        tables = {side: _looked_up(entities, side, side in triples.columns) for side in ("subject", "object")}
        # what is broadcast are the tables of both sides, with the rendered texts
        small = small and fits(*tables.values())
    for side in ("subject", "object"):
        given = F.col(side) if side in triples.columns else F.lit(None).cast("string")
        disp = F.coalesce(F.when(given != "", given), F.col(f"{side}_curie"))
        if entities is None:
            out = out.withColumns({
                f"{side}_name": F.lit(""),
                f"_{side}_display": disp,
                f"{side}_info": F.lit(None).cast(ENTITY_INFO),
                f"{side}_names": F.array(disp),
            })
            continue
        # rows that carry sections are not sorted; of the entities a task holds its partition
        e = F.broadcast(tables[side]) if small else tables[side].hint("shuffle_hash")
        out = out.join(e, f"{side}_curie", "left").withColumns({
            f"{side}_name": F.coalesce(F.col(f"{side}_info.name"), F.lit("")),
            f"_{side}_display": disp,
            f"{side}_names": F.when(F.coalesce(F.size(f"_{side}_all"), F.lit(0)) > 0,
                                    F.col(f"_{side}_all")).otherwise(F.array(disp)),
        }).drop(f"_{side}_all")
    return out


def named(columns: list[str]) -> list[str]:
    """``columns`` with each name column right after its curie column."""
    order: list[str] = []
    for c in columns:
        if c in ("subject_name", "object_name"):
            continue
        order.append(c)
        if c in ("subject_curie", "object_curie"):
            order.append(c.replace("_curie", "_name"))
    return order


def named_columns(triples: DataFrame, entities: DataFrame) -> DataFrame:
    """F32: the input columns with ``subject_name`` right after ``subject_curie``
    and ``object_name`` right after ``object_curie``."""
    cols = [c for c in triples.columns if c not in ("subject_name", "object_name")]
    return with_entities(triples.select(*cols), entities).select(*named(cols))


__all__ = [
    "KEY_COLUMNS", "load_entities", "collect_names", "merge_names",
    "unique_curies", "with_entities", "named", "named_columns", "answer_labels",
]
