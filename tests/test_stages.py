"""Stages of the evaluation: packed keys, tables in buckets, both rounds in one pass."""

import hashlib

from pyspark.sql import functions as F

from attestor.functions.keys import packed, unpacked
from attestor.operators import score
from attestor.operators.hot import hot_join
from attestor.session import materialize_by, write_stage
from attestor.sources.sinks import as_text


def _sha(i) -> str:
    return hashlib.sha256(str(i).encode()).hexdigest()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_packed_keys_are_short_and_come_back(spark):
    keys = [_sha(1), _sha(1).upper(), "z" * 64, "p1", "", "\x00" * 31, "é" * 16, None]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select(
        "k", packed("k").alias("p"), unpacked(packed("k")).alias("again")).collect()
    assert [r.again for r in rows] == keys
    assert len(rows[0].p) == 32 and all(len(r.p) > 32 for r in rows[1:-1])
    assert len({bytes(r.p) for r in rows[:-1]}) == len(keys) - 1


def test_tables_by_key_are_not_shuffled_again(spark):
    a = spark.range(1000).select(packed(F.sha2(F.col("id").cast("string"), 256)).alias("k"), "id")
    stored = materialize_by(a, "k", "test")
    assert not [t for t in spark.catalog.listTables() if "attestor_test" in t.name]  # known only while looked up
    assert sorted(r.id for r in stored.collect()) == list(range(1000))
    files = stored.inputFiles()
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "Exchange" not in _plan(stored.groupBy("k").agg(F.max("id")))
    joined = stored.hint("merge").join(materialize_by(a, "k", "test"), "k")
    assert "Exchange" not in _plan(joined) and joined.count() == 1000


def test_stages_are_compressed_well(spark):
    path = write_stage(spark.range(10).withColumn("x", F.lit("y")), "test")
    assert all("zstd" in f for f in spark.read.parquet(path).inputFiles())


def test_both_rounds_are_replayed_in_one_pass(spark):
    rows = [(_sha(k), n, f"{c}{k}", None, 1.0) for k in range(20) for n in (1, 2) for c in "ab" if (k + n) % 3]
    r = spark.createDataFrame(rows, "prompt_key string, round int, content string, error string, runtime_seconds double")
    got = score.replay_rounds(r)
    assert _plan(got).count("Exchange hashpartitioning") == 1
    found = {(x.prompt_key, n): x[f"r{n}"].content for x in got.withColumn("prompt_key", unpacked("prompt_key")).collect()
             for n in (1, 2) if x[f"r{n}"] is not None}
    expected = {(x.prompt_key, n): x.content for n in (1, 2) for x in score.replay(r, n).collect()}
    assert found == expected and len(found) == len({x[:2] for x in rows})


def test_hot_join_on_packed_keys(spark):
    key = packed(F.sha2((F.col("id") % 10_000).cast("string"), 256))
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, packed(F.lit(_sha("hot")))).otherwise(key).alias("k"), "id")
    other = rows.select("k").distinct().withColumn("v", F.hex("k"))
    got = hot_join(rows, other, "k")
    assert "Union" in _plan(got)  # the hot key was split off
    assert got.where(F.hex("k") == F.col("v")).count() == 20_000


def test_text_form_leaves_numbers_alone_and_cleans_text(spark):
    df = spark.createDataFrame([("a\r\nb\rc\td\"e", 1.5, 7, True), (None, None, None, None)],
                               "s string, d double, n long, b boolean")
    text = as_text(df)
    assert [tuple(r) for r in text.collect()] == [("a b c d'e", "1.5", "7", "True"), ("None",) * 4]
    plan = _plan(text)
    assert plan.count("translate(") == 1 and "regexp_replace" not in plan


def test_edge_records_are_written_compressed(spark, monkeypatch):
    from attestor.plans import queries

    seen = []
    read = queries.edges_op.read_edges
    monkeypatch.setattr(queries.edges_op, "read_edges", lambda s, path: seen.extend(
        s.read.text(path).inputFiles()) or read(s, path))
    assert queries.QUERIES["edges_file"](spark, "/root/testdata/sf0.001").count() > 0
    assert seen and all(f.endswith(".json.gz") for f in seen)
