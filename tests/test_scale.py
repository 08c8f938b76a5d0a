"""Plans and layouts that keep a step's memory and disk in step with its input."""

from __future__ import annotations

from pyspark.sql import functions as F

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_long_documents_are_read_a_row_at_a_time(spark):
    from flowmetrics.registry import REGISTRY
    from flowmetrics.sources.store import materialize_lines
    rows = [('{"a": "x\\ny\\"z"}',), (None,), ("x" * 300_000,)]
    back = materialize_lines(spark.createDataFrame(rows, "document string"), "lines")
    assert sorted(map(str, (r.document for r in back.collect()))) == sorted(str(r[0]) for r in rows)
    for name in ("page_explode", "link_ids"):
        plan = _plan(REGISTRY[name](spark, SF_SMALL))
        assert "FileScan text" in plan and "FileScan parquet" not in plan, name


def test_awkward_documents_come_from_the_first_batch_alone(spark):
    from flowmetrics.testdata.documents import awkward
    docs = spark.createDataFrame([("p", 0, "abcd"), ("p", 1, "efgh"), (None, 0, "ijkl")], "g string, batch int, document string")
    got = [(r.g, r.batch, r.document) for r in awkward(docs, "g", "-").collect()]
    extra = [(g, -1, d) for g, half in (("p", "ab"), (None, "ij")) for d in ("-", '{"value": null}', None, half)]
    assert sorted(map(str, got)) == sorted(map(str, [("p", 0, "abcd"), ("p", 1, "efgh"), (None, 0, "ijkl"), *extra]))
    assert "Aggregate" not in _plan(awkward(docs, "g", "-"))


def test_dealt_merge_equals_the_joined_one(spark, tmp_dir):
    from flowmetrics.operators.merge import merge_by_key, merge_dealt
    cur = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, None, "c"), (None, 1, "n"), (6, 1, None), (6, 2, "twice")],
                                "k int, rev int, v string")
    inc = spark.createDataFrame([(1, 4, "old"), (2, 5, "same"), (3, 1, None), (4, 1, "ins"), (None, 2, "m"), (6, 9, "z")], cur.schema)

    def deal(df):
        return df.withColumn("_b", F.pmod(F.hash("k"), F.lit(3))).repartition("_b")
    for cols, newer in ((None, None), (["v"], None), (None, ["rev"]), (["v"], ["rev"])):
        got = merge_dealt(cur, inc, ["k"], deal, ["_b"], cols, newer)
        assert _plan(got).count("Exchange") == 1
        want = merge_by_key(cur, inc, ["k"], cols, newer=newer)
        assert sorted(map(str, got.drop("_b").collect())) == sorted(map(str, want.collect())), (cols, newer)


def test_a_large_batch_is_written_once(spark, tmp_dir, monkeypatch):
    from flowmetrics.operators import merge as M
    from flowmetrics.sources import store as S
    monkeypatch.setattr(M, "SMALL_BATCH_ROWS", 10)
    written = []
    monkeypatch.setattr(S, "materialize", lambda df, name: written.append(name) or df)
    rows = lambda lo, hi, v: spark.range(lo, hi).select("id", F.lit(v).alias("v"))
    table = S.KeyedTable(spark, tmp_dir + "/t", rows(0, 1, "").schema, ["id"], 4)
    for lo, hi, v in ((0, 50, "a"), (0, 50, "b"), (20, 70, "c")):
        table.merge(rows(lo, hi, v), written=True)
    assert not written
    assert table.merge(rows(20, 70, "c"), written=True) == 4      # others stay: the buckets are written again
    whole = table.read().localCheckpoint()
    assert table.merge(whole, written=True) == 0                  # all of it is stored
    assert table.merge(whole.withColumn("v", F.when(F.col("id") != 7, F.col("v"))), written=True) == 4
    assert table.merge(whole, written=True) == 4
    assert {(r.v, r.n) for r in table.read().groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()} == {("b", 20), ("c", 50)}
