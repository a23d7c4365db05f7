import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from jobloom.operators.compare import differences
from jobloom.operators.latest import repeated_keys, winning_rows
from jobloom.operators.merge import fits_broadcast, merge
from jobloom.operators.publish import staged
from jobloom.schemas import INT, LONG, STRING, TIMESTAMP, shape

ROW = shape(k=INT, v=STRING)
EVENT = shape(k=INT, v=STRING, timestamp=TIMESTAMP, partition=INT, offset=LONG)
TARGET = [(1, "a"), (None, "tn")]
SOURCE = [(1, "A"), (None, "sn"), (2, None)]


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def events(spark, rows):
    """Rows (key, value, offset)."""
    return spark.createDataFrame([(k, v, None, 0, o) for k, v, o in rows], EVENT)


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("mode, expected", [
    ("update", [(1, "A"), (None, "tn"), (None, "sn"), (2, None)]),
    ("insert", [(1, "a"), (None, "tn"), (None, "sn"), (2, None)]),
])
def test_modes_and_null_keys(spark, tmp_path, mode, expected, small):
    """With and without the cut of the target's keys to those of a small source."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit if small else "-1")
    try:
        source = staged(spark.createDataFrame(SOURCE, ROW), str(tmp_path / "s"))
        assert fits_broadcast(source) is small
        got = merge(spark.createDataFrame(TARGET, ROW), source, ["k"], mode)
        assert bag(got) == sorted(expected, key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_matched_null_overwrites(spark):
    got = merge(spark.createDataFrame([(1, "a")], ROW), spark.createDataFrame([(1, None)], ROW),
                ["k"])
    assert bag(got) == [(1, None)]


def test_columns_match_by_name_and_all_target_rows_of_a_key_change(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], ROW)
    source = spark.createDataFrame([("x", 1)], "v string, k int")
    assert bag(merge(target, source, ["k"])) == [(1, "x"), (1, "x"), (2, "c")]
    with pytest.raises(ValueError, match="differ"):
        merge(target, source.withColumn("z", F.lit(1)), ["k"])


def test_later_event_wins_an_update_and_earlier_an_insert(spark):
    rows = events(spark, [(1, "x", 5), (1, "y", 7), (2, "z", 6), (None, "n", 5), (None, "n", 9)])
    last = winning_rows(rows, ["k"], "last").select("k", "v")
    assert bag(last) == sorted([(1, "y"), (2, "z"), (None, "n"), (None, "n")], key=repr)
    first = winning_rows(rows, ["k"], "first").select("k", "v")
    assert bag(first) == sorted([(1, "x"), (2, "z"), (None, "n"), (None, "n")], key=repr)


def test_rows_of_one_event_tie(spark):
    rows = events(spark, [(1, "x", 5), (1, "y", 5), (1, "z", 4)])
    assert bag(winning_rows(rows, ["k"]).select("v")) == [("x",), ("y",)]


def test_one_row_of_an_event_without_ties(spark):
    rows = events(spark, [(1, "x", 5), (1, "x", 5), (1, "z", 4), (2, "y", 1)])
    assert bag(winning_rows(rows, ["k"], ties=False).select("k", "v")) == [(1, "x"), (2, "y")]


def test_repeated_keys_pass_over_nulls(spark):
    rows = events(spark, [(1, "x", 5), (1, "y", 5), (1, "z", 4), (None, "a", 5), (None, "b", 5)])
    assert bag(repeated_keys(rows, ["offset"], ["k"])) == [(5, 1, 2)]


def test_hot_key_is_cut_down_before_the_exchange(spark):
    df = winning_rows(events(spark, []), ["k"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below


def test_large_target_is_not_exchanged_for_a_small_source(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20000).selectExpr("cast(id as int) k", "cast(id as string) v").write.parquet(path)
    target = spark.read.parquet(path)
    source = staged(spark.createDataFrame(SOURCE, ROW), str(tmp_path / "s"))
    df = merge(target, source, ["k"])
    assert df.count() == 20000 + 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_hot_target_key_is_split(spark, tmp_path):
    """A third of the target has one key; the join of a large source still splits it."""
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        path = str(tmp_path / "t")
        (spark.range(0, 60000, 1, 8)
         .selectExpr("cast(case when id % 3 = 0 then 7 else id end as int) k", "uuid() v")
         .write.parquet(path))
        target = spark.read.parquet(path)
        source = spark.range(50000, 70000).selectExpr("cast(id as int) k", "'new' v")
        df = merge(target, source, ["k"])
        new = df.filter("v = 'new'").count()
        assert df.collect() and new == 20000
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sequential(target, batches, mode):
    """What one merge per event gives; batches are lists of (key, value), keys unique."""
    rows = list(target)
    for batch in batches:
        known = {k for k, _ in rows if k is not None}
        new = dict((k, v) for k, v in batch if k is not None)
        if mode == "update":
            rows = [(k, new.get(k, v)) if k in new else (k, v) for k, v in rows]
        rows += [(k, v) for k, v in batch if k is None or k not in known]
    return rows


KEY = st.one_of(st.none(), st.integers(0, 4))
BATCH = st.lists(st.tuples(KEY, st.sampled_from(["p", "q", "r", None])), max_size=4,
                 unique_by=lambda r: r[0] if r[0] is not None else object())


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(st.tuples(st.integers(0, 6), st.just("t")), max_size=4,
                       unique_by=lambda r: r[0]),
       batches=st.lists(BATCH, max_size=4), mode=st.sampled_from(["update", "insert"]),
       seed=st.integers(0, 99))
def test_a_batch_equals_its_events_one_by_one(spark, target, batches, mode, seed):
    rows = [(k, v, i) for i, batch in enumerate(batches) for k, v in batch]
    random.Random(seed).shuffle(rows)
    keep = "last" if mode == "update" else "first"
    source = winning_rows(events(spark, rows), ["k"], keep).select("k", "v")
    got = merge(spark.createDataFrame(target, ROW), source, ["k"], mode)
    assert bag(got) == sorted(sequential(target, batches, mode), key=repr)


def test_merging_again_changes_nothing(spark):
    target = spark.createDataFrame([(1, "a"), (3, "c")], ROW)
    source = spark.createDataFrame([(1, "A"), (2, None)], ROW)
    once = merge(target, source, ["k"])
    assert not differences(merge(once, source, ["k"]), once).head(1)


def test_differences_count_duplicates(spark):
    a = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], ROW)
    b = spark.createDataFrame([(1, "a"), (3, "c")], ROW)
    assert bag(differences(a, b)) == sorted(
        [(1, "a", "actual"), (2, "b", "actual"), (3, "c", "expected")], key=repr)
