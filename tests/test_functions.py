from datetime import datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from jobloom.functions import checks, text
from jobloom.functions.maps import map_upsert
from jobloom.operators import status


def one(spark, value, column, type_="string"):
    return spark.createDataFrame([(value,)], f"x {type_}").select(column(F.col("x"))).head()[0]


@pytest.mark.parametrize("value, allowed, position", [
    ("abc", "", -1), ("", "", -1), ("a\0b", "", 1), ("a\U0001F600b\x07", "", 3), ("­", "", 0),
    ("a\nb", "", 1), ("a\nb", "\n", -1), ("a\nb\tc", "\n", 3), ("\U0001F600" * 50 + "\n", "", 50),
])
def test_control_position(spark, value, allowed, position):
    assert one(spark, value, lambda c: checks.control_position(c, allowed)) == position


@pytest.mark.parametrize("value, expected", [
    ("\t\n  ", ""), (" x ", "x"), (" x ", "x"), ("　x", "x"), ("\x85x", "x"),
    ("\x1cx\x1f", "x"), ("a b", "a b"), ("x\n", "x"),
])
def test_stripped(spark, value, expected):
    assert one(spark, value, checks.stripped) == expected == value.strip()
    assert one(spark, value, checks.blank) is (expected == "")


@pytest.mark.parametrize("value, minimum, broken", [
    (None, 1, True), (0.0, 1, True), (1.0, 1, False), (-0.5, -1, False)])
def test_below(spark, value, minimum, broken):
    assert one(spark, value, lambda c: checks.below(c, minimum), "double") is broken


@pytest.mark.parametrize("value, kind, type_, broken", [
    (None, "text", "string", True), ("", "text", "string", True), (" ", "text", "string", False),
    (0, "number", "int", True), (2, "number", "int", False), ([], "list", "array<int>", True),
    ([0], "list", "array<int>", False), (False, "flag", "boolean", True)])
def test_falsy(spark, value, kind, type_, broken):
    assert one(spark, value, lambda c: checks.falsy(c, kind), type_) is broken


@pytest.mark.parametrize("value, broken", [
    ("2025-05-08T01:02:03Z", False), ("2025-05-08T01:02:03+0000", False),
    ("2025-05-08T01:02:03.123456-05:30", False), ("2025-05-08T01:02:03", True),
    ("2025-05-08", True), ("12:00-05:00 x", True), (None, True)])
def test_zoneless(spark, value, broken):
    assert one(spark, value, checks.zoneless) is broken


@pytest.mark.parametrize("value, broken", [
    ("my-jobs", False), (" jobs ", False), ("a" * 249, False), ("a" * 250, True),
    ("my_jobs", True), ("jobs\nx", True), ("", True), (None, True)])
def test_topic_name(spark, value, broken):
    assert one(spark, value, checks.bad_topic_name) is broken


def test_checksum_and_rule_names(spark):
    df = spark.createDataFrame([("a" * 12,), ("a" * 11,), (None,)], "x string")
    rules = {"length": checks.bad_checksum(F.col("x")), "null": F.col("x").isNull()}
    got = [r.violations for r in checks.check(df, rules).collect()]
    assert got == [[], ["length"], ["length", "null"]]


@pytest.mark.parametrize("ref, name, tag, digest", [
    ("ghcr.io/a/b:v1@sha256:d", "ghcr.io/a/b", "v1", "sha256:d"),
    ("host:5000/a", "host:5000/a", None, None), ("host:5000/a:t", "host:5000/a", "t", None),
    ("a@sha256:d", "a", None, "sha256:d")])
def test_image_parts(spark, ref, name, tag, digest):
    got = tuple(one(spark, ref, f) for f in (text.image_name, text.image_tag, text.image_digest))
    assert got == (name, tag, digest)


def test_labels(spark):
    assert one(spark, "7", text.job_label) == "job_id_7"
    assert one(spark, "some_user", text.namespace_prefix) == "u_some_user__"
    assert one(spark, "a-b-c", text.identifier) == "a_b_c"
    assert one(spark, "", text.run_prefix) == "integration_test"
    assert one(spark, "mine", text.run_label).startswith("mine_")


def test_redact_and_audit(spark):
    df = spark.createDataFrame([(1, "secret")], "a int, b string")
    assert tuple(text.redact(df, ["a"]).head()) == (1, "REDACTED")
    at = F.lit(datetime(2025, 5, 8, 1, 2, 3, 456789, timezone.utc))
    line = df.select(text.audit_json({"b": F.lit(None).cast("string"), "c": F.lit("x")}, at))
    assert line.head()[0] == '{"c":"x","asctime":"2025-05-08T01:02:03.456+00:00"}'


STRINGS = st.dictionaries(st.sampled_from("abcd"), st.sampled_from("xy"), max_size=3)


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=st.none() | STRINGS, new=STRINGS, unset=st.lists(st.sampled_from("abcd"), max_size=2))
def test_map_upsert_law(spark, old, new, unset):
    df = spark.createDataFrame([(old, new)], "o map<string,string>, n map<string,string>")
    got = df.select(map_upsert(F.col("o"), F.col("n"), unset)).head()[0]
    assert got == {k: v for k, v in (old or {}).items() if k not in unset} | new


def test_a_start_clears_complete_and_error_only(spark):
    changes = spark.createDataFrame([
        ("j", status.COMPLETE, "t0", 0), ("j", status.ERROR, "t1", 1),
        ("j", status.NO_OPERATION, "t2", 2), ("j", "other", "x", 0), ("j", status.START, "t3", 3),
        ("k", status.START, "t1", 1), ("k", status.COMPLETE, "t2", 2),
        ("k", status.START, "t0", 0), ("l", status.ERROR, "t9", 9),
    ], "job_id string, key string, value string, seq bigint")
    maps = status.status_maps(status.current_status(changes, ["seq"]))
    assert {r.job_id: r.meta for r in maps.collect()} == {
        "j": {status.NO_OPERATION: "t2", "other": "x", status.START: "t3"},
        "k": {status.START: "t1", status.COMPLETE: "t2"},
        "l": {status.ERROR: "t9"},
    }
