import json

import pytest
from pyspark.sql import functions as F

from jobloom.operators import dlq, route as r
from jobloom.operators.decode import decode
from jobloom.schemas import RECORD

OK = '{"job_id":"a","state":"complete"}'

# Text, route, job id.
CASES = [
    (OK, r.IMPORTABLE, "a"),
    (f" \t\r\n{OK}\n ", r.IMPORTABLE, "a"),
    ('{"job_id":null,"state":"complete"}', r.IMPORTABLE, None),
    ('{"job_id":"a","state":null}', r.DISCARD, "a"),
    ('{"job_id":"a","state":"error"}', r.DISCARD, "a"),
    ('{"job_id":"a","state":["complete"]}', r.DISCARD, "a"),
    ('{"job_id":"a","status":"complete"}', r.MISSING_KEYS, "a"),
    ("{}", r.MISSING_KEYS, None),
    ('{"special_event_type":"integration_test"}', r.CONTROL, None),
    ('{"special_event_type":"other"}', r.MISSING_KEYS, None),
    ('{"job_id":"a","job_id":"b","state":"complete"}', r.IMPORTABLE, "b"),
    ('{"job_id":5,"state":"complete"}', r.IMPORTABLE, "5"),
    (OK + " x", r.MALFORMED, None),
    (OK + "]", r.MALFORMED, None),
    (OK + "}", r.MALFORMED, None),
    (OK + ",", r.MALFORMED, None),
    (OK + ']{"a":1}', r.MALFORMED, None),
    (OK + "," + OK, r.MALFORMED, None),
    (OK + OK, r.MALFORMED, None),
    ("[" + OK + "]", r.MALFORMED, None),
    ("{'job_id':'a','state':'complete'}", r.MALFORMED, None),
    ('{"job_id":"a","state":"complete","n":NaN}', r.MALFORMED, None),
    ('{"job_id":"a","state":"com\nplete"}', r.MALFORMED, None),
    ("﻿" + OK, r.MALFORMED, None),
    (" " + OK, r.MALFORMED, None),
    ("5", r.MALFORMED, None), ('"x"', r.MALFORMED, None), ("null", r.MALFORMED, None),
    ("", r.MALFORMED, None), (" ", r.MALFORMED, None), (None, r.MALFORMED, None),
]


def records(spark, values):
    rows = [(None, v, "t", 0, i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, RECORD)


def test_each_text_takes_its_route(spark):
    values = [None if t is None else bytearray(t.encode()) for t, _, _ in CASES]
    got = r.route(decode(records(spark, values))).select("offset", "route", "job_id").collect()
    wrong = [(CASES[g.offset], g) for g in got if (g.route, g.job_id) != CASES[g.offset][1:]]
    assert not wrong and len(got) == len(CASES)


def test_bytes_that_are_no_utf8_are_kept(spark):
    letters = dlq.dead_letters(
        r.route(decode(records(spark, [bytearray(b"\xff{"), None]))), 1
    ).collect()
    assert {bytes(x.value) if x.value else None for x in letters} == {b"\xff{", None}
    assert {x.error_dlq for x in letters} == {None}


def test_text_that_repeats_the_hash_of_another(spark):
    """A second value that looks like the check value is not taken for it."""
    mark = spark.sql(f"select cast(xxhash64('{OK}') as string) m").head().m
    got = decode(records(spark, [bytearray(f'{OK},"{mark}"'.encode())])).head()
    assert got.event is None


def test_missing_keys_letter(spark):
    text = '{"job_id": "my_job_id", "status": "complete"}'
    letter = dlq.dead_letters(r.route(decode(records(spark, [bytearray(text.encode())]))), 3).head()
    error = ("Message has missing required keys:\n"
             '{"job_id":"my_job_id","status":"complete"}')
    assert json.loads(bytes(letter.value)) == {
        "job_id": "my_job_id", "status": "complete", "error_dlq": error}
    assert (letter.job_id, letter.route, letter.error_dlq, letter.batch_id) == (
        "my_job_id", r.MISSING_KEYS, error, 3)


def test_letters_keep_other_fields_and_replace_an_old_error(spark):
    text = ('{"job_id":"a","state":"complete","n":1.5,"o":{"x":[1,null]},"error_dlq":"old",'
            '"error_dlq_trace":"older"}')
    event = r.route(decode(records(spark, [bytearray(text.encode())]))).withColumns(
        {"route": F.lit(r.IMPORT_ERROR), "error": F.lit('new "one"')})
    got = json.loads(bytes(dlq.dead_letters(event, 1).head().value))
    assert got == {"job_id": "a", "state": "complete", "n": 1.5, "o": {"x": [1, None]},
                   "error_dlq": 'new "one"', "error_dlq_trace": "older"}


def test_replayed_letters_lose_the_error(spark):
    texts = ['{"job_id":"a","state":"complete","error_dlq":"e","error_dlq_trace":"t"}', "x"]
    letters = dlq.dead_letters(
        decode(records(spark, [bytearray(t.encode()) for t in texts])).withColumn(
            "route", F.lit(r.IMPORT_ERROR)), 1)
    values = {bytes(x.value) for x in dlq.as_events(letters).collect()}
    assert values == {b'{"job_id":"a","state":"complete"}', b"x"}


@pytest.mark.parametrize("columns", [["route"], ["job_id", "offset"]])
def test_the_text_is_parsed_once(spark, columns):
    """Filters stay above the parse, and all is in one generated stage."""
    df = r.route(decode(records(spark, []))).filter(F.col("route") == r.IMPORTABLE)
    plan = df.select(*columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") <= 1
