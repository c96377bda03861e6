"""Column functions against fixed vectors."""

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from strata.functions import jsontext as J
from strata.functions.hashing import canonical_request, pipe_request_hash, request_hash
from strata.functions.moments import from_epoch_ms, iso_utc, to_date_strict
from strata.functions.numbers import int_or_zero
from strata.functions.text import account_name, digits_only, padded_page, safe_run_id


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def ts(text):
    return F.lit(text).cast("timestamp")


def test_request_hash_vectors(spark):
    digest = request_hash(F.lit("E"), F.lit("2024-01-01"), F.lit(1), {"page": F.lit(1)})
    assert one(spark, digest) == "f2391ccf36ef909076cbb4c97a9a17e12bd930abd39ceb42f2f17abb0530296e"
    digest = pipe_request_hash(F.lit("S"), F.lit("E"), F.lit(1), F.lit("2024-01-01"))
    assert one(spark, digest) == "51169bd259f0d8cc4a8139c8babb7c74f1d8d60c3f498ee05123bc0d3772d66e"


@pytest.mark.parametrize("endpoint", ["plain", "ñandú/é", "emoji \U0001f600 \U0010ffff", 'quote " back \\ slash /', ""])
def test_canonical_request_is_sorted_ascii_json(spark, endpoint):
    expected = json.dumps(
        {"endpoint": endpoint, "params": {"page": 3, "a": None}, "page": 3, "execution_date": "2024-01-01"},
        sort_keys=True, separators=(",", ":"),
    )
    params = {"page": F.lit(3), "a": F.lit(None).cast("string")}
    text = canonical_request(F.lit(endpoint), F.lit("2024-01-01"), F.lit(3), params)
    assert one(spark, text) == expected
    assert one(spark, F.sha2(text, 256)) == hashlib.sha256(expected.encode()).hexdigest()


DOCUMENTS = [
    '{"a":1}', ' {"a":1} \n', "[1]", "null", "0", '"x"', "true", "[]", "{}", '{"a":1,"a":2}', "[[1],[2]]",
    '{"a":1} x', '{"a":1}{}', "[1],[2", "1],[2", "1]", "1]}", '1,"v":2', "1,2", "{}]{}", "{}}", "]", "}", "", "  ",
    '{"a":', "nul", "'x'", '{"a":1,}', "[1,]", "1]  ,[", '{"b":2}},{"c":{}', "01", "+1", '"a\tb"',
]


def test_strict_documents_are_those_a_json_decoder_takes(spark):
    def valid(text):
        try:
            json.loads(text)
            return True
        except ValueError:
            return False

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(DOCUMENTS)], "i int, t string")
    parsed = J.with_document(rows, F.col("t"), "d").select("i", F.col("d").isNotNull().alias("ok")).collect()
    assert {DOCUMENTS[r["i"]]: r["ok"] for r in parsed} == {t: valid(t) for t in DOCUMENTS}


def test_json_value_tests_follow_python(spark):
    values = ["null", '""', '" "', '"0"', '"false"', "0", "0.0", "-0.0", "0e3", "0.1", "1", "true", "false", "[]", "{}",
              "[0]", '{"a":null}', '"[]"']
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    parsed = J.with_document(rows, F.col("v"), "d")
    for row in parsed.select("i", J.is_falsy(F.col("d")).alias("falsy"), J.is_empty(F.col("d")).alias("empty")).collect():
        value = json.loads(values[row["i"]])
        assert row["falsy"] == (not value), values[row["i"]]
        assert row["empty"] == (isinstance(value, (list, dict, str)) and len(value) == 0), values[row["i"]]


def test_int_or_zero_follows_python(spark):
    values = ["null", "0", "12", "3.7", "-3.7", '"12"', '" 12 "', '"+3"', '"1_000"', '"3.7"', '"x"', '""', "true", "false",
              "[]", "{}", "[1]", '{"a":1}']
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    found = J.with_document(rows, F.col("v"), "d").select("i", int_or_zero(F.col("d")).alias("n")).collect()
    for row in found:
        try:
            expected = int(json.loads(values[row["i"]]) or 0)
        except (TypeError, ValueError):
            expected = None
        assert row["n"] == expected, values[row["i"]]


def test_utf8_text_strips_the_mark_and_refuses_other_bytes(spark):
    rows = spark.createDataFrame([(0, b"\xef\xbb\xbf{}"), (1, b"{}"), (2, b"\xff{}"), (3, "é".encode())], "i int, c binary")
    found = {r["i"]: r["t"] for r in rows.select("i", J.utf8_text(F.col("c")).alias("t")).collect()}
    assert found == {0: "{}", 1: "{}", 2: None, 3: "é"}


def test_text_helpers(spark):
    now = ts("2024-01-02 03:04:05")
    assert one(spark, safe_run_id(F.lit("manual__2024-01-01T00:00:00+00:00"), now)) == "manual__2024-01-01T00_00_00_00_00"
    assert one(spark, safe_run_id(F.lit("a/b=c"), now)) == "a_b_c"
    assert one(spark, safe_run_id(F.lit(None).cast("string"), now)) == "manual__20240102T030405Z"
    assert one(spark, account_name(F.lit("https://acct.dfs.core.windows.net/"))) == "acct"
    assert one(spark, account_name(F.lit("acct"))) == "acct"
    assert one(spark, padded_page(F.lit(7))) == "0007"
    assert one(spark, padded_page(F.lit(123456))) == "123456"
    assert one(spark, digits_only(F.lit("123"))) == 123
    assert one(spark, digits_only(F.lit("12a"))) is None


def test_moments(spark):
    now = ts("2024-01-02 03:04:05")
    assert one(spark, from_epoch_ms(F.lit(0).cast("bigint"), now)) == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, from_epoch_ms(F.lit(None).cast("bigint"), now)) == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, from_epoch_ms(F.lit(1704067200000), now)) == dt.datetime(2024, 1, 1)
    assert one(spark, iso_utc(ts("2024-01-01 00:00:00.5"))) == "2024-01-01T00:00:00.500000+00:00"
    for text, expected in [("2024-1-5", dt.date(2024, 1, 5)), ("2024-01-05", dt.date(2024, 1, 5)), ("2024-13-05", None),
                           ("x", None), ("2024-02-30", None)]:
        assert one(spark, to_date_strict(F.lit(text))) == expected
