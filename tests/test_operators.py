"""Operators on small fixtures, and their independence of partitioning."""

import datetime as dt
import json
import os
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.catalogue import queries
from strata.contracts import DIMENSIONS, FACT, STAGING, typed
from strata.operators import constraints, facts, keys, lifecycle, metrics, raw, records, runlog, upsert
from strata.session import scratch_root
from strata.sources import envelopes, pages

NOW = "2024-01-02 03:04:05"


def ts(text=NOW):
    return F.lit(text).cast("timestamp")


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("sizes, ceiling, kept", [
    ({1: 3, 2: 3, 3: 0}, None, [1, 2]),
    ({1: 3, 2: 0, 3: 5}, None, [1]),
    ({1: 0}, None, []),
    ({i: 1 for i in range(1, 171)}, 166, list(range(1, 167))),
    ({1: 1, 3: 1}, None, [1]),
    ({2: 1, 3: 1}, None, []),
])
def test_page_cut(spark, sizes, ceiling, kept):
    landed = spark.createDataFrame(list(sizes.items()), "page bigint, records bigint")
    assert sorted(r["page"] for r in pages.keep_pages(landed, max_pages=ceiling).collect()) == kept


def test_missing_pages_span_blocks(spark):
    landed = spark.createDataFrame([(1,), (2,), (5,), (250_000,), (250_000,)], "page bigint")
    assert rows_of(pages.missing_pages(landed)) == [(3, 4), (6, 249_999)]
    assert rows_of(pages.missing_pages(landed, last=300_000)) == [(3, 4), (6, 249_999), (250_001, 300_000)]


def test_raw_append_writes_a_key_once(spark):
    schema = "execution_date string, request_hash string, page int, content string"
    batch = spark.createDataFrame([("d", "h1", 1, "b"), ("d", "h1", 1, "a"), ("d", "h2", 2, "c")], schema)
    nothing = spark.createDataFrame([], schema)
    first = raw.new_rows(batch, nothing)
    assert rows_of(first) == [("d", "h1", 1, "a"), ("d", "h2", 2, "c")]
    assert raw.new_rows(batch, first).count() == 0
    changed = spark.createDataFrame([("d", "h1", 1, "z")], schema)
    assert rows_of(raw.overwritten(changed, first)) == [("d", "h1", 1, "z"), ("d", "h2", 2, "c")]
    assert {(r["page"], r["written"]) for r in raw.append_outcome(batch, first).collect()} == {(1, False), (2, False)}


def test_records_come_out_of_envelopes_as_text(spark):
    payloads = ['{"results":[{"a":1.50,"b":"x","c":null},{"a":"y"}]}', '{"results":[]}', "[]", '"p"', '{"results":{"a":1}}']
    raw_rows = spark.createDataFrame([(f'{{"metadata":{{}},"payload":{p}}}',) for p in payloads], "content string")
    found = envelopes.result_records(raw_rows, ["a", "other"], source_names={"other": "b"})
    assert rows_of(found) == [(0, "1.5", "x"), (1, "y", None)]


def test_numbers_keep_their_digits_and_odd_elements_are_refused(spark):
    results = '[1,{"a":9007199254740993.12},"s",null,{"a":1234567890123456.78},[{"a":2}],{"a":"007"}]'
    contents = [f'{{"payload":{{"results":{results}}}}}', "{broken", None, '{"payload":{}}']
    raw_rows = spark.createDataFrame([(c,) for c in contents], "content string")
    found = envelopes.result_records(raw_rows, ["a"])
    assert rows_of(found) == [(1, "9007199254740993.12"), (4, "1234567890123456.78"), (6, "007")]
    refused = envelopes.result_elements(raw_rows, ["a"]).filter("_reject is not null").select("_reject", "_element")
    assert sorted(map(tuple, refused.collect())) == [
        ("NOT_OBJECT", '"s"'), ("NOT_OBJECT", "1"), ("NOT_OBJECT", '[{"a":2}]'), ("NOT_OBJECT", "null"), ("NOT_PARSED", "{broken")]


def test_latest_per_key_does_not_depend_on_partitions(spark):
    data = [("A", 1, "x"), ("A", 2, "x"), ("A", 2, "y"), ("A", 2, None), ("B", None, None)]
    frame = spark.createDataFrame(data * 3, "k string, v int, w string")
    expected = [("A", 2, "y"), ("B", None, None)]
    for parts in (1, 4, 50):
        assert sorted(map(tuple, records.latest_per_key(frame.repartition(parts), ["k"], ["v"]).collect())) == expected


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    frame = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    plan = records.latest_per_key(frame, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")


def test_contract_cases(spark):
    text = "numero_prestamo string, numero_tramo string, fecha_corte string, monto_tramo string"
    given = spark.createDataFrame([
        ("A", "1", "2024-1-5", "2.345"), ("B", "1", "x", "1"), ("C", "1", "2024-01-05", "123456789012345678.9"),
        (None, "1", "2024-01-05", None), ("D" * 51, "z", "2024-01-05", " "),
    ], text)
    fields = [f for f in STAGING["deuda_corte"].fields if f.name in given.columns]
    found = records.typed_records(given, fields).collect()
    assert [r["_issues"] for r in found] == [[], ["CAST:fecha_corte"], ["CAST:monto_tramo"], [], ["CAST:numero_tramo"]]
    assert str(found[0]["monto_tramo"]) == "2.35" and found[0]["fecha_corte"] == dt.date(2024, 1, 5)
    checked = constraints.checked(records.typed_records(given, fields), STAGING["deuda_corte"]).collect()
    assert [r["reasons"] for r in checked] == [
        [], ["NOT_NULL:fecha_corte"], [], ["NOT_NULL:numero_prestamo"],
        ["NOT_NULL:numero_tramo", "WIDTH:numero_prestamo"],
    ]


def test_interest_category_widths_differ_by_layer(spark):
    row = spark.createDataFrame([("A", 1, "c" * 80)], "numero_prestamo string, numero_tramo int, categoria_interes_tramo string")
    assert constraints.checked(row, STAGING["tramo"]).first()["reasons"] == ["WIDTH:categoria_interes_tramo"]
    assert constraints.checked(row, DIMENSIONS["tramo"]).first()["reasons"] == []
    accents = spark.createDataFrame([("é" * 30, 1)], "numero_prestamo string, numero_tramo int")
    assert constraints.checked(accents, STAGING["tramo"]).first()["reasons"] == []
    assert constraints.checked(accents, STAGING["tramo"], octets=True).first()["reasons"] == ["WIDTH:numero_prestamo"]


def test_keys_are_dense_and_do_not_depend_on_partitions(spark):
    frame = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    seen = set()
    for parts, shuffles in ((1, "1"), (7, "8"), (40, "200")):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        found = {r["k"]: r["n"] for r in keys.assign_keys(frame.repartition(parts), ["k"], "n", 10).collect()}
        spark.conf.set("spark.sql.shuffle.partitions", before)
        assert sorted(found.values()) == list(range(11, 3011))
        seen.add(tuple(sorted(found.items())))
    assert len(seen) == 1
    assert keys.assign_keys(frame.limit(0), ["k"], "n").count() == 0


def test_numbering_reads_its_rows_once(spark):
    """no look at the rows before they are dealt; the order is that of buckets, keys and nulls first."""
    read = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    frame = spark.range(2000, numPartitions=4).select(F.when(F.col("id") > 0, F.col("id").cast("string")).alias("k"))
    found = keys.assign_keys(frame.mapInArrow(run, "k string"), ["k"], "n").collect()
    assert read.value == 2000
    bucket = {r["k"]: r["b"] for r in frame.select("k", keys.key_bucket(["k"]).alias("b")).collect()}
    ordered = sorted(bucket, key=lambda k: (bucket[k], k is not None, k or ""))
    assert {r["k"]: r["n"] for r in found} == {k: i for i, k in enumerate(ordered, 1)}


def test_few_buckets_give_the_order_of_their_keys(spark):
    frame = spark.range(500).select(F.format_string("%03d", "id").alias("k"))
    found = {r["k"]: r["n"] for r in keys.assign_keys(frame.repartition(5), ["k"], "n", buckets=1).collect()}
    assert found == {f"{i:03d}": i + 1 for i in range(500)}


def test_members_and_dates_are_cast_once(spark):
    """a condition on the cast members, or a lost date, casts nothing a second time."""
    given = spark.createDataFrame([('{"payload":{"results":[{"fecha_corte":" 2024-1-5 "},{"fecha_corte":"x"},7]}}',)], "content string")
    fields = [f for f in STAGING["deuda_corte"].fields if f.name == "fecha_corte"]
    typed = records.typed_records(envelopes.result_records(given, ["fecha_corte"]), fields)
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(_value") == 1 and plan.count("gettimestamp") == 1
    assert [tuple(r) for r in typed.collect()] == [(dt.date(2024, 1, 5), []), (None, ["CAST:fecha_corte"])]


def test_fact_loads_write_their_rows_no_more_often_than_needed(spark, tmp_path):
    """numbered rows lie in a stored copy, so nothing stores them before or after once more."""
    spark.range(1, 41).selectExpr(
        "id o_orderkey", "'1-URGENT' o_orderpriority", "'F' o_orderstatus", "id o_custkey", "1.5D o_totalprice",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(120).selectExpr(
        "id div 3 + 1 l_orderkey", "cast(id % 3 as int) l_linenumber", "'R' l_returnflag", "'O' l_linestatus", "0.1D l_discount",
        "id l_suppkey", "id l_partkey", "cast(date_add(date'1998-12-01', cast(id as int)) as timestamp_ntz) l_shipdate", "2.5D l_extendedprice",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    place = Path(scratch_root(spark)) / "strata"

    def copies(query):
        before = set(os.listdir(place)) if place.exists() else set()
        rows = query(spark, str(tmp_path)).collect()
        return rows, Counter(name.rpartition("-")[0].partition("-")[0] for name in set(os.listdir(place)) - before)

    rows, stored = copies(queries.q17_fact_keys)
    assert sorted(r["deuda_corte_key"] for r in rows) == list(range(1, 121)) and {r["monto_tramo"] for r in rows} == {"2.50"}
    assert stored.keys() == {"numbered"}
    rows, stored = copies(queries.q18_fact_reload)
    assert sorted(r["deuda_corte_key"] for r in rows) == list(range(1, 121))
    assert Counter(r["load_action"] for r in rows) == {"updated": 31, "inserted": 89}
    assert stored.keys() == {"debts", "numbered", "matched"}


def loan(number, kind):
    return (number, kind, None, None, None, None, None)


def merge(spark, target, rows, date, stamp, **more):
    contract = DIMENSIONS["prestamo"]
    names = contract.names[1:8]
    source = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    if target is None:
        target = spark.createDataFrame([], contract.schema)
    merged = upsert.merge_dimension(target, source, contract, execution_date=F.lit(date), batch_ts=ts(stamp), **more)
    return spark.createDataFrame(merged.collect(), merged.schema)


def actions(merged):
    return {r["numero_prestamo"]: r["load_action"] for r in merged.collect()}


def test_upsert_actions(spark):
    first = merge(spark, None, [loan("A", "x"), loan("B", None), loan("C", "x")], "2024-01-02", NOW)
    assert set(actions(first).values()) == {"inserted"}
    base = first.drop("load_action")
    second = [loan("A", "x"), loan("B", "y"), loan("D", "x")]
    assert actions(merge(spark, base, second, "2024-01-02", NOW)) == {
        "A": "updated", "B": "updated", "C": "kept", "D": "inserted"}
    assert actions(merge(spark, base, second, "2024-01-03", NOW, count="changed")) == {
        "A": "unchanged", "B": "updated", "C": "kept", "D": "inserted"}
    late = merge(spark, base, second, "2024-01-01", NOW)
    assert actions(late) == {"A": "stale", "B": "stale", "C": "kept", "D": "inserted"}
    assert {r["numero_prestamo"]: r["tipo_prestamo"] for r in late.collect()}["B"] is None
    assert sorted(r["prestamo_key"] for r in late.collect()) == [1, 2, 3, 4]


def test_upsert_may_ignore_case_and_trailing_blanks(spark):
    first = merge(spark, None, [loan("Abc", "x")], "2024-01-01", NOW).drop("load_action")
    again = merge(spark, first, [loan("ABC  ", "y")], "2024-01-02", NOW, collation="UTF8_LCASE_RTRIM")
    assert [(r["numero_prestamo"], r["tipo_prestamo"], r["load_action"]) for r in again.collect()] == [("Abc", "y", "updated")]


def test_unresolved_facts_name_what_is_missing(spark):
    given = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), ("C", 1)], "numero_prestamo string, numero_tramo int")
    loans = spark.createDataFrame([("A", 1)], "numero_prestamo string, prestamo_key bigint")
    tranches = spark.createDataFrame([("A", 1, 1), ("B", 1, 2)], "numero_prestamo string, numero_tramo int, tramo_key bigint")
    assert rows_of(facts.with_reference_keys(given, tranches, loans).select("numero_prestamo", "numero_tramo")) == [("A", 1)]
    assert {(r[0], r[1]): r["reasons"] for r in facts.unresolved(given, tranches, loans).collect()} == {
        ("A", 2): ["FK:numero_tramo"], ("B", 1): ["FK:numero_prestamo"],
        ("C", 1): ["FK:numero_prestamo", "FK:numero_tramo"],
    }


def test_a_hot_loan_is_split_when_its_tranches_are_resolved(spark):
    """A loan with most tranches: the adaptive join splits it, since nothing needs its partitioning."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        number = F.col("id")
        loan_number = F.when(number % 10 < 8, "hot").otherwise(number.cast("string")).alias("numero_prestamo")
        numbers = spark.range(0, 60_000, 1, 8)
        tranches = numbers.select(loan_number, number.cast("int").alias("numero_tramo"), number.alias("tramo_key"))
        loans = numbers.filter((number % 10 >= 8) | (number == 0)).select(loan_number, number.alias("prestamo_key"))
        given = tranches.select("numero_prestamo", "numero_tramo")
        resolved = facts.with_reference_keys(given, tranches, loans)
        assert len(resolved.collect()) == 60_000
        assert "skew=true" in resolved._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_snapshot_reload_keeps_keys_and_drops_vanished_rows(spark):
    schema = "prestamo_key bigint, tramo_key bigint, " + ", ".join(
        f"{f.name} {f.type}" for f in FACT.fields[3:-3]) + ", execution_date date"
    day = dt.date(2024, 1, 31)

    def debts(*numbers):
        return spark.createDataFrame(
            [(1, n, "A", n, day, *[None] * 10, dt.date(2024, 1, 1)) for n in numbers], schema)

    first = facts.load_snapshot(debts(1, 2), None, batch_ts=ts(), start=0)
    known = {r["numero_tramo"]: r["deuda_corte_key"] for r in first.collect()}
    again = facts.load_snapshot(debts(2, 3), first.drop("load_action"), batch_ts=ts("2024-02-01 00:00:00"), start=2)
    found = {r["numero_tramo"]: r for r in again.collect()}
    assert set(found) == {2, 3}
    assert found[2]["deuda_corte_key"] == known[2] and found[3]["deuda_corte_key"] == 3
    assert found[2]["created_at_utc"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert found[2]["updated_at_utc"] == dt.datetime(2024, 2, 1)


STATE = "struct<result_state:string,state_message:string>"
RUN = (
    "run_id bigint, run_page_url string, start_time bigint, end_time bigint, "
    f"state {STATE}, tasks array<struct<run_id:bigint,state:{STATE}>>, output string"
)


@pytest.mark.parametrize("output, counts, status, message", [
    ('{"rows_read":10,"rows_inserted":3,"rows_updated":4}', (10, 3, 4, 7), "SUCCESS", "Run completed"),
    ('{"records_read":10,"inserted":3,"updated":4,"rows_written":9}', (10, 3, 4, 9), "SUCCESS", "Run completed"),
    ('{"rows_read":null,"records_read":5}', (0, 0, 0, 0), "SUCCESS", "Run completed"),
    ('{"rows_read":"x","status":"FAILED"}', (0, 0, 0, 0), "SUCCESS", "Run completed"),
    ('{"status":"FAILED","message":"m"}', (0, 0, 0, 0), "FAILED", "m"),
    ('{"status":"DONE"}', (0, 0, 0, 0), "SUCCESS", "Run completed"),
    ("not json", (0, 0, 0, 0), "SUCCESS", "Run completed"),
    (None, (0, 0, 0, 0), "SUCCESS", "Run completed"),
])
def test_warehouse_metrics(spark, output, counts, status, message):
    runs = spark.createDataFrame([(1, "u", 0, 1704067200000, ("SUCCESS", ""), [], output)], RUN)
    row = metrics.resolved_runs(runs, "warehouse", ts()).first()
    assert (row["rows_read"], row["rows_inserted"], row["rows_updated"], row["rows_written"]) == counts
    assert (row["status"], row["message"]) == (status, message)
    assert row["ended_at_utc"] == dt.datetime(2024, 1, 1) and row["started_at_utc"] == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_curated_metrics_keep_a_good_read_count(spark):
    runs = spark.createDataFrame(
        [(1, "u", 0, 0, ("SUCCESS", None), [(9, ("FAILED", "task"))], '{"rows_read":5,"rows_written":"x"}'),
         (None, "u", 5, 5, None, None, '{"rows_read":5}')], RUN)
    good, none = metrics.resolved_runs(runs, "curated", ts()).collect()
    assert (good["rows_read"], good["rows_written"], good["status"], good["message"], good["task_run_id"]) == (5, 0, "FAILED", "task", 9)
    assert (none["rows_read"], none["status"], none["message"]) == (0, "FAILED", "No Databricks run_id found.")
    assert none["started_at_utc"] == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_run_log_takes_what_the_target_has(spark):
    run = spark.createDataFrame(
        [("r", "d", "t", "2024-01-01", "SUCCESS", "curated", "debt", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))],
        "run_id string, dag_id string, task_id string, execution_date string, status string, stage string, "
        "dataset_name string, started_at_utc timestamp, ended_at_utc timestamp")
    narrow = runlog.run_log_rows(run, ["run_id", "dag_id", "task_id", "execution_date", "status", "message", "created_at"])
    assert narrow.columns == ["run_id", "dag_id", "task_id", "execution_date", "status"]
    assert narrow.first()["execution_date"] == dt.date(2024, 1, 1)
    with pytest.raises(ValueError):
        runlog.run_log_rows(run, ["x"])
    with pytest.raises(Exception, match="missing required run log fields: stage, ended_at_utc"):
        runlog.run_log_rows(run.drop("stage").withColumn("ended_at_utc", F.lit(None)), ["run_id"]).collect()


def test_lifecycle_state(spark):
    begun = spark.createDataFrame(
        [(1, "p", "s", "d", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1)), (2, "p", "s", "d", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1))],
        "audit_id bigint, pipeline_name string, stage string, dataset_name string, execution_date date, started_at_utc timestamp")
    opened = lifecycle.started(begun)
    # Closed at the very moment it began: the closing row still counts.
    ended = lifecycle.closed(opened.filter("audit_id = 2"), status=F.lit("FAILED"), ended=ts("2024-01-01 00:00:00"), error=F.lit("e"))
    state = {r["audit_id"]: (r["status"], r["error_message"]) for r in lifecycle.latest_state(opened.unionByName(ended)).collect()}
    assert state == {1: ("STARTED", None), 2: ("FAILED", "e")}


def test_details_keep_nulls(spark):
    row = spark.createDataFrame([(1, None)], "a int, b string").select(runlog.details_json("a", "b").alias("d")).first()
    assert json.loads(row["d"]) == {"a": 1, "b": None}


def test_field_types_are_known():
    assert typed("x", "int").ddl == "int"
