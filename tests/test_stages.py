"""The stages end to end on a small landed data set."""

import datetime as dt
import hashlib
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.contracts import ALL_TABLES, DIMENSIONS, FACT, PIPELINE_RUNS, RUN_LOG
from strata.operators import raw
from strata.plans import dates, retention, runner, stages, store
from strata.plans.lake import Lake
from strata.plans.runner import Run
from strata.plans.stages import StageFailed
from strata.session import materialise


def record(loan, tranche, day="2024-01-31", **more):
    return {
        "numero_prestamo": loan, "tipo_prestamo": "bond", "moneda_base_prestamo": " usd ", "numero_tramo": tranche,
        "moneda_tramo": "usd", "tasa_interes": "1.2345678", "nombre_acreedor": "Bank  A", "tipo_acreedor": "bank",
        "deudor": "State", "ley_numero": "L1", "fecha_ley": "2001-2-3", "fecha_corte": day, "monto_tramo": "2.345",
        "monto_prestamo": "10", **more,
    }


def landed(spark, *pages):
    rows = [(i + 1, json.dumps({"results": results})) for i, results in enumerate(pages)]
    return spark.createDataFrame(rows, "page bigint, payload string")


# The data is tiny: compiling every plan would take most of the time.
QUICK = {"spark.sql.codegen.wholeStage": "false", "spark.sql.shuffle.partitions": "2"}


@pytest.fixture
def lake(spark, tmp_path):
    before = {name: spark.conf.get(name) for name in QUICK}
    for name, value in QUICK.items():
        spark.conf.set(name, value)
    for database in ("stg", "mart", "audit", "warehouse"):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    yield Lake(str(tmp_path / "lake"), "debt")
    for name, value in before.items():
        spark.conf.set(name, value)


def load(spark, lake, source, date="2024-01-01", stamp="2024-01-02 00:00:00", **more):
    run = Run(date, stamp, run_id=f"run+{date}")
    return runner.run_load(spark, lake, source, run, endpoint="https://api", **more)


FIRST = (
    [record("A", "1"), record("A", "2"), record("B", "1", monto_tramo="123456789012345678.9")],
    [record("A", "1", monto_tramo="3"), record("C", "1", day="x"), record("z" * 51, "1")],
    [],
    [record("LATE", "1")],
)


def keys(spark, contract):
    return {tuple(r[k] for k in contract.key): r[contract.surrogate] for r in spark.table(contract.full_name).collect()}


def state(spark):
    tables = [c.full_name for c in DIMENSIONS.values()] + [FACT.full_name]
    return {
        t: sorted(map(repr, (r.asDict() for r in spark.table(t).drop("updated_at_utc").collect()))) for t in tables
    }


def test_loads_of_two_dates_and_their_reruns(spark, lake):
    first_load(spark, lake)
    same_date_again(spark, lake)
    next_date(spark, lake)
    older_date_again(spark, lake)
    pruned_scan(spark, lake)


def first_load(spark, lake):
    reports = load(spark, lake, landed(spark, *FIRST))
    assert reports["ingest"]["pages_loaded"] == 2 and reports["ingest"]["records_loaded"] == 6
    assert reports["raw_validation"]["metrics"]["validated_files"] == 2
    assert reports["staging"]["rows_read"] == 6
    # B's amount overflowed and C's date is none; the long loan number is refused by three tables.
    assert reports["staging"]["rows_with_lost_values"] == 2
    assert reports["staging"]["rows_quarantined"] == 1 + 1 + 2
    refused = spark.read.parquet(lake.quarantine("staging")).collect()
    assert sorted((r["entity"], tuple(r["reasons"])) for r in refused) == [
        ("deuda_corte", ("NOT_NULL:fecha_corte",)), ("deuda_corte", ("WIDTH:numero_prestamo",)),
        ("prestamo", ("WIDTH:numero_prestamo",)), ("tramo", ("WIDTH:numero_prestamo",)),
    ]

    loans = spark.table("warehouse.dim_prestamo")
    assert {r["numero_prestamo"]: r["moneda_base_prestamo"] for r in loans.collect()} == {"A": "USD", "B": "USD", "C": "USD"}
    assert sorted(keys(spark, DIMENSIONS["prestamo"]).values()) == [1, 2, 3]
    assert {r["nombre_acreedor"] for r in spark.table("warehouse.dim_acreedor").collect()} == {"Bank A"}
    facts = {(r["numero_prestamo"], r["numero_tramo"]): r for r in spark.table(FACT.full_name).collect()}
    assert set(facts) == {("A", 1), ("A", 2), ("B", 1)}
    assert str(facts[("A", 2)]["monto_tramo"]) == "2.35" and facts[("B", 1)]["monto_tramo"] is None
    assert facts[("A", 1)]["mes_corte"] == 1 and facts[("A", 1)]["anio_corte"] == 2024
    assert facts[("A", 1)]["fecha_corte"] == dt.date(2024, 1, 31)
    by_key = {v: k for k, v in keys(spark, DIMENSIONS["prestamo"]).items()}
    assert all(by_key[r["prestamo_key"]] == (r["numero_prestamo"],) for r in facts.values())

    states = {r["stage"]: r for r in runner.pipeline_state(spark).collect()}
    assert {r["status"] for r in states.values()} == {"SUCCESS"} and len(states) == 5
    assert states["ingest"]["pages_loaded"] == 2 and states["ingest"]["pages_expected"] == 2
    logged = spark.table(RUN_LOG.full_name).collect()
    assert [r["status"] for r in logged] == ["SUCCESS"] * 5 and all(r["details_json"] for r in logged)
    document = spark.read.json(reports["warehouse"]["log_path"]).first()
    assert document["run_id"] == "run+2024-01-01"
    assert "layer=warehouse/execution_date=2024-01-01/run_id=run_2024-01-01.json" in reports["warehouse"]["log_path"]


def same_date_again(spark, lake):
    before = state(spark)
    again = load(spark, lake, landed(spark, *FIRST), stamp="2024-01-03 00:00:00")
    assert again["ingest"]["pages_loaded"] == 0
    counts = again["warehouse"]
    assert counts["rows_inserted"] == 0 and counts["rows_updated"] == 13 == counts["rows_read"]
    assert state(spark) == before


def next_date(spark, lake):
    first_keys = keys(spark, DIMENSIONS["prestamo"])
    second = ([record("A", "1", tipo_prestamo="loan"), record("D", "1")], [])
    reports = load(spark, lake, landed(spark, *second), date="2024-01-02", stamp="2024-01-04 00:00:00")
    found = {r["numero_prestamo"]: r for r in spark.table("warehouse.dim_prestamo").collect()}
    assert found["A"]["tipo_prestamo"] == "loan" and found["A"]["last_execution_date"] == dt.date(2024, 1, 2)
    assert found["A"]["created_at_utc"] == dt.datetime(2024, 1, 2) and found["A"]["updated_at_utc"] == dt.datetime(2024, 1, 4)
    assert found["B"]["last_execution_date"] == dt.date(2024, 1, 1)
    assert found["D"]["prestamo_key"] == 4
    assert all(found[k[0]]["prestamo_key"] == v for k, v in first_keys.items())
    facts = spark.table(FACT.full_name)
    assert sorted(facts.groupBy("execution_date").count().collect()) == [
        (dt.date(2024, 1, 1), 3), (dt.date(2024, 1, 2), 2)]
    assert facts.select("deuda_corte_key").distinct().count() == 5
    # Loan D, its tranche, and two facts.
    assert reports["warehouse"]["rows_inserted"] == 4


def older_date_again(spark, lake):
    """The snapshot of the older date is replaced, members keep what the newer date gave them."""
    older = ([record("A", "1", tipo_prestamo="old", monto_tramo="9"), record("E", "1")], [])
    load(spark, lake, landed(spark, *older), stamp="2024-01-05 00:00:00", overwrite=True)
    found = {r["numero_prestamo"]: r for r in spark.table("warehouse.dim_prestamo").collect()}
    assert found["A"]["tipo_prestamo"] == "loan" and found["E"]["prestamo_key"] == 5
    day = {r["numero_prestamo"] for r in spark.table(FACT.full_name).filter("execution_date = '2024-01-01'").collect()}
    assert day >= {"A", "E"}
    assert spark.table(FACT.full_name).filter("execution_date = '2024-01-02'").count() == 2


def pruned_scan(spark, lake):
    scan = stages.layer_rows(spark, lake, "curated", "tramo", "2024-01-01")
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(execution_date" in text and "PushedFilters: []" in text


def test_bad_raw_partition_stops_the_load(spark, lake):
    with pytest.raises(StageFailed) as failure:
        load(spark, lake, landed(spark, []))
    assert failure.value.report["errors"] == ["No existe el path RAW para execution_date=2024-01-01"]
    states = {r["stage"]: r["status"] for r in runner.pipeline_state(spark).collect()}
    assert states == {"ingest": "SUCCESS", "raw_validation": "FAILED"}
    log = {r["stage"]: r for r in spark.table(RUN_LOG.full_name).collect()}
    assert log["raw_validation"]["error_message"] == failure.value.report["error_message"]


def test_a_failing_stage_is_audited_and_raised(spark, lake):
    runner.create_tables(spark, lake)

    def body():
        raise ValueError("broken")

    with pytest.raises(ValueError, match="broken"):
        runner.run_stage(spark, lake, Run("2024-01-01", "2024-01-02 00:00:00"), "curated", body)
    row = runner.pipeline_state(spark).first()
    assert row["status"] == "FAILED" and row["error_message"] == "broken" and row["ended_at_utc"]
    assert spark.table(RUN_LOG.full_name).first()["status"] == "FAILED"


def test_log_failure_comes_first_and_the_run_log_is_still_written(spark, lake, monkeypatch):
    runner.create_tables(spark, lake)
    monkeypatch.setattr(runner, "write_document", lambda *a: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(StageFailed, match="Fallo escritura log ADLS: full"):
        runner.run_stage(spark, lake, Run("2024-01-01", "2024-01-02 00:00:00"), "staging", dict)
    row = spark.table(RUN_LOG.full_name).first()
    assert row["status"] == "FAILED" and "full" in row["error_message"]


def test_a_page_that_is_no_object_fails_the_ingest(spark, lake):
    source = spark.createDataFrame([(1, '{"results":[1]}'), (2, "[1]")], "page bigint, payload string")
    with pytest.raises(Exception, match="page 2 holds no JSON object"):
        load(spark, lake, source)


def test_tables_match_their_contracts(spark, lake):
    runner.create_tables(spark, lake)
    runner.create_tables(spark, lake)
    assert len(ALL_TABLES) == 14
    for contract in ALL_TABLES:
        found = {f.name: f.dataType.simpleString() for f in spark.table(contract.full_name).schema.fields}
        assert found == {f.name: f.type for f in contract.fields}
    assert spark.catalog.databaseExists("mart")


def test_validate_reads_files_too(spark, lake, tmp_path):
    folder = tmp_path / "lake" / "raw" / "debt" / "execution_date=2024-01-01" / "request_hash=x"
    folder.mkdir(parents=True)
    (folder / "page=0001.json").write_text('{"metadata":{"execution_date":"2024-01-01"},"payload":{"results":[1]}}')
    (folder / "page=0002.json").write_text("")
    row = stages.validate(spark, lake, execution_date="2024-01-01", from_files=True).first()
    assert row["metrics"]["files_total"] == 2 and row["errors"] == ["Archivo JSON vacio"]
    missing = stages.validate(spark, lake, execution_date="2030-01-01", from_files=True).first()
    assert len(missing["errors"]) == 2


def test_every_violation_is_kept_and_an_unreadable_file_says_why(spark, lake, tmp_path):
    folder = tmp_path / "lake" / "raw" / "debt" / "execution_date=2024-01-01"
    (folder / "a" / "b").mkdir(parents=True)
    for i in range(70):
        (folder / "a" / f"{i:03}.json").write_text("[")
    (folder / "a" / "b" / "_hidden.json").write_text("[1]")
    (folder / "a" / ".hidden.json").write_text("")
    (folder / "a" / "b" / "gone %41+é.json").symlink_to("nowhere")
    row = stages.validate(spark, lake, execution_date="2024-01-01", from_files=True).first()
    assert row["metrics"]["files_total"] == 73 == row["metrics"]["invalid_files"]
    assert len(row["errors"]) == 50 and row["status"] == "FAILED"
    kept = {r["path"].rpartition("/")[2]: r for r in spark.read.parquet(f"{lake.quarantine('raw_validation')}/execution_date=2024-01-01").collect()}
    assert len(kept) == 73 and kept["_hidden.json"]["code"] == "ROOT_NOT_OBJECT" and kept[".hidden.json"]["code"] == "EMPTY_FILE"
    assert kept["gone %41+é.json"]["code"] == "UNREADABLE" and kept["gone %41+é.json"]["message"].startswith("No se pudo leer el archivo: ")
    assert "No such file" in kept["gone %41+é.json"]["message"]


def test_a_load_that_dies_between_tasks_leaves_the_date_whole(spark, lake):
    table = dates.of_layer(lake, "staging", "t", T.StructType.fromDDL("k bigint, v string, execution_date date"))
    dates.create(spark, table)
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    assert dates.replace(rows, table, "2024-01-01") == 100 and dates.read(spark, table, "2024-01-02").count() == 0
    dies = F.when(F.col("k") == 77, F.raise_error(F.lit("killed"))).otherwise(F.lit("new"))
    with pytest.raises(Exception, match="killed"):
        dates.replace(rows.repartition(8).withColumn("v", dies), table, "2024-01-01")
    assert {tuple(r) for r in dates.read(spark, table, "2024-01-01").groupBy("v").count().collect()} == {("old", 100)}
    # A date may be made from itself, and may become empty.
    own = dates.read(spark, table, "2024-01-01").where("k < 10").withColumn("v", F.lit("own"))
    assert dates.replace(own, table, "2024-01-01") == 10 and dates.read(spark, table, "2024-01-01").where("v = 'own'").count() == 10
    assert dates.replace(rows.limit(0), table, "2024-01-01") == 0 and dates.read(spark, table, "2024-01-01").count() == 0
    dates.remove(spark, table, "2024-01-01")
    dates.remove(spark, table, "2024-01-01")
    assert not dates.has_date(spark, table, "2024-01-01")


def scanned_rows(frame):
    """Rows that the scans of a plan have read."""
    frame.collect()
    plan, found = frame._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if "AdaptiveSparkPlan" in node.nodeName():
            node = node.executedPlan()
        if node.nodeName().startswith("Scan"):
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().length()):
            walk(node.children().apply(i))

    walk(plan)
    return sum(found)


def test_a_lookup_leaves_out_row_groups(spark, lake):
    table = dates.of_layer(lake, "curated", "t", T.StructType.fromDDL("numero_prestamo string, v bigint, execution_date date"), ("numero_prestamo",))
    dates.create(spark, table)
    rows = spark.range(40_000).select(F.concat(F.lit("p"), F.col("id") * 2).alias("numero_prestamo"), F.col("id").alias("v")).repartition(4, "v")
    dates.replace(rows, table, "2024-01-01")
    whole = dates.read(spark, table, "2024-01-01")
    assert scanned_rows(whole.where("numero_prestamo = 'p44'")) < 40_000
    assert scanned_rows(whole.where("numero_prestamo = 'p45'")) == 0  # within all ranges, but nowhere


def test_ids_of_writers_at_the_same_time_differ(spark, lake):
    runner.create_tables(spark, lake)
    sessions = [spark, spark.newSession()]

    def begin(i):
        one = sessions[i % 2]
        took = store.claim(one, f"{lake.claims}/t", 1 + i % 3, lambda: 100)
        return range(took, took + 1 + i % 3)

    with ThreadPoolExecutor(8) as pool:
        found = sorted(n for numbers in pool.map(begin, range(60)) for n in numbers)
    assert found == list(range(101, 101 + 120))
    assert len(store.names(spark, f"{lake.claims}/t")) <= store.KEPT_CLAIMS + 8
    runs = Run("2024-01-01", "2024-01-02 00:00:00")
    with ThreadPoolExecutor(4) as pool:
        opened = list(pool.map(lambda i: runner._begin(spark, lake, runs, "staging", dt.datetime(2024, 1, 1)).first()["audit_id"], range(8)))
    assert sorted(opened) == list(range(1, 9))


def test_files_are_put_whole_or_not_at_all(spark, tmp_path):
    path = f"{tmp_path}/a/b.json"
    store.put(spark, path, b"1")
    store.put(spark, path, "2é".encode())
    assert store.get(spark, path) == "2é".encode() and not store.put_new(spark, path, b"3") and store.put_new(spark, f"{tmp_path}/a/c", b"")
    assert store.names(spark, f"{tmp_path}/a") == ["b.json", "c"] or all(n.startswith(".") or n in ("b.json", "c") for n in store.names(spark, f"{tmp_path}/a"))
    assert store.get(spark, path) == "2é".encode() and store.names(spark, f"{tmp_path}/none") == []


def test_the_audit_document_is_one_file_with_the_reports_fields(spark, lake):
    reports = load(spark, lake, landed(spark, *FIRST))
    path = reports["warehouse"]["log_path"]
    found = json.loads(store.get(spark, path))
    assert found["event_type"] == "warehouse_load" and found["layer"] == "warehouse" and found["status"] == "SUCCESS"
    assert found["rows_read"] == reports["warehouse"]["rows_read"] and found["rows_written"] == reports["warehouse"]["rows_written"]
    assert found["log_path"] == path and found["dag_id"] == "load" and found["run_id"] == "run+2024-01-01" and found["message"] == "Run completed"
    assert dt.datetime.fromisoformat(found["started_at_utc"]) <= dt.datetime.fromisoformat(found["ended_at_utc"])
    raw = json.loads(store.get(spark, reports["raw_validation"]["log_path"]))
    assert raw["event_type"] == "raw_validation" and raw["checks"]["json_valid"] is True and raw["metrics"]["json_files"] == 2
    again = load(spark, lake, landed(spark, *FIRST), stamp="2024-01-02 00:00:00")
    assert again["warehouse"]["log_path"] == path and json.loads(store.get(spark, path))["rows_inserted"] == 0


def test_landed_copies_of_a_page_and_pages_of_another_request(spark, lake):
    twice = landed(spark, *FIRST).unionByName(landed(spark, *FIRST)).unionByName(landed(spark, [record("X", "1")]))
    first = stages.ingest(spark, lake, twice, execution_date="2024-01-01", batch_ts=F.lit("2024-01-02").cast("timestamp"), endpoint="https://api")
    assert first["pages_loaded"] == 2
    held = {r["page"]: r["content"] for r in spark.read.parquet(lake.raw_table).collect()}
    digests = {p: hashlib.sha256(t.encode()).hexdigest() for p, t in [(1, json.dumps({"results": FIRST[0]})), (0, json.dumps({"results": [record("X", "1")]}))]}
    assert (json.dumps({"results": FIRST[0]}) in held[1]) == (digests[1] < digests[0])
    other = {"execution_date": "2024-01-01", "batch_ts": F.lit("2024-01-03").cast("timestamp"), "endpoint": "https://other"}
    assert stages.ingest(spark, lake, landed(spark, *FIRST), key=raw.PAGE_KEY, **other)["pages_loaded"] == 0
    assert stages.ingest(spark, lake, landed(spark, *FIRST), **other)["pages_loaded"] == 2


def test_sweeping_leaves_what_tables_and_open_runs_need(spark, lake):
    load(spark, lake, landed(spark, *FIRST))
    load(spark, lake, landed(spark, *FIRST), stamp="2024-01-03 00:00:00")
    before = state(spark)
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=30)
    assert retention.sweep(spark, lake)["versions"] == 0
    opened = dt.datetime.now(dt.timezone.utc) - dt.timedelta(hours=1)
    runner._begin(spark, lake, Run("2024-01-01", "2024-01-02 00:00:00"), "curated", opened)
    copy, path = materialise(spark.range(5), "running")
    soon = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1)
    assert retention.horizon(spark, dt.timedelta(0), soon) == opened.replace(microsecond=opened.microsecond)
    assert retention.sweep(spark, lake, dt.timedelta(0), soon) == {"versions": 0, "copies": 0} and copy.count() == 5
    # Much later the open run counts as dead.
    gone = retention.sweep(spark, lake, dt.timedelta(0), later)
    assert gone["versions"] >= len(DIMENSIONS) + 1 and gone["copies"] >= 1 and state(spark) == before
    assert retention.sweep(spark, lake, dt.timedelta(0), later) == {"versions": 0, "copies": 0}
