"""Stand-ins on the given tables.

Orders are loans, line items tranches and debts at a cut-off date, customers debtors, suppliers
creditors, parts laws, events raw files and runs, pages API requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import configure

DATE = "2024-01-01"
NEXT_DATE = "2024-01-02"
BATCH_TS = "2024-01-02 03:04:05"
NEXT_TS = "2024-01-03 03:04:05"
RAW_BASE = "raw/debt"

# The file kinds of the validation truth table; the kind of an event is its id modulo 16.
_GOOD = '{"metadata":{"execution_date":"2024-01-01"},"payload":{"results":[%s]}}'
FILE_KINDS = (
    None,
    "",
    "  ",
    '{"metadata":',
    '{"a":1} x',
    "[1]",
    "null",
    '{"metadata":{"execution_date":"2024-01-01"},"payload":null}',
    '{"payload":{}}',
    '{"metadata":{"execution_date":""},"payload":[]}',
    '{"metadata":"x","payload":0}',
    '{"metadata":{"execution_date":"1999-01-01"},"payload":"p"}',
    '{"metadata":{"execution_date":" "},"payload":{"results":[]}}',
    '{"metadata":{"execution_date":"2024-01-01"},"payload":""}',
    None,
    "anything",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def portable(rows: DataFrame) -> DataFrame:
    """Dates, times and amounts as text, lists joined, so that both engines print them alike."""
    shown = []
    for name, type_ in rows.dtypes:
        column = F.col(name)
        if type_.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif type_ == "date" or type_.startswith("decimal"):
            column = column.cast("string")
        elif type_ == "array<string>":
            column = F.array_join(column, ",")
        shown.append(column.alias(name))
    return rows.select(*shown)


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw file per event, of the sixteen kinds."""
    kind = F.col("event_id") % 16
    fixed = F.array(*[F.lit(text) for text in FILE_KINDS])
    content = F.coalesce(F.get(fixed, kind.cast("int")), F.format_string(_GOOD, F.col("props")))
    suffix = F.when(kind == 14, ".JSON").when(kind == 15, ".txt").otherwise(".json")
    path = F.concat(F.lit(f"{RAW_BASE}/execution_date={DATE}/event="), F.format_string("%012d", "event_id"), suffix)
    binary = content.cast("binary")
    return table(spark, sf_dir, "events").select(
        path.alias("path"), F.octet_length(binary).cast("bigint").alias("length"), binary.alias("content")
    )


def page_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed page per web page, its payload a list of one result."""
    result = F.struct("page_id", "url", "html")
    return table(spark, sf_dir, "pages").select(
        F.lit(DATE).alias("execution_date"),
        F.col("page_id").alias("page"),
        F.col("url").alias("endpoint"),
        F.to_json(F.struct(F.array(result).alias("results"))).alias("payload"),
    )


def loan_rows(orders: DataFrame) -> DataFrame:
    """Orders in the shape of the loan entity."""
    empty = F.lit(None).cast("string")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("numero_prestamo"),
        F.col("o_orderpriority").alias("tipo_prestamo"),
        F.col("o_orderstatus").alias("fuente_deuda"),
        empty.alias("duracion"),
        F.lit("USD").alias("moneda_base_prestamo"),
        empty.alias("garantia_publica"),
        F.col("o_custkey").cast("string").alias("gestion_tramo"),
    )


def debt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed flat records: a line item with its order."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    empty = F.lit(None).cast("string")
    day = F.col("l_shipdate").cast("date")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").cast("string").alias("numero_prestamo"),
        F.col("o_orderpriority").alias("tipo_prestamo"),
        F.col("o_orderstatus").alias("fuente_deuda"),
        empty.alias("duracion"),
        F.lit("USD").alias("moneda_base_prestamo"),
        empty.alias("garantia_publica"),
        F.col("o_custkey").cast("string").alias("gestion_tramo"),
        F.col("l_linenumber").alias("numero_tramo"),
        F.col("l_returnflag").alias("moneda_tramo"),
        F.col("l_linestatus").alias("categoria_interes_tramo"),
        F.col("l_discount").cast("decimal(18,6)").alias("tasa_interes"),
        F.col("l_suppkey").cast("string").alias("grupo_tasa_interes"),
        F.col("l_partkey").cast("string").alias("grupo_vencimiento"),
        day.alias("fecha_corte"),
        F.lit(None).cast("int").alias("mes_corte"),
        F.lit(None).cast("int").alias("anio_corte"),
        F.col("l_linestatus").alias("categoria_deuda"),
        F.col("l_returnflag").alias("situacion"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("monto_prestamo"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("monto_tramo"),
        F.lit(None).cast("date").alias("fecha_inicial_programada"),
        F.lit(None).cast("date").alias("fecha_final_programada"),
        F.lit(None).cast("date").alias("fecha_limite_desembolso"),
        F.lit(DATE).cast("date").alias("execution_date"),
        moment(BATCH_TS).alias("ingestion_timestamp"),
    )
