"""Table contracts: columns, widths, keys and references, stated once and used by every operator."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    width: int | None = None
    required: bool = False

    @property
    def ddl(self) -> str:
        """Column type of a catalog table: bounded text keeps its width."""
        return f"varchar({self.width})" if self.width else self.type


def text(name: str, width: int, required: bool = False) -> Field:
    return Field(name, "string", width, required)


def typed(name: str, type_: str, required: bool = False) -> Field:
    return Field(name, type_, None, required)


@dataclass(frozen=True)
class Reference:
    """Foreign key: ``columns`` must exist in ``table``, whose surrogate lands in ``key``."""

    columns: tuple[str, ...]
    table: str
    key: str


@dataclass(frozen=True)
class TableContract:
    name: str
    database: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    surrogate: str | None = None
    partition: str | None = None
    order: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    upper: tuple[str, ...] = field(default=())

    @property
    def full_name(self) -> str:
        return f"{self.database}.{self.name}"

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, T._parse_datatype_string(f.type), not f.required) for f in self.fields]
        )

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)


# The tables, their columns, widths and keys.

_LOAN = (
    text("numero_prestamo", 50, True),
    text("tipo_prestamo", 100),
    text("fuente_deuda", 50),
    text("duracion", 50),
    text("moneda_base_prestamo", 10),
    text("garantia_publica", 50),
    text("gestion_tramo", 50),
)

_TRANCHE = (
    text("numero_prestamo", 50, True),
    typed("numero_tramo", "int", True),
    text("moneda_tramo", 10),
    text("categoria_interes_tramo", 50),
    typed("tasa_interes", "decimal(18,6)"),
    text("grupo_tasa_interes", 100),
    text("grupo_vencimiento", 100),
)

_CREDITOR = (
    text("nombre_acreedor", 200, True),
    text("tipo_acreedor", 100),
    text("pais_acreedor", 200),
)

_DEBTOR = (
    text("deudor", 200, True),
    text("nombre_beneficiario", 200),
    text("categoria_deudor", 100),
    text("descripcion_tipo_administracion", 200),
    text("institucion_pagadora", 200),
    text("agencias_implantacion", 200),
)

_LAW = (
    text("ley_numero", 200, True),
    typed("fecha_ley", "date"),
)

_DEBT = (
    text("numero_prestamo", 50, True),
    typed("numero_tramo", "int", True),
    typed("fecha_corte", "date", True),
    typed("mes_corte", "int"),
    typed("anio_corte", "int"),
    text("categoria_deuda", 100),
    text("fuente_deuda", 50),
    text("situacion", 50),
    typed("monto_prestamo", "decimal(18,2)"),
    typed("monto_tramo", "decimal(18,2)"),
    typed("fecha_inicial_programada", "date"),
    typed("fecha_final_programada", "date"),
    typed("fecha_limite_desembolso", "date"),
)

_STAGING_TAIL = (typed("execution_date", "date", True), typed("ingestion_timestamp", "timestamp", True))
_STAMPS = (typed("created_at_utc", "timestamp", True), typed("updated_at_utc", "timestamp", True))
_DIMENSION_TAIL = (typed("last_execution_date", "date", True), *_STAMPS)


def _staging(name: str, fields: tuple[Field, ...], key: tuple[str, ...], **more) -> TableContract:
    return TableContract(
        name, "stg", fields + _STAGING_TAIL, key + ("execution_date",), partition="execution_date", **more
    )


def _dimension(name: str, surrogate: str, fields: tuple[Field, ...], key: tuple[str, ...], **more) -> TableContract:
    head = (typed(surrogate, "bigint", True),)
    return TableContract(name, "warehouse", head + fields + _DIMENSION_TAIL, key, surrogate=surrogate, **more)


_WIDE_TRANCHE = tuple(
    replace(f, width=100) if f.name == "categoria_interes_tramo" else f for f in _TRANCHE
)

STAGING = {
    "prestamo": _staging("stg_prestamo", _LOAN, ("numero_prestamo",), upper=("moneda_base_prestamo",)),
    "tramo": _staging("stg_tramo", _TRANCHE, ("numero_prestamo", "numero_tramo"), upper=("moneda_tramo",)),
    "acreedor": _staging("stg_acreedor", _CREDITOR, ("nombre_acreedor",)),
    "deudor": _staging("stg_deudor", _DEBTOR, ("deudor",)),
    "ley": _staging("stg_ley", _LAW, ("ley_numero",)),
    "deuda_corte": _staging(
        "stg_deuda_corte", _DEBT, ("numero_prestamo", "numero_tramo", "fecha_corte"), order=("fecha_corte",)
    ),
}

DIMENSIONS = {
    "prestamo": _dimension("dim_prestamo", "prestamo_key", _LOAN, ("numero_prestamo",)),
    "tramo": _dimension("dim_tramo", "tramo_key", _WIDE_TRANCHE, ("numero_prestamo", "numero_tramo")),
    "acreedor": _dimension("dim_acreedor", "acreedor_key", _CREDITOR, ("nombre_acreedor",)),
    "deudor": _dimension("dim_deudor", "deudor_key", _DEBTOR, ("deudor",)),
    "ley": _dimension("dim_ley", "ley_key", _LAW, ("ley_numero",)),
}

FACT = TableContract(
    "fact_deuda_corte",
    "warehouse",
    (
        typed("deuda_corte_key", "bigint", True),
        typed("prestamo_key", "bigint", True),
        typed("tramo_key", "bigint", True),
        *_DEBT,
        *_STAMPS,
        typed("execution_date", "date", True),
    ),
    ("numero_prestamo", "numero_tramo", "fecha_corte", "execution_date"),
    surrogate="deuda_corte_key",
    partition="execution_date",
    order=("fecha_corte",),
    references=(
        Reference(("numero_prestamo",), "dim_prestamo", "prestamo_key"),
        Reference(("numero_prestamo", "numero_tramo"), "dim_tramo", "tramo_key"),
    ),
)

# The log keeps every run column: a target that lacks some of them still takes the rest.
RUN_LOG = TableContract(
    "etl_run_log",
    "audit",
    (
        text("run_id", 250, True),
        text("dag_id", 250, True),
        text("task_id", 250, True),
        typed("execution_date", "date", True),
        text("status", 20, True),
        text("message", 2000),
        typed("created_at", "timestamp", True),
        text("stage", 50),
        text("dataset_name", 100),
        text("source", 100),
        text("target", 100),
        typed("started_at_utc", "timestamp"),
        typed("ended_at_utc", "timestamp"),
        text("error_message", 2000),
        typed("details_json", "string"),
        typed("raw_path", "string"),
    ),
    (),
)

PIPELINE_RUNS = TableContract(
    "pipeline_runs",
    "audit",
    (
        typed("audit_id", "bigint", True),
        text("pipeline_name", 100, True),
        text("stage", 50, True),
        text("dataset_name", 100, True),
        typed("execution_date", "date", True),
        text("status", 20, True),
        typed("pages_expected", "int"),
        typed("pages_loaded", "int"),
        text("missing_pages", 500),
        typed("started_at_utc", "timestamp", True),
        typed("ended_at_utc", "timestamp"),
        text("error_message", 2000),
        typed("created_at_utc", "timestamp", True),
    ),
    ("audit_id",),
    surrogate="audit_id",
)

DATABASES = ("stg", "mart", "audit", "warehouse")
ALL_TABLES = (*STAGING.values(), *DIMENSIONS.values(), FACT, RUN_LOG, PIPELINE_RUNS)


def record_fields() -> list[str]:
    """Business columns of one source record: every staging column, once."""
    names: dict[str, None] = {}
    for contract in STAGING.values():
        for name in contract.names:
            if name not in ("execution_date", "ingestion_timestamp"):
                names[name] = None
    return list(names)
