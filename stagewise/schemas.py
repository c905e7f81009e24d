"""Fixed vocabulary and layer schemas of the account-opening funnel.

Everything downstream (pivot columns, report codes, abandonment and
cumulative counts, conversion rows) is generated from ``STAGES``; no
report spells the six stages out by hand.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql.types import (
    DateType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


class Stage(NamedTuple):
    label: str   # value of the ``stage`` column in the source files
    column: str  # column name after the pivot
    code: str    # row label in the reports


# The six funnel stages in funnel order, as (source label,
# pivot column, report code). These must equal the source system's values.
STAGES: tuple[Stage, ...] = (
    Stage("Introduccion", "introduction", "TI"),
    Stage("Solicitud de datos", "data_request", "TSD"),
    Stage("Validacion de datos", "data_validation", "TVD"),
    Stage("Reconocimiento facial", "facial_recognition", "TRF"),
    Stage("Firma", "signature", "TF"),
    Stage("Confirmacion de datos", "data_confirmation", "TCD"),
)

STAGE_COLUMNS: tuple[str, ...] = tuple(s.column for s in STAGES)
STAGE_CODES: tuple[str, ...] = tuple(s.code for s in STAGES)
STAGE_LABEL_TO_COLUMN: dict[str, str] = {s.label: s.column for s in STAGES}

# Age buckets (inclusive bounds) and the catch-all label.
AGE_BUCKETS: tuple[tuple[int, int, str], ...] = (
    (18, 25, "18-25"),
    (26, 35, "26-35"),
    (36, 50, "36-50"),
)
AGE_OTHER = "50+"

# Data-quality rule of the enriched funnel rows.
QUALITY_PASSED = "Passed"
QUALITY_FAILED = "Not Passed"
CLIENT_ID_LENGTH = 5
VALID_COMPLETE_PROCESS = (0, 1)

# Landing file and bronze column names (source system's).
FUNNEL_FILE = "usuarios_banco_con_funnel"
CLIENTS_FILE = "clientes"
LOAD_TS_COLUMN = "fecha_ingesta"
FUNNEL_SOURCE_COLUMNS = ("ID_cliente", "App", "stage", "date", "Proceso_completo")
CLIENTS_SOURCE_COLUMNS = ("ID_cliente", "Nombre", "Correo", "Edad", "Estado")
FUNNEL_BRONZE_KEYS = ("ID_cliente", "stage")
CLIENTS_BRONZE_KEYS = ("ID_cliente",)

# Bronze -> silver conform specs: source column -> (silver column, type).
FUNNEL_CONFORM = {
    "ID_cliente": ("client_id", "string"),
    "App": ("app", "string"),
    "stage": ("stage", "string"),
    "date": ("register_date", "date"),
    "Proceso_completo": ("complete_process", "int"),
    LOAD_TS_COLUMN: ("ingestion_date", "timestamp"),
}
CLIENTS_CONFORM = {
    "ID_cliente": ("client_id", "string"),
    "Nombre": ("name", "string"),
    "Correo": ("email", "string"),
    "Edad": ("age", "int"),
    "Estado": ("state", "string"),
    LOAD_TS_COLUMN: ("ingestion_date", "timestamp"),
}


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


def landing_schema(columns: tuple[str, ...]) -> StructType:
    """All-string schema of a landing CSV (header on, no inference)."""
    return _schema(*[(c, StringType()) for c in columns])


SILVER_FUNNEL = _schema(
    ("client_id", StringType()),
    ("app", StringType()),
    ("stage", StringType()),
    ("register_date", DateType()),
    ("complete_process", IntegerType()),
    ("ingestion_date", TimestampType()),
)

SILVER_CATALOG = _schema(
    ("client_id", StringType()),
    ("name", StringType()),
    ("email", StringType()),
    ("age", IntegerType()),
    ("state", StringType()),
    ("ingestion_date", TimestampType()),
    ("update_date", TimestampType()),
)

GOLD_CLIENTS_FUNNEL = _schema(
    ("client_id", StringType()),
    ("name", StringType()),
    ("age", IntegerType()),
    ("state", StringType()),
    ("email", StringType()),
    ("app", StringType()),
    ("stage", StringType()),
    ("register_date", DateType()),
    ("complete_process", IntegerType()),
    ("quality_check", StringType()),
    ("ingestion_date", TimestampType()),
)

GOLD_PIVOT = _schema(
    ("client_id", StringType()),
    ("complete_process", IntegerType()),
    ("name", StringType()),
    ("age", IntegerType()),
    ("state", StringType()),
    ("email", StringType()),
    ("app", StringType()),
    *[(c, DateType()) for c in STAGE_COLUMNS],
    ("ingestion_time", TimestampType()),
    ("update_date", TimestampType()),
)

# Group keys of the reference pivot (client attributes + funnel attributes).
PIVOT_KEYS = ("client_id", "complete_process", "name", "age", "state", "email", "app")
CATALOG_ATTRS = ("name", "age", "state", "email")
