"""Table schemas of every layer and the write-time conform step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType, VariantType)


_TYPES = {"string": StringType(), "bigint": LongType(), "int": IntegerType(),
          "double": DoubleType(), "boolean": BooleanType()}


def _struct(spec: str) -> StructType:
    """``"a string, b bigint"`` -> StructType (flat columns of simple types)."""
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(StructField(name, _TYPES[typ]))
    return StructType(fields)


def _nested(name: str, inner: str) -> StructField:
    return StructField(name, _struct(inner))


# The field and column names below are the feed's data model
# (page files, Bronze, Silver, export and log records) and must stay as they
# are for existing pages, tables and exports to keep working.

# One sync page: header scalars and three arrays whose elements are kept as
# their JSON source text.  Elements of ``removed`` keep their JSON type: only
# strings and objects are ids.
PAGE = StructType([
    StructField("run_id", StringType()),
    StructField("run_ts", StringType()),
    StructField("mode", StringType()),
    StructField("institution", StringType()),
    StructField("item_id", StringType()),
    StructField("plaid_env", StringType()),
    StructField("cursor_in", StringType()),
    StructField("cursor_out", StringType()),
    StructField("has_more", BooleanType()),
    StructField("added", ArrayType(StringType())),
    StructField("modified", ArrayType(StringType())),
    StructField("removed", ArrayType(VariantType())),
])

# Fields of a transaction object that are read into columns.  amount and
# pending are read as text and cast with try_cast so failures can be counted.
TX = StructType(
    _struct("transaction_id string, account_id string, amount string, "
            "iso_currency_code string, date string, authorized_date string, "
            "name string, merchant_name string, pending string, "
            "payment_channel string").fields
    + [_nested("personal_finance_category",
               "primary string, detailed string, confidence_level string"),
       _nested("location", "city string, region string, country string")])

PAYLOAD_COLUMNS = [
    "account_id", "amount", "iso_currency_code", "date", "authorized_date",
    "name", "merchant_name", "pending", "payment_channel", "pfc_primary",
    "pfc_detailed", "pfc_confidence", "city", "region", "country",
]

BRONZE = _struct(
    "plaid_env string, run_id string, run_ts string, event_date string, "
    "event_year bigint, event_month bigint, mode string, institution string, "
    "item_id string, cursor_in string, cursor_out string, has_more boolean, "
    "page_path string, event_type string, transaction_id string, event_id string, "
    "account_id string, amount double, iso_currency_code string, date string, "
    "authorized_date string, name string, merchant_name string, pending boolean, "
    "payment_channel string, pfc_primary string, pfc_detailed string, "
    "pfc_confidence string, city string, region string, country string, "
    "raw_transaction_json string, ingested_at string, "
    # ours: explicit order inside one run (page, type, array position)
    "page_name string, type_ord int, pos bigint")

SILVER = _struct(
    "plaid_env string, institution string, item_id string, transaction_id string, "
    "account_id string, amount double, iso_currency_code string, date string, "
    "authorized_date string, name string, merchant_name string, pending boolean, "
    "payment_channel string, pfc_primary string, pfc_detailed string, "
    "pfc_confidence string, city string, region string, country string, "
    "valid_from_ts string, valid_to_ts string, is_current boolean, "
    "is_active boolean, is_deleted boolean, change_type string, version bigint, "
    "source_event_id string, source_event_type string, source_run_id string, "
    "source_run_ts string, source_page_path string, silver_built_at string, "
    "txn_year bigint, txn_month bigint")

# Export columns, fixed order.
EXPORT_COLUMNS = [
    "plaid_env", "institution", "item_id", "account_id", "transaction_id", "date",
    "authorized_date", "amount", "iso_currency_code", "name", "merchant_name",
    "pending", "payment_channel", "pfc_primary", "pfc_detailed", "pfc_confidence",
    "city", "region", "country", "is_current", "is_active", "is_deleted",
    "change_type", "version", "valid_from_ts", "valid_to_ts", "source_event_type",
    "source_run_ts", "silver_built_at",
]

LEDGER = _struct("ts string, run_id string, page_path string, "
                 # ours: the Bronze batch of a page; a file read to its end
                 "batch bigint, source string")

QUARANTINE = _struct("ts string, page_path string, run_id string, content string")

SYNC_LOG = _struct(
    "timestamp string, plaid_env string, silver_delta_path string, "
    "spreadsheet_id string, worksheet_name string, export_mode string, "
    "rows_synced bigint, last_synced_valid_from_ts string, "
    # ours: number and state of the run (begun, done), the watermark as an
    # instant, and the last build that was exported from
    "export_id bigint, state string, last_synced_key string, last_built_at string")

ERROR = StructType(
    _struct("type string, message string, status bigint, reason string").fields
    + [_nested("plaid", "error_type string, error_code string, error_message string, "
               "display_message string, request_id string, documentation_url string, "
               "suggested_action string"),
       StructField("body", StringType())])

RUNS_LOG = StructType([
    StructField("ts", StringType()), StructField("run_id", StringType()),
    StructField("institution", StringType()), StructField("item_id", StringType()),
    StructField("mode", StringType()), StructField("event", StringType()),
    StructField("page", LongType()), StructField("cursor_in", StringType()),
    StructField("error", StringType()),
])

_NUMERIC = (LongType, IntegerType, DoubleType)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: missing columns become typed nulls,
    unknown columns are dropped, order is fixed, types are cast with
    ``try_cast`` (a value that does not cast becomes null; see quality D8).
    Built as one ``selectExpr`` over fixed column names and types."""
    have = {f.name: f.dataType for f in df.schema.fields}
    exprs: list[str] = []
    for f in schema.fields:
        name, typ = f"`{f.name}`", f.dataType.simpleString()
        if f.name not in have:
            exprs.append(f"CAST(NULL AS {typ}) AS {name}")
        elif have[f.name] == f.dataType:
            exprs.append(name)
        else:
            exprs.append(f"try_cast({name} AS {typ}) AS {name}")
    return df.selectExpr(*exprs)


def require_columns(df: DataFrame, required) -> None:
    """Raise when any required column is absent (quality D7)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"table is missing required columns: {missing}")
