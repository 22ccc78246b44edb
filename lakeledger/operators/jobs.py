"""End-to-end batch jobs: pages -> Bronze -> Silver -> checks -> export.

Each job is one Spark action (or a few) over whole tables and returns its
row totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeledger.operators import bronze as B
from lakeledger.operators import export as X
from lakeledger.operators import quality as Q
from lakeledger.operators import silver as SV
from lakeledger.operators import views as V
from lakeledger.operators.silver import now_iso
from lakeledger.sources import layout as L
from lakeledger.sources import pages as P


def run_bronze(spark: SparkSession, pages_root: str, bronze_path: str, ledger_path: str,
               now: str | None = None, prefix: str = "", default_env: str = "sandbox",
               institution: str | None = None, item_id: str | None = None) -> dict:
    """Ingest new pages, of one institution or item if given; returns {pages, rows}."""
    return B.ingest(spark, pages_root, bronze_path, ledger_path, now, prefix, default_env,
                    institution=institution, item_id=item_id)


def run_silver(spark: SparkSession, bronze_path: str, silver_path: str,
               built_at: str | None = None, form: str = "auto") -> dict:
    """Full rebuild of Silver from Bronze, in Bronze's key layout; returns
    {bronze_rows, silver_rows}."""
    built_at = built_at or now_iso()
    bronze = B.read_bronze(spark, bronze_path)
    SV.write_silver(SV.silver_from_bronze(bronze, built_at, form), silver_path,
                    L.stored(spark, silver_path) or L.stored(spark, bronze_path))
    # Counts of stored rows read no columns.
    return {"bronze_rows": bronze.count(), "silver_rows": SV.read_silver(spark, silver_path).count()}


def run_checks(spark: SparkSession, silver_path: str, raise_on_failure: bool = True,
               bronze_path: str | None = None, pages_root: str | None = None) -> DataFrame:
    """Integrity checks on the current Silver and, if given, on Bronze and on
    values of the landed pages that did not cast; registers the three views."""
    silver = SV.read_silver(spark, silver_path)
    V.register(silver)
    checks = Q.check_silver(silver)
    if bronze_path is not None:
        raw = None
        if pages_root is not None:
            raw = B.raw_payload_failures(P.read_pages(spark, pages_root))
        checks = checks.unionByName(Q.check_bronze(B.read_bronze(spark, bronze_path), raw),
                                    allowMissingColumns=True)
    checks = checks.cache()  # a handful of rows, used twice
    if raise_on_failure:
        Q.assert_all(checks)
    return checks


def run_export(spark: SparkSession, silver_path: str, target: str, log_path: str,
               mode: str = "current", env: str = "sandbox", worksheet: str = "transactions",
               now: str | None = None, mark: str = "text") -> dict:
    silver = SV.read_silver(spark, silver_path)
    return X.incremental_export(spark, silver, target, log_path, mode, env, worksheet,
                                table_path=silver_path, now=now, mark=mark)
