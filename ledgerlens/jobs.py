"""Batch job: run audit checks over stored views and write every result as a table.

    spark-submit ledgerlens/jobs.py config.json

``config.json``::

    {"views": {"supplier_transactions": {"path": "s3://.../supplier_transactions"}, ...},
     "checks": {"afo01_supplier_advances": {"establishments": ["R351"], "base_date": "2025-12-31"}, ...},
     "output": "s3://.../audit", "run_id": "2025-12-31", "collation": null, "format": "parquet"}

Each check is computed once and written under ``<output>/<run_id>/<key>``
(overwrite, so a re-run after a failure is idempotent); the summary
(``<output>/<run_id>/_suite``) counts the written tables instead of
recomputing the checks. Views may also come from JDBC (``{"jdbc": {...}}``).
"""

from __future__ import annotations

import datetime as _dt
import json
import sys
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.constants import CONFIRM_DEFAULT_TIMEOUT_SECONDS
from ledgerlens.plans.confirm import confirm_messages, confirm_outcomes, confirm_report
from ledgerlens.plans.suite import CATALOG, params_text, run_check
from ledgerlens.sources.contacts import confirm_contacts, read_contacts_csv
from ledgerlens.sources.sinks import confirm_results
from ledgerlens.sources.views import load_view

_DATE_KEYS = {"base_date", "start", "end", "as_of", "settled_from"}


def _params(raw: Mapping) -> dict:
    out = dict(raw)
    for k in _DATE_KEYS & out.keys():
        if isinstance(out[k], str):
            out[k] = _dt.date.fromisoformat(out[k])
    if "holidays" in out:
        out["holidays"] = [_dt.date.fromisoformat(d) if isinstance(d, str) else d for d in out["holidays"]]
    return out


def run_audit(spark: SparkSession, views: Mapping[str, DataFrame], checks: Mapping[str, Mapping], *,
              output: str, run_id: str, collation: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Write each check's result and return the summary read back from the written tables."""
    base = f"{output.rstrip('/')}/{run_id}"
    summary = []
    for key, raw in checks.items():
        params = _params(raw)
        path = f"{base}/{key}"
        run_check(key, views, params, collation=collation).write.mode("overwrite").format(fmt).save(path)
        written = spark.read.format(fmt).load(path)
        check = CATALOG[key]
        summary.append(written.agg(F.count(F.lit(1)).alias("rows_found")).select(
            F.lit(key).alias("check"), F.lit(check.code).alias("code"), F.lit(check.area).alias("area"),
            F.lit(params_text(params)).alias("parameters"), F.lit(path).alias("path"), "rows_found"))
    out = summary[0]
    for s in summary[1:]:
        out = out.unionByName(s)
    out.write.mode("overwrite").format(fmt).save(f"{base}/_suite")
    return spark.read.format(fmt).load(f"{base}/_suite")


def prepare_confirmation(spark: SparkSession, contacts_csv: str, output: str, *, company: str,
                         template: str, contact_key: str | None = None) -> DataFrame:
    """Contact sheet -> message table (one row per contact, sanitized message text),
    written to ``<output>/mensagens`` for the sending side; returns it read back."""
    contacts = confirm_contacts(read_contacts_csv(spark, contacts_csv))
    if contact_key is None:
        contacts = contacts.withColumn("contact_id", F.monotonically_increasing_id())
    elif contact_key != "contact_id":
        contacts = contacts.withColumnRenamed(contact_key, "contact_id")
    path = f"{output.rstrip('/')}/mensagens"
    confirm_messages(contacts, company=company, template=template).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def finish_confirmation(spark: SparkSession, prepared: DataFrame, sent: DataFrame, replies: DataFrame,
                        output: str, *, run_ts: _dt.datetime,
                        timeout_seconds: int = CONFIRM_DEFAULT_TIMEOUT_SECONDS) -> DataFrame:
    """Match replies to sent messages and write the outcome table (fixed schema) to
    ``<output>/resultados``; returns it read back."""
    outcomes = confirm_outcomes(sent, replies, timeout_seconds=timeout_seconds)
    path = f"{output.rstrip('/')}/resultados"
    confirm_results(confirm_report(prepared, outcomes, run_ts=run_ts, timeout_seconds=timeout_seconds), path)
    return spark.read.parquet(path)


def main(argv: list[str]) -> int:
    with open(argv[1], encoding="utf-8") as f:
        cfg = json.load(f)
    spark = SparkSession.builder.appName("ledgerlens-audit").getOrCreate()
    views = {name: load_view(spark, name, **spec) for name, spec in cfg["views"].items()}
    run_audit(spark, views, cfg["checks"], output=cfg["output"], run_id=cfg["run_id"],
              collation=cfg.get("collation"), fmt=cfg.get("format", "parquet"))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
