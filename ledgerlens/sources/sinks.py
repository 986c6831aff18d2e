"""Writing check results: report tables, confirmation outcomes, billing extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.constants import CONFIRM_RESULT_COLUMNS
from ledgerlens.functions.dates import date_text

CONFIRM_RESULT_SCHEMA = T.StructType([
    T.StructField("nome_cliente", T.StringType(), True),
    T.StructField("telefone", T.StringType(), True),
    T.StructField("notas_fiscais", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("resposta", T.StringType(), True),
    T.StructField("data_hora", T.TimestampType(), True),
])


def format_dates(df: DataFrame, date_columns: Sequence[str], pattern: str = "dd/MM/yyyy") -> DataFrame:
    """Dates rendered as text; numbers stay numeric."""
    out = df
    for c in date_columns:
        if c in df.columns:
            out = out.withColumn(c, date_text(c, pattern))
    return out


def write_report(summary: DataFrame, detail: DataFrame, path: str, *, run_id: str,
                 date_columns: Sequence[str] = ("data_transacao", "data_vencimento"),
                 fmt: str = "parquet") -> dict[str, str]:
    """Save a summary table and a detail table under ``path/<run_id>/``.

    Dates are rendered ``dd/MM/yyyy`` in the detail only. Both writes are
    distributed; nothing is collected. Returns the two output paths.
    """
    base = f"{path.rstrip('/')}/{run_id}"
    out = {"summary": f"{base}/summary", "detail": f"{base}/detail"}
    writer_opts = {"header": "true"} if fmt == "csv" else {}
    summary.write.mode("overwrite").options(**writer_opts).format(fmt).save(out["summary"])
    format_dates(detail, date_columns).write.mode("overwrite").options(**writer_opts).format(fmt).save(out["detail"])
    return out


def confirm_results(outcomes: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    """Write confirmation outcomes with the fixed six-column schema, also when empty."""
    cols = []
    for f in CONFIRM_RESULT_SCHEMA.fields:
        src = F.col(f.name) if f.name in outcomes.columns else F.lit(None)
        cols.append(src.cast(f.dataType).alias(f.name))
    outcomes.select(*cols).write.mode("overwrite").format(fmt).save(path)


def write_partitioned(df: DataFrame, path: str, *, partition_by: Sequence[str],
                      fmt: str = "parquet", mode: str = "overwrite",
                      max_records_per_file: int = 5_000_000) -> None:
    """A partitioned table write, rebalanced by the partition columns (see ``materialize_view``)."""
    (df.hint("rebalance", *partition_by).write.mode(mode).format(fmt).option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(*partition_by).save(path))


assert tuple(f.name for f in CONFIRM_RESULT_SCHEMA.fields) == CONFIRM_RESULT_COLUMNS
