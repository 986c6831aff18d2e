"""Debit notes and returned batteries (area: BIN)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.constants import NO_FINANCE_OPERATION_LABELS, PROFILE_DEBIT_NOTE
from ledgerlens.functions import code_filter, operation_label, reversal_exclude
from ledgerlens.operators import (
    constant_label,
    count_over,
    distinct_count_having,
    grouped_sum,
    ordered_output,
    scope_filter,
    semi_join_back,
)

CLOSED_DETAIL_COLUMNS = (
    "cod_estabelecimento", "cod_cliente", "nome_cliente", "data_transacao", "data_vencimento",
    "perfil_lancamento", "nota_fiscal", "comprovante", "parcela", "valor_parcela", "valor_titulo",
)


def _debit_notes(closed_tx: DataFrame, establishments, start, end, profile) -> DataFrame:
    df = scope_filter(closed_tx, establishments=establishments, date_col="data_transacao",
                      start=start, end=end)
    return df.filter(code_filter("perfil_lancamento", include=profile))


def bin01_note_summary(closed_tx: DataFrame, *, establishments, start, end,
                       profile: str = PROFILE_DEBIT_NOTE, more_than: int = 2,
                       group_label: str, ordered: bool = True) -> DataFrame:
    """BIN.01 summary: customers (code and name) with more than ``more_than`` distinct
    debit notes in scope, with the sum of their instalments; the establishment
    column carries ``group_label``."""
    df = _debit_notes(closed_tx, establishments, start, end, profile)
    g = distinct_count_having(df, ["cod_cliente", "nome_cliente"], "nota_fiscal", more_than,
                              name="total_nf_diferentes",
                              extra=[F.sum("valor_parcela").alias("valor_total")])
    out = constant_label(g, "cod_estabelecimento", group_label).select(
        "cod_estabelecimento", "cod_cliente", "nome_cliente", "total_nf_diferentes", "valor_total")
    return ordered_output(out, [F.col("total_nf_diferentes").desc(), F.col("valor_total").desc()], ordered)


def bin01_note_detail(closed_tx: DataFrame, *, establishments, start, end,
                      profile: str = PROFILE_DEBIT_NOTE, more_than: int = 2,
                      ordered: bool = True) -> DataFrame:
    """BIN.01 detail: every in-scope row of customers (by code only) with more than
    ``more_than`` distinct debit notes. A left-semi join back on the qualifying
    codes: one row per code on the right, so it equals the inner join and never
    multiplies rows."""
    df = _debit_notes(closed_tx, establishments, start, end, profile)
    keys = distinct_count_having(df, "cod_cliente", "nota_fiscal", more_than, name="qtd_notas_fiscais")
    out = semi_join_back(df, keys, "cod_cliente").select(*CLOSED_DETAIL_COLUMNS)
    return ordered_output(out, ["cod_cliente", "nota_fiscal", "data_transacao", "parcela"], ordered)


def bin02_split_notes(closed_tx: DataFrame, *, establishments, start, end,
                      profile: str = PROFILE_DEBIT_NOTE, more_than: int = 1,
                      ordered: bool = True) -> DataFrame:
    """BIN.02: in-scope debit-note rows whose (customer, note) occurs more than
    ``more_than`` times (instalments), with ``qtd_repeticao_nota``.

    The audited text inner-joins a per-customer aggregate without HAVING, whose
    only effect is to drop NULL customers; that join is replaced by the filter.
    """
    df = _debit_notes(closed_tx, establishments, start, end, profile)
    df = df.filter(F.col("cod_cliente").isNotNull()).select(*CLOSED_DETAIL_COLUMNS)
    out = count_over(df, ["cod_cliente", "nota_fiscal"], "nota_fiscal", more_than=more_than,
                     name="qtd_repeticao_nota")
    return ordered_output(out, ["cod_cliente", "nota_fiscal", "data_transacao", "parcela"], ordered)


def bin06_no_finance_moves(stock_moves: DataFrame, *, establishments, start, end,
                           op_labels: Mapping[str, str] = NO_FINANCE_OPERATION_LABELS,
                           operations: Iterable[str] | None = None,
                           ordered: bool = True) -> DataFrame:
    """BIN.06: stock moves of customers without finance, reversals excluded: quantity
    per establishment, depot, date, note and operation, labelled entry/exit.

    ``desc_tipo_operacao`` stays a grouping key although it is not returned, so
    rows that differ only in it appear separately, as in the audited query.
    """
    ops = list(op_labels) if operations is None else list(operations)
    df = scope_filter(stock_moves, establishments=establishments, date_col="data", start=start, end=end)
    df = df.filter(code_filter("tipo_operacao", include=ops) & reversal_exclude("num_nota_fiscal"))
    g = grouped_sum(df, ["cod_estabelecimento", "deposito", "data", "num_nota_fiscal", "tipo_operacao",
                         "desc_tipo_operacao"], {"quantidade": "qtd"})
    out = g.select("cod_estabelecimento", "deposito", "data", "num_nota_fiscal", "quantidade",
                   "tipo_operacao", operation_label("tipo_operacao", dict(op_labels)).alias("desc_operacao"))
    return ordered_output(out, [F.col("data").desc(), F.col("num_nota_fiscal")], ordered)


def bin01_report(closed_tx: DataFrame, path: str, *, establishments, start, end, group_label: str,
                 profile: str = PROFILE_DEBIT_NOTE, more_than: int = 2, run_id: str | None = None,
                 fmt: str = "parquet", reuse_scope: bool = True) -> dict[str, str]:
    """BIN.01 as one report: the summary and the detail written together under
    ``path/<run_id>/``, dates as ``dd/MM/yyyy`` text in the detail only, numbers kept
    numeric. ``run_id`` defaults to the scope (establishments and end date) and the time
    of the run, so a later run never overwrites an earlier report. Both tables are computed and written by Spark;
    nothing passes through the driver. Returns the two paths.

    With ``reuse_scope`` the scoped, column-pruned debit notes are checkpointed
    once into the cluster's ``spark.checkpoint.dir`` (a reliable checkpoint, not a
    local one), so the ledger is scanned once instead of three times (summary,
    detail, qualifying customers) and the outputs do not depend on that lineage.
    """
    from ledgerlens.functions._util import to_date_value
    from ledgerlens.session import checkpoint_dir
    from ledgerlens.sources.sinks import write_report

    ests = [establishments] if isinstance(establishments, str) else list(establishments)
    run_id = run_id or f"BIN01_{'-'.join(ests)}_{to_date_value(end):%Y%m%d}_{_dt.datetime.now():%Y%m%d%H%M%S%f}"
    kw = dict(establishments=ests, start=start, end=end, profile=profile, more_than=more_than)
    source = closed_tx
    if reuse_scope:
        spark = closed_tx.sparkSession
        checkpoint_dir(spark, local_fallback=True)   # raises on a cluster without a shared folder
        source = _debit_notes(closed_tx, ests, start, end, profile).select(*CLOSED_DETAIL_COLUMNS).checkpoint()
    summary = bin01_note_summary(source, group_label=group_label, **kw)
    detail = bin01_note_detail(source, **kw)
    return write_report(summary, detail, path, run_id=run_id, fmt=fmt,
                        date_columns=("data_transacao", "data_vencimento"))
