"""Cash (area: Caixa)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import code_filter, month_name_pt, year_month
from ledgerlens.operators import (
    conditional_count,
    conditional_sum,
    expression_group,
    having_filter,
    ordered_output,
    scope_filter,
)

CASH_ACCOUNT = "1.1.01.01.003"


def cax02_cash_over_limit(gl_tx: DataFrame, *, establishments, start, end,
                          account: str = CASH_ACCOUNT, limit=20000, ordered: bool = True) -> DataFrame:
    """CAX.02: per establishment, month and account, debit (> 0) and credit (< 0)
    sums and counts and the net; keep the months whose debit total exceeds ``limit``."""
    df = scope_filter(gl_tx, establishments=establishments, date_col="data_transacao", start=start, end=end)
    df = df.filter(code_filter("conta_contabil", include=account))
    v = F.col("valor_moeda")
    year, month = year_month("data_transacao")
    g = expression_group(df, {"cod_estabelecimento": F.col("cod_estabelecimento"), "ano": year, "mes": month,
                              "conta_contabil": F.col("conta_contabil"), "nome_conta": F.col("nome_conta")}, [
        conditional_sum(v, v > 0).alias("total_debito_mensal"),
        conditional_count(v > 0).alias("total_transacoes_debito"),
        conditional_sum(v, v < 0).alias("total_credito_mensal"),
        conditional_count(v < 0).alias("total_transacoes_credito"),
        F.sum(v).alias("total_liquido_mensal"),
    ])
    g = having_filter(g, F.col("total_debito_mensal") > limit)
    out = g.select("cod_estabelecimento", "ano", "mes", month_name_pt(month=F.col("mes")).alias("nome_mes"),
                   "conta_contabil", "nome_conta", "total_debito_mensal", "total_transacoes_debito",
                   "total_credito_mensal", "total_transacoes_credito", "total_liquido_mensal")
    return ordered_output(out, ["ano", "mes"], ordered)
