"""Supplier advances (area: Adiantamentos a Fornecedores)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.constants import PROFILE_SUPPLIER_ADVANCE, STATUS_CLOSED, STATUS_OPEN
from ledgerlens.functions import base_date_shift, code_filter, open_as_of
from ledgerlens.operators import label_aggregate, ordered_output, scope_filter


def afo01_supplier_advances(supplier_tx: DataFrame, *, establishments: Iterable[str] | str,
                            base_date, profile: str = PROFILE_SUPPLIER_ADVANCE,
                            statuses: Iterable[str] = (STATUS_OPEN, STATUS_CLOSED),
                            ordered: bool = True) -> DataFrame:
    """AFO.01: per establishment and supplier, advances still unsettled at ``base_date``.

    Rows: transaction on or before the base date, settled after it (or never),
    of the advance profile and an open/closed status. Sums and counts split by
    status; groups whose total is 0 are dropped; largest open amount first.
    """
    df = scope_filter(supplier_tx, establishments=establishments, date_col="data_transacao", end=base_date)
    df = df.filter(open_as_of("data_liquidacao", base_date_shift(base_date, 1), inclusive=True)
                   & code_filter("perfil_lanc", include=profile)
                   & code_filter("status", include=statuses))
    is_open = F.col("status") == STATUS_OPEN
    is_closed = F.col("status") == STATUS_CLOSED
    v = F.col("valor_moeda")
    g = label_aggregate(
        df, ["cod_estabelecimento", "cod_fornecedor"],
        labels={"cnpj_cpf": "cnpj_cpf", "nome_fornecedor": "nome_fornecedor", "perfil_lanc": "perfil_lanc"},
        sums={"valor_aberto": F.when(is_open, v).otherwise(F.lit(0)),
              "valor_fechado": F.when(is_closed, v).otherwise(F.lit(0)),
              "valor_total": v},
        counts={"qtd_aberto": F.when(is_open, F.lit(1)), "qtd_fechado": F.when(is_closed, F.lit(1))},
    )
    g = g.filter(F.col("valor_total") != 0).withColumn("qtd_total", F.col("qtd_aberto") + F.col("qtd_fechado"))
    return ordered_output(g, [F.col("valor_aberto").desc()], ordered)
