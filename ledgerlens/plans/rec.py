"""Revenue (area: Receita) and the billing extract."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.constants import SALES_CFOPS
from ledgerlens.functions import holiday_flag, month_end_exclude, reversal_exclude, weekday_name, weekend_flag
from ledgerlens.operators import member_filter, ordered_output, scope_condition, scope_filter
from ledgerlens.sources.sinks import write_partitioned


def rec07_weekend_holiday_billing(sales_orders: DataFrame, *, establishments, start, end,
                                  holidays: Iterable, cfops: Iterable[str] = SALES_CFOPS,
                                  month_end_days: int = 3,
                                  weekday_labels: Mapping[str, str] | None = None,
                                  ordered: bool = True) -> DataFrame:
    """REC.07: billed sales with a sales CFOP, no reversal, invoiced on a Saturday,
    Sunday or one of ``holidays``, outside the last ``month_end_days`` days of the
    month; weight and value per customer, note and CFOP, with the weekday name."""
    d = F.col("data_nota_fiscal")
    df = scope_filter(sales_orders, establishments=establishments, date_col="data_nota_fiscal",
                      start=start, end=end)
    df = member_filter(df, "cfop", list(cfops)).filter((F.col("para_faturamento") == "Sim")
                   & reversal_exclude("num_nota_fiscal")
                   & (weekend_flag(d) | holiday_flag(d, holidays))
                   & month_end_exclude(d, month_end_days))
    g = df.groupBy("cod_cliente", "cod_estabelecimento", "nome_cliente", "cpf_cnpj", "data_nota_fiscal",
                   "num_nota_fiscal", "cfop").agg(
        F.sum("peso_bin").alias("peso_bin_total"),
        F.sum("valor").alias("valor_total"),
    )
    out = g.withColumn("dia_semana", weekday_name("data_nota_fiscal", dict(weekday_labels or {})))
    return ordered_output(out, ["cod_cliente", "data_nota_fiscal", "num_nota_fiscal"], ordered)


def billing_rows(*, establishments, start, end, **_) -> Column:
    """The rows of the billing extract."""
    return scope_condition(establishments=establishments, date_col="data_nota_fiscal", start=start, end=end)


def billing_extract(sales_orders: DataFrame, *, establishments, start, end) -> DataFrame:
    """All billing rows of the given establishments in a date range, every column."""
    return sales_orders.filter(billing_rows(establishments=establishments, start=start, end=end))


def write_billing_extract(sales_orders: DataFrame, path: str, *, establishments, start, end,
                          fmt: str = "parquet") -> None:
    """Export the extract partitioned by establishment (distributed write, no driver round trip)."""
    write_partitioned(billing_extract(sales_orders, establishments=establishments, start=start, end=end),
                      path, partition_by=["cod_estabelecimento"], fmt=fmt)
