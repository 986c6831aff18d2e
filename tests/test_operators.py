"""DataFrame operators on small hand-made frames."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlens.operators import (
    aggregate_arithmetic,
    any_label,
    conditional_counts,
    conditional_sums,
    constant_label,
    distinct_count_having,
    distinct_rows,
    expression_group,
    grouped_sum,
    having_filter,
    label_aggregate,
    member_filter,
    ordered_output,
    scope_filter,
    semi_join_back,
)
from ledgerlens.functions import numeric_threshold

D = dt.date


def _ledger(spark):
    rows = [("R1", "A", D(2025, 1, 5), "ABERTO", Decimal("10.00"), "n1"),
            ("R1", "A", D(2025, 2, 5), "FECHADO", Decimal("-4.00"), "n2"),
            ("R1", "B", D(2025, 2, 6), "ABERTO", Decimal("7.00"), "n2"),
            ("R2", "C", D(2024, 12, 31), "ABERTO", Decimal("1.00"), None),
            ("R1", "A", D(2025, 3, 1), "ABERTO", None, "n3")]
    return spark.createDataFrame(rows, "est string, k string, d date, status string, v decimal(18,2), nota string")


def test_scope_filter_bounds(spark):
    df = _ledger(spark)
    assert scope_filter(df, establishments="R1", establishment_col="est").count() == 4
    assert scope_filter(df, establishments=None, date_col="d", start=D(2025, 2, 1)).count() == 3
    assert scope_filter(df, establishments=["R1", "R2"], date_col="d", end="2025-01-31",
                        establishment_col="est").count() == 2
    assert scope_filter(df, establishments=["R1"], date_col="d", start="2025-02-05", end=D(2025, 2, 6),
                        establishment_col="est").count() == 2


def test_conditional_sums_counts_and_arithmetic(spark):
    df = _ledger(spark)
    is_open = F.col("status") == "ABERTO"
    sums = conditional_sums(df, "k", "v", {"aberto": is_open, "fechado": ~is_open})
    counts = conditional_counts(df, "k", {"n_aberto": is_open})
    out = aggregate_arithmetic(sums.join(counts, "k"), {"liquido": F.col("aberto") + F.col("fechado")})
    got = {r.k: (r.aberto, r.fechado, r.n_aberto, r.liquido) for r in out.collect()}
    assert got["A"] == (Decimal("10.00"), Decimal("-4.00"), 2, Decimal("6.00"))
    assert got["C"] == (Decimal("1.00"), Decimal("0.00"), 1, Decimal("1.00"))


def test_grouped_sum_any_label_and_label_aggregate_agree(spark):
    df = _ledger(spark)
    a = grouped_sum(df, ["est"], {"total": "v"})
    assert {r.est: r.total for r in a.collect()} == {"R1": Decimal("13.00"), "R2": Decimal("1.00")}
    direct = df.groupBy("est").agg(*any_label(["k", "nota"]), F.sum("v").alias("total"),
                                   F.count(F.when(F.col("status") == "ABERTO", 1)).alias("n"))
    two_phase = label_aggregate(df, "est", labels={"k": "k", "nota": "nota"}, sums={"total": F.col("v")},
                                counts={"n": F.when(F.col("status") == "ABERTO", 1)})
    assert sorted(direct.collect()) == sorted(two_phase.select(*direct.columns).collect())
    assert two_phase.schema["total"].dataType == direct.schema["total"].dataType


def test_distinct_count_having_semi_join_and_having(spark):
    df = _ledger(spark)
    keys = distinct_count_having(df, "k", "nota", 1, name="n")
    assert [(r.k, r.n) for r in keys.collect()] == [("A", 3)]
    assert semi_join_back(df, keys, "k").count() == 3
    g = df.groupBy("est").agg(F.sum("v").alias("t"))
    assert [r.est for r in having_filter(g, numeric_threshold("t", 5)).collect()] == ["R1"]


def test_distinct_rows_and_expression_group(spark):
    df = _ledger(spark)
    assert distinct_rows(df, ["est", "k"]).count() == 3
    g = expression_group(df, {"ano": F.year("d"), "mes": F.month("d")}, [F.count(F.lit(1)).alias("n")])
    assert sorted((r.ano, r.mes, r.n) for r in g.collect()) == [(2024, 12, 1), (2025, 1, 1), (2025, 2, 2),
                                                                (2025, 3, 1)]


def test_member_filter_list_and_constant_label_and_order(spark):
    df = _ledger(spark)
    assert member_filter(df, "k", ["A", "C"]).count() == 4
    out = ordered_output(constant_label(df, "est", "GRUPO"), [F.col("d").desc(), "k"])
    rows = out.collect()
    assert {r.est for r in rows} == {"GRUPO"} and rows[0].d == D(2025, 3, 1) and rows[-1].d == D(2024, 12, 31)
    assert ordered_output(df, ["d"], ordered=False) is df


def test_scale_conf_sizes_partitions_in_core_waves():
    from ledgerlens.session import scale_conf

    conf = scale_conf(100 * 1024 ** 4, 8000)
    parts = int(conf["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and parts * 256 * 1024 ** 2 >= 25 * 1024 ** 4
    assert int(scale_conf(10 * 1024 ** 2, 16)["spark.sql.shuffle.partitions"]) == 16
