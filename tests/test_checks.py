"""Audit checks on hand-made ledger rows and properties on the fixture views."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from paths import SF_SMALL
from ledgerlens import fixture as fx
from ledgerlens.plans import (
    afo01_supplier_advances,
    bin01_note_detail,
    bin01_note_summary,
    bin02_split_notes,
    cax02_cash_over_limit,
    car04_individual_billing,
    car05_advance_offset,
    car07_open_bin_overdue,
    car10_multiple_advances,
    rec07_weekend_holiday_billing,
)
from ledgerlens.operators import count_over, count_rows_over
from ledgerlens.sources import VIEW_SCHEMAS
from ledgerlens.sources import testdata_view as derived_view

D = dt.date
SENT = D(1900, 1, 1)


def _view(spark, name, rows):
    return spark.createDataFrame(rows, VIEW_SCHEMAS[name])


def _sup(est, forn, nome, cpf, tx, due, liq, perfil, status, nf, valor):
    return (est, forn, nome, cpf, tx, due, liq, perfil, status, nf, Decimal(valor))


def test_afo01_open_closed_total_and_zero_drop(spark):
    rows = [
        _sup("R351", "F1", "Ana", "1", D(2025, 5, 1), None, SENT, "AFO", "ABERTO", "1", "100.00"),
        _sup("R351", "F1", "Ana", "1", D(2025, 6, 1), None, D(2026, 1, 1), "AFO", "FECHADO", "2", "50.00"),
        _sup("R351", "F1", "Ana", "1", D(2025, 6, 1), None, D(2025, 12, 31), "AFO", "FECHADO", "3", "70.00"),
        _sup("R351", "F2", "Bia", "2", D(2025, 6, 1), None, SENT, "AFO", "ABERTO", "4", "10.00"),
        _sup("R351", "F2", "Bia", "2", D(2025, 6, 2), None, SENT, "AFO", "ABERTO", "5", "-10.00"),
        _sup("R352", "F3", "Cris", "3", D(2026, 1, 2), None, SENT, "AFO", "ABERTO", "6", "9.00"),
        _sup("R351", "F4", "Duda", "4", D(2025, 1, 2), None, SENT, "AVI", "ABERTO", "7", "9.00"),
    ]
    out = afo01_supplier_advances(_view(spark, "supplier_transactions", rows), establishments=["R351", "R352"],
                                  base_date=D(2025, 12, 31)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.cod_fornecedor, r.valor_aberto, r.valor_fechado, r.valor_total) == (
        "F1", Decimal("100.00"), Decimal("50.00"), Decimal("150.00"))
    assert (r.qtd_aberto, r.qtd_fechado, r.qtd_total) == (1, 1, 2)
    assert r.valor_aberto + r.valor_fechado == r.valor_total


def _closed(cli, nome, nf, parcela, valor, tx=D(2025, 8, 1)):
    return ("R291", cli, nome, tx, tx, "TND", nf, f"V{nf}-{parcela}", parcela, Decimal(valor), Decimal("999.00"))


def test_bin01_two_names_and_detail(spark):
    rows = [_closed("C1", "Ana", "1", 1, "10"), _closed("C1", "Ana", "2", 1, "10"),
            _closed("C1", "Ana S", "3", 1, "10"), _closed("C2", "Bia", "4", 1, "5"),
            _closed("C2", "Bia", "5", 1, "5"), _closed("C2", "Bia", "6", 1, "5"),
            _closed("C2", "Bia", None, 1, "5")]
    df = _view(spark, "closed_transactions", rows)
    kw = dict(establishments=["R291"], start=D(2025, 7, 1), end=D(2025, 12, 31))
    summary = bin01_note_summary(df, group_label="GRUPO", **kw).collect()
    # By code and name C1 splits into 2 + 1 notes and drops out; C2 has 3 distinct non-NULL notes.
    assert [(r.cod_cliente, r.total_nf_diferentes, r.valor_total) for r in summary] == [("C2", 3, Decimal("20.00"))]
    assert summary[0].cod_estabelecimento == "GRUPO"
    detail = bin01_note_detail(df, **kw).collect()
    assert sorted({r.cod_cliente for r in detail}) == ["C1", "C2"]
    assert len(detail) == 7


def test_bin02_repeats_and_null_notes(spark):
    rows = [_closed("C1", "Ana", "1", 1, "10"), _closed("C1", "Ana", "1", 2, "10"),
            _closed("C1", "Ana", "2", 1, "10"), _closed("C1", "Ana", None, 1, "1"),
            _closed("C1", "Ana", None, 2, "1"), _closed(None, "X", "9", 1, "1"), _closed(None, "X", "9", 2, "1")]
    out = bin02_split_notes(_view(spark, "closed_transactions", rows), establishments=["R291"],
                            start=D(2025, 7, 1), end=D(2025, 12, 31)).collect()
    assert [(r.cod_cliente, r.nota_fiscal, r.parcela, r.qtd_repeticao_nota) for r in out] == [
        ("C1", "1", 1, 2), ("C1", "1", 2, 2)]


def test_count_over_equals_window_with_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), (None, 3), (None, 4), (None, None)],
                               "k string, v int")
    w = Window.partitionBy("k")
    want = sorted(df.withColumn("n", F.count("v").over(w)).collect(), key=str)
    got = sorted(count_over(df, "k", "v", name="n").collect(), key=str)
    assert got == want
    want_rows = sorted(df.withColumn("n", F.count(F.lit(1)).over(w)).filter("n > 2").collect(), key=str)
    assert sorted(count_rows_over(df, "k", more_than=2, name="n").collect(), key=str) == want_rows


def test_cax02_debit_credit_net(spark):
    rows = [("R111", D(2025, 7, 3), "1.1.01.01.003", "CAIXA", Decimal("15000")),
            ("R111", D(2025, 7, 9), "1.1.01.01.003", "CAIXA", Decimal("6000")),
            ("R111", D(2025, 7, 9), "1.1.01.01.003", "CAIXA", Decimal("-500")),
            ("R111", D(2025, 8, 1), "1.1.01.01.003", "CAIXA", Decimal("20000")),
            ("R111", D(2025, 8, 1), "1.1.01.02.001", "BANCO", Decimal("90000"))]
    out = cax02_cash_over_limit(_view(spark, "gl_transactions", rows), establishments="R111",
                                start=D(2025, 7, 1), end=D(2025, 12, 31)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.ano, r.mes, r.nome_mes) == (2025, 7, "JULHO")
    assert (r.total_transacoes_debito, r.total_transacoes_credito) == (2, 1)
    assert r.total_debito_mensal + r.total_credito_mensal == r.total_liquido_mensal == Decimal("20500")


def _so(est, cli, cpf, day, nf, cfop, fat="Sim", valor="10"):
    return (est, cli, "Nome", cpf, day, nf, "I1", "Item", Decimal("1"), Decimal(valor), Decimal("15"),
            cfop, "VENDA", fat)


def test_car04_person_filter_and_groups(spark):
    rows = [_so("R351", "C1", "123.456.789-01", D(2025, 7, 5), "1", "5.102"),
            _so("R999", "C2", "123.456.789-01", D(2025, 7, 5), "2", "5.102"),
            _so("R351", "C3", "12.345.678/0001-90", D(2025, 7, 5), "3", "5.102"),
            _so("R351", "C4", "123.456.789-01", D(2025, 7, 5), "4-EST", "5.102"),
            _so("R351", "C5", "123.456.789-01", D(2025, 7, 5), "5", "5.949"),
            _so("R351", "C6", "123.456.789-01", D(2025, 7, 5), "6", "5.102", fat="Não")]
    out = car04_individual_billing(_view(spark, "sales_orders", rows), establishments=["R351", "R999"],
                                   start=D(2025, 7, 1), end=D(2025, 12, 31)).collect()
    assert sorted((r.cod_cliente, r.grupo, r.cpf_cnpj, r.caracteres) for r in out) == [
        ("C1", "AVANÇAR", "12345678901", 11), ("C2", "CADASTRAR", "12345678901", 11)]


def test_rec07_weekend_holiday_month_end(spark):
    rows = [_so("R121", "C1", "x", D(2025, 9, 6), "1", "5.102"),   # Saturday
            _so("R121", "C1", "x", D(2025, 9, 6), "1", "5.102", valor="5"),
            _so("R121", "C1", "x", D(2025, 9, 8), "2", "5.102"),   # Monday
            _so("R121", "C1", "x", D(2025, 4, 21), "3", "5.102"),  # Monday holiday
            _so("R121", "C1", "x", D(2025, 8, 30), "4", "5.102"),  # Saturday in last 3 days
            _so("R121", "C1", "x", D(2025, 9, 7), "5-EST", "5.102")]
    out = rec07_weekend_holiday_billing(_view(spark, "sales_orders", rows), establishments="R121",
                                        start=D(2025, 1, 1), end=D(2025, 12, 31),
                                        holidays=[D(2025, 4, 21)]).collect()
    assert [(r.num_nota_fiscal, r.valor_total, r.dia_semana) for r in out] == [
        ("3", Decimal("10.00"), "Monday"), ("1", Decimal("15.00"), "Saturday")]


def test_car05_statuses_reachable(spark):
    def ct(perfil, valor, cli="C1"):
        return ("R241", cli, "N", D(2025, 8, 1), D(2026, 1, 20), SENT, perfil, "1", Decimal(valor), "ABERTO")
    rows = [ct("ACL", "10", "C1"), ct("DPC", "10", "C1"), ct("ATC", "1", "C1"), ct("TCC", "2", "C1"),
            ct("ACL", "10", "C2"), ct("DPC", "10", "C2"), ct("ATC", "3", "C2"), ct("TCC", "3", "C2"),
            ct("ACL", "5", "C3"), ct("ACL", "-5", "C3")]
    out = car05_advance_offset(_view(spark, "customer_transactions", rows), establishments="R241",
                               start=D(2025, 7, 1), end=D(2025, 12, 31), as_of=D(2025, 12, 31)).collect()
    assert sorted((r.cod_cliente, r.status, r.dif_data, r.aging_list) for r in out) == [
        ("C1", "Baixar ATC", 20, "Venc. até 30 dias"), ("C2", "Não Aplicável", 20, "Venc. até 30 dias")]


def test_car07_null_settlement_kept(spark):
    def ob(liq, dias=400, peso="300", status="ABERTO", sistema="D365"):
        return ("R351", "C1", "N", D(2024, 1, 1), D(2024, 1, 31), liq, "1", "V1", Decimal("1"), Decimal("1"),
                Decimal(peso), Decimal("1"), status, sistema, dias)
    rows = [ob(None), ob(SENT), ob(D(2026, 1, 1)), ob(D(2025, 12, 31)), ob(None, dias=360), ob(None, peso="200"),
            ob(None, sistema="AX"), ob(None, status="FECHADO")]
    out = car07_open_bin_overdue(_view(spark, "open_bin", rows), establishments="R351",
                                 base_date=D(2025, 12, 31)).collect()
    assert len(out) == 3


def test_car10_counts_rows_per_supplier_on_fixture(spark):
    view = derived_view(spark, SF_SMALL, "supplier_transactions")
    out = car10_multiple_advances(view, **fx.PARAMS["car10_multiple_advances"])
    per = out.groupBy("cod_fornecedor").agg(F.count(F.lit(1)).alias("n"), F.max("qtd_adiantamentos_fornecedor").alias("q"))
    assert per.filter("n <> q").count() == 0
    assert out.filter("qtd_adiantamentos_fornecedor <= 11").count() == 0


def test_bin01_detail_codes_cover_summary(spark):
    view = derived_view(spark, SF_SMALL, "closed_transactions")
    s = bin01_note_summary(view, **fx.PARAMS["bin01_note_summary"]).select("cod_cliente")
    d = bin01_note_detail(view, **fx.PARAMS["bin01_note_detail"]).select("cod_cliente")
    assert s.subtract(d).count() == 0


def test_every_check_runs_with_case_insensitive_collation(spark):
    from ledgerlens.plans import CATALOG, run_check

    views = {}
    for key, check in CATALOG.items():
        if check.view not in views:
            views[check.view] = derived_view(spark, SF_SMALL, check.view)
        plain = run_check(key, views, fx.PARAMS[key]).count()
        collated = run_check(key, views, fx.PARAMS[key], collation="UTF8_LCASE").count()
        assert plain == collated, key


def test_collation_matches_lower_case_codes(spark):
    from ledgerlens.sources import with_collation

    rows = [("r291", "c1", "N", D(2025, 8, 1), D(2025, 8, 1), "tnd", n, "V", 1, Decimal("1"), Decimal("1"))
            for n in ("1", "1", "2-est")]
    df = _view(spark, "closed_transactions", rows)
    kw = dict(establishments=["R291"], start=D(2025, 7, 1), end=D(2025, 12, 31))
    assert bin02_split_notes(df, **kw).count() == 0
    assert bin02_split_notes(with_collation(df, "UTF8_LCASE"), **kw).count() == 2


ORDER_SPECS = {
    "afo01_supplier_advances": [("valor_aberto", True)],
    "bin01_note_summary": [("total_nf_diferentes", True), ("valor_total", True)],
    "bin01_note_detail": [("cod_cliente", False), ("nota_fiscal", False), ("data_transacao", False)],
    "bin02_split_notes": [("cod_cliente", False), ("nota_fiscal", False), ("data_transacao", False)],
    "bin06_no_finance_moves": [("data", True), ("num_nota_fiscal", False)],
    "cax02_cash_over_limit": [("ano", False), ("mes", False)],
    "car05_advance_offset": [("data_vencimento", False)],
    "car07_open_bin_overdue": [("cod_cliente", False)],
    "car09_open_travel_advances": [("cod_fornecedor", False), ("num_nota_fiscal", False)],
    "rec07_weekend_holiday_billing": [("cod_cliente", False), ("data_nota_fiscal", False),
                                      ("num_nota_fiscal", False)],
}


def test_ordered_checks_return_rows_in_the_audited_order(spark):
    from ledgerlens.plans import CATALOG, run_check

    for key, spec in ORDER_SPECS.items():
        view = derived_view(spark, SF_SMALL, CATALOG[key].view)
        rows = run_check(key, {CATALOG[key].view: view}, fx.PARAMS[key]).collect()
        assert rows, key
        for a, b in zip(rows, rows[1:]):
            for col, desc in spec:
                x, y = a[col], b[col]
                if x == y:
                    continue
                assert (x > y) if desc else (x < y), (key, col, x, y)
                break
