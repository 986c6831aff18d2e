"""Column expressions on hand-made edge rows (FIXTURES §4)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens import functions as L
from ledgerlens.constants import AGING_360_LABELS, AGING_720_LABELS, AGING_NO_DUE_DATE

AS_OF = dt.date(2025, 12, 31)


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_tax_id(spark):
    rows = [("123.456.789-01",), ("12.345.678/0001-90",), ("123 456 789 01",), ("12.34",), (None,),
            ("123_456",)]
    df = spark.createDataFrame(rows, "t string")
    out = df.select(L.tax_id_clean("t").alias("c"), L.tax_id_length("t").alias("n"),
                    L.tax_id_type(L.tax_id_length("t")).alias("k")).collect()
    assert [r.c for r in out] == ["12345678901", "12345678000190", "12345678901", "1234", None, "123_456"]
    assert [r.n for r in out] == [11, 14, 11, 4, None, 7]
    assert [r.k for r in out] == ["CPF", "CNPJ", "CPF", "TAMANHO INVÁLIDO", "TAMANHO INVÁLIDO", "TAMANHO INVÁLIDO"]


def _due(days_before):
    return AS_OF - dt.timedelta(days=days_before)


def test_aging_720_edges(spark):
    cases = {-5: 0, 0: 0, 30: 0, 31: 1, 60: 1, 61: 2, 90: 2, 91: 3, 120: 3, 121: 4, 180: 4, 181: 5,
             360: 5, 361: 6, 720: 6, 721: 7}
    rows = [(_due(d),) for d in cases] + [(None,)]
    got = _one(spark, L.aging_overdue_720("d", AS_OF), rows, "d date")
    assert got == [AGING_720_LABELS[i] for i in cases.values()] + [AGING_NO_DUE_DATE]


def test_aging_360_edges_negative_and_null(spark):
    cases = {-1: None, 0: 0, 30: 0, 31: 1, 60: 1, 61: 2, 90: 2, 91: 3, 120: 3, 121: 4, 180: 4, 181: 5,
             360: 5, 361: 6}
    rows = [(_due(d),) for d in cases] + [(None,)]
    got = _one(spark, L.aging_overdue_360("d", AS_OF), rows, "d date")
    want = [AGING_NO_DUE_DATE if i is None else AGING_360_LABELS[i] for i in cases.values()] + [AGING_NO_DUE_DATE]
    assert got == want


def test_aging_to_due(spark):
    ahead = {-3: "Verificar", 0: "Verificar", 1: "Venc. até 30 dias", 30: "Venc. até 30 dias",
             31: "Venc. 31 a 60", 60: "Venc. 31 a 60", 61: "Venc. 61 a 90", 91: "Venc. 91 a 120",
             120: "Venc. 91 a 120", 121: "Venc. Mais 120"}
    rows = [(AS_OF + dt.timedelta(days=d),) for d in ahead] + [(None,)]
    got = _one(spark, L.aging_to_due("d", AS_OF), rows, "d date")
    assert got == list(ahead.values()) + ["Verificar"]


def test_days_overdue_floor_keeps_null(spark):
    rows = [(AS_OF,), (AS_OF + dt.timedelta(days=1),), (AS_OF - dt.timedelta(days=1),), (None,)]
    assert _one(spark, L.days_overdue_floor("d", AS_OF), rows, "d date") == [0, 0, 1, None]
    assert _one(spark, L.days_overdue("d", AS_OF), rows, "d date") == [0, -1, 1, None]


def test_offset_status_order(spark):
    rows = [(0.0, 5.0, 1.0, 2.0), (10.0, 20.0, 0.0, 0.0), (20.0, 10.0, 0.0, 0.0),
            (10.0, 10.0, 1.0, 2.0), (10.0, 10.0, 2.0, 1.0), (10.0, 10.0, 3.0, 3.0)]
    got = _one(spark, L.offset_status("a", "d", "t", "c"), rows, "a double, d double, t double, c double")
    assert got == ["OK", "Baixar ACL", "Baixar DPC", "Baixar ATC", "Baixar TCC", "Não Aplicável"]


def test_month_name(spark):
    rows = [(m,) for m in range(0, 14)] + [(None,)]
    got = _one(spark, L.month_name_pt(month=F.col("m")), rows, "m int")
    assert got[1] == "JANEIRO" and got[3] == "MARÇO" and got[12] == "DEZEMBRO"
    assert got[0] == got[13] == got[14] == "VERIFICAR"


def test_weekend_holiday_month_end(spark):
    days = [dt.date(2025, 2, 25), dt.date(2025, 2, 26), dt.date(2024, 2, 26), dt.date(2024, 2, 27),
            dt.date(2025, 4, 27), dt.date(2025, 4, 28), dt.date(2025, 12, 28), dt.date(2025, 12, 29)]
    got = _one(spark, L.month_end_exclude("d", 3), [(d,) for d in days], "d date")
    assert got == [True, False, True, False, True, False, True, False]
    df = spark.createDataFrame([(dt.date(2025, 9, 6),), (dt.date(2025, 9, 7),), (dt.date(2025, 9, 8),),
                                (dt.date(2025, 4, 21),)], "d date")
    out = df.select(L.weekend_flag("d").alias("w"), L.weekday_name("d").alias("n"),
                    L.holiday_flag("d", [dt.date(2025, 4, 21), "2025-09-07"]).alias("h"),
                    L.weekday_name("d", {"Saturday": "sábado"}).alias("pt")).collect()
    assert [r.w for r in out] == [True, True, False, False]
    assert [r.n for r in out] == ["Saturday", "Sunday", "Monday", "Monday"]
    assert [r.h for r in out] == [False, True, False, True]
    assert out[0].pt == "sábado" and out[1].pt == "Sunday"


def test_open_as_of_variants(spark):
    base = dt.date(2025, 12, 31)
    rows = [(dt.date(1900, 1, 1),), (base,), (dt.date(2026, 1, 1),), (None,), (dt.date(2025, 1, 1),)]
    a = _one(spark, L.open_as_of("s", L.base_date_shift(base, 1), inclusive=True), rows, "s date")
    c = _one(spark, L.open_as_of("s", base, inclusive=False, keep_null=True), rows, "s date")
    b = _one(spark, L.open_as_of("s", "2025-01-01", inclusive=True), rows, "s date")
    assert [bool(x) for x in a] == [True, False, True, False, False]
    assert c == [True, False, True, True, False]
    assert [bool(x) for x in b] == [True, True, True, False, True]


def test_code_filter_and_reversal_null_drop(spark):
    df = spark.createDataFrame([("TCC", "1"), ("ACL", "2-EST"), (None, None), ("CCR", "3")], "p string, n string")
    kept = df.filter(L.code_filter("p", exclude=["TCC", "CCR"])).collect()
    assert [r.p for r in kept] == ["ACL"]
    assert [r.n for r in df.filter(L.reversal_exclude("n")).collect()] == ["1", "3"]


def test_operation_label(spark):
    labels = {"1.7.001": "ENTRADA", "2.7.001": "SAÍDA"}
    got = _one(spark, L.operation_label("o", labels), [("1.7.001",), ("9",), (None,)], "o string")
    assert got == ["ENTRADA", "VERIFICAR", "VERIFICAR"]


def test_confirm_phone(spark):
    rows = [("(81) 99999-1234",), ("55 81 99999-1234",), ("5581999991234",), ("9999-1234",),
            ("12345678901",), ("123456789012",), ("sem telefone",), (None,), ("+1 (212) 555-0100 ext 12",)]
    got = _one(spark, L.confirm_phone("p"), rows, "p string")
    assert got == ["5581999991234", "5581999991234", "5581999991234", "5599991234", "5512345678901",
                   "123456789012", None, None, "1212555010012"]


def test_confirm_notes_and_message(spark):
    df = spark.createDataFrame([(" 12, ,13 ,", "Ana"), (None, "Bia")], "n string, nome string")
    out = df.select(L.confirm_notes("n").alias("a"), L.confirm_notes_text(L.confirm_notes("n")).alias("t"),
                    L.confirm_message("nome", L.confirm_notes("n"), company="ACME",
                                      template="Oi {nome_cliente} de {empresa}:\n{notas}").alias("m")).collect()
    assert out[0].a == ["12", "13"] and out[0].t == "12,13"
    assert out[1].a == [] and out[1].t == ""
    assert out[0].m == "Oi Ana de ACME:\n  • NF 12\n  • NF 13"
    assert out[1].m == "Oi Bia de ACME:\n"


def test_confirm_sanitize(spark):
    text = "ok 😊\tA\nB\rC\x01\x1fD\x0b"
    rows = [(text,), (None,), ("plain",)]
    df = spark.createDataFrame(rows, "t string")
    out = df.select(L.confirm_sanitize("t").alias("s"), L.confirm_removed_count("t").alias("n")).collect()
    assert out[0].s == "ok \tA\nB\rCD" and out[0].n == 4
    assert out[1].s == "" and out[1].n == 0
    assert out[2].s == "plain" and out[2].n == 0


def _py_720(d):
    if d is None:
        return AGING_NO_DUE_DATE
    for edge, label in zip((30, 60, 90, 120, 180, 360, 720), AGING_720_LABELS):
        if d <= edge:
            return label
    return AGING_720_LABELS[-1]


def _py_360(d):
    if d is None or d < 0:
        return AGING_NO_DUE_DATE
    for edge, label in zip((30, 60, 90, 120, 180, 360), AGING_360_LABELS):
        if d <= edge:
            return label
    return AGING_360_LABELS[-1]


def _py_to_due(d):
    if d is None or d <= 0:
        return "Verificar"
    for edge, label in zip((30, 60, 90, 120), ("Venc. até 30 dias", "Venc. 31 a 60", "Venc. 61 a 90",
                                               "Venc. 91 a 120")):
        if d <= edge:
            return label
    return "Venc. Mais 120"


def test_ageing_schemes_are_total_and_match_rule(spark):
    import random

    rnd = random.Random(11)
    days = [None] + list(range(-3, 800)) + [rnd.randint(-100_000, 100_000) for _ in range(500)]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    rows = df.select("d", L.bucket_overdue_720("d").alias("a"), L.bucket_overdue_360("d").alias("b"),
                     L.bucket_to_due("d").alias("c")).collect()
    assert all(r.a is not None and r.b is not None and r.c is not None for r in rows)
    assert [r.a for r in rows] == [_py_720(r.d) for r in rows]
    assert [r.b for r in rows] == [_py_360(r.d) for r in rows]
    assert [r.c for r in rows] == [_py_to_due(r.d) for r in rows]
