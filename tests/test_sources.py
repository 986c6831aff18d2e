"""Sources and sinks: contact sheets, report writers, partitioned views."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from ledgerlens import fixture as fx
from ledgerlens.plans import car06_overdue_receivables, write_billing_extract, billing_extract
from ledgerlens.sources import (
    CONFIRM_RESULT_SCHEMA,
    confirm_contacts,
    confirm_results,
    load_view,
    materialize_view,
    resolve_aliases,
    write_report,
)
from ledgerlens.sources import testdata_view as derived_view


def test_alias_resolution_first_alias_wins():
    cols = [" Celular ", "Cliente", "Nome", "NF", "extra"]
    got = resolve_aliases(cols)
    assert got == {"nome_cliente": "Nome", "telefone": " Celular ", "notas_fiscais": "NF"}


def test_contacts_csv_roundtrip(spark, tmp_out):
    path = os.path.join(tmp_out, "contatos.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("Nome do Cliente,Telefone,Outra\n")
        f.write("Ana,(81) 99999-1234,x\n")
        f.write("Bia,   ,y\n")
        f.write("Cris,nan,z\n")
        f.write("Duda,,w\n")
        f.write("Eva,sem telefone,v\n")
    raw = spark.read.csv(path, header=True, inferSchema=False)
    out = confirm_contacts(raw)
    assert out.columns[:3] == ["nome_cliente", "telefone", "notas_fiscais"] and "Outra" in out.columns
    rows = out.collect()
    assert [(r.nome_cliente, r.telefone, r.notas_fiscais) for r in rows] == [
        ("Ana", "(81) 99999-1234", ""), ("Eva", "sem telefone", "")]


def test_contacts_require_name_and_phone(spark):
    df = spark.createDataFrame([("a", "b")], "nome string, email string")
    with pytest.raises(ValueError):
        confirm_contacts(df)


def test_write_report_dates_as_text(spark, tmp_out):
    summary = spark.createDataFrame([("C1", 3)], "cod_cliente string, n int")
    detail = spark.createDataFrame([("C1", dt.date(2025, 7, 1), dt.date(2025, 8, 1), 10.5)],
                                   "cod_cliente string, data_transacao date, data_vencimento date, v double")
    paths = write_report(summary, detail, tmp_out, run_id="R241_20251231")
    back = spark.read.parquet(paths["detail"]).collect()[0]
    assert back.data_transacao == "01/07/2025" and back.data_vencimento == "01/08/2025" and back.v == 10.5
    assert spark.read.parquet(paths["summary"]).collect()[0].n == 3


def test_confirm_results_fixed_schema_when_empty(spark, tmp_out):
    empty = spark.createDataFrame([], "nome_cliente string, status string")
    path = os.path.join(tmp_out, "resultados")
    confirm_results(empty, path)
    back = spark.read.parquet(path)
    assert back.count() == 0
    assert [(f.name, f.dataType) for f in back.schema.fields] == [
        (f.name, f.dataType) for f in CONFIRM_RESULT_SCHEMA.fields]


def test_materialized_view_prunes_and_matches(spark, tmp_out):
    view = derived_view(spark, SF_SMALL, "customer_transactions")
    path = os.path.join(tmp_out, "customer_transactions")
    materialize_view(view, path)
    stored = load_view(spark, "customer_transactions", path=path)
    params = fx.PARAMS["car06_overdue_receivables"]
    a = car06_overdue_receivables(view, **params)
    b = car06_overdue_receivables(stored, **params)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0
    plan = stored.filter(F.col("cod_estabelecimento").isin("R011", "R021"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "cod_estabelecimento" in plan


def test_billing_extract_partitioned_write(spark, tmp_out):
    view = derived_view(spark, SF_SMALL, "sales_orders")
    path = os.path.join(tmp_out, "faturamento")
    params = fx.PARAMS["billing_extract"]
    write_billing_extract(view, path, **params)
    back = spark.read.parquet(path)
    want = billing_extract(view, **params)
    assert back.count() == want.count()
    dirs = [d for d in os.listdir(path) if not d.startswith((".", "_"))]
    assert dirs and all(d.startswith("cod_estabelecimento=") for d in dirs)


def test_run_audit_writes_tables_and_summary(spark, tmp_out):
    from ledgerlens.jobs import run_audit
    from ledgerlens.plans import CATALOG, run_check

    keys = ["afo01_supplier_advances", "car07_open_bin_overdue", "rec07_weekend_holiday_billing"]
    views = {CATALOG[k].view: derived_view(spark, SF_SMALL, CATALOG[k].view) for k in keys}
    checks = {k: {p: (v.isoformat() if isinstance(v, dt.date) else v) for p, v in fx.PARAMS[k].items()}
              for k in keys}
    checks["rec07_weekend_holiday_billing"]["holidays"] = [d.isoformat() for d in fx.HOLIDAYS]
    summary = {r.check: r.rows_found for r in run_audit(spark, views, checks, output=tmp_out, run_id="r1").collect()}
    assert summary == {k: run_check(k, views, fx.PARAMS[k]).count() for k in keys}
    assert summary["afo01_supplier_advances"] == 5
    back = spark.read.parquet(os.path.join(tmp_out, "r1", "car07_open_bin_overdue"))
    assert back.count() == summary["car07_open_bin_overdue"]


def test_load_view_canonicalises_erp_column_names(spark, tmp_out):
    df = spark.createDataFrame(
        [("R351", "F1", "Ana", "123.456.789-01", "2025-07-01", "2025-08-01", "1900-01-01", "AFO", "ABERTO", "9",
          "10.5")],
        "COD_ESTABELECIMENTO string, COD_FORNECEDOR string, NOME_FORNECEDOR string, `CNPJ/CPF` string, "
        "DATA_TRANSACAO string, DATA_VENCIMENTO string, DATA_LIQUIDACAO string, PERFIL_LANC string, "
        "STATUS string, NUM_NOTA_FISCAL string, VALOR_MOEDA string")
    path = os.path.join(tmp_out, "erp_sup")
    df.write.parquet(path)
    view = load_view(spark, "supplier_transactions", path=path)
    from ledgerlens.sources import VIEW_SCHEMAS

    assert view.schema == VIEW_SCHEMAS["supplier_transactions"]
    r = view.collect()[0]
    assert r.cnpj_cpf == "123.456.789-01" and r.data_transacao == dt.date(2025, 7, 1)
    from ledgerlens.plans import afo01_supplier_advances

    res = afo01_supplier_advances(view, establishments="R351", base_date=dt.date(2025, 12, 31)).collect()
    assert len(res) == 1 and float(res[0].valor_aberto) == 10.5


def test_load_view_requires_one_source(spark):
    with pytest.raises(ValueError):
        load_view(spark, "open_bin")
    with pytest.raises(ValueError):
        load_view(spark, "open_bin", path="/x", sf_dir="/y")


def test_confirmation_job_end_to_end(spark, tmp_out):
    from ledgerlens.jobs import finish_confirmation, prepare_confirmation

    csv = os.path.join(tmp_out, "contatos.csv")
    with open(csv, "w", encoding="utf-8") as f:
        f.write("id,Cliente,Tel,Notas\n")
        f.write("1,Ana,(81) 99999-1234,\"12, 13\"\n")
        f.write("2,Bia,sem telefone,14\n")
        f.write("3,Cris,,15\n")
    prepared = prepare_confirmation(spark, csv, tmp_out, company="ACME", template=fx.TEMPLATE, contact_key="id")
    assert prepared.count() == 2
    ana = prepared.filter("nome_cliente = 'Ana'").collect()[0]
    assert ana.telefone_limpo == "5581999991234" and ana.notas_texto == "12,13" and "  • NF 13" in ana.mensagem
    t0 = dt.datetime(2025, 1, 6, 12)
    sent = spark.createDataFrame([(1, "1", t0)], "message_id long, contact_id string, sent_ts timestamp_ntz")
    reps = spark.createDataFrame([(9, "1", t0 + dt.timedelta(seconds=30), "SIM")],
                                 "reply_id long, contact_id string, reply_ts timestamp_ntz, reply_text string")
    out = finish_confirmation(spark, prepared, sent, reps, tmp_out, run_ts=t0)
    rows = {r.nome_cliente: (r.status, r.resposta, r.telefone) for r in out.collect()}
    assert rows == {"Ana": ("RESPONDIDO", "SIM", "5581999991234"),
                    "Bia": ("ERRO - TELEFONE INVÁLIDO", None, "sem telefone")}


def test_bin01_report_writes_summary_and_detail(spark, tmp_out):
    from ledgerlens.plans import bin01_note_detail, bin01_note_summary, bin01_report

    view = derived_view(spark, SF_SMALL, "closed_transactions")
    p = fx.PARAMS["bin01_note_summary"]
    paths = bin01_report(view, tmp_out, **p)
    assert "/BIN01_R011-R021-R031-R041-R051-R061-R071-R081-R091-R101-R111-R121-R131-R141-R151_19981231_" in paths["summary"]
    assert bin01_report(view, tmp_out, **p)["summary"] != paths["summary"]  # a later run keeps the earlier report
    s = spark.read.parquet(paths["summary"])
    d = spark.read.parquet(paths["detail"])
    assert s.count() == bin01_note_summary(view, **p).count() == 71
    kw = {k: v for k, v in p.items() if k != "group_label"}
    assert d.count() == bin01_note_detail(view, **kw).count() == 631
    assert dict(d.dtypes)["data_transacao"] == "string" and dict(d.dtypes)["valor_parcela"].startswith("decimal")
    assert d.filter(~d.data_transacao.rlike(r"^\d{2}/\d{2}/\d{4}$")).count() == 0


def test_select_checks_by_code_and_area():
    from ledgerlens.plans import select_checks

    assert select_checks(codes=["CAR.04"]) == ["car04_individual_billing"]
    assert select_checks(codes=["BIN.01"]) == ["bin01_note_summary", "bin01_note_detail"]
    caixa = select_checks(areas=["Caixa"])
    assert caixa == ["cax02_cash_over_limit"]
    assert len(select_checks()) == 14
    with pytest.raises(ValueError):
        select_checks(codes=["XYZ.99"])


def test_materialize_sorted_by_date_reads_back_equal(spark, tmp_out):
    view = derived_view(spark, SF_SMALL, "gl_transactions")
    path = os.path.join(tmp_out, "gl")
    materialize_view(view, path, sort_by="data_transacao")
    back = load_view(spark, "gl_transactions", path=path)
    assert back.count() == view.count()
    assert back.exceptAll(view.select(*back.columns)).count() == 0


def test_jobs_main_from_config(spark, tmp_out):
    import json

    from ledgerlens import jobs

    view_dir = os.path.join(tmp_out, "views")
    materialize_view(derived_view(spark, SF_SMALL, "gl_transactions"), os.path.join(view_dir, "gl"),
                     sort_by="data_transacao")
    cfg = {"views": {"gl_transactions": {"path": os.path.join(view_dir, "gl")}},
           "checks": {"cax02_cash_over_limit": {"establishments": list(fx.ESTABLISHMENTS),
                                                "start": "1998-01-01", "end": "1998-12-31"}},
           "output": os.path.join(tmp_out, "out"), "run_id": "r"}
    path = os.path.join(tmp_out, "cfg.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(cfg, f)
    assert jobs.main(["x", path]) == 0
    summary = spark.read.parquet(os.path.join(tmp_out, "out", "r", "_suite")).collect()
    assert [(r.code, r.rows_found) for r in summary] == [("CAX.02", 42)]


def test_stream_main_from_config(spark, tmp_out):
    import json

    from ledgerlens.streaming.confirm_stream import main as stream_main

    sent_dir, rep_dir = os.path.join(tmp_out, "sent"), os.path.join(tmp_out, "rep")
    derived_view(spark, SF_SMALL, "sent_messages").write.parquet(sent_dir)
    derived_view(spark, SF_SMALL, "replies").write.parquet(rep_dir)
    cfg = {"sent": sent_dir, "replies": rep_dir, "output": os.path.join(tmp_out, "o"),
           "timeout_seconds": fx.REPLY_TIMEOUT_SECONDS, "available_now": True}
    path = os.path.join(tmp_out, "s.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(cfg, f)
    assert stream_main(["x", path]) == 0
    assert spark.read.parquet(os.path.join(tmp_out, "o", "outcomes")).count() == 188


def test_jdbc_views_are_split_or_refused(spark, monkeypatch):
    from pyspark.sql import DataFrameReader

    calls = []
    empty = spark.createDataFrame([], "cod_estabelecimento string, data_transacao date, conta_contabil string, "
                                      "nome_conta string, valor_moeda decimal(18,2)")
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, *a, **k: calls.append((a, k)) or empty)
    with pytest.raises(ValueError, match="partition_column"):
        load_view(spark, "gl_transactions", jdbc={"url": "jdbc:x", "table": "t"})
    load_view(spark, "gl_transactions", jdbc={"url": "jdbc:x", "table": "t", "partition_column": "id", "lower": 0,
                                              "upper": 9, "num_partitions": 3})
    load_view(spark, "gl_transactions", jdbc={"url": "jdbc:x", "table": "t", "predicates": ["id < 5", "id >= 5"]})
    assert [k.get("numPartitions") for _, k in calls] == [3, None] and calls[1][1]["predicates"] == ["id < 5", "id >= 5"]


def test_partitioned_write_has_few_files_per_establishment(spark, tmp_out):
    view = derived_view(spark, SF_SMALL, "sales_orders").repartition(8)
    path = os.path.join(tmp_out, "few")
    write_billing_extract(view, path, **fx.PARAMS["billing_extract"])
    for d in os.listdir(path):
        if d.startswith("cod_estabelecimento="):
            assert len([f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")]) <= 2


SKEWED = [(dt.date(2025, 1, 1) + dt.timedelta(days=d), k) for d in range(40) for k in range(-5, 15)] + [
    (dt.date(2025, 1, 17), k) for k in range(2000)] + [(None, k) for k in range(900)] + [(dt.date(2025, 1, 17), None), (None, None)]


def test_split_predicates_are_even_disjoint_and_complete_on_a_skewed_column(spark):
    from ledgerlens.sources import split_histogram, split_predicates

    df = spark.createDataFrame(SKEWED, "data date, id long")
    for bins in (1000, 7):
        histogram = split_histogram(df, "data", bins=bins)
        assert sum(n for _, n in histogram) == len(SKEWED) and len(histogram) <= bins + 2
        texts = split_predicates(histogram, "data", 10, within="id")
        later = df.union(spark.createDataFrame([(dt.date(1990, 1, 1), 1), (dt.date(2090, 1, 1), -7)], df.schema))
        rows = later.select(*[F.expr(t).alias(f"p{i}") for i, t in enumerate(texts)]).collect()
        assert all(sum(bool(x) for x in r) == 1 for r in rows)  # each row, NULLs included, in exactly one part
        sizes = [sum(bool(r[i]) for r in rows) for i in range(len(texts))]
        assert max(sizes) <= 1.2 * len(SKEWED) / 10 and len(texts) <= 22
    whole = split_predicates(histogram, "data", 10)
    assert "data IS NULL" in whole and max(sum(bool(r[0]) for r in df.select(F.expr(t)).collect()) for t in whole) >= 2000


def test_split_predicates_of_odd_columns(spark):
    from ledgerlens.sources import split_histogram, split_predicates

    empty = spark.createDataFrame([], "v long")
    assert split_histogram(empty, "v") == [] and split_predicates([], "v", 4) == ["v IS NOT NULL", "v IS NULL"]
    assert split_predicates([(None, 5)], "v", 2) == ["v IS NOT NULL", "v IS NULL"]
    assert split_predicates([("it's", 5), ("a", 5)], "v", 2) == ["v < 'it''s'", "v >= 'it''s'", "v IS NULL"]
    for bad in ([(1.5, 3), (2.5, 3)], [(1, 2), (1, 3)]):
        with pytest.raises(ValueError):
            split_predicates(bad, "v", 2)


def test_jdbc_read_by_histogram(spark, monkeypatch):
    from pyspark.sql import DataFrameReader

    calls = []
    empty = spark.createDataFrame([], "cod_estabelecimento string, data_transacao date, conta_contabil string, "
                                      "nome_conta string, valor_moeda decimal(18,2)")
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, *a, **k: calls.append(k) or empty)
    load_view(spark, "gl_transactions", jdbc={"url": "jdbc:x", "table": "t", "partition_column": "id", "num_partitions": 2,
                                              "histogram": [(1, 4), (5, 4), (None, 1)]})
    assert calls[0]["predicates"] == ["id < 5", "id >= 5", "id IS NULL"]


def test_folded_keys_make_a_case_insensitive_scope_a_pushed_filter(spark, tmp_out):
    from ledgerlens.plans import run_check

    key = "afo01_supplier_advances"
    view = derived_view(spark, SF_SMALL, "supplier_transactions")
    mixed = view.withColumn("cod_estabelecimento", F.when(F.crc32("cod_fornecedor") % 2 == 0, F.lower("cod_estabelecimento"))
                            .otherwise(F.col("cod_estabelecimento")))
    params = dict(fx.PARAMS[key])
    codes = params["establishments"]
    params["establishments"] = codes.lower() if isinstance(codes, str) else [c.lower() for c in codes]
    path = os.path.join(tmp_out, "folded")
    materialize_view(mixed, path, partition_by=("status",), folded=("cod_estabelecimento",))
    stored = load_view(spark, "supplier_transactions", path=path, folded=True)
    got = run_check(key, {"supplier_transactions": stored}, params, collation="UTF8_LCASE")
    plan = got._jdf.queryExecution().executedPlan().toString()
    pushed = [x for x in plan.split("PushedFilters")[1:] if "cod_estabelecimento__folded" in x.split("ReadSchema")[0]]
    assert pushed and all("In(cod_estabelecimento__folded" in x or "EqualTo(cod_estabelecimento__folded" in x for x in pushed)
    plain = run_check(key, {"supplier_transactions": load_view(spark, "supplier_transactions", path=path)}, params,
                      collation="UTF8_LCASE")
    assert got.columns == plain.columns and sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    assert got.count() > run_check(key, {"supplier_transactions": stored}, params).count()  # without a collation: exact case


def test_folded_partitions_prune_folders(spark, tmp_out):
    from ledgerlens.sources import collated_scope

    view = derived_view(spark, SF_SMALL, "gl_transactions")
    path = os.path.join(tmp_out, "by_folded")
    materialize_view(view, path, partition_by=("cod_estabelecimento__folded",), folded=("cod_estabelecimento",))
    code = view.first().cod_estabelecimento
    scoped = collated_scope(load_view(spark, "gl_transactions", path=path, folded=True), "UTF8_LCASE", code.swapcase())
    assert "PartitionFilters: [cod_estabelecimento__folded" in scoped._jdf.queryExecution().executedPlan().toString() or \
        "cod_estabelecimento__folded" in scoped._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]
    assert scoped.count() == view.filter(F.lower("cod_estabelecimento") == code.lower()).count() > 0
    assert "cod_estabelecimento__folded" not in scoped.columns
