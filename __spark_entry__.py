"""

Every query reads the whole base tables of ``sf_dir`` through the derived ERP
views (``ledgerlens.sources.testdata``) and runs a library check or operator
with the fixture parameters of ``ledgerlens.fixture``. Results are normalised
for comparison only: decimals to double (after summing in decimal), small
integers to bigint. The matching DuckDB SQL lives in ``duck_oracle``.
"""

from __future__ import annotations

import os
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import fixture as fx
from ledgerlens.constants import ESTABLISHMENT_GROUPS, GROUP_DEFAULT
from ledgerlens.functions import (
    base_date_shift,
    bucket_overdue_360,
    bucket_overdue_720,
    bucket_to_due,
    confirm_removed_count,
    confirm_sanitize,
    date_text,
    days_overdue,
    days_overdue_floor,
    days_to_due,
    holiday_flag,
    month_end_exclude,
    month_name_pt,
    offset_status,
    open_as_of,
    reversal_exclude,
    tax_id_clean,
    tax_id_length,
    tax_id_type,
    weekday_name,
    weekend_flag,
)
from ledgerlens.operators import (
    conditional_count,
    conditional_sum,
    count_over,
    count_rows_over,
    distinct_rows,
    group_lookup,
    ranked_output,
    semi_join_back,
)
from ledgerlens.plans import (
    CATALOG,
    audit_suite,
    bin01_report,
    confirm_messages,
    confirm_outcomes,
    confirm_outcomes_by_instant,
    confirm_report,
    mark_not_found,
    run_check,
)
from ledgerlens.session import checkpoint_dir
from ledgerlens.sources import confirm_contacts, confirm_results, load_view, testdata_view
from ledgerlens.sources.testdata import StreamingTables, Tables, replies, sent_messages
from ledgerlens.streaming import run_to_end

SMOKE_DIR = "/root/testdata/sf0.001"


def normalize(df: DataFrame) -> DataFrame:
    """Comparison types: decimal -> double, int/short/byte -> bigint; names unchanged."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = Tables(spark, sf_dir)
    return {name: testdata_view(spark, sf_dir, name, tables)
            for name in {c.view for c in CATALOG.values()}}


def _check(key: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        view = testdata_view(spark, sf_dir, CATALOG[key].view)
        return normalize(run_check(key, {CATALOG[key].view: view}, fx.PARAMS[key]))
    run.__name__ = key
    return run


def _view(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalize(load_view(spark, name, sf_dir=sf_dir))
    run.__name__ = f"view_{name}"
    return run


# ---- primitive operators over whole views ---------------------------------

def q_tax_id(spark, sf_dir):
    so = testdata_view(spark, sf_dir, "sales_orders")
    n = tax_id_length("cpf_cnpj")
    return normalize(so.select("cpf_cnpj", tax_id_clean("cpf_cnpj").alias("cpf_cnpj_limpo"),
                               n.alias("qtd_caracteres"), tax_id_type(n).alias("tipo_documento")).distinct())


def q_aging_720(spark, sf_dir):
    ct = testdata_view(spark, sf_dir, "customer_transactions")
    d = days_overdue("data_vencimento", fx.AS_OF)
    return normalize(ct.select("data_vencimento", d.alias("dias_atraso"),
                               bucket_overdue_720(d).alias("categoria_atraso")).distinct())


def q_aging_360(spark, sf_dir):
    st = testdata_view(spark, sf_dir, "supplier_transactions")
    return normalize(st.select(
        "data_vencimento", days_overdue_floor("data_vencimento", fx.AS_OF).alias("dias_atraso"),
        bucket_overdue_360(days_overdue("data_vencimento", fx.AS_OF)).alias("categoria_atraso")).distinct())


def q_aging_to_due(spark, sf_dir):
    ct = testdata_view(spark, sf_dir, "customer_transactions")
    d = days_to_due("data_vencimento", fx.AS_OF)
    return normalize(ct.select("data_vencimento", d.alias("dif_data"), bucket_to_due(d).alias("aging_list")).distinct())


def q_offset_status(spark, sf_dir):
    """Conditional sums per customer/transaction/due date over the whole view, no HAVING."""
    ct = testdata_view(spark, sf_dir, "customer_transactions")
    p, v = F.col("perfil_lanc"), F.col("valor_moeda")
    g = ct.groupBy("cod_cliente", "data_transacao", "data_vencimento").agg(
        *[conditional_sum(v, p == prof).alias(f"valor_{prof.lower()}") for prof in ("ACL", "DPC", "ATC", "TCC")])
    return normalize(g.withColumn("status", offset_status("valor_acl", "valor_dpc", "valor_atc", "valor_tcc")))


def q_month_name(spark, sf_dir):
    gl = testdata_view(spark, sf_dir, "gl_transactions")
    v = F.col("valor_moeda")
    g = gl.groupBy(F.year("data_transacao").alias("ano"), F.month("data_transacao").alias("mes")).agg(
        conditional_sum(v, v > 0).alias("total_debito"), conditional_count(v > 0).alias("qtd_debito"),
        conditional_sum(v, v < 0).alias("total_credito"), conditional_count(v < 0).alias("qtd_credito"))
    return normalize(g.withColumn("nome_mes", month_name_pt(month=F.col("mes"))))


def q_calendar(spark, sf_dir):
    so = testdata_view(spark, sf_dir, "sales_orders")
    d = F.col("data_nota_fiscal")
    return normalize(so.select(
        "data_nota_fiscal", weekend_flag(d).alias("fim_de_semana"), weekday_name(d).alias("dia_semana"),
        holiday_flag(d, fx.HOLIDAYS).alias("feriado"), month_end_exclude(d, 3).alias("fora_fim_mes"),
        date_text(d).alias("data_texto")).distinct())


def q_group_lookup(spark, sf_dir):
    so = testdata_view(spark, sf_dir, "sales_orders")
    g = group_lookup(so.select("cod_estabelecimento"), "cod_estabelecimento", ESTABLISHMENT_GROUPS,
                     default=GROUP_DEFAULT, name="grupo")
    return normalize(g.groupBy("cod_estabelecimento", "grupo").agg(F.count(F.lit(1)).alias("linhas")))


def q_count_over(spark, sf_dir):
    """W1 over the whole closed-titles view: rows whose (customer, note) has more than 5 instalments."""
    ct = testdata_view(spark, sf_dir, "closed_transactions").select("cod_cliente", "nota_fiscal", "comprovante")
    return normalize(count_over(ct, ["cod_cliente", "nota_fiscal"], "nota_fiscal", more_than=5,
                                name="qtd_repeticao_nota"))


def q_count_rows_over(spark, sf_dir):
    """W2 over the whole supplier view: distinct (supplier, note) rows with the count per supplier."""
    st = testdata_view(spark, sf_dir, "supplier_transactions")
    d = distinct_rows(st, ["cod_fornecedor", "num_nota_fiscal"])
    return normalize(count_rows_over(d, "cod_fornecedor", name="qtd_notas_fornecedor"))


def q_semi_join_back(spark, sf_dir):
    """J1 over the whole sales view: every line of customers that have a reversed invoice."""
    so = testdata_view(spark, sf_dir, "sales_orders")
    keys = so.filter(~reversal_exclude("num_nota_fiscal")).select("cod_cliente")
    return normalize(semi_join_back(so, keys, "cod_cliente").select(
        "cod_cliente", "num_nota_fiscal", "cod_item", "quantidade"))


def q_open_as_of(spark, sf_dir):
    """P2's three variants counted per profile and status over the whole supplier view."""
    st = testdata_view(spark, sf_dir, "supplier_transactions")
    base = fx.BASE_DATE
    a = open_as_of("data_liquidacao", base_date_shift(base, 1), inclusive=True)
    b = open_as_of("data_liquidacao", fx.SETTLED_FROM, inclusive=True)
    c = open_as_of("data_liquidacao", base, inclusive=False, keep_null=True)
    return normalize(st.groupBy("perfil_lanc", "status").agg(
        conditional_count(a).alias("abertos_base_seguinte"), conditional_count(b).alias("abertos_desde"),
        conditional_count(c).alias("abertos_ou_nulos"), F.count(F.lit(1)).alias("linhas")))


# ---- confirmation job -----------------------------------------------------

def q_confirm_contacts(spark, sf_dir):
    return normalize(confirm_contacts(testdata_view(spark, sf_dir, "contacts")))


def q_confirm_messages(spark, sf_dir):
    prepared = confirm_messages(confirm_contacts(testdata_view(spark, sf_dir, "contacts")), company=fx.COMPANY,
                                template=fx.TEMPLATE)
    return normalize(prepared.select("contact_id", "nome_cliente", "telefone", "telefone_limpo", "telefone_valido",
                                     "notas_texto", F.size("notas").alias("qtd_notas"), "mensagem",
                                     "caracteres_removidos"))


def q_confirm_outcomes(spark, sf_dir):
    sent = testdata_view(spark, sf_dir, "sent_messages")
    rep = testdata_view(spark, sf_dir, "replies")
    return normalize(confirm_outcomes(sent, rep, timeout_seconds=fx.REPLY_TIMEOUT_SECONDS))


def q_confirm_outcomes_by_instant(spark, sf_dir):
    sent = testdata_view(spark, sf_dir, "sent_messages")
    rep = testdata_view(spark, sf_dir, "replies")
    return normalize(confirm_outcomes_by_instant(sent, rep, timeout_seconds=fx.REPLY_TIMEOUT_SECONDS))


def q_confirm_send_errors(spark, sf_dir):
    """The outcomes where messages to contacts that the sheet lacks, or has without a usable phone, were not found."""
    prepared = confirm_messages(confirm_contacts(testdata_view(spark, sf_dir, "contacts")), company=fx.COMPANY,
                                template=fx.TEMPLATE)
    sent = mark_not_found(testdata_view(spark, sf_dir, "sent_messages"), prepared.filter("telefone_valido"))
    return normalize(confirm_outcomes_by_instant(sent, testdata_view(spark, sf_dir, "replies"),
                                                 timeout_seconds=fx.REPLY_TIMEOUT_SECONDS))


def q_confirm_report(spark, sf_dir):
    """The outcome table: every contact of the sheet and every sent message."""
    prepared = confirm_messages(confirm_contacts(testdata_view(spark, sf_dir, "contacts")), company=fx.COMPANY,
                                template=fx.TEMPLATE)
    outcomes = confirm_outcomes(testdata_view(spark, sf_dir, "sent_messages"),
                                testdata_view(spark, sf_dir, "replies"), timeout_seconds=fx.REPLY_TIMEOUT_SECONDS)
    return normalize(confirm_report(prepared, outcomes, run_ts=fx.RUN_TS,
                                    timeout_seconds=fx.REPLY_TIMEOUT_SECONDS))


def _scratch(spark, name: str) -> str:
    """A new folder of this name in the session's shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark, local_fallback=True), f"{name}-{uuid.uuid4().hex}")


def q_confirm_results(spark, sf_dir):
    """The outcome table written with its fixed schema and read back."""
    path = _scratch(spark, "resultados")
    confirm_results(q_confirm_report(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return normalize(back.withColumn("data_hora", F.col("data_hora").cast("timestamp_ntz")))


def q_confirm_sanitize(spark, sf_dir):
    """Every conversation text with controls and a code point above U+FFFF put in, cleaned again."""
    text = F.concat(F.col("text"), F.lit("\x07\t\x0b\U0001F600"))
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return normalize(rows.select("conv_id", "turn", confirm_sanitize(text).alias("limpo"),
                                 confirm_removed_count(text).alias("removidos")))


def q_offset_status_cases(spark, sf_dir):
    """The offset status of small amounts taken from every line item's keys; all six occur."""
    keys = {"valor_acl": "l_orderkey", "valor_dpc": "l_partkey", "valor_atc": "l_suppkey", "valor_tcc": "l_linenumber"}
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        *[(F.col(c) % 3).cast("bigint").alias(n) for n, c in keys.items()])
    return normalize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas")).withColumn(
        "status", offset_status(*keys)))


def _report(part: str):
    def run(spark, sf_dir):
        view = testdata_view(spark, sf_dir, "closed_transactions")
        paths = bin01_report(view, _scratch(spark, "report"), **fx.PARAMS["bin01_note_summary"])
        return normalize(spark.read.parquet(paths[part]))
    run.__name__ = f"q_write_report_{part}"
    return run


def q_ordered_output(spark, sf_dir):
    """The ordered check as written and reread in order, with each row's position (ties share one)."""
    path = _scratch(spark, "ordered")
    ordered = run_check("afo01_supplier_advances", _views(spark, sf_dir), fx.PARAMS["afo01_supplier_advances"])
    ordered.select("cod_estabelecimento", "cod_fornecedor", "valor_aberto").write.parquet(path)
    return normalize(ranked_output(spark.read.parquet(path), "valor_aberto", name="posicao"))


def q_confirm_outcomes_stream(spark, sf_dir):
    """Streaming outcomes over the event file (a finite run, the tail closed at its end)."""
    t = StreamingTables(spark, sf_dir)
    folder = _scratch(spark, "confirm")
    return normalize(run_to_end(spark, sent_messages(t), replies(t), folder=f"{folder}/tables", name=uuid.uuid4().hex,
                                checkpoint=f"{folder}/progress", timeout_seconds=fx.REPLY_TIMEOUT_SECONDS).outcomes())


def q_audit_suite(spark, sf_dir):
    keys = list(fx.PARAMS)
    return normalize(audit_suite(keys, _views(spark, sf_dir), fx.PARAMS))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: AFO.01 (supplier advances open at the base date) on sf0.001."""
    return queries()["afo01_supplier_advances"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {key: _check(key) for key in fx.PARAMS}
    out["audit_suite"] = q_audit_suite
    out["load_view"] = _view("sales_orders")
    for name in ("supplier_transactions", "customer_transactions", "closed_transactions",
                 "inventory_movements", "gl_transactions", "open_bin"):
        out[f"view_{name}"] = _view(name)
    out["tax_id_type"] = q_tax_id
    out["aging_overdue_720"] = q_aging_720
    out["aging_overdue_360"] = q_aging_360
    out["aging_to_due"] = q_aging_to_due
    out["offset_status"] = q_offset_status
    out["month_name_pt"] = q_month_name
    out["calendar_flags"] = q_calendar
    out["group_lookup"] = q_group_lookup
    out["count_over"] = q_count_over
    out["count_rows_over"] = q_count_rows_over
    out["semi_join_back"] = q_semi_join_back
    out["open_as_of"] = q_open_as_of
    out["confirm_contacts"] = q_confirm_contacts
    out["confirm_messages"] = q_confirm_messages
    out["confirm_outcomes"] = q_confirm_outcomes
    out["confirm_outcomes_by_instant"] = q_confirm_outcomes_by_instant
    out["confirm_send_errors"] = q_confirm_send_errors
    out["confirm_report"] = q_confirm_report
    out["confirm_results"] = q_confirm_results
    out["confirm_sanitize"] = q_confirm_sanitize
    out["confirm_outcomes_stream"] = q_confirm_outcomes_stream
    out["offset_status_cases"] = q_offset_status_cases
    out["write_report_summary"] = _report("summary")
    out["write_report_detail"] = _report("detail")
    out["ordered_output"] = q_ordered_output
    return out | _corpus()[0]


def _corpus() -> tuple[dict, dict]:
    """Queries and SQL of the llm subpackage and the corpus pipeline, where these are installed."""
    try:
        import corpus_pipeline
        from ledgerlens.llm.queries import ORACLE_SQL, QUERIES
    except ImportError as missing:  # the folders are not there, or a package that only they need is not
        warnings.warn(f"corpus queries are left out: {missing}", stacklevel=2)
        return {}, {}
    sql = dict(ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**QUERIES, "pipeline": corpus_pipeline.run}, sql


def oracle_sql() -> dict[str, str]:
    from duck_oracle import ORACLE_SQL

    return dict(ORACLE_SQL) | _corpus()[1]
