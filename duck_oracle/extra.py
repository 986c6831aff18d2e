"""Oracle SQL for the views, primitive operators, the confirmation job and the suite."""

from __future__ import annotations

from duck_oracle.queries import (
    CHECK_SQL,
    GROUPS_CTE,
    aging360,
    aging720,
    clean_id,
    month_name,
    offset,
    to_due,
)
from duck_oracle.views import with_views
from ledgerlens import fixture as fx
from ledgerlens.plans.suite import CATALOG, params_text

AS_OF = "DATE '1998-12-31'"

_VIEW_NUMERIC = {
    "sales_orders": "CAST(quantidade AS DOUBLE) AS quantidade, CAST(valor AS DOUBLE) AS valor, "
                    "CAST(peso_bin AS DOUBLE) AS peso_bin",
    "supplier_transactions": "CAST(valor_moeda AS DOUBLE) AS valor_moeda",
    "customer_transactions": "CAST(valor_moeda AS DOUBLE) AS valor_moeda",
    "closed_transactions": "CAST(parcela AS BIGINT) AS parcela, CAST(valor_parcela AS DOUBLE) AS valor_parcela, "
                           "CAST(valor_titulo AS DOUBLE) AS valor_titulo",
    "inventory_movements": "CAST(qtd AS DOUBLE) AS qtd",
    "gl_transactions": "CAST(valor_moeda AS DOUBLE) AS valor_moeda",
    "open_bin": "CAST(peso_bin_original AS DOUBLE) AS peso_bin_original, "
                "CAST(peso_bin_baixado AS DOUBLE) AS peso_bin_baixado, "
                "CAST(peso_bin_aberto AS DOUBLE) AS peso_bin_aberto, CAST(valor AS DOUBLE) AS valor, "
                "CAST(dias_atraso AS BIGINT) AS dias_atraso",
}


def view_sql(name: str) -> str:
    return with_views(f"SELECT * REPLACE ({_VIEW_NUMERIC[name]}) FROM {name}", name)


def tax_id_sql() -> str:
    c = clean_id("cpf_cnpj")
    return with_views(f"""
SELECT DISTINCT cpf_cnpj, {c} AS cpf_cnpj_limpo, CAST(length({c}) AS BIGINT) AS qtd_caracteres,
  CASE length({c}) WHEN 11 THEN 'CPF' WHEN 14 THEN 'CNPJ' ELSE 'TAMANHO INVÁLIDO' END AS tipo_documento
FROM sales_orders""", "sales_orders")


def aging_720_sql() -> str:
    days = f"({AS_OF} - data_vencimento)"
    return with_views(f"""
SELECT DISTINCT data_vencimento, CAST({days} AS BIGINT) AS dias_atraso, {aging720(days)} AS categoria_atraso
FROM customer_transactions""", "customer_transactions")


def aging_360_sql() -> str:
    days = f"({AS_OF} - data_vencimento)"
    return with_views(f"""
SELECT DISTINCT data_vencimento,
  CAST(IF(data_vencimento IS NULL, NULL, greatest({days}, 0)) AS BIGINT) AS dias_atraso,
  {aging360(days)} AS categoria_atraso
FROM supplier_transactions""", "supplier_transactions")


def aging_to_due_sql() -> str:
    dif = f"(data_vencimento - {AS_OF})"
    return with_views(f"""
SELECT DISTINCT data_vencimento, CAST({dif} AS BIGINT) AS dif_data, {to_due(dif)} AS aging_list
FROM customer_transactions""", "customer_transactions")


def offset_status_sql() -> str:
    return with_views(f"""
SELECT cod_cliente, data_transacao, data_vencimento,
  CAST(acl AS DOUBLE) AS valor_acl, CAST(dpc AS DOUBLE) AS valor_dpc,
  CAST(atc AS DOUBLE) AS valor_atc, CAST(tcc AS DOUBLE) AS valor_tcc,
  {offset('acl', 'dpc', 'atc', 'tcc')} AS status
FROM s""", "customer_transactions", ctes={"s": """
  SELECT cod_cliente, data_transacao, data_vencimento,
    sum(IF(perfil_lanc = 'ACL', valor_moeda, 0)) AS acl, sum(IF(perfil_lanc = 'DPC', valor_moeda, 0)) AS dpc,
    sum(IF(perfil_lanc = 'ATC', valor_moeda, 0)) AS atc, sum(IF(perfil_lanc = 'TCC', valor_moeda, 0)) AS tcc
  FROM customer_transactions
  GROUP BY ALL"""})


def month_name_sql() -> str:
    return with_views(f"""
SELECT CAST(year(data_transacao) AS BIGINT) AS ano, CAST(month(data_transacao) AS BIGINT) AS mes,
  CAST(sum(IF(valor_moeda > 0, valor_moeda, 0)) AS DOUBLE) AS total_debito,
  CAST(count(*) FILTER (WHERE valor_moeda > 0) AS BIGINT) AS qtd_debito,
  CAST(sum(IF(valor_moeda < 0, valor_moeda, 0)) AS DOUBLE) AS total_credito,
  CAST(count(*) FILTER (WHERE valor_moeda < 0) AS BIGINT) AS qtd_credito,
  {month_name('month(data_transacao)')} AS nome_mes
FROM gl_transactions
GROUP BY year(data_transacao), month(data_transacao)""", "gl_transactions")


def calendar_sql() -> str:
    return with_views("""
SELECT DISTINCT data_nota_fiscal,
  isodow(data_nota_fiscal) >= 6 AS fim_de_semana,
  dayname(data_nota_fiscal) AS dia_semana,
  data_nota_fiscal IN (DATE '1998-09-07', DATE '1998-12-25') AS feriado,
  day(last_day(data_nota_fiscal)) - day(data_nota_fiscal) >= 3 AS fora_fim_mes,
  strftime(data_nota_fiscal, '%d/%m/%Y') AS data_texto
FROM sales_orders""", "sales_orders")


def group_lookup_sql() -> str:
    return with_views("""
SELECT s.cod_estabelecimento, coalesce(any_value(g.grupo), 'CADASTRAR') AS grupo, CAST(count(*) AS BIGINT) AS linhas
FROM sales_orders s LEFT JOIN grupos g ON g.code = s.cod_estabelecimento
GROUP BY s.cod_estabelecimento""", "sales_orders", ctes={"grupos": GROUPS_CTE})


def count_over_sql() -> str:
    return with_views("""
SELECT cod_cliente, nota_fiscal, comprovante,
  CAST(count(nota_fiscal) OVER (PARTITION BY cod_cliente, nota_fiscal) AS BIGINT) AS qtd_repeticao_nota
FROM closed_transactions
QUALIFY count(nota_fiscal) OVER (PARTITION BY cod_cliente, nota_fiscal) > 5""", "closed_transactions")


def count_rows_over_sql() -> str:
    return with_views("""
SELECT cod_fornecedor, num_nota_fiscal,
  CAST(count(*) OVER (PARTITION BY cod_fornecedor) AS BIGINT) AS qtd_notas_fornecedor
FROM (SELECT DISTINCT cod_fornecedor, num_nota_fiscal FROM supplier_transactions) d""", "supplier_transactions")


def semi_join_back_sql() -> str:
    return with_views("""
SELECT cod_cliente, num_nota_fiscal, cod_item, CAST(quantidade AS DOUBLE) AS quantidade
FROM sales_orders s
WHERE EXISTS (SELECT 1 FROM sales_orders r WHERE r.cod_cliente = s.cod_cliente AND r.num_nota_fiscal LIKE '%EST%')""",
                      "sales_orders")


def open_as_of_sql() -> str:
    return with_views("""
SELECT perfil_lanc, status,
  CAST(count(*) FILTER (WHERE data_liquidacao = DATE '1900-01-01' OR data_liquidacao > DATE '1998-12-31') AS BIGINT)
    AS abertos_base_seguinte,
  CAST(count(*) FILTER (WHERE data_liquidacao = DATE '1900-01-01' OR data_liquidacao >= DATE '1998-01-01') AS BIGINT)
    AS abertos_desde,
  CAST(count(*) FILTER (WHERE data_liquidacao IS NULL OR data_liquidacao = DATE '1900-01-01'
                         OR data_liquidacao > DATE '1998-12-31') AS BIGINT) AS abertos_ou_nulos,
  CAST(count(*) AS BIGINT) AS linhas
FROM supplier_transactions
GROUP BY perfil_lanc, status""", "supplier_transactions")


# White space of Unicode and the separators U+001C to U+001F, as a RE2 class.
_BLANK = ("[\\x09-\\x0D\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
          "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")


def strip(text: str) -> str:
    """Text without white space at either end."""
    return f"regexp_replace({text}, '^{_BLANK}+|{_BLANK}+$', '', 'g')"


_CONTACTS_KEPT = f"""
  SELECT "Nome do Cliente" AS nome_cliente, "Celular" AS telefone, "NF" AS notas_fiscais, contact_id
  FROM contacts
  WHERE coalesce({strip('"Celular"')}, '') NOT IN ('', 'nan')"""


def confirm_contacts_sql() -> str:
    return with_views("SELECT nome_cliente, telefone, notas_fiscais, contact_id FROM kept", "contacts",
                      ctes={"kept": _CONTACTS_KEPT})


def _sql_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def confirm_messages_sql() -> str:
    digits = "regexp_replace(coalesce(telefone, ''), '[^0-9]', '', 'g')"
    notes = ("list_filter(list_transform(string_split(coalesce(notas_fiscais, ''), ','), "
             f"lambda x: {strip('x')}), lambda x: x <> '')")
    lines = f"array_to_string(list_transform({notes}, lambda x: '  • NF ' || x), chr(10))"
    msg = (f"replace(replace(replace({_sql_literal(fx.TEMPLATE)}, '{{empresa}}', "
           f"{_sql_literal(fx.COMPANY)}), '{{notas}}', {lines}), '{{nome_cliente}}', coalesce(nome_cliente, ''))")
    bad = "'[\\x{10000}-\\x{10FFFF}\\x{0}-\\x{8}\\x{B}\\x{C}\\x{E}-\\x{1F}]'"
    return with_views(f"""
SELECT contact_id, nome_cliente, telefone, telefone_limpo, telefone_limpo IS NOT NULL AS telefone_valido,
  array_to_string(notas, ',') AS notas_texto, CAST(len(notas) AS BIGINT) AS qtd_notas,
  regexp_replace(msg, {bad}, '', 'g') AS mensagem,
  CAST(length(msg) - length(regexp_replace(msg, {bad}, '', 'g')) AS BIGINT) AS caracteres_removidos
FROM (
  SELECT *,
    CASE WHEN {digits} = '' THEN NULL
         WHEN {digits} LIKE '55%' THEN {digits}
         WHEN length({digits}) <= 11 THEN '55' || {digits}
         ELSE {digits} END AS telefone_limpo,
    {notes} AS notas,
    {msg} AS msg
  FROM kept
) t""", "contacts", ctes={"kept": _CONTACTS_KEPT})


def confirm_outcomes_sql() -> str:
    timeout = f"INTERVAL {fx.REPLY_TIMEOUT_SECONDS} SECOND"
    return with_views(f"""
SELECT s.message_id, s.contact_id, s.sent_ts,
  CASE WHEN f.reply_ts IS NOT NULL THEN 'RESPONDIDO' ELSE 'SEM RESPOSTA' END AS status,
  f.reply_text AS resposta, f.reply_ts
FROM sent_messages s LEFT JOIN firsts f ON f.message_id = s.message_id""", "sent_messages", "replies", ctes={
        "ranked": f"""
  SELECT s.message_id, r.reply_ts, {strip('r.reply_text')} AS reply_text,
    row_number() OVER (PARTITION BY s.message_id ORDER BY r.reply_ts, r.reply_id) AS rn
  FROM sent_messages s JOIN replies r
    ON r.contact_id = s.contact_id AND r.reply_ts > s.sent_ts AND r.reply_ts <= s.sent_ts + {timeout}
  WHERE {strip('r.reply_text')} <> ''""",
        "firsts": "SELECT message_id, reply_ts, reply_text FROM ranked WHERE rn = 1"})


def confirm_report_sql() -> str:
    digits = "regexp_replace(coalesce(telefone, ''), '[^0-9]', '', 'g')"
    clean = (f"CASE WHEN {digits} = '' THEN NULL WHEN {digits} LIKE '55%' THEN {digits} "
             f"WHEN length({digits}) <= 11 THEN '55' || {digits} ELSE {digits} END")
    notes = ("array_to_string(list_filter(list_transform(string_split(coalesce(notas_fiscais, ''), ','), "
             f"lambda x: {strip('x')}), lambda x: x <> ''), ',')")
    run_ts = fx.RUN_TS.strftime("%Y-%m-%d %H:%M:%S")
    return with_views(f"""
SELECT nome_cliente, telefone, notas_fiscais, 'ERRO - TELEFONE INVÁLIDO' AS status,
  CAST(NULL AS VARCHAR) AS resposta, TIMESTAMP '{run_ts}' AS data_hora
FROM kept WHERE ({clean}) IS NULL
UNION ALL
SELECT v.nome_cliente, v.telefone, v.notas_fiscais, o.status, o.resposta,
  coalesce(o.reply_ts, o.sent_ts + INTERVAL {fx.REPLY_TIMEOUT_SECONDS} SECOND) AS data_hora
FROM ({confirm_outcomes_sql()}) o LEFT JOIN valid v ON v.contact_id = o.contact_id
UNION ALL
SELECT nome_cliente, telefone, notas_fiscais, 'NÃO ENVIADO', NULL, TIMESTAMP '{run_ts}'
FROM valid v WHERE NOT EXISTS (SELECT 1 FROM sent_messages s WHERE s.contact_id = v.contact_id)""",
                      "contacts", "sent_messages", ctes={"kept": _CONTACTS_KEPT, "valid": f"""
  SELECT contact_id, nome_cliente, {clean} AS telefone, {notes} AS notas_fiscais
  FROM kept WHERE ({clean}) IS NOT NULL"""})


def confirm_send_errors_sql() -> str:
    digits = "regexp_replace(coalesce(telefone, ''), '[^0-9]', '', 'g')"
    lost = "NOT EXISTS (SELECT 1 FROM usable u WHERE u.contact_id = o.contact_id)"
    return with_views(f"""
SELECT message_id, contact_id, sent_ts, CASE WHEN lost THEN 'ERRO - CONTATO NÃO ENCONTRADO' END AS send_error,
  CASE WHEN lost THEN 'ERRO - CONTATO NÃO ENCONTRADO' ELSE status END AS status,
  CASE WHEN NOT lost THEN resposta END AS resposta, CASE WHEN NOT lost THEN reply_ts END AS reply_ts
FROM (SELECT o.*, {lost} AS lost FROM ({confirm_outcomes_sql()}) o) m""", "contacts", ctes={
        "kept": _CONTACTS_KEPT, "usable": f"SELECT contact_id FROM kept WHERE {digits} <> ''"})


def confirm_results_sql() -> str:
    """The report as the result table holds it."""
    return f"SELECT nome_cliente, telefone, notas_fiscais, status, resposta, data_hora FROM ({confirm_report_sql()}) r"


def confirm_sanitize_sql() -> str:
    raw = "coalesce(text || chr(7) || chr(9) || chr(11) || chr(128512), '')"
    clean = f"regexp_replace({raw}, '[\\x{{10000}}-\\x{{10FFFF}}\\x{{0}}-\\x{{8}}\\x{{B}}\\x{{C}}\\x{{E}}-\\x{{1F}}]', '', 'g')"
    return f"""
SELECT conv_id, turn, {clean} AS limpo, CAST(length({raw}) - length({clean}) AS BIGINT) AS removidos
FROM conversations"""


def offset_cases_sql() -> str:
    return f"""
SELECT CAST(a AS BIGINT) AS valor_acl, CAST(d AS BIGINT) AS valor_dpc, CAST(t AS BIGINT) AS valor_atc,
  CAST(c AS BIGINT) AS valor_tcc, {offset('a', 'd', 't', 'c')} AS status, CAST(count(*) AS BIGINT) AS linhas
FROM (SELECT l_orderkey % 3 AS a, l_partkey % 3 AS d, l_suppkey % 3 AS t, l_linenumber % 3 AS c FROM lineitem) v
GROUP BY a, d, t, c"""


def report_sql(key: str, dates: tuple[str, ...] = ()) -> str:
    """A written report table: the check's rows, dates as text where named."""
    text = ", ".join(f"strftime({d}, '%d/%m/%Y') AS {d}" for d in dates)
    return f"SELECT * REPLACE ({text}) FROM ({CHECK_SQL[key]()}) q" if dates else CHECK_SQL[key]()


def ordered_sql() -> str:
    """Supplier advances with each row's position by open amount, largest first."""
    return f"""
SELECT cod_estabelecimento, cod_fornecedor, valor_aberto,
  CAST(rank() OVER (ORDER BY valor_aberto DESC) AS BIGINT) AS posicao
FROM ({CHECK_SQL['afo01_supplier_advances']()}) q"""


def audit_suite_sql() -> str:
    parts = []
    for key in fx.PARAMS:
        check = CATALOG[key]
        inner = CHECK_SQL[key]()
        parts.append(
            f"SELECT '{key}' AS \"check\", '{check.code}' AS code, '{check.area}' AS area, "
            f"{_sql_literal(params_text(fx.PARAMS[key]))} AS parameters, "
            f"CAST((SELECT COUNT(*) FROM ({inner}) q) AS BIGINT) AS rows_found")
    return "\nUNION ALL\n".join(parts)


ORACLE_SQL: dict[str, str] = {key: fn() for key, fn in CHECK_SQL.items()}
ORACLE_SQL.update({
    "audit_suite": audit_suite_sql(),
    "load_view": view_sql("sales_orders"),
    **{f"view_{n}": view_sql(n) for n in ("supplier_transactions", "customer_transactions",
                                          "closed_transactions", "inventory_movements", "gl_transactions",
                                          "open_bin")},
    "tax_id_type": tax_id_sql(),
    "aging_overdue_720": aging_720_sql(),
    "aging_overdue_360": aging_360_sql(),
    "aging_to_due": aging_to_due_sql(),
    "offset_status": offset_status_sql(),
    "month_name_pt": month_name_sql(),
    "calendar_flags": calendar_sql(),
    "group_lookup": group_lookup_sql(),
    "count_over": count_over_sql(),
    "count_rows_over": count_rows_over_sql(),
    "semi_join_back": semi_join_back_sql(),
    "open_as_of": open_as_of_sql(),
    "confirm_contacts": confirm_contacts_sql(),
    "confirm_messages": confirm_messages_sql(),
    "confirm_outcomes": confirm_outcomes_sql(),
    "confirm_outcomes_by_instant": confirm_outcomes_sql(),
    "confirm_send_errors": confirm_send_errors_sql(),
    "confirm_report": confirm_report_sql(),
    "confirm_results": confirm_results_sql(),
    "confirm_sanitize": confirm_sanitize_sql(),
    "confirm_outcomes_stream": confirm_outcomes_sql(),
    "offset_status_cases": offset_cases_sql(),
    "write_report_summary": report_sql("bin01_note_summary"),
    "write_report_detail": report_sql("bin01_note_detail", ("data_transacao", "data_vencimento")),
    "ordered_output": ordered_sql(),
})
