"""The derived views (FIXTURES.md §2) as DuckDB CTE text over the base tables."""

from __future__ import annotations

import re

VIEW_SQL = {
    "supplier_transactions": """
SELECT 'R' || pad(s_nationkey, 2) || '1' AS cod_estabelecimento,
  'F' || pad(s_suppkey, 6) AS cod_fornecedor,
  s_name AS nome_fornecedor,
  CASE WHEN s_suppkey % 2 = 0
    THEN pad(s_suppkey // 1000000, 3) || '.' || pad(s_suppkey // 1000 % 1000, 3) || '.' || pad(s_suppkey % 1000, 3) || '-' || pad(s_nationkey, 2)
    ELSE '00.' || pad(s_suppkey // 1000000, 3) || '.' || pad(s_suppkey // 1000 % 1000, 3) || '/0' || pad(s_suppkey % 1000, 3) || '-' || pad(s_nationkey, 2) END AS cnpj_cpf,
  CAST(l_shipdate AS DATE) AS data_transacao,
  CASE WHEN l_orderkey % 97 <> 0 THEN CAST(l_shipdate AS DATE) + CAST(l_orderkey % 700 AS INT) END AS data_vencimento,
  CASE WHEN l_linestatus = 'O' THEN DATE '1900-01-01'
    ELSE CAST(l_shipdate AS DATE) + CAST(l_partkey % 400 AS INT) END AS data_liquidacao,
  CASE l_returnflag WHEN 'A' THEN 'AFO' WHEN 'N' THEN 'AVI' ELSE 'FOR' END AS perfil_lanc,
  CASE WHEN l_linestatus = 'O' THEN 'ABERTO' ELSE 'FECHADO' END AS status,
  CAST(l_orderkey AS VARCHAR) AS num_nota_fiscal,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS valor_moeda
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "customer_transactions": """
SELECT 'R' || pad(c_nationkey, 2) || '1' AS cod_estabelecimento,
  'C' || pad(c_custkey, 6) AS cod_cliente,
  c_name AS nome_cliente,
  CAST(o_orderdate AS DATE) AS data_transacao,
  CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 700 AS INT) END AS data_vencimento,
  CASE WHEN o_orderstatus = 'O' THEN DATE '1900-01-01'
    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INT) END AS data_liquidacao,
  CASE l_linenumber WHEN 1 THEN 'ACL' WHEN 2 THEN 'DPC' WHEN 3 THEN 'ATC'
    WHEN 4 THEN 'TCC' WHEN 5 THEN 'CCR' ELSE 'NFS' END AS perfil_lanc,
  CAST(o_orderkey AS VARCHAR) AS num_nota_fiscal,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS valor_moeda,
  CASE WHEN o_orderstatus = 'O' THEN 'ABERTO' ELSE 'FECHADO' END AS status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "closed_transactions": """
SELECT 'R' || pad(c_nationkey, 2) || '1' AS cod_estabelecimento,
  CASE WHEN o_orderkey % 89 <> 0 THEN 'C' || pad(c_custkey, 6) END AS cod_cliente,
  c_name AS nome_cliente,
  CAST(o_orderdate AS DATE) AS data_transacao,
  CAST(o_orderdate AS DATE) + CAST(30 * l_linenumber AS INT) AS data_vencimento,
  CASE WHEN l_returnflag = 'R' THEN 'TND' ELSE 'NFS' END AS perfil_lancamento,
  CAST(o_orderkey AS VARCHAR) AS nota_fiscal,
  'V' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS comprovante,
  l_linenumber AS parcela,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS valor_parcela,
  CAST(o_totalprice AS DECIMAL(18,2)) AS valor_titulo
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "inventory_movements": """
SELECT 'R' || pad(s_nationkey, 2) || '1' AS cod_estabelecimento,
  p_brand AS deposito,
  CAST(l_shipdate AS DATE) AS data,
  CASE WHEN l_orderkey % 10 = 0 THEN CAST(l_orderkey AS VARCHAR) || '-EST'
    ELSE CAST(l_orderkey AS VARCHAR) END AS num_nota_fiscal,
  CAST(l_quantity AS DECIMAL(18,2)) AS qtd,
  CASE CAST(l_partkey % 4 AS INT) WHEN 0 THEN '1.7.001' WHEN 1 THEN '2.7.001'
    WHEN 2 THEN '1.1.001' ELSE '2.1.001' END AS tipo_operacao,
  p_type AS desc_tipo_operacao
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
    "gl_transactions": """
SELECT 'R' || pad(s_nationkey, 2) || '1' AS cod_estabelecimento,
  CAST(l_shipdate AS DATE) AS data_transacao,
  CASE WHEN l_linenumber <= 2 THEN '1.1.01.01.003' ELSE '1.1.01.02.001' END AS conta_contabil,
  CASE WHEN l_linenumber <= 2 THEN 'CAIXA' ELSE 'BANCO' END AS nome_conta,
  CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,2)) AS valor_moeda
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "sales_orders": """
SELECT 'R' || pad(c_nationkey, 2) || '1' AS cod_estabelecimento,
  'C' || pad(c_custkey, 6) AS cod_cliente,
  c_name AS nome_cliente,
  CASE WHEN c_custkey % 101 = 0 THEN '123.45' ELSE CASE WHEN c_custkey % 2 = 0
    THEN pad(c_custkey // 1000000, 3) || '.' || pad(c_custkey // 1000 % 1000, 3) || '.' || pad(c_custkey % 1000, 3) || '-' || pad(c_nationkey, 2)
    ELSE '00.' || pad(c_custkey // 1000000, 3) || '.' || pad(c_custkey // 1000 % 1000, 3) || '/0' || pad(c_custkey % 1000, 3) || '-' || pad(c_nationkey, 2) END END AS cpf_cnpj,
  CAST(o_orderdate AS DATE) AS data_nota_fiscal,
  CASE WHEN o_orderkey % 10 = 0 THEN CAST(o_orderkey AS VARCHAR) || '-EST'
    ELSE CAST(o_orderkey AS VARCHAR) END AS num_nota_fiscal,
  CAST(l_partkey AS VARCHAR) AS cod_item,
  p_name AS descr_item,
  CAST(l_quantity AS DECIMAL(18,2)) AS quantidade,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS valor,
  CAST(l_quantity * 15 AS DECIMAL(18,2)) AS peso_bin,
  CASE CAST(l_partkey % 5 AS INT) WHEN 0 THEN '5.102' WHEN 1 THEN '6.102' WHEN 2 THEN '5.405'
    WHEN 3 THEN '5.949' ELSE '1.202' END AS cfop,
  p_type AS desc_tipo_operacao,
  CASE WHEN o_orderstatus = 'P' THEN 'Não' ELSE 'Sim' END AS para_faturamento
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey""",
    "open_bin": """
SELECT 'R' || pad(c_nationkey, 2) || '1' AS cod_estabelecimento,
  'C' || pad(c_custkey, 6) AS cod_cliente,
  c_name AS nome_cliente,
  CAST(o_orderdate AS DATE) AS data_transacao,
  CAST(o_orderdate AS DATE) + 30 AS data_vencimento,
  CASE o_orderstatus WHEN 'O' THEN DATE '1900-01-01' WHEN 'P' THEN NULL
    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 1500 AS INT) END AS data_liquidacao,
  CAST(o_orderkey AS VARCHAR) AS num_nota_fiscal,
  'V' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS comprovante,
  CAST(l_quantity * 20 AS DECIMAL(18,2)) AS peso_bin_original,
  CAST(l_quantity * 5 AS DECIMAL(18,2)) AS peso_bin_baixado,
  CAST(l_quantity * 15 AS DECIMAL(18,2)) AS peso_bin_aberto,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS valor,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN 'FECHADO' ELSE 'ABERTO' END AS status,
  CASE WHEN l_partkey % 7 = 0 THEN 'AX' ELSE 'D365' END AS sistema,
  CAST(DATE '1998-12-31' - (CAST(o_orderdate AS DATE) + 30) AS INT) AS dias_atraso
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "contacts": """
SELECT c_name AS "Nome do Cliente",
  CASE CAST(c_custkey % 6 AS INT)
    WHEN 0 THEN '(81) 9' || pad(c_custkey, 4) || '-1234'
    WHEN 1 THEN '+55 81 9' || pad(c_custkey, 4) || '-1234'
    WHEN 2 THEN '   '
    WHEN 3 THEN NULL
    WHEN 4 THEN 'sem telefone'
    ELSE '55 9' || pad(c_custkey, 4) || '1234' END AS "Celular",
  CASE WHEN c_custkey % 4 = 0 THEN NULL
    WHEN c_custkey % 4 = 1 THEN CAST(c_custkey AS VARCHAR) || ',' || chr(9) || CAST(c_custkey + 1 AS VARCHAR)
      || chr(10) || ',' || chr(160) || ',' || chr(9)
    ELSE ' ' || CAST(c_custkey AS VARCHAR) || ', ,' || CAST(c_custkey + 1 AS VARCHAR) END AS "NF",
  c_custkey AS contact_id
FROM customer""",
    "sent_messages": """
SELECT event_id AS message_id, user_id AS contact_id, ts AS sent_ts FROM events WHERE event_type = 'view'""",
    "replies": """
SELECT event_id AS reply_id, user_id AS contact_id, ts AS reply_ts,
  CASE WHEN event_id % 15 = 0 THEN chr(160) WHEN event_id % 5 = 0 THEN '  '
    WHEN event_id % 2 = 0 THEN 'SIM' || chr(8195) ELSE 'NÃO' END AS reply_text
FROM events WHERE event_type = 'click'""",
}


# pad(number, width): zeros in front up to the width, never fewer digits than the number has.
_PAD = re.compile(r"pad\(([^(),]+), (\d)\)")
VIEW_SQL = {name: _PAD.sub(r"lpad(CAST(\1 AS VARCHAR), greatest(\2, length(CAST(\1 AS VARCHAR)))::INTEGER, '0')", sql)
            for name, sql in VIEW_SQL.items()}


def with_views(sql: str, *views: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs of the named views, then any extra named CTEs."""
    parts = [f"{v} AS ({VIEW_SQL[v]}\n)" for v in views]
    parts += [f"{name} AS (\n{body}\n)" for name, body in (ctes or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n" + sql
