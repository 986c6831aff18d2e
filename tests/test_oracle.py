"""Every registered query against its DuckDB oracle on the smallest scale."""

import datetime as dt
import re

import duckdb
import pytest

import __spark_entry__ as entry
from paths import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return round(v, 6)
        if isinstance(v, dt.datetime):
            return v.replace(tzinfo=None)
        return v
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


OWN = re.compile(r"op\d+_|pipeline$")


@pytest.mark.parametrize("name", sorted(k for k in entry.oracle_sql() if not OWN.match(k)))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    srows = [tuple(r) for r in df.collect()]
    assert len(srows) == len(drows)
    assert _canon(df.columns, srows) == _canon(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 5
    assert df.columns[:2] == ["cod_estabelecimento", "cod_fornecedor"]


def test_every_reference_query_has_an_oracle():
    assert {k for k in entry.queries() if not OWN.match(k)} <= set(entry.oracle_sql()) <= set(entry.queries())


def test_cases_that_the_views_must_reach(spark):
    q = entry.queries()
    assert {r.status for r in q["offset_status_cases"](spark, SF_SMALL).select("status").distinct().collect()} == {
        "OK", "Baixar ACL", "Baixar DPC", "Baixar ATC", "Baixar TCC", "Não Aplicável"}
    assert {r.tipo_documento for r in q["tax_id_type"](spark, SF_SMALL).collect()} == {"CPF", "CNPJ", "TAMANHO INVÁLIDO"}
    for name in ("aging_overdue_720", "aging_overdue_360", "aging_to_due"):
        assert q[name](spark, SF_SMALL).filter("data_vencimento IS NULL").count() == 1
    assert q["view_closed_transactions"](spark, SF_SMALL).filter("cod_cliente IS NULL").count() > 0
    assert q["confirm_sanitize"](spark, SF_SMALL).filter("removidos >= 3").count() > 0
