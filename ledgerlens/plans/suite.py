"""Check catalog and the audit suite.

Checks carry a code ``AREA.NN``. The suite runs a selection of them over the
given views and returns one table: code, area, parameters and rows found. A view
that several checks read is scoped and cut to the columns they need together and
written once, so its sources are read once; checks that list rows are conditional
counts of one aggregate, the others distributed counts, and the one-row frames are
unioned. Nothing is collected.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions._util import to_date_value
from ledgerlens.operators import scope_filter
from ledgerlens.plans.afo import afo01_supplier_advances
from ledgerlens.plans.bin import (
    bin01_note_detail,
    bin01_note_summary,
    bin02_split_notes,
    bin06_no_finance_moves,
)
from ledgerlens.plans.car import (
    car04_individual_billing,
    car04_rows,
    car05_advance_offset,
    car06_overdue_receivables,
    car07_open_bin_overdue,
    car07_rows,
    car09_open_travel_advances,
    car10_multiple_advances,
)
from ledgerlens.plans.cax import cax02_cash_over_limit
from ledgerlens.plans.rec import billing_extract, billing_rows, rec07_weekend_holiday_billing
from ledgerlens.session import checkpoint_dir
from ledgerlens.sources.views import collated_scope


@dataclass(frozen=True)
class Check:
    """A catalogued check. ``needs``: the view's columns that its number of rows depends on; ``rows``: for
    a check that lists rows of its view, their predicate, given the check's parameters."""

    code: str
    area: str
    view: str
    fn: Callable[..., DataFrame]
    needs: tuple[str, ...]
    rows: Callable[..., Column] | None = None


# Area names as the audited repository files them.
AREA_SUPPLIER_ADVANCES = "Adiantamentos a Fornecedores"
AREA_BIN = "BIN"
AREA_CASH = "Caixa"
AREA_RECEIVABLES = "Contas a Receber"
AREA_REVENUE = "Receita"
AREA_RPA = "RPA"

_SUPPLIER = ("cod_estabelecimento", "cod_fornecedor", "data_transacao", "perfil_lanc", "status")
_ADVANCE = (*_SUPPLIER, "nome_fornecedor", "cnpj_cpf", "data_vencimento", "num_nota_fiscal")
_NOTE = ("cod_estabelecimento", "cod_cliente", "data_transacao", "perfil_lancamento", "nota_fiscal")
_SALE = ("cod_estabelecimento", "data_nota_fiscal", "para_faturamento", "num_nota_fiscal", "cfop", "cpf_cnpj")
_RECEIVABLE = ("cod_estabelecimento", "cod_cliente", "nome_cliente", "data_transacao", "data_vencimento", "perfil_lanc",
               "valor_moeda")

CATALOG: dict[str, Check] = {
    "afo01_supplier_advances": Check("AFO.01", AREA_SUPPLIER_ADVANCES, "supplier_transactions", afo01_supplier_advances,
                                     (*_SUPPLIER, "data_liquidacao", "valor_moeda")),
    "bin01_note_summary": Check("BIN.01", AREA_BIN, "closed_transactions", bin01_note_summary, (*_NOTE, "nome_cliente")),
    "bin01_note_detail": Check("BIN.01", AREA_BIN, "closed_transactions", bin01_note_detail, _NOTE),
    "bin02_split_notes": Check("BIN.02", AREA_BIN, "closed_transactions", bin02_split_notes, _NOTE),
    "bin06_no_finance_moves": Check("BIN.06", AREA_BIN, "inventory_movements", bin06_no_finance_moves, (
        "cod_estabelecimento", "deposito", "data", "num_nota_fiscal", "tipo_operacao", "desc_tipo_operacao")),
    "cax02_cash_over_limit": Check("CAX.02", AREA_CASH, "gl_transactions", cax02_cash_over_limit, (
        "cod_estabelecimento", "data_transacao", "conta_contabil", "nome_conta", "valor_moeda")),
    "car04_individual_billing": Check("CAR.04", AREA_RECEIVABLES, "sales_orders", car04_individual_billing, _SALE,
                                      car04_rows),
    "car05_advance_offset": Check("CAR.05", AREA_RECEIVABLES, "customer_transactions", car05_advance_offset, _RECEIVABLE),
    "car06_overdue_receivables": Check("CAR.06", AREA_RECEIVABLES, "customer_transactions", car06_overdue_receivables,
                                       (*_RECEIVABLE, "data_liquidacao", "num_nota_fiscal", "status")),
    "car07_open_bin_overdue": Check("CAR.07", AREA_RECEIVABLES, "open_bin", car07_open_bin_overdue, (
        "cod_estabelecimento", "data_transacao", "dias_atraso", "peso_bin_aberto", "status", "sistema",
        "data_liquidacao"), car07_rows),
    "car09_open_travel_advances": Check("CAR.09", AREA_RECEIVABLES, "supplier_transactions", car09_open_travel_advances,
                                        _ADVANCE),
    "car10_multiple_advances": Check("CAR.10", AREA_RECEIVABLES, "supplier_transactions", car10_multiple_advances,
                                     (*_ADVANCE, "valor_moeda")),
    "rec07_weekend_holiday_billing": Check("REC.07", AREA_REVENUE, "sales_orders", rec07_weekend_holiday_billing,
                                           (*_SALE, "cod_cliente", "nome_cliente")),
    "billing_extract": Check("RPA.FAT", AREA_RPA, "sales_orders", billing_extract,
                             ("cod_estabelecimento", "data_nota_fiscal"), billing_rows),
}


def params_text(params: Mapping) -> str:
    """Parameters as compact JSON with sorted keys; dates ISO, tuples as lists."""
    def conv(v):
        if isinstance(v, (_dt.date, _dt.datetime)):
            return v.isoformat()
        if isinstance(v, (list, tuple, set, frozenset)):
            return [conv(x) for x in v]
        return v
    return json.dumps({k: conv(v) for k, v in sorted(params.items())}, ensure_ascii=False,
                      separators=(",", ":"))


def select_checks(codes: Sequence[str] | None = None, areas: Sequence[str] | None = None) -> list[str]:
    """Catalog keys whose code (``"CAR.04"``) or area (``"Contas a Receber"``) is listed;
    with neither given, every check. Unknown codes or areas raise ``ValueError``."""
    codes_set = set(codes or ())
    areas_set = set(areas or ())
    known_codes = {c.code for c in CATALOG.values()}
    known_areas = {c.area for c in CATALOG.values()}
    if codes_set - known_codes or areas_set - known_areas:
        raise ValueError(f"unknown codes {sorted(codes_set - known_codes)} or areas {sorted(areas_set - known_areas)}")
    if not codes_set and not areas_set:
        return list(CATALOG)
    return [k for k, c in CATALOG.items() if c.code in codes_set or c.area in areas_set]


def run_check(key: str, views: Mapping[str, DataFrame], params: Mapping,
              collation: str | None = None) -> DataFrame:
    """Run one catalogued check on its view; ``collation`` (e.g. ``UTF8_LCASE``)
    makes its text comparisons follow that collation."""
    check = CATALOG[key]
    return check.fn(collated_scope(views[check.view], collation, params.get("establishments")), **params)


def joint_establishments(scopes: Sequence[Mapping]) -> list[str] | None:
    """The establishments of several checks' parameters; none if a check has no such scope."""
    sites = [s.get("establishments") for s in scopes]
    return None if None in sites else sorted({e for s in sites for e in ([s] if isinstance(s, str) else s)})


def joint_scope(df: DataFrame, scopes: Sequence[Mapping]) -> DataFrame:
    """The rows of a view that any of several checks' parameters can select.

    Establishments are united; dates keep the latest end and, if every check has
    one, the earliest start. A check without a bound lifts it for all.
    """
    date_col = "data" if "data" in df.columns else (
        "data_transacao" if "data_transacao" in df.columns else "data_nota_fiscal")
    starts = [s.get("start") for s in scopes]
    ends = [s.get("end", s.get("base_date")) for s in scopes]
    return scope_filter(df, establishments=joint_establishments(scopes), date_col=date_col,
                        start=None if None in starts else min(map(to_date_value, starts)),
                        end=None if None in ends else max(map(to_date_value, ends)))


def share_views(checks: Sequence[str], views: Mapping[str, DataFrame],
                params: Mapping[str, Mapping]) -> dict[str, DataFrame]:
    """The views; those with several readers scoped, cut to the columns that count, written once and reread.

    The writes are jobs of their own and run side by side. Columns that no check's number
    of rows depends on are NULL in the views that are reread; Catalyst drops them.
    """
    out = dict(views)
    shared = {}
    for name in sorted({CATALOG[k].view for k in checks}):
        readers = [k for k in checks if CATALOG[k].view == name]
        if len(readers) > 1:
            needs = {c for k in readers for c in CATALOG[k].needs}
            kept = [c for c in views[name].columns if c in needs]
            shared[name] = joint_scope(views[name], [params.get(k, {}) for k in readers]).select(*kept)
    if shared:
        spark = next(iter(views.values())).sparkSession
        folder = f"{checkpoint_dir(spark, local_fallback=True).rstrip('/')}/suite-{uuid.uuid4().hex}"
        with ThreadPoolExecutor(len(shared)) as pool:
            list(pool.map(lambda name: shared[name].write.parquet(f"{folder}/{name}"), shared))
        for name in shared:
            narrow = spark.read.schema(shared[name].schema).parquet(f"{folder}/{name}")
            out[name] = narrow.select(*[F.col(f.name) if f.name in narrow.columns else F.lit(None).cast(f.dataType).alias(
                f.name) for f in views[name].schema.fields])
    return out


def audit_suite(checks: Sequence[str], views: Mapping[str, DataFrame],
                params: Mapping[str, Mapping], collation: str | None = None,
                share: bool = True) -> DataFrame:
    """One row per check: ``check``, ``code``, ``area``, ``parameters``, ``rows_found``.

    Checks that list rows of one view are counted by one aggregate over it; the others
    run unordered (their row order does not change a count, so no sort is planned).
    ``share`` writes each view with several readers once (see :func:`share_views`); not
    with a collation, where a scope is compared otherwise.
    """
    if not checks:
        raise ValueError("no checks selected")
    if share and not collation:
        views = share_views(checks, views, params)
    frames, listed = [], {}
    for key in checks:
        check = CATALOG[key]
        p = dict(params.get(key, {}))
        name = F.struct(F.lit(key).alias("check"), F.lit(check.code).alias("code"), F.lit(check.area).alias("area"),
                        F.lit(params_text({k: v for k, v in p.items() if k != "ordered"})).alias("parameters"))
        if check.rows is not None:
            listed.setdefault(check.view, []).append((name, F.count_if(check.rows(**p))))
            continue
        if "ordered" in check.fn.__code__.co_varnames:
            p.setdefault("ordered", False)
        result = check.fn(collated_scope(views[check.view], collation, p.get("establishments")), **p)
        frames.append(result.agg(F.count(F.lit(1)).alias("rows_found")).select(name.alias("c"), "rows_found"))
    for view, some in listed.items():
        sites = joint_establishments([params.get(k, {}) for k in checks if CATALOG[k].view == view and CATALOG[k].rows is not None])
        counts = collated_scope(views[view], collation, sites).agg(*[n.alias(f"n{i}") for i, (_, n) in enumerate(some)])
        each = F.explode(F.array(*[F.struct(c.alias("c"), F.col(f"n{i}").alias("rows_found")) for i, (c, _) in enumerate(some)]))
        frames.append(counts.select(each.alias("e")).select("e.c", "e.rows_found"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select("c.check", "c.code", "c.area", "c.parameters", "rows_found")
