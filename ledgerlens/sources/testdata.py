"""ERP views derived from the TPC-H-like tables under ``/root/testdata/sf*/``.

A production ledger arrives as the seven ERP views themselves (see
:mod:`ledgerlens.sources.views`). To exercise the checks on the driver's data,
each view is derived here from the base tables with the mapping fixed in
FIXTURES.md §2. They are plain projections over equi-joins, so Catalyst pushes
every check's scope predicate through them: date scopes become Parquet
``PushedFilters`` on ``l_shipdate``/``o_orderdate`` and only referenced columns
are read. Join strategy is left to the planner (broadcast only under
``autoBroadcastJoinThreshold``, which is a size check on the scanned side), and
scan parallelism to the files' splits, so the plan is the same at every size.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.constants import UNSETTLED_SENTINEL

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# The fixed date at which the open-BIN view precomputes its days overdue.
OPEN_BIN_AS_OF = _dt.date(1998, 12, 31)


class Tables:
    """Lazy base-table readers for one scale-factor directory; a table's schema is read once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.opened: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in BASE_TABLES:
            raise AttributeError(name)
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.opened[name]


class StreamingTables(Tables):
    """Like :class:`Tables`, but ``events`` arrives as a file stream (one micro-batch per
    file), so the event-derived views (sent messages, replies) become streaming DataFrames."""

    def __getattr__(self, name: str) -> DataFrame:
        if name != "events":
            return super().__getattr__(name)
        schema = self.spark.read.parquet(f"{self.sf_dir}/events.parquet").schema
        return (self.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
                .option("maxFilesPerTrigger", 1).parquet(self.sf_dir))


def _s(c) -> Column:
    return F.col(c).cast("string")


def _padded(c: Column, width: int) -> Column:
    """A number as text with zeros in front up to ``width`` digits; longer numbers keep all their digits."""
    text = c.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def _establishment(nationkey: str) -> Column:
    return F.concat(F.lit("R"), _padded(F.col(nationkey), 2), F.lit("1"))


def _code(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), _padded(F.col(key), 6))


def _tax_id(key: Column, nationkey: str) -> Column:
    """Even keys: an 11-digit CPF-shaped id; odd keys: a 14-digit CNPJ-shaped one. The key's
    digits are all in it, in groups of three, so different keys have different ids."""
    high, mid, low = _padded(F.floor(key / 1_000_000), 3), _padded(F.floor(key / 1000) % 1000, 3), _padded(key % 1000, 3)
    nation = _padded(F.col(nationkey), 2)
    return (F.when(key % 2 == 0, F.concat(high, F.lit("."), mid, F.lit("."), low, F.lit("-"), nation))
            .otherwise(F.concat(F.lit("00."), high, F.lit("."), mid, F.lit("/0"), low, F.lit("-"), nation)))


def _day(ts: str) -> Column:
    return F.col(ts).cast("date")


def _plus_days(ts: str, expr: Column) -> Column:
    return F.date_add(_day(ts), expr.cast("int"))


def _money(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def _sentinel() -> Column:
    return F.lit(UNSETTLED_SENTINEL)


def supplier_transactions(t: Tables) -> DataFrame:
    j = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return j.select(
        _establishment("s_nationkey").alias("cod_estabelecimento"),
        _code("F", "s_suppkey").alias("cod_fornecedor"),
        F.col("s_name").alias("nome_fornecedor"),
        _tax_id(F.col("s_suppkey"), "s_nationkey").alias("cnpj_cpf"),
        _day("l_shipdate").alias("data_transacao"),
        F.when(F.col("l_orderkey") % 97 != 0, _plus_days("l_shipdate", F.col("l_orderkey") % 700))
         .alias("data_vencimento"),
        F.when(F.col("l_linestatus") == "O", _sentinel())
         .otherwise(_plus_days("l_shipdate", F.col("l_partkey") % 400)).alias("data_liquidacao"),
        F.when(F.col("l_returnflag") == "A", "AFO").when(F.col("l_returnflag") == "N", "AVI")
         .otherwise("FOR").alias("perfil_lanc"),
        F.when(F.col("l_linestatus") == "O", "ABERTO").otherwise("FECHADO").alias("status"),
        _s("l_orderkey").alias("num_nota_fiscal"),
        _money("l_extendedprice").alias("valor_moeda"),
    )


def _line_order_customer(t: Tables) -> DataFrame:
    """Orders are joined to their customers first (both carry the check's date and
    establishment scope), then the line items to that: only the scoped orders are
    shuffled by customer, never the line-level result. The planner and AQE choose
    each join's strategy by bytes."""
    scoped_orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return t.lineitem.join(scoped_orders, F.col("l_orderkey") == F.col("o_orderkey"))


def customer_transactions(t: Tables) -> DataFrame:
    ln = F.col("l_linenumber")
    profile = (F.when(ln == 1, "ACL").when(ln == 2, "DPC").when(ln == 3, "ATC")
               .when(ln == 4, "TCC").when(ln == 5, "CCR").otherwise("NFS"))
    return _line_order_customer(t).select(
        _establishment("c_nationkey").alias("cod_estabelecimento"),
        _code("C", "c_custkey").alias("cod_cliente"),
        F.col("c_name").alias("nome_cliente"),
        _day("o_orderdate").alias("data_transacao"),
        F.when(F.col("o_orderkey") % 97 != 0, _plus_days("o_orderdate", F.col("o_orderkey") % 700))
         .alias("data_vencimento"),
        F.when(F.col("o_orderstatus") == "O", _sentinel())
         .otherwise(_plus_days("o_orderdate", F.col("o_orderkey") % 400)).alias("data_liquidacao"),
        profile.alias("perfil_lanc"),
        _s("o_orderkey").alias("num_nota_fiscal"),
        _money("l_extendedprice").alias("valor_moeda"),
        F.when(F.col("o_orderstatus") == "O", "ABERTO").otherwise("FECHADO").alias("status"),
    )


def closed_transactions(t: Tables) -> DataFrame:
    return _line_order_customer(t).select(
        _establishment("c_nationkey").alias("cod_estabelecimento"),
        F.when(F.col("o_orderkey") % 89 != 0, _code("C", "c_custkey")).alias("cod_cliente"),
        F.col("c_name").alias("nome_cliente"),
        _day("o_orderdate").alias("data_transacao"),
        _plus_days("o_orderdate", F.col("l_linenumber") * 30).alias("data_vencimento"),
        F.when(F.col("l_returnflag") == "R", "TND").otherwise("NFS").alias("perfil_lancamento"),
        _s("o_orderkey").alias("nota_fiscal"),
        F.concat(F.lit("V"), _s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("comprovante"),
        F.col("l_linenumber").alias("parcela"),
        _money("l_extendedprice").alias("valor_parcela"),
        _money("o_totalprice").alias("valor_titulo"),
    )


def inventory_movements(t: Tables) -> DataFrame:
    j = (t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(t.part, F.col("l_partkey") == F.col("p_partkey")))
    pk = (F.col("l_partkey") % 4).cast("int")
    op = (F.when(pk == 0, "1.7.001").when(pk == 1, "2.7.001").when(pk == 2, "1.1.001")
          .otherwise("2.1.001"))
    return j.select(
        _establishment("s_nationkey").alias("cod_estabelecimento"),
        F.col("p_brand").alias("deposito"),
        _day("l_shipdate").alias("data"),
        F.when(F.col("l_orderkey") % 10 == 0, F.concat(_s("l_orderkey"), F.lit("-EST")))
         .otherwise(_s("l_orderkey")).alias("num_nota_fiscal"),
        _money("l_quantity").alias("qtd"),
        op.alias("tipo_operacao"),
        F.col("p_type").alias("desc_tipo_operacao"),
    )


def gl_transactions(t: Tables) -> DataFrame:
    j = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    cash = F.col("l_linenumber") <= 2
    return j.select(
        _establishment("s_nationkey").alias("cod_estabelecimento"),
        _day("l_shipdate").alias("data_transacao"),
        F.when(cash, "1.1.01.01.003").otherwise("1.1.01.02.001").alias("conta_contabil"),
        F.when(cash, "CAIXA").otherwise("BANCO").alias("nome_conta"),
        _money(F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice"))
               .otherwise(F.col("l_extendedprice"))).alias("valor_moeda"),
    )


def sales_orders(t: Tables) -> DataFrame:
    j = _line_order_customer(t).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    pk = (F.col("l_partkey") % 5).cast("int")
    cfop = (F.when(pk == 0, "5.102").when(pk == 1, "6.102").when(pk == 2, "5.405")
            .when(pk == 3, "5.949").otherwise("1.202"))
    return j.select(
        _establishment("c_nationkey").alias("cod_estabelecimento"),
        _code("C", "c_custkey").alias("cod_cliente"),
        F.col("c_name").alias("nome_cliente"),
        F.when(F.col("c_custkey") % 101 == 0, F.lit("123.45"))
         .otherwise(_tax_id(F.col("c_custkey"), "c_nationkey")).alias("cpf_cnpj"),
        _day("o_orderdate").alias("data_nota_fiscal"),
        F.when(F.col("o_orderkey") % 10 == 0, F.concat(_s("o_orderkey"), F.lit("-EST")))
         .otherwise(_s("o_orderkey")).alias("num_nota_fiscal"),
        _s("l_partkey").alias("cod_item"),
        F.col("p_name").alias("descr_item"),
        _money("l_quantity").alias("quantidade"),
        _money("l_extendedprice").alias("valor"),
        _money(F.col("l_quantity") * 15).alias("peso_bin"),
        cfop.alias("cfop"),
        F.col("p_type").alias("desc_tipo_operacao"),
        F.when(F.col("o_orderstatus") == "P", "Não").otherwise("Sim").alias("para_faturamento"),
    )


def open_bin(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    due = F.date_add(_day("o_orderdate"), 30)
    return _line_order_customer(t).select(
        _establishment("c_nationkey").alias("cod_estabelecimento"),
        _code("C", "c_custkey").alias("cod_cliente"),
        F.col("c_name").alias("nome_cliente"),
        _day("o_orderdate").alias("data_transacao"),
        due.alias("data_vencimento"),
        F.when(status == "O", _sentinel()).when(status == "P", F.lit(None).cast("date"))
         .otherwise(_plus_days("o_orderdate", F.col("o_orderkey") % 1500)).alias("data_liquidacao"),
        _s("o_orderkey").alias("num_nota_fiscal"),
        F.concat(F.lit("V"), _s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("comprovante"),
        _money(F.col("l_quantity") * 20).alias("peso_bin_original"),
        _money(F.col("l_quantity") * 5).alias("peso_bin_baixado"),
        _money(F.col("l_quantity") * 15).alias("peso_bin_aberto"),
        _money("l_extendedprice").alias("valor"),
        F.when((status == "F") & (F.col("o_orderkey") % 3 == 0), "FECHADO").otherwise("ABERTO").alias("status"),
        F.when(F.col("l_partkey") % 7 == 0, "AX").otherwise("D365").alias("sistema"),
        F.datediff(F.lit(OPEN_BIN_AS_OF), due).cast("int").alias("dias_atraso"),
    )


def contacts(t: Tables) -> DataFrame:
    """A contact sheet as a user would upload it: free header names, every column text."""
    k = F.col("c_custkey")
    k4 = _padded(k, 4)
    m = (k % 6).cast("int")
    phone = (F.when(m == 0, F.concat(F.lit("(81) 9"), k4, F.lit("-1234")))
             .when(m == 1, F.concat(F.lit("+55 81 9"), k4, F.lit("-1234")))
             .when(m == 2, F.lit("   "))
             .when(m == 3, F.lit(None).cast("string"))
             .when(m == 4, F.lit("sem telefone"))
             .otherwise(F.concat(F.lit("55 9"), k4, F.lit("1234"))))
    notes = (F.when(k % 4 == 0, F.lit(None).cast("string"))
             .when(k % 4 == 1, F.concat(_s("c_custkey"), F.lit(",\t"), (k + 1).cast("string"), F.lit("\n,\u00a0,\t")))
             .otherwise(F.concat(F.lit(" "), _s("c_custkey"), F.lit(", ,"), (k + 1).cast("string"))))
    return t.customer.select(
        F.col("c_name").alias("Nome do Cliente"),
        phone.alias("Celular"),
        notes.alias("NF"),
        k.alias("contact_id"),
    )


def sent_messages(t: Tables) -> DataFrame:
    return (t.events.filter(F.col("event_type") == "view")
            .select(F.col("event_id").alias("message_id"), F.col("user_id").alias("contact_id"),
                    F.col("ts").alias("sent_ts")))


def replies(t: Tables) -> DataFrame:
    eid = F.col("event_id")
    text = (F.when(eid % 15 == 0, "\u00a0").when(eid % 5 == 0, "  ").when(eid % 2 == 0, "SIM\u2003")
            .otherwise("NÃO"))
    return (t.events.filter(F.col("event_type") == "click")
            .select(eid.alias("reply_id"), F.col("user_id").alias("contact_id"),
                    F.col("ts").alias("reply_ts"), text.alias("reply_text")))


VIEW_BUILDERS = {
    "supplier_transactions": supplier_transactions,
    "customer_transactions": customer_transactions,
    "closed_transactions": closed_transactions,
    "inventory_movements": inventory_movements,
    "gl_transactions": gl_transactions,
    "sales_orders": sales_orders,
    "open_bin": open_bin,
    "contacts": contacts,
    "sent_messages": sent_messages,
    "replies": replies,
}


def testdata_view(spark: SparkSession, sf_dir: str, name: str, tables: Tables | None = None) -> DataFrame:
    """One derived view over the base tables in ``sf_dir`` (``tables``: readers shared by several views)."""
    try:
        builder = VIEW_BUILDERS[name]
    except KeyError:
        raise ValueError(f"unknown view {name!r}; known: {sorted(VIEW_BUILDERS)}") from None
    return builder(tables or Tables(spark, sf_dir))
