"""Reading the ERP views.

Canonical column names are the audited views' names in lower case; the two
bracketed tax-id spellings become ``cnpj_cpf`` (suppliers) and ``cpf_cnpj``
(sales orders). Money is ``decimal(18,2)``, dates are ``date``.

Production layout: each view stored as Parquet partitioned by
``cod_estabelecimento`` (see :func:`materialize_view`), so that every check's
establishment scope prunes directories and its date scope is a pushed filter.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources.testdata import testdata_view

_S, _D, _I = T.StringType(), T.DateType(), T.IntegerType()
_M = T.DecimalType(18, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


VIEW_SCHEMAS: dict[str, T.StructType] = {
    "supplier_transactions": _schema(
        ("cod_estabelecimento", _S), ("cod_fornecedor", _S), ("nome_fornecedor", _S), ("cnpj_cpf", _S),
        ("data_transacao", _D), ("data_vencimento", _D), ("data_liquidacao", _D), ("perfil_lanc", _S),
        ("status", _S), ("num_nota_fiscal", _S), ("valor_moeda", _M)),
    "customer_transactions": _schema(
        ("cod_estabelecimento", _S), ("cod_cliente", _S), ("nome_cliente", _S), ("data_transacao", _D),
        ("data_vencimento", _D), ("data_liquidacao", _D), ("perfil_lanc", _S), ("num_nota_fiscal", _S),
        ("valor_moeda", _M), ("status", _S)),
    "closed_transactions": _schema(
        ("cod_estabelecimento", _S), ("cod_cliente", _S), ("nome_cliente", _S), ("data_transacao", _D),
        ("data_vencimento", _D), ("perfil_lancamento", _S), ("nota_fiscal", _S), ("comprovante", _S),
        ("parcela", _I), ("valor_parcela", _M), ("valor_titulo", _M)),
    "inventory_movements": _schema(
        ("cod_estabelecimento", _S), ("deposito", _S), ("data", _D), ("num_nota_fiscal", _S), ("qtd", _M),
        ("tipo_operacao", _S), ("desc_tipo_operacao", _S)),
    "gl_transactions": _schema(
        ("cod_estabelecimento", _S), ("data_transacao", _D), ("conta_contabil", _S), ("nome_conta", _S),
        ("valor_moeda", _M)),
    "sales_orders": _schema(
        ("cod_estabelecimento", _S), ("cod_cliente", _S), ("nome_cliente", _S), ("cpf_cnpj", _S),
        ("data_nota_fiscal", _D), ("num_nota_fiscal", _S), ("cod_item", _S), ("descr_item", _S),
        ("quantidade", _M), ("valor", _M), ("peso_bin", _M), ("cfop", _S), ("desc_tipo_operacao", _S),
        ("para_faturamento", _S)),
    "open_bin": _schema(
        ("cod_estabelecimento", _S), ("cod_cliente", _S), ("nome_cliente", _S), ("data_transacao", _D),
        ("data_vencimento", _D), ("data_liquidacao", _D), ("num_nota_fiscal", _S), ("comprovante", _S),
        ("peso_bin_original", _M), ("peso_bin_baixado", _M), ("peso_bin_aberto", _M), ("valor", _M),
        ("status", _S), ("sistema", _S), ("dias_atraso", _I)),
}

#: Ending of the stored columns that hold a key in the form case-insensitive comparisons see.
FOLDED = "__folded"
HISTOGRAM_BINS = 1000

# Source column spellings that differ from the lower-cased canonical name.
_RENAMES = {"cnpj/cpf": "cnpj_cpf", "cpf/cnpj": "cpf_cnpj"}


def canonical_columns(df: DataFrame, name: str, *, folded: bool = False) -> DataFrame:
    """Lower-case the columns, map the bracketed tax-id names, and cast to the view schema; ``folded`` keeps stored folded keys."""
    schema = VIEW_SCHEMAS[name]
    by_lower = {}
    for c in df.columns:
        key = c.strip().lower()
        by_lower.setdefault(_RENAMES.get(key, key), c)
    cols = []
    for f in schema.fields:
        if f.name not in by_lower:
            raise ValueError(f"view {name!r} is missing column {f.name!r}")
        cols.append(df[f"`{by_lower[f.name]}`"].cast(f.dataType).alias(f.name))
    if folded:
        cols += [df[f"`{by_lower[f.name + FOLDED]}`"].alias(f.name + FOLDED) for f in schema.fields
                 if f.name + FOLDED in by_lower]
    return df.select(*cols)


def fold_key(col: Column) -> Column:
    """A text as ``UTF8_LCASE`` compares it, in the default collation, so that stored columns of it can be pushed filters."""
    return F.collate(F.lower(F.collate(col, "UTF8_LCASE")), "UTF8_BINARY")


def split_histogram(df: DataFrame, column: str, *, bins: int = HISTOGRAM_BINS) -> list[tuple]:
    """Lower bounds and row counts of at most ``bins + 1`` ranges of a numeric or date column; NULLs last, if there are any.

    ``df`` is the view, or any table of its values (a stored copy). The bounds are
    approximate quantiles; the counts are exact. Both are aggregates that combine inside
    each task, so a value with a third of all rows is no task's group, and only the
    ranges reach the driver.
    """
    if df.schema[column].dataType.typeName() in ("string", "binary", "boolean"):
        raise ValueError("the column must be numeric, a date or a time")
    v = F.col(column)
    shares = [i / bins for i in range(bins)]
    cuts = df.agg(F.min(v).alias("least"), F.percentile_approx(v, shares, 10 * bins).alias("q")).first()
    bounds = sorted({cuts["least"], *(cuts["q"] or ())} - {None})
    known = F.array(*[F.lit(b) for b in bounds])
    bound = F.array_max(F.filter(known, lambda c: c <= v)) if bounds else F.lit(None)
    found = df.groupBy(F.when(v.isNotNull(), bound).alias("low")).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted(((r["low"], r["n"]) for r in found), key=lambda x: (x[0] is None, x[0] if x[0] is not None else 0))


def _literal(value) -> str:
    if isinstance(value, (bool, float)) or not isinstance(value, (int, Decimal, str, _dt.date)):
        raise ValueError(f"no exact SQL literal for {value!r}")
    if isinstance(value, (int, Decimal)):
        return str(value)
    text = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat() if isinstance(
        value, _dt.date) else value
    return "'" + text.replace("'", "''") + "'"


def split_predicates(histogram: Sequence[tuple], column: str, parts: int, *, within: str | None = None) -> list[str]:
    """WHERE texts of about equal row counts, one per task of a JDBC read: disjoint, and complete for every value and NULL.

    ``histogram``: (lower bound, rows) per range, rows without a value under None (see
    :func:`split_histogram`). Ranges are joined until they hold a part's share. A range
    (or the NULLs) beyond a share is a part alone, split further by the remainder of the
    integer column ``within`` if that is given; rows where ``within`` is NULL go to the
    first remainder. The first and the last range are open, so rows that came after the
    histogram was made belong to a part as well.
    """
    if parts < 1:
        raise ValueError("parts must be positive")
    total = sum(n for _, n in histogram)
    share = max(1, -(-total // parts))
    ranges = sorted(((low, n) for low, n in histogram if low is not None), key=lambda x: x[0])
    if len({low for low, _ in ranges}) < len(ranges):
        raise ValueError("a lower bound stands twice in the histogram")
    groups: list[list] = []  # [first range, one past the last, rows]
    for i, (_, n) in enumerate(ranges):
        if groups and n <= share and groups[-1][2] + n <= share:
            groups[-1][1:] = [i + 1, groups[-1][2] + n]
        else:
            groups.append([i, i + 1, n])
    out = []

    def add(where: str, rows: int) -> None:
        pieces = -(-rows // share)
        if within is None or pieces < 2:
            out.append(where)
            return
        for k in range(pieces):
            rest = f"ABS({within} % {pieces}) = {k}"
            out.append(f"({where}) AND ({f'{rest} OR {within} IS NULL' if k == 0 else rest})")

    for first, end, rows in groups:
        low = f"{column} >= {_literal(ranges[first][0])}" if first else None
        high = f"{column} < {_literal(ranges[end][0])}" if end < len(ranges) else None
        add(" AND ".join(x for x in (low, high) if x) or f"{column} IS NOT NULL", rows)
    if not groups:
        add(f"{column} IS NOT NULL", 0)
    add(f"{column} IS NULL", sum(n for low, n in histogram if low is None))
    return out


def load_view(spark: SparkSession, name: str, *, path: str | None = None,
              jdbc: Mapping | None = None, sf_dir: str | None = None, folded: bool = False) -> DataFrame:
    """Read one ERP view.

    * ``path``: a Parquet table (partitioned or not); ``folded`` keeps its folded key columns
      (see :func:`materialize_view`), by which ``run_check`` with ``UTF8_LCASE`` prunes the scan.
    * ``jdbc``: ``{"url", "table", "partition_column", "lower", "upper", "num_partitions",
      "properties"}``; ``table`` is the source view's name in that database. The
      read is always split, over ``num_partitions`` connections by ``partition_column``
      (in equal steps or, with a ``"histogram"`` of it and if wanted ``"split_within"``, by
      :func:`split_predicates`), or over ``"predicates"`` (one WHERE text per task); without
      either it raises, as the whole view would go through one task. Credentials go in ``properties`` and
      come from the caller, never from code.
    * ``sf_dir``: the view derived from the TPC-H-like test tables.
    """
    if sum(x is not None for x in (path, jdbc, sf_dir)) != 1:
        raise ValueError("give exactly one of path, jdbc, sf_dir")
    if sf_dir is not None:
        return testdata_view(spark, sf_dir, name)
    if path is not None:
        return canonical_columns(spark.read.parquet(path), name, folded=folded)
    opts = dict(jdbc)
    table = opts["table"]
    props = dict(opts.get("properties", {}))
    if "predicates" in opts:
        df = spark.read.jdbc(opts["url"], table, predicates=list(opts["predicates"]), properties=props)
    elif "histogram" in opts and "partition_column" in opts:
        texts = split_predicates(opts["histogram"], opts["partition_column"], opts["num_partitions"],
                                 within=opts.get("split_within"))
        df = spark.read.jdbc(opts["url"], table, predicates=texts, properties=props)
    elif "partition_column" in opts:
        df = spark.read.jdbc(opts["url"], table, column=opts["partition_column"],
                             lowerBound=opts["lower"], upperBound=opts["upper"],
                             numPartitions=opts["num_partitions"], properties=props)
    else:
        raise ValueError("a JDBC view needs partition_column, lower, upper and num_partitions, or predicates")
    return canonical_columns(df, name)


def materialize_view(df: DataFrame, path: str, *,
                     partition_by: Sequence[str] = ("cod_estabelecimento",),
                     sort_by: str | None = None,
                     mode: str = "overwrite", max_records_per_file: int = 5_000_000,
                     folded: Sequence[str] = ()) -> None:
    """Write a view as Parquet partitioned for scope pruning.

    The rows are rebalanced by the partition columns first: AQE gives a dominant
    establishment several tasks and lets small ones share a task, so a folder holds
    a few files of the advisory size instead of one per task.
    ``max_records_per_file`` bounds file size. ``sort_by`` (a date column) orders
    rows inside each task before writing, a local sort, so each file's row groups
    cover narrow date ranges and Parquet statistics skip row groups outside a
    check's date scope. ``folded`` names key columns of which a folded copy
    (``<name>__folded``) is stored as well: a case-insensitive scope is then a pushed
    filter on it, or prunes directories where ``partition_by`` names it.
    """
    df = df.withColumns({c + FOLDED: fold_key(F.col(c)) for c in folded})
    out = df.hint("rebalance", *partition_by)
    out = out.sortWithinPartitions(*partition_by, sort_by) if sort_by else out
    (out.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_by).parquet(path))


def with_collation(df: DataFrame, collation: str | None = "UTF8_LCASE",
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Give string columns a collation, so that every comparison a check makes on
    them (``=``, ``IN``, ``LIKE '%EST%'``, grouping) follows it, as the source
    database's collation would. ``UTF8_LCASE`` is case-insensitive. ``None``
    returns ``df`` unchanged (binary comparison, the default).

    Collated predicates are evaluated by Spark after the scan rather than pushed
    into Parquet: keep date scopes on plain columns, and store folded keys for the
    establishments (:func:`collated_scope`).
    """
    if not collation:
        return df
    names = set(columns) if columns is not None else None
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType) and (names is None or f.name in names):
            c = F.collate(c, collation)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def collated_scope(df: DataFrame, collation: str | None, establishments, *,
                   establishment_col: str = "cod_estabelecimento") -> DataFrame:
    """The view with its collation, pruned by the stored folded establishment where that decides the scope.

    Folded columns are dropped. The filter on them is a plain comparison that Parquet
    receives; a check's own collated comparison follows and decides.
    """
    if collation == "UTF8_LCASE" and establishments is not None and establishment_col + FOLDED in df.columns:
        codes = [establishments] if isinstance(establishments, str) else list(establishments)
        df = df.filter(F.col(establishment_col + FOLDED).isin(*[fold_key(F.lit(c)) for c in codes]))
    return with_collation(df.drop(*[c for c in df.columns if c.endswith(FOLDED)]), collation)
