"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the driver's tables, with a DuckDB oracle in ``ORACLE`` where SQL can state it.

Standard arguments are those of ``lakeledger.oracle``. Every query reads the
whole tables; the only limit is the 5-row preview, which is the feature.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger import oracle as O
from lakeledger.operators import gold as G
from lakeledger.operators import maintenance as M
from lakeledger.operators import reports as R
from lakeledger.schemas import MONEY
from lakeledger.sources import testdata as TD

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _gold_product(spark, sf):
    return G.gold_product(TD.devolucao(spark, sf), TD.estoque(spark, sf), TD.vendas(spark, sf))


def _gold_freight(spark, sf):
    return G.gold_freight(spark, TD.frete(spark, sf))


def _gold_taxes(spark, sf):
    return G.gold_taxes(TD.tributos(spark, sf))


STD_FILTER = dict(branches=O.BRANCHES, date_from=O.DATE_FROM, date_to=O.DATE_TO)
_WHERE = (f"FilialId IN ({O.in_list(O.BRANCHES)}) "
          f"AND CodigoData BETWEEN DATE '{O.DATE_FROM}' AND DATE '{O.DATE_TO}'")

# --- step 1/2: gold tables and their parts ---------------------------------

register("gold_taxes", O.with_ctes("SELECT * FROM gold_taxes", "gold_taxes"))(_gold_taxes)
register("gold_freight", O.with_ctes("SELECT * FROM gold_freight", "gold_freight"))(_gold_freight)
register("gold_product", O.with_ctes("SELECT * FROM gold_product", "gold_product"))(_gold_product)


@register("agg_returns", O.with_ctes("SELECT * FROM agg_returns", "agg_returns"))
def agg_returns(spark, sf):
    return G.agg_returns(TD.devolucao(spark, sf))


@register("agg_stock", O.with_ctes("SELECT * FROM agg_stock", "agg_stock"))
def agg_stock(spark, sf):
    return G.agg_stock(TD.estoque(spark, sf))


@register("agg_sales", O.with_ctes("SELECT * FROM agg_sales", "agg_sales"))
def agg_sales(spark, sf):
    return G.agg_sales(TD.vendas(spark, sf))


# Sales counted in delivered units: open lines ('O') carry their value but no
# delivered units yet, so some cells have zero units and their ticket is NULL.
_DELIVERED = O.SILVER["vendas"].replace(
    "CAST(l_quantity AS INT) AS quantidade",
    "CASE WHEN l_linestatus = 'O' THEN 0 ELSE CAST(l_quantity AS INT) END AS quantidade",
)


@register("ticket_zero_units",
          O.with_ctes(O.agg_sales_sql("vendas_entregues"), extra={"vendas_entregues": _DELIVERED}))
def ticket_zero_units(spark, sf):
    li = TD.read_table(spark, sf, "lineitem").select("l_suppkey", "l_linestatus", "l_partkey",
                                                    "l_quantity", "l_shipdate", "l_extendedprice")
    sup = TD.read_table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nat = TD.read_table(spark, sf, "nation").select("n_nationkey", "n_name")
    rows = li.join(sup, li.l_suppkey == sup.s_suppkey).join(nat, sup.s_nationkey == nat.n_nationkey)
    delivered = rows.select(
        F.trunc(F.col("l_shipdate").cast(T.DateType()), "month").alias("data_venda"),
        (F.col("l_partkey") % 50 + 1).cast("int").alias("produto_id"),
        F.col("n_name").alias("filial_id"),
        F.when(F.col("l_linestatus") == "O", F.lit(0))
        .otherwise(F.col("l_quantity").cast("int")).alias("quantidade"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast(MONEY).alias("valor_unitario"),
    )
    return G.agg_sales(delivered)


# Freight charged to the hundredth of a cent: price times discount, not rounded per row.
_FINE = O.SILVER["frete"].replace(
    """CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
            AS DECIMAL(18,4))""", "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4))")


@register("gold_freight_subcent", O.with_ctes(
    "SELECT data_envio AS CodigoData, filial_id AS FilialId, transportadora AS Transportadora, "
    "CAST(round(sum(valor_frete), 4) AS DOUBLE) AS TotalFretePago FROM frete_fino GROUP BY 1, 2, 3",
    extra={"frete_fino": _FINE}))
def gold_freight_subcent(spark, sf):
    """The freight summary of amounts with four decimals: exact, no row rounded before the sum."""
    return G.gold_freight(spark, TD.frete(spark, sf, fine=True))


@register("ticket_subcent", O.with_ctes(O.agg_sales_sql("vendas_finas", scale=10000), extra={
    "vendas_finas": O.SILVER["vendas"].replace(
        "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,4))",
        "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4))")}))
def ticket_subcent(spark, sf):
    """The sales summary of amounts with four decimals: value and ticket rounded once, at the end."""
    fine = TD.vendas(spark, sf, fine=True)
    return G.agg_sales(fine)


@register("join_returns_stock", O.with_ctes(
    "SELECT * FROM agg_returns JOIN agg_stock USING (CodigoData, ProdutoId, FilialId)",
    "agg_returns", "agg_stock"))
def join_returns_stock(spark, sf):
    return G.join_returns_stock(G.agg_returns(TD.devolucao(spark, sf)), G.agg_stock(TD.estoque(spark, sf)))


register("gold_product_sorted", O.with_ctes(
    "SELECT * FROM gold_product ORDER BY CodigoData, ProdutoId, FilialId", "gold_product"))(
    lambda spark, sf: G.sorted_by_keys(_gold_product(spark, sf), G.PRODUCT_KEYS))
register("gold_freight_sorted", O.with_ctes(
    "SELECT * FROM gold_freight ORDER BY CodigoData, FilialId, Transportadora", "gold_freight"))(
    lambda spark, sf: G.sorted_by_keys(_gold_freight(spark, sf), G.FREIGHT_KEYS))
register("gold_taxes_sorted", O.with_ctes(
    "SELECT * FROM gold_taxes ORDER BY CodigoData, FilialId, TipoImposto", "gold_taxes"))(
    lambda spark, sf: G.sorted_by_keys(_gold_taxes(spark, sf), G.TAX_KEYS))
register("gold_product_top5", O.with_ctes(
    "SELECT * FROM gold_product ORDER BY CodigoData, ProdutoId, FilialId LIMIT 5", "gold_product"))(
    lambda spark, sf: G.preview(_gold_product(spark, sf), G.PRODUCT_KEYS, 5))

# --- step 3: filters and reports ---------------------------------------------


@register("filter_date", O.with_ctes(
    f"SELECT * FROM gold_taxes WHERE CodigoData = DATE '{O.PROCESSING_DATE}'", "gold_taxes"))
def filter_date(spark, sf):
    """The taxes increment of one processing date: the date filter is applied
    to the silver rows before the aggregate."""
    tributos = TD.tributos(spark, sf)
    return G.gold_taxes(M.on_date(tributos, "data_pagamento", O.PROCESSING_DATE))


register("filter_branches", O.with_ctes(
    "SELECT DISTINCT FilialId FROM gold_product WHERE FilialId IS NOT NULL ORDER BY 1", "gold_product"))(
    lambda spark, sf: R.distinct_values(_gold_product(spark, sf), "FilialId"))
register("filter_products", O.with_ctes(
    "SELECT DISTINCT ProdutoId FROM gold_product WHERE ProdutoId IS NOT NULL ORDER BY 1", "gold_product"))(
    lambda spark, sf: R.distinct_values(_gold_product(spark, sf), "ProdutoId"))
register("filter_dates", O.with_ctes(
    "SELECT DISTINCT CodigoData FROM gold_product WHERE CodigoData IS NOT NULL ORDER BY 1", "gold_product"))(
    lambda spark, sf: R.distinct_values(_gold_product(spark, sf), "CodigoData"))
register("date_bounds", O.with_ctes(
    "SELECT min(CodigoData) AS DataInicial, max(CodigoData) AS DataFinal FROM gold_product",
    "gold_product"))(lambda spark, sf: R.date_bounds(_gold_product(spark, sf)))
register("default_branch", O.with_ctes(
    "SELECT min(FilialId) AS FilialId FROM gold_product", "gold_product"))(
    lambda spark, sf: R.default_branch(_gold_product(spark, sf)))


def _series_sql(gold: str, measure: str, exact: bool, extra_where: str = "") -> str:
    total = (f"CAST(coalesce(sum(CAST({measure} AS DECIMAL(38,4))), 0) AS DOUBLE)" if exact
             else f"CAST(coalesce(sum({measure}), 0) AS BIGINT)")
    return O.with_ctes(
        f"SELECT CodigoData, FilialId, {total} AS {measure} FROM {gold} "
        f"WHERE {_WHERE}{extra_where} GROUP BY 1, 2 ORDER BY 1, 2", gold)


register("report_taxes", _series_sql("gold_taxes", "TotalImpostoPago", True))(
    lambda spark, sf: R.report_series(_gold_taxes(spark, sf), R.REPORTS["impostos"], **STD_FILTER))
register("report_freight", _series_sql("gold_freight", "TotalFretePago", True))(
    lambda spark, sf: R.report_series(_gold_freight(spark, sf), R.REPORTS["fretes"], **STD_FILTER))
register("report_products_all", _series_sql("gold_product", "TotalQuantidadeVendida", False))(
    lambda spark, sf: R.report_series(_gold_product(spark, sf), R.REPORTS["produtos"],
                                      product=R.ALL_PRODUCTS, **STD_FILTER))
register("report_products_one", _series_sql("gold_product", "TotalQuantidadeVendida", False,
                                            f" AND ProdutoId = {O.PRODUCT}"))(
    lambda spark, sf: R.report_series(_gold_product(spark, sf), R.REPORTS["produtos"],
                                      product=O.PRODUCT, **STD_FILTER))
register("report_detail_taxes", O.with_ctes(
    f"SELECT * FROM gold_taxes WHERE {_WHERE} ORDER BY CodigoData, FilialId, TipoImposto",
    "gold_taxes"))(
    lambda spark, sf: R.report_detail(_gold_taxes(spark, sf), G.TAX_KEYS, **STD_FILTER))
register("report_detail_freight", O.with_ctes(
    f"SELECT * FROM gold_freight WHERE {_WHERE} ORDER BY CodigoData, FilialId, Transportadora",
    "gold_freight"))(
    lambda spark, sf: R.report_detail(_gold_freight(spark, sf), G.FREIGHT_KEYS, **STD_FILTER))
register("report_detail_products", O.with_ctes(
    f"SELECT * FROM gold_product WHERE {_WHERE} ORDER BY CodigoData, ProdutoId, FilialId",
    "gold_product"))(
    lambda spark, sf: R.report_detail(_gold_product(spark, sf), G.PRODUCT_KEYS, **STD_FILTER))


@register("report_no_branch", "SELECT * FROM (" + " UNION ALL ".join(
    "SELECT * FROM (" + O.with_ctes(
        f"SELECT '{n}' AS tabela, CAST(count(*) AS BIGINT) AS linhas, "
        f"CAST(count(*) FILTER (WHERE FilialId IN ({O.in_list(O.BRANCHES)})) AS BIGINT) AS com_filial, "
        f"CAST(0 AS BIGINT) AS sem_filial FROM {n}", n) + f") q_{n}"
    for n in ("gold_freight", "gold_product", "gold_taxes")) + ") t")
def report_no_branch(spark, sf):
    """Rows of every gold table in all, with branches chosen, and with no branch chosen (none)."""
    out = None
    for name, build in (("gold_freight", _gold_freight), ("gold_product", _gold_product), ("gold_taxes", _gold_taxes)):
        gold = build(spark, sf)
        cols = ("linhas", "com_filial", "sem_filial")
        parts = (gold, R.filter_gold(gold, branches=O.BRANCHES), R.filter_gold(gold, branches=[]))
        for k, part in enumerate(parts):
            marks = part.select(F.lit(name).alias("tabela"), *[F.lit(int(i == k)).alias(c) for i, c in enumerate(cols)])
            out = marks if out is None else out.unionByName(marks)
    return out.groupBy("tabela").agg(*[F.sum(c).alias(c) for c in cols])


# --- step 4: maintenance operators on DataFrames -----------------------------

_D = f"DATE '{O.PROCESSING_DATE}'"


@register("delete_date", O.with_ctes(
    f"SELECT * FROM vendas WHERE data_venda IS DISTINCT FROM {_D}", "vendas"))
def delete_date(spark, sf):
    return M.delete_date(TD.vendas(spark, sf), "data_venda", O.PROCESSING_DATE)


@register("retain_date", O.with_ctes(
    f"SELECT * FROM gold_taxes WHERE CodigoData IS NULL OR CodigoData = {_D}", "gold_taxes"))
def retain_date(spark, sf):
    return M.retain_date(_gold_taxes(spark, sf), "CodigoData", O.PROCESSING_DATE)


@register("append_rows", O.with_ctes("SELECT * FROM vendas", "vendas"))
def append_rows(spark, sf):
    """Rows before the processing date, then the rest appended."""
    v = TD.vendas(spark, sf)
    d = F.lit(O.PROCESSING_DATE).cast("date")
    return M.append_rows(v.filter(F.col("data_venda") < d), v.filter(F.col("data_venda") >= d))


@register("append_evolve", O.with_ctes(
    f"""SELECT data_venda, produto_id, filial_id, quantidade,
       CASE WHEN data_venda >= {_D} THEN valor_unitario END AS valor_unitario,
       CASE WHEN data_venda >= {_D} THEN n_name END AS canal
FROM (SELECT {O._MONTH} AS data_venda, {O._PRODUCT} AS produto_id, n_name AS filial_id,
             CAST(l_quantity AS INT) AS quantidade,
             CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS valor_unitario, n_name
      FROM {O._BRANCH}) x"""))
def append_evolve(spark, sf):
    """An older table without the price column, then rows that bring the price
    back and a new column: missing values read as NULL."""
    v = TD.vendas(spark, sf).withColumn("canal", F.col("filial_id"))
    d = F.lit(O.PROCESSING_DATE).cast("date")
    old = v.filter(F.col("data_venda") < d).drop("valor_unitario", "canal")
    new = v.filter(F.col("data_venda") >= d)
    return M.append_rows(old, new, evolve=True)


@register("replace_date", O.with_ctes(
    f"SELECT data_venda, produto_id, filial_id, CASE WHEN data_venda = {_D} THEN quantidade + 1 ELSE quantidade END AS quantidade, "
    f"valor_unitario FROM vendas WHERE data_venda IS DISTINCT FROM {_D} OR produto_id % 2 = 0", "vendas"))
def replace_date(spark, sf):
    """The whole table, then the day extracted anew, with fewer rows and other quantities: none of the
    day's old rows may stay."""
    v = TD.vendas(spark, sf)
    day = v.filter((F.col("data_venda") == F.lit(O.PROCESSING_DATE).cast("date")) & (F.col("produto_id") % 2 == 0))
    day = day.withColumn("quantidade", F.col("quantidade") + 1)
    return M.replace_date(v, day, "data_venda", O.PROCESSING_DATE)


@register("upsert", O.with_ctes(
    f"""SELECT pedido_id, produto_id, quantidade,
       CASE WHEN data_devolucao = {_D} THEN motivo || ' (revisado)' ELSE motivo END AS motivo,
       data_devolucao, filial_id
FROM devolucao""", "devolucao"))
def upsert(spark, sf):
    """Target: returns up to the processing date. Source: returns from that date
    on, the processing date's rows revised. Matched keys are updated, the later
    dates inserted."""
    r = TD.devolucao(spark, sf)
    d = F.lit(O.PROCESSING_DATE).cast("date")
    target = r.filter(F.col("data_devolucao") <= d)
    source = r.filter(F.col("data_devolucao") >= d).withColumn(
        "motivo",
        F.when(F.col("data_devolucao") == d, F.concat(F.col("motivo"), F.lit(" (revisado)")))
        .otherwise(F.col("motivo")),
    )
    return M.upsert(target, source, "pedido_id")

# --- step 5/6: stored tables, CSV ingest, refresh and back-fill ---------------
# These queries write a lake under the shared checkpoint folder (a fresh
# sub-folder per call), run the jobs on it and return a scan of the result.

from lakeledger.functions.dates import as_date  # noqa: E402
from lakeledger.plans import gold as gold_jobs  # noqa: E402
from lakeledger.plans import ingest as ingest_jobs  # noqa: E402
from lakeledger.schemas import GOLDS, SOURCES, Lake  # noqa: E402
from lakeledger.session import scratch_dir, shuffles_end  # noqa: E402
from lakeledger.sources import tables  # noqa: E402
from lakeledger.sources.bronze import daily_path, export_daily, scan_csv  # noqa: E402


#: Lakes that queries of this process have made; ``drop_lakes`` removes them.
LAKES: list[str] = []


def new_lake(spark: SparkSession, label: str) -> Lake:
    LAKES.append(scratch_dir(spark, label))
    return Lake(LAKES[-1])


def drop_lakes(spark: SparkSession) -> None:
    """Remove the lakes made so far (once their results have been read)."""
    while LAKES:
        path = LAKES.pop()
        tables._FS(spark, path).delete(path)


def as_first_sent(df: DataFrame, spec, day) -> DataFrame:
    """The rows of a source as a first extract might have had them: on ``day`` the append sources send
    every row twice; of the returns a third still has another reason, a third lies a month earlier, and a
    third is missing."""
    c = F.col(spec.date_column)
    today = c == F.lit(as_date(day))
    if spec.append_only:
        return df.unionByName(df.filter(today))
    kind = F.when(today, F.pmod(F.xxhash64(spec.key_column), F.lit(3))).otherwise(F.lit(-1))
    return (df.withColumn("_kind", kind).filter("_kind <> 2")
            .withColumn("motivo", F.when(F.col("_kind") == 0, F.lit("antigo")).otherwise(F.col("motivo")))
            .withColumn(spec.date_column, F.when(F.col("_kind") == 1, F.add_months(c, -1)).otherwise(c)).drop("_kind"))


def middle_day(df: DataFrame, spec):
    """The middle one of a source's dates (dates only reach the driver)."""
    with shuffles_end(df.sparkSession):
        days = sorted(r[0] for r in df.select(spec.date_column).distinct().collect())
    return days[len(days) // 2]


@register("write_create", O.with_ctes("SELECT * FROM vendas", "vendas"))
def write_create(spark, sf):
    """First load of a silver table, read back."""
    lake = new_lake(spark, "write_create")
    spec = SOURCES["vendas"]
    tables.create_table(spark, lake.silver(spec), TD.vendas(spark, sf), spec.date_column)
    return tables.scan_table(spark, lake.silver(spec))


@register("scan_table", O.with_ctes(
    f"SELECT * FROM tributos WHERE data_pagamento BETWEEN DATE '{O.DATE_FROM}' AND DATE '{O.DATE_TO}'",
    "tributos"))
def scan_table(spark, sf):
    """A stored table scanned with a date range: only those partitions are read."""
    lake = new_lake(spark, "scan_table")
    spec = SOURCES["tributos"]
    tables.create_table(spark, lake.silver(spec), TD.tributos(spark, sf), spec.date_column)
    return tables.scan_table(spark, lake.silver(spec), O.DATE_FROM, O.DATE_TO)


def _ingest_query(source: str):
    def run(spark, sf):
        """Every date of the source exported as a daily CSV file and loaded, one date as first sent:
        the first day creates the table, the rest go in as one range. Then that date's corrected file
        arrives and is loaded, twice (a re-run changes nothing)."""
        lake = new_lake(spark, f"ingest_{source}")
        spec = SOURCES[source]
        df = TD.BUILDERS[source](spark, sf)
        day = middle_day(df, spec)
        days = export_daily(spark, as_first_sent(df, spec, day), lake, spec)
        ingest_jobs.ingest(spark, lake, spec, days[0])
        ingest_jobs.ingest_range(spark, lake, spec, days[1:])
        export_daily(spark, df.filter(F.col(spec.date_column) == F.lit(day)), lake, spec)
        ingest_jobs.ingest(spark, lake, spec, day)
        ingest_jobs.ingest(spark, lake, spec, day)
        return tables.scan_table(spark, lake.silver(spec))
    return run


for _src in SOURCES:
    register(f"ingest_{_src}", O.with_ctes(f"SELECT * FROM {_src}", _src))(_ingest_query(_src))


def _silver_lake(spark, sf, label: str, names, before=None) -> Lake:
    """A lake whose silver tables ``names`` hold the fixture rows (dates < ``before``)."""
    lake = new_lake(spark, label)

    def create(name: str) -> None:
        spec = SOURCES[name]
        df = TD.BUILDERS[name](spark, sf)
        if before is not None:
            df = df.filter(F.col(spec.date_column) < F.lit(as_date(before)))
        tables.create_table(spark, lake.silver(spec), df, spec.date_column)

    # Independent tables: their jobs are submitted together and share the cluster.
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        list(pool.map(create, names))
    return lake


def _refresh_query(gold: str):
    def run(spark, sf):
        """Gold built from the silver history before the processing date; then the date's silver rows
        arrive as first sent and the gold date is refreshed; then they are corrected and it is refreshed again."""
        day = as_date(O.PROCESSING_DATE)
        lake = _silver_lake(spark, sf, f"refresh_{gold}", GOLDS[gold].inputs, before=day)
        gold_jobs.refresh(spark, lake, gold, day)  # first load: whole history
        for corrected in (False, True):
            for name in GOLDS[gold].inputs:
                spec = SOURCES[name]
                rows = TD.BUILDERS[name](spark, sf)
                rows = rows if corrected else rows.unionByName(rows)
                tables.replace_dates(spark, lake.silver(spec), rows, [day])
            gold_jobs.refresh(spark, lake, gold, day)
        return tables.scan_table(spark, lake.gold(gold))
    return run


for _name, _gold in (("refresh_incremental", "produtos"), ("refresh_freight", "fretes"), ("refresh_taxes", "impostos")):
    _table = {"produtos": "gold_product", "fretes": "gold_freight", "impostos": "gold_taxes"}[_gold]
    register(_name, O.with_ctes(f"SELECT * FROM {_table} WHERE CodigoData <= {_D}", _table))(_refresh_query(_gold))


@register("backfill_range", O.with_ctes("SELECT * FROM gold_product", "gold_product"))
def backfill_range(spark, sf):
    """Gold built (from the whole history, which begins before the range) while the sales of the range are still
    as first sent; then they are corrected and the whole range is recomputed in one job."""
    lo, hi = as_date(O.DATE_FROM), as_date(O.DATE_TO)
    lake = _silver_lake(spark, sf, "backfill", ("devolucao", "estoque"))
    spec = SOURCES["vendas"]
    rows = TD.vendas(spark, sf)
    inside = F.col("data_venda").between(F.lit(lo), F.lit(hi))
    tables.create_table(spark, lake.silver(spec), rows.withColumn(
        "quantidade", F.when(inside, F.lit(0)).otherwise(F.col("quantidade"))), spec.date_column)
    gold_jobs.backfill(spark, lake, "produtos", lo, lo + (hi - lo) / 2)  # creates
    days = [d for d in tables.list_partitions(spark, lake.silver(spec), "data_venda") if d and lo <= d <= hi]
    tables.replace_dates(spark, lake.silver(spec), rows, days)
    gold_jobs.backfill(spark, lake, "produtos", lo, hi)
    return tables.scan_table(spark, lake.gold("produtos"))


@register("pipeline_day", "SELECT * FROM (" + " UNION ALL ".join(
    "SELECT * FROM (" + O.with_ctes(
        f"SELECT '{t}' AS tabela, CodigoData, FilialId, CAST(count(*) AS BIGINT) AS linhas, "
        f"CAST(sum(CAST({m} AS DECIMAL(38,4))) AS DOUBLE) AS total FROM {g} WHERE CodigoData <= {_D} GROUP BY 2, 3", g) + f") q_{t}"
    for t, g, m in (("produtos", "gold_product", "TotalValorVendido"), ("fretes", "gold_freight", "TotalFretePago"),
                    ("impostos", "gold_taxes", "TotalImpostoPago"))) + ") t")
def pipeline_day(spark, sf):
    """A whole day, bronze to gold, for all sources and gold tables: silver holds the history before the processing
    date, the day's files arrive as first sent and run, then corrected, and run again. Returns rows and total per
    gold table, date and branch."""
    from lakeledger.plans.pipeline import run_day

    day = as_date(O.PROCESSING_DATE)
    lake = _silver_lake(spark, sf, "pipeline_day", tuple(SOURCES), before=day)
    for corrected in (False, True):
        for name, spec in SOURCES.items():
            rows = TD.BUILDERS[name](spark, sf).filter(F.col(spec.date_column) == F.lit(day))
            if not corrected and not spec.append_only:
                rows = rows.withColumn("quantidade", F.col("quantidade") + 1)
            elif not corrected:
                rows = rows.unionByName(rows)
            export_daily(spark, rows, lake, spec)
        run_day(spark, lake, day)
    out = None
    for gold, measure in (("produtos", "TotalValorVendido"), ("fretes", "TotalFretePago"), ("impostos", "TotalImpostoPago")):
        part = tables.scan_table(spark, lake.gold(gold)).groupBy(F.lit(gold).alias("tabela"), "CodigoData", "FilialId").agg(
            F.count("*").alias("linhas"), F.sum(F.col(measure).cast("decimal(38,4)")).cast("double").alias("total"))
        out = part if out is None else out.unionByName(part)
    return out


def _stored_report(choice: str, **filters):
    def run(spark, sf):
        """A report asked of the lake: the choice picks the stored gold table, and only the range's folders are read."""
        from lakeledger.plans.reports import answer_report

        lake = _silver_lake(spark, sf, f"report_{choice}", GOLDS[choice].inputs)
        gold_jobs.build(spark, lake, choice)
        return answer_report(spark, lake, choice, **filters)
    return run


register("report_stored_freight", ORACLE["report_freight"])(_stored_report("fretes", **STD_FILTER))
register("report_stored_product", ORACLE["report_products_one"])(_stored_report("produtos", product=O.PRODUCT, **STD_FILTER))


@register("scan_csv", O.with_ctes(
    "SELECT data_devolucao, filial_id, CAST(count(*) AS BIGINT) AS linhas, CAST(sum(quantidade) AS BIGINT) AS quantidade, "
    "CAST(sum(produto_id) AS BIGINT) AS produtos FROM devolucao GROUP BY 1, 2", "devolucao"))
def scan_csv_query(spark, sf):
    """Daily files whose part files order their columns differently, with empty part files among them: every
    part is bound by its own header."""
    lake = new_lake(spark, "scan_csv")
    spec = SOURCES["devolucao"]
    df = TD.devolucao(spark, sf)
    path = daily_path(lake, spec, O.PROCESSING_DATE)
    odd = F.pmod(F.xxhash64("pedido_id"), F.lit(2)) == 1
    df.filter(odd).write.option("header", True).csv(path)
    df.filter(~odd).select(*reversed(df.columns)).write.mode("append").option("header", True).csv(path)
    fs = tables._FS(spark, path)
    fs.fs.create(fs.p(f"{path}/part-00000-empty.csv"), True).close()
    return scan_csv(spark, path, spec).groupBy("data_devolucao", "filial_id").agg(
        F.count("*").alias("linhas"), F.sum("quantidade").alias("quantidade"), F.sum("produto_id").alias("produtos"))


@register("upsert_stored", O.with_ctes(
    f"""SELECT pedido_id, produto_id, CASE WHEN produto_id % 5 = 0 THEN quantidade + 1 ELSE quantidade END AS quantidade, motivo,
       CASE WHEN produto_id % 5 = 0 AND produto_id % 2 = 0 THEN CAST(data_devolucao + INTERVAL 1 MONTH AS DATE) ELSE data_devolucao END AS data_devolucao,
       filial_id FROM devolucao""", "devolucao"))
def upsert_stored(spark, sf):
    """A stored table upserted with revised rows, rows that move to another date, and new keys."""
    lake = new_lake(spark, "upsert_stored")
    spec = SOURCES["devolucao"]
    df = TD.devolucao(spark, sf)
    five = F.col("produto_id") % 5 == 0
    new_key = F.col("produto_id") % 7 == 3
    tables.create_table(spark, lake.silver(spec), df.filter(~new_key), spec.date_column)
    revised = df.withColumn("quantidade", F.when(five, F.col("quantidade") + 1).otherwise(F.col("quantidade"))).withColumn(
        "data_devolucao", F.when(five & (F.col("produto_id") % 2 == 0), F.add_months("data_devolucao", 1)).otherwise(F.col("data_devolucao")))
    tables.upsert_table(spark, lake.silver(spec), revised.filter(five | new_key), spec.key_column)
    return tables.scan_table(spark, lake.silver(spec))


def _stream_query(source: str):
    def run(spark, sf):
        """Daily files exported to the bronze folder, one date as first sent, and loaded by the
        file-watching stream; then that date's corrected file lands and a second run picks it up."""
        from lakeledger.streaming.bronze_watch import catch_up

        lake = new_lake(spark, f"stream_{source}")
        spec = SOURCES[source]
        df = TD.BUILDERS[source](spark, sf)
        day = middle_day(df, spec)
        export_daily(spark, as_first_sent(df, spec, day), lake, spec)
        catch_up(spark, lake, spec, checkpoint=f"{lake.root}/_streams/{source}")
        export_daily(spark, df.filter(F.col(spec.date_column) == F.lit(day)), lake, spec)
        catch_up(spark, lake, spec, checkpoint=f"{lake.root}/_streams/{source}")
        return tables.scan_table(spark, lake.silver(spec))
    return run


for _src in ("frete", "devolucao"):
    register(f"stream_ingest_{_src}", O.with_ctes(f"SELECT * FROM {_src}", _src))(_stream_query(_src))


# --- keyed upserts by bucket, gold that follows silver --------------------------------


@register("upsert_bucketed", ORACLE["upsert_stored"])
def upsert_bucketed(spark, sf):
    """The upsert of ``upsert_stored`` into a table with buckets of the key below its dates."""
    lake = new_lake(spark, "upsert_bucketed")
    spec = SOURCES["devolucao"]
    df = TD.devolucao(spark, sf)
    five = F.col("produto_id") % 5 == 0
    new_key = F.col("produto_id") % 7 == 3
    tables.create_table(spark, lake.silver(spec), df.filter(~new_key), spec.date_column, buckets=(spec.key_column, 4))
    revised = df.withColumn("quantidade", F.when(five, F.col("quantidade") + 1).otherwise(F.col("quantidade"))).withColumn(
        "data_devolucao", F.when(five & (F.col("produto_id") % 2 == 0), F.add_months("data_devolucao", 1)).otherwise(F.col("data_devolucao")))
    tables.upsert_table(spark, lake.silver(spec), revised.filter(five | new_key), spec.key_column)
    return tables.scan_table(spark, lake.silver(spec))


def _gold_totals(spark, lake):
    """Rows and total of each stored gold table, date and branch."""
    out = None
    for gold, measure in (("produtos", "TotalValorVendido"), ("fretes", "TotalFretePago"), ("impostos", "TotalImpostoPago")):
        part = tables.scan_table(spark, lake.gold(gold)).groupBy(F.lit(gold).alias("tabela"), "CodigoData", "FilialId").agg(
            F.count("*").alias("linhas"), F.sum(F.col(measure).cast("decimal(38,4)")).cast("double").alias("total"))
        out = part if out is None else out.unionByName(part)
    return out


@register("stream_to_gold", ORACLE["pipeline_day"].replace(f"WHERE CodigoData <= {_D} ", ""))
def stream_to_gold(spark, sf):
    """Daily files of all sources, one date as first sent (returns of it lie a month earlier, or are missing), taken from bronze to
    gold by one stream; then the date's corrected files land, and a second run refreshes the gold dates that they change: that date, and
    the month that the moved returns leave."""
    from lakeledger.streaming.bronze_watch import LOADS_AT_ONCE, catch_up_lake

    lake = new_lake(spark, "stream_to_gold")
    frames = {n: build(spark, sf) for n, build in TD.BUILDERS.items()}
    day = middle_day(frames["devolucao"], SOURCES["devolucao"])

    def export(corrected: bool) -> None:
        def one(name: str) -> None:
            spec = SOURCES[name]
            rows = frames[name].filter(F.col(spec.date_column) == F.lit(day)) if corrected else as_first_sent(frames[name], spec, day)
            export_daily(spark, rows, lake, spec)
        with ThreadPoolExecutor(max_workers=len(SOURCES) if corrected else LOADS_AT_ONCE) as pool:
            list(pool.map(one, SOURCES))
    for corrected in (False, True):
        export(corrected)
        catch_up_lake(spark, lake, checkpoint=f"{lake.root}/_streams/lake")
    return _gold_totals(spark, lake)


@register("gold_product_delta", ORACLE["gold_product"])
def gold_product_delta(spark, sf):
    """The product summary kept by differences: built while one date's rows are as first sent, then brought up to date from the change
    sets of an upsert (revisions, moves, new rows) and of two replaced dates, applied twice (the second is skipped)."""
    from lakeledger.operators import deltas
    from lakeledger.plans import delta as delta_jobs

    lake = new_lake(spark, "gold_product_delta")
    frames = {n: TD.BUILDERS[n](spark, sf) for n in GOLDS["produtos"].inputs}
    day = middle_day(frames["devolucao"], SOURCES["devolucao"])
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        list(pool.map(lambda n: tables.create_table(spark, lake.silver(n), as_first_sent(frames[n], SOURCES[n], day), SOURCES[n].date_column), frames))
    silver = {n: tables.scan_table(spark, lake.silver(n)) for n in frames}
    delta_jobs.build(spark, lake, silver)
    changes = {}
    for name, df in frames.items():
        spec, path = SOURCES[name], f"{lake.root}/_changes/{name}"
        rows = df.filter(F.col(spec.date_column) == F.lit(day))
        if spec.append_only:
            deltas.replace_changes(silver[name], rows, spec.date_column, day).write.parquet(path)
            tables.replace_dates(spark, lake.silver(spec), rows, [day])
        else:
            tables.upsert_table(spark, lake.silver(spec), rows, spec.key_column, changes=path)
        changes[name] = spark.read.parquet(path)
    for _ in range(2):
        delta_jobs.apply_changes(spark, lake, changes, batch=("changes", 0))
    return tables.scan_table(spark, lake.gold("produtos"))


# --- types of undeclared columns -------------------------------------------------------

_EXTRA = """CASE WHEN produto_id % 2 = 0 THEN quantidade * 0.5 ELSE quantidade END"""


@register("scan_csv_inferred", O.with_ctes(
    f"SELECT filial_id, CAST(sum(CAST({_EXTRA} AS DOUBLE)) AS DOUBLE) AS peso, CAST(max(CAST(produto_id AS BIGINT) * 1000000000) AS BIGINT) AS lote, "
    "CAST(count(*) FILTER (WHERE quantidade > 25) AS BIGINT) AS abertos, min(data_devolucao) AS prazo, CAST(sum(quantidade) AS BIGINT) AS caixas FROM devolucao GROUP BY 1", "devolucao"))
def scan_csv_inferred(spark, sf):
    """A daily file with columns that the contract does not declare, whose parts write them differently (whole and broken numbers): each
    gets the narrowest type that takes all its texts, and is summed or compared in that type."""
    lake = new_lake(spark, "scan_csv_inferred")
    spec = SOURCES["devolucao"]
    df = TD.devolucao(spark, sf).select(
        "*", (F.col("produto_id").cast("bigint") * 1000000000).alias("lote"), (F.col("quantidade") > 25).alias("aberto"),
        F.col("data_devolucao").alias("prazo"), F.col("quantidade").alias("caixas"))
    path = daily_path(lake, spec, O.PROCESSING_DATE)
    even = F.col("produto_id") % 2 == 0
    df.filter(even).withColumn("peso", F.col("quantidade") * 0.5).write.option("header", True).csv(path)
    df.filter(~even).withColumn("peso", F.col("quantidade")).write.mode("append").option("header", True).csv(path)
    rows = scan_csv(spark, path, spec, infer=True)
    assert [rows.schema[c].dataType.simpleString() for c in ("peso", "lote", "aberto", "prazo", "caixas")] == ["double", "bigint", "boolean", "date", "int"]
    return rows.groupBy("filial_id").agg(F.sum("peso").alias("peso"), F.max("lote").alias("lote"), F.count(F.when(F.col("aberto"), 1)).alias("abertos"),
                                         F.min("prazo").alias("prazo"), F.sum("caixas").alias("caixas"))


@register("ingest_widened", O.with_ctes(
    f"SELECT data_venda, CAST(count(*) AS BIGINT) AS linhas, CAST(sum(CASE WHEN data_venda < {_D} THEN quantidade ELSE quantidade * 0.5 END) AS DOUBLE) AS peso "
    "FROM vendas GROUP BY 1", "vendas"))
def ingest_widened(spark, sf):
    """Sales whose files bring an undeclared column: whole numbers on the days before the processing date, broken ones after it. The
    stored column widens, and older files are read in the wider type."""
    lake = new_lake(spark, "ingest_widened")
    spec = SOURCES["vendas"]
    d = F.lit(O.PROCESSING_DATE).cast("date")
    rows = TD.vendas(spark, sf)
    late = F.col("data_venda") >= d
    whole, broken = rows.filter(~late).withColumn("peso", F.col("quantidade")), rows.filter(late).withColumn("peso", F.col("quantidade") * 0.5)
    for day, part in (("1998-02-28", whole), ("1998-03-02", broken)):
        part.write.option("header", True).csv(daily_path(lake, spec, day))
        ingest_jobs.ingest(spark, lake, spec, day, infer=True)
    out = tables.scan_table(spark, lake.silver(spec))
    assert out.schema["peso"].dataType == T.DoubleType()
    return out.groupBy("data_venda").agg(F.count("*").alias("linhas"), F.sum("peso").alias("peso"))


# --- reports on the lake ----------------------------------------------------------------


def _gold_lake(spark, sf, label: str, golds=("produtos",)) -> Lake:
    """A lake with stored gold tables."""
    lake = _silver_lake(spark, sf, label, sorted({s for g in golds for s in GOLDS[g].inputs}))
    for gold in golds:
        gold_jobs.build(spark, lake, gold)
    return lake


@register("stored_date_bounds", ORACLE["date_bounds"])
def stored_date_bounds(spark, sf):
    """First and last date of the stored summary, from its folders."""
    from lakeledger.plans import reports as report_jobs

    return report_jobs.stored_date_bounds(spark, _gold_lake(spark, sf, "bounds"), "produtos")


@register("stored_choices", "SELECT * FROM (" + " UNION ALL ".join(
    "SELECT * FROM (" + O.with_ctes(f"SELECT DISTINCT '{c}' AS campo, CAST({c} AS VARCHAR) AS valor FROM gold_product WHERE {c} IS NOT NULL", "gold_product") + f") q_{c}"
    for c in ("CodigoData", "ProdutoId", "FilialId")) + ") t")
def stored_choices(spark, sf):
    """The choice lists of a report on the stored summary: dates from its folders, products and branches from their columns."""
    from lakeledger.plans import reports as report_jobs

    lake, out = _gold_lake(spark, sf, "choices"), None
    for c in ("CodigoData", "ProdutoId", "FilialId"):
        part = report_jobs.stored_choices(spark, lake, "produtos", c).select(F.lit(c).alias("campo"), F.col(c).cast("string").alias("valor"))
        out = part if out is None else out.unionByName(part)
    return out


@register("stored_has_rows", "SELECT * FROM (" + " UNION ALL ".join(
    "SELECT * FROM (" + O.with_ctes(f"SELECT '{t}' AS tabela, CAST(count(*) AS BIGINT) AS linhas, count(*) > 0 AS tem_linhas FROM {g}", g) + f") q_{t}"
    for t, g in (("produtos", "gold_product"), ("fretes", "gold_freight"), ("impostos", "gold_taxes"))) + ") t")
def stored_has_rows(spark, sf):
    """Whether each stored gold table has rows, and how many, from Parquet footers."""
    from lakeledger.plans import reports as report_jobs

    return report_jobs.stored_rows(spark, _gold_lake(spark, sf, "has_rows", tuple(GOLDS)), ("produtos", "fretes", "impostos"))


_CHOSEN = ("SELECT CodigoData, FilialId, CAST(coalesce(sum(CAST(TotalFretePago AS DECIMAL(38,4))), 0) AS DOUBLE) AS TotalFretePago FROM gold_freight "
           "WHERE FilialId IN (SELECT n_name FROM nation WHERE n_regionkey = 1) AND CodigoData IN "
           "(SELECT CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= DATE '1995-06-01' AND o_orderdate < DATE '1996-01-01') GROUP BY 1, 2")


@register("report_chosen", O.with_ctes(_CHOSEN, "gold_freight"))
def report_chosen(spark, sf):
    """A report whose choices are tables: the branches of a region, the months that had urgent orders in half a year."""
    lake = _gold_lake(spark, sf, "report_chosen", ("fretes",))
    branches = TD.read_table(spark, sf, "nation").filter("n_regionkey = 1").select(F.col("n_name").alias("FilialId"))
    orders = TD.read_table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderdate >= DATE'1995-06-01' AND o_orderdate < DATE'1996-01-01'")
    dates = orders.select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("CodigoData"))
    return R.chosen_series(tables.scan_table(spark, lake.gold("fretes")), R.REPORTS["fretes"], branches, dates)


@register("report_cached", ORACLE["report_freight"])
def report_cached(spark, sf):
    """Questions of one report session: two on the freight summary while a date is as first sent, the second from memory; then the
    date is corrected and refreshed, and the next question sees it."""
    from lakeledger.plans.reports import ReportSession

    lake = new_lake(spark, "report_cached")
    spec, day = SOURCES["frete"], as_date(O.PROCESSING_DATE)
    rows = TD.frete(spark, sf)
    tables.create_table(spark, lake.silver(spec), as_first_sent(rows, spec, day), spec.date_column)
    gold_jobs.build(spark, lake, "fretes")
    session = ReportSession(spark, lake)
    for _ in range(2):
        R.collect_series(session.ask("fretes", **STD_FILTER), max_rows=100_000)
    tables.replace_dates(spark, lake.silver(spec), rows, [day])
    gold_jobs.refresh(spark, lake, "fretes", day)
    return session.ask("fretes", **STD_FILTER)


@register("report_collected", ORACLE["report_taxes"])
def report_collected(spark, sf):
    """A report brought to the driver for a chart (bounded by dates times chosen branches), and back as a frame."""
    series = R.report_series(_gold_taxes(spark, sf), R.REPORTS["impostos"], **STD_FILTER)
    return spark.createDataFrame(R.collect_series(series, max_rows=100_000), series.schema)


@register("report_batch", "SELECT * FROM (" + ORACLE["report_products_all"] + ") a UNION ALL SELECT * FROM (" + ORACLE["report_products_one"] + ") b")
def report_batch(spark, sf):
    """Two questions on one summary, which is computed once for both; their answers are stored before it is let go."""
    out = f"{new_lake(spark, 'report_batch').root}/answers"
    with R.report_batch(_gold_product(spark, sf)) as gold:
        every, one = (R.report_series(gold, R.REPORTS["produtos"], product=p, **STD_FILTER) for p in (R.ALL_PRODUCTS, O.PRODUCT))
        every.unionByName(one).write.parquet(out)
    return spark.read.parquet(out)


@register("report_detail_pages", ORACLE["report_detail_products"])
def report_detail_pages(spark, sf):
    """The detail rows of the stored summary page by page, a page beginning behind the last key of the one before."""
    lake = _gold_lake(spark, sf, "report_pages")
    out = None
    for page in R.detail_pages(tables.scan_table(spark, lake.gold("produtos")), G.PRODUCT_KEYS, 200, **STD_FILTER):
        out = page if out is None else out.unionByName(page)
    return out


@register("gold_product_bucketed", ORACLE["gold_product"])
def gold_product_bucketed(spark, sf):
    """The product summary from copies that are bucketed and sorted on its keys: no exchange but that of the writes."""
    from lakeledger.sources import bucketed

    folder = f"{new_lake(spark, 'bucketed').root}/copies"
    for source in ("devolucao", "estoque", "vendas"):
        bucketed.write_bucketed(spark, folder, source, TD.BUILDERS[source](spark, sf))
    return bucketed.product_summary(spark, folder)
