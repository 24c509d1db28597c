"""The product/branch summary kept by differences.

A change set is a frame of source rows with a sign (``_sinal``): -1 for a row that leaves, +1 for one that comes; a revision is
both, a move to another date too. Partial sums are linear in the rows, so the signed sums of a change set are added to the
stored ones and no unchanged row is read again. The partial sums keep, for every date, product and branch, each source's number of rows (a
summary row exists while all three have some), the number of known values of each measure (a sum over none is NULL, not 0),
and units and value apart, the value as an exact decimal: ticket and rounding come last, from exact sums, so the summary is
the same as one computed from all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.functions.dates import DateLike
from lakeledger.functions.money import WIDE_MONEY, as_money, half_up_ratio, rounded_double
from lakeledger.operators.gold import PRODUCT_KEYS
from lakeledger.operators.maintenance import SIGN, co_partitioned, conform, on_date, source_key_counts, update_matched, without_keys, SPREAD

#: Source -> (date column, {measure: column}).
MEASURES = {
    "devolucao": ("data_devolucao", {"devolvido": "quantidade"}),
    "estoque": ("data_referencia", {"estoque": "quantidade_disponivel"}),
    "vendas": ("data_venda", {"vendido": "quantidade", "valor": "valor_unitario"}),
}
ROWS = [f"linhas_{name}" for name in MEASURES]
TOTALS = {m: WIDE_MONEY if m == "valor" else T.LongType() for _, ms in MEASURES.values() for m in ms}
SUMS = ROWS + [f"n_{m}" for m in TOTALS] + list(TOTALS)


def _contribution(name: str, rows: DataFrame) -> DataFrame:
    date, measures = MEASURES[name]
    sign = F.col(SIGN) if SIGN in rows.columns else F.lit(1)
    known = {f"linhas_{name}": sign}
    for m, c in measures.items():
        # The type of a value is kept as it is (money is exact), its sign is the row's.
        value = as_money(rows, c) if m == "valor" else F.col(c)
        known |= {f"n_{m}": F.when(F.col(c).isNotNull(), sign), m: F.when(sign < 0, -value).otherwise(value)}
    kinds = {**dict.fromkeys(SUMS, T.LongType()), **TOTALS}
    return rows.select(F.col(date).alias("CodigoData"), F.col("produto_id").alias("ProdutoId"), F.col("filial_id").alias("FilialId"),
                       *[F.coalesce(known.get(c, F.lit(0)).cast(kinds[c]), F.lit(0).cast(kinds[c])).alias(c) for c in SUMS])


def partial_sums(sources: dict[str, DataFrame]) -> DataFrame:
    """Partial sums of source rows, signed or not: one aggregate over the sources together, reduced before the shuffle."""
    parts = None
    for name, rows in sources.items():
        part = _contribution(name, rows)
        parts = part if parts is None else parts.unionByName(part)
    return _added(parts)


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*PRODUCT_KEYS).agg(*[F.sum(c).cast(TOTALS.get(c, T.LongType())).alias(c) for c in SUMS])


def merge(stored: DataFrame, change: DataFrame) -> DataFrame:
    """Stored partial sums and those of a change set together. What no source has rows of any more goes; a number of rows below
    zero means that a row left that was never there, and is an error."""
    out = _added(stored.select(*PRODUCT_KEYS, *SUMS).unionByName(change.select(*PRODUCT_KEYS, *SUMS)))
    fewest = F.least(*ROWS)
    out = out.filter(F.when(fewest < 0, F.raise_error(F.lit("change set takes out rows that the sums do not hold")).cast("boolean")).otherwise(F.lit(True)))
    return out.filter(F.greatest(*ROWS) > 0)


def product_summary(parts: DataFrame) -> DataFrame:
    """The summary rows of partial sums; as after an inner join, a cell needs rows of all three sources and no NULL key."""
    whole = parts.filter(F.least(*ROWS) > 0).dropna(subset=PRODUCT_KEYS)

    def known(m):
        return F.when(F.col(f"n_{m}") > 0, F.col(m))
    sums = whole.select(*PRODUCT_KEYS, known("devolvido").alias("TotalDevolvido"), known("estoque").alias("TotalEmEstoque"),
                        known("vendido").alias("TotalQuantidadeVendida"), known("valor").alias("_valor"))
    return sums.select(*PRODUCT_KEYS, "TotalDevolvido", "TotalEmEstoque", "TotalQuantidadeVendida", rounded_double(F.col("_valor"), 2).alias("TotalValorVendido"),
                       half_up_ratio("_valor", "TotalQuantidadeVendida").alias("TicketMedio"))


def _signed(gone: DataFrame, come: DataFrame) -> DataFrame:
    return gone.withColumn(SIGN, F.lit(-1)).unionByName(come.withColumn(SIGN, F.lit(1)))


def replace_changes(target: DataFrame, day_rows: DataFrame, date_col: str, day: DateLike) -> DataFrame:
    """The change set of ``replace_date``: the date's rows out, the new rows in."""
    return _signed(on_date(target, date_col, day), conform(day_rows, target))


def upsert_changes(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The change set of ``upsert``: matched rows out, their new versions and the new keys' rows in."""
    src = conform(source, target)
    gone = (co_partitioned(target.filter(F.col(key).isNotNull()), key)
            .join(co_partitioned(source_key_counts(src, key).select(key), key), [key, SPREAD], "left_semi").select(*target.columns))
    new = without_keys(src, target.select(key).filter(F.col(key).isNotNull()).distinct(), key)
    return _signed(gone, update_matched(gone, src, key).unionByName(new))
