"""The five silver sources derived from the driver's TPC-H-like tables.

The mapping (business date = month of ``l_shipdate``, product = part key mod
50, branch = supplier nation, money as DECIMAL rounded per row) is the one
recorded in FIXTURES.md; the oracle SQL in ``lakeledger.oracle`` states the
same rules in SQL text, so both engines start from identical rows.

Each frame is a plain DataFrame plan over the parquet files: scans are pruned
to the columns used, and the joins are left for Catalyst/AQE to plan (the
nation and supplier sides are small dimension tables whose size the planner
checks before it broadcasts them).
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.schemas import MONEY

# Carrier names (by line number mod 4) and tax codes (by part key mod 8).
CARRIERS = ["Correios", "JadLog", "Loggi", "Mandae"]
TAX_TYPES = ["ICMS", "ISS", "PIS", "COFINS", "IRPJ", "CSLL", "INSS", "IPI"]
PRODUCTS = 50


# One relation per (session, file): the driver's tables are read-only, so the
# file listing and Parquet footer are read once per session, as they would be
# for a catalog table, instead of once per use.
_RELATIONS: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = (
    weakref.WeakKeyDictionary())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = _RELATIONS.setdefault(spark, {})
    if path not in known:
        known[path] = spark.read.parquet(path)
    return known[path]


def _lines_with_branch(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", *cols)
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        li.join(sup, li.l_suppkey == sup.s_suppkey)
        .join(nat, sup.s_nationkey == nat.n_nationkey)
    )


def _month(col: str = "l_shipdate"):
    return F.trunc(F.col(col).cast(T.DateType()), "month")


def _product():
    return (F.col("l_partkey") % PRODUCTS + 1).cast(T.IntegerType())


def _units():
    return F.col("l_quantity").cast(T.IntegerType())


def _order_line_id():
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", _units().cast("string")
    )


def _dec(col: str, p: int, s: int):
    return F.col(col).cast(T.DecimalType(p, s))


def _pick(index, names: list[str]):
    """CASE index WHEN 0 THEN names[0] ... ELSE names[-1] END."""
    expr = None
    for i, name in enumerate(names[:-1]):
        expr = F.when(index == i, name) if expr is None else expr.when(index == i, name)
    return expr.otherwise(names[-1])


def vendas(spark: SparkSession, sf_dir: str, fine: bool = False) -> DataFrame:
    """Sales; with ``fine`` the unit values are discounts with four decimals instead of prices."""
    df = _lines_with_branch(spark, sf_dir, "l_shipdate", "l_partkey", "l_quantity",
                            "l_extendedprice", "l_discount")
    value = _dec("l_extendedprice", 12, 2) * _dec("l_discount", 4, 2) if fine else _dec("l_extendedprice", 18, 2)
    return df.select(
        _month().alias("data_venda"),
        _product().alias("produto_id"),
        F.col("n_name").alias("filial_id"),
        _units().alias("quantidade"),
        value.cast(MONEY).alias("valor_unitario"),
    )


def estoque(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _lines_with_branch(spark, sf_dir, "l_shipdate", "l_partkey", "l_quantity",
                            "l_linestatus")
    return df.filter(F.col("l_linestatus") == "O").select(
        _product().alias("produto_id"),
        F.col("n_name").alias("filial_id"),
        _units().alias("quantidade_disponivel"),
        _month().alias("data_referencia"),
    )


def devolucao(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _lines_with_branch(spark, sf_dir, "l_orderkey", "l_linenumber", "l_partkey",
                            "l_quantity", "l_shipdate", "l_returnflag")
    df = df.filter(F.col("l_returnflag") == "R")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    df = df.join(orders, df.l_orderkey == orders.o_orderkey)
    return df.select(
        _order_line_id().alias("pedido_id"),
        _product().alias("produto_id"),
        _units().alias("quantidade"),
        F.col("o_orderpriority").alias("motivo"),
        _month().alias("data_devolucao"),
        F.col("n_name").alias("filial_id"),
    )


def frete(spark: SparkSession, sf_dir: str, fine: bool = False) -> DataFrame:
    """Freight; with ``fine`` the fees keep their four decimals."""
    df = _lines_with_branch(spark, sf_dir, "l_orderkey", "l_linenumber", "l_partkey",
                            "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    fee = _dec("l_extendedprice", 12, 2) * _dec("l_discount", 4, 2)
    fee = fee if fine else F.round(fee, 2)
    return df.select(
        _order_line_id().alias("pedido_id"),
        fee.cast(MONEY).alias("valor_frete"),
        _month().alias("data_envio"),
        _pick(F.col("l_linenumber") % 4, CARRIERS).alias("transportadora"),
        F.col("n_name").alias("filial_id"),
    )


def tributos(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _lines_with_branch(spark, sf_dir, "l_shipdate", "l_partkey", "l_extendedprice",
                            "l_discount", "l_tax")
    paid = F.round(
        _dec("l_extendedprice", 12, 2) * (F.lit(1) - _dec("l_discount", 4, 2)) * _dec("l_tax", 4, 2), 2
    )
    return df.select(
        _month().alias("data_pagamento"),
        _pick(F.col("l_partkey") % 8, TAX_TYPES).alias("tipo_imposto"),
        paid.cast(MONEY).alias("valor_pago"),
        F.col("n_name").alias("filial_id"),
    )


BUILDERS = {
    "vendas": vendas,
    "estoque": estoque,
    "devolucao": devolucao,
    "frete": frete,
    "tributos": tributos,
}
