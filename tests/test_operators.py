"""DataFrame operators: maintenance edges, money rounding, reports, order."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixture_paths import SF_SMALL
from lakeledger.operators import gold as G
from lakeledger.operators import maintenance as M
from lakeledger.operators import reports as R
from lakeledger import oracle as O
from lakeledger.registry import QUERIES

D1, D2 = dt.date(2025, 9, 19), dt.date(2025, 9, 20)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def kv(spark):
    schema = "k string, v int, d date"
    return lambda data: spark.createDataFrame(data, schema)


def test_delete_date_keeps_null_dates(kv):
    df = kv([("a", 1, D1), ("b", 2, D2), ("n", 0, None)])
    assert rows(M.delete_date(df, "d", D1)) == [("b", 2, D2), ("n", 0, None)]


def test_retain_date_keeps_null_dates(kv):
    df = kv([("a", 1, D1), ("b", 2, D2), ("n", 0, None)])
    assert rows(M.retain_date(df, "d", "2025-09-19")) == [("a", 1, D1), ("n", 0, None)]


def test_bad_date_fails_on_the_driver(kv):
    with pytest.raises(ValueError):
        M.on_date(kv([]), "d", "2025-13-45")


def test_replace_date_twice_equals_once(kv):
    t = kv([("a", 1, D1), ("b", 2, D2)])
    day = kv([("c", 3, D2)])
    once = M.replace_date(t, day, "d", D2)
    assert rows(M.replace_date(once, day, "d", D2)) == rows(once) == [("a", 1, D1), ("c", 3, D2)]


def test_upsert_frame_semantics(kv):
    t = kv([("a", 1, D1), ("b", 2, D1), (None, 5, D1)])
    s = kv([("b", 20, D2), ("z", 9, D2), ("z", 10, D2), (None, 6, D2)])
    out = rows(M.upsert(t, s, "k"))
    assert out == rows(kv([("a", 1, D1), ("b", 20, D2), ("z", 9, D2), ("z", 10, D2),
                           (None, 5, D1), (None, 6, D2)]))
    assert rows(M.upsert(M.upsert(t, s, "k"), kv([("b", 20, D2)]), "k")) == out


def test_upsert_frame_repeated_matched_key_fails(kv):
    t = kv([("a", 1, D1)])
    with pytest.raises(Exception, match="matched more than once"):
        M.upsert(t, kv([("a", 2, D1), ("a", 3, D1)]), "k").collect()


def test_upsert_frame_updates_every_matched_target_row(kv):
    t = kv([("n", 2, D1), ("n", 3, D1), ("a", 1, D1)])
    out = rows(M.upsert(t, kv([("n", 7, D2)]), "k"))
    assert out == rows(kv([("a", 1, D1), ("n", 7, D2), ("n", 7, D2)]))


def test_upsert_frame_with_hot_keys(kv):
    """A third of the target shares one (NULL) key and a third of the source
    one new key: every row is kept, updated or inserted as for any key."""
    t = kv([(None, i, D1) for i in range(50)] + [(f"t{i}", i, D1) for i in range(100)])
    s = kv([("hot", i, D2) for i in range(50)] + [(f"t{i}", -i, D2) for i in range(0, 100, 2)])
    expected = ([(None, i, D1) for i in range(50)]
                + [(f"t{i}", i, D1) if i % 2 else (f"t{i}", -i, D2) for i in range(100)]
                + [("hot", i, D2) for i in range(50)])
    assert rows(M.upsert(t, s, "k")) == rows(kv(expected))


def test_ticket_half_up_and_zero_units(spark):
    df = spark.createDataFrame(
        [(D1, 1, "X", 2, Decimal("2.01")),      # 1.005 -> 1.01 (tie goes up)
         (D1, 2, "X", 3, Decimal("1.00")),      # 0.3333 -> 0.33
         (D1, 3, "X", 3, Decimal("2.00")),      # 0.6667 -> 0.67
         (D1, 4, "X", 0, Decimal("5.00"))],     # zero units -> NULL, no error
        "data_venda date, produto_id int, filial_id string, quantidade int, "
        "valor_unitario decimal(18,2)")
    got = {r["ProdutoId"]: r["TicketMedio"] for r in G.agg_sales(df).collect()}
    assert got == {1: 1.01, 2: 0.33, 3: 0.67, 4: None}


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame(
        [(D1, "T", Decimal("0.10"), "X")] * 3 + [(D1, "T", Decimal("0.20"), "X")],
        "data_pagamento date, tipo_imposto string, valor_pago decimal(18,2), filial_id string")
    assert G.gold_taxes(df).collect()[0]["TotalImpostoPago"] == 0.5


def test_report_all_null_group_sums_to_zero(spark):
    df = spark.createDataFrame(
        [(D1, "A", None)], "CodigoData date, FilialId string, TotalImpostoPago double")
    out = R.report_series(df, R.REPORTS["impostos"], branches=["A"])
    assert out.collect()[0]["TotalImpostoPago"] == 0.0


def test_report_no_branch_is_empty(spark):
    got = QUERIES["report_no_branch"](spark, SF_SMALL).collect()
    assert all(r["sem_filial"] == 0 and 0 < r["com_filial"] < r["linhas"] for r in got)


def test_amounts_below_a_cent_are_not_rounded_before_the_sum(spark):
    tax = spark.createDataFrame([(D1, "T", Decimal("0.004"), "X")] * 3,
                                "data_pagamento date, tipo_imposto string, valor_pago decimal(20,4), filial_id string")
    assert G.gold_taxes(tax).first()["TotalImpostoPago"] == 0.012
    fee = spark.createDataFrame([(D1, "B", "J", Decimal("0.004"))] * 3,
                                "data_envio date, filial_id string, transportadora string, valor_frete decimal(20,4)")
    assert G.gold_freight(spark, fee).first()["TotalFretePago"] == 0.012
    sale = "data_venda date, produto_id int, filial_id string, quantidade int, valor_unitario decimal(20,4)"
    got = G.agg_sales(spark.createDataFrame([(D1, 1, "X", 1, Decimal("0.006"))] * 3, sale)).first()
    assert got["TotalValorVendido"] == 0.02
    one = G.agg_sales(spark.createDataFrame([(D1, 1, "X", 1, Decimal("0.004")), (D1, 1, "X", 0, Decimal("0.004"))], sale)).first()
    assert one["TicketMedio"] == 0.01


def test_report_over_all_branches_equals_gold_total(spark):
    gold = QUERIES["gold_taxes"](spark, SF_SMALL)
    branches = [r[0] for r in R.distinct_values(gold, "FilialId").collect()]
    series = R.report_series(gold, R.REPORTS["impostos"], branches=branches)
    a = series.agg(F.sum(F.col("TotalImpostoPago").cast("decimal(38,4)"))).first()[0]
    b = gold.agg(F.sum(F.col("TotalImpostoPago").cast("decimal(38,4)"))).first()[0]
    assert a == b


@pytest.mark.parametrize("name,keys", [
    ("gold_product_sorted", G.PRODUCT_KEYS),
    ("gold_freight_sorted", G.FREIGHT_KEYS),
    ("gold_taxes_sorted", G.TAX_KEYS),
    ("report_detail_taxes", G.TAX_KEYS),
    ("report_products_all", ["CodigoData", "FilialId"]),
    ("filter_dates", ["CodigoData"]),
])
def test_sorted_outputs_are_in_key_order(spark, name, keys):
    got = [tuple(r[k] for k in keys) for r in QUERIES[name](spark, SF_SMALL).collect()]
    assert got == sorted(got)


def test_preview_is_first_five_in_key_order(spark):
    full = [tuple(r) for r in QUERIES["gold_product_sorted"](spark, SF_SMALL).collect()]
    top = [tuple(r) for r in QUERIES["gold_product_top5"](spark, SF_SMALL).collect()]
    assert top == full[:5]


def test_gold_freight_resolves_names_case_insensitively(spark):
    df = spark.createDataFrame(
        [(D1, "B", "JadLog", Decimal("1.25"))],
        T.StructType([T.StructField("Data_Envio", T.DateType()),
                      T.StructField("FILIAL_ID", T.StringType()),
                      T.StructField("TRANSPORTADORA", T.StringType()),
                      T.StructField("valor_frete", T.DecimalType(18, 2))]))
    assert G.gold_freight(spark, df).collect()[0]["TotalFretePago"] == 1.25


def test_report_batch_caches_then_releases(spark):
    gold = QUERIES["gold_taxes"](spark, SF_SMALL)
    with R.report_batch(gold) as g:
        assert g.is_cached
        a = R.report_series(g, R.REPORTS["impostos"], branches=O.BRANCHES,
                            date_from=O.DATE_FROM, date_to=O.DATE_TO)
        b = R.report_series(g, R.REPORTS["impostos"], branches=O.BRANCHES[:1],
                            date_from=O.DATE_FROM, date_to=O.DATE_TO)
        assert a.count() > 0 and b.count() <= a.count()
    assert not g.is_cached


def test_collect_series_is_bounded(spark):
    series = QUERIES["report_taxes"](spark, SF_SMALL)
    pdf = R.collect_series(series, max_rows=10_000)
    assert list(pdf.columns) == ["CodigoData", "FilialId", "TotalImpostoPago"]
    assert len(pdf) == series.count()
    assert list(pdf["CodigoData"]) == sorted(pdf["CodigoData"])
    with pytest.raises(ValueError):
        R.collect_series(series, max_rows=len(pdf) - 1)


def test_has_rows(spark):
    assert R.has_rows(QUERIES["gold_taxes"](spark, SF_SMALL))
    assert not R.has_rows(R.filter_gold(QUERIES["gold_taxes"](spark, SF_SMALL), branches=[]))
