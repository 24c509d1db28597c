"""Reads of stored tables: buckets, metadata, run-time pruning, cached and paged reports, inferred types."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.operators import gold as G
from lakeledger.operators import reports as R
from lakeledger.plans import ingest as ingest_jobs
from lakeledger.plans import reports as report_jobs
from lakeledger.schemas import SOURCES
from lakeledger.sources import infer, tables
from lakeledger.sources.bronze import daily_path, scan_csv

D = [dt.date(2025, 9, d) for d in range(1, 31)]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def metric(df, name) -> int:
    """A metric of the file scan of a query that has run; ``df`` must be collected from itself."""
    found = []

    def walk(p):
        if p.nodeName().startswith("Scan") and p.metrics().contains(name):
            found.append(p.metrics().apply(name).value())
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(p.executedPlan())
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            return walk(p.plan())
        children = p.children()
        for i in range(children.size()):
            walk(children.apply(i))
    walk(df._jdf.queryExecution().executedPlan())
    return max(found)


@pytest.fixture()
def keyed(spark, lake):
    path = f"{lake.root}/t"
    df = spark.range(400).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("v"), F.element_at(F.array(*[F.lit(d) for d in D[:4]]), (F.col("id") % 4 + 1).cast("int")).alias("d"))
    tables.create_table(spark, path, df, "d", buckets=("k", 16))
    return path


def test_an_upsert_reads_and_rewrites_only_its_buckets(spark, keyed):
    source = spark.createDataFrame([("k5", 1000, D[1]), ("k9", 2000, D[0]), ("new", 3000, D[9])], "k string, v int, d date")
    mine = {r[0] for r in source.select(tables.bucket_of("k", 16)).collect()}
    keys = tables.touched_keys(spark, keyed, source, "k")
    assert "dynamicpruning" in plan(keys).replace(" ", "").lower()
    files = {f for f in tables.scan_table(spark, keyed).inputFiles()}
    hit = {f for f in files if any(f"{tables.BUCKET}={b}/" in f for b in mine)}
    keys.collect()
    assert metric(keys, "numFiles") == len(hit) < len(files) / 3
    before = {f: os.stat(f.removeprefix("file:").replace("///", "/")).st_mtime_ns for f in files}
    out = tables.upsert_table(spark, keyed, source, "k")
    assert out["replaced"] == [D[1]]
    after = set(tables.scan_table(spark, keyed).inputFiles())
    assert len(files - after) <= 2 and all(any(f"{tables.BUCKET}={b}/" in f for b in mine) for f in files - after)
    assert all(os.stat(f.removeprefix("file:").replace("///", "/")).st_mtime_ns == before[f] for f in files & after)
    got = {r.k: (r.v, r.d) for r in tables.scan_table(spark, keyed).collect()}
    assert len(got) == 401 and got["k5"] == (1000, D[1]) and got["k9"] == (2000, D[0]) and got["new"] == (3000, D[9])


def test_a_bucketed_table_takes_every_kind_of_write(spark, keyed):
    one = spark.createDataFrame([("k0", 1, D[0]), ("x", 2, D[7]), (None, 3, D[0]), (None, 4, None)], "k string, v int, d date")
    tables.write_partitions(spark, keyed, one, replace=[D[0]])
    assert rows(tables.scan_table(spark, keyed).filter((F.col("d") == F.lit(D[0])) | (F.col("d") == F.lit(D[7])) | F.col("d").isNull())) == sorted(map(tuple, one.collect()), key=repr)
    tables.append_rows(spark, keyed, one.filter("k = 'x'"))
    assert tables.scan_table(spark, keyed, D[7], D[7]).count() == 2
    # Every row of D[7] moves away: no folder of that date is left.
    tables.upsert_table(spark, keyed, spark.createDataFrame([("x", 5, D[8])], "k string, v int, d date"), "k")
    assert D[7] not in tables.list_partitions(spark, keyed, "d") and tables.scan_table(spark, keyed, D[8], D[8]).count() == 2
    tables.upsert_table(spark, keyed, spark.createDataFrame([(None, 9, D[0])], "k string, v int, d date"), "k")
    assert tables.scan_table(spark, keyed).filter("k IS NULL").count() == 3
    with pytest.raises(ValueError):
        tables.create_table(spark, f"{keyed}2", one, "d", buckets=("k", 100_000))


def test_changes_of_a_stored_upsert(spark, keyed):
    source = spark.createDataFrame([("k5", 1000, D[2]), ("new", 3000, D[9]), (None, 7, D[9])], "k string, v int, d date")
    tables.upsert_table(spark, keyed, source, "k", changes=f"{keyed}-changes")
    assert rows(spark.read.parquet(f"{keyed}-changes").select("k", "v", "d", tables.SIGN)) == sorted(
        [("k5", 5, D[1], -1), ("k5", 1000, D[2], 1), ("new", 3000, D[9], 1), (None, 7, D[9], 1)], key=repr)


GOLD = "CodigoData date, FilialId string, Transportadora string, TotalFretePago double"


@pytest.fixture()
def freight(spark, lake):
    df = spark.createDataFrame([(d, b, c, float(i)) for i, d in enumerate(D) for b in ("A", "B", "C") for c in ("x", "y")], GOLD)
    tables.create_table(spark, lake.gold("fretes"), df, "CodigoData")
    return lake


def test_choices_in_tables_prune_folders_at_run_time(spark, freight):
    gold = tables.scan_table(spark, freight.gold("fretes"))
    spark.createDataFrame([(D[3],), (D[4],), (D[4],), (None,)], "CodigoData date").write.parquet(f"{freight.root}/dates")
    spark.createDataFrame([("A",), ("A",), (None,), ("none",)], "FilialId string").write.parquet(f"{freight.root}/branches")
    dates, branches = (spark.read.parquet(f"{freight.root}/{t}") for t in ("dates", "branches"))
    df = R.chosen_series(gold, R.REPORTS["fretes"], branches, dates)
    assert "dynamicpruning" in plan(df).lower()
    assert [tuple(r) for r in df.collect()] == [(D[3], "A", 6.0), (D[4], "A", 8.0)]
    assert metric(df, "numPartitions") == 2
    assert R.chosen_series(gold, R.REPORTS["fretes"], branches.limit(0), dates).count() == 0


def test_a_report_session_reads_a_table_once_until_a_load_commits(spark, freight):
    session = report_jobs.ReportSession(spark, freight)
    ask = {"branches": ["A"], "date_from": D[0], "date_to": D[1]}
    first = session.ask("fretes", **ask)
    assert [tuple(r) for r in first.collect()] == [(D[0], "A", 0.0), (D[1], "A", 2.0)]
    again = session.ask("fretes", **ask)
    assert "InMemoryTableScan" in plan(again) and "FileScan" in plan(again) and len(session.held) == 1
    held = session.held["fretes"]
    session.ask("fretes", **ask)
    assert session.held["fretes"] is held
    tables.replace_dates(spark, freight.gold("fretes"), spark.createDataFrame([(D[1], "A", "x", 9.5)], GOLD), [D[1]])
    assert [tuple(r) for r in session.ask("fretes", **ask).collect()] == [(D[0], "A", 0.0), (D[1], "A", 9.5)]
    tables.append_rows(spark, freight.gold("fretes"), spark.createDataFrame([(D[1], "A", "x", 0.5)], GOLD))
    assert session.ask("fretes", **ask).collect()[1][2] == 10.0
    assert tables.scan_table(spark, freight.gold("fretes"), D[1], D[1]).count() == 2  # a plain scan is not answered from memory
    session.close()
    assert not session.held
    with pytest.raises(ValueError):
        session.ask("fretes", product=3, **ask)


def test_pages_together_are_the_detail(spark):
    data = [(D[i % 3] if i % 7 else None, f"b{i % 5}", None if i % 4 == 0 else f"c{i}", float(i)) for i in range(57)]
    df = spark.createDataFrame(data, GOLD)
    keys = ["CodigoData", "FilialId", "Transportadora", "TotalFretePago"]
    want = [tuple(r) for r in R.report_detail(df, keys, branches=["b0", "b1", "b2", "b3"]).collect()]
    for n in (1, 10, len(want), 1000):
        pages = [p.collect() for p in R.detail_pages(df, keys, n, branches=["b0", "b1", "b2", "b3"])]
        assert [tuple(r) for p in pages for r in p] == want
        assert all(len(p) == n for p in pages[:-1])
    assert list(R.detail_pages(df, keys, 10, branches=[])) == []


def test_a_page_behind_a_key_reads_only_later_folders(spark, freight):
    pages = list(R.detail_pages(tables.scan_table(spark, freight.gold("fretes")), G.FREIGHT_KEYS, 60, branches=["A", "B", "C"]))
    assert len(pages) == 3
    pages[2].collect()
    assert metric(pages[2], "numPartitions") <= 11


def test_bounds_and_counts_come_from_metadata(spark, freight):
    assert tuple(report_jobs.stored_date_bounds(spark, freight, "fretes").first()) == (D[0], D[-1])
    assert "FileScan" not in plan(report_jobs.stored_choices(spark, freight, "fretes", "CodigoData"))
    choices = report_jobs.stored_choices(spark, freight, "fretes", "FilialId")
    assert [r[0] for r in choices.collect()] == ["A", "B", "C"] and "ReadSchema: struct<FilialId:string>" in plan(choices)
    df = report_jobs.stored_rows(spark, freight, ["fretes"])
    assert "PushedAggregation: [COUNT(" in plan(df) and tuple(df.first()) == ("fretes", 180, True)
    tables.create_table(spark, freight.gold("impostos"), spark.createDataFrame([], "CodigoData date, FilialId string"), "CodigoData")
    assert tuple(report_jobs.stored_rows(spark, freight, ["impostos"]).first()) == ("impostos", 0, False)
    assert tuple(report_jobs.stored_date_bounds(spark, freight, "impostos").first()) == (None, None)


@pytest.mark.parametrize("texts,kind", [
    (["1", " 2 ", "", None, "-3"], T.IntegerType()), (["1", "3000000000"], T.LongType()), (["1", "2.5", "1e3"], T.DoubleType()), (["1", "x"], T.StringType()),
    (["true", "FALSE"], T.BooleanType()), (["0", "1"], T.IntegerType()), (["2025-09-19"], T.DateType()), (["2025"], T.IntegerType()), (["2025-13-19"], T.StringType()),
    (["2025-09-19 10:00:00", "2025-09-19T10:00"], T.TimestampType()), (["", None], T.StringType()), (["NaN"], T.StringType()), (["99999999999999999999"], T.DoubleType()),
    (["1d"], T.StringType()), (["t"], T.StringType())])
def test_inferred_types(spark, texts, kind):
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    assert infer.inferred_types(df, ["a"]) == {"a": kind}


def test_types_widen_and_never_narrow(spark, lake):
    assert infer.widened(T.IntegerType(), T.LongType(), "c") == T.LongType()
    assert infer.widened(T.DoubleType(), T.IntegerType(), "c") == T.DoubleType()
    for a, b in ((T.LongType(), T.DoubleType()), (T.IntegerType(), T.StringType()), (T.StringType(), T.IntegerType()), (T.DateType(), T.TimestampType())):
        with pytest.raises(TypeError):
            infer.widened(a, b, "c")
    spec = SOURCES["vendas"]

    def load(day, extra):
        path = daily_path(lake, spec, day)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(f"data_venda,produto_id,filial_id,quantidade,valor_unitario,peso,nota\n{day},1,A,1,1.00,{extra},n\n")
        ingest_jobs.ingest(spark, lake, spec, day, infer=True)
    load("2025-09-18", "7")
    load("2025-09-19", "3000000000")
    df = tables.scan_table(spark, lake.silver(spec))
    assert dict(df.dtypes)["peso"] == "bigint" and sorted(r.peso for r in df.collect()) == [7, 3000000000]
    load("2025-09-20", "5")  # narrower rows are cast
    with pytest.raises(TypeError, match="peso"):
        load("2025-09-21", "heavy")
    assert sorted(r.peso for r in tables.scan_table(spark, lake.silver(spec)).collect()) == [5, 7, 3000000000]


@pytest.mark.parametrize("text,good", [("0.0041", True), ("10.500000", True), ("100", True), ("4e-2", True), ("40e-5", True), ("1.5e3", True), ("0.00000000000000000", True), ("-3.1000", True),
                                       ("0.00411", False), ("4e-19", False), ("4e-5", False), ("0.0000000000000000000004", False), ("1.23456e0", False)])
def test_amounts_are_judged_on_their_digits(spark, lake, text, good):
    spec = SOURCES["vendas"]
    path = daily_path(lake, spec, "2025-09-19")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(f"data_venda,produto_id,filial_id,quantidade,valor_unitario\n2025-09-19,7,SP01,3,{text}\n")
    if good:
        assert scan_csv(spark, path, spec).first()["valor_unitario"] == Decimal(text)
    else:
        with pytest.raises(Exception, match="more than 4 decimals"):
            scan_csv(spark, path, spec).collect()


@pytest.mark.parametrize("kind,amount", [("double", 0.00004), ("decimal(20,5)", Decimal("0.00004")), ("double", 1e-300)])
def test_frames_with_finer_amounts_fail_instead_of_rounding(spark, kind, amount):
    freight = spark.createDataFrame([("p", amount, D[0], "x", "A")] * 10, f"pedido_id string, valor_frete {kind}, data_envio date, transportadora string, filial_id string")
    with pytest.raises(Exception, match="more than 4 decimals"):
        G.gold_freight(spark, freight).collect()
    taxes = spark.createDataFrame([(D[0], "t", amount, "A")], f"data_pagamento date, tipo_imposto string, valor_pago {kind}, filial_id string")
    with pytest.raises(Exception, match="more than 4 decimals"):
        G.gold_taxes(taxes).collect()
