"""CSV scan, bronze -> silver ingest, gold refresh and the end-to-end runs."""

import datetime as dt
import tempfile
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixture_paths import SF_SMALL
from lakeledger.functions.dates import file_token
from lakeledger.plans import gold as gold_jobs
from lakeledger.plans import ingest as ingest_jobs
from lakeledger.plans import pipeline
from lakeledger.schemas import GOLDS, SOURCES, Lake
from lakeledger.sources import tables
from lakeledger.sources import testdata as TD
from lakeledger.sources.bronze import FILE_DAY, daily_path, export_daily, scan_csv

VENDAS = SOURCES["vendas"]
DEV = SOURCES["devolucao"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rows_of(data):
    return sorted((tuple(r) for r in data), key=repr)


def write_csv(lake, spec, day, text):
    path = daily_path(lake, spec, day)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_file_token_and_path(lake):
    assert file_token("2025-09-19") == "2025_09_19"
    assert daily_path(lake, VENDAS, "2025-09-19").endswith(
        "bronze/sistema_vendas/vendas/vendas_2025_09_19.csv")


def test_scan_binds_by_header_name(spark, lake):
    a = write_csv(lake, VENDAS, "2025-09-19",
                  "data_venda,produto_id,filial_id,quantidade,valor_unitario\n"
                  "2025-09-19,7,SP01,3,10.50\n")
    b = write_csv(lake, VENDAS, "2025-09-20",
                  "valor_unitario,quantidade,filial_id,produto_id,data_venda,canal\n"
                  "99.99,1,RJ02,8,2025-09-20,web\n")
    df = scan_csv(spark, [a, b], VENDAS)
    assert df.columns == VENDAS.column_names + ["canal"]
    assert dict(df.dtypes)["valor_unitario"] == "decimal(18,4)"
    got = rows(df.select(*VENDAS.column_names, F.col("canal")))
    assert [r[:5] for r in got] == [
        (dt.date(2025, 9, 19), 7, "SP01", 3, Decimal("10.50")),
        (dt.date(2025, 9, 20), 8, "RJ02", 1, Decimal("99.99")),
    ]
    assert [r[5] for r in got] == [None, "web"]


def test_header_only_file_keeps_declared_types(spark, lake):
    p = write_csv(lake, VENDAS, "2025-09-19",
                  "data_venda,produto_id,filial_id,quantidade,valor_unitario\n")
    df = scan_csv(spark, p, VENDAS)
    assert df.count() == 0
    assert dict(df.dtypes)["data_venda"] == "date"


def test_bad_value_fails(spark, lake):
    p = write_csv(lake, VENDAS, "2025-09-19",
                  "data_venda,produto_id,filial_id,quantidade,valor_unitario\n"
                  "2025-09-19,seven,SP01,3,10.50\n")
    with pytest.raises(Exception):
        scan_csv(spark, p, VENDAS).collect()


def test_missing_file_fails(spark, lake):
    with pytest.raises(FileNotFoundError):
        ingest_jobs.ingest(spark, lake, "vendas", "2025-09-19")


def test_ingest_first_load_replace_and_stray(spark, lake):
    header = "data_venda,produto_id,filial_id,quantidade,valor_unitario\n"
    write_csv(lake, VENDAS, "2025-09-19", header + "2025-09-19,1,A,1,1.00\n")
    assert ingest_jobs.ingest(spark, lake, "vendas", "2025-09-19")["mode"] == "create"
    write_csv(lake, VENDAS, "2025-09-20",
              header + "2025-09-20,2,A,2,2.00\n2025-09-19,9,A,9,9.00\n")
    out = ingest_jobs.ingest(spark, lake, "vendas", "2025-09-20")
    assert out["stray_dates"] == [dt.date(2025, 9, 19)]
    got = rows(tables.scan_table(spark, lake.silver("vendas")).select("produto_id"))
    assert got == [(1,), (2,), (9,)]
    # Re-running the day replaces it; its stray row is appended once more,
    # exactly as a delete-then-append of the whole file would do.
    ingest_jobs.ingest(spark, lake, "vendas", "2025-09-20")
    got = rows(tables.scan_table(spark, lake.silver("vendas")).select("produto_id"))
    assert got == [(1,), (2,), (9,), (9,)]


def test_stray_rows_are_counted(spark, lake):
    header = "data_venda,produto_id,filial_id,quantidade,valor_unitario\n"
    write_csv(lake, VENDAS, "2025-09-19", header + "2025-09-19,1,A,1,1.00\n")
    ingest_jobs.ingest(spark, lake, "vendas", "2025-09-19")
    write_csv(lake, VENDAS, "2025-09-20", header + "2025-09-20,2,A,2,2.00\n"
              "2025-09-19,8,A,8,8.00\n2025-09-19,9,A,9,9.00\n,7,A,7,7.00\n")
    out = ingest_jobs.ingest(spark, lake, "vendas", "2025-09-20")
    assert out["stray_rows"] == 3
    assert out["appended_rows"] == {dt.date(2025, 9, 19): 2, None: 1}
    write_csv(lake, VENDAS, "2025-09-21", header + "2025-09-21,3,A,3,3.00\n2025-09-01,4,A,4,4.00\n")
    write_csv(lake, VENDAS, "2025-09-22", header + "2025-09-22,5,A,5,5.00\n")
    out = ingest_jobs.ingest_range(spark, lake, "vendas", ["2025-09-21", "2025-09-22"])
    assert (out["mode"], out["stray_dates"], out["stray_rows"]) == ("one_job", [dt.date(2025, 9, 1)], 1)


def test_ingest_upsert_source(spark, lake):
    header = "pedido_id,produto_id,quantidade,motivo,data_devolucao,filial_id\n"
    write_csv(lake, DEV, "2025-09-19", header + "p1,1,1,a,2025-09-19,A\np2,2,2,b,2025-09-19,A\n")
    ingest_jobs.ingest(spark, lake, "devolucao", "2025-09-19")
    write_csv(lake, DEV, "2025-09-20", header + "p2,2,5,c,2025-09-20,A\np3,3,3,d,2025-09-20,A\n")
    assert ingest_jobs.ingest(spark, lake, "devolucao", "2025-09-20")["mode"] == "upsert"
    got = rows(tables.scan_table(spark, lake.silver("devolucao")).select("pedido_id", "quantidade"))
    assert got == [("p1", 1), ("p2", 5), ("p3", 3)]


def test_ingest_range_equals_day_by_day(spark):
    import tempfile
    results = []
    for one_job in (True, False):
        lake = Lake(tempfile.mkdtemp(prefix="lakeledger-range-"))
        for name in ("vendas", "devolucao"):
            spec = SOURCES[name]
            recent = TD.BUILDERS[name](spark, SF_SMALL).filter(
                F.col(spec.date_column) >= F.lit(dt.date(2001, 1, 1)))
            days = export_daily(spark, recent, lake, spec)
            if one_job:
                ingest_jobs.ingest(spark, lake, name, days[0])
                out = ingest_jobs.ingest_range(spark, lake, name, days[1:])
                assert out["mode"] == "one_job"
            else:
                for d in days:
                    ingest_jobs.ingest(spark, lake, name, d)
        results.append([rows(tables.scan_table(spark, lake.silver(n))) for n in ("vendas", "devolucao")])
    assert results[0] == results[1]


def test_ingest_range_with_strays_is_one_job_equal_to_day_by_day(spark):
    import tempfile
    header = "data_venda,produto_id,filial_id,quantidade,valor_unitario\n"
    files = {
        # strays into a later day of the batch and into a day outside it
        "2025-09-18": "2025-09-18,1,A,1,1.00\n2025-09-19,2,A,2,2.00\n2025-09-10,3,A,3,3.00\n",
        # a stray into an earlier day of the batch, and a NULL date
        "2025-09-19": "2025-09-19,4,A,4,4.00\n2025-09-18,5,A,5,5.00\n,6,A,6,6.00\n",
        # only a stray: the file's own date is cleared
        "2025-09-20": "2025-09-21,7,A,7,7.00\n",
    }
    results = []
    for one_job in (True, False):
        lake = Lake(tempfile.mkdtemp(prefix="lakeledger-strays-"))
        write_csv(lake, VENDAS, "2025-09-17", header + "2025-09-20,9,A,9,9.00\n2025-09-17,8,A,8,8.00\n")
        ingest_jobs.ingest(spark, lake, "vendas", "2025-09-17")
        for d, body in files.items():
            write_csv(lake, VENDAS, d, header + body)
        if one_job:
            out = ingest_jobs.ingest_range(spark, lake, "vendas", list(files))
            assert out["mode"] == "one_job"
        else:
            for d in files:
                ingest_jobs.ingest(spark, lake, "vendas", d)
        results.append(rows(tables.scan_table(spark, lake.silver("vendas"))
                            .select("data_venda", "produto_id")))
    d = dt.date
    assert results[0] == results[1] == rows_of([
        (d(2025, 9, 10), 3), (d(2025, 9, 17), 8), (d(2025, 9, 18), 1), (d(2025, 9, 18), 5),
        (d(2025, 9, 19), 4), (None, 6), (d(2025, 9, 21), 7)])


def test_ingest_range_key_in_two_files_keeps_the_latest_row(spark, lake):
    header = "pedido_id,produto_id,quantidade,motivo,data_devolucao,filial_id\n"
    write_csv(lake, DEV, "2025-09-19", header + "p1,1,1,a,2025-09-19,A\n")
    write_csv(lake, DEV, "2025-09-20", header + "p1,1,7,b,2025-09-20,A\n")
    out = ingest_jobs.ingest_range(spark, lake, "devolucao", ["2025-09-19", "2025-09-20"])
    assert out["mode"] == "create"
    got = rows(tables.scan_table(spark, lake.silver("devolucao")).select("pedido_id", "quantidade"))
    assert got == [("p1", 7)]


DEV_HEADER = "pedido_id,produto_id,quantidade,motivo,data_devolucao,filial_id\n"


def _upsert_batch_both_ways(spark, first: str, files: dict):
    """The same files loaded by ingest_range and one by one, on top of a
    table created from ``first``; returns (mode, one-job rows, daily rows)."""
    import tempfile
    results, mode = [], None
    for one_job in (True, False):
        lake = Lake(tempfile.mkdtemp(prefix="lakeledger-upsert-range-"))
        write_csv(lake, DEV, "2025-09-17", DEV_HEADER + first)
        ingest_jobs.ingest(spark, lake, "devolucao", "2025-09-17")
        for d, body in files.items():
            write_csv(lake, DEV, d, DEV_HEADER + body)
        if one_job:
            mode = ingest_jobs.ingest_range(spark, lake, "devolucao", list(files))["mode"]
        else:
            for d in files:
                ingest_jobs.ingest(spark, lake, "devolucao", d)
        results.append(rows(tables.scan_table(spark, lake.silver("devolucao"))
                            .select("pedido_id", "quantidade", "data_devolucao")))
    return mode, results[0], results[1]


def test_ingest_range_upsert_revisions_are_one_job_equal_to_day_by_day(spark):
    first = "t1,1,1,a,2025-09-17,A\nt2,1,2,a,2025-09-17,A\nt2,1,3,a,2025-09-17,A\n"
    files = {
        # t1 revised twice; t2 (twice in the table) revised once; new key n1
        # inserted twice in one file; a NULL key in two files
        "2025-09-18": "t1,1,10,b,2025-09-18,A\nn1,1,5,b,2025-09-18,A\nn1,1,6,b,2025-09-18,A\n,1,0,b,2025-09-18,A\n",
        "2025-09-19": "t1,1,11,c,2025-09-19,A\nt2,1,20,c,2025-09-19,A\nn2,1,7,c,2025-09-19,A\n,1,0,c,2025-09-19,A\n",
    }
    mode, once, daily = _upsert_batch_both_ways(spark, first, files)
    assert mode == "one_job"
    assert once == daily
    d = dt.date
    assert once == rows_of([
        ("t1", 11, d(2025, 9, 19)), ("t2", 20, d(2025, 9, 19)), ("t2", 20, d(2025, 9, 19)),
        ("n1", 5, d(2025, 9, 18)), ("n1", 6, d(2025, 9, 18)), ("n2", 7, d(2025, 9, 19)),
        (None, 0, d(2025, 9, 18)), (None, 0, d(2025, 9, 19))])


def test_ingest_range_key_repeated_in_its_first_file_is_one_job_equal_to_day_by_day(spark):
    files = {
        "2025-09-18": "n1,1,5,b,2025-09-18,A\nn1,1,6,b,2025-09-18,A\n",
        "2025-09-19": "n1,1,9,c,2025-09-19,A\n",
    }
    mode, once, daily = _upsert_batch_both_ways(spark, "t1,1,1,a,2025-09-17,A\n", files)
    assert mode == "one_job"
    assert once == daily


@pytest.mark.parametrize("known,again", [("t1", "t1"), ("t1", "n1")])
def test_ingest_range_key_repeated_later_or_known_to_the_table_is_an_error(spark, lake, known, again):
    """As day by day: a file that repeats a key which the table or an earlier file holds."""
    write_csv(lake, DEV, "2025-09-17", DEV_HEADER + f"{known},1,1,a,2025-09-17,A\n")
    ingest_jobs.ingest(spark, lake, "devolucao", "2025-09-17")
    write_csv(lake, DEV, "2025-09-18", DEV_HEADER + "n1,1,5,b,2025-09-18,A\n")
    write_csv(lake, DEV, "2025-09-19", DEV_HEADER + f"{again},1,6,b,2025-09-19,A\n{again},1,7,b,2025-09-19,A\n")
    with pytest.raises(Exception, match="matched more than once"):
        ingest_jobs.ingest_range(spark, lake, "devolucao", ["2025-09-18", "2025-09-19"])
    assert tables.scan_table(spark, lake.silver("devolucao")).count() == 1


def test_first_load_of_a_range_takes_its_columns_from_the_first_day(spark):
    got = []
    for one_job in (True, False):
        lake = Lake(tempfile.mkdtemp(prefix="lakeledger-cols-"))
        write_csv(lake, DEV, "2025-09-18", DEV_HEADER + "n1,1,5,b,2025-09-18,A\n")
        write_csv(lake, DEV, "2025-09-19", DEV_HEADER.strip() + ",extra\n" + "n2,1,6,b,2025-09-19,A,x\n")
        days = ["2025-09-18", "2025-09-19"]
        if one_job:
            ingest_jobs.ingest_range(spark, lake, "devolucao", days)
        else:
            for d in days:
                ingest_jobs.ingest(spark, lake, "devolucao", d)
        df = tables.scan_table(spark, lake.silver("devolucao"))
        got.append((df.columns, rows(df)))
    assert got[0] == got[1] and "extra" not in got[0][0]


def test_back_fill_of_a_missing_gold_table_reads_the_whole_history(spark, lake):
    spec = SOURCES["tributos"]
    df = TD.tributos(spark, SF_SMALL)
    tables.create_table(spark, lake.silver(spec), df, spec.date_column)
    gold_jobs.backfill(spark, lake, "impostos", "1998-01-01", "1998-03-01")
    assert tables.scan_table(spark, lake.gold("impostos")).agg(F.min("CodigoData")).first()[0] == df.agg(F.min(spec.date_column)).first()[0]


def test_part_files_are_bound_by_their_own_headers(spark, lake):
    path = daily_path(lake, VENDAS, "2025-09-19")
    os.makedirs(path)
    bodies = {
        "part-00000.csv": "",
        "part-00001.csv": "data_venda,produto_id,filial_id,quantidade,valor_unitario\n2025-09-19,7,SP01,3,10.50\n",
        "part-00002.csv": "data_venda,quantidade,filial_id,produto_id,valor_unitario\n2025-09-19,3,SP01,7,10.50\n",
    }
    for name, body in bodies.items():
        with open(f"{path}/{name}", "w") as f:
            f.write(body)
    got = rows(scan_csv(spark, path, VENDAS))
    assert [r[1:4] for r in got] == [(7, "SP01", 3)] * 2


def test_an_amount_with_too_many_decimals_fails(spark, lake):
    header = "data_venda,produto_id,filial_id,quantidade,valor_unitario\n"
    p = write_csv(lake, VENDAS, "2025-09-19", header + "2025-09-19,7,SP01,3,0.0041\n")
    assert scan_csv(spark, p, VENDAS).first()["valor_unitario"] == Decimal("0.0041")
    p = write_csv(lake, VENDAS, "2025-09-20", header + "2025-09-20,7,SP01,3,0.00411\n")
    with pytest.raises(Exception, match="more than 4 decimals"):
        scan_csv(spark, p, VENDAS).collect()


def test_patterns_are_left_out_for_plain_amounts_and_paths(spark, lake):
    header = "data_venda,produto_id,filial_id,quantidade,valor_unitario\n"
    odd = Lake(f"{lake.root}/first.csv")  # the first ".csv" of the path is not the daily file's
    paths = [write_csv(at, VENDAS, "2025-09-19", header + f"2025-09-19,7,SP01,3,{amount}\n")
             for at, amount in ((lake, " 10.5000"), (odd, "1.23400000"))]
    df = scan_csv(spark, paths, VENDAS, with_file_day=True)
    assert rows(df.select("valor_unitario", FILE_DAY)) == [
        (Decimal("1.2340"), dt.date(2025, 9, 19)), (Decimal("10.5000"), dt.date(2025, 9, 19))]
    # A pattern costs more than reading the row does: it stands only behind a cheaper test.
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    money = plan[plan.index("CASE WHEN"):]
    assert "instr" in money.split(" THEN ")[0] and "regexp_extract" not in money.split(" THEN ")[0]
    assert "coalesce(try_cast(replace(substring(substring_index(" in plan


def test_export_refuses_rows_without_a_date(spark, lake):
    spec = SOURCES["tributos"]
    df = TD.tributos(spark, SF_SMALL).limit(5)
    nulls = df.withColumn(spec.date_column, F.lit(None).cast("date"))
    with pytest.raises(ValueError):
        export_daily(spark, df.unionByName(nulls), lake, spec)
    assert ingest_jobs.available_days(spark, lake, spec) == []


def test_exported_files_are_compressed_and_read_back(spark, lake):
    df = spark.createDataFrame([(f"p{i}", i % 5, i, "m,\"x\"" if i % 2 else None, dt.date(2025, 9, 18 + i % 2), "SP01") for i in range(4000)], DEV.schema)
    days = export_daily(spark, df, lake, DEV)
    parts = [f"{p}/{f}" for p in (daily_path(lake, DEV, d) for d in days) for f in os.listdir(p) if not f.startswith((".", "_"))]
    assert len(days) == 2 and all(f.endswith(".csv.gz") for f in parts)
    text = sum(len(",".join("" if v is None else str(v) for v in r)) + 1 for r in df.collect())
    assert sum(os.path.getsize(f) for f in parts) < text / 2
    assert rows(scan_csv(spark, [daily_path(lake, DEV, d) for d in days], DEV)) == rows(df)


def test_only_repeated_keys_of_a_batch_are_gathered(spark, monkeypatch):
    gathered, latest_rows = [], ingest_jobs._latest_rows

    def seen(df, repeated, key):
        gathered.append(rows(repeated))
        return latest_rows(df, repeated, key)
    monkeypatch.setattr(ingest_jobs, "_latest_rows", seen)
    first = "p0,1,1,a,2025-09-17,A\n"
    _, one_job, daily = _upsert_batch_both_ways(spark, first, {
        "2025-09-18": "p0,1,2,b,2025-09-18,A\np1,1,3,b,2025-09-18,A\n,1,4,b,2025-09-18,A\n", "2025-09-19": "p2,1,5,c,2025-09-19,A\n,1,6,c,2025-09-19,A\n"})
    assert one_job == daily and len(daily) == 5 and gathered == []  # rows without a key do not repeat one
    _, one_job, daily = _upsert_batch_both_ways(spark, first, {
        "2025-09-18": "p1,1,3,b,2025-09-18,A\np2,1,4,b,2025-09-18,A\n", "2025-09-19": "p2,1,5,c,2025-09-19,A\n"})
    assert one_job == daily and gathered == [[("p2",)]]


def test_pipeline_day_by_day_equals_backfill(spark):
    import tempfile
    days_lake = Lake(tempfile.mkdtemp(prefix="lakeledger-days-"))
    fill_lake = Lake(tempfile.mkdtemp(prefix="lakeledger-fill-"))
    all_days = set()
    for lake in (days_lake, fill_lake):
        for name in SOURCES:
            df = TD.BUILDERS[name](spark, SF_SMALL)
            df = df.filter(F.col(SOURCES[name].date_column) >= F.lit(dt.date(1998, 1, 1)))
            all_days |= set(export_daily(spark, df, lake, SOURCES[name]))
    days = sorted(all_days)[:4]
    for d in days:
        pipeline.run_day(spark, days_lake, d)
    pipeline.backfill(spark, fill_lake, days[0], days[-1])
    for g in ("produtos", "fretes", "impostos"):
        a = rows(tables.scan_table(spark, days_lake.gold(g)))
        b = rows(tables.scan_table(spark, fill_lake.gold(g)))
        assert a == b and len(a) > 0


def test_refresh_empty_day_clears_gold_date(spark, lake):
    for name in ("tributos",):
        spec = SOURCES[name]
        tables.create_table(spark, lake.silver(spec), TD.tributos(spark, SF_SMALL), spec.date_column)
    gold_jobs.refresh(spark, lake, "impostos", "1998-03-01")
    day = dt.date(1998, 3, 1)
    assert day in tables.list_partitions(spark, lake.gold("impostos"), "CodigoData")
    tables.replace_dates(spark, lake.silver("tributos"),
                         TD.tributos(spark, SF_SMALL).limit(0), [day])
    gold_jobs.refresh(spark, lake, "impostos", day)
    assert day not in tables.list_partitions(spark, lake.gold("impostos"), "CodigoData")


def test_refreshing_dates_gives_the_rows_of_one_backfill(spark):
    """A refresh recomputes one date from its silver partitions; done over a
    back-filled gold table (first, last and evenly spaced dates) it must
    leave every row as the one-job back-fill computed it."""
    import tempfile
    lake = Lake(tempfile.mkdtemp(prefix="lakeledger-gold-props-"))
    for name in SOURCES:
        spec = SOURCES[name]
        tables.create_table(spark, lake.silver(spec), TD.BUILDERS[name](spark, SF_SMALL),
                            spec.date_column)
    for g in ("produtos", "fretes", "impostos"):
        spec = GOLDS[g]
        src = SOURCES[spec.inputs[0]]
        days = sorted(d for d in tables.list_partitions(spark, lake.silver(src), src.date_column)
                      if d is not None)
        gold_jobs.backfill(spark, lake, g, days[0], days[-1])
        once = rows(tables.scan_table(spark, lake.gold(g)))
        for d in sorted(set(days[::max(1, len(days) // 6)] + [days[-1]])):
            gold_jobs.refresh(spark, lake, g, d)
        assert rows(tables.scan_table(spark, lake.gold(g))) == once and len(once) > 0
