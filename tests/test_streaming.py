"""The bronze folder watcher loads each daily file once, late files later."""

import datetime as dt
import gzip
import os
import time

import pytest
from pyspark.sql import functions as F

from fixture_paths import SF_SMALL
from lakeledger.schemas import SOURCES
from lakeledger.sources import tables
from lakeledger.sources import testdata as TD
from lakeledger.plans import ingest as ingest_jobs
from lakeledger.sources.bronze import daily_path, export_daily
from lakeledger.streaming.bronze_watch import catch_up


def test_catch_up_loads_new_files_once(spark, lake):
    spec = SOURCES["tributos"]
    rows = TD.tributos(spark, SF_SMALL)
    cut = F.lit(dt.date(2000, 1, 1))
    ckpt = f"{lake.root}/_streams/tributos"
    export_daily(spark, rows.filter(F.col(spec.date_column) < cut), lake, spec)
    catch_up(spark, lake, spec, checkpoint=ckpt)
    first = tables.scan_table(spark, lake.silver(spec)).count()
    assert first == rows.filter(F.col(spec.date_column) < cut).count()
    # Nothing new: a second run changes nothing.
    catch_up(spark, lake, spec, checkpoint=ckpt)
    assert tables.scan_table(spark, lake.silver(spec)).count() == first
    # Later files arrive and are loaded by the next run.
    export_daily(spark, rows.filter(F.col(spec.date_column) >= cut), lake, spec)
    catch_up(spark, lake, spec, checkpoint=ckpt)
    assert tables.scan_table(spark, lake.silver(spec)).count() == rows.count()


def write_day(lake, day, bodies, name="part-{:05d}.csv"):
    """A daily folder of part files of the returns source."""
    spec = SOURCES["devolucao"]
    path = daily_path(lake, spec, day)
    os.makedirs(path, exist_ok=True)
    for i, body in enumerate(bodies):
        text = "pedido_id,produto_id,quantidade,motivo,data_devolucao,filial_id\n" + body
        file = f"{path}/{name.format(i)}"
        with (gzip.open(file, "wt") if file.endswith(".gz") else open(file, "w")) as f:
            f.write(text)
    return path


def returns(spark, lake):
    df = tables.scan_table(spark, lake.silver("devolucao")).select("pedido_id", "quantidade", "data_devolucao")
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_day_of_many_part_files_is_loaded_once(spark, lake):
    write_day(lake, "2025-09-18", ["a,1,1,m,2025-09-18,A\n"])
    catch_up(spark, lake, "devolucao", checkpoint=f"{lake.root}/_s")
    write_day(lake, "2025-09-19", [f"b{i},1,1,m,2025-09-19,A\n" for i in range(7)] + [",1,9,m,2025-09-19,A\n"])
    catch_up(spark, lake, "devolucao", checkpoint=f"{lake.root}/_s")
    assert len(returns(spark, lake)) == 9  # the row without a key stands once


def test_files_of_one_run_load_in_date_order_whatever_their_arrival(spark, lake):
    late = write_day(lake, "2025-09-19", ["a,1,19,m,2025-09-19,A\n"])
    early = write_day(lake, "2025-09-18", ["a,1,18,m,2025-09-18,A\n"])
    now = time.time()
    for path, age in ((late, 5000), (early, 10)):
        for f in os.listdir(path):
            os.utime(f"{path}/{f}", (now - age, now - age))
    catch_up(spark, lake, "devolucao", checkpoint=f"{lake.root}/_s")
    assert returns(spark, lake) == [("a", 19, dt.date(2025, 9, 19))]


def test_a_file_with_an_old_modification_time_is_still_loaded(spark, lake):
    write_day(lake, "2025-09-19", ["a,1,1,m,2025-09-19,A\n"])
    catch_up(spark, lake, "devolucao", checkpoint=f"{lake.root}/_s")
    path = write_day(lake, "2025-09-10", ["old,1,1,m,2025-09-10,A\n"])
    old = time.time() - 60 * 86400
    for f in os.listdir(path):
        os.utime(f"{path}/{f}", (old, old))
    catch_up(spark, lake, "devolucao", checkpoint=f"{lake.root}/_s")
    assert [r[0] for r in returns(spark, lake)] == ["a", "old"]


def test_compressed_part_files_are_seen(spark, lake):
    write_day(lake, "2025-09-19", ["a,1,1,m,2025-09-19,A\n"], name="part-{:05d}.csv.gz")
    catch_up(spark, lake, "devolucao", checkpoint=f"{lake.root}/_s")
    assert [r[0] for r in returns(spark, lake)] == ["a"]


def test_a_batch_that_fails_after_its_commit_is_not_applied_again(spark, lake, monkeypatch):
    write_day(lake, "2025-09-18", ["a,1,1,m,2025-09-18,A\n"])
    catch_up(spark, lake, "devolucao", checkpoint=f"{lake.root}/_s")
    write_day(lake, "2025-09-19", [",1,5,m,2025-09-19,A\n"])
    real = ingest_jobs.ingest_range

    def failing(*a, **k):
        real(*a, **k)
        raise RuntimeError("after the commit")
    with monkeypatch.context() as m:
        m.setattr(ingest_jobs, "ingest_range", failing)
        with pytest.raises(Exception):
            catch_up(spark, lake, "devolucao", checkpoint=f"{lake.root}/_s")
    catch_up(spark, lake, "devolucao", checkpoint=f"{lake.root}/_s")
    assert returns(spark, lake) == [("a", 1, dt.date(2025, 9, 18)), (None, 5, dt.date(2025, 9, 19))]
