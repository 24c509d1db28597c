"""Every registered query against its DuckDB oracle (the driver's check, on
the smallest tables so the suite stays quick)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from fixture_paths import SF_SMALL
from lakeledger.operators import maintenance as M
from lakeledger.registry import ORACLE, QUERIES
from lakeledger.sources import tables

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries())


def _broken(monkeypatch, name):
    """Disable the operator that a query is named after."""
    if name == "replace_date":
        monkeypatch.setattr(M, "replace_date", lambda target, *a: target)
    elif name in ("ingest_devolucao", "stream_ingest_devolucao", "upsert_stored"):
        monkeypatch.setattr(tables, "update_matched", lambda target, src, key: target)
    elif name in ("refresh_incremental", "refresh_taxes", "backfill_range"):
        real = tables.write_partitions

        def keep(spark, path, df, replace=(), **k):
            return {} if "/gold/" in path else real(spark, path, df, replace=replace, **k)
        monkeypatch.setattr(tables, "write_partitions", keep)
    else:  # existing dates are never replaced: the new rows are only appended
        real = tables.write_partitions
        monkeypatch.setattr(tables, "write_partitions", lambda spark, path, df, replace=(), **k: real(spark, path, df, replace=(), **k))


@pytest.mark.parametrize("name", ["replace_date", "ingest_devolucao", "stream_ingest_devolucao", "upsert_stored",
                                  "refresh_incremental", "refresh_taxes", "backfill_range", "ingest_vendas"])
def test_a_query_fails_when_its_operator_is_disabled(spark, duck, monkeypatch, name):
    with monkeypatch.context() as m:
        _broken(m, name)
        df = QUERIES[name](spark, SF_SMALL)
        got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert got != _rows(cols, res.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, res.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["CodigoData", "ProdutoId", "FilialId", "TotalDevolvido",
                          "TotalEmEstoque", "TotalQuantidadeVendida", "TotalValorVendido",
                          "TicketMedio"]
    assert df.count() > 0
