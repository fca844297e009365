"""Every registered query against its DuckDB formulation, and the
reconciliation properties that must hold on any input."""

import datetime as dt
import decimal
import hashlib
import json
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

ORACLE = entry.oracle_sql()
QUERIES = {n: q for n, q in entry.queries().items() if n in ORACLE}


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF_SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_of_the_library_has_an_oracle():
    from ledgerlens.plans import oracle, registry

    assert set(registry.QUERIES) == set(oracle.QUERIES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(srows, df.columns) == digest(orows, ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["transaction_uid", "login", "counter_login", "transaction_type", "transaction_ts", "comment", "amount"]
    assert df.count() > 0


def test_statuses_partition_the_pairs(spark):
    summary = {r.status: r.pairs for r in QUERIES["c17_reconciliation_summary"](spark, SF_SMALL).collect()}
    n_left = QUERIES["c5_load_ledger"](spark, SF_SMALL).count()
    n_right = QUERIES["c6_load_second_source"](spark, SF_SMALL).count()
    total = sum(summary.values())
    assert total - summary.get("right_only", 0) == n_left
    assert total - summary.get("left_only", 0) == n_right
    accepted = sum(summary.get(s, 0) for s in ("exact", "char", "date", "int"))
    assert QUERIES["c12_clean_transactions"](spark, SF_SMALL).count() == accepted
    assert QUERIES["c12_clean_transactions_multi"](spark, SF_SMALL).count() >= accepted


def test_daily_monthly_total_agree(spark):
    def total(name, col):
        return QUERIES[name](spark, SF_SMALL).agg({col: "sum"}).collect()[0][0]

    assert total("c14_daily_agg", "daily_sum") == total("c15_monthly_agg", "monthly_sum") == total("c16_total_agg", "total_sum")


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("s")))
def test_query_types_match_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = duck.execute(f"SELECT * FROM ({ORACLE[name]}) q LIMIT 0")
    oracle = {d[0]: str(d[1]) for d in res.description}
    for field in df.schema.fields:
        t = field.dataType.simpleString()
        assert oracle[field.name] == SPARK_TO_DUCK.get(t, t.upper()), (field.name, t, oracle[field.name])
