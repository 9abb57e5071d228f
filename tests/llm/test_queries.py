"""The registered queries with a SQL form, side by side on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from layerkit.llm import queries as Q

SF = "/root/testdata/sf0.001"


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: repr(v) if isinstance(v, float) and not math.isnan(v) else str(v)
    return sorted([cell(r[i]) for i in order] for r in rows)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(E.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    df = E.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(columns, found.fetchall())


def test_one_query_per_operator():
    names = [n for n in Q.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(Q.queries()) == {*names, "pipeline"}
