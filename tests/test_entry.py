import duckdb

from conftest import SF001
import __spark_entry__ as entry_mod
from visitlens.plans.catalog import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    got = df.collect()
    assert len(got) == 10
    assert df.columns == ["category_id", "click_count", "order_count", "pay_count"]


def test_every_query_has_oracle():
    qs, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60
    assert set(QUERIES) - set(sql) == set()


def test_oracles_match_on_smallest_fixture(spark):
    """A quick version of the driver's gate: every query vs its DuckDB SQL at sf0.001."""
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")

    def canon(rs):
        out = []
        for r in rs:
            out.append(tuple(None if v is None else (round(v, 6) if isinstance(v, float) else str(v)) for v in r))
        return sorted(out, key=repr)

    bad = []
    for name in QUERIES:
        df = entry_mod.queries()[name](spark, SF001)
        cols = sorted(df.columns)
        a = canon([tuple(r[c] for c in cols) for r in df.collect()])
        rel = con.sql(entry_mod.oracle_sql()[name])
        if sorted(rel.columns) != cols:
            bad.append((name, "columns"))
            continue
        idx = [rel.columns.index(c) for c in cols]
        b = canon([tuple(r[i] for i in idx) for r in rel.fetchall()])
        if a != b:
            bad.append((name, len(a), len(b)))
    assert bad == []
