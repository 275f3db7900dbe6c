import re

import duckdb

from __spark_entry__ import entry, oracle_sql, queries
from starflow.fixtures import TABLES
from conftest import SF_SMALL


CORPUS = re.compile(r"(op\d+_|pipeline$)")
KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
         "double": "DOUBLE", "boolean": "BOOLEAN"}


def _like(spark_type, duck):
    """Same type, as far as the driver's own names for types tell (STRING, NUMBER, DATETIME)."""
    want = KINDS.get(spark_type, spark_type.upper().replace(" ", ""))
    loose = {"VARCHAR": "STRING", "BIGINT": "NUMBER", "INTEGER": "NUMBER", "DOUBLE": "NUMBER", "TIMESTAMP": "DATETIME"}
    return duck.replace(" ", "") in (want, loose.get(want, "NUMBER" if want.startswith("DECIMAL") else want))


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["company_id", "industry_id", "sector_id", "state_id"]


def test_every_query_has_oracle_or_is_rows_only():
    assert set(oracle_sql()) <= set(queries())
    assert {q for q in queries() if not CORPUS.match(q)} <= set(oracle_sql())


def _canon(rows):
    return sorted(tuple("∅" if v is None else str(v) for v in r) for r in rows)


def test_queries_match_duckdb_small(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in oracle_sql().items():
        if CORPUS.match(name):
            continue  # tests/llm has them
        df = queries()[name](spark, SF_SMALL)
        cols = df.columns
        res = con.execute(sql)
        ocols = [d[0] for d in res.description]
        assert sorted(cols) == sorted(ocols), name
        kinds = dict(zip(ocols, (str(d[1]).upper() for d in res.description)))
        for c, t in df.dtypes:
            assert _like(t, kinds[c]), (name, c, t, kinds[c])
        orows = [tuple(r[ocols.index(c)] for c in cols) for r in res.fetchall()]
        srows = [tuple(r) for r in df.collect()]
        assert _canon(srows) == _canon(orows), name
