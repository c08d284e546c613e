"""Driver contract: entry runs, keys line up, a few plans explain as intended."""

import __spark_entry__ as E
from likeness.plans import ORACLES, QUERIES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["id_1", "id_2", "similarity"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) - set(ORACLES) == {"als_predict"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_is_pruned(spark):
    # the joins write their distinct inputs once; the scans happen in these plans
    from likeness.sources import tables as T
    docs = _plan(T.word_sets(spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in docs
    assert "PushedFilters: []" in docs  # the whole table
    cf = _plan(T.raw_cf_ratings(spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>" in cf
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in cf
