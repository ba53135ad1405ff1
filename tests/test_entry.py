"""Driver contract: the entry query runs and every registered query is callable."""

import __spark_entry__ as E

#: Queries without SQL (the optional corpus operators are listed by themselves).
ROWS_ONLY = {
             "tagger_fit", "tagger_predict", "tagger_eval", "pred_align"}


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert set(df.columns) >= {"lang", "kappa"}
    assert len(rows) >= 1


def test_every_query_has_an_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert {n for n in set(q) - set(o) if n not in E.LLM_QUERIES} <= ROWS_ONLY
