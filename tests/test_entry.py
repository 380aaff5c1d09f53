import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and "bleu" in df.columns


def test_every_query_runs_and_has_oracle_names(spark):
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    for name, fn in qs.items():
        df = fn(spark, SF_SMALL)
        assert df.columns, name
        df.write.format("noop").mode("overwrite").save()
