"""The driver contract."""

import __spark_entry__ as contract
from checks.compare import oracle_connection


def test_contract(spark, tiny_dir):
    frame = contract.entry(spark)
    assert frame.count() == 5 and "revenue_rank" in frame.columns
    queries, sql = contract.queries(), contract.oracle_sql()
    assert len(queries) > 100 and set(sql) < set(queries)
    con = oracle_connection(tiny_dir)
    for name in ("annual_sales_trend", "model_benchmark", "dataset_model_benchmark"):
        kinds = {d[0]: str(d[1]) for d in con.execute(sql[name]).description}
        ours = dict(queries[name](spark, tiny_dir).dtypes)
        assert set(kinds) == set(ours)
        assert set(ours.values()) <= {"bigint", "double", "string", "date", "boolean"}
