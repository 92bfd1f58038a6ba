import duckdb
import pytest

from pisteflow import catalog


@pytest.mark.parametrize("name", ["generated_areas", "greedy_assign_min_key"])
def test_rows_of_objects_far_beyond_the_first(spark, tmp_path, name):
    """Rows that would lie too far north, on the date line and in the second round of the world."""
    rows = [0, 149, 150, 400, 860, 899, 50_699, 50_700, 108_000, 108_001]
    keys = ", ".join(f"({r})" for r in rows)
    base = duckdb.connect()
    base.execute(f"COPY (SELECT (r * 100 + i)::BIGINT AS c_custkey FROM (VALUES {keys}) v(r), range(100) t(i)) TO '{tmp_path}/customer.parquet'")
    base.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet'")
    want = base.execute(catalog.ORACLE_SQL[name]).fetchall()
    got = catalog.QUERIES[name](spark, str(tmp_path)).select("area", "key").collect()
    assert sorted(map(tuple, got)) == sorted(want) and want
