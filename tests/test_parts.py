"""Documents of several parts against their SQL, at a size where the parts are several."""

import duckdb
import pytest

from qrelmill.plans.suite import ORACLES, QUERIES


@pytest.mark.parametrize("name, table, rows", [("catalog_documents", "part", 90_000), ("group_documents", "supplier", 13_000)])
def test_documents_of_parts_are_laid_end_to_end(spark, tmp_path, name, table, rows):
    shape = {
        "part": "id as p_partkey, concat('part ', id) as p_name, concat('Brand#', id % 25) as p_brand, concat('TYPE ', id % 7) as p_type, cast(id % 3 as int) as p_size",
        "supplier": "id as s_suppkey, concat('supplier ', id) as s_name, cast(id % 12 as int) as s_nationkey",
    }[table]
    path = f"{tmp_path}/{table}.parquet"
    spark.sql(f"select {shape} from range({rows})").coalesce(1).write.parquet(path)
    got = {tuple(r) for r in QUERIES[name](spark, str(tmp_path)).select("dataset", "stem", "text_md5").collect()}
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from '{path}/*.parquet'")
    assert got == set(con.execute(ORACLES[name]).fetchall())
