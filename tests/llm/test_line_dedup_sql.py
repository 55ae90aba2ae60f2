"""op2 against its SQL: repeated rows, repeated and null ids, as documents of their own or as one."""

import duckdb

from attrition.llm import queries


def test_documents_are_told_apart_by_id_and_text(spark, tmp_path):
    rows = [(1, "Shared A\nown 1")] * 12  # one document, twelve rows: its line stays
    rows += [(None, f"shared B \nnull {i}") for i in range(10)]  # ten documents without id
    rows += [(2, f" SHARED c\nsame id {i}") for i in range(10)]  # ten texts under one id
    rows += [(100 + i, f"shared D\n\n{'x ' * i}") for i in range(9)] + [(None, None), (3, None), (3, ""), (4, "\n\t\n")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(
        str(tmp_path / "documents.parquet"))
    got = queries.op2_line_dedup(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(queries.ORACLE_SQL["op2_line_dedup"])
    assert sorted(got.columns) == sorted(want.columns)
    cols = ", ".join(got.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, con.sql(f"select {cols} from want").fetchall()))
    dropped = {(r["doc_id"], r["n_dropped"]) for r in got.collect()}
    assert (1, 0) in dropped and (None, 1) in dropped and (2, 1) in dropped and (100, 0) in dropped
