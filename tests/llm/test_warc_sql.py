"""op6 against its SQL on pages with null ids, ties and shared payloads."""

import duckdb

from attrition.llm import queries


def test_null_ids_revisit_pages_of_the_same_payload(spark, tmp_path):
    big, other = "<p>" + "x" * 200, "y" * 150
    pages = [(5, "a", big), (None, "b", big), (None, None, big), (9, "c", big), (None, "d", other), (None, "e", other),
             (1, "f", "small"), (None, "g", "small"), (2, "h", None), (None, None, None), (3, "i", "é" * 60)]
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3) \
        .write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op6_warc(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = con.sql(queries.ORACLE_SQL["op6_warc"])
    assert got.columns == want.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))
    kinds = [(r["page_id"], r["record_type"], r["refers_to"]) for r in got.collect()]
    assert kinds.count((None, "revisit", 5)) == 2 and (9, "revisit", 5) in kinds
    assert kinds.count((None, "response", None)) == 4  # no page with an id, small or empty payloads
