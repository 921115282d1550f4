"""Queries on texts that the test tables do not have, against their SQL."""

import duckdb

from registry import route_queries as rq

ODD = [(7, ""), (15, None), (23, "ABC"), (31, "abc"), (39, " "), (0, ""), (6, "")]


def test_route_custom_takes_empty_texts(spark, tmp_path):
    """The share of capitals of an empty text is 0 / 0."""
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in ODD], "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, rq.QUERIES["route_custom"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(con.sql(rq.ORACLES["route_custom"]).fetchall())
    assert [r[0] for r in got if r[1] == "loud"] == [6, 7, 23]
