"""Tasks hold a part of the replies of a batch."""

from labelloom.operators import supervise as sv


def test_rephrase_holds_the_replies_of_some_rows(spark, monkeypatch):
    monkeypatch.setattr(sv, "CALLED", 16, raising=False)

    def fn(text):
        with open("/proc/self/statm") as f:
            return f"{int(f.read().split()[1]) * 4096}|" + "x" * 1_000_000

    rows = spark.range(600).selectExpr("id AS record_id", "IF(id % 50 = 0, NULL, CONCAT('text ', id)) AS text").coalesce(1)
    out = sv.rephrase(rows, fn, threads=2)
    assert out.columns == ["record_id", "text", "original_text", "error"]
    got = out.selectExpr("record_id", "CAST(substring_index(text, '|', 1) AS LONG) AS held", "original_text", "error").collect()
    assert {(r.record_id, r.original_text, r.error) for r in got} == {(i, None if i % 50 == 0 else f"text {i}", None) for i in range(600)}
    held = [r.held for r in got]
    assert max(held) - min(held) < 300_000_000
