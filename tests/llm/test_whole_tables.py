"""Models learn from whole tables."""

from labelloom.llm import pii


def test_trees_learn_from_every_candidate_with_evidence(spark, monkeypatch):
    learned, write = [], pii.materialize

    def counting(df, label):
        out = write(df, label)
        if "half" in out.columns:
            learned.append(out.count())
        return out

    monkeypatch.setattr(pii, "materialize", counting)
    monkeypatch.setattr(pii, "TREES", 1)
    line = "phone 612-555-7{0:03d} and order 8{0:03d}55512"
    docs = spark.range(240).selectExpr("id AS doc_id").collect()
    docs = [(r.doc_id, "\n".join(line.format((r.doc_id + 7 * k) % 1000) for k in range(50))) for r in docs]
    marked = pii.labelled(pii.candidates(spark.createDataFrame(docs, "doc_id long, text string")))
    pii.train(marked)
    told = marked.filter("evidence IS NOT NULL AND NOT touched").filter(pii.plausible()).count()
    assert told > 20_000
    assert learned == [told + pii._example_rows(spark).count()]
