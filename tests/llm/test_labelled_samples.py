"""Bounds of the labelled rows that toxicity is learned from, and labels and ids that repeat."""

from pyspark.sql import functions as F

from splice_spark.llm import quality_classifier, toxicity


def test_sample_bounds_rows_not_ids(spark):
    """One labelled id on thousands of rows, of one text or of many, gives no more than the sample; each class has its own."""
    docs = spark.createDataFrame([(1, f"text {k % 1500}") for k in range(3000)] + [(3, f"clean {k}") for k in range(300)] + [(k, f"toxic {k}") for k in range(10, 60)], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(1, 0), (1, 0), (3, 0)] + [(k, 1) for k in range(10, 60)] + [(9999, 1)], "doc_id long, toxic int")
    rows = toxicity.labelled_sample(docs, labels, "toxic", 20).collect()
    assert len(rows) <= 40 and all(sum(r["label"] == k for r in rows) <= 20 for k in (0, 1))
    assert len({(r["label"], r["text"]) for r in rows}) == len(rows)
    whole = toxicity.labelled_sample(docs, labels, "toxic", 10**6)
    known = labels.distinct().filter(~quality_classifier.held_out(parts=5, part=0))
    assert whole.count() == docs.join(known, "doc_id").distinct().count()


def test_repeated_labelled_rows_are_scored(spark):
    """A labelled id on thousands of rows, null texts and two labels for one id: every row has a score in both classifiers."""
    text = "you are an idiot and a moron, worthless trash"
    rows = [(1, text)] * 2500 + [(2, None)] * 5 + [(k, f"a calm text about gardens and rivers number {k}") for k in range(3, 60)] + [(None, text)]
    docs = spark.createDataFrame([(*r, 1, 0.5, "x", True) for r in rows], "doc_id long, text string, label int, score double, key string, held_out boolean").repartition(4)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 1)] + [(k, 0, 1) for k in range(3, 60)] + [(3, 0, 1)], "doc_id long, toxic int, quality int")
    for got in (toxicity.score_toxicity(docs, labels), quality_classifier.classify(docs, labels)):
        assert got.count() == len(rows)
        assert got.filter("score is null or score < 0 or score > 1 or predicted <> int(score >= 0.5)").count() == 0
    assert toxicity.score_toxicity(docs, labels).filter("doc_id = 1").select(F.min("score")).first()[0] > 0.5
