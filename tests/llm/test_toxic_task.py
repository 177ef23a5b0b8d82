"""The toxicity model is trained in a task, not on the driver."""

import os

from pixelspark.llm import toxicity


def test_training_does_not_run_on_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "vile rotten words" if i % 3 == 0 else "a calm and pleasant text", "en") for i in range(120)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")

    driver, train = os.getpid(), toxicity.train

    def elsewhere(*args):
        assert os.getpid() != driver
        return train(*args)

    monkeypatch.setattr(toxicity, "train", elsewhere)
    model = toxicity.fit(docs, labels)
    got = toxicity.scored(docs, model).select("doc_id", "score").collect()
    assert all((r["score"] > 0.5) == (r["doc_id"] % 3 == 0) for r in got)
    one = labels.where("toxic = 1")
    assert toxicity.fit(docs, one) is None
