import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tests.support import SMALL, rows
from textpulse.operators import model as md
from textpulse.operators.scoring import score_content
from textpulse.sources import tables as tb


@pytest.fixture(scope="module")
def model(spark):
    return md.default_model(spark)


def test_training_texts(spark):
    counts = {r.label: r["count"] for r in md.training_rows(spark).groupBy("label").count().collect()}
    assert counts == {0: 8, 1: 7, 2: 8}


def test_model_learns_its_training_texts(spark, model):
    scored = md.apply_model(model, md.training_rows(spark))
    assert scored.filter("label = prediction").count() >= 21


def test_model_scores_every_document(spark, model):
    content = tb.posts(tb.read_table(spark, SMALL, "documents")).withColumnRenamed("title", "content")
    scored = score_content(content, scorer=md.model_scorer(model)).select("sentiment_result.*")
    assert scored.count() == 200
    odd = scored.filter(
        ~F.col("sentiment").isin(*md.SENTIMENT_BY_CLASS)
        | ~F.col("confidence").between(1 / 3 - 1e-9, 1)
    )
    assert odd.count() == 0


def test_hybrid_prefers_the_lexicon(spark, model):
    df = spark.createDataFrame(
        [("great love it here",), ("okay average nothing special typical",), ("good but bad",)],
        "t string",
    )
    hybrid = [tuple(r.sentiment_result) for r in md.hybrid_scorer(model)(df, "t").collect()]
    alone = [tuple(r.sentiment_result) for r in md.model_scorer(model)(df, "t").collect()]
    assert hybrid[0] == ("positive", 0.8, 0.7999999999999999)
    assert hybrid[1] == alone[1]
    assert hybrid[1][:2] == ("neutral", 0.5)
    assert hybrid[2] == ("neutral", 0.5, 0.6)


def test_saved_model_scores_alike(spark, model, tmp_path):
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    df = tb.read_table(spark, SMALL, "documents")
    both = [md.apply_model(m, df).select("doc_id", "prediction").toPandas() for m in (model, again)]
    assert rows(both[0]) == rows(both[1])
