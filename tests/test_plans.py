"""The whole plan: conservation, failures of a scorer, one-pass output, plan shapes."""

import pytest
from pyspark.sql import functions as F

from tests.support import SMALL, compare, rows
from textpulse.catalog.queries import QUERIES, fixed_now
from textpulse.config import PulseConfig
from textpulse.operators.routing import dead_letters
from textpulse.operators.scoring import lexicon_scorer
from textpulse.plans.content import (
    failures,
    outcome,
    processed_rows,
    read_results,
    route,
    write_routed,
)
from textpulse.schemas import DEAD_LETTER
from textpulse.sources import tables as tb


@pytest.fixture(scope="module")
def envelopes(spark):
    return tb.all_envelopes(
        tb.read_table(spark, SMALL, "documents"), tb.read_table(spark, SMALL, "conversations")
    )


def picky(df, text):
    """A scorer without an answer for texts without a lexicon word."""
    scored = lexicon_scorer()(df, text)
    answer = F.when(F.col("sentiment_result.sentiment") != "neutral", F.col("sentiment_result"))
    return scored.withColumn("sentiment_result", answer)


@pytest.mark.parametrize("scorer", [None, picky])
def test_every_message_has_one_outcome(spark, envelopes, scorer):
    config = PulseConfig(min_text_length=120, min_confidence=0.7)
    routed = route(envelopes, config, scorer)
    by_type = routed.groupBy("content_type", outcome(config).alias("o")).count().collect()
    counts = {(row.content_type, row.o): row["count"] for row in by_type}
    total = {r.content_type: r["count"] for r in envelopes.groupBy("content_type").count().collect()}
    processed = processed_rows(routed, config).groupBy("content_type").count().collect()
    for kind in ("post", "comment"):
        assert sum(n for (k, _), n in counts.items() if k == kind) == total[kind]
    assert {r.content_type: r["count"] for r in processed} == {
        k: n for (k, o), n in counts.items() if o == "processed"
    }
    failed = sum(n for (_, o), n in counts.items() if o.endswith("_failed"))
    assert failures(routed, config).count() == failed


def test_scorer_without_answer_goes_to_dead_letters(spark, envelopes):
    records = dead_letters(failures(route(envelopes, scorer=picky)), fixed_now())
    assert [(f.name, f.dataType) for f in records.schema] == [
        (f.name, f.dataType) for f in DEAD_LETTER
    ]
    unscored = records.filter("error_type = 'SentimentAnalysisError'")
    assert unscored.count() > 100
    odd = unscored.filter(
        "topic not in ('post', 'comment') or error_message <> 'Null sentiment result'"
        " or retry_count <> 0 or timestamp <> 1706745600 or length(original_message) <= 10"
    )
    assert odd.count() == 0


def test_one_pass_output_equals_the_plan(spark, envelopes, tmp_path):
    write_routed(envelopes, str(tmp_path / "routed"), scorer=picky)
    landed = read_results(spark, str(tmp_path / "routed"), now=fixed_now())
    routed = route(envelopes, scorer=picky)
    expected = processed_rows(routed, now=fixed_now())
    assert compare(landed.processed.toPandas(), expected.toPandas()) is None
    dead = dead_letters(failures(routed), fixed_now())
    assert rows(landed.dead_letters.toPandas()) == rows(dead.toPandas())


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = [name for name in QUERIES if not name.startswith(("stream_", "model_"))]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join_in_batch_plans(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for unwanted in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_costly_steps_appear_once(spark, envelopes):
    posts = tb.post_envelopes(tb.read_table(spark, SMALL, "documents"))
    plan = plan_of(processed_rows(route(posts)))
    assert plan.count("parseJson") == 1
    assert plan.count("lower(") == 1
    assert plan.count("split(") == 1
    assert "Exchange" not in plan


def test_top_content_keeps_few_rows_per_partition(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_engaging"](spark, SMALL))


def test_unused_columns_are_not_read(spark):
    plan = plan_of(QUERIES["eval_metrics"](spark, SMALL))
    assert "text" not in plan.split("ReadSchema", 2)[2]
