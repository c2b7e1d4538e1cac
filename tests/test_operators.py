"""De-duplication, metrics and listings on small fixtures against brute force."""

import json
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from textpulse.operators.dedup import first_seen
from textpulse.operators.metrics import processing_metrics, sentiment_by_group, top_engaging
from textpulse.sources.listings import flatten_listings, listing_failures, read_children

START = datetime(2024, 1, 1)


def test_first_seen_with_one_hot_id(spark):
    rows = []
    for n in range(3000):
        key = "hot" if n % 3 == 0 else f"id{n % 700}"
        kind = "post" if n % 2 else "comment"
        at = START + timedelta(seconds=(n * 7919) % 3000)
        rows.append((kind, key, at, f"text {n}", n))
    df = spark.createDataFrame(
        rows, "content_type string, id string, kafka_timestamp timestamp, content string, n int"
    ).repartition(7)
    expected = {}
    for row in sorted(rows, key=lambda r: (r[2], r[3])):
        expected.setdefault(row[:2], row)
    assert sorted(tuple(r) for r in first_seen(df).collect()) == sorted(expected.values())


def test_first_seen_picks_the_same_row_among_simultaneous_copies(spark):
    rows = [("post", "1", START, text) for text in "bcad"]
    df = spark.createDataFrame(
        rows, "content_type string, id string, kafka_timestamp timestamp, content string"
    )
    assert [r.content for r in first_seen(df).collect()] == ["a"]


@pytest.fixture(scope="module")
def processed(spark):
    rows = []
    for n in range(600):
        # One group, author and window hold a third of the rows.
        hot = n % 3 == 0
        rows.append(
            (
                f"id{n}",
                f"content {n}",
                "post" if hot or n % 2 else "comment",
                "hot" if hot else f"s{n % 5}",
                "hot" if hot else f"a{n % 17}",
                ("positive", "negative", "neutral")[n % 7 % 3],
                (0.8, 0.2, 0.5)[n % 7 % 3],
                0.5 + n % 10 / 20,
                n % 40,
                n % 90,
                START + timedelta(seconds=0 if hot else n * 11),
            )
        )
    return spark.createDataFrame(
        rows,
        "id string, content string, content_type string, subreddit string, author string,"
        " sentiment string, sentiment_score double, confidence double, engagement_score int,"
        " text_length int, processing_timestamp timestamp",
    )


def test_processing_metrics(spark, processed):
    groups = {}
    for r in processed.collect():
        minute = r.processing_timestamp.minute // 5 * 5
        start = r.processing_timestamp.replace(minute=minute, second=0)
        groups.setdefault((start, r.content_type, r.subreddit), []).append(r)
    got = processing_metrics(processed).collect()
    assert len(got) == len(groups)
    for g in got:
        members = groups[g.window_start, g.content_type, g.subreddit]
        kinds = Counter(m.sentiment for m in members)
        assert g.window_end - g.window_start == timedelta(minutes=5)
        assert g.total_processed == len(members)
        assert g.avg_sentiment == pytest.approx(
            sum(m.sentiment_score for m in members) / len(members)
        )
        assert g.avg_confidence == pytest.approx(sum(m.confidence for m in members) / len(members))
        assert (g.positive_count, g.negative_count, g.neutral_count) == tuple(
            kinds[k] for k in ("positive", "negative", "neutral")
        )
        assert g.max_engagement == max(m.engagement_score for m in members)
        assert g.avg_text_length == pytest.approx(
            sum(m.text_length for m in members) / len(members)
        )
        assert g.unique_authors == len({m.author for m in members})


def test_approximate_authors_are_near(spark, processed):
    exact = {
        (r.window_start, r.content_type, r.subreddit): r.unique_authors
        for r in processing_metrics(processed).collect()
    }
    for r in processing_metrics(processed, approximate=True).collect():
        wanted = exact[r.window_start, r.content_type, r.subreddit]
        assert abs(r.unique_authors - wanted) <= max(1, 0.15 * wanted)


def test_ratios_add_up(spark, processed):
    grouped = sentiment_by_group(processed)
    total = F.col("positive") + F.col("negative") + F.col("neutral")
    ratio = F.col("positive_ratio") + F.col("negative_ratio") + F.col("neutral_ratio")
    assert grouped.filter((total != F.col("total_count")) | (F.abs(ratio - 1) > 1e-9)).count() == 0
    assert grouped.agg(F.sum("total_count")).first()[0] == 600


def test_top_engaging_breaks_ties_by_id(spark, processed):
    rows = [r for r in processed.collect() if r.content_type == "comment"]
    expected = [r.id for r in sorted(rows, key=lambda r: (-r.engagement_score, r.id))[:7]]
    top = top_engaging(processed, "comment", 7)
    assert [r.id for r in top.collect()] == expected
    assert top.columns == [
        "id", "content", "subreddit", "sentiment", "engagement_score", "author",
    ]


def listing(*children):
    return json.dumps({"data": {"children": [{"data": child} for child in children]}})


POST = {"id": "1", "title": "t", "author": "a", "subreddit": "s", "score": 3, "created_utc": 5}
COMMENT = {"id": "1", "subreddit": "s", "score": 3, "created_utc": 5, "parent_id": "p"}


def frame(spark, *values):
    return spark.createDataFrame([(v, n) for n, v in enumerate(values)], "value string, n int")


def test_post_listing(spark):
    good = [POST, {**POST, "id": "2", "created_utc": 1704067200.0, "extra": 1}]
    bad = [{k: v for k, v in POST.items() if k != name} for name in POST]
    bad += [{**POST, "id": 7}, {**POST, "score": "3"}, {**POST, "score": 1.5}, {**POST, "title": None}]
    df = frame(spark, listing(*good, *bad))
    rows = flatten_listings(df, "post", keep=["n"]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        (0, "1", "t", "a", "s", 3, 5),
        (0, "2", "t", "a", "s", 3, 1704067200),
    ]
    failed = listing_failures(df, "post").collect()
    assert len(failed) == len(bad)
    assert all(json.loads(r.original_message)["data"] in bad for r in failed)
    assert {r.source_topic for r in failed} == {"posts"}


def test_comment_listing_defaults(spark):
    df = frame(spark, listing(COMMENT, {**COMMENT, "body": "b", "author": 7}))
    got = {tuple(r) for r in flatten_listings(df, "comment").collect()}
    assert got == {("1", "", "", "s", 3, 5, "p"), ("1", "b", "", "s", 3, 5, "p")}


def test_unreadable_and_empty_listings(spark):
    df = frame(spark, "not json", '{"data":{}}', listing(), None)
    children = read_children(df, "post")
    assert sorted(str(r.raw) for r in children.collect()) == ["None", "not json", '{"data":{}}']
    assert flatten_listings(df, "post").count() == 0
