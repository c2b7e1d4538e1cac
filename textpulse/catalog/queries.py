"""The registered queries: each reads whole tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textpulse.functions.lexicon import lexicon_hits, lexicon_sentiment
from textpulse.functions.text import clean_column, extract_content
from textpulse.operators import evaluation as ev
from textpulse.operators import metrics as mt
from textpulse.operators import model as md
from textpulse.operators.dedup import first_seen
from textpulse.operators.routing import (
    dead_letters,
    parse_failures,
    parse_messages,
    union_content,
    valid_content,
)
from textpulse.operators.scoring import (
    clean_content,
    drop_short,
    lexicon_scorer,
    score_content,
)
from textpulse.operators.term_lexicon import term_scorer
from textpulse.plans.content import failures, processed_rows, route
from textpulse.session import scratch_dir
from textpulse.sinks import messages as out
from textpulse.sinks.tables import BATCH_COLUMNS, land_in_directory
from textpulse.sources import listings as ls
from textpulse.sources import tables as tb
from textpulse.sources.records import decode_dead_letters, decode_processed
from textpulse.streaming import jobs
from textpulse.streaming.live import join_labels, live_evaluation

Query = Callable[[SparkSession, str], DataFrame]

# 2024-02-01 00:00:00 UTC, the clock of every registered query.
FIXED_EPOCH = 1706745600


def fixed_now() -> Column:
    return F.timestamp_seconds(F.lit(FIXED_EPOCH))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return tb.read_texts(spark, sf, "documents", tb.spread_of(spark))


def _conversations(spark: SparkSession, sf: str) -> DataFrame:
    return tb.read_texts(spark, sf, "conversations", tb.spread_of(spark))


def _envelopes(spark: SparkSession, sf: str) -> DataFrame:
    return tb.all_envelopes(_documents(spark, sf), _conversations(spark, sf))


def _content(spark: SparkSession, sf: str) -> DataFrame:
    return valid_content(parse_messages(_envelopes(spark, sf)))


def _processed(spark: SparkSession, sf: str) -> DataFrame:
    return processed_rows(route(_envelopes(spark, sf)), now=fixed_now())


def _wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _readable(df: DataFrame) -> DataFrame:
    key = {"kafka_key": F.col("kafka_key").cast("string")}
    return _wall_clock(df.withColumns(key), "kafka_timestamp")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def parse_posts(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(valid_content(parse_messages(tb.post_envelopes(_documents(spark, sf)))))


def parse_comments(spark: SparkSession, sf: str) -> DataFrame:
    envelopes = tb.comment_envelopes(_conversations(spark, sf))
    return _readable(valid_content(parse_messages(envelopes)))


def dlq_records(spark: SparkSession, sf: str) -> DataFrame:
    return dead_letters(failures(route(_envelopes(spark, sf))), fixed_now())


def dlq_preview(spark: SparkSession, sf: str) -> DataFrame:
    problems = parse_failures(parse_messages(_envelopes(spark, sf)))
    return _wall_clock(out.dead_letter_preview(problems, fixed_now()), "Timestamp")


def unified_content(spark: SparkSession, sf: str) -> DataFrame:
    posts = valid_content(parse_messages(tb.post_envelopes(_documents(spark, sf))))
    comments = valid_content(parse_messages(tb.comment_envelopes(_conversations(spark, sf))))
    return _readable(union_content(posts, comments))


def extract_content_by_type(spark: SparkSession, sf: str) -> DataFrame:
    posts = tb.posts(_documents(spark, sf)).select(
        "id", F.lit("post").alias("content_type"), "title", F.lit(None).cast("string").alias("body")
    )
    # Whitespace around every third body, and a type that is neither for every tenth turn.
    comments = tb.comments(_conversations(spark, sf)).select(
        "id",
        F.when(F.col("conv_id") % 10 == 0, "other").otherwise("comment").alias("content_type"),
        F.lit(None).cast("string").alias("title"),
        F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit(" \t\n"), "body", F.lit(" \n")))
        .otherwise(F.col("body"))
        .alias("body"),
    )
    return posts.unionByName(comments).select(
        "id",
        "content_type",
        extract_content(F.col("title"), F.col("body"), F.col("content_type")).alias("content"),
    )


def clean_text_rows(spark: SparkSession, sf: str) -> DataFrame:
    content = tb.posts(_documents(spark, sf)).select("doc_id", F.col("title").alias("content"))
    kept = drop_short(clean_content(content))
    return kept.select("doc_id", "cleaned_text", F.length("cleaned_text").alias("text_length"))


def lexicon_sentiment_rows(spark: SparkSession, sf: str) -> DataFrame:
    content = tb.posts(_documents(spark, sf)).select("doc_id", F.col("title").alias("content"))
    scored = score_content(content)
    return scored.select("doc_id", "sentiment_result.*")


def lexicon_sentiment_raw(spark: SparkSession, sf: str) -> DataFrame:
    """The column function on texts as they are, and on a short word beside some of them."""
    texts = F.when(F.col("doc_id") % 20 == 0, F.array("title", F.lit("good")))
    texts = texts.otherwise(F.array("title"))
    rows = tb.posts(_documents(spark, sf)).select("doc_id", F.explode(texts).alias("text"))
    scored = rows.select("doc_id", lexicon_sentiment(F.col("text")).alias("result"))
    return scored.select("doc_id", "result.*")


def lexicon_terms(spark: SparkSession, sf: str) -> DataFrame:
    """A lexicon of every word of ``benchmark``, joined; words of even length are positive."""
    cleaned = clean_column(tb.read_table(spark, sf, "benchmark"), F.col("text"), "cleaned")
    words = cleaned.select(F.explode(F.split("cleaned", " ")).alias("word"))
    polarity = F.when(F.length("word") % 2 == 0, "positive").otherwise("negative")
    terms = words.distinct().withColumn("polarity", polarity)
    content = tb.posts(_documents(spark, sf)).select("doc_id", F.col("title").alias("content"))
    scored = score_content(content, scorer=term_scorer(terms, ["doc_id"]))
    return scored.select("doc_id", "sentiment_result.*")


def processed_content(spark: SparkSession, sf: str) -> DataFrame:
    return _wall_clock(_readable(_processed(spark, sf)), "processing_timestamp")


def result_preview(spark: SparkSession, sf: str) -> DataFrame:
    return out.result_preview(_processed(spark, sf))


def encode_processed(spark: SparkSession, sf: str) -> DataFrame:
    return out.encode_processed(_processed(spark, sf))


def _damaged(messages: DataFrame, number: Column, period: int) -> DataFrame:
    """Every ``period``-th value cut off, as a broken writer would leave it."""
    value = F.when(number % period == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    return messages.withColumn("value", value)


def decode_processed_rows(spark: SparkSession, sf: str) -> DataFrame:
    messages = out.encode_processed(_processed(spark, sf))
    number = F.regexp_extract("key", "[0-9]+$", 0).cast("bigint")
    return _wall_clock(decode_processed(_damaged(messages, number, 10)), "processing_timestamp")


def decode_dlq(spark: SparkSession, sf: str) -> DataFrame:
    records = dead_letters(failures(route(_envelopes(spark, sf))), fixed_now())
    messages = _damaged(out.encode_dead_letters(records), F.length("value"), 5)
    return _wall_clock(decode_dead_letters(messages), "error_timestamp")


def encode_dlq(spark: SparkSession, sf: str) -> DataFrame:
    records = dead_letters(failures(route(_envelopes(spark, sf))), fixed_now())
    return out.encode_dead_letters(records)


def listing_posts(spark: SparkSession, sf: str) -> DataFrame:
    return ls.flatten_listings(tb.post_listings(_documents(spark, sf)), "post")


def listing_comments(spark: SparkSession, sf: str) -> DataFrame:
    return ls.flatten_listings(tb.comment_listings(_conversations(spark, sf)), "comment")


def listing_failures(spark: SparkSession, sf: str) -> DataFrame:
    posts = ls.listing_failures(tb.post_listings(_documents(spark, sf)), "post")
    comments = ls.listing_failures(tb.comment_listings(_conversations(spark, sf)), "comment")
    return dead_letters(posts.unionByName(comments), fixed_now())


def dedup_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    number = F.regexp_extract("id", "^c?([0-9]+)", 1).cast("bigint")
    return _readable(first_seen(tb.repeated(_content(spark, sf), number)))


def publish_raw(spark: SparkSession, sf: str) -> DataFrame:
    return out.encode_raw(_content(spark, sf))


def windowed_metrics(spark: SparkSession, sf: str) -> DataFrame:
    records = tb.event_records(tb.read_table(spark, sf, "events"))
    return _metrics_view(mt.processing_metrics(records))


def windowed_metrics_content(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics_view(mt.processing_metrics(_processed(spark, sf), "kafka_timestamp"))


def _metrics_view(metrics: DataFrame) -> DataFrame:
    return _wall_clock(metrics, "window_start", "window_end")


def sentiment_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return mt.sentiment_by_group(_processed(spark, sf))


def top_engaging(spark: SparkSession, sf: str) -> DataFrame:
    return mt.top_engaging(_processed(spark, sf), "post")


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    return tb.weighted_predictions(
        tb.read_table(spark, sf, "labels"), tb.read_table(spark, sf, "documents")
    )


def _verdicts(documents: DataFrame) -> DataFrame:
    """The lexicon's class of each document, with its time and confidence."""
    content = tb.posts(documents).select(
        "doc_id", "created_utc", F.col("title").alias("content")
    )
    scored = lexicon_scorer()(clean_content(content), "cleaned_text")
    names = F.array(*[F.lit(name) for name in md.SENTIMENT_BY_CLASS])
    position = F.array_position(names, F.col("sentiment_result.sentiment"))
    return scored.select(
        "doc_id",
        (position - 1).cast("double").alias("prediction"),
        "sentiment_result.confidence",
        F.timestamp_seconds("created_utc").alias("kafka_timestamp"),
    )


def _lexicon_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Labels against the lexicon's verdict on the document, with its time and confidence.

    Documents are scored before the join, so that the join moves no texts.
    """
    verdicts = _verdicts(_documents(spark, sf))
    return tb.weighted_join(tb.labelled(tb.read_table(spark, sf, "labels")), verdicts, "doc_id")


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return ev.confusion_matrix(_predictions(spark, sf), weight="weight")


def _report(spark: SparkSession, sf: str) -> DataFrame:
    return ev.classification_report(confusion_matrix(spark, sf))


def eval_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(ev.evaluation_metrics(_predictions(spark, sf), weight="weight"), *ev.METRICS)


def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_report(spark, sf), "precision", "recall", "f1")


def classification_report_text(spark: SparkSession, sf: str) -> DataFrame:
    return ev.report_text(_report(spark, sf))


def _comparison(spark: SparkSession, sf: str) -> DataFrame:
    return ev.compare_models(
        _predictions(spark, sf), _lexicon_predictions(spark, sf), weight="weight"
    )


def ab_compare(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_comparison(spark, sf), "model_1", "model_2", "difference")


def ab_report_text(spark: SparkSession, sf: str) -> DataFrame:
    return ev.comparison_text(_comparison(spark, sf), "rule against lexicon")


def windowed_eval(spark: SparkSession, sf: str) -> DataFrame:
    evaluated = ev.windowed_evaluation(_lexicon_predictions(spark, sf), weight="weight")
    rounded = _rounded(evaluated, "accuracy", "avg_confidence")
    return _wall_clock(rounded, "window_start", "window_end")


def model_train_score(spark: SparkSession, sf: str) -> DataFrame:
    """The verdicts of the model of the built-in texts on every document."""
    content = tb.posts(_documents(spark, sf)).select("doc_id", F.col("title").alias("content"))
    scored = score_content(content, scorer=md.model_scorer(md.default_model(spark)))
    return _model_verdicts(scored.select("doc_id", "sentiment_result.*"))


def _model_verdicts(df: DataFrame) -> DataFrame:
    """Confidence to four digits: it is a fit's, which ends within a tolerance."""
    return df.withColumn("confidence", F.round("confidence", 4))


def model_hybrid_score(spark: SparkSession, sf: str) -> DataFrame:
    content = tb.posts(_documents(spark, sf)).select("doc_id", F.col("title").alias("content"))
    scored = score_content(content, scorer=md.hybrid_scorer(md.default_model(spark)))
    by_lexicon = F.size(lexicon_hits(F.col("cleaned_text"), cleaned=True)) > 0
    decided_by = F.when(by_lexicon, "lexicon").otherwise("model").alias("decided_by")
    return _model_verdicts(scored.select("doc_id", decided_by, "sentiment_result.*"))


def labelled_model_eval(spark: SparkSession, sf: str) -> DataFrame:
    """A model fitted on labelled documents, evaluated on the fifth of them held out.

    Its accuracy is held against always giving the most frequent class.
    """
    content = tb.posts(_documents(spark, sf)).select("doc_id", F.col("title").alias("content"))
    texts = clean_content(content).select("doc_id", F.col("cleaned_text").alias("text"))
    rows = texts.join(tb.labelled(tb.read_table(spark, sf, "labels")), "doc_id")
    held_out = F.col("doc_id") % 5 == 0
    model = md.train_on_sample(rows.filter(~held_out), "doc_id")
    scored = md.apply_model(model, rows.filter(held_out)).select("label", "prediction")
    report = ev.classification_report(ev.confusion_matrix(scored))
    # A row a class; the hits of a class are its recall times its support.
    everything = Window.partitionBy()
    hits = F.sum(F.round(F.col("recall") * F.col("support"))).over(everything)
    beats = hits >= F.max("support").over(everything)
    return report.select("class_id", "class_name", "support", beats.alias("beats_majority"))


# A bound on a micro-batch; nothing depends on which files meet in one.
FILES_PER_TRIGGER = 100


def _envelope_stream(spark: SparkSession, sf: str) -> DataFrame:
    return tb.all_envelopes(
        *[
            tb.stream_table(spark, sf, name, FILES_PER_TRIGGER, tb.spread_of(spark))
            for name in ("documents", "conversations")
        ]
    )


def _run_scoring(spark: SparkSession, sf: str, outcome: str) -> DataFrame:
    """Stream both tables through the scoring job once, into a folder for one outcome."""
    root = scratch_dir(spark, "stream-scoring")
    query = jobs.start_scoring(
        _envelope_stream(spark, sf),
        f"{root}/checkpoint",
        **{outcome: [land_in_directory(f"{root}/landed")]},
        now=fixed_now(),
        trigger=jobs.ONCE,
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/landed").drop(*BATCH_COLUMNS)


def stream_processed(spark: SparkSession, sf: str) -> DataFrame:
    landed = _run_scoring(spark, sf, "processed")
    return _wall_clock(_readable(landed), "processing_timestamp")


def stream_dlq(spark: SparkSession, sf: str) -> DataFrame:
    return _run_scoring(spark, sf, "dead")


def stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Windowed metrics of the stream, added up from the parts of its batches."""
    root = scratch_dir(spark, "stream-metrics")
    processed = processed_rows(route(_envelope_stream(spark, sf)), now=fixed_now())
    query = jobs.start_metrics(
        processed, f"{root}/checkpoint", f"{root}/parts", trigger=jobs.ONCE
    )
    query.awaitTermination()
    return _metrics_view(jobs.latest_metrics(spark, f"{root}/parts"))


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """First-seen posts and comments of a stream with repeats, by content type and id."""
    root = scratch_dir(spark, "stream-dedup")
    content = valid_content(parse_messages(_envelope_stream(spark, sf)))
    number = F.regexp_extract("id", "^c?([0-9]+)", 1).cast("bigint")
    query = jobs.start_landing(
        tb.repeated(content, number),
        f"{root}/checkpoint",
        jobs.land_first_seen(f"{root}/unique"),
        trigger=jobs.ONCE,
    )
    query.awaitTermination()
    return _readable(jobs.first_rows(spark, f"{root}/unique"))


def stream_top_engaging(spark: SparkSession, sf: str) -> DataFrame:
    """The most engaging posts of the stream, from the top ones of its batches."""
    root = scratch_dir(spark, "stream-top")
    processed = processed_rows(route(_envelope_stream(spark, sf)), now=fixed_now())
    query = jobs.start_landing(
        processed, f"{root}/checkpoint", jobs.land_top(f"{root}/parts"), trigger=jobs.ONCE
    )
    query.awaitTermination()
    return jobs.latest_top(spark, f"{root}/parts", "post")


def stream_windowed_eval(spark: SparkSession, sf: str) -> DataFrame:
    """``windowed_eval`` of a stream of verdicts and a stream of labels that come ten minutes later."""
    root = scratch_dir(spark, "stream-evaluation")
    spread = tb.spread_of(spark)
    verdicts = _verdicts(tb.stream_table(spark, sf, "documents", FILES_PER_TRIGGER, spread))
    labels = tb.labelled(tb.stream_table(spark, sf, "labels", FILES_PER_TRIGGER))
    labels = labels.withColumn(
        "label_timestamp", F.timestamp_seconds(F.lit(1704067200 + 600) + F.col("doc_id") * 60)
    )
    evaluation = live_evaluation(f"{root}/windows")
    query = evaluation.start(
        join_labels(verdicts, labels),
        f"{root}/checkpoint",
        land_in_directory(f"{root}/late"),
        trigger=jobs.ONCE,
    )
    query.awaitTermination()
    rounded = _rounded(evaluation.windows(spark), "accuracy", "avg_confidence")
    return _wall_clock(rounded, "window_start", "window_end")


QUERIES: dict[str, Query] = {
    "parse_posts": parse_posts,
    "parse_comments": parse_comments,
    "dlq_records": dlq_records,
    "dlq_preview": dlq_preview,
    "unified_content": unified_content,
    "extract_content": extract_content_by_type,
    "clean_text": clean_text_rows,
    "lexicon_sentiment": lexicon_sentiment_rows,
    "lexicon_sentiment_raw": lexicon_sentiment_raw,
    "lexicon_terms": lexicon_terms,
    "processed_content": processed_content,
    "result_preview": result_preview,
    "encode_processed": encode_processed,
    "encode_dlq": encode_dlq,
    "decode_processed": decode_processed_rows,
    "decode_dlq": decode_dlq,
    "listing_posts": listing_posts,
    "listing_comments": listing_comments,
    "listing_failures": listing_failures,
    "dedup_first_seen": dedup_first_seen,
    "publish_raw": publish_raw,
    "windowed_metrics": windowed_metrics,
    "windowed_metrics_content": windowed_metrics_content,
    "sentiment_by_group": sentiment_by_group,
    "top_engaging": top_engaging,
    "confusion_matrix": confusion_matrix,
    "eval_metrics": eval_metrics,
    "classification_report": classification_report,
    "classification_report_text": classification_report_text,
    "ab_compare": ab_compare,
    "ab_report_text": ab_report_text,
    "windowed_eval": windowed_eval,
    "model_train_score": model_train_score,
    "model_hybrid_score": model_hybrid_score,
    "labelled_model_eval": labelled_model_eval,
    "stream_processed": stream_processed,
    "stream_dlq": stream_dlq,
    "stream_dedup": stream_dedup,
    "stream_metrics": stream_metrics,
    "stream_top_engaging": stream_top_engaging,
    "stream_windowed_eval": stream_windowed_eval,
}
