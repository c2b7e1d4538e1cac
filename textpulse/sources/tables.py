"""The given tables as bus messages, listings, processed records and predictions.

The SQL texts run unchanged in Spark and in the oracle's engine; ``{documents}`` and the
like name the input table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse.session import pin_utc

# Decoration makes every text rule and both word lists apply to some rows.
POSTS = """
select doc_id, cast(doc_id as string) as id,
  text || case when doc_id % 5 = 0
      then ' https://ex.com/a?b=c#frag or/and /r/tech u/bob [deleted] IMO TL;DR [EDIT: x]'
      else '' end
    || case when doc_id % 7 = 0 then ' great love' else '' end
    || case when doc_id % 11 = 0 then ' awful hate bad' else '' end as title,
  'user' || cast(doc_id % 50 as string) as author, source as subreddit,
  cast(n_chars % 1000 as int) as score, 1704067200 + doc_id * 60 as created_utc
from {documents}
"""

COMMENTS = """
select conv_id, turn,
  'c' || cast(conv_id as string) || '_' || cast(turn as string) as id,
  case when (conv_id + turn) % 13 = 0 then '[deleted]'
       when (conv_id + turn) % 13 = 1 then '[removed]'
       else text || case when conv_id % 3 = 0 then ' best imho, see http://x.io/~a' else '' end
  end as body,
  role || cast(conv_id % 20 as string) as author,
  'src' || cast(conv_id % 20 as string) as subreddit,
  cast(length(text) % 100 as int) as score,
  1704067200 + conv_id * 600 + turn * 30 as created_utc,
  case when turn = 0 then 't3_' || cast(conv_id as string)
       else 't1_c' || cast(conv_id as string) || '_' || cast(turn - 1 as string) end as parent_id
from {conversations}
"""

EVENT_RECORDS = """
select cast(event_id as string) id,
  case when event_type in ('click', 'view') then 'post' else 'comment' end content_type,
  event_type subreddit, 'user' || cast(user_id as string) author,
  case event_id % 3 when 0 then 'positive' when 1 then 'negative' else 'neutral' end sentiment,
  case event_id % 3 when 0 then cast(0.8 as double) when 1 then cast(0.2 as double)
    else cast(0.5 as double) end sentiment_score,
  cast(0.6 as double) + (event_id % 8) * cast(0.05 as double) confidence,
  cast(floor(value) as int) engagement_score, cast(event_id % 500 as int) text_length,
  ts processing_timestamp
from {events}
"""

PREDICTIONS = """
select l.doc_id,
  cast(case when toxic = 1 then 0 when quality = 0 then 1 else 2 end as double) label,
  cast((l.doc_id * 7 + quality) % 3 as double) prediction
from {labels} l join {documents} d on l.doc_id = d.doc_id
"""


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(table_path(sf_dir, name))


SPREAD_CONF = "spark.textpulse.spread"


def read_texts(
    spark: SparkSession, sf_dir: str, name: str, spread: int | None = None
) -> DataFrame:
    """A table whose texts will be cleaned or parsed.

    It is read where it lies, without a shuffle. For a table of one small file the caller may
    ask for a ``spread`` over so many tasks first.
    """
    table = read_table(spark, sf_dir, name)
    return table.repartition(spread) if spread else table


def spread_of(spark: SparkSession) -> int | None:
    """The spread that a session sets for its small tables; none by default."""
    found = spark.conf.get(SPREAD_CONF, None)
    return int(found) if found else None


def stream_table(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    max_files_per_trigger: int | None = None,
    spread: int | None = None,
) -> DataFrame:
    """The table as a stream of its files, in no order of time, spread as in ``read_texts``."""
    table = read_table(spark, sf_dir, name)
    reader = spark.readStream.schema(table.schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # A stream takes a folder or a pattern. The pattern matches just this name, whether it is a
    # folder of files or one file.
    stream = reader.parquet(f"{sf_dir}/{name}.parque[t]")
    return stream.repartition(spread) if spread else stream


def posts(documents: DataFrame) -> DataFrame:
    return documents.sparkSession.sql(POSTS, documents=documents)


def comments(conversations: DataFrame) -> DataFrame:
    return conversations.sparkSession.sql(COMMENTS, conversations=conversations)


def event_records(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(EVENT_RECORDS, events=events)


def predictions(labels: DataFrame, documents: DataFrame) -> DataFrame:
    """Row by row; for large tables see ``weighted_predictions``."""
    return labels.sparkSession.sql(PREDICTIONS, labels=labels, documents=documents)


def weighted_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The inner join with equal rows aggregated on both sides first; ``weight`` counts them.

    A key with many copies on both sides then makes one pair per distinct combination. A
    side that has a ``weight`` already keeps it.
    """

    def counted(side: DataFrame, name: str) -> DataFrame:
        rows = F.sum("weight") if "weight" in side.columns else F.count(F.lit(1))
        return side.groupBy(*[c for c in side.columns if c != "weight"]).agg(rows.alias(name))

    joined = counted(left, "_left").join(counted(right, "_right"), key)
    return joined.withColumn("weight", F.col("_left") * F.col("_right")).drop("_left", "_right")


# The two columns of ``PREDICTIONS`` without its join.
LABEL = "cast(case when toxic = 1 then 0 when quality = 0 then 1 else 2 end as double) as label"
RULE = "cast((doc_id * 7 + quality) % 3 as double) as prediction"


def labelled(labels: DataFrame) -> DataFrame:
    return labels.selectExpr("doc_id", LABEL)


def weighted_predictions(labels: DataFrame, documents: DataFrame) -> DataFrame:
    """``PREDICTIONS`` with equal rows counted in ``weight``."""
    return weighted_join(
        labels.selectExpr("doc_id", LABEL, RULE), documents.select("doc_id"), "doc_id"
    )


def _envelope(value: Column, content_type: str) -> list[Column]:
    return [
        F.encode(F.col("id"), "utf-8").alias("key"),
        F.encode(value, "utf-8").alias("value"),
        F.timestamp_seconds("created_utc").alias("timestamp"),
        F.lit(content_type).alias("content_type"),
    ]


def post_envelopes(documents: DataFrame) -> DataFrame:
    """Posts as messages, four in seventeen of them damaged in different ways."""
    damage = F.col("doc_id") % 17
    message = F.to_json(
        F.struct(
            F.when(damage == 2, "").otherwise(F.col("id")).alias("id"),
            F.when(damage != 1, F.col("title")).alias("title"),
            "author",
            "subreddit",
            F.when(damage != 3, F.col("score")).alias("score"),
            "created_utc",
        )
    )
    value = F.when(damage == 0, "not json").otherwise(message)
    return posts(documents).select(*_envelope(value, "post"))


def comment_envelopes(conversations: DataFrame) -> DataFrame:
    """Comments as messages, two in seventeen of them damaged."""
    damage = (F.col("conv_id") * 8 + F.col("turn")) % 17
    message = F.to_json(
        F.struct(
            "id",
            F.when(damage != 1, F.col("body")).alias("body"),
            "author",
            "subreddit",
            "score",
            "created_utc",
            "parent_id",
        )
    )
    value = F.when(damage == 0, '{"id":').otherwise(message)
    return comments(conversations).select(*_envelope(value, "comment"))


def all_envelopes(documents: DataFrame, conversations: DataFrame) -> DataFrame:
    return post_envelopes(documents).unionByName(comment_envelopes(conversations))


def repeated(content: DataFrame, number: Column) -> DataFrame:
    """Rows with ``number`` divisible by 4 twice, the copy 30 seconds later."""
    delays = F.when(number % 4 == 0, F.array(F.lit(0), F.lit(30))).otherwise(F.array(F.lit(0)))
    kept = [name for name in content.columns if name != "kafka_timestamp"]
    return content.withColumn("_delay", F.explode(delays)).select(
        *kept,
        F.timestamp_seconds(F.unix_timestamp("kafka_timestamp") + F.col("_delay")).alias(
            "kafka_timestamp"
        ),
    )


def _listing(children: list[Column], unreadable: Column) -> Column:
    # One listing per source row: it never has more than a few children.
    wrapped = F.array(*[F.struct(child.alias("data")) for child in children])
    listing = F.to_json(F.struct(F.struct(wrapped.alias("children")).alias("data")))
    return F.when(unreadable, "not json").otherwise(listing).alias("value")


def post_listings(documents: DataFrame) -> DataFrame:
    """Per document a listing of its post and of a second post that may lack a field."""
    number = F.col("doc_id")
    first = F.struct("id", "title", "author", "subreddit", "score", "created_utc")
    second = F.struct(
        F.concat(F.lit("x"), F.col("id")).alias("id"),
        F.when(number % 6 != 0, F.col("title")).alias("title"),
        "author",
        "subreddit",
        F.when(number % 6 != 1, F.col("score")).alias("score"),
        "created_utc",
    )
    return posts(documents).select(
        _listing([first, second], number % 17 == 0),
        F.timestamp_seconds("created_utc").alias("timestamp"),
    )


def comment_listings(conversations: DataFrame) -> DataFrame:
    """Per turn a listing of its comment and of a second one that may lack a field."""
    number = F.col("conv_id") * 8 + F.col("turn")
    first = F.struct("id", "body", "author", "subreddit", "score", "created_utc", "parent_id")
    second = F.struct(
        F.concat(F.lit("x"), F.col("id")).alias("id"),
        F.when(number % 6 != 0, F.col("body")).alias("body"),
        F.when(number % 6 != 1, F.col("author")).alias("author"),
        "subreddit",
        "score",
        "created_utc",
        F.when(number % 6 != 2, F.col("parent_id")).alias("parent_id"),
    )
    return comments(conversations).select(
        _listing([first, second], number % 17 == 0),
        F.timestamp_seconds("created_utc").alias("timestamp"),
    )
