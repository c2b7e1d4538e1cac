"""Fixed schemas. Nothing is ever inferred from data."""

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# A message as the bus hands it over; readers add ``content_type``.
ENVELOPE = _schema(key=T.BinaryType(), value=T.BinaryType(), timestamp=T.TimestampType())

TYPED_ENVELOPE = T.StructType([*ENVELOPE.fields, T.StructField("content_type", T.StringType())])

POST = _schema(
    id=T.StringType(),
    title=T.StringType(),
    author=T.StringType(),
    subreddit=T.StringType(),
    score=T.IntegerType(),
    created_utc=T.LongType(),
)

COMMENT = _schema(
    id=T.StringType(),
    body=T.StringType(),
    author=T.StringType(),
    subreddit=T.StringType(),
    score=T.IntegerType(),
    created_utc=T.LongType(),
    parent_id=T.StringType(),
)

# Posts and comments in one shape.
CONTENT = _schema(
    kafka_key=T.BinaryType(),
    kafka_timestamp=T.TimestampType(),
    content_type=T.StringType(),
    id=T.StringType(),
    content=T.StringType(),
    parent_id=T.StringType(),
    author=T.StringType(),
    subreddit=T.StringType(),
    score=T.IntegerType(),
    created_utc=T.LongType(),
)

SENTIMENT = T.StructType(
    [
        T.StructField("sentiment", T.StringType(), False),
        T.StructField("sentiment_score", T.DoubleType(), False),
        T.StructField("confidence", T.DoubleType(), False),
    ]
)

# A scored record as published and landed.
PROCESSED = _schema(
    id=T.StringType(),
    original_content=T.StringType(),
    cleaned_text=T.StringType(),
    content_type=T.StringType(),
    author=T.StringType(),
    subreddit=T.StringType(),
    score=T.IntegerType(),
    created_utc=T.LongType(),
    parent_id=T.StringType(),
    sentiment=T.StringType(),
    sentiment_score=T.DoubleType(),
    confidence=T.DoubleType(),
    text_length=T.IntegerType(),
    engagement_score=T.IntegerType(),
    processing_timestamp=T.TimestampType(),
    model_version=T.StringType(),
)

DEAD_LETTER = _schema(
    original_message=T.StringType(),
    error_type=T.StringType(),
    error_message=T.StringType(),
    timestamp=T.LongType(),
    retry_count=T.IntegerType(),
    topic=T.StringType(),
)

# ``label`` and ``prediction`` are class ids: 0 negative, 1 neutral, 2 positive.
PREDICTIONS = _schema(label=T.DoubleType(), prediction=T.DoubleType())

TRAINING = _schema(label=T.IntegerType(), text=T.StringType())

CLASS_NAMES = ("Negative", "Neutral", "Positive")
