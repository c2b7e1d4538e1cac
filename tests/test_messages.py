"""JSON coercion of bus messages, row by row."""

from datetime import datetime

import pytest

from textpulse.operators.routing import parse_failures, parse_messages, valid_content
from textpulse.schemas import CONTENT, TYPED_ENVELOPE

AT = datetime(2024, 1, 1)
REST = '"title":"t","author":"a","subreddit":"s","created_utc":9007199254740993'

# Message, and (id, content, author, score) or None for an invalid one.
POSTS = [
    ("not json", None),
    ("", None),
    (None, None),
    ('[{"id":"1"}]', None),
    ('"text"', None),
    ("7", None),
    (f'{{"id":"1",{REST},"score":3}}', ("1", "t", "a", 3)),
    (f'{{"id":"1",{REST}}}', ("1", "t", "a", 0)),
    ('{"id":"1","title":"t","author":null,"score":null}', ("1", "t", "", 0)),
    (f'{{"ID":"1",{REST}}}', None),
    (f'{{"id":"1",{REST},"score":3.7}}', ("1", "t", "a", 3)),
    (f'{{"id":"1",{REST},"score":1e3}}', ("1", "t", "a", 1000)),
    (f'{{"id":"1",{REST},"score":-2}}', ("1", "t", "a", -2)),
    (f'{{"id":"1",{REST},"score":"7"}}', ("1", "t", "a", 0)),
    (f'{{"id":"1",{REST},"score":true}}', ("1", "t", "a", 0)),
    (f'{{"id":"1",{REST},"score":99999999999}}', ("1", "t", "a", 0)),
    (f'{{"id":12,{REST}}}', ("12", "t", "a", 0)),
    (f'{{"id":1.5,{REST}}}', ("1.5", "t", "a", 0)),
    (f'{{"id":true,{REST}}}', None),
    (f'{{"id":"",{REST}}}', None),
    ('{"id":"1","title":{"x":1}}', None),
    ('{"id":"1","title":["x"]}', None),
    ('{"id":"1","title":""}', None),
    (f'{{"id":"1","id":"2",{REST}}}', None),
    (f'{{"id":"1",{REST}}} trailing', ("1", "t", "a", 0)),
    ('{"id":"1","title":"[deleted]"}', ("1", "[deleted]", "", 0)),
    ('{"id":"1","body":"b"}', None),
]
COMMENTS = [
    ('{"id":"1","body":"b","parent_id":"p"}', ("1", "b", "", 0)),
    ('{"id":"1","body":"[deleted]"}', None),
    ('{"id":"1","body":"[removed]"}', None),
    ('{"id":"1","body":"[deleted] "}', ("1", "[deleted] ", "", 0)),
    ('{"id":"1","title":"t"}', None),
]


def envelopes(spark, messages, kind):
    rows = [
        (bytearray(str(n), "utf-8"), None if m is None else bytearray(m, "utf-8"), AT, kind)
        for n, m in enumerate(messages)
    ]
    return spark.createDataFrame(rows, TYPED_ENVELOPE)


@pytest.mark.parametrize("kind, cases", [("post", POSTS), ("comment", COMMENTS)])
def test_coercion(spark, kind, cases):
    parsed = parse_messages(envelopes(spark, [message for message, _ in cases], kind))
    got = {int(row.kafka_key): row.parsed for row in parsed.collect()}
    for n, (message, expected) in enumerate(cases):
        found = got[n]
        actual = found and (found.id, found.content, found.author, found.score)
        assert actual == expected, message


def test_valid_rows_have_the_content_schema(spark):
    message = '{"id":"1","body":"b","parent_id":"p","created_utc":9007199254740993}'
    content = valid_content(parse_messages(envelopes(spark, [message], "comment")))
    assert [(f.name, f.dataType) for f in content.schema] == [
        (f.name, f.dataType) for f in CONTENT
    ]
    row = content.first()
    assert (row.parent_id, row.created_utc, row.content_type) == ("p", 2**53 + 1, "comment")


def test_failures_keep_the_raw_message(spark):
    parsed = parse_messages(
        envelopes(spark, ["x"], "post").unionByName(envelopes(spark, ["y"], "comment"))
    )
    got = {tuple(row) for row in parse_failures(parsed).collect()}
    assert got == {
        ("x", "JSONParseError", "Invalid Post JSON", "posts"),
        ("y", "JSONParseError", "Invalid Comment JSON", "comments"),
    }
