"""Documents to quote rows: sources, failed-poll skip, decode, unpivot, tag, concatenation."""

import json
import random
from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from cambio.operators.documents import (
    broker_entries,
    concat_by_name,
    rejected_quotes,
    split_by_status,
    tag_source,
    unpivot_quotes,
)
from cambio.schemas import DOCUMENT_SCHEMA
from cambio.sources.landing import (
    documents_of_poll,
    land_documents,
    read_document_files,
    read_documents,
    stream_document_files,
    stream_documents,
)

POLL = datetime(2024, 1, 28)


def documents(spark, *bodies, coin="btc", status=200):
    return spark.createDataFrame([(POLL, coin, status, body) for body in bodies], DOCUMENT_SCHEMA)


def quotes(spark, *bodies, **options):
    return [tuple(r) for r in unpivot_quotes(documents(spark, *bodies), **options).collect()]


def test_all_fields(spark):
    body = '{"fiwind":{"ask":1.5,"totalAsk":2,"bid":1,"totalBid":0.9,"time":1700000000}}'
    assert quotes(spark, body) == [("btc", "fiwind", 1.5, 2.0, 1.0, 0.9, 1700000000.0)]


def test_missing_field_is_null(spark):
    assert quotes(spark, '{"fiwind":{"totalAsk":2}}') == [("btc", "fiwind", None, 2.0, None, None, None)]


def test_one_row_per_key(spark):
    body = json.dumps({f"broker{i}": {"totalAsk": i} for i in range(50)})
    assert sorted((q[1], q[3]) for q in quotes(spark, body)) == sorted((f"broker{i}", float(i)) for i in range(50))


@pytest.mark.parametrize("body", ["{}", "null", " {} "])
def test_no_rows_keep_the_schema(spark, body):
    frame = unpivot_quotes(documents(spark, body))
    assert frame.columns == ["cripto", "broker", "ask", "totalAsk", "bid", "totalBid", "time"]
    assert frame.count() == 0


def test_one_bad_broker_does_not_cost_the_document(spark):
    body = '{"a":5,"b":{"totalAsk":7},"c":null,"d":"text","e":[1]}'
    assert [(q[1], q[3]) for q in quotes(spark, body)] == [("b", 7.0)]
    rejected = rejected_quotes(documents(spark, body)).collect()
    assert sorted((r.cripto, r.broker, r.quote) for r in rejected) == [
        ("btc", "a", "5"),
        ("btc", "c", "null"),
        ("btc", "d", "text"),
        ("btc", "e", "[1]"),
    ]


@pytest.mark.parametrize(
    "body",
    [
        "not json",
        "",
        None,
        "5",
        "[]",
        '[{"a":{}}]',
        '{"a":{"totalAsk":1}',
        '{"a":{"totalAsk":1}} xyz',
        '{"a":{"totalAsk":1}}{"b":{}}',
        '{"a":{}},{"b":{}}',
        "{'a':{'totalAsk':1}}",
    ],
)
def test_malformed_body_fails_the_job(spark, body):
    with pytest.raises(PySparkException, match="malformed quote document"):
        quotes(spark, '{"a":{"totalAsk":1}}', body)


def test_repeated_field_last_wins(spark):
    assert [q[3] for q in quotes(spark, '{"a":{"totalAsk":1,"x":0,"totalAsk":2}}')] == [2.0]


def test_repeated_key_last_wins(spark):
    assert [q[3] for q in quotes(spark, '{"a":{"totalAsk":1},"a":{"totalAsk":2}}')] == [2.0]
    many = "{" + ",".join(f'"k{i % 7}":{{"totalAsk":{i}}}' for i in range(100)) + "}"
    assert {q[1]: q[3] for q in quotes(spark, many)} == {f"k{i % 7}": float(i) for i in range(100)}
    assert broker_entries(documents(spark, many)).count() == 7


def test_number_texts(spark):
    body = '{"a":{"ask":"7.5","totalAsk":1e5,"bid":NaN,"totalBid":null,"time":1700000000.5}}'
    assert quotes(spark, body) == [("btc", "a", 7.5, 100000.0, None, None, 1700000000.5)]


def test_non_numeric_price_fails_the_job(spark):
    with pytest.raises(PySparkException, match="not a number in field totalBid"):
        quotes(spark, '{"a":{"totalBid":"abc"}}')


def test_extra_fields_survive(spark):
    body = '{"a":{"totalAsk":1,"spread":"x \\"y\\" ñ","deep":{"k":[1,2]}}}'
    row = unpivot_quotes(documents(spark, body), extra_fields=["spread", "deep", "none"]).first()
    assert (row.spread, row.deep, row.none) == ('x "y" ñ', '{"k":[1,2]}', None)


def test_status_split(spark):
    frame = spark.createDataFrame(
        [(POLL, "btc", 200, "{}"), (POLL, "eth", 500, "ignored"), (POLL, "dai", None, None)], DOCUMENT_SCHEMA
    )
    answered, failed = split_by_status(frame)
    assert [r.cripto_name for r in answered.collect()] == ["btc"]
    assert sorted(r.cripto_name for r in failed.collect()) == ["dai", "eth"]
    assert unpivot_quotes(answered).count() == 0


def test_concat_by_name(spark, rows):
    a = tag_source(spark.createDataFrame([("x", 1.0)], "broker string, totalAsk double"), "btc")
    b = tag_source(spark.createDataFrame([(2.0, "y"), (2.0, "y")], "totalBid double, broker string"), "eth")
    both = concat_by_name([a, b])
    assert both.columns == ["cripto", "broker", "totalAsk", "totalBid"]
    assert rows(both) == [("btc", "x", 1.0, None), ("eth", "y", None, 2.0), ("eth", "y", None, 2.0)]


def test_concat_of_nothing(spark):
    with pytest.raises(ValueError, match="every poll failed"):
        concat_by_name([])


def test_document_files(spark, tmp_path):
    for poll, coin, body in [
        ("2024-01-28 00%3A00%3A00", "btc", '{"a":{"totalAsk":1},\n "b":{"totalAsk":2}}'),
        ("2024-01-28 00%3A00%3A00", "eth", "{}"),
        ("2024-01-29 00%3A00%3A00", "btc", '{"a":{"totalAsk":3}}'),
    ]:
        folder = tmp_path / "landing" / f"poll_ts={poll}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{coin}.json").write_text(body)
    frame = read_document_files(spark, str(tmp_path / "landing"))
    assert frame.schema.fieldNames() == DOCUMENT_SCHEMA.fieldNames()
    got = unpivot_quotes(frame, ["poll_ts"]).select("poll_ts", "cripto", "broker", "totalAsk").collect()
    expected = [
        (datetime(2024, 1, 28), "btc", "a", 1.0),
        (datetime(2024, 1, 28), "btc", "b", 2.0),
        (datetime(2024, 1, 29), "btc", "a", 3.0),
    ]
    assert sorted(tuple(r) for r in got) == expected
    assert documents_of_poll(frame, datetime(2024, 1, 29)).count() == 1
    stream = stream_document_files(spark, str(tmp_path / "landing"))
    seen = []
    stream.writeStream.foreachBatch(lambda b, _: seen.extend(r.cripto_name for r in b.collect())).option(
        "checkpointLocation", str(tmp_path / "cp")
    ).trigger(availableNow=True).start().awaitTermination()
    assert sorted(seen) == ["btc", "btc", "eth"]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_landed_rows(spark, tmp_path, rows, fmt):
    path = str(tmp_path / fmt)
    frame = spark.createDataFrame(
        [(POLL, "btc", 200, '{"a":{"totalAsk":1}}'), (datetime(2024, 1, 29, 1, 2, 3), "eth", 500, None)], DOCUMENT_SCHEMA
    )
    land_documents(frame, path, fmt)
    back = read_documents(spark, path, fmt)
    assert rows(back) == rows(frame)
    pruned = documents_of_poll(back, POLL)
    assert "PartitionFilters: [isnotnull(poll_ts" in pruned._jdf.queryExecution().toString()
    assert pruned.count() == 1
    assert stream_documents(spark, path, fmt).isStreaming


def test_random_documents_equal_a_python_decode(spark, rows):
    """Whole random documents, repeated keys, odd values and missing fields included, against the json module."""
    r = random.Random(7)
    names = ["a", "b", "ñandú", 'quo"te', "x.y", ""]

    def number():
        return r.choice([r.randint(-5, 10**9), round(r.uniform(-9, 1e6), 3), r.random() * 1e-7, 1e15, None])

    def value():
        if r.random() < 0.2:
            return r.choice([5, None, "text", [1, 2], True])
        return {f: number() for f in ("ask", "totalAsk", "bid", "totalBid", "time", "other") if r.random() < 0.8}

    bodies = []
    for _ in range(200):
        entries = [f"{json.dumps(r.choice(names))}: {json.dumps(value())}" for _ in range(r.randint(0, 9))]
        bodies.append("{" + ", ".join(entries) + "}")
    expected = []
    for number_of, body in enumerate(bodies):
        for broker, quote in json.loads(body).items():
            if isinstance(quote, dict):
                fields = [quote.get(f) for f in ("ask", "totalAsk", "bid", "totalBid", "time")]
                expected.append((f"c{number_of}", broker, *[None if v is None else float(v) for v in fields]))
    frame = spark.createDataFrame([(POLL, f"c{i}", 200, body) for i, body in enumerate(bodies)], DOCUMENT_SCHEMA)
    assert rows(unpivot_quotes(frame)) == sorted(expected, key=repr)
