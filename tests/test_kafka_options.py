"""What readers of topics and the jobs tell Kafka; no broker is needed to see that."""

import json

import pytest

from tickloom.plans import jobs
from tickloom.sources.kafka import topic_options


def test_live_jobs_start_at_the_end_and_replays_at_the_beginning():
    live = topic_options("broker:9092", "coinbase.trades")
    assert live["startingOffsets"] == "latest" and "kafka.group.id" not in live
    assert live["subscribe"] == "coinbase.trades"
    assert live["kafka.bootstrap.servers"] == "broker:9092"
    replay = topic_options("broker:9092", "t", start="earliest", group="bars")
    assert replay["startingOffsets"] == "earliest" and replay["kafka.group.id"] == "bars"


def test_jobs_take_start_group_and_writer_schema():
    schema = {"trade": json.dumps({"type": "record", "name": "Trade", "fields": []})}
    args = jobs.parse([
        "bars", "--work", "w", "--start", "earliest", "--group", "bars-1",
        "--writer-schema", json.dumps(schema),
    ])
    assert (args.start, args.group, args.writer_schema) == ("earliest", "bars-1", schema)
    plain = jobs.parse(["bars", "--work", "w"])
    assert (plain.start, plain.group, plain.writer_schema) == ("latest", None, {})
    with pytest.raises(SystemExit):
        jobs.parse(["bars", "--work", "w", "--start", "yesterday"])


def test_each_query_of_a_job_keeps_its_own_offsets(spark, tmp_path):
    for feed in ("trades", "ticker", "oracle"):
        (tmp_path / "raw" / feed).mkdir(parents=True)
    args = jobs.parse(["ingest", "--work", str(tmp_path / "w"), "--files", str(tmp_path / "f"),
                       "--raw", str(tmp_path / "raw"), "--once"])
    for query in jobs.start(spark, args):
        query.awaitTermination()
    kept = {p.parent.name for p in tmp_path.glob("w/checkpoint/*/metadata")}
    assert kept == {"trades", "ticker", "oracle"}
