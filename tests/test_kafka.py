"""Options only: neither the connector nor a broker is at hand."""

import pytest

from skytally.plans import jobs
from skytally.sources.kafka import reader_options, writer_options

PROPERTIES = {
    "bootstrap.servers": "b:9092", "group.id": "g", "auto.offset.reset": "earliest", "read-topic": "in",
    "write-topic": "out", "security.protocol": "SSL",
}


def test_reader_options():
    assert reader_options("in", PROPERTIES) == {
        "kafka.bootstrap.servers": "b:9092", "kafka.security.protocol": "SSL", "subscribe": "in",
        "startingOffsets": "earliest",
    }
    assert reader_options("in", PROPERTIES, "latest", 10)["maxOffsetsPerTrigger"] == "10"


def test_writer_options():
    assert writer_options("out", PROPERTIES) == {
        "kafka.bootstrap.servers": "b:9092", "kafka.security.protocol": "SSL", "topic": "out",
    }


def test_brokers_are_required():
    with pytest.raises(ValueError, match="bootstrap"):
        reader_options("in", {})
    with pytest.raises(ValueError, match="bootstrap"):
        writer_options("out", {})


def test_jobs_pass_offsets_on(monkeypatch):
    """Every job hands ``starting`` and ``max_offsets`` to the reader."""
    seen = []

    def read(spark, topic, properties, starting, max_offsets):
        seen.append((starting, max_offsets))
        raise RuntimeError("read")

    monkeypatch.setattr(jobs, "read_topic_stream", read)
    monkeypatch.setattr(jobs, "apply_conf", lambda spark: spark)
    monkeypatch.setattr(jobs, "register_functions", lambda spark: None)
    offsets = {"starting": "latest", "max_offsets": 7}
    for job, arguments in (
        (jobs.run_planes, ("t", "w", {}, "c")), (jobs.run_flights_hourly, ("t", "w", {}, "c")),
        (jobs.run_flights_tumbling, ("t", "w", {}, "c")), (jobs.run_nested, ("t", {}, "c")),
        (jobs.run_rejects, ("t", "icao", {}, "c", [])),
    ):
        with pytest.raises(RuntimeError, match="read"):
            job(None, *arguments, **offsets)
    assert seen == [("latest", 7)] * 5
