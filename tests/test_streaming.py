"""Stream job: same answer as the batch filters, malformed rows rejected, replay-safe output."""

import os
import tempfile

import pytest

from fixture_rows import SF_SMALL
from smogmesh.sources.readings import readings_view
from smogmesh.streaming import feeds
from smogmesh.streaming import abnormal, alerts, read_feed, read_sensors, run_alerts, write_sensor_files


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_and_rejects_malformed_rows(spark):
    base = tempfile.mkdtemp(prefix="smogmesh-stream-test-")
    raw = readings_view(spark, SF_SMALL)
    write_sensor_files(raw, f"{base}/in", files=4)
    # A header line, a 20-column batch row and a blank pm10 in extra drops
    with open(f"{base}/in/part-99998-extra.csv", "w") as fh:
        fh.write("station_id,pm25,pm10,co2,no2,o3,timestamp\n")
        fh.write(",".join(["1"] * 20) + "\n")
    with open(f"{base}/in/part-99999-extra.csv", "w") as fh:
        fh.write("7,500,,400,20,30,1700000000000\n")  # N4: null index stays NORMALE
    q = run_alerts(
        read_sensors(spark, f"{base}/in", glob="part-*.csv", max_files=2),
        f"{base}/out",
        checkpoint=f"{base}/ckpt",
        trigger={"availableNow": True},
    )
    q.awaitTermination()
    batch = raw.select("station_id", "pm25", "pm10", "co2", "no2", "o3", "timestamp")
    assert _rows(read_feed(spark, f"{base}/out", "abnormal").drop("batch_id")) == _rows(abnormal(batch))
    assert _rows(read_feed(spark, f"{base}/out", "alerts").drop("batch_id")) == _rows(alerts(batch))
    rejected = spark.read.parquet(f"{base}/out/rejected").count()
    assert rejected == 2
    runs = [d for d in os.listdir(f"{base}/out/abnormal") if d.startswith("run=")]
    assert runs == [f"run={q.id}"]
    assert len([d for d in os.listdir(f"{base}/out/abnormal/{runs[0]}") if d.startswith("batch_id=")]) >= 2


def test_append_feed_to_parquet(spark):
    from smogmesh.streaming import start_feed

    base = tempfile.mkdtemp(prefix="smogmesh-feed-test-")
    raw = readings_view(spark, SF_SMALL)
    write_sensor_files(raw, f"{base}/in", files=3)
    stream = read_sensors(spark, f"{base}/in", glob="part-*.csv", max_files=1)
    q = start_feed(
        alerts(stream), path=f"{base}/out", checkpoint=f"{base}/ckpt", trigger={"availableNow": True}
    )
    q.awaitTermination()
    batch = raw.select("station_id", "pm25", "pm10", "co2", "no2", "o3", "timestamp")
    assert _rows(spark.read.parquet(f"{base}/out")) == _rows(alerts(batch))


def test_two_separate_queries(spark):
    from smogmesh.streaming import run_separate

    base = tempfile.mkdtemp(prefix="smogmesh-two-test-")
    raw = readings_view(spark, SF_SMALL)
    write_sensor_files(raw, f"{base}/in", files=2)
    stream = read_sensors(spark, f"{base}/in", glob="part-*.csv")
    qs = run_separate(stream, f"{base}/out", checkpoint=f"{base}/ckpt", trigger={"availableNow": True})
    for q in qs:
        q.awaitTermination()
    batch = raw.select("station_id", "pm25", "pm10", "co2", "no2", "o3", "timestamp")
    assert _rows(spark.read.parquet(f"{base}/out/abnormal")) == _rows(abnormal(batch))
    assert _rows(spark.read.parquet(f"{base}/out/alerts")) == _rows(alerts(batch))


def test_odd_rows_reach_the_feeds_and_are_reported(spark):
    base = tempfile.mkdtemp(prefix="smogmesh-stream-test-")
    os.makedirs(f"{base}/in")
    with open(f"{base}/in/sensor_1.csv", "w") as fh:
        fh.write("7,500,500,4000,500,500\n")  # no timestamp
        fh.write("8,500,500,4000,500,500,1700000000000,9\n")  # one field too many
        fh.write("9,500,500,4000,500,500,1700000000000\n")
    q = run_alerts(
        read_sensors(spark, f"{base}/in"), f"{base}/out", checkpoint=f"{base}/ckpt", trigger={"availableNow": True}
    )
    q.awaitTermination()
    for feed in ("abnormal", "alerts"):
        assert sorted(r["station_id"] for r in read_feed(spark, f"{base}/out", feed).collect()) == [7, 8, 9]
    assert spark.read.parquet(f"{base}/out/rejected").count() == 2


def test_new_checkpoint_keeps_older_output(spark):
    base = tempfile.mkdtemp(prefix="smogmesh-stream-test-")
    os.makedirs(f"{base}/in")
    with open(f"{base}/in/sensor_1.csv", "w") as fh:
        fh.write("9,500,500,4000,500,500,1700000000000\n")
    for ckpt in ("a", "b"):
        q = run_alerts(
            read_sensors(spark, f"{base}/in"), f"{base}/out", checkpoint=f"{base}/{ckpt}", trigger={"availableNow": True}
        )
        q.awaitTermination()
    assert len(os.listdir(f"{base}/out/alerts")) == 2


def _drops(spark, files):
    base = tempfile.mkdtemp(prefix="smogmesh-restart-test-")
    raw = readings_view(spark, SF_SMALL)
    write_sensor_files(raw, f"{base}/in", files=files)
    return base, raw.select("station_id", "pm25", "pm10", "co2", "no2", "o3", "timestamp")


@pytest.mark.parametrize("when", ["after the output", "before the output"])
def test_restart_after_a_batch_that_was_not_committed(spark, monkeypatch, when):
    """The job dies between a batch's output and its commit: the batch runs again and replaces its own output."""
    base, batch = _drops(spark, 4)
    plain, died = feeds._batch_writer, []

    def failing(out):
        write = plain(out)

        def once(rows, batch_id):
            if batch_id == 1 and not died:
                if when == "after the output":
                    write(rows, batch_id)
                died.append(batch_id)
                raise RuntimeError("the machine is gone")
            write(rows, batch_id)

        return once

    monkeypatch.setattr(feeds, "_batch_writer", failing)

    def run():
        stream = read_sensors(spark, f"{base}/in", glob="part-*.csv", max_files=1)
        q = run_alerts(stream, f"{base}/out", checkpoint=f"{base}/ckpt", trigger={"availableNow": True})
        q.awaitTermination()
        return q

    with pytest.raises(Exception, match="the machine is gone"):
        run()
    assert died == [1] and sorted(os.listdir(f"{base}/ckpt/commits")) == sorted([".0.crc", "0"])
    first = os.listdir(f"{base}/out/abnormal")
    q = run()
    assert os.listdir(f"{base}/out/abnormal") == first == [f"run={q.id}"]
    assert _rows(read_feed(spark, f"{base}/out", "abnormal")) == _rows(abnormal(batch))
    assert _rows(read_feed(spark, f"{base}/out", "alerts")) == _rows(alerts(batch))


def test_append_feed_restarts_after_a_lost_commit(spark):
    """The sink's file log knows the batch although the query's commit is gone: no row twice."""
    from smogmesh.streaming import start_feed

    base, batch = _drops(spark, 3)

    def run():
        stream = read_sensors(spark, f"{base}/in", glob="part-*.csv", max_files=1)
        start_feed(abnormal(stream), path=f"{base}/out", checkpoint=f"{base}/ckpt", trigger={"availableNow": True}).awaitTermination()
        return _rows(spark.read.parquet(f"{base}/out"))

    want = _rows(abnormal(batch))
    assert run() == want
    last = max(int(n) for n in os.listdir(f"{base}/ckpt/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        os.remove(f"{base}/ckpt/commits/{name}")
    assert run() == want


def test_new_drops_after_a_stop_are_read_once(spark):
    base, batch = _drops(spark, 2)
    for _ in range(2):
        stream = read_sensors(spark, f"{base}/in", glob="*.csv")
        run_alerts(stream, f"{base}/out", checkpoint=f"{base}/ckpt", trigger={"availableNow": True}).awaitTermination()
        with open(f"{base}/in/sensor_9.csv", "w") as fh:
            fh.write("9,500,500,4000,500,500,1700000000000\n")
    got = _rows(read_feed(spark, f"{base}/out", "alerts").select("station_id", "timestamp"))
    assert got == sorted([*_rows(alerts(batch).select("station_id", "timestamp")), (9, 1_700_000_000_000)])


def test_a_job_without_a_checkpoint_does_not_start(spark):
    base, _ = _drops(spark, 1)
    with pytest.raises(TypeError):
        run_alerts(read_sensors(spark, f"{base}/in"), f"{base}/out")
