"""First arrivals in a stream: order, verdicts, restart and expiry."""

import pytest
from pyspark.sql import functions as F

from corpusloom.streaming import arrivals as A

SCHEMA = "`_id` long, source string, `the.url` string, title string, publish_ts timestamp, at timestamp"


@pytest.fixture(scope="module")
def own(spark):
    session = spark.newSession()
    A.use_rocksdb(session)
    session.conf.set("spark.sql.shuffle.partitions", "1")
    return session


def land(own, path, rows):
    df = own.createDataFrame(rows, "i long, source string, url string, title string, day string, second int")
    at = F.lit("2024-06-21").cast("timestamp") + F.make_dt_interval(secs=F.col("second"))
    df = df.select("i", "source", "url", "title", F.col("day").cast("timestamp"), at)
    df.toDF("_id", "source", "the.url", "title", "publish_ts", "at").coalesce(1).write.mode("append").parquet(path)


def run(own, tmp_path, **options):
    stream = own.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    found = A.stream_first_articles(stream, key="_id", url="`the.url`", arrived="at", **options)
    assert found.columns == ["_id", "source", "the.url", "title", "publish_ts", "at", "verdict"]
    A.write_verdicts(found, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    return {r._id: r.verdict for r in own.read.parquet(str(tmp_path / "out")).select("_id", "verdict").collect()}


def test_order_verdicts_and_restart(own, tmp_path):
    day = "2024-06-20"
    land(own, str(tmp_path / "in"), [
        (9, "s", "http://a/1", "One", day, 0), (2, "s", "http://a/1?x", "Other", day, 2), (3, "s", "http://a/2", " one ", day, 3),
        (4, "s", "http://a/3", "Other", day, 4), (5, "s", None, None, day, 5), (6, "s", "http://a/4", "Late", "2024-01-01", 6),
        (7, "s", "http://a/5", "Undated", None, 7), (8, "t", "http://a/1", "One", day, 8), (None, "s", "http://b", "b", day, 9),
    ])
    first = {9: "first", 2: "repeat", 3: "repeat", 4: "first", 5: "first", 6: "late", 7: "undated", 8: "first", None: "first"}
    assert run(own, tmp_path) == first
    # after a restart the state still knows what came first; late and undated rows have left no trace
    land(own, str(tmp_path / "in"), [
        (1, "s", "http://a/1", "New", day, 0), (10, "s", "http://a/4", "late", day, 20), (11, "s", "http://a/5", "Undated", day, 20),
    ])
    assert run(own, tmp_path) == first | {1: "repeat", 10: "first", 11: "first"}
    back = A.read_verdicts(own, str(tmp_path / "out"), own.read.parquet(str(tmp_path / "in")).schema, A.LATE).collect()
    assert [r._id for r in back] == [6]


def test_state_expires(own, tmp_path):
    day = "2024-06-20"
    land(own, str(tmp_path / "in"), [(1, "s", "http://a/1", "One", day, 0), (2, "s", "http://a/1", "Two", day, 1)])
    assert run(own, tmp_path, ttl_days=1e-8) == {1: "first", 2: "repeat"}
    land(own, str(tmp_path / "in"), [(3, "s", "http://a/1", "One", day, 5)])
    assert run(own, tmp_path, ttl_days=1e-8)[3] == "first"


def test_many_keys_of_a_batch(own, tmp_path):
    """Thousands of keys take calls of a bucket each, not of a key, and ids of 64 bits stay exact beside a null one."""
    import time

    big, n = 2**60 + 1, 4_000
    rows = [(big + i, "s", f"http://a/{i // 2}", f"t{i // 2}", "2024-06-20", i % 2) for i in range(n)]
    land(own, str(tmp_path / "in"), [*rows, (None, "s", "http://b", "b", "2024-06-20", 3)])
    started = time.monotonic()
    found = run(own, tmp_path)
    assert time.monotonic() - started < 60  # a call per key took some 100 s
    assert found == {big + i: "repeat" if i % 2 else "first" for i in range(n)} | {None: "first"}
