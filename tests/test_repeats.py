import itertools
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from veriframe.streaming import repeats, streams


def write(spark, path, *batch):
    df = spark.createDataFrame(list(batch), "ts string, k string, u int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.coalesce(1).write.mode("append").parquet(path)


def run(result, tmp_path, name="out"):
    query = streams.run_to_files(result, str(tmp_path / name), str(tmp_path / f"{name}-offsets"))
    query.awaitTermination()
    return query


def found(spark, result, tmp_path, name="out"):
    out = spark.read.schema(result.schema).parquet(str(tmp_path / name))
    return rows(out.withColumns({c: F.date_format(c, "dd HH:mm:ss") for c in out.columns if c.endswith("_at") or c.startswith("window_")}))


def test_joined():
    assert repeats.joined([], (5, 5, 1), 2) == [(5, 5, 1)]
    assert repeats.joined([(0, 3, 2), (8, 9, 1)], (6, 6, 1), 2) == [(0, 3, 2), (6, 9, 2)]
    assert repeats.joined([(0, 4, 2), (8, 9, 1)], (6, 6, 1), 2) == [(0, 9, 4)]
    rng = random.Random(1)
    for _ in range(200):
        times, within = [rng.randint(0, 60) for _ in range(rng.randint(1, 12))], rng.randint(0, 9)
        got = []
        for t in times:
            got = repeats.joined(got, (t, t, 1), within)
        want = []
        for t in sorted(times):
            if want and t - want[-1][-1] <= within:
                want[-1].append(t)
            else:
                want.append([t])
        assert got == [(w[0], w[-1], len(w)) for w in want]


@pytest.fixture
def stream(spark, tmp_path):
    path = str(tmp_path / "in")
    write(spark, path, ("2024-01-01 00:59:59", "a", 1), ("2024-01-01 00:10:00", "b", 1), ("2024-01-01 00:20:00", None, 1), (None, "a", 1))
    write(spark, path, ("2024-01-01 01:00:00", "a", 1), ("2024-01-01 00:55:00", "a", 2), ("2024-01-01 00:30:00", None, 1), ("2024-01-01 00:19:00", "b", 1))
    write(spark, path, ("2024-01-01 05:00:00", "c", 1), ("2024-01-01 05:09:59", "c", 1), ("2024-01-01 05:20:00", "c", 1))
    write(spark, path, ("2024-01-01 00:11:00", "b", 1), ("2024-01-01 05:25:00", "d", 1))  # the first one long after the watermark
    return path, repeats.with_end(streams.stream_container(spark, path, 1), "ts", str(tmp_path / "end"))


def test_repeats_cross_window_edges_and_end(spark, stream, tmp_path):
    result = repeats.stream_repeats(stream[1], ["k", "u"], "ts", "10 minutes", "30 minutes")
    query = run(result, tmp_path)
    early = [("a", 1, "01 00:59:59", "01 01:00:00", 2), ("b", 1, "01 00:10:00", "01 00:19:00", 2)]
    assert found(spark, result, tmp_path) == early
    assert repeats.late_rows(query) == 1
    repeats.end_stream(spark, str(tmp_path / "end"))
    run(result, tmp_path)  # from its own offsets and state, as after a restart
    assert found(spark, result, tmp_path) == [*early, ("c", 1, "01 05:00:00", "01 05:09:59", 2)]
    run(result, tmp_path)
    assert len(found(spark, result, tmp_path)) == 3


def test_volume_of_an_ended_stream(spark, stream, tmp_path):
    result = streams.stream_volume(stream[1], "ts", "1 hour", "30 minutes")
    run(result, tmp_path)
    before = found(spark, result, tmp_path)
    repeats.end_stream(spark, str(tmp_path / "end"))
    run(result, tmp_path)
    got = found(spark, result, tmp_path)
    # The row of the last batch still meets an open window: windows close with the batch after the watermark has passed them.
    assert before == [("01 00:00:00", "01 01:00:00", 7), ("01 01:00:00", "01 02:00:00", 1)]
    assert got == [*before, ("01 05:00:00", "01 06:00:00", 4)]


def test_rows_in_any_order_equal_the_batch(spark, tmp_path):
    rng = random.Random(7)
    seconds = {k: [rng.randint(0, 20_000) for _ in range(40)] for k in "xyz"}
    flat = [(f"2024-01-01 {s // 3600:02}:{s // 60 % 60:02}:{s % 60:02}", k, 0) for k, ss in seconds.items() for s in ss]
    rng.shuffle(flat)
    for chunk in itertools.batched(flat, 30):
        write(spark, str(tmp_path / "in"), *chunk)
    live = repeats.with_end(streams.stream_container(spark, str(tmp_path / "in"), 1), "ts", str(tmp_path / "end"))
    result = repeats.stream_repeats(live, ["k"], "ts", "3 minutes", "10 hours")
    run(result, tmp_path)
    repeats.end_stream(spark, str(tmp_path / "end"))
    run(result, tmp_path)
    want = []
    for k, ss in seconds.items():
        chain = []
        for s in [*sorted(ss), 10**9]:
            if chain and s - chain[-1] > 180:
                if len(chain) > 1:
                    want.append((k, len(chain)))
                chain = []
            chain.append(s)
    got = spark.read.schema(result.schema).parquet(str(tmp_path / "out"))
    assert sorted((r.k, r.occurrences) for r in got.collect()) == sorted(want)


def test_refresh_of_intervals(spark):
    assert repeats._micros(spark, "10 minutes") == 600_000_000 and repeats._micros(spark, "1 day") == 86_400_000_000


def test_a_key_is_woken_once_a_batch(spark):
    """Of many stretches the earliest has a timer; it closes all that the watermark is past and waits for the next one."""
    calls, held = [], {}

    class Handle:
        def registerTimer(self, due):
            calls.append(("register", due))

        def deleteTimer(self, due):
            calls.append(("delete", due))

    class Open:
        def get(self):
            return held.get("v")

        def update(self, v):
            held["v"] = v

        def clear(self):
            held.clear()

    class At:
        def __init__(self, ms):
            self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: ms

    processor = repeats.Repeats(["k"], 5_000)
    processor.handle, processor.open = Handle(), Open()
    came = lambda ms: processor.handleInputRows(("a",), iter([{"_us": m * 1000, "_end": False} for m in ms]), At(0))
    came([*range(9_000, 0, -100), 50])  # 91 stretches
    came([50, 48])
    assert calls == [("register", 56)]
    out = list(processor.handleExpiredTimer(("a",), At(8_200), At(56)))
    assert [r["n"] for r in out] == [3] and calls == [("register", 56), ("register", 8_206)]
    assert held["v"][0][0] == 8_200_000 and len(held["v"][0]) == 9
    assert list(processor.handleExpiredTimer(("a",), At(20_000), At(8_206))) == [] and not held and len(calls) == 2


def test_many_rows_of_a_key_merge_in_chunks():
    rng = random.Random(3)
    times = [(t, t, 1) for t in rng.sample(range(10**6), 5_000)]
    one = []
    for t in times[:500]:
        one = repeats.joined(one, t, 90)
    assert one == repeats.merged(times[:500], 90) and sum(n for *_, n in repeats.merged(times, 90)) == 5_000
    chunked = []
    for some in itertools.batched(times, 64):
        chunked = repeats.merged([*chunked, *some], 90)
    assert chunked == repeats.merged(times, 90)
