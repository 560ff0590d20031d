"""Landing by deltas, the stream that keeps the last payloads, and gaps in what has landed."""

import json
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from obsflow.functions.times import minute_bucket, with_hour_bucket
from obsflow.operators import gaps
from obsflow.sinks import deltas
from obsflow.streaming.latest import set_aside_corrupt, stream_latest

SCHEMA = "city string, method string, ts timestamp_ntz, v int"


def payloads(spark, *data):
    """(city, hour, minute, v) of the first of January; a day is 24 hours on."""
    made = [(c, "current" if c != "x" else "", datetime(2024, 1, 1) + timedelta(hours=h, minutes=m), v) for c, h, m, v in data]
    return spark.createDataFrame(made, SCHEMA)


def minutes(spark, path):
    return deltas.minute_landing(spark, str(path), payloads(spark).schema, ts="ts", tie=["v"])


def stored(folder: Path) -> dict[str, int]:
    return {str(f): f.stat().st_size for f in folder.rglob("*.parquet")}


def test_batches_in_any_order_and_compaction(spark, tmp_path):
    rng = random.Random(3)
    data = [(rng.choice("abx"), rng.randrange(60), rng.randrange(3), v) for v in range(300)]
    batches = [data[k::6] for k in range(6)]
    last = {}
    for c, h, m, v in sorted(data, key=lambda r: r[3]):
        last[c, h, m] = v
    expected = sorted((c, None if c == "x" else "current", h % 24, v) for (c, h, m), v in last.items())
    for run in range(2):
        rng.shuffle(batches)
        landing = minutes(spark, tmp_path / f"land{run}")
        assert landing.table.read().count() == 0 and landing.table.compact(datetime(2025, 1, 1)) == 0
        for k, batch in enumerate([*batches, batches[0]]):
            landing.land(payloads(spark, *batch))
            if k == 3:
                assert landing.table.compact(datetime(2024, 1, 2, 5), most=1) == 1  # the first day of one method
        read = lambda: sorted((r.city, r.method, r.hour, r.v) for r in landing.table.read().collect())
        assert sorted(read(), key=repr) == sorted(expected, key=repr)
        while landing.table.compact(datetime(2025, 1, 1), most=2):
            assert sorted(read(), key=repr) == sorted(expected, key=repr)
        assert landing.table.deltas.count() == 0
        assert landing.table.base.count() == len(expected)


def test_a_minute_writes_its_own_bytes_only(spark, tmp_path):
    landing = minutes(spark, tmp_path / "land")
    written = []
    for m in range(30):
        before = stored(tmp_path)
        landing.land(payloads(spark, *[(c, 3, m, m) for c in "abcdef"]))
        after = stored(tmp_path)
        assert {f: n for f, n in after.items() if f in before} == before
        written.append(sum(after.values()) - sum(before.values()))
    assert max(written) <= 1.2 * min(written)
    assert landing.table.read().count() == 180


def test_compaction_leaves_open_hours_and_late_files_alone(spark, tmp_path):
    landing = deltas.hour_landing(spark, str(tmp_path / "land"), payloads(spark).schema, ts="ts", tie=["v"])
    landing.land(payloads(spark, ("a", 1, 0, 1), ("b", 2, 0, 2), ("a", 3, 0, 3)))
    assert landing.table.compact(datetime(2024, 1, 1, 3)) == 2
    assert rows(landing.table.deltas.select("hour")) == [(3,)]
    landing.land(payloads(spark, ("a", 1, 30, 4), ("c", 1, 0, 5)))  # late, into a compacted hour
    got = lambda: rows(landing.table.read().select("city", "hour", "v"))
    assert got() == [("a", 1, 4), ("a", 3, 3), ("b", 2, 2), ("c", 1, 5)]
    crashed = stored(tmp_path / "land/deltas")
    kept = {f: Path(f).read_bytes() for f in crashed}
    assert landing.table.compact(datetime(2024, 1, 1, 3)) == 1
    for f, raw in kept.items():  # as if the run had ended before its files were removed
        Path(f).parent.mkdir(parents=True, exist_ok=True)
        Path(f).write_bytes(raw)
    assert got() == [("a", 1, 4), ("a", 3, 3), ("b", 2, 2), ("c", 1, 5)]
    assert rows(landing.table.read(F.col("hour") == 1).select("city")) == [("a",), ("c",)]
    assert "PartitionFilters: [isnotnull(hour" in plan(landing.table.read(F.col("hour") == 1))


def test_stream_keeps_the_last_payload(spark, tmp_path):
    drops, marks = tmp_path / "drops", str(tmp_path / "marks")
    drops.mkdir()
    schema = payloads(spark).schema
    landing = deltas.hour_landing(spark, str(tmp_path / "latest"), schema, ts="ts", tie=["v"])
    plan_ = lambda r: with_hour_bucket(r, F.col("method"), F.col("ts")).withColumn("minute_bucket", minute_bucket(F.col("ts")))

    def drop(name, *data):
        lines = [json.dumps({"city": c, "method": "m", "ts": f"2024-01-01T{h:02}:{m:02}:00", "v": v}) for c, h, m, v in data]
        (drops / name).write_text("\n".join(lines) + "\n")

    run = lambda marks=marks: stream_latest(spark, str(drops), schema, landing.table, marks, plan=plan_, arrivals="1 second", delay="0 seconds", multi_line=False)
    got = lambda: rows(landing.table.read().select("city", "hour", "v"))
    drop("1.json", ("a", 5, 10, 1), ("b", 9, 0, 2), ("a", 5, 20, 3))
    run()
    assert got() == [("a", 5, 3), ("b", 9, 2)]
    before = stored(tmp_path / "latest")
    run()
    assert stored(tmp_path / "latest") == before
    drop("2.json", ("a", 5, 15, 4), ("a", 1, 0, 5))  # an older payload of the hour, and an hour long past
    (drops / "3.json").write_text('{torn\n')
    run()
    assert got() == [("a", 1, 5), ("a", 5, 3), ("b", 9, 2)]
    drop("4.json", ("a", 5, 10, 1), ("b", 9, 0, 6), ("a", 5, 59, 7))  # repeated, tied, later
    run()
    run(str(tmp_path / "other-marks"))  # everything once more, as after a lost checkpoint
    assert got() == [("a", 1, 5), ("a", 5, 7), ("b", 9, 6)]
    for _ in range(2):
        set_aside_corrupt(spark, str(drops), schema, str(tmp_path / "aside"), str(tmp_path / "aside-marks"), multi_line=False)
    assert [r.file.endswith("3.json") for r in spark.read.parquet(str(tmp_path / "aside")).collect()] == [True]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_gaps_against_brute_force(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    rng = random.Random(11)
    first, last = datetime(1969, 12, 28, 7), datetime(1970, 1, 12, 15)
    n = int((last - first).total_seconds() // 3600) + 1
    requests = [("m", "a"), ("m", "b"), (None, "c"), ("m", "never"), ("m", "always")]
    landed = [("m", "b", first + timedelta(hours=h)) for h in (0, 1, n - 1)] + [("m", "always", first + timedelta(hours=h)) for h in range(-3, n + 3)]
    landed += [(m, c, first + timedelta(hours=rng.randrange(-80, n + 80), minutes=rng.randrange(60))) for m, c in requests[:3] for _ in range(250)]
    landed += [("m", "unasked", first), ("m", "a", None)]
    there = {(m, c, t.replace(minute=0)) for m, c, t in landed if t}
    expected = []
    for m, c in requests:
        run = []
        for h in range(n + 1):
            t = first + timedelta(hours=h)
            if h < n and (m, c, t) not in there:
                run.append(t)
            elif run:
                expected.append((m, c, run[0], run[-1], len(run)))
                run = []
    frame = spark.createDataFrame(landed, "method string, city string, ingest_ts timestamp_ntz")
    grid = spark.createDataFrame(requests + requests[:1], "method string, city string")
    bitmaps = gaps.merge_bitmaps(gaps.hour_bitmaps(frame.where("minute(ingest_ts) < 30")).union(gaps.hour_bitmaps(frame.where("minute(ingest_ts) >= 30"))))
    assert rows(gaps.missing_spans(grid, bitmaps, first, last)) == sorted(expected, key=repr)
    whole = rows(gaps.missing_spans(grid, bitmaps.limit(0), first, last))
    assert whole == sorted([(m, c, first, last, n) for m, c in requests], key=repr)
    assert "Python" not in plan(gaps.missing_spans(grid, bitmaps, first, last))
