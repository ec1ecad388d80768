"""Sessions of a stream against those of the table, with late rows and a restart; scratch tables."""

from datetime import datetime, timedelta
from pathlib import Path

from genoframe import scratch
from genoframe.streaming.sessions import sessions, write_sessions

SF = "/root/testdata/sf0.001"
SCHEMA = "user_id long, ts timestamp_ntz"
DAY = datetime(2024, 1, 1)


def plain(rows, gap=timedelta(minutes=30)):
    out = {}
    for user, at in sorted((u, t) for u, t in rows if t is not None):
        own = out.setdefault(user, [])
        if own and at - own[-1][1] <= gap:
            own[-1][1:] = [at, own[-1][2] + 1]
        else:
            own.append([at, at, 1])
    return sorted((u, *s) for u, found in out.items() for s in found)


def put(spark, rows, folder, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, folder, out, checkpoint):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)
    write_sessions(sessions(stream, ["user_id"]), out, checkpoint).awaitTermination(120)
    return sorted(tuple(r) for r in spark.read.parquet(out).collect())


def test_stream_gives_the_sessions_of_the_table(spark, tmp_path):
    rows = [(r.user_id, r.ts) for r in spark.read.parquet(f"{SF}/events.parquet").select("user_id", "ts").collect()]
    rows = sorted(rows, key=lambda r: r[1])[:120] + [(1, None)]
    assert sorted(tuple(r) for r in sessions(spark.createDataFrame(rows, SCHEMA), ["user_id"]).collect()) == plain(rows)
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    put(spark, rows[:60], folder, "a")
    first = run(spark, folder, out, checkpoint)
    assert first and len(first) < len(plain(rows[:60]))
    # The next files come to a query that starts anew; the last one's time closes all sessions before it.
    put(spark, rows[60:], folder, "b")
    run(spark, folder, out, checkpoint)
    put(spark, [(None, max(t for _, t in rows if t) + timedelta(days=2))], folder, "c")
    found = run(spark, folder, out, checkpoint)
    assert found == plain(rows)
    # An event that is later than the watermark allows changes nothing, and neither does starting again.
    put(spark, [(rows[0][0], rows[0][1] + timedelta(minutes=1))], folder, "d")
    assert run(spark, folder, out, checkpoint) == run(spark, folder, out, checkpoint) == found


def test_scratch_tables_are_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(scratch, "shared_folder", lambda _: f"file://{tmp_path}")
    rows = scratch.written(spark.range(10))
    own = Path(scratch.own_folder(spark).removeprefix("file://"))
    assert rows.count() == 10 and list(own.iterdir())
    scratch.clean_up(spark)
    assert not own.exists()
    scratch.clean_up(spark)
