"""Sessions with timers against a batch computation, on late, repeated and out-of-order events."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from sparklab.streaming import stateful

T0 = dt.datetime(2024, 1, 1)


def plain(rows, gap):
    """Sessions of distinct events by sorting each key's times: (key, start, end, arrivals)."""
    by = {}
    for k, t, e in rows:
        if k is not None:
            by.setdefault(k, {}).setdefault(e, t)
    out = []
    for k, events in by.items():
        times = sorted(events.values())
        run = [times[0]]
        for t in times[1:]:
            if (t - run[-1]).total_seconds() >= gap:
                out.append((k, run[0], run[-1] + dt.timedelta(seconds=gap), len(run)))
                run = []
            run.append(t)
        out.append((k, run[0], run[-1] + dt.timedelta(seconds=gap), len(run)))
    return sorted(out)


def test_merging_equals_sorting():
    r = random.Random(0)
    for _ in range(200):
        rows = [(r.randrange(400), f"e{k}") for k in range(r.randint(1, 25))]
        rows += r.choices(rows, k=3)
        r.shuffle(rows)
        opened = []
        for at, e in rows:
            opened = stateful.merged(opened, at, e, 20)
        want = plain([("k", T0 + dt.timedelta(seconds=t), e) for t, e in rows], 20)
        assert [(s[0], s[1], len(s[2])) for s in opened] == [(int((a - T0).total_seconds()), int((b - T0).total_seconds()) - 20, n) for _, a, b, n in want]
        assert sum(s[3] for s in opened) == 3


def test_stream_equals_batch_and_forgets_closed_keys(spark, tmpdir_path):
    stateful.use_rocksdb(spark)
    try:
        r = random.Random(7)
        rows = []
        for k in range(6):
            t = 0
            for n in range(25):
                t += r.choice([60, 300, 900, 4000])
                rows.append((f"k{k}", T0 + dt.timedelta(seconds=t), f"{k}-{n}"))
        rows.sort(key=lambda x: x[1])
        # out of order by some places, repeats, and a key that is not set
        order = sorted(range(len(rows)), key=lambda i: i + r.uniform(0, 6))
        sent = [rows[i] for i in order]
        sent = [x for y in sent for x in ([y, y] if r.random() < 0.2 else [y])] + [(None, T0, "none")]
        src = os.path.join(tmpdir_path, "in")
        for n, k in enumerate(range(0, len(sent), 30)):
            spark.createDataFrame(sent[k : k + 30], "user string, at timestamp, event string").coalesce(1).write.mode("append").parquet(f"{src}/b={n:03d}")
        # the end of the stream: an event late enough to close every session
        spark.createDataFrame([("end", T0 + dt.timedelta(days=30), "last")], "user string, at timestamp, event string").coalesce(1).write.parquet(f"{src}/b=900")
        spark.createDataFrame([("end", T0 + dt.timedelta(days=60), "very last")], "user string, at timestamp, event string").coalesce(1).write.parquet(f"{src}/b=901")
        stream = spark.readStream.schema("user string, at timestamp, event string, b int").option("maxFilesPerTrigger", 1).parquet(src)
        q = (stateful.sessions(stream, "user", "at", "event", 1800, "12 hours").writeStream.format("parquet").option("path", f"{tmpdir_path}/out")
             .option("checkpointLocation", f"{tmpdir_path}/ck").outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        got = sorted((x["user"], x["session_start"], x["session_end"], x["arrivals"]) for x in spark.read.parquet(f"{tmpdir_path}/out").where(F.col("user") != "end").collect())
        assert got == plain([x for x in sent], 1800) and len(got) > 20
        # only the last key still has state
        last = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]][-1]
        assert last <= 3
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
