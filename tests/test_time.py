"""As-of and interval joins, event-time windows, the drift monitor and joined streams: brute force, hot keys, restarts."""

import datetime as dt
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfwise import session
from shelfwise.operators.intervals import overlap_join, point_join, within_join
from shelfwise.operators.temporal import as_of_join, rolling_sums
from shelfwise.streaming import windows as W
from shelfwise.streaming.monitor import monitor_drift, use_rocks
from shelfwise.streaming.outcomes import join_outcomes

START = dt.datetime(2024, 1, 1)


def at(hours):
    return START + dt.timedelta(hours=hours)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def hot(spark):
    """Two thirds of the rows on one key; many equal times; null keys and times."""
    draw = random.Random(1)
    key = lambda: "hot" if draw.random() < 2 / 3 else draw.choice(["a", "b", None])
    left = [(i, key(), draw.choice([draw.randrange(300), None]) if draw.random() < 0.05 else draw.randrange(300)) for i in range(6000)]
    right = [(key(), draw.randrange(300) if draw.random() < 0.97 else None, i, f"v{i}") for i in range(900)]
    return left, right, spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "k string, t int, version int, name string")


@pytest.mark.parametrize("direction,exact,within", [("backward", True, None), ("backward", False, 7), ("forward", True, 2), ("forward", False, None)])
def test_as_of_join_against_brute_force(spark, hot, direction, exact, within):
    left, right, lefts, rights = hot

    def match(k, t):
        fits = lambda s: (s <= t if exact else s < t) if direction == "backward" else (s >= t if exact else s > t)
        valid = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and fits(r[1])]
        if not valid:
            return (None, None)
        best = max(valid, key=lambda r: (r[1] if direction == "backward" else -r[1], r[2]))
        return (best[3], best[1]) if within is None or abs(best[1] - t) <= within else (None, None)

    found = as_of_join(lefts, rights, ["k"], "t", "t", ["name", "t"], tie_by=["version"], direction=direction, exact=exact, within=within, prefix="r_")
    assert rows_of(found) == sorted(((*r, *match(r[1], r[2])) for r in left), key=str)


def test_as_of_join_cuts_a_hot_key(spark, hot):
    left, right, lefts, rights = hot
    plain = rows_of(as_of_join(lefts, rights, ["k"], "t", "t", ["name"], tie_by=["version"]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with more data
    try:
        assert rows_of(as_of_join(lefts, rights, ["k"], "t", "t", ["name"], tie_by=["version"])) == plain
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in spark.read.parquet(session._scratch[-1]).filter("__k0 = 'hot'").groupBy("__slice").count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 3 * sum(sizes) / len(sizes)


def test_as_of_join_of_times(spark):
    left = spark.createDataFrame([(1, "a", at(5)), (2, "a", at(1)), (2, "a", at(1)), (3, None, at(5)), (4, "a", None)], "id int, k string, t timestamp")
    right = spark.createDataFrame([("a", at(2), 1), ("a", at(5), 2), ("a", at(6), 3), (None, at(1), 9)], "k string, s timestamp, v int")
    assert [r["v"] for r in as_of_join(left, right, ["k"], "t", "s", ["v"]).orderBy("id").collect()] == [2, None, None, None, None]
    assert [r["v"] for r in as_of_join(left, right, ["k"], "t", "s", ["v"], exact=False, within=3 * 3600).orderBy("id").collect()] == [1, None, None, None, None]
    assert as_of_join(left, right.limit(0), ["k"], "t", "s", ["v"]).filter("v is null").count() == 5
    assert as_of_join(left.limit(0), right, ["k"], "t", "s", ["v"]).count() == 0
    with pytest.raises(ValueError, match="prefix"):
        as_of_join(left, right, ["k"], "t", "s", ["k"])


def spans(draw, n, wide):
    out = []
    for i in range(n):
        start = draw.choice([draw.uniform(-50, 1000), float(draw.randrange(1000))])
        end = start + draw.choice([0.0, 1.0, draw.uniform(0, 5), draw.uniform(0, wide), -1.0])
        out.append((i, draw.choice(["x", "x", "x", "y", None]), draw.choice([None, math.nan, -math.inf]) if draw.random() < 0.04 else start, math.inf if draw.random() < 0.02 else end))
    return out


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("keys,hot_rows", [(["k"], 20_000), ([], 40)])
def test_overlap_join_against_brute_force(spark, closed, keys, hot_rows):
    draw = random.Random(7)
    left, right = spans(draw, 400, 900), spans(draw, 300, 60)

    def meets(a, b):
        if any(x is None or math.isnan(x) for x in (*a[2:], *b[2:])) or a[2] > a[3] or b[2] > b[3] or (keys and (a[1] is None or a[1] != b[1])):
            return False
        low, high = max(a[2], b[2]), min(a[3], b[3])
        return low <= high and (closed or low < high or any(x[2] == x[3] and (y[2] == y[3] or x[2] < y[3]) for x, y in ((a, b), (b, a))))

    frames = [spark.createDataFrame(r, "id int, k string, s double, e double") for r in (left, right)]
    joined = overlap_join(*frames, ("s", "e"), ("s", "e"), keys, closed=closed, hot_rows=hot_rows, left_columns=["id"], right_columns=["id"], prefix="r_")
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    expected = sorted((a[0], b[0]) for a in left for b in right if meets(a, b))
    assert len(expected) > 3000 and sorted(tuple(r) for r in joined.collect()) == expected


def test_overlap_join_splits_a_hot_bin(spark):
    points = spark.range(5000).select("id", (F.col("id") % 3).cast("double").alias("p"))
    bands = spark.createDataFrame([(i, -float(i), 1.0 + i) for i in range(4)], "band int, low double, high double")
    found = point_join(points, bands, "p", ("low", "high"), hot_rows=100, left_columns=["id"], right_columns=["band"])
    counts = {r["band"]: r["count"] for r in found.groupBy("band").count().collect()}
    assert counts == {0: 3334, 1: 5000, 2: 5000, 3: 5000} and found.distinct().count() == found.count()
    parts = [r["__parts"] for r in spark.read.parquet([p for p in session._scratch if "/hot-bins" in p][-1]).collect()]
    assert max(parts) >= 10
    assert point_join(points.limit(0), bands, "p", ("low", "high")).count() == 0


def test_within_join_keeps_rows_without_a_partner(spark):
    left = spark.createDataFrame([(1, "a", at(1)), (1, "a", at(1)), (2, "b", at(2)), (3, None, at(1)), (4, "a", None)], "id int, k string, t timestamp")
    right = spark.createDataFrame([("a", at(1), 1), ("a", at(3), 2), ("a", at(3.5), 3), ("b", at(1), 4)], "k string, s timestamp, v int")
    found = within_join(left, right, ["k"], "t", "s", 7200).select("id", "v")
    assert rows_of(found) == sorted([(1, 1), (1, 2), (1, 1), (1, 2), (2, None), (3, None), (4, None)], key=str)


EVENTS = "id int, t timestamp, user string, x double"


def arrivals(draw, batches=6):
    """(micro-batch, id, time, user, value): some rows late, some of them too late."""
    out = []
    for i in range(900):
        hour = draw.uniform(0, 24 * batches)
        out.append((min(batches - 1, int(hour // 24) + (draw.choice([1, 2]) if draw.random() < 0.1 else 0)), i, at(hour), draw.choice(["a", "a", "b", "c"]), round(draw.random(), 3)))
    return out


def write_batch(spark, rows, number, folder):
    part = [r[1:] for r in rows if r[0] == number]
    spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(folder)


def test_windows_over_a_stream_that_is_interrupted(spark, tmp_path):
    rows = arrivals(random.Random(3))
    inbox, base = str(tmp_path / "in"), str(tmp_path / "job")
    figures = {"n": F.count(F.lit(1)), "total": F.sum("x")}
    kinds = {"day": W.tumbling("t", "6 hours", ("user",), **figures), "visit": W.sessions("t", "40 minutes", ("user",), **figures)}
    for numbers in ((0, 1), (2,), (3, 4, 5)):  # three runs, each from the checkpoint of the one before
        for n in numbers:
            write_batch(spark, rows, n, inbox)
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(inbox)
        W.start_windows(stream, base, "t", "6 hours", kinds).awaitTermination()
    tables = W.WindowTables(base)

    marks, seen, late = {}, None, set()
    for n in range(6):
        marks[n] = seen - dt.timedelta(hours=6) if seen else None
        here = [r for r in rows if r[0] == n]
        late |= {r[1] for r in here if marks[n] and r[2] < marks[n]}
        seen = max([r[2] for r in here] + ([seen] if seen else []))
    assert late and {r["id"] for r in tables.late_rows(spark).collect()} == late
    assert tables.rows(spark).count() == len(rows)
    assert [r["watermark"] for r in tables.watermarks(spark).orderBy("batch_id").collect()] == [marks[n] for n in range(6)]

    on_time = spark.createDataFrame([r[1:] for r in rows if r[1] not in late], EVENTS)
    final = F.lit(seen - dt.timedelta(hours=6)).cast("timestamp")
    for name, kind in kinds.items():
        expected = W.aggregate(on_time, kind).filter(F.col("window_end") <= final)
        close = lambda d: d.withColumn("total", F.round("total", 6))
        assert rows_of(close(tables.windows(spark, name)).select(expected.columns)) == rows_of(close(expected))


def test_a_micro_batch_that_is_run_again_doubles_nothing(spark, tmp_path):
    rows = arrivals(random.Random(4), batches=3)
    inbox, base = str(tmp_path / "in"), str(tmp_path / "job")
    kinds = {"day": W.tumbling("t", "6 hours", (), n=F.count(F.lit(1)))}

    def run():
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(inbox)
        W.start_windows(stream, base, "t", "6 hours", kinds).awaitTermination()

    for n in range(3):
        write_batch(spark, rows, n, inbox)
    run()
    before = rows_of(W.WindowTables(base).windows(spark, "day"))
    for name in ("2", ".2.crc"):  # as if the job had died before it noted the last micro-batch as done
        (tmp_path / "job" / "progress" / "commits" / name).unlink(missing_ok=True)
    run()
    assert rows_of(W.WindowTables(base).windows(spark, "day")) == before
    assert W.WindowTables(base).rows(spark).count() == len(rows)


def test_a_replayed_table_comes_number_by_number_in_many_files(spark, tmp_path):
    df = spark.range(402_000, numPartitions=4).withColumn("n", F.when(F.col("id") < 1, 7).when(F.col("id") < 2000, 3).otherwise(F.col("id") % 2))
    stream = W.in_batches(df, F.col("n"), str(tmp_path / "in"))
    seen = []
    stream.writeStream.option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).foreachBatch(
        lambda rows, i: seen.append((i, [tuple(r) for r in rows.withColumn("file", F.input_file_name()).groupBy("n").agg(F.count("id"), F.count_distinct("id"), F.count_distinct("file")).collect()]))
    ).start().awaitTermination()
    assert seen == [(0, [(0, 200_000, 200_000, 2)]), (1, [(1, 200_000, 200_000, 2)]), (2, [(3, 1999, 1999, 2)]), (3, [(7, 1, 1, 1)])]


def test_windows_keep_a_slice_of_state_a_core(spark, tmp_path):
    rows, given = arrivals(random.Random(6), batches=2), spark.conf.get("spark.sql.shuffle.partitions")
    kinds = {"day": W.tumbling("t", "6 hours", (), n=F.count(F.lit(1)))}
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        for n in range(2):
            write_batch(spark, rows, n, str(tmp_path / "in"))
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        W.start_windows(stream, str(tmp_path / "job"), "t", "6 hours", kinds).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", given)
    slices = [p.name for p in (tmp_path / "job" / "progress-day" / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(slices) == spark.sparkContext.defaultParallelism


def records(spark, rows, tmp_path, name, runs, **options):
    use_rocks(spark)
    inbox, output = str(tmp_path / f"{name}-in"), str(tmp_path / f"{name}-out")
    for numbers in runs:
        for n in numbers:
            write_batch(spark, rows, n, inbox)
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(inbox)
        found = monitor_drift(stream, "user", "t", "x", width_s=3600 * 6, delay="6 hours", reference=3, **options)
        found.writeStream.option("checkpointLocation", str(tmp_path / f"{name}-progress")).trigger(availableNow=True).format("parquet").start(output).awaitTermination()
    return [(r["key"], r["window_start"], r["status"], r["n"], *(None if r[c] is None else round(r[c], 6) for c in ("mean", "deviation", "reference_mean", "z"))) for r in spark.read.parquet(output).orderBy("key", "window_start", "status").collect()]


def test_monitor_goes_on_from_its_checkpoint(spark, tmp_path):
    draw = random.Random(9)
    rows = [(int(h // 24), i, at(h), u, x) for i in range(1200) for h in [draw.uniform(0, 144)] for u in [draw.choice("ab")] for x in [draw.gauss(1 + (h > 100 and u == "a"), 0.1)]]
    rows += [(0, 5000 + i, at(i / 2), "gone", float(i)) for i in range(6)]
    once = records(spark, rows, tmp_path, "once", [range(6)], ttl_s=2 * 86_400)
    again = records(spark, rows, tmp_path, "again", [(0, 1), (2,), (3, 4, 5)], ttl_s=2 * 86_400)
    assert once == again
    of = lambda key, status: [r for r in once if r[0] == key and r[2] == status]
    assert len(of("a", "reference")) == 3 and len(of("a", "drift")) >= 4 and len(of("b", "drift")) <= 1 and len(of("b", "ok")) > 10
    assert [(r[1], r[2], r[3]) for r in once if r[0] == "gone"] == [(at(0), "reference", 6), (at(6), "expired", 0)]
    day = [r[4] for r in rows if r[3] == "b" and at(0) <= r[2] < at(6)]
    assert of("b", "reference")[0][3:5] == (len(day), round(sum(day) / len(day), 6))


def test_joined_streams_equal_the_joined_batches(spark, tmp_path):
    draw = random.Random(2)
    requests = [(int(h // 24), i, at(h), draw.choice(["a", "b", None]), 0.0) for i in range(300) for h in [draw.uniform(0, 120)]]
    outcomes = [(int(h // 24), i, at(h), draw.choice(["a", "b", None]), 0.0) for i in range(150) for h in [draw.uniform(0, 120)]]
    names = {"r": ["r_id", "r_t", "r_user", "r_x"], "o": ["o_id", "o_t", "o_user", "o_x"]}
    output = str(tmp_path / "out")
    for numbers in ((0, 1, 2), (3, 4)):  # the second run goes on from the checkpoint
        for n in numbers:
            write_batch(spark, requests, n, str(tmp_path / "r"))
            write_batch(spark, outcomes, n, str(tmp_path / "o"))
        sides = [spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / k)).toDF(*names[k]) for k in "ro"]
        found = join_outcomes(*sides, "r_user", "o_user", "r_t", "o_t", "2 hours", delay="1 hour")
        found.writeStream.option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).format("parquet").start(output).awaitTermination()
    batches = [spark.createDataFrame([r[1:] for r in rows], EVENTS).toDF(*names[k]) for k, rows in (("r", requests), ("o", outcomes))]
    batch = join_outcomes(*batches, "r_user", "o_user", "r_t", "o_t", "2 hours")
    mark = min(max(r[2] for r in requests), max(r[2] for r in outcomes)) - dt.timedelta(hours=1)
    open_ = (F.col("o_id").isNull()) & (F.col("r_t") + F.expr("INTERVAL 2 HOURS") >= F.lit(mark).cast("timestamp")) & F.col("r_user").isNotNull()
    got, expected = spark.read.parquet(output), batch.filter(~open_)
    assert got.count() > 300
    pairs = lambda d: rows_of(d.filter("r_user is not null").select("r_id", "o_id"))
    assert pairs(got) == pairs(expected)
    null_ids = {r["r_id"] for r in got.filter("r_user is null").collect()}
    assert null_ids <= {r[1] for r in requests if r[3] is None}
    with pytest.raises(ValueError, match="both streams"):
        join_outcomes(batches[0], batches[0], "r_user", "r_user", "r_t", "r_t", "1 hour")


def test_sessions_need_a_key():
    with pytest.raises(ValueError, match="key"):
        W.sessions("t", "1 hour", ())


def test_sql_of_an_as_of_join_agrees(spark, hot):
    left, right, lefts, rights = hot
    con = duckdb.connect()
    con.register("l", lefts.toPandas())
    con.register("r", rights.dropna(subset=["k", "t"]).toPandas())
    sql = con.execute("SELECT l.id, r.version FROM l ASOF LEFT JOIN (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY k, t ORDER BY version DESC) = 1) r ON l.k = r.k AND l.t >= r.t").fetchall()
    found = as_of_join(lefts, rights, ["k"], "t", "t", ["version"], tie_by=["version"]).select("id", "version")
    assert rows_of(found) == sorted(((a, None if b is None or b != b else int(b)) for a, b in sql), key=str)


def test_rolling_sums_against_brute_force(spark):
    """Two thirds of the rows on one key, many of one moment, null keys, times and values."""
    draw = random.Random(12)
    rows = [
        (i, "hot" if draw.random() < 2 / 3 else draw.choice(["a", None]), None if draw.random() < 0.02 else draw.randrange(200), None if draw.random() < 0.05 else draw.randrange(-500, 500) / 4)
        for i in range(2500)
    ]
    df = spark.createDataFrame(rows, "id int, k string, t int, x double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with more data
    try:
        before = len(session._scratch)
        found = {r["id"]: (r["n_rows"], r["total_known"], r["total"]) for r in rolling_sums(df, "t", 7, {"total": "x"}, ["k"]).collect()}
        slices = [p for p in session._scratch[before:] if "/as-of-" in p][0]
        hot = [r["count"] for r in spark.read.parquet(slices).filter("__k0.k = 'hot'").groupBy("__slice").count().collect()]
        assert len(hot) >= 3 and max(hot) <= 2 * sorted(hot)[len(hot) // 2] + 8
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == len(rows)
    for i, k, t, _ in rows:
        frame = [r for r in rows if r[1] == k and r[2] is not None and t is not None and t - 7 <= r[2] <= t]
        values = [r[3] for r in frame if r[3] is not None]
        assert found[i] == ((len(frame), len(values), sum(values)) if t is not None else (None, None, None)), i


def test_rolling_sums_of_times_and_all_rows(spark):
    df = spark.createDataFrame([(1, at(0), 1.5), (2, at(1), 2.0), (3, at(2.01), 4.0), (4, at(2), 8.25)], "id int, t timestamp, x double")
    found = {r["id"]: (r["n_rows"], float(r["s"])) for r in rolling_sums(df, "t", 3600, {"s": "x"}).collect()}
    assert found == {1: (1, 1.5), 2: (2, 3.5), 4: (2, 10.25), 3: (2, 12.25)}
    assert rolling_sums(df.limit(0), "t", 3600, {"s": "x"}).count() == 0
