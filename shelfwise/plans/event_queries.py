"""Named queries over time: as-of and interval joins, windows over streams, monitors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import cubes as C
from shelfwise.operators import explore as E
from shelfwise.operators import sketches as K
from shelfwise.operators.encoding import category_table, encode_categories, one_hot_by_table
from shelfwise.operators.features import TARGET, one_hot
from shelfwise.operators.intervals import overlap_join, within_join
from shelfwise.operators.model import score_python, train_rating_model
from shelfwise.operators.temporal import as_of_join, rolling_sums
from shelfwise.plans import adapters as A
from shelfwise.plans.preparation import prepare
from shelfwise.session import materialize, scratch_path
from shelfwise.streaming import windows as W
from shelfwise.streaming.monitor import monitor_drift, use_rocks
from shelfwise.streaming.outcomes import join_outcomes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def shown(df: DataFrame) -> DataFrame:
    """All times as text, to the microsecond, as in UTC."""
    plain = {"timestamp": lambda c: F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(EPOCH)), "timestamp_ntz": F.col}
    return df.select(*[F.date_format(plain[t](c), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) if t in plain else F.col(c) for c, t in df.dtypes])


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with their times as instants, as streams need them, and the day, counted from the first of 2024."""
    events = A.table(spark, sf_dir, "events")
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    return events.withColumn("day", day).withColumn("ts", F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(EPOCH), F.col("ts").cast("timestamp_ntz"))))


def _five_days(late: bool) -> Column:
    """The number of the micro-batch in which an event comes: of five days; with `late`, one in forty comes three days later."""
    return F.floor((F.col("day") + (F.when(F.col("event_id") % 40 == 0, 3).otherwise(0) if late else 0)) / 5)


@query
def version_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version of a model that was registered last when a request came; requests are events, versions those of sign-ups."""
    requests = A.table(spark, sf_dir, "events").filter("event_type <> 'signup'").select(
        "event_id", F.concat(F.lit("model-"), (F.col("event_id") % 20).cast("string")).alias("display_name"), F.col("ts").alias("request_time")
    )
    versions = A.registry(spark, sf_dir).filter(F.col("labels")["eval-status"] == "completed")
    found = as_of_join(requests, versions, ["display_name"], "request_time", "create_time", ["version", "create_time"], tie_by=["version"])
    return shown(found.withColumn("version", F.coalesce("version", F.lit(-1))))


@query
def price_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each returned line the last price its part had been shipped at, within 90 days."""
    lines = A.table(spark, sf_dir, "lineitem")
    returned = lines.filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    shipped = lines.filter("l_returnflag = 'N'").withColumn("price", F.col("l_extendedprice") / F.col("l_quantity"))
    return shown(as_of_join(
        returned, shipped, ["l_partkey"], "l_shipdate", "l_shipdate", ["price", "l_shipdate"], tie_by=["l_orderkey", "l_linenumber"], within=90 * 86_400, prefix="last_",
    ))


@query
def next_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next later price of the part, not of the same day."""
    lines = A.table(spark, sf_dir, "lineitem")
    returned = lines.filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    shipped = lines.filter("l_returnflag = 'N'").withColumn("price", F.col("l_extendedprice") / F.col("l_quantity"))
    return shown(as_of_join(
        returned, shipped, ["l_partkey"], "l_shipdate", "l_shipdate", ["price"], tie_by=["l_orderkey", "l_linenumber"], direction="forward", exact=False, prefix="next_",
    ))


@query
def price_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose price, give or take a tenth, meets a price band; one band holds all others."""
    price = F.col("price_numeric")
    items = prepare(A.items(spark, sf_dir)).select("id", (price * 0.9).alias("low"), (price * 1.1).alias("high"))
    key = F.col("n_nationkey")
    top = F.when(key == 24, F.lit(1000.0)).otherwise(key + 1.0 + key % 5)
    bands = A.table(spark, sf_dir, "nation").select(F.col("n_name").alias("band"), F.when(key == 24, F.lit(0.0)).otherwise(key * 1.0).alias("least"), top.alias("most"))
    return overlap_join(items, bands, ("low", "high"), ("least", "most"), left_columns=["id"], right_columns=["band"])


@query
def overlapping_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one part whose periods overlap: from shipping on, as many days as pieces."""
    lines = A.table(spark, sf_dir, "lineitem").withColumn("until", F.col("l_shipdate") + F.make_dt_interval(F.col("l_quantity").cast("int")))
    side = lambda flag, prefix: lines.filter(F.col("l_returnflag") == flag).select(
        "l_partkey", *[F.col(c).alias(prefix + c) for c in ("l_orderkey", "l_linenumber", "l_shipdate", "until")]
    )
    one, two = side("A", "a_"), side("N", "b_")
    found = overlap_join(one, two, ("a_l_shipdate", "a_until"), ("b_l_shipdate", "b_until"), ["l_partkey"], closed=False, right_columns=[c for c in two.columns if c != "l_partkey"])
    return shown(found)


@query
def shipped_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines shipped up to thirty days later, or with none."""
    orders = A.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderdate")
    lines = A.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_shipdate")
    found = within_join(orders, lines, ["orderkey"], "o_orderdate", "l_shipdate", 30 * 86_400, prefix="line_").drop("line_orderkey")
    return shown(found.withColumn("line_l_linenumber", F.coalesce("line_l_linenumber", F.lit(0))))


@query
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a day, sliding windows and sessions over a stream of micro-batches of five days, and its late rows by micro-batch.

    Some events come three days late; the watermark waits for one.
    """
    events = _events(spark, sf_dir).select("event_id", "ts", "day", F.col("user_id").cast("string").alias("user"), "event_type", "value")
    stream = W.in_batches(events, _five_days(late=True), scratch_path(spark, "inbox"))
    figures = {"n": F.count(F.lit(1)), "total": F.sum("value")}
    kinds = {
        "tumbling": W.tumbling("ts", "1 day", ("event_type",), **figures),
        "sliding": W.sliding("ts", "1 day", "12 hours", (), **figures),
        "session": W.sessions("ts", "30 minutes", ("user",), **figures),
    }
    tables = W.WindowTables(scratch_path(spark, "event-windows"))
    W.start_windows(stream, tables.base, "ts", "1 day", kinds).awaitTermination()
    shape = lambda df, kind, key: df.select(F.lit(kind).alias("kind"), key.alias("key"), "window_start", "window_end", "n", F.round("total", 6).alias("total"))
    late = tables.late_rows(spark).groupBy("batch_id").agg(F.min("ts").alias("window_start"), F.max("ts").alias("window_end"), *[c.alias(n) for n, c in figures.items()])
    found = shape(late, "late", F.col("batch_id").cast("string"))
    for kind, key in (("tumbling", F.col("event_type")), ("sliding", F.lit("")), ("session", F.col("user"))):
        found = found.union(shape(tables.windows(spark, kind), kind, key))
    return shown(found)


@query
def drift_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means by event type against each type's first five days, by a stateful stream."""
    events = _events(spark, sf_dir).select("ts", "day", "event_type", "value")
    stream = W.in_batches(events, _five_days(late=False), scratch_path(spark, "inbox"))
    use_rocks(spark)
    output = scratch_path(spark, "drift")
    records = monitor_drift(stream, "event_type", "ts", "value", limit=2.0)
    writer = records.writeStream.option("checkpointLocation", scratch_path(spark, "progress")).trigger(availableNow=True)
    writer.outputMode("append").format("parquet").start(output).awaitTermination()
    r6 = lambda c: F.round(c, 6).alias(c)
    return spark.read.parquet(output).select("key", F.date_format(F.timestamp_add("MICROSECOND", F.unix_micros("window_start"), F.expr(EPOCH)), "yyyy-MM-dd").alias("day"), "status", "n", r6("mean"), r6("deviation"), "reference_n", r6("reference_mean"), r6("z"))


@query
def outcomes_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views with the same user's clicks up to an hour later, by two streams; views without one once none can come any more."""
    events = _events(spark, sf_dir).withColumn("batch", _five_days(late=False))

    def side(kind: str, prefix: str) -> DataFrame:
        rows = events.filter(F.col("event_type") == kind).select(*[F.col(c).alias(prefix + c) for c in ("event_id", "ts", "user_id", "batch")])
        return W.in_batches(rows, F.col(f"{prefix}batch"), scratch_path(spark, "inbox"))

    joined = join_outcomes(side("view", "r_"), side("click", "o_"), "r_user_id", "o_user_id", "r_ts", "o_ts", "1 hour")
    output = scratch_path(spark, "outcomes")
    writer = joined.writeStream.option("checkpointLocation", scratch_path(spark, "progress")).trigger(availableNow=True)
    writer.outputMode("append").format("parquet").start(output).awaitTermination()
    return spark.read.parquet(output).select(F.col("r_event_id").alias("request_id"), F.coalesce("o_event_id", F.lit(-1)).alias("outcome_id"))


@query
def daily_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of each day, stored day by day and merged by event type: exact where they are, within their errors else."""
    events = _events(spark, sf_dir).select("day", "event_type", "value", "user_id")
    path = scratch_path(spark, "sketches")
    for late in (False, True):  # the second half of the days comes later
        K.write_sketches(K.build_sketches(events.filter((F.col("day") >= 15) == F.lit(late)), ["day", "event_type"], ["value"], ["user_id"]), path, "day")
    report = K.sketch_report(K.merge_sketches(K.read_sketches(spark, path), ["event_type"]), ["event_type"])
    one = report.filter("column = 'value'").select("event_type", "rows", "known", "least", "largest", "q50")
    two = report.filter("column = 'user_id'").select("event_type", "distinct")
    exact = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    ranks = events.join(one, "event_type").groupBy("event_type").agg(F.avg((F.col("value") <= F.col("q50")).cast("double")).alias("upto"), F.avg((F.col("value") < F.col("q50")).cast("double")).alias("below"))
    found = one.join(two, "event_type").join(exact, "event_type").join(ranks, "event_type")
    median = (F.col("upto") >= 0.5 - K.RANK_ERROR) & (F.col("below") <= 0.5 + K.RANK_ERROR)
    near = F.abs(F.col("distinct") - F.col("users")) <= K.DISTINCT_ERROR * F.col("users") + 1
    return found.select("event_type", "rows", "known", "least", "largest", median.alias("median_within_error"), near.alias("distinct_within_error"))


@query
def density_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The density of the price by 2,001 cells."""
    found = E.binned_density(prepare(A.items(spark, sf_dir)), "price_numeric", cells=2001)
    return found.select("feature", "position", *[F.round(c, 6).alias(c) for c in ("x", "density", "curve")])


@query
def categories_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions by frequency in a table made from the items up to a price; others' unknown categories have none."""
    rows = prepare(A.items(spark, sf_dir)).select("id", "price_numeric", "Country", "Grape")
    table = category_table(rows.filter("price_numeric < 3 AND Country > 'NATION_12'"), ["Country", "Grape"])
    found = encode_categories(rows, table, ["Country", "Grape"])
    return found.select("id", *[F.coalesce(f"{c}_position", F.lit(-1)).alias(f"{c}_position") for c in ("Country", "Grape")])


@query
def one_hot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors by the category table next to those of indexer and encoder, over all items: how many are equal."""
    columns = ["Country", "Type", "Style", "Grape"]
    rows = materialize(prepare(A.items(spark, sf_dir)).select("id", *columns), "items")
    some = rows.filter("Country <> 'NATION_3'")
    by_table = one_hot_by_table(rows, category_table(some, columns, order="alphabet"), columns, output="table")
    both = by_table.join(one_hot(rows, some, columns).select("id", F.col("features").cast("string").alias("indexer")), "id")
    return both.groupBy("Type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("table").cast("string") == F.col("indexer")).alias("n_equal"))


@query
def target_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which item tables training refuses before it reads a row: those without the column to learn."""
    rows = prepare(A.items(spark, sf_dir))
    found = []
    for case, given, target in (("no target", rows.drop(TARGET), TARGET), ("another target", rows, "Score"), ("no such name", rows.withColumnRenamed(TARGET, "rating_"), TARGET)):
        try:
            train_rating_model(given, ["price_numeric", "Country"], target)
            refused = False
        except KeyError:
            refused = True
        found.append(given.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(case).alias("case"), F.lit(refused).alias("refused"), "rows"))
    return found[0].union(found[1]).union(found[2])


@query
def python_model_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models that take their rows as a frame, as an array only, or as lists only: the same predictions."""
    rows = prepare(A.items(spark, sf_dir)).select("id", "price_numeric", F.col("id").cast("double").alias("key"))

    def model(form: str) -> Callable[[], object]:
        def load() -> object:
            class Picky:
                def predict(self, given):
                    if form == "frame":
                        return given["price_numeric"] * 2 + given["key"]
                    if type(given).__name__ != {"array": "ndarray", "list": "list"}[form]:
                        raise TypeError(f"rows as {form} only")
                    return [row[0] * 2 + row[1] for row in given]

            return Picky()

        return load

    found = rows
    for form in ("frame", "array", "list"):
        found = score_python(found, model(form), ["price_numeric", "key"]).withColumnRenamed("prediction", f"by_{form}")
    return found.select("id", *[F.round(f"by_{form}", 6).alias(f"by_{form}") for form in ("frame", "array", "list")])


@query
def rolling_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean value of the last seven days by event type, at each event."""
    events = A.table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    found = rolling_sums(events, "ts", 7 * 86_400, {"total": "value"}, ["event_type"])
    return found.select("event_id", "n_rows", F.round(F.col("total").cast("double") / F.col("total_known"), 6).alias("mean"))


@query
def sales_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by country, type and style and all coarser groupings: number, sum of prices, distinct grapes and regions."""
    columns = ["Country", "Type", "Style"]
    rows = prepare(A.items(spark, sf_dir))
    measures = {"n": F.count(F.lit(1)), "total": F.round(F.sum("price_numeric"), 4)}
    exact = C.totals_by(rows, columns, C.cube_sets(columns), measures, ["Grape", "Region"])
    near = C.totals_by(rows, columns, C.cube_sets(columns), {}, ["id"], exact=False)
    same = F.col("e.level") == F.col("s.level")
    for c in columns:
        same = same & F.col(f"e.{c}").eqNullSafe(F.col(f"s.{c}"))
    both = exact.alias("e").join(near.alias("s"), same)
    within = F.abs(F.col("id_distinct") - F.col("n")) <= K.DISTINCT_ERROR * F.col("n") + 1
    return both.select("e.*", within.alias("ids_within_error"))


@query
def sales_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["Region", "Country", "Type"]
    return C.totals_by(prepare(A.items(spark, sf_dir)), columns, C.rollup_sets(columns), {"n": F.count(F.lit(1)), "top": F.max("price_numeric")}, ["Style"])
