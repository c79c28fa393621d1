"""Cleaning, deduplication, numbering and quality against brute force, with hot groups."""

from __future__ import annotations

import datetime
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalstrata.errors import DatasetError
from pedalstrata.functions import udaf
from pedalstrata.functions.aggregates import first_non_null
from pedalstrata.operators import cleaning, dedup, numbering, ordering, projection, quality, rollup
from pedalstrata.plans import demand, gold
from pedalstrata.plans.lineitem_feed import day_dirty, hour_dirty, hour_raw
from pedalstrata.plans.silver import silver
from pedalstrata.schemas import DOMAIN_RULES

NAN = float("nan")
FUZZ = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
RIDES = "ride_id long, ride_date date, ride_hour long, temperature double"


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- cleaning ------------------------------------------------------------------------------


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([("2011-01-01", 1)], "dteday string, riders int")
    with pytest.raises(DatasetError, match=r"\['cnt'\].*dteday.*riders"):
        cleaning.clean(df)


def test_clean_drops_missing_and_bad_dates(spark):
    data = [("2011-01-01", "5"), ("bad", "5"), (None, "5"), ("NA", "5"), ("2011-01-02", None), ("2011-01-03", "")]
    df = spark.createDataFrame(data, "dteday string, cnt string")
    assert rows(cleaning.clean(df)) == [(datetime.date(2011, 1, 1), "5")]
    assert rows(cleaning.cleaning_report(df)) == [(6, 4, 1, 1)]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([("2011-01-01", NAN), ("2011-01-01", 2.0)], "dteday string, cnt double")
    assert cleaning.clean(df).count() == 1


def test_report_adds_up(spark, sf_dir):
    for df in (hour_dirty(spark, sf_dir), hour_raw(spark, sf_dir)):
        r = cleaning.cleaning_report(df).first()
        assert r.rows_in == df.count() == r.dropped_null + r.dropped_bad_date + r.rows_out
        assert cleaning.clean(df).count() == r.rows_out


# --- deduplication -------------------------------------------------------------------------


@pytest.mark.parametrize("method", ["aggregate", "window"])
@pytest.mark.parametrize(("null_keys", "n"), [("collapse", 1), ("keep", 3), ("drop", 0)])
def test_null_keys(spark, method, null_keys, n):
    day = datetime.date(2011, 1, 1)
    df = spark.createDataFrame([(None, day, h, 0.1) for h in (1, 2, 3)] + [(7, day, 1, 0.1)], RIDES)
    out = dedup.latest_per_key(df, "ride_id", ["ride_date"], null_keys, method)
    assert out.where("ride_id is null").count() == n
    assert out.where("ride_id = 7").count() == 1


@pytest.mark.parametrize("method", ["aggregate", "window"])
def test_ties_go_to_the_later_hour(spark, method):
    day = datetime.date(2011, 1, 1)
    df = spark.createDataFrame([(1, day, 3, 0.9), (1, day, 9, 0.1), (1, None, 20, 0.1)], RIDES)
    assert rows(dedup.latest_per_key(df, "ride_id", ["ride_date"], method=method)) == [(1, day, 9, 0.1)]


def test_unknown_null_policy(spark):
    df = spark.createDataFrame([], RIDES)
    with pytest.raises(ValueError, match="null_keys"):
        dedup.latest_per_key(df, "ride_id", ["ride_date"], "ignore")


DATES = st.one_of(st.none(), st.dates(datetime.date(2011, 1, 1), datetime.date(2011, 1, 3)))
HOURS = st.one_of(st.none(), st.integers(0, 3))
TEMPS = st.one_of(st.none(), st.sampled_from([NAN, 0.0, 0.5, -1.0]))
KEYS = st.one_of(st.none(), st.integers(1, 3))


def _newest(group):
    def rank(v):
        missing = v is None
        nan = v != v if not missing else False
        return (not missing, nan, 0 if missing or nan else v)

    return max(group, key=lambda r: tuple(rank(v) for v in r[1:]))


@FUZZ
@given(st.lists(st.tuples(KEYS, DATES, HOURS, TEMPS), min_size=1, max_size=40))
def test_both_methods_equal_brute_force(spark, data):
    df = spark.createDataFrame(data, RIDES)
    groups: dict = {}
    for r in data:
        groups.setdefault(r[0], []).append(r)
    want = Counter(repr(_newest(g)) for g in groups.values())
    for method in ("aggregate", "window"):
        out = dedup.latest_per_key(df, "ride_id", ["ride_date"], method=method)
        assert Counter(repr(r) for r in rows(out)) == want


def test_dedup_is_idempotent(spark, sf_dir):
    once = silver(hour_dirty(spark, sf_dir), "hour")
    twice = dedup.latest_per_key(once, "ride_id", ["ride_date"])
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_hot_key_moves_one_row_per_task(spark):
    """A key with half of all rows: each task sends a single row of it through the shuffle."""
    df = spark.range(0, 40_000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id")).alias("ride_id"),
        F.expr("date_add(date'2011-01-01', cast(id % 700 as int))").alias("ride_date"),
        F.col("id").alias("ride_hour"),
        F.lit(0.5).alias("temperature"),
    )
    out = dedup.latest_per_key(df, "ride_id", ["ride_date"])
    assert out.count() == 20_001
    hot = out.where("ride_id is null").first()
    want = max(((i % 700, i) for i in range(0, 40_000, 2)))
    assert (hot.ride_date, hot.ride_hour) == (datetime.date(2011, 1, 1) + datetime.timedelta(want[0]), want[1])


# --- numbering and order -------------------------------------------------------------------


def test_both_numberings_agree(spark, sf_dir):
    hours = hour_raw(spark, sf_dir).select("dteday", "instant", "hr").distinct()
    one = numbering.sequence_id(hours, ["dteday", "instant", "hr"], "n")
    many = numbering.sequence_id_distributed(hours, ["dteday", "instant", "hr"], "n", unique=True)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_numbering_splits_hot_key_and_copies(spark):
    """Half of the rows are one copied row; numbers stay dense and the copies spread out."""
    df = spark.range(0, 20_000, numPartitions=8).select(
        F.expr("if(id % 2 = 0, '2011-06-01', string(date_add(date'2011-01-01', int(id % 365))))").alias("dteday"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("v"),
    )
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        out = numbering.sequence_id_distributed(df, ["dteday"], "n")
    finally:
        spark.conf.unset(coalesce)
    assert rows(out.agg(F.min("n"), F.max("n"), F.count_distinct("n"))) == [(1, 20_000, 20_000)]
    got = [r.dteday for r in out.orderBy("n").collect()]
    assert got == sorted(got)
    sizes = [spark.read.parquet(f).count() for f in out.inputFiles()]
    assert sum(sizes) == 20_000 and len(sizes) >= 8 and max(sizes) < 5_000


def test_numbering_of_empty_input(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert numbering.sequence_id_distributed(df, ["k"], "n").count() == 0


def test_newest_first_keeps_all_rows_in_order(spark):
    data = [(None, i) for i in range(50)] + [(datetime.date(2011, 1, 1 + i % 9), i) for i in range(50)]
    df = spark.createDataFrame(data, "ride_date date, v int").repartition(4)
    got = rows(ordering.newest_first(df, ["ride_date"]))
    dates = [r[0] for r in got]
    present = [d for d in dates if d is not None]
    assert Counter(got) == Counter(data)
    assert dates == sorted(present, reverse=True) + [None] * 50


def shares(df):
    """Rows of the largest task of the last stage that sorts or ranks, over the even share."""
    n = df.rdd.getNumPartitions()
    sizes = df.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    return max(sizes) * n / sum(sizes)


def test_rank_all_equals_the_window_and_splits_a_hot_key(spark):
    df = spark.range(20_000, numPartitions=6).selectExpr(
        "if(id % 3 = 0, null, id % 500) as ride_id", "date_add(date'2011-01-01', cast(id % 40 as int)) as ride_date", "id % 7 as x"
    )
    got = dedup.rank_all(df, "ride_id", ["ride_date"])
    want = dedup.rank_latest(df, "ride_id", ["ride_date"])
    assert Counter(rows(got)) == Counter(rows(want)) and got.columns == want.columns
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert shares(dedup.rank_all(df, "ride_id", ["ride_date"])) < 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_newest_first_splits_one_column_and_copies(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dates = spark.range(20_000).selectExpr("if(id % 3 = 0, null, date_add(date'2011-01-01', cast(id % 900 as int))) as d")
        copies = spark.range(20_000).selectExpr("if(id % 3 = 0, 5, id) as a", "if(id % 3 = 0, 'x', 'y') as b")
        for df, by in ((dates, ["d"]), (copies, ["a"])):
            out = ordering.newest_first(df, by)
            assert shares(out) < 2 and out.count() == 20_000
            values = [r[0] for r in out.collect()]
            present = [v for v in values if v is not None]
            assert present == sorted(present, reverse=True) and values[: len(present)] == present
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_newest_first_splits_a_hot_key(spark):
    """Half of the rows without a date still spread over the ranges of the sort."""
    df = spark.range(0, 20_000, numPartitions=8).select(
        F.expr("if(id % 2 = 0, null, date_add(date'2011-01-01', int(id % 365)))").alias("ride_date"), "id"
    )
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        out = ordering.newest_first(df, ["ride_date"]).select(F.spark_partition_id().alias("p"))
        sizes = Counter(r.p for r in out.collect())
    finally:
        spark.conf.unset(coalesce)
    assert sum(sizes.values()) == 20_000 and max(sizes.values()) < 5_000


# --- roll-up -------------------------------------------------------------------------------


def test_daily_sums_equal_hourly_sums(spark, sf_dir):
    hours = hour_raw(spark, sf_dir)
    days = rollup.rollup_day(hours)
    for c in ("casual", "registered", "cnt"):
        assert days.agg(F.sum(c)).first()[0] == hours.agg(F.sum(c)).first()[0]
    assert days.count() == hours.select("dteday").distinct().count()


def test_text_and_date_keys_give_the_same_days(spark, sf_dir):
    hours = hour_raw(spark, sf_dir)
    text = rollup.rollup_day(hours).withColumn("dteday", F.col("dteday").cast("date"))
    typed = rollup.rollup_day(hours.withColumn("dteday", F.col("dteday").cast("date")))
    assert text.exceptAll(typed).isEmpty() and typed.exceptAll(text).isEmpty()


def test_days_are_numbered_by_date_not_by_text(spark, sf_dir):
    hours = hour_raw(spark, sf_dir).limit(0).select("*")
    one = hour_raw(spark, sf_dir).limit(1)
    three = [one.withColumn("dteday", F.lit(d)) for d in ("2011-10-01", "2011-9-30", "someday")]
    days = rollup.rollup_day(hours.unionByName(three[0]).unionByName(three[1]).unionByName(three[2]))
    assert [r.dteday for r in days.orderBy("instant").collect()] == ["2011-9-30", "2011-10-01", "someday"]


# --- quality -------------------------------------------------------------------------------


@pytest.mark.parametrize(("n_rows", "n_cols", "valid"), [(100, 5, True), (99, 5, False), (100, 4, False)])
def test_thresholds_are_inclusive(spark, n_rows, n_cols, valid):
    df = spark.range(n_rows).select(*[F.col("id").alias(f"c{i}") for i in range(n_cols)])
    report = quality.validate_dataset(df, "t")
    assert report.first().valid is valid
    if valid:
        quality.require_valid(report)
    else:
        with pytest.raises(DatasetError):
            quality.require_valid(report)


def test_all_failures_are_reported_at_once(spark):
    small = spark.range(3)
    with pytest.raises(DatasetError, match="a: too few rows.*a: too few columns.*b: too few rows"):
        quality.require_valid(quality.validate_dataset(small, "a"), quality.validate_dataset(small, "b"))


def test_null_cells_only_warn(spark):
    df = spark.range(100).select(*[F.lit(None).cast("double").alias(f"c{i}") for i in range(5)])
    report = quality.validate_dataset(df, "t").first()
    assert report.valid and report.n_nulls == 500


def test_domains_ignore_null(spark):
    df = spark.createDataFrame([(1, 0), (5, 7), (None, None)], "season long, weekday long")
    rules = [r for r in DOMAIN_RULES if r[1] in df.columns]
    assert dict(rows(quality.check_domains(df, rules))) == {"season_1_4": 1, "weekday_0_6": 1}


def test_unknown_columns_are_errors(spark):
    df = spark.createDataFrame([(1, 0)], "season long, `week.day` long")
    with pytest.raises(DatasetError, match="hour_0_23.*ride_hour"):
        quality.check_domains(df)
    with pytest.raises(DatasetError, match="sesaon"):
        quality.count_missing(df, ["sesaon"])
    assert rows(quality.count_missing(df, ["week.day"])) == [(0,)]
    assert quality.required_columns_report(df, ["week.day", "x"]).count() == 2
    assert cleaning.drop_missing(df, ["week.day"]).count() == 1


def test_total_invariant(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 2, 4)], "casual_users long, registered_users long, total_rides long")
    assert rows(quality.check_total(df)) == [(2, 1)]
    df = spark.createDataFrame(
        [(1, 2, 3), (1, 2, 4), (1, 2, None), (None, 2, 3), (None, None, None)],
        "casual_users long, registered_users long, total_rides long",
    )
    assert rows(quality.total_report(df)) == [(5, 1, 2, 1)]


# --- gold and demand -----------------------------------------------------------------------


def test_shared_gold_scan_equals_single_tables(spark, sf_dir):
    rides = silver(hour_dirty(spark, sf_dir), "hour")
    shared = gold.gold_tables(rides)
    single = {
        "monthly": gold.monthly(rides),
        "yearly": gold.yearly(rides),
        "rental_metrics": gold.rental_metrics(rides),
        "weather_metrics": gold.weather_metrics(rides),
    }
    for name, df in single.items():
        assert Counter(rows(df)) == Counter(rows(shared[name])), name


def test_share_of_nothing_is_null(spark, sf_dir):
    rides = silver(hour_raw(spark, sf_dir), "hour").withColumn("total_rides", F.lit(0).cast("bigint"))
    assert {r.casual_share for r in gold.rental_metrics(rides).collect()} == {None}


def test_correlation_without_variance_is_null(spark):
    schema = "total_rides long, temperature double"
    df = spark.createDataFrame([(5, 0.5), (7, 0.5), (None, 0.9), (8, None)], schema)
    assert rows(demand.relation_to_rides(df, "temperature")) == [(2, None, None, None)]
    df = spark.createDataFrame([(5, 0.5), (5, 0.7)], schema)
    assert rows(demand.relation_to_rides(df, "temperature")) == [(2, None, 0.0, 5.0)]
    df = spark.createDataFrame([(1, 0.0), (3, 1.0), (5, 2.0)], schema)
    assert rows(demand.relation_to_rides(df, "temperature")) == [(3, 1.0, 2.0, 1.0)]
    assert rows(demand.relation_to_rides(df.limit(0), "temperature")) == [(0, None, None, None)]


def test_day_grain_silver(spark, sf_dir):
    day = silver(day_dirty(spark, sf_dir), "day")
    assert "ride_hour" not in day.columns and day.count() == 3906


# --- names -----------------------------------------------------------------------------------

AWKWARD = ("_row", "_at", "_part", "_local", "_before", "_key", "_rn", "_n", "row", "at", "part", "n", "key", "rank", "local", "before", "k.x")


@pytest.fixture(scope="module")
def plain_and_awkward(spark):
    """The same rows under plain names, and with a column of every name that could be used inside."""
    plain = spark.range(200, numPartitions=4).selectExpr("id % 7 as k", "nullif(id % 11, 3) as v", "id % 2 as w")
    awkward = plain.select(F.col("k").alias("k.x"), "v", "w", *[F.lit(i).alias(c) for i, c in enumerate(AWKWARD[:-1])])
    return plain, awkward


def shared_rows(df):
    """Rows without the columns that only the second frame has."""
    own = [F.col(f"`{c}`") for c in df.columns if c not in AWKWARD[:-1]]
    return sorted(str(tuple(r)) for r in df.select(*own).collect())


@pytest.mark.parametrize("method", ["aggregate", "window"])
@pytest.mark.parametrize("null_keys", ["collapse", "keep", "drop"])
def test_latest_per_key_with_awkward_names(plain_and_awkward, method, null_keys):
    plain, awkward = plain_and_awkward
    got = dedup.latest_per_key(awkward, "k.x", ["v"], null_keys, method)
    assert got.columns == awkward.columns
    assert shared_rows(got) == shared_rows(dedup.latest_per_key(plain, "k", ["v"], null_keys, method))
    assert got.select(*[c for c in AWKWARD[:-1]]).distinct().collect() == [tuple(range(len(AWKWARD) - 1))]


def test_ranks_numbers_and_order_with_awkward_names(plain_and_awkward):
    plain, awkward = plain_and_awkward
    assert shared_rows(dedup.rank_all(awkward, "k.x", ["v"], "place")) == shared_rows(dedup.rank_all(plain, "k", ["v"], "place"))
    pairs = [(numbering.sequence_id_distributed(df, [key, "v", "w"], "place"), df) for df, key in ((awkward, "k.x"), (plain, "k"))]
    assert shared_rows(pairs[0][0]) == shared_rows(pairs[1][0])
    got, want = (ordering.newest_first(df, ["v", key]) for df, key in ((awkward, "k.x"), (plain, "k")))
    assert [r.v for r in got.collect()] == [r.v for r in want.collect()] and got.columns == awkward.columns
    assert projection.rename_only(awkward, {"k.x": "k"}).columns == ["k"]


# --- first values and slices -------------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 7, 13])
def test_rollup_does_not_depend_on_partitions(spark, sf_dir, partitions):
    hours = hour_dirty(spark, sf_dir).withColumn("instant", F.expr("case when registered % 3 = 0 then '5' else instant end"))
    want = rollup.rollup(hours.coalesce(1), "dteday", rollup.DAY_MEASURES)
    got = rollup.rollup(hours.repartition(partitions), "dteday", rollup.DAY_MEASURES)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # The whole-row aggregate over all rows, as the definition has it.
    order = F.col("instant").try_cast("bigint")
    rest = [F.col(c) for c in hours.columns if c != "dteday"]
    firsts = [m.column for m in rollup.DAY_MEASURES if m.kind == "first"]
    direct = hours.where("dteday is not null").groupBy("dteday").agg(
        *[first_non_null(F.col(c), hours.schema[c].dataType, order, rest).alias(c) for c in firsts]
    )
    assert sorted(map(str, got.select("dteday", *firsts).collect())) == sorted(map(str, direct.collect()))


def test_a_callable_sees_its_whole_group_in_order(spark):
    df = spark.range(30_000, numPartitions=6).selectExpr("if(id % 3 = 0, null, id % 5) as `k.x`", "id as v", "id % 2 as w")

    def check(batches, n):
        seen = [v for b in batches for v in b.column("v").to_pylist()]
        return f"{n} {len(seen)} {seen == sorted(seen)} {sum(seen)}"

    out = udaf.aggregate_slices(df, "k.x", ["v", "w"], check, T.StringType(), "told", ["v"])
    # One shuffle for the counts and one, sorted once, for the rows.
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning") == 2 and text.count("Sort [") == 1
    want = df.where("`k.x` is not null").groupBy("`k.x`").agg(F.count("v"), F.sum("v")).collect()
    assert dict(map(tuple, out.collect())) == {k: f"{n} {n} True {s}" for k, n, s in want}
    stops = udaf.aggregate_slices(df, "k.x", ["v"], lambda batches, n: next(batches).num_rows > 0, T.BooleanType(), "some", ["v"])
    assert {r.some for r in stops.collect()} == {True}
    assert udaf.aggregate_slices(df.where("false"), "k.x", ["v"], check, T.StringType(), "told").count() == 0


def test_a_hot_group_takes_no_more_memory_than_a_small_one(spark):
    """Three million rows in one group, fifty in another."""
    df = spark.range(3_000_000).selectExpr("if(id < 50, 'small', 'hot') as k", "repeat(string(id), 20) as v")

    def peak(batches, n):
        import resource

        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        total = sum(b.num_rows for b in batches)
        return f"{total} {(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024}"

    got = dict(map(tuple, udaf.aggregate_slices(df, "k", ["v"], peak, T.StringType(), "peak").collect()))
    total, grown = map(int, got["hot"].split())
    assert total == 3_000_000 - 50 and grown < 150  # MB; the group holds 400
