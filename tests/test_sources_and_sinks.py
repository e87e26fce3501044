"""Named sources, published versions, day partials, ordered exports and the exact sample."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallyrec.functions.ids import md5_key, smallest_hashes
from tallyrec.operators import interactions, posts
from tallyrec.params import DEFAULT
from tallyrec.plans.daily import DailyRun, store_partials
from tallyrec.session import scratch_path
from tallyrec.sources import io, named, versions

from conftest import SMALL


@pytest.fixture(scope="module")
def catalog(spark):
    """The fixtures as catalog tables (views, clicks: one a channel), named in all the ways a job may name them."""
    src = named.fixture_sources(spark, SMALL)
    spark.sql("create database if not exists job location '" + scratch_path(spark, "db") + "'")
    entries = {}
    for name in named.LAYOUTS:
        entries[name] = []
        for i, df in enumerate(src.parts(name)):
            table = f"job.{name}_{i}"
            df.withColumn("extra", F.lit(1)).write.mode("overwrite").option("path", scratch_path(spark, name)).saveAsTable(table)
            entries[name].append({0: table, 1: f"spark_catalog.{table}", 2: f"select * from {table}"}[i % 3])
    yield named.named_sources(spark, entries, src.as_of, src.orders_as_of)
    spark.sql("drop database job cascade")


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_run_over_catalog_tables_gives_the_same_feed(spark, run, catalog):
    other = DailyRun(spark, "", DEFAULT, sources=catalog)
    assert rows(other.interactions) == rows(run.interactions)
    assert rows(other.meta) == rows(run.meta)
    assert rows(other.recs) == rows(run.recs)
    assert rows(other.outbound.drop("import_time_stamp")) == rows(run.outbound.drop("import_time_stamp"))


def test_sources_are_checked(spark, catalog):
    with pytest.raises(ValueError, match="lacks post_id"):
        named.laid_out(spark.range(3).selectExpr("'a' as anonymous_id", "now() as received_at"), "views")
    with pytest.raises(ValueError, match="missing.*views"):
        named.named_sources(spark, {k: v for k, v in catalog.entries.items() if k != "views"}, catalog.as_of)
    with pytest.raises(ValueError, match="not known.*visits"):
        named.named_sources(spark, {**catalog.entries, "visits": "job.views_0"}, catalog.as_of)
    got = named.laid_out(spark.sql("select 1 as post_id, 'k' as meta_key, 2 as meta_id, 3 as meta_value, 9 as more"), "postmeta")
    assert got.schema.simpleString() == "struct<post_id:bigint,meta_id:bigint,meta_key:string,meta_value:string>"
    query = named.Sources(spark, {"options": "with o as (select 'a' option_name, 'b' option_value) select * from o"}, None, None)
    assert [tuple(r) for r in query.table("options").collect()] == [("a", "b")]


def test_readers_see_the_old_table_until_the_new_one_is_whole(spark):
    path = scratch_path(spark, "published")
    assert versions.read_published(spark, path) is None
    versions.publish(spark.range(3), path)
    old = versions.read_published(spark, path)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        versions.publish(broken, path)
    assert old.count() == versions.read_published(spark, path).count() == 3
    versions.publish(spark.range(5), path)
    assert versions.read_published(spark, path).count() == 5 and old.count() == 3  # a reader of the old version still reads it
    assert versions.drop_superseded(spark, path) >= 1
    assert versions.read_published(spark, path).count() == 5
    for day, n in (("2024-01-01", 2), ("2024-01-02", 3), ("2024-01-01", 4)):
        io.append_batch(spark.range(n), path + "-days", dt.datetime.fromisoformat(day))
    assert versions.read_published(spark, path + "-days").count() == 7
    assert versions.read_published(spark, path + "-days", before="2024-01-02").count() == 4


def test_a_failed_swap_restores_the_old_table(spark, monkeypatch):
    path = scratch_path(spark, "table")
    io.replace_table(spark.range(4), path)
    real = io._folder

    class Fs:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            return False if ".new-" in a.toString() else self.fs.rename(a, b)

    monkeypatch.setattr(io, "_folder", lambda s, p: (Fs(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(OSError, match="cannot move the new table"):
        io.replace_table(spark.range(9), path)
    assert spark.read.parquet(path).count() == 4


def test_one_ordered_file_from_several_tasks(spark):
    path = scratch_path(spark, "ordered")
    df = spark.range(0, 5000, 1, 6).select((F.col("id") * 7919 % 5000).alias("k"), F.when(F.col("id") % 3 == 0, None).otherwise(
        F.concat(F.lit('a "b",\n'), F.col("id").cast("string"))).alias("text, of \"k\""))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        io.write_csv(df, path, order_by=["k"])
        io.write_csv(df, path, order_by=["k"])  # overwrites
        io.write_csv(df, path + "-parts", order_by=["k"], single_file=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    local = path.removeprefix("file:")
    assert [f for f in os.listdir(local) if f.endswith(".csv")] == ["part-00000.csv"]
    parts = sorted(f for f in os.listdir(local + "-parts") if f.endswith(".csv"))
    assert len(parts) > 1  # several tasks sort and write
    for p in (path, path + "-parts"):
        got = io.read_csv(spark, p, df.schema)
        assert rows(got) == rows(df)
    order = [r.k for r in io.read_csv(spark, path, df.schema).collect()]
    assert order == list(range(5000))  # SRT1: the file's own row order
    assert [r.k for f in parts for r in io.read_csv(spark, f"{path}-parts/{f}", df.schema).collect()] == list(range(5000))
    io.write_csv(df.limit(0), path, order_by=["k"])
    assert io.read_csv(spark, path, df.schema).count() == 0


@pytest.mark.parametrize("n", [1, 40, 999, 5000])
def test_smallest_hashes_equal_an_ordered_limit(spark, n):
    df = spark.range(0, 1500, 1, 12).select(F.col("id").cast("string").alias("u"), F.lit(1).alias("x"))
    want = df.orderBy(md5_key("u", salt="s"), "u").limit(n)
    assert rows(smallest_hashes(df, n, ["u"], "s")) == rows(want)


def test_no_task_of_the_sample_sees_many_times_n(spark):
    df = spark.range(0, 200_000, 1, 64).select(F.col("id").cast("string").alias("u"))
    n, near = 50, []
    count = type(df).count

    def counted(self):
        near.append(count(self))
        return near[-1]

    type(df).count = counted
    try:
        assert count(smallest_hashes(df, n, ["u"], "s")) == n
    finally:
        type(df).count = count
    assert near[0] == 200_000 and n <= near[-1] <= 3 * n  # 64 splits x 50 rows would be 3,200
    equal = spark.range(300).selectExpr("'x' as u")  # all hashes equal: the cutoff widens until enough are in
    assert count(smallest_hashes(equal, 7, ["u"], "s")) == 7


def _events(spark, entries):
    return spark.createDataFrame([(a, p, dt.datetime.fromisoformat(t)) for a, p, t in entries],
                                 "anonymous_id string, post_id string, received_at timestamp_ntz")


def test_a_run_reads_one_new_day_and_replaces_late_ones(spark, run, monkeypatch):
    src = named.fixture_sources(spark, SMALL)
    path = scratch_path(spark, "days")
    read = []
    real = interactions.day_partials

    def noted(kind, sources, since, until=None):
        if kind == "views":
            read.append((since, until))
        return real(kind, sources, since, until)

    monkeypatch.setattr(interactions, "day_partials", noted)
    early = named.Sources(spark, dict(src.entries), src.as_of - dt.timedelta(days=1), src.orders_as_of)
    views = spark.createDataFrame([], "anonymous_id string, post_id string, received_at timestamp_ntz")
    for df in src.parts("views"):
        views = views.unionByName(df)
    day, late = src.as_of.date(), src.as_of.date() - dt.timedelta(days=9)
    seen = views.where((F.col("received_at") < F.lit(day)) & ~((F.to_date("received_at") == F.lit(late)) & (F.hash("post_id") % 2 == 0)))
    early.entries["views"] = seen  # the day before: no events of the run day yet, and half of an older day still under way
    store_partials(early, path, 28)
    assert len(read) == 1 and (read[0][0], read[0][1]) == (late - dt.timedelta(days=20), None)
    read.clear()
    got = store_partials(src, path, 28, late_days=0)
    assert read == [(day, None)]
    want = real("views", src.parts("views"), day - dt.timedelta(days=28))
    window = F.col("day") >= F.lit(day - dt.timedelta(days=28))
    assert rows(got["views"].where(window).select(want.columns)) != rows(want)  # the late events are missing
    read.clear()
    got = store_partials(src, path, 28, late_days=1, again=(late,))
    assert read == [(late, late + dt.timedelta(days=1)), (day - dt.timedelta(days=1), None)]
    assert rows(got["views"].where(window).select(want.columns)) == rows(want)
    again = DailyRun(spark, SMALL, DEFAULT, setup=run.setup, partials=got)
    for a, b in zip(again.activity, run.activity, strict=True):
        assert rows(a) == rows(b.select(a.columns))


def test_content_is_deduplicated_by_digest(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    v = spark.createDataFrame([(1, "b", t(3), t(4)), (1, "a", t(5), t(5)), (1, "b", t(9), t(1)), (1, None, t(1), t(1)), (2, "", t(1), t(1))],
                              "id long, post_content string, post_date timestamp_ntz, post_modified timestamp_ntz")
    base = spark.createDataFrame([("1",), ("2",)], "post_id string")
    out = posts.post_content(v, base)
    assert rows(out) == rows(spark.createDataFrame([("1", "b a"), ("2", "")], "post_id string, post_content string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert keys and not any("hashpartitioning" in line and "post_content" in line.split("ENSURE")[0] for line in keys)
