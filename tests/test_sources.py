"""CSV scans and stage tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripmetrics import functions as tm
from tripmetrics import schema
from fixtures import tables
from tripmetrics.operators import filters, records, trips
from tripmetrics.schema import WEATHER_COLUMNS
from tripmetrics.sources import (
    Stages,
    broken_records,
    load_stage,
    read_trips,
    read_weather,
    read_zips,
    record_summary,
    save_stage,
    scratch_path,
    stage,
    unreadable_fields,
    whole_records,
)

HEADER = (
    "Company,Fare,Taxi ID,Trip Start Timestamp,Trip End Timestamp,Trip Seconds,Trip Miles,Tips,"
    "Pickup Centroid Latitude,Pickup Centroid Longitude,Dropoff Centroid Latitude,Dropoff Centroid Longitude"
)


def write(tmp_path, name, *lines):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_columns_are_found_by_name(spark, tmp_path):
    path = write(
        tmp_path,
        "trips.csv",
        HEADER,
        '"Cab, Inc",12.5,abc,01/01/2018 12:15:00 AM,01/01/2018 12:30:00 AM,900,3.5,2,41.9,-87.6,41.8,-87.7',
        "Other,oops,def,01/01/2018 12:15:00 AM,,many,,,,,,",
    )
    trips = read_trips(spark, path)
    assert trips.schema.simpleString() == schema.TRIPS.simpleString()
    good, broken = trips.orderBy("taxi_id").collect()
    assert tuple(good) == (
        None, "abc", "01/01/2018 12:15:00 AM", "01/01/2018 12:30:00 AM", 900, 3.5, 12.5, 2.0, 41.9, -87.6, 41.8, -87.7,
    )
    assert broken.taxi_id == "def"
    assert [broken[c] for c in ("end_text", "trip_seconds", "trip_miles", "fare", "tips", "start_lat")] == [None] * 6


def test_only_used_columns_are_read(spark, tmp_path):
    path = write(tmp_path, "trips.csv", HEADER)
    plan = read_trips(spark, path).select("fare")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Fare:double>" in plan


def test_missing_columns_are_an_error(spark, tmp_path):
    path = write(tmp_path, "trips.csv", "Taxi ID,Fare", "a,1")
    with pytest.raises(ValueError, match="Trip Start Timestamp"):
        read_trips(spark, path)


def test_files_with_other_headers_are_an_error(spark, tmp_path):
    write(tmp_path, "a.csv", "zip,lat,lng", "60601,41.8,-87.6")
    write(tmp_path, "b.csv", "zip,lng,lat", "60602,-87.6,41.8")
    with pytest.raises(Exception, match="header"):
        read_zips(spark, str(tmp_path)).collect()


def test_weather(spark, tmp_path):
    path = write(
        tmp_path,
        "weather.csv",
        "Station Name,Measurement Timestamp,Interval Rain,Rain Intensity,Measurement ID",
        "Oak Street Weather Station,05/22/2015 03:00:00 PM,0.5,1.25,Oak1",
        ",never,,,",
    )
    rows = records.rain_records(read_weather(spark, path)).collect()
    by_station = {r.station: r for r in rows}
    assert by_station["OakStreetWeatherStation"].interval_rain == 0.5
    assert by_station[None].measured_ts is None and by_station[None].intensity == 0.0


def test_stage_by_year(spark, sf_dir, tmp_path):
    trips = records.normalize_trips(tables.trips_raw(spark, sf_dir))
    path = str(tmp_path / "trips")
    save_stage(trips, path, partition_by="year")
    loaded = load_stage(spark, path)
    assert sorted(loaded.columns) == sorted(trips.columns)
    assert loaded.count() == trips.count()
    assert loaded.select(*trips.columns).exceptAll(trips).count() == 0

    good = filters.year_slice(filters.good_trips(loaded), 2025).select("fare", "start_ts")
    plan = good._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(year" in scan
    assert all(f in scan for f in ("GreaterThanOrEqual(start_ts", "LessThanOrEqual(fare", "LessThanOrEqual(speed_mph"))
    assert "taxi_id" not in scan
    assert {r.year for r in loaded.select("year").distinct().collect()} == {2024, 2025, 2026}


def test_stage_writes_few_files(spark, tmp_path):
    """Each folder gets one file although every task holds rows of every folder."""
    path = str(tmp_path / "ids")
    save_stage(spark.range(0, 8000, 1, 8).withColumn("part", F.col("id") % 4), path, partition_by="part")
    assert len(list((tmp_path / "ids").glob("part=*/*.parquet"))) == 4


def test_stage_is_read_back_from_the_shared_folder(spark):
    staged = stage(spark.range(10), "test")
    assert sorted(r.id for r in staged.collect()) == list(range(10))
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert all(root.rstrip("/") in name for name in staged.inputFiles())
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key.replace(".", "_"), default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(spark_master="yarn"), "x")
    shared = scratch_path(Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/"), "x")
    assert shared.startswith("hdfs:///shared/tripmetrics-x-")


def test_a_machine_local_folder_needs_a_single_process():
    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, key, default=None):
            return self.master if key == "spark.master" else default

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    for master in ("local", "local[4]"):
        assert "tripmetrics-x-" in scratch_path(Session(master), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session("local-cluster[2,1,1024]"), "x")
    assert scratch_path(Session("yarn"), "x", "hdfs:///own/").startswith("hdfs:///own/tripmetrics-x-")


def test_partition_columns_keep_their_type(spark, tmp_path):
    path = str(tmp_path / "taxis")
    rows = [("007", 1, "a"), ("7", 2, "b"), ("2018-01-01", 3, "c")]
    save_stage(spark.createDataFrame(rows, "taxi_id string, n long, x string"), path, partition_by="taxi_id")
    loaded = load_stage(spark, path)
    assert sorted((r.taxi_id, r.n, r.x) for r in loaded.collect()) == sorted(rows)
    assert dict(loaded.dtypes) == {"taxi_id": "string", "n": "bigint", "x": "string"}


def test_unreadable_numbers_are_told_from_missing_ones(spark, tmp_path):
    path = write(
        tmp_path,
        "trips.csv",
        HEADER,
        "x,$12.50,a,,,900.0,NaN,,,,,",
        "x,12.5,b,,,900,3.5,1,,,,",
        "x,,c,,,many,Infinity,none,41.9,?,,",
    )
    plain, flagged = (read_trips(spark, path, flag_unreadable=f).orderBy("taxi_id").collect() for f in (False, True))
    for rows in (plain, flagged):
        assert [r.trip_seconds for r in rows] == [900, 900, None]
        assert [r.fare for r in rows] == [None, 12.5, None]
        assert [r.trip_miles for r in rows] == [None, 3.5, None]
    assert [sorted(r.unreadable) for r in flagged] == [
        ["fare", "trip_miles"], [], ["start_lng", "tips", "trip_miles", "trip_seconds"],
    ]
    counts = {r["column"]: r["unreadable"] for r in unreadable_fields(read_trips(spark, path, True)).collect()}
    assert counts == {
        "trip_seconds": 1, "trip_miles": 2, "fare": 1, "tips": 1, "start_lat": 0, "start_lng": 1, "end_lat": 0, "end_lng": 0,
    }


def rows_read(df):
    """Rows that the scan of a table gives, after row groups were skipped."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_row_groups_are_skipped(spark, tmp_path):
    """For a taxi that drives all year, by the ranges of a stage in order of taxis; in any order for one that isn't there."""
    n = 60_000
    trips = spark.range(n).select(
        F.col("id").alias("trip_id"),
        F.concat(F.lit("taxi-"), F.lpad((F.col("id") % 500).cast("string"), 4, "0")).alias("taxi_id"),
        (tm.year_one() + F.make_dt_interval(F.lit(736_000), F.lit(0), F.col("id").cast("int"))).alias("start_ts"),
        F.md5(F.col("id").cast("string")).alias("text"),
        F.lit(2018).alias("year"),
    )
    plain, ordered = str(tmp_path / "plain"), str(tmp_path / "ordered")
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "131072")
    try:
        save_stage(trips, plain, partition_by="year")
        save_stage(trips, ordered, partition_by="year", sort_by=("taxi_id", "start_ts"), look_up=("taxi_id",))
    finally:
        hadoop.unset("parquet.block.size")
    read = {}
    for path in (plain, ordered):
        for taxi in ("taxi-0077", "taxi-0077x"):
            found = filters.taxi_slice(load_stage(spark, path), taxi)
            assert found.count() == (120 if taxi == "taxi-0077" else 0)
            read[path, taxi] = rows_read(found)
    assert read[plain, "taxi-0077"] > n / 2 and read[ordered, "taxi-0077"] < n / 5, read
    assert read[ordered, "taxi-0077x"] == 0, read
    first = load_stage(spark, ordered).where("taxi_id = 'taxi-0003'").select("start_ts").collect()
    assert [r.start_ts for r in first] == sorted(r.start_ts for r in first)


def test_stages_hold_what_is_still_read(spark, tmp_path):
    live = lambda: sorted(p.name.rsplit("-", 1)[0] for top in tmp_path.iterdir() for p in top.iterdir())
    with Stages(spark, "sums", str(tmp_path)) as own:
        first = own.write(spark.range(100), "first")
        second = own.write(first.where("id > 50"), "second")
        assert live() == ["first", "second"]
        third = own.write(first.join(second, "id"), "third", done=("first", "second"), result=True)
        assert live() == ["third"]
        own.write(third.limit(1), "left behind")
        with pytest.raises(ValueError):
            own.write(third, "third")
    assert live() == ["third"] and third.count() == 49
    with pytest.raises(RuntimeError):
        with Stages(spark, "failed", str(tmp_path)) as own:
            own.write(spark.range(3), "result", result=True)
            raise RuntimeError
    assert live() == ["third"] and len(list(tmp_path.iterdir())) == 1


def test_a_task_that_is_repeated_finds_its_input(spark, tmp_path):
    """A stage is removed after what reads it is complete: failing tasks are tried again on the same files."""
    with Stages(spark, "again", str(tmp_path)) as own:
        first = own.write(spark.range(0, 1000, 1, 4), "first")
        flag = tmp_path / "tried"

        def fail_once(batches):
            for batch in batches:
                if 500 in batch.column(0).to_pylist() and not flag.exists():
                    flag.touch()
                    raise RuntimeError("lost")
                yield batch

        if spark.conf.get("spark.task.maxFailures", "1") == "1" and spark.sparkContext.master.startswith("local["):
            with pytest.raises(Exception, match="lost"):
                own.write(first.mapInArrow(fail_once, "id long"), "broken", done=("first",))
            assert first.count() == 1000
        again = own.write(first.mapInArrow(fail_once, "id long"), "second", done=("first",), result=True)
    assert again.count() == 1000


TRIPS_HEADER = "Trip ID,Taxi ID,Trip Start Timestamp,Trip End Timestamp,Trip Seconds,Trip Miles,Fare,Tips"


def test_broken_rows_are_told_from_whole_ones(spark, tmp_path):
    whole = "1,007,01/05/2025 01:15:00 PM,01/05/2025 01:45:00 PM,1800,2.5,10,2"
    lines = [whole, "2,007,01/05/2025 01:15:00 PM,01/05/2025 01:45:00 PM", whole + ",9", "4" + whole[1:-1], "5,,,,,,,", "6", '"7, and more"' + whole[1:]]
    (tmp_path / "trips.csv").write_text("\n".join([TRIPS_HEADER, *lines]) + "\n")
    flagged = read_trips(spark, str(tmp_path / "trips.csv"), flag_unreadable=True)
    assert sorted(r.trip_id for r in whole_records(flagged).collect()) == ["1", "4", "5", "7, and more"]
    assert sorted(r.broken for r in broken_records(flagged).collect()) == sorted([lines[1], lines[2], lines[5]])
    assert tuple(record_summary(flagged).first()) == (4, 3, 0)
    summary = trips.quality_summary(records.normalize_trips(flagged)).first()
    assert (summary.trips, summary.good, summary.broken) == (4, 3, 3)
    # Also where a question uses few columns, and after a stage.
    assert whole_records(flagged).agg(F.sum("fare")).first()[0] == 30
    save_stage(records.normalize_trips(flagged), str(tmp_path / "stage"), partition_by="year")
    staged = load_stage(spark, str(tmp_path / "stage"))
    assert whole_records(staged).count() == 4 and broken_records(staged).count() == 3
    assert "broken" not in read_trips(spark, str(tmp_path / "trips.csv")).columns
    assert broken_records(read_trips(spark, str(tmp_path / "trips.csv"))).count() == 0


def test_broken_weather_and_a_column_of_the_same_name(spark, tmp_path):
    (tmp_path / "w.csv").write_text(
        "Station Name,broken,Measurement ID,Measurement Timestamp,Interval Rain,Rain Intensity\n"
        "Oak Street,x,m1,01/05/2025 01:00:00 PM,0.5,wet\nOak Street,x,m2,01/05/2025 01:00:00 PM\n"
    )
    flagged = read_weather(spark, str(tmp_path / "w.csv"), flag_unreadable=True)
    assert tuple(record_summary(flagged).first()) == (1, 1, 1)
    assert {tuple(r) for r in unreadable_fields(whole_records(flagged), WEATHER_COLUMNS).collect()} == {("interval_rain", 0), ("intensity", 1)}


def test_a_stage_without_partitions_is_loaded_as_it_is(spark, tmp_path):
    path = str(tmp_path / "plain")
    save_stage(spark.createDataFrame([(1, "007")], "n int, taxi_id string"), path)
    assert [tuple(r) for r in load_stage(spark, path).collect()] == [(1, "007")]
