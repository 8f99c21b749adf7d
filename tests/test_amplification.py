"""Noisy copies of trips."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kerbside.operators.amplification import amplify, amplify_lines
from kerbside.sources.periods import write_csv_period

LINE = "V1,2013-03-10 02:30:00,2013-03-10 02:45:30,3,1.5,-73.98765,40.75,1,N,,x"
FORMAT = "%Y-%m-%d %H:%M:%S"


def copies(spark, *lines, **options):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    return amplify_lines(df, **options).orderBy("copy").collect()


def test_a_line_and_its_two_copies(spark):
    first, second = copies(spark, LINE)
    for years, row in ((7, first), (14, second)):
        fields, old = row.value.split(","), LINE.split(",")
        start, end = (datetime.strptime(text, FORMAT) for text in fields[1:3])
        assert abs((start - datetime(2013 - years, 3, 10, 2, 30)).total_seconds()) <= 250
        assert (end - start).total_seconds() == 930
        assert int(fields[3]) in (3, 4)
        assert abs(float(fields[5]) + 73.98765) < 1.01e-4 and abs(float(fields[6]) - 40.75) < 1.01e-4
        assert all(len(text.split(".")[1]) <= 5 for text in fields[5:7])
        assert [fields[0], fields[4], fields[7:]] == [old[0], old[4], old[7:]]
        assert (row.period_year, row.period_month) == (2013 - years, 3)


@pytest.mark.parametrize(
    ("line", "count"),
    [
        (LINE.replace("2013-03-10", "2012-02-29"), 0),
        (LINE.replace("2013-03-10", "2016-02-28"), 2),
        (LINE.replace("2013-03-10 02:45:30", "never"), 0),
        (LINE.replace("-73.98765", "x"), 0),
        ("V1,2013-03-10 02:30:00,2013-03-10 02:45:30,3,1.5,-73.98765", 0),
        ("V1,2013-03-10 02:30:00,2013-03-10 02:45:30,3,1.5,-73.98765,40.75", 2),
        ("header", 0),
        (LINE.replace("2013", "1910"), 1),
        ("  " + LINE + "  ", 2),
    ],
)
def test_which_lines_are_copied(spark, line, count):
    assert len(copies(spark, line)) == count


def test_leap_day_survives_a_shift_to_a_leap_year(spark):
    assert len(copies(spark, LINE.replace("2013-03-10", "2012-02-29"), copies=(4,))) == 1


def test_bad_passengers_only_matter_when_raised(spark):
    lines = [LINE.replace(",3,", ",x,").replace("V1", f"V{i}") for i in range(400)]
    kept = copies(spark, *lines, copies=(1,))
    assert 250 < len(kept) < 350
    assert {row.value.split(",")[3] for row in kept} == {"x"}


def test_noise_is_even(spark):
    lines = spark.range(8000).select(F.concat(F.lit("V"), "id", F.lit(LINE[2:])).alias("value"))
    found = [row.value.split(",") for row in amplify_lines(lines, copies=(1,)).collect()]
    seconds = Counter((datetime.strptime(f[1], FORMAT) - datetime(2006, 3, 10, 2, 30)).total_seconds() for f in found)
    assert min(seconds) == -250 and max(seconds) == 249 and len(seconds) == 500
    steps = Counter(round((float(f[5]) + 73.98765) * 1e5) for f in found)
    assert sorted(steps) == list(range(-10, 10))
    assert 0.22 < sum(f[3] == "4" for f in found) / len(found) < 0.28


def test_seed_and_repeat(spark):
    once, again, other = (copies(spark, LINE, seed=seed) for seed in (0, 0, 1))
    assert once == again != other


def test_typed_trips_keep_their_columns(spark):
    trips = spark.createDataFrame(
        [("k", "2013-03-10 02:30:00", "2013-03-10 02:20:00", 3, -73.98765, 40.75, "kept")],
        "trip_key string, datetime string, dropoff string, passengers int, longitude double, latitude double, extra_column string",
    )
    rows = amplify(trips, key=["trip_key"]).collect()
    assert [row.copy for row in rows] == [1, 2]
    for row in rows:
        assert row.extra_column == "kept"
        # A drop-off before the pick-up stays that way.
        assert (datetime.strptime(row.dropoff, FORMAT) - datetime.strptime(row.datetime, FORMAT)).total_seconds() == -600


def test_one_folder_per_month(spark, tmp_path):
    lines = spark.createDataFrame([(LINE,), (LINE.replace("-03-10", "-04-10"),)], "value string")
    amplified = amplify_lines(lines)
    write_csv_period(amplified, str(tmp_path / "out"))
    folders = {str(path.parent.relative_to(tmp_path / "out")) for path in (tmp_path / "out").rglob("*.txt")}
    assert folders == {f"period_year={year}/period_month={month}" for year in (2006, 1999) for month in (3, 4)}
    stored = spark.read.text(str(tmp_path / "out"))
    assert sorted(stored.select("value").collect()) == sorted(amplified.select("value").collect())


def test_nothing_is_shuffled(spark, plan):
    text = plan(amplify_lines(spark.createDataFrame([(LINE,)], "value string")))
    assert "Exchange" not in text and "Python" not in text
