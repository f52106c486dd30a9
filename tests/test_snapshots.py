import datetime as dt
import pathlib
import tempfile

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from muster.sources import snapshots
from muster.sources.tables import shared_folder

DAY = dt.date(2022, 1, 15)


def folder():
    return tempfile.mkdtemp(prefix="muster-test-") + "/t"


def frame(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id int")


def test_replace_is_idempotent_and_guarded(spark):
    path = folder()
    for _ in range(2):
        assert snapshots.replace_snapshot(frame(spark, 1, 2), path, "d", DAY) == 2
        snapshots.replace_snapshot(frame(spark, 3), path, "d", DAY + dt.timedelta(days=1))
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,), (3,)]
    assert snapshots.replace_snapshot(frame(spark, 1).where("id > 9"), path, "d", DAY) == 0
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,), (3,)]
    snapshots.replace_snapshot(frame(spark, 1).where("id > 9"), path, "d", DAY, guard=False)
    assert rows(spark.read.parquet(path), "id") == [(3,)]


def test_retention_keeps_sundays_last_run_and_unknown_flags(spark):
    path = folder()
    for day in (15, 16, 17, 18, 18):  # Saturday onwards; the last day runs twice
        run = dt.date(2022, 1, day)
        new = frame(spark, day).withColumn("date", F.lit(run)).withColumn("to_delete", snapshots.retention_flag("date"))
        snapshots.retain_and_append(new, path, "date", run)
        snapshots.retain_and_append(new, path, "date", run)
    assert rows(spark.read.parquet(path), "id") == [(16,), (18,)]
    run = dt.date(2022, 1, 19)
    unknown = frame(spark, 19).withColumn("date", F.lit(run)).withColumn("to_delete", F.lit(None).cast("int"))
    snapshots.retain_and_append(unknown, path, "date", run)
    run = dt.date(2022, 1, 20)
    late = frame(spark, 20).withColumn("date", F.lit(run)).withColumn("to_delete", F.lit(1))
    snapshots.retain_and_append(late, path, "date", run)
    assert rows(spark.read.parquet(path), "id") == [(16,), (19,), (20,)]
    snapshots.retain_and_append(late.where("id > 99"), path, "date", run)
    assert rows(spark.read.parquet(path), "id") == [(16,), (19,)]


def test_retention_drops_flagged_rows_without_a_date_and_leaves_no_empty_folders(spark):
    path = folder()
    day = dt.date(2022, 1, 17)
    odd = frame(spark, 1, 2).withColumn("date", F.lit(None).cast("date")).withColumn("to_delete", F.when(F.col("id") == 1, 1).otherwise(0))
    snapshots.retain_and_append(odd, path, "date", day)
    new = frame(spark, 3).withColumn("date", F.lit(day)).withColumn("to_delete", F.lit(1))
    snapshots.retain_and_append(new, path, "date", day)
    assert rows(spark.read.parquet(path), "id") == [(2,), (3,)]
    later = day + dt.timedelta(days=1)
    snapshots.retain_and_append(new.withColumn("date", F.lit(later)), path, "date", later)
    assert rows(spark.read.parquet(path), "id") == [(2,), (3,)]
    assert sorted(p.name for p in pathlib.Path(path).glob("date=*/to_delete=*")) == ["to_delete=0", "to_delete=1"]
    snapshots.retain_and_append(new.where("id > 9"), path, "date", later)
    assert rows(spark.read.parquet(path), "id") == [(2,)]


def test_append_new_twice(spark):
    path = folder()
    for batch in ((1, 2), (1, 2), (2, 3)):
        snapshots.append_new(frame(spark, *batch), path, "id")
    assert rows(spark.read.parquet(path)) == [(1,), (2,), (3,)]


def test_append_strict_stops_at_null(spark):
    path = folder()
    snapshots.append_new(frame(spark, 1, None), path, "id", strict=True)
    snapshots.append_new(frame(spark, 2), path, "id", strict=True)
    assert rows(spark.read.parquet(path)) == [(1,), (None,)]
    snapshots.append_new(frame(spark, 2), path, "id")
    assert rows(spark.read.parquet(path)) == [(1,), (2,), (None,)]


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("target", [(1, 5, 9), (1, None), (None,), ()])
@pytest.mark.parametrize("batch", [(5, 6), (None,), (None, 7), (20,), ()])
def test_append_new_agrees_with_a_whole_read(spark, strict, target, batch):
    path = folder()
    frame(spark, *target).write.parquet(path)
    snapshots.append_new(frame(spark, *batch), path, "id", strict=strict)
    unknown = strict and target and (None in target)
    kept = [] if unknown else [i for i in batch if i not in target and (i is not None or not strict or not target)]
    if not strict:
        kept = [i for i in batch if i is None or i not in target]
    assert rows(spark.read.parquet(path)) == sorted([(i,) for i in (*target, *kept)], key=repr)


def test_append_new_reads_only_the_incoming_range(spark):
    path = folder()
    frame(spark, *range(100)).write.parquet(path)
    seen = plan(snapshots.stored_keys(spark.read.parquet(path), frame(spark, 40, 50), "id"))
    assert "GreaterThanOrEqual(id,40)" in seen and "LessThanOrEqual(id,50)" in seen


def test_work_folder_comes_from_the_session(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
