"""What the queries of streets leave on disk while they run."""

import os
import time

import pytest
from pyspark.sql import functions as F

from waymesh.operators import streets
from waymesh.operators.durable import checkpointed, settled, shared_dir
from waymesh.plans import catalog

DATA = "/root/testdata/sf0.001"


def folders(spark):
    top = shared_dir(spark).removeprefix("file://")
    return {os.path.join(top, x) for x in os.listdir(top)}


def steps(spark, name):
    """The result's number of rows, and the columns of each step that is on disk when a query has been planned."""
    old = folders(spark)
    rows = catalog.queries()[name](spark, DATA)
    return rows.count(), [set(spark.read.parquet(x).columns) for x in folders(spark) - old if "/step-" in x]


def shuffle_files(spark):
    every = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for k in range(every.size()) if (f := every.apply(k).getName()).startswith("shuffle_")}


def test_a_step_leaves_no_shuffle(spark):
    old = shuffle_files(spark)
    rows = checkpointed(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 10
    while shuffle_files(spark) - old and time.time() < until:  # they go in the background
        time.sleep(0.1)
    assert not shuffle_files(spark) - old and rows.count() == 7


def test_settled_removes_what_it_passed(spark):
    old = folders(spark)
    rows = settled(lambda: settled(lambda: checkpointed(spark.range(9))).where("id > 3"))
    assert len(folders(spark) - old) == 1 and sorted(r.id for r in rows.collect()) == [4, 5, 6, 7, 8]


@pytest.mark.parametrize("name", ["encode_roundtrip", "json_intersection"])
def test_intersections_write_no_references(spark, name):
    n, found = steps(spark, name)
    assert n > 1000 and not any({"location_references", "points", "inbound"} & x for x in found)
    assert len(found) == 1  # the placed segments


@pytest.mark.parametrize("name", ["json_geometry", "tile_records"])
def test_streets_write_one_frame(spark, name):
    """The measured geometries, and the list of repeated ids; no frame of references or of streets beside them."""
    n, found = steps(spark, name)
    assert n > 1000 and len(found) == 2 and {"level", "geometry_id", "least"} in found
    assert not any({"location_references", "forward_reference_id", "inbound"} & x for x in found)


def test_measured_geometries_tell_the_same(spark):
    rows = catalog._measured(spark, DATA).cache()
    bare = rows.drop("measured")
    # A second segment with the geometry of each tenth: the least one stays.
    copies = lambda x: x.unionByName(x.where("crc32(seg_key) % 10 = 0").withColumn("seg_key", F.concat("seg_key", F.lit("x"))))
    told = streets.street_geometries(copies(rows)).drop("metadata")
    want = streets.street_geometries(copies(bare), streets.references(copies(bare))).drop("metadata").select(told.columns)
    assert told.count() == bare.count() and not told.where("seg_key like '%x'").count()
    assert told.exceptAll(want).isEmpty() and want.exceptAll(told).isEmpty()


def test_shares_of_tiles_are_all_records(spark):
    from waymesh.sources import tile_files

    parts = catalog._records_of(catalog._measured(spark, DATA).where("level = 2").cache())
    whole = tile_files.tile_records(*parts).cache()
    one = whole.agg(F.min("tile")).first()[0]
    split = [tile_files.tile_records(*parts, among=lambda tile, k=k: (tile == one) == F.lit(k)) for k in (True, False)]
    assert all(0 < x.count() < whole.count() for x in split)
    both = split[0].unionByName(split[1])
    assert both.count() == whole.count() and whole.exceptAll(both).isEmpty()


def test_files_make_room(spark):
    """Files are gone when they have been read back."""
    old = folders(spark)
    assert catalog.queries()["tile_files_written"](spark, DATA).count() == 48
    assert not [x for x in folders(spark) - old if "/tiles-" in x and os.path.exists(x)]
