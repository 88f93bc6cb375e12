"""Stored tables: shared by later applications, published whole, sized by the data."""
from chartwise.sources import store


def test_second_application_reads_what_the_first_wrote(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(10)

    root = str(tmp_path)
    first = store.stored(spark, "k", "t", build, ("id",), ("id",), store_path=root)
    store._READS.clear()                      # what a new application starts with
    second = store.stored(spark, "k", "t", build, ("id",), ("id",), store_path=root)
    assert len(built) == 1 and first.count() == second.count() == 10


def test_a_table_published_by_another_application_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    spark.range(5).write.parquet(str(tmp_path / "_t-x"))
    store._publish(spark, str(tmp_path / "_t-x"), path)
    assert spark.read.parquet(path).count() == 3 and not (tmp_path / "_t-x").exists()


def test_partitions_grow_with_the_data(spark):
    some = store.partitions_for(spark, "/root/testdata/sf0.001", ["events.parquet"], bytes_each=1000)
    more = store.partitions_for(spark, "/root/testdata/sf0.01", ["events.parquet"], bytes_each=1000)
    assert more > 5 * some


def test_item_tables_are_written_without_a_shuffle_of_item_rows(spark, tmp_path):
    """Events are clustered before they unfold: rows of one patient and time share a file, and files follow the rows."""
    from pyspark.sql import functions as F

    from chartwise.sources import Sources

    at = F.timestamp_seconds(F.lit(1704067200) + (F.col("id") * 7919) % 2_000_000)
    events = spark.range(60_000).select(
        F.col("id").alias("event_id"), at.cast("timestamp_ntz").alias("ts"), ((F.col("id") * 31) % 97).alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit("").alias("props"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    labs = Sources.from_events(spark, str(tmp_path))["labevents"].select("subject_id", "charttime", F.input_file_name().alias("file"))
    places = labs.groupBy("subject_id", "charttime").agg(F.countDistinct("file").alias("files"))
    assert places.agg(F.max("files")).first()[0] == 1
    assert labs.select("file").distinct().count() == 3      # of 25,000 events each


def test_only_the_narrow_events_are_stored_not_their_item_rows(spark, tmp_path):
    """An event's some thirty charted and laboratory rows unfold from the scan of the events."""
    from pyspark.sql import functions as F

    from chartwise.sources import Sources

    events = spark.range(2_000).select(
        F.col("id").alias("event_id"), (F.lit("2024-01-02").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") % 900).cast("int"))).alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit("").alias("props"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    tables = Sources.from_events(spark, str(tmp_path))
    for name in ("chartevents", "labevents", "inputevents"):
        assert spark.read.parquet(*tables[name].inputFiles()).count() == 2_000
    assert tables["chartevents"].count() > 40_000 and tables["labevents"].count() > 40_000
    plain = Sources.from_events(spark, str(tmp_path), materialize=False)
    for name in ("chartevents", "labevents", "inputevents"):
        assert tables[name].exceptAll(plain[name]).isEmpty() and plain[name].exceptAll(tables[name]).isEmpty()


def test_kept_items_are_those_of_the_residue(spark):
    from pyspark.sql import functions as F

    from chartwise.sources import adapters
    from chartwise.sources import fixture_spec as S

    e = F.col("e")
    got = spark.createDataFrame([(-4,), (0,), (1,), (2,), (900_001,), (None,)], "e long").select("e", F.explode(
        adapters._kept_items(S.CHART_ITEMS, e, 3)).alias("it")).select("e", "it.itemid").collect()
    assert [tuple(r) for r in got] == [(v, i[0]) for v in (-4, 0, 1, 2, 900_001) for i in S.CHART_ITEMS if (v + i[0]) % 3 == 0]
