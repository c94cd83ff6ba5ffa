from __future__ import annotations

from ledgerline import session


def test_shuffles_follow_the_input_size(spark, tmp_path, monkeypatch):
    spark.range(20_000).write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert session.size_shuffles(stored) == 4
    monkeypatch.setattr(session, "BYTES_PER_PARTITION", 4_000)
    try:
        grown = session.size_shuffles(stored)
        assert grown > 4 and spark.conf.get(session._INITIAL) == str(grown)
        monkeypatch.setattr(session, "MOST_PARTITIONS", 6)
        assert session.size_shuffles(stored) == grown
    finally:
        spark.conf.unset(session._INITIAL)


def test_unknown_sizes_change_nothing(spark, tmp_path):
    from ledgerline.sources.loader import RawStore
    from ledgerline.sources.schemas import TRANSACTIONS

    frames = [spark.createDataFrame([(1,)], "x int"), spark.range(3), RawStore(spark, str(tmp_path)).table(TRANSACTIONS)]
    assert [session.size_shuffles(f) for f in frames] == [4, 4, 4]
    assert spark.conf.get(session._INITIAL, None) is None


def test_settings_end_with_their_use(spark, tmp_path, monkeypatch):
    spark.range(20_000).write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    monkeypatch.setattr(session, "BYTES_PER_PARTITION", 1_000)
    with session.sized_shuffles(stored) as wanted:
        assert wanted > 4 and spark.conf.get(session._INITIAL) == str(wanted)
    assert spark.conf.get(session._INITIAL, None) is None


def test_settled_tables_go_with_their_block(spark):
    with session.settling(spark):
        inside = session.settle(spark.range(5), "five")
        path = inside.inputFiles()[0].rpartition("/")[0]
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        assert where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    assert not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def test_settled_tables_land_in_the_shared_folder(spark):
    settled = session.settle(spark.range(5), "five")
    shared = spark.conf.get("spark.checkpoint.dir")
    assert all(f.startswith(f"file://{shared}") for f in settled.inputFiles())
    assert session.fits_broadcast(settled, 5) and not session.fits_broadcast(settled, 4)


def test_methods_too_large_to_be_compiled_are_not_made(spark, tmp_path):
    from pyspark.sql import functions as F

    from ledgerline.functions.times import lenient_time

    session.configure(spark)
    texts = spark.createDataFrame([("2024 Jan 02 10:00",), ("soon",)], "t string")
    parsed = texts.select(lenient_time(F.col("t")).alias("t")).where("to_date(t) IS NOT NULL")
    plan = parsed.groupBy("t").count()
    assert plan.collect()[0]["count"] == 1
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000
