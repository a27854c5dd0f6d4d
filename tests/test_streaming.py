

def test_stream_queries_read_a_directory_of_parts(spark, tmp_dir):
    from ticksmith.plans.catalog import QUERIES
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_dir}/events.parquet")
    for name in ("stream_bars", "stream_bronze"):
        one, many = QUERIES[name](spark, "/root/testdata/sf0.001"), QUERIES[name](spark, tmp_dir)
        assert one.count() == many.count() > 0
        assert one.exceptAll(many).count() == 0
