import pytest

from tessera.sources import read, write


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    write(df, f"{tmp_path}/t", fmt)
    assert sorted(read(spark, f"{tmp_path}/t", fmt, "k long, v string").collect()) == sorted(df.collect())


def test_partitioned_sink_prunes(spark, tmp_path):
    write(spark.range(10).selectExpr("id", "id % 2 AS p"), f"{tmp_path}/t", partition_by=("p",))
    rows = read(spark, f"{tmp_path}/t").filter("p = 1")
    assert rows.count() == 5
    assert "PartitionFilters: [isnotnull(p" in rows._jdf.queryExecution().toString()


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        read(spark, str(tmp_path), "nope")


def test_text_xml_and_binary(spark, tmp_path):
    write(spark.createDataFrame([("a",), ("é b",)], "value string"), f"{tmp_path}/text", "text")
    assert sorted(r.value for r in read(spark, f"{tmp_path}/text", "text").collect()) == ["a", "é b"]
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    write(df, f"{tmp_path}/xml", "xml", options={"rowTag": "row"})
    assert sorted(read(spark, f"{tmp_path}/xml", "xml", "k long, v string", {"rowTag": "row"}).collect()) == sorted(df.collect())
    files = read(spark, f"{tmp_path}/text", "binaryFile", options={"pathGlobFilter": "*.txt"}).collect()
    assert sorted(bytes(f.content) for f in files if f.length) == ["a\n".encode(), "é b\n".encode()]
    with pytest.raises(ValueError):
        write(df, f"{tmp_path}/no", "binaryFile")


def test_bucketed_tables_join_without_shuffle(spark):
    from tessera.sources import write_bucketed

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bucketed_a", "bucketed_b"):
            write_bucketed(spark.range(100).selectExpr("id AS k", f"id * 2 AS {name}"), name, 4, "k", mode="overwrite")
        rows = spark.table("bucketed_a").join(spark.table("bucketed_b"), "k")
        assert rows.count() == 100 and "Exchange hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_a", "bucketed_b"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_object_store_sets_the_endpoint(spark):
    from tessera.sources import object_store

    object_store(spark, "http://store.example:9000")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    assert conf.get("fs.s3a.endpoint") == "http://store.example:9000" and conf.get("fs.s3a.path.style.access") == "true"


def test_rate_source(spark, tmp_path):
    query = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 5).load().writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(once=True).start(f"{tmp_path}/t")
    query.awaitTermination()
    assert read(spark, f"{tmp_path}/t").count() == 5


def test_python_data_source(spark):
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Numbers(DataSource):
        @classmethod
        def name(cls):
            return "numbers"

        def schema(self):
            return "n int"

        def reader(self, schema):
            class Reader(DataSourceReader):
                def partitions(self):
                    return [InputPartition(i) for i in range(3)]

                def read(self, partition):
                    yield (partition.value,)

            return Reader()

    spark.dataSource.register(Numbers)
    assert sorted(r.n for r in spark.read.format("numbers").load().collect()) == [0, 1, 2]
