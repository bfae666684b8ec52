import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F, types as T

from scorestream.operators import classifiers
from scorestream.schemas import flower_schema, review_schema
from scorestream.sources import artifacts, batch, sinks, streams
from scorestream.streaming.messages import parse_json_messages
from scorestream.workspace import materialize, scratch_path, shared_root

FLOWERS = """5.1,3.5,1.4,0.2,Iris-setosa
7.0,3.2,4.7,1.4,Iris-versicolor
6.3,3.3,6.0
wide,3.0,5.9,2.1,Iris-virginica
6.3,2.9,5.6,1.8,Iris-virginica,extra
6.5,3.0,5.8,2.2,Iris-virginica
"""


@pytest.fixture
def flower_file(tmp_path):
    path = tmp_path / "flowers.csv"
    path.write_text(FLOWERS)
    return str(path)


def test_malformed_csv_rows_are_dropped(spark, flower_file):
    df = batch.csv_scan(spark, flower_file, flower_schema(T.DoubleType()), header=False)
    assert [r.sepal_length for r in df.collect()] == [5.1, 7.0, 6.5]


def test_a_count_sees_the_same_rows_as_a_full_read(spark, flower_file):
    df = batch.csv_scan(spark, flower_file, flower_schema(), header=False)
    assert df.count() == 3
    assert df.select("species").count() == len(df.select("species").collect()) == 3


def test_csv_without_schema_is_all_text(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("stars,text\n5.0,good\nx,bad\n")
    df = batch.csv_scan(spark, str(path))
    assert [f.dataType for f in df.schema.fields] == [T.StringType()] * 2
    assert df.count() == 2


def test_json_schema_and_inference(spark, tmp_path):
    path = str(tmp_path / "json")
    df = spark.createDataFrame([("b", 1, "2020-01-01", 0, "r", 5.0, "hi", 2, "u")], review_schema())
    sinks.write_json(df, path)
    with pytest.raises(Exception):
        sinks.write_json(df, path)
    assert batch.json_scan(spark, path, review_schema()).collect() == df.collect()
    inferred = batch.json_scan(spark, [path, path])
    assert dict(inferred.dtypes)["cool"] == "bigint" and inferred.count() == 2


def test_binary_scan_by_name(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.jpg").write_bytes(b"123")
    (tmp_path / "a" / "y.txt").write_bytes(b"12345")
    df = batch.binary_scan(spark, str(tmp_path), "*.jpg")
    assert [(r.length, bytes(r.content)) for r in df.collect()] == [(3, b"123")]
    assert df.columns == ["path", "modificationTime", "length", "content"]


def test_whole_text_scan(spark, tmp_path):
    (tmp_path / "x.txt").write_text("a\nb\n")
    rows = batch.whole_text_scan(spark, str(tmp_path)).collect()
    assert [r.value for r in rows] == ["a\nb\n"] and rows[0].file_path.endswith("x.txt")


def test_driver_rows_and_views(spark):
    df = batch.driver_rows(spark, [("a", 1)], "name string, n int")
    sinks.register_view(df, "little")
    assert spark.table("little").collect() == df.collect()


def test_published_rows_come_back_whole(spark, tmp_path):
    path = str(tmp_path / "topic")
    df = spark.createDataFrame([(1, "a", None), (2, "b, \"c\"", 0.5)], "k int, s string, v double")
    sinks.publish(sinks.json_messages(df, "k"), path)
    topic = spark.read.parquet(path)
    assert sorted(bytes(r.key) for r in topic.collect()) == [b"1", b"2"]
    assert sorted(parse_json_messages(topic, df.schema).collect()) == sorted(df.collect())


def test_empty_lines_are_not_published(spark):
    lines = spark.createDataFrame([("a",), ("",)], "value string")
    assert [bytes(r.value) for r in sinks.line_messages(lines).collect()] == [b"a"]


def test_topic_options():
    assert streams.kafka_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "subscribe": "t"}
    full = streams.kafka_options("h:1", "t", "earliest", False, 10)
    assert full["startingOffsets"] == "earliest" and full["failOnDataLoss"] == "false"
    assert full["maxOffsetsPerTrigger"] == "10"


def test_models_are_saved_loaded_and_chained(spark, tmp_path):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 3.0), (0.0, 0.5), (1.0, 2.5)], "label double, x double")
    assembler = VectorAssembler(inputCols=["x"], outputCol="features")
    model = classifiers.logistic(maxIter=5, regParam=0.3).fit(assembler.transform(df))
    path = str(tmp_path / "lr")
    artifacts.save_model(model, path)
    with pytest.raises(Exception):
        artifacts.save_model(model, path)
    artifacts.save_model(model, path, overwrite=True)
    loaded = artifacts.load_model(LogisticRegressionModel, path)
    chained = artifacts.chain_models(assembler, loaded)
    expected = model.transform(assembler.transform(df)).select("prediction").collect()
    assert chained.transform(df).select("prediction").collect() == expected


def test_scratch_follows_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_root(spark) == configured.rstrip("/")
    assert scratch_path(spark, "a").startswith(shared_root(spark))
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    copy = materialize(spark.range(5).where(F.col("id") > 7), "empty")
    assert copy.count() == 0 and copy.columns == ["id"]
