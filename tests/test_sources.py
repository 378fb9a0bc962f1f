"""Reader options, schema fallback and working folders."""

import pytest

from tidemark import contracts as C
from tidemark.operators import layout
from tidemark.sources import streams, tables
from tidemark.plans import catalog
from tidemark.workspace import ensure_folder, exists, new_folder, shared_root


def test_bootstrap_order():
    assert streams.bootstrap_servers("a:1", "b:1", "c:1") == "a:1"
    assert streams.bootstrap_servers(None, "b:1", "c:1") == "b:1"
    assert streams.bootstrap_servers("", "", "c:1") == "c:1"
    with pytest.raises(ValueError):
        streams.bootstrap_servers()


def test_kafka_options():
    assert streams.kafka_options("a:1", "ticks") == {
        "kafka.bootstrap.servers": "a:1", "subscribe": "ticks", "startingOffsets": "latest",
    }
    assert streams.kafka_options("a:1", "t", "earliest", 10)["maxOffsetsPerTrigger"] == "10"
    with pytest.raises(ValueError):
        streams.kafka_options("a:1", "t", "middle")
    assert streams.kafka_sink_options("a:1", "t")["kafka.acks"] == "all"


def test_schema_or(spark, tmp_path):
    absent, empty, filled = (str(tmp_path / n) for n in ("absent", "empty", "filled"))
    ensure_folder(spark, empty)
    spark.range(1).write.parquet(filled)
    assert tables.schema_or(spark, absent, C.MESSAGE_SCHEMA) == C.MESSAGE_SCHEMA
    assert tables.schema_or(spark, empty, C.MESSAGE_SCHEMA) == C.MESSAGE_SCHEMA
    assert tables.schema_or(spark, filled, C.MESSAGE_SCHEMA).names == ["id"]


def test_new_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first.startswith(root) and second.startswith(root) and first != second
    assert not exists(spark, first)
    ensure_folder(spark, first)
    assert exists(spark, first)


class _Session:
    """Just enough of a session to ask where shared files go."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})
        self.settings = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.conf = type("Conf", (), {"get": self.settings.get, "set": self.settings.__setitem__})


def test_shared_root():
    assert shared_root(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(_Session("yarn"))
    local = _Session("local[2]")
    assert shared_root(local) == shared_root(local)


def test_tables_may_be_folders_of_files(spark, tmp_path):
    """The catalogue reads and streams a table of many files as well as a single file."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    out = catalog.QUERIES["stream_bronze"](spark, str(tmp_path))
    assert out.count() == events.count()


def test_database_statements():
    columns = ["k", "a", "b"]
    assert layout.upsert_statement("gold.t", "staging.t", columns, ["k"]) == (
        "INSERT INTO gold.t (k, a, b) SELECT k, a, b FROM staging.t "
        "ON CONFLICT (k) DO UPDATE SET a = EXCLUDED.a, b = EXCLUDED.b"
    )
    assert layout.insert_if_absent_statement("t", "s", columns).endswith("ON CONFLICT DO NOTHING")


def test_database_columns(spark):
    df = spark.sql("select 1 as k, array('a', null) as notes")
    assert layout.database_columns(df).collect() == [(1, '["a",null]')]
    assert layout.jdbc_properties("u", "p", "d") == {
        "user": "u", "password": "p", "driver": "d", "batchsize": "500",
    }
