import importlib


def test_entry_smoke(spark):
    m = importlib.import_module("__spark_entry__")
    df = m.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["level", "zone", "date"] and df.columns[-1] == "FC"
    assert {r.level for r in df.select("level").distinct().collect()} == {"zone", "region"}


def test_contract_keys():
    m = importlib.import_module("__spark_entry__")
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


def test_scale_conf_bounds():
    from firn.session import scale_conf
    small, big = scale_conf(10 ** 6), scale_conf(100 * 2 ** 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.shuffle.partitions"] == "122880"
    assert int(scale_conf(10 ** 18)["spark.sql.shuffle.partitions"]) > 1_000_000  # no upper limit
    assert big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == big["spark.sql.shuffle.partitions"]
    assert "RocksDB" in big["spark.sql.streaming.stateStore.providerClass"]
