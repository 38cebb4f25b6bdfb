"""The join strategies chosen by measured size give the same encodings, also
with a key holding more than a third of all rows (AQE skew split)."""

from pyspark.sql import functions as F

from jobtide.operators.encode import apply_encodings, category_key, encoding_maps, global_mean


def _data(spark):
    # one hot organisation with 40 % of the rows, many small ones
    rows = [("hot", float(i % 7)) for i in range(4000)]
    rows += [(f"org{i % 900}", float(i % 13)) for i in range(6000)]
    return spark.createDataFrame(rows, "organization string, work_places double").repartition(8)


def _encode(df, literal_max, broadcast_max):
    g = global_mean(df, "work_places")
    maps = encoding_maps(df, ["organization"], {}, "work_places", 10, g)
    out = apply_encodings(df, maps, {"organization": category_key("organization")}, g,
                          broadcast_max, literal_max=literal_max)
    return {r["organization"]: r["organization_encoded"]
            for r in out.select("organization", "organization_encoded").distinct().collect()}


def test_literal_broadcast_and_shuffle_agree(spark):
    df = _data(spark)
    big = _encode(df, literal_max=10_000, broadcast_max=10_000)      # literal map
    bc = _encode(df, literal_max=0, broadcast_max=10_000)             # broadcast join
    old = {k: spark.conf.get(k) for k in (
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        sh = _encode(df, literal_max=0, broadcast_max=0)              # shuffle join
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert big.keys() == bc.keys() == sh.keys()
    for k in big:
        assert abs(big[k] - bc[k]) < 1e-12 and abs(big[k] - sh[k]) < 1e-12
    assert abs(big["hot"] - sum(i % 7 for i in range(4000)) / 4000) < 1e-12


def test_hot_group_demand_is_exact(spark):
    import datetime as dt
    from jobtide.operators.spans import demand_series
    rows = [(i, "hot" if i % 3 else f"g{i % 5}", dt.datetime(2020, 1, 1 + i % 28),
             dt.datetime(2020, 3 + i % 4, 1), 1) for i in range(3000)]
    sp = spark.createDataFrame(rows, "id long, grp string, start_ts timestamp, end_ts timestamp, weight long")
    out = demand_series(sp, "M", min_activity=1).filter(F.col("series") == "hot")
    got = {str(r["period"]): r["value"] for r in out.collect()}
    hot = [r for r in rows if r[1] == "hot"]
    exp_jan = sum(1 for r in hot)                          # every hot span is active in January
    exp_apr = sum(1 for r in hot if r[3].month > 4)
    assert got["2020-01-31"] == exp_jan and got["2020-04-30"] == exp_apr


def test_rendered_files_grow_with_the_rows(spark, monkeypatch):
    from jobtide.plans import queries as Q
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert Q._files_per_batch(spark, sf, 4) == 1
    monkeypatch.setattr(Q, "_FILE_ROWS", max(1, n // 10))
    assert Q._files_per_batch(spark, sf, 4) == 3
