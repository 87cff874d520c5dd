import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import joins, ranking, selection
from ledgerlens.operators.joins import spread_join
from ledgerlens.operators.ranking import percent_ranks, positions, tile
from ledgerlens.operators.selection import not_before, percentile, row_at, text_at, tile_start


@pytest.fixture(params=["broadcast", "shuffle", "ranges"])
def way(request, monkeypatch):
    """Run with measured sides broadcast, with none broadcast and small groups already hot, and with orders cut into ranges."""
    if request.param == "shuffle":
        monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(joins, "LEAST_HOT_ROWS", 3)
    if request.param == "ranges":
        monkeypatch.setattr(ranking, "WINDOW_ROWS", 10)
    return request.param


@pytest.fixture(params=[50_000, 6])
def few(request, monkeypatch):
    """Brackets that hold all values, and such as must be cut again and again."""
    monkeypatch.setattr(selection, "FEW", request.param)


def values(n, seed=3):
    """A third of the rows share one value, some are missing."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, n // 4, n).astype(float)
    x[rng.random(n) < 0.33] = 0.0
    x[rng.random(n) < 0.05] = np.nan
    return x


def test_percent_ranks_like_pandas(spark, way):
    pdf = pd.DataFrame({"id": np.arange(400), "a": values(400), "b": values(400, 4), "c": np.nan})
    rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "id double, a double, b double, c double")
    got = percent_ranks(df, "id", ["a", "b", "c"]).toPandas().set_index("id").sort_index()
    expected = pdf.set_index("id")[["a", "b", "c"]].rank(pct=True)
    # A row without any value has no rank to return.
    expected = expected.dropna(how="all")
    expected.index = expected.index.astype(float)
    pd.testing.assert_frame_equal(got.astype(float), expected, check_exact=True, check_names=False)


def test_positions_and_tiles_like_window(spark, way):
    df = spark.createDataFrame(
        [(g, i, float(v)) for g in "ab" for i, v in enumerate(np.nan_to_num(values(157)))], "g string, id int, v double"
    )
    placed = positions(df, ["g"], ["v", "id"], "position", "n")
    w = Window.partitionBy("g").orderBy("v", "id")
    for k in (3, 5, 10, 200):
        both = placed.select(
            tile(F.col("position"), F.col("n"), k).alias("got"), F.ntile(k).over(w).alias("expected")
        )
        assert both.where("got <> expected").count() == 0
    assert placed.count() == 314


def test_seven_rows_in_three_tiles(spark):
    placed = positions(spark.range(7), [], ["id"], "position", "n")
    tiles = placed.orderBy("id").select(tile(F.col("position"), F.col("n"), 3)).collect()
    assert [r[0] for r in tiles] == [1, 1, 1, 2, 2, 3, 3]


@pytest.mark.parametrize("n", [1, 2, 11, 101, 157])
def test_percentile_like_pandas(spark, n, few):
    x = pd.Series(values(400, n)[:n])
    df = spark.createDataFrame([(None if pd.isna(v) else float(v),) for v in x], "x double")
    found, count = percentile(df, "x", 99)
    assert count == x.notna().sum()
    if x.notna().any():
        assert found == pytest.approx(x.quantile(0.99), abs=1e-9)


def test_percentile_of_nothing(spark):
    assert percentile(spark.createDataFrame([(None,)], "x double"), "x", 99) == (None, 0)


def test_percentile_by_a_poor_sketch(spark, monkeypatch):
    """A bracket that misses the place is opened."""
    monkeypatch.setattr(selection, "MARGIN", 0)
    monkeypatch.setattr(selection, "ACCURACY", 5)
    x = pd.Series(np.random.default_rng(5).normal(size=500))
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    for percent in (1, 50, 99):
        assert percentile(df, "x", percent)[0] == pytest.approx(x.quantile(percent / 100), abs=1e-12)


@pytest.mark.parametrize("n", [0, 3, 9, 157])
def test_tiles_by_selection_like_window(spark, n, few):
    rows = [(f"C{i * 7919 % 1000:03d}", float(v)) for i, v in enumerate(np.nan_to_num(values(400))[:n])]
    df = spark.createDataFrame(rows, "id string, v double")
    w = Window.orderBy("v", "id")
    for tiles, first in ((5, 5), (10, 4)):
        start = row_at(df, "v", "id", (first - 1) / tiles, lambda n: tile_start(n, tiles, first))
        both = df.select(not_before("v", "id", start).alias("got"), (F.ntile(tiles).over(w) >= first).alias("expected"))
        assert both.where("got <> expected").count() == 0


def test_texts_by_place(spark, few):
    texts = ["C1", "C10", "C100", "C2", "", "é", "C1", "日本", "日", "C10"] + [f"C1{i}" for i in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    places = [0, 1, 3, 5, 30, len(texts) - 2, len(texts) - 1]
    assert [text_at(df, "t", i) for i in places] == [sorted(texts, key=str.encode)[i] for i in places]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_spread_join_like_join(spark, monkeypatch, how):
    monkeypatch.setattr(joins, "LEAST_HOT_ROWS", 3)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i}") for i in range(300)]
    left = spark.createDataFrame(rows, "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k2", 3), ("other", 4), (None, 5)], "k string, v int")
    got = spread_join(left, right, ["k"], ["id"], how)
    expected = left.join(right, "k", how)
    assert set(got.columns) == set(expected.columns)
    assert sorted(map(repr, got.select(*expected.columns).collect())) == sorted(map(repr, expected.collect()))


def test_spread_join_deals_out_hot_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(joins, "LEAST_HOT_ROWS", 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, "hot" if i % 2 else None) for i in range(8000)]
        left = spark.createDataFrame(rows, "id int, k string")
        right = spark.createDataFrame([("hot", 1)], "k string, v int")
        parts = spread_join(left, right, ["k"], ["id"], "left").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(parts) > 1
    assert max(r["count"] for r in parts) < 4000
