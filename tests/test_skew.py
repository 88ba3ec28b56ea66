"""Hot keys: one list, slug or partition holding a large share of the rows stays bounded per task."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from semjoin.operators import catalog as C
from semjoin.operators import match as M
from semjoin.operators.ids import with_dense_index

DIM = 8
NOW = dt.datetime(2024, 5, 1, 12, 0, 0)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _vectors(rng, n):
    return [[float(x) for x in v] for v in rng.normal(size=(n, DIM)).astype(np.float32)]


def test_hot_list_cogroups_are_bounded(spark):
    rng = np.random.default_rng(3)
    # list 0 holds two thirds of the left rows and of the catalogue
    left_lists = [0] * 2000 + [1] * 700 + [2] * 300
    cat_lists = [0] * 400 + [1] * 150 + [2] * 50
    left = spark.createDataFrame(list(zip(range(len(left_lists)), left_lists, _vectors(rng, len(left_lists)))),
                                 "key long, list_id int, embedding array<float>")
    cat = spark.createDataFrame(list(zip(range(10_000, 10_000 + len(cat_lists)), cat_lists,
                                         _vectors(rng, len(cat_lists)))),
                                "id long, list_id int, embedding array<float>")
    block_rows, cat_block_rows = 250, 100
    ls, cs = M.blocked_groups(left, cat, block_rows, cat_block_rows)
    keys = ["list_id", "salt", "block"]
    left_max = ls.groupBy(keys).count().agg(F.max("count")).first()[0]
    cat_max = cs.groupBy(keys).count().agg(F.max("count")).first()[0]
    assert left_max <= 1.5 * block_rows
    assert cat_max <= 1.5 * cat_block_rows
    # every left row meets every catalogue row of its list exactly once
    pairs = (ls.join(cs, keys).groupBy("list_id").count()
             .collect())
    want = {0: 2000 * 400, 1: 700 * 150, 2: 300 * 50}
    assert {r.list_id: r["count"] for r in pairs} == want
    # S salts for the hot list: ceil(2000 / 250)
    assert ls.where("list_id = 0").select("salt").distinct().count() == math.ceil(2000 / block_rows)
    # a list whose catalogue fits one block gives the unused allowance to its left rows: no salting,
    # so its catalogue rows are not copied
    assert ls.where("list_id = 2").select("salt").distinct().count() == 1
    assert cs.where("list_id = 2").count() == 50
    both = (ls.groupBy(keys).count().withColumnRenamed("count", "nl")
            .join(cs.groupBy(keys).count().withColumnRenamed("count", "nc"), keys))
    assert both.agg(F.max(F.col("nl") + F.col("nc"))).first()[0] <= 1.5 * (block_rows + cat_block_rows)


def test_single_hot_list_blocked_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    news = rng.normal(size=(900, DIM)).astype(np.float32)
    cat = rng.normal(size=(120, DIM)).astype(np.float32)
    n = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(news)],
                              "news_id long, embedding array<float>")
    c = spark.createDataFrame([(1000 + i, [float(x) for x in v]) for i, v in enumerate(cat)],
                              "id long, embedding array<float>")
    got = {r.news_id: (r.matched_market_id, r.match_score)
           for r in M.nearest(n, c, dim=DIM, threshold=None, strategy="blocked", block_rows=60,
                              cat_block_rows=25).collect()}
    cn = cat.astype(np.float64) / np.linalg.norm(cat.astype(np.float64), axis=1, keepdims=True)
    nn = news.astype(np.float64) / np.linalg.norm(news.astype(np.float64), axis=1, keepdims=True)
    s = nn @ cn.T
    for i in range(len(news)):
        j = int(np.argmax(s[i]))
        assert got[i][0] == 1000 + j
        assert got[i][1] == pytest.approx(s[i, j], abs=1e-9)


def test_hot_slug_upsert_is_partially_aggregated(spark):
    # 400 feed rows: every third row repeats the slug "hot"; the last of them wins
    rows = [(p, "hot" if p % 3 == 0 else f"s{p}", f"q{p}", p % 2 == 0, "feed", "ok") for p in range(400)]
    staged = spark.createDataFrame(rows, "pos long, slug string, question string, is_resolved boolean, "
                                         "source string, status string")
    current = spark.createDataFrame(
        [(7, "seed", "hot", "old question", False, NOW - dt.timedelta(days=1), NOW - dt.timedelta(days=1))],
        "id long, source string, slug string, question string, is_resolved boolean, "
        "created_at timestamp_ntz, updated_at timestamp_ntz")
    out = C.upsert_markets(current, staged, NOW)
    p = plan(out)
    assert "partial_max_by" in p
    got = {r.slug: r for r in out.collect()}
    assert len(got) == 1 + sum(1 for r in rows if r[1] != "hot")
    hot = got["hot"]
    last_hot = max(r[0] for r in rows if r[1] == "hot")
    assert (hot.id, hot.source, hot.question) == (7, "seed", f"q{last_hot}")
    assert hot.is_resolved == (last_hot % 2 == 0)
    new_ids = sorted(r.id for r in got.values() if r.slug != "hot")
    assert new_ids == list(range(8, 8 + len(new_ids)))


def test_dense_index_with_one_partition_holding_a_third(spark):
    # partition 0 gets a third of the rows, the rest are spread over 7 partitions
    df = spark.range(0, 3000).withColumn("p", F.when(F.col("id") < 1000, F.lit(0))
                                         .otherwise(F.pmod(F.col("id"), F.lit(7)) + 1))
    skewed = df.repartition(8, "p").persist()
    counts = sorted(skewed.groupBy(F.spark_partition_id()).count().collect(), key=lambda r: -r["count"])
    assert counts[0]["count"] >= 1000
    idx = [r.i for r in with_dense_index(skewed, "i", materialize=False).select("i").collect()]
    assert sorted(idx) == list(range(3000))
    skewed.unpersist()


def test_hot_topic_buffer_ranks_in_bounded_rounds(spark):
    from semjoin.operators.topn import top_n_per_key
    # a third of 12,000 arrivals in one topic, over 24 input partitions
    df = spark.range(0, 12000, numPartitions=24).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("id") % 5).cast("string")))
         .alias("topic"), F.col("id").alias("arrival"))
    pdf = df.toPandas()
    for n, budget in ((40, 300), (1200, 3000)):
        out = top_n_per_key(df, "topic", "arrival", n, max_task_rows=budget)
        p = out._jdf.queryExecution().sparkPlan().toString()
        # a grouping round (partition groups) before the final rank
        assert "SPARK_PARTITION_ID" in p
        if n <= 1000:
            assert "WindowGroupLimit" in p
        assert "Pandas" not in p
        got = {}
        for r in out.collect():
            got.setdefault(r.topic, []).append(r.arrival)
        want = {t: sorted(g.arrival.nlargest(n)) for t, g in pdf.groupby("topic")}
        assert {t: sorted(v) for t, v in got.items()} == want
