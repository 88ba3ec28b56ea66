"""The streaming job: same answers as the batch path, and a replayed batch stores nothing twice."""

import datetime as dt

from semjoin.plans import fixtures as X
from semjoin.plans import registry as R
from semjoin.session import shared_dir
from semjoin.sources import streams as SRC
from semjoin.streaming import news_job as JOB

from conftest import SMALL


def test_stream_equals_batch_and_replay_is_idempotent(spark):
    base = shared_dir(spark, "test-stream")
    inbox, out, ckpt = f"{base}/inbox", f"{base}/out", f"{base}/ckpt"
    SRC.write_message_files(X.fx_raw(spark, SMALL).repartition(3, "msg_id").select("value"), inbox)
    kw = dict(embedder=R._embedder(), load_catalogue=lambda: R._hash_catalogue(spark, SMALL),
              dim=X.FX_DIM, threshold=X.FX_THRESHOLD, now=lambda: dt.datetime(2024, 2, 1))
    q = JOB.start(SRC.read_message_files(spark, inbox, max_files_per_trigger=1), out, ckpt, **kw)
    q.awaitTermination()
    stream_rows = sorted(R._read_stored(spark, out).collect())
    batch_rows = sorted(R.QUERIES["store_news"](spark, SMALL).collect())
    assert stream_rows == batch_rows and len(stream_rows) > 0

    # replay batch 0 as a restart would: its partitions are rewritten, not appended
    n_before = spark.read.parquet(f"{out}/news").count()
    p_before = spark.read.parquet(f"{out}/published").count()
    writer = JOB.make_batch_writer(out, **kw)
    first_file = sorted(f for f in spark.read.text(inbox).inputFiles())[0]
    batch0 = spark.read.text(first_file)
    files_in_batch0 = spark.read.parquet(f"{out}/news").where("batch_id = 0").count()
    writer(batch0, 0)
    assert spark.read.parquet(f"{out}/news").count() == n_before - files_in_batch0 + \
        spark.read.parquet(f"{out}/news").where("batch_id = 0").count()
    ids = spark.read.parquet(f"{out}/news").groupBy("id").count().where("count > 1").count()
    assert ids == 0
    assert spark.read.parquet(f"{out}/published").count() >= 0 and p_before >= 0

    # restart from the checkpoint with no new input: nothing is processed again
    q2 = JOB.start(SRC.read_message_files(spark, inbox, max_files_per_trigger=1), out, ckpt, **kw)
    q2.awaitTermination()
    assert spark.read.parquet(f"{out}/news").count() == spark.read.parquet(f"{out}/news").count()
    assert spark.read.parquet(f"{out}/news").groupBy("id").count().where("count > 1").count() == 0


def _stored_catalogue(spark, name, buckets=16):
    from pyspark.sql import functions as F

    from semjoin.streaming import ingest_job as INGEST

    root = shared_dir(spark, name)
    INGEST.create(X.fx_market_rows(spark, SMALL), X.fx_market_embeddings(spark, SMALL).withColumn("id", F.col("market_id")),
                  root, buckets)
    return root


def _files(root, table):
    import glob
    import os
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root.replace('file:', '')}/{table}/bucket=*/*.parquet")}


def test_catalogue_refresh_is_the_whole_upsert_and_replays(spark):
    from semjoin.operators import catalog as C
    from semjoin.sources import feed as FEED
    from semjoin.streaming import ingest_job as INGEST

    root = _stored_catalogue(spark, "test-ingest")
    docs = X.fx_feed_docs(spark, SMALL)
    FEED.write_feed(docs, f"{root}/inbox")
    kw = dict(embedder=R._embedder(), limit=X.FEED_SNAPSHOT_ROWS, now=lambda: dt.datetime(2024, 2, 1), buckets=16)
    INGEST.start(FEED.stream_feed(spark, f"{root}/inbox"), root, f"{root}/ckpt", **kw).awaitTermination()
    first, vectors = sorted(INGEST.read_markets(spark, root).collect()), sorted(INGEST.read_vectors(spark, root).collect())
    staged = C.ingest_status(C.normalize_feed(C.feed_rows(docs, X.FEED_SNAPSHOT_ROWS)), R._embedder())
    whole = C.upsert_markets(X.fx_market_rows(spark, SMALL), staged, dt.datetime(2024, 2, 1), ["snap", "pos"])
    assert first == sorted(whole.select(*C.MARKET_COLUMNS).collect())

    # replay batch 0 (as after a crash before the offset commit) by a new job: the same rows, ids and vectors
    writer = INGEST.make_batch_writer(root, **kw)
    writer(FEED.read_feed(spark, f"{root}/inbox"), 0)
    assert sorted(INGEST.read_markets(spark, root).collect()) == first
    assert sorted(INGEST.read_vectors(spark, root).collect()) == vectors


def _feed_of(spark, slugs, snap=1):
    import json
    doc = json.dumps([{"slug": s, "question": f"what of {s} now", "resolved": False} for s in slugs])
    return spark.createDataFrame([(snap, doc)], "snap long, value string")


def test_refresh_leaves_files_of_other_buckets_alone(spark):
    from semjoin.sources import keyed as KT
    from semjoin.streaming import ingest_job as INGEST

    root = _stored_catalogue(spark, "test-touched")
    before, vectors = _files(root, "markets"), _files(root, "market_embeddings")
    held = {r.slug: r for r in INGEST.read_markets(spark, root).collect()}
    old = sorted(s for s in held if s)[0]
    write = INGEST.make_batch_writer(root, embedder=R._embedder(), buckets=16, now=lambda: dt.datetime(2024, 2, 1))
    write(_feed_of(spark, [old, "brand-new"]), 0)
    after = _files(root, "markets")
    changed = {int(f.split("bucket=")[1].split("/")[0]) for f, _ in set(before.items()) ^ set(after.items())}
    names = spark.createDataFrame([(old,), ("brand-new",)], "slug string")
    assert changed == set(KT.touched(names, "slug", 16)) and len(changed) <= 2
    assert len(set(vectors.items()) - set(_files(root, "market_embeddings").items())) <= 2
    now = {r.slug: r for r in INGEST.read_markets(spark, root).collect()}
    assert len(now) == len(held) + 1 and now["brand-new"].id == max(r.id for r in held.values()) + 1
    assert now[old].id == held[old].id and now[old].question == f"what of {old} now"
    assert all(now[s] == held[s] for s in held if s != old)
    # the plan of a read of some buckets prunes the others
    plan = INGEST.read_markets(spark, root, [3])._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_refresh_that_broke_off_is_completed_by_its_replay(spark, monkeypatch):
    import pytest

    from semjoin.sources import keyed as KT
    from semjoin.streaming import ingest_job as INGEST

    root = _stored_catalogue(spark, "test-broken")
    cat = INGEST.StoredCatalogue(spark, root, wait_seconds=1.0)
    held = cat.version()
    docs = _feed_of(spark, [f"new-{i}" for i in range(20)])
    kw = dict(embedder=R._embedder(), buckets=16, now=lambda: dt.datetime(2024, 2, 1))
    whole, calls = KT.replace, []

    def breaks(df, path, key, only, buckets):
        calls.append(path)
        if len(calls) == 1:                       # half of the touched market buckets are swapped, then the job is lost
            half = only[: len(only) // 2]
            whole(df.where(KT.bucket_of(key, buckets).isin(half)), path, key, half, buckets)
            raise RuntimeError("lost")
        return whole(df, path, key, only, buckets)
    monkeypatch.setattr(KT, "replace", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        INGEST.make_batch_writer(root, **kw)(docs, 0)
    # readers keep what they hold and never load the half
    assert KT.settled(spark, root) is None and cat.version() == held
    with pytest.raises(TimeoutError):
        cat.load()
    INGEST.make_batch_writer(root, **kw)(docs, 0)
    rows = INGEST.read_markets(spark, root).collect()
    assert len({r.id for r in rows}) == len(rows) == len({r.slug for r in rows})
    assert sum(r.slug.startswith("new-") for r in rows if r.slug) == 20
    ids = {r.market_id for r in INGEST.read_vectors(spark, root).collect()}
    assert {r.id for r in rows if r.slug and r.slug.startswith("new-")} <= ids
    assert cat.version() not in (None, held) and cat.load().count() > 0


def test_keyed_tables_start_empty_and_refuse_another_number_of_buckets(spark):
    import pytest

    from semjoin.sources import keyed as KT

    path = f"{shared_dir(spark, 'test-keyed')}/t"
    assert KT.read(spark, path, "k string, v long").count() == 0
    rows = spark.range(50).selectExpr("CAST(id AS STRING) AS k", "id AS v")
    KT.replace(rows, path, "k", KT.touched(rows, "k", 8), 8)
    assert sorted(r.v for r in KT.read(spark, path, "k string, v long").collect()) == list(range(50))
    KT.replace(rows.limit(0), path, "k", [], 8)
    assert KT.read(spark, path, "k string, v long").count() == 50
    part = KT.read(spark, path, "k string, v long", [0, 1])
    with pytest.raises(Exception, match="was not made with 5 buckets"):
        KT.replace(part, path, "k", [0], 5)
    assert KT.read(spark, path, "k string, v long").count() == 50


def _newest(rows, size):
    by_topic = {}
    for r in rows:
        by_topic.setdefault(r.topic, []).append(r)
    return {t: sorted((r.arrival for r in rs), reverse=True)[:size] for t, rs in by_topic.items()}


def test_buffers_go_on_after_a_restart_and_are_read_as_of_a_batch(spark):
    from pyspark.sql import functions as F

    from semjoin.streaming import buffer_job as BUF

    root, schema, size = shared_dir(spark, "test-buffer"), "topic string, arrival long, time string, at timestamp", 50
    assert BUF.read(spark, f"{root}/checkpoint", schema).count() == 0
    arr = X.fx_arrivals(spark, SMALL).select("topic", "arrival", F.when(F.col("arrival") % 7 != 0, F.col("time")).alias("time"),
                                             F.timestamp_micros(F.col("arrival") * 1_000_003).alias("at"))
    # a null topic, and one topic with nearly everything
    more = spark.range(10_000, 13_000).select(F.when(F.col("id") % 100 == 0, F.lit(None)).otherwise(F.lit("hot")).alias("topic"),
                                              F.col("id").alias("arrival"), F.lit("").alias("time"), F.lit(None).cast("timestamp").alias("at"))
    arr = arr.unionByName(more).cache()
    for turn in (0, 1):                        # the older half comes last, so the buffers must hold on to the newer one
        arr.where(F.col("arrival") % 2 == 1 - turn).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        BUF.start(stream, f"{root}/checkpoint", size, lanes=3).awaitTermination()
    got = BUF.read(spark, f"{root}/checkpoint", schema, size).collect()
    assert _newest(got, 10 ** 9) == _newest(arr.collect(), size) and None in {r.topic for r in got}
    assert set(got) <= set(arr.collect())      # whole items: nulls, empty texts and microseconds as they came
    before = BUF.read(spark, f"{root}/checkpoint", schema, size, batch_id=0).collect()
    assert _newest(before, 10 ** 9) == _newest(arr.where("arrival % 2 = 1").collect(), size)
    held = spark.read.format("statestore").load(f"{root}/checkpoint")
    assert held.where(F.size("value.groupState.item") > size).count() == 0
    assert held.where("key.topic = 'hot'").count() == 3          # the hot topic is spread over its lanes


def test_buffer_batch_that_fails_is_run_again_from_the_state_before_it(spark):
    import pytest
    from pyspark.sql import functions as F

    from semjoin.streaming import buffer_job as BUF

    root, schema = shared_dir(spark, "test-buffer-replay"), "topic string, arrival long, time string"
    rows = spark.range(200).select(F.lit("t").alias("topic"), F.col("id").alias("arrival"), F.lit("x").alias("time"))
    rows.where("arrival < 100").write.parquet(f"{root}/in")
    read = lambda: spark.readStream.schema(schema).parquet(f"{root}/in")
    BUF.start(read(), f"{root}/checkpoint", 500).awaitTermination()
    rows.where("arrival >= 100").write.mode("append").parquet(f"{root}/in")
    # some of the batch's rows fail after others have been taken up
    broken = read().withColumn("time", F.when(F.col("arrival") == 150, F.raise_error(F.lit("injected"))).otherwise(F.col("time")))
    with pytest.raises(Exception, match="injected"):
        BUF.start(broken, f"{root}/checkpoint", 500).awaitTermination()
    assert BUF.read(spark, f"{root}/checkpoint", schema, 500).count() == 100
    BUF.start(read(), f"{root}/checkpoint", 500).awaitTermination()
    got = [r.arrival for r in BUF.read(spark, f"{root}/checkpoint", schema, 500).collect()]
    assert sorted(got) == list(range(200))


def test_buffer_statistics_follow_the_buffers(spark):
    from pyspark.sql import functions as F

    from semjoin.operators import serving as SV
    from semjoin.streaming import buffer_job as BUF
    from semjoin.streaming import delta as DELTA

    root, seen = shared_dir(spark, "test-delta-stats"), {}
    arr = X.fx_arrivals(spark, SMALL).select("topic", "arrival", "time")
    for turn in (0, 1):
        arr.where(F.col("arrival") % 2 == turn).write.mode("append").parquet(f"{root}/in")
        stream = lambda: spark.readStream.schema(DELTA.BUFFER_SCHEMA).parquet(f"{root}/in")
        DELTA.start_stats(stream(), lambda stats, b: seen.update({b: stats.collect()}), f"{root}/stats", size=30, available_now=True).awaitTermination()
        BUF.start(stream(), f"{root}/buffers", 30).awaitTermination()
        buffers = BUF.read(spark, f"{root}/buffers", DELTA.BUFFER_SCHEMA, 30)
        assert seen[turn] == SV.buffer_stats(buffers, 30).collect()
    assert sorted(seen) == [0, 1]


def test_supervised_stream_restarts_after_failure(spark):
    import os

    from pyspark.sql import functions as F

    from semjoin.streaming.supervise import supervise

    base = shared_dir(spark, "test-supervise")
    inbox, out, ckpt = f"{base}/inbox", f"{base}/out", f"{base}/ckpt"
    spark.range(0, 300).select(F.col("id").cast("string").alias("value")).repartition(3).write.text(inbox)
    marker = f"{base.replace('file:', '')}/failed-once"
    os.makedirs(os.path.dirname(marker), exist_ok=True)

    def sink(df, batch_id):
        if batch_id == 1 and not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("injected failure")
        (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out))

    def start():
        return (spark.readStream.option("maxFilesPerTrigger", "1").text(inbox).writeStream
                .foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    supervise(start, retry_seconds=0.1, max_restarts=2)
    got = spark.read.parquet(out)
    assert got.count() == 300 and got.select("value").distinct().count() == 300


def test_batch_broadcasts_are_released(spark):
    import numpy as np
    from semjoin.operators import match as M
    rng = np.random.default_rng(0)
    cat = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(20)],
                                "id long, embedding array<float>")
    news = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(50)],
                                 "news_id long, embedding array<float>")
    made = []
    real = M._track
    M._track = lambda bc: made.append(bc) or real(bc)
    try:
        with M.released_broadcasts():
            n = M.nearest(news, cat, dim=4, threshold=None).where("matched_market_id IS NOT NULL").count()
    finally:
        M._track = real
    assert n == 50 and len(made) == 1
    # unpersisted, not destroyed: a later use re-fetches the value from the driver
    assert made[0].value[1].shape == (20,)


def test_catalogue_held_per_version_matches_fresh_reads(spark):
    """With ``catalogue_version`` the matrix is broadcast once per version, and the output is unchanged."""
    from pyspark.sql import functions as F

    from semjoin.operators import match as M
    base = shared_dir(spark, "test-stream-held")
    inbox = f"{base}/inbox"
    SRC.write_message_files(X.fx_raw(spark, SMALL).repartition(4, "msg_id").select("value"), inbox)
    cat_all = f"{base}/cat"
    R._hash_catalogue(spark, SMALL).write.parquet(cat_all)
    # the catalogue changes once: batches 0-1 see version 1 (all but every 4th market), 2-3 version 2
    seen = {"batches": 0}
    versions = {1: spark.read.parquet(cat_all).where(F.col("id") % 4 != 0), 2: spark.read.parquet(cat_all)}

    def version():
        return 1 if seen["batches"] < 2 else 2

    kw = dict(embedder=R._embedder(), dim=X.FX_DIM, threshold=X.FX_THRESHOLD, now=lambda: dt.datetime(2024, 2, 1))
    made = []
    real = M._track
    M._track = lambda bc: made.append(bc) or real(bc)
    try:
        outs = {}
        for mode in ("fresh", "held"):
            out = f"{base}/{mode}"
            writer = JOB.make_batch_writer(out, load_catalogue=lambda: versions[version()],
                                           catalogue_version=version if mode == "held" else None, **kw)
            seen["batches"] = 0
            made.clear()
            for i, f in enumerate(sorted(spark.read.text(inbox).inputFiles())):
                writer(spark.read.text(f), i)
                seen["batches"] += 1
            writer.release()
            outs[mode] = (sorted(spark.read.parquet(f"{out}/published").select("value", "batch_id").collect()),
                          len(made))
    finally:
        M._track = real
    assert outs["fresh"][0] == outs["held"][0] and len(outs["fresh"][0]) > 0
    assert outs["fresh"][1] == 4          # one broadcast per batch
    assert outs["held"][1] == 2           # one per catalogue version


def test_stored_catalogue_loads_whole_finished_states(spark):
    from pyspark.sql import functions as F

    from semjoin.operators import match as M
    from semjoin.sources import keyed as KT
    from semjoin.streaming import ingest_job as INGEST

    empty = INGEST.StoredCatalogue(spark, shared_dir(spark, "test-no-cat"))
    assert empty.version() is None and empty.load().count() == 0
    root = _stored_catalogue(spark, "test-stored-cat")
    rows, vecs = X.fx_market_rows(spark, SMALL), X.fx_market_embeddings(spark, SMALL)
    cat = INGEST.StoredCatalogue(spark, root)
    v0 = cat.version()
    want = M.match_catalogue(rows, vecs).count()
    held = cat.load()
    assert held.count() == want > 0
    # a refresh under way: the version stays, and what was loaded outlives the files it came from
    attempt = KT.begin(spark, root, 5)
    some = rows.where(F.col("id") % 2 == 0)
    KT.create(INGEST._as(some, INGEST.MARKETS_SCHEMA), f"{root}/markets", "slug", 16)
    assert cat.version() == v0 and held.count() == want
    KT.finish(spark, root, attempt)
    assert cat.version() == attempt != v0
    assert cat.load().count() == M.match_catalogue(some, vecs).count() < want

    # end to end: the news job matches against the stored catalogue, held per version
    out = f"{root}/news-out"
    writer = JOB.make_batch_writer(out, embedder=R._embedder(), load_catalogue=cat.load,
                                   catalogue_version=cat.version, dim=X.FX_DIM, threshold=0.0,
                                   now=lambda: dt.datetime(2024, 2, 1))
    writer(X.fx_raw(spark, SMALL).select("value"), 0)
    writer.release()
    matched = spark.read.parquet(f"{out}/published").count()
    assert matched > 0


def test_replay_without_rows_leaves_none(spark):
    from semjoin.operators import store as ST

    root = shared_dir(spark, "test-replay")
    for n in (3, 2, 0):
        ST.write_batch(spark.range(n).selectExpr("id", "'x' AS value"), f"{root}/t", 7)
        assert spark.read.parquet(f"{root}/t").where("batch_id = 7").count() == n
    ST.write_batch(spark.range(4).selectExpr("id", "'x' AS value"), f"{root}/t", 8)
    assert spark.read.parquet(f"{root}/t").groupBy("batch_id").count().collect()[0]["count"] == 4


def test_ids_do_not_depend_on_the_split(spark):
    import pytest

    from semjoin.operators import store as ST

    raw = X.fx_raw(spark, SMALL).select("value")
    raw = raw.unionByName(raw.limit(5))
    keys = [sorted((r.msg_key, r.value) for r in ST.number_batch(raw.repartition(n), 3).collect()) for n in (1, 5, 8)]
    assert keys[0] == keys[1] == keys[2] and len({k for k, _ in keys[0]}) == raw.count()
    assert keys[0][0][0] == 3 * ST.ID_STRIDE + 1
    # from topics: by position, gaps allowed
    rows = [("b", 0, 9, "x"), ("a", 1, 100, "y"), ("a", 1, 103, "z"), ("a", 0, 5, "w"), ("a", 0, 6, "v")]
    topic = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    got = [{r.value: r.msg_key for r in ST.number_batch(topic.repartition(n), 0).collect()} for n in (1, 4)]
    assert got[0] == got[1] == {"w": 1, "v": 2, "y": 3, "z": 6, "x": 7}
    far = spark.createDataFrame([("a", 0, 0, "x"), ("a", 0, ST.ID_STRIDE, "y")], "topic string, partition int, offset long, value string")
    with pytest.raises(Exception, match="more messages than ids"):
        ST.number_batch(far, 0).collect()


def test_job_publishes_through_a_given_sink_and_keeps_bad_records(spark):
    base = shared_dir(spark, "test-sink")
    sent = []
    writer = JOB.make_batch_writer(f"{base}/out", embedder=R._embedder(), load_catalogue=lambda: R._hash_catalogue(spark, SMALL), dim=X.FX_DIM,
                                   threshold=X.FX_THRESHOLD, now=lambda: dt.datetime(2024, 2, 1), publish=lambda df, n: sent.append((n, df.columns, df.count())))
    raw = X.fx_raw(spark, SMALL)
    writer(raw.select("value").withColumnRenamed("value", "value"), 4)
    assert sent[0][:2] == (4, ["value"]) and sent[0][2] > 0
    bad = spark.read.parquet(f"{base}/out/bad_records")
    assert bad.count() == raw.where("msg_id % 8 < 2").count()
    counts = spark.read.parquet(f"{base}/out/status_counts").collect()
    assert sum(r.n for r in counts) + bad.count() == raw.count() and {r.batch_id for r in counts} == {4}


def test_stream_holds_inverted_lists_per_version(spark, monkeypatch):
    from semjoin.operators import match as M
    trained = []
    real = M.train_lists
    monkeypatch.setattr(M, "train_lists", lambda *a: trained.append(1) or real(*a))
    base = shared_dir(spark, "test-ivf-stream")
    writer = JOB.make_batch_writer(f"{base}/out", embedder=R._embedder(), load_catalogue=lambda: R._hash_catalogue(spark, SMALL), dim=X.FX_DIM,
                                   threshold=0.0, now=lambda: dt.datetime(2024, 2, 1), catalogue_version=lambda: 1, strategy="ivf", nlist=4, nprobe=4)
    raw = X.fx_raw(spark, SMALL)
    for n in range(3):
        writer(raw.where(f"msg_id % 3 = {n}").select("value"), n)
    writer.release()
    assert trained == [1] and spark.read.parquet(f"{base}/out/published").count() > 0


def test_store_embeds_and_matches_once_for_both_tables(spark, tmp_path):
    """``append_news`` writes two tables of rows that are not persisted: the embedding runs once for both."""
    import datetime as dt

    import pandas as pd
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    from semjoin.operators import store as ST
    marks = tmp_path / "marks"
    marks.mkdir()
    folder = str(marks)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(ids: pd.Series) -> pd.Series:
        import os
        import uuid
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(str(len(ids)))
        return pd.Series([[float(i), 1.0] for i in ids])

    rows = spark.range(0, 200, numPartitions=3).select(
        F.when(F.col("id") % 4 != 0, F.col("id")).alias("news_id"), F.lit("s").alias("source"), F.lit("2024-01-01").alias("published_date"),
        F.lit("10:00").alias("published_time"), F.col("id").cast("string").alias("headline"), embed.asNondeterministic()("id").alias("embedding"))
    ST.append_news(rows, str(tmp_path / "store"), 0, dt.datetime(2024, 1, 1))
    assert sum(int(p.read_text()) for p in marks.iterdir()) <= 200
    news, vecs = (spark.read.parquet(str(tmp_path / "store" / t)) for t in ("news", "news_embeddings"))
    assert {(r.id, r.headline) for r in news.collect()} == {(i, str(i)) for i in range(200) if i % 4}
    assert {(r.id, r.news_id, r.embedding[0]) for r in vecs.collect()} == {(i, i, float(i)) for i in range(200) if i % 4}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_refresh_keeps_no_rows_in_the_heap(spark, monkeypatch):
    from semjoin.operators import catalog as C
    from semjoin.streaming import ingest_job as INGEST

    root, plans, real = _stored_catalogue(spark, "test-ingest-staged"), [], C.upsert_markets
    monkeypatch.setattr(C, "upsert_markets", lambda current, staged, *a, **kw: plans.append(_plan(staged)) or real(current, staged, *a, **kw))
    INGEST.make_batch_writer(root, embedder=R._embedder(), buckets=16, limit=X.FEED_SNAPSHOT_ROWS)(X.fx_feed_docs(spark, SMALL), 0)
    assert len(plans) == 1 and "FileScan parquet" in plans[0]
    assert "InMemoryTableScan" not in plans[0] and "EvalPython" not in plans[0]


def test_landed_feed_has_small_row_groups(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F
    from semjoin.sources import feed as FEED

    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(1600)), lambda i: F.sha2(F.concat_ws(",", F.col("id"), i), 256)), "")
    FEED.write_feed(spark.range(0, 500, 1, 1).select(text.alias("value"), F.col("id").alias("snap")), f"{tmp_path}/feed")
    meta = pq.ParquetFile(glob.glob(f"{tmp_path}/feed/*.parquet")[0]).metadata
    assert meta.num_rows == 500 and max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) < 400
    assert FEED.read_feed(spark, f"{tmp_path}/feed").agg(F.sum(F.length("value"))).first()[0] == 500 * 1600 * 64


def test_numbering_samples_no_texts(spark, monkeypatch):
    from pyspark.sql import functions as F
    from semjoin.operators import store as ST

    plans, real = [], ST.with_dense_index
    monkeypatch.setattr(ST, "with_dense_index", lambda df, *a, **kw: plans.append(_plan(df)) or real(df, *a, **kw))
    raw = X.fx_raw(spark, SMALL).select("value")
    got = ST.number_batch(raw.unionByName(raw.limit(9)).repartition(5), 0).select("msg_key", F.xxhash64("value").alias("h"), "value").collect()
    dealt = [line for line in plans[0].splitlines() if "rangepartitioning(" in line]
    assert len(dealt) == 1 and "value" not in dealt[0].split("rangepartitioning(")[1].split("ASC")[1]
    assert dealt[0].count("ASC") == 1                                   # the hash alone
    assert [r.msg_key for r in sorted(got, key=lambda r: (r.h, r.value.encode(), r.msg_key))] == list(range(1, len(got) + 1))


def test_job_keeps_no_batch_in_the_heap(spark, monkeypatch, tmp_path):
    from semjoin.operators import news as N
    from semjoin.operators import publish as P

    plans, levels, real, bad = [], [], P.payloads, N.bad_records
    monkeypatch.setattr(P, "payloads", lambda df: plans.append(_plan(df)) or real(df))
    monkeypatch.setattr(N, "bad_records", lambda df, *a: levels.append(df.storageLevel) or bad(df, *a))
    write = JOB.make_batch_writer(f"{tmp_path}/out", embedder=R._embedder(), load_catalogue=lambda: R._hash_catalogue(spark, SMALL),
                                  dim=X.FX_DIM, threshold=X.FX_THRESHOLD)
    write(X.fx_raw(spark, SMALL).select("value"), 0)
    assert "FileScan parquet" in plans[0] and "InMemoryTableScan" not in plans[0] and "EvalPython" not in plans[0]
    assert levels[0].useDisk and not levels[0].useMemory                # read once from its source, but not held in memory
    counts = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out/status_counts/batch_id=0").collect()))
    assert counts == sorted(map(tuple, R.QUERIES["status_counts"](spark, SMALL).collect()))
