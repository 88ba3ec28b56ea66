"""Edge rows: one per behaviour the operators must keep (or deliberately change)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from semjoin.operators import catalog as C
from semjoin.operators import embed as EMB
from semjoin.operators import match as M
from semjoin.operators import news as N
from semjoin.operators import publish as PUB
from semjoin.operators import serving as SV
from semjoin.functions.text import iso_timestamp

DIM = 4


def raw(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "msg_id long, value string")


def test_parse_accepts_objects_only(spark):
    vals = ['{}', 'null', '"str"', '', "{'a':1}", '[1,2]', 'not json', '{"a":1} trailing', '{"news":" "}']
    got = {r.msg_id for r in N.parse_news(raw(spark, vals)).collect()}
    # objects, plus the documented difference: Spark accepts trailing text after an object
    assert got == {0, 7, 8}
    bad = {r.msg_id for r in N.bad_records(raw(spark, vals)).collect()}
    assert bad == {1, 2, 3, 4, 5, 6}


def test_empty_object_is_no_text_and_missing_fields(spark):
    df = N.store_status(N.embed_news(N.normalize_news(N.parse_news(raw(spark, ['{}']))), EMB.HashEmbedder(DIM)))
    r = df.first()
    assert (r.embedding_status, r.db_status) == ("no_text", "failed_missing_fields")


def test_truthiness_of_fields(spark):
    vals = ['{"news":" "}', '{"headline":"", "news":"x"}', '{"headline":null, "news":"y"}', '{"news":0}',
            '{"news":5}', '{"news":false}', '{"news":[]}', '{"headline":"h","news":"n"}']
    got = {r.msg_id: r.headline for r in N.normalize_news(N.parse_news(raw(spark, vals))).collect()}
    assert got == {0: " ", 1: "x", 2: "y", 3: None, 4: "5", 5: None, 6: None, 7: "h"}


def test_date_and_time_fallbacks_and_typing(spark):
    vals = ['{"source":"s","date":"2024-01-02","published_date":"2024-03-04","time":"01:02:03","news":"a b"}',
            '{"source":"s","date":"2024-13-01","time":"01:02:03","news":"a b"}',
            '{"source":"s","date":"2024-01-02 10:00","time":"01:02:03","news":"a b"}',
            '{"source":"s","date":"2024-01-02","time":"25:00:00","news":"a b"}']
    df = N.store_status(N.embed_news(N.normalize_news(N.parse_news(raw(spark, vals))), EMB.HashEmbedder(DIM)))
    got = {r.msg_id: (r.published_date, r.db_status) for r in df.collect()}
    assert got[0] == ("2024-03-04", "saved")
    assert got[1][1] == "failed: bad date"
    assert got[2][1] == "failed: bad date"        # ISO only
    assert got[3][1] == "failed: bad time"


def test_reserved_keys_dropped_and_payload_has_no_duplicates(spark):
    v = '{"source":"s","date":"2024-01-02","time":"01:02:03","news":"alpha beta","match_score":9,' \
        '"embedding":[1,2],"extra":{"k":1}}'
    cat = spark.createDataFrame([(1, "m1", "q1", [1.0, 0.0, 0.0, 0.0])],
                                "id long, slug string, question string, embedding array<float>")
    emb = lambda c: F.array(*[F.lit(x).cast("float") for x in (1.0, 0.0, 0.0, 0.0)])
    p = N.process(raw(spark, [v]), emb, cat, dim=DIM, threshold=0.5)
    p = p.withColumn("news_id", F.lit(None).cast("long"))
    out = json.loads(PUB.payloads(p).first().value)
    assert out["extra"] == {"k": 1} and out["match_score"] == 1.0 and "embedding" not in out
    assert out["matched_market"] == "m1" and "news_id" not in out


def _news(spark, vecs):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vecs)], "news_id long, embedding array<float>")


def _cat(spark, rows):
    return spark.createDataFrame(rows, "id long, embedding array<float>")


@pytest.mark.parametrize("strategy", ["broadcast", "blocked"])
def test_degenerate_vectors_never_match(spark, strategy):
    news = _news(spark, [[0.0, 0.0, 0.0, 0.0], [1.0, 0.0, 0.0], None, [1.0, 0.0, 0.0, 0.0]])
    cat = _cat(spark, [(1, [0.0, 0.0, 0.0, 0.0]), (2, None), (3, [1.0, 0.0, 0.0]), (4, [0.0, 1.0, 0.0, 0.0])])
    got = {r.news_id: (r.matched_market_id, r.match_score)
           for r in M.nearest(news, cat, dim=DIM, threshold=None, strategy=strategy).collect()}
    assert got[0] == (None, None) and got[1] == (None, None) and got[2] == (None, None)
    assert got[3] == (4, 0.0)     # the only usable market


def test_threshold_inclusive_and_ties_lowest_id(spark):
    news = _news(spark, [[1.0, 0.0, 0.0, 0.0]])
    cat = _cat(spark, [(7, [0.5, 0.5, 0.5, 0.5]), (5, [0.5, 0.5, 0.5, 0.5])])   # both at exactly 0.5
    r = M.nearest(news, cat, dim=DIM, threshold=0.5).first()
    assert r.matched_market_id == 5 and r.match_score == pytest.approx(0.5)
    r = M.nearest(news, cat, dim=DIM, threshold=0.5000001).first()
    assert r.matched_market_id is None


def test_null_flag_market_never_matched_and_counted_nowhere(spark):
    markets = spark.createDataFrame([(1, None), (2, False), (3, True)], "id long, is_resolved boolean")
    vecs = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0, 0.0])],
                                 "market_id long, embedding array<float>")
    cat = M.match_catalogue(markets, vecs)
    assert [r.id for r in cat.collect()] == [2]
    st = SV.market_stats(markets, vecs).first()
    assert (st.total_markets, st.active_markets, st.resolved_markets, st.markets_with_embeddings) == (3, 1, 1, 3)


def test_empty_catalogue_gives_nulls(spark):
    news = _news(spark, [[1.0, 0.0, 0.0, 0.0]])
    r = M.nearest(news, _cat(spark, []), dim=DIM).first()
    assert r.matched_market_id is None and r.match_score is None


def _feed(spark, rows_json):
    doc = json.dumps(rows_json)
    return spark.createDataFrame([(doc,)], "value string")


NOW = dt.datetime(2024, 5, 1)


def _current(spark):
    return spark.createDataFrame(
        [(1, "old", "a", "qa", False, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))],
        "id long, source string, slug string, question string, is_resolved boolean, "
        "created_at timestamp_ntz, updated_at timestamp_ntz")


def test_feed_envelopes_and_limit(spark):
    rows = [{"slug": f"s{i}", "question": "q"} for i in range(5)]
    for doc, n in ((rows, 3), ({"data": rows}, 3), ({"markets": rows}, 3), ({"data": None, "markets": rows}, 0),
                   ({"other": rows}, 0), ("text", 0)):
        df = spark.createDataFrame([(json.dumps(doc),)], "value string")
        assert C.feed_rows(df, limit=3).count() == n


def test_upsert_last_wins_keeps_identity(spark):
    feed = _feed(spark, [{"market_slug": "a", "question": "first q"}, {"slug": "a", "question": "second q"},
                         {"slug": "", "question": "x"}, {"slug": "b", "question": None},
                         {"slug": "c", "question": "new market"}])
    staged = C.ingest_status(C.normalize_feed(C.feed_rows(feed, 20)), EMB.HashEmbedder(DIM))
    cnt = C.ingest_counters(staged).first()
    assert (cnt.success_count, cnt.error_count) == (3, 2)
    out = {r.slug: r for r in C.upsert_markets(_current(spark), staged, NOW).collect()}
    assert set(out) == {"a", "c"}
    a = out["a"]
    assert (a.id, a.source, a.question, a.created_at, a.updated_at) == (1, "old", "second q",
                                                                      dt.datetime(2024, 1, 1), NOW)
    assert out["c"].id == 2 and out["c"].created_at == NOW


def test_upsert_twice_same_rows_except_timestamps(spark):
    feed = _feed(spark, [{"slug": "a", "question": "q1"}, {"slug": "z", "question": "qz", "closed": True}])
    staged = C.ingest_status(C.normalize_feed(C.feed_rows(feed, 20)), EMB.HashEmbedder(DIM))
    once = C.upsert_markets(_current(spark), staged, NOW)
    twice = C.upsert_markets(once, staged, NOW + dt.timedelta(days=1))
    cols = ["id", "source", "slug", "question", "is_resolved"]
    assert sorted(once.select(cols).collect()) == sorted(twice.select(cols).collect())


def test_resolved_flag_chain(spark):
    feed = _feed(spark, [{"slug": "a", "question": "q"}, {"slug": "b", "question": "q", "is_resolved": None},
                         {"slug": "c", "question": "q", "closed": True, "is_resolved": None},
                         {"slug": "d", "question": "q", "closed": None, "resolved": True},
                         {"slug": "e", "question": "q", "closed": False, "is_resolved": False}])
    got = {r.slug: r.is_resolved for r in C.normalize_feed(C.feed_rows(feed, 20)).collect()}
    assert got == {"a": False, "b": None, "c": True, "d": True, "e": False}


def test_stats_with_zero_news(spark):
    arr = spark.createDataFrame([("processed_news", 1, "00:00:01")], "topic string, arrival long, time string")
    r = SV.buffer_stats(arr).first()
    assert (r.total_news, r.total_processed, r.processing_rate) == (0, 1, 0.0)
    assert r.latest_news_time is None and r.latest_processed_time == "00:00:01"


@pytest.mark.parametrize("limit", [0, -1, 1001])
def test_limits_rejected(spark, limit):
    m = _current(spark)
    with pytest.raises(ValueError):
        SV.markets_list(m, limit)


def test_delta_quiet_topic_sends_nothing(spark):
    arr = spark.createDataFrame([("news_stream", i, "t") for i in range(30)] + [("processed_news", 3, "t")],
                                "topic string, arrival long, time string")
    since = spark.createDataFrame([("news_stream", 5), ("processed_news", 3)], "topic string, last_arrival long")
    out = SV.delta_feed(arr, since).collect()
    assert {r.topic for r in out} == {"news_stream"}
    assert sorted(r.arrival for r in out) == list(range(20, 30))


def test_iso_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 60),), (dt.datetime(2024, 1, 2, 3, 4, 5),)],
                               "t timestamp_ntz")
    got = [r.s for r in df.select(iso_timestamp("t").alias("s")).collect()]
    assert got == ["2024-01-02T03:04:05.000060", "2024-01-02T03:04:05"]


def test_large_buffers_use_salted_rounds(spark):
    arr = spark.createDataFrame([("a" if i % 10 else "b", i, "t") for i in range(5000)],
                                "topic string, arrival long, time string")
    got = SV.recent_by_topic(arr, size=1500)
    rows = got.collect()
    a = sorted(r.arrival for r in rows if r.topic == "a")
    b = sorted(r.arrival for r in rows if r.topic == "b")
    assert len(a) == 1500 and a[0] == sorted(i for i in range(5000) if i % 10)[-1500]
    assert len(b) == 500


def test_enrich_shuffled_path_equals_broadcast(spark):
    news = spark.createDataFrame([(i, float(i % 3) if i % 4 else None) for i in range(200)],
                                 "news_id long, s double")
    news = news.withColumn("matched_market_id", F.when(F.col("s").isNotNull(), (F.col("news_id") % 5) - 2))
    cat = spark.createDataFrame([(i, f"m{i}", f"q{i}") for i in range(-2, 3)], "id long, slug string, question string")
    key = lambda r: r.news_id
    a = sorted(M.enrich(news, cat).collect(), key=key)
    b = sorted(M.enrich(news, cat, max_broadcast_bytes=0).collect(), key=key)
    assert a == b and sum(r.matched_market is not None for r in a) == 150


def test_process_over_budget_catalogue_falls_back_to_blocked(spark):
    from semjoin.operators import news as N
    from semjoin.plans import fixtures as X
    from semjoin.plans import registry as R
    sf = "/root/testdata/sf0.001"
    cols = ["msg_id", "matched_market_id", "matched_market", "match_score", "db_status"]

    def run(**kw):
        out = N.process(X.fx_raw(spark, sf), R._embedder(), R._hash_catalogue(spark, sf), dim=X.FX_DIM,
                        threshold=X.FX_THRESHOLD, **kw)
        return sorted((r.msg_id, r.matched_market_id, r.matched_market,
                       None if r.match_score is None else round(r.match_score, 9), r.db_status)
                      for r in out.select(*cols).collect())

    prep = M.prepare_catalogue(R._hash_catalogue(spark, sf), X.FX_DIM, max_broadcast_bytes=1000)
    assert prep.bc is None and M.catalogue_bytes(prep.n_rows, X.FX_DIM) > 1000
    small = run(max_broadcast_bytes=1000)      # a few rows at most: blocked strategy
    default = run()
    assert small == default and sum(r[1] is not None for r in default) > 0


@pytest.mark.parametrize("strategy", ["broadcast", "blocked", "ivf"])
@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf")])
def test_one_bad_market_spoils_nothing(spark, strategy, bad):
    news = _news(spark, [[1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.1, 0.0], [bad, 0.0, 0.0, 1.0]])
    cat = _cat(spark, [(1, [bad, 1.0, 0.0, 0.0]), (2, [1.0, 0.1, 0.0, 0.0]), (3, [0.0, 1.0, 0.0, 0.0])])
    got = {r.news_id: r.matched_market_id for r in M.nearest(news, cat, dim=DIM, threshold=None, strategy=strategy, nlist=2, nprobe=2).collect()}
    assert got == {0: 2, 1: 3, 2: None}
    assert M.prepare_catalogue(cat.selectExpr("*", "'s' AS slug", "'q' AS question"), DIM).n_rows == 2


@pytest.mark.parametrize("strategy", ["broadcast", "blocked", "ivf"])
def test_ten_thousand_equal_markets(spark, strategy):
    cat = spark.range(10_000).select((F.col("id") + 5).alias("id"), F.array(*[F.lit(x).cast("float") for x in (1.0, 2.0, 0.0, 0.0)]).alias("embedding"))
    cat = cat.unionByName(_cat(spark, [(1, [1.0, 0.0, 0.0, 0.0])]))
    news = _news(spark, [[2.0, 4.0, 0.0, 0.0], [1.0, 0.0, 0.0, 0.0]])
    got = {r.news_id: r.matched_market_id for r in M.nearest(news, cat, dim=DIM, threshold=None, strategy=strategy, nlist=3, nprobe=3).collect()}
    assert got == {0: 5, 1: 1}
    assert M.usable_catalogue(cat, DIM).count() == 2


def test_rescoring_is_bounded_and_exact():
    """Scaled copies all tie: the kernel rescores them in slices and still answers with the lowest id."""
    import tracemalloc

    import numpy as np
    rng = np.random.default_rng(0)
    base = rng.normal(size=64)
    cat = (base[None, :] * rng.uniform(0.5, 2, size=(3000, 1))).astype(np.float32)
    cat[::7] = rng.normal(size=(len(cat[::7]), 64))
    x = np.repeat((base / np.linalg.norm(base))[None, :], 1500, axis=0)
    inv = M._reciprocal_norms(cat)
    want = np.round((cat.astype(float) @ x[0]) * inv, M.TIE_DECIMALS)
    was = M.RESCORE_BYTES
    try:
        for M.RESCORE_BYTES in (1 << 23, 64 * 16 * 100):       # also fewer than the candidates of one row
            tracemalloc.start()
            at, sim = M._best(x[:1500 if M.RESCORE_BYTES > 1 << 20 else 40], np.ones(len(x), bool)[:1500 if M.RESCORE_BYTES > 1 << 20 else 40], np.arange(3000), cat, inv)
            peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            assert (at == int(np.argmax(want))).all() and sim[0] == pytest.approx(want.max())
            assert peak < 16 * 3000 * 1500 + 6 * (1 << 23)
    finally:
        M.RESCORE_BYTES = was


@pytest.mark.parametrize("strategy", ["blocked", "ivf"])
def test_repeated_and_text_keys_equal_broadcast(spark, strategy):
    rows = [("a", [1.0, 0.0, 0.0, 0.0]), ("a", [0.9, 0.3, 0.0, 0.0]), ("b", [0.0, 1.0, 0.0, 0.0]), (None, [0.0, 0.0, 1.0, 0.2]), ("c", None)]
    news = spark.createDataFrame(rows, "news_id string, embedding array<float>")
    cat = _cat(spark, [(1, [1.0, 0.05, 0.0, 0.0]), (2, [0.0, 1.0, 0.0, 0.0]), (3, [1.0, 0.4, 0.0, 0.0]), (4, [0.0, 0.0, 1.0, 0.0])])
    def got(s):
        return sorted(map(str, M.nearest(news, cat, dim=DIM, threshold=None, strategy=s, nlist=2, nprobe=2).withColumn("match_score", F.round("match_score", 9)).collect()))
    assert got(strategy) == got("broadcast") and sum("matched_market_id=None" in r for r in got(strategy)) == 1


def test_inverted_lists_are_trained_once(spark, monkeypatch):
    trained = []
    real = M.train_lists
    monkeypatch.setattr(M, "train_lists", lambda *a: trained.append(1) or real(*a))
    cat = _cat(spark, [(i, [float(i % 5), 1.0, float(i % 3), 0.5]) for i in range(60)])
    ready = M.prepare_catalogue(cat.selectExpr("*", "'s' AS slug", "'q' AS question"), DIM, strategy="ivf", nlist=4)
    for k in range(3):
        news = _news(spark, [[float(k), 1.0, 1.0, 0.0]] * 3)
        for probes in (1, 4):
            out = M.nearest(news, cat, dim=DIM, threshold=None, strategy="ivf", nprobe=probes, prepared=ready).collect()
            assert all(r.matched_market_id is not None for r in out)
        exact = M.nearest(news, cat, dim=DIM, threshold=None).collect()
        assert sorted(r.matched_market_id for r in out) == sorted(r.matched_market_id for r in exact)
    assert trained == [1]
    ready.release()


def test_enrich_spreads_a_popular_market(spark):
    news = spark.range(3000).select(F.col("id").alias("news_id"), F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.lit(2)).cast("long").alias("matched_market_id"))
    cat = spark.createDataFrame([(1, "s1", "q1"), (2, "s2", "q2")], "id long, slug string, question string")
    out = M.enrich(news, cat, max_broadcast_bytes=0)
    assert out.count() == 3000 and out.where("matched_market = 's1'").count() == 750 and out.where("matched_market IS NULL").count() == 750


@pytest.mark.parametrize("text,stored", [("10:11:12", "10:11:12"), ("10:11:12.345678", "10:11:12.345678"), ("10:11:12.500", "10:11:12.5"),
                                         ("10:11:12.000", "10:11:12"), ("10:10", "10:10:00"), ("00:00:00", "00:00:00"), ("24:00", None), ("10", None), (None, None)])
def test_times_are_stored_whole(spark, text, stored):
    assert spark.createDataFrame([(text,)], "t string").select(N.time_value(F.col("t")).alias("v")).first().v == stored


def test_recent_lists_are_oldest_first(spark):
    arr = spark.createDataFrame([("news_stream", i, "t") for i in range(50)], "topic string, arrival long, time string")
    assert [r.arrival for r in SV.recent(arr, "news_stream", 5).collect()] == [45, 46, 47, 48, 49]


def test_items_under_other_names_are_listed(spark):
    items = spark.createDataFrame([("s", None, "2024-01-02", "", "h", "10:00", "n"), ("s", "2024-01-03", None, "x", None, "11:00", None), ("", "d", None, "x", None, "t", None)],
                                  "source string, date string, published_date string, news string, headline string, time string, other string")
    assert sorted(tuple(r) for r in SV.api_news(items).collect()) == [("s", "2024-01-02", "10:00", "h"), ("s", "2024-01-03", "11:00", "x")]


def test_large_buffers_keep_values(spark):
    big = (1 << 53) + 1
    arr = spark.range(4000, numPartitions=6).select(F.when(F.col("id") % 5 == 0, None).otherwise(F.lit("a")).alias("topic"), F.col("id").alias("arrival"),
                                                    F.when(F.col("id") % 3 > 0, F.col("id") * 2 + big).alias("news_id"))
    for n, most in ((1000, 1500), (1001, 1500), (1001, 10 ** 6), (1_000_001, 2_000_000)):
        got = {(r.topic, r.arrival): r.news_id for r in SV.top_n_per_key(arr, "topic", "arrival", n, most).collect()}
        want = {}
        for topic, own in ((None, [i for i in range(4000) if i % 5 == 0]), ("a", [i for i in range(4000) if i % 5])):
            want |= {(topic, i): i * 2 + big if i % 3 else None for i in own[-n:]}
        assert got == want


def test_products_and_cogroups_are_walked_in_tiles(monkeypatch):
    """Rows and catalogue in small tiles: the answers of one large product, in memory that follows the tile."""
    import tracemalloc

    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(3)
    cat = rng.normal(size=(2500, 16)).astype(np.float32)
    cat[2000:2100] = cat[100:200] * np.float32(2)                   # ties over tiles: the lower id
    left = np.concatenate([rng.normal(size=(2900, 16)), cat[2000:2100]]).astype(np.float32)
    unit = left / np.linalg.norm(left, axis=1, keepdims=True).astype(float)
    sims = np.round((unit @ cat.T.astype(float)) * M._reciprocal_norms(cat), M.TIE_DECIMALS)
    monkeypatch.setattr(M, "SIM_CHUNK_CELLS", 1 << 14)
    monkeypatch.setattr(M, "SIM_CHUNK_ROWS", 64)
    monkeypatch.setattr(M, "LEFT_BATCH_ROWS", 300)
    tracemalloc.start()
    at, _ = M._best(unit, np.ones(len(unit), bool), np.arange(len(cat)), cat, M._reciprocal_norms(cat))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (at == sims.argmax(axis=1)).all() and peak < 2 << 20     # all products: 29 MB in float32
    shuffled = rng.permutation(len(cat))
    market = pd.DataFrame({"id": shuffled, "embedding": [*cat[shuffled]]})
    out = M._block_kernel(16)(pd.DataFrame({"key": np.arange(len(left) + 1), "embedding": [*left, None]}), market)
    assert out["key"].tolist() == list(range(len(left))) and out["market_id"].tolist() == sims.argmax(axis=1).tolist()
    assert len(M._block_kernel(16)(pd.DataFrame({"key": [], "embedding": []}), market)) == 0
