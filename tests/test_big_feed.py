"""Feed documents of any size: cut into elements when too large for one variant."""

import json
import random

import pytest
from pyspark.sql import functions as F

from semjoin.operators import catalog as C


@pytest.mark.parametrize("text", ["[]", " [1, 2]", '{"data": []}', '{"markets": [{"a": "x,]\\"}"}, [1, [2]], "s", null]}', '{"data": 5, "markets": [1]}',
                                  '{"x": {"data": [9]}, "markets" : [ {"k": [1, {"z": "[,"}]} , 2 ] }', "{}", '{"a": 1}', "5", "", '"data"', "[[1], [2, 3]]"])
def test_elements_are_those_of_a_json_parser(text):
    try:
        doc = json.loads(text)
    except ValueError:
        doc = None
    want = doc if isinstance(doc, list) else (doc.get("data", doc.get("markets")) if isinstance(doc, dict) else None)
    got = C.feed_elements(text)
    assert (None if got is None else [json.loads(x) for x in got]) == (want if isinstance(want, list) else None)


def test_elements_of_random_documents():
    rng = random.Random(1)

    def value(depth):
        kind = rng.randrange(6 if depth else 3)
        if kind < 3:
            return rng.choice([1, -2.5, None, True, "", 'q"\\]},[', "é\n:"])
        return [value(depth - 1) for _ in range(rng.randrange(4))] if kind < 5 else {f"k{i}\"": value(depth - 1) for i in range(rng.randrange(3))}
    for _ in range(400):
        rows = [value(3) for _ in range(rng.randrange(6))]
        doc = rng.choice([rows, {"data": rows}, {"other": value(2), "markets": rows}, {"markets": value(1), "data": rows}])
        text = json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        assert [json.loads(x) for x in C.feed_elements(text)] == rows
        cut = text.rstrip()[:-1]
        assert C.feed_elements(cut) is None and C.feed_elements(text + "]") is None


@pytest.mark.parametrize("cut", [False, True])
def test_cut_documents_give_the_same_rows(spark, monkeypatch, cut):
    monkeypatch.setattr(C, "BIG_DOCUMENT", 10 if cut else 1 << 30)
    docs = [(1, json.dumps([{"slug": f"m{i}", "question": "q" * i} for i in range(5)])), (2, json.dumps({"data": [{"slug": "a"}, 7, None]})),
            (3, json.dumps({"markets": [{"slug": "z", "tags": [1, {"x": "]"}]}]})), (4, '[{"slug": "broken"}'), (5, json.dumps({"neither": [1, 2, 3]})), (6, None)]
    frame = spark.createDataFrame(docs, "snap long, value string")
    rows = C.normalize_feed(C.feed_rows(frame, 4)).select("snap", "pos", "slug", F.length("question").alias("n"))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([(1, i, f"m{i}", i or None) for i in range(4)] + [(2, 0, "a", None), (2, 1, None, None), (2, 2, None, None), (3, 0, "z", None)], key=str)
    assert sorted(r.snap for r in C.unreadable_documents(frame).collect()) == [4, 5, 6]


def test_a_snapshot_of_200_megabytes(spark, tmp_path):
    body = "x" * 1_000_000
    value = F.concat(F.lit('{"data": ['), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(199)), lambda i: F.concat(
        F.lit('{"slug": "m'), i.cast("string"), F.lit('", "question": "'), F.lit(body), F.lit('"}'))), ","), F.lit("]}"))
    spark.range(1).select(value.alias("value"), F.lit(1).cast("long").alias("snap")).write.parquet(f"{tmp_path}/feed")
    docs = spark.read.parquet(f"{tmp_path}/feed")
    assert docs.select(F.octet_length("value")).first()[0] > 200_000_000
    got = C.normalize_feed(C.feed_rows(docs, 1000)).select("slug", F.length("question").alias("n")).collect()
    assert sorted(r.slug for r in got) == sorted(f"m{i}" for i in range(200)) and {r.n for r in got} == {1_000_000}
