"""Topics kept as files: offsets, starting points, publishing once."""

from __future__ import annotations

import glob
import json
import os

import pyarrow as pa
import pytest

from semjoin.session import shared_dir
from semjoin.sources import file_topics as FT


def _path(spark, name):
    return shared_dir(spark, "test-topic", name)


def _values(df):
    return sorted(r.value for r in df.collect())


def _local(path):
    return path.replace("file:", "")


def _collect_stream(stream, out, checkpoint):
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 31, 33])
def test_end_is_found_whatever_is_known(tmp_path, n):
    folder = FT.Folder(str(tmp_path))
    for k in range(n):
        folder.commit(k, [])
    assert [folder.end(known) for known in range(n + 1)] == [n] * (n + 1)


def test_earliest_latest_and_restart(spark):
    path = _path(spark, "start")
    publish = FT.publish_to_file_topic(path)
    batch = lambda *v: spark.createDataFrame([(x,) for x in v], "value string")
    publish(batch("a", "b"), 0)
    outs = {}
    for starting in ("earliest", "latest"):
        outs[starting] = out = _path(spark, f"out-{starting}")
        stream = FT.read_file_topic_stream(spark, path, starting=starting)
        _collect_stream(stream, out, f"{out}-ckpt")
    publish(batch("c"), 1)
    publish(batch("d", "d", None), 2)
    for starting, out in outs.items():
        stream = FT.read_file_topic_stream(spark, path, starting=starting)
        _collect_stream(stream, out, f"{out}-ckpt")
    read = lambda s: sorted(str(r.value) for r in spark.read.schema("value string").parquet(outs[s]).collect())
    assert read("latest") == ["None", "c", "d", "d"]
    assert read("earliest") == ["None", "a", "b", "c", "d", "d"]
    with pytest.raises(Exception, match="earliest or latest"):
        _collect_stream(FT.read_file_topic_stream(spark, path, starting="middle"), _path(spark, "o"), _path(spark, "c"))


def test_a_replayed_batch_is_published_once(spark):
    path = _path(spark, "once")
    publish = FT.publish_to_file_topic(path)
    rows = spark.range(0, 100, 1, 4).selectExpr("CAST(id AS STRING) AS value")
    publish(rows, 0)
    files = set(glob.glob(f"{_local(path)}/data/*"))
    publish(rows, 0)                                # the job was lost after publishing, before its own commit
    publish(rows.where("value >= '5'"), 1)
    assert _values(FT.read_file_topic(spark, path)) == sorted([str(i) for i in range(100)] + [str(i) for i in range(100) if str(i) >= "5"])
    assert files <= set(glob.glob(f"{_local(path)}/data/*")) and len(glob.glob(f"{_local(path)}/offsets/*.json")) == 2
    named = {f["name"] for p in glob.glob(f"{_local(path)}/offsets/*.json") for f in json.load(open(p))["files"]}
    assert named == {f"data/{os.path.basename(p)}" for p in glob.glob(f"{_local(path)}/data/*")}   # the repeat left nothing


def test_failed_tasks_publish_nothing(spark):
    path = _path(spark, "failed")
    bad = spark.range(0, 40, 1, 4).selectExpr("IF(id = 35, raise_error('lost'), CAST(id AS STRING)) AS value")
    with pytest.raises(Exception, match="lost"):
        FT.publish_to_file_topic(path)(bad, 0)
    assert FT.Folder(path).end() == 0 and FT.read_file_topic(spark, path).count() == 0


def test_streams_publish_and_empty_batches_take_an_offset(spark):
    src, path = _path(spark, "src"), _path(spark, "streamed")
    spark.range(500).selectExpr("CAST(id AS STRING) AS value", "id AS n").write.parquet(src)
    stream = lambda: spark.readStream.schema("value string, n long").parquet(src)
    FT.publish_stream(stream(), path, f"{path}-ckpt").awaitTermination()
    FT.publish_stream(stream(), path, f"{path}-ckpt").awaitTermination()
    got = FT.read_file_topic(spark, path, "n long, value string, extra double")
    assert got.columns == ["n", "value", "extra"] and got.where("extra IS NOT NULL").count() == 0
    assert sorted((r.n, r.value) for r in got.collect()) == [(i, str(i)) for i in range(500)]
    FT.publish_to_file_topic(path)(spark.createDataFrame([], "value string"), FT.Folder(path).end())
    assert FT.read_file_topic(spark, path).count() == 500


def test_a_large_file_is_read_by_several_tasks(tmp_path):
    def batches():
        for i in range(40):
            yield pa.record_batch({"value": [str(i)] * 5})
    message = FT._Files(str(tmp_path)).write(batches())
    folder = FT.Folder(str(tmp_path))
    folder.commit(0, message.files)
    splits = folder.splits(0, 1)
    assert [(s.first, s.last) for s in splits] == [(0, 16), (16, 32), (32, 40)]
