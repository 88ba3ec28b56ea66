"""Topics kept as files, with offsets: read from the earliest or the latest message on, published exactly once.

A topic is a folder. One publication (a micro-batch, or a batch write with its
number) is one offset: its tasks write Parquet files under ``data``, and the
driver's commit names those of the finished tasks in ``offsets/<n>.json``.
Files of failed or repeated tasks are named nowhere and so never read; a
publication that is run again finds its offset taken and removes what it
wrote. Offsets run from 0 without gaps, so the end of a topic is found by a
few look-ups, not by listing it. One query publishes to a topic.

``register(spark)`` adds the format ``file_topic`` (Spark's Python data source
interface) to a session:

* ``spark.readStream.format("file_topic").schema(...).option("starting", "latest").load(path)``;
  ``starting`` is ``earliest`` unless given; ``latest`` tails the topic from its end at the first start, and a restart goes
  on from the checkpoint. ``spark.read`` gives all that is published.
* ``stream.writeStream.format("file_topic").option("path", path)`` and ``publish_to_file_topic`` publish.

Files are opened with ``pyarrow.fs`` where the tasks run, so the folder must be one that it knows: a mounted folder,
HDFS, S3, GCS. A task reads some row groups of one file, batch by batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)
from pyspark.sql.types import StructType

FORMAT = "file_topic"
# Ours: row groups (one a written Arrow batch) that a task reads, and rows it holds at a time.
GROUPS_A_TASK, ROWS_AT_ONCE = 16, 1024


class Folder:
    """A topic's folder: look-ups and commits of offsets."""

    def __init__(self, path: str):
        if path.startswith("file:"):
            path = "/" + path[len("file:"):].lstrip("/")
        self.fs, self.root = pafs.FileSystem.from_uri(path)

    def _offset(self, n: int) -> str:
        return f"{self.root}/offsets/{n:012d}.json"

    def taken(self, n: int) -> bool:
        return self.fs.get_file_info(self._offset(n)).type == pafs.FileType.File

    def end(self, known: int = 0) -> int:
        """The first offset not taken, given that those below ``known`` are."""
        step = 1
        while self.taken(known + step - 1):
            known, step = known + step, step * 2
        while step > 1:                          # taken below known, not taken at known + step - 1
            step //= 2
            if self.taken(known + step - 1):
                known += step
        return known

    def files(self, n: int) -> list[dict]:
        with self.fs.open_input_stream(self._offset(n)) as f:
            return json.loads(f.read())["files"]

    def commit(self, n: int, written: list[dict]) -> None:
        if self.taken(n):
            return self.remove(written)
        self.fs.create_dir(f"{self.root}/offsets", recursive=True)
        draft = f"{self.root}/offsets/_{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as f:
            f.write(json.dumps({"files": written}).encode())
        self.fs.move(draft, self._offset(n))

    def remove(self, written: list[dict]) -> None:
        for file in written:
            if self.fs.get_file_info(f"{self.root}/{file['name']}").type == pafs.FileType.File:
                self.fs.delete_file(f"{self.root}/{file['name']}")

    def splits(self, start: int, end: int) -> list[Split]:
        return [Split(f["name"], at, min(at + GROUPS_A_TASK, f["groups"]))
                for n in range(start, end) for f in self.files(n) for at in range(0, f["groups"], GROUPS_A_TASK)]


@dataclass
class Split(InputPartition):
    name: str
    first: int
    last: int


@dataclass
class Written(WriterCommitMessage):
    files: list


class _Rows:
    """What batch and stream readers share: the rows of a split, in the columns asked for."""

    def __init__(self, path: str, schema: StructType):
        from pyspark.sql.pandas.types import to_arrow_schema
        self.path, self.schema = path, to_arrow_schema(schema)

    def read(self, split: Split | None) -> Iterator[pa.RecordBatch]:
        if split is None:                        # Spark's one partition of an empty topic
            return
        folder = Folder(self.path)
        with folder.fs.open_input_file(f"{folder.root}/{split.name}") as f:
            file = pq.ParquetFile(f)
            held = set(file.schema_arrow.names)
            for batch in file.iter_batches(ROWS_AT_ONCE, row_groups=list(range(split.first, split.last)),
                                           columns=[c for c in self.schema.names if c in held]):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c.name).cast(c.type) if c.name in held else pa.nulls(batch.num_rows, c.type) for c in self.schema],
                    schema=self.schema)


class Reader(_Rows, DataSourceReader):
    def partitions(self) -> list[Split]:
        folder = Folder(self.path)
        return folder.splits(0, folder.end())


class StreamReader(_Rows, DataSourceStreamReader):
    def __init__(self, path: str, schema: StructType, starting: str):
        if starting not in ("earliest", "latest"):
            raise ValueError(f"starting must be earliest or latest, got {starting!r}")
        super().__init__(path, schema)
        self.starting, self.known = starting, 0

    def initialOffset(self) -> dict:
        return {"next": Folder(self.path).end() if self.starting == "latest" else 0}

    def latestOffset(self) -> dict:
        self.known = Folder(self.path).end(self.known)
        return {"next": self.known}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        return Folder(self.path).splits(start["next"], end["next"])

    def commit(self, end: dict) -> None:
        pass


class _Files:
    """What batch and stream writers share: a task writes one Parquet file, a row group an Arrow batch."""

    def __init__(self, path: str):
        self.path = path

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        folder, out, groups, rows = Folder(self.path), None, 0, 0
        name = f"data/{uuid.uuid4().hex}.parquet"
        try:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                if out is None:
                    folder.fs.create_dir(f"{folder.root}/data", recursive=True)
                    out = pq.ParquetWriter(f"{folder.root}/{name}", batch.schema, filesystem=folder.fs)
                out.write_batch(batch)
                groups, rows = groups + 1, rows + batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written([{"name": name, "groups": groups, "rows": rows}] if groups else [])

    def _commit(self, messages: list[Written | None], n: int) -> None:
        Folder(self.path).commit(n, [f for m in messages if m is not None for f in m.files])

    def _abort(self, messages: list[Written | None]) -> None:
        Folder(self.path).remove([f for m in messages if m is not None for f in m.files])


class StreamWriter(_Files, DataSourceStreamArrowWriter):
    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self._commit(messages, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._abort(messages)


class Writer(_Files, DataSourceArrowWriter):
    def __init__(self, path: str, offset: int):
        super().__init__(path)
        self.offset = offset

    def commit(self, messages: list[Written | None]) -> None:
        self._commit(messages, self.offset)

    def abort(self, messages: list[Written | None]) -> None:
        self._abort(messages)


class FileTopic(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.options["path"], schema)

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(self.options["path"], schema, self.options.get("starting", "earliest"))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("a topic is appended to, not overwritten")
        return Writer(self.options["path"], int(self.options["offset"]))

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FileTopic)


def read_file_topic_stream(spark: SparkSession, path: str, schema: str = "value string", starting: str = "earliest") -> DataFrame:
    """The topic as a stream; the file twin of ``streams.read_topic_stream``."""
    register(spark)
    return spark.readStream.format(FORMAT).schema(schema).option("starting", starting).load(path)


def read_file_topic(spark: SparkSession, path: str, schema: str = "value string") -> DataFrame:
    """All that is published."""
    register(spark)
    return spark.read.format(FORMAT).schema(schema).load(path)


def publish_to_file_topic(path: str):
    """A sink for ``news_job``: ``publish(df, batch_id)`` publishes a batch once, however often it is replayed."""
    def publish(df: DataFrame, batch_id: int) -> None:
        register(df.sparkSession)
        df.write.format(FORMAT).option("offset", str(batch_id)).mode("append").save(path)
    return publish


def publish_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Publish a stream, one offset a micro-batch."""
    register(stream.sparkSession)
    w = stream.writeStream.format(FORMAT).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return w.trigger(**(trigger or {"availableNow": True})).start()
