"""Token counts of documents in flat, unindexed token files, by a vectorised scan for end-of-document identifiers.

A token file is nothing but little-endian identifiers, one document after another, each ended by ``eod``. Files are cut
into blocks wherever they fall; a task reads one block, finds the separators in one vectorised comparison and returns
their positions. Documents that cross blocks are stitched by a prefix scan over the blocks of a file: the number of
separators before a block numbers its documents, the last separator before it starts its first one.

``write_token_files`` makes such files from a table, one file a task, and lists which document went where. A file is
named by one attempt of its task, and only listed files are read, so lost executors and repeated tasks do no harm.

Defined cases: null and empty texts have 0 tokens; runs of white space of any length are tokenised as the pattern says; tokens after the last separator of a file are a document of their
own; an empty file has none; repeated rows and null ids are counted each; a separator's text inside a document is
ordinary text; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from semjoin.llm.common import stage
from semjoin.session import shared_dir

#: Tokens of a block.
BLOCK = 1 << 21
#: How this vocabulary's words are split; it belongs to the vocabulary and is fixed.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: A run of white space (as the pattern's \s has it) that is cut out before the pattern sees it.
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}


@functools.lru_cache(maxsize=4)
def _encoding(path: str):
    import tiktoken
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=_ranks(path), special_tokens={})


def encode(encoding, text: str) -> list[int]:
    """The identifiers of a text. The pattern's engine cannot take very long runs of white space, so these are cut out first.

    The pattern makes one piece of such a run, but for its last character where something follows: that one may begin the
    next piece.
    """
    out, at = [], 0
    for found in _BLANKS.finditer(text):
        end = found.end() if found.end() == len(text) else found.end() - 1
        out += encoding.encode_ordinary(text[at:found.start()])
        out += encoding._encode_single_piece(text[found.start():end])
        at = end
    return out + encoding.encode_ordinary(text[at:])


def id_width(tokenizer: str, eod: int) -> int:
    """Bytes of an identifier in the token files: enough for every rank of the vocabulary and ``eod``, which must be free."""
    used = set(_ranks(tokenizer).values())
    if eod in used or eod < 0:
        raise ValueError(f"identifier {eod} is a token of the vocabulary or negative; it cannot end documents")
    return 2 if max(eod, *used) < 1 << 16 else 4


def _dtype(width: int) -> str:
    return f"<u{width}"


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a URI; a bare ``file:/x`` is a local path."""
    return pyarrow.fs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def write_token_files(docs: DataFrame, tokenizer: str, eod: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise whole texts into flat files in the shared folder; rows (file, ordinal, doc_id), and per file (file, -1, tokens)."""
    folder, kind = shared_dir(docs.sparkSession, "llm", "tokens"), _dtype(id_width(tokenizer, eod))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, name = _encoding(tokenizer), f"{folder}/{uuid.uuid4().hex}.bin"
        fs, path = _open(name)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        n, tokens = 0, 0
        with fs.open_output_stream(path) as out:
            for batch in batches:
                for text in batch.column(1):
                    ids = np.append(encode(encoding, text.as_py() or ""), eod).astype(kind)
                    tokens += len(ids)
                    out.write(ids.tobytes())
                k = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([name] * k, pa.string()), pa.array(range(n, n + k), pa.int64()),
                                                  batch.column(0).cast(pa.int64())], ["file", "ordinal", "doc_id"])
                n += k
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([-1], pa.int64()), pa.array([tokens], pa.int64())], ["file", "ordinal", "doc_id"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stage(rows.mapInArrow(write, "file string, ordinal long, doc_id long"), "token_index")


def token_files(spark, path: str, width: int = 2) -> DataFrame:
    """(file, tokens) of the token files in a folder, ``width`` bytes a token; only their lengths are read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("file"), F.expr(f"length div {width}").alias("tokens"))


def scan(files: DataFrame, eod: int, block: int = BLOCK, width: int = 2) -> DataFrame:
    """(file, ordinal, n_tokens) of every document in ``files`` (file, tokens; ``width`` bytes a token), separators not counted."""
    kind = _dtype(width)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, tokens, at in zip(*(c.to_pylist() for c in batch.columns)):
                fs, path = _open(file)
                with fs.open_input_file(path) as f:
                    f.seek(at * block * width)
                    ids = np.frombuffer(f.read(min(block, tokens - at * block) * width), dtype=kind)
                ends = np.flatnonzero(ids == eod) + at * block
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([at], pa.int64()), pa.array([tokens], pa.int64()),
                                                  pa.array([ends], pa.list_(pa.int64()))], ["file", "block", "tokens", "ends"])

    blocks = files.filter("tokens > 0").select("file", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(tokens - 1) div {block}"))).alias("block"))
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = stage(blocks.repartition(tasks, "file", "block").mapInArrow(search, "file string, block long, tokens long, ends array<long>"), "token_blocks")
    # one narrow row a block goes through the prefix scan; separators' positions rise, so the last one is the largest
    so_far = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    carried = found.select("file", "block", F.size("ends").alias("n"), last.alias("last")).select(
        "file", "block", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("base"), F.coalesce(F.max("last").over(so_far), F.lit(-1)).alias("prev"))
    lengths = F.transform("ends", lambda e, i: e - F.when(i == 0, F.col("prev")).otherwise(F.col("ends")[i - 1]) - 1)
    docs = found.join(carried, ["file", "block"]).select("file", "base", F.posexplode(lengths).alias("pos", "n_tokens"))
    whole = docs.select("file", (F.col("base") + F.col("pos")).alias("ordinal"), "n_tokens")
    ends = found.groupBy("file").agg(F.first("tokens").alias("tokens"), F.sum(F.size("ends")).alias("ordinal"), F.coalesce(F.max(last), F.lit(-1)).alias("prev"))
    open_end = ends.filter("tokens - prev > 1").select("file", "ordinal", (F.col("tokens") - F.col("prev") - 1).alias("n_tokens"))
    return whole.unionByName(open_end)


def count_tokens(docs: DataFrame, tokenizer: str, eod: int, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every row of ``docs``, by writing token files and scanning them."""
    index = write_token_files(docs, tokenizer, eod, id_col, text_col)
    found = scan(index.filter("ordinal = -1").select("file", F.col("doc_id").alias("tokens")), eod, block, id_width(tokenizer, eod))
    return index.filter("ordinal >= 0").join(found, ["file", "ordinal"]).select("doc_id", "n_tokens")
