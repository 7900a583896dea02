"""Operator 2: token ids of all documents in plane shards, and back.

Documents are dealt out by ranges of doc_id, so that shard after shard holds them in ascending
order. Each task encodes its range and writes one shard straight to the shared folder, under a
name no other attempt uses; the table of shards, committed by Spark, lists the shards that count.
A lost executor costs its open shards only. Reading deals out shards, each read block by block.

Files are opened through Arrow's file systems, so a folder in HDFS or an object store will do.

Defined cases: null text is an empty document, which is its end id alone. Null doc_ids come first,
and equal ones follow each other by text. An empty table gives no shards and no rows. Other columns
are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import arrow_schema, columns, ship, slices, written
from orderloom.llm.planes import BITS, PlaneReader, PlaneWriter
from orderloom.llm.tokens import encoder
from orderloom.session import work_dir

SHARDS = columns(
    "shard int, path string, bytes bigint, n_docs bigint, n_ids bigint")
DOCS = columns(
    "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, shard int")


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1,
                 planes: int = BITS, block_ids: int = 65536) -> DataFrame:
    """Encodes `docs` (doc_id, text) into shards in `folder`; returns the table of shards."""
    ship(docs.sparkSession)
    end, fields = np.array([end_id], "<u4").tobytes(), arrow_schema(SHARDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, writer = TaskContext.get().partitionId(), None
        fs, root = open_fs(folder)
        path = f"{root}/{number:06d}-{uuid.uuid4().hex}.planes"
        out = None
        for part in slices(batches):
            if writer is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(path)
                writer = PlaneWriter(out, planes, block_ids)
            found = encoder(tokenizer).ids([t or "" for t in part["text"]])
            for doc_id, ids in zip(part["doc_id"], found, strict=True):
                writer.add(doc_id, ids + end)
        if writer is not None:
            writer.close()
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                (number, path, size, len(writer.lengths), writer.n_ids), fields,
                strict=True)], schema=fields)

    ordered = docs.select("doc_id", "text").repartitionByRange(
        F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text")
    return written(ordered.mapInArrow(run, SHARDS), "shards")


def read_documents(shards: DataFrame, folder: str) -> DataFrame:
    """One row per document from the shards: doc_id, start, n_tokens, ids_crc32, shard."""
    ship(shards.sparkSession)
    fields = arrow_schema(DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(folder)
        for part in slices(batches):
            for shard, path, size, before in zip(part["shard"], part["path"], part["bytes"],
                                                 part["before"], strict=True):
                with fs.open_input_file(path) as file:
                    rows = []
                    for doc_id, start, n, crc in PlaneReader(file, size).documents():
                        rows.append((doc_id, before + start, n, crc, shard))
                        if len(rows) == 10_000:
                            yield _batch(rows, fields)
                            rows = []
                    if rows:
                        yield _batch(rows, fields)

    # One row per shard, so the running total over all of them is a small sort.
    before = F.coalesce(F.sum("n_ids").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = shards.withColumn("before", before)
    return placed.repartition(max(1, shards.count())).mapInArrow(run, DOCS)


def _batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), fields, strict=True)],
        schema=fields)


def token_shards(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 1,
                 planes: int = BITS, block_ids: int = 65536) -> DataFrame:
    """Writes all documents and reads them back from the files."""
    folder = folder or work_dir(docs.sparkSession, "planes")
    return read_documents(
        write_shards(docs, folder, tokenizer, end_id, planes, block_ids), folder)
