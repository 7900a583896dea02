"""Operator 13: exact dedup by a minimal perfect hash over the digests of what is already there.

Every text becomes its SHA-256 digest. The distinct digests of the historical rows are cut into
buckets by hash, as many as keep a bucket small at any size of the corpus; each bucket gets a minimal
perfect hash, whose slots hold the full digest, the place of the row that stays (doc_id and row
number) and the number of rows. Incoming rows are first combined to one row per digest, so a text
that a third of all rows repeat is one lookup. A lookup goes to one slot and compares all bytes: equal
ones are repeats and settle with the slot's winner, all others are groups of their own.

Texts are equal when identical; null counts as empty. Of equal texts the row of largest doc_id stays;
of rows alike in doc_id as well, one (the last in reading order). A null doc_id is less than any
other and is never history. Other columns are not looked at. An empty table gives an empty table.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm import perfecthash
from orderloom.llm.common import arrow_schema, columns, ship, written

#: Digests that one bucket holds, about; a bucket is one row of the index and one group of a task.
BUCKET = 32_768
INDEX = columns("bucket bigint, sizes bigints, bits binary, digests binary, doc_ids bigints,"
                "rows bigints, counts bigints")
GROUPS = columns("digest binary, doc_id bigint, row bigint, n bigint, historical boolean")


class Index(NamedTuple):
    table: DataFrame
    buckets: int


def digested(docs: DataFrame) -> DataFrame:
    """doc_id, row (a number of its own) and digest of each row, as a stored table."""
    return written(docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest")), "digests")


def grouped(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays and the number of rows; combined before the shuffle."""
    return rows.groupBy("digest").agg(
        F.max(F.struct("doc_id", "row")).alias("last"), F.count("*").alias("n")).select(
        "digest", "last.doc_id", "last.row", "n")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket")


def build_index(groups: DataFrame, buckets: int) -> Index:
    """The index of `groups` (digest, doc_id, row, n), one row per bucket, stored."""
    ship(groups.sparkSession)
    schema = arrow_schema(INDEX)

    def build(table: pa.Table) -> pa.Table:
        digests = perfecthash.words(_joined(table.column("digest")))
        sizes, bits, slots = perfecthash.build(digests)
        order = np.argsort(slots)
        placed = table.take(pa.array(order))
        return pa.Table.from_pylist([{
            "bucket": table.column("bucket")[0].as_py(), "sizes": sizes, "bits": bits,
            "digests": digests[order].tobytes(), "doc_ids": placed.column("doc_id").to_pylist(),
            "rows": placed.column("row").to_pylist(), "counts": placed.column("n").to_pylist()}], schema)

    return Index(written(groups.select("*", _bucket(buckets)).groupBy("bucket").applyInArrow(
        build, INDEX), "digest-index"), buckets)


def _joined(column: pa.ChunkedArray) -> bytes:
    return b"".join(column.to_pylist())


def merged(incoming: DataFrame, index: Index) -> DataFrame:
    """All groups of history and `incoming` (digest, doc_id, row, n) together, as GROUPS."""
    ship(incoming.sparkSession)
    schema = arrow_schema(GROUPS)

    def look_up(new: pa.Table, stored: pa.Table) -> pa.Table:
        slots = stored.to_pylist()[0] if stored.num_rows else None
        ids, places, counts, member, old = [], [], [], np.zeros(new.num_rows, bool), b""
        given = list(zip(*(new.column(c).to_pylist() for c in ("doc_id", "row", "n")), strict=True))
        if slots:
            old, (ids, places, counts) = slots["digests"], (slots[c] for c in ("doc_ids", "rows", "counts"))
        if slots and new.num_rows:
            asked = perfecthash.words(_joined(new.column("digest")))
            found = perfecthash.find(asked, slots["sizes"], slots["bits"])
            member = (found >= 0) & (perfecthash.words(old)[found] == asked).all(axis=1)
            for i in np.flatnonzero(member):
                s, (doc_id, row, n) = found[i], given[i]
                counts[s] += n
                if _key(doc_id, row) > _key(ids[s], places[s]):
                    ids[s], places[s] = doc_id, row
        fresh = np.flatnonzero(~member)
        alone = [given[i] for i in fresh]
        digests = [old[i:i + perfecthash.WIDTH] for i in range(0, len(old), perfecthash.WIDTH)]
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip((
            digests + new.column("digest").take(pa.array(fresh, "int64")).to_pylist(),
            [*ids, *(x[0] for x in alone)], [*places, *(x[1] for x in alone)],
            [*counts, *(x[2] for x in alone)], [True] * len(digests) + [False] * len(alone)),
            schema, strict=True)], schema=schema)

    return incoming.select("digest", "doc_id", "row", "n", _bucket(index.buckets)).groupBy(
        "bucket").cogroup(index.table.groupBy("bucket")).applyInArrow(look_up, GROUPS)


def _key(doc_id: int | None, row: int) -> tuple[bool, int, int]:
    return doc_id is not None, doc_id or 0, row


def buckets_for(*groups: DataFrame) -> int:
    """As many buckets as the larger of these tables needs."""
    return max(g.count() for g in groups) // BUCKET + 1


def dedup_exact(docs: DataFrame, history_upto: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Rows of a doc_id up to `history_upto` are the history; by default the older half of the range of
    ids. The result is the same wherever the line is drawn.
    """
    rows = digested(docs)
    if history_upto is None:
        least, most = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
        history_upto = 0 if least is None else least + (most - least) // 2
    old = F.coalesce(F.col("doc_id") <= history_upto, F.lit(False))
    history = written(grouped(rows.where(old)), "history")
    incoming = written(grouped(rows.where(~old)), "incoming")
    index = build_index(history, buckets_for(history, incoming))
    # A stored table, so that a digest of very many rows can be split in the join.
    repeated = written(merged(incoming, index).where("n > 1").select(
        "digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), "n"), "repeated")
    single = F.col("n").isNull()
    return rows.join(repeated, "digest", "left").select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame, history_upto: int | None = None) -> DataFrame:
    """One row of each text, all columns: that of the largest doc_id."""
    kept = written(dedup_exact(docs, history_upto).where("kept").select(
        F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_sha")).distinct(), "kept-texts")
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: n for c, n in zip(docs.columns, names, strict=True)}
    plain = docs.toDF(*names)
    sha = F.sha2(F.coalesce(at["text"], F.lit("")), 256)
    return plain.join(kept, F.col(at["doc_id"]).eqNullSafe(F.col("k_id")) & (sha == F.col("k_sha")),
                      "left_semi").withColumn("k_sha", sha).dropDuplicates(
        [at["doc_id"], "k_sha"]).drop("k_sha").toDF(*docs.columns)
