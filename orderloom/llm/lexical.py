"""Operator 12: ranked lexical search over impact vectors in buckets by length.

A document is a vector with one integer impact for each of its terms, an item one with a weight for
each of its terms; a score is their product. Vectors are held in order of length, cut into buckets.
For an item and a bucket, the product of the lengths (Cauchy-Schwarz) is an upper bound: below the
item's threshold the whole bucket is skipped. Inside, the item's heaviest coordinates are multiplied
out and the rest is bounded by the lengths of what remains of both vectors; documents that stay below
the threshold are dropped. Survivors are scored again exactly, in integers. Bounds are floats rounded
up; scores never are.

The threshold of an item is a score that at least k documents reach. It starts with the k-th best
among about `SEED` of the longest vectors of the whole corpus, and each task raises it by what it finds. Every
task keeps its own k best per item; these few rows are ranked at the end.

Items are taken in blocks of bounded size, and their terms are the only coordinates kept, so what goes
to the workers does not grow with the corpus, nor with the number of items.

Defined cases: null or empty texts and texts without a term have no vector and are never found; items
without a term, or without a document that scores, have no rows. Rows alike are ranked one by one, also
items of equal item_id. Equal scores go by doc_id, a null doc_id last. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import arrow_schema, columns, per_slice, ship, written

#: Of a text in UTF-8 with A-Z lower-cased.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Bytes of item text in one block.
BLOCK = 2_000_000
#: Vectors, and coordinates, of one bucket.
BUCKET, COORDINATES = 4096, 2_000_000
#: Vectors from which the first thresholds come.
SEED = 8192
#: Coordinates multiplied out before the rest is bounded.
FOCUS = 4
UP = 1 + 1e-9
VECTORS = columns("row bigint, doc_id bigint, n bigint, terms ints, counts ints")
FOUND = columns("item bigint, doc_id bigint, score bigint")


class Queries:
    """A block of items: their terms numbered, each item's terms with repeats counted."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.terms: dict[bytes, int] = {}
        self.items = []
        for number, text in items:
            found = Counter(terms_of(text))
            ids = [self.terms.setdefault(t, len(self.terms)) for t in found]
            if ids:
                self.items.append((number, np.array(ids), np.array(list(found.values()), "i8")))

    def weigh(self, df: dict[int, int], documents: int) -> None:
        """Sets the weights of all terms, heaviest first in each item."""
        w = np.array([weight(documents, df[t]) if t in df else 0 for t in range(len(self.terms))], "i8")
        self.weighted = []
        for number, ids, repeats in self.items:
            own = w[ids] * repeats
            order = np.argsort(-own, kind="stable")
            order = order[own[order] > 0]
            if len(order):
                self.weighted.append((number, ids[order].tolist(), own[order].tolist()))


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall((text or "").encode().lower())  # bytes: only A-Z change


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def vectors(docs: DataFrame, queries: Queries) -> DataFrame:
    """Documents with a term: number of terms, and how often each term of the block occurs."""
    sent = docs.sparkSession.sparkContext.broadcast(queries.terms)

    def task(part: dict[str, list]) -> dict[str, list]:
        known, out = sent.value, {name: [] for name in VECTORS.names}
        for row, doc_id, text in zip(part["row"], part["doc_id"], part["text"], strict=True):
            words = terms_of(text)
            if words:
                found = Counter(map(known.get, words))
                found.pop(None, None)
                for name, value in zip(VECTORS.names, (row, doc_id, len(words), list(found),
                                                       list(found.values())), strict=True):
                    out[name].append(value)
        return out

    return written(per_slice(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"),
                             task, VECTORS), "vectors")


def impacts(found: DataFrame, documents: int, terms: int) -> DataFrame:
    """row, doc_id, terms, impacts and squared length of the vectors that have a coordinate."""
    by_length = f"(100 - 75 + (75 * n * {documents}L) div {terms}L)"
    return found.where(F.size("terms") > 0).withColumn("m", F.expr(by_length)).select(
        "row", "doc_id", "terms", F.expr(
            "transform(counts, tf -> (1000000000L * tf) div (1000L * tf + 8 * m))").alias("impacts")
    ).withColumn("square", F.expr("aggregate(impacts, 0D, (s, x) -> s + double(x) * x)"))


class Bucket:
    """Some vectors, turned into one list of (vector, impact) per coordinate."""

    def __init__(self, batch: pa.RecordBatch):
        terms, made = batch.column("terms"), batch.column("impacts")
        ids = terms.flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(terms.offsets.to_numpy()))
        order = np.argsort(ids, kind="stable")
        self.size = batch.num_rows
        self.doc_id = batch.column("doc_id")
        self.square = batch.column("square").to_numpy() * UP
        self.longest = math.sqrt(self.square.max())
        coordinates, first = np.unique(ids[order], return_index=True)
        edges = [*first.tolist(), len(ids)]
        owner, values = owner[order], made.flatten().to_numpy(zero_copy_only=False)[order]
        self.lists = {t: (owner[a:b], values[a:b])
                      for t, a, b in zip(coordinates.tolist(), edges, edges[1:], strict=False)}

    def may_reach(self, terms: list[int], weights: list[int], least: int) -> np.ndarray:
        """Which vectors may score `least`, by the focus coordinates and the length of the rest."""
        part, rest = np.zeros(self.size), self.square.copy()
        for t, w in zip(terms[:FOCUS], weights[:FOCUS], strict=True):
            if t in self.lists:
                owner, values = self.lists[t]
                part[owner] += w * values.astype("f8")
                rest[owner] -= values.astype("f8") ** 2
        length = math.sqrt(sum(float(w) * w for w in weights[FOCUS:]))
        return (part + length * np.sqrt(np.maximum(rest, 0))) * UP >= least

    def scores(self, terms: list[int], weights: list[int]) -> np.ndarray:
        total = np.zeros(self.size, "i8")
        for t, w in zip(terms, weights, strict=True):
            if t in self.lists:
                owner, values = self.lists[t]
                total[owner] += w * values
        return total


def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    for batch in batches:
        ends = batch.column("terms").offsets.to_numpy()
        first = 0
        while first < batch.num_rows:
            end = int(np.searchsorted(ends, ends[first] + COORDINATES, side="right")) - 1
            part = batch.slice(first, max(1, min(end - first, BUCKET)))
            yield Bucket(pa.RecordBatch.from_arrays(
                [pa.concat_arrays([c]) for c in part.columns], names=part.schema.names))
            first += part.num_rows


def search(batches: Iterator[pa.RecordBatch], queries: list, least: dict[int, int], k: int) -> dict:
    """The k best (-score, no doc_id, doc_id) per item among vectors that come longest first."""
    best: dict[int, list[tuple[int, bool, int]]] = {}
    lengths = {number: math.sqrt(sum(float(w) * w for w in weights)) for number, _, weights in queries}
    for bucket in buckets(batches):
        for number, terms, weights in queries:
            own = best.get(number, [])
            bar = max(1, least.get(number, 0), -own[-1][0] if len(own) == k else 0)
            if lengths[number] * bucket.longest * UP < bar:
                continue
            may = bucket.may_reach(terms, weights, bar)
            if may.any():
                scores = bucket.scores(terms, weights)
                kept = np.flatnonzero(may & (scores >= bar))
                if len(kept):
                    best[number] = sorted([*own, *_first(bucket, scores, kept, k)])[:k]
    return best


def _first(bucket: Bucket, scores: np.ndarray, kept: np.ndarray, k: int) -> list[tuple[int, bool, int]]:
    ids = bucket.doc_id.take(pa.array(kept))
    none = ids.is_null().to_numpy(zero_copy_only=False)
    number = ids.fill_null(0).to_numpy()
    order = np.lexsort((number, none, -scores[kept]))[:k]
    return [(-int(scores[kept[i]]), bool(none[i]), int(number[i])) for i in order]


def best_of(ordered: DataFrame, queries: Queries, least: dict[int, int], k: int) -> DataFrame:
    """The k best of each partition of `ordered`, per item."""
    ship(ordered.sparkSession)
    sent = ordered.sparkSession.sparkContext.broadcast((queries.weighted, least))
    schema = arrow_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighted, bars = sent.value
        rows = [(number, None if none else doc_id, -score)
                for number, own in search(batches, weighted, bars, k).items()
                for score, none, doc_id in own]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)],
                schema=schema)

    return ordered.select("doc_id", "terms", "impacts", "square").mapInArrow(run, FOUND)


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = BLOCK,
           seed: int = SEED) -> DataFrame:
    """item_id, rank, doc_id, score: for each item the `k` documents of the highest scores above 0."""
    spark = docs.sparkSession
    numbered = written(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"),
                       "items")
    size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    found = spark.createDataFrame([], FOUND)
    for b in range(blocks):
        own = numbered.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        queries = Queries([tuple(r) for r in own.select("item", "text").collect()])
        if queries.items:
            found = found.unionByName(_block(docs, queries, k, seed))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(
        numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _block(docs: DataFrame, queries: Queries, k: int, seed: int) -> DataFrame:
    own = vectors(docs, queries)
    documents, terms = own.agg(F.count("*"), F.sum("n")).first()
    queries.weigh({t: n for t, n in own.select(F.explode("terms").alias("t")).groupBy("t").count()
                   .collect()}, documents)  # at most one row per term of the block
    made = impacts(own, documents, terms or 1)
    # About as many of the longest as wanted; which of them does not matter to the result.
    edge = made.agg(F.percentile_approx("square", max(0.0, 1 - seed / max(1, documents)))).first()[0]
    longest = made.where(F.col("square") >= F.lit(edge)).limit(seed)
    least = {r.item: r.score for r in best_of(longest, queries, {}, k).groupBy("item").agg(
        F.min("score").alias("score"), F.count("*").alias("n")).where(F.col("n") == k).collect()}
    return written(best_of(made.sortWithinPartitions(F.desc("square")), queries, least, k), "found")
