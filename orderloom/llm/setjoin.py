"""Operator 4: n-gram Jaccard join with set-relation skipping.

Texts become sets of word shingles; equal sets become one. Sets are indexed by signatures of their
parts (see `shingles`), so the lists of the index hold sets that share whole parts, by position.

Index skipping: a list of one set is dropped at once. Of the others, positions beyond what the size
class can differ in are never written, and within a list a partner is skipped by its size.

Answer skipping: each list has a pivot, its least set. All others are compared with it exactly. Sets
found to be in one component need no comparison with each other: their answers follow from the
pivot's. Only sets that stay outside the pivot's component go on, and what is known of both against
the pivot bounds their overlap from both sides: many pairs are settled by that alone. Parity bitmaps
settle most of the rest, and what remains is compared exactly.

No list is ever expanded into all its pairs: the first round has one row per set and pivot; the
second pairs only outsiders, and its condition is evaluated inside the join. Both sides of each join
are stored tables, so that a list with a third of the corpus is split over tasks.

Defined cases: null or empty text is an empty set: n_shingles 0, linked with nothing. A text of
fewer than k words is one shingle. Rows with equal doc_ids are documents each, whose ids are alike;
rows alike are copies. A null doc_id is never chosen as component_id unless the component has no
other. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import (
    arrow_schema, columns, drop_scratch, fresh, per_slice, scratch_mark, scratch_path, ship, slices,
    written, written_parts)
from orderloom.llm.components import components
from orderloom.llm.shingles import BITMAP, bitmap, shingle_set, signatures
from orderloom.sinks.tables import remove_folder

#: Slices of the signatures. They are worked off one after the other, so that the shuffle files on disk at a
#: time are those of one. A slice is a folder, which goes once its lists are made: signatures take far
#: more room than all else that is kept of a set.
SLICES = 8
SETS = columns("uid bigint, doc_id bigint, k_hash bigint, n bigint, set_hi bigint, set_lo bigint,"
               "bits bigints")
SIGNED = columns("uid bigint, doc_id bigint, k_hash bigint, n bigint, set_hi bigint, set_lo bigint,"
                 "bits bigints, parts bigints, slice int")
CHECKED = columns("a bigint, b bigint, overlap bigint, n_a bigint, n_b bigint")
NO_ID = (1 << 63) - 1
WORDS = BITMAP // 64


def sets_of(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """One row per row of `docs`, with a number of its own, and the signatures (uid, n, parts, slice), both
    stored: a folder per slice, and one more, the last, for the sets."""

    def task(part: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {name: [] for name in SIGNED.names}
        for uid, doc_id, k_hash, text in zip(*(part[c] for c in ("uid", "doc_id", "k_hash", "text")),
                                             strict=True):
            members = shingle_set(text, k)
            digest = np.frombuffer(xxhash.xxh3_128_digest(members.tobytes()), "<i8")
            signed = signatures(members, percent) if len(members) else np.zeros(0, "u8")
            own = signed % np.uint64(SLICES)
            rows = [(uid, None, None, len(members), None, None, None, signed[own == i].view("i8"), i)
                    for i in np.unique(own).tolist()]
            rows.append((uid, doc_id, k_hash, len(members), int(digest[0]), int(digest[1]),
                         bitmap(members) if len(members) else [], None, SLICES))
            for row in rows:
                for name, value in zip(SIGNED.names, row, strict=True):
                    out[name].append(value)
        return out

    given = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id",
                        F.xxhash64("text").alias("k_hash"), "text")
    made = written(per_slice(given, task, SIGNED), "sets", by="slice")
    return (made.where(F.col("slice") == SLICES).select(*SETS.names),
            made.where(F.col("slice") < SLICES).select("uid", "n", "parts", "slice"))


def linked(overlap: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * overlap >= percent * (a + b - overlap)


def sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def checked(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Exact overlap of the sets of `pairs` (a, b); `texts` has uid and text."""
    ship(pairs.sparkSession)
    fields = arrow_schema(CHECKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, members = None, None
        for part in slices(batches):
            rows = []
            for a, b, text_a, text_b in zip(*(part[c] for c in ("a", "b", "text_a", "text_b")),
                                            strict=True):
                if b != last:  # rows come ordered by b
                    last, members = b, shingle_set(text_b, k)
                other = shingle_set(text_a, k)
                both = np.intersect1d(other, members, assume_unique=True)
                rows.append((a, b, len(both), len(other), len(members)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), fields, strict=True)],
                schema=fields)

    text_a = texts.select(F.col("uid").alias("a"), F.col("text").alias("text_a"))
    text_b = texts.select(F.col("uid").alias("b"), F.col("text").alias("text_b"))
    return written_parts((
        own.join(text_a, "a").join(other, "b").select("a", "b", "text_a", "text_b")
        .sortWithinPartitions("b").mapInArrow(run, CHECKED)
        for own, other in zip(halves(pairs.select("a", "b"), "b"), halves(text_b, "b"), strict=True)),
        "checked")


def halves(rows: DataFrame, key: str) -> list[DataFrame]:
    """The rows in two parts by a hash of the key, to be worked off one after the other."""
    return [rows.where(F.pmod(F.xxhash64(key), F.lit(2)) == i) for i in range(2)]


def entries_of(signed: DataFrame, path: str, reps: DataFrame) -> Iterator[DataFrame]:
    """Per slice: list, pivot, uid, n of the lists with more than one set. The slice's folder below `path`
    is removed after that."""
    for i in range(SLICES):
        own = signed.where(F.col("slice") == i).join(reps, "uid", "left_semi")
        entries = own.select("uid", "n", F.explode("parts").alias("part"))
        since = scratch_mark()
        lists = written(entries.groupBy("part").agg(
            F.min("uid").alias("pivot"), F.max("uid").alias("_last")).where("pivot <> _last").select(
            F.col("part").alias("list"), "pivot"), "lists")
        yield entries.join(lists, F.col("part") == F.col("list")).select("list", "pivot", "uid", "n")
        drop_scratch(signed.sparkSession, since, since + 1)
        remove_folder(signed.sparkSession, f"{path}/slice={i}")


def set_links(sets: DataFrame, signed: DataFrame, path: str, docs: DataFrame, k: int,
              percent: int) -> DataFrame:
    """Links (a, b) between representatives of equal sets, enough to connect every component. Removes the
    signatures, which lie below `path`."""
    reps = written(sets.where("n > 0").groupBy("set_hi", "set_lo").agg(F.min("uid").alias("rep")),
                   "representatives")
    shared = written_parts(entries_of(signed, path, reps.select(F.col("rep").alias("uid"))), "entries")
    there = shared.select("uid").distinct().join(
        sets.select("uid", "doc_id", "k_hash", "bits", "n"), "uid")
    there = written(there, "candidates")
    found = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("d"),
                        F.xxhash64("text").alias("h"), "text")
    wanted = there.select("uid", F.coalesce("doc_id", F.lit(NO_ID)).alias("d"),
                          F.col("k_hash").alias("h"))
    # One text per uid; with the keys of the join named as well, texts are not shuffled again for that.
    texts = written_parts((
        some.join(own, ["d", "h"]).dropDuplicates(["uid", "d", "h"]).select("uid", "text")
        for some, own in zip(halves(wanted, "h"), halves(found, "h"), strict=True)), "texts")

    # First round: everything against the pivot of its list.
    sizes = there.select(F.col("uid").alias("pivot"), F.col("n").alias("p_n"))
    first = checked(shared.where("uid <> pivot").select("uid", "pivot", "n").distinct().join(
        sizes, "pivot").where(sizes_fit(F.col("n"), F.col("p_n"), percent)).select(
        F.col("uid").alias("a"), F.col("pivot").alias("b")), texts, k)
    ok = linked(F.col("overlap"), F.col("n_a"), F.col("n_b"), percent)
    links = first.where(ok).select("a", "b")
    roots = components(links)

    # Second round: what is not in the component of its list's pivot.
    root = roots.select(F.col("node").alias("uid"), F.col("root").alias("comp"))
    p_root = roots.select(F.col("node").alias("pivot"), F.col("root").alias("p_comp"))
    known = first.select(F.col("a").alias("uid"), F.col("b").alias("pivot"), "overlap")
    placed = written(
        shared.join(root, "uid", "left").join(p_root, "pivot", "left").withColumns({
            "comp": F.coalesce("comp", "uid"), "p_comp": F.coalesce("p_comp", "pivot")}), "placed")
    outside = written(placed.where("comp <> p_comp").select("list").distinct(), "open-lists")
    told = written(
        placed.join(outside, "list", "left_semi").join(known, ["uid", "pivot"], "left").join(
            there.select("uid", *[F.col("bits")[i].alias(f"bits{i}") for i in range(WORDS)]), "uid")
        .join(sizes, "pivot").withColumn(
            "overlap", F.when(F.col("uid") == F.col("pivot"), F.col("n")).otherwise(
                F.col("overlap"))), "open-entries")
    x, y = told.where("comp <> p_comp").alias("x"), told.alias("y")
    nx, ny, ox, oy = (F.col(c) for c in ("x.n", "y.n", "x.overlap", "y.overlap"))
    differ = sum((F.bit_count(F.col(f"x.bits{i}").bitwiseXOR(F.col(f"y.bits{i}")))
                  for i in range(WORDS)), F.lit(0))
    at_most = F.least(ox, oy) + F.least(nx - ox, ny - oy)
    pairs = written(x.join(y, (
        (F.col("x.list") == F.col("y.list")) & (F.col("x.comp") != F.col("y.comp"))
        & ((F.col("x.uid") < F.col("y.uid")) | (F.col("y.comp") == F.col("y.p_comp")))
        & (F.col("y.uid") != F.col("x.pivot")) & sizes_fit(nx, ny, percent)
        & ((100 + percent) * differ <= (100 - percent) * (nx + ny))
        & F.coalesce(linked(at_most, nx, ny, percent), F.lit(True)))).select(
        F.least("x.uid", "y.uid").alias("a"), F.greatest("x.uid", "y.uid").alias("b"),
        F.coalesce(linked(ox + oy - F.col("x.p_n"), nx, ny, percent), F.lit(False)).alias("sure"))
        .groupBy("a", "b").agg(F.max("sure").alias("sure")), "pairs")
    second = checked(pairs.where(~F.col("sure")), texts, k).where(ok)
    return links.unionByName(pairs.where("sure").select("a", "b")).unionByName(
        second.select("a", "b"))


def placed_sets(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The stored sets, and set_hi, set_lo, root (number of the component) of each different set."""
    sets, signed = sets_of(docs, k, percent)
    path, since = scratch_path(), scratch_mark()
    roots = components(set_links(sets, signed, path, docs, k, percent))
    reps = sets.where("n > 0").groupBy("set_hi", "set_lo").agg(F.min("uid").alias("node"))
    upto = scratch_mark()
    named = written(reps.join(roots, "node", "left").select(
        "set_hi", "set_lo", F.coalesce("root", "node").alias("root")), "named-sets")
    drop_scratch(docs.sparkSession, since, upto)  # texts and links: the components stand
    return sets, named


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: the least doc_id reachable by links of `percent` or more."""
    sets, named = placed_sets(docs, k, percent)
    narrow = sets.select("doc_id", "n", "set_hi", "set_lo")
    member = narrow.where("n > 0").join(named, ["set_hi", "set_lo"])
    least = written(member.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    return member.join(least, "root").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
        narrow.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"),
                                     F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, all columns, without those linked to one of lower doc_id.

    Of each component the row of least doc_id stays (of rows with equal ids, the one of least text
    hash; of rows alike, one). Rows without words all stay.
    """
    sets, named = placed_sets(docs, k, percent)
    first = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("d"), F.col("k_hash").alias("h"))
    kept = written(sets.where("n > 0").join(named, ["set_hi", "set_lo"]).groupBy("root").agg(
        F.min(first).alias("first")), "kept")
    d, h, w, k_d, k_h = (fresh(x, docs.columns) for x in ("_d", "_h", "_worded", "_k_d", "_k_h"))
    keys = docs.select("*", F.coalesce("doc_id", F.lit(NO_ID)).alias(d),
                       F.xxhash64("text").alias(h),
                       F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False)).alias(w))
    chosen = kept.select(F.col("first.d").alias(k_d), F.col("first.h").alias(k_h))
    staying = keys.where(w).join(chosen, (F.col(d) == F.col(k_d)) & (F.col(h) == F.col(k_h)),
                                 "left_semi").dropDuplicates([d, h])
    return staying.unionByName(keys.where(~F.col(w))).drop(d, h, w)
