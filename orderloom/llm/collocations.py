"""Operator 11: phrase collocation mining by SON partitioning.

First pass: texts of one language are dealt into shards of about equal size, whose number grows with
the text. Each shard is mined completely, level by level, at the support divided by the number of
shards: a phrase with the global support must have that much in at least one of them. The union of the
locally frequent phrases, less those that cannot reach the support even if they fell just short of it
in every other shard, goes into a bit table of their hashes. Second pass: all occurrences of the
phrases in that table are counted over all texts, exactly and by the words themselves; the counts
of a shard are combined before the shuffle. A phrase that finds its bits set by others
costs a row more and changes nothing: what lacks the support falls out after counting.

A shard holds up to `LARGE_SHARD` bytes, so with support s the local support of a language falls to one
beyond s such shards: its first pass then sends every phrase of a shard once, with its count.

Defined cases: null text is empty; a null language is `und`. Words keep their case but for A-Z. Rows
alike count each. A phrase of one word is counted as a part of others but is no candidate. An empty
table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import arrow_schema, columns, per_slice, ship, written
from orderloom.llm.shingles import mixed

#: One byte per byte: A-Z to lower case, all that ends a piece to a full stop, a tab to a space.
_FOLD = bytes(ord(".") if chr(c) in ".,;:!?\n\v\f\r" else c + 32 if 65 <= c <= 90 else c
              for c in range(256))
#: Bytes of a shard: a language has SHARDS of them, fewer if they came below the smaller size, more if
#: they came above the larger.
SMALL_SHARD, LARGE_SHARD, SHARDS = 2_000_000, 96_000_000, 16
#: Phrases that the second pass spells out at once, and positions of a chunk of a level.
ROWS_AT_ONCE, CHUNK = 100_000, 2_000_000
#: Bits of the table for each locally frequent phrase at least, of which PROBES are set, and bits of the
#: whole table at most.
BITS_EACH, PROBES, MOST_BITS = 16, 4, 1 << 29
PART_BITS = 1 << 22
_A = np.uint64(0x9E3779B97F4A7C15)
LOCAL = columns("lang string, shards bigint, hash bigint, n bigint")
COUNTS = columns("lang string, phrase string, n bigint")
SCORED = columns("lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")


class Words:
    """Words as numbers from 1 on, in text order, with 0 between pieces."""

    def __init__(self, lang: str):
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[b"."] = 0
        self.seed = xxhash.xxh3_64_intdigest(lang)
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        found = (text.translate(_FOLD).replace(b".", b" . ") + b" . ").split()
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, found), "i4", len(found)))
        self.size += len(found)

    def levels(self, longest: int, keep: Callable[[np.ndarray, np.ndarray], np.ndarray]
               ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per length: (length, count, hash and one place of each phrase kept). `keep` gets counts and
        hashes of the phrases whose two shorter parts were kept, and says which stay."""
        ids = np.concatenate([np.zeros(0, "i4"), *self.parts])
        self.ids, self.parts = ids, []
        names = list(self.numbers)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, self.seed) for w in names), "u8", len(names))
        count = np.bincount(ids, minlength=len(names))
        self.total = int(count.sum() - count[0])
        place = np.zeros(len(names), "i8")
        place[ids[::-1]] = np.arange(len(ids))[::-1]
        good = keep(count, hashes)
        good[0] = False
        number = np.where(good, np.cumsum(good) - 1, -1).astype("i4")
        at, gram = number[ids], hashes[good]  # at: the kept phrase that begins here, or -1
        yield 1, count[good], gram, place[good]
        for length in range(2, longest + 1):
            begins = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0)).astype("i4")
            following = np.full(len(ids), -1, "i4")
            made: list[tuple] = []
            base = 0
            chunks = len(begins) // CHUNK + 1
            chunk = np.zeros(len(begins), "u1")  # equal phrases fall into one chunk
            for first in range(0, len(begins) if chunks > 1 else 0, CHUNK):
                some = begins[first:first + CHUNK]
                chunk[first:first + CHUNK] = mixed(
                    gram[at[some]] ^ hashes[ids[some + length - 1]]) % np.uint64(chunks)
            for c in range(chunks):
                own = begins[chunk == c]
                key = at[own].astype("i8") * len(names) + ids[own + length - 1]
                code, distinct = pd.factorize(key)
                n = np.bincount(code, minlength=len(distinct))
                h = mixed(gram[distinct // len(names)] * _A + hashes[distinct % len(names)])
                good = keep(n, h)
                first = np.empty(len(distinct), "i8")
                first[code[::-1]] = own[::-1]
                number = np.where(good, np.cumsum(good) - 1 + base, -1).astype("i4")
                following[own] = number[code]
                base += int(good.sum())
                made.append((n[good], h[good], first[good]))
            n, h, first = (np.concatenate(x) for x in zip(*made, strict=True))
            at, gram = following, h
            yield length, n, h, first

    def spelled(self, length: int, places: np.ndarray) -> list[str]:
        names = list(self.numbers)
        own = [list(map(names.__getitem__, self.ids[places + i].tolist())) for i in range(length)]
        return [b" ".join(x).decode() for x in zip(*own, strict=True)]


def texts_of(docs: DataFrame) -> DataFrame:
    """lang and the text in UTF-8."""
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def shards_of(texts: DataFrame) -> DataFrame:
    """lang, the number of its shards and of those of the languages before it, as a stored table."""
    size = F.sum(F.octet_length("text"))
    few = F.least(F.lit(SHARDS), F.ceil(size / SMALL_SHARD))
    sizes = texts.groupBy("lang").agg(
        F.greatest(F.lit(1), few, F.ceil(size / LARGE_SHARD)).cast("bigint").alias("shards"))
    upto = F.sum("shards").over(Window.orderBy("lang"))  # one row per language
    return written(sizes.withColumn("first", upto - F.col("shards")), "shards")


def per_shard(texts: DataFrame, shards: DataFrame, schema: T.StructType,
              task: Callable[[Words, str, int], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Applies `task` to the words of each shard, its language and that language's number of shards.

    Shards are numbered through and each is a partition of its own: by hash, several would meet in one.
    """
    ship(texts.sparkSession)
    total = shards.agg(F.sum("shards")).first()[0] or 1
    dealt = texts.withColumn("row", F.monotonically_increasing_id()).join(shards, "lang").select(
        "lang", "shards", (F.col("first") + F.pmod(F.xxhash64("row"), "shards")).alias("shard"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[Words, str, int]] = {}
        for batch in batches:
            for lang, shards, shard, text in zip(*(batch.column(c).to_pylist() for c in (
                    "lang", "shards", "shard")), batch.column("text"), strict=True):
                if shard not in held:
                    held[shard] = Words(lang), lang, shards
                held[shard][0].add(text.as_py())
        while held:
            yield from task(*held.popitem()[1])

    return dealt.repartitionById(int(total), F.col("shard").cast("int")).mapInArrow(run, schema)


def locally_frequent(texts: DataFrame, shards: DataFrame, support: int, longest: int) -> DataFrame:
    """Hashes of the phrases that a shard finds frequent and that may be so altogether, stored."""
    schema = arrow_schema(LOCAL)

    def mined(words: Words, lang: str, shards: int) -> Iterator[pa.RecordBatch]:
        least = -(-support // shards)
        for _, n, h, _ in words.levels(longest, lambda n, h: n >= least):
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(n), "string"), pa.array(np.full(len(n), shards)),
                pa.array(h.view("i8")), pa.array(n, "int64")], schema=schema)

    found = per_shard(texts, shards, LOCAL, mined)
    short = F.ceil(F.lit(support) / F.col("shards")) - 1  # what a shard that is silent may hold
    return written(found.groupBy("lang", "hash", "shards").agg(
        F.sum("n").alias("n"), F.count("*").alias("told")).where(
        F.col("n") + (F.col("shards") - F.col("told")) * short >= support).select("hash"),
        "local-phrases")


def bit_table(hashes: DataFrame) -> np.ndarray:
    """PROBES bits set for each hash; parts of the table are made by the tasks."""
    wanted = BITS_EACH * hashes.count()
    bits = min(MOST_BITS, max(PART_BITS, 1 << wanted.bit_length()))

    def part(table: pa.Table) -> pa.Table:
        made = np.zeros(PART_BITS, "u1")
        made[table.column("cell").to_numpy() & (PART_BITS - 1)] = 1
        return pa.table({"part": [table.column("part")[0].as_py()],
                         "bits": [np.packbits(made, bitorder="little").tobytes()]})

    step = F.shiftrightunsigned("hash", 32).bitwiseOR(F.lit(1))  # as in `probes`
    cells = F.explode(F.array(*[(F.col("hash").bitwiseAND(F.lit(MOST_BITS - 1)) + i * step).bitwiseAND(
        F.lit(bits - 1)) for i in range(PROBES)])).alias("cell")
    parts = hashes.select(cells).distinct().withColumn(
        "part", F.shiftright("cell", PART_BITS.bit_length() - 1)).groupBy("part").applyInArrow(
        part, columns("part bigint, bits binary"))
    whole = np.zeros(bits // 8, "u1")
    for row in parts.collect():  # at most MOST_BITS altogether
        begin = row.part * PART_BITS // 8
        whole[begin:begin + PART_BITS // 8] = np.frombuffer(row.bits, "u1")
    return whole


def probes(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The cells of each hash in a table of so many bits, one array after the other."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield (((hashes & np.uint64(MOST_BITS - 1)) + np.uint64(i) * step) & np.uint64(bits - 1)).astype("i8")


def counted(texts: DataFrame, shards: DataFrame, table: np.ndarray, longest: int) -> DataFrame:
    """lang, phrase, n: all occurrences of the phrases in the table; phrase '' for all words. Stored.

    Counted per shard, as a phrase then makes at most one row in each: a frequent phrase stands in nearly
    every share of the text, so the rows to shuffle are fewest when the shares are large.
    """
    sent = texts.sparkSession.sparkContext.broadcast(table)
    schema = arrow_schema(COUNTS)

    def named(words: Words, lang: str, _: int) -> Iterator[pa.RecordBatch]:
        bits = sent.value

        def known(_: np.ndarray, h: np.ndarray) -> np.ndarray:
            found = np.ones(len(h), "u1")
            for at in probes(h, len(bits) * 8):
                found &= bits[at >> 3] >> (at & 7).astype("u1") & 1
            return found.astype(bool)

        for length, n, _, places in words.levels(longest, known):
            for i in range(0, len(n), ROWS_AT_ONCE):
                part = n[i:i + ROWS_AT_ONCE]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), "string"),
                    pa.array(words.spelled(length, places[i:i + ROWS_AT_ONCE]), "string"),
                    pa.array(part, "int64")], schema=schema)
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([""]), pa.array([words.total])],
                                         schema=schema)

    return written(per_shard(texts, shards, COUNTS, named).groupBy("lang", "phrase").agg(
        F.sum("n").alias("n")), "counts")


def cuts(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, n and its cuts (k, l, r) of every candidate."""
    words = frequent.withColumn("w", F.split("phrase", " ", -1)).where(F.size("w") > 1)
    each = words.select("lang", "phrase", F.col("n").alias("a"), "w", F.explode(F.sequence(
        F.lit(1), F.size("w") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.concat_ws(" ", F.slice("w", F.lit(1), F.col("k"))).alias("first"),
        F.concat_ws(" ", F.expr("slice(w, k + 1, size(w) - k)")).alias("rest"))
    l_of = frequent.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    r_of = frequent.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    return each.join(l_of, ["lang", "first"]).join(r_of, ["lang", "rest"]).groupBy(
        "lang", "phrase").agg(F.first("a").alias("a"), F.sort_array(
            F.collect_list(F.array(F.col("k").cast("bigint"), "l", "r"))).alias("cuts")).join(
        totals, "lang")


def maximal(frequent: DataFrame, percent: int) -> DataFrame:
    """Candidates without those inside a longer one that is `percent` as frequent, or more.

    A phrase is no more frequent than any part of it, so one word longer is as far as one must look.
    """
    words = frequent.withColumn("w", F.split("phrase", " ", -1)).where(F.size("w") > 1)
    inside = words.where(F.size("w") > 2).select("lang", F.col("n").alias("more"), F.explode(F.expr(
        "transform(array(1, 2), i -> concat_ws(' ', slice(w, i, size(w) - 1)))")).alias("phrase"))
    most = inside.groupBy("lang", "phrase").agg(F.max("more").alias("more"))
    return words.join(most, ["lang", "phrase"], "left").where(
        F.col("more").isNull() | (100 * F.col("more") < percent * F.col("n"))).select("lang", "phrase")


def scored(candidates: DataFrame) -> DataFrame:
    """The cut of the least score of each candidate; integers of any size."""

    def task(part: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {name: [] for name in SCORED.names}
        for lang, phrase, a, own, n in zip(*(part[c] for c in ("lang", "phrase", "a", "cuts", "n")),
                                           strict=True):
            score, _, l, r = min((1000 * a * n // (l * r), k, l, r) for k, l, r in own)
            for name, value in zip(SCORED.names, (lang, phrase, a, l, r, n, score), strict=True):
                out[name].append(value)
        return out

    return per_slice(candidates.select("lang", "phrase", "a", "cuts", "n"), task, SCORED)


def collocations(docs: DataFrame, support: int = 100, longest: int = 5, top: int = 2000,
                 percent: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of each language."""
    texts = texts_of(docs)
    shards = shards_of(texts)
    table = bit_table(locally_frequent(texts, shards, support, longest))
    counts = counted(texts, shards, table, longest)
    frequent = written(counts.where((F.col("n") >= support) & (F.col("phrase") != "")), "frequent")
    totals = counts.where("phrase = ''").select("lang", "n")
    made = written(scored(cuts(frequent, totals).join(
        maximal(frequent, percent), ["lang", "phrase"], "left_semi")), "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Twice, so that a language with most phrases is not ranked by one task alone.
    some = made.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(
        F.col("rank") <= top).drop("part", "rank")
    return some.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
