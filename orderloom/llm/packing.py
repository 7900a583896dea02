"""Operator 10: packs token pieces into few sequences by linear grouping and best fit.

A length is at most the capacity, so the corpus enters the plan as a histogram of that many cells,
however many documents it has. The plan is made from the histogram alone:

1. Large lengths, in descending order, fall into groups of equal cardinality; within a group each
   counts as its largest.
2. The few rounded sizes are packed by configurations: the linear program over all ways to fill a
   sequence is solved by column generation, and whole multiples of its solution are taken.
3. Actual lengths take the places of the rounded ones, in order.
4. What is left, and all small lengths, go by decreasing length to the tightest sequence that fits.

A plan is a list of runs: `n` sequences alike, with the lengths each holds. Documents find their
place by their rank within their length. The rank comes from counts per (length, salt) and a row
number within them, so one very frequent length is ranked by many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import columns, per_slice, written
from orderloom.llm.tokens import encoder

PIECES = columns("doc_id bigint, piece int, start bigint, length bigint, ids binary")
#: Groups of large lengths; the linear program has as many rows.
GROUPS = (12, 24, 48)
#: Share of the program's sequences that is filled by it. What a group rounds up leaves gaps that only
#: small lengths fill, so the other large lengths go into sequences of their own choice by best fit.
#: The best of these plans is taken; a share of 0 is best fit alone.
SHARES = (1.0, 0.5, 0.25, 0.125, 0.0)
#: Row numbers are taken within (length, salt).
SALTS = 64


@dataclass
class Run:
    """`n` sequences, each holding `parts` (length, how many) in order."""

    n: int
    free: int
    parts: list[tuple[int, int]] = field(default_factory=list)

    def plus(self, length: int, times: int, n: int | None = None) -> "Run":
        return Run(self.n if n is None else n, self.free - length * times,
                   [*self.parts, (length, times)])


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, cap: int = 1024) -> DataFrame:
    """doc_id, piece, start, length, ids of each document's ids with the end id, cut at `cap`.

    A document of more ids is cut from its end, so its first piece may be shorter. Null text is
    empty; its document is one piece, the end id.
    """
    end = np.array([end_id], "<u4").tobytes()

    def task(part: dict[str, list]) -> dict[str, list]:
        rows = []
        for doc_id, ids in zip(part["doc_id"], encoder(tokenizer).ids(
                [t or "" for t in part["text"]]), strict=True):
            whole = ids + end
            n = len(whole) // 4
            first = n % cap or cap
            edges = [0, *range(min(first, n), n + 1, cap)]
            for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                rows.append((doc_id, i, a, b - a, whole[4 * a:4 * b]))
        return dict(zip(PIECES.names, map(list, zip(*rows, strict=True)), strict=True))

    return per_slice(docs.select("doc_id", "text"), task, PIECES)


def pack(pieces: DataFrame, cap: int = 1024, groups: tuple[int, ...] = GROUPS, salts: int = SALTS) -> DataFrame:
    """`pieces` (doc_id, piece, length and any others) with sequence_id and offset.

    `pieces` should be a stored table: it is read for the histogram and for the placing. Every
    length is from 1 to `cap`. Sequences are filled from offset 0 without gaps. Equal rows are
    separate pieces. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    counts = written(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")), "lengths")
    # At most `cap` rows.
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    if any(not 1 <= length <= cap for length in histogram):
        raise ValueError(f"piece lengths must be from 1 to {cap}")
    places, first = [], 0
    used: dict[int, int] = {}
    for run in plan(histogram, cap, groups):
        offset = 0
        for length, times in run.parts:
            rank = used.get(length, 0)
            used[length] = rank + run.n * times
            places.append((length, rank, used[length], times, first, offset))
            offset += length * times
        first += run.n
    places_df = spark.createDataFrame(
        places, "_length bigint, _from bigint, _to bigint, _times bigint, _first bigint, _at bigint")
    by_salt = Window.partitionBy("length").orderBy("_salt")
    # At most cap x salts rows.
    bases = counts.select(
        F.col("length").alias("_blength"), F.col("_salt").alias("_bsalt"),
        (F.sum("_n").over(by_salt.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias(
            "_base"))
    numbered = salted.withColumn("_row", F.row_number().over(
        Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")))
    ranked = numbered.join(F.broadcast(bases), (F.col("length") == F.col("_blength"))
                           & (F.col("_salt") == F.col("_bsalt"))).withColumn(
        "_rank", F.col("_base") + F.col("_row") - 1)
    # One row per part of a run: their number depends on cap and groups alone.
    placed = ranked.join(F.broadcast(places_df), (F.col("length") == F.col("_length"))
                         & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    within = F.col("_rank") - F.col("_from")
    return placed.select(
        *[F.col(c) for c in pieces.columns],
        (F.col("_first") + F.floor(within / F.col("_times"))).alias("sequence_id"),
        (F.col("_at") + F.col("length") * (within % F.col("_times"))).alias("offset"))


def plan(histogram: dict[int, int], cap: int, groups: tuple[int, ...] = GROUPS) -> list[Run]:
    """Runs that hold every length of the histogram as often as it occurs."""
    plans = [plan for n in groups for plan in plans_with(histogram, cap, n)]
    return min(plans, key=lambda runs: sum(run.n for run in runs))


def plans_with(histogram: dict[int, int], cap: int, groups: int) -> list[list[Run]]:
    """One plan for each of the shares, on one solution of the configuration program."""
    full = [Run(n, 0, [(cap, 1)]) for length, n in histogram.items() if length == cap and n]
    rest = sorted(((length, n) for length, n in histogram.items() if length < cap and n),
                  reverse=True)
    large = [x for x in rest if x[0] > cap // 8]
    small = [x for x in rest if x[0] <= cap // 8]
    return [full + best_fit(runs, sorted(left + small, reverse=True), cap)
            for runs, left in grouped(large, cap, groups)]


def grouped(large: list[tuple[int, int]], cap: int, groups: int) -> list[tuple[list[Run], list]]:
    """For each share runs from the configuration program, and the (length, count) they leave."""
    total = sum(n for _, n in large)
    if not total:
        return [([], [])]
    quota, queues = -(-total // groups), [[]]
    room = quota
    for length, n in large:
        while n:
            if not room:
                queues.append([])
                room = quota
            take = min(n, room)
            queues[-1].append([length, take])
            n, room = n - take, room - take
    merged = [queues[0]]
    for queue in queues[1:]:  # groups of one rounded size are one
        if queue[0][0] == merged[-1][0][0]:
            merged[-1] += queue
        else:
            merged.append(queue)
    queues = merged
    sizes = [q[0][0] for q in queues]
    counts = [sum(n for _, n in q) for q in queues]
    solved = configurations(sizes, counts, cap)
    return [_substituted([[list(x) for x in q] for q in queues],
                         [(config, int(times * share)) for config, times in solved], cap)
            for share in SHARES]


def _substituted(queues: list[list[list[int]]], configs: list[tuple[list[int], int]],
                 cap: int) -> tuple[list[Run], list]:
    """Actual lengths in the places of the rounded ones, and what is left of them."""
    runs = []
    for config, times in configs:
        slots = [g for g, a in enumerate(config) for _ in range(a)]
        while times:
            heads = {g: 0 for g in slots}
            # As many sequences as every slot's group can serve from its next length.
            for g in heads:
                heads[g] = queues[g][0][1] // config[g]
            n = min(times, min(heads.values()))
            if n:
                parts = [(queues[g][0][0], config[g]) for g in heads]
                for g in heads:
                    _take(queues[g], n * config[g])
            else:  # a length runs out within one sequence
                n, parts = 1, []
                for g in heads:
                    for _ in range(config[g]):
                        parts.append((queues[g][0][0], 1))
                        _take(queues[g], 1)
            runs.append(Run(n, cap - sum(length * k for length, k in parts), parts))
            times -= n
    return runs, [(length, n) for q in queues for length, n in q]


def _take(queue: list[list[int]], n: int) -> None:
    queue[0][1] -= n
    if not queue[0][1]:
        queue.pop(0)


def configurations(sizes: list[int], counts: list[int], cap: int) -> list[tuple[list[int], int]]:
    """(how many of each size, whole number of sequences): the linear optimum, rounded down."""
    k = len(sizes)
    columns = [[cap // s if i == j else 0 for j in range(k)] for i, s in enumerate(sizes)]
    need = np.array(counts, float)
    basis = np.array(columns, float).T
    for _ in range(40 * k):
        inverse = np.linalg.inv(basis)
        amounts = inverse @ need
        column, worth = best_column(sizes, inverse.sum(axis=0), cap)
        if worth <= 1 + 1e-9:
            break
        direction = inverse @ np.array(column, float)
        ratios = np.where(direction > 1e-9, np.maximum(amounts, 0) / np.maximum(direction, 1e-9),
                          np.inf)
        out = int(np.argmin(ratios))
        if not np.isfinite(ratios[out]):
            break
        basis[:, out], columns[out] = column, column
    amounts = np.linalg.solve(basis, need)
    chosen, spare = [], list(counts)
    for column, amount in zip(columns, amounts, strict=True):
        times = min([int(max(amount, 0) + 1e-6)]
                    + [spare[i] // a for i, a in enumerate(column) if a])
        if times:
            spare = [s - times * a for s, a in zip(spare, column, strict=True)]
            chosen.append((list(column), times))
    return chosen


def best_column(sizes: list[int], prices: np.ndarray, cap: int) -> tuple[list[int], float]:
    """The most valuable filling of one sequence, by dynamic programming over its length."""
    best, pick = np.zeros(cap + 1), np.full(cap + 1, -1)
    order = [i for i in range(len(sizes)) if prices[i] > 1e-12]
    size, price = np.array([sizes[i] for i in order], int), prices[order]
    for room in range(1, cap + 1):
        best[room] = best[room - 1]
        fits = size <= room
        if fits.any():
            worth = np.where(fits, price + best[np.maximum(room - size, 0)], -1.0)
            top = int(np.argmax(worth))
            if worth[top] > best[room] + 1e-12:
                best[room], pick[room] = worth[top], top
    column, room = [0] * len(sizes), cap
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            column[order[pick[room]]] += 1
            room -= int(size[pick[room]])
    return column, float(best[cap])


def best_fit(runs: list[Run], lengths: list[tuple[int, int]], cap: int) -> list[Run]:
    """Adds (length, count), longest first, each to the tightest sequences that have room."""
    by_free: dict[int, list[Run]] = {}
    for run in runs:
        by_free.setdefault(run.free, []).append(run)
    for length, n in lengths:
        free = length
        while n:
            while free < cap and not by_free.get(free):
                free += 1
            times = free // length
            run = by_free[free].pop() if free < cap else Run(n, cap)
            if n < times:
                filled, rest = run.plus(length, n, 1), run.n - 1
                n = 0
            else:
                m = min(run.n, n // times)
                filled, rest = run.plus(length, times, m), run.n - m
                n -= m * times
            by_free.setdefault(filled.free, []).append(filled)
            if free < cap and rest:
                by_free[free].append(Run(rest, free, run.parts))
            # What remains may fit into the sequences just filled only if it is as small as their
            # room, and those have less room than `length`: go on from the same place.
    return [run for free in sorted(by_free) for run in by_free[free] if run.n]


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, cap: int = 1024,
                   groups: tuple[int, ...] = GROUPS) -> DataFrame:
    """Pieces of all documents with their ids, sequence_id and offset.

    Null or empty text: one piece, the end id. Repeated rows and equal doc_ids are packed each.
    Columns other than doc_id and text are not looked at.
    """
    return pack(written(token_pieces(docs, tokenizer, end_id, cap), "pieces"), cap, groups)


def packed_digest(docs: DataFrame, tokenizer: str, end_id: int = 2, cap: int = 1024) -> DataFrame:
    """The packing with a checksum in place of the ids, so the ids stay where they were written."""
    pieces = written(token_pieces(docs, tokenizer, end_id, cap), "pieces")
    return pack(pieces.select("doc_id", "piece", "start", "length",
                              F.crc32("ids").alias("ids_crc32")), cap)
