"""Passages of whole lines that repeat, found by winnowing over line hashes.

Lines are deleted whole or not at all: a passage that starts or ends inside a line, whose other words
differ, is not found here. `passages.py`, which the queries use, finds it.

A document is the sequence of its lines that have words. A *run* from a line is the shortest stretch
of lines from it with at least `min_words` words; a *gram* is the same with half as many. In each
run the least of the hashes of the grams inside is its fingerprint. Equal stretches of `min_words`
words hold an equal run, so they share its fingerprint wherever they stand: that is the guarantee.

1. Fingerprints that occur once in the corpus are dropped with their runs (a count, combined before
   the shuffle). What is left is a small part of the corpus.
2. Positions of equal runs are joined with the first of them (by document, then place), never pair
   by pair. The first run carries the hashes of the few lines around it.
3. In each document the matches are extended both ways, line by line, against the lines around
   the first occurrence. Matched lines are deleted; the first occurrence stays.

An extension of `min_words` words is a run of its own and matched as such, so extending stops there.
The text itself is shuffled once, by document, to meet its matches.

Defined cases: null text stays null, and has no lines. Documents come in the order of doc_id, nulls
last, and then of a hash of the text; rows alike in both are one document, and each gets its edit.
A run that overlaps its first occurrence in the same document is no repetition of it. Lines are
compared by their words, whatever white space is between. A document that loses all its words has
an empty text. Other columns pass through `edited` whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import (arrow_schema, by_position, columns, fresh, per_slice, ship, slices,
                                  written)

WORD = re.compile("[^\x20\x09-\x0D]+")
MIN_WORDS = 50
LAST_ID = (1 << 63) - 1

RUNS = columns(
    "k_id bigint, k_hash bigint, first ints, last ints, fingerprint bigints, run_hi bigints,"
    "run_lo bigints, before bigint_lists, after bigint_lists")
EDIT = columns("n_lines bigint, n_removed_lines bigint, n_removed_words bigint, removed string")
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def lines_of(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, words and hash of each line that has a word."""
    numbers, sizes, hashes = [], [], []
    for number, line in enumerate((text or "").split("\n")):
        words = WORD.findall(line)
        if words:
            numbers.append(number)
            sizes.append(len(words))
            hashes.append(xxhash.xxh3_64_intdigest(" ".join(words)))
    return np.array(numbers, "i8"), np.array(sizes, "i8"), np.array(hashes, "u8")


def stretches(total: np.ndarray, words: int) -> np.ndarray:
    """For each line the last line of the shortest stretch with so many words; beyond the end: n."""
    return np.searchsorted(total[1:], total[:-1] + words)


def stretch_hash(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, base: np.uint64
                 ) -> np.ndarray:
    """Polynomial hash of the lines first..last of each stretch, from running ones."""
    up = np.cumprod(np.full(len(hashes) + 1, base, "u8"))
    down = np.cumprod(np.full(len(hashes) + 1, np.uint64(pow(int(base), -1, 1 << 64)), "u8"))
    scaled = np.concatenate([np.zeros(1, "u8"), np.cumsum(hashes * up[:-1])])
    found = (scaled[last + 1] - scaled[first]) * down[first]
    found = (found ^ (found >> np.uint64(31))) * _BASES[0] + (last - first).astype("u8")
    return found ^ (found >> np.uint64(29))


def runs_of(text: str | None, min_words: int) -> dict[str, list] | None:
    """The runs of a text with fingerprints, hashes and the lines around; None without a run."""
    _, sizes, hashes = lines_of(text)
    n = len(sizes)
    total = np.concatenate([[0], np.cumsum(sizes)])
    if total[-1] < min_words:
        return None
    last = stretches(total, min_words)
    first = np.flatnonzero(last < n)
    last = last[first]
    gram_last = stretches(total, -(-min_words // 2))
    grams = np.flatnonzero(gram_last < n)
    gram_last = gram_last[grams]
    gram = stretch_hash(hashes, grams, gram_last, _BASES[1])
    # Starts and ends of grams ascend, so the grams inside a run are neighbours.
    upto = np.searchsorted(gram_last, last, side="right")
    least = [int(gram[a:b].min()) for a, b in zip(first, upto, strict=True)]
    signed = hashes.view("i8").tolist()
    before = [signed[max(0, np.searchsorted(total, total[a] - min_words, side="right") - 1):a][::-1]
              for a in first]
    after = [signed[b + 1:np.searchsorted(total[1:], total[b + 1] + min_words) + 1] for b in last]
    return {"first": first.tolist(), "last": last.tolist(),
            "fingerprint": np.array(least, "u8").view("i8").tolist(),
            "run_hi": stretch_hash(hashes, first, last, _BASES[0]).view("i8").tolist(),
            "run_lo": stretch_hash(hashes, first, last, _BASES[1]).view("i8").tolist(),
            "before": before, "after": after}


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("k_id"),
                       F.xxhash64("text").alias("k_hash"), "text").where(F.col("text").isNotNull())


def later_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """k_id, k_hash, matches: the runs of a document that occurred before, with what is around the
    first occurrence (null limits where that is in another document).
    """

    def task(part: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {name: [] for name in RUNS.names}
        for k_id, k_hash, text in zip(part["k_id"], part["k_hash"], part["text"], strict=True):
            made = runs_of(text, min_words)
            if made:
                out["k_id"].append(k_id)
                out["k_hash"].append(k_hash)
                for name, value in made.items():
                    out[name].append(value)
        return out

    stored = written(per_slice(keyed(docs), task, RUNS), "runs")
    prints = stored.select("k_id", "k_hash", F.explode(F.array_distinct(F.arrays_zip(
        "fingerprint", "first"))).alias("x")).select("k_id", "k_hash", F.col("x.fingerprint").alias(
            "fingerprint"))
    # Written first, so that both sides of each join below are plain tables and a fingerprint or run
    # that a third of the documents share is split over tasks.
    often = written(prints.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("fingerprint").alias("repeated")), "fingerprints")
    every = stored.select("k_id", "k_hash", F.inline(F.arrays_zip(
        "first", "last", "fingerprint", "run_hi", "run_lo", "before", "after")))
    runs = written(every.join(often, F.col("fingerprint") == F.col("repeated"), "left_semi").drop(
        "fingerprint"), "repeated-runs")
    owners = written(
        runs.groupBy("run_hi", "run_lo").agg(
            F.count("*").alias("n"),
            F.min(F.struct("k_id", "k_hash", "first", "last", "before", "after")).alias("o"))
        .where("n > 1").select(F.col("run_hi").alias("o_hi"), F.col("run_lo").alias("o_lo"), "o"),
        "owners")
    met = runs.drop("before", "after").join(
        owners, (F.col("run_hi") == F.col("o_hi")) & (F.col("run_lo") == F.col("o_lo")))
    same = (F.col("o.k_id") == F.col("k_id")) & (F.col("o.k_hash") == F.col("k_hash"))
    return met.where(~same | (F.col("first") > F.col("o.last"))).groupBy("k_id", "k_hash").agg(
        F.collect_set(F.struct(
            "first", "last", F.when(same, F.col("o.last")).alias("limit"),
            F.col("o.before").alias("before"), F.col("o.after").alias("after"))).alias("matches"))


def removed_lines(hashes: list[int], matches: list[dict]) -> set[int]:
    """Numbers, among lines with words, of matched lines and of the extensions both ways."""
    gone: set[int] = set()
    for m in matches:
        a, b = m["first"], m["last"]
        gone.update(range(a, b + 1))
        lowest = -1 if m["limit"] is None else m["limit"]
        for step, h in enumerate(m["before"], 1):
            if a - step <= lowest or hashes[a - step] != h:
                break
            gone.add(a - step)
        for step, h in enumerate(m["after"], 1):
            if b + step >= len(hashes) or hashes[b + step] != h:
                break
            gone.add(b + step)
    return gone


def edit(text: str | None, matches: list[dict] | None) -> tuple:
    """The text without its later runs, and the values of EDIT."""
    if text is None:
        return None, 0, 0, 0, ""
    numbers, sizes, hashes = lines_of(text)
    if not matches:
        return text, len(numbers), 0, 0, ""
    gone = sorted(removed_lines(hashes.view("i8").tolist(), matches))
    lines = set(numbers[gone].tolist())
    kept = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in lines)
    runs: list[list[int]] = []
    for i in numbers[gone].tolist():
        if runs and runs[-1][1] == i - 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    return (kept, len(numbers), len(gone), int(sizes[gone].sum()),
            ",".join(f"{a}-{b}" for a, b in runs))


def edited(docs: DataFrame, min_words: int = MIN_WORDS, result: str = "line_dedup") -> DataFrame:
    """All columns of `docs` with the text edited, and a struct named `result` of EDIT.

    `removed` lists runs of line numbers (from 0, both ends included) of the text as it was.
    """
    return applied(docs, later_runs(docs, min_words), edit, result, EDIT)


def applied(docs: DataFrame, matches: DataFrame, edit: Callable[[str | None, list[dict] | None], tuple],
            result: str, kind: T.StructType) -> DataFrame:
    """All columns of `docs`; text and the struct `result` as `edit` makes them from text and matches."""
    names, text_at = docs.columns, f"c{docs.columns.index('text')}"
    matches = matches.select(F.col("k_id").alias("m_id"), F.col("k_hash").alias("m_hash"),
                             F.col("matches").alias("found"))
    plain = by_position(docs)  # names of any form
    joined = plain.select("*", F.coalesce(F.col(f"c{names.index('doc_id')}"), F.lit(LAST_ID)).alias("k_id"),
                          F.xxhash64(text_at).alias("k_hash")).join(
        matches, (F.col("k_id") == F.col("m_id")) & (F.col("k_hash") == F.col("m_hash")), "left")
    schema = T.StructType([*plain.schema.fields, T.StructField("result", kind)])
    fields = arrow_schema(schema)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, notes = [], []
            for part in slices([batch.select([text_at, "found"])]):
                for text, own in zip(part[text_at], part["found"], strict=True):
                    new, *note = edit(text, own)
                    texts.append(new)
                    notes.append(dict(zip(kind.names, note, strict=True)))
            made = [pa.array(texts, f.type) if f.name == text_at else pa.array(notes, f.type)
                    if f.name == "result" else batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays(made, schema=fields)

    return joined.select(*plain.columns, "found").mapInArrow(run, schema).toDF(*names, result)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without later runs, and the columns of EDIT."""
    return edited(docs.select("doc_id", "text"), min_words).select("doc_id", "text", "line_dedup.*")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The columns of `docs`, texts edited; documents of which no word is left are gone."""
    result = fresh("line_dedup", docs.columns)
    made = edited(docs, min_words, result)
    emptied = (F.col(f"{result}.n_lines") > 0) & (
        F.col(f"{result}.n_lines") == F.col(f"{result}.n_removed_lines"))
    return made.where(~emptied).drop(result)
