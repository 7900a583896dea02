"""Operator 3: passages of words that repeat, found by winnowing over word hashes.

A *window* is `min_words` words in a row, whatever lines they stand in. Every word of a window that
stood before, in an earlier document or earlier in the same one without overlap, is cut: so of every
passage of at least `min_words` words that equals an earlier one word for word, nothing stays but its
first occurrence, wherever in a line it starts or ends.

1. The *print* of a window is the least of the hashes of its grams of a quarter as many words, so
   equal windows have equal prints. Neighbouring windows with one print are a *segment*, a row each.
   Segments of prints that occur once in the corpus are dropped (a count, combined before the shuffle).
2. Segments alike in all their words are settled at once, by the first of them (by document, then
   place), never pair by pair.
3. Where segments of one print differ, or overlap, the first of each kind is taken apart into windows,
   which are settled in the same way. For this the text of the documents concerned is read again.
4. The text is shuffled by document to meet the windows that go.

The first occurrence is of the single window, not of a passage: a passage put together from several
earlier documents goes whole, and no extension of matches is needed.

Defined cases: null text stays null, and has no words. Documents come in the order of doc_id, nulls
last, and then of a hash of the text; rows alike in both are one document, and each gets its edit.
Words are compared, whatever white space is between. A line that loses all its words goes; one that
loses a part keeps the rest, with the white space before each kept word but at its end. A document
that loses all its words has an empty text. Other columns pass through `edited` whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import columns, drop_scratch, fresh, per_slice, scratch_mark, written
from orderloom.llm.linededup import MIN_WORDS, applied, keyed

SEGMENTS = columns("k_id bigint, k_hash bigint, start int, n int, print bigint, whole bigint")
WINDOWS = columns("k_id bigint, k_hash bigint, start int, print bigint, whole bigint")
EDIT = columns("n_lines bigint, n_removed_lines bigint, n_cut_lines bigint, n_removed_words bigint,"
               "removed string, cut string")
#: A line that holds a word, from its first word on.
WORDED_LINE = re.compile("[^\x20\x09-\x0D][^\n]*")
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES, _PLACES = mixed(np.arange(1, 257, dtype="u8") * _A), mixed(np.arange(1, 4097, dtype="u8") * _B)


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring stretches from theirs."""
    return mixed(a * _A + b)


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and the place of each text's first word among them (and the end)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), "u1")
    in_word = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(in_word, prepend=False))
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    begin = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    firsts = np.searchsorted(starts, begin)
    if not len(starts):
        return np.zeros(0, "u8"), firsts
    at = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(at, sizes)
    longest = int(sizes.max())
    places = _PLACES if longest <= len(_PLACES) else mixed(np.arange(1, longest + 1, dtype="u8") * _B)
    return mixed(np.add.reduceat(_BYTES[data[in_word]] * places[place], at)), firsts


def stretches(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k neighbours, from those of powers of two."""
    size, done, out = 1, 0, None
    while True:
        if k & size:
            part = h[done:]
            out = part if out is None else joined(out[:len(part)], part)
            done += size
        if done == k:
            return out
        h = joined(h[:-size], h[size:])
        size *= 2


def least(h: np.ndarray, k: int) -> np.ndarray:
    """The least of every k neighbours."""
    size = 1
    while size < k:
        step = min(size, k - size)
        h = np.minimum(h[:-step], h[step:])
        size += step
    return h


def windows_of(texts: list[str], min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place of each text's first word; places, prints and hashes of all windows that lie in one text."""
    words, firsts = words_of(texts)
    if len(words) < min_words:
        return firsts, np.zeros(0, "i8"), np.zeros(0, "u8"), np.zeros(0, "u8")
    gram = -(-min_words // 4)
    whole = stretches(words, min_words)
    prints = least(stretches(words, gram), min_words - gram + 1)
    text = np.repeat(np.arange(len(texts)), np.diff(firsts))
    inside = np.flatnonzero(text[:len(whole)] == text[min_words - 1:])
    return firsts, inside, prints[inside], whole[inside]


def segments(part: dict[str, list], min_words: int) -> dict[str, list]:
    firsts, at, prints, whole = windows_of(part["text"], min_words)
    if not len(at):
        return {name: [] for name in SEGMENTS.names}
    longest = min_words - -(-min_words // 4) + 1  # so a segment's first and last window meet
    new = np.concatenate([[True], (np.diff(at) != 1) | (prints[1:] != prints[:-1])])
    run = np.flatnonzero(new)
    within = np.arange(len(at)) - run[np.cumsum(new) - 1]
    first = np.flatnonzero(within % longest == 0)
    n = np.diff(np.append(first, len(at)))
    text = np.searchsorted(firsts, at[first], side="right") - 1
    return {"k_id": np.array(part["k_id"], "i8")[text].tolist(),
            "k_hash": np.array(part["k_hash"], "i8")[text],
            "start": (at[first] - firsts[text]).astype("i4"), "n": n.astype("i4"),
            "print": prints[first].view("i8"),
            "whole": joined(joined(whole[first], whole[first + n - 1]), n.astype("u8")).view("i8")}


def windows(part: dict[str, list], min_words: int) -> dict[str, list]:
    """The windows of the segments named in `open`."""
    firsts, at, prints, whole = windows_of(part["text"], min_words)
    text = np.repeat(np.arange(len(part["open"])), [len(x) for x in part["open"]])
    start = np.array([s["start"] for x in part["open"] for s in x], "i8")
    n = np.array([s["n"] for x in part["open"] for s in x], "i8")
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    text, start = np.repeat(text, n), np.repeat(start, n) + within
    place = np.searchsorted(at, firsts[text] + start)
    return {"k_id": np.array(part["k_id"], "i8")[text].tolist(),
            "k_hash": np.array(part["k_hash"], "i8")[text], "start": start.astype("i4"),
            "print": prints[place].view("i8"), "whole": whole[place].view("i8")}


def owned(rows: DataFrame, label: str) -> DataFrame:
    """print, whole, n, o: the first of all rows alike. Written, so that both sides of a join with it are
    plain tables, and a key that a third of the documents share is split over tasks.
    """
    return written(rows.groupBy(F.col("print").alias("o_print"), F.col("whole").alias("o_whole")).agg(
        F.count("*").alias("o_n"), F.min(F.struct("k_id", "k_hash", "start")).alias("o")), label)


def met(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """The rows that are not the first of their kind, and whether they overlap the first."""
    same = (F.col("o.k_id") == F.col("k_id")) & (F.col("o.k_hash") == F.col("k_hash"))
    return rows.join(owners.where("o_n > 1"), (F.col("print") == F.col("o_print")) & (
        F.col("whole") == F.col("o_whole"))).withColumn(
            "shift", F.when(same, F.col("start") - F.col("o.start"))).where(
                "shift is null or shift > 0").drop("o", "o_print", "o_whole", "o_n")


def later_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """k_id, k_hash, matches: stretches of words (first, end) that stood before."""
    since = scratch_mark()
    stored = written(per_slice(keyed(docs), lambda part: segments(part, min_words), SEGMENTS), "segments")
    often = written(stored.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("print").alias("repeated")), "prints")
    rows = written(stored.join(often, F.col("print") == F.col("repeated"), "left_semi"), "repeated")
    drop_scratch(docs.sparkSession, since, since + 2)
    kinds = owned(rows.withColumn("start", F.struct("start", "n")), "kinds")
    firsts = kinds.select("o_print", "o_whole", "o_n", F.struct(
        "o.k_id", "o.k_hash", F.col("o.start.start").alias("start")).alias("o"))
    later = written(met(rows, firsts), "later-segments")
    overlapping = later.where(F.col("shift") < min_words)
    # Prints whose segments differ or overlap; each kind by its first, for it owns what the others hold.
    unlike = written(kinds.select("o_print", F.lit(1).alias("x")).unionByName(
        overlapping.select(F.col("print").alias("o_print"), F.lit(1).alias("x"))).groupBy("o_print").agg(
            F.sum("x").alias("x")).where("x > 1").select(F.col("o_print").alias("mixed")), "mixed")
    first = kinds.join(unlike, F.col("o_print") == F.col("mixed"), "left_semi").select(
        "o.k_id", "o.k_hash", F.col("o.start.start").alias("start"), F.col("o.start.n").alias("n"))
    opened = written(first.unionByName(overlapping.select("k_id", "k_hash", "start", "n")).groupBy(
        F.col("k_id").alias("u_id"), F.col("k_hash").alias("u_hash")).agg(
            F.collect_set(F.struct("start", "n")).alias("open")), "open-segments")
    texts = keyed(docs).join(opened, (F.col("k_id") == F.col("u_id")) & (F.col("k_hash") == F.col("u_hash")))
    single = written(per_slice(texts.select("k_id", "k_hash", "text", "open"),
                               lambda part: windows(part, min_words), WINDOWS), "windows")
    again = met(single, owned(single, "window-owners")).withColumn("n", F.lit(1))
    return later.unionByName(again).where(F.col("shift").isNull() | (F.col("shift") >= min_words)).groupBy(
        "k_id", "k_hash").agg(F.collect_set(F.struct(
            F.col("start").alias("first"),
            (F.col("start") + F.col("n") + F.lit(min_words - 1)).alias("end"))).alias("matches"))


def edges(mask: np.ndarray) -> np.ndarray:
    """Where runs of true begin and end, by turns."""
    padded = np.zeros(len(mask) + 2, bool)
    padded[1:-1] = mask
    return np.flatnonzero(padded[1:] != padded[:-1])


def edit(text: str | None, matches: list[dict] | None) -> tuple:
    """The text without its later passages, and the values of EDIT."""
    if text is None:
        return None, 0, 0, 0, 0, "", ""
    if not matches:
        return text, len(WORDED_LINE.findall(text)), 0, 0, 0, "", ""
    # Bytes split at the white space between words, and at no other; places are looked up in cut lines only.
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    sizes = [len(x.split()) for x in lines]
    change = np.zeros(sum(sizes) + 1, "i8")
    np.add.at(change, [m["first"] for m in matches], 1)
    np.add.at(change, [m["end"] for m in matches], -1)
    gone = np.cumsum(change)[:-1] > 0
    upto_line = np.concatenate([[0], np.cumsum(gone)])[np.cumsum([0, *sizes])]
    n_lost = (upto_line[1:] - upto_line[:-1]).tolist()
    kept: list[bytes] = []
    whole: list[list[int]] = []
    cuts: list[tuple[int, int, int]] = []
    at = n_cut = 0
    for number, (line, size, n_gone) in enumerate(zip(lines, sizes, n_lost, strict=True)):
        at += size
        if not n_gone:
            kept.append(line)
        elif n_gone == size:
            if whole and whole[-1][1] == number - 1:
                whole[-1][1] = number
            else:
                whole.append([number, number])
        else:
            n_cut += 1
            edge, run = edges(~_SPACE[np.frombuffer(line, "u1")]), edges(gone[at - size:at]).tolist()
            starts, ends = edge[::2], edge[1::2]
            pieces, upto = [], 0
            for i, after in zip(run[::2], run[1::2], strict=True):
                cuts.append((number, i, after - 1))
                last = after == size
                pieces.append(line[upto:ends[i - 1] if last else starts[i]])
                upto = len(line) if last else starts[after]
            kept.append(b"".join([*pieces, line[upto:]]))
    return (b"\n".join(kept).decode("utf-8", "surrogatepass"), sum(map(bool, sizes)),
            sum(b - a + 1 for a, b in whole), n_cut, sum(n_lost),
            ",".join(f"{a}-{b}" for a, b in whole), ",".join(f"{n}:{a}-{b}" for n, a, b in cuts))


def edited(docs: DataFrame, min_words: int = MIN_WORDS, result: str = "line_dedup") -> DataFrame:
    """All columns of `docs` with the text edited, and a struct named `result` of EDIT.

    `removed` lists runs of line numbers (from 0, both ends included) of the text as it was that lost all
    their words, `cut` runs of words within other lines, as line:first-last.
    """
    return applied(docs, later_passages(docs, min_words), edit, result, EDIT)


def dedup_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without later passages, and the columns of EDIT."""
    return edited(docs.select("doc_id", "text"), min_words).select("doc_id", "text", "line_dedup.*")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The columns of `docs`, texts edited; documents of which no word is left are gone."""
    result = fresh("line_dedup", docs.columns)
    made = edited(docs, min_words, result)
    emptied = (F.col(f"{result}.n_lines") > 0) & (
        F.col(f"{result}.n_lines") == F.col(f"{result}.n_removed_lines"))
    return made.where(~emptied).drop(result)
