"""Operator 6: benchmark decontamination by one Aho-Corasick automaton.

The windows of all test items, as words between spaces, are the patterns of one automaton. Each text
is normalised to words between spaces and scanned once; the places of hits are mapped to words, and
by these to code points of the original text.

Only the items travel to the tasks. Their size is measured before, and above `max_chars` the items are
dealt into blocks of about that size (or one item), each scanned by an automaton of its own in a pass
of its own, which adds to the hits of the pass before. A block is collected when its pass begins, and
the rows with their hits are written as a table before the next one, so driver and workers hold one
block at a time, however large the benchmark is. Documents are never shuffled.

Defined cases: null text has no words and is not contaminated; null items and items without a word
match nothing; items alike are counted each. Repeated rows give a row each. Empty tables give no
rows or no hits. Other columns pass through `marked` whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import (attached, columns, discard, fresh, scratch_mark, worker_memory,
                                  written)

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
HITS = columns("n_words bigint, hit_words ints, items strings, spans string")
#: Characters of benchmark text in one automaton. With windows of 13 words a character makes some eleven
#: nodes of 32 bytes (measured: 545 MB in a worker for a million characters without repeated windows).
MAX_CHARS = 500_000


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def automaton(items: list[tuple[str, str | None]], window: int):
    """Patterns of all windows; the value is the items that have it and its number of words."""
    found: dict[str, list[int]] = {}
    for i, (_, text) in enumerate(items):
        words = words_of(text)
        n = min(window, len(words))
        for a in range(len(words) - n + 1 if n else 0):
            found.setdefault(f" {' '.join(words[a:a + n])} ", []).append(i)
    made = ahocorasick.Automaton()
    for pattern, own in found.items():
        made.add_word(pattern, (sorted(set(own)), pattern.count(" ") - 1, len(pattern)))
    if found:
        made.make_automaton()
    return made if found else None


def scan(text: str | None, made, items: list[tuple[str, str | None]], before: dict | None) -> dict:
    """The values of HITS, with what an earlier block found."""
    words = words_of(text)
    hit = set(before["hit_words"]) if before else set()
    found = before["items"] if before else []
    which: set[int] = set()
    if made is not None and words:
        places = []
        line = f" {' '.join(words)} "
        for end, (own, n, size) in made.iter(line):
            places.append((end - size + 1, n))
            which.update(own)
        if places:
            starts, at = {}, 0
            for i, word in enumerate(words):
                starts[at] = i
                at += len(word) + 1
            hit.update(w for place, n in places for w in range(starts[place], starts[place] + n))
    return {"n_words": len(words), "hit_words": sorted(hit),
            "items": sorted([*found, *(items[i][0] for i in which)]), "spans": spans(text, hit)}


def spans(text: str | None, hit: set[int]) -> str:
    """start:end code points, in the text as it is, of runs of hit words."""
    if not hit:
        return ""
    at = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    runs: list[list[int]] = []
    for w in sorted(hit):
        if runs and runs[-1][2] == w - 1:
            runs[-1][1:] = [at[w][1], w]
        else:
            runs.append([*at[w], w])
    return ",".join(f"{a}:{b}" for a, b, _ in runs)


def marked(docs: DataFrame, items: DataFrame, name: str, window: int = 13,
           max_chars: int = MAX_CHARS) -> DataFrame:
    """All columns of `docs`, and a struct `name` of HITS; one pass for each block of items."""
    needs, since = ["text"], scratch_mark()
    for block in item_blocks(items, max_chars):
        if name in needs:
            docs = written(docs, "hits")
            discard(docs, since, scratch_mark())  # the table of the pass before
        docs = attached(docs, needs, _scanner(docs, block, window, name), name, HITS)
        needs = ["text", name]
    return docs


def verdicts(name: str) -> list[Column]:
    """n_words, n_hit, n_items, items_sha256 and contaminated of the struct `name`.

    A document is contaminated when at least a twentieth of its words is hit.
    """
    n_words, hit = F.col(f"{name}.n_words"), F.size(f"{name}.hit_words").cast("bigint")
    return [n_words.alias("n_words"), hit.alias("n_hit"),
            F.size(f"{name}.items").cast("bigint").alias("n_items"),
            F.sha2(F.concat_ws(",", f"{name}.items"), 256).alias("items_sha256"),
            ((hit > 0) & (20 * hit >= n_words)).alias("contaminated")]


def benchmark_hits(docs: DataFrame, items: DataFrame, window: int = 13,
                   max_chars: int = MAX_CHARS) -> DataFrame:
    """doc_id, the columns of `verdicts`, the items, and start:end code points of hit runs."""
    return marked(docs.select("doc_id", "text"), items, "hits", window, max_chars).select(
        "doc_id", *verdicts("hits"), "hits.items", "hits.spans")


def without_benchmark(docs: DataFrame, items: DataFrame, window: int = 13) -> DataFrame:
    """The rows of `docs`, all columns, that are not contaminated."""
    name = fresh("hits", docs.columns)
    return marked(docs, items, name, window).where(~verdicts(name)[-1]).drop(name)


def item_blocks(items: DataFrame, max_chars: int) -> Iterator[list[tuple[str, str | None]]]:
    """The items in lists of about `max_chars` characters, each collected when it is asked for."""
    sized = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = sized.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // max_chars))
    for b in range(n):
        own = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) if n > 1 else sized
        yield [tuple(r) for r in own.collect()]


def _scanner(docs: DataFrame, block: list, window: int, name: str):
    items = [(item_id or "", text) for item_id, text in block]
    sent = docs.sparkSession.sparkContext.broadcast(items)
    mark = hashlib.md5(repr((items, window)).encode()).hexdigest()

    def task(part: dict[str, list]) -> list[dict]:
        built = worker_memory("decontaminate")
        if mark not in built:  # once per Python worker
            built.clear()
            built[mark] = automaton(sent.value, window)
        before = part.get(name, [None] * len(part["text"]))
        return [scan(text, built[mark], sent.value, found)
                for text, found in zip(part["text"], before, strict=True)]

    return task
