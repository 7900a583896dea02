"""Operator 1: line-first quality rules.

Every line is judged by itself: navigation (separators), punctuation (symbols, no sentence end),
boilerplate (fixed phrases) and repetition. Failing lines are removed, and a document goes when too
few of its words are left. Document measures are taken on the whole text first.

All work is per document, in slices of Arrow batches: no shuffle, so neither a hot source nor a
line that a third of the documents share makes any task longer.

Defined cases: null text has no words and fails. Lines without a word are blank; they are kept and
count for nothing. Repeated rows are judged each. Other columns are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from orderloom.llm.common import columns, per_slice

WORD = re.compile("[^\x20\x09-\x0D]+")
SYMBOL = re.compile("[#*$%&|<>]")
SEPARATOR = re.compile("[|»›•·]|::|>>")
SENTENCE_END = re.compile("[.!?…:;,\"'”’»)\\]]$")
BOILERPLATE = re.compile(
    "all rights reserved|cookie policy|privacy policy|terms of (?:use|service)|lorem ipsum"
    "|enable javascript|javascript is (?:disabled|required)|use of cookies|click here|read more"
    "|sign up for our|subscribe to our|share on (?:facebook|twitter)|skip to (?:main )?content"
    "|powered by|back to top", re.IGNORECASE)

RESULT = columns(
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
    "n_repeat_words bigint, base_failed boolean, kept boolean, n_lines_removed bigint,"
    "n_words_kept bigint, removed strings, cleaned string")


@dataclass(frozen=True)
class Rules:
    """Limits of the line rules and of the verdict on a document."""

    min_words: int = 50
    max_repeat_percent: int = 50
    #: A line is navigation with this many separators, and one to at most so many words.
    separators: int = 3
    words_per_separator: int = 4
    #: Symbols in percent of the line's words.
    symbol_percent: int = 30
    #: A line of more words than this needs a sentence end somewhere in its words.
    words_without_end: int = 60
    #: Lines of so many words need that share of different ones.
    repetition_from: int = 10
    distinct_percent: int = 30
    #: Boilerplate phrases condemn lines of at most so many words.
    boilerplate_words: int = 40
    #: A document goes when its lines lost more than this.
    max_lost_percent: int = 40


RULES = Rules()


def line_failure(line: str, words: list[str], rules: Rules = RULES) -> str | None:
    """The first rule that the line breaks; `words` are its words, at least one."""
    n = len(words)
    separators = len(SEPARATOR.findall(line))
    if separators >= rules.separators and separators * rules.words_per_separator >= n - separators:
        return "navigation"
    if len(SYMBOL.findall(line)) * 100 > rules.symbol_percent * n and n > 2:
        return "symbols"
    if n > rules.words_without_end and not any(SENTENCE_END.search(w) for w in words):
        return "punctuation"
    if n >= rules.repetition_from and len(set(words)) * 100 < rules.distinct_percent * n:
        return "repetition"
    if n <= rules.boilerplate_words and BOILERPLATE.search(line):
        return "boilerplate"
    return None


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of three found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        j = first.setdefault(window, i)
        if j != i:
            covered[j:j + 3] = b"\1\1\1"
            covered[i:i + 3] = b"\1\1\1"
    return covered.count(1)


def judge(text: str | None, rules: Rules = RULES) -> tuple:
    """The columns of RESULT after doc_id."""
    text = text or ""
    words: list[str] = []
    seen: set[str] = set()
    dup = removed_words = 0
    reasons, clean = [], []
    for line in text.split("\n"):
        own = WORD.findall(line)
        if not own:
            clean.append(line)
            continue
        words += own
        dup += line in seen
        seen.add(line)
        reason = line_failure(line, own, rules)
        if reason:
            reasons.append(reason)
            removed_words += len(own)
        else:
            clean.append(line)
    n, repeated = len(words), repeated_words(words)
    failed = n < rules.min_words or 100 * repeated > rules.max_repeat_percent * n
    kept = not failed and 100 * removed_words <= rules.max_lost_percent * n
    return (n, sum(map(len, words)), len(SYMBOL.findall(text)), dup, repeated, failed, kept,
            len(reasons), n - removed_words, reasons, "\n".join(clean))


def quality_rules(docs: DataFrame, rules: Rules = RULES) -> DataFrame:
    """One row per document: measures, verdict, the reasons of removed lines and what is left."""

    def task(part: dict[str, list]) -> dict[str, list]:
        rows = [(d, *judge(t, rules)) for d, t in zip(part["doc_id"], part["text"], strict=True)]
        return dict(zip(RESULT.names, map(list, zip(*rows, strict=True)), strict=True))

    return per_slice(docs.select("doc_id", "text"), task, RESULT)
