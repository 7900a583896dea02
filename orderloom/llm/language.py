"""Operator 9: language of words and documents by a linear-chain conditional random field.

Training takes a bounded sample: `per_label` documents of each label, the ones of lowest hash among
those not held out, of each at most `words_per_text` words, and at most `max_labels` labels. Nothing else is bounded: prediction
labels every word of every text. A sequence is a line, cut after `SEQUENCE` words, so that
code-switched text changes label between words and long lines cost no more memory.

The model (weights of `BUCKETS` features, transitions, lexicon of the sample) has a fixed bound and
travels with the tasks; documents are labelled where they are read, without a shuffle.

Defined cases: a text that is null or has no letter is `und` with score 0; so is every text if there
is nothing to learn from. Null labels are not learned from. A document without an id is neither held
out nor learned from. Repeated rows are labelled each. Ties go to the label first in order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import attached, columns, fresh, per_slice
from orderloom.llm.crf import WORD, Model, fit, marginals, padded

SEQUENCE = 256
CHUNK = 512
RESULT = columns("doc_id bigint, held_out boolean, lang_pred string, score double, n_words bigint,"
                 "n_switches bigint")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, per_label: int = 250, words_per_text: int = 150,
          max_labels: int = 256) -> Model:
    """Learns from text and lang of documents that are not held out.

    At most `max_labels` labels are learned, those of most documents (ties: first in order), and at
    most `per_label` texts of each, cut to `words_per_text` words before they leave the executors. So
    the driver gets at most `max_labels * per_label * words_per_text` words. Rows alike count once.
    """
    print_of = F.xxhash64("text")
    keys = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()).groupBy(
        "lang", "doc_id", print_of.alias("print")).agg(F.count("*").alias("n"))
    labels = keys.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(
        max_labels)
    chosen = keys.drop("n").join(F.broadcast(labels.select("lang")), "lang").withColumn(
        "place", F.row_number().over(Window.partitionBy("lang").orderBy(
            F.xxhash64("doc_id", F.lit(9)), "doc_id", "print"))).where(
        F.col("place") <= per_label).drop("place")
    # At most per_label rows for each of max_labels labels.
    texts = docs.select("lang", "doc_id", print_of.alias("print"), "text").where(
        F.col("text").isNotNull()).join(F.broadcast(chosen), ["lang", "doc_id", "print"])

    def task(part: dict[str, list]) -> dict[str, list]:
        found = [WORD.findall(text.lower())[:words_per_text] for text in part["text"]]
        return {"lang": part["lang"], "doc_id": part["doc_id"], "words": [" ".join(w) for w in found]}

    cut = per_slice(texts.select("lang", "doc_id", "text"), task, columns(
        "lang string, doc_id bigint, words string")).distinct().where("words <> ''")
    return fit(sorted((r.words, r.lang) for r in cut.collect()))


def label_texts(texts: list[str | None], model: Model) -> list[tuple[str, float, int, list[str]]]:
    """(language, score, words, label of each word) of each text."""
    sequences, owner, words = [], [], []
    for i, text in enumerate(texts):
        for line in (text or "").lower().split("\n"):
            found = WORD.findall(line)
            for first in range(0, len(found), SEQUENCE):
                own = found[first:first + SEQUENCE]
                sequences.append(len(own))
                owner.append(i)
                words += own
    k = len(model.labels)
    if not words or not k:
        return [("und", 0.0, 0, [])] * len(texts)
    which, distinct = pd.factorize(np.array(words, object))
    scores = model.emissions(distinct.tolist())
    lengths = np.array(sequences)
    begins = np.cumsum(lengths) - lengths
    prob = np.empty((len(words), k), "f4")
    order = np.argsort(lengths, kind="stable")
    for first in range(0, len(order), CHUNK):  # sequences of like length together
        part = order[first:first + CHUNK]
        own = lengths[part]
        at = np.concatenate([np.arange(b, b + n) for b, n in
                             zip(begins[part], own, strict=True)])
        made = marginals(padded(scores[which[at]], own), own, model.transitions, model.start)
        prob[at] = made[np.arange(made.shape[1])[None, :] < own[:, None]]
    best = prob.argmax(axis=1)
    ends = np.zeros(len(texts) + 1, "i8")
    np.add.at(ends, np.array(owner) + 1, lengths)
    ends = np.cumsum(ends)
    out = []
    for a, b in zip(ends, ends[1:], strict=False):
        if a == b:
            out.append(("und", 0.0, 0, []))
            continue
        mean = prob[a:b].mean(axis=0, dtype="f8")
        top = int(mean.argmax())
        out.append((model.labels[top], float(min(1.0, mean[top])), int(b - a), best[a:b]))
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_words, n_switches (changes of label between words)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def task(part: dict[str, list]) -> dict[str, list]:
        made = label_texts(part["text"], sent.value)
        return {"doc_id": part["doc_id"], "held_out": part["held_out"],
                "lang_pred": [m[0] for m in made], "score": [m[1] for m in made],
                "n_words": [m[2] for m in made],
                "n_switches": [int(np.count_nonzero(np.diff(m[3]))) for m in made]}

    return per_slice(docs.select("doc_id", held_out().alias("held_out"), "text"), task, RESULT)


def identify(docs: DataFrame, per_label: int = 250, words_per_text: int = 150) -> DataFrame:
    return predict(docs, train(docs, per_label, words_per_text))


def keep_identified(docs: DataFrame, least_score: float = 0.35) -> DataFrame:
    """The rows of `docs`, all columns, whose language is known with at least that score."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs))

    def task(part: dict[str, list]) -> list[dict]:
        return [{"lang": m[0], "score": m[1]} for m in label_texts(part["text"], sent.value)]

    name = fresh("language", docs.columns)
    return attached(docs, ["text"], task, name, columns("lang string, score double")).where(
        (F.col(f"{name}.lang") != "und") & (F.col(f"{name}.score") >= least_score)).drop(name)
