"""Collocations, ranked search and exact dedup against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderloom.llm import collocations, exactdedup, lexical, perfecthash

DOCS = "doc_id bigint, text string, lang string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# exact dedup ------------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    rnd = np.random.default_rng(n)
    digests = rnd.integers(0, 1 << 63, (n, 4)).astype("u8")
    digests[:, 0] = 7  # three words differ, one does not
    sizes, bits, slots = perfecthash.build(digests)
    assert sorted(slots.tolist()) == list(range(n))
    assert (perfecthash.find(digests, sizes, bits) == slots).all()
    others = perfecthash.find(digests + np.uint64(1), sizes, bits)
    assert ((others >= -1) & (others < max(n, 1))).all()
    assert len(bits) <= 40 + n


def plain_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    return Counter(
        (d, max((x for x in ids if x is not None), default=None), len(ids), i == 0,
         hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items()
        for i, d in enumerate(sorted(ids, key=lambda x: (x is not None, x or 0), reverse=True)))


@pytest.mark.parametrize("upto", [None, -1, 0, 40, 1000])
def test_exact_dedup_equals_plain_groups(spark, upto, monkeypatch):
    monkeypatch.setattr(exactdedup, "BUCKET", 5)
    rnd = random.Random(3)
    texts = [None, "", " ", "a", "A", "a ", "é", "é", "x" * 100_000, *(f"t{i}" for i in range(20))]
    rows = [(i, rnd.choice(texts)) for i in range(80)] + [(80 + i, "hot") for i in range(60)]
    rows += [(None, "t1"), (None, "alone"), (5, "twin"), (5, "twin"), (None, "none"), (None, "none")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "doc_id bigint, text string, digest int, `a.b` string")
    made = exactdedup.dedup_exact(df, upto)
    assert made.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, made.collect())) == plain_groups(rows)
    kept = exactdedup.without_copies(df, upto)
    assert kept.columns == df.columns
    assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == Counter(
        {(d, next(t or "" for _, t in rows if hashlib.sha256((t or "").encode()).hexdigest() == sha)): 1
         for d, _, _, stays, sha in plain_groups(rows) if stays})


def test_exact_dedup_of_no_rows(spark):
    df = spark.createDataFrame([], DOCS)
    assert exactdedup.dedup_exact(df).count() == 0
    assert exactdedup.without_copies(df).count() == 0


# ranked search ----------------------------------------------------------------------------------

def plain_ranking(docs, items, k):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))
    found = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    total = sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in found:
            m = 100 - 75 + 75 * sum(c.values()) * len(found) // total
            s = sum(n * math.floor(1000 * math.log((2 * len(found) + 2) / (2 * df[t] + 1)))
                    * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t, n in Counter(terms(text)).items() if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, i, None if none else d, -s)
                for i, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("seed,block,start", [(1, 2_000_000, 8192), (2, 60, 7), (3, 200, 1)])
def test_ranking_equals_plain_ranking(spark, seed, block, start):
    rnd = random.Random(seed)
    pool = [f"w{int(rnd.paretovariate(0.7)) % 300}" for _ in range(500)] + ["É", "Straße", "x9", "9"]

    def text(n):
        return "".join(rnd.choice(pool).upper() + rnd.choice([" ", "_", "-", ".\n", "\x00"])
                       for _ in range(n))
    docs = [(i, text(rnd.choice([0, 1, 5, 30, 200]))) for i in range(150)]
    docs += [(200 + i, docs[7][1]) for i in range(30)]  # ties
    docs += [(None, docs[7][1]), (None, "w1 w2"), (7, docs[7][1]), (300, None), (301, "w1 " * 20_000)]
    items = [(i, text(rnd.choice([1, 3, 20]))) for i in range(15)]
    items += [(3, items[3][1]), (20, None), (21, "zzz"), (22, ""), (23, docs[7][1]), (24, "w1 W1 w1")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, score string")
    queries = spark.createDataFrame([(*i, 1) for i in items], "item_id bigint, text string, item int")
    made = lexical.ranked(df.repartition(5), queries, 10, block, start)
    assert made.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, made.collect())) == plain_ranking(docs, items, 10)


def test_ranking_of_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", "en")], DOCS)
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert lexical.ranked(df.limit(0), items).count() == 0
    assert lexical.ranked(df, items.limit(0)).count() == 0


def test_bounds_skip_and_never_lose(spark):
    """Whole buckets and single vectors are skipped, and no vector above the bar is among them."""
    rnd = random.Random(5)
    docs = [(i, " ".join(f"t{int(rnd.paretovariate(1)) % 60}" for _ in range(rnd.choice([2, 10, 400]))))
            for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    queries = lexical.Queries([(1, "t1 t1 t7 t9 t30 t31 t40"), (2, "t2")])
    own = lexical.vectors(df, queries)
    n, words = own.selectExpr("count(*)", "sum(n)").first()
    queries.weigh(dict(own.selectExpr("explode(terms) t").groupBy("t").count().collect()), n)
    batch = lexical.impacts(own, n, words).select(
        "doc_id", "terms", "impacts", "square").toArrow().combine_chunks().to_batches()[0]
    bucket = lexical.Bucket(batch)
    for _, terms, weights in queries.weighted:
        scores = bucket.scores(terms, weights)
        bar = sorted(scores)[-5]
        may = bucket.may_reach(terms, weights, int(bar))
        assert may[scores >= bar].all() and not may.all()
        assert scores.max() <= math.sqrt(sum(w * w for w in weights)) * bucket.longest


# collocations -----------------------------------------------------------------------------------

def plain_collocations(docs, support, top):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts[lang].update(tuple(words[i:i + m]) for m in range(1, 6)
                                for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        good = {p: n for p, n in f.items() if n >= support}
        rows = []
        for p, a in good.items():
            if len(p) == 1 or any(n >= a and len(q) > len(p) and any(
                    q[i:i + len(p)] == p for i in range(len(q))) for q, n in good.items()):
                continue
            score, _, l, r = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                 for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, totals[lang], -s)
                for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return Counter(out)


def some_texts(seed, n):
    rnd = random.Random(seed)
    fixed = ["on the other hand", "À la carte É", "as soon as it was", "x x x x x x x"]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rnd.randint(0, 40)):
            words.append(rnd.choice(fixed) if rnd.random() < 0.2 else f"W{int(rnd.paretovariate(0.9)) % 90}")
            words.append(rnd.choice([" "] * 8 + ["  ", "\t", ", ", ".", "\n", "\x0b", "\x1c", "\xa0"]))
        docs.append((i, "".join(words), rnd.choice(["en", "fr", None, "und"])))
    return docs


@pytest.mark.parametrize("small,top", [(2_000_000, 2000), (500, 2000), (300, 7)])
def test_collocations_equal_plain_ones(spark, small, top, monkeypatch):
    monkeypatch.setattr(collocations, "SMALL_SHARD", small)
    docs = some_texts(small, 300)
    docs += [(900, None, "en"), (901, "", "de"), (902, "a b " * 30_000, "de"), (903, "one", "nl"),
             (903, "one", "nl"), (None, "to be " * 50, "nl")]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS + ", phrase int, shards string")
    made = collocations.collocations(df.repartition(5), support=20, top=top)
    assert made.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert Counter(map(tuple, made.collect())) == plain_collocations(docs, 20, top)


def test_collocations_of_no_rows(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0


def test_levels_in_chunks(monkeypatch):
    """A level counted in many chunks, and closed under the shorter parts."""
    texts = [t.encode() for _, t, _ in some_texts(9, 200)]

    def counts(chunk):
        monkeypatch.setattr(collocations, "CHUNK", chunk)
        words = collocations.Words("en")
        for t in texts:
            words.add(t)
        return {(length, p, int(c), int(x)) for length, n, h, places in words.levels(5, lambda n, h: n >= 3)
                for p, c, x in zip(words.spelled(length, places), n, h, strict=True)}

    assert counts(1 << 40) == counts(37)


def test_support_is_reached_by_phrases_spread_evenly(spark, monkeypatch):
    """A phrase that no shard holds more often than it must is still found."""
    monkeypatch.setattr(collocations, "SMALL_SHARD", 100)
    docs = [(i, f"rare pair u{i} v{i}", "en") for i in range(100)]
    df = spark.createDataFrame(docs, DOCS)
    assert [tuple(r) for r in collocations.collocations(df).collect()] == [
        ("en", 1, "rare pair", 100, 100, 100, 400, 4000)]
    assert collocations.collocations(df.where("doc_id > 0")).count() == 0
