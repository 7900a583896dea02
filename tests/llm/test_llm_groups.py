"""Line dedup, the set join, language and the pipeline."""

import collections
import itertools
import os
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from orderloom.llm import components, crf, language, linededup, passages, setjoin, shingles

SF = "/root/testdata/sf0.001"


# line dedup -------------------------------------------------------------------------------------

def plain_removed(docs, least):
    """Every run against the first equal one, then both ways line by line."""
    seqs = {}
    for d, text in docs:
        lines = [(i, re.findall("[^\x20\x09-\x0D]+", x)) for i, x in enumerate(text.split("\n"))]
        seqs[d] = [(i, tuple(w)) for i, w in lines if w]
    first, runs = {}, []
    for d in sorted(seqs):
        seq = seqs[d]
        for i in range(len(seq)):
            total = 0
            for e in range(i, len(seq)):
                total += len(seq[e][1])
                if total >= least:
                    key = tuple(w for _, w in seq[i:e + 1])
                    first.setdefault(key, (d, i, e))
                    runs.append((d, i, e, key))
                    break
    gone = {d: set() for d in seqs}
    for d, i, e, key in runs:
        fd, fi, fe = first[key]
        if (fd, fi) == (d, i) or fd == d and i <= fe:
            continue
        own, other = [w for _, w in seqs[d]], [w for _, w in seqs[fd]]
        gone[d] |= set(range(i, e + 1))
        k, words = 1, 0
        while words < least and i - k > (fe if fd == d else -1) and fi >= k and own[i - k] == other[fi - k]:
            gone[d].add(i - k)
            words, k = words + len(own[i - k]), k + 1
        k, words = 1, 0
        while words < least and e + k < len(own) and fe + k < len(other) and own[e + k] == other[fe + k]:
            gone[d].add(e + k)
            words, k = words + len(own[e + k]), k + 1
    return {d: sorted(seqs[d][x][0] for x in gone[d]) for d in seqs}


def spelled(removed):
    return [x for part in removed.split(",") if part
            for x in range(int(part.split("-")[0]), int(part.split("-")[1]) + 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    pool = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.choice([1, 2, 5, 10, 30, 60])))
            for _ in range(12)]
    docs = []
    for d in range(40):
        lines = [rnd.choice(pool) if rnd.random() < 0.8 else rnd.choice(["", "  ", f"own {d} {i}"])
                 for i in range(rnd.randint(0, 12))]
        if docs and rnd.random() < 0.3:
            lines += rnd.choice(docs)[1].split("\n")
        docs.append((d, "\n".join(lines)))
    least = (50, 20)[seed % 2]
    df = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id bigint, text string, n_lines int")
    rows = {r.doc_id: r for r in linededup.dedup_lines(df, least).collect()}
    want = plain_removed(docs, least)
    assert {d: spelled(r.removed) for d, r in rows.items()} == want
    for d, text in docs:
        kept = [x for i, x in enumerate(text.split("\n")) if i not in want[d]]
        assert rows[d].text == "\n".join(kept)


def test_line_dedup_of_awkward_rows(spark):
    passage = "\n".join(f"{x} " * 20 + "end." for x in "abcd")
    rows = [(1, passage), (1, passage), (2, None), (3, ""), (None, passage), (7, f"own line\n{passage}"),
            (8, "\n".join([passage] * 3)), (9, "w " * 50_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "doc_id bigint, text string, _matches string, line_dedup int")
    made = linededup.without_repeats(df)
    assert made.columns == df.columns
    found = sorted(((r.doc_id, r.text) for r in made.collect()), key=repr)
    assert found == sorted([(1, passage), (1, passage), (2, None), (3, ""), (7, "own line"),
                            (9, "w " * 50_000)], key=repr)
    assert linededup.dedup_lines(df.limit(0)).count() == 0


# passages ---------------------------------------------------------------------------------------

def plain_kept(docs, least):
    """Lines of kept words: a word goes with any window that stood before without overlap."""
    first, kept = {}, {}
    for d, text in sorted(docs):
        lines = [re.findall("[^\x20\x09-\x0D]+", x) for x in text.split("\n")]
        words = [w for x in lines for w in x]
        gone = set()
        for i in range(len(words) - least + 1):
            fd, fi = first.setdefault(tuple(words[i:i + least]), (d, i))
            if fd != d or i >= fi + least:
                gone |= set(range(i, i + least))
        at, kept[d] = 0, []
        for x in lines:
            left = [w for i, w in enumerate(x, at) if i not in gone]
            at += len(x)
            if left or not x:
                kept[d].append(left)
    return kept


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passages_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    docs = []
    for d in range(60):
        words = [rnd.choice("abé") if rnd.random() < 0.1 else f"w{rnd.randrange(1000)}"
                 for _ in range(rnd.randint(0, 80))]
        for _ in range(rnd.randint(0, 3)):
            if docs:
                other = rnd.choice(docs)[1].split()
                i = rnd.randint(0, len(other))
                at = rnd.randint(0, len(words))
                words[at:at] = other[i:i + rnd.choice([10, 19, 20, 21, 50, 51, 200])]
        if rnd.random() < 0.2:
            words += rnd.choice([["x"], ["x", "y", "z"]]) * rnd.randint(10, 80)
        docs.append((d, "".join(w + rnd.choice([" "] * 12 + ["\n", "  ", "\n\n"]) for w in words)))
    least = (50, 20, 7)[seed - 1]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = plain_kept(docs, least)
    rows = {r.doc_id: r for r in passages.dedup_passages(df, least).collect()}
    for d, text in docs:
        assert [x.split() for x in rows[d].text.split("\n")] == (want[d] or [[]]), d
        assert rows[d].n_removed_words == len(text.split()) - sum(map(len, want[d]))
    assert sum(r.n_cut_lines for r in rows.values()) > 5


def test_passage_inside_lines_is_cut(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    more = " ".join(f"q{i}" for i in range(40))
    rows = [(1, f"one {passage} end"), (2, f"two  three {passage}  four\n five"), (3, f"six {passage} {more} a"),
            (4, f"b\n{passage} {more} c"), (5, f"d {passage} \n\n{passage}")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in passages.dedup_passages(df).collect()}
    assert [found[d].text for d in range(1, 6)] == [
        rows[0][1], "two  three four\n five", f"six {more} a", "b\nc", "d\n"]
    assert (found[2].cut, found[2].removed, found[5].cut, found[5].removed) == ("0:2-61", "", "0:1-60", "2-2")
    assert (found[4].n_removed_words, found[5].n_removed_lines, found[5].n_cut_lines) == (100, 1, 1)


def test_passages_of_awkward_rows(spark):
    passage = "\n".join(f"{x} " * 20 + "end." for x in "abcd")
    rows = [(1, passage), (1, passage), (2, None), (3, ""), (None, passage), (7, f"own line\n{passage}"),
            (9, "w " * 5_000), (10, "x" * 9_000 + " " + "é" * 9_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "doc_id bigint, text string, _matches string, line_dedup int")
    made = passages.without_repeats(df)
    assert made.columns == df.columns
    found = sorted(((r.doc_id, r.text) for r in made.collect()), key=repr)
    assert found == sorted([(1, passage), (1, passage), (2, None), (3, ""), (7, "own line"),
                            (9, " ".join("w" * 50)), rows[7]], key=repr)
    assert passages.dedup_passages(df.limit(0)).count() == 0


# set join ---------------------------------------------------------------------------------------

def plain_set(text, k):
    words = re.findall("[^\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def plain_components(docs, k, percent):
    sets = [plain_set(t, k) for _, t in docs]
    parent = list(range(len(docs)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in itertools.combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[top(i)] = min(least.get(top(i), d), d)
    return {(d, len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(docs)}


def edited_docs(seed):
    rnd = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(300)]
    bases = [[rnd.choice(vocabulary) for _ in range(n)] for n in (1, 2, 3, 5, 8, 15, 30, 60, 150, 400)]
    docs = []
    for d in range(200):
        words = list(rnd.choice(bases)) if rnd.random() < 0.85 else rnd.sample(vocabulary, 30)
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
            i = rnd.randrange(len(words) + 1)
            words[i:i + rnd.randint(0, 1)] = [rnd.choice(vocabulary)] * rnd.randint(0, 1)
        docs.append((d, rnd.choice([" ", "  ", "\n"]).join(words)))
    return [*docs, (500, None), (501, ""), (502, " ")]


@pytest.mark.parametrize("seed, k, percent", [(1, 3, 90), (2, 5, 80)])
def test_components_equal_brute_force(spark, seed, k, percent):
    docs = edited_docs(seed)
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, n string")
    want = plain_components(docs, k, percent)
    assert {tuple(r) for r in setjoin.jaccard_components(df, k, percent).collect()} == want
    kept = setjoin.one_of_each(df, k, percent)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})


def test_set_join_of_awkward_rows(spark):
    text = "one two three four five six seven"
    rows = [(3, text), (3, text), (None, text), (3, "other words here"), (4, None), (2, text.upper()),
            (None, None), (8, "w " * 40_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, _d int")
    found = setjoin.jaccard_components(df).collect()
    assert len(found) == len(rows)
    assert {r.component_id for r in found if r.n_shingles == 3} == {2}
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text is None) for r in setjoin.one_of_each(df).collect())
    assert kept == [(False, 2, False), (False, 3, False), (False, 4, True), (False, 8, False),
                    (True, 0, True)]
    assert setjoin.jaccard_components(df.limit(0)).count() == 0


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for percent in (80, 90):
        for n in (*range(1, 60), 200, 999):
            base = np.unique(rng.integers(0, 2 ** 63, n).astype("u8"))
            for gone in range(0, len(base)):
                other = base[gone:]
                if 100 * len(other) < percent * len(base):
                    break
                own = set(shingles.signatures(base, percent).tolist())
                assert own & set(shingles.signatures(other, percent).tolist())
                differ = np.unpackbits(shingles.bitmap(base).view("u1")
                                       ^ shingles.bitmap(other).view("u1")).sum()
                assert differ <= gone


def test_components_of_a_long_chain(spark):
    n = 200
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(900, 901)], "a bigint, b bigint")
    roots = {r.node: r.root for r in components.components(links).collect()}
    assert roots == {**{i: 0 for i in range(n + 1)}, 900: 900, 901: 900}


# language ---------------------------------------------------------------------------------------

def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(5)
    lengths, k = np.array([4, 2, 1]), 3
    scores, moves, start = rng.normal(size=(3, 4, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    found = crf.marginals(scores, lengths, moves, start)
    pairs = np.zeros((k, k))
    for s, n in enumerate(lengths):
        total, sums, two = 0.0, np.zeros((n, k)), np.zeros((k, k))
        for path in itertools.product(range(k), repeat=int(n)):
            w = np.exp(start[path[0]] + sum(scores[s, t, y] for t, y in enumerate(path))
                       + sum(moves[a, b] for a, b in itertools.pairwise(path)))
            total += w
            for t, y in enumerate(path):
                sums[t, y] += w
            for a, b in itertools.pairwise(path):
                two[a, b] += w
        assert np.allclose(found[s, :n], sums / total)
        pairs += two / total
    assert np.allclose(crf.pair_counts(scores, lengths, moves, start), pairs, atol=1e-5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in language.identify(docs).collect()}
    true = {r.doc_id: r.lang for r in docs.collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in rows.items())
    out = [d for d, r in rows.items() if r.held_out]
    assert np.mean([rows[d].lang_pred == true[d] for d in out]) > 0.96
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_code_switched_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    made = language.label_texts(["erkeitung und die schein einer the and of thouing with",
                                 None, "", "12 34 !", "x" * 5000], model)
    labels = [model.labels[i] for i in made[0][3]]
    assert labels[:5] == ["de"] * 5 and labels[-5:] == ["en"] * 5
    assert [m[0] for m in made[1:4]] == ["und"] * 3 and made[1][1] == 0.0
    assert made[4][0] in model.labels


def test_language_of_awkward_rows(spark):
    rows = [(None, "text here", "en"), (1, None, None), (1, "some words", None), (2, "", "de")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, score string")
    found = language.identify(df).collect()
    assert len(found) == 4 and {r.lang_pred for r in found} == {"und"}
    assert language.keep_identified(df).columns == df.columns
    assert language.identify(df.limit(0)).count() == 0


def test_the_sample_is_bounded_before_it_leaves_the_tasks(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "fit", lambda texts: seen.append(texts))
    free = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(free[0], "same row again", "en")] * 500  # one id, one text
    rows += [(free[1], f"text number {'x' * n}", "en") for n in range(1, 41)]  # one id, many texts
    rows += [(i, "lang wort " * 5000, "de") for i in free[2:40]] + [(free[41], "mot", "fr")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    language.train(df, per_label=20, words_per_text=7)
    counts = collections.Counter(lang for _, lang in seen[0])
    assert counts == {"en": 20, "de": 20, "fr": 1}
    assert sum(text == "same row again" for text, _ in seen[0]) <= 1
    assert all(len(text.split()) <= 7 for text, _ in seen[0])
    language.train(df, per_label=20, words_per_text=7, max_labels=2)
    assert {lang for _, lang in seen[1]} == {"en", "de"}


# pipeline ---------------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == names, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert 0.5 * before < docs.count() <= before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_stages_on_empty_and_awkward_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = docs.limit(3).selectExpr("cast(null as bigint) doc_id", "cast(null as string) text", "lang",
                                    "source", "n_chars").unionByName(docs.limit(20))
    more = more.selectExpr("*", "1 AS kept", "'x' AS hits", "2 AS language", "3 AS _d", "4 AS uid")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        made = stage(spark, more, SF)
        assert made.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "language"


def test_stages_take_any_column_names(spark):
    """Names that the operators use themselves, and names with dots."""
    from orderloom.llm import decontaminate, language

    text = " ".join(f"word{i} and the of" for i in range(40))
    rows = [(i, text if i < 3 else f"{text} {i}" * (i % 3 + 1), "en") for i in range(9)]
    clashing = ["_id", "_m_id", "_m_hash", "_k_d", "_k_h", "a.b", "c0", "made", "found", "result", "hits"]
    df = spark.createDataFrame([(*r, *range(len(clashing))) for r in rows], "doc_id bigint, text string, lang string, "
                               + ", ".join(f"`{c}` int" for c in clashing))
    items = spark.createDataFrame([(1, "nothing of that kind")], "item_id bigint, text string")
    for made in (language.keep_identified(df), passages.without_repeats(df), linededup.without_repeats(df),
                 setjoin.one_of_each(df), decontaminate.without_benchmark(df, items)):
        assert made.columns == df.columns
        kept = made.collect()
        assert kept and all(tuple(r[3:]) == tuple(range(len(clashing))) for r in kept)


def test_words_of_kept_lines_are_not_looked_up(monkeypatch):
    """Only the bytes of lines that are cut inside are searched for words."""
    searched, edges = [], getattr(passages, "edges", None)
    monkeypatch.setattr(passages, "edges", lambda mask: searched.append(len(mask)) or edges(mask),
                        raising=False)
    long = "w\x1cw ü " * 500
    text = f"{long}\none two  three\tfour\x0b\n \n{long}\ngone gone"
    assert passages.edit(text, []) == (text, 4, 0, 0, 0, "", "")
    assert not searched
    made = passages.edit(text, [{"first": 1001, "end": 1003}, {"first": 2004, "end": 2006}])
    assert made == (f"{long}\none four\x0b\n \n{long}", 4, 1, 1, 4, "4-4", "1:1-2")
    assert searched == [len("one two  three\tfour\x0b"), 4]


def test_signatures_go_once_their_lists_are_made(spark):
    from orderloom.llm.common import scratch_path
    text = " ".join(f"w{i}" for i in range(400))
    df = spark.createDataFrame([(1, text), (2, text + " x"), (3, None)], "doc_id bigint, text string")
    sets, signed = setjoin.sets_of(df, 5, 80)
    path = scratch_path()
    reps, left = sets.where("n > 0").select("uid"), []
    assert sets.count() == 3 and signed.select("slice").distinct().count() == setjoin.SLICES
    for entries in setjoin.entries_of(signed, path, reps):
        assert entries.where("uid <> pivot").count() > 0
        left.append(len([x for x in os.listdir(path.removeprefix("file:")) if x.startswith("slice=")]))
    assert left == list(range(setjoin.SLICES + 1, 1, -1))  # the sets' own folder stays
    assert sets.count() == 3
