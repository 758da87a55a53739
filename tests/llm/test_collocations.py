"""Collocations against plain counting of all runs of words."""

import re
from collections import Counter

import numpy as np
import pytest

from smeltery.llm import collocations
from smeltery.llm.queries import QUERIES


def plain_counts(docs):
    counts, totals = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                counts.update((lang, " ".join(words[i : i + size])) for i in range(len(words) - size + 1))
    return counts, totals


def plain_collocations(docs, least=10, top=2_000):
    counts, totals = plain_counts(docs)
    phrases = {k: a for k, a in counts.items() if a >= least and " " in k[1]}
    longer = Counter()
    for (lang, phrase), a in phrases.items():
        words = phrase.split(" ")
        if len(words) == 3:
            for part in (words[:2], words[1:]):
                longer[lang, " ".join(part)] = max(a, longer[lang, " ".join(part)])
    rows = {}
    for (lang, phrase), a in phrases.items():
        if 100 * longer[lang, phrase] >= 50 * a:
            continue
        words = phrase.split(" ")
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, " ".join(words[:k])], counts[lang, " ".join(words[k:])]
            cuts.append((10**6 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, phrase.encode(), l, r))
    return {
        (lang, rank, p.decode(), -a, l, r, totals[lang], -score)
        for lang, found in rows.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1)
    }


def rows_of(frame):
    got = [(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_query_equals_plain_counting(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("lang", "text").collect()
    assert rows_of(QUERIES["op12_collocations"](spark, small)) == plain_collocations(docs)


def made_docs(spark, seed=5, n=400):
    rng = np.random.default_rng(seed)
    vocabulary = np.array([f"W{i}" if i % 3 else f"é{i}" for i in range(40)])
    joints = np.array([" ", " ", " ", "  ", "\t", ". ", "!", "\r\n", " \x0b"])
    rows = []
    for i in range(n):
        words = vocabulary[np.minimum(rng.zipf(1.4, rng.integers(0, 30)) - 1, 39)]
        text = "".join(w + j for w, j in zip(words, rng.choice(joints, len(words))))
        rows.append((i if i % 7 else None, None if i % 11 == 0 else text, [None, "en", "und", "", "fr"][i % 5]))
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


@pytest.mark.parametrize("sampled", [0.0, 0.02, 1.0])
def test_every_sample_leads_to_the_same_counts(spark, sampled, monkeypatch):
    """Border failures are made good whatever the sample proposes, even if it proposes nothing."""
    rows, docs = made_docs(spark)
    passes = []
    counted = collocations.counted
    monkeypatch.setattr(collocations, "counted", lambda *a, **k: passes.append(1) or counted(*a, **k))
    got = collocations.frequent_phrases(docs, 10, "doc_id", "text", "lang", sampled=sampled).collect()
    counts, totals = plain_counts([(r[2], r[1]) for r in rows])
    want = {(lang, p, n) for (lang, p), n in counts.items() if n >= 10} | {(k, "", v) for k, v in totals.items() if v}
    assert len(got) == len(want) and {(r.lang, r.phrase, r.n) for r in got} == want
    assert len(passes) == {0.0: 4, 1.0: 2}.get(sampled, len(passes))


def test_crowded_bitmaps_change_nothing(spark, monkeypatch):
    rows, docs = made_docs(spark, seed=6, n=150)
    want = plain_collocations([(r[2], r[1]) for r in rows], 5, 7)
    monkeypatch.setattr(collocations, "PLACES", 64)
    assert rows_of(collocations.collocations(docs, least=5, top=7)) == want


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 64)
    text = "a b c. " * 40 + "one very long piece without an end " * 30 + "! d e f"
    docs = spark.createDataFrame([(1, text, "en")], "doc_id bigint, text string, lang string")
    want = plain_collocations([("en", text)])
    # Chunk sizes reach tasks with the function; here the cut is tried on its own as well.
    data = collocations._PLAIN[np.frombuffer(text.encode(), np.uint8)]
    parts = list(collocations._parts(data))
    assert len(parts) > 3 and np.array_equal(np.concatenate(parts), data) and all(p[-1] == 10 for p in parts[:-1])
    assert rows_of(collocations.collocations(docs)) == want


def test_many_kinds_of_words_in_one_part():
    """Numbers of phrases that do not fit 64 bits are made smaller first."""
    said = b"a b c a b c a b"
    every = np.full(1, ~np.uint64(0))
    wanted = {size: every for size in range(1, 46)}
    data = collocations._PLAIN[np.frombuffer(said, np.uint8)]
    got = {(s, p.as_py(), n) for s, ps, ns in collocations._text_counts(data, "en", wanted) for p, n in zip(ps, ns.tolist())}
    words = said.split()
    want = {(0, b"", 8)} | {
        (s, p, n) for s in range(1, 9) for p, n in Counter(b" ".join(words[i : i + s]) for i in range(9 - s)).items()
    }
    assert got == want


def test_codes_in_one_place_raise_counts_only():
    """A pass without bitmaps counts each phrase once; a later one leaves out what was counted."""
    data = collocations._PLAIN[np.frombuffer(b"a b a b, c a b d. d d d", np.uint8)]
    whole = {(s, c): n for s, cs, ns in collocations._code_counts(data, "en", None, None, 3) for c, n in zip(cs.tolist(), ns.tolist())}
    assert sorted(n for (s, _), n in whole.items() if s == 1) == [1, 3, 3, 4]
    assert sum(n for (s, _), n in whole.items() if s == 2) == 3 + 3 + 2
    none, every = np.zeros(1, np.uint64), np.full(1, ~np.uint64(0))
    first = list(collocations._code_counts(data, "en", {1: every, 2: none}, None, 3))
    second = list(collocations._code_counts(data, "en", {1: every, 2: every}, {1: every, 2: none}, 3))
    both = {(s, c): n for s, cs, ns in first + second for c, n in zip(cs.tolist(), ns.tolist())}
    assert both == whole and [len(n) for _, _, n in second] == [0, 5]


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 3_000_000_000_000_001, 3_000_000_000_000_007, 9_000_000_000_000_011
    counts = spark.createDataFrame(
        [("en", 2, "x y", a), ("en", 1, "x", l), ("en", 1, "y", r)], "lang string, size int, phrase string, n bigint"
    )
    assert collocations.scored(counts).first().score == 10**6 * a * a // (l * r)


def test_odd_tables(spark):
    rows = [(1, None, "en"), (None, "", None), (2, " \t\n.,", "en"), (3, "One  one\tONE one. one", None)] + [(4, "x y z", "fr")] * 12
    docs = spark.createDataFrame([r + (0, "-") for r in rows], "doc_id bigint, text string, lang string, n int, phrase string")
    assert rows_of(collocations.collocations(docs)) == plain_collocations([(r[2], r[1]) for r in rows])
    assert rows_of(collocations.collocations(docs, least=2)) == plain_collocations([(r[2], r[1]) for r in rows], 2)
    assert collocations.collocations(docs.limit(0)).count() == 0
