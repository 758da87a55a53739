"""Word and byte deduplication against brute force."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from smeltery.llm import anchors, repeats, substrings
from smeltery.llm.queries import QUERIES


def plain(docs, window, split, join):
    """By document: units, removed flags, digest of what stays."""
    seen, out = {}, []
    docs = [(k, split(t or "")) for k, t in docs]
    for key, units in sorted(docs, key=lambda d: d[0]):
        removed = np.zeros(len(units) + 1, int)
        for i in range(len(units) - window + 1):
            s = units[i : i + window] if isinstance(units, bytes) else tuple(units[i : i + window])
            if s in seen:
                removed[i] += 1
                removed[min(i + window, len(units))] -= 1
            else:
                seen[s] = i
        gone = np.cumsum(removed[: len(units)]) > 0
        kept = join(u for u, g in zip(units, gone) if not g)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) > 0).sum())
        out.append((key, len(units), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def words(t):
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", t)]


def by_words(docs, window=20):
    return [(k, n, r, h) for k, n, r, _, h in plain(docs, window, words, b" ".join)]


def by_bytes(docs, window=100):
    return plain(docs, window, str.encode, lambda us: bytes(us))


def read(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def test_word_query_equals_brute_force(spark, small):
    got = sorted(tuple(r) for r in QUERIES["op1_substring_dedup"](spark, small).collect())
    assert got == by_words(read(spark, small))


def test_byte_query_equals_brute_force(spark, tiny):
    got = sorted(tuple(r) for r in QUERIES["op9_maximal_repeats"](spark, tiny).collect())
    assert got == by_bytes(read(spark, tiny))


@pytest.fixture(scope="module")
def tangled():
    """Few units, many repeats: nested, overlapping, periodic, shared by most documents."""
    rng = np.random.default_rng(5)
    passages = ["".join(rng.choice(list("ab é\0"), rng.integers(5, 60))) for _ in range(6)]
    docs = []
    for k in range(80):
        parts = [passages[rng.integers(6)] if rng.random() < 0.6 else "".join(rng.choice(list("abc "), rng.integers(0, 40))) for _ in range(rng.integers(0, 7))]
        docs.append((k, " ".join(parts)))
    docs += [(80, "a" * 300), (81, "a " * 200), (82, "a" * 300), (83, None), (84, ""), (85, "ab" * 200)]
    return docs


def test_crowded_anchors_are_split(spark):
    rng = np.random.default_rng(12)
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [(k, " ".join(map(str, rng.integers(0, 9999, 30))) + f" {passage} " + " ".join(map(str, rng.integers(0, 9999, 30)))) for k in range(400)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    own = anchors.documents(frame, "doc_id", "text")
    for cut, brute, module in (
        (anchors.Cut(True, 20, 8), by_words, substrings), (anchors.Cut(False, 100, 32), by_bytes, repeats)
    ):
        split = anchors.crowded_anchors(own.once, cut)
        assert 0 < len(split) < 20
        kinds = anchors.settled(anchors.segments(own.once, cut)).groupBy("kind", "key").count()
        assert kinds.where("kind = 3 and count >= 192").isEmpty()
        assert sorted(tuple(r) for r in module.deduplicate(frame).drop("kept").collect()) == brute(docs)


@pytest.mark.parametrize("window, gram", [(4, 2), (5, 5), (7, 3), (20, 8)])
def test_tangled_words(spark, tangled, window, gram):
    frame = spark.createDataFrame(tangled, "doc_id bigint, text string").repartition(5)
    got = substrings.deduplicate(frame, window=window, gram=gram).drop("kept")
    assert sorted(tuple(r) for r in got.collect()) == by_words(tangled, window)


@pytest.mark.parametrize("window, gram", [(8, 3), (12, 12), (33, 5)])
def test_tangled_bytes(spark, tangled, window, gram):
    frame = spark.createDataFrame(tangled, "doc_id bigint, text string").repartition(5)
    got = repeats.deduplicate(frame, window=window, gram=gram).drop("kept")
    assert sorted(tuple(r) for r in got.collect()) == by_bytes(tangled, window)


def test_nulls_repeated_rows_and_clashing_names(spark):
    long = " ".join(map(str, range(60)))
    rows = [(None, long, 0), (1, long, 0), (1, long, 0), (1, "x " + long, 1), (2, None, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, first int")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substrings.deduplicate(docs).collect()), key=str)
    # Of the two documents with key 1, both come after the one without a key.
    assert got == sorted([(None, 60, 0), (1, 60, 60), (1, 60, 60), (1, 61, 60), (2, 0, 0)], key=str)
    assert substrings.deduplicate(docs.limit(0)).count() == 0
    assert repeats.deduplicate(docs.limit(0)).count() == 0


def test_automaton_matches_what_was_added():
    rng = np.random.default_rng(2)
    automaton = substrings.SuffixAutomaton()
    texts = [rng.integers(0, 3, 30).tolist() for _ in range(20)]
    for i, text in enumerate(texts):
        known = [tuple(t[a:b]) for t in texts[:i] for a in range(30) for b in range(a + 1, 31)]
        known = set(known) | {()}
        want = [max(n for n in range(j + 2) if tuple(text[j + 1 - n : j + 1]) in known) for j in range(30)]
        assert automaton.statistics(text) == want
        automaton.add(text)


def test_all_places_of_each_repeat():
    texts = [b"xxabcdefyy", b"zabcdefz", b"abcdeq", b"qabcdefyy"]
    segments = [(0, i, 0, 0, len(t) - 3, t) for i, t in enumerate(texts)]
    got = sorted((n, sorted(zip(o.tolist(), s.tolist()))) for n, o, s in repeats.maximal_repeats(segments, 4))
    assert got == [(5, [(0, 2), (1, 1), (2, 0), (3, 1)]), (6, [(0, 2), (1, 1), (3, 1)]), (8, [(0, 2), (3, 1)])]


def test_contents_that_share_32_bits_stay_apart(monkeypatch):
    one = np.array([5, 5], np.uint64)
    found = (np.array([0, 1]), np.zeros(2, np.int64), np.ones(2, np.int64), one, np.array([7, 7 + 2**32], np.uint64))
    monkeypatch.setattr(anchors, "cut_segments", lambda *_: found)

    class Frame:
        mapInArrow = staticmethod(lambda run, schema: run)

    run = anchors._held_segments(Frame, anchors.Cut(True, 20, 8), one[:0], anchors._collapse, anchors.SEGMENT)
    batch = pa.RecordBatch.from_pydict({"rank": [1, 2], "twin": [0, 0], "text": ["a", "b"]})
    kinds = [k for part in run(iter([batch])) for k in part.column(0).to_pylist()]
    assert kinds == [anchors.SINGLE, anchors.SINGLE]
