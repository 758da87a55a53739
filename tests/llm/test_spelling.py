"""Spelling variants against a plain deletion and replacement search over whole texts."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from smeltery.llm import spelling
from smeltery.llm.queries import QUERIES


def plain_words(docs):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def apart_by_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_near(words):
    """By patterns with one letter left out; every pair is checked letter by letter."""
    meet = defaultdict(set)
    for w in words:
        meet["=", w].add(w)
        for i in range(len(w)):
            meet["*", w[:i], w[i + 1 :]].add(w)
            meet["=", w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in meet.values():
        for a in group:
            near[a] |= {b for b in group if a != b and apart_by_one(a, b)}
    return near


def plain_variants(words):
    near = plain_near(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def rows_of(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def test_query_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    want = plain_variants(plain_words(docs))
    got = rows_of(QUERIES["op11_spelling_variants"](spark, small))
    assert got == want
    assert sum(v[0] is not None for v in want.values()) > 20


def made_words(seed, count, letters="abcé", shortest=1, longest=9):
    rng = np.random.default_rng(seed)
    return sorted({"".join(rng.choice(list(letters), rng.integers(shortest, longest + 1))) for _ in range(count)})


def test_index_finds_exactly_the_words_one_letter_apart(monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 128)
    monkeypatch.setattr(spelling, "BATCH", 50)
    words = made_words(1, 900, longest=6)
    got = {}
    for a, b, place in spelling.near_pairs(words):
        for i, j, p in zip(a, b, place):
            assert (i, j) not in got
            got[i, j] = p
    want = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if apart_by_one(a, b)}
    assert set(got) == want and len(want) > 1_000
    for (i, j), p in got.items():
        assert words[i][:p] == words[j][:p] and words[i][p : p + 1] != words[j][p : p + 1]


@pytest.mark.parametrize("limits", [{}, {"shard_words": 40, "crowd": 10}])
def test_shards_find_each_pair_once(spark, limits):
    """Also where shards are so crowded that pieces are halved down to one letter."""
    words = {w: 1 + i * 7919 % 50 for i, w in enumerate(made_words(2, 700))}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = {r.word: (r.n_near, r.near, r.near_n) for r in spelling.near_words(frame, **limits).collect()}
    want = {}
    for w, near in plain_near(words).items():
        if near:
            best = min(near, key=lambda v: (-words[v], v))
            want[w] = (len(near), best, words[best])
    assert got == want


def test_crowded_shards_are_halved(spark):
    words = made_words(2, 700)
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    rows = spelling.shards(frame, shard_words=40, crowd=10)
    assert rows.where("hi - lo = 1 and la >= 8").count() > 0


def test_chains_end_at_the_last_form(spark):
    links = [(f"w{i:02}", f"w{i + 1:02}") for i in range(21)] + [("x", "w05"), ("y", "z")]
    frame = spark.createDataFrame(links, "word string, form string")
    got = {r.word: r.root for r in spelling.last_of_chains(frame).collect()}
    assert got == {f"w{i:02}": "w21" for i in range(21)} | {"x": "w21", "y": "z"}
    assert spelling.last_of_chains(frame.limit(0)).count() == 0


def test_odd_tables(spark):
    long = "x" * 3_000
    rows = [
        (1, "colour " * 30 + "color " * 40 + "COLOUR. colours-colours colours colours colours", "a"),
        (1, "colour " * 30, "b"),
        (None, "colour " * 5 + "ÀÉÎÕÜß " * 5 + "àéîõüß " * 5, "c"),
        (2, None, "d"),
        (3, "", "e"),
        (4, f"{long} {long[:-1]}y " * 6 + "short shor " * 40, "f"),
        (5, "colour " * 200_000, "g"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, word string")
    want = plain_variants(plain_words([r[:2] for r in rows]))
    assert rows_of(spelling.variants(docs)) == want
    assert long in want and want["colours"][0] == "colour"
    assert spelling.variants(docs.limit(0)).count() == 0


def test_losses_follow_the_hash():
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(5_000)]
    changed = [w for w in words if spelling.with_losses("7", w) != w]
    assert changed == [w for w in words if zlib.crc32(f"7:{w}".encode()) % 199 == 0] and changed
