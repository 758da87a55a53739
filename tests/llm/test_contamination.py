"""Leaks against brute force over all documents and items."""

import numpy as np
from pyspark.sql import functions as F

from smeltery.llm import contamination as c
from smeltery.llm.queries import QUERIES


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def holds(item, read):
    """The rule itself, over all stretches of a passage."""
    n = len(item.words)
    if n < c.WHOLE:
        return any(read[i : i + n] == item.words for i in range(len(read)))
    if c.common_subsequence(item.masks, n, read) < c.SIMILAR * n:
        return False
    for start in range(len(read)):
        some = read[start : start + c.SPAN * n]
        share = c.common_subsequence(item.masks, n, some) / n
        answer = c.common_subsequence(item.answer_masks, len(item.answer), some) / len(item.answer)
        if share >= c.SAME or (share >= c.SIMILAR and answer >= c.SIMILAR):
            return True
    return False


def brute(docs, items):
    """Pairs held by the rule, over the same passages, without retrieval."""
    made = [m for i, t in items if (m := c.make_item(i, t or ""))]
    block = max(32, -(-max(len(m.words) for m in made) // 2))
    held = set()
    for k, text in docs:
        words = c.hashes_of(c.plain_words(text or "")).tolist()
        for start in range(0, len(words), block):
            read = words[start : start + 3 * block]
            held |= {(k, m.item_id) for m in made if holds(m, read)}
    return held


def test_subsequence_length():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 30)).tolist(), rng.integers(0, 5, rng.integers(0, 40)).tolist()
        assert c.common_subsequence(c._masks(a), len(a), b) == plain_lcs(a, b)


def test_query_equals_brute_force(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in QUERIES["op6_benchmark_leaks"](spark, small).collect()}
    want = brute(docs, items)
    assert got == want and len(got) > 5


def test_paraphrases_and_odd_rows(spark):
    rng = np.random.default_rng(8)
    vocabulary = ["".join(rng.choice(list("abcdefghijk"), 5)) for _ in range(3000)]
    say = lambda n: [vocabulary[i] for i in rng.integers(0, 3000, n)]
    items = [(i, say(30)) for i in range(12)]
    docs = [(None, None), (1, ""), (2, " ".join(say(500)))]
    for i, words in items:
        changed = [w if rng.random() > 0.15 else say(1)[0] for w in words]
        docs.append((100 + i, " ".join(say(150) + [w.upper() + "," for w in changed] + say(90))))
        docs.append((200 + i, " ".join(say(40) + words[:10] + say(40))))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as item_id")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(50, None), (51, " ")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in c.find_leaks(frame, bench).collect()}
    assert got == brute(docs, [(i, " ".join(w)) for i, w in items]) and len(got) >= 10
    assert c.find_leaks(frame.limit(0), bench).count() == 0
    assert c.find_leaks(frame, bench.limit(0)).count() == 0


def test_basis_holds_the_matrix():
    rng = np.random.default_rng(6)
    low = rng.normal(size=(60, 8))
    test = rng.normal(size=(60, 12))
    basis = c.latent_basis(low @ (low.T @ test), test)
    assert basis.shape == (60, 8) and np.allclose(basis @ (basis.T @ low), low, atol=1e-6)


def brute_by_length(docs, items):
    """Pairs held, with passages for items of like length."""
    classes = {}
    for i, t in items:
        classes.setdefault(c.half_longest(len(c.plain_words(t))), []).append((i, t))
    held = set()
    for block, own in classes.items():
        made = [c.make_item(i, t) for i, t in own]
        for k, text in docs:
            words = c.hashes_of(c.plain_words(text)).tolist()
            for start in range(0, len(words), block):
                read = words[start : start + 3 * block]
                held |= {(k, m.item_id) for m in made if holds(m, read)}
    return held


def test_all_items_in_a_row_and_mixed_lengths(spark):
    rng = np.random.default_rng(12)
    vocabulary = ["".join(rng.choice(list("abcdefghijk"), 5)) for _ in range(2000)]
    say = lambda n: " ".join(vocabulary[i] for i in rng.integers(0, 2000, n))
    sizes = [15, 18, 22, 40, 64, 65, 130, 400, 1000] + [16] * 60
    items = [(i, say(n)) for i, n in enumerate(sizes)]
    docs = [(1, " ".join(t for _, t in items)), (2, " ".join(t for _, t in items[::-1])), (3, say(600))]
    docs += [(10 + i, f"{say(100)} {t} {say(70)}") for i, t in items]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in c.find_leaks(frame, bench).collect()}
    assert got == brute_by_length(docs, items)
    assert got >= {(d, i) for i, _ in items for d in (1, 2, 10 + i)}
    assert [r.doc_id for r in c.without_leaks(frame, bench).collect()] == [3]


def test_paraphrases_of_the_rare_words(spark):
    rng = np.random.default_rng(14)
    common = ["".join(rng.choice(list("abcdefghijk"), 4)) for _ in range(60)]
    new = iter(f"new{i}" for i in range(100_000))
    say = lambda n: [common[i] for i in rng.integers(0, 60, n)]
    items, docs = [], [(i, " ".join(say(300))) for i in range(60)]
    for i in range(10):
        rare = {int(k) for k in rng.choice(22, 11, replace=False)}
        words = [next(new) if k in rare else w for k, w in enumerate(say(28))]
        items.append((i, " ".join(words)))
        # All rare words replaced: 17 of 28 are left, with the answer.
        docs.append((100 + i, " ".join(say(50) + [next(new) if k in rare else w for k, w in enumerate(words)] + say(50))))
        docs.append((200 + i, " ".join(say(50) + words + say(50))))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in c.find_leaks(frame, bench).collect()}
    assert got == brute(docs, items)
    assert got >= {(d + i, i) for i in range(10) for d in (100, 200)}


def test_short_items_leave_clean_documents_alone(spark):
    items = [
        (1, "yes"), (2, "What is the capital of France?"), (3, "of the in"), (4, "the first of its own kind here"),
        (5, "Name the river that runs through the old town and then on to the sea"),
    ]
    spread = "name {0} the {0} river {0} that {0} runs {0} through {0} the {0} old {0} town {0} and {0} then"
    docs = [
        (1, "Yes, of the in and yes again"),
        (2, "what is left of the plan, is the new capital budget of the region of France"),
        (3, "They asked: what is THE capital of France, and went on"),
        (4, "the first house, of its own sort and kind, here"),
        (5, spread.format("some more words here")),
        (6, "please name the river that runs through the very old town and on then to the sea"),
        (7, " ".join(["word"] * 61) + " what is the capital of france " + " ".join(["word"] * 300)),
    ]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in c.find_leaks(frame, bench).collect()}
    assert got == brute(docs, items) == {(3, 2), (6, 5), (7, 2)}
    assert sorted(r.doc_id for r in c.without_leaks(frame, bench).collect()) == [1, 2, 4, 5]
    few = bench.where("item_id in (1, 3)")
    assert c.find_leaks(frame, few).count() == 0 and c.without_leaks(frame, few).count() == len(docs)


def test_best_stretch_equals_all_stretches():
    rng = np.random.default_rng(31)
    for _ in range(300):
        item = c.make_item(0, " ".join(f"w{i}" for i in rng.integers(0, 12, rng.integers(10, 25))))
        read = c.hashes_of(c.plain_words(" ".join(f"w{i}" for i in rng.integers(0, 30, 96)))).tolist()
        for at, word in zip(sorted(rng.choice(96, len(item.words), replace=False)), item.words):
            if rng.random() < 0.85:
                read[at] = word
        assert (c.shares_in(item, read) is not None) == holds(item, read)


def test_cosine_retrieves_and_words_audit(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    found = {(r.doc_id, r.item_id): r for r in c.find_leaks(docs, bench).collect()}
    assert len(found) > 5 and all(r.retrieved for r in found.values())
    # With a bound that nothing reaches, the audit still reads whatever counts, and says so.
    monkeypatch.setattr(c, "_least_cosine", lambda *_: 2.0)
    audited = {(r.doc_id, r.item_id): r for r in c.find_leaks(docs, bench).collect()}
    assert audited.keys() == found.keys() and not any(r.retrieved for r in audited.values())
    # Blocks of one item each give the same pairs.
    monkeypatch.undo()
    monkeypatch.setattr(c, "BLOCK_WORDS", 1)
    few = bench.where(F.col("item_id").isin(sorted({i for _, i in found})[:4]))
    some = {(r.doc_id, r.item_id) for r in c.find_leaks(docs, few).collect()}
    assert some == {k for k in found if k[1] in {r.item_id for r in few.collect()}}


def test_least_cosine_takes_the_lightest_words():
    latent, count = np.array([[3.0, 0.0], [1.0, 0.0], [0.0, 2.0]]), np.array([1, 2, 1])
    rarity = np.array([3.0, 1.0, 2.0])
    # Both of the lightest term, then the next lightest one.
    got = c._least_cosine(latent, count, rarity, 3, np.array([1.0, 0.0]), 1.0)
    assert abs(got - 2 / np.sqrt(4 + 4 + 1)) < 1e-12
