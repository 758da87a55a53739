"""Quality scores: statistics against plain counting, trees against a plain walk, held-out labels."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from smeltery.llm import quality
from smeltery.llm.queries import QUERIES

TEXTS = [
    None,
    "",
    " \t\n",
    "One",
    "one two one two one two.\n\none two!! $$$ é\n",
    "SHOUT!! SHOUT!! again again again | x | y",
    "élan ünd ñ " * 50 + "\n" + "line\n" * 20,
]


def plain(text):
    data = (text or "").encode()
    words = data.split()
    out = {"log_bytes": math.log1p(len(data)), "log_words": math.log1p(len(words))}
    counts = Counter(data)
    out["entropy"] = -sum(c / len(data) * math.log2(c / len(data)) for c in counts.values())
    out["share_upper"] = sum(65 <= c <= 90 for c in data) / max(1, len(data))
    out["share_inner"] = sum(0x80 <= c < 0xC0 for c in data) / max(1, len(data))
    n = max(1, len(words))
    out["word_mean"] = sum(map(len, words)) / n
    out["word_longest"] = math.log1p(max(map(len, words), default=0))
    out["words_one"] = sum(len(w) == 1 for w in words) / n
    out["words_distinct"] = len(set(words)) / n
    out["word_top"] = max(Counter(words).values(), default=0) / n
    out["words_again"] = sum(a == b for a, b in zip(words, words[1:])) / n
    out["phrases_distinct"] = len(set(zip(words, words[1:], words[2:]))) / max(1, len(words) - 2)
    lines = data.split(b"\n")
    lines = [x + b"\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
    out["log_lines"] = math.log1p(len(lines))
    out["lines_distinct"] = len(set(lines)) / max(1, len(lines))
    return out


def test_statistics_equal_plain_counting():
    rows = quality.statistics(pa.array(TEXTS, pa.string()))
    assert rows.shape == (len(TEXTS), len(quality.STATISTICS)) and np.isfinite(rows).all()
    for text, row in zip(TEXTS, rows):
        got = dict(zip(quality.STATISTICS, row))
        for name, value in plain(text).items():
            assert got[name] == pytest.approx(value, abs=1e-9), (text, name)


def test_statistics_do_not_depend_on_the_company():
    together = quality.statistics(pa.array(TEXTS, pa.string()))
    alone = np.concatenate([quality.statistics(pa.array([t], pa.string())) for t in TEXTS])
    assert np.array_equal(together, alone)


def plain_walk(model, row):
    total = model.base
    for node in model.roots:
        while model.left[node] != node:
            goes_left = row[model.feature[node]] <= model.threshold[node]
            node = model.left[node] if goes_left else model.right[node]
        total += model.value[node]
    return 1 / (1 + math.exp(-total))


def test_flat_trees_score_like_a_plain_walk():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(600, 5))
    rows[:, 4] = np.round(rows[:, 4])
    labels = ((rows[:, 0] > 0) ^ (rows[:, 4] > 0)).astype(float)
    model = quality.fit(rows, labels)
    got = model.score(rows)
    assert np.allclose(got, [plain_walk(model, row) for row in rows], rtol=0, atol=1e-12)
    assert ((got > 0.5) == labels).mean() > 0.97


def test_first_split_is_the_best_of_all():
    """Against a search over every threshold with sums from scratch."""
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 12, (200, 3)).astype(float)
    labels = (rows[:, 1] + rng.normal(size=200) > 6).astype(float)
    model = quality.fit(rows, labels)
    p = 1 / (1 + math.exp(-model.base))
    gradient, weight = p - labels, p * (1 - p)

    def worth(mask):
        return gradient[mask].sum() ** 2 / (weight * mask.sum() + quality.L2)

    best = max(
        (worth(rows[:, f] <= t) + worth(rows[:, f] > t), -f, -t)
        for f in range(3)
        for t in np.unique(rows[:, f])[:-1] + 0.5
    )
    root = model.roots[0]
    assert (-best[1], -best[2]) == (model.feature[root], model.threshold[root])


def test_held_out_labels_are_predicted(spark, small):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    rows = QUERIES["op13_quality"](spark, small).collect()
    assert len(rows) == 1_000 and len({r.doc_id for r in rows}) == 1_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) >= 0.95
    good = [p for q, p in held if q == 1]
    assert sum(good) / len(good) >= 0.98


def test_a_model_looks_at_nothing_but_texts(spark):
    """Held-out labels, other columns and the order of rows leave every score as it is."""
    rows = [(i, "fine words here and there " * (1 + i % 3) if i % 2 else "$$$ ### &&&" * (1 + i % 4)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    again = quality.train(docs.repartition(5), labels.repartition(3))
    assert all(np.array_equal(getattr(model, f), getattr(again, f)) for f in ("feature", "threshold", "left", "value"))
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert all((got[i] > 0.5) == bool(i % 2) for i in range(80))


def test_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, 5.0), (1, "", 5.0), (None, "words " * 200_000, 5.0), (2, "a b", 5.0)],
        "doc_id bigint, text string, score double",
    )
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = quality.score(docs, quality.train(docs, none)).collect()
    assert [r.score for r in got] == [0.5] * 4 and got[0].__fields__ == ["doc_id", "score"]
    one = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 0), (9, 0), (2, None), (2, 7)], "doc_id bigint, quality int")
    # Learnt from: both rows of key 1, the row of key 2.
    scores = [r.score for r in quality.score(docs, quality.train(docs, one)).collect()]
    assert scores == pytest.approx([4 / 5] * 4)
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), one)).count() == 0


def test_the_sample_is_bounded_when_a_key_repeats(spark, monkeypatch):
    docs = spark.range(500).selectExpr("1L as doc_id", "concat('text ', id) as text")
    labels = spark.createDataFrame([(1, 1), (1, 0)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, labels: seen.append((rows.shape, set(labels))))
    quality.train(docs, labels, sample=50)
    assert seen == [((50, len(quality.STATISTICS)), {0.0, 1.0})]
