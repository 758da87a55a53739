"""Held-out accuracy, whole texts, and defined results for odd rows."""

import zlib

import numpy as np

from smeltery.llm import langid
from smeltery.llm.queries import QUERIES


def test_held_out_accuracy(spark, small):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op3_language"](spark, small).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    right = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert np.mean(right) > 0.97, np.mean(right)


def test_windows_cover_every_byte():
    data = np.arange(1, 1501, dtype=np.int64).astype(np.uint8)
    bounds = np.array([0, 0, 300, 300 + 256, 1500])
    windows, owner, sizes = langid.cut(data, bounds)
    for i in range(4):
        joined = np.concatenate([w[:s] for w, s, o in zip(windows, sizes, owner) if o == i] or [data[:0]])
        assert (joined == data[bounds[i] : bounds[i + 1]]).all()


def test_gradients_by_differences():
    rng = np.random.default_rng(3)
    windows, labels = rng.integers(0, 9, (5, 40)).astype(np.uint8), np.array([0, 1, 2, 0, 1])
    mask = langid._filter_mask()
    p = {
        "embedding": rng.normal(size=(256, langid.DEPTH)), "filters": rng.normal(size=mask.shape) * mask,
        "offsets": rng.normal(size=mask.shape[1]), "weights": rng.normal(size=(mask.shape[1], 3)), "bias": rng.normal(size=3),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    ones = np.ones(5, np.float32)
    grads = langid._gradients(p, ("a", "b", "c"), windows, labels, ones)

    def loss():
        out = langid.Network(("a", "b", "c"), **p).log_probabilities(windows)
        return -out[np.arange(5), labels].astype(float).mean()

    for name in p:
        at = np.unravel_index(np.abs(grads[name]).argmax(), p[name].shape)
        kept = p[name][at]
        p[name][at] = kept + 1e-2
        up = loss()
        p[name][at] = kept - 1e-2
        down = loss()
        p[name][at] = kept
        assert abs((up - down) / 2e-2 - grads[name][at]) < 0.05 * max(1, abs(grads[name][at]))


def test_odd_rows(spark):
    rows = [(1, None, "x", 0.5), (None, "", "x", 0.5), (3, "12 34 !", "x", None), (4, "the and of " * 40_000, "x", 1.0), (4, "é", None, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    got = langid.predict(docs, langid.train(docs)).collect()
    assert sorted((r.lang_pred, r.score > 0) for r in got) == [("und", False)] * 3 + [("x", True)] * 2
    assert [r.lang_pred for r in langid.predict(docs, None).collect()] == ["und"] * 5
    assert langid.train(docs.limit(0)) is None and langid.predict(docs.limit(0), None).count() == 0


def test_sample_is_bounded_and_sees_every_text(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "fit", lambda windows, labels, languages: seen.append((windows, labels)))
    words = [f"word{i} and more of it" for i in range(400)]
    # Half of the rows share a null key, a quarter are one row again and again.
    rows = [(None, w, "x") for w in words[:200]] + [(7, "the same row", "x")] * 100
    rows += [(10 + i, w, "x") for i, w in enumerate(words[200:300])] + [(900, "autre", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    langid.train(docs, docs_per_language=30)
    langid.train(docs.repartition(13), docs_per_language=30)
    assert (seen[0][1] == 0).sum() == 30 and (seen[0][1] == 1).sum() == 1
    assert all(np.array_equal(a, b) for a, b in zip(*seen))
    langid.train(docs, docs_per_language=1000)
    assert (seen[2][1] == 0).sum() == 301
