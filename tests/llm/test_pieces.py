"""Lossless round trips, exact sampling, and the model's own decoder."""

from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from smeltery.llm import pieces
from smeltery.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model():
    return pieces.load()


@pytest.fixture(scope="module")
def source():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def encode(model, text, key=0):
    return pieces.encode_group(model, [text], np.array([key], np.int64))[0]


HARD = ["", " ", "  a  b ", "▁", "a▁ b", "\n\t\r\0x", "é😀漢字́", "<s></s><unk><0x0A>", "x" * 5000, " " * 300, "word " * 2000, "\U0010ffff"]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts_come_back(model, source, text):
    for key in range(3):
        ids, bounds = pieces.encode_group(model, [text], np.array([key]))
        assert pieces.decode_group(model, ids, bounds) == [text.encode()]
    if "▁" not in text and "\0" not in text:
        assert source.decode(ids.tolist()) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=6))
def test_any_texts_come_back(texts):
    model = test_any_texts_come_back.__dict__.setdefault("model", pieces.load())
    ids, bounds = pieces.encode_group(model, texts, np.arange(len(texts)))
    assert pieces.decode_group(model, ids, bounds) == [t.encode() for t in texts]


def test_company_does_not_matter(model):
    texts = ["one two three", "", None, "two three one", "deux trois"]
    together, bounds = pieces.encode_group(model, texts, np.arange(5))
    for i, text in enumerate(texts):
        assert (encode(model, text, i) == together[bounds[i] : bounds[i + 1]]).all()


def segmentations(source, text):
    """All segmentations of a text with their weights."""
    known = {source.id_to_piece(i).replace("▁", " "): i for i in range(source.vocab_size()) if i > 258}
    found = [((), 0.0, 0)]
    while found:
        done, weight, at = found.pop()
        if at == len(text):
            yield done, weight
        for end in range(at + 1, len(text) + 1):
            i = known.get(text[at:end])
            if i is not None:
                found.append(((*done, i), weight + max(source.get_score(i), -1e6) * pieces.SHARPNESS, end))


def test_draws_follow_the_exact_distribution(model, source):
    text, n = "house", 20_000
    ways = dict(segmentations(source, " " + text))
    chance = {k: np.exp(w) for k, w in ways.items()}
    total = sum(chance.values())
    ids, bounds = pieces.encode_group(model, [text] * n, np.arange(n) * 7919)
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:]))
    assert set(seen) <= set(ways)
    for way, c in chance.items():
        p = c / total
        assert abs(seen[way] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-3


def test_query_is_lossless(spark, small):
    rows = QUERIES["op10_sampled_pieces"](spark, small).collect()
    assert len(rows) == spark.read.parquet(f"{small}/documents.parquet").count()
    assert all(r.lossless for r in rows)
    again = QUERIES["op10_sampled_pieces"](spark, small).collect()
    assert sorted(rows) == sorted(again)


def test_odd_rows(spark, model):
    rows = [(1, None, 0), (None, "a b", 1), (2, "", 2), (2, "same", 3), (2, "same", 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, piece_ids int")
    out = pieces.decode(pieces.encode(docs, model), model).collect()
    assert [(r.doc_id, r.text) for r in out] == [r[:2] for r in rows]
    assert [r.decoded for r in out] == [r[1] for r in rows]
    assert out[3].piece_ids == out[4].piece_ids and out[2].piece_ids == b"" and out[0].piece_ids is None
    assert pieces.encode(docs.limit(0), model).count() == 0
