"""Each stage against brute force on its own input, then the whole."""

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as pipeline
from smeltery.llm import pieces
from test_contamination import brute as leaks
from test_pii import plain as personal
from test_simhash import plain_fingerprint, plain_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, small, tmp_path_factory):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = [docs.collect()]
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        found.append(docs.collect())
    return found


def keys(rows):
    return sorted(r.doc_id for r in rows)


def test_language_keeps_what_has_letters(steps):
    before, after = steps[0], steps[1]
    kept = set(keys(after))
    lost = [r for r in before if r.doc_id not in kept]
    assert all(not any(c.isalpha() for c in r.text or "") for r in lost)
    assert {r.doc_id: tuple(r) for r in after}.items() <= {r.doc_id: tuple(r) for r in before}.items()


def test_one_of_each_group_stays(steps):
    groups = plain_groups({r.doc_id: plain_fingerprint(r.text) for r in steps[1]})
    assert keys(steps[2]) == sorted(k for k, g in groups.items() if k == g)


def test_leaks_go_and_others_stay(spark, small, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    held = {k for k, _ in leaks([(r.doc_id, r.text) for r in steps[2]], items)}
    assert keys(steps[3]) == sorted(set(keys(steps[2])) - held) and held


def test_personal_data_is_gone(steps):
    assert keys(steps[4]) == keys(steps[3])
    before = {r.doc_id: r for r in steps[3]}
    for r in steps[4]:
        assert not [s for s in personal(r.text) if s[0] in ("email", "card")]
        assert r.n_chars == len(r.text)
        if not personal(before[r.doc_id].text) and "password" not in before[r.doc_id].text:
            assert r.text == before[r.doc_id].text or "[" in r.text


def test_pieces_come_back(steps):
    model = pieces.load()
    assert keys(steps[5]) == keys(steps[4]) and all(r.lossless for r in steps[5])
    for r in steps[5][:50]:
        ids = np.frombuffer(r.piece_ids, "<i4")
        assert len(ids) == r.n_pieces
        assert pieces.decode_group(model, ids, np.array([0, len(ids)])) == [r.text.encode()]
    assert steps[5][0].__fields__[:5] == COLUMNS


def test_run_equals_the_stages(spark, small, steps):
    assert sorted(map(tuple, pipeline.run(spark, small).collect())) == sorted(map(tuple, steps[5]))


def test_odd_rows(spark, tiny):
    words = "the of and with that this from have been which their would there".split()
    text = " ".join(words * 3)
    rows = [
        (None, text, None, None, None, 0), (1, text, "en", "s", 1, 1), (1, text, "en", "s", 1, 1), (2, None, "en", "s", 0, 2),
        (3, "", "en", "s", 0, 3), (4, " ".join(words[::-1]) + " me@x.org", "en", None, 9, 4), (5, "12 !", "en", "s", 4, 5),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, fingerprint int"
    docs = spark.createDataFrame(rows, schema).withColumnsRenamed({}).selectExpr("*", "1 as score", "'p' as piece_ids")
    for _, stage in pipeline.STAGES:
        empty = stage(spark, docs.limit(0), tiny)
        assert empty.count() == 0
        docs = spark.createDataFrame(stage(spark, docs, tiny).toArrow())
    got = {r.doc_id: r for r in docs.collect()}
    assert set(got) == {1, 4} and docs.count() == 2
    assert got[4].text.endswith("[EMAIL]") and got[4].n_chars == len(got[4].text)
    assert got[1].piece_ids == "p" and got[1].score == 1 and got[1].fingerprint == 1 and got[1].lossless
    assert isinstance(docs.toArrow(), pa.Table)


def test_without_labels_and_counts_nothing_is_lost(spark, tiny):
    rows = [(i, f"some words that stay as they are {i} me@x.org", None) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert sorted(map(tuple, pipeline.language(spark, docs, tiny).collect())) == rows
    found = pipeline.personal_data(spark, docs, tiny)
    assert found.columns == docs.columns
    assert sorted(r.text for r in found.collect()) == [f"some words that stay as they are {i} [EMAIL]" for i in range(5)]
