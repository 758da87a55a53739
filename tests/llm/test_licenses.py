"""License matches against containment over every window, without retrieval."""

import pytest

from smeltery.llm import licenses, words
from smeltery.llm.queries import QUERIES


def shingles(text):
    w = words.plain_words(text or "")
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(docs):
    found = {}
    templates = [(n, set(shingles(t))) for n, t in licenses.TEMPLATES]
    for key, text in docs:
        own = shingles(text)
        for name, wanted in templates:
            step = 1 << (len(wanted) - 1).bit_length()
            for start in range(0, len(own), step):
                held = len(wanted.intersection(own[start : start + 2 * step])) / len(wanted)
                if held >= 0.8:
                    found[key, name] = max(found.get((key, name), 0), held)
    return {(k, n, round(h, 9)) for (k, n), h in found.items()}


def test_query_equals_brute_force(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = {(r.doc_id, r.license, round(r.containment, 9)) for r in QUERIES["op5_license_matches"](spark, small).collect()}
    assert got == brute(docs) and got


def test_changed_texts_and_odd_rows(spark):
    filler = " ".join(f"w{i}" for i in range(300))
    docs = [(None, None), (1, ""), (2, "MIT License")]
    for i, (_, text) in enumerate(licenses.TEMPLATES):
        parts = text.split()
        docs.append((100 + i, f"{filler}\n{text.upper()} {filler}"))
        docs.append((200 + i, f"{filler[:i]} {' '.join(parts[: len(parts) - 1])} zzz {filler}"))
        docs.append((300 + i, " ".join(p for j, p in enumerate(parts) if j % 4)))
    docs += [(7, filler * 50 + " Released under the MIT License"), (7, filler * 50 + " Released under the MIT License")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "'x' as license")
    got = [(r.doc_id, r.license, round(r.containment, 9)) for r in licenses.find(frame).collect()]
    assert set(got) == brute(docs) and {(100 + i, n) for i, (n, _) in enumerate(licenses.TEMPLATES)} <= {g[:2] for g in got}
    assert sum(g[0] == 7 for g in got) == 2
    assert licenses.find(frame.limit(0)).count() == 0


def test_bands_give_the_certainty():
    for group in licenses.classes_of(licenses.TEMPLATES):
        least = min(licenses.least_similarity(len(s), group.window) for _, s in group.members)
        assert (1 - least**licenses.ROWS) ** group.bands <= 1 - licenses.CERTAINTY + 1e-12
    with pytest.raises(ValueError):
        licenses.classes_of([("short", "too few words")])
