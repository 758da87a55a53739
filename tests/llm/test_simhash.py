"""SimHash groups against brute force over all pairs."""

import re

import numpy as np
import pytest
import xxhash

from smeltery.llm import simhash
from smeltery.llm.queries import QUERIES


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) > 2 else [words] * bool(words)
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Smallest key reachable over fingerprints at most two bits apart."""
    keys = sorted(prints)
    values = np.array([prints[k] for k in keys], np.uint64)
    name = {k: k for k in keys}

    def root(k):
        while name[k] != k:
            k = name[k]
        return k

    for i, k in enumerate(keys):
        near = np.bitwise_count(values ^ values[i]) <= 2
        for j in np.flatnonzero(near[:i]):
            a, b = sorted((root(keys[j]), root(k)))
            name[b] = a
    return {k: root(k) for k in keys}


def test_query_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    prints = {d: plain_fingerprint(t) for d, t in docs}
    groups = plain_groups(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash_groups"](spark, small).collect()}
    assert got == {k: (f"{v:016x}", groups[k]) for k, v in prints.items()}


def test_links_join_exactly_the_values_two_bits_apart(spark):
    rng = np.random.default_rng(1)
    values = set()
    for center in rng.integers(0, 2**63, 20):
        for _ in range(40):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            values.add(int(center) ^ sum(1 << int(b) for b in flips))
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    from smeltery.llm.graph import components

    links = simhash.near_links(frame)
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 2 for a, b in links.collect())
    named = {r.node: r.component for r in components(links).collect()}
    want = plain_groups({v: v & (2**64 - 1) for v in signed})
    assert {v: named.get(v, v) for v in signed} == want


@pytest.mark.parametrize("text", [None, "", " \t\r\n", "One", "one TWO", "É É É É", "a b c\x0bd e"])
def test_odd_texts(text):
    want = plain_fingerprint(text)
    assert simhash.fingerprint((text or "").encode()) & (2**64 - 1) == want


def test_long_text_is_counted_in_chunks():
    text = " ".join(str(i * i % 977) for i in range(70_000))
    assert simhash.fingerprint(text.encode()) & (2**64 - 1) == plain_fingerprint(text)


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None, 0), (1, "", 0), (None, "a b c d", 1), (7, "A b c d", 2), (9, "A b c d", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (None, 7), (7, 7), (9, 7)], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
