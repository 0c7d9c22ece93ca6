from __future__ import annotations

import random
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import ODD_TEXTS

from martloom.llm import simhash as S


def test_query_matches_brute_force(documents, result):
    want = brute.groups([(i, brute.fingerprint(t)) for i, t in documents])
    assert Counter(result("op2_simhash")) == Counter(want)


def test_odd_rows(rows_of):
    got = S.near_duplicates(rows_of(ODD_TEXTS)).select("doc_id", "fingerprint", "component_id")
    assert Counter(map(tuple, got.collect())) == Counter(brute.groups([(i, brute.fingerprint(t)) for i, t in ODD_TEXTS]))


def test_one_of_each_group_stays_with_all_columns(rows_of):
    df = rows_of(ODD_TEXTS)
    kept = S.deduplicated(df)
    assert kept.columns == df.columns
    want = {g for g in brute.groups([(i, brute.fingerprint(t)) for i, t in ODD_TEXTS])}
    assert kept.count() == len({c for _, _, c in want if c is not None} | {f for _, f, c in want if c is None})


def test_empty_table(rows_of):
    assert S.near_duplicates(rows_of([])).collect() == []
    assert S.deduplicated(rows_of([])).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 70_000])
def test_fingerprint_of_any_length(n):
    text = " ".join(f"w{i % 977}" for i in range(n))
    if n < 100:
        assert S.fingerprint(text) == brute.fingerprint(text)
    else:
        assert S.fingerprint(text) == S.fingerprint(text.upper()) != 0


def near_values(seed, n=300):
    """Random words, and chains whose neighbours differ in one or two bits."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for start in out[:20]:
        for _ in range(10):
            start ^= 1 << rng.randrange(64)
            start ^= (1 << rng.randrange(64)) * rng.randrange(2)
            out.append(start)
    return sorted(set(out) | {0, 1, 3, 7, (1 << 64) - 1})


def partition(values, pairs):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        parent[root(a)] = root(b)
    groups = {}
    for v in values:
        groups.setdefault(root(v), set()).add(v)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("tile", [7, 64, 2048])
def test_tiles_link_what_all_pairs_link(tile):
    values = near_values(tile)
    near = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 2]
    ordered = S._by_count(np.array(values, np.uint64))
    got = S._stars(ordered, None, 2, tile)
    assert all((int(a) ^ int(b)).bit_count() >= 1 for a, b in got)
    assert partition(values, [(int(a), int(b)) for a, b in got]) == partition(values, near)


@pytest.mark.parametrize("chunk", [2, 5, 16_384])
def test_buckets_lose_no_link(spark, chunk):
    values = near_values(chunk, 200)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = S.linked(spark.createDataFrame([(v,) for v in signed], "fp long"), chunk=chunk).collect()
    near = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 2]
    got = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in links]
    assert partition(values, got) == partition(values, near)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 140)]
    got = {r["node"]: r["root"] for r in S.components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
