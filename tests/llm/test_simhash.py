"""SimHash: fingerprints and components by brute force, tiles, stage."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from linkyard.llm.components import components
from linkyard.llm.simhash import _forest, drop_near_copies, fingerprint_of, near_duplicates, near_links, tile_links


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    k = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, radius=4):
    """For each value the position of the first one in its component."""
    a, parent = np.array(values, np.uint64), list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a) <= radius).tolist():
            p, q = root(i), root(j)
            parent[max(p, q)] = min(p, q)
    return [root(i) for i in range(len(a))]


def test_odd_rows(odd_docs, odd_rows, no_docs):
    rows = sorted(odd_rows, key=lambda r: (r[0] is None, r[0] or 0))  # null keys name nothing
    fps = [brute_fp(r[1]) for r in rows]
    roots = brute_components(fps)
    want = sorted((str(r[0]), f"{f:016x}", str(rows[c][0])) for r, f, c in zip(rows, fps, roots))
    got = sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in near_duplicates(odd_docs).collect())
    assert got == want
    assert near_duplicates(no_docs).count() == 0 and drop_near_copies(no_docs).count() == 0
    kept = drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(str(rows[c][0]) for c in set(roots))


def _near(rnd, base, bits):
    for b in rnd.sample(range(64), bits):
        base ^= 1 << b
    return base


def test_links_connect_what_all_pairs_connect(spark):
    rnd = random.Random(4)
    values = [rnd.getrandbits(64) for _ in range(300)] + [0, 2**64 - 1]
    for b in list(values[:40]):  # chains of near fingerprints, one dense group
        for _ in range(5):
            b = _near(rnd, b, rnd.randint(1, 5))
            values.append(b)
    hub = rnd.getrandbits(64)
    values += [_near(rnd, hub, 2) for _ in range(400)]
    values = sorted({v - 2**64 if v >> 63 else v for v in values})
    roots = brute_components([v % 2**64 for v in values])
    distinct = spark.createDataFrame([(v,) for v in values], "fp long")
    for tile in (7, 4096):
        links = near_links(distinct, 4, tile)
        found = {r["node"]: r["root"] for r in components(links).collect()}
        assert [found.get(v, v) for v in values] == [values[c] for c in roots]
        assert links.count() < 20 * len(values)  # forests, not pairs


def test_tile_pair_finds_every_link_between_tiles():
    rng = np.random.default_rng(2)
    a = rng.integers(-2**63, 2**63 - 1, 500)
    b = np.concatenate((a[:200] ^ np.int64(0b1011), rng.integers(-2**63, 2**63 - 1, 300)))
    assert {tuple(sorted(p)) for p in tile_links(a, b, 3)} >= {tuple(sorted((int(x), int(x ^ 0b1011)))) for x in a[:200]}
    assert tile_links(a, b, 2) == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.booleans(), min_size=5, max_size=5), min_size=1, max_size=6))
def test_forest_keeps_what_a_matrix_connects(rows):
    near = np.array(rows)
    out = _forest(near)
    assert all(near[i, j] for i, j in out)

    def groups(edges):
        parent = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for i, j in edges:
            parent[root(("r", i))] = root(("c", j))
        return {frozenset(y for y in parent if root(y) == root(x)) for x in parent}

    assert groups(out) == groups(zip(*np.nonzero(near)))


def test_components_of_a_long_chain_and_a_star(spark):
    n = 3000
    edges = [(i, i + 1) for i in range(n)] + [(10_000, 10_001 + i) for i in range(n)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{10_000 + i: 10_000 for i in range(n + 1)}}


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aB \tcé\n漢.")), max_size=60))
def test_fingerprint(text):
    assert fingerprint_of(text) % 2**64 == brute_fp(text)
