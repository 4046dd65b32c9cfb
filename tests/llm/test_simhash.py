"""op9 against all pairs of fingerprints."""

import numpy as np
import pytest
import xxhash

from gidlake.llm import common, simhash
from tests.llm.conftest import ODD


def plain(rows):
    values = []
    for _, text in rows:
        words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
        shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        ones = [0] * 64
        for h in (xxhash.xxh64_intdigest(s, seed=42) for s in shingles):
            for k in range(64):
                ones[k] += h >> k & 1
        values.append(sum(1 << k for k in range(64) if 2 * ones[k] > len(shingles)))
    fp = np.array(values, np.uint64)
    i, j = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2)
    root = common.local_roots(len(rows), i, j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root[k]] = min(doc, least.get(root[k], doc))
    return sorted(((d, f"{values[k]:016x}", least.get(root[k])) for k, (d, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("subtrie, large", [(16384, 262144), (4, 8)])
def test_components(spark, docs_of, sf, monkeypatch, subtrie, large):
    monkeypatch.setattr(simhash, "SUBTRIE", subtrie)
    monkeypatch.setattr(simhash, "TOO_LARGE", large)
    rows = [(r.doc_id + 100, r.text) for r in sf("documents").limit(70).collect()] + ODD
    assert sorted((tuple(r) for r in simhash.simhash_components(docs_of(rows)).collect()), key=repr) == plain(rows)


def test_empty(docs_of):
    assert simhash.simhash_components(docs_of([])).count() == 0


def near(n, rng):
    base = np.repeat(rng.integers(0, 1 << 63, size=n // 8 + 1, dtype=np.uint64), 8)[:n].copy()
    for i in range(n):
        for _ in range(rng.integers(0, 4)):
            base[i] ^= np.uint64(1) << np.uint64(rng.integers(0, 64))
    return np.unique(base)


@pytest.mark.parametrize("n", [1, 5, 300, 2000])
def test_trie_join_finds_every_pair(n):
    rng = np.random.default_rng(n)
    a, b = near(n, rng), near(n, rng)
    b = np.unique(np.concatenate([b, a[:40] ^ np.uint64(1 << 63)]))
    for x, y, twin in ((a, a, True), (a, b, False)):
        got = {p for i, j in simhash.trie_links(x, y, 0, 0, twin) for p in zip(i.tolist(), j.tolist(), strict=True)}
        close = np.bitwise_count(x[:, None] ^ y[None, :]) <= 2
        i, j = np.nonzero(np.triu(close, 1) if twin else close)
        assert got == set(zip(i.tolist(), j.tolist(), strict=True))


def test_components_of_links(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, size=(220, 2))] + [(i, i + 1) for i in range(500, 560)] + [(900, k) for k in range(901, 960)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(links, "a long, b long"), "test-links").collect()}
    root = common.local_roots(1000, *(np.array([x[i] for x in links]) for i in (0, 1)))
    assert got == {n: root[n] for a, b in links if a != b for n in (a, b)}
    assert common.components(spark.createDataFrame([], "a long, b long"), "test-links").count() == 0
