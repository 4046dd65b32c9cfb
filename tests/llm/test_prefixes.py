"""op12 against rebuilt lists of turns."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from gidlake.llm import prefixes

TURNS = "conv_id long, turn long, role string, text string, node string, ref string, n long, part int, at int"


@pytest.fixture(scope="module")
def turns_of(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", "y", 1, 2, 3) for r in rows], TURNS)


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    members, ending = defaultdict(list), defaultdict(list)
    for conv in sorted(own):
        h = zlib.crc32(str(conv).encode()) % 6
        turns = tuple(own.get(conv - conv % 100, [])[:h] + own[conv][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
        ending[turns].append(conv)
    below = {node: [0, 0] for node in members}
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            below[node[:d]][0] += not children[node]
            below[node[:d]][1] += (len(convs) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), children[node], *below[node],
                    hashlib.sha256(",".join(map(str, ending[node])).encode()).hexdigest()) for node, convs in members.items()), key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(frame):
    return sorted((tuple(r) for r in prefixes.prefix_trie(frame).select(*COLUMNS).collect()), key=repr)


def talks(n, seed):
    """Conversations over few turns, so that they share heads; repeated, turnless and long ones among them."""
    rng = random.Random(seed)
    said = ["", "hi", "how are you", "é\U0001d4b3 ñ", "x" * 50]
    rows = [(7, None, "user", "no number"), (7, 1, None, None), (None, 0, "user", "no id")]
    for conv in rng.sample(range(100 * n), 12 * n) + [100 * k for k in range(0, n, 2)]:
        rows += [(conv, t, rng.choice(["user", "bot", None]) if t > 2 else "user", rng.choice(said)) for t in range(rng.choice([1, 2, 3, 7, 9]))]
    return list(dict.fromkeys(rows)) + [(100 * n + 5, t, "user", "hi") for t in range(400)] + [(100 * n, t, "user", "hi") for t in range(395)]


def test_test_table(spark, sf):
    table = sf("conversations")
    assert got(table) == plain([(r.conv_id, r.turn, r.role, r.text) for r in table.collect()])


@pytest.mark.parametrize("partitions, page", [(1, 10_000), (13, 3)])
def test_odd_conversations(spark, turns_of, monkeypatch, partitions, page):
    monkeypatch.setattr(prefixes, "IDS_PER_PAGE", page)
    monkeypatch.setattr(prefixes.ends, "__defaults__", (page,))
    rows = talks(6, partitions)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert got(turns_of(rows)) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repeated_rows_and_long_texts(turns_of):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (101, 5, "user", "b " * 40_000), (102, 5, "user", "b " * 40_000), (-3, 0, "u", "negative")]
    assert got(turns_of(rows[:-1])) == plain(rows[:-1])
    assert got(turns_of(rows)) and got(turns_of([])) == []


def test_meeting_fingerprints_start_anew(turns_of, monkeypatch):
    """With hashes that tell nothing apart, every depth is one node until the next seed; two prefixes of one sum are told apart."""
    rows = talks(4, 1)
    real = prefixes.products

    def weak(turns, seed):
        if seed:
            return real(turns, seed)
        same = turns.withColumn("role", prefixes.F.lit("same")).withColumn("text", prefixes.F.lit("same"))
        return real(same, seed)

    monkeypatch.setattr(prefixes, "products", weak)
    assert got(turns_of(rows)) == plain(rows)
    monkeypatch.setattr(prefixes, "SEEDS", 1)
    with pytest.raises(RuntimeError):
        prefixes.prefix_trie(turns_of(rows))


def test_powers():
    exponents = np.array([0, 1, 2, 63, 10**6, 2**40 + 3])
    for base, prime in zip(prefixes.BASES, prefixes.PRIMES, strict=True):
        assert prefixes.powers(base, prime, exponents).tolist() == [pow(base, int(e), prime) for e in exponents]
        assert all(prime % k for k in range(2, 47_000))
