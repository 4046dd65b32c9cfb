"""op7 against windows held in sets."""

import hashlib
import random
import re

import pytest

from gidlake.llm import decontamination as d
from tests.llm.conftest import ODD


def words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def plain(docs, bench):
    out = []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for name, passage in bench:
            b = words(passage)
            n = min(13, len(b))
            windows = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if b else set()
            for i in range(len(w) - n + 1):
                if windows and tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    items |= {str(name)} if name is not None else set()
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(items), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [500_000, 30])
@pytest.mark.parametrize("seed", [0, 1, 2])
def test_hits(spark, docs_of, block, seed):
    rng = random.Random(seed)
    letters = ["a", "b", "C", "é", "x1", "zz!"][:3 + seed]
    bench = [(i, " ".join(rng.choices(letters, k=rng.choice([0, 1, 3, 13, 20, 40]) if seed == 2 else rng.choice([14, 20, 40])))) for i in range(6)]
    bench += [(7, None), (8, ""), bench[1], (11, "one"), (12, "\x00\x01"), (None, "no id two three"), (None, bench[2][1])]
    docs = [(20 + i, " ".join(rng.choices([*letters, "q"], k=rng.randint(0, 120)))) for i in range(12)]
    docs += [(50 + i, f"q {bench[i][1]} q {bench[i][1]}") for i in range(5)] * 2 + ODD
    got = d.contamination(docs_of(docs), spark.createDataFrame(bench, "item_id long, text string"), block).collect()
    assert sorted(map(tuple, got), key=repr) == plain(docs, bench)


def test_matches_are_longest(spark, docs_of):
    passage = [f"w{i}" for i in range(30)]
    bench = spark.createDataFrame([("item", " ".join(passage))], "item_id string, text string")
    docs = [(1, " ".join(["x", *passage[4:25], "x", *passage])), (2, " ".join(passage[:12]))]
    assert sorted(map(tuple, d.matches(docs_of(docs), bench).collect())) == [(1, "item", 1, 4, 21), (1, "item", 23, 0, 30)]


def test_empty(spark, docs_of):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert d.contamination(docs_of([]), bench).count() == 0
    assert d.contamination(docs_of([(1, "a b")]), bench).first().n_hit == 0


def test_an_item_without_an_id_hits_but_is_not_listed(spark, docs_of):
    text = " ".join(f"w{i}" for i in range(20))
    bench = spark.createDataFrame([(None, text), (3, text.upper())], "item_id long, text string")
    rows = [(1, text), (2, "w1 w2")]
    assert sorted(map(tuple, d.contamination(docs_of(rows), bench.filter("item_id is null")).collect())) == plain(rows, [(None, text)])
    assert sorted(map(tuple, d.contamination(docs_of(rows), bench).collect())) == plain(rows, [(None, text), (3, text.upper())])


def test_items_of_one_preamble_make_no_pairs(monkeypatch):
    """Every occurrence is found once, however many items begin with it."""
    preamble = " ".join(f"p{i}" for i in range(13))
    items = [(str(k), f"{preamble} x{k}".encode()) for k in range(2_000)]
    bench = d.Benchmark(items)
    assert len(bench.window_starts) == 2_001 and len(bench.starts) == 4_000
    texts = [f"a {preamble} b".encode()] * 1_500
    counts, _, (window, place) = d.scan_shard(texts, bench, d.window_hits)
    assert len(place) == 1_500 and set(counts) == {15}
    monkeypatch.setattr(d, "ITEMS_HELD", 100_000)
    batch = d.pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "text": texts[:40], "n_words": [0] * 40, "n_hit": [0] * 40, "hits": [None] * 40, "items": [None] * 40},
                                         schema=d._FOUND)
    out = list(d._scan(iter([batch]), bench, True))
    assert len(out) == 1 and sum(len(x) for x in out[0].column("items")) == 80_000
    monkeypatch.setattr(d, "ITEMS_HELD", 10_000)
    parts = list(d._scan(iter([batch]), bench, True))
    assert len(parts) > 5 and [r for p in parts for r in p.to_pylist()] == out[0].to_pylist()
