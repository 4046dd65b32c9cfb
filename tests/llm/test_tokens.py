"""op3 and op5: ids against the tokenizer itself, exact round trips, gapless packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from gidlake.llm import packing, repair, tokens
from gidlake.settings import scratch_path
from tests.llm.conftest import ODD

TEXTS = ["", " ", "<|startoftext|>a b<|endoftext|>", "a\x1cb\x85c d", "don't it's S'x", "ÅÅ ́e", "Σας ΑΣ", "12 345 a1b2", "İstanbul ﬁ", '"q"...!!', "H̱ T̈ H̱",
         "A. B, c., d.. e.\nf, g.", "<|STARTOFTEXT|> A", "K İ ǅ x.", "re: the 'll of'", "|a| b"]


@pytest.fixture(scope="module")
def plain():
    encoder = tokens.WordEncoder(tokens.word_bpe_path()).tokenizer
    return lambda text: np.array([*encoder.encode(text or "", add_special_tokens=False).ids, tokens.END_ID], "<u4")


@pytest.mark.parametrize("cache, fragment", [(600_000, 4 << 20), (40, 4 << 20), (40, 7)])
def test_ids_are_those_of_whole_texts(monkeypatch, plain, cache, fragment):
    monkeypatch.setattr(tokens, "CACHE_WORDS", cache)
    monkeypatch.setattr(tokens, "FRAGMENT_BYTES", fragment)
    monkeypatch.setattr(tokens.fragments, "__defaults__", (fragment,))
    encoder = tokens.WordEncoder(tokens.word_bpe_path())
    for _ in range(2):
        ids, ends = encoder.encode([t.encode() for t in TEXTS])
        for text, start, end in zip(TEXTS, [0, *ends.tolist()[:-1]], ends.tolist(), strict=True):
            assert ids[start:end].tolist() == plain(text).tolist(), text


@pytest.mark.parametrize("base", [12, 70_000])
def test_grammar_round_trip(base):
    rng = np.random.default_rng(3)
    for ids in (np.zeros(0, int), np.array([5]), np.full(1001, 7), rng.integers(0, 9, 5000), np.tile(rng.integers(0, 9, 37), 90), rng.integers(0, base, 3000)):
        grammar = repair.Grammar.build(ids, base, min_count=2, rounds=30)
        again = repair.Grammar.unpack(grammar.pack(len(ids)))
        assert again.ids().tolist() == ids.tolist()
        assert len(again.symbols) + 2 * len(again.rules) <= len(ids) + 1 or not len(again.rules)
        for start, end in ((0, len(ids)), (len(ids) // 3, len(ids) // 2), (0, min(1, len(ids)))):
            assert again.slice(start, end).tolist() == ids[start:end].tolist()


def test_repair_reads_back_every_document(spark, docs_of, plain, monkeypatch):
    out = scratch_path(spark, "test-ids")
    repair.write_ids(docs_of(ODD), out)
    rows = sorted(repair.read_documents(spark, out).collect(), key=lambda r: r.start)
    order = sorted(range(len(ODD)), key=lambda i: (ODD[i][0] is not None, ODD[i][0] or 0))
    at, everything = 0, []
    assert [r.doc_id for r in rows] == [ODD[i][0] for i in order]
    for r in rows:
        options = [plain(t) for d, t in ODD if d == r.doc_id]
        match = [o for o in options if (len(o), zlib.crc32(o.tobytes())) == (r.n_tokens, r.ids_crc32)]
        assert match and r.start == at
        everything += match[0].tolist()
        at += r.n_tokens
    assert repair.read_slice(spark, out, 3, at - 2) == everything[3:at - 2]
    assert repair.repair_tokens(docs_of([])).count() == 0


def test_packing_is_gapless_and_whole(docs_of, plain):
    rows = packing.best_fit_packing(docs_of(ODD), size=64).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    wanted = defaultdict(list)
    for doc, text in ODD:
        ids = plain(text)
        for k in range(0, len(ids), 64):
            wanted[doc].append((k // 64, k, len(ids[k:k + 64]), zlib.crc32(ids[k:k + 64].tobytes())))
    assert {d: sorted(p) for d, p in pieces.items()} == {d: sorted(p) for d, p in wanted.items()}
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.best_fit_packing(docs_of([])).count() == 0


def test_best_fit_against_a_plain_search():
    rng = random.Random(5)
    packer, opened, made = packing.BestFit(50, 4), [], 0  # (free space, bin), latest last
    for _ in range(2000):
        length = rng.randint(1, 50)
        fitting = [x for x in opened if x[0] >= length]
        if fitting:
            least = min(x[0] for x in fitting)
            chosen = next(x for x in reversed(opened) if x[0] == least)
            opened.remove(chosen)
        else:
            if len(opened) == 4:
                least = min(x[0] for x in opened)
                opened.remove(next(x for x in reversed(opened) if x[0] == least))
            chosen, made = (50, made), made + 1
        assert packer.add(length) == (chosen[1], 50 - chosen[0])
        if chosen[0] > length:
            opened.append((chosen[0] - length, chosen[1]))


def test_packing_is_tight(sf):
    rows = packing.best_fit_packing(sf("documents")).collect()
    assert len({r.sequence_id for r in rows}) <= 1.03 * sum(r.length for r in rows) / packing.SEQUENCE + 1


def test_bins_close_and_packing_stays_tight():
    """Pieces in the order they come, with the production number of open bins: the fullest do close, and little space is lost."""
    rng = random.Random(8)
    lengths = [min(4096, int(rng.lognormvariate(6, 1.2)) + 1) for _ in range(40_000)]
    packer = packing.BestFit()
    fill: dict[int, int] = {}
    for n in lengths:
        number, place = packer.add(n)
        assert place == fill.get(number, 0) and place + n <= packing.SEQUENCE and packer.open <= packing.OPEN_BINS
        fill[number] = place + n
    assert packer.closed > 100 and sum(fill.values()) == sum(lengths)
    assert packer.made <= 1.02 * sum(lengths) / packing.SEQUENCE + packing.OPEN_BINS


def test_words_that_come_back_are_not_learned_again(monkeypatch):
    encoder = tokens.WordEncoder(tokens.word_bpe_path(), 60)
    learned, own = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: learned.extend(words) or own(words))
    texts = [f"common words stay here odd{i}x rare{i}y".encode() for i in range(200)]
    whole = tokens.WordEncoder(tokens.word_bpe_path(), 10_000).encode(texts)[0].tolist()
    assert [i for t in texts for i in encoder.encode([t])[0].tolist()] == whole
    assert learned.count(b"common") == 1 and len(encoder.index) <= 60
