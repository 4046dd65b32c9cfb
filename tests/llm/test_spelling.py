"""op11 against all one-edit strings of every word."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gidlake.llm import spelling
from tests.llm.conftest import ODD

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def counts(rows):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def edits(word):
    for i in range(len(word) + 1):
        if i < len(word):
            yield word[:i] + word[i + 1:]
        for c in LETTERS:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1:]


def near_words(words):
    """Long words by comparing all of them, short ones by their edits."""
    near = {w: {e for e in edits(w) if e in words and e != w} if len(w) < 200 else set() for w in words}
    long = [w for w in words if len(w) >= 199]
    for a in long:
        for b in long:
            if a < b and abs(len(a) - len(b)) < 2:
                short, other = sorted((a, b), key=len)
                i = next((i for i, (x, y) in enumerate(zip(short, other, strict=False)) if x != y), len(short))
                if short[i + (len(a) == len(b)):] == other[i + 1:]:
                    near[a].add(b)
                    near[b].add(a)
    return near


def plain(rows):
    words = counts(rows)
    near = near_words(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def check(docs_of, rows):
    got = sorted(tuple(r) for r in spelling.spelling_variants(docs_of(rows)).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == plain(rows)
    return got


def test_documents(docs_of, sf):
    got = check(docs_of, [(r.doc_id + 100, r.text) for r in sf("documents").collect()] + ODD)
    assert sum(r[4] > 0 for r in got) > 300 and any(r[1] != r[2] for r in got if r[1])


def times(n, *words):
    return [(1000 + i, " ".join(words)) for i in range(n)]


@pytest.mark.parametrize("length", [spelling.TRIE_LENGTH, 6, 9])
def test_edits_at_every_place_and_long_words(docs_of, monkeypatch, length):
    monkeypatch.setattr(spelling, "TRIE_LENGTH", length)
    rows = times(9, "abcdefgh", "aaaaa", "étésß") + times(4, "aaaaaa", "aaaaaaa", "bbbbb", "abcde", "Étésß")
    for word in ("abcdefgh", "abcde"):
        rows += times(3, *{e for k, e in enumerate(edits(word)) if k % 3 == 0})
    for n in (63, 64, 65, 66, 199, 200):
        base = "".join(LETTERS[(i * i + i) % 26] for i in range(n))
        rows += times(8, base) + times(3, base[1:], base + "x", base[:n // 2] + "q" + base[n // 2 + 1:], base[:-1] + "z", base[:5] + "q" + base[5:])
    rows += times(3, "y" * 20_000, "y" * 20_001, "y" * 10_000 + "z" + "y" * 9_999)
    check(docs_of, rows)


def test_chains_and_ties(docs_of):
    rows = times(90, "chain") + times(35, "chaix") + times(12, "chaxx") + times(4, "cxaxx") + times(8, "tiesa", "tiesb") + times(3, "ties") + times(4, "tiesc", "tieszz")
    got = {r[0]: r for r in check(docs_of, rows)}
    assert got["cxaxx"][2] == "chain" and got["tiesc"][1] == "tiesa"


def test_empty(docs_of):
    assert spelling.spelling_variants(docs_of([])).collect() == []
    assert spelling.spelling_variants(docs_of([(1, None), (2, "a b c")])).collect() == []


def test_hashes_less_one_letter():
    word = "abcabéxyz" * 5
    whole, variants = spelling.less_one(word)
    for i in range(len(word)):
        assert spelling.less_one(word[:i] + word[i + 1:])[0] == variants[i]
    assert whole not in set(variants) and np.unique(variants).size > 40
