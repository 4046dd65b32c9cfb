"""op13 against the tokenizer library itself."""

import base64
import hashlib
import random
import time

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from gidlake.llm import byte_bpe
from tests.llm.conftest import ODD

RANKS = byte_bpe.read_ranks(byte_bpe.multi_path())
LIBRARY = tiktoken.Encoding("own", pat_str=byte_bpe.piece_pattern(), mergeable_ranks=RANKS, special_tokens={})
PAIRS = byte_bpe.BytePairs(RANKS)


def digest(doc, text):
    ids = LIBRARY.encode_ordinary(text or "")
    return (doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIBRARY.decode_bytes(ids)).hexdigest())


def test_documents_and_odd_rows(docs_of, sf):
    rows = [(r.doc_id + 100, r.text) for r in sf("documents").collect()] + ODD + [
        (50, "<|endoftext|> it's 'tis we'll'LL \u0130\u0558\u208f\U00011de0 \x1c\x1d a\u00a0\u2003\u3000b \x85  \n\n x"), (51, " " * 70_000 + "a"),
        (52, "ab1 !? " * 40_000), (53, "\u3042\u3044\U0001f600" * 9_000)]
    got = [tuple(r) for r in byte_bpe.byte_bpe_digest(docs_of(rows)).collect()]
    assert sorted(got, key=repr) == sorted((digest(*row) for row in rows), key=repr)
    assert all(hashlib.sha256((text or "").encode()).hexdigest() == digest(doc, text)[3] for doc, text in rows)


def test_empty(docs_of):
    assert byte_bpe.byte_bpe_digest(docs_of([])).collect() == []


def test_every_token_and_joined_tokens():
    rng = random.Random(1)
    tokens = list(RANKS)
    samples = tokens[::7] + [b"".join(rng.choices(tokens, k=rng.randrange(2, 6))) for _ in range(4000)]
    for piece in samples:
        want = [RANKS[piece]] if piece in RANKS else PAIRS.merge(piece)
        assert PAIRS.encode(piece) == want, piece


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("ab \n'\u00e9\u00df1", max_size=80))
def test_any_text(text):
    pieces = byte_bpe.re.findall(byte_bpe.plain_pattern(byte_bpe.piece_pattern()), text)
    assert [i for p in pieces for i in PAIRS.encode(p.encode())] == LIBRARY.encode_ordinary(text)


def test_small_vocabularies_with_dead_ends():
    """Ranks made by merging random neighbours over few letters, where the longest token is often wrong."""
    for seed in range(30):
        rng = random.Random(seed)
        ranks = {bytes([c]): i for i, c in enumerate(b"abc")}
        while len(ranks) < 14:
            ranks.setdefault(rng.choice(list(ranks)) + rng.choice(list(ranks)), len(ranks))
        pairs = byte_bpe.BytePairs(ranks)
        reachable = all(pairs.merge(t) == [r] for t, r in ranks.items())
        for _ in range(60):
            piece = bytes(rng.choices(b"abc", k=rng.randrange(1, 40)))
            if reachable and piece not in ranks:
                assert pairs.encode(piece) == pairs.merge(piece)


def test_time_is_linear_in_a_piece():
    def seconds(n):
        begun = time.perf_counter()
        PAIRS.encode(bytes(random.Random(n).choices(b"abcdefgh", k=n)))
        return time.perf_counter() - begun

    seconds(50_000)
    assert seconds(400_000) < 8 * seconds(100_000) + 0.5


def test_fragments_keep_the_pieces():
    text = "one two3 'll four  five\nsix seven" * 50
    split = byte_bpe.re.compile(byte_bpe.plain_pattern(byte_bpe.piece_pattern())).findall
    assert [p for part in byte_bpe.fragments(text, 7) for p in split(part)] == split(text)
    assert "".join(byte_bpe.fragments("x" * 100, 7)) == "x" * 100


@pytest.mark.parametrize("pattern", [r"[\S]+", r"\p{Z}"])
def test_unknown_classes_are_refused(pattern):
    with pytest.raises(ValueError):
        byte_bpe.plain_pattern(pattern)


def test_ranks_file():
    assert len(RANKS) == 50_256 and base64.b64encode(PAIRS.token[300])
