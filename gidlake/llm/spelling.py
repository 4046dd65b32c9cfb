"""op11: words grouped with their commoner spelling, found by walking a trie of all words as a table of edges.

The frontier holds (word, position, node, edits): how far a word has been read, the trie node reached and the edits spent.
Each level joins it with the children of its nodes: a state without an edit also branches to every other letter, one with
an edit only follows its word. A state that has spent its edit and read its word at the end of another word is a link.

An edit in the second half of a word leaves its first half as it is. So a word enters the frontier at its middle, where few
words are below a node, and the trie of the reversed words finds the edits of the first half. A replacement is followed
towards the larger letter and an insertion from the shorter word; the other end of a link is added by turning it round.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gidlake.llm import common
from gidlake.operators.skew import HOT_SHARE, skew_join
from gidlake.settings import scratch_path

LEAST_LENGTH, LEAST_COUNT, FORM_RATIO = 5, 3, 2
# One run in so many, by its hash, loses a letter before words are counted.
THINNED = 97
# Words of up to this many code points are in the trie, so it has so many levels at most; links of two longer words are found by
# hashes of the words less one letter.
TRIE_LENGTH = 65
# Different words that one task counts before it hands them on, and bytes of text.
COUNTED, COUNTED_BYTES = 150_000, 16 << 20

_COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])
_VARIANTS = pa.schema([("id", pa.int64()), ("size", pa.int32()), ("place", pa.int32()), ("hash", pa.int64())])

# Letters are one byte in Latin-1, so a place in its bytes is a code point; all other bytes become blanks.
_LETTERS = bytes(b if b >= 0xC0 or chr(b).isalpha() and b < 0x80 else 0x20 for b in range(256)).lower()


# --- words and counts


def runs(text: bytes) -> list[bytes]:
    """Maximal runs of letters, A-Z in lower case, in Latin-1."""
    return text.decode("utf-8", "replace").encode("latin-1", "replace").translate(_LETTERS).split()


def _plain(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.release()
    total: Counter[bytes] = Counter()
    held = 0

    def flush() -> pa.RecordBatch:
        out = common.record_batch([[_plain(w) for w in total], list(total.values())], _COUNTS)
        total.clear()
        return out

    for batch in common.slices(batches):
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = runs(text)
            own = set(words)
            start = zlib.crc32(b":" if doc is None else b"%d:" % doc)
            hashes = map(zlib.crc32, own if text.isascii() else map(_plain, own), repeat(start))
            thinned = [(w, h) for w, h in zip(own, hashes, strict=True) if not h % THINNED]
            times = Counter(filter({w for w, _ in thinned}.__contains__, words)) if thinned else {}
            for word, h in thinned:
                total[word] -= times[word]
                cut = h % len(word)
                if less := word[:cut] + word[cut + 1:]:
                    total[less] += times[word]
            total.update(words)
            held += len(text)
            if len(total) > COUNTED or held > COUNTED_BYTES:
                yield flush()
                held = 0
    yield flush()


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of whole texts that are long and frequent enough, after the thinning.

    A row without an id has an empty id in the hash. Counts are summed in each task before they are shuffled.
    """
    counted = common.id_text(docs).mapInArrow(_count, "word binary, n long").withColumn("word", F.col("word").cast("string"))
    kept = counted.filter(F.length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n"))
    return kept.filter(F.col("n") >= least_count)


# --- the trie


def _letter(word: Column | str, place: Column) -> Column:
    """The letter at a 0-based place; empty at the end."""
    return F.substring(word, place + 1, F.lit(1))


def _signature(word: Column | str, place: Column) -> Column:
    """A number below 256 from what is left of a word behind a place: its next two letters, its last one and its length."""
    left = F.xxhash64(F.substring(word, place + 1, F.lit(2)), F.substring(word, F.lit(-1), F.lit(1)), F.length(word) - place)
    return F.pmod(left, F.lit(256)).cast("int")


_BITS = ("bits0", "bits1", "bits2", "bits3")


def trie_nodes(words: DataFrame) -> DataFrame:
    """(dir, depth, node, under, ends, longer, bits): each prefix of the words, with how many words it has, whether one ends there
    or goes on, and a set bit for the signature of what each has left."""
    at = words.select("dir", "word", F.length("word").alias("size"), F.explode(F.sequence(F.lit(1), F.length("word"))).alias("depth"))
    marked = at.select("dir", "depth", "size", F.substring("word", F.lit(1), F.col("depth")).alias("node"), _signature("word", F.col("depth")).alias("sign"))
    bits = [F.bit_or(F.expr(f"case when sign div 64 = {k} then shiftleft(1L, sign % 64) else 0L end")).alias(name) for k, name in enumerate(_BITS)]
    return marked.groupBy("dir", "depth", "node").agg(
        F.count("*").alias("under"), (F.min("size") == F.col("depth")).alias("ends"), (F.max("size") > F.col("depth")).alias("longer"), *bits)


def trie_children(nodes: DataFrame) -> DataFrame:
    """(dir, depth, node, under, children): each node that has children, with them. An alphabet of 90 letters bounds the lists."""
    child = nodes.select("dir", (F.col("depth") - 1).alias("depth"), F.substring("node", F.lit(1), F.col("depth") - 1).alias("node"), "under", F.struct(
        F.substring("node", F.col("depth"), F.lit(1)).alias("letter"), "ends", "longer", *_BITS).alias("child"))
    return child.groupBy("dir", "depth", "node").agg(F.sum("under").alias("under"), F.collect_list("child").alias("children"))


def _standing(words: DataFrame, depth: int) -> DataFrame:
    """States without an edit: words whose middle has been passed, at the node that is their own prefix."""
    return words.filter((F.floor(F.length("word") / 2) <= depth) & (F.length("word") >= depth)).select(
        "dir", "word", F.lit(depth).alias("place"), F.substring("word", 1, depth).alias("node"), F.lit(0).alias("edits"))


def step(frontier: DataFrame, children: DataFrame, hot: DataFrame) -> DataFrame:
    """The states with an edit one level deeper; `link` is set where a word has been read to the end of another one.

    A state goes on only if its node's words have the signature of what it has left. `hot` are the keys of nodes with very many words.
    """
    key = F.concat_ws(":", "dir", "node").alias("key")
    joined = skew_join(frontier.select("*", key), children.select(key, "children"), "key", "inner", spread=F.col("word"), hot=hot)
    # What a state has left after following or replacing a letter (1) and after inserting one (0) is worked out once, not for each child.
    state = joined.select("dir", "word", "place", "node", (F.col("edits") == 0).alias("first"), _letter("word", F.col("place")).alias("own"), "children",
                          *(_signature("word", F.col("place") + k).alias(f"sign{k}") for k in (0, 1)),
                          *((F.col("place") + k == F.length("word")).alias(f"read{k}") for k in (0, 1)))
    state = state.select("*", *(F.expr(f"shiftleft(1L, sign{k} % 64)").alias(f"mask{k}") for k in (0, 1))).withColumn("c", F.explode("children"))
    letter, own, first = F.col("c.letter"), F.col("own"), F.col("first")

    def possible(k: int) -> Column:
        bits = F.expr(f"case sign{k} div 64 " + " ".join(f"when {i} then c.{name}" for i, name in enumerate(_BITS)) + " end")
        return F.when(F.col(f"read{k}"), F.col("c.ends")).otherwise(bits.bitwiseAND(F.col(f"mask{k}")) != 0)

    follow = ~first & (letter == own)
    replace = first & (own != "") & (letter > own)
    insert = first & (letter != own)  # before an equal letter is the same as after it
    forward = F.when((follow | replace) & possible(1), F.lit(1))
    ahead = F.when(insert & possible(0), F.lit(0))
    moved = state.select("dir", "word", "place", "node", letter.alias("letter"), "read0", "read1", forward.alias("forward"), ahead.alias("ahead"))
    moved = moved.filter("forward is not null or ahead is not null").withColumn("move", F.explode(F.array_compact(F.array("forward", "ahead"))))
    return moved.select("dir", "word", (F.col("place") + F.col("move")).alias("place"), F.concat("node", "letter").alias("node"), F.lit(1).alias("edits"),
                        F.when(F.col("move") == 1, F.col("read1")).otherwise(F.col("read0")).alias("link"))


def trie_links(words: DataFrame) -> DataFrame:
    """(a, b): links of words of up to TRIE_LENGTH code points, each in one direction and at least once."""
    short = words.filter(F.length("word") <= TRIE_LENGTH).select("word")
    both = common.staged(short.select(F.lit(0).alias("dir"), "word")
                         .unionByName(short.select(F.lit(1).alias("dir"), F.reverse("word").alias("word"))), "op11-words")
    sizes = both.agg(F.count("*"), F.max(F.length("word"))).first()
    if not sizes[0]:
        return words.select(F.col("word").alias("a"), F.col("word").alias("b")).limit(0)
    children = staged_by_depth(trie_children(trie_nodes(both)))
    # At each level fewer than 1000 nodes of a direction have so large a part of its words.
    hot = common.staged(children.filter(F.col("under") * 2 * HOT_SHARE > sizes[0]).select("depth", F.concat_ws(":", "dir", "node").alias("key"), F.col("under").alias("n")),
                        "op11-hot")
    found, frontier = None, None
    for depth in range(sizes[1]):
        states = _standing(both, depth)
        if frontier is not None:
            states = states.unionByName(frontier)
        level = common.staged(step(states, children.filter(F.col("depth") == depth), hot.filter(F.col("depth") == depth).drop("depth")), "op11-frontier")
        found = level.filter("link") if found is None else found.unionByName(level.filter("link"))
        frontier = level.filter("not link").drop("link")
    turned = F.col("dir") == 1
    return found.select(F.when(turned, F.reverse("word")).otherwise(F.col("word")).alias("a"),
                        F.when(turned, F.reverse("node")).otherwise(F.col("node")).alias("b"))


def staged_by_depth(children: DataFrame) -> DataFrame:
    """The edge table as one folder for each level."""
    path = scratch_path(children.sparkSession, "op11-trie")
    children.repartition("depth", F.pmod(F.hash("node"), F.lit(64))).write.partitionBy("depth").parquet(path)
    return children.sparkSession.read.schema(children.schema).parquet(path)


# --- longer words

_PRIMES = (2_147_483_629, 2_147_483_587)
_BASES = (48_271, 69_621)


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(max(1, n), np.int64)
    have = 1
    while have < len(out):
        more = min(have, len(out) - have)
        out[have:have + more] = out[:more] * (out[have - 1] * base % prime) % prime
        have += more
    return out[:n]


def less_one(word: str) -> tuple[int, np.ndarray]:
    """A hash of the word, and hashes of the word less the letter at each place."""
    letters = np.array([ord(c) for c in word], np.int64)
    whole, variants = 0, np.zeros(len(letters), np.int64)
    for prime, base in zip(_PRIMES, _BASES, strict=True):
        power = _powers(base, prime, len(letters) + 1)
        before = np.concatenate([[0], np.cumsum(letters * power[:-1] % prime) % prime])
        # Letters behind the gap move one place down: what they add is divided by the base.
        after = (before[-1] - before[1:]) % prime * pow(base, -1, prime) % prime
        variants = variants << 31 | (before[:-1] + after) % prime
        whole = whole << 31 | int(before[-1])
    return whole, variants


def _less_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, "word"):
        for key, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist(), strict=True):
            whole, variants = less_one(word)
            n = len(variants)
            yield common.record_batch([[key], [n], [-1], [whole]], _VARIANTS)
            for at in range(0, n, 65_536):
                part = variants[at:at + 65_536]
                yield common.record_batch([np.full(len(part), key), np.full(len(part), n), np.arange(at, at + len(part)), part], _VARIANTS)


def long_links(words: DataFrame) -> DataFrame:
    """(a, b): links of words of TRIE_LENGTH or more code points, each at least once.

    Two words differ by a replacement if they are equal without the letter at one place, by an insertion if one less a letter is
    the other. Both are equi-joins of hashes; what they find is checked on the words.
    """
    long = words.filter(F.length("word") >= TRIE_LENGTH).select(F.xxhash64("word").alias("id"), "word")
    hashes = common.staged(long.mapInArrow(_less_one, "id long, size int, place int, hash long"), "op11-variants")
    gaps = hashes.filter("place >= 0")
    other = gaps.select(F.col("id").alias("other"), "size", "place", "hash")
    replaced = gaps.join(other, ["hash", "size", "place"]).filter("id < other").select("id", "other")
    whole = hashes.filter("place < 0").select(F.col("id").alias("other"), (F.col("size") + 1).alias("size"), "hash")
    inserted = gaps.join(whole, ["hash", "size"]).select("id", "other")
    pairs = replaced.unionByName(inserted).distinct()
    return (pairs.join(long.withColumnRenamed("word", "a"), "id").drop("id")
            .join(long.select(F.col("id").alias("other"), F.col("word").alias("b")), "other")
            .filter(F.levenshtein("a", "b", 1) == 1).select("a", "b"))


# --- forms and roots


def spelling_links(words: DataFrame) -> DataFrame:
    """(word, near): every link of the words, in both directions, once."""
    pairs = trie_links(words).unionByName(long_links(words))
    turned = pairs.select(F.col("b").alias("word"), F.col("a").alias("near"))
    return pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(turned).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by following forms, each round twice as far. Counts at least double with every form, so they end."""
    up = common.staged(forms.select("word", F.col("form").alias("root")), "op11-up")
    while True:
        ahead = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = common.staged(up.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                           "op11-up")
        if up.filter("moved").isEmpty():
            return up.drop("moved")
        up = up.drop("moved")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """op11: (word, form, root, n, n_near, form_n) of every word with at least LEAST_LENGTH letters and LEAST_COUNT occurrences.

    form: the near word of largest n (ties: the smallest) where that is at least FORM_RATIO times the word's own; root: the last
    form of the chain, the word itself without one. Null and empty texts have no words, repeated rows count again, further
    columns play no part, an empty table gives no rows. Words of any length take part.
    """
    words = common.staged(word_counts(docs), "op11-counts")
    links = common.staged(spelling_links(words), "op11-links")
    counted = links.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.minus")).alias("near_n"))
    joined = words.join(best, "word", "left").withColumn("takes", F.col("near_n") >= FORM_RATIO * F.col("n"))
    formed = common.staged(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("takes"), F.col("near")).alias("form"),
                                         F.when(F.col("takes"), F.col("near_n")).alias("form_n")), "op11-forms")
    roots = _roots(formed.filter("form is not null"))
    return (formed.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
