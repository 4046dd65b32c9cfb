"""op12: the prefix trie of rebuilt conversations, by fingerprints that compose.

A row of turns has the fingerprint sum(x_i * B^i) modulo four primes, x_i a hash of turn i. Rows compose: that of `s` after
`r` turns counts B^r times, and as B has an inverse, the part of a conversation behind its first h turns is its product less
that of its head. So a conversation's running products are made once, piece by piece in sorted ranges, and every prefix of a
rebuilt conversation is (base head) + (shift) * (own product - own head) in integers; no rebuilt text is ever made.

Conversations with a prefix of one fingerprint are members of one trie node. Members that refer to the same stored turn are
equal by construction; for all others the turns referred to are compared, and their parents. Should two differ, the hashes
start again from another seed.

Sums over subtrees need no walk either. A conversation is the smallest member of a suffix of its path, so each node belongs to one
conversation, and what a subtree holds is a sum over the members of its top.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gidlake.llm import common
from gidlake.operators.skew import in_pages, long_groups, skew_join

BASE_EVERY, HEADS = 100, 6
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587, 2_147_483_579)
BASES = (1_103_515_245, 1_140_671_485, 1_664_525_013, 1_082_269_761)
LOW = (1 << 31) - 1
# Conversation ids joined into one text; longer lists of ends are hashed page by page.
IDS_PER_PAGE = 10_000
SEEDS = 5

# Within a range: the place in its conversation, the products after and before a turn (two primes in a long), code points before.
_PRODUCTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("at", pa.int64()), ("a1", pa.int64()), ("a2", pa.int64()),
                       ("b1", pa.int64()), ("b2", pa.int64()), ("chars_before", pa.int64()), ("chars", pa.int64()), ("ref", pa.int64())])
_PRODUCTS_DDL = ", ".join(f"{f.name} {'int' if f.name == 'part' else 'long'}" for f in _PRODUCTS)


# --- products


def powers(base: int, prime: int, exponents: np.ndarray) -> np.ndarray:
    """base ^ exponents modulo prime, by squaring."""
    out, square, left = np.ones(len(exponents), np.int64), base % prime, exponents.astype(np.int64)
    while left.any():
        odd = (left & 1).astype(bool)
        out[odd] = out[odd] * square % prime
        square, left = square * square % prime, left >> 1
    return out


def _pack(lanes: list[np.ndarray]) -> list[np.ndarray]:
    return [lanes[0] << 31 | lanes[1], lanes[2] << 31 | lanes[3]]


def _unpack(first: np.ndarray, second: np.ndarray) -> list[np.ndarray]:
    return [first >> 31, first & LOW, second >> 31, second & LOW]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running products of the conversations of a sorted range; the last one goes on in the next batch."""
    common.release()
    open_conv, held, lanes_held, chars_held = None, 0, [0] * 4, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv, h1, h2, chars = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("conv_id", "h1", "h2", "chars"))
        first = np.concatenate([[True], conv[1:] != conv[:-1]])
        start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        goes_on = (start == 0) & (conv == open_conv if open_conv is not None else False)
        at = np.arange(n) - start + 1 + np.where(goes_on, held, 0)
        after, before = [], []
        for k, (prime, base) in enumerate(zip(PRIMES, BASES, strict=True)):
            term = np.mod(h1 if k < 2 else h2, prime) * powers(base, prime, at) % prime
            total = np.cumsum(term)
            sums = (total - (total - term)[start] + np.where(goes_on, lanes_held[k], 0)) % prime
            after.append(sums)
            before.append((sums - term) % prime)
        total = np.cumsum(chars)
        upto = total - (total - chars)[start] + np.where(goes_on, chars_held, 0)
        open_conv, held, lanes_held, chars_held = conv[-1], int(at[-1]), [int(x[-1]) for x in after], int(upto[-1])
        yield common.record_batch([batch.column("conv_id"), batch.column("part"), at, *_pack(after), *_pack(before), upto - chars, chars,
                                   batch.column("ref")], _PRODUCTS)


def _shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of ranges times B ^ (turns before the range), each prime's in its own column."""
    for batch in batches:
        before = batch.column("turns_before").to_numpy()
        lanes = _unpack(batch.column("a1").to_numpy(), batch.column("a2").to_numpy())
        power = [powers(b, p, before) for b, p in zip(BASES, PRIMES, strict=True)]
        moved = [x * q % p for x, q, p in zip(lanes, power, PRIMES, strict=True)]
        kept = [batch.column(c) for c in ("conv_id", "part", "turns_before", "chars_before", "n", "chars")]
        yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, moved), *map(pa.array, power)],
                                         names=["conv_id", "part", "turns_before", "chars_before", "n", "chars",
                                                *(f"m{k}" for k in range(4)), *(f"q{k}" for k in range(4))])


_SHIFT_DDL = "conv_id long, part int, turns_before long, chars_before long, n long, chars long, " + ", ".join(f"{c}{k} long" for c in "mq" for k in range(4))


def _lane(first: Column | str, second: Column | str, k: int) -> Column:
    packed = first if k < 2 else second
    return F.shiftright(packed, 31) if k % 2 == 0 else F.col(packed).bitwiseAND(LOW) if isinstance(packed, str) else packed.bitwiseAND(LOW)


def _packed(lanes: list[Column], first: str, second: str) -> list[Column]:
    return [F.shiftleft(lanes[0], 31).bitwiseOR(lanes[1]).alias(first), F.shiftleft(lanes[2], 31).bitwiseOR(lanes[3]).alias(second)]


def stored_turns(conversations: DataFrame) -> DataFrame:
    """Turns as they come, with a reference to each; role and text are never null. Written once; the texts are not moved again."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")}
    rows = conversations.filter(F.col("conv_id").cast("long").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), text["role"].alias("role"), text["text"].alias("text"))
    return common.staged(rows.withColumn("ref", F.monotonically_increasing_id()), "op12-turns")


def products(turns: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(running products of turns within sorted ranges, what came before each range of a conversation).

    Turns are sorted in ranges over the whole table, so a conversation of any length is spread over tasks. Turns that tie
    are ordered by role and hash.
    """
    hashed = turns.select("conv_id", "turn", "role", F.xxhash64(F.lit(2 * seed), "role", "text").alias("h1"),
                          F.xxhash64(F.lit(2 * seed + 1), "role", "text").alias("h2"), F.length("text").cast("long").alias("chars"), "ref")
    order = ["conv_id", "turn", "role", "h1", "h2", "ref"]
    ranged = hashed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    placed = common.staged(ranged.mapInArrow(_scan, _PRODUCTS_DDL), "op12-products")
    ranges = placed.groupBy("conv_id", "part").agg(F.max("at").alias("n"), F.max_by("a1", "at").alias("a1"), F.max_by("a2", "at").alias("a2"),
                                                   F.sum("chars").alias("chars"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = ranges.select("*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("turns_before"),
                            F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars_before"))
    moved = counted.mapInArrow(_shift, _SHIFT_DDL)
    came = [(F.coalesce(F.sum(f"m{k}").over(before), F.lit(0)) % p).alias(f"g{k}") for k, p in enumerate(PRIMES)]
    return placed, common.staged(moved.select("conv_id", "part", "turns_before", "chars_before", "n", "chars", *(f"q{k}" for k in range(4)), *came),
                                 "op12-ranges")


def _whole(joined: DataFrame) -> DataFrame:
    """Products and places in the whole conversation, from those in a range and what came before it (columns q, g, turns_before)."""
    def moved(first: str, second: str, out: tuple[str, str]) -> list[Column]:
        lanes = [(_lane(first, second, k) * F.col(f"q{k}") + F.col(f"g{k}")) % p for k, p in enumerate(PRIMES)]
        return _packed(lanes, *out)

    return joined.withColumns({c: v for pair, names in ((("a1", "a2"), ("after1", "after2")), (("b1", "b2"), ("before1", "before2")))
                               for c, v in zip(names, moved(*pair, names), strict=True)}
                              | {"rank": F.col("turns_before") + F.col("at"), "chars_ahead": F.col("range_chars_before") + F.col("chars_before")})


# --- rebuilt conversations


def rebuilt(placed: DataFrame, ranges: DataFrame, every: int = BASE_EVERY, heads: int = HEADS) -> DataFrame:
    """A row for each prefix of each rebuilt conversation: (conv_id, node, parent, chars_before, ref, last, total).

    node and parent are (depth, two fingerprints); the root's parent and reference are null. `last` marks the whole conversation, and
    `total` are its code points.
    """
    ranges = ranges.withColumnRenamed("chars_before", "range_chars_before").withColumnRenamed("n", "range_n").withColumnRenamed("chars", "range_chars")
    keys = ["conv_id", "part"]
    opening = _whole(placed.filter(F.col("at") < heads).join(ranges.filter(F.col("turns_before") < heads), keys)).filter(F.col("rank") < heads)
    entry = F.struct("rank", "after1", "after2", "before1", "before2", "chars_ahead", "chars", "ref")
    opened = common.staged(opening.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("head")), "op12-heads")  # fewer than `heads` each
    sizes = ranges.groupBy("conv_id").agg(F.sum("range_n").alias("n"), F.sum("range_chars").alias("own_chars"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    of_base = opened.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    nothing = F.array().cast(opened.schema["head"].dataType)
    plan = (sizes.join(opened, "conv_id").select("*", h.alias("h"), base).join(of_base, "base", "left")
            .withColumn("base_head", F.slice(F.coalesce("base_head", nothing), F.lit(1), F.col("h"))))
    zero = F.struct(*(F.lit(0).cast("long").alias(c) for c in ("after1", "after2", "chars_upto")))

    def end(head: str, n: Column) -> Column:
        found = F.get(head, n - 1)
        return F.when(n > 0, F.struct(found["after1"].alias("after1"), found["after2"].alias("after2"),
                                      (found["chars_ahead"] + found["chars"]).alias("chars_upto"))).otherwise(zero)

    plan = plan.withColumn("taken", F.size("base_head")).withColumn("goes_on", F.col("n") > F.col("h")).select(
        "conv_id", "n", "h", "taken", "goes_on", "base_head", end("base_head", F.col("taken")).alias("from"),
        F.when(F.col("goes_on"), end("head", F.col("h"))).otherwise(zero).alias("less"), "own_chars")
    plan = common.staged(plan.withColumn("total", F.col("from.chars_upto") + F.when(F.col("goes_on"), F.col("own_chars") - F.col("less.chars_upto")).otherwise(0)),
                         "op12-plan")

    def node(depth: Column, first: Column, second: Column) -> Column:
        return F.struct(depth.cast("long").alias("depth"), first.alias("f1"), second.alias("f2"))

    nil = F.lit(0).cast("long")
    root = plan.select("conv_id", node(nil, nil, nil).alias("node"), F.lit(None).cast("struct<depth:bigint,f1:bigint,f2:bigint>").alias("parent"),
                       nil.alias("chars_before"), F.lit(None).cast("long").alias("ref"), ((F.col("taken") == 0) & ~F.col("goes_on")).alias("last"), "total")
    turn = plan.select("conv_id", F.explode("base_head").alias("t"), "taken", "goes_on", "total")
    depth = F.col("t.rank")
    headed = turn.select("conv_id", node(depth, F.col("t.after1"), F.col("t.after2")).alias("node"),
                         node(depth - 1, F.col("t.before1"), F.col("t.before2")).alias("parent"), F.col("t.chars_ahead").alias("chars_before"), "t.ref",
                         ((depth == F.col("taken")) & ~F.col("goes_on")).alias("last"), "total")
    # Behind the head: a range of a conversation brings all it needs, so a long one stays spread over its ranges.
    tails = ranges.join(plan.filter("goes_on").drop("base_head", "goes_on", "own_chars"), "conv_id")
    own = _whole(placed.join(tails, keys)).filter(F.col("rank") > F.col("h"))
    back = [F.get(F.array(*(F.lit(pow(b, -k, p)).cast("long") for k in range(heads))), F.col("h") - F.col("taken")) for b, p in zip(BASES, PRIMES, strict=True)]

    def behind(first: str, second: str) -> list[Column]:
        lanes = []
        for k, p in enumerate(PRIMES):
            gone = F.pmod(_lane(first, second, k) - _lane(F.col("less.after1"), F.col("less.after2"), k), F.lit(p))
            lanes.append((gone * back[k] + _lane(F.col("from.after1"), F.col("from.after2"), k)) % p)
        return _packed(lanes, first, second)

    depth = F.col("rank") - F.col("h") + F.col("taken")
    followed = own.select("conv_id", node(depth, *behind("after1", "after2")).alias("node"), node(depth - 1, *behind("before1", "before2")).alias("parent"),
                          (F.col("from.chars_upto") + F.col("chars_ahead") - F.col("less.chars_upto")).alias("chars_before"), "ref",
                          (F.col("rank") == F.col("n")).alias("last"), "total")
    return common.staged(root.unionByName(headed).unionByName(followed), "op12-prefixes")


# --- nodes


def _nodes(rows: DataFrame) -> DataFrame:
    return common.staged(rows.groupBy("node").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("chars_before").alias("chars_before"),
        F.min("parent").alias("parent"), F.max("parent").alias("other_parent"), F.min("ref").alias("ref"), F.max("ref").alias("other_ref")), "op12-nodes")


def differing(rows: DataFrame, nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes whose members are not equal: other parents, or other turns behind different references. Texts of turns that all
    members refer to are not read."""
    apart = nodes.filter("parent <> other_parent").select("node")
    several = nodes.filter("ref <> other_ref").select("node")
    refs = rows.join(several, "node", "left_semi").select("node", "ref").distinct()
    said = refs.join(turns.select("ref", F.struct("role", "text").alias("turn")), "ref")
    unlike = said.groupBy("node").agg(F.min("turn").alias("low"), F.max("turn").alias("high")).filter("low <> high").select("node")
    return apart.unionByName(unlike)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash for each node over its pages, which come in order; only a page at a time is held."""
    open_node, digest = None, None
    for batch in batches:
        nodes, hashes = [], []
        for node, page in zip(batch.column("node").to_pylist(), batch.column("page").to_pylist(), strict=True):
            if node != open_node:
                if open_node is not None:
                    nodes.append(open_node)
                    hashes.append(digest.hexdigest())
                open_node, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(page.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, _NODE), pa.array(hashes, pa.string())], names=["node", "ends_sha256"])
    if open_node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([open_node], _NODE), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])


_NODE = pa.struct([("depth", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64())])


def ends(rows: DataFrame, page: int = IDS_PER_PAGE) -> DataFrame:
    """(node, ends_sha256) of nodes where conversations end. Ids are sorted and joined in pages, by many tasks for a node with very
    many; the hash then runs over a node's pages in order."""
    last = common.staged(rows.filter("last").select("node", "conv_id"), "op12-ends")
    paged = in_pages(last, "node", ["conv_id"], page, long_groups(last, "node", page))
    texts = paged.groupBy("node", "part").agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("page"))
    return (texts.repartition("node").sortWithinPartitions("node", "part").select("node", "page")
            .mapInArrow(_hash_ends, "node struct<depth: long, f1: long, f2: long>, ends_sha256 string"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """op12: one row per trie node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null role or text is empty; rows without a conv_id are left out; turns without a number come first, and ties are ordered by role
    and hash. Repeated rows are turns of their own. Texts of any length and conversations of any number of turns take part,
    further columns do not. An empty table gives no rows, not even the root.
    """
    turns = stored_turns(conversations)
    for seed in range(SEEDS):
        rows = rebuilt(*products(turns, seed))
        nodes = _nodes(rows)
        if differing(rows, nodes, turns).isEmpty():
            break
    else:
        raise RuntimeError(f"fingerprints of different turns met under {SEEDS} seeds")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = common.staged(nodes.select("node", "n_convs", "conv_id", "chars_before", "parent").join(children, "node", "left")
                          .withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "op12-trie")
    # What a conversation owns: the nodes whose smallest member it is, a suffix of its path, and perhaps a leaf.
    owned = nodes.groupBy("conv_id").agg(F.min_by("chars_before", "node.depth").alias("not_owned"), F.max((F.col("n_children") == 0).cast("int")).alias("leaf"))
    owned = common.staged(owned, "op12-owned")
    shares = skew_join(rows.select("node", "conv_id", "total"), owned, "conv_id", "left", spread=F.col("node")).select(
        "node", "conv_id", "total", F.coalesce(F.col("total") - F.col("not_owned"), F.lit(0)).alias("owned"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    sums = shares.groupBy("node").agg(F.sum("total").alias("all_chars"), F.sum("owned").alias("all_owned"), F.sum("leaf").alias("n_leaves"),
                                      F.min_by("total", "conv_id").alias("own_total"), F.min_by("owned", "conv_id").alias("own_owned"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    joined = nodes.join(sums, "node").join(ends(rows), "node", "left")
    joined = skew_join(joined, parents, "parent", "left", spread=F.col("conv_id"))
    # Code points of all members below the node's parent, less those of each distinct node once.
    every = F.col("all_chars") - F.col("n_convs") * F.col("chars_before")
    once = F.col("own_total") - F.col("chars_before") + F.col("all_owned") - F.col("own_owned")
    return joined.select("conv_id", F.col("node.depth").alias("depth"), "parent_conv_id", "n_convs", "n_children", F.col("n_leaves").cast("long").alias("n_leaves"),
                         (every - once).cast("long").alias("saved_tokens"),
                         F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
