"""op6: secrets by base patterns and a battery of randomness tests, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gidlake.llm import common

KINDS = ("assign", "access", "hex")
# The base patterns and the least length of what counts.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_LEAST = 6
# Tokens the battery tests: runs of encoding characters from this length on that have a digit and a letter.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
# Tokens of one stratum (an encoding, a range of lengths) are accepted together, at this share of false ones at most.
FALSE_SHARE, BINS = 0.1, 200

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# The encodings a token may have, the first whose pattern fits, and their alphabets.
ENCODINGS = (("hex", "[0-9a-f]+", _DIGITS + "abcdef"), ("HEX", "[0-9A-F]+", _DIGITS + "ABCDEF"), ("base32", "[A-Z2-7]+", _UPPER + "234567"),
             ("base36", "[0-9a-z]+", _DIGITS + _LOWER), ("BASE36", "[0-9A-Z]+", _DIGITS + _UPPER), ("base64", ".+", _UPPER + _LOWER + _DIGITS + "+/"))


# Running sums are made in blocks of so many values, and of blocks of blocks: copying an array for each value costs a block, not the row.
BLOCK = 64


def _bound(value: Column, use) -> Column:
    """use(value), with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def before_each(values: Column, levels: int = 4) -> Column:
    """For each of an array of numbers, the sum of those before it. The work is linear up to BLOCK ** levels values."""
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")

    def short(block: Column, start: Column) -> Column:
        state = F.struct(start.alias("at"), none.alias("out"))
        return F.aggregate(block, state, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
                           lambda acc: acc["out"])

    if levels == 1:
        return short(values, zero)

    def long(array: Column) -> Column:
        starts = F.when(F.size(array) > 0, F.sequence(F.lit(0), F.floor((F.size(array) - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))
        blocks = F.transform(starts, lambda k: F.slice(array, k * BLOCK + 1, F.lit(BLOCK)))

        def joined(cut: Column) -> Column:
            sums = F.transform(cut, lambda block: F.aggregate(block, zero, lambda acc, x: acc + x))
            return F.flatten(F.zip_with(cut, before_each(sums, levels - 1), short))

        return F.when(F.size(array) <= BLOCK, short(array, zero)).otherwise(_bound(blocks, joined))

    return _bound(values, long)


def located(text: Column, pattern: str) -> Column:
    """Matches of a pattern as array<struct<start, end, token>> in code points, from the texts between them."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda b, m: F.struct(F.length(b).cast("long").alias("gap"), m.alias("token")))

    def placed(pairs: Column) -> Column:
        ahead = before_each(F.transform(pairs, lambda x: x["gap"] + F.length(x["token"])))
        return F.zip_with(pairs, ahead, lambda x, at: F.struct(
            (at + x["gap"]).cast("int").alias("start"), (at + x["gap"] + F.length(x["token"])).cast("int").alias("end"), x["token"].alias("token")))

    return _bound(pairs, placed)


def _when(test: Column, found: Column) -> Column:
    return F.when(test, found).otherwise(F.array().cast("array<struct<start:int,end:int,token:string>>"))


def _named(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def base_and_candidates(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, base, candidates) of every row. A cheap test on each text decides whether its matches are located."""
    text = F.col("text")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    assign = F.filter(located(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["token"], ASSIGN, 2)) >= ASSIGN_LEAST)
    base = F.concat(_named(_when(text.rlike(ASSIGN), assign), "assign"), _named(_when(text.contains("AKIA"), located(text, ACCESS)), "access"),
                    _named(_when(text.rlike(HEX), located(text, HEX)), "hex"))
    candidates = F.filter(_when(text.rlike(CANDIDATE), located(text, CANDIDATE)), lambda s: s["token"].rlike("[0-9]") & s["token"].rlike("[A-Za-z]"))
    return rows.select("rid", "doc_id", F.sort_array(base).alias("base"), candidates.alias("candidates"))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal, by a rational approximation that is good to 1e-7."""
    # Coefficients of formula 26.2.17 in Abramowitz and Stegun.
    t = F.lit(1.0) / (1 + 0.2316419 * F.abs(z))
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-z * z / 2) / 2.5066282746310002 * series
    return F.greatest(F.when(z >= 0, tail).otherwise(1 - tail), F.lit(1e-300))


def _both_tails(z: Column) -> Column:
    return F.least(2 * _upper_tail(F.abs(z)), F.lit(1.0))


def tested(candidates: DataFrame) -> DataFrame:
    """Rows with a `token` get its inferred encoding, the p-value of each test and `p`, all under the hypothesis of randomness.

    chi-squared: symbol counts against a uniform alphabet. Runs: changes between the halves of the alphabet. Serial
    correlation: of neighbouring symbol values. Fisher's sum joins the three. Values that a test can't judge give 1.
    """
    plain = F.translate("token", "-_=", "+/")
    encoding = F.coalesce(*(F.when(plain.rlike(f"^{pattern}$"), F.lit(name)) for name, pattern, _ in ENCODINGS))
    alphabet = F.coalesce(*(F.when(F.col("encoding") == name, F.lit(letters)) for name, _, letters in ENCODINGS))
    d = (candidates.withColumn("plain", plain).withColumn("encoding", encoding).withColumn("alphabet", alphabet)
         .withColumn("n", F.length("plain").cast("double")).withColumn("symbols", F.length("alphabet").cast("double")))
    squares = F.aggregate(F.split("alphabet", ""), F.lit(0.0), lambda acc, s: acc + F.when(
        F.length(s) == 0, 0.0).otherwise(F.pow(F.length("plain") - F.length(F.replace(F.col("plain"), s, F.lit(""))), F.lit(2))))
    d = d.withColumn("chi", F.col("symbols") / F.col("n") * squares - F.col("n"))
    free = F.col("symbols") - 1
    cube = (F.pow(F.greatest("chi", F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    d = d.withColumn("p_chi", _upper_tail(cube))
    d = d.withColumn("v", F.expr("transform(filter(split(plain, ''), c -> length(c) = 1), c -> cast(instr(alphabet, c) as double))"))
    d = d.withColumn("mean", F.expr("aggregate(v, 0D, (a, x) -> a + x) / n"))
    d = d.withColumn("high", F.expr("cast(size(filter(v, x -> x > symbols / 2)) as double)")).withColumn("low", F.col("n") - F.col("high"))
    steps = "zip_with(slice(v, 1, size(v) - 1), slice(v, 2, size(v) - 1), (x, y) -> {})"
    d = d.withColumn("runs", F.expr(f"1 + aggregate({steps.format('if((x > symbols / 2) <> (y > symbols / 2), 1D, 0D)')}, 0D, (a, x) -> a + x)"))
    d = d.withColumn("lagged", F.expr(f"aggregate({steps.format('(x - mean) * (y - mean)')}, 0D, (a, x) -> a + x)"))
    d = d.withColumn("spread", F.expr("aggregate(v, 0D, (a, x) -> a + (x - mean) * (x - mean))"))
    both = 2 * F.col("high") * F.col("low")
    runs_sd = F.sqrt(F.greatest(both * (both - F.col("n")) / (F.col("n") * F.col("n") * (F.col("n") - 1)), F.lit(1e-12)))
    d = d.withColumn("p_runs", F.when(both > F.col("n"), _both_tails((F.col("runs") - 1 - both / F.col("n")) / runs_sd)).otherwise(1e-6))
    d = d.withColumn("p_serial", F.when(F.col("spread") > 0, _both_tails((F.col("lagged") / F.col("spread") + 1 / (F.col("n") - 1)) * F.sqrt("n"))).otherwise(1e-6))
    x = -(F.log("p_chi") + F.log("p_runs") + F.log("p_serial"))
    d = d.withColumn("x", x).withColumn("p", F.least(F.exp(-F.col("x")) * (1 + F.col("x") + F.col("x") * F.col("x") / 2), F.lit(1.0)))
    length = F.least(F.floor(2 * F.log2(F.col("n") / 20)), F.lit(12)).cast("string")
    return d.withColumn("stratum", F.concat_ws("/", "encoding", length)).drop("plain", "alphabet", "symbols", "v", "mean", "high", "low", "lagged", "spread", "x")


def thresholds(tests: DataFrame, false_share: float = FALSE_SHARE) -> dict[str, float]:
    """For each stratum, the least p from which tokens are accepted; strata without one are left out.

    Random tokens have uniform p-values, others gather near 0, the more so the longer they are. Twice the tokens above one
    half is the number of random ones, so the share of false ones above any p can be told; the least p at which it is
    within `false_share` is taken. Counts by p over all tokens of the corpus: at most BINS rows for each of some 80 strata.
    """
    counts = tests.groupBy("stratum", F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")).count().collect()
    by: dict[str, list[int]] = {}
    for r in counts:
        by.setdefault(r.stratum, [0] * BINS)[r.bin] += r["count"]
    out = {}
    for name, bins in by.items():
        random = min(sum(bins), 2 * sum(bins[BINS // 2:]))
        above = 0
        for b in range(BINS - 1, -1, -1):
            above += bins[b]
            if above and 1 - random * (1 - b / BINS) / above <= false_share:
                out[name] = b / BINS
    return out


def _free(rows: DataFrame) -> DataFrame:
    """(rid, start, end, token, free) of every candidate; free: no base span of its text overlaps it.

    A base span overlaps if it begins before the candidate's end and ends behind its start. So in the order of these places, the largest
    end of the base spans so far tells, and no candidate is held against all spans.
    """
    span = "struct<start:int,end:int,token:string>"
    candidates = rows.filter(F.size("candidates") > 0)
    alone = candidates.filter(F.size("base") == 0).select("rid", F.explode("candidates").alias("c"), F.lit(True).alias("free"))
    mixed = candidates.filter(F.size("base") > 0)
    marks = mixed.select("rid", F.explode("base").alias("b")).select("rid", F.col("b.start").alias("place"), F.lit(1).alias("side"), F.col("b.end").alias("upto"),
                                                                    F.lit(None).cast(span).alias("c"))
    asked = mixed.select("rid", F.explode("candidates").alias("c")).select("rid", F.col("c.end").alias("place"), F.lit(0).alias("side"), F.lit(None).cast("int").alias("upto"), "c")
    so_far = F.max("upto").over(Window.partitionBy("rid").orderBy("place", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    judged = (marks.unionByName(asked).withColumn("last", so_far).filter("side = 0")
              .select("rid", "c", (F.coalesce("last", F.lit(0)) <= F.col("c.start")).alias("free")))
    return alone.unionByName(judged).select("rid", "free", F.col("c.start").alias("start"), F.col("c.end").alias("end"), F.col("c.token").alias("token"))


def secrets(docs: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """(doc_id, base, added) of every row: sorted spans struct<start, rank, end, kind>, ends exclusive, in code points.

    Added spans have the kind `random` and overlap no base span. Null and empty texts have none; repeated rows are treated alike.
    The work is linear in a text's length and its matches, however many; an empty table gives no rows.
    """
    rows = common.staged(base_and_candidates(docs), "op6-rows")
    tests = common.staged(tested(_free(rows)), "op6-tests")
    least = thresholds(tests, false_share)
    limit = F.create_map(*(F.lit(x) for pair in least.items() for x in pair))[F.col("stratum")] if least else F.lit(None).cast("double")
    span = F.struct("start", F.lit(len(KINDS)).alias("rank"), "end", F.lit("random").alias("kind"))
    added = tests.filter(F.col("free") & (F.col("p") >= limit)).groupBy("rid").agg(F.sort_array(F.collect_list(span)).alias("added"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return rows.join(added, "rid", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def secret_digest(docs: DataFrame) -> DataFrame:
    """op6: counts of base spans by kind, the digest of all base spans, and all spans as text, by start, then kind as listed.

    Null and empty texts have none, texts of any length are read whole, repeated rows and rows without an id are treated like any other, further
    columns play no part, an empty table gives no rows.
    """

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return secrets(docs).select("doc_id", *map(number, KINDS), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                                listed(F.sort_array(F.concat("base", "added"))).alias("spans"))
