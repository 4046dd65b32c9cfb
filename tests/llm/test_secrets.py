"""op6: base patterns against plain searches, the tests of randomness, and what they add."""

import hashlib
import itertools
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from gidlake.llm import secrets
from tests.llm.conftest import ODD

PATTERNS = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 6),
            ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 24)]
PARTS = ["password", "TOKEN", "api_key", "apikey", '"', "'", " ", "=", ":", "abcdef", "x", "AKIA", "ABCDEF0123456789", "0123456789abcdef01234567", "é", "\n",
         "secret", "-", "9f", "passwd", "ToKen", "\U0001d4b3"]


def plain(text):
    return sorted((m.start(), secrets.KINDS.index(k), m.end(), k) for k, p, ok in PATTERNS for m in re.finditer(p, text or "", re.ASCII) if ok(m))


def test_base_spans(docs_of):
    rng = random.Random(2)
    docs = [(100 + i, "".join(rng.choices(PARTS, k=rng.randint(0, 14)))) for i in range(2000)]
    got = {r.doc_id: [tuple(s) for s in r.base] for r in secrets.secrets(docs_of(docs)).collect()}
    assert got == {d: plain(t) for d, t in docs}


def test_query_rows(docs_of, sf):
    rows = [(r.doc_id, r.text) for r in sf("documents").collect()] + ODD
    got = secrets.secret_digest(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for row in got:
        own = [plain(t) for d, t in rows if d == row.doc_id]
        texts = [",".join(f"{k}:{s}:{e}" for s, _, e, k in x) for x in own]
        assert row.base_sha256 in [hashlib.sha256(t.encode()).hexdigest() for t in texts]
        assert any([row[f"n_{k}"] for k in secrets.KINDS] == [Counter(y[3] for y in x)[k] for k in secrets.KINDS] for x in own)
    assert secrets.secret_digest(docs_of([])).count() == 0


def test_battery_tells_random_from_written(spark, docs_of):
    rng = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    docs = [(i, f"x {''.join(rng.choices(letters, k=40))} thisisalongidentifier{i}/withwords/andmore{i} 11111111111111111111a") for i in range(80)]
    added = [(s.start, s.end) for r in secrets.secrets(docs_of(docs)).collect() for s in r.added]
    assert set(added) == {(2, 42)} and len(added) >= 70


def test_p_values_are_uniform_for_random_tokens(spark):
    rng = random.Random(6)
    tokens = [("".join(rng.choices("0123456789abcdef", k=64)),) for _ in range(1500)]
    rows = secrets.tested(spark.createDataFrame(tokens, "token string")).select("p_chi", "p_runs", "p_serial", "p").collect()
    for column in range(4):
        assert abs(sum(r[column] < 0.2 for r in rows) / len(rows) - 0.2) < 0.06


def test_plan_has_no_python(docs_of):
    plan = secrets.secret_digest(docs_of(ODD))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_sums_before_each(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randrange(1000) for _ in range(n)]) for i, n in enumerate((0, 1, 63, 64, 65, 4096, 4097, 70_000))]
    frame = spark.createDataFrame(rows, "i int, v array<bigint>")
    got = {r.i: r.s for r in frame.select("i", secrets.before_each(F.col("v")).alias("s")).collect()}
    assert got == {i: [0, *itertools.accumulate(v)][:len(v)] for i, v in rows}


def test_candidates_beside_base_spans(spark, docs_of):
    rng = random.Random(5)
    hexes = ["".join(rng.choices("0123456789abcdef", k=32)) for _ in range(300)]
    bases = ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=40)) for _ in range(300)]
    text = " ".join(f"{h} {b} password={b} AKIA{b[:20].upper()}" for h, b in zip(hexes, bases, strict=True))
    row = secrets.secrets(docs_of([(1, text)])).first()
    assert [tuple(s) for s in row.base] == plain(text)
    tokens = [m.span() for m in re.finditer(secrets.CANDIDATE, text)]
    free = {(a, b) for a, b in tokens if not any(s.start < b and s.end > a for s in row.base)}
    added = [(s.start, s.end) for s in row.added]
    assert set(added) <= free and len(added) == len(set(added)) > 250


def test_time_is_linear_in_matches(spark, docs_of):
    def seconds(n):
        text = " ".join("".join(f"{(i * 2654435761) % 2**32:08x}{i:08x}{(i * 40503) % 2**32:08x}") for i in range(n))
        frame = secrets.secret_digest(docs_of([(1, text)]))
        begun = time.perf_counter()
        row = frame.first()
        assert row.n_hex == n and row.base_sha256 == hashlib.sha256(",".join(f"hex:{25 * i}:{25 * i + 24}" for i in range(n)).encode()).hexdigest()
        return time.perf_counter() - begun

    seconds(1_000)
    assert seconds(100_000) < 2.5 * seconds(50_000) + 4
