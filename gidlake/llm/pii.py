"""op1: personal data by base patterns and a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gidlake.llm import common

KINDS = ("email", "ip", "card", "phone")
# The label set, outside first, then begin and inside of each kind.
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
# Bounds of the labelled table: documents of the corpus read for it, and sequences taken from them.
SAMPLE_DOCS, SAMPLE_SEQUENCES, SAMPLE_TOKENS = 2000, 1500, 12
STEPS, RATE, RIDGE = 120, 0.2, 0.01

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
# Tokens the model decides on; every other token is outside by definition and ends a sequence.
_CANDIDATE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _ip_ok(text: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in text.split(".")))


def _card_ok(text: str) -> bool:
    digits = "".join(_DIGITS.findall(text)) if len(text) <= 40 else ""
    return 13 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(text: str) -> bool:
    return 9 <= len(_DIGITS.findall(text)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches around each @, so that long words without one cost nothing twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:  # what stands before this @ can't be part of a later match
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern matches by kind as listed, then start."""
    found = [("email", s, e) for s, e in _emails(text)]
    if "." in text:
        found += [("ip", *m.span()) for m in _IP.finditer(text) if _ip_ok(m.group())]
    found += [("card", *m.span()) for m in _CARD.finditer(text) if _card_ok(m.group())]
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if _phone_ok(m.group())]
    return found


# --- sequences and features


def sequences(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring candidate tokens with one character between them, as spans."""
    out: list[list[tuple[int, int]]] = []
    for m in _CANDIDATE.finditer(text):
        if out and m.start() == out[-1][-1][1] + 1:
            out[-1].append(m.span())
        else:
            out.append([m.span()])
    return out


def shape(token: str) -> str:
    """Capital, small and digit runs as one letter each; other characters as they are. Long shapes keep both ends."""
    s = re.sub(r"\d+", "9", re.sub(r"[^\W\d_A-Z]+", "a", re.sub(r"[A-Z]+", "A", token)))
    return s if len(s) <= 24 else f"{s[:12]}~{s[-8:]}"


# Only short tokens are remembered.
@lru_cache(maxsize=20_000)
def _short_features(token: str) -> tuple[str, ...]:
    return _own_features(token)


def _own_features(token: str) -> tuple[str, ...]:
    core = token.strip("\"'<>[](){}.,;:!?")
    n = sum(map(str.isdigit, token))
    at = core.count("@")
    return (f"s={shape(core)}", f"n={min(n, 20)}", f"l={min(len(token), 24) // 3}", f"f={token[0] if not token[0].isalnum() else ''}",
            f"at={min(at, 2)}", f"dom={at == 1 and bool(_DOMAIN.fullmatch(core.rpartition('@')[2]))}",
            f"ip={core.count('.') == 3 and core.replace('.', '').isdigit() and all(core.split('.')) and _ip_ok(core)}",
            f"luhn={_card_ok(core)}", f"only={bool(re.fullmatch(r'[0-9]+', core))}", f"tel={bool(re.fullmatch(r'[+]?[0-9().-]+', core))}")


def features(tokens: list[str]) -> list[tuple[str, ...]]:
    own = [(_short_features if len(t) <= 64 else _own_features)(t) for t in tokens]
    shapes = ["^", *(f[0] for f in own), "$"]
    joined = "".join(tokens) if len(tokens) <= 8 else ""
    card = f"run={bool(joined) and _card_ok(joined)}"
    return [(*f, f"p{shapes[i]}", f"q{shapes[i + 2]}", card, f"sp{f[0]}{shapes[i]}", "1") for i, f in enumerate(own)]


def tags_of(tokens: list[tuple[int, int]], spans: list[tuple[str, int, int]]) -> list[str]:
    """Begin and inside marks of the tokens that a span overlaps."""
    tags = ["O"] * len(tokens)
    for kind, start, end in spans:
        inside = [i for i, (s, e) in enumerate(tokens) if s < end and e > start]
        for k, i in enumerate(inside):
            tags[i] = f"{'I' if k else 'B'}-{kind}"
    return tags


def seed_table(rows: int = 600, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """Small labelled table of invented sequences: ways to write each kind, and numbers that are none of them."""
    rng = random.Random(seed)

    def digits(n: int) -> str:
        return "".join(rng.choices("0123456789", k=n))

    def card(valid: bool) -> str:
        body = f"4{digits(14)}"
        return next(body + d for d in "0123456789" if luhn(body + d) == valid)

    def address(top: int) -> str:
        return ".".join(str(rng.randint(1, 254)) if i else str(top) for i in range(4))

    def word(n: int = 6) -> str:
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))

    def four(text: str, sep: str) -> str:
        return sep.join(text[i:i + 4] for i in range(0, 16, 4))

    kinds = [
        ("email", lambda: f"{word()}.{digits(2)}@{word()}{digits(1)}.{word(7)}.com"), ("email", lambda: f"<{word()}@{word()}.org>"),
        ("email", lambda: f"{word()}@{word()}.net,"), ("ip", lambda: address(rng.randint(1, 254))), ("ip", lambda: f"{address(10)}:{digits(4)}"),
        ("ip", lambda: f"[{address(172)}]."), ("card", lambda: card(True)), ("card", lambda: four(card(True), " ")),
        ("card", lambda: four(card(True), "-")), ("phone", lambda: f"+1 ({digits(3)}) {digits(3)}-{digits(4)}"),
        ("phone", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}"), ("phone", lambda: f"{digits(3)}-{digits(3)}-{digits(4)}"),
        ("phone", lambda: f"+44 20 {digits(4)} {digits(4)}"), ("phone", lambda: f"+{digits(11)}"),
        ("O", lambda: f"{rng.randint(1900, 2030)}"), ("O", lambda: f"{digits(1)}.{digits(1)}"), ("O", lambda: f"{digits(1)}.{digits(1)}.{digits(2)}"),
        ("O", lambda: f"20{digits(2)}-0{digits(1)}-1{digits(1)}"), ("O", lambda: f"1{digits(1)}:3{digits(1)}"), ("O", lambda: f"${digits(1)},{digits(3)}.50"),
        ("O", lambda: card(False)), ("O", lambda: f"{rng.randint(256, 999)}.{rng.randint(256, 999)}.{digits(2)}.{digits(2)}"), ("O", lambda: digits(10)),
        ("O", lambda: f"password={hashlib.md5(digits(9).encode()).hexdigest()}"), ("O", lambda: f"AKIA{word(8).upper()}{digits(4)}"),
        ("O", lambda: f"@{word()}"), ("O", lambda: f"{word()}@{word()}"), ("O", lambda: f"{digits(1)}."), ("O", lambda: f"{digits(2)}%"),
    ]
    table = []
    for i in range(rows):
        tokens, tags = [], []
        for kind, make in [kinds[i % len(kinds)], *rng.choices(kinds, k=rng.choice((0, 0, 1)))]:
            part = make().split()
            tokens += part
            tags += ["O"] * len(part) if kind == "O" else [f"B-{kind}"] + [f"I-{kind}"] * (len(part) - 1)
        table.append((tokens, tags))
    return table


# --- the model


class ChainCRF:
    """Linear-chain conditional random field: a weight for each (feature, label) and for each pair of labels in a row."""

    def __init__(self, table: list[tuple[list[str], list[str]]]):
        feats = [features(t) for t, _ in table]
        self.index = {f: i for i, f in enumerate(sorted({f for row in feats for token in row for f in token}))}
        n, width, k = len(table), max(len(t) for t, _ in table), len(LABELS)
        gold, mask = np.zeros((n, width), np.int64), np.zeros((n, width), bool)
        x = np.zeros((sum(map(len, feats)), len(self.index)))
        at = 0
        for r, (row, (_, tags)) in enumerate(zip(feats, table, strict=True)):
            for t, token in enumerate(row):
                x[at, [self.index[f] for f in token]] = 1
                gold[r, t], mask[r, t] = LABELS.index(tags[t]), True
                at += 1
        self.weights, self.moves = np.zeros((len(self.index), k)), np.zeros((k, k))
        self._train(x, gold, mask)

    def _train(self, x: np.ndarray, gold: np.ndarray, mask: np.ndarray) -> None:
        """Gradient steps of fixed number on the penalised likelihood, each parameter scaled by its past gradients (Adam)."""
        n, width = gold.shape
        k = len(LABELS)
        real = np.flatnonzero(mask.ravel())
        one = np.eye(k)[gold] * mask[..., None]
        pairs = np.einsum("nta,ntb->ab", one[:, :-1], one[:, 1:])
        moments = [np.zeros_like(p) for p in (self.weights, self.weights, self.moves, self.moves)]
        for step in range(1, STEPS + 1):
            score = np.zeros((n * width, k))
            score[real] = x @ self.weights
            unary, pair = self._marginals(score.reshape(n, width, k), mask)
            grads = (x.T @ (one - unary).reshape(-1, k)[real] / n - RIDGE * self.weights / 10, (pairs - pair) / n - RIDGE * self.moves / 10)
            for i, (p, g) in enumerate(zip((self.weights, self.moves), grads, strict=True)):
                m, v = moments[2 * i], moments[2 * i + 1]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _marginals(self, score: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each label and expected label pairs, by the forward and backward sums."""
        n, width, k = score.shape

        def total(a: np.ndarray, axis: int) -> np.ndarray:
            top = a.max(axis, keepdims=True)
            return np.log(np.exp(a - top).sum(axis)) + top.squeeze(axis)

        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for t in range(1, width):
            step = total(forward[:, t - 1, :, None] + self.moves, 1) + score[:, t]
            forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
        z = total(forward[:, -1], 1)
        for t in range(width - 2, -1, -1):
            step = total(self.moves + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], step, 0)
        unary = np.exp(forward + backward - z[:, None, None]) * mask[..., None]
        both = forward[:, :-1, :, None] + self.moves + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - z[:, None, None, None]
        return unary, (np.exp(np.minimum(both, 0)) * mask[:, 1:, None, None]).sum((0, 1))

    def decode(self, rows: list[list[str]], batch: int = 4096) -> list[list[int]]:
        """The best labels of each token sequence by Viterbi, in batches of sequences of like length. Ties take the first label."""
        out: list[list[int]] = [[] for _ in rows]
        order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
        while order:
            width = len(rows[order[0]])
            part = order[:max(1, batch * 8 // max(width, 1))]
            order = order[len(part):]
            sizes = np.array([len(rows[i]) for i in part])
            score = np.zeros((len(part), width, len(LABELS)))
            for r, i in enumerate(part):
                for t, own in enumerate(features(rows[i])):
                    score[r, t] = self.weights[[self.index[f] for f in own if f in self.index]].sum(0)
            best, back = score[:, 0], np.zeros((len(part), width, len(LABELS)), np.int64)
            final = best.copy()
            for t in range(1, width):
                reach = best[:, :, None] + self.moves
                back[:, t] = reach.argmax(1)
                best = reach.max(1) + score[:, t]
                final[sizes > t] = best[sizes > t]
            last = final.argmax(1)
            for r, i in enumerate(part):
                path = [int(last[r])]
                for t in range(sizes[r] - 1, 0, -1):
                    path.append(int(back[r, t, path[-1]]))
                out[i] = path[::-1]
        return out


_VALID = {"email": lambda t: bool(re.search(r"[^\s@]@[^\s@]+\.[^\s@]", t)), "ip": lambda t: bool((m := _IP.search(t)) and _ip_ok(m.group())),
          "card": _card_ok, "phone": _phone_ok}


def _spans(tokens: list[tuple[int, int]], labels: list[int], text: str) -> list[tuple[str, int, int]]:
    """Chunks of decoded tokens as spans without the marks around them; a chunk without the digits of its kind is dropped."""
    out, i = [], 0
    while i < len(tokens):
        name = LABELS[labels[i]]
        j = i + 1
        while j < len(tokens) and name != "O" and LABELS[labels[j]] == f"I-{name[2:]}":
            j += 1
        if name != "O":
            start, end = tokens[i][0], tokens[j - 1][1]
            while start < end and not (text[start].isalnum() or text[start] in "+("):
                start += 1
            while start < end and not text[end - 1].isalnum():
                end -= 1
            if start < end and _VALID[name[2:]](text[start:end]):
                out.append((name[2:], start, end))
        i = j
    return out


def find_spans(texts: list[str], model: ChainCRF) -> list[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
    """(base spans, spans the model adds) of each text. An added span overlaps no base span of any kind."""
    base = [base_spans(t) for t in texts]
    runs = [(k, run) for k, t in enumerate(texts) for run in sequences(t)]
    labels = model.decode([[texts[k][s:e] for s, e in run] for k, run in runs])
    added: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    free = [_outside(spans) for spans in base]
    for (k, run), own in zip(runs, labels, strict=True):
        added[k] += [x for x in _spans(run, own, texts[k]) if free[k](x[1], x[2])]
    return list(zip(base, added, strict=True))


def _outside(spans: list[tuple[str, int, int]]) -> Callable[[int, int], bool]:
    """Tells whether a place overlaps none of the spans: of those that begin before its end, the largest end so far decides."""
    starts = sorted(s for _, s, _ in spans)
    ends = list(accumulate((e for _, _, e in sorted(spans, key=lambda x: x[1])), max))

    def free(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return not before or ends[before - 1] <= start

    return free


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.release()
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("tokens", pa.list_(pa.string())), ("tags", pa.list_(pa.string()))])
    for batch in common.slices(batches):
        rows = []
        for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            text = raw.decode()
            spans = base_spans(text)
            for n, run in enumerate(sequences(text)):
                run = run[:SAMPLE_TOKENS]
                rows.append((doc, n, [text[s:min(e, s + 200)] for s, e in run], tags_of(run, spans)))
        yield common.record_batch([list(c) for c in zip(*rows, strict=True)] or [[]] * 4, schema)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_sequences: int = SAMPLE_SEQUENCES) -> ChainCRF:
    """Train on the seed table and on sequences of a bounded sample of documents, labelled by the base patterns.

    The sample is the `sample_docs` rows with the smallest hashes of their ids, and of their sequences the
    `sample_sequences` first by hash, each of at most SAMPLE_TOKENS tokens of 200 characters, which bounds what the driver holds.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    texts = common.id_text(docs).join(F.broadcast(common.staged(chosen, "op1-sample")), "doc_id")
    rows = (texts.mapInArrow(_labelled, "doc_id long, n int, tokens array<string>, tags array<string>")
            .orderBy(F.xxhash64("doc_id", "n"), "doc_id", "n", "tokens").limit(sample_sequences).collect())
    return ChainCRF(seed_table() + [(list(r.tokens), list(r.tags)) for r in rows])


_FOUND = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])))])
_FOUND_DDL = "doc_id long, spans array<struct<kind: string, start: long, end: long, base: boolean>>"


def _find(batches: Iterator[pa.RecordBatch], model: ChainCRF) -> Iterator[pa.RecordBatch]:
    common.release()
    for batch in common.slices(batches):
        found = find_spans([t.decode() for t in batch.column("text").to_pylist()], model)
        rows = [sorted([(k, s, e, True) for k, s, e in base] + [(k, s, e, False) for k, s, e in added],
                       key=lambda x: (KINDS.index(x[0]), x[1], x[2])) for base, added in found]
        yield common.record_batch([batch.column("doc_id"), [[dict(zip(("kind", "start", "end", "base"), x, strict=True)) for x in r] for r in rows]], _FOUND)


def find(docs: DataFrame, model: ChainCRF | None = None) -> DataFrame:
    """(doc_id, spans): spans of every text by kind as listed, then start; `base` marks pattern matches.

    Positions are code points, ends exclusive. Null and empty texts have none; repeated rows are treated alike; texts of any length are
    read whole, in time that grows with their length and their spans. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    return common.id_text(docs).mapInArrow(lambda batches: _find(batches, shared.value), _FOUND_DDL)


def personal_data(docs: DataFrame, model: ChainCRF | None = None) -> DataFrame:
    """op1: counts of base spans by kind, the digest of all base spans, and all spans as text; odd rows as in find."""
    found = find(docs, model)
    base = F.filter("spans", lambda s: s["base"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    counts = [number(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or group of spans that overlap, replaced by the kind of its first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: ChainCRF | None = None) -> DataFrame:
    """docs with the spans of `text` masked and `n_chars`, where there is one, counted anew. Null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        for batch in common.slices(batches):
            texts = batch.column(place).to_pylist()
            found = find_spans([t or "" for t in texts], shared.value)
            new = [None if t is None else masked(t, base + added) if base or added else t for t, (base, added) in zip(texts, found, strict=True)]
            yield batch.set_column(place, batch.schema.field(place), pa.array(new, batch.schema.field(place).type))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))
    return out
