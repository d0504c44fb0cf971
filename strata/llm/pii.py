"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Strict patterns find the base spans of e-mail addresses, ip addresses, card and phone numbers. Looser patterns propose
more spans (spelled-out addresses, national phone numbers, ipv6, social security and bank account numbers, card-like
numbers). Five labelers vote for, against or not at all on every span: the strict pattern, a check (digits, checksum,
ranges), a gazetteer (top-level domains, country and issuer prefixes), the words before it, and its neighbours. EM
estimates how reliable each labeler is without labels; its posteriors train a logistic span classifier on the votes
and the span's shape. Base spans always stand; a proposed span stands if the classifier gives it at least one half and
no base span overlaps it.

Votes and shapes are few and discrete, so Spark counts them over all documents and the driver fits on those counts,
whose number is bounded by the number of combinations.

Defined cases: a null text is empty and has no spans; repeated rows are scanned row by row; without candidates the
classifier keeps nothing but base spans. Texts are scanned whole, in time linear in their length. Empty tables give
empty results. ``find`` returns the id, as it came, and its own columns; ``redact`` returns all columns, and only the
text changes.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .tokens import text_column

# Kinds (the base ones in the order that breaks ties) and word lists of the labelers.
KINDS = ("email", "ip", "card", "phone", "ssn", "iban")
BASE = KINDS[:4]
TOP_DOMAINS = set("com org net edu gov mil int info biz io co uk de fr es it nl be ch at pl pt ru cn jp kr in br mx ar "
                  "ca us au nz se no dk fi ie eu app dev me tv".split())
COUNTRY_CODES = set("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 "
                    "65 66 81 82 84 86 90 91 92 93 94 95 98 351 352 353 354 358 420 421".split())
ISSUER_PREFIXES = ("4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "34", "37", "60", "65", "35")
FOR_WORDS = {
    "email": "mail email e-mail contact write correo courriel".split(),
    "ip": "ip address host server from".split(),
    "card": "card visa mastercard credit debit tarjeta carte karte".split(),
    "phone": "phone tel telephone call fax mobile cell whatsapp telefon".split(),
    "ssn": "ssn social security".split(),
    "iban": "iban account konto cuenta compte bank".split(),
}
AGAINST_WORDS = set("version v ver isbn issn build release order invoice item sku serial ref doi page id no nr "
                    "commit hash".split())

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_GATE = re.compile(r"[0-9@\[(]|[A-Fa-f]:[A-Fa-f]")  # every span has one of these; ipv6 may be all letters
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(](?:at|@)[\])] ?[A-Za-z0-9-]{1,63}+"
                      r"(?: ?[\[(](?:dot|\.)[\])] ?[A-Za-z0-9-]{2,63}+|\.[A-Za-z0-9-]{2,63}+)+", re.I)
_NATIONAL = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9A-Za-z-])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_SSN = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
_IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")
_CARDLIKE = re.compile(r"(?<![0-9A-Za-z])[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9A-Za-z])")
_BEFORE = re.compile(r"[A-Za-z-]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    """Leftmost strict addresses. Each @ is looked at once, with the allowed characters to its left."""
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield Span("email", start, m.end())
            floor = m.end()
        else:
            floor = at + 1
        at = text.find("@", floor)


def base_spans(text: str) -> list[Span]:
    """The strict spans, by start and then kind."""
    found = list(emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(Span("ip", *m.span()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            found.append(Span("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append(Span("phone", *m.span()))
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def proposed_spans(text: str) -> list[Span]:
    """What looser patterns find."""
    out = []
    for kind, pattern in (("phone", _NATIONAL), ("ssn", _SSN), ("iban", _IBAN), ("card", _CARDLIKE), ("ip", _IPV6)):
        out += [Span(kind, *m.span()) for m in pattern.finditer(text)]
    if "[" in text or "(" in text:
        out += [Span("email", *m.span()) for m in _SPELLED.finditer(text)]
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


def _check(kind: str, s: str, d: str) -> int:
    if kind == "card":
        return 1 if luhn(d) and len(set(d)) > 3 else -1
    if kind == "ip":
        return 1 if ":" in s or (s not in ("0.0.0.0", "1.2.3.4") and not any(len(p) > 1 and p[0] == "0" for p in s.split("."))) else -1
    if kind == "phone":
        return 1 if 10 <= len(d) <= 15 and len(set(d)) > 2 else -1
    if kind == "ssn":
        return -1 if d[:3] in ("000", "666") or d[0] == "9" or d[3:5] == "00" or d[5:] == "0000" else 1
    if kind == "iban":
        x = s.replace(" ", "")
        return 1 if int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1 else -1
    return 1 if len(s) <= 254 else -1


def _gazetteer(kind: str, s: str, d: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[^A-Za-z0-9]+", s.rstrip(")]"))[-1].lower() in TOP_DOMAINS else 0
    if kind == "card":
        return 1 if d.startswith(ISSUER_PREFIXES) else -1
    if kind == "phone":
        return int(not s.startswith("+") or any(d[:k] in COUNTRY_CODES for k in (1, 2, 3)))
    if kind == "ip" and ":" not in s:
        return 1 if 1 <= int(s.split(".")[0][-4:]) <= 223 else -1
    return 0


def features(text: str, span: Span, strict: bool) -> tuple[int, ...]:
    """Kind, five votes (-1, 0, 1), and the span's shape: length and share of digits, in steps."""
    kind, a, b = span
    s = text[a:b]
    d = _digits(s)
    before = [w.lower() for w in _BEFORE.findall(text[max(0, a - 32):a])][-3:]
    context = -1 if AGAINST_WORDS.intersection(before) else 1 if set(FOR_WORDS[kind]).intersection(before) else 0
    edge = text[a - 1:a] + text[b:b + 1]
    neighbours = -1 if any(c.isalnum() or c in "_=/\\\"'#" for c in edge) else 1
    return (KINDS.index(kind), int(strict), _check(kind, s, d), _gazetteer(kind, s, d), context, neighbours,
            min(7, (b - a) // 6), min(4, 4 * len(d) // (b - a)))


def scan(text: str) -> tuple[list[Span], list[tuple[Span, tuple[int, ...]]]]:
    """Base spans, and all spans with their features."""
    if not _GATE.search(text):
        return [], []
    base = base_spans(text)
    spans = [(s, features(text, s, True)) for s in base]
    last = 0
    for s in proposed_spans(text):
        if s.start >= last and not any(s.start < b.end and b.start < s.end for b in base):
            spans.append((s, features(text, s, False)))
            last = s.end
    return base, spans


VOTES = slice(1, 6)


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50):
    """Posterior of each vote pattern, and each labeler's vote probabilities given no (0) and yes (1).

    Starts from the majority vote. Labelers are independent given the truth; each kind has its own prior. A labeler
    that does not vote says nothing.
    """
    x = np.array([p for p, _ in patterns])
    n = np.array([c for _, c in patterns], float)
    votes = x[:, VOTES]
    q = np.clip(0.5 + votes.sum(1) / 6, 0.05, 0.95)
    for _ in range(rounds):
        table = np.empty((2, votes.shape[1], 3))
        for y, w in ((0, n * (1 - q)), (1, n * q)):
            for v in (-1, 0, 1):
                table[y, :, v + 1] = (w[:, None] * (votes == v)).sum(0) + 0.5 if v else 0
        table /= table.sum(2, keepdims=True)
        logit = np.empty(len(n))
        for k in np.unique(x[:, 0]):
            of = x[:, 0] == k
            logit[of] = math.log(((n * q)[of].sum() + 1) / ((n * (1 - q))[of].sum() + 1))
        for j in range(votes.shape[1]):
            given = votes[:, j] != 0
            logit[given] += np.log(table[1, j, votes[given, j] + 1]) - np.log(table[0, j, votes[given, j] + 1])
        q = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return q, table


def _one_hot(f: tuple[int, ...]) -> np.ndarray:
    v = np.zeros(1 + len(KINDS) + 15 + 8 + 5)
    v[0] = v[1 + f[0]] = 1
    for j, vote in enumerate(f[VOTES]):
        v[1 + len(KINDS) + 3 * j + vote + 1] = 1
    v[1 + len(KINDS) + 15 + f[6]] = v[1 + len(KINDS) + 23 + f[7]] = 1
    return v


class Model(NamedTuple):
    weights: list[float]
    reliability: list  # of EM: [no/yes][labeler][against, none, for]

    def probability(self, f: tuple[int, ...]) -> float:
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(_one_hot(f) @ np.array(self.weights)))))))


def fit_patterns(patterns: list[tuple[tuple[int, ...], int]]) -> Model:
    """EM, then a logistic classifier on its posteriors (Newton steps, ridge penalty)."""
    size = len(_one_hot((0,) * 8))
    if not patterns:
        return Model([-1.0] + [0.0] * (size - 1), [])
    patterns = sorted(patterns)
    q, table = expectation_maximisation(patterns)
    x = np.array([_one_hot(p) for p, _ in patterns])
    n = np.array([c for _, c in patterns], float)
    n /= n.sum()
    w = np.zeros(size)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - q)) + 1e-4 * w
        hess = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-4 * np.eye(size)
        w = w - np.linalg.solve(hess, grad)
    return Model([float(v) for v in w], table.tolist())


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


_SCANNED = ("n_email long, n_ip long, n_card long, n_phone long, base string, "
            "seen array<struct<span:string,f:array<int>>>")
_SEEN = pa.list_(pa.struct([("span", pa.string()), ("f", pa.list_(pa.int32()))]))


def scanned(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the scan of each text: base counts, base spans, and proposed and base spans with features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base_spans_, seen = [], [], []
            for t in text_column(batch, "__text").to_pylist():
                base, spans = scan(t)
                n = Counter(s.kind for s in base)
                counts.append([n[k] for k in BASE])
                base_spans_.append(joined(base))
                seen.append([{"span": joined([s]), "f": list(f)} for s, f in spans])
            yield pa.RecordBatch.from_arrays(
                [text_column(batch, c) for c in keep] + [pa.array([n[k] for n in counts], pa.int64()) for k in range(4)]
                + [pa.array(base_spans_, pa.string()), pa.array(seen, _SEEN)], names=schema.names)

    head = docs.select(*keep).schema
    fields = docs.sparkSession.createDataFrame([], _SCANNED).schema
    schema = type(head)([*head, *fields])
    df = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    return df.mapInArrow(run, schema)


def fit(scan_rows: DataFrame) -> Model:
    """Model from scanned documents; Spark counts each combination of features."""
    rows = scan_rows.select(F.explode("seen.f").alias("f")).groupBy("f").agg(F.count("*").alias("n")).collect()
    return fit_patterns([(tuple(r["f"]), r["n"]) for r in rows])


def decide(base: list[Span], spans: list[tuple[Span, tuple[int, ...]]], model: Model) -> list[Span]:
    """Base spans and the proposed ones that the classifier keeps, by start and then kind."""
    strict = set(base)
    more = [s for s, f in spans if s not in strict and model.probability(f) >= 0.5]
    return sorted([*base, *more], key=lambda s: (s.start, KINDS.index(s.kind)))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Doc id, base counts, digest of the base spans, and all spans of every document."""
    rows = store(scanned(docs, [doc_id], text), "pii-spans")
    model = fit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest, every = [], []
            for base, seen in zip(text_column(batch, "base").to_pylist(), text_column(batch, "seen").to_pylist()):
                digest.append(sha256(base.encode()).hexdigest())
                if seen:
                    spans = [(_parsed(x["span"]), tuple(x["f"])) for x in seen]
                    strict = [_parsed(x) for x in base.split(",") if x]
                    every.append(joined(decide(strict, spans, model)))
                else:
                    every.append(base)
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-2] + [pa.array(digest, pa.string()), pa.array(every, pa.string())], names=schema.names)

    schema = rows.drop("base", "seen").withColumns({"base_sha256": F.lit(""), "spans": F.lit("")}).schema
    return rows.mapInArrow(run, schema)


def _parsed(s: str) -> Span:
    kind, a, b = s.split(":")
    return Span(kind, int(a), int(b))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets. A null text stays null."""
    model = fit(store(scanned(docs, [], text).select("seen"), "pii-seen"))

    def replaced(t: str | None) -> str | None:
        if t is None or not _GATE.search(t):
            return t
        out, last = [], 0
        for s in decide(*scan(t), model):
            if s.end > last:
                if s.start >= last:
                    out += [t[last:s.start], f"[{s.kind}]"]
                last = s.end
        return "".join(out) + t[last:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            clean = pa.array([replaced(t) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), clean)

    return docs.mapInArrow(run, docs.schema)
