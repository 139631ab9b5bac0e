"""Personal data by weak supervision.

Base spans (e-mail, IPv4, card, phone) are exact patterns and always stay.
Further spans come from a wider set of candidates:

1. Candidates: obfuscated addresses, long digit groups, assigned secrets.
2. Labelers vote on each one (1 personal, 0 not, 2 abstain): regular
   expressions, gazetteers and the words around it.
3. Expectation-maximisation over the table of vote patterns (pattern, count;
   at most 3 ** labelers rows) estimates each labeler's reliability given the
   hidden class, and so a probability per pattern.
4. A logistic span classifier on the candidate's own shape and surroundings
   learns those probabilities, and decides.

The counts cover all candidates of all documents; the classifier is fitted on
``fit_rows`` of them, drawn by hash.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can't begin inside a digit run: where the run's start fails, its rest does
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its check, by start, then kind."""
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        done = m.end() if m else at + 1
        if m:
            out.append((start, done, "email"))
        at = text.find("@", done)
    out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], BASE_KINDS.index(s[2])))


# Candidates: kind, pattern. Each begins with a rare literal or a digit and is linear in the text.
_AT = re.compile(r"(?:\(at\)|\[at\]| at )\s?[A-Za-z0-9-]+(?:\s?(?:\.|\(dot\)|\[dot\]| dot )\s?[A-Za-z0-9-]+)+")
_WIDE_NUMBER = re.compile(r"(?<![0-9])[0-9](?:[\x20().\-/]{0,2}[0-9])+")
_SECRET = re.compile(r"[=:]\s?[\"']?([A-Za-z0-9+/_-]{16,})[\"']?")
_KEY = re.compile(r"([A-Za-z_]{2,20})\s?$")

# Gazetteers: fixed values.
TOP_LEVEL = frozenset("com org net edu gov info io co de fr es uk eu us example test".split())
SECRET_NAMES = frozenset("token secret password passwd pwd key apikey api_key access_key auth bearer".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 55 61 81 86 90 91".split())
CONTACT_WORDS = frozenset("phone tel call mobile fax cell contact mail email e-mail reach card visa ip address host".split())
QUANTITY_WORDS = frozenset("version chapter section page vol no isbn issn figure table total sum price year".split())

LABELERS = ("exact_shape", "checksum", "even_groups", "known_name", "known_code", "contact_words", "quantity_words", "random_looking", "digit_run")
ABSTAIN = 2


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Wide candidates that touch no base span, without overlaps."""
    found: list[Span] = []
    for m in _AT.finditer(text):
        start = m.start()
        while start > 0 and _LOCAL.match(text, start - 1):
            start -= 1
        if start < m.start() and (" dot " in m[0] or "(" in m[0] or "[" in m[0]):
            found.append((start, m.end(), "email"))
    for m in _WIDE_NUMBER.finditer(text):
        whole = len(_NOT_DIGIT.sub("", m[0])) <= 19
        for part in [m] if whole else re.finditer(r"[^\x20]+", m[0]):
            start, stop = (m.start(), m.end()) if whole else (m.start() + part.start(), m.start() + part.end())
            digits = len(_NOT_DIGIT.sub("", text[start:stop]))
            if 7 <= digits <= 19:
                kind = "ip" if text.count(".", start, stop) == 3 and digits <= 12 else "card" if digits >= 13 else "phone"
                found.append((start - (start > 0 and text[start - 1] in "+("), stop, kind))
    for m in _SECRET.finditer(text):
        found.append((m.start(1), m.end(1), "secret"))
    out: list[Span] = []
    starts = sorted(a for a, _, _ in base)
    reach = list(accumulate((b for _, b in sorted((a, b) for a, b, _ in base)), max))  # the furthest end up to each start
    last = 0  # the end of the last one taken
    for a, b, kind in sorted(found, key=lambda s: (s[0], -s[1], KINDS.index(s[2]))):
        before = bisect_left(starts, b)
        if a >= last and (not before or reach[before - 1] <= a):
            out.append((a, b, kind))
            last = b
    return out


def _around(text: str, a: int, b: int) -> tuple[list[str], str, str]:
    """Words shortly before, and the neighbouring characters."""
    words = [w.strip(".,:;()\"'").lower() for w in text[max(0, a - 40) : a].split()[-3:]]
    return words, text[a - 1 : a], text[b : b + 1]


def votes(text: str, span: Span) -> tuple[int, ...]:
    """One vote of each labeler: 1 personal, 0 not, 2 abstains."""
    a, b, kind = span
    s = text[a:b]
    digits = _NOT_DIGIT.sub("", s)
    words, before, after = _around(text, a, b)
    groups = [g for g in _NOT_DIGIT.split(s) if g]
    key = _KEY.search(text[max(0, a - 25) : a].rstrip("\"' =:") )
    shape = {
        "email": 1,
        "ip": int(len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)),
        "card": int(len(digits) == 16 and [len(g) for g in groups] in ([16], [4] * 4)),
        "phone": int(s[0] in "+(" and 9 <= len(digits) <= 15),
        "secret": int(bool(re.fullmatch(r"[0-9a-fA-F]{32,64}|[A-Za-z0-9+/_-]{20,}", s))),
    }[kind]
    mixed = len(set(s)) >= 8 and any(c.isdigit() for c in s) and any(c.isalpha() for c in s)
    return (
        shape,
        int(luhn(digits)) if kind == "card" else ABSTAIN,
        (int(2 <= len(groups) <= 5 and max(map(len, groups)) <= 4) if kind in ("phone", "card") and groups else ABSTAIN),
        (int(bool(key) and key[1].lower() in SECRET_NAMES) if kind == "secret" else int(s.rsplit(".", 1)[-1].rsplit(" ", 1)[-1].lower() in TOP_LEVEL) if kind == "email" else ABSTAIN),
        (1 if groups and groups[0] in CALLING_CODES and s[0] == "+" else ABSTAIN) if kind == "phone" else ABSTAIN,
        1 if CONTACT_WORDS.intersection(words) else ABSTAIN,
        0 if QUANTITY_WORDS.intersection(words) or before in "$€%#" and before else ABSTAIN,
        int(mixed) if kind == "secret" else ABSTAIN,
        0 if kind != "secret" and (before.isalnum() or after.isalnum()) else ABSTAIN,
    )


FEATURES = 512


def features(text: str, span: Span) -> list[int]:
    """Indices of the candidate's binary features, 0 (the bias) included."""
    a, b, kind = span
    s = text[a:b]
    digits = _NOT_DIGIT.sub("", s)
    words, before, after = _around(text, a, b)
    k = KINDS.index(kind)
    named = [
        ("kind", k),
        ("digits", k, len(digits)),
        ("length", k, min((b - a) // 4, 16)),
        ("groups", k, min(len(_NOT_DIGIT.split(s)), 8)),
        ("first", k, "d" if s[0].isdigit() else s[0] if s[0] in "+(" else "a"),
        ("before", "d" if before.isdigit() else "a" if before.isalpha() else before),
        ("after", "d" if after.isdigit() else "a" if after.isalpha() else after),
        ("hex", bool(re.fullmatch(r"[0-9a-fA-F]+", s))),
        ("word", words[-1] if words and words[-1] in CONTACT_WORDS | QUANTITY_WORDS | SECRET_NAMES else ""),
        ("luhn", k, len(digits) >= 12 and luhn(digits)),
    ]
    return [0, *(1 + int.from_bytes(pd.util.hash_array(np.array([repr(f)], dtype=object), categorize=False).tobytes(), "little") % (FEATURES - 1) for f in named)]


@dataclass(frozen=True)
class PiiModel:
    """Weights of the span classifier; labeler reliabilities for reports."""

    weights: np.ndarray
    reliability: dict[str, tuple[float, float]] = field(default_factory=dict)
    prior: float = 0.5

    def score(self, text: str, span: Span) -> float:
        return float(1 / (1 + np.exp(-self.weights[features(text, span)].sum())))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability of class 1 per vote pattern, P(vote | class) per labeler, and the prior."""
    votes_for, votes_against = (patterns == 1).sum(axis=1), (patterns == 0).sum(axis=1)
    p = (votes_for + 0.5) / (votes_for + votes_against + 1.0)
    seen = np.stack([patterns == v for v in range(3)], axis=2).astype(float)  # pattern, labeler, vote
    for _ in range(rounds):
        prior = float(np.clip((counts * p).sum() / counts.sum(), 0.01, 0.99))
        weight = np.stack([counts * (1 - p), counts * p])
        given = np.einsum("cp,plv->clv", weight, seen) + 0.5
        # an honest labeler is likelier to vote for the true class than the other one does
        given /= given.sum(axis=2, keepdims=True)
        logp = np.einsum("plv,clv->pc", seen, np.log(given)) + np.log([1 - prior, prior])
        p = 1 / (1 + np.exp(logp[:, 0] - logp[:, 1]))
    if (counts * p * (votes_against - votes_for)).sum() > (counts * (1 - p) * (votes_against - votes_for)).sum():
        p = 1 - p  # the classes came out with their names exchanged
    return p, given, prior


def fit(docs: DataFrame, text_col: str = "text", fit_rows: int = 20000, steps: int = 400, seed: int = 11) -> PiiModel | None:
    """The model of all documents' candidates; None where there are none.

    ``fit_rows`` bounds the candidates, drawn by hash, that the classifier is
    fitted on and the driver holds; vote patterns are counted over all.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text in texts_of(pdf["text"]):
                for span in candidates(text, base_spans(text)):
                    rows.append(("".join(map(str, votes(text, span))), features(text, span)))
            yield pd.DataFrame(rows, columns=["pattern", "features"])

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInPandas(run, "pattern string, features array<int>")
    found = stored(found.groupBy("pattern", "features").agg(F.count("*").alias("n")), "pii-candidates")
    table = found.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()  # 3 ** labelers rows at most
    if not table:
        return None
    patterns = np.array([[int(c) for c in r["pattern"]] for r in table])
    p, given, prior = expectation_maximisation(patterns, np.array([r["n"] for r in table], dtype=float))
    soft = {r["pattern"]: float(x) for r, x in zip(table, p, strict=True)}
    drawn = found.orderBy(F.xxhash64("pattern", "features", F.lit(seed)), "pattern").limit(fit_rows).toPandas()
    x = np.zeros((len(drawn), FEATURES))
    for i, f in enumerate(drawn["features"]):
        x[i, list(f)] = 1
    y, n = drawn["pattern"].map(soft).to_numpy(), drawn["n"].to_numpy(float)
    w = np.zeros(FEATURES)
    for _ in range(steps):
        grad = x.T @ (n * (1 / (1 + np.exp(-x @ w)) - y)) / n.sum() + 1e-4 * w
        w -= 2.0 * grad
    return PiiModel(w, {name: (float(given[1, i, 1]), float(given[0, i, 0])) for i, name in enumerate(LABELERS)}, prior)


def spans_of(text: str, model: PiiModel | None, threshold: float = 0.5) -> tuple[list[Span], list[Span]]:
    """Base spans, and those that the model adds."""
    base = base_spans(text)
    return base, [s for s in candidates(text, base) if model and model.score(text, s) >= threshold]


_SPANS = "array<struct<start:int,stop:int,kind:string>>"


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: PiiModel | None = None, threshold: float = 0.5) -> DataFrame:
    """``id, base, added``: arrays of (start, stop, kind), in code points, stop exclusive.

    Fits a model on ``docs`` unless one is given.  A null or empty text has no
    spans; null ids and repeated rows are kept as they are; an empty table
    gives an empty result; other columns are ignored.
    """
    model = model or fit(docs, text_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            both = [spans_of(t, model, threshold) for t in texts_of(pdf["text"])]
            yield pd.DataFrame({"id": pdf["id"], "base": [b for b, _ in both], "added": [a for _, a in both]})

    source = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = source.mapInPandas(run, f"id string, base {_SPANS}, added {_SPANS}")
    return out.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    for a, b, kind in sorted(spans):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def mask_personal_data(docs: DataFrame, text_col: str = "text", model: PiiModel | None = None, threshold: float = 0.5) -> DataFrame:
    """``docs`` with all spans of ``text_col`` replaced by ``[KIND]``; null texts stay null."""
    model = model or fit(docs, text_col)

    @F.pandas_udf("string")
    def mask(column: pd.Series) -> pd.Series:
        return pd.Series([redact(t, sum(spans_of(t, model, threshold), [])) if isinstance(t, str) else None for t in column], dtype=object)

    return docs.withColumn(text_col, mask(F.col(text_col).cast("string")))
