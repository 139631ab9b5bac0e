"""Toxicity by a linear-chain conditional random field.

Two labels: O and T (toxic).  A token's features are its lower-cased word, its
prefixes and its suffixes.  Training:

1. Over labelled documents, features are counted by document label; those
   whose G-test against the label is significant form the lexicon.
2. Tokens of toxic documents with a lexicon feature are labelled T, all others
   O.  The CRF (a weight per lexicon feature, a bias, transitions) is fitted on
   windows around such tokens and on plain windows, by gradient ascent on the
   conditional likelihood; expectations come from forward-backward.
3. A logistic curve from a document's marginals (their sum and maximum) to the
   document label is fitted on the same documents.

Scoring: tokens without a lexicon feature all have the same emission, so a run
of them is a power of one 2 x 2 matrix, in closed form; forward-backward steps
from one lexicon token to the next and gives their exact marginals, however
long the text is.

The training sample is bounded: ``max_toxic`` and ``max_clean`` documents,
drawn by hash.  Everything else covers all rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, stored

WINDOW = 31
_WORD = re.compile(r"\w+")


def word_features(word: str) -> list[str]:
    """The features of a lower-cased word: itself, its proper prefixes and suffixes."""
    n = len(word)
    return [f"={word}", *(f"<{word[:k]}" for k in range(3, 8) if n > k), *(f">{word[-k:]}" for k in range(3, 7) if n > k)]


@dataclass(frozen=True)
class Crf:
    """``weights`` of lexicon features for T; O's emission is 0.  ``trans[i, j]`` scores i -> j."""

    weights: dict[str, float]
    bias: float
    start: float
    trans: np.ndarray
    curve: tuple[float, float, float]

    def emission(self, word: str) -> float | None:
        """Score of T for the word, None where no feature of it is known."""
        known = [self.weights[f] for f in word_features(word) if f in self.weights]
        return self.bias + sum(known) if known else None

    def plain_powers(self):
        """gap -> scaled matrix of a run of ``gap`` tokens without features, then the step's transition."""
        step = np.exp(self.trans + np.array([0.0, self.bias]))
        (a, b), (c, d) = step
        root = math.sqrt((a - d) ** 2 + 4 * b * c)
        first, second = (a + d + root) / 2, (a + d - root) / 2
        one = (step - second * np.eye(2)) / root
        ratio = second / first
        return lambda gap: one + ratio**gap * (np.eye(2) - one)

    def marginals(self, n: int, at: list[int], scores: list[float]) -> list[float]:
        """P(T) of the tokens at positions ``at`` (their T scores given) of a sequence of ``n``."""
        if not at:
            return []
        power, trans = self.plain_powers(), np.exp(self.trans)
        head = np.array([1.0, math.exp(self.start)])

        def into(gap: int, v: np.ndarray) -> np.ndarray:  # over ``gap`` plain tokens to the next lexicon token
            return v @ power(gap) @ trans

        forward = []
        v = head if at[0] == 0 else into(at[0] - 1, head * [1.0, math.exp(self.bias)])
        for i, s in enumerate(scores):
            if i:
                v = into(at[i] - at[i - 1] - 1, v)
            v = v * [1.0, math.exp(min(s, 60.0))]
            v = v / v.sum()
            forward.append(v)
        out = [0.0] * len(at)
        back = power(n - 1 - at[-1]) @ np.ones(2)
        for i in range(len(at) - 1, -1, -1):
            both = forward[i] * back
            out[i] = float(both[1] / both.sum())
            if i:
                back = power(at[i] - at[i - 1] - 1) @ trans @ (back * [1.0, math.exp(min(scores[i], 60.0))])
                back = back / back.sum()
        return out

    def score(self, marginals: list[float]) -> float:
        a, b, c = self.curve
        x = a + b * math.log1p(sum(marginals)) + c * max(marginals, default=0.0)
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


class Tagger:
    """Applies a CRF to texts; words are looked up once per chunk."""

    def __init__(self, crf: Crf):
        self.crf, self.known = crf, {}

    def emission(self, word: str) -> float | None:
        if word not in self.known:
            if len(self.known) >= 1 << 16:
                self.known.clear()
            self.known[word] = self.crf.emission(word.lower())
        return self.known[word]

    def tag(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Document score, and (start, stop, P(T)) of the lexicon tokens in code points."""
        words = _WORD.findall(text)
        hits = [(i, s) for i, w in enumerate(words) if (s := self.emission(w)) is not None]
        if not hits:
            return self.crf.score([]), []
        p = self.crf.marginals(len(words), [i for i, _ in hits], [s for _, s in hits])
        wanted, spans = {i: x for (i, _), x in zip(hits, p, strict=True)}, []
        for i, m in enumerate(_WORD.finditer(text)):
            if i in wanted:
                spans.append((m.start(), m.end(), wanted[i]))
        return self.crf.score(p), spans


def g_test(a: np.ndarray, c: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Signed G statistic of a feature in ``a`` of ``n1`` toxic and ``c`` of ``n0`` clean documents."""
    q = n1 / (n1 + n0)
    with np.errstate(divide="ignore", invalid="ignore"):
        inside = np.where(a > 0, a * np.log(a / ((a + c) * q)), 0) + np.where(c > 0, c * np.log(c / ((a + c) * (1 - q))), 0)
        b, d = n1 - a, n0 - c
        outside = np.where(b > 0, b * np.log(b / ((b + d) * q)), 0) + np.where(d > 0, d * np.log(d / ((b + d) * (1 - q))), 0)
    return np.where(a * n0 > c * n1, 2, -2) * (inside + outside)


def fit_windows(ids: np.ndarray, offsets: np.ndarray, tags: np.ndarray, mask: np.ndarray, features: int, steps: int = 150, rate: float = 0.3, l2: float = 1e-3):
    """Weights of a CRF on equally long windows.

    ``ids`` are the feature numbers of all window tokens, ``offsets`` where each
    token's begin; ``tags`` and ``mask`` (windows x length) are 0/1.
    """
    n, length = tags.shape
    owner = np.repeat(np.arange(n * length), np.diff(offsets))
    w, other = np.zeros(features), np.zeros(6)  # bias, start, four transitions
    other[0] = -2.0
    moment = [np.zeros(features), np.zeros(6)], [np.zeros(features), np.zeros(6)]
    pairs = mask[:, 1:].sum()
    for step in range(1, steps + 1):
        emit = np.bincount(owner, weights=w[ids], minlength=n * length).reshape(n, length) + other[0]
        trans = np.exp(other[2:].reshape(2, 2))
        et = np.exp(np.clip(emit, -40, 40))
        alpha, beta = np.empty((length, n, 2)), np.ones((length, n, 2))
        v = np.stack([np.ones(n), np.exp(other[1]) * et[:, 0]], axis=1)
        alpha[0] = v / v.sum(axis=1, keepdims=True)
        for i in range(1, length):
            v = alpha[i - 1] @ trans
            v[:, 1] *= et[:, i]
            v = v / v.sum(axis=1, keepdims=True)
            alpha[i] = np.where(mask[:, i, None] > 0, v, alpha[i - 1])
        for i in range(length - 2, -1, -1):
            v = (beta[i + 1] * np.stack([np.ones(n), et[:, i + 1]], axis=1)) @ trans.T
            v = v / v.sum(axis=1, keepdims=True)
            beta[i] = np.where(mask[:, i + 1, None] > 0, v, beta[i + 1])
        p = alpha * beta
        p = (p[:, :, 1] / p.sum(axis=2)).T  # windows x length
        off = (tags - p) * mask
        gw = np.bincount(ids, weights=off.ravel()[owner], minlength=features)
        go = np.zeros(6)
        go[0], go[1] = off.sum(), (tags[:, 0] - p[:, 0]).sum()
        joint = alpha[:-1].transpose(1, 0, 2)[..., :, None] * trans * (beta[1:].transpose(1, 0, 2) * np.stack([np.ones((n, length - 1)), et[:, 1:]], axis=2))[..., None, :]
        joint = joint / joint.sum(axis=(2, 3), keepdims=True) * mask[:, 1:, None, None]
        seen = np.zeros((2, 2))
        np.add.at(seen, (tags[:, :-1].astype(int), tags[:, 1:].astype(int)), mask[:, 1:])
        go[2:] = (seen - joint.sum(axis=(0, 1))).ravel()
        for x, g, k in ((w, gw / n - l2 * w, 0), (other, go / max(pairs, 1) * length - l2 * other, 1)):
            moment[0][k][:] = 0.9 * moment[0][k] + 0.1 * g
            moment[1][k][:] = 0.999 * moment[1][k] + 0.001 * g * g
            x += rate * (moment[0][k] / (1 - 0.9**step)) / (np.sqrt(moment[1][k] / (1 - 0.999**step)) + 1e-8)
    return w, other


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_toxic: int = 3000, max_clean: int = 9000, max_features: int = 4096, significance: float = 30.0, seed: int = 5) -> Crf:
    """A CRF learnt from the labelled rows; with no usable label, one whose scores are the base rate."""
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    drawn = F.xxhash64("id", F.lit(seed))
    sample = marked.where("y = 1").orderBy(drawn, "id").limit(max_toxic).unionByName(marked.where("y = 0").orderBy(drawn, "id").limit(max_clean))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = stored(source.join(F.broadcast(sample), "id").select("y", F.coalesce("text", F.lit("")).alias("text")), "toxic-sample")  # max_toxic + max_clean rows
    by = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = by.get(1, 0), by.get(0, 0)
    base = (math.log((n1 + 0.5) / (n0 + 0.5)) if n0 + n1 else -20.0, 0.0, 0.0)
    plain = Crf({}, -5.0, 0.0, np.zeros((2, 2)), base)
    if not n1 or not n0:
        return plain

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            y = pdf["y"].to_numpy()
            for a, b in chunks(pdf["text"].tolist()):
                seen = Counter(), Counter()
                for label, text in zip(y[a:b], pdf["text"].iloc[a:b], strict=True):
                    seen[label].update({f for w in set(_WORD.findall(text)) for f in word_features(w.lower())})
                names = list(seen[0].keys() | seen[1].keys())
                yield pd.DataFrame({"feature": names, "toxic": [seen[1][f] for f in names], "clean": [seen[0][f] for f in names]})

    counted = texts.mapInPandas(count, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    likely = counted.where((F.col("toxic") >= 3) & (F.col("toxic") * n0 > 3 * F.col("clean") * n1)).orderBy(F.desc("toxic"), "feature").limit(16 * max_features).toPandas()
    likely["g"] = g_test(likely["toxic"].to_numpy(float), likely["clean"].to_numpy(float), n1, n0)
    chosen = likely[(likely["g"] >= significance) & (likely["toxic"] >= 9 * likely["clean"])].sort_values(["g", "feature"], ascending=[False, True]).head(max_features)
    names = chosen["feature"].tolist()
    number = {f: i for i, f in enumerate(names)}
    if not names:
        return plain
    half = WINDOW // 2

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for y, text in zip(pdf["y"], pdf["text"], strict=True):
                ids = [[number[f] for f in word_features(w.lower()) if f in number] for w in _WORD.findall(text)]
                hits = [i for i, x in enumerate(ids) if x]
                for at in dict.fromkeys([*hits[:3], len(ids) // 2][: 4 if hits else 1]):
                    part = ids[max(0, at - half) : at + half + 1]
                    if part:
                        rows.append((int(y), [len(x) for x in part], [i for x in part for i in x]))
            yield pd.DataFrame(rows, columns=["y", "sizes", "ids"])

    got = texts.mapInPandas(windows, "y int, sizes array<int>, ids array<int>").toPandas()  # four windows a document at most
    tags, mask, sizes = np.zeros((len(got), WINDOW)), np.zeros((len(got), WINDOW)), np.zeros((len(got), WINDOW), dtype=int)
    for i, (y, s) in enumerate(zip(got["y"], got["sizes"], strict=True)):
        sizes[i, : len(s)], mask[i, : len(s)] = s, 1
        tags[i, : len(s)] = y * (np.array(s) > 0)
    ids = np.concatenate([np.asarray(x, dtype=int) for x in got["ids"]])
    w, other = fit_windows(ids, np.r_[0, np.cumsum(sizes.ravel())], tags, mask, len(names))
    crf = Crf({f: float(x) for f, x in zip(names, w, strict=True)}, float(other[0]), float(other[1]), other[2:].reshape(2, 2), base)

    def aggregate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(crf)
        for pdf in batches:
            p = [[x for _, _, x in tagger.tag(t)[1]] for t in pdf["text"]]
            yield pd.DataFrame({"y": pdf["y"], "total": [math.log1p(sum(x)) for x in p], "top": [max(x, default=0.0) for x in p]})

    seen = texts.mapInPandas(aggregate, "y int, total double, top double").toPandas()
    x = np.stack([np.ones(len(seen)), seen["total"], seen["top"]], axis=1)
    weight = np.zeros(3)
    for _ in range(50):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        move = np.linalg.solve(hess, x.T @ (seen["y"].to_numpy() - p) - 0.05 * weight)
        weight = weight + np.clip(move, -2, 2)
    return Crf(crf.weights, crf.bias, crf.start, crf.trans, tuple(float(v) for v in weight))


def toxicity(docs: DataFrame, crf: Crf, text_col: str = "text", out_col: str = "toxicity", span_at: float = 0.5) -> DataFrame:
    """``docs`` with ``out_col``: ``score`` (0 to 1) and ``spans`` (start, stop, p), in code points.

    Spans are the tokens whose marginal is ``span_at`` or more, neighbours
    merged.  A null or empty text has no span and the score of no evidence;
    repeated rows score alike; other columns stay as they are, but for one
    named ``out_col``, which is replaced.
    """

    @F.pandas_udf("score double, spans array<struct<start:int,stop:int,p:double>>")
    def run(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(crf)  # one store of words for all of a task's batches
        for column in columns:
            scores, spans = [], []
            for text in column:
                text = text if isinstance(text, str) else ""
                score, found = tagger.tag(text)
                merged: list[tuple[int, int, float]] = []
                for a, b, p in found:
                    if p < span_at:
                        continue
                    if merged and not _WORD.search(text, merged[-1][1], a):
                        merged[-1] = (merged[-1][0], b, max(merged[-1][2], p))
                    else:
                        merged.append((a, b, p))
                scores.append(score)
                spans.append(merged)
            yield pd.DataFrame({"score": scores, "spans": spans})

    return docs.withColumn(out_col, run(F.col(text_col).cast("string")))
