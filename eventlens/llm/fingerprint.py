"""Document fingerprints by consistent weighted sampling.

A text's weighted terms are its two-word shingles (of lower-cased words) with
their counts; a text of one word has that word.  For each of ``samples``
independent draws ``k`` and each term, random numbers that depend on
(term, k) alone give the gamma(2, 1) variables r and c and the uniform b:

    t = floor(ln w / r + b),   a = c * exp(-r * (t - b) - r)

They are made of four uniforms of 32 bits: c = -ln(u3 u4), r = -ln(u1 u2) and
b = ln u2 / ln(u1 u2), which is uniform and independent of r, as the share of
one of two exponential variables in their sum is.  Then r (1 - b) = -ln u1, so

    a = c * u1 * exp(-r * t),

and the draw's sample is the (term, t) with the least ``a``.  Two texts
agree in a draw with probability sum(min(w, w')) / sum(max(w, w')), the
generalised Jaccard similarity.  ``a`` is a function of (term, t) and no
other input, so its bits stand for the sample; 16 of them are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _M1, _M2, chunks, mix64, shingle_hashes, stored

_STEP = np.uint64(0x9E3779B97F4A7C15)

#: Weighted terms looked at together.
TERM_BLOCK = 1 << 16
#: Of those, terms whose draws are made at once, so that they stay in the cache.
DRAW_BLOCK = 1 << 8


def _mix(x: np.ndarray, spare: np.ndarray) -> None:
    """``mix64`` in place."""
    for shift, factor in ((30, _M1), (27, _M2), (31, None)):
        np.right_shift(x, np.uint64(shift), out=spare)
        x ^= spare
        if factor is not None:
            x *= factor


def term_draws(terms: np.ndarray, weights: np.ndarray, samples: int) -> np.ndarray:
    """``a`` of each (term, draw)."""
    out = np.empty((len(terms), samples))
    with np.errstate(over="ignore"):
        seeds = mix64(np.arange(1, samples + 1, dtype=np.uint64) * _STEP)
        x, spare = np.empty((2, DRAW_BLOCK, samples), dtype=np.uint64)
        first, second = np.empty((2, DRAW_BLOCK, samples))
        for i in range(0, len(terms), DRAW_BLOCK):
            n = min(DRAW_BLOCK, len(terms) - i)
            w = weights[i : i + n]
            heavy = np.flatnonzero(w > 1)
            x, spare, first, second = x[:n], spare[:n], first[:n], second[:n]
            halves = x.view(np.uint32)
            # uniforms in (0, 1) of 32 bits each, times 2**32
            np.bitwise_xor(terms[i : i + n, None], seeds[None, :], out=x)
            _mix(x, spare)
            np.add(halves[:, 0::2], 0.5, out=out[i : i + n])
            if len(heavy):
                u1, u2 = ((halves[heavy, k::2] + 0.5) * 2.0**-32 for k in (0, 1))
            x += _STEP
            _mix(x, spare)
            np.add(halves[:, 0::2], 0.5, out=first)
            np.add(halves[:, 1::2], 0.5, out=second)
            first *= 2.0**-64
            first *= second
            np.log(first, out=first)
            first *= -(2.0**-32)
            out[i : i + n] *= first  # for weight 1, t is 0
            if len(heavy):
                e2 = -np.log(u2)
                r = e2 - np.log(u1)
                out[i + heavy] *= np.exp(-r * np.floor((np.log(w[heavy])[:, None] + e2) / r))
    return out


def signatures(texts: list[str], samples: int) -> np.ndarray:
    """A row of ``samples`` 16-bit samples for each text; zeros for no words."""
    out = np.zeros((len(texts), samples), dtype=np.uint16)
    for a, b in chunks(texts, 1 << 21):
        hashes, owner, _ = shingle_hashes(texts[a:b], 2)
        if not len(hashes):
            continue
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
        weight = np.diff(np.r_[new, len(hashes)])
        hashes, owner = hashes[new], owner[new]
        carried = None
        for i in range(0, len(hashes), TERM_BLOCK):
            part, w, h = owner[i : i + TERM_BLOCK], weight[i : i + TERM_BLOCK], hashes[i : i + TERM_BLOCK]
            with np.errstate(over="ignore"):
                _, first, back = np.unique(mix64(h) + w.astype(np.uint64), return_index=True, return_inverse=True)
            draws = term_draws(h[first], w[first], samples)
            heads = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            low = np.empty((len(heads), samples))
            for k, (x, y) in enumerate(zip(heads.tolist(), [*heads[1:].tolist(), len(part)], strict=True)):
                np.minimum.reduce(draws[back[x:y]], axis=0, out=low[k])  # a text at a time: its draws stay in the cache
            if carried and part[0] == carried[0]:  # a text that goes on from the last block
                low[0] = np.minimum(low[0], carried[1])
            out[a + part[heads]] = (mix64(low.view(np.uint64)) >> np.uint64(48)).astype(np.uint16)
            carried = part[heads[-1]], low[-1]
    return out


def edit_text(text: str, following: str) -> str:
    """``text`` with its last third (rounded down) replaced by as many first
    code points of ``following``, or all of them."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def fingerprints_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = 64, rows_per_range: int = 500, max_ranges: int = 1 << 14) -> DataFrame:
    """Fingerprint every text, its edited text, and compare with the next document.

    Documents are ordered by descending id (ties: by the text's hash, nulls
    last); after the last comes the first.  Returns ``id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The texts move once: to ranges of the id, cut at sampled quantiles (at
    most ``max_ranges`` numbers on the driver).  Each range also gets a copy
    of the first document of the range after it.  A null text is an empty one;
    the fingerprint of a text without words is all zeros and two such are
    alike.  A lone document follows itself; repeated rows follow one another;
    an empty table gives an empty result; other columns are ignored.
    """
    raw = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    raw = raw.withColumn("tie", F.xxhash64("text"))
    n = raw.count()
    ranges = max(1, min(max_ranges, n // rows_per_range))
    cuts = raw.agg(F.percentile_approx("id", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] if ranges > 1 else []
    cuts = np.unique(np.array(cuts or [], dtype=np.int64))

    @F.pandas_udf("int")
    def find(ids: pd.Series) -> pd.Series:  # ranges count down, as the ids do
        return pd.Series((len(cuts) - np.searchsorted(cuts, ids.to_numpy(np.int64), "left")).astype("int32"))

    placed = raw.withColumn("range", F.when(F.col("id").isNull(), F.lit(len(cuts) + 1)).otherwise(find(F.coalesce("id", F.lit(0)))))
    heads = stored(placed.groupBy("range").agg(F.max(F.struct("id", "tie")).alias("head")), "fp-heads").orderBy("range").collect()  # a row for each range
    if not heads:
        return docs.sparkSession.createDataFrame([], _OUT).withColumn("id", F.col("id").cast("long")).withColumnRenamed("id", id_col)
    to = [(heads[i]["head"]["id"], heads[i]["head"]["tie"], heads[i - 1]["range"]) for i in range(len(heads))]
    send = docs.sparkSession.createDataFrame(to, "id long, tie long, range int")
    extra = raw.join(F.broadcast(send), raw["id"].eqNullSafe(send["id"]) & (raw["tie"] == send["tie"])).select(raw["id"], "text", raw["tie"], "range").dropDuplicates(["id", "tie", "range"])
    both = placed.select("range", "id", "tie", "text", F.lit(0).alias("last")).unionByName(extra.select("range", "id", "tie", "text", F.lit(1).alias("last")))
    parts = max(len(heads) // 4, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sorted_rows = both.repartition(parts, "range").sortWithinPartitions("range", "last", F.col("id").desc_nulls_last(), F.col("tie").desc())
    sorted_rows = sorted_rows.select("range", "last", F.col("id").cast("string").alias("id"), "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the row whose next one is still to come
        for pdf in batches:
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            texts = pdf["text"].tolist()
            for a, b in chunks(texts, 1 << 22):
                b = min(b + 1, len(texts))  # a chunk's last text is the next one's first
                yield from _pairs(pdf.iloc[a:b], texts[a:b], samples)
            held = pdf.iloc[-1:]

    return sorted_rows.mapInPandas(run, _OUT).withColumn("id", F.col("id").cast("long")).withColumnRenamed("id", id_col)


_OUT = "id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _pairs(pdf: pd.DataFrame, texts: list[str], samples: int) -> Iterator[pd.DataFrame]:
    """Rows for all but the last of ``pdf`` and but for those that end a range."""
    last, rng = pdf["last"].to_numpy(), pdf["range"].to_numpy()
    at = np.flatnonzero((last[:-1] == 0) & (rng[:-1] == rng[1:]))
    if not len(at):
        return
    edited = [edit_text(texts[i], texts[i + 1]) if i < len(texts) - 1 else "" for i in range(len(texts))]
    both = signatures([t for pair in zip(texts, edited, strict=True) for t in pair], samples)  # pairs share most terms
    own, new = both[0::2], both[1::2]
    yield pd.DataFrame({
        "id": pdf["id"].iloc[at].to_numpy(),
        "n_chars": [len(texts[i]) for i in at],
        "edited_sha256": [hashlib.sha256(edited[i].encode()).hexdigest() for i in at],
        "fingerprint": [own[i].astype(">u2").tobytes().hex() for i in at],
        "edited_fingerprint": [new[i].astype(">u2").tobytes().hex() for i in at],
        "near_edited": (own[at] == new[at]).mean(axis=1),
        "near_next": (own[at] == own[at + 1]).mean(axis=1),
    })
