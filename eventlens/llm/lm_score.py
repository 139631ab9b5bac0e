"""Language-model scores by stupid backoff, over count tables of all documents.

    S(w | context) = f(context w) / f(context)           if f(context w) > 0
                     alpha * S(w | context less a word)   otherwise

down to f(w) / T.  Counts are those of all *other* documents (the document's
own occurrences are taken off), so that backing off means something on the
corpus that was counted; a word seen nowhere else counts as one occurrence.

The relational plan, with packed columns in place of a row per n-gram:

1. Documents are dealt to blocks of about ``block_bytes`` of text by a hash, their
   texts deflated.
2. A block explodes its n-grams, counts them, and sends each hash partition
   its sorted distinct n-gram hashes and counts as one row.  A frequent n-gram
   is one entry per block, however many documents have it.
3. A partition of the count table merges the blocks' entries and sends each
   block the totals of its own n-grams, in its order.
4. A block joins the totals to its exploded n-grams and sums per document.

N-grams are 64-bit hashes.  Two of n distinct ones collide with probability
n**2 / 2**65.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, word_hashes
from .mixing import word_count

_STEP = np.uint64(0x9E3779B97F4A7C15)


def ngram_hashes(words: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 ... order, the hash of the n-gram that ends at each word; 0 where the text begins too late for one."""
    place = np.arange(len(words)) - np.repeat(starts[:-1], np.diff(starts))
    out = [mix64(words + _STEP)]
    with np.errstate(over="ignore"):
        for n in range(2, order + 1):
            longer = np.zeros(len(words), dtype=np.uint64)
            longer[1:] = mix64(out[-1][:-1] * np.uint64(2 * n + 1) + words[1:])
            longer[place < n - 1] = 0
            out.append(longer)
    return out


def _planes(values: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes of 64-bit numbers, one place after the other, the highest
    first.  That of gaps and of counts is uneven and so deflated, and while it shrinks
    to a quarter the next one too; the others are as good as random.  Each place
    begins with its length, 0 for bytes as they are."""
    places, out, uneven = values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8), [len(values).to_bytes(4, "little"), bytes([width])], True
    for i in reversed(range(width)):
        raw = places[:, i].tobytes()
        if uneven:
            coder = zlib.compressobj(1, zlib.DEFLATED, -15, 8, zlib.Z_RLE)
            coded = coder.compress(raw) + coder.flush()
            uneven = 4 * len(coded) < len(raw)
            if len(coded) < len(raw):
                out += [len(coded).to_bytes(4, "little"), coded]
                continue
        out += [bytes(4), raw]
    return b"".join(out)


def _from_planes(raw: bytes) -> np.ndarray:
    n, width, at = int.from_bytes(raw[:4], "little"), raw[4], 5
    wide = np.zeros((n, 8), dtype=np.uint8)
    for i in reversed(range(width)):
        size = int.from_bytes(raw[at : at + 4], "little")
        body = raw[at + 4 : at + 4 + (size or n)]
        wide[:, i] = np.frombuffer(zlib.decompress(body, -15) if size else body, dtype=np.uint8)
        at += 4 + len(body)
    return wide.reshape(-1).view("<u8")


def _bytes_of(values: np.ndarray) -> int:
    return max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1


def pack(values: np.ndarray, base: int = 0) -> bytes:
    """Sorted 64-bit numbers from ``base`` on as gaps of the fewest whole bytes that hold them all."""
    gaps = np.diff(values, prepend=np.uint64(base))
    return _planes(gaps, _bytes_of(gaps))


def unpack(raw: bytes, base: int = 0) -> np.ndarray:
    return np.cumsum(_from_planes(raw), dtype=np.uint64) + np.uint64(base)


def pack_counts(values: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold them all."""
    return _planes(values.astype(np.uint64), _bytes_of(values))


def unpack_counts(raw: bytes) -> np.ndarray:
    return _from_planes(raw).astype(np.int64)


def _deflated(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: zlib.compress(t.encode("utf-8", "surrogatepass"), 1))


def _inflated(column: pd.Series) -> list[str]:
    return [zlib.decompress(x).decode("utf-8", "surrogatepass") for x in column]


def _block_grams(texts: list[str], order: int) -> tuple[np.ndarray, list[np.ndarray], list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Text starts, n-gram hash per word and order, and per order (distinct hashes, index per word, counts)."""
    words, starts = word_hashes(texts)
    grams = ngram_hashes(words, starts, order)
    tables = []
    for g in grams:
        distinct, index, counts = np.unique(g, return_inverse=True, return_counts=True)
        tables.append((distinct, index, counts))
    return starts, grams, tables


def document_scores(starts: np.ndarray, grams: list[np.ndarray], tables: list, totals: list[np.ndarray], tokens: int, alpha: float) -> np.ndarray:
    """Sum of log2 S of each text's words.  ``totals`` are corpus counts of the tables' distinct n-grams."""
    n_words = len(grams[0])
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    own_tokens = np.diff(starts)[owner]
    left = []  # count of the n-gram that ends at each word, in the other documents
    for (_, index, _), total in zip(tables, totals, strict=True):
        _, pair, own = np.unique(index * np.int64(len(starts)) + owner, return_inverse=True, return_counts=True)
        left.append(total[index] - own[pair])
    rest = np.maximum(tokens - own_tokens, 1)
    score = np.log2(np.maximum(left[0], 1) / rest)  # of a word by itself
    for n in range(2, len(grams) + 1):
        whole = left[n - 1]
        has = grams[n - 1] != 0
        context = np.ones(n_words, dtype=np.int64)
        context[1:] = left[n - 2][:-1]
        seen = has & (whole > 0)
        with np.errstate(divide="ignore"):
            direct = np.log2(np.where(seen, whole, 1) / np.where(seen, np.maximum(context, 1), 1))
        score = np.where(seen, direct, np.where(has, np.log2(alpha) + score, score))
    return np.bincount(owner, weights=score, minlength=len(starts) - 1)


def stupid_backoff(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2, alpha: float = 0.4, block_bytes: int = 8 << 20) -> DataFrame:
    """``id, n_tokens, log2_score, mean_log2`` of every document.

    Words are lower-cased (A-Z) runs of characters other than ASCII white
    space.  A text without words, empty or null, has no tokens, score 0 and a
    null mean.  Repeated rows are documents of their own, so each sees the
    other's counts; null ids are kept; an empty table gives an empty result;
    other columns are ignored.
    """
    if order < 1:
        raise ValueError("order must be 1 or more")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text)).alias("bytes"), F.sum(word_count(text)).alias("tokens")).first()
    blocks = max(1, -(-(size["bytes"] or 0) // block_bytes))
    tokens = size["tokens"] or 0
    bits = max(3, (blocks - 1).bit_length())  # 2 ** bits partitions of the count table
    source = docs.select(F.col(id_col).cast("string").alias("id"), text.alias("text"))
    source = source.select("id", F.pandas_udf(_deflated, "binary")("text").alias("text"), F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).alias("block"))
    dealt = source.repartition(int(min(blocks, 1 << 16)), "block")

    def explode(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for n, grams in enumerate(ngram_hashes(*word_hashes(_inflated(pdf["text"])), order), 1):
            distinct, counts = np.unique(grams, return_counts=True)
            cuts = np.searchsorted(distinct, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
            for part, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(distinct)], strict=True)):
                if a < b:
                    rows.append((part, n, pdf["block"].iloc[0], pack(distinct[a:b], part << (64 - bits)), pack_counts(counts[a:b])))
        return pd.DataFrame(rows, columns=["part", "n", "block", "grams", "counts"])

    entries = dealt.groupBy("block").applyInPandas(explode, "part int, n int, block long, grams binary, counts binary")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        grams = [unpack(x, int(pdf["part"].iloc[0]) << (64 - bits)) for x in pdf["grams"]]
        _, index = np.unique(np.concatenate(grams), return_inverse=True)
        total = np.zeros(index.max() + 1, dtype=np.int64)
        np.add.at(total, index, np.concatenate([unpack_counts(x) for x in pdf["counts"]]))
        ends = np.cumsum([len(g) for g in grams])
        return pd.DataFrame({"block": pdf["block"], "n": pdf["n"], "part": pdf["part"], "totals": [pack_counts(total[i]) for i in np.split(index, ends[:-1])]})

    table = entries.groupBy("part", "n").applyInPandas(merge, "block long, n int, part int, totals binary")

    def score(_key, docs_of: pd.DataFrame, totals_of: pd.DataFrame) -> pd.DataFrame:
        texts = _inflated(docs_of["text"])
        starts, grams, tables = _block_grams(texts, order)
        totals = [np.concatenate([np.zeros(0, dtype=np.int64), *[unpack_counts(x) for x in same.sort_values("part")["totals"]]]) for same in (totals_of[totals_of["n"] == n] for n in range(1, order + 1))]
        if any(len(t) != len(d) for t, (d, _, _) in zip(totals, tables, strict=True)):
            raise RuntimeError("a block's n-grams differ between the two passes; is the input deterministic?")
        sums = document_scores(starts, grams, tables, totals, tokens, alpha) if starts[-1] else np.zeros(len(texts))
        return pd.DataFrame({"id": docs_of["id"], "n_tokens": np.diff(starts), "log2_score": sums})

    out = dealt.groupBy("block").cogroup(table.groupBy("block")).applyInPandas(score, "id string, n_tokens long, log2_score double")
    mean = F.when(F.col("n_tokens") > 0, F.col("log2_score") / F.col("n_tokens"))
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_tokens", "log2_score", mean.alias("mean_log2"))
