"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A task looks at about this many characters of text at a time.
CHUNK_CHARS = 1 << 19


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (``spark.checkpoint.dir``).

    Where the setting is absent, a local session gets a temporary folder;
    any other master is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="eventlens-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here,
    and a lost executor costs no more than a read."""
    path = f"{work_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    for held in _OPEN:
        held.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_OPEN: list[list[str]] = []


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what ``stored`` wrote inside, also after an error.

    For jobs: results that read stored tables must be written before the end."""
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.remove(made)
        for path in made:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer where ``df`` has a column of it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def unit_hash(*cols: Column | str) -> Column:
    """A deterministic number in [0, 1) of the columns' values."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` characters; a longer text is alone."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > limit:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def texts_of(column: pd.Series) -> list[str]:
    """The column's texts, a null as the empty text."""
    return [t if isinstance(t, str) else "" for t in column]


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, and where each text's words begin.

    Words are runs of characters other than the six ASCII white-space ones;
    ``lower`` maps A-Z only.  The second array has ``len(texts) + 1`` entries.
    """
    words: list[bytes] = []
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    for i, t in enumerate(texts):
        raw = t.encode("utf-8", "surrogatepass")
        words += (raw.lower() if lower else raw).split()
        starts[i + 1] = len(words)
    if not words:
        return np.zeros(0, dtype=np.uint64), starts
    array = np.empty(len(words), dtype=object)
    array[:] = words
    codes, uniques = pd.factorize(array)
    return pd.util.hash_array(uniques, categorize=False)[codes], starts


def shingle_hashes(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the ``n``-word shingles of all texts: (hashes, text index, n_words).

    A text of fewer than ``n`` words, but at least one, has its whole word
    sequence as its one shingle; a text without words has none.
    """
    words, starts = word_hashes(texts)
    count = np.diff(starts)
    per = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    owner = np.repeat(np.arange(len(texts)), per)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per) + starts[:-1][owner]
    width = np.minimum(count, n)[owner]
    out = np.zeros(len(owner), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            inside = k < width
            step = mix64(out + words[np.minimum(at + k, max(len(words) - 1, 0))] + np.uint64(0x9E3779B97F4A7C15)) if len(words) else out
            out = np.where(inside, step, out)
    return out, owner, count
