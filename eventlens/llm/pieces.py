"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text is read once, slice by slice.  A ``Window`` holds, for each boundary since
the last commit, where the last piece of the best path to it begins; a new
boundary looks back at most the longest piece's length.  As soon as the paths of
all boundaries that a later piece can still start from run through one common
boundary, everything before it is final: its pieces are committed and the
window moves there, so memory is bounded by the distance to that boundary and
not by the text.

Two kinds of model differ in which arcs of the lattice survive:

* unigram: the arc with the highest sum of piece scores;
* BPE: the arc whose piece may follow the path's last piece, which is so if
  merging the two pieces' characters by rank leaves just these two pieces.
  Every adjacent pair of a BPE encoding passes that test, and a sequence whose
  pairs all pass is the encoding, so one arc survives at each boundary.

Some convergence points need no search: where no piece of the vocabulary holds
the two characters at a boundary (a word's end before a space mark, say), every
path runs through it.  A regular expression finds these in each slice; the
stretch between two of them is one committed window, whose ids are remembered
by its text.  A stretch that a slice ends in goes on in the next one, through a
``Window`` of its own if it is long.

Unknown characters become byte pieces if the model has them, else one unknown
id per run.  Decoding inverts pieces and bytes and drops the dummy prefix.
"""

from __future__ import annotations

import codecs
import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MARK = "▁"
#: Characters of a text that are read at a time.
SLICE = 1 << 16
#: Entries of each of the two generations of a worker's stores: ids of stretches, pairs of pieces.
MEMORY, PAIRS = 1 << 18, 1 << 16


class Memory(dict):
    """Remembers what was used of late: when this generation is full it becomes the
    old one, and what is asked for again moves over from there."""

    def __init__(self, size: int) -> None:
        super().__init__()
        self.old: dict = {}
        self.size = size

    def recall(self, key: object) -> object:
        """The value that the old generation has, or None."""
        got = self.old.get(key)
        if got is not None:
            self.keep(key, got)
        return got

    def keep(self, key: object, value: object) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
#: Below the lowest score of a piece: that of a character without one, in unigram models.
UNKNOWN_SCORE = -10.0


@dataclass
class PieceModel:
    """Pieces and scores of a SentencePiece model with the identity normaliser."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_at: list[int] | None
    unknown: int
    bpe: bool
    dummy_prefix: bool
    texts: list[str]
    byte_of: dict[int, int]
    silent: frozenset[int]

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.ids), default=1)
        self.plain = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.silent else t.encode() for i, t in enumerate(self.texts)]
        self.memory, self.pairs = Memory(MEMORY), Memory(PAIRS)
        self.spines: dict[str, tuple[list, list] | None] = {}
        # every end of a piece, and whether it is a piece that a path may take
        self.tails = {p[i:]: False for p in self.ids for i in range(len(p))}
        self.tails |= {p: True for p in self.ids if not self.bpe or self.spine(p) is not None}
        inside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.mark_starts_cut = not any(x[1] == MARK and x[0] != MARK for x in inside)
        alphabet = {c for p in self.ids for c in p}
        breaks = "".join(c for c in "\n\t\r" if c not in alphabet)
        letters = "A-Za-zÀ-ÖØ-öø-ÿ"
        after_letter = {x[1] for x in inside if re.match(f"[{letters}]", x)}
        ends = re.escape("".join(c for c in ".,!?;:#%*$&|\"" if c not in after_letter))
        forms = [f"[{breaks}]"] * bool(breaks) + [f"{MARK}*[{letters}]++(?=[{ends}])"] * bool(ends) + [f"{MARK}*[^{MARK}{breaks}]+", f"{MARK}+"]
        self._cut = re.compile("|".join(forms))
        # a boundary (between the two characters of a match) that no piece spans
        self._meets = re.compile(f"(?<=[^{MARK}]){MARK}" + (f"|[{breaks}]" if breaks else ""))

    def __getstate__(self) -> dict:  # what is remembered stays with its worker
        return self.__dict__ | {"memory": Memory(MEMORY), "pairs": Memory(PAIRS), "spines": {}}

    # -- the lattice ---------------------------------------------------------

    def spine(self, piece: str) -> tuple[list, list] | None:
        """Merge history of a piece's left and right edge, innermost first: (part,
        score of the merge that takes the part up).  None if merging the piece's
        characters by rank (best score first, leftmost on ties) doesn't give it."""
        if piece in self.spines:
            return self.spines[piece]
        parts, left, right = list(piece), [], []
        while len(parts) > 1:
            at, best = -1, -np.inf
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1], -np.inf)
                if score > best:
                    at, best = i, score
            if at < 0:
                break
            if at == 0:
                left.append((parts[0], best))
            if at == len(parts) - 2:
                right.append((parts[-1], best))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        out = None
        if len(parts) == 1:
            out = [*left, (piece, -np.inf)], [*right, (piece, -np.inf)]
        self.spines[piece] = out
        return out

    def follows(self, left: str, right: str) -> bool:
        """Whether the BPE encoding of both pieces' text is the two pieces.

        A merge over the boundary happens if both its sides exist at its score:
        the left side must not be taken up earlier or, being further left, at
        the same score; the right side not earlier.
        """
        known = self.pairs.recall((left, right))
        if known is None:
            known = left not in self.ids  # an unknown character is held by no merge
            if not known:
                known, scores, right_edge = True, self.scores, self.spine(right)[0]
                for x, x_up in self.spine(left)[1]:
                    for y, y_up in right_edge:
                        score = scores.get(x + y)
                        if score is not None and x_up < score and y_up <= score:
                            known = False
            self.pairs.keep((left, right), known)
        return known

    def stream(self, text: str) -> Iterator[str]:
        """The pieces of ``text``, each as soon as it is final."""
        window = Window(self)
        for at in range(0, len(text), self.longest):
            yield from window.feed(text[at : at + self.longest])
        yield from window.flush()

    def _unigram_arc(self, text: str, arcs: list[int], i: int, back: list[int], total: list[float], before: str) -> tuple[int, float]:
        if not arcs or arcs[0] < i - 1:
            arcs = [i - 1, *arcs]  # an unknown character
        scored = [(total[j] + self.scores.get(text[j:i], UNKNOWN_SCORE + self.lowest), j) for j in arcs]
        best = max(s for s, _ in scored)
        return next(j for s, j in reversed(scored) if s == best), best  # the longest piece on ties

    def _bpe_arc(self, text: str, arcs: list[int], i: int, back: list[int], total: list[float], before: str) -> tuple[int, float]:
        pairs = self.pairs
        for j in reversed(arcs):
            left = text[back[j] : j] if j else before
            if left:
                right = text[j:i]
                ok = pairs.get((left, right))
                if not (self.follows(left, right) if ok is None else ok):
                    continue
            return j, 0.0
        return i - 1, 0.0  # an unknown character

    def short_path(self, text: str) -> list[str]:
        """The surviving BPE path over a short stretch that is one window.

        The same search without the window's bookkeeping, and from its end: a
        boundary's surviving arc is looked for when a later arc asks for it."""
        tail, pairs, follows = self.tails.get, self.pairs.get, self.follows
        last: dict[int, str] = {}  # the piece of each boundary's surviving arc

        def survivor(i: int) -> str:
            piece = last.get(i)
            if piece is not None:
                return piece
            j, arcs = i - 1, []
            piece = text[j:i]
            takes = tail(piece)
            while takes is not None:
                if takes:
                    arcs.append((j, piece))
                j -= 1
                if j < 0:
                    break
                piece = text[j:i]
                takes = tail(piece)
            while arcs:
                j, piece = arcs.pop()
                if j:
                    left = survivor(j)
                    ok = pairs((left, piece))
                    if not (follows(left, piece) if ok is None else ok):
                        continue
                last[i] = piece
                return piece
            last[i] = text[i - 1 : i]  # an unknown character
            return last[i]

        out, n = [], len(text)
        while n:
            out.append(survivor(n))
            n -= len(out[-1])
        return out[::-1]

    @property
    def lowest(self) -> float:
        return min(self.scores.values(), default=0.0)

    # -- ids -----------------------------------------------------------------

    def encode_cut(self, text: str) -> bytes:
        """Ids of a stretch between two convergence points, as 32-bit integers."""
        got = self.memory.recall(text) if text not in self.memory else self.memory[text]
        if got is not None:
            return got
        window = Window(self)
        pieces = self.short_path(text) if self.bpe and len(text) <= 64 else [*window.feed(text), *window.flush()]
        ids = self._ids(pieces, window).tobytes()
        if len(text) <= 64:
            self.memory.keep(text, ids)
        return ids

    def _ids(self, pieces: list[str], window: Window) -> np.ndarray:
        out: list[int] = []
        for piece in pieces:
            own = self.ids.get(piece)
            if own is not None:
                out.append(own)
            elif self.bytes_at:
                out += [self.bytes_at[b] for b in piece.encode("utf-8", "surrogatepass")]
            elif not window.unknown_run:
                out.append(self.unknown)
            window.unknown_run = own is None
        return np.array(out, dtype=np.int32)

    def encode_stream(self, text: str) -> Iterator[np.ndarray]:
        """The ids of ``text``, committed part by part."""
        known = self.mark_starts_cut and bool(self.bytes_at)
        held = MARK if self.dummy_prefix and text else ""
        window = None if known else Window(self)
        get, slow = self.memory.get, self.encode_cut
        for at in range(0, len(text), SLICE):
            part, held = held + text[at : at + SLICE].replace(" ", MARK), ""
            if window is not None:  # inside a long stretch
                meet = self._meets.search(window.last + part, 1) if known else None
                stop = len(part) if meet is None else meet.start() - 1
                yield self._ids(window.feed(part[:stop]), window)
                if meet is None:
                    continue
                yield self._ids(window.flush(), window)
                part, window = part[stop:], None
            cuts = self._cut.findall(part)
            if at + SLICE < len(text):
                held = cuts.pop()
            yield np.frombuffer(b"".join([get(c) or slow(c) for c in cuts]), dtype=np.int32)
            if len(held) > 4 * self.longest:
                window = Window(self)
                yield self._ids(window.feed(held), window)
                held = ""
        if window is not None:
            yield self._ids(window.flush(), window)

    def encode(self, text: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, dtype=np.int32), *self.encode_stream(text)])

    def decode_stream(self, parts: Iterable[Sequence[int]]) -> Iterator[str]:
        """The text of ids that come part by part."""
        reader, first = codecs.getincrementaldecoder("utf-8")("replace"), self.dummy_prefix
        for ids in itertools.chain(parts, [None]):
            ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
            raw = b"" if ids is None else b"".join(map(self.plain.__getitem__, ids))
            text = reader.decode(raw, final=ids is None).replace(MARK, " ")
            if first and text:
                text, first = text.removeprefix(" "), False
            yield text

    def decode(self, ids: Sequence[int]) -> str:
        return "".join(self.decode_stream([ids]))


class Window:
    """The lattice between the last commit and the newest character."""

    def __init__(self, model: PieceModel) -> None:
        self.model, self.text, self.before = model, "", ""
        self.back: list[int] = [0]  # start of the last piece of the path to each boundary
        self.total: list[float] = [0.0]
        self.due, self.commits, self.unknown_run, self.last = 4 * model.longest, 0, False, ""

    def feed(self, more: str) -> list[str]:
        """Read ``more``; the pieces that are final now."""
        model, out, i = self.model, [], len(self.back)
        arc, longest, tail = model._bpe_arc if model.bpe else model._unigram_arc, model.longest, model.tails.get
        self.text += more
        self.last = self.text[-1:] or self.last
        text, back, total = self.text, self.back, self.total
        while i <= len(text):
            arcs, j, first = [], i - 1, i - longest if i > longest else 0
            while j >= first:
                takes = tail(text[j:i])
                if takes:
                    arcs.append(j)
                elif takes is None:
                    break
                j -= 1
            start, best = arc(text, arcs, i, back, total, self.before)
            back.append(start)
            total.append(best)
            if i >= self.due:
                meet = self.meeting_point()
                if meet:
                    out += self._commit(meet)
                    text, back, total = self.text, self.back, self.total
                    i -= meet
                self.due = i + longest
            i += 1
        return out

    def flush(self) -> list[str]:
        """The rest, its end being the text's or a sure convergence point."""
        return self._commit(len(self.text)) if self.text else []

    def meeting_point(self) -> int:
        """The last boundary that the paths to all of the newest boundaries share."""
        newest = len(self.back) - 1
        alive = set(range(max(0, newest - self.model.longest + 1), newest + 1))
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(self.back[last])
        return alive.pop()

    def _commit(self, meet: int) -> list[str]:
        pieces, stop = [], meet
        while stop:
            pieces.append(self.text[self.back[stop] : stop])
            stop = self.back[stop]
        pieces.reverse()
        self.before, self.text, self.commits = pieces[-1], self.text[meet:], self.commits + 1
        # no live path runs through a boundary whose piece begins before the meeting point
        self.back = [max(b - meet, 0) for b in self.back[meet:]]
        self.total = self.total[meet:]
        return pieces


def load_model(path: str, unigram: bool = False) -> PieceModel:
    """Read a ``.model`` file on the driver; ``unigram`` searches by scores whatever its type."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm = proto.normalizer_spec
    if norm.name != "identity" or norm.remove_extra_whitespaces or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models with the identity normaliser, kept and escaped white space and a prefix mark are supported")
    kinds = proto.SentencePiece
    usable = {i: p for i, p in enumerate(proto.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
    as_bytes = {i: int(p.piece[3:5], 16) for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
    place = {b: i for i, b in as_bytes.items()}
    unknown = next((i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN), 0)
    return PieceModel(
        ids={p.piece: i for i, p in usable.items()},
        scores={p.piece: p.score for p in usable.values()},
        bytes_at=[place[b] for b in range(256)] if len(place) == 256 else None,
        unknown=unknown,
        bpe=proto.trainer_spec.model_type == 2 and not unigram,
        dummy_prefix=norm.add_dummy_prefix,
        texts=[" ⁇ " if i == unknown else p.piece for i, p in enumerate(proto.pieces)],
        byte_of=as_bytes,
        silent=frozenset(i for i, p in enumerate(proto.pieces) if p.type == kinds.CONTROL),
    )


def encode_documents(docs: DataFrame, model: PieceModel, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with ``out_col``, the ids of the whole text; a null text has null, an empty one none.

    The model (a vocabulary of fixed size) is shared by broadcast.  Repeated
    rows get equal ids; a column named ``out_col`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for column in batches:
            values: list[np.ndarray] = []
            ends = np.zeros(len(column) + 1, dtype=np.int32)
            for i, text in enumerate(column.to_pylist()):
                ids = own.encode(text or "")
                values.append(ids)
                ends[i + 1] = ends[i] + len(ids)
            flat = np.concatenate(values) if values else np.zeros(0, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=column.is_null())

    return docs.withColumn(out_col, run(F.col(text_col).cast("string")))


def decode_documents(docs: DataFrame, model: PieceModel, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with ``out_col``, the text of the ids; null for null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for column in batches:
            yield pa.array([None if x is None else own.decode(x) for x in column.to_pylist()], pa.string())

    return docs.withColumn(out_col, run(F.col(ids_col)))


def round_trip(docs: DataFrame, model: PieceModel, text_col: str = "text") -> DataFrame:
    """``docs`` encoded and decoded: ``ids, n_ids, decoded_sha256`` (of the decoded
    text's UTF-8) and ``round_trip``, whether that text is the input.

    A text's ids are decoded as they are committed, so no decoded text is held.  A
    text with the mark's own character gives a space in its place, so it isn't its own
    round trip.  A null text has null ids and hash and is one.  Columns of these
    names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = "struct<ids: array<int>, decoded_sha256: string, round_trip: boolean>"

    @F.arrow_udf(kinds)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for column in batches:
            ends, flat = np.zeros(len(column) + 1, dtype=np.int32), []
            hashes: list[str | None] = []
            same: list[bool] = []
            for i, cell in enumerate(column):
                text = cell.as_py()
                size, at, equal, digest = 0, 0, True, hashlib.sha256()

                def parts(text: str) -> Iterator[np.ndarray]:
                    nonlocal size
                    for ids in own.encode_stream(text):
                        flat.append(ids)
                        size += len(ids)
                        yield ids

                for back in own.decode_stream(parts(text or "")):
                    equal = equal and (text or "").startswith(back, at)
                    at += len(back)
                    digest.update(back.encode("utf-8", "surrogatepass"))
                ends[i + 1] = ends[i] + size
                hashes.append(None if text is None else digest.hexdigest())
                same.append(equal and at == len(text or ""))
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, dtype=np.int32), *flat])), mask=column.is_null())
            yield pa.StructArray.from_arrays([ids, pa.array(hashes, pa.string()), pa.array(same, pa.bool_())], ["ids", "decoded_sha256", "round_trip"])

    kept = [c for c in docs.columns if c.lower() not in ("ids", "n_ids", "decoded_sha256", "round_trip", "_trip")]
    tripped = docs.withColumn("_trip", run(F.col(text_col).cast("string")))
    return tripped.select(*kept, "_trip.ids", F.size("_trip.ids").cast("long").alias("n_ids"), "_trip.decoded_sha256", "_trip.round_trip")
