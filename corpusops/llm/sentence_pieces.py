"""SentencePiece encoding and decoding with a max-plus scan over chunks of a text.

A text is a lattice of pieces; its encoding is the best path. For a unigram model any piece may follow
any other and the sum of scores decides. For a BPE model a path is admitted only if every two
neighbouring pieces stay apart when their concatenation is merged alone; exactly one such path exists,
and it is what merging the whole text gives, since no merge crosses a final boundary.

Long texts are cut into chunks of CHUNK characters at any place. A boundary state is a piece that starts
before the boundary and ends on or behind it. Each chunk yields a max-plus matrix from the states at its
left boundary to those at its right one. The product is associative, so matrices of FAN neighbouring chunks are multiplied in
one task, their products in turn, until a text has one; on the way back down the states at the ends of a range fix
those at its inner boundaries, and then each chunk is traced on its own.
Where no piece crosses a position (before a word's space mark), paths meet, so words inside a chunk
are independent of the boundaries and are looked up in a table of words seen lately. The same holds, for a BPE model,
between two characters that are neighbours in no piece (a letter and the full stop behind it): short texts are cut there too.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import small_batches

#: characters of a chunk; chunks (then ranges of them) that are combined in one task
CHUNK, FAN = 1 << 15, 64
#: words a process remembers (twice that for a while), each about 200 bytes; pairs of pieces; bytes of text worked on at once
REMEMBER, PAIRS, SLICE = 100_000, 50_000, 1 << 20
#: chunks that are handed to a Python process at once
CHUNKS = 64
#: longer stretches without a space are traced, not merged, which takes time with the square of their length
MERGED = 64
MARK = "▁"
UNIGRAM, BPE = 1, 2


def read_model(path: str) -> dict:
    """What encoding needs of a model file: pieces with scores and kinds, and flags."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    return parse_model(proto)


def parse_model(proto) -> dict:
    n = proto.normalizer_spec
    if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models with the identity normaliser and escaped leading white space are supported")
    if proto.trainer_spec.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return {"digest": hashlib.sha256(proto.SerializeToString(deterministic=True)).hexdigest(), "kind": proto.trainer_spec.model_type, "dummy": n.add_dummy_prefix, "fallback": proto.trainer_spec.byte_fallback,
            "pieces": [(p.piece, p.score, p.type) for p in proto.pieces]}


class Lattice:
    """Pieces of a model with the pair rule; remembers words and pairs."""

    def __init__(self, model: dict):
        self.bpe, self.dummy = model["kind"] == BPE, model["dummy"]
        normal = [(i, p, s) for i, (p, s, kind) in enumerate(model["pieces"]) if kind in (1, 4)]
        self.ids = {p: i for i, p, _ in normal}
        self.scores = {p: s for _, p, s in normal}
        self.codes = {p: array("i", [i]).tobytes() for p, i in self.ids.items()}
        self.names = [p for p, _, _ in model["pieces"]]
        self.unknown = next((i for i, (_, _, kind) in enumerate(model["pieces"]) if kind == 2), 0)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(model["pieces"]) if kind == 6} if model["fallback"] else {}
        self.id_bytes = {i: b for b, i in self.byte_ids.items()}
        self.control = {i for i, (_, _, kind) in enumerate(model["pieces"]) if kind == 3}
        self.longest = max(map(len, self.ids), default=1)
        self.lowest = min(self.scores.values(), default=0.0) - 10.0
        self.none = float("-inf")
        #: without such a piece no path can run across the place before a space mark
        self.cuts = all(MARK not in p.lstrip(MARK) for p in self.ids)
        #: neighbouring characters of some piece, with the score of the two as a piece; paths never run across others
        self.near = {pair: self.scores.get("".join(pair), self.none) for p in self.ids for pair in zip(p, p[1:])}
        #: the same by code points, through the places of left and right characters (0: others)
        self.left, self.right = (np.zeros(0x110000, np.int16) for _ in range(2))
        for places, side in ((self.left, 0), (self.right, 1)):
            found = sorted({ord(pair[side]) for pair in self.near})
            places[found] = np.arange(1, len(found) + 1)
        self.joined = np.zeros((self.left.max() + 1, self.right.max() + 1), bool)
        for a, b in self.near:
            self.joined[self.left[ord(a)], self.right[ord(b)]] = True
        self.pairs: dict[tuple[str, str], bool] = {}
        self.alone: dict[str, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text by merging: best score first, leftmost among equals."""
        get, none = self.near.get, self.none
        return self._merged(list(text), [get(pair, none) for pair in zip(text, text[1:])])

    def _merged(self, parts: list[str], scores: list[float]) -> list[str]:
        """Characters and the scores of neighbouring ones (both used up)."""
        get, none = self.scores.get, self.none
        while scores:
            best = max(scores)
            if best == none:
                break
            i = scores.index(best)
            del scores[i]
            parts[i] = joined = parts[i] + parts.pop(i + 1)
            if i < len(scores):
                scores[i] = get(joined + parts[i + 1], none)
            if i:
                scores[i - 1] = get(parts[i - 1] + joined, none)
        return parts

    def allowed(self, left: str, right: str) -> bool:
        """Whether ``right`` may follow ``left`` on a path."""
        if not self.bpe or not left:
            return True
        key = (left, right)
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            ok = self.pairs[key] = self.merge(left + right) == [left, right]
        return ok

    def standing(self, piece: str) -> bool:
        """Whether a piece can be the result of merging its own characters."""
        ok = self.alone.get(piece)
        if ok is None:
            ok = self.alone[piece] = not self.bpe or len(piece) == 1 or self.merge(piece) == [piece]
        return ok

    def score(self, piece: str) -> float:
        return self.scores.get(piece, self.lowest)

    def _ending(self, text: str, start: int, end: int) -> list[str]:
        """Pieces of text[start:end] that end at ``end``, longest first; a single unknown character counts as one."""
        out = [p for p in (text[a:end] for a in range(max(start, end - self.longest), end - 1)) if p in self.ids and self.standing(p)]
        out.append(text[end - 1])
        return out

    def forward(self, text: str, start: int, end: int, first: str = "") -> list[tuple[float, str] | None]:
        """Best score and last piece of a path over text[start:i] for every i up to ``end``; ``first`` precedes it."""
        best: list = [None] * (end - start + 1)
        best[0] = (0.0, first)
        for i in range(start + 1, end + 1):
            found = None
            for p in self._ending(text, start, i):
                before = best[i - start - len(p)]
                if before is not None and self.allowed(before[1], p):
                    total = before[0] + self.score(p)
                    if found is None or total > found[0]:
                        found = (total, p)
                        if self.bpe:
                            break
            best[i - start] = found
        return best

    def trace(self, best: list, to: int) -> list[str]:
        out = []
        while to > 0:
            out.append(best[to][1])
            to -= len(out[-1])
        return out[::-1]

    def numbers(self, pieces: list[str]) -> list[int]:
        out = []
        for p in pieces:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in p.encode())
            else:
                out.append(self.unknown)
        return out

    def word(self, text: str) -> bytes:
        """Numbers, four bytes each, of a stretch that no piece leaves; the words of the last two tables are remembered."""
        found = self.words.get(text)
        if found is None:
            found = self.older.get(text)
            if found is None:
                if self.bpe and len(text) <= MERGED:
                    found = self._short(text)
                else:
                    found = array("i", self.numbers(self.trace(self.forward(text, 0, len(text)), len(text)))).tobytes()
            if len(text) <= MERGED:
                if len(self.words) >= REMEMBER:
                    self.older, self.words = self.words, {}
                self.words[text] = found
        return found

    def _short(self, text: str) -> bytes:
        """Numbers of a short word of a BPE model; stretches between characters that no piece joins (as before a full stop) are words of their own."""
        scores = list(map(self.near.get, zip(text, text[1:])))
        if None in scores:
            out, first, table, word = [], 0, self.words, self.word
            for at, score in enumerate(scores, 1):
                if score is None:
                    part = text[first:at]
                    out.append(table.get(part) or word(part))
                    first = at
            part = text[first:]
            out.append(table.get(part) or word(part))
            return b"".join(out)
        pieces = self._merged(list(text), scores)
        try:
            return b"".join(map(self.codes.__getitem__, pieces))
        except KeyError:
            return array("i", self.numbers(pieces)).tobytes()

    def whole(self, texts: pa.StringArray) -> pa.ListArray:
        """Numbers of the pieces of whole texts without nulls, by a BPE model.

        Texts are cut between characters that no piece joins, all at once, and each different stretch is looked up once.
        """
        starts = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[starts[0]:starts[-1]]
        starts -= starts[0]
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        first = np.zeros(len(data) + 1, bool)
        first[np.flatnonzero((data & 0xC0) != 0x80)[1:][~self.joined[self.left[chars[:-1]], self.right[chars[1:]]]]] = True
        first[starts] = True
        firsts = np.flatnonzero(first[:-1])
        words = pa.StringArray.from_buffers(len(firsts), pa.py_buffer(np.append(firsts, len(data)).astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        table, word = self.words, self.word
        codes = [table.get(w) or word(w) for w in words.dictionary.to_pylist()]
        sizes, which = np.fromiter(map(len, codes), np.int64, len(codes)) // 4, words.indices.to_numpy()
        size = sizes[which]
        ends = np.append(0, np.cumsum(size))
        numbers = np.frombuffer(b"".join(codes), np.int32)[np.repeat((np.cumsum(sizes) - sizes)[which] - ends[:-1], size) + np.arange(ends[-1])]
        return pa.ListArray.from_arrays(pa.array(ends[np.searchsorted(firsts, starts)].astype(np.int32)), pa.array(numbers))

    # chunks ---------------------------------------------------------------------------------------

    def states(self, text: str, at: int) -> list[tuple[int, str]]:
        """Pieces over a boundary at ``at``, as (offset of the start before it, piece), in a fixed order."""
        if at <= 0 or at >= len(text):
            return [(0, "")]
        out = []
        for a in range(max(0, at - self.longest), at):
            if self.cuts and any(text[i] == MARK and text[i - 1] != MARK for i in range(a + 1, at)):
                continue
            for b in range(at, min(len(text), a + self.longest) + 1):
                p = text[a:b]
                if (p in self.ids and self.standing(p)) or (b - a == 1):
                    out.append((at - a, p))
        return out

    def first_cut(self, text: str, at: int, end: int) -> int | None:
        """The first place in [at, end] that no piece crosses."""
        if not self.cuts:
            return None
        while True:
            i = text.find(MARK, at, end)
            if i < 0:
                return None
            if i > 0 and text[i - 1] != MARK:
                return i
            at = i + 1

    def last_cut(self, text: str, at: int, end: int) -> int | None:
        if not self.cuts:
            return None
        while True:
            i = text.rfind(MARK, at, end)
            if i < 0:
                return None
            if i > 0 and text[i - 1] != MARK:
                return i
            end = i

    def _leave(self, text: str, best: list, start: int, end: int, out: list[tuple[int, str]]) -> list[float]:
        """Score of the best path into each state of the right boundary."""
        if out == [(0, "")]:
            return [best[end - start][0] if best[end - start] else -np.inf]
        scores = []
        for back, p in out:
            a = end - back - start
            ok = 0 <= a < len(best) and best[a] is not None and self.allowed(best[a][1], p)
            scores.append(best[a][0] + self.score(p) if ok else -np.inf)
        return scores

    def matrix(self, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray | None]:
        """Max-plus matrix of text[start:end] between its boundary states.

        If the paths meet inside, it is the outer sum of two vectors, which are returned instead.
        """
        before, after = self.states(text, start), self.states(text, end)
        cut = self.first_cut(text, start, end - 1)
        enter = []
        for back, p in before:
            at = start - back + len(p)
            if cut is not None:
                found = self.forward(text, at, cut, p)[cut - at] if at <= cut else None
                enter.append(found[0] if found else -np.inf)
            elif at <= end:
                enter.append(self._leave(text, self.forward(text, at, end, p), at, end, after))
            else:
                enter.append([-np.inf] * len(after))
        if cut is None:
            return np.array(enter), None
        last = self.last_cut(text, cut, end - 1)
        return np.array(enter), np.array(self._leave(text, self.forward(text, last, end), last, end, after))

    def encode(self, text: str, start: int, end: int, i: int = 0, j: int = 0) -> list[int]:
        """Numbers of the pieces that start in text[start:end], from state ``i`` on the left to ``j`` on the right."""
        back, p = self.states(text, start)[i] if start > 0 else (0, "")
        at = start - back + len(p)
        after = self.states(text, end)[j] if end < len(text) else (0, "")
        stop = end - after[0]
        cut = self.first_cut(text, at, stop) if at <= stop else None
        if cut is None:
            best = self.forward(text, at, stop, p)
            return self.numbers(self.trace(best, stop - at) + ([after[1]] if after[0] else []))
        last = self.last_cut(text, cut, stop)
        best = self.forward(text, at, cut, p)
        out = array("i", self.numbers(self.trace(best, cut - at)))
        table, word = self.words, self.word
        inner = WORDS.findall(text, cut, last)
        out.frombytes(b"".join([table.get(w) or word(w) for w in inner]))
        if after[0]:
            best = self.forward(text, last, stop)
            out.extend(self.numbers(self.trace(best, stop - last) + [after[1]]))
        elif last < stop:
            out.frombytes(word(text[last:stop]))
        return out


WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_LATTICES: dict[str, Lattice] = {}


def _lattice(shared) -> Lattice:
    """The lattice of a broadcast model, by the model's digest; a worker process keeps that of the last model."""
    model = shared.value
    found = _LATTICES.get(model["digest"])
    if found is None:
        _LATTICES.clear()
        found = _LATTICES[model["digest"]] = Lattice(model)
    return found


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in groups of about SLICE bytes of a text column."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        limit = (ends[first - 1] if first else 0) + SLICE
        last = max(first + 1, int(np.searchsorted(ends, limit, side="right")))
        yield batch.slice(first, last - first)
        first = last


Matrix = tuple[np.ndarray, np.ndarray | None]


def combine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (x[:, :, None] + y[None, :, :]).max(1)


def times(x: Matrix, y: Matrix) -> Matrix:
    """Product of two matrices, each whole or the outer sum of two vectors."""
    (a, b), (c, d) = x, y
    if b is not None:
        return (a + (b + c).max(), d) if d is not None else (a, (b[:, None] + c).max(0))
    return ((a + c[None, :]).max(1), d) if d is not None else (combine(a, c), None)


def product(matrices: list[Matrix]) -> Matrix:
    out = matrices[0]
    for m in matrices[1:]:
        out = times(out, m)
    return out


def boundary_states(matrices: list[Matrix], first: int = 0, last: int | None = None) -> list[int]:
    """State at each inner boundary on the best path through a range of chunks.

    ``first`` is the state at its left end, ``last`` that at its right end, by default the best one. Ties go to the lower state.
    """
    ahead = None
    rows = []
    for enter, leave in matrices:
        if ahead is None:
            step = enter[first] if leave is None else enter[first] + leave
        else:
            step = (ahead[:, None] + enter).max(0) if leave is None else (ahead + enter).max() + leave
        rows.append(step)
        ahead = step
    state, out = int(np.argmax(ahead)) if last is None else last, []
    for k in range(len(matrices) - 1, 0, -1):
        enter, leave = matrices[k]
        state = int(np.argmax(rows[k - 1] + (enter[:, state] if leave is None else enter)))
        out.append(state)
    return out[::-1]


def _escaped(text, dummy: bool):
    marked = F.replace(text, F.lit(" "), F.lit(MARK))
    return F.when(F.length(text) > 0, F.concat(F.lit(MARK), marked) if dummy else marked).otherwise("")


def escaped_texts(docs: DataFrame, model: dict, key: str, text: str, longer: int | None = None, up_to: int | None = None) -> DataFrame:
    """key and t, the text as the model sees it, of texts longer than a number of characters or up to it."""
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    size = F.length(plain) + int(model["dummy"])
    rows = docs.where(size > longer) if longer is not None else docs.where(size <= up_to)
    return rows.select(F.col(key).alias("key"), _escaped(plain, model["dummy"]).alias("t"))


def chunks(long: DataFrame, chunk: int, margin: int) -> DataFrame:
    """id, key, chunk, chunks, lead, size, part: slices of texts, with ``margin`` characters on either side; the id is that of the row."""
    long = long.withColumn("id", F.monotonically_increasing_id()).withColumn("chunks", F.ceil(F.length("t") / chunk).cast("int"))

    def cut(i):
        start = i * chunk
        lead = F.least(start, F.lit(margin))
        return F.struct(i.alias("chunk"), lead.alias("lead"), F.least(F.lit(chunk), F.length("t") - start).alias("size"),
                        F.substring("t", start - lead + 1, lead + chunk + margin).alias("part"))

    return long.select("id", "key", "chunks", F.explode(F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), cut)).alias("c")).select("id", "key", "chunks", "c.*")


def _matrices(group: pd.DataFrame) -> list[Matrix]:
    return [(np.array(e, float).reshape(n, -1) if x is None else np.array(e, float), None if x is None else np.array(x, float))
            for e, x, n in zip(group["enter"], group["leave"], group["rows"])]


def scan_states(matrices: DataFrame, most: int) -> DataFrame:
    """(id, chunk, i, j): the states at both ends of every chunk, from one matrix for each chunk.

    Products of FAN neighbours, then of FAN products, until one range holds ``most`` chunks; then back down, range by range.
    A task has FAN matrices at a time, whatever the length of a text.
    """
    columns = "id long, chunk int, enter array<double>, leave array<double>, rows int"
    ranged = F.floor(F.col("chunk") / FAN).cast("int").alias("range")

    def multiply(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        enter, leave = product(_matrices(group))
        first = group.iloc[:1]
        return pd.DataFrame({"id": first["id"], "chunk": first["range"], "enter": [enter.ravel().tolist()],
                             "leave": [None if leave is None else leave.tolist()], "rows": [len(enter)]})

    def resolve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        first, last = int(group["i"].iloc[0]), int(group["j"].iloc[0])
        inner = boundary_states(_matrices(group), first, last)
        return pd.DataFrame({"id": group["id"], "chunk": group["chunk"], "i": [first, *inner], "j": [*inner, last]})

    levels = [matrices.select("id", "chunk", "enter", "leave", "rows")]
    while most > FAN:
        below = levels[-1].select("*", ranged)
        levels.append(stage(below.groupBy("id", "range").applyInPandas(multiply, columns), "piece-products"))
        most = -(-most // FAN)
    states = None
    for level in reversed(levels):
        rows = level.select("*", ranged)
        if states is None:  # the whole text: one state before its first character and one behind its last
            rows = rows.select("*", F.lit(0).alias("i"), F.lit(0).alias("j"))
        else:
            ends = states.select(F.col("id").alias("of"), F.col("chunk").alias("of_range"), "i", "j")
            rows = rows.join(ends, (F.col("id") == F.col("of")) & (F.col("range") == F.col("of_range"))).drop("of", "of_range")
        states = rows.groupBy("id", "range").applyInPandas(resolve, "id long, chunk int, i int, j int")
    return states


def encode(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, model: dict | None = None) -> DataFrame:
    """One row per document: key and ``pieces``, the piece numbers in order.

    A null or empty text has no pieces. Keys are taken as they are and may be null or repeated; a text longer
    than a chunk gets a number of its own when its chunks are written.
    Characters outside the vocabulary become byte pieces if the model has them, else the unknown piece. Which of several
    unigram paths with the best sum is taken may depend on where chunks end. Further columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    model = model or read_model(model_file)
    shared = spark.sparkContext.broadcast(model)
    margin = 2 * max(len(p) for p, _, _ in model["pieces"])
    if chunk < 2 * margin:
        raise ValueError(f"a chunk needs at least {2 * margin} characters")
    kind = dict(docs.select(F.col(key).alias("key")).dtypes)["key"]

    def listed(encoded: Iterator[list[int]]) -> pa.ListArray:
        flat, ends = array("i"), [0]
        for numbers in encoded:
            flat.extend(numbers)
            ends.append(len(flat))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if len(flat) else np.zeros(0, np.int32)))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(shared)
        for batch in batches:
            for rows in _slices(batch, "t"):
                pieces = lattice.whole(rows["t"]) if lattice.bpe else listed(lattice.encode(t, 0, len(t)) if t else [] for t in rows["t"].to_pylist())
                yield pa.RecordBatch.from_arrays([rows["key"], pieces], ["key", "pieces"])
        pa.default_memory_pool().release_unused()

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(shared)
        for batch in batches:
            for rows in _slices(batch, "part"):
                cols = [rows[c].to_pylist() for c in ("part", "lead", "size", "i", "j")]
                pieces = listed(lattice.encode(part, lead, lead + size, i, j) for part, lead, size, i, j in zip(*cols))
                yield pa.RecordBatch.from_arrays([rows["id"], rows["key"], rows["chunk"], pieces], ["id", "key", "chunk", "pieces"])

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(shared)
        for batch in batches:
            for rows in _slices(batch, "part"):
                found = [lattice.matrix(p, a, a + n) for p, a, n in zip(*[rows[c].to_pylist() for c in ("part", "lead", "size")])]
                yield pa.RecordBatch.from_arrays([rows["id"], rows["chunk"], pa.array([e.ravel().tolist() for e, _ in found], pa.list_(pa.float64())),
                                                  pa.array([None if x is None else x.tolist() for _, x in found], pa.list_(pa.float64())),
                                                  pa.array([len(e) for e, _ in found], pa.int32())], ["id", "chunk", "enter", "leave", "rows"])

    short = escaped_texts(docs, model, key, text, up_to=chunk).mapInArrow(whole, f"key {kind}, pieces array<int>")
    cut = stage(chunks(escaped_texts(docs, model, key, text, longer=chunk), chunk, margin), "piece-chunks")
    most = cut.agg(F.max("chunks")).first()[0]
    if most is None:
        return short
    with small_batches(spark, CHUNKS):
        matrices = stage(cut.select("id", "chunk", "lead", "size", "part")
                         .mapInArrow(transfer, "id long, chunk int, enter array<double>, leave array<double>, rows int"), "piece-matrices")
    states = stage(scan_states(matrices, most), "piece-states").select(F.col("id").alias("of"), F.col("chunk").alias("at"), "i", "j")
    placed = cut.join(states, (F.col("id") == F.col("of")) & (F.col("chunk") == F.col("at")))
    long = placed.select("id", "key", "chunk", "lead", "size", "part", "i", "j").mapInArrow(trace, f"id long, key {kind}, chunk int, pieces array<int>")
    long = long.groupBy("id").agg(F.first("key").alias("key"), F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "pieces"))), lambda x: x["pieces"])).alias("pieces"))
    return short.union(long.select("key", "pieces"))


def decode(encoded: DataFrame, model_file: str, pieces: str = "pieces", out: str = "text", model: dict | None = None) -> DataFrame:
    """Add the text of each piece array: bytes are joined, marks become spaces, the added first space goes.

    A null array decodes to null; control pieces have no text; bytes that are not UTF-8 become U+FFFD. What is decoded is written
    first: else a task that encodes and decodes would hold two Python processes at once.
    """
    spark = encoded.sparkSession
    with small_batches(spark):
        encoded = stage(encoded, "pieces")
    shared = spark.sparkContext.broadcast(model or read_model(model_file))

    @F.pandas_udf("string")
    def text_of(arrays: pd.Series) -> pd.Series:
        lattice = _lattice(shared)
        table = [b"" if i in lattice.control else bytes([lattice.id_bytes[i]]) if i in lattice.id_bytes else name.replace(MARK, " ").encode()
                 for i, name in enumerate(lattice.names)]
        done = []
        for a in arrays:
            text = None if a is None else b"".join(map(table.__getitem__, a.tolist())).decode("utf-8", "replace")
            done.append(text[1:] if text and lattice.dummy and text[0] == " " else text)
        return pd.Series(done, dtype=object)

    return encoded.withColumn(out, text_of(F.col(pieces)))
