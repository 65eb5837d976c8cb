"""Runs (maximal periodic stretches of words) by Baier's grouping of suffixes and longest common extensions.

Phase one of Baier's suffix sorter refines groups of suffixes, from the highest to the lowest, until each
group is named by a Lyndon word: the longest Lyndon word that starts at its members. The lengths of these names
are the Lyndon array, once under an order of the words and once under the reversed order. Every run holds, under one of
the two orders, a Lyndon word as long as its period, so each (position, length) is extended to both
sides by longest common extensions; those that cover two periods are the runs.

A run of at least ``m`` words repeats, at the distance of its period, every gram of ``m / 2`` words it holds, so all its words
lie in grams that occur twice in the text. Only such stretches are grouped; the stretches of many texts are
joined by words that occur once, over which no run can reach.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, let, words
from .tokens import mix

#: words that are searched together; a longer text is searched alone
BLOCK_WORDS = 1 << 16
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def lyndon_array(symbols: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each position, the end sorting before every symbol.

    Groups are ranges of ``order``. A group is done when all higher ones are: its members' next lower
    neighbours to the left (not yet done, found by merged intervals) take its word, as often as it follows them, into their own names.
    """
    n = len(symbols)
    by_symbol = np.argsort(symbols, kind="stable")
    in_order = symbols[by_symbol]
    first = np.flatnonzero(np.r_[True, in_order[1:] != in_order[:-1]]) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, n])
    group = np.empty(n + 1, np.int64)
    group[by_symbol + 1] = np.repeat(first, sizes)
    size_of, name_length = np.zeros(n, np.int64), np.ones(n, np.int64)
    size_of[first] = sizes
    at = np.empty(n + 1, np.int64)
    at[by_symbol + 1] = np.arange(n)
    # positions count from 1; 0 stands for "none to the left"
    order, group, at, size, length = (by_symbol + 1).tolist(), group.tolist(), at.tolist(), size_of.tolist(), name_length.tolist()
    left, out, end = list(range(n + 1)), [0] * (n + 1), n
    while end:
        start = group[order[end - 1]]
        members, name = order[start:end], length[start]
        end = start
        for i in members:
            left[i] = i - 1
            out[i] = name
        times: dict[int, int] = {}
        for i in members:
            j = i - 1
            while left[j] != j:
                left[j] = left[left[j]]
                j = left[j]
            left[i] = j
            if j:
                times[j] = times.get(j, 0) + 1
        if len(times) == 1:
            shares = list(times.items())
        else:
            shares = sorted(times.items(), key=lambda x: -x[1])
        k = 0
        while k < len(shares):
            often, moved = shares[k][1], defaultdict(list)
            while k < len(shares) and shares[k][1] == often:
                j = shares[k][0]
                old = group[j]
                size[old] -= 1
                last = old + size[old]
                other = order[last]
                order[at[j]], at[other] = other, at[j]
                order[last], at[j] = j, last
                moved[old].append(j)
                k += 1
            for old, taken in moved.items():
                new = old + size[old]
                length[new] = length[old] + often * name
                size[new] = len(taken)
                for j in taken:
                    group[j] = new
    return np.array(out[1:], np.int64)


class Extensions:
    """Longest common extensions by names of all substrings of 1, 2, 4, ... symbols; equal names are equal substrings."""

    def __init__(self, symbols: np.ndarray):
        names = np.unique(symbols, return_inverse=True)[1].astype(np.int32)
        self.size, self.names = len(symbols), [names]
        while True:
            half, names = 1 << (len(self.names) - 1), self.names[-1]
            if 2 * half > self.size or names.max() + 1 == len(names):  # all different: nothing longer is equal
                break
            pairs = names[:-half].astype(np.int64) << 32 | names[half:]
            self.names.append(np.unique(pairs, return_inverse=True)[1].astype(np.int32))

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` and from ``b`` on are the same; a < b."""
        found = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names, to = self.names[k], b + found
            inside = to < len(names)
            same = inside & (names[np.where(inside, a + found, 0)] == names[np.where(inside, to, 0)])
            found += same * (1 << k)
        return found

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before ``a`` and before ``b`` are the same; a < b."""
        found = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names, x, y = self.names[k], a - found - (1 << k), b - found - (1 << k)
            inside = x >= 0
            found += (inside & (names[np.where(inside, x, 0)] == names[np.where(inside, y, 0)])) * (1 << k)
        return found


def find_runs(symbols: np.ndarray, least: int = 2) -> np.ndarray:
    """Rows (start, length, period) of all runs of at least ``least`` symbols, by start and period."""
    n = len(symbols)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    extensions, i = Extensions(symbols), np.arange(n)
    roots = np.concatenate([np.stack([i, lyndon_array(s)], 1) for s in (symbols, symbols.max() - symbols)])
    roots = np.unique(roots, axis=0)
    at, period = roots[:, 0], roots[:, 1]
    before = extensions.backward(at, at + period)
    length = before + period + extensions.forward(at, at + period)
    runs = np.stack([at - before, length, period], 1)[(length >= 2 * period) & (length >= least)]
    return np.unique(runs[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def repeated_grams(ids: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """True for the words in a gram of ``width`` words whose hash occurs twice in its text.

    Two grams with one hash only add words to look at.
    """
    n = len(ids) - width + 1
    if n < 2:
        return np.zeros(len(ids), bool)
    h = text[:n].astype(np.uint64)
    for k in range(width):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + ids[k:n + k].astype(np.uint64) + np.uint64(1))
    inside = np.flatnonzero(text[:n] == text[width - 1:])
    order = inside[np.argsort(h[inside])]
    same = h[order[1:]] == h[order[:-1]]
    change = np.zeros(len(ids) + 1, np.int32)
    starts = order[np.r_[False, same] | np.r_[same, False]] if len(order) else order
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0


def runs_of_texts(texts: list[list[bytes]], least: int) -> list[np.ndarray]:
    """Per text (its words) the rows (start, length, period) of its runs."""
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    lengths = np.array([len(t) for t in texts])
    ids = np.fromiter((numbers[w] for t in texts for w in t), np.int64, int(lengths.sum()))
    text = np.repeat(np.arange(len(texts)), lengths)
    covered = repeated_grams(ids, text, max(1, (least + 1) // 2))
    found = [np.zeros((0, 3), np.int64)] * len(texts)
    if not covered.any():
        return found
    before = np.r_[False, covered[:-1] & (text[1:] == text[:-1])]
    at = np.flatnonzero(covered)
    stretch = np.cumsum(covered & ~before)[at] - 1
    origin = np.full(len(at) + stretch[-1], -1)
    place = np.arange(len(at)) + stretch
    origin[place] = at
    symbols = np.empty(len(origin), np.int64)
    symbols[place] = ids[at]
    symbols[origin < 0] = len(numbers) + np.arange(stretch[-1])
    runs = find_runs(symbols, least)
    runs[:, 0] = origin[runs[:, 0]]
    owner = text[runs[:, 0]]
    runs[:, 0] -= (np.cumsum(lengths) - lengths)[owner]
    for part in np.split(np.arange(len(runs)), np.flatnonzero(np.diff(owner)) + 1):
        if len(part):
            found[owner[part[0]]] = runs[part]
    return found


def collapse(words_: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that repeat the first period of a run, joined by one space."""
    if not len(runs):
        return b" ".join(words_)
    change = np.zeros(len(words_) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(words_[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist())


def _search(least: int):
    def block(rows: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of_texts(texts, least)
        flat = np.concatenate(found)
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
        struct = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=["start", "length", "period"])
        collapsed = pa.array([collapse(t, f) for t, f in zip(texts, found)], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([rows, pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(offsets, struct), collapsed],
                                          names=["row", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, column = batch.column("row"), batch.column("text").cast(pa.binary())
            first, texts, held = 0, [], 0
            for i in range(len(column)):
                texts.append((column[i].as_py() or b"").split())
                held += len(texts[-1])
                if held >= BLOCK_WORDS or i + 1 == len(column):
                    yield block(rows.slice(first, i + 1 - first), texts)
                    first, texts, held = i + 1, [], 0
    return run


def periodic_runs(docs: DataFrame, text: str = "text", least: int = 12, carry: list[str] | None = None) -> DataFrame:
    """One row per document: ``row`` (struct of the carried columns, all by default), n_words, runs, collapsed.

    ``runs`` holds (start, length, period) of every run of at least ``least`` words (two at least) and of two periods, by start, then period;
    ``collapsed`` are the words that no run holds after its first period, joined by one space. Words are compared as
    bytes, whole. Null and empty texts have no words, no runs and an empty ``collapsed``; repeated rows come back as often;
    empty tables give no rows. A text is searched in one task, in memory of about 300 bytes a word of its repeated stretches.
    """
    least = max(2, least)
    whole = F.struct(*[F.col(c) for c in (carry or docs.columns)])
    rows = docs.select(whole.alias("row"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_search(least), f"row {rows.schema['row'].dataType.simpleString()}, n_words long, runs {RUNS}, collapsed string")


def made_periodic(doc_id: str, text: str, period_of: int = 10) -> Column:
    """The text, with words repeated periodically from some word on where the hash of the id is divisible by ``period_of``."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / period_of)

    def repeat(w: Column) -> Column:
        n = F.size(w)
        start = (g % n).cast("int")
        period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(w, lambda x, i: F.when(i >= start, F.get(w, start + (i - start) % period)).otherwise(x)), " ")

    return F.when(fold(doc_id, period_of) == 0, let(words(text), repeat)).otherwise(F.col(text))


def run_digests(found: DataFrame) -> DataFrame:
    """The carried row with the longest run and the digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    joined = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    told = found.select("row.*", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), joined.alias("lines"), "collapsed")
    period = -F.col("best.period")
    return told.select(*found.schema["row"].dataType.names, "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), period.alias("period"),
                       F.floor(F.expr("1000 * best.length div -best.period")).cast("long").alias("exponent_milli"),
                       F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
