"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact verification.

Texts and benchmark items are read as sequences of characters (lower case, words
of letters and digits with one blank between them).  The CGK random walk turns
edit distance into Hamming distance: at each step it writes the character under
a pointer, and a random bit of that character says whether the pointer moves
on.  Two sequences with few edits fall into step again after each edit, so they
write the same characters at most steps.  Bit sampling then hashes some steps;
independent walks and samples bring the recall up.

A window begins at every word of a text and of an item (in scripts without
blanks at every character), so an item is entered from all of its words and
needs no word to be equal.  The length of the walks, the sampled steps and the
votes go by the length of the item (``TIERS``); walks are made for the tiers
that have items, and a walk ends early when no item has its first sampled steps
(which loses nothing).  Places with enough votes pass a bound that loses nothing (an
edit touches at most q of an item's q-grams, so the others must be near the
hit), and are then verified exactly: the least edit distance, in characters,
between the item and any part of the text around the hit must be at most
``1 - LEAST_SIMILARITY`` of the item's length.

The benchmark is the query set.  Its items go to the tasks in blocks of
``BLOCK_ITEMS``; texts are read once for each block and never shuffled.

Defined cases: null, empty and wordless texts or items match nothing.  Items with
equal texts are all reported.  Rows are scanned one by one, so repeated rows
give repeated results and null ids pass through.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.base import in_small_batches, ship

ship(__name__)

LEAST_SIMILARITY = 0.8
#: least characters of an item, steps of its walks, steps sampled, independent walks, least votes
TIERS = ((60, 28, 14, 6, 2), (20, 16, 7, 6, 1), (6, 6, 3, 4, 1), (1, 1, 1, 1, 1))
VOTE_CHARS = 40            # characters of an item for each vote asked for, above the least
MOST_VOTES = 8             # votes asked for at most: in a long item with one-sided edits few anchors agree on a place
NEAR = 10                  # characters between places that count as one
LONG = 400                 # characters of an item from which a quarter of its edits may lie between them
TEST_BITS = 20             # of a key, that select the walks worth finishing
PLACE_BITS = 33            # of a place in a text (which may begin ahead of it) beside its text and item
GRAMS = (2, 3)             # q-grams of the bound before verification
BLOCK_ITEMS = 4096
SLICE_BYTES = 1 << 20

_RNG = np.random.default_rng(20240901)
_IS_WORD = np.array([chr(c).isalnum() or c >= 128 for c in range(129)])
_PAD = max(t[1] for t in TIERS) + 1


def _walks(steps: int, sampled: int, repeats: int) -> list[list[tuple[np.ndarray, np.ndarray | None]]]:
    """For each walk and step: moves by symbol, and numbers by symbol where the step is sampled."""
    out = []
    for _ in range(repeats):
        chosen = set(_RNG.choice(steps, sampled, replace=False).tolist())
        walk = []
        for step in range(max(chosen) + 1):
            moves = _RNG.integers(0, 2, 256).astype(np.int32)
            moves[0] = 0                                     # a walk ends with its text
            walk.append((moves, _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) if step in chosen else None))
        out.append(walk)
    return out


_WALKS = [_walks(*t[1:4]) for t in TIERS]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Symbols:
    """Characters of several texts in one array, with a zero after each text."""

    def __init__(self, texts: list[str | None]):
        parts = [(t or "").lower() for t in texts]
        raw = np.frombuffer("".join(t + "\n" for t in parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in parts], dtype=np.int64) - 1
        inside = _IS_WORD[np.minimum(raw, 128)]
        begin = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0) == 1)
        text = np.searchsorted(ends, begin)
        keep = inside.copy()
        later = np.flatnonzero(np.diff(text, prepend=-1) == 0)     # words with one before them in their text
        keep[begin[later] - 1] = True
        keep[ends] = True
        place = np.cumsum(keep) - 1
        chars = np.where(inside, raw, np.uint32(32))
        chars[ends] = 0
        self.chars = np.concatenate([chars[keep], np.zeros(_PAD, np.uint32)])
        low = (self.chars ^ (self.chars >> np.uint32(8))).astype(np.uint8)
        self.low = np.where((self.chars != 0) & (low == 0), np.uint8(1), low)
        self.words = place[begin]
        self.stop = place[ends]                                    # the zero of each text
        self.start = np.concatenate([[0], self.stop[:-1] + 1]).astype(np.int64)[:len(parts)]
        dense = (self.chars >= 0x2E80) | ((self.chars >= 0x0E00) & (self.chars < 0x0F00))
        self.windows = np.union1d(self.words, np.flatnonzero(dense)) if dense.any() else self.words

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.stop, at)

    def line(self, lo: int, hi: int) -> str:
        return self.chars[lo:hi].tobytes().decode("utf-32-le", "surrogatepass")

    def word(self, at: int, first: int) -> int:
        """Number of the first word at or after a place, in the text that begins at ``first``."""
        return int(np.searchsorted(self.words, max(at, first)) - np.searchsorted(self.words, first))


def walk_keys(low: np.ndarray, starts: np.ndarray, walk: list, tests: dict[int, np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """Keys of the sampled steps of the walks from ``starts``, the last characters seen, and which walks these are.

    With ``tests``, only walks whose key of the first ``n`` sampled steps passes
    ``tests[n]``, for each such ``n``, are walked on; the others cannot meet the
    tests' items.
    """
    which = np.arange(len(starts))
    keys, pointer, seen = np.zeros(len(starts), np.uint64), starts.astype(np.int32 if len(low) < 1 << 31 else np.int64), low[starts]
    sampled = 0
    for moves, numbers in walk:
        seen = low[pointer]
        if numbers is not None:
            keys += numbers[seen]
            sampled += 1
            if tests and sampled in tests:
                on = np.flatnonzero(tests[sampled][(_mix(keys) >> np.uint64(64 - TEST_BITS)).astype(np.int64)])
                which, keys, pointer, seen = which[on], keys[on], pointer[on], seen[on]
        pointer += moves[seen]
    return _mix(keys), seen, which


def _tests(low: np.ndarray, starts: np.ndarray, walk: list) -> dict[int, np.ndarray]:
    """For some numbers of sampled steps: the keys that the walks from ``starts`` have there, as marks by leading bits."""
    steps = np.flatnonzero([n is not None for _, n in walk])
    out = {}
    for n in sorted({len(steps) * k // 7 for k in (3, 4, 5, 7)} - {0}):
        keys, _, _ = walk_keys(low, starts, walk[:steps[n - 1] + 1])
        marks = np.zeros(1 << TEST_BITS, bool)
        marks[(keys >> np.uint64(64 - TEST_BITS)).astype(np.int64)] = True
        out[n] = marks
    return out


def _grams(low: np.ndarray, q: int) -> np.ndarray:
    """Hashes of 16 bits of the q-grams of some characters."""
    out = low[:len(low) - q + 1].astype(np.uint32)
    for k in range(1, q):
        out = out * np.uint32(0x9E3779B1) + low[k:len(low) - q + 1 + k]
    return (out * np.uint32(0x85EBCA6B)) >> np.uint32(16)


def least_distance(item: str, text: str, limit: int) -> int | None:
    """Least edit distance of ``item`` to any part of ``text``; None above ``limit``.

    Bit-parallel columns (one bit for each character of the item).
    """
    if item in text:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, now = full, 0, len(item)
    best = now
    for c in text:
        eq = where.get(c, 0)
        diag = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (full & ~(diag | plus)), plus & diag
        now += bool(up & top) - bool(down & top)
        best = min(best, now)
        up, down = (up << 1) & full, (down << 1) & full   # a part may begin anywhere
        plus, minus = down | (full & ~(diag | up)), up & diag
    return best if best <= limit else None


class Index:
    """LSH tables of one block of items."""

    def __init__(self, items: list[tuple], least: float = LEAST_SIMILARITY):
        own = Symbols([t for _, t in items])
        self.ids = [i for i, _ in items]
        spans = list(zip(own.start.tolist(), own.stop.tolist()))
        self.lines = [own.line(a, b) for a, b in spans]
        self.limits = [int((1 - least) * len(s) + 1e-9) for s in self.lines]
        self.grams = [[_grams(own.low[a:b], q) for q in GRAMS] for a, b in spans]
        item = own.text_of(own.windows)
        size = (own.stop - own.start)[item] if len(items) else item
        least_size = np.array([t[0] for t in TIERS])
        tier = np.argmax(size[:, None] >= least_size[None, :], axis=1)
        self.votes = np.array([max(min(len(s) // VOTE_CHARS, MOST_VOTES), next((t[4] for t in TIERS if len(s) >= t[0]), 1)) for s in self.lines])
        self.near = np.array([max(NEAR, limit // 4) if len(s) >= LONG else NEAR for s, limit in zip(self.lines, self.limits)], np.int64)
        self.tables = []                                     # (walk, keys, items, places in the items, tests)
        for k, walks in enumerate(_WALKS):
            mine = own.windows[tier == k]
            for walk in walks if len(mine) else ():
                keys, seen, _ = walk_keys(own.low, mine, walk)
                whole = np.flatnonzero(seen)                 # walks that do not leave the item
                order = whole[np.argsort(keys[whole], kind="stable")]
                text = own.text_of(mine[order])
                self.tables.append((walk, keys[order], text, mine[order] - own.start[text], _tests(own.low, mine[order], walk)))
        self.marks = [np.zeros(1 << 16, bool) for _ in GRAMS]

    def _possible(self, item: int, low: np.ndarray) -> bool:
        """Whether the characters hold as many q-grams of the item as its limit asks for."""
        for q, mark, own in zip(GRAMS, self.marks, self.grams[item]):
            need = len(self.lines[item]) - q + 1 - q * self.limits[item]
            if need > 0:
                near = _grams(low, q) if len(low) >= q else own[:0]
                mark[near] = True
                n = int(np.count_nonzero(mark[own]))
                mark[near] = False
                if n < need:
                    return False
        return True

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int]]:
        """(text, item, distance, first word of the place) of the best place of each item in each text."""
        if not self.tables or not texts:
            return []
        own = Symbols(texts)
        text = own.text_of(own.windows)
        hits = []
        for walk, table, items, before, tests in self.tables:
            keys, _, some = walk_keys(own.low, own.windows, walk, tests)
            lo, hi = (np.searchsorted(table, keys, side=s) for s in ("left", "right"))
            count = hi - lo
            entry = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - lo, count)
            doc = np.repeat(text[some], count)
            hits.append(np.stack([doc * len(self.ids) + items[entry], np.repeat(own.windows[some], count) - own.start[doc] - before[entry]]))
        pair, at = np.concatenate(hits, axis=1)          # a place may begin ahead of its text, where words are missing
        ahead = 1 << (PLACE_BITS - 1)
        key = np.sort((pair << PLACE_BITS) + at + ahead)  # places of one item in one text lie side by side
        item = (key >> PLACE_BITS) % len(self.ids)
        votes = np.searchsorted(key, key + self.near[item], side="right") - np.searchsorted(key, key - self.near[item], side="left")
        key = np.unique(key[votes >= self.votes[item]])
        best: dict[tuple[int, int], tuple[int, int]] = {}
        done: dict[tuple[int, int], int] = {}
        for k in key.tolist():
            doc, item = divmod(k >> PLACE_BITS, len(self.ids))
            first, at = int(own.start[doc]), (k & ((1 << PLACE_BITS) - 1)) - ahead + int(own.start[doc])
            if best.get((doc, item), (1,))[0] == 0 or at <= done.get((doc, item), -1 << 60):
                continue
            size, limit = len(self.lines[item]), self.limits[item]
            done[doc, item] = at + NEAR + size // 8      # the same place, a few words on
            lo, hi = max(first, at - limit - NEAR), min(int(own.stop[doc]), at + size + limit + 2 * NEAR + size // 8)
            if not self._possible(item, own.low[lo:hi]):
                continue
            d = least_distance(self.lines[item], own.line(lo, hi), limit)
            if d is not None and d < best.get((doc, item), (1 << 60,))[0]:
                best[doc, item] = (d, own.word(at, first))
        return [(doc, item, d, at) for (doc, item), (d, at) in sorted(best.items())]


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about SLICE_BYTES characters."""
    lo = size = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE_BYTES:
            yield lo, k + 1
            lo, size = k + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _blocks(benchmark: DataFrame, id_col: str, text: str) -> Iterator[list[tuple]]:
    """Items in blocks that are sure to be small; only one is on the driver at a time."""
    rows = benchmark.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text is not null")
    block: list[tuple] = []
    for r in rows.orderBy("id", "text").toLocalIterator():
        block.append((r["id"], r["text"]))
        if len(block) == BLOCK_ITEMS:
            yield block
            block = []
    if block:
        yield block


def _match(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, out = b.column(0).to_pylist(), b.column(1).to_pylist(), []
            for lo, hi in _slices(texts):
                out += [(ids[lo + doc], index.ids[item], d, 1 - d / len(index.lines[item]), at) for doc, item, d, at in index.find(texts[lo:hi])]
            cols = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "item_id", "distance", "similarity", "first_word"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", least: float = LEAST_SIMILARITY) -> DataFrame:
    """One row for each document and item found in it, with the best edit distance."""
    rows = in_small_batches(docs).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = "doc_id long, item_id long, distance long, similarity double, first_word long"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(benchmark, item_id, item_text):
        out = out.unionAll(rows.mapInArrow(_match(Index(block, least)), schema))
    return out


def _clean(index: Index, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(place).to_pylist()
            keep = np.ones(len(texts), bool)
            for lo, hi in _slices(texts):
                keep[[lo + doc for doc, *_ in index.find(texts[lo:hi])]] = False
            yield b.filter(pa.array(keep))
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", least: float = LEAST_SIMILARITY) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; nothing is shuffled or joined."""
    for block in _blocks(benchmark, item_id, item_text):
        docs = in_small_batches(docs).mapInArrow(_clean(Index(block, least), docs.columns.index(text)), docs.schema)
    return docs


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
