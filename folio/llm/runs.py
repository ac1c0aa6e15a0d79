"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of a text with smallest period q that no neighbouring word
extends, of at least ``LEAST`` words and ``TIMES`` periods.  The texts of a batch
that repeat any eight words become one sequence of (text, word) numbers with an
end mark after each text.  Over it stand

- the ranks of all factors of 2^k words (prefix doubling); the last order is the
  suffix array, in which equal factors of any such length are one interval;
- a wavelet matrix over the suffix array, whose range successor gives the next
  place of a factor at or after a given word.

For each length 2^k >= 8, each block (a factor at a multiple of 2^k) asks for its
places in the window that begins 2^k to 2^(k+1) - 1 words behind it (from 1
word on for the shortest blocks).  A run of period q holds a block of
2^k <= q < 2^(k+1) words whose copy, q words on, lies in the run too, as the run
has three periods.  One or two places are candidate periods.  Three or more are
a progression, whose difference p is the block's period: then the stretches
of period p around the block and around its copies are found, and the distances
of their left and of their right ends are the candidates (were neither the
period, the run would have period p).  A candidate is extended both ways by
descending factor lengths, and of equal stretches the least period stays.  All
this is O(n log n) for n words, done by array operations in the task that read the
texts; nothing is shuffled.

Defined cases: a null, empty or blank text has no words, so no run and an empty
collapsed text.  Repeated rows give repeated result rows; a null id stays null.
An empty table gives no rows.  A long text is one row and is handled whole.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.base import in_small_batches, ship, words
from folio.operators.chunking import let

ship(__name__)

LEAST = 24             # words of a run; the search needs 24, so that blocks of 8 words fit
TIMES = 3              # periods of a run; the search needs 3
SHORTEST = 3           # blocks have 2^3 words or more
TOGETHER = 1 << 18     # words of the texts searched together (one text may have more)


def _ranks(symbols: np.ndarray, levels: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Ranks of the factors of 2^k symbols for k < ``levels``, the ends of their intervals, the order of the last ones.

    A rank is the first place of the factor's interval in the order.
    """
    n = len(symbols)
    ranks, ends = [], []
    key = symbols.astype(np.int64)
    for k in range(levels):
        order = np.argsort(key)
        ordered = key[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        size = np.diff(np.append(starts, n))
        rank, end = np.empty(n, np.int64), np.empty(n, np.int64)
        rank[order] = np.repeat(starts, size)
        end[order] = np.repeat(starts + size, size)
        ranks.append(rank)
        ends.append(end)
        step = 1 << k
        key = rank * (n + 1)
        key[:n - step] += rank[step:] + 1
    return ranks, ends, order


class Successor:
    """Wavelet matrix of an array of distinct numbers below its length."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros = []          # of each bit from the highest: how many zeros stand before each place
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1
            self.zeros.append(np.concatenate([[0], np.cumsum(1 - one)]).astype(np.int32))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [lo, hi) are less than x."""
        lo, hi, found = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        over = x >= 1 << self.bits
        for level, zeros in enumerate(self.zeros):
            one = (x >> (self.bits - 1 - level)) & 1 == 1
            zlo, zhi = zeros[lo], zeros[hi]
            found += np.where(one, zhi - zlo, 0)
            lo, hi = np.where(one, zeros[-1] + lo - zlo, zlo), np.where(one, zeros[-1] + hi - zhi, zhi)
        return np.where(over, -1, found)

    def nth(self, lo: np.ndarray, hi: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The value of [lo, hi) that has ``at`` lesser ones there."""
        lo, hi, at, value = lo.copy(), hi.copy(), at.copy(), np.zeros(len(lo), np.int64)
        for level, zeros in enumerate(self.zeros):
            zlo, zhi = zeros[lo], zeros[hi]
            one = at >= zhi - zlo
            value |= one.astype(np.int64) << (self.bits - 1 - level)
            at = np.where(one, at - (zhi - zlo), at)
            lo, hi = np.where(one, zeros[-1] + lo - zlo, zlo), np.where(one, zeros[-1] + hi - zhi, zhi)
        return value

    def at_least(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least value >= x of [lo, hi); -1 where there is none."""
        found = self.below(lo, hi, x)
        some = (found >= 0) & (found < hi - lo)
        out = np.full(len(lo), -1, np.int64)
        out[some] = self.nth(lo[some], hi[some], found[some])
        return out


def _extend(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many symbols before, and how many from, places i < j on are equal."""
    n = len(ranks[0])
    behind, ahead = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        rank, step = ranks[k], 1 << k
        while True:
            a, b = i + ahead, j + ahead
            same = (b + step <= n) & (rank[a] == rank[np.minimum(b, n - 1)])
            ahead += step * same
            if k < len(ranks) - 1 or not same.any():
                break
        while True:
            a, b = i - behind - step, j - behind - step
            same = (a >= 0) & (rank[np.maximum(a, 0)] == rank[b])
            behind += step * same
            if k < len(ranks) - 1 or not same.any():
                break
    return behind, ahead


def _periods(ranks, ends, order) -> tuple[np.ndarray, np.ndarray]:
    """Places and candidate periods: every run of three periods has one of its period at a place in it."""
    n = len(order)
    successor = None
    places, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def put(s, d):
        places.append(s)
        periods.append(d)

    for k in range(SHORTEST, len(ranks)):
        size = 1 << k
        block = np.arange(0, n, size)
        lo, hi = ranks[k][block], ends[k][block]
        more = hi - lo > 1
        block, lo, hi = block[more], lo[more], hi[more]
        if not len(block):
            continue
        successor = successor or Successor(order)
        found = successor.at_least(lo, hi, block + (size if k > SHORTEST else 1))

        def inside(f, s):
            return (f >= 0) & (f < s + 2 * size)

        if k == SHORTEST:  # at most 15 places
            while len(block):
                ok = inside(found, block)
                block, lo, hi, found = block[ok], lo[ok], hi[ok], found[ok]
                put(block, found - block)
                found = successor.at_least(lo, hi, found + 1)
            continue
        ok = inside(found, block)
        block, lo, hi, one = block[ok], lo[ok], hi[ok], found[ok]
        two = successor.at_least(lo, hi, one + 1)
        ok = inside(two, block)
        put(block[~ok], one[~ok] - block[~ok])
        block, lo, hi, one, two = block[ok], lo[ok], hi[ok], one[ok], two[ok]
        three = successor.at_least(lo, hi, two + 1)
        ok = inside(three, block)
        for at in (one, two):
            put(block[~ok], at[~ok] - block[~ok])
        block, one, step = block[ok], one[ok], (two - one)[ok]
        before, after = _extend(ranks, block, block + step)
        before2, after2 = _extend(ranks, one, one + step)
        for d in ((one - before2) - (block - before), (one + after2) - (block + after)):
            real = (d >= size) & (d < 2 * size)
            put(block[real], d[real])
    return np.concatenate(places), np.concatenate(periods)


def runs_of(texts: list[np.ndarray], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """Of each text (an array of word numbers): its runs as rows of start, length, period, by start and period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    if max(lengths, default=0) < least:
        return [np.empty((0, 3), np.int64)] * len(texts)
    levels = max(int(max(lengths) // times).bit_length(), SHORTEST + 1)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    word = np.concatenate([x for t in texts for x in (t, [-1])]).astype(np.int64) + 1
    text = np.repeat(np.arange(len(texts)), lengths + 1)
    ranks, ends, order = _ranks(text * (word.max() + 1) + word, levels)
    place, period = _periods(ranks, ends, order)
    before, after = _extend(ranks, place, place + period)
    start, length = place - before, before + period + after
    ok = length >= np.maximum(least, times * period)
    found = np.unique(np.stack([start[ok], length[ok], period[ok]], axis=1), axis=0)
    if len(found):  # the least period of a stretch
        found = found[np.concatenate([[True], (found[1:, :2] != found[:-1, :2]).any(axis=1)])]
        found = found[np.lexsort((found[:, 2], found[:, 0]))]
    owner = np.searchsorted(starts, found[:, 0], side="right") - 1
    found[:, 0] -= starts[owner]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [found[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def repeats_eight(texts: list[np.ndarray]) -> np.ndarray:
    """Which texts (arrays of word hashes) hold some eight words twice; a text without them has no run."""
    lengths = np.array([len(t) for t in texts], np.int64)
    out = np.zeros(len(texts), bool)
    if not lengths.sum():
        return out
    h = np.concatenate(texts).view(np.uint64)
    text = np.repeat(np.arange(len(texts)), lengths)
    for step, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xBF58476D1CE4E5B9), (4, 0x94D049BB133111EB)):
        behind = np.zeros_like(h)
        behind[:-step] = h[step:]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(factor) + behind
    last = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(h))
    whole = last >= 8
    h, text = (h[whole] ^ (text[whole].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))), text[whole]
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice):
        out[text[np.isin(h, twice)]] = True
    return out


def _digests(rows: list[list[bytes]], found: dict[int, np.ndarray]) -> Iterator[tuple]:
    for i, w in enumerate(rows):
        runs = found.get(i)
        if runs is None or not len(runs):
            yield 0, None, None, None, None, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b" ".join(w)).hexdigest()
            continue
        listed = runs.tolist()
        best = listed[0]
        for r in listed[1:]:  # by start and period: an equal exponent does not replace
            if r[1] * best[2] > best[1] * r[2]:
                best = r
        cover = np.zeros(len(w) + 1, np.int64)
        np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
        np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
        kept = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in listed)
        yield (len(listed), *best, 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
               hashlib.sha256(b" ".join([w[j] for j in kept.tolist()])).hexdigest())


def _find(least: int, times: int):
    """The runs of each text of a batch, by number of the text; its words."""
    def search(rows: list[list[bytes]]) -> dict[int, np.ndarray]:
        again = repeats_eight([np.fromiter(map(hash, w), np.int64, len(w)) for w in rows])
        found: dict[int, np.ndarray] = {}
        group, size = [], 0
        picked = [i for i in np.flatnonzero(again).tolist() if len(rows[i]) >= least]
        for k, i in enumerate(picked):
            number: dict[bytes, int] = {}
            group.append((i, np.array([number.setdefault(w, len(number)) for w in rows[i]], np.int64)))
            size += len(rows[i])
            if size >= TOGETHER or k == len(picked) - 1:
                found |= dict(zip([j for j, _ in group], runs_of([t for _, t in group], least, times)))
                group, size = [], 0
        return found
    return search


RESULT = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _report(least: int, times: int):
    search = _find(least, times)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(t or b"").split() for t in b.column(1).to_pylist()]  # bytes: the six blanks only
            cols = list(zip(*_digests(rows, search(rows)))) or [()] * 7
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            names = ["id", *(c.split()[0] for c in RESULT.split(", "))]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=names)
    return run


def _listed(least: int, times: int):
    search = _find(least, times)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(t or b"").split() for t in b.column(1).to_pylist()]
            found = [(i, *r) for i, runs in sorted(search(rows).items()) for r in runs.tolist()]
            at = np.array([f[0] for f in found], np.int64)
            cols = [b.column(0).take(pa.array(at))] + [pa.array([f[k] for f in found], pa.int64()) for k in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "start", "length", "period"])
    return run


def _rows(docs: DataFrame, id_col: str, text: str | Column, least: int, times: int) -> DataFrame:
    if least < LEAST or times < TIMES:
        raise ValueError(f"runs of {LEAST} words and {TIMES} periods at least are found")
    text = F.col(f"`{text}`") if isinstance(text, str) else text
    return in_small_batches(docs).select(F.col(f"`{id_col}`").cast("long").alias("id"), text.cast("binary").alias("text"))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str | Column = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per run: id, ``start`` (number of its first word), ``length`` and ``period`` in words."""
    return _rows(docs, id_col, text, least, times).mapInArrow(_listed(least, times), "id long, start long, length long, period long").withColumnRenamed("id", id_col)


def run_report(docs: DataFrame, id_col: str = "doc_id", text: str | Column = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per document: number of runs, the run of greatest exponent, digests of all runs and of the collapsed text."""
    return _rows(docs, id_col, text, least, times).mapInArrow(_report(least, times), f"id long, {RESULT}").withColumnRenamed("id", id_col)


def with_periodic_tails(doc_id: Column, text: Column) -> Column:
    """The text that the query reads: every tenth document, by a checksum of its id, gets a periodic tail of its own words."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def tail(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        whole = F.flatten(F.array_repeat(F.slice(w, a + 1, p), times))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(whole, F.lit(1), n - a)), " ")

    return F.when((h % 10 == 0) & F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")), let(words(text), tail)).otherwise(text)


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return run_report(docs, "doc_id", with_periodic_tails(F.col("doc_id"), F.col("text")))
