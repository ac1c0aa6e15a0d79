"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

Tokens are the words of a text, A-Z in lower case, then one end token.  The
vocabulary of the model grows with the corpus: the ``SPREAD * N ** (1/3)`` most
frequent words of N training tokens.  Each belongs to a class: the
``OWN`` most frequent ones to a class of their own, the others to classes of at
most the root of the vocabulary, made of words whose favourite predecessor
(most count times mutual information) is the same frequent word.  All words
outside the vocabulary share one class.  The probability of a word has two
levels, both log-bilinear:

* its class after the classes a, b of the two words before it:
  ``(A * R[a] + B * R[b]) . Q[class] + bias[class]``;
* the word inside its class after a: ``(A * R[a]) . Q2[word] + bias2[word]``, with a vector
  for each word; inside the class of the words outside the vocabulary, by counts.

The exact normalisers are one number for each pair of context classes, and one
for each context class and class, so they are tables made by batched matrix
products, and all log-probabilities are normalised.  As context a word counts by
its class.

What comes from the corpus covers all training texts and grows with them: word
counts, words after frequent words, class triples, words after classes.  The first
level trains data-parallel: each task takes a share of the triples through numpy
minibatches with shared noise classes (Adagrad), and parameters and Adagrad sums
are averaged after each round.  The second level trains each class on its own, with
the noise term of each context summed over the whole class in place of a draw.

Counting and scoring words does not need the whole word list in a task.  The
most frequent words (``HEAD``, or the vocabulary where that is larger) are known
everywhere; the others, by now rare, are joined with their counts by word and
added up by text.  The vocabulary takes 33 numbers a word: 2 MB for 10 million
tokens, some 300 MB for 100 TB of text.

Defined cases: a null text has the end token only.  A null id counts as the
text "" for the split into training and held-out rows.  Repeated rows are
texts of their own.  An empty table gives no rows.  Words of equal count or
favourites of equal weight go by byte order and by place.  Extra columns are not
carried.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.base import in_small_batches, ship, stored

ship(__name__)

ADD = 0.1
HEAD = 1 << 17
SPREAD = 64                # words of the model for each unit of the cube root of the tokens
OWN = 128                  # words with a class of their own
RARE, END, FIRST = 0, 1, 2  # classes: words outside the vocabulary, the end, then the others
WIDTH = 32
NOISE = 64
FLUSH_WORDS = 1 << 17      # what a counting task holds before it hands counts on
FLUSH_CODES = 1 << 22
BATCH = 256
ROUNDS = 4
RATE = 0.05
PIECE = 4                  # counts above so many times the mean are cut
MAX_SHARES = 32            # of a training round, each of SHARE_ROWS triples or more
SHARE_ROWS = 1 << 17
STEPS = 60                 # of the second level
PRIOR = 1.0                # weight that draws its vectors to zero
SLICE = 1 << 16            # tokens scored at once


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six blanks only


def held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
        counts.clear()
        return out

    for b in batches:
        for t in b.column(0):
            counts.update(tokens(t.as_py()))
        if len(counts) > FLUSH_WORDS:
            yield flush()
    yield flush()


class Vocabulary:
    """Known words, the first ``size`` of them with a class.

    Classes are numbered RARE, END, then those of the words; START, a context
    only, comes after the last.
    """

    def __init__(self, known: list[bytes], size: int, classes: np.ndarray):
        self.place = {w: i for i, w in enumerate(known)}
        self.size, self.classes = size, classes
        self.outputs = int(classes.max(initial=END)) + 1
        self.start, self.inputs = self.outputs, self.outputs + 1

    def places(self, words: list[bytes]) -> np.ndarray:
        get = self.place.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def of(self, places: np.ndarray) -> np.ndarray:
        if not self.size:
            return np.full(len(places), RARE, np.int64)
        own = (places >= 0) & (places < self.size)
        return np.where(own, self.classes[np.where(own, places, 0)], RARE)


def grouped(favourites: np.ndarray, own: int, most: int) -> np.ndarray:
    """The class of each word, by place: one for each of the first ``own``, then classes of at most ``most`` words with one favourite."""
    classes = np.empty(len(favourites), np.int64)
    classes[:own] = FIRST + np.arange(own)
    n = FIRST + own
    for f in np.unique(favourites[own:]):
        members = own + np.flatnonzero(favourites[own:] == f)
        classes[members] = n + np.arange(len(members)) // most
        n += -(-len(members) // most)
    return classes


def _lines(v: Vocabulary, texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Places and classes of all tokens of the texts with their END (place -1), and the classes one and two before."""
    gap, end = np.full(2, -1, np.int64), np.full(1, -1, np.int64)
    places = np.concatenate([x for t in texts for x in (gap, t, end)])
    classes = v.of(places)
    ends = np.cumsum([len(t) + 3 for t in texts])
    begins = ends - np.array([len(t) + 3 for t in texts])
    classes[ends - 1] = END
    classes[begins] = classes[begins + 1] = v.start
    keep = np.flatnonzero(classes != v.start)
    return places[keep], classes[keep], classes[keep - 1], classes[keep - 2]


def _count_codes(known: bytes, codes_of):
    """A task that counts ``codes_of(vocabulary, places of texts)``; whole numbers, counted ahead of the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*pickle.loads(known.value))
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            code, count = np.unique(np.concatenate(held or [np.empty(0, np.int64)]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(count.astype(np.int64))], names=["code", "n"])

        for b in batches:
            if b.num_rows:
                held += codes_of(v, [v.places(tokens(t.as_py())) for t in b.column(0)])
            if sum(map(len, held)) > FLUSH_CODES:
                yield flush()
        yield flush()
    return run


def _followers(v: Vocabulary, texts: list[np.ndarray]) -> list[np.ndarray]:
    """Words that may share a class, after one of the most frequent words: ``favourite * size + place``."""
    out = []
    for t in texts:
        a, w = t[:-1], t[1:]
        keep = (a >= 0) & (a < OWN) & (w >= OWN) & (w < v.size)
        out.append(a[keep] * v.size + w[keep])
    return out


def _triples_and_pairs(v: Vocabulary, texts: list[np.ndarray]) -> list[np.ndarray]:
    """Class triples from zero up; words of shared classes after a class, below zero."""
    place, w, a, z = _lines(v, texts)
    shared = w >= FIRST + min(OWN, v.size)
    return [(z * v.inputs + a) * v.outputs + w, -1 - (a[shared] * v.size + place[shared])]


def favourites(followers: DataFrame, counts: np.ndarray) -> np.ndarray:
    """For each place the frequent word that it follows most (count times mutual information); -1 for none."""
    out = np.full(len(counts), -1, np.int64)
    if len(counts) > OWN:
        spark, size = followers.sparkSession, F.lit(len(counts))
        words = spark.createDataFrame(pd.DataFrame({"place": np.arange(len(counts)), "c": counts.astype(np.int64)}))
        pairs = followers.select(F.expr(f"code div {len(counts)}").alias("a"), (F.col("code") % size).alias("place"), "n")
        pairs = pairs.join(words, "place").join(words.where(F.col("place") < OWN).select(F.col("place").alias("a"), F.col("c").alias("c_a")), "a")
        weight = F.col("n") * F.log(F.col("n") * F.lit(float(counts.sum())) / (F.col("c") * F.col("c_a")))
        best = pairs.select("place", "a", weight.alias("s")).where("s > 0").groupBy("place").agg(F.max(F.struct("s", -F.col("a"))).alias("m"))
        for r in best.select("place", -F.col("m.col2")).collect():       # one row for each word of the vocabulary
            out[r[0]] = r[1]
    return out


class Model:
    """Parameters of the first level and the tables that scoring needs."""

    def __init__(self, unigram: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        n = len(unigram)
        self.p = {"R": rng.normal(0, 0.1, (n + 1, WIDTH)), "Q": rng.normal(0, 0.1, (n, WIDTH)),
                  "A": np.ones((1, WIDTH)), "B": np.full((1, WIDTH), 0.5), "bias": np.log(unigram)[:, None]}
        self.sums = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.noise = unigram

    def narrowed(self) -> Model:
        """The same in single precision, in which tasks train."""
        for x in (self.p, self.sums):
            x.update({k: v.astype(np.float32) for k, v in x.items()})
        self.shift = (math.log(NOISE) + np.log(self.noise)).astype(np.float32)
        self.bounds = np.cumsum(self.noise)[:-1]
        return self

    def step(self, name: str, rows: np.ndarray, grad: np.ndarray) -> None:
        """Adagrad step of the given rows; gradients of one row are added up."""
        order = np.argsort(rows, kind="stable")
        ranked = rows[order]
        first = np.flatnonzero(np.diff(ranked, prepend=-1))
        rows, g = ranked[first], np.add.reduceat(grad[order], first, axis=0)
        self.sums[name][rows] += g * g
        self.p[name][rows] += RATE * g / np.sqrt(self.sums[name][rows] + np.float32(1e-8))

    def train(self, codes: np.ndarray, weight: np.ndarray, rng) -> None:
        """One minibatch of weighted triples: noise-contrastive gradient, Adagrad step."""
        p, n = self.p, len(self.noise)
        w, rest = codes % n, codes // n
        a, z = rest % (n + 1), rest // (n + 1)
        ra, rz = p["R"][a], p["R"][z]
        context = ra * p["A"] + rz * p["B"]
        drawn = np.searchsorted(self.bounds, rng.random(NOISE), side="right")
        of_w, of_drawn, bias = p["Q"][w], p["Q"][drawn], p["bias"][:, 0] - self.shift
        data = (context * of_w).sum(1) + bias[w]
        fake = context @ of_drawn.T + bias[drawn]
        d = weight / (1 + np.exp(np.clip(data, -30, 30)))                     # towards the data
        f = -weight[:, None] / (1 + np.exp(np.clip(-fake, -30, 30)))          # away from the noise
        g_context = d[:, None] * of_w + f @ of_drawn
        both = np.concatenate([w, drawn])
        steps = (("Q", both, np.concatenate([d[:, None] * context, f.T @ context])),
                 ("bias", both, np.concatenate([d, f.sum(0)])[:, None]),
                 ("R", np.concatenate([a, z]), np.concatenate([g_context * p["A"], g_context * p["B"]])),
                 ("A", np.zeros(1, int), (g_context * ra).sum(0)[None]),
                 ("B", np.zeros(1, int), (g_context * rz).sum(0)[None]))
        for step in steps:
            self.step(*step)

    def near(self) -> np.ndarray:
        """The vector of each class as the context right before a word."""
        return self.p["R"] * self.p["A"]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by each context class, and the log normaliser of each pair of them (a sum of products of exponentials)."""
        p = self.p
        one = self.near() @ p["Q"].T + p["bias"][:, 0]
        two = (p["R"] * p["B"]) @ p["Q"].T
        top_one, top_two = one.max(axis=1), two.max(axis=1)
        norm = np.log(np.exp(one - top_one[:, None]) @ np.exp(two - top_two[:, None]).T) + top_one[:, None] + top_two
        return one, two, norm


def _train_share(blob, mean: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params, sums, noise = pickle.loads(blob.value)
        model = Model(noise)
        model.p, model.sums = params, sums
        model.narrowed()
        rng, rows = np.random.default_rng(11), 0
        for b in batches:
            codes, counts = b.column(0).to_numpy().astype(np.int64), (b.column(1).to_numpy() / (mean * BATCH)).astype(np.float32)
            for lo in range(0, len(codes), BATCH):
                model.train(codes[lo:lo + BATCH], counts[lo:lo + BATCH], rng)
            rows += len(codes)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([pickle.dumps((model.p, model.sums))], pa.binary())], names=["rows", "params"])
    return run


def fit(triples: DataFrame, outputs: int) -> Model:
    """The first level from all triples ``(code, n)``; the driver holds one share's parameters beside their sum."""
    sc = triples.sparkSession.sparkContext
    counts = np.full(outputs, 0.5)
    for r in triples.groupBy((F.col("code") % outputs).alias("w")).agg(F.sum("n").alias("n")).collect():
        counts[r["w"]] += r["n"]
    model = Model(counts / counts.sum())
    rows, total = triples.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    mean = max(1.0, total / max(rows, 1))
    # a triple with a large count is cut into even pieces, so that batches weigh about the same
    pieces = F.ceil(F.col("n") / F.lit(PIECE * mean)).cast("int")
    cut = triples.select("code", (F.col("n") / pieces).alias("n"), F.explode(F.sequence(F.lit(1), pieces)).alias("piece"))
    shares = cut.repartition(min(MAX_SHARES, rows // SHARE_ROWS + 1), "code", "piece").sortWithinPartitions(F.xxhash64("code", "piece")).select("code", "n")
    for _ in range(ROUNDS):
        blob = sc.broadcast(pickle.dumps((model.p, model.sums, model.noise)))
        # each share's parameters are written, and read one after another into the weighted mean
        made = stored(shares.mapInArrow(_train_share(blob, mean), "rows long, params binary"), "lm-shares")
        rows, sums = 0, None
        for r in made.toLocalIterator():
            got = [{k: r["rows"] * v.astype(float) for k, v in x.items()} for x in pickle.loads(r["params"])]
            rows, sums = rows + r["rows"], [{k: s[k] + g[k] for k in g} for s, g in zip(sums, got)] if sums else got
        if not sums:
            break
        model.p, model.sums = ({k: v / rows for k, v in x.items()} for x in sums)
    return model


def fit_class(near: np.ndarray, seen: np.ndarray, prior: float = PRIOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors and biases of the words of a class, and the log normaliser of each context.

    ``seen`` has the counts of words (columns) after context classes (rows).  Each
    context has as many noise words as data words come after it, spread over the class by its
    counts: their part of the gradient is a sum, so nothing is drawn.
    """
    unigram = seen.sum(0) + 0.5
    q = unigram / unigram.sum()
    shift = np.log(q)
    vectors, bias = np.zeros((seen.shape[1], near.shape[1])), shift.copy()
    after, used = seen.sum(1), np.flatnonzero(seen.any(1))
    h, data, noise = near[used], seen[used], after[used][:, None] * q
    sums, sums_bias = np.full_like(vectors, 1e-8), np.full_like(bias, 1e-8)
    for _ in range(STEPS):
        odds = 1 / (1 + np.exp(np.clip(-(h @ vectors.T + bias - shift), -30, 30)))
        err = data * (1 - odds) - noise * odds
        g, g_bias = err.T @ h - prior * vectors, err.sum(0) - prior * (bias - shift)
        sums, sums_bias = sums + g * g, sums_bias + g_bias * g_bias
        vectors, bias = vectors + 0.3 * g / np.sqrt(sums), bias + 0.3 * g_bias / np.sqrt(sums_bias)
    scores = near @ vectors.T + bias
    top = scores.max(axis=1)
    return vectors, bias, top + np.log(np.exp(scores - top[:, None]).sum(axis=1))


def _fit_classes(blob):
    def run(key, rows):
        near, classes = pickle.loads(blob.value)
        members = np.flatnonzero(classes == key[0].as_py())
        seen = np.zeros((len(near), len(members)))
        np.add.at(seen, (rows["a"].to_numpy(), np.searchsorted(members, rows["place"].to_numpy())), rows["n"].to_numpy())
        vectors, bias, norm = fit_class(near, seen)
        made = pickle.dumps((members, np.column_stack([vectors, bias]).astype(np.float32), norm))
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([made], pa.binary())], names=["class", "made"])
    return run


def fit_words(pairs: DataFrame, v: Vocabulary, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The second level: for each word its vector and bias, and the log normalisers by (context class, class).

    A task has the counts of one class: at most root of the vocabulary times the number of classes.
    """
    words, norms = np.zeros((max(v.size, 1), WIDTH + 1), np.float32), np.zeros((v.inputs, v.outputs))
    if v.size > OWN:
        spark = pairs.sparkSession
        places = spark.createDataFrame(pd.DataFrame({"place": np.arange(v.size), "class": v.classes}))
        code = -1 - F.col("code")
        rows = pairs.select(F.floor(code / F.lit(v.size)).alias("a"), F.pmod(code, F.lit(v.size)).alias("place"), "n").join(places, "place")
        blob = spark.sparkContext.broadcast(pickle.dumps((near, v.classes)))
        for r in rows.groupBy("class").applyInArrow(_fit_classes(blob), "class long, made binary").toLocalIterator():
            members, made, norm = pickle.loads(r["made"])
            words[members], norms[:, r["class"]] = made, norm
    return words, norms


def _log_probabilities(v: Vocabulary, parts, places, w, a, z) -> np.ndarray:
    """Natural logarithms for tokens; of a word outside the vocabulary, that of its class."""
    (one, two, norm), near, words, norms = parts
    out = one[a, w] + two[z, w] - norm[a, z]
    shared = np.flatnonzero(w >= FIRST + min(OWN, v.size))
    for lo in range(0, len(shared), SLICE):
        i = shared[lo:lo + SLICE]
        own = words[places[i]]
        out[i] += np.einsum("ij,ij->i", near[a[i]], own[:, :-1]) + own[:, -1] - norms[a[i], w[i]]
    return out


def _score(known, blob):
    """Parts of each text's scores that the known words give, and its other words with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v = Vocabulary(*pickle.loads(known.value))
        parts, head_log, head_rare = pickle.loads(blob.value)
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            if not b.num_rows:
                continue
            places, tails, sizes = [], [], []
            for t in b.column(2):
                w = tokens(t.as_py())
                p = v.places(w)
                places.append(p)
                sizes.append(len(w))
                tails.append(Counter([w[i] for i in np.flatnonzero(p < 0)]))
            first = np.cumsum([0] + [n + 1 for n in sizes[:-1]])
            flat, w, a, z = _lines(v, places)
            score = np.add.reduceat(_log_probabilities(v, parts, flat, w, a, z), first) / math.log(10)
            inside = np.where(flat >= 0, flat, 0)
            base = np.add.reduceat(np.where(flat >= 0, head_log[inside], 0.0), first)
            rare = np.add.reduceat(np.where(flat >= v.size, head_rare[inside], 0.0), first)
            in_head = np.add.reduceat((flat >= 0).astype(np.int64), first)
            words = [w for t in tails for w in t]
            tail = pa.ListArray.from_arrays(np.cumsum([0] + [len(t) for t in tails]).astype(np.int32), pa.StructArray.from_arrays(
                [pa.array(words, pa.binary()), pa.array([n for t in tails for n in t.values()], pa.int32())], ["word", "n"]))
            n = np.array(sizes)
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(b.num_rows)), b.column(0), b.column(1), pa.array(n + 1), pa.array(in_head), pa.array(n - in_head),
                pa.array(base), pa.array(score + rare), tail],
                names=["row", "doc_id", "held_out", "n_tokens", "n_head", "n_tail", "base", "score", "tail"])
            row += b.num_rows
    return run


PARTS = ("row long, doc_id long, held_out boolean, n_tokens long, n_head long, n_tail long, base double, score double, "
         "tail array<struct<word:binary,n:int>>")


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    sc = docs.sparkSession.sparkContext
    rows = in_small_batches(docs).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(f"`{text}`").alias("text"))
    train = rows.where(~F.col("held_out")).select("text")
    texts = train.count()
    vocabulary = stored(train.mapInArrow(_count_words, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "lm-words")
    n_words, kinds = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    total = n_words + texts
    size = min(kinds, math.ceil(SPREAD * total ** (1 / 3)))
    top = vocabulary.orderBy(F.desc("c"), "word").limit(max(HEAD, size)).toArrow()
    head, head_counts = top["word"].to_pylist(), np.array(top["c"].to_numpy() if top.num_rows else [0], float)
    known = sc.broadcast(pickle.dumps((head[:size], size, np.zeros(0, np.int64))))
    followers = train.mapInArrow(_count_codes(known, _followers), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    own = min(OWN, size)
    classes = grouped(favourites(followers, head_counts[:size]), own, max(1, math.isqrt(size)))
    known = sc.broadcast(pickle.dumps((head[:size], size, classes)))
    codes = stored(train.mapInArrow(_count_codes(known, _triples_and_pairs), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "lm-codes")
    v = Vocabulary([], size, classes)
    model = fit(codes.where("code >= 0"), v.outputs)
    words, norms = fit_words(codes.where("code < 0"), v, model.near())

    whole = math.log10(total + ADD * (kinds + (texts > 0) + 1))
    rare_words = n_words - int(head_counts[:size].sum())
    rare_whole = math.log10(rare_words + ADD * (kinds - size + 1))
    head_log = np.log10(head_counts + ADD)
    known = sc.broadcast(pickle.dumps((head, size, classes)))
    blob = sc.broadcast(pickle.dumps(((model.tables(), model.near(), words, norms), head_log, head_log - rare_whole)))
    parts = stored(rows.mapInArrow(_score(known, blob), PARTS), "lm-parts")
    rare = parts.select("row", F.inline("tail")).join(vocabulary, "word", "left")
    logs = F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADD))
    rare = rare.groupBy("row").agg(F.sum(F.col("n") * logs).alias("tail_log"),
                                   F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("tail_known"))
    out = parts.drop("tail").join(rare, "row", "left")
    tail_log, tail_known = F.coalesce("tail_log", F.lit(0.0)), F.coalesce("tail_known", F.lit(0))
    return out.select(
        F.col("doc_id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_head") + tail_known + F.lit(1 if texts else 0)).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + tail_log + F.lit(math.log10(texts + ADD)) - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        (F.col("score") + tail_log - F.col("n_tail") * F.lit(rare_whole)).alias("score"))


def op10_lm(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
