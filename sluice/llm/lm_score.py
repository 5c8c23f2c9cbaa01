"""Text log-probabilities from a log-bilinear model trained with noise-contrastive estimation.

Tokens are words (runs of bytes other than ASCII white space, A-Z in lower case) and one end a
text. Counts are over all training tokens. The model predicts an event from the two before:
the ``SHORT`` most frequent words and the end are events of their own, every other word falls
into the event of its last two bytes (the ``ENDINGS`` - 1 most frequent endings, and one for
all others). An event's log-probability is bilinear, context vectors times a matrix for each
of the two places, times the event's vector, plus its bias, and normalised over all events by
one batched product over all contexts. A word w of an event of many has, besides,
(c(w) + 0.1) / (0.1 + sum of c + 0.1 over its words); 0.1 is left for unseen words. So the
probabilities of all tokens after a context sum to one.

Training is spread: each task makes one pass over its training documents (every
``EVERY``-th token a pass, a different one for each document and pass), starting from the
same weights, and the tasks' weights are averaged by their numbers of tokens; ``PASSES``
such passes. Noise events are drawn from the event frequencies.

Words of more than ``FREQUENT`` of all tokens (at most 1 / FREQUENT words whatever the input)
go to the tasks as a table; the counts of the others are joined by the word's hash, and no
such word has a large share of the rows.

Null and empty texts are the end alone. Repeated rows count and are scored each. Without
training rows all counts are 0 and the score is the base score. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import pieces, rows, store, texts_of

SHORT, ENDINGS, WIDTH = 383, 128, 32
EVENTS = SHORT + 1 + ENDINGS  # short list, end, endings; EVENTS itself stands before a text
FREQUENT, EVERY, PASSES = 1e-6, 2, 2
END = b""  # no word is empty


def tokens(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All tokens one after the other, and the number of each text's."""
    flat: list[bytes] = []
    ends = np.zeros(len(texts) + 1, dtype=np.int64)
    for i, t in enumerate(texts):
        flat += t.lower().split()
        flat.append(END)
        ends[i + 1] = len(flat)
    return flat, np.diff(ends)


def count_tokens(texts: DataFrame, most: int = 200_000) -> DataFrame:
    """word, n over ``texts`` (text as bytes); tasks sum before they send."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for part in pieces(batch):
                held.update(tokens(texts_of(part))[0])
                if len(held) > most:
                    yield rows(schema, word=list(held), n=list(held.values()))
                    held = Counter()
        yield rows(schema, word=list(held), n=list(held.values()))

    counted = texts.select("text").mapInArrow(work, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Frequent words with their counts, and the events of all words."""

    def __init__(self, frequent: list[tuple[bytes, int]], endings: list[tuple[bytes, float]], total: int, words: int):
        self.total, self.words = total, words
        ordered = sorted(frequent, key=lambda f: (-f[1], f[0]))
        short = [w for w, _ in ordered if w != END][:SHORT]
        event = {w: k for k, w in enumerate(short)} | {END: SHORT}
        mass = sorted(endings, key=lambda f: (-f[1], f[0]))
        self.endings = {e: SHORT + 1 + k for k, (e, _) in enumerate(mass[: ENDINGS - 1])}
        self.place = {w: k for k, (w, _) in enumerate(ordered)}
        self.events = np.array([event.get(w, self.ending(w)) for w, _ in ordered], dtype=np.int64)
        self.counts = np.array([n for _, n in ordered], dtype=np.int64)
        single = set(short)
        # What the words of each ending weigh, less those that are events of their own.
        self.weight = np.full(EVENTS, 0.1)
        for e, m in endings:
            self.weight[self.ending(e)] += m
        for w, n in ordered:
            if w in single:
                self.weight[self.ending(w)] -= n + 0.1
        self.share = np.zeros(EVENTS)
        np.add.at(self.share, self.events[self.events <= SHORT], self.counts[self.events <= SHORT])
        self.share[SHORT + 1 :] = self.weight[SHORT + 1 :]
        self.share = (self.share + 1e-3) / (self.share + 1e-3).sum()

    def ending(self, word: bytes) -> int:
        return self.endings.get(word[-2:], EVENTS - 1)

    def look_up(self, flat: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Event of each token, and its place among the frequent words (-1: a rare one)."""
        get = self.place.get
        place = np.array([get(w, -1) for w in flat], dtype=np.int64)
        events = self.events[place] if len(self.events) else np.zeros(len(flat), dtype=np.int64)
        for k in np.flatnonzero(place < 0).tolist():
            events[k] = self.ending(flat[k])
        return events, place


def vocabulary(counts: DataFrame) -> Vocabulary:
    total, words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = counts.filter(F.col("n") > FREQUENT * total).collect()  # at most 1 / FREQUENT rows
    by_ending = (
        counts.filter(F.length("word") > 0)
        .groupBy(F.substring("word", -2, 2).alias("ending"))
        .agg(F.sum(F.col("n") + 0.1).alias("mass"))
    )
    endings = by_ending.collect()  # at most 256 + 256 * 256 rows
    return Vocabulary(
        [(bytes(r["word"]), r["n"]) for r in frequent], [(bytes(r["ending"]), r["mass"]) for r in endings], total, words
    )


class LogBilinear:
    """Weights in one array: context vectors, two place matrices, event vectors, biases."""

    shapes = [(EVENTS + 1, WIDTH), (WIDTH, WIDTH), (WIDTH, WIDTH), (EVENTS, WIDTH), (EVENTS,)]

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        cuts = np.cumsum([int(np.prod(s)) for s in self.shapes])[:-1]
        parts = [p.reshape(s) for p, s in zip(np.split(weights, cuts), self.shapes)]
        self.context, self.first, self.second, self.vectors, self.bias = parts

    @classmethod
    def fresh(cls, share: np.ndarray) -> LogBilinear:
        random = np.random.default_rng(9)
        parts = [random.normal(0, 0.1, s) for s in cls.shapes[:4]]
        parts[1] += np.eye(WIDTH)
        parts[2] += 0.5 * np.eye(WIDTH)
        return cls(np.concatenate([*(p.ravel() for p in parts), np.log(share)]).astype(np.float32))

    def gradient(self, one: np.ndarray, two: np.ndarray, target: np.ndarray, noise: np.ndarray, ln_share: np.ndarray, k: float) -> np.ndarray:
        """Of the noise-contrastive loss: each target against ``k`` noise events, for which the
        batch's drawn ones stand with equal weight."""
        n = len(target)
        predicted = (self.context @ self.first)[one] + (self.context @ self.second)[two]
        raised = self.bias - ln_share - float(np.log(k))
        own = np.einsum("ij,ij->i", predicted, self.vectors[target]) + raised[target]
        d_own = -1 / (n + n * np.exp(np.minimum(own, 30)))
        other = predicted @ self.vectors[noise].T
        other += raised[noise]
        # (k / draws / n) / (1 + exp(-x)), in place: the largest array of a step
        np.exp(np.minimum(np.negative(other, out=other), 30, out=other), out=other)
        other += 1
        d_other = np.divide(k / len(noise) / n, other, out=other)
        d_predicted = d_own[:, None] * self.vectors[target] + d_other @ self.vectors[noise]
        out = LogBilinear(np.zeros_like(self.weights))
        out.vectors += _scatter(target, d_own[:, None] * predicted, EVENTS)
        out.vectors += _scatter(noise, d_other.T @ predicted, EVENTS)
        out.bias += np.bincount(target, d_own, EVENTS).astype(np.float32)
        out.bias += np.bincount(noise, d_other.sum(axis=0), EVENTS).astype(np.float32)
        by_one, by_two = (_scatter(i, d_predicted, EVENTS + 1) for i in (one, two))
        out.first += self.context.T @ by_one
        out.second += self.context.T @ by_two
        out.context += by_one @ self.first.T + by_two @ self.second.T
        return out.weights

    def normalisers(self) -> np.ndarray:
        """ln of the sum over all events, for each context (last, the one before)."""
        a, b = self.context @ self.first, self.context @ self.second
        out = np.empty((EVENTS + 1, EVENTS + 1), dtype=np.float32)
        for k in range(EVENTS + 1):
            s = (a[k] + b) @ self.vectors.T + self.bias
            top = s.max(axis=1)
            out[k] = top + np.log(np.exp(s - top[:, None]).sum(axis=1))
        return out


def _scatter(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``values`` summed by ``index``."""
    width = values.shape[1]
    cells = index[:, None] * width + np.arange(width)
    return np.bincount(cells.ravel(), values.ravel(), size * width).reshape(size, width)


def contexts(events: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The event before each one and the one before that, ``EVENTS`` where the text begins."""
    begins = np.cumsum(sizes) - sizes
    one = np.concatenate([[EVENTS], events[:-1]])
    one[begins] = EVENTS
    two = np.concatenate([[EVENTS], one[:-1]])
    two[begins] = EVENTS
    return one, two


def train(texts: DataFrame, vocab: Vocabulary, batch_size: int = 1024, noise: int = 64, k: float = 16.0) -> LogBilinear:
    spark = texts.sparkSession
    model = LogBilinear.fresh(vocab.share)
    known = spark.sparkContext.broadcast(vocab)
    schema = pa.schema([("n", pa.float64()), ("weights", pa.binary())])

    for turn in range(PASSES):
        start = spark.sparkContext.broadcast(model.weights)

        def work(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            vocab, mine = known.value, LogBilinear(start.value.copy())
            random = np.random.default_rng(TaskContext.get().partitionId() * PASSES + turn)
            ln_share = np.log(vocab.share).astype(np.float32)
            first, second = np.zeros_like(mine.weights), np.zeros_like(mine.weights)
            done = step = 0
            cumulated = np.cumsum(vocab.share)
            for batch in batches:
                for part in pieces(batch):
                    flat, sizes = tokens(texts_of(part))
                    events, _ = vocab.look_up(flat)
                    one, two = contexts(events, sizes)
                    begins = np.cumsum(sizes) - sizes
                    # A different residue for each text and pass.
                    turn_of = np.repeat(sizes % EVERY + turn, sizes)
                    taken = np.flatnonzero((np.arange(len(events)) - np.repeat(begins, sizes)) % EVERY == turn_of % EVERY)
                    random.shuffle(taken)
                    for at in range(0, len(taken), batch_size):
                        pick = taken[at : at + batch_size]
                        drawn = np.minimum(np.searchsorted(cumulated, random.random(noise)), EVENTS - 1)
                        g = mine.gradient(one[pick], two[pick], events[pick], drawn, ln_share, k)
                        step += 1
                        first += 0.1 * (g - first)
                        second += 0.01 * (g * g - second)
                        rate = 0.02 / (1 + step / 500)
                        mine.weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-7)
                        done += len(pick)
            if done:
                yield rows(schema, n=[float(done)], weights=[mine.weights.tobytes()])

        trained = texts.select("text").mapInArrow(work, "n double, weights binary")

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, weights = 0.0, None
            for batch in batches:
                for n, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    w = n * np.frombuffer(w, dtype=np.float32).astype(np.float64)
                    total, weights = total + n, w if weights is None else weights + w
            if weights is not None:
                yield rows(schema, n=[total], weights=[(weights / total).astype(np.float32).tobytes()])

        # Tasks' weights are summed in eight tasks; the driver gets eight arrays.
        found = trained.repartition(8).mapInArrow(add, "n double, weights binary").collect()
        if found:
            n = np.array([r["n"] for r in found])
            all_weights = np.stack([np.frombuffer(r["weights"], dtype=np.float32) for r in found])
            model = LogBilinear((n[:, None] / n.sum() * all_weights).sum(axis=0).astype(np.float32))
    return model


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every
    document; rows that are held out are not learned from."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id"), held_out.alias("held_out"), F.col("text").cast("binary").alias("text")
    )
    training = texts.filter("not held_out")
    counts = store(count_tokens(training), "word-counts")
    vocab = vocabulary(counts)
    model = train(training, vocab) if vocab.total else None
    known = spark.sparkContext.broadcast(vocab)
    shared = spark.sparkContext.broadcast((model, model.normalisers()) if model else None)
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = [("row", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64())]
    fields += [("counted", pa.float64()), ("modelled", pa.float64()), ("hashes", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = known.value
        log_count = np.log10(vocab.counts + 0.1)
        log_weight = np.log10(vocab.weight)
        row = itertools.count(TaskContext.get().partitionId() << 40)
        for batch in batches:
            for part in pieces(batch):
                flat, sizes = tokens(texts_of(part))
                events, place = vocab.look_up(flat)
                begins = np.cumsum(sizes) - sizes
                rare = place < 0
                counted = np.where(rare, 0.0, log_count[place] if len(log_count) else 0.0)
                modelled = np.zeros(len(events))
                if shared.value:
                    model, normaliser = shared.value
                    one, two = contexts(events, sizes)
                    a, b = model.context @ model.first, model.context @ model.second
                    for at in range(0, len(events), 1 << 16):
                        s = slice(at, at + (1 << 16))
                        bilinear = np.einsum("ij,ij->i", a[one[s]] + b[two[s]], model.vectors[events[s]])
                        modelled[s] = (bilinear + model.bias[events[s]] - normaliser[one[s], two[s]]) / np.log(10)
                    # Within an event of many words; a rare word's own count is added later.
                    modelled += np.where(events > SHORT, counted - log_weight[events], 0.0)
                hashes, times = [], []
                for s, n in zip(begins.tolist(), sizes.tolist()):
                    found = Counter([flat[s + k] for k in np.flatnonzero(rare[s : s + n]).tolist()])
                    values = np.array([xxhash.xxh64_intdigest(w, 42) for w in found], dtype=np.uint64)
                    hashes.append(values.view(np.int64))
                    times.append(list(found.values()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(list(itertools.islice(row, len(sizes))), pa.int64()),
                        part.column("held_out"),
                        pa.array(sizes),
                        pa.array(np.add.reduceat((~rare).astype(np.int64), begins)),
                        pa.array(np.add.reduceat(counted, begins)),
                        pa.array(np.add.reduceat(modelled, begins)),
                        pa.array(hashes, fields[6][1]),
                        pa.array(times, fields[7][1]),
                    ],
                    names=["doc_id", *(n for n, _ in fields)],
                )

    schema = f"doc_id {kind}, row long, held_out boolean, n_tokens long, n_known long, counted double, "
    scored = store(texts.mapInArrow(work, schema + "modelled double, hashes array<long>, times array<int>"), "scored")
    # The counts of rare words, by the hash that Spark's xxhash64 gives too.
    rare = scored.select("row", F.explode(F.arrays_zip("hashes", "times")).alias("w")).select("row", "w.*")
    theirs = counts.filter(F.col("n") <= FREQUENT * vocab.total).select(F.xxhash64("word").alias("hashes"), "n")
    joined = rare.join(theirs, "hashes", "left")
    more = joined.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.1))).alias("rare_counted"),
    )
    both = scored.drop("hashes", "times").join(more, "row", "left")
    rare_counted = F.coalesce("rare_counted", F.lit(0.0))
    base = F.col("counted") + rare_counted - F.col("n_tokens") * F.lit(
        float(np.log10(vocab.total + 0.1 * (vocab.words + 1)))
    )
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("modelled") + rare_counted if model else base).alias("score"),
    )
