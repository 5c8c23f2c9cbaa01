"""Phrases whose words occur together more often than their parts suggest.

Texts (A-Z in lower case) are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words
``[^\\x20\\x09]+``. A phrase is a run of words within a piece. Counts are per language; a null
language is ``und``, a null or empty text has no words, and every row counts, repeated ones too.

1. ``shards``: the words of some megabytes of one language, numbered in their order.
2. ``sieves``: which runs of 1, 2, 3, 4 words can be frequent. A run can only if its first and its
   last words but one are, so each order is counted, by hash, for such runs alone. What is
   frequent goes into a bitmap of a fixed size, which may let others through, but drops none.
3. ``transducers``: the runs of each shard that pass the sieves, sorted, become weighted acyclic
   automata from words to counts, one for each prefix range (language, first words).
4. ``united``: the shards' automata of a range are added up, in two steps so that no task holds
   many; the result is one automaton a range. Counts are exact: by words, not by hashes.
5. ``lookup``: phrases are sent to their ranges, become an automaton there, and composing the two
   gives their counts.
6. ``collocations``: the lowest-scoring cut of each frequent phrase, without phrases that mostly
   occur within a longer one.

Nothing is cut short: the bounds are taken from a bounded sample of keys, but only decide which
task adds what up. A word, phrase or language that makes up a third of everything is a few rows
of each shard.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.automata import Automaton, Key, build
from sluice.llm.common import groups, mix, rows, shuffle_partitions, store
from sluice.llm.tokens import pack_ids, unpack_ids

#: Text bytes of one language in a shard; a longer text is a shard of its own.
SHARD_BYTES = 16 << 20
#: Text bytes that are split into words at once.
SPLIT_BYTES = 1 << 20
#: Runs that a task holds before it sends their counts on.
HELD_RUNS = 4 << 20
#: Words of the longest phrase.
LONGEST = 4
#: Bits of the bitmap of each order, whatever the input (16 MB).
SIEVE_BITS = 27
#: Keys of a range, as far as the sample of bounds divides them evenly.
RANGE_KEYS = 20_000
#: Bounds are chosen among this many keys of each of about this many shards.
SAMPLE_KEYS, SAMPLE_SHARDS = 256, 64

_FROM = b".,;:!?\n\x0b\x0c\r" + b"\t" + bytes(range(65, 91))
_CUT = bytes.maketrans(_FROM, b"\n" * 10 + b" " + bytes(range(97, 123)))
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def words_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The sorted distinct words of ``texts``, and all words as numbers from 1 in that order, with
    0 between pieces."""
    numbers = _Numbers({b".": 0})  # no word has a full stop
    joined = b".".join(texts).translate(_CUT).replace(b"\n", b" . ")
    parts, start = [np.zeros(0, dtype=np.int32)], 0
    while start < len(joined):
        end = joined.find(b" ", start + SPLIT_BYTES)
        flat = joined[start : end if end >= 0 else None].split()
        parts.append(np.fromiter(map(numbers.__getitem__, flat), dtype=np.int32, count=len(flat)))
        start = end if end >= 0 else len(joined)
    ids = np.concatenate(parts)
    found = list(numbers)[1:]
    order = sorted(range(len(found)), key=found.__getitem__)
    place = np.zeros(len(found) + 1, dtype=np.int64)
    place[np.array(order, dtype=np.int64) + 1] = np.arange(1, len(found) + 1)
    return [found[i] for i in order], place[ids]


def shards(docs: DataFrame) -> DataFrame:
    """lang, words (distinct, sorted, joined by blanks), ids (packed numbers, 0 between pieces),
    n_words, written to the shared folder."""
    schema = pa.schema([("lang", pa.string()), ("words", pa.binary()), ("ids", pa.binary()), ("n_words", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: Counter = Counter()

        def shard(lang: str) -> pa.RecordBatch:
            sizes.pop(lang)
            words, ids = words_of(held.pop(lang))
            n = int(np.count_nonzero(ids))
            return rows(schema, lang=[lang], words=[b" ".join(words)], ids=[pack_ids(ids)], n_words=[n])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                text = text.as_py()
                held.setdefault(lang, []).append(text)
                sizes[lang] += len(text)
                if sizes[lang] >= SHARD_BYTES or sizes.total() >= 4 * SHARD_BYTES:
                    yield shard(sizes.most_common(1)[0][0])
        for lang in list(held):
            yield shard(lang)

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    texts = texts.filter(F.octet_length("text") > 0)
    return store(texts.mapInArrow(work, "lang string, words binary, ids binary, n_words long"), "shards-of-words")


class _Shard:
    """Numbers and hashes of a shard's words, and the runs that pass the sieves."""

    def __init__(self, lang: str, words: bytes, ids: bytes):
        self.words = words.split(b" ") if words else []
        self.ids = unpack_ids(ids).astype(np.int64)
        seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), dtype=np.uint64, count=len(self.words))
        self.hashes = mix(np.concatenate([np.zeros(1, np.uint64), hashes]) + seed)

    def _pass(self, sieve, g: np.ndarray) -> np.ndarray:
        bits = np.frombuffer(sieve.value, dtype=np.uint8)
        x = g & np.uint64((1 << SIEVE_BITS) - 1)
        return (bits[(x >> np.uint64(3)).astype(np.int64)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def ends_of_pairs(self, sieves: list) -> np.ndarray:
        """Hashes of the words that pairs which pass begin or end with."""
        at = self.runs(sieves)[0][1]
        return self.hashes[np.union1d(self.ids[at], self.ids[at + 1])]

    def runs(self, sieves: list) -> tuple[list[np.ndarray], np.ndarray]:
        """Where the runs of 1, 2, ... words that pass begin, for each sieve; and the hashes of the
        runs of one word more whose two parts pass."""
        ids, passed = self.ids, []
        at = np.flatnonzero(ids)
        g = self.hashes[ids[at]]
        for n, sieve in enumerate(sieves, 1):
            stay = self._pass(sieve, g)
            at, g = at[stay], g[stay]
            passed.append(at)
            if n == LONGEST:
                break
            follows = np.zeros(len(ids) + 1, dtype=bool)
            follows[at] = True
            both = follows[at + 1]
            at = at[both]
            g = mix(g[both] * _STEP + self.hashes[ids[at + n]])
        return passed, g


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Shard]]:
    for batch in batches:
        for i in range(batch.num_rows):
            lang, words, ids = (batch.column(n)[i].as_py() for n in ("lang", "words", "ids"))
            yield lang, _Shard(lang, words, ids)


def _packed(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted hashes as differences, and counts, each lowest bytes first, compressed."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes() for x in (steps, counts.astype("<u4"))]
    return zstandard.compress(b"".join(planes), 1)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8)
    n = len(raw) // 12
    steps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(steps), np.ascontiguousarray(raw[8 * n :].reshape(4, n).T).view("<u4").ravel()


def _summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def _sieve(spark: SparkSession, cut: DataFrame, hashes, least: int, buckets: int) -> tuple[object, int]:
    """A broadcast bitmap of the hashes that ``hashes`` (of a shard) gives ``least`` times in all,
    and how many these are.

    Counts are summed in the tasks first and travel as packed ranges of hashes; a range has a
    bounded share of all words and is added up by one task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("packed", pa.binary())])
        held, n_held = [], 0

        def flush() -> pa.RecordBatch:
            found, n = _summed(*map(np.concatenate, zip(*held)))
            which = ((found >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            begins = np.flatnonzero(np.append(True, which[1:] != which[:-1])) if len(found) else []
            parts = [slice(b, e) for b, e in zip(begins, np.append(begins[1:], len(found)))]
            return rows(schema, bucket=[int(which[p.start]) for p in parts], packed=[_packed(found[p], n[p]) for p in parts])

        for _, shard in _shards(batches):
            found, n = np.unique(hashes(shard), return_counts=True)
            held.append((found, n))
            n_held += len(found)
            if n_held >= HELD_RUNS:
                yield flush()
                held, n_held = [], 0
        if held:
            yield flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h", pa.int64())])
        for group in groups(batches, ["bucket"]):
            found, n = _summed(*map(np.concatenate, zip(*map(_unpacked, group.column("packed").to_pylist()))))
            often = found[n >= least]
            for i in range(0, len(often), 1 << 17):
                yield rows(schema, h=often[i : i + (1 << 17)].view(np.int64))

    counted = cut.select("lang", "words", "ids").mapInArrow(count, "bucket int, packed binary")
    dealt = counted.repartition(shuffle_partitions(spark), "bucket").sortWithinPartitions("bucket")
    x = F.col("h").bitwiseAND(F.lit((1 << SIEVE_BITS) - 1)) + 1
    blocks = dealt.mapInArrow(add, "h long").groupBy(F.bitmap_bucket_number(x).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(x)).alias("bits"), F.count("*").alias("n")
    )
    bits, total = np.zeros(1 << (SIEVE_BITS - 3), dtype=np.uint8), 0
    for block, part, n in blocks.collect():  # 4,096 rows of 4 KB at most
        bits[(block - 1) << 12 : block << 12] = np.frombuffer(part, dtype=np.uint8)
        total += n
    return spark.sparkContext.broadcast(bits.tobytes()), total


def sieves(spark: SparkSession, cut: DataFrame, least: int) -> tuple[list, int]:
    """For each order a broadcast bitmap of the hashes of runs that occur ``least`` times, that of
    single words for those alone which a frequent pair begins or ends with (no other word is
    ever asked for); and how many these runs are in all."""
    n_words = cut.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(shuffle_partitions(spark), n_words // HELD_RUNS)
    made, total = [], 0
    for _ in range(LONGEST):
        sieve, n = _sieve(spark, cut, lambda shard, so_far=list(made): shard.runs(so_far)[1], least, buckets)
        made.append(sieve)
        total += n
    words, n = _sieve(spark, cut, lambda shard, pairs=made[:2]: shard.ends_of_pairs(pairs), 1, buckets)
    return [made, words], total + n


def _label(lang: str) -> bytes:
    """The first label of a language's keys; in hexadecimal, as it may hold any character."""
    return lang.encode().hex().encode()


def _key(text: bytes) -> Key:
    return tuple(text.split(b"\t"))


def _keys(lang: str, shard: _Shard, passed: list) -> tuple[list[Key], list[int]]:
    """The runs of the shard that pass the sieves, in order, and how often each occurs."""
    orders, words = passed
    begins, _ = shard.runs(orders)
    single = np.flatnonzero(np.append(False, shard._pass(words, shard.hashes[1:])))
    ids = np.concatenate([shard.ids, np.zeros(LONGEST, np.int64)])
    table = np.concatenate(
        [np.stack([ids[at + k] if k < n else np.zeros(len(at), np.int64) for k in range(LONGEST)]) for n, at in enumerate(begins, 1) if n > 1],
        axis=1,
    )
    weights = np.append(np.ones(table.shape[1], dtype=np.int64), np.bincount(shard.ids, minlength=len(shard.hashes))[single])
    table = np.concatenate([table, np.stack([single, *[np.zeros(len(single), np.int64)] * (LONGEST - 1)])], axis=1)
    order = np.lexsort(table[::-1])
    table, weights = table[:, order], weights[order]
    if not len(weights):
        return [], []
    first = np.flatnonzero(np.append(True, np.any(table[:, 1:] != table[:, :-1], axis=0)))
    names, top = [b"", *shard.words], _label(lang)
    keys = [(top, *[names[i] for i in run if i]) for run in zip(*table[:, first].tolist())]
    return keys, np.add.reduceat(weights, first).tolist()


def bounds(cut: DataFrame, passed: list, n_keys: int) -> list[Key]:
    """Keys that divide all keys into ranges of about ``RANGE_KEYS``, from a sample of shards."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, shard in _shards(batches):
            keys, _ = _keys(lang, shard, passed)
            some = [keys[i] for i in np.linspace(0, len(keys) - 1, min(SAMPLE_KEYS, len(keys))).astype(int)]
            yield pa.RecordBatch.from_pydict({"key": pa.array([b"\t".join(k) for k in some], pa.binary())})

    every = -(-cut.count() // SAMPLE_SHARDS)
    some = cut.filter(F.pmod(F.xxhash64("words"), F.lit(max(1, every))) == 0).select("lang", "words", "ids")
    found = some.mapInArrow(work, "key binary").limit(4 * SAMPLE_KEYS * SAMPLE_SHARDS).collect()
    found = sorted(_key(bytes(r["key"])) for r in found)
    n = min(-(-n_keys // RANGE_KEYS), len(found))
    return sorted({found[len(found) * i // n] for i in range(1, n)})


def transducers(cut: DataFrame, passed: list, cuts: list[Key], salts: int) -> DataFrame:
    """range, salt, automaton: of each shard an automaton from language and words to their counts
    for each prefix range that it has keys of."""
    schema = pa.schema([("range", pa.int32()), ("salt", pa.int32()), ("automaton", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId()
        for lang, shard in _shards(batches):
            n += 1
            keys, counts = _keys(lang, shard, passed)
            begin = 0
            while begin < len(keys):
                where = bisect_right(cuts, keys[begin])
                end = bisect_left(keys, cuts[where], begin) if where < len(cuts) else len(keys)
                made = build(zip(keys[begin:end], counts[begin:end]))
                yield rows(schema, range=[where], salt=[n % salts], automaton=[made.dump()])
                begin = end

    return cut.select("lang", "words", "ids").mapInArrow(work, "range int, salt int, automaton binary")


def _added(parts: DataFrame, keys: list[str], least: int) -> DataFrame:
    """``keys`` and one automaton for each of them: the sum of theirs, without counts below ``least``."""
    schema = pa.schema([*[(k, pa.int32()) for k in keys], ("automaton", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, sums = None, Counter()

        def done() -> pa.RecordBatch:
            kept = sorted((k, n) for k, n in sums.items() if n >= least)
            return rows(schema, **{k: [v] for k, v in zip(keys, here)}, automaton=[build(kept).dump()])

        for batch in batches:
            for i in range(batch.num_rows):
                group = tuple(batch.column(k)[i].as_py() for k in keys)
                if group != here:
                    if here is not None:
                        yield done()
                    here, sums = group, Counter()
                for key, n in Automaton.load(batch.column("automaton")[i].as_py()).items():
                    sums[key] += n
        if here is not None:
            yield done()

    dealt = parts.repartition(shuffle_partitions(parts.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(work, ", ".join(f"{k} int" for k in keys) + ", automaton binary")


def united(cut: DataFrame, passed: list, cuts: list[Key], least: int) -> DataFrame:
    """range, automaton: for each prefix range the counts of all shards, from ``least`` on."""
    salts = max(1, int(cut.count() ** 0.5))  # as many parts of a range as each part has shards
    some = _added(transducers(cut, passed, cuts, salts), ["range", "salt"], 0)
    return store(_added(some.select("range", "automaton"), ["range"], least), "united")


def counted_phrases(sums: DataFrame) -> DataFrame:
    """lang, phrase (words joined by blanks), n_words, f: every key of the united automata."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("n_words", pa.int32()), ("f", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dumped in batch.column("automaton"):
                items = list(Automaton.load(dumped.as_py()).items())
                yield rows(
                    schema,
                    lang=[bytes.fromhex(k[0].decode()).decode() for k, _ in items],
                    phrase=[b" ".join(k[1:]) for k, _ in items],
                    n_words=[len(k) - 1 for k, _ in items],
                    f=[n for _, n in items],
                )

    found = sums.select("automaton").mapInArrow(work, "lang string, phrase binary, n_words int, f long")
    return found.withColumn("phrase", F.col("phrase").cast("string"))


def lookup(sums: DataFrame, cuts: list[Key], asked: DataFrame) -> DataFrame:
    """lang, phrase, f: the counts of the phrases ``asked`` (lang, phrase: distinct), where known.

    Phrases go to the ranges of ``sums`` (as from ``united`` with the same ``cuts``), where their
    automaton is composed with the range's; a range has at most as many of them as keys."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("f", pa.int64())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = pa.schema([("range", pa.int32()), ("key", pa.binary()), ("automaton", pa.binary())])
        for batch in batches:
            pairs = zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())
            keys = [(_label(lang), *phrase.split(b" ")) for lang, phrase in pairs]
            yield rows(sent, range=[bisect_right(cuts, k) for k in keys], key=[b"\t".join(k) for k in keys], automaton=[None] * len(keys))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, machine, keys = None, None, []

        def answers() -> pa.RecordBatch:
            wanted = build((k, 0) for k in sorted(keys))
            found = list(machine.compose(wanted)) if machine else []
            return rows(
                schema,
                lang=[bytes.fromhex(k[0].decode()).decode() for k, _ in found],
                phrase=[b" ".join(k[1:]) for k, _ in found],
                f=[n for _, n in found],
            )

        for batch in batches:
            for number, key, dumped in zip(*(batch.column(n).to_pylist() for n in ("range", "key", "automaton"))):
                if number != here:
                    if keys:
                        yield answers()
                    here, machine, keys = number, None, []
                if dumped is not None:
                    machine = Automaton.load(dumped)
                else:
                    keys.append(_key(key))
        if keys:
            yield answers()

    sent = asked.select("lang", F.col("phrase").cast("binary").alias("phrase"))
    sent = sent.mapInArrow(send, "range int, key binary, automaton binary")
    there = sums.select("range", F.lit(None).cast("binary").alias("key"), "automaton").unionByName(sent)
    dealt = there.repartition(shuffle_partitions(sums.sparkSession), "range").sortWithinPartitions("range", "key")
    found = dealt.mapInArrow(work, "lang string, phrase binary, f long")
    return found.withColumn("phrase", F.col("phrase").cast("string"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, inside_percent: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of phrases of 2 to 4 words with a count a of at least
    ``least`` the first ``top`` of each language by score, count (both descending) and phrase.

    l and r are the counts of the parts of the cut with the lowest score floor(2000000 a / (l + r)),
    the earliest of those; n is the language's number of words. A phrase inside a longer frequent
    one that occurs ``inside_percent`` percent as often is left out. Products are decimals of 38
    digits. Columns of ``docs`` but lang and text are ignored; an empty table has no phrases.
    """
    spark = docs.sparkSession
    cut = shards(docs)
    passed, n_keys = sieves(spark, cut, least)
    cuts = bounds(cut, passed, n_keys)
    sums = united(cut, passed, cuts, least)
    for sieve in [*passed[0], passed[1]]:
        sieve.unpersist()

    known = store(counted_phrases(sums).filter("n_words > 1").withColumnRenamed("f", "a"), "phrases")
    words = F.split("phrase", " ", -1)
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    joined = lambda start, length: F.array_join(F.slice(words, start, length), " ")
    cuts_of = known.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1))).select(
        "lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("rest")
    )
    parts = cuts_of.select("lang", F.explode(F.array("first", "rest")).alias("phrase")).distinct()
    counts = store(lookup(sums, cuts, parts), "parts")
    of = lambda part, name: counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    scored = cuts_of.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r)")
    scored = scored.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = known.filter("n_words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)))
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1)))
    inner = inner.groupBy("lang", joined(F.col("start"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    alone = scored.join(inner, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * wide("longer") < inside_percent * wide("a"))
    )

    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    first = alone.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    sizes = cut.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return first.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
