"""Near-duplicate documents with a MinHash LSH forest and exact confirmation.

A document's set is its distinct 5-word shingles (words are runs of bytes other than ASCII
white space, A-Z in lower case); with fewer words, the whole sequence is its one shingle.
Two documents are linked if the Jaccard similarity of their sets is at least 0.75.

* Documents with equal sets collapse first; the smallest doc_id stands for them.
* Each of ``TREES`` trees orders the sets by a signature of ``LEVELS`` MinHash values.
  Neighbours in such an order that share a prefix of ``BASE`` values are candidates: two
  sets of similarity 0.75 share one in some tree with probability 1 - 5e-6. Trees are range
  partitioned, so a prefix that very many sets share is spread over tasks.
* What candidates connect is a block; no linked pair spans two blocks (but for that
  probability). Each document of a block is read again once, and its block is searched
  breadth first with full sets, without writing out pairs.
* Depth adapts per region: a block of more than ``block_bytes`` is dealt along ``DEEP`` of its trees,
  in the order of all ``LEVELS`` values, into stretches that fit a task. Sets of a stretch share
  the longest prefixes there are, and are searched in full. What that connects is a cluster.
* Only pairs of two clusters are open then. Clusters that exceed a part are cut into parts of
  their own, the others share parts; each pair of parts is searched by one task unless both are of
  one cluster. So the cut loses no link, no task holds more than two parts, and a block that is
  one cluster, as a group of near copies is, costs ``DEEP`` copies of its sets.

Null and empty texts have no set and link to nothing. Rows that share a doc_id are one
document (they share a component). Rows without doc_id link to nothing (component null,
kept). An empty table gives no rows. Other columns are ignored, or kept by ``deduplicate``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import binary_text, groups, hash_words, pieces, rows, shingles, shuffle_partitions, store, texts_of
from sluice.llm.components import components

WIDTH, PERCENT = 5, 75
TREES, BASE, LEVELS = 32, 4, 6
DEEP = 4

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 1 << 32, TREES * LEVELS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _random.integers(0, 1 << 32, TREES * LEVELS, dtype=np.uint32)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    texts = [t.lower() for t in texts]
    words, starts = hash_words(texts)
    found, owner, _ = shingles(words, starts, WIDTH)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i, n in enumerate(np.diff(starts)):
        if n >= WIDTH:
            s = np.sort(found[bounds[i] : bounds[i + 1]])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        else:
            short = [xxhash.xxh3_64_intdigest(b" ".join(texts[i].split()))] if n else []
            out.append(np.array(short, dtype=np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """For each set, TREES paths: two 64-bit numbers of BASE values of 16 bits and of the other
    values of 32 bits (a row of 2 * TREES; sets must not be empty)."""
    sizes = np.array([len(s) for s in sets])
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    begins = np.cumsum(sizes) - sizes
    out = np.zeros((len(sets), 2 * TREES), dtype=np.uint64)
    for k, (factor, shift) in enumerate(zip(_FACTORS, _SHIFTS)):
        least = np.minimum.reduceat(flat * factor + shift, begins)
        least = (least * np.uint32(0x9E3779B1)).astype(np.uint64)  # small minima differ in low bits only
        tree, level = divmod(k, LEVELS)
        if level < BASE:
            out[:, 2 * tree] = (out[:, 2 * tree] << np.uint64(16)) | (least >> np.uint64(16))
        else:
            out[:, 2 * tree + 1] = (out[:, 2 * tree + 1] << np.uint64(32)) | least
    return out.view(np.int64)


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (MD5), n_shingles, set_hash (128 bits; null without a set) and paths of
    every document."""
    fields = [("doc_id", pa.int64()), ("text_hash", pa.binary()), ("n_shingles", pa.int64()), ("set_hash", pa.binary())]
    schema = pa.schema([*fields, ("paths", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                texts = texts_of(part)
                sets = shingle_sets(texts)
                full = [s for s in sets if len(s)]
                paths = iter(signatures(full) if full else [])
                yield rows(
                    schema,
                    doc_id=part.column("doc_id"),
                    text_hash=[hashlib.md5(t).digest() for t in texts],
                    n_shingles=[len(s) for s in sets],
                    set_hash=[xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    paths=[next(paths) if len(s) else None for s in sets],
                )

    return binary_text(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        work, "doc_id long, text_hash binary, n_shingles long, set_hash binary, paths array<long>"
    )


def neighbours(forest: DataFrame) -> DataFrame:
    """Edges a, b of ``forest`` (tree, base, rest, doc): in each tree's sorted order, every set
    with the first one of the run of neighbours that share its base prefix.

    A run may go on in the next partition; each partition also gives its first and last set
    with their prefix, and those with the same prefix are joined up.
    """
    spark = forest.sparkSession
    names = [("tree", pa.int32()), ("base", pa.int64()), ("a", pa.int64()), ("b", pa.int64())]
    schema = pa.schema(names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = base = head = None
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t, p, d = (np.asarray(batch.column(n)) for n in ("tree", "base", "doc"))
            begins = np.ones(len(t), dtype=bool)
            begins[1:] = (t[1:] != t[:-1]) | (p[1:] != p[:-1])
            goes_on = last is not None and t[0] == tree and p[0] == base
            first = d[np.maximum.accumulate(np.where(begins, np.arange(len(t)), 0))]
            if goes_on:
                first[: np.argmax(begins[1:]) + 1 if begins[1:].any() else len(t)] = head
            elif last is None:
                yield rows(schema, tree=t[:1], base=p[:1], a=[None], b=d[:1])
            linked = first != d
            yield rows(schema, tree=[None] * int(linked.sum()), base=[None] * int(linked.sum()), a=first[linked], b=d[linked])
            tree, base, head, last = t[-1], p[-1], first[-1], d[-1]
        if last is not None:
            yield rows(schema, tree=[tree], base=[base], a=[None], b=[last])

    ordered = forest.repartitionByRange(shuffle_partitions(spark), "tree", "base", "rest", "doc")
    found = store(
        ordered.sortWithinPartitions("tree", "base", "rest", "doc").mapInArrow(
            work, "tree int, base long, a long, b long"
        ),
        "neighbours",
    )
    edges = found.filter("a is not null").select("a", "b")
    ends = found.filter("a is null")  # two rows a partition
    heads = ends.groupBy("tree", "base").agg(F.min("b").alias("a"))
    return edges.unionByName(ends.drop("a").join(heads, ["tree", "base"]).select("a", "b"))


def link(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """A number for each set, equal for those that links connect: breadth first, each set
    against all that no search has reached yet."""
    sizes = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    begins = np.cumsum(sizes) - sizes
    marked = np.zeros(int(flat.max()) + 1, dtype=np.int64)
    label = np.full(len(sets), -1, dtype=np.int64)
    left, left_flat = np.arange(len(sets)), flat

    def narrow() -> None:
        nonlocal left, left_flat
        stay = label[left] < 0
        left_flat = left_flat[np.repeat(stay, sizes[left])]
        left = left[stay]

    for seed in range(len(sets)):
        if label[seed] >= 0:
            continue
        label[seed] = seed
        queue = [seed]
        while queue:
            x = queue.pop()
            narrow()
            if not len(left):
                break
            mine = flat[begins[x] : begins[x] + sizes[x]]
            marked[mine] = 1
            ends = np.cumsum(sizes[left])
            common = np.add.reduceat(marked[left_flat], ends - sizes[left])
            marked[mine] = 0
            linked = left[100 * common >= percent * (sizes[left] + sizes[x] - common)]
            label[linked] = seed
            queue.extend(linked.tolist())
    return label


def read_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` (doc, text_hash, block, large) with the shingle set of each, read from ``docs``:
    a text meets its own row only, also where rows share a doc_id."""
    fields = [("block", pa.int64()), ("large", pa.bool_()), ("doc", pa.int64()), ("text_hash", pa.binary())]
    schema = pa.schema([*fields, ("shingles", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                sets = [s.tobytes() for s in shingle_sets(texts_of(part))]
                yield rows(schema, **{n: part.column(n) for n, _ in fields}, shingles=sets)

    texts = binary_text(docs, F.col("doc_id").cast("long").alias("doc"))
    texts = texts.filter("doc is not null").withColumn("text_hash", F.unhex(F.md5(F.coalesce("text", F.lit("").cast("binary")))))
    return texts.join(members, ["doc", "text_hash"]).mapInArrow(
        work, "block long, large boolean, doc long, text_hash binary, shingles binary"
    )


def confirm(sets: DataFrame, keys: list[str]) -> DataFrame:
    """Edges a, b (long): documents with the least one that confirmed links connect them with,
    within each group of ``sets`` with equal ``keys`` (long)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, keys):
            ids = group.column("doc").to_numpy()
            label = link([np.frombuffer(s, dtype=np.uint64) for s in group.column("shingles").to_pylist()])
            least = np.full(len(ids), np.iinfo(np.int64).max)
            np.minimum.at(least, label, ids)
            yield rows(schema, a=least[label], b=ids)

    dealt = sets.select(*keys, "doc", "shingles").repartition(shuffle_partitions(sets.sparkSession), *keys)
    return dealt.sortWithinPartitions(*keys, "doc").mapInArrow(work, "a long, b long")


def stretches(forest: DataFrame, block_bytes: int) -> DataFrame:
    """text_hash and stretch (long): ``forest`` (block, tree, base, rest, text_hash, size) in the order of
    whole paths, cut where ``block_bytes`` of sets are full or a block or tree begins."""
    schema = pa.schema([("text_hash", pa.binary()), ("stretch", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch, here, held = TaskContext.get().partitionId() << 40, None, 0
        for batch in batches:
            found = []
            for block, tree, size in zip(*(batch.column(n).to_pylist() for n in ("block", "tree", "size"))):
                if (block, tree) != here or held + 8 * size > block_bytes:
                    stretch, here, held = stretch + 1, (block, tree), 0
                held += 8 * size
                found.append(stretch)
            yield rows(schema, text_hash=batch.column("text_hash"), stretch=found)

    order = ["block", "tree", "base", "rest", "text_hash"]
    dealt = forest.repartitionByRange(shuffle_partitions(forest.sparkSession), *order)
    return dealt.sortWithinPartitions(*order).mapInArrow(work, "text_hash binary, stretch long")


def open_pairs(members: DataFrame, block_bytes: int) -> DataFrame:
    """text_hash, one, two (long) of the pairs of parts that are not of one cluster;
    ``members``: text_hash, block, size, cluster."""
    by_cluster = members.groupBy("block", "cluster").agg((8 * F.sum("size")).alias("bytes"))
    # Clusters of more than a quarter of a part have parts of their own.
    own = F.ceil(F.col("bytes") / block_bytes).cast("long")
    by_cluster = by_cluster.withColumn("own", F.when(4 * F.col("bytes") > block_bytes, own).otherwise(0))
    shared = F.ceil(F.sum(F.when(F.col("own") == 0, F.col("bytes")).otherwise(0)) / block_bytes).cast("long")
    shared = by_cluster.groupBy("block").agg(shared.alias("shared"), F.count("*").alias("clusters"))
    dealt = members.join(by_cluster.drop("bytes"), ["block", "cluster"]).join(shared.filter("clusters > 1"), "block")
    alone = F.col("own") > 0
    dealt = store(
        dealt.select(
            "text_hash",
            "block",
            alone.alias("alone"),
            F.when(alone, F.col("cluster")).otherwise(0).alias("cluster"),
            F.when(alone, F.pmod(F.xxhash64("text_hash"), "own")).otherwise(F.pmod(F.xxhash64("cluster"), "shared")).alias("slot"),
        ),
        "parts",
    )
    key = ["block", "alone", "cluster", "slot"]
    parts = dealt.select(*key).distinct().withColumn("part", F.xxhash64(*key))
    other = parts.select("block", F.col("alone").alias("_alone"), F.col("cluster").alias("_cluster"), F.col("part").alias("other"))
    pairs = parts.join(other, "block").filter("not (alone and _alone and cluster = _cluster)")
    return dealt.join(pairs, key).select(
        "text_hash", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two")
    )


def classes(docs: DataFrame, block_bytes: int = 16 << 20, broadcast_rows: int = 100_000) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the smallest doc_id of its component)."""
    described = store(describe(docs), "signatures")
    full = described.filter("set_hash is not null and doc_id is not null")
    distinct = store(
        full.groupBy("set_hash").agg(
            F.min("doc_id").alias("doc"),
            F.min_by("text_hash", F.struct("doc_id", "text_hash")).alias("text_hash"),
            F.min_by("paths", "doc_id").alias("paths"),
            F.min("n_shingles").alias("size"),
        ),
        "distinct",
    )
    path = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.struct(
            t.alias("tree"), F.get("paths", 2 * t).alias("base"), F.get("paths", 2 * t + 1).alias("rest")
        ),
    )
    forest = distinct.select("doc", F.explode(path).alias("p")).select("p.tree", "p.base", "p.rest", "doc")
    blocks = components(neighbours(forest))
    sized = distinct.select("doc", "text_hash", "size").join(
        blocks.withColumnsRenamed({"node": "doc", "label": "block"}), "doc"
    )
    large = store(
        sized.groupBy("block").agg((8 * F.sum("size")).alias("bytes")).filter(F.col("bytes") > block_bytes).select("block"),
        "large-blocks",
    )
    some = large.limit(1).count() > 0
    members = store(
        sized.join(large.withColumn("large", F.lit(True)), "block", "left").select(
            "doc", "text_hash", "block", "size", F.coalesce("large", F.lit(False)).alias("large")
        ),
        "members",
    )
    named = members.select("doc", "text_hash", "block", "large")
    n = members.count()
    side = F.broadcast(named) if n <= broadcast_rows else named
    sets = read_sets(docs, side)
    if not some:
        links = store(confirm(sets, ["block"]), "links")
        one_each = members.select("doc").distinct().count() == n  # else a document has several sets
        labels = components(links) if not one_each else links.select(
            F.col("b").alias("node"), F.col("a").alias("label")
        ).distinct()
    else:
        sets = store(sets, "sets")
        links = store(confirm(sets.filter("not large"), ["block"]), "links")
        much, those = sets.filter("large"), members.filter("large")
        along = distinct.select("text_hash", F.explode(F.slice(path, 1, DEEP)).alias("p")).select("text_hash", "p.*")
        along = along.join(those.select("text_hash", "block", "size"), "text_hash")
        near = store(stretches(along, block_bytes), "stretches")
        deep = store(confirm(much.join(near, "text_hash"), ["stretch"]), "deep-links")
        clusters = components(deep).withColumnsRenamed({"node": "doc", "label": "cluster"})
        clustered = those.join(clusters, "doc", "left").withColumn("cluster", F.coalesce("cluster", "doc"))
        pairs = store(open_pairs(store(clustered, "clusters"), block_bytes), "open-pairs")
        rest = store(confirm(much.join(pairs, "text_hash"), ["block", "one", "two"]), "rest-links")
        labels = components(links.unionByName(deep).unionByName(rest))
    named = distinct.select("set_hash", "doc").join(labels.withColumnRenamed("node", "doc"), "doc", "left")
    named = store(named.select("set_hash", F.coalesce("label", "doc").alias("label")), "classes")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    found = described.select("doc_id", "n_shingles", "set_hash").join(named, "set_hash", "left")
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id; of rows
    that share a doc_id one stays, rows without doc_id all do."""
    found = classes(docs)
    kept = found.filter("kept and doc_id is not null").select(F.col("doc_id").alias("_kept_doc_id")).distinct()
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), F.col("text"))
    named = docs.join(kept, F.col("doc_id").cast("long") == F.col("_kept_doc_id"), "left_semi")
    first = named.withColumn("_kept_turn", F.row_number().over(one)).filter("_kept_turn = 1").drop("_kept_turn")
    return first.unionByName(docs.filter("doc_id is null"))
