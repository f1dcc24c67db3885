"""Jaccard similarity join of documents on word n-grams, with rare-first prefix filtering.

1. Every document becomes its set of n-grams (64-bit hashes). A frequency sketch counts all
   n-grams of all documents in a fixed number of counters; it gives the order
   rarest-first that all documents share. Any common order keeps the join exact; the
   counts only make prefixes rare.
2. Two sets with Jaccard similarity t or more share an n-gram among the first
   ``n - ceil(t n) + 1`` of both. Equal sets are represented by one document, and prefix
   n-grams that only one set has are dropped after counting, as are those that stand too
   late in a set for the sizes it meets (positional filter).
3. Documents that share a prefix n-gram with few others give candidate pairs, which are made
   distinct and pass the length filter in the join. N-grams with more documents than
   ``SHORT_LIST`` mark large groups of near copies: their documents are dealt in blocks of
   bounded size, and blocks that share such an n-gram meet once, so no pairs are emitted.
   There a pair is skipped when both ends are known to be linked already.
4. Both ways a pair passes the suffix filter (a bound on the difference of the sets from
   the numbers in 128 ranges of hash values) and is verified once on the sets themselves.
   Links become components.

Texts move only for documents with a candidate.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardlake.llm import hashing
from cardlake.llm.components import connected_components
from cardlake.llm.shipping import ship_package
from cardlake.session import stage

COUNTERS = 1 << 20
SLICES = 64
BLOCK_DOCUMENTS = 512
BLOCK_NGRAMS = 2_000_000
RANGES = 128
SHORT_LIST = 64
ID_BUCKETS = 1 << 20
BROADCAST_ROWS = 500_000
HOT_DIGESTS = 10_000


def ngram_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text.

    Words are runs without ASCII white space, A-Z in lower case. A text with fewer words
    than ``size`` is one n-gram; without words the set is empty.
    """
    for _, group in hashing.chunks(texts):
        words, bounds, _ = hashing.batch_words(group)
        ngrams = hashing.sequence_hashes(words, size)
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if high - low >= size:
                yield np.unique(ngrams[low:high - size + 1])
            else:
                yield hashing.sequence_hashes(words[low:high], high - low) if high > low else words[:0]


def _required(n: int, percent: int) -> int:
    """Least common part of a set of ``n`` with any set it links to."""
    return -(-percent * n // 100)


def _sum_slices(rows: DataFrame, *keys: str) -> DataFrame:
    """Adds up counter slices that share ``keys``."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(COUNTERS // SLICES, dtype=np.int64)
        for data in table.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(data), dtype=np.int64)
        head = {k: table.column(k)[:1] for k in ("part", "slice")}
        return pa.table(head | {"counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    return rows.groupBy(*keys).applyInArrow(add, "part int, slice int, counts binary")


def frequency_sketch(texts: DataFrame, size: int) -> np.ndarray:
    """Documents per n-gram over all documents, in ``COUNTERS`` shared counters.

    Each task sends a few MB at most, which are added up in two steps.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, part = np.zeros(COUNTERS, dtype=np.int64), 0
        for batch in batches:
            for ngrams in ngram_sets(batch.column(0).to_pylist(), size):
                if len(ngrams):
                    part = part or int(ngrams[0] & np.uint64(63))
                    np.add.at(counts, (ngrams & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        if counts.any():
            pieces = [zlib.compress(x.tobytes(), 1) for x in counts.reshape(SLICES, -1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * SLICES, pa.int32()), pa.array(range(SLICES), pa.int32()), pa.array(pieces)],
                names=["part", "slice", "counts"])

    rows = texts.mapInArrow(count, "part int, slice int, counts binary")
    total = np.zeros((SLICES, COUNTERS // SLICES), dtype=np.int64)
    for row in _sum_slices(_sum_slices(rows, "part", "slice"), "slice").collect():
        total[row["slice"]] = np.frombuffer(zlib.decompress(row["counts"]), dtype=np.int64)
    return total.reshape(-1)


def _prefixes(docs: DataFrame, sketch: np.ndarray, size: int, percent: int) -> DataFrame:
    """Per document the set's size, its digest, and the rarest n-grams it must share one of."""
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(sketch, 2**31 - 1).astype(np.int32))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            sizes, digests, prefixes = [], [], []
            for ngrams in ngram_sets(batch.column(1).to_pylist(), size):
                n = len(ngrams)
                keep = n - _required(n, percent) + 1 if n else 0
                rarity = counts[(ngrams & np.uint64(COUNTERS - 1)).astype(np.int64)]
                sizes.append(n)
                digests.append(hashlib.blake2b(ngrams.tobytes(), digest_size=16).digest() if n else None)
                prefixes.append(ngrams[np.argsort(rarity, kind="stable")[:keep]].view(np.int64))
            lengths = np.zeros(len(sizes) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in prefixes], out=lengths[1:])
            values = np.concatenate(prefixes) if prefixes else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(lengths), pa.array(values))],
                names=["doc_id", "n", "digest", "prefix"])

    return docs.mapInArrow(build, "doc_id long, n long, digest binary, prefix array<long>")


def _ranges(ngrams: np.ndarray) -> np.ndarray:
    """How many n-grams of a set fall into each range of hash values."""
    return np.bincount((ngrams >> np.uint64(57)).astype(np.int64), minlength=RANGES).astype(np.int32)


def _hopeful(n: int, ranges: np.ndarray, others: np.ndarray, other_ranges: np.ndarray, percent: int) -> np.ndarray:
    """Which other sets pass the length and suffix filters, the likeliest first."""
    # Length: the common part is at most the smaller set.
    near = np.flatnonzero((100 * others >= percent * n) & (100 * n >= percent * others))
    both = n + others[near]
    needed = -(-percent * both // (100 + percent))
    # Suffix: what differs in number per range cannot be common.
    apart = np.abs(other_ranges[near] - ranges).sum(axis=1)
    good = np.flatnonzero(both - apart >= 2 * needed)
    return near[good[np.argsort(apart[good], kind="stable")]]


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test of two sets."""
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    common = int(np.count_nonzero(b[place] == a))
    return 100 * common >= percent * (len(a) + len(b) - common)


class _Sets:
    """Sets of one side of a block pair."""

    def __init__(self, ids: list[int], texts: list[str | None], size: int) -> None:
        self.ids, self.sets = ids, list(ngram_sets(texts, size))
        self.n = np.array([len(x) for x in self.sets], dtype=np.int64)
        self.ranges = np.stack([_ranges(x) for x in self.sets]) if ids else np.zeros((0, RANGES), np.int32)


def _links(left: _Sets, right: _Sets, same: bool, percent: int) -> list[tuple[int, int]]:
    """Links between two blocks (or within one), enough of them to connect what is linked."""
    parent = {i: i for i in [*left.ids, *right.ids]}

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found = []
    for i, (a, ngrams) in enumerate(zip(left.ids, left.sets)):
        start = i + 1 if same else 0
        for k in _hopeful(len(ngrams), left.ranges[i], right.n[start:], right.ranges[start:], percent).tolist():
            b = right.ids[start + k]
            if root(a) != root(b) and _linked(ngrams, right.sets[start + k], percent):
                parent[max(root(a), root(b))] = min(root(a), root(b))
                found.append((a, b))
    return found


def _verify_blocks(blocks: DataFrame, size: int, percent: int) -> DataFrame:
    """Links within dealt-out block pairs. Rows are sorted by block pair, so each is one run."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(rows: list[tuple]) -> pa.RecordBatch:
            sides = [[r for r in rows if r[1] == side] for side in (0, 1)]
            left, right = [_Sets([r[2] for r in side], [r[3] for r in side], size) for side in sides]
            same = not right.ids
            links = _links(left, left if same else right, same, percent)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

        held, key = [], None
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns]):
                if row[0] != key and held:
                    yield solve(held)
                    held = []
                key = row[0]
                held.append(row)
        if held:
            yield solve(held)

    return _sorted_into_tasks(blocks, "task").select("task", "side", "doc_id", "text").mapInArrow(link, "a long, b long")


def _verify_pairs(pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links among candidate pairs. Rows are sorted by the first document of the pairs, with
    its own text before those of its partners, so two sets are held at a time."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, ranges = None, None, None
        for batch in batches:
            left, right = [], []
            task, side, doc, texts = (column.to_pylist() for column in batch.columns)
            for a, later, b, ngrams in zip(task, side, doc, ngram_sets(texts, size)):
                if not later:
                    key, own, ranges = a, ngrams, _ranges(ngrams)
                elif key == a:
                    others = np.array([len(ngrams)]), _ranges(ngrams)[None, :]
                    if len(_hopeful(len(own), ranges, *others, percent)) and _linked(own, ngrams, percent):
                        left.append(a)
                        right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return _sorted_into_tasks(pairs, "task", "side").select("task", "side", "doc_id", "text").mapInArrow(
        link, "a long, b long")


def _sorted_into_tasks(rows: DataFrame, *order: str) -> DataFrame:
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, "task").sortWithinPartitions(*order)


def jaccard_components(
    docs: DataFrame, size: int, percent: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Classes of documents linked by n-gram Jaccard similarity of ``percent`` or more.

    Returns ``id_column`` (long), ``n_ngrams`` (set size) and ``component_id`` (the smallest
    id reachable by links, itself included), one row per input row. Null, empty and wordless
    texts have set size 0 and link with nothing. Equal texts link; rows that repeat an id
    should repeat its text (each copy then gets the same answer). A null id keeps its row, takes
    no part in links, and has a null class. Two hashes of 64 bits that agree by chance would
    count as one n-gram (expected less than once in 10**8 documents of 10**3 words each set).
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    sketch = frequency_sketch(rows.select("text"), size)
    described = stage(_prefixes(rows, sketch, size, percent), "prefixes")

    heads = stage(
        described.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
            F.min("doc_id").alias("head"), F.count("*").alias("copies")),
        "heads")
    documents = heads.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    # Prefixes stay where they are: the fewer ids of copies are sent to them, if few enough.
    copies = stage(
        _by_digest(described.select("doc_id", "digest"), heads, documents).where("doc_id <> head")
        .select("doc_id").distinct(),
        "copies")
    known = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS else copies
    postings = described.where("doc_id IS NOT NULL").join(known, "doc_id", "left_anti").select(
        "doc_id", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("position", "ngram"))
    several = postings.groupBy("ngram").agg(
        F.count("*").alias("members"), F.min("doc_id").alias("first"), F.min("n").alias("least_n")
    ).where("members > 1")
    # Positional filter: a pair that first agrees at this position has at most n - position
    # n-grams in common, too few for any partner but a small one.
    partner = (F.col("n") - F.col("position")) * (100 + percent) - F.col("n").cast("long") * percent
    shared = stage(
        postings.join(several, "ngram").where(partner >= F.col("least_n") * percent).select(
            "doc_id", "n", "ngram", "first", "members"),
        "postings")
    ids = described.select("doc_id", "n").distinct()
    members, crowded = _blocks(shared.where(F.col("members") > SHORT_LIST), ids)
    groups, pairs = _pairs(shared.where(F.col("members") <= SHORT_LIST), members, ids, percent)

    # Who goes where is settled on ids, before any text moves.
    links = None
    for addressed, verify in ((stage(crowded.union(groups), "groups"), _verify_blocks), (pairs, _verify_pairs)):
        part = verify(_with_texts(rows, addressed), size, percent)
        links = part if links is None else links.union(part)
    classes = connected_components(links)

    # Classes meet the heads, one row per set, before they meet the documents.
    # They are stored, as the lookup of documents takes them in three places.
    classed = stage(
        heads.join(classes.withColumnRenamed("node", "head"), "head", "left").select(
            "digest", "copies", F.coalesce("component", "head").alias("component")),
        "classed")
    return _by_digest(described.select("doc_id", "n", "digest"), classed, documents).select(
        F.col("doc_id").alias(id_column), F.col("n").alias("n_ngrams"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def _by_digest(rows: DataFrame, values: DataFrame, documents: int) -> DataFrame:
    """Documents with what ``values`` holds for their digest, one row each; nulls where nothing.

    Digests with more than one in ``HOT_DIGESTS`` of all ``documents``, fewer than that in number, are
    broadcast, so the copies of a text never meet on one key. Rows without a set or an id, which
    have no entry, are not shuffled either.
    """
    hot = F.col("copies") * HOT_DIGESTS > documents
    none = F.col("digest").isNull() | F.col("doc_id").isNull()
    few = F.broadcast(values.where(hot))
    known = rows.where(~none)
    found = known.join(few, "digest").union(
        known.join(few.select("digest"), "digest", "left_anti").join(values.where(~hot), "digest"))
    rest = [F.lit(None).cast(values.schema[c].dataType).alias(c) for c in values.columns if c != "digest"]
    return found.union(rows.where(none).select("digest", *[c for c in rows.columns if c != "digest"], *rest))


def _blocks(shared: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents of crowded n-grams with their cluster and block, and who meets in which task."""
    clusters = connected_components(
        shared.where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b")))
    sized = clusters.join(ids.withColumnRenamed("doc_id", "node"), "node")
    totals = sized.groupBy("component").agg(F.count("*").alias("members"), F.sum("n").alias("ngrams"))
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK_DOCUMENTS, F.col("ngrams") / BLOCK_NGRAMS))
    members = stage(
        sized.join(totals.select("component", blocks.alias("blocks")), "component").select(
            F.col("node").alias("doc_id"), F.col("component").alias("cluster"),
            F.pmod(F.xxhash64("node"), "blocks").alias("block"), "blocks"),
        "members")
    # Blocks meet where they share a crowded n-gram; a block meets itself anyway.
    seen = shared.join(members.where("blocks > 1").select("doc_id", "cluster", "block"), "doc_id").select(
        "ngram", "cluster", "block").distinct()
    meetings = (
        seen.join(seen.select("ngram", "cluster", F.col("block").alias("other")), ["ngram", "cluster"])
        .where("block < other").select("cluster", "block", "other").distinct()
    )
    own = members.select("cluster", "block", F.col("block").alias("other")).distinct()
    tasks = own.union(meetings).select(F.struct("cluster", "block", "other").alias("task"))
    sides = tasks.select("task", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.struct("task.cluster", "task.block").alias("place")),
        F.struct(F.lit(1).alias("side"), F.struct(F.col("task.cluster"), F.col("task.other").alias("block")).alias("place")),
    )).alias("s")).select("task", "s.side", "s.place").where("side = 0 OR task.block < task.other")
    placed = members.select("doc_id", F.struct("cluster", "block").alias("place"))
    return members, placed.join(sides, "place").select("doc_id", "task", "side")


def _pairs(shared: DataFrame, members: DataFrame, ids: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs of uncrowded n-grams: small groups as block tasks, and all other pairs.

    An n-gram brings at most ``SHORT_LIST`` documents together, so pairs grow with the
    postings. Pairs whose ends stand in one block are left out, as they meet there. Pairs that
    hang together in a group no larger than a block are one task, so each text goes there
    once; the others are one row per document that meets a first one.
    """
    one = shared.select("ngram", F.col("doc_id").alias("a"), F.col("n").alias("n_a"))
    other = shared.select("ngram", F.col("doc_id").alias("b"), F.col("n").alias("n_b"))
    found = (
        one.join(other, "ngram")
        .where((F.col("a") < F.col("b")) & (F.col("n_a") * 100 >= F.col("n_b") * percent)
               & (F.col("n_b") * 100 >= F.col("n_a") * percent))
        .select("a", "b").distinct()
    )
    known = members.select("doc_id", F.struct("cluster", "block").alias("place"))
    found = (
        found.join(known.withColumnsRenamed({"doc_id": "a", "place": "place_a"}), "a", "left")
        .join(known.withColumnsRenamed({"doc_id": "b", "place": "place_b"}), "b", "left")
        .where("place_a IS NULL OR place_b IS NULL OR place_a <> place_b")
        .select("a", "b")
    )
    found = stage(found, "candidates")
    groups = connected_components(found).join(ids.withColumnRenamed("doc_id", "node"), "node")
    fits = groups.groupBy("component").agg(F.count("*").alias("members"), F.sum("n").alias("ngrams")).where(
        (F.col("members") <= BLOCK_DOCUMENTS) & (F.col("ngrams") <= BLOCK_NGRAMS)).select("component")
    grouped = stage(groups.join(fits, "component").select(F.col("node").alias("doc_id"), "component"), "grouped")
    alone = F.lit(-1).cast("long")
    tasks = grouped.select(
        "doc_id", F.struct(F.col("component").alias("cluster"), alone.alias("block"), alone.alias("other")).alias("task"),
        F.lit(0).alias("side"))
    found = found.join(grouped.select(F.col("doc_id").alias("a")), "a", "left_anti")
    first = found.select(F.col("a").alias("doc_id"), F.col("a").alias("task"), F.lit(0).alias("side")).distinct()
    return tasks, stage(first.union(found.select("b", "a", F.lit(1))), "pairs")


def _with_texts(rows: DataFrame, addressed: DataFrame) -> DataFrame:
    """Documents with their tasks and texts.

    A list of at most ``BROADCAST_ROWS`` addresses (a few dozen MB) goes to the texts. A longer one
    is joined by a shuffle, in which texts take part whose ids pass a filter of
    ``ID_BUCKETS`` hash buckets (8 MB) of the wanted ids.
    """
    if addressed.count() <= BROADCAST_ROWS:
        dealt = rows.join(F.broadcast(addressed), "doc_id")
    else:
        bucket = F.pmod(F.xxhash64("doc_id"), F.lit(ID_BUCKETS))
        buckets = addressed.select(bucket.alias("bucket")).distinct()
        near = rows.withColumn("bucket", bucket).join(F.broadcast(buckets), "bucket", "left_semi")
        dealt = near.drop("bucket").join(addressed, "doc_id")
    return dealt.select("task", "side", "doc_id", "text")
