"""Near duplicates among embeddings by product quantisation with exact rerank.

Vectors are scaled to length one. Coarse centroids deal them to inverted lists; what is
left after subtracting the centroid is cut into subspaces with 256 codewords each. A vector
asks its own list and all lists whose centroid is nearly as close. In a list the cosine is
estimated from a table of products with codewords (asymmetric: the asking vector is not
quantised). The length of the quantisation error, stored with the code, bounds how far the
estimate can be off, so only probes can lose a link, never the estimate. What may reach the
threshold is computed exactly in double precision.

A pair may be found from one side only, where the other does not ask its partner's list. Members
carry the lists that they ask, so the link is then counted for both, and once for each.

Equal vectors are represented by one. Long lists are split into blocks, which an asking
vector visits one after the other; a block returns one row per asking vector (how many it
links to and one node that it is connected with) and one per member with links found from
the other side only, never the pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardlake.llm.components import connected_components
from cardlake.llm.shipping import ship_package
from cardlake.session import stage

MAX_LISTS = 1024
SAMPLE_PER_LIST = 40
SAMPLE_BYTES = 128 << 20
ASKED_BYTES = 32 << 20
SUBSPACES = 8
CODEWORDS = 256
BLOCK_VECTORS = 2048
QUERY_CHUNK = 512
PROBE_MARGIN = 0.2


def _kmeans(vectors: np.ndarray, wanted: int, rounds: int, seed: int) -> np.ndarray:
    """Plain k-means; clusters that run empty are dropped."""
    random = np.random.default_rng(seed)
    centres = vectors[random.permutation(len(vectors))[:wanted]].copy()
    for _ in range(rounds):
        owner = (vectors @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)
        counts = np.bincount(owner, minlength=len(centres))
        order = np.argsort(owner, kind="stable")
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[counts > 0]
        centres = np.add.reduceat(vectors[order], starts, axis=0) / counts[counts > 0][:, None]
    return centres


@dataclass
class Quantiser:
    """Coarse centroids (unit length) and per subspace its columns and codewords."""

    centroids: np.ndarray
    columns: list[np.ndarray]
    codewords: list[np.ndarray]
    margin: float

    def lists(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The own list of each vector, and which lists it asks."""
        cosines = units @ self.centroids.T
        own = cosines.argmax(axis=1)
        return own, cosines >= cosines.max(axis=1, keepdims=True) - self.margin

    def encode(self, units: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals and the length of what they miss."""
        rest = units - self.centroids[own]
        codes = np.empty((len(units), len(self.columns)), dtype=np.uint8)
        missed = np.zeros(len(units))
        for m, (columns, words) in enumerate(zip(self.columns, self.codewords)):
            part = rest[:, columns]
            codes[:, m] = (part @ words.T - 0.5 * (words**2).sum(axis=1)).argmax(axis=1)
            missed += ((part - words[codes[:, m]]) ** 2).sum(axis=1)
        return codes, np.sqrt(missed)

    def tables(self, units: np.ndarray) -> list[np.ndarray]:
        """Products of every vector's subspaces with all codewords."""
        return [units[:, c] @ w.T for c, w in zip(self.columns, self.codewords)]


def fit(units: np.ndarray, lists: int, margin: float, seed: int = 3) -> Quantiser:
    """Fits coarse centroids and codewords on a sample of unit vectors."""
    centroids = _kmeans(units, max(1, min(lists, len(units))), 8, seed)
    centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
    rest = units - centroids[(units @ centroids.T).argmax(axis=1)]
    columns = np.array_split(np.arange(units.shape[1]), min(SUBSPACES, units.shape[1]))
    words = [_kmeans(rest[:, c], min(CODEWORDS, len(rest)), 6, seed + 1 + m) for m, c in enumerate(columns)]
    return Quantiser(centroids, columns, words, margin)


def _prepared(vectors: DataFrame) -> DataFrame:
    """Ids with unit vectors in double precision; null for vectors that link with nothing."""

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, digests, sizes = [], [], []
            for values in batch.column(1).to_pylist():
                unit = None
                if values and None not in values:
                    vector = np.array(values, dtype=np.float64)
                    top = np.abs(vector).max()
                    if np.isfinite(top) and top > 0:
                        vector = vector / top
                        unit = (vector / np.linalg.norm(vector)).tobytes()
                units.append(unit)
                digests.append(hashlib.blake2b(unit, digest_size=16).digest() if unit else None)
                sizes.append(len(values) if unit else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), pa.array(units, pa.binary())],
                names=["vec_id", "size", "digest", "unit"])

    return vectors.mapInArrow(scale, "vec_id long, size int, digest binary, unit binary")


def _dealt(heads: DataFrame, quantiser: Quantiser) -> DataFrame:
    """A row for each vector in its list, and one for each list that it asks."""
    shared = heads.sparkSession.sparkContext.broadcast(quantiser)
    schema = pa.schema(
        [("list", pa.int32()), ("asks", pa.bool_()), ("vec_id", pa.int64()), ("weight", pa.int64()), ("unit", pa.binary()),
         ("codes", pa.binary()), ("missed", pa.float64()), ("own", pa.int32()), ("asked", pa.binary())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, weights, data = batch.columns
            units = np.frombuffer(b"".join(data.to_pylist())).reshape(len(data), -1)
            own, asked = known.lists(units)
            codes, missed = known.encode(units, own)
            home = pa.array(own, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [home, pa.array([False] * len(ids)), ids, weights, data, pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array(missed), home, pa.array([np.flatnonzero(a).astype(np.int32).tobytes() for a in asked], pa.binary())],
                schema=schema)
            asking, numbers = np.nonzero(asked)
            step = max(1, ASKED_BYTES // units[0].nbytes)
            for low in range(0, len(asking), step):
                rows = pa.array(asking[low:low + step])
                none = [pa.nulls(len(rows), t) for t in (pa.binary(), pa.float64(), pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[low:low + step], pa.int32()), pa.array([True] * len(rows)), ids.take(rows),
                     weights.take(rows), data.take(rows), none[0], none[1], home.take(rows), none[2]],
                    schema=schema)

    return heads.select("vec_id", "weight", "unit").mapInArrow(
        deal, "list int, asks boolean, vec_id long, weight long, unit binary, codes binary, missed double, own int, asked binary")


def _sample(heads: DataFrame, rows: int, wanted: int) -> DataFrame:
    """The ``wanted`` unit vectors whose ids hash lowest.

    Only rows below a bound that about twice as many pass are sorted, so what tasks hand to the
    last one does not grow with the table. Fewer than ``wanted`` of them have a negligible chance.
    """
    placed = heads.select("unit", F.xxhash64("vec_id").alias("place"))
    bound = -(2**63) + 2**64 * 2 * wanted // rows
    if bound < 2**63:
        placed = placed.where(F.col("place") < F.lit(bound))
    return placed.orderBy("place").limit(wanted).select("unit")


class _Block:
    """The vectors of one block of a list, and which of them are known to be connected."""

    def __init__(self, quantiser: Quantiser, number: int, rows: list[tuple], limit: float) -> None:
        self.quantiser, self.limit = quantiser, limit
        self.centroid = quantiser.centroids[number]
        self.ids = np.array([r[3] for r in rows], dtype=np.int64)
        self.weights = np.array([r[4] for r in rows], dtype=np.int64)
        self.units = np.frombuffer(b"".join(r[5] for r in rows)).reshape(len(rows), -1) if rows else np.zeros((0, 1))
        self.codes = np.frombuffer(b"".join(r[6] for r in rows), dtype=np.uint8).reshape(len(rows), -1) if rows else None
        self.missed = np.array([r[7] for r in rows])
        self.root = np.arange(len(rows))
        # Which lists each member asks, as sorted numbers of member and list.
        asked = [np.frombuffer(r[9], dtype=np.int32) for r in rows]
        members = np.repeat(np.arange(len(rows)), [len(a) for a in asked])
        self.asked = members * len(quantiser.centroids) + np.concatenate(asked) if rows else members

    def _asks_back(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Whether members ask the given lists."""
        wanted = x * len(self.quantiser.centroids) + own
        place = np.minimum(np.searchsorted(self.asked, wanted), len(self.asked) - 1)
        return self.asked[place] == wanted

    def ask(self, rows: list[tuple]) -> list[tuple[int, int, int]]:
        """(vector, connected vector, links) per asking vector, rows that join members, and the
        same for members whose own search does not come upon vectors that have found them."""
        out: list[tuple[int, int, int]] = []
        if not len(self.ids) or not rows:
            return out
        ids = np.array([r[3] for r in rows], dtype=np.int64)
        units = np.frombuffer(b"".join(r[5] for r in rows)).reshape(len(rows), -1)
        estimate = np.broadcast_to((units @ self.centroid)[:, None], (len(ids), len(self.ids))).copy()
        for m, table in enumerate(self.quantiser.tables(units)):
            estimate += table[:, self.codes[:, m]]
        q, x = np.nonzero(estimate + self.missed >= self.limit - 1e-9)
        different = ids[q] != self.ids[x]
        q, x = q[different], x[different]
        exact = np.empty(len(q))
        for low in range(0, len(q), 1 << 16):
            part = slice(low, low + (1 << 16))
            exact[part] = np.einsum("ij,ij->i", units[q[part]], self.units[x[part]])
        linked = exact >= self.limit
        q, x = q[linked], x[linked]
        if not len(q):
            return out
        count = np.bincount(q, weights=self.weights[x], minlength=len(ids)).astype(np.int64)
        own = np.array([r[8] for r in rows], dtype=np.int64)
        unasked = ~self._asks_back(x, own[q])
        weights = np.array([r[4] for r in rows], dtype=np.int64)
        credit = np.bincount(x[unasked], weights=weights[q[unasked]], minlength=len(self.ids)).astype(np.int64)
        partner = np.zeros(len(self.ids), dtype=np.int64)
        partner[x[unasked]] = ids[q[unasked]]
        credited = np.flatnonzero(credit)
        out += zip(self.ids[credited].tolist(), partner[credited].tolist(), credit[credited].tolist())
        lowest = np.full(len(ids), len(self.ids))
        np.minimum.at(lowest, q, self.root[x])
        apart = np.unique(np.stack([self.root[x], lowest[q]]), axis=1).T
        for a, b in apart[apart[:, 0] != apart[:, 1]].tolist():
            a, b = self._find(a), self._find(b)
            if a != b:
                self.root[max(a, b)] = min(a, b)
                out.append((int(self.ids[a]), int(self.ids[b]), 0))
        self.root = self.root[self.root]
        asking = np.flatnonzero(count)
        out += zip(ids[asking].tolist(), self.ids[lowest[asking]].tolist(), count[asking].tolist())
        return out

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            i = int(self.root[i])
        return i


def _search(dealt: DataFrame, quantiser: Quantiser, limit: float) -> DataFrame:
    """Answers of all blocks. Rows come sorted: a block's members, then those that ask it."""
    shared = dealt.sparkSession.sparkContext.broadcast(quantiser)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["a", "b", "links"])

        key, members, asking, block = None, [], [], None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[:2] != key:
                    if block and asking:
                        yield answer(block.ask(asking))
                    key, members, asking, block = row[:2], [], [], None
                if not row[2]:
                    members.append(row)
                    continue
                block = block or _Block(shared.value, row[0], members, limit)
                asking.append(row)
                if len(asking) == QUERY_CHUNK:
                    yield answer(block.ask(asking))
                    asking = []
        if block and asking:
            yield answer(block.ask(asking))

    partitions = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.repartition(partitions, "list", "block").sortWithinPartitions("list", "block", "asks")
        .select("list", "block", "asks", "vec_id", "weight", "unit", "codes", "missed", "own", "asked")
        .mapInArrow(search, "a long, b long, links long")
    )


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.9,
    margin: float = PROBE_MARGIN,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Links between vectors with cosine ``threshold`` or more, and their components.

    Returns per input row: ``vec_id`` (long), ``n_links`` (other vectors it links to),
    ``component_id`` (smallest id reachable), ``kept`` (it is that smallest). Vectors that are
    null, empty, zero, or hold null or non-finite components link with nothing; vectors of
    different lengths are never linked. Rows that repeat an id count as vectors of their own;
    a null id keeps its row and links with nothing.

    The quantiser of each vector length is fitted on at most ``SAMPLE_PER_LIST`` vectors per
    list and ``SAMPLE_BYTES`` in all, with about the square root of the number of distinct vectors
    as lists, ``MAX_LISTS`` at most. Beyond that lists grow and are split into blocks of about ``BLOCK_VECTORS``.
    """
    ship_package(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    prepared = stage(_prepared(rows), "units")
    heads = stage(
        prepared.where("digest IS NOT NULL AND vec_id IS NOT NULL").groupBy("size", "digest").agg(
            F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"), F.first("unit").alias("unit")),
        "heads")
    answers = None
    for found in heads.groupBy("size").agg(F.count("*").alias("n")).orderBy("size").collect():
        own = heads.where(F.col("size") == found["size"])
        lists = min(MAX_LISTS, math.ceil(math.sqrt(found["n"])))
        wanted = min(lists * SAMPLE_PER_LIST, max(1, SAMPLE_BYTES // (8 * found["size"])))
        sample = _sample(own, found["n"], wanted)
        units = np.frombuffer(b"".join(r["unit"] for r in sample.collect())).reshape(-1, found["size"])
        quantiser = fit(units, lists, margin)
        dealt = stage(_dealt(own, quantiser), "lists")
        blocks = dealt.where("NOT asks").groupBy("list").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("blocks"))
        place = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")))
        spread = dealt.join(F.broadcast(blocks), "list").withColumn("block", F.explode(place))
        part = _search(spread, quantiser, threshold)
        answers = part if answers is None else answers.union(part)
    if answers is None:
        return prepared.select(
            F.col("vec_id").alias(id_column), F.lit(0).cast("long").alias("n_links"),
            F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    answers = stage(answers, "links")
    counted = answers.where("links > 0").groupBy(F.col("a").alias("head")).agg(F.sum("links").alias("links"))
    classes = connected_components(answers.select("a", "b")).withColumnRenamed("node", "head")
    known = heads.select("digest", F.col("vec_id").alias("head"), "weight").join(counted, "head", "left").join(
        classes, "head", "left")
    component = F.coalesce("component", "head", "vec_id")
    valid = F.col("digest").isNotNull() & F.col("vec_id").isNotNull()
    return prepared.select("vec_id", "digest").join(known, "digest", "left").select(
        F.col("vec_id").alias(id_column),
        F.when(valid, F.coalesce("links", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).otherwise(0).alias("n_links"),
        F.when(valid, component).otherwise(F.col("vec_id")).alias("component_id"),
        F.coalesce(~valid | (component == F.col("vec_id")), F.lit(True)).alias("kept"),
    )
