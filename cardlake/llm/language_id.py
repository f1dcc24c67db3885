"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed character n-grams (1 to 4 letters within words), weighted by
TF-IDF and scaled to length one. Per language a few centroids are clustered (spherical
k-means) on a bounded labelled sample; a text gets the language of the centroid with the
largest cosine, and is rejected where that cosine is far below what training texts of the
language with as many distinct n-grams reach. Short texts have few n-grams and so small
cosines; random letters and foreign text stay below clean text at every length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from cardlake.llm import hashing
from cardlake.llm.naming import unused
from cardlake.llm.shipping import ship_package

FEATURES = 1 << 13
GRAM_LETTERS = (1, 2, 3, 4)
UNKNOWN = "und"
# Runs of so many words of a training text show what short texts reach.
PIECE_WORDS = (1, 2, 4, 8, 16, 32, 64, 128)
CLASS_EDGES = np.append(0.0, 2.0 ** np.arange(4.0, 13.5, 0.5))
CLASS_PIECES = 20

_GAPS = re.compile(r"[\W\d_]+")


def text_vector(text: str) -> np.ndarray | None:
    """Counts of hashed character n-grams of a whole text; None without letters.

    Case, digits and punctuation do not matter; word borders count as a character.
    """
    letters = _GAPS.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, letters)):  # numerals such as fractions are no letters
        return None
    counts = np.zeros(FEATURES, dtype=np.int64)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    # Windows meet in the three characters that n-grams reach over.
    for low in range(0, len(codes), hashing.WINDOW_BYTES):
        piece = codes[max(0, low - GRAM_LETTERS[-1] + 1):low + hashing.WINDOW_BYTES].astype(np.uint64)
        new = len(piece) - (low - max(0, low - GRAM_LETTERS[-1] + 1))
        blank = piece == 32
        value = np.zeros(len(piece), dtype=np.uint64)
        for size in range(1, GRAM_LETTERS[-1] + 1):
            # value[i] covers the n-gram that ends at i + size - 1
            value = value[:len(piece) - size + 1] * np.uint64(0x100000001B3) + piece[size - 1:]
            grams = value
            if size == 1:
                inside = ~blank
            else:  # no blank but at either end
                inside = np.ones(len(grams), dtype=bool)
                for k in range(1, size - 1):
                    inside &= ~blank[k:k + len(grams)]
                if size == 2:
                    inside &= ~(blank[:len(grams)] & blank[1:])
            first_new = max(0, len(grams) - new)
            kept = grams[first_new:][inside[first_new:]]
            slots = hashing.mix(kept + np.uint64(size)) & np.uint64(FEATURES - 1)
            counts += np.bincount(slots.astype(np.int64), minlength=FEATURES)
    return counts


@dataclass
class LanguageModel:
    """Inverse document frequencies, and per centroid its vector, language and limits.

    ``limits`` has per centroid the numbers of distinct n-grams (as logarithms) and the least
    cosines there; between them limits are interpolated.
    """

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    limits: list[tuple[np.ndarray, np.ndarray]]

    def classify(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid and its cosine, per row of counts."""
        weighted = weigh(vectors, self.idf)
        if not len(self.languages):
            return np.zeros(len(vectors), dtype=np.int64), np.zeros(len(vectors))
        cosines = weighted @ self.centroids.T
        best = cosines.argmax(axis=1)
        return best, np.clip(cosines[np.arange(len(best)), best].astype(np.float64), 0.0, 1.0)

    def limit(self, centroid: int, vector: np.ndarray) -> float:
        """The least cosine of a text with these counts that is not rejected."""
        return float(np.interp(np.log(max(1, np.count_nonzero(vector))), *self.limits[centroid]))


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length one; sublinear in the counts."""
    weights = np.log1p(counts).astype(np.float32) * idf
    return weights / np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-9)


@dataclass
class _Sparse:
    """Rows of weights of length one: the slots they use, and where each row starts.

    No row is empty. Dense copies of a sample would not fit a driver; these are a few
    thousand entries a row.
    """

    slots: np.ndarray
    weights: np.ndarray
    starts: np.ndarray

    @classmethod
    def weighed(cls, slots: np.ndarray, logarithms: np.ndarray, starts: np.ndarray, idf: np.ndarray) -> _Sparse:
        weights = logarithms * idf[slots]
        norms = np.sqrt(np.add.reduceat(weights * weights, starts)) if len(starts) else np.zeros(0)
        sizes = np.diff(starts, append=len(slots))
        return cls(slots, weights / np.repeat(np.maximum(norms, 1e-9), sizes).astype(np.float32), starts)

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts, append=len(self.slots))

    def rows(self, chosen: np.ndarray) -> _Sparse:
        """The rows for which ``chosen`` (one truth value a row) holds."""
        sizes = self.sizes
        inside = np.repeat(chosen, sizes)
        return _Sparse(self.slots[inside], self.weights[inside], np.cumsum(sizes[chosen]) - sizes[chosen])

    def times(self, vector: np.ndarray) -> np.ndarray:
        """Products of every row with a dense vector."""
        return np.add.reduceat(self.weights * vector[self.slots], self.starts)

    def cosines(self, centres: np.ndarray) -> np.ndarray:
        return np.stack([self.times(c) for c in centres], axis=1)

    def total(self, chosen: np.ndarray) -> np.ndarray:
        inside = np.repeat(chosen, self.sizes)
        return np.bincount(self.slots[inside], self.weights[inside], FEATURES)

    def dense(self, row: int) -> np.ndarray:
        part = slice(self.starts[row], self.starts[row] + self.sizes[row])
        return np.bincount(self.slots[part], self.weights[part], FEATURES).astype(np.float32)


def _clusters(vectors: _Sparse, wanted: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread-out first centres; empty clusters vanish."""
    centres = vectors.dense(0)[None, :]
    while len(centres) < min(wanted, len(vectors.starts)):
        nearest = vectors.cosines(centres).max(axis=1)
        centres = np.vstack([centres, vectors.dense(int(nearest.argmin()))])
    for _ in range(rounds):
        owner = vectors.cosines(centres).argmax(axis=1)
        sums = np.stack([vectors.total(owner == k) for k in range(len(centres)) if (owner == k).any()])
        centres = (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    return centres


def pieces(text: str, place: int) -> list[str]:
    """Runs of 1 to 128 words of a text, one of each length, from a place that is a hash."""
    words = _GAPS.sub(" ", text).split()
    starts = np.random.default_rng(place & (2**63 - 1)).random(len(PIECE_WORDS))
    return [" ".join(words[(low := int(x * (len(words) - n + 1))):low + n])
            for n, x in zip(PIECE_WORDS, starts) if n < len(words)]


def _medians(sizes: np.ndarray, cosines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Median cosines over classes of distinct n-grams, at the middle of each class.

    Classes with fewer than ``CLASS_PIECES`` members are left out, unless all are so small.
    """
    classes = np.digitize(sizes, CLASS_EDGES)
    held, counts = np.unique(classes, return_counts=True)
    enough = held[counts >= CLASS_PIECES]
    groups = [classes == k for k in enough] if len(enough) else [np.ones(len(sizes), dtype=bool)]
    return (np.array([np.log(np.median(sizes[g])) for g in groups]), np.array([np.median(cosines[g]) for g in groups]))


def fit(
    labelled: DataFrame,
    per_language: int = 400,
    centroids: int = 4,
    reject_share: float = 0.45,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    sample_texts: int = 4000,
    max_languages: int = 500,
) -> LanguageModel:
    """Fits centroids on at most about ``per_language`` labelled texts of each language.

    The sample is drawn by a hash of the id, the same at every run. Rows with null or
    letterless text or null language take no part. The limits of a language are ``reject_share``
    times the median cosine of its training texts and of runs of their words, per class of
    distinct n-grams. Either half of the texts is measured with centroids of the other half,
    so that limits hold for unseen texts.

    Bounds of the driver: of many languages the ``max_languages`` with the most texts are learned
    (equal numbers in order of name), from about ``sample_texts`` texts together. A text and its
    runs bring up to ``FEATURES`` entries of 6 bytes each, and one language at a time is clustered.
    """
    ship_package(labelled.sparkSession)
    rows = labelled.where(F.col(text_column).isNotNull() & F.col(language_column).isNotNull()).select(
        F.xxhash64(F.col(id_column).cast("string")).alias("place"),
        F.col(text_column).cast("string").alias("text"), F.col(language_column).cast("string").alias("lang"))
    totals = {
        r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    }
    if not totals:
        return LanguageModel(np.zeros(FEATURES, np.float32), np.zeros((0, FEATURES), np.float32), [], [])
    wanted = min(per_language, sample_texts / len(totals))
    shares = F.create_map(*[F.lit(x) for language, n in totals.items() for x in (language, min(1.0, wanted / n))])
    drawn = rows.where(F.pmod("place", F.lit(1 << 20)) < F.coalesce(shares[F.col("lang")], F.lit(0.0)) * (1 << 20))

    def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, spoken, whole, slots, logarithms = [], [], [], [], []
            for place, text, language in zip(*(c.to_pylist() for c in batch.columns)):
                for number, part in enumerate([text, *pieces(text, place)]):
                    vector = text_vector(part)
                    if vector is None:
                        continue
                    used = np.flatnonzero(vector)
                    places.append(place)
                    spoken.append(language)
                    whole.append(number == 0)
                    slots.append(used.astype(np.uint16).tobytes())
                    logarithms.append(np.log1p(vector[used]).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int64()), pa.array(spoken, pa.string()), pa.array(whole, pa.bool_()),
                 pa.array(slots, pa.binary()), pa.array(logarithms, pa.binary())],
                names=["place", "lang", "whole", "slots", "logarithms"])

    found = drawn.select("place", "text", "lang").mapInArrow(
        vectorise, "place long, lang string, whole boolean, slots binary, logarithms binary").toArrow()
    found = found.sort_by([(name, "ascending") for name in ("lang", "place", "whole", "slots", "logarithms")])

    def entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slots, logarithms = (table.column(name).to_pylist() for name in ("slots", "logarithms"))
        sizes = np.array([len(x) // 2 for x in slots], dtype=np.int64)
        return (np.frombuffer(b"".join(slots), dtype=np.uint16), np.frombuffer(b"".join(logarithms), dtype=np.float32),
                np.cumsum(sizes) - sizes)

    sample = found.filter(found.column("whole"))
    present = np.zeros(FEATURES, dtype=np.int64)
    for part in sample.column("slots"):
        present += np.bincount(np.frombuffer(part.as_py(), dtype=np.uint16), minlength=FEATURES)
    idf = np.log((1 + len(sample)) / (1 + present)).astype(np.float32) + np.float32(1)
    kept, languages, limits, measured = [], [], [], None
    for language in sorted(set(sample.column("lang").to_pylist())):
        measured = found.filter(pc.equal(found.column("lang"), language))
        vectors = _Sparse.weighed(*entries(measured), idf)
        whole = measured.column("whole").to_numpy(zero_copy_only=False)
        odd = (measured.column("place").to_numpy() & 1).astype(bool)
        own, half = vectors.rows(whole), odd[whole]
        centres = _clusters(own, centroids)
        others = [_clusters(own.rows(half != side), centroids) if (half != side).any() else centres for side in (False, True)]
        even_reach, odd_reach = (vectors.cosines(c).max(axis=1) for c in others)
        at, medians = _medians(vectors.sizes, np.where(odd, odd_reach, even_reach))
        kept.append(centres)
        languages += [language] * len(centres)
        limits += [(at, reject_share * medians)] * len(centres)
    del found, sample, measured
    pa.default_memory_pool().release_unused()  # the driver needs the memory for later stages
    return LanguageModel(
        idf, np.concatenate(kept) if kept else np.zeros((0, FEATURES), np.float32), languages, limits)


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_nearest``, ``lang_score`` (cosine, 0 to 1) and ``lang_rejected``.

    Null, empty and letterless texts get ``und``, score 0, rejected. Where the cosine is below
    the limit the nearest language is still named but the text is rejected. All columns of
    ``docs`` pass through; those called like a new one are replaced. One narrow pass without
    a shuffle, on whole texts.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<language: string, score: double, rejected: boolean>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for texts in batches:
            out = [(UNKNOWN, 0.0, True)] * len(texts)
            for low in range(0, len(texts), 256):
                found = [(i, v) for i in range(low, min(low + 256, len(texts)))
                         if isinstance(texts.iloc[i], str) and (v := text_vector(texts.iloc[i])) is not None]
                if not found or not known.languages:
                    continue
                best, score = known.classify(np.stack([v for _, v in found]))
                for (i, v), k, s in zip(found, best.tolist(), score.tolist()):
                    out[i] = known.languages[k], s, s < known.limit(k, v)
            yield pd.DataFrame(out, columns=["language", "score", "rejected"])

    name = unused(docs.columns, "language")
    # Called nondeterministic, it is not run a second time for a filter on its result.
    result = docs.withColumn(name, predict.asNondeterministic()(F.col(text_column).cast("string")))
    return result.withColumns({
        "lang_nearest": F.col(name)["language"], "lang_score": F.col(name)["score"],
        "lang_rejected": F.col(name)["rejected"],
    }).drop(name)


def held_out(id_column: Column, folds: int, fold: int) -> Column:
    """Whether a row belongs to the fold that is kept from training."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string")), F.lit(folds)) == fold, F.lit(False))
