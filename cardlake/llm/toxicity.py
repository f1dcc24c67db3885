"""Toxicity scores from a factorisation machine over hashed terms.

The terms of a text are its distinct words and leading parts of its longer words. Beside a
weight per term the machine learns a short vector per term; the products of the vectors of
two terms that occur together, such as an insult and the mention of a group, add what no
sum of single weights can. In a text of n terms a product counts 1/n, so that long texts do
not drown in products.

    score = sigmoid(w0 + sum w_i + 1/(2n) sum_f ((sum v_if)^2 - sum v_if^2))

Every term with minimal support is a feature of both parts. Weights are fitted first, under a
penalty that follows each term's frequency; then weights and vectors together, for as long as
texts held back from that fit gain by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardlake.llm import hashing
from cardlake.llm.shipping import ship_package

SLOTS = 1 << 20
LEADING_BYTES = (5, 7)


def _terms(group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all terms of a group of texts, with the text each belongs to."""
    words, bounds, leading = hashing.batch_words(group, hashing.NON_LETTERS, prefixes=LEADING_BYTES)
    owner = np.repeat(np.arange(len(group)), np.diff(bounds))
    slots, owners = [words], [owner]
    for part in leading:
        present = part != 0
        slots.append(part[present])
        owners.append(owner[present])
    mask = np.uint64(SLOTS - 1)
    return (np.concatenate(slots) & mask).astype(np.int64), np.concatenate(owners)


def _lowered(texts: list) -> list[str]:
    return [t.lower() if isinstance(t, str) else "" for t in texts]


@dataclass
class FactorizationMachine:
    """Parameters of the known terms; ``feature`` maps a slot to its row or to -1."""

    feature: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, starts: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Log-odds of texts from their features, those of text i from ``starts[i]`` on."""
        count = len(starts) - 1
        out = np.full(count, self.bias)
        for low, high in _blocks(starts):
            own = features[starts[low]:starts[high]]
            rows = np.repeat(np.arange(high - low), np.diff(starts[low:high + 1]))
            sizes = np.maximum(1, np.diff(starts[low:high + 1]))
            linear = np.bincount(rows, weights=self.weights[own], minlength=high - low)
            squares = np.zeros(high - low)
            for column in self.factors.T:
                values = column[own].astype(np.float64)
                squares += np.bincount(rows, weights=values, minlength=high - low) ** 2
                squares -= np.bincount(rows, weights=values**2, minlength=high - low)
            out[low:high] += linear + 0.5 * squares / sizes
        return out

    def score_texts(self, texts: list) -> np.ndarray:
        """Scores of whole texts; null and empty ones get the score of a text without terms."""
        out = np.empty(len(texts))
        size = max(1, len(self.weights))
        for first, group in hashing.chunks(_lowered(texts)):
            slots, owner = _terms(group)
            features = self.feature[slots]
            used = features >= 0
            pairs = np.unique(owner[used] * size + features[used]) if used.any() else np.zeros(0, np.int64)
            starts = np.searchsorted(pairs, np.arange(len(group) + 1) * size)
            out[first:first + len(group)] = _sigmoid(self.margins(starts, pairs % size))
        return out


# So many entries (text, feature) are worked on at a time.
BLOCK_ENTRIES = 1 << 18


def _blocks(starts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of texts with about ``BLOCK_ENTRIES`` entries; a longer text is a run of its own."""
    bounds, count = [0], len(starts) - 1
    while bounds[-1] < count:
        wanted = int(np.searchsorted(starts, starts[bounds[-1]] + BLOCK_ENTRIES, side="right")) - 1
        bounds.append(min(count, max(wanted, bounds[-1] + 1)))
    return list(zip(bounds, bounds[1:]))


def _sigmoid(margins: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margins, -60.0, 60.0)))


@dataclass
class _Sample:
    """Labelled texts as rows of features, and what each counts in the loss."""

    starts: np.ndarray
    features: np.ndarray
    labels: np.ndarray
    balance: np.ndarray

    @classmethod
    def of(cls, sizes: np.ndarray, features: np.ndarray, labels: np.ndarray) -> _Sample:
        """Either label counts half, whatever its share."""
        ones = max(1.0, labels.sum())
        balance = np.where(labels == 1, 0.5 / ones, 0.5 / max(1.0, len(labels) - ones))
        return cls(np.concatenate([[0], np.cumsum(sizes)]), features, labels, balance)

    def rows(self, chosen: np.ndarray) -> _Sample:
        sizes = np.diff(self.starts)
        return _Sample.of(sizes[chosen], self.features[np.repeat(chosen, sizes)], self.labels[chosen])

    def loss(self, margins: np.ndarray) -> float:
        return float((self.balance * np.logaddexp(0.0, np.where(self.labels == 1, -margins, margins))).sum())


RELAXED = 0.1


def _fit_weights(sample: _Sample, count: int, strength: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Bias and weights under a penalty on each weight's size.

    The penalty of a term is ``strength`` times the slope that chance alone would show for
    a term of its frequency. Most weights stay at zero; a set of terms whose slopes exceed
    their penalties grows until none is left out, and only that set is fitted. In the end the
    set is fitted again under ``RELAXED`` of the penalty, which shrinks what it keeps.
    """
    sizes = np.diff(sample.starts)
    entries = np.repeat(np.arange(len(sizes)), sizes)
    support = np.bincount(sample.features, minlength=count)
    chance = 0.5 * np.sqrt(support * np.mean(sample.balance**2))
    penalty = strength * chance
    bias, weights, active, settled = 0.0, np.zeros(count), np.zeros(count, dtype=bool), False
    while not settled:
        margins = bias + np.bincount(entries, weights=weights[sample.features], minlength=len(sizes))
        error = (_sigmoid(margins) - sample.labels) * sample.balance
        slope = np.bincount(sample.features, weights=error[entries], minlength=count)
        beyond = (np.abs(slope) > penalty * 1.01) & ~active
        settled = not beyond.any()
        if settled:
            active, penalty = weights != 0, RELAXED * penalty
        active |= beyond
        inside = active[sample.features]
        rows, own = entries[inside], sample.features[inside]
        # Steps by a bound of the curvature: a term meets the other active terms of its texts.
        together = 1.0 + np.bincount(rows, minlength=len(sizes))
        bound = 0.25 * np.bincount(own, weights=(sample.balance * together)[rows], minlength=count) + 1e-12
        bias_bound = 0.25 * (sample.balance * together).sum()
        ahead, ahead_bias, momentum = weights.copy(), bias, 1.0
        for _ in range(rounds):
            margins = ahead_bias + np.bincount(rows, weights=ahead[own], minlength=len(sizes))
            error = (_sigmoid(margins) - sample.labels) * sample.balance
            stepped = ahead - np.bincount(own, weights=error[rows], minlength=count) / bound
            stepped = np.sign(stepped) * np.maximum(np.abs(stepped) - penalty / bound, 0.0) * active
            stepped_bias = ahead_bias - error.sum() / bias_bound
            following = (1.0 + np.sqrt(1.0 + 4.0 * momentum**2)) / 2.0
            ahead = stepped + (momentum - 1.0) / following * (stepped - weights)
            ahead_bias = stepped_bias + (momentum - 1.0) / following * (stepped_bias - bias)
            moved = max(abs(stepped_bias - bias), float(np.abs(stepped - weights).max(initial=0.0)))
            weights, bias, momentum = stepped, stepped_bias, following
            if moved < 1e-5:
                break
    return float(bias), weights


def _fit_together(
    machine: FactorizationMachine, sample: _Sample, rounds: int, rate: float, patience: int,
    held_back: _Sample | None = None,
) -> tuple[int, float, FactorizationMachine]:
    """Weights and vectors by gradient steps (Adam) from a given machine.

    Returns the number of rounds after which the loss on ``held_back`` was least, that loss, and
    the machine then; without texts held back, all rounds are made.
    """
    count, sizes = len(machine.weights), np.diff(sample.starts)
    parameters = [np.array([machine.bias]), machine.weights.copy(), machine.factors.copy()]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    current = lambda: FactorizationMachine(machine.feature, float(parameters[0][0]), *[p.copy() for p in parameters[1:]])
    best = (0, held_back.loss(machine.margins(held_back.starts, held_back.features)), machine) if held_back else None
    for step in range(1, rounds + 1):
        now = FactorizationMachine(machine.feature, float(parameters[0][0]), parameters[1], parameters[2])
        error = (_sigmoid(now.margins(sample.starts, sample.features)) - sample.labels) * sample.balance
        slopes = [np.array([error.sum()]), np.zeros(count), np.zeros_like(parameters[2])]
        for low, high in _blocks(sample.starts):
            own = sample.features[sample.starts[low]:sample.starts[high]]
            rows = np.repeat(np.arange(high - low), sizes[low:high])
            pull = error[low:high][rows]
            slopes[1] += np.bincount(own, weights=pull, minlength=count)
            pull = pull / sizes[low:high][rows]
            for f in range(parameters[2].shape[1]):
                values = parameters[2][:, f][own]
                sums = np.bincount(rows, weights=values, minlength=high - low)
                slopes[2][:, f] += np.bincount(own, weights=pull * (sums[rows] - values), minlength=count)
        for parameter, (first, second), slope in zip(parameters, moments, slopes):
            first += 0.1 * (slope - first)
            second += 0.001 * (slope**2 - second)
            parameter -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        if held_back is not None:
            loss = held_back.loss(now.margins(held_back.starts, held_back.features))
            if loss < best[1]:
                best = step, loss, current()
            elif step - best[0] >= patience:
                break
    return best if held_back is not None else (rounds, 0.0, current())


def fit(
    labelled: DataFrame,
    docs: DataFrame,
    per_label: int = 6000,
    support: int = 4,
    factors: int = 6,
    rounds: int = 120,
    rate: float = 0.05,
    strength: float = 4.0,
    patience: int = 25,
    seed: int = 11,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> FactorizationMachine:
    """Fits a machine on at most ``per_label`` labelled rows of either label.

    ``labelled`` has ids and labels (0 or 1; others and null take no part). The sample is
    drawn by a hash of the id, so it is the same at every run. Either label counts half in the
    loss; the bias then gets the log-odds of the labels in all rows. All slots that ``support`` sampled texts have are features; none is selected by what
    it tells alone. A fifth of the sample is held back to find after how many rounds the
    vectors stop to help; where they never do, only the weights are kept and the vectors stay
    close to zero. The sampled ids (at most ``2 * per_label``) are broadcast; texts come back as
    slots of distinct terms, 4 bytes each, and are worked on in blocks. Without both labels the
    machine knows no terms and scores all texts alike.
    """
    ship_package(docs.sparkSession)
    known = labelled.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull()).groupBy(id_column).agg(
        F.max(label_column).alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    feature = np.full(SLOTS, -1, dtype=np.int32)
    if not counts.get(0) or not counts.get(1):
        share = min(max(counts.get(1, 0) / max(1, sum(counts.values())), 0.01), 0.99)
        return FactorizationMachine(feature, float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, factors)))
    place = F.xxhash64(F.col(id_column).cast("string"))
    drawn = None
    for label in (0, 1):
        some = known.where(F.col("label") == label).orderBy(place, id_column).limit(per_label)
        drawn = some if drawn is None else drawn.union(some)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = [b""] * batch.num_rows
            for first, group in hashing.chunks(_lowered(batch.column(1).to_pylist())):
                found, owner = _terms(group)
                pairs = np.unique(owner * SLOTS + found)
                starts = np.searchsorted(pairs, np.arange(len(group) + 1) * SLOTS)
                for i in range(len(group)):
                    slots[first + i] = (pairs[starts[i]:starts[i + 1]] % SLOTS).astype(np.int32).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(slots, pa.binary())],
                names=["place", "label", "slots"])

    sample = (
        docs.select(id_column, F.col(text_column).cast("string").alias("text"))
        .join(F.broadcast(drawn), id_column)
        .select(place.alias("place"), "text", F.col("label").cast("int"))
        .mapInArrow(extract, "place long, label int, slots binary")
        .toArrow().sort_by([("place", "ascending"), ("label", "ascending"), ("slots", "ascending")])
    )
    labels = sample.column("label").to_numpy().astype(np.float64)
    places = sample.column("place").to_numpy()
    found = [np.frombuffer(x, dtype=np.int32) for x in sample.column("slots").to_pylist()]
    seen = np.zeros(SLOTS, dtype=np.int64)
    for slots in found:  # the slots of a text are distinct
        seen[slots] += 1
    # With fewer texts than ``support`` every slot that all texts of a label have is a feature.
    chosen = np.flatnonzero(seen >= min(support, max(1, min(labels.sum(), len(labels) - labels.sum()))))
    feature[chosen] = np.arange(len(chosen), dtype=np.int32)
    found = [f[f >= 0] for f in (feature[slots] for slots in found)]
    sizes = np.array([len(f) for f in found], dtype=np.int64)
    whole = _Sample.of(sizes, np.concatenate(found) if found else np.zeros(0, np.int32), labels)
    del sample, seen, found
    pa.default_memory_pool().release_unused()

    random = np.random.default_rng(seed)
    small = random.normal(0.0, 0.1, (len(chosen), factors)).astype(np.float32)
    held_back = (places % 5) == 0
    bias, weights = _fit_weights(whole, len(chosen), strength)
    machine = FactorizationMachine(feature, bias, weights, small * np.float32(0.01))
    parts = [whole.rows(rows) for rows in (~held_back, held_back)]
    prior = float(np.log(counts[1] / counts[0]))  # of all labelled rows, not of the sample
    if all(0 < p.labels.sum() < len(p.labels) for p in parts):
        start = FactorizationMachine(feature, *_fit_weights(parts[0], len(chosen), strength), small)
        alone = parts[1].loss(FactorizationMachine(
            feature, start.bias, start.weights, small * np.float32(0.01)).margins(parts[1].starts, parts[1].features))
        steps, loss, _ = _fit_together(start, parts[0], rounds, rate, patience, parts[1])
        if steps and loss < 0.9 * alone:
            _, _, machine = _fit_together(
                FactorizationMachine(feature, bias, weights, small), whole, steps, rate, patience)
    machine.bias += prior
    return machine


def score(docs: DataFrame, machine: FactorizationMachine, text_column: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1), from the whole text; null counts as empty.

    All columns pass through; one called ``toxicity`` is replaced. One narrow pass without a
    shuffle; the machine (``SLOTS`` numbers and 36 bytes per known term) is broadcast.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score_texts(texts.tolist()), dtype="float64")

    return docs.withColumn("toxicity", predict(F.col(text_column).cast("string")))
