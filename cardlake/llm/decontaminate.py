"""Benchmark decontamination: BM25 retrieval of test items for every training passage.

The test items are the documents of an inverted index, and every passage of the training
texts is a query. A score is the BM25 sum of the shared terms as a share of what the item
scores against itself, so one threshold fits items of any length. Retrieval is exact and
works like block-max WAND, for many passages at once: a passage whose sum of per-term
maxima stays below the threshold is skipped; then so is every block of items whose sum of
block maxima stays below; only what is left is scored. Retrieved items are verified on
the word order of their question and answer.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardlake.llm import hashing
from cardlake.llm.shipping import ship_package
from cardlake.session import stage

K1, B = 1.2, 0.75
BLOCK_ITEMS = 8
SHARD_ITEMS = 20_000
SHARD_BYTES = 32 << 20
LEAST_STRIDE = 64
GRAM = 4

# Words are runs of letters and digits.
NON_WORDS = hashing.NON_LETTERS.copy()
NON_WORDS[ord("0"):ord("9") + 1] = False

# A point within a number ends no sentence.
_LAST_SENTENCE = re.compile(r"(?s)^(.*(?:[?!\n]|(?<!\d)\.|\.(?!\d)))\s*(\S.*?)\s*$")
# Symbols before or within numbers are words, told apart by bytes that no UTF-8 text has.
_SYMBOLS = re.compile(rb"[-+*/=<>^%]+(?= *[0-9])|(?<=[0-9])\.(?=[0-9])")
_SYMBOL_BYTES = bytes.maketrans(b"-+*/=<>^%.", b"\xf8\xf9\xfa\xfb\xfc\xfd\xfe\xff\xc0\xc1")


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the last sentence or line answers; a single one is both."""
    match = _LAST_SENTENCE.match(text.rstrip().rstrip(".?!"))
    return (match[1], match[2]) if match and match[1].strip() else (text, text)


def _grams(words: np.ndarray) -> tuple[np.ndarray, int]:
    """Distinct runs of words, and how many words they have."""
    size = min(GRAM, len(words))
    return (np.unique(hashing.sequence_hashes(words, size)) if size else words), size


def _batch_words(group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and number symbols of a group of texts, and the bounds of each text."""
    marked = [_SYMBOLS.sub(lambda m: b" " + m[0].translate(_SYMBOL_BYTES) + b" ", text) for text in group]
    return hashing.batch_words(marked, NON_WORDS)[:2]


def _words(text: str) -> np.ndarray:
    return _batch_words([text.lower().encode("utf-8", "surrogatepass")])[0]


def _numeric(text: str) -> bool:
    """Whether a text has digits but no letters."""
    return any(c.isdigit() for c in text) and not any(c.isalpha() for c in text)


@dataclass
class ItemIndex:
    """Postings of one shard of items: term -> blocks with maxima -> items with weights.

    ``numbers`` tell the items apart; ``items`` are their ids, which may repeat or be null.
    """

    numbers: list[int]
    items: list[int | None]
    stride: int
    terms: np.ndarray
    likely: np.ndarray
    term_max: np.ndarray
    block_start: np.ndarray
    block_of: np.ndarray
    block_max: np.ndarray
    posting_start: np.ndarray
    posting_item: np.ndarray
    posting_weight: np.ndarray
    grams: list[tuple[tuple[np.ndarray, int], ...]]
    numeric: list[bool]


def build_index(
    items: list[tuple[int, str]], frequencies: dict[int, int], total: int, mean_length: float,
    ids: dict[int, int | None] | None = None,
) -> ItemIndex:
    """Index of a bounded list of (number, text); frequencies count the items of all shards.

    ``ids`` has the id of each number, where that is not the number itself.
    """
    rows = [(ids[number] if ids else number, text, _words(text), number) for number, text in items]
    rows = sorted((r for r in rows if len(r[2])), key=lambda r: (len(r[2]), r[0] is None, r[0] or 0, r[1]))
    owner, term, weight = [], [], []
    for place, (_, _, words, _) in enumerate(rows):
        unique, counts = np.unique(words, return_counts=True)
        known = np.array([frequencies.get(t, 1) for t in unique.tolist()], dtype=np.float64)
        idf = np.log1p((total - known + 0.5) / (known + 0.5))
        bm25 = idf * counts * (K1 + 1) / (counts + K1 * (1 - B + B * len(words) / mean_length))
        owner.append(np.full(len(unique), place))
        term.append(unique)
        weight.append(bm25 / bm25.sum())
    owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    term = np.concatenate(term) if term else np.zeros(0, np.uint64)
    weight = np.concatenate(weight) if weight else np.zeros(0)
    order = np.lexsort((owner, term))
    owner, term, weight = owner[order], term[order], weight[order]
    terms, first = np.unique(term, return_index=True)
    at = np.searchsorted(terms, term)
    new_block = np.ones(len(term), dtype=bool)
    new_block[1:] = (at[1:] != at[:-1]) | (owner[1:] // BLOCK_ITEMS != owner[:-1] // BLOCK_ITEMS)
    posting_start = np.append(np.flatnonzero(new_block), len(term))
    heads = posting_start[:-1]
    likely = np.zeros(1 << 20, dtype=bool)
    likely[(terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    split = [split_item(r[1]) for r in rows]
    return ItemIndex(
        numbers=[r[3] for r in rows], items=[r[0] for r in rows],
        stride=max([LEAST_STRIDE, *(len(r[2]) for r in rows)]),
        terms=terms, likely=likely,
        term_max=np.maximum.reduceat(weight, first) if len(term) else weight,
        block_start=np.searchsorted(at[heads], np.arange(len(terms) + 1)),
        block_of=owner[heads] // BLOCK_ITEMS,
        block_max=np.maximum.reduceat(weight, heads) if len(term) else weight,
        posting_start=posting_start, posting_item=owner, posting_weight=weight,
        grams=[(_grams(_words(q)), _grams(_words(a)), _grams(w)) for (q, a), (_, _, w, _) in zip(split, rows)],
        numeric=[_numeric(a) for _, a in split],
    )


def _expand(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of many ranges, with the number of the range each is from."""
    sizes = stops - starts
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes), owner


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    unique, place = np.unique(keys, return_inverse=True)
    return unique, np.bincount(place, weights=values, minlength=len(unique)), place


def retrieve(index: ItemIndex, window: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    """(window, item, score) of all scores from ``threshold``, for distinct (window, term)."""
    slack = threshold - 1e-9  # for the bounds, whose sums are rounded otherwise
    # Passages by the maxima of their terms.
    bound = np.bincount(window, weights=index.term_max[term])
    kept = bound[window] >= slack
    window, term = window[kept], term[kept]
    # Blocks of items by the maxima in the block.
    entry, pair = _expand(index.block_start[term], index.block_start[term + 1])
    blocks = int(index.block_of.max(initial=0)) + 1
    key = window[pair] * blocks + index.block_of[entry]
    _, block_bound, place = _sums(key, index.block_max[entry])
    kept = block_bound[place] >= slack
    entry, window = entry[kept], window[pair[kept]]
    # Items of the blocks that are left.
    posting, pair = _expand(index.posting_start[entry], index.posting_start[entry + 1])
    key = window[pair] * len(index.items) + index.posting_item[posting]
    unique, score, _ = _sums(key, index.posting_weight[posting])
    good = score >= threshold
    return unique[good] // max(1, len(index.items)), unique[good] % max(1, len(index.items)), score[good]


def _share(grams: np.ndarray, size: int, passage: np.ndarray) -> float:
    """Share of an item's runs of words that a passage has; none to look for: 0."""
    return float(np.isin(grams, hashing.sequence_hashes(passage, size)).mean()) if len(grams) else 0.0


def search(index: ItemIndex, texts: list, threshold: float, overlap: float) -> list[list[tuple]]:
    """Per text the verified items: (place in the index, first word, score, question and answer share)."""
    out: list[list[tuple]] = [[] for _ in texts]
    if not len(index.items):
        return out
    stride = index.stride
    lowered = [t.lower() if isinstance(t, str) else "" for t in texts]
    for first, group in hashing.chunks(lowered):
        words, bounds = _batch_words(group)
        at = np.flatnonzero(index.likely[(words & np.uint64((1 << 20) - 1)).astype(np.int64)])
        term = np.searchsorted(index.terms, words[at])
        term[term == len(index.terms)] = 0
        hit = index.terms[term] == words[at]
        at, term = at[hit], term[hit]
        if not len(at):
            continue
        owner = np.searchsorted(bounds, at, side="right") - 1
        strides = np.maximum(1, -(-np.diff(bounds) // stride))
        base = np.concatenate([[0], np.cumsum(strides)])
        # Passages of two strides overlap by one: no item is cut in both.
        step = (at - bounds[owner]) // stride
        window = np.concatenate([base[owner] + step, (base[owner] + step - 1)[step > 0]])
        pairs = np.unique(window * len(index.terms) + np.concatenate([term, term[step > 0]]))
        found = retrieve(index, pairs // len(index.terms), pairs % len(index.terms), threshold)
        for w, item, score in zip(*(x.tolist() for x in found)):
            text = int(np.searchsorted(base, w, side="right")) - 1
            begin = int(bounds[text]) + (w - int(base[text])) * stride
            passage = words[begin:min(begin + 2 * stride, int(bounds[text + 1]))]
            question, answer, whole = (_share(grams, size, passage) for grams, size in index.grams[item])
            if index.numeric[item] and answer < 1.0:
                continue
            if (question >= overlap and answer >= overlap) or whole >= (1 + overlap) / 2:
                out[first + text].append((item, begin - int(bounds[text]), score, question, answer))
    return out


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.5,
    overlap: float = 0.5,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``leaks``: the benchmark items that its passages hold.

    Each leak has ``item_id``, ``first_word`` (where the passage starts, in words), ``score``
    (the best BM25 share), ``question_overlap`` and ``answer_overlap`` (shares of word
    4-grams). Every distinct row of id and text is an item, rows without an id too; rows of one
    id that are found in a text are leaks of their own. An item is verified where both overlaps reach ``overlap``, or where the whole
    item's reaches halfway from there to 1; a question or answer without words has overlap 0,
    so there the whole item counts. An answer of numbers alone has to be in the passage
    whole in any case, as texts of one template differ in their numbers. Words are runs of letters
    and digits, and symbols before or within numbers. Null, empty and wordless texts and items match
    nothing. All columns pass through; one called ``leaks`` is replaced. Every text is searched
    whole, in overlapping passages that are long enough for any item of the shard.

    Items are indexed in shards of at most about ``SHARD_ITEMS`` items and ``SHARD_BYTES`` bytes, one
    broadcast and one narrow pass over ``docs`` each, with document frequencies of all items.
    """
    ship_package(docs.sparkSession)
    items = stage(benchmark.where(F.col(item_text_column).isNotNull()).select(
        F.col(item_column).cast("long").alias("item_id"), F.col(item_text_column).cast("string").alias("text")
    ).distinct().withColumn("number", F.monotonically_increasing_id()), "items")
    sizes = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    shards = max(1, math.ceil(sizes[0] / SHARD_ITEMS), math.ceil(sizes[1] / SHARD_BYTES))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, lengths = [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _words(text)
                unique = np.unique(words).view(np.int64).tolist()
                ids += [i] * len(unique)
                hashes += unique
                lengths += [len(words)] + [0] * (len(unique) - 1) if unique else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(lengths, pa.int64())],
                names=["number", "term", "length"])

    listed = items.select("number", "text").mapInArrow(terms, "number long, term long, length long")
    total, length = listed.agg(F.count_if(F.col("length") > 0), F.coalesce(F.sum("length"), F.lit(0))).first()
    frequency = listed.groupBy("term").agg(F.count("*").alias("n"))
    shard = F.pmod(F.xxhash64("number"), F.lit(shards))
    result = docs.withColumn("leaks", F.expr(
        "cast(array() as array<struct<item_id:bigint,first_word:bigint,score:double,question_overlap:double,answer_overlap:double>>)"))
    for number in range(shards):
        own = items.where(shard == number).collect()
        needed = listed.where(shard == number).select("term").distinct()
        counts = {r["term"] & (2**64 - 1): r["n"] for r in frequency.join(needed, "term").collect()}
        index = build_index(
            [(r["number"], r["text"]) for r in own], counts, total, max(1.0, length / max(1, total)),
            {r["number"]: r["item_id"] for r in own})
        result = result.withColumn("leaks", F.concat("leaks", _searcher(result, index, threshold, overlap)(
            F.col(text_column).cast("string"))))
    return result


def _searcher(docs: DataFrame, index: ItemIndex, threshold: float, overlap: float):
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("array<struct<item_id:bigint,first_word:bigint,score:double,question_overlap:double,answer_overlap:double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("item_id", "first_word", "score", "question_overlap", "answer_overlap")
        for texts in batches:
            found = search(shared.value, texts.tolist(), threshold, overlap)
            best = []
            for rows in found:  # overlapping passages may hold an item twice
                kept: dict[int, tuple] = {}
                for row in rows:
                    if row[0] not in kept or (row[2], -row[1]) > (kept[row[0]][2], -kept[row[0]][1]):
                        kept[row[0]] = row
                ids = shared.value.items
                order = sorted(kept, key=lambda i: (ids[i] is None, ids[i] or 0, i))
                best.append([dict(zip(names, (ids[i], *kept[i][1:]))) for i in order])
            yield pd.Series(best, dtype=object)

    return run.asNondeterministic()  # else it runs a second time for a filter on the leaks
