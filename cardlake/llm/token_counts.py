"""Token counts of every prefix of a text, by dynamic programming over its bytes.

The encoding of a byte string under a byte-pair vocabulary is the one token sequence in
which every neighbouring pair is stable (encoding the two together gives them back). So
the last token of each prefix follows from the last tokens of shorter prefixes, and

    count[i] = count[i - len(last token)] + 1.

Texts are cut into units (white space with the token group behind it) whose counts do not
depend on what stands before them. A unit's counts are kept as one signed byte per text
byte, the change against the prefix that is one byte shorter; the counts of a whole text
are the concatenation, as large as the text. Any truncation or budget question is a
running sum over it: nothing is encoded again.

A prefix that ends inside a UTF-8 character counts as the one before that character.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardlake.llm.shipping import ship_package

# How byte-level vocabularies split text before merging (fixed value, published pattern).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space with what it can influence: the group behind it. A contraction is one only
# where no blank stands before its apostrophe.
UNIT = r"\s*(?<! )(?:'s|'t|'re|'ve|'m|'ll|'d)|\s*(?:\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)|\s+"

CACHED_PIECES = 800_000
CACHED_UNITS = 100_000
CACHED_PAIRS = 2_000_000


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabulary files use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter(dict):
    """Maps what stands between blanks to the count changes of a blank and it.

    Changes are one signed byte per UTF-8 byte. Filled on demand, with a bounded size.
    """

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        letters = _byte_letters()
        special = [x["content"] for x in stored["added_tokens"]]
        names = {k: v for k, v in stored["model"]["vocab"].items() if k not in special}
        self.ids = {bytes(letters[c] for c in k): v for k, v in names.items()}
        self.longest = max(map(len, self.ids))
        self.tokens = {v: k for k, v in self.ids.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        # Of each token the rank of its merge and the two parts; bytes come from no merge.
        self.made = {t: (-1, t, t) for b, t in self.ids.items() if len(b) == 1}
        for rank, pair in enumerate(stored["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[names[a], names[b]] = rank, names[a + b]
            self.made.setdefault(names[a + b], (rank, names[a], names[b]))
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.units = regex.compile(UNIT).findall
        self.beside_blank = regex.compile(r" (?:\s|$)|\s ").search
        self.known_units: dict[str, bytes] = {}
        self.stable: dict[tuple[int, int], bool] = {}
        self.reachable = {b: t for b, t in self.ids.items() if self._encode(b) == [t]}

    def _encode(self, data: bytes) -> list[int]:
        """Plain merging, lowest rank first; used for one or two tokens only."""
        parts = [self.ids[data[i:i + 1]] for i in range(len(data))]
        while len(parts) > 1:
            found = min(
                ((self.merges[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.merges),
                default=None,
            )
            if found is None:
                break
            (_, merged), at = found
            parts[at:at + 2] = [merged]
        return parts

    def _is_stable(self, left: int, right: int) -> bool:
        """Whether encoding the two tokens' bytes together gives the two tokens.

        Undoes the later of the merges that made the two, step by step. While two parts
        stood side by side, a merge of them of a lower rank than the next merge that
        happened would have crossed the border. Equal ranks merge from the left.
        """
        if len(self.stable) >= CACHED_PAIRS:
            self.stable.clear()
        merges, made = self.merges, self.made
        x, y, before, crossed = left, right, math.inf, False
        while True:
            merge = merges.get((x, y))
            if merge is not None and merge[0] < before:
                crossed = True
                break
            rank_x, rank_y = made[x][0], made[y][0]
            if rank_x < 0 and rank_y < 0:
                break
            if rank_x > rank_y:
                before, x = rank_x, made[x][2]
            else:
                before, y = rank_y + 1, made[y][1]
        self.stable[left, right] = not crossed
        return not crossed

    def group_counts(self, data: bytes) -> list[int]:
        """Tokens of every prefix of one token group, the empty prefix first."""
        last, counts = [-1], [0]
        find, known = self.reachable.get, self.stable.get
        longest, size = self.longest, len(data)
        for end in range(1, size + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = find(data[start:end])
                if token is None:
                    continue
                if start:
                    left = last[start]
                    stable = known((left, token))
                    if stable is None:
                        stable = self._is_stable(left, token)
                    if not stable:
                        continue
                last.append(token)
                counts.append(counts[start] + 1)
                break
        return counts

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHED_PIECES:
            self.clear()
        if piece.isalpha():
            data = b" " + piece.encode()
            found = self._steps(data, self.group_counts(data))
        else:
            found = b"".join([
                self[unit[1:]] if unit[0] == " " and unit[1:].isalpha() else self.unit_steps(unit)
                for unit in self.units(" " + piece)
            ])
        self[piece] = found
        return found

    @staticmethod
    def _steps(data: bytes, counts: list[int]) -> bytes:
        """Differences of the counts; nothing changes inside a character."""
        if data.isascii():
            return bytes([(b - a) & 0xFF for a, b in zip(counts, counts[1:])])
        steps, shown = bytearray(), 0
        for i in range(1, len(data) + 1):
            now = shown if i < len(data) and data[i] & 0xC0 == 0x80 else counts[i]
            steps.append((now - shown) & 0xFF)
            shown = now
        return bytes(steps)

    def unit_steps(self, unit: str) -> bytes:
        found = self.known_units.get(unit)
        if found is None:
            if len(self.known_units) >= CACHED_UNITS:
                self.known_units.clear()
            found = self.known_units[unit] = self._steps(unit.encode(), self._unit_counts(unit))
        return found

    def _unit_counts(self, unit: str) -> list[int]:
        core = unit.lstrip()
        gap, data = unit[:len(unit) - len(core)], core.encode()
        if gap == " " and core:
            return self.group_counts(b" " + data)
        if core in ("'re", "'ve", "'ll"):  # cut short, these are an apostrophe and a letter
            counts = [0, 1, 2, self.group_counts(data)[-1]]
        else:
            counts = self.group_counts(data)
        if not gap:
            return counts
        alone = self.group_counts(gap.encode())
        if not core:
            return alone
        before = alone[len(gap[:-1].encode())]
        if gap[-1] == " ":
            return alone + [before + n for n in self.group_counts(b" " + data)[2:]]
        before += self.group_counts(gap[-1].encode())[-1]
        return alone + [before + n for n in counts[1:]]

    def _plain(self, text: str) -> bytes:
        """The count changes of text without special strings."""
        if self.beside_blank(text):  # longer white space: units, not pieces between blanks
            return b"".join(map(self.unit_steps, self.units(text)))
        first, *pieces = text.split(" ")
        head = b"".join(map(self.unit_steps, self.units(first)))
        return head + b"".join(map(self.__getitem__, pieces))

    def prefixes(self, text: str) -> bytes:
        """The count changes of a whole text; special strings in it are single tokens."""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        out, at = [], 0
        for match in self.special.finditer(text):
            before, special = text[at:match.start()], match.group()
            units = self.units(before)
            tail = units[-1] if units else ""
            size = len(tail.encode())
            # Cut short, the special string is ordinary text behind the last unit.
            joined = self._signed(self._plain(tail + special)).tolist()
            steps = joined[size:-1]
            if tail:  # what the tail counts in this company, less what it counts alone
                steps[0] += sum(joined[:size]) - sum(self._signed(self.unit_steps(tail)).tolist())
            steps.append(1 - sum(steps))
            out += [self._plain(before), bytes(x & 0xFF for x in steps)]
            at = match.end()
        out.append(self._plain(text[at:]))
        return b"".join(out)

    @staticmethod
    def _signed(steps: bytes) -> np.ndarray:
        return np.frombuffer(steps, dtype=np.int8)


def counts_at_bytes(steps: bytes) -> np.ndarray:
    """Token count at every byte prefix, the empty prefix first."""
    out = np.zeros(len(steps) + 1, dtype=np.int64)
    np.cumsum(np.frombuffer(steps, dtype=np.int8), dtype=np.int64, out=out[1:])
    return out


def bytes_within(text: bytes, steps: bytes, budget: int) -> int:
    """Length of the longest prefix of whole characters with at most ``budget`` tokens."""
    counts = counts_at_bytes(steps)
    fits = np.flatnonzero(counts <= budget)
    at = int(fits[-1])
    while 0 < at < len(text) and text[at] & 0xC0 == 0x80:
        at -= 1
    return at


_COUNTERS: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_token_counts(
    docs: DataFrame,
    vocabulary: str,
    budget: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_prefixes: bool = True,
) -> DataFrame:
    """Exact token counts of every document and of all its prefixes.

    ``vocabulary`` is the path of a byte-level ``.json`` vocabulary that all executors
    have. Returns ``id_column``, ``n_bytes``, ``n_tokens``, ``budget_bytes`` (the longest
    prefix of whole characters with at most ``budget`` tokens) and, with
    ``keep_prefixes``, ``prefix_steps`` (see ``counts_at_bytes``).

    A null text counts as empty: 0 bytes, 0 tokens. Ids are passed on as they are, null
    and repeated ones too. One narrow pass without a shuffle; memory per task is one batch
    of texts and two caches of fixed size.
    """
    ship_package(docs.sparkSession)
    id_type = docs.schema[id_column].dataType
    fields = {"n_bytes": "long", "n_tokens": "long", "budget_bytes": "long"}
    if keep_prefixes:
        fields["prefix_steps"] = "binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            sizes, totals, within, kept = [], [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                data = text.encode()
                steps = counter.prefixes(text)
                total = int(np.frombuffer(steps, dtype=np.int8).sum(dtype=np.int64))
                sizes.append(len(data))
                totals.append(total)
                # A count never shrinks by a whole budget: short texts need no search.
                within.append(len(data) if len(data) <= budget else bytes_within(data, steps, budget))
                if keep_prefixes:
                    kept.append(steps)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()),
                       pa.array(within, pa.int64())]
            if keep_prefixes:
                columns.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["id", *fields])

    schema = f"id {id_type.simpleString()}, " + ", ".join(f"{k} {v}" for k, v in fields.items())
    return (
        docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
        .mapInArrow(count, schema)
        .withColumnRenamed("id", id_column)
    )
