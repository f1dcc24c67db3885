"""Fill-in-the-middle examples, cut at borders of units that a skip list finds.

A text is a row of units (lines, unless another pattern is given). Its skip list links every
unit to the next; each lane above skips ``EXPRESS`` links of the one below. A link carries how
many units and how many code points it passes, so a walk from the top lane down reaches the
border after any number of units and knows the code points before it, exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cardlake.llm.naming import unused
from cardlake.llm.shipping import ship_package

# The marks before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
LINES = r"[^\n]*\n|[^\n]+"
EXPRESS = 16


class UnitSkipList:
    """The units of one text; ``lengths`` are their code points in order."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lanes = [(np.ones(len(lengths), dtype=np.int64), np.asarray(lengths, dtype=np.int64))]
        while len(self.lanes[-1][0]) > EXPRESS:
            units, points = self.lanes[-1]
            posts = np.arange(0, len(units), EXPRESS)
            self.lanes.append((np.add.reduceat(units, posts), np.add.reduceat(points, posts)))

    def __len__(self) -> int:
        return len(self.lanes[0][0])

    def code_points(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        link = passed = points = 0
        for units, widths in reversed(self.lanes):
            while link < len(units) and passed + units[link] <= rank:
                passed += int(units[link])
                points += int(widths[link])
                link += 1
            link *= EXPRESS  # the same place, one lane below
        return points


def unit_lengths(text: str, unit: re.Pattern) -> np.ndarray:
    """Code points of every unit. What no match covers belongs to the unit that ends after it;
    what follows the last match is a unit of its own."""
    ends = np.fromiter((m.end() for m in unit.finditer(text) if m.end() > m.start()), dtype=np.int64)
    if len(text) and (not len(ends) or ends[-1] < len(text)):
        ends = np.append(ends, len(text))
    return np.diff(ends, prepend=0)


def _check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """Marks must be found again without doubt wherever they are put between texts without them."""
    overlap = any(a[-n:] == b[:n] for a in sentinels for b in sentinels for n in range(1, min(len(a), len(b))))
    inside = any(a in b for i, a in enumerate(sentinels) for j, b in enumerate(sentinels) if i != j)
    if overlap or inside or not all(sentinels):
        raise ValueError(f"sentinels must be different and must not overlap: {sentinels}")


def fill_in_middle(
    docs: DataFrame,
    seed: int = 7,
    fim_percent: int = 100,
    spm_percent: int = 50,
    unit: str = LINES,
    sentinels: tuple[str, str, str] = SENTINELS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with the example made of every text.

    New columns: ``fim_units`` (long), ``fim_form`` (``plain``, ``psm`` or ``spm``),
    ``fim_prefix_chars`` and ``fim_middle_chars`` (code points; null if plain) and
    ``fim_output`` (the example). Input columns so called are replaced, others pass through.

    Both cuts, whether a text is transformed and the order of its parts come from the SHA-256
    of seed and id, so reruns agree; rows that repeat an id have the same draws, a null id
    counts as an empty one. Null texts count as empty; empty texts and texts that hold a
    sentinel stay plain, as do ``100 - fim_percent`` % of the others. One narrow pass; a task
    needs memory for one batch of texts and the unit lengths of one text.
    """
    _check_sentinels(sentinels)
    ship_package(docs.sparkSession)
    pattern = unit

    @F.pandas_udf("struct<units: long, prefix: int, middle: int>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        compiled = re.compile(pattern)
        for texts, first, second in batches:
            rows = []
            for text, a, b in zip(texts, first, second):
                found = UnitSkipList(unit_lengths(text, compiled))
                low, high = sorted((int(a) % (len(found) + 1), int(b) % (len(found) + 1)))
                prefix = found.code_points(low)
                rows.append((len(found), prefix, found.code_points(high) - prefix))
            yield pd.DataFrame(rows, columns=["units", "prefix", "middle"])

    name = unused(docs.columns, "fim_cut")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    draw = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    marked = text == ""
    for mark in sentinels:
        marked = marked | F.contains(text, F.lit(mark))
    form = (
        F.when(marked | (draw[2] % 100 >= fim_percent), "plain")
        .when(draw[3] % 100 < spm_percent, "spm").otherwise("psm")
    )
    found = F.col(name)
    prefix = F.substring(text, F.lit(1), found.prefix)
    middle = F.substring(text, found.prefix + 1, found.middle)
    suffix = F.substring(text, found.prefix + found.middle + 1, F.length(text))
    p, s, m = (F.lit(mark) for mark in sentinels)
    output = (
        F.when(form == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .when(form == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(text)
    )
    plain = form == "plain"
    return docs.withColumn(name, cut(text, draw[0], draw[1])).withColumns({
        "fim_units": found.units,
        "fim_form": form,
        "fim_prefix_chars": F.when(~plain, found.prefix.cast("long")),
        "fim_middle_chars": F.when(~plain, found.middle.cast("long")),
        "fim_output": output,
    }).drop(name)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an example was made of, from the example and its form alone."""
    parts = F.split(output, "|".join(f"\\Q{mark}\\E" for mark in sentinels))
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
    )
