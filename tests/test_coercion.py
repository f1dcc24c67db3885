"""Cleaning rules against pandas on thousands of random texts."""

from __future__ import annotations

import math
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from cardlake.functions import columns as C
from cardlake.sources import landing

CASES = 4000


def texts(alphabet, longest, seed):
    generator = random.Random(seed)
    return sorted({
        "".join(generator.choice(alphabet) for _ in range(generator.randint(0, longest)))
        for _ in range(CASES)
    })


def evaluate(spark, data, schema, *expressions):
    return spark.createDataFrame(data, schema).select(*expressions).collect()


def test_money_equals_pandas(spark):
    data = texts("0123456789.,$-+eE_d \t", 8, 1) + ["nan", "None", "1e3", "$1,2.5", " 7 "]
    cleaned = (
        pd.Series(data, dtype="string").str.replace("$", "", regex=False)
        .str.replace(",", "", regex=False).str.strip()
    )
    wanted = pd.to_numeric(cleaned, errors="coerce").astype("float64")
    found = evaluate(spark, [(v,) for v in data], "v string", C.parse_money(F.col("v")))
    for text, want, (got,) in zip(data, wanted, found):
        if math.isnan(want):
            assert got is None, text
        elif abs(want) < 1e14:  # beyond that the decimal type ends
            assert got is not None and abs(float(got) - want) <= 5.1e-5, text


def test_time_of_day_equals_pandas(spark):
    data = texts("0123456789:", 5, 2) + texts("012:", 5, 3) + [" 9:05 ", "9:05:00", "24:00"]
    stripped = pd.Series(data, dtype="string").str.strip()
    wanted = pd.to_datetime("2024-02-29 " + stripped, format="%Y-%m-%d %H:%M", errors="coerce")
    found = evaluate(
        spark, [(v,) for v in data], "v string",
        C.assemble_timestamp(F.lit(2024), F.lit(2), F.lit(29), F.col("v")),
    )
    for text, want, (got,) in zip(data, wanted, found):
        assert (got is None) == pd.isna(want), text
        assert got is None or got == want.to_pydatetime(), text


def test_calendar_days_equal_pandas(spark):
    generator = random.Random(4)
    data = [
        (generator.randint(1700, 2200), generator.randint(-1, 14), generator.randint(-1, 33))
        for _ in range(CASES)
    ]
    parts = pd.DataFrame(data, columns=["y", "m", "d"]).astype("string")
    wanted = pd.to_datetime(
        parts["y"].str.zfill(4) + "-" + parts["m"].str.zfill(2) + "-" + parts["d"].str.zfill(2)
        + " 10:00", format="%Y-%m-%d %H:%M", errors="coerce",
    )
    found = evaluate(
        spark, data, "y bigint, m bigint, d bigint",
        C.assemble_timestamp(F.col("y"), F.col("m"), F.col("d"), F.lit("10:00")),
    )
    for row, want, (got,) in zip(data, wanted, found):
        assert (got is None) == pd.isna(want), row
        assert got is None or got == want.to_pydatetime(), row


@pytest.mark.parametrize("rule, data_type", [
    (C.strip_text, None), (lambda c: C.zip_text(c, T.StringType()), None)])
def test_stripping_equals_python(spark, rule, data_type):
    data = texts("ab \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85     　é", 6, 5)
    found = evaluate(spark, [(v,) for v in data], "v string", rule(F.col("v")))
    assert [got for (got,) in found] == [text.strip() for text in data]


def test_number_pattern_equals_pandas(spark):
    """The per-file check counts as numbers what a CSV reader would take for numbers."""
    data = [
        v for v in texts("0123456789.-+eE_dfx ", 6, 6)
        if v.strip() == v and v and not re.search(r"[eE]\+?\d{3}", v)  # beyond float64
    ]
    found = evaluate(spark, [(v,) for v in data], "v string",
                     F.col("v").rlike(landing._NUMBER))
    wanted = pd.to_numeric(pd.Series(data, dtype="object"), errors="coerce").notna()
    differ = [v for v, want, (got,) in zip(data, wanted, found) if got != want]
    assert differ == []


def test_null_words_equal_pandas(spark, tmp_path):
    words = [*C.NULL_WORDS, "none", "NULLS", "n/A", "0", "-", "#N/A#"]
    (tmp_path / "a.csv").write_text("v,w\n" + "".join(f"{word},x\n" for word in words))
    wanted = pd.read_csv(tmp_path / "a.csv")["v"].isna().tolist()
    scanned = landing.scan(spark, [str(tmp_path / "a.csv")], ["v", "w"])
    assert [row["v"] is None for row in scanned.orderBy("_row").collect()] == wanted


def test_quotients_are_rounded_once(spark):
    from decimal import ROUND_HALF_UP, Decimal, localcontext

    pairs = [(100, 20001), (1, 8), (-1, 8), (1, -8), (5, 1000), (4999999, 10**9), (0, 7), (7, 0), (10**15, 3),
             (1, 3), (2, 3), (-2005, 1000), (123456789012345, 1000)]
    found = spark.createDataFrame(pairs, "n bigint, d bigint").select(
        "n", "d", C.quotient2(F.col("n"), F.col("d")).alias("q")).collect()
    for row in found:
        if not row["d"]:
            assert row["q"] is None
            continue
        with localcontext() as context:
            context.prec = 60
            wanted = (Decimal(row["n"]) / Decimal(row["d"])).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert row["q"] == wanted, row


def test_near_whole_text_is_no_id(spark):
    texts = ["3", "3.0", " 3. ", "+3", "-3.000", "3.0000001", "0.0000001", "3.5", "1e3", "x", "", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(
        C.parse_int64(F.col("t"), T.StringType()).alias("v")).collect()
    assert [row["v"] for row in found] == [3, 3, 3, 3, -3, None, None, None, None, None, None, None]
