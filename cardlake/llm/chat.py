"""Preference formatting: one prompt and two masked completions per pair of conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CHOSEN, REJECTED = "chosen", "rejected"


def _render(turns: Column, start: str, middle: str, end: str) -> Column:
    """All turns one after the other in the chat template."""
    one = lambda t: F.concat(F.lit(start), t["role"], F.lit(middle), t["text"], F.lit(end))
    return F.array_join(F.transform(turns, one), "")


def _trained_spans(turns: Column, roles: tuple[str, ...], start: str, middle: str, end: str) -> Column:
    """Character ranges [begin, end) of a rendered completion that the loss covers.

    Covered are texts of the trained roles with their end mark; headers and other roles
    are masked.
    """
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(turn["role"]) + len(start) + len(middle)
        stop = begin + F.length(turn["text"]) + len(end)
        span = F.array(F.struct(begin.alias("begin"), stop.alias("end")))
        return F.struct(
            stop.alias("at"),
            F.when(turn["role"].isin(*roles), F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(turns, zero, step)["spans"]


def format_preferences(
    turns: DataFrame,
    pair_column: str = "pair_id",
    side_column: str = "side",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    trained_roles: tuple[str, ...] = ("assistant",),
    start: str = "<|",
    middle: str = "|>\n",
    end: str = "<|end|>\n",
) -> DataFrame:
    """Formats pairs of conversations for preference training.

    ``turns`` has one row per pair, side (``chosen`` or ``rejected``) and turn. The longest
    common prefix of turns (equal role and text) is the prompt; the turns behind it are the
    completions. Returns one row per pair: ``pair_id``, ``prefix_turns``, ``prompt``,
    ``chosen``, ``rejected``, their ``*_spans`` (character ranges that are trained on; all
    else is masked), and ``status``:

    - ``pair``: both completions hold at least one trained turn;
    - ``same``: both sides are equal, so nothing is left to prefer;
    - ``one_sided``: a completion lacks a trained turn (a side that is missing, that is a
      prefix of the other, or that goes on with other roles only).

    Turns are ordered by turn number, then role, then text; null numbers come first. A null
    text counts as empty, a null role as ``user``; repeated rows are repeated turns; null
    pair ids form one pair; rows of any other side are ignored. Only the named columns are
    read, so extra ones cannot clash.

    One shuffle on the pair. A pair's turns meet in one row because they leave in one row.
    """
    rows = turns.where(F.col(side_column).isin(CHOSEN, REJECTED)).select(
        F.col(pair_column).alias("pair_id"),
        F.col(side_column).alias("side"),
        F.struct(
            F.col(turn_column).alias("turn"),
            F.coalesce(F.col(role_column).cast("string"), F.lit("user")).alias("role"),
            F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        ).alias("entry"),
    )
    collected = rows.groupBy("pair_id").agg(
        *[
            F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col("entry")))).alias(side)
            for side in (CHOSEN, REJECTED)
        ]
    )
    same = lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False))
    differs = F.array_position(F.zip_with(CHOSEN, REJECTED, same), False)
    shorter = F.least(F.size(CHOSEN), F.size(REJECTED))
    common = F.when(differs > 0, differs - 1).otherwise(shorter).cast("int")
    split = collected.withColumn("prefix_turns", common).select(
        "pair_id",
        "prefix_turns",
        F.slice(CHOSEN, 1, F.col("prefix_turns")).alias("head"),
        *[
            F.slice(side, F.col("prefix_turns") + 1, F.size(side)).alias(side)
            for side in (CHOSEN, REJECTED)
        ],
    )
    trained = lambda side: F.exists(side, lambda t: t["role"].isin(*trained_roles))
    status = (
        F.when((F.size(CHOSEN) == 0) & (F.size(REJECTED) == 0), "same")
        .when(trained(CHOSEN) & trained(REJECTED), "pair")
        .otherwise("one_sided")
    )
    template = (start, middle, end)
    return split.select(
        F.col("pair_id").alias(pair_column),
        "prefix_turns",
        _render(F.col("head"), *template).alias("prompt"),
        _render(F.col(CHOSEN), *template).alias(CHOSEN),
        _render(F.col(REJECTED), *template).alias(REJECTED),
        _trained_spans(F.col(CHOSEN), trained_roles, *template).alias("chosen_spans"),
        _trained_spans(F.col(REJECTED), trained_roles, *template).alias("rejected_spans"),
        status.alias("status"),
    )
