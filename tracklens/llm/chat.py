"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role merge into a block by array
functions; blocks are joined into one text:

    <s>[user]hello[+]are you there</s><s>[assistant]yes</s>

``<s>[``, ``]``, ``[+]`` and ``</s>`` are the control strings. In roles and texts ``~ [ < ]`` are written ``~0 ~1 ~2 ~3``, so
no control string can come from a text and every text is read back exactly. The loss mask covers the assistant's texts,
not the control strings around them.

A conversation is one row of the result, so it must fit a row (2 GB); conversations spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPES = (("~", "~0"), ("[", "~1"), ("<", "~2"), ("]", "~3"))


def escaped(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _block_starts(turns: Column) -> Column:
    """Positions from 0 at which the role changes."""
    return F.filter(
        F.sequence(F.lit(0), F.size(turns) - 1),
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, F.greatest(i - 1, F.lit(0)))["role"]),
    )


def _block(turns: Column, start: Column, end: Column) -> Column:
    texts = F.transform(F.slice(turns, start + 1, end - start), lambda t: escaped(t["text"]))
    role = escaped(F.get(turns, start)["role"])
    return F.concat(F.lit("<s>["), role, F.lit("]"), F.array_join(texts, "[+]"), F.lit("</s>"))


def formatted(turns: Column) -> Column:
    """The text of sorted turns."""

    def blocks(t: Column) -> Column:
        return let(
            _block_starts(t),
            lambda starts: F.transform(
                starts, lambda s, k: _block(t, s, F.coalesce(F.get(starts, k + 1), F.size(t)))
            ),
        )

    return let(turns, lambda t: F.array_join(blocks(t), ""))


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted``: one row per conversation of ``conv_id, turn, role, text``.

    Turns go by number, then role and text, so ties and repeated rows have one order and all stay; NULL turns come
    first. A NULL role or text is empty. Rows without a ``conv_id`` are one conversation. Other columns are ignored.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return grouped.select("conv_id", formatted(F.col("turns")).alias("formatted"))


def read_back(text: Column) -> Column:
    """The turns of a formatted text as an array of ``role, text``."""
    blocks = F.split(text, "</s>", -1)
    whole = F.filter(blocks, lambda b: b != "")

    def turns(block: Column) -> Column:
        role = unescaped(F.regexp_extract(block, r"^<s>\[([^\]]*)\]", 1))
        body = F.regexp_replace(block, r"^<s>\[[^\]]*\]", "")
        texts = F.split(body, r"\[\+\]", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(whole, turns))


def digests(chats: DataFrame) -> DataFrame:
    """What the formatted texts hold, read back from them: turns, hashes and the text under the loss mask."""
    read = chats.select(
        "conv_id",
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        let(
            read_back(F.col("formatted")),
            lambda t: F.struct(
                F.size(t).cast("long").alias("n_turns"),
                F.array_join(
                    F.transform(t, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""
                ).alias("all"),
                F.array_join(
                    F.transform(F.filter(t, lambda x: x["role"] == "assistant"), lambda x: x["text"]), ""
                ).alias("loss"),
            ),
        ).alias("r"),
    )
    return read.select(
        "conv_id",
        "r.n_turns",
        F.sha2("r.all", 256).alias("turns_sha256"),
        F.char_length("r.loss").cast("long").alias("loss_chars"),
        F.sha2("r.loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def with_probe(turns: DataFrame) -> DataFrame:
    """The turns plus conversation -7, whose texts look like control strings."""
    said = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    probe = turns.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)
