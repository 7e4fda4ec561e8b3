"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns
of one role merge into one block; a block is written as

    <|start|>role LF text <|next|> text ... <|end|> LF

so the turns inside a block can be told apart again.  In texts and roles ``~``,
``<`` and ``[`` are written ``~0``, ``~1`` and ``~2`` (in roles LF is ``~3``), so
no control string of this or another common template can occur in them, and
every text comes back exactly.

The loss mask is a list of spans (block, start, length) in code points of the
block, one for each turn of the trained role.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, NEXT, END = "<|start|>", "<|next|>", "<|end|>\n"
#: Characters that control strings begin with, and how they are written.
WRITTEN = (("~", "~0"), ("<", "~1"), ("[", "~2"))


def escaped(text: Column, role: bool = False) -> Column:
    for plain, written in WRITTEN + ((("\n", "~3"),) if role else ()):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column, role: bool = False) -> Column:
    for plain, written in reversed(WRITTEN + ((("\n", "~3"),) if role else ())):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def formatted(rows: DataFrame, trained: str = "assistant") -> DataFrame:
    """conv_id, blocks, formatted, loss: one row per conversation.

    ``rows`` has conv_id, turn, role, text.  Null texts and roles count as empty;
    a null turn comes first; equal turns are ordered by role and text, and
    repeated rows are turns of their own.  Rows with a null conv_id form one
    conversation.  An empty table gives no row.  One conversation becomes one
    string, so it has to fit a row.
    """
    turns = rows.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            escaped(F.coalesce("text", F.lit(""))).alias("body"),
        ).alias("item"),
    )
    gathered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("item")).alias("turns"))
    gathered = gathered.withColumn(
        "starts",
        F.filter(
            F.sequence(F.lit(1), F.size("turns")),
            lambda i: (i == 1)
            | (
                F.element_at("turns", i)["role"]
                != F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"]
            ),
        ),
    )

    def block(start: Column, nth: Column) -> Column:
        stop = F.coalesce(F.get("starts", nth + 1), F.size("turns") + 1)
        return F.struct(
            F.element_at("turns", start)["role"].alias("role"),
            F.transform(F.slice("turns", start, stop - start), lambda t: t["body"]).alias("bodies"),
        )

    merged = gathered.withColumn("merged", F.transform("starts", block)).select("conv_id", "merged")

    def head(b: Column) -> Column:
        return F.concat(F.lit(START), escaped(b["role"], True), F.lit("\n"))

    def spans(b: Column, nth: Column) -> Column:
        """Places of the bodies of one block."""
        begin = F.struct(
            (F.length(head(b))).alias("at"),
            F.array().cast("array<struct<block:int,start:int,length:int>>").alias("found"),
        )
        placed = F.aggregate(
            b["bodies"],
            begin,
            lambda s, body: F.struct(
                (s["at"] + F.length(body) + len(NEXT)).alias("at"),
                F.array_append(
                    s["found"],
                    F.struct(nth.alias("block"), s["at"].alias("start"), F.length(body).alias("length")),
                ).alias("found"),
            ),
        )
        none = F.array().cast("array<struct<block:int,start:int,length:int>>")
        return F.when(b["role"] == trained, placed["found"]).otherwise(none)

    return merged.select(
        "conv_id",
        F.transform(
            "merged", lambda b: F.concat(head(b), F.array_join(b["bodies"], NEXT), F.lit(END))
        ).alias("blocks"),
        F.flatten(F.transform("merged", spans)).alias("loss"),
    ).select("conv_id", "blocks", F.array_join("blocks", "").alias("formatted"), "loss")


def read_back(output: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), loss_text: what the formatted string and its mask say."""
    pieces = output.withColumn("parts", F.split("formatted", r"<\|end\|>\n", -1)).withColumn(
        "parts", F.slice("parts", 1, F.size("parts") - 1)
    )

    def turns(part: Column) -> Column:
        role = F.substring_index(F.substr(part, F.lit(len(START) + 1)), "\n", 1)
        body = F.substr(part, F.lit(len(START) + 2) + F.length(role))
        return F.transform(
            F.split(body, r"<\|next\|>", -1),
            lambda t: F.struct(unescaped(role, True).alias("role"), unescaped(t).alias("text")),
        )

    kept = F.transform(
        "loss",
        lambda s: unescaped(F.substr(F.get("parts", s["block"]), s["start"] + 1, s["length"])),
    )
    return pieces.select(
        "conv_id",
        F.flatten(F.transform("parts", turns)).alias("turns"),
        F.array_join(kept, "").alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
