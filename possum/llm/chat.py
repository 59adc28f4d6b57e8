"""Operator 3: chat formatting with Spark expressions only.

Turns are collected as structs and sorted; adjacent turns of one role are
merged into one block by comparing each struct with the one before it, and
the pieces are joined by one array aggregation (linear in the turns):

    <|block|>user
    <|turn|>text<|turn|>next text of the same role<|end|>
    <|block|>assistant
    <|turn|>text<|end|>

Inside roles and texts every ``&`` becomes ``&amp;`` and every ``<|`` becomes
``&lt;|``, so no text can contain a control string, whatever it holds, and the
escape is undone exactly. ``parse`` reads the turns back from the formatted
string alone.

Nulls: a null text is empty; a null role is the role ``""``; a null turn sorts
first; a null conv_id is a conversation of its own. Turns with equal numbers
are ordered by role, then text; repeated rows are repeated turns. Other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, TURN, END = "<|block|>", "<|turn|>", "<|end|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, formatted: one row per conversation."""
    one = F.struct(F.col(turn_col).alias("turn"),
                   escape(F.coalesce(F.col(role_col), F.lit(""))).alias("role"),
                   escape(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    grouped = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(one)).alias("turns"))
    turn = F.col("turns")

    def piece(x: Column, i: Column) -> Column:
        opened = F.concat(F.lit(BLOCK), x["role"], F.lit("\n"))
        before = F.when(i == 0, opened).when(
            F.get(turn, i - 1)["role"] == x["role"], F.lit("")).otherwise(F.concat(F.lit(f"{END}\n"), opened))
        return F.concat(before, F.lit(TURN), x["text"])

    return grouped.select("conv_id", F.concat(F.array_join(F.transform(turn, piece), ""),
                                              F.lit(END)).alias("formatted"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text, loss>> read back from a formatted conversation."""
    body = F.substring(formatted, len(BLOCK) + 1, 2147483647)
    body = F.substring(body, F.lit(1), F.length(body) - len(END))
    blocks = F.split(body, _literal(f"{END}\n{BLOCK}"))

    def turns_of(block: Column) -> Column:
        parts = F.split(block, _literal(TURN))
        role = unescape(F.substring(parts[0], F.lit(1), F.length(parts[0]) - 1))
        return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))),
                           lambda x: F.struct(role.alias("role"), unescape(x).alias("text"),
                                              (role == LOSS_ROLE).alias("loss")))

    return F.flatten(F.transform(blocks, turns_of))


def _literal(mark: str) -> str:
    return "\\Q" + mark + "\\E"


def chat_digest(formatted: DataFrame) -> DataFrame:
    """What the contract asks for, read back from ``formatted``."""
    turns = F.col("turns")
    flat = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter(turns, lambda t: t["loss"]), lambda t: t["text"]), "")
    return (formatted.withColumn("turns", parse(F.col("formatted")))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(flat, 256).alias("turns_sha256"),
                    F.length(loss).cast("long").alias("loss_chars"),
                    F.sha2(loss, 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))
