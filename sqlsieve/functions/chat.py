"""Output forms of a question with its code, and chat text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .text import any_of, as_column


def fenced(code: Column | str) -> Column:
    return F.concat(
        F.lit(f"{rules.CODE_FENCE}{rules.OUTPUT_FENCE_LANGUAGE}\n"),
        as_column(code),
        F.lit(f"\n{rules.CODE_FENCE}"),
    )


def alpaca_columns(instruction: Column | str, code: Column | str) -> list[Column]:
    return [
        as_column(instruction).alias("instruction"),
        F.lit("").alias("input"),
        fenced(code).alias("output"),
    ]


def chat_messages(instruction: Column | str, code: Column | str) -> Column:
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    user, assistant = rules.CHAT_ROLES
    return F.array(message(user, as_column(instruction)), message(assistant, fenced(code)))


def open_turn() -> Column:
    """Header of the turn that the model is to write."""
    return F.lit(f"{rules.CHAT_START}{rules.CHAT_ROLES[1]}\n")


def turn_text(role: Column | str, content: Column | str) -> Column:
    """One closed turn; empty for roles other than user and assistant."""
    role = F.coalesce(as_column(role), F.lit(rules.CHAT_ROLES[0]))
    body = F.coalesce(as_column(content), F.lit(""))
    text = F.concat(F.lit(rules.CHAT_START), role, F.lit("\n"), body, F.lit(f"{rules.CHAT_END}\n"))
    return F.when(any_of([role == r for r in rules.CHAT_ROLES]), text).otherwise("")


def chat_text(messages: Column | str) -> Column:
    """All turns of a message list followed by the open header."""
    turns = F.transform(as_column(messages), lambda m: turn_text(m["role"], m["content"]))
    return F.concat(F.array_join(turns, ""), open_turn())
