"""Cut SQL files into chunks: at batch separators, at object heads, or the whole file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .patterns import NON_NEWLINE_SPACES, SPACES, any_phrase, phrase
from .text import as_column, let, lines_with_ends, strip

_SEPARATOR = rf"(?imd)^[{NON_NEWLINE_SPACES}]*{rules.BATCH_SEPARATOR}[{NON_NEWLINE_SPACES}]*$"
_HEAD = rf"(?ius)\A[{SPACES}]*+" + phrase(rules.OBJECT_HEAD)


def batch_chunks(content: Column | str) -> Column:
    """Batches between separator lines that have a fitting length and hold a statement."""
    batches = F.transform(F.split(as_column(content), _SEPARATOR), strip)
    return F.filter(
        batches,
        lambda b: F.length(b).between(rules.MIN_STORED_CHUNK, rules.MAX_CHUNK)
        & b.rlike(any_phrase(rules.BATCH_STATEMENTS)),
    )


def object_chunks(content: Column | str) -> Column:
    """Pieces that open at an object head and close when long enough or at a later head.

    One fold over the lines that keeps character positions only; the texts are cut afterwards.
    A piece is long enough once it holds ``MAX_CHUNK`` characters; another head closes it when it
    comes more than ``HEAD_LOOKAHEAD_LINES`` lines after the opening one. Lines between a closed
    piece and the next head belong to none.
    """
    content = as_column(content)
    heads = F.transform(
        lines_with_ends(content),
        lambda line, i: F.struct(
            F.length(line).alias("chars"), line.rlike(_HEAD).alias("head"), i.alias("no")
        ),
    )
    span = "struct<at:int,chars:int>"
    start = F.struct(
        F.array().cast(f"array<{span}>").alias("done"),
        F.lit(0).alias("pos"),
        F.lit(-1).alias("open_at"),
        F.lit(0).alias("open_no"),
    )

    def closed(state: Column) -> Column:
        piece = F.struct(state.open_at.alias("at"), (state.pos - state.open_at).alias("chars"))
        return F.array_append(state.done, piece.cast(span))

    def step(state: Column, line: Column) -> Column:
        is_open = state.open_at >= 0
        ends = is_open & (
            (state.pos - state.open_at >= rules.MAX_CHUNK)
            | (line["head"] & (line["no"] > state.open_no + rules.HEAD_LOOKAHEAD_LINES))
        )
        opens = (ends | ~is_open) & line["head"]
        return F.struct(
            F.when(ends, closed(state)).otherwise(state.done).alias("done"),
            (state.pos + line["chars"]).alias("pos"),
            F.when(opens, state.pos)
            .when(ends, F.lit(-1))
            .otherwise(state.open_at)
            .alias("open_at"),
            F.when(opens, line["no"]).otherwise(state.open_no).alias("open_no"),
        )

    spans = F.aggregate(
        heads,
        start,
        step,
        lambda state: F.when(state.open_at >= 0, closed(state)).otherwise(state.done),
    )
    pieces = F.transform(
        spans, lambda s: strip(F.substring(content, s["at"] + F.lit(1), s["chars"]))
    )
    return F.filter(pieces, lambda p: F.length(p) >= rules.MIN_STORED_CHUNK)


def whole_chunk(content: Column | str) -> Column:
    """The whole file as one chunk when its raw length fits."""
    content = as_column(content)
    fits = F.length(content).between(rules.MIN_STORED_CHUNK, rules.MAX_CHUNK)
    return F.when(fits, F.array(strip(content))).otherwise(F.array().cast("array<string>"))


def extract_chunks(content: Column | str) -> Column:
    """The first of the three ways that gives any chunk."""

    def first_of(text: Column) -> Column:
        return let(
            batch_chunks(text),
            lambda batches: F.when(F.size(batches) > 0, batches).otherwise(
                let(
                    object_chunks(text),
                    lambda objects: F.when(F.size(objects) > 0, objects).otherwise(
                        whole_chunk(text)
                    ),
                )
            ),
        )

    return let(as_column(content), first_of)
