"""Line and character measures of text columns, all built-in expressions.

Lines are split once per row and bound with ``let``: an expression that several rules share stays
one expression wherever Catalyst moves it, also when a filter is pushed below the projection.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import INLINE_SPACES, LINE_END, LINE_ENDS, SPACE_CHARS, escape
from .rules import COMMENT_STARTS

_RARE_LINE_ENDS = [c for c in SPACE_CHARS if len(f"a{c}b".splitlines()) == 2 and c != "\n"]
_ASCII_ALNUM = string.digits + string.ascii_letters
_COMMENT = rf"\A[{INLINE_SPACES}]*+(?:{'|'.join(escape(s) for s in COMMENT_STARTS)})"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once per row."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def strip(text: Column | str) -> Column:
    """Remove white space at both ends."""
    return F.btrim(as_column(text), F.lit(SPACE_CHARS))


def has_rare_end(text: Column) -> Column:
    """Holds a line end other than a newline. Only texts beyond ASCII are searched for those beyond it."""

    def holds(ends: list[str]) -> Column:
        return any_of([text.contains(c) for c in ends])

    beyond = [c for c in _RARE_LINE_ENDS if not c.isascii()]
    return holds([c for c in _RARE_LINE_ENDS if c.isascii()]) | (
        (F.octet_length(text) > F.length(text)) & holds(beyond)
    )


def split_lines(text: Column | str) -> Column:
    """Lines without their ends, plus an empty one after a final line end.

    Plain newlines are the fast path; the other line ends are rewritten first where they occur.
    A replacement compares the text at each byte, so it costs more than all of the searches.
    """

    def plain(t: Column) -> Column:
        unix = F.replace(t, F.lit("\r\n"), F.lit("\n"))
        return F.when(has_rare_end(t), F.regexp_replace(unix, f"[{LINE_ENDS}]", "\n")).otherwise(t)

    return F.split(let(as_column(text), plain), "\n")


def lines(text: Column | str) -> Column:
    """Lines without their ends; a final line end does not open another line."""
    return let(
        split_lines(text),
        lambda a: F.when(F.get(a, F.size(a) - 1) == "", F.slice(a, 1, F.size(a) - 1)).otherwise(a),
    )


def lines_with_ends(text: Column | str) -> Column:
    """Lines, each with its line end."""
    text = as_column(text)

    def by_newline(parts: Column) -> Column:
        closed = F.transform(
            parts, lambda line, i: F.when(i < F.size(parts) - 1, F.concat(line, F.lit("\n")))
            .otherwise(line)
        )
        return F.filter(closed, lambda line: line != "")

    odd_ends = let(
        F.replace(text, F.lit("\r\n"), F.lit("\n")),
        lambda t: any_of([t.contains(c) for c in _RARE_LINE_ENDS]),
    )
    return F.when(
        has_rare_end(text) & odd_ends, F.regexp_extract_all(text, F.lit(rf"(?s).*?{LINE_END}|.+\z"), F.lit(0))
    ).otherwise(let(F.split(text, "\n"), by_newline))


# Measures over the array that ``split_lines`` gives.


def line_count(split: Column) -> Column:
    unfinished = F.get(split, F.size(split) - 1) != ""
    return F.size(split) - 1 + unfinished.cast("int")


def longest_line(split: Column) -> Column:
    return F.array_max(F.transform(split, F.length))


def all_lines_within(split: Column, most: int) -> Column:
    """No line is longer. Bytes, whose number is at hand, settle it for nearly all of them."""
    return F.forall(split, lambda line: (F.octet_length(line) <= most) | (F.length(line) <= most))


def chars_in_lines(split: Column) -> Column:
    return F.aggregate(split, F.lit(0), lambda acc, line: acc + F.length(line))


def comment_lines(split: Column) -> Column:
    """Lines whose first visible characters open a comment."""
    return F.size(F.filter(split, lambda line: line.rlike(_COMMENT)))


def mean_line_length(split: Column) -> Column:
    return chars_in_lines(split) / F.greatest(line_count(split), F.lit(1))


def mean_line_within(split: Column, most: int) -> Column:
    """The mean length is no more; characters are counted where the bytes are too many."""
    size = F.aggregate(split, F.lit(0), lambda acc, line: acc + F.octet_length(line))
    few = size <= F.greatest(line_count(split), F.lit(1)) * most
    return F.when(few, F.lit(True)).otherwise(mean_line_length(split) <= most)


def comment_share(split: Column) -> Column:
    return comment_lines(split) / F.greatest(line_count(split), F.lit(1))


def line_stats(text: Column | str) -> Column:
    """Struct of line count, longest line, mean line length and comment lines."""
    return let(
        split_lines(text),
        lambda a: F.struct(
            line_count(a).alias("n_lines"),
            longest_line(a).alias("longest"),
            mean_line_length(a).alias("mean_length"),
            comment_lines(a).alias("n_comments"),
        ),
    )


def _alnum_chars(t: Column) -> Column:
    ascii_only = F.octet_length(t) == F.length(t)
    plain = F.regexp_replace(t, f"[^{_ASCII_ALNUM}]+", "")
    # What stays of a text of ASCII characters is as many bytes as characters.
    return F.when(ascii_only, F.octet_length(plain)).otherwise(
        F.length(F.regexp_replace(t, r"[^\p{L}\p{N}]+", ""))
    )


def alnum_share(text: Column | str) -> Column:
    return let(as_column(text), lambda t: _alnum_chars(t) / F.greatest(F.length(t), F.lit(1)))


def alnum_share_from(text: Column | str, least: float) -> Column:
    """The share is at least that. The first half of most texts has enough for the whole."""

    def enough(t: Column) -> Column:
        head = let(F.substring(t, F.lit(1), F.ceil(F.length(t) / 2).cast("int")), _alnum_chars)
        settled = head / F.greatest(F.length(t), F.lit(1)) >= least
        return F.when(settled, F.lit(True)).otherwise(alnum_share(t) >= least)

    return let(as_column(text), enough)


def path_suffix(path: Column | str) -> Column:
    """Lower-cased last suffix of the last path part; a leading dot alone is not a suffix."""
    name = F.regexp_extract(
        F.regexp_replace(as_column(path), r"(?:/\.?)+\z", ""), r"([^/]*)\z", 1
    )
    return F.lower(F.regexp_extract(name, r"(?s)\A.+(\.[^.]+)\z", 1))
