"""Quality rules for SQL files, each a Column, and their ordered combination.

The rules run from cheap to dear and stop at the first failure. ``reject_reason`` names it and
``is_quality`` is its absence: one expression, which Catalyst can push down whole and which
splits the text into lines once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules, text
from .dialect import finds_any, folded, is_dialect, may_hold
from .patterns import any_phrase, any_text, either, longest_word
from .text import any_of, as_column, let, split_lines


def size_ok(content: Column | str) -> Column:
    return F.length(as_column(content)).between(rules.MIN_CHARS, rules.MAX_CHARS)


# Rules over the array that ``split_lines`` gives.


def line_count_ok(split: Column) -> Column:
    return text.line_count(split) >= rules.MIN_LINES


def longest_line_ok(split: Column) -> Column:
    return text.all_lines_within(split, rules.MAX_LINE_LENGTH)


def mean_line_ok(split: Column) -> Column:
    return text.mean_line_within(split, rules.MAX_MEAN_LINE_LENGTH)


def comments_ok(split: Column) -> Column:
    return text.comment_share(split) <= rules.MAX_COMMENT_SHARE


def not_generated(split: Column, upper: Column | None = None) -> Column:
    """No generator's note in the first lines. ``upper`` may be that of the whole text."""
    head = F.array_join(F.slice(split, 1, rules.HEADER_LINES), "\n")
    found = finds_any(head, rules.GENERATED_PHRASES)
    return ~found if upper is None else ~(may_hold(upper, rules.GENERATED_PHRASES) & found)


# Rules over the whole text.


def alnum_ok(content: Column | str) -> Column:
    return text.alnum_share_from(content, rules.MIN_ALNUM_SHARE)


def is_migration_path(path: Column | str) -> Column:
    return let(
        F.lower(F.coalesce(as_column(path), F.lit(""))),
        lambda p: any_of([p.contains(part) for part in rules.MIGRATION_PATH_PARTS]),
    )


def is_migration_header(content: Column | str, upper: Column | None = None) -> Column:
    """``upper`` is the folded whole text if already at hand."""
    start = F.substring(as_column(content), 1, rules.MIGRATION_HEADER_CHARS)
    found = start.rlike(
        either(
            any_phrase(rules.MIGRATION_HEADER_PHRASES), any_text(rules.MIGRATION_HEADER_TEXTS)
        )
    )
    if upper is None:
        return found
    words = [longest_word(t) for t in rules.MIGRATION_HEADER_TEXTS]
    return may_hold(upper, rules.MIGRATION_HEADER_PHRASES + words) & found


def is_migration(
    path: Column | str, content: Column | str, upper: Column | None = None
) -> Column:
    return is_migration_path(path) | is_migration_header(content, upper)


def has_statement(content: Column | str) -> Column:
    """Holds a statement beyond plain table definitions."""
    return as_column(content).rlike(any_phrase(rules.FILE_STATEMENTS))


def quality_rules(
    content: Column | str, path: Column | str, split: Column, upper: Column
) -> list[tuple[str, Column]]:
    """(reason, condition that must hold), in the order in which they apply after the size."""
    return [
        ("lines", line_count_ok(split)),
        ("longest_line", longest_line_ok(split)),
        ("mean_line", mean_line_ok(split)),
        ("alnum", alnum_ok(content)),
        ("comments", comments_ok(split)),
        ("autogen", not_generated(split, upper)),
        ("migration", ~is_migration(path, content, upper)),
        ("dialect", is_dialect(content, upper)),
        ("statement", has_statement(content)),
    ]


def reject_reason(
    content: Column | str, path: Column | str, *after: Column | str
) -> Column:
    """Name of the first rule that a file fails, null when it is kept.

    A missing content fails the first rule; a missing path is an empty one. ``after`` names
    columns that have to be there first: a filter that mentions columns of a join's other side
    stays above that join, so only the rows that the join leaves are judged.
    """

    def judge(file: Column) -> Column:
        text, name = file["content"], file["path"]

        def after_size(split: Column, upper: Column) -> Column:
            (first, ok), *rest = quality_rules(text, name, split, upper)
            verdict = F.when(~ok, F.lit(first))
            for reason, ok in rest:
                verdict = verdict.when(~ok, F.lit(reason))
            return verdict

        right_size = F.coalesce(size_ok(text), F.lit(False))
        return F.when(~right_size, F.lit("size")).otherwise(
            let(split_lines(text), lambda s: let(folded(text), lambda u: after_size(s, u)))
        )

    file = F.struct(
        as_column(content).alias("content"), as_column(path).alias("path"), *map(as_column, after)
    )
    return let(file, judge)


def is_quality(content: Column | str, path: Column | str, *after: Column | str) -> Column:
    return reject_reason(content, path, *after).isNull()
