"""Dialect, feature and weight functions over SQL text columns.

A phrase is looked for in two steps: a substring search for its words in the upper-cased text,
then the regex where those occur. On texts without the phrase, which is the common case, the
regex never runs. Texts of ASCII characters alone have it run on the upper-cased text, without case
folding and Unicode classes; it finds the same there at a fraction of the cost.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .patterns import ASCII, any_phrase, escape, guard_words, is_span
from .text import any_of, as_column, let

# Letters that a caseless regex equates with k and i but upper-casing leaves alone.
_UNFOLDED = [("\u212a", "K"), ("\u0130", "I")]


def folded(text: Column) -> Column:
    """Upper-cased text for the substring searches; rules over one text may share it."""

    def fold_rest(upper: Column) -> Column:
        rest = reduce(lambda t, r: F.replace(t, F.lit(r[0]), F.lit(r[1])), _UNFOLDED, upper)
        return F.when(F.octet_length(text) == F.length(text), upper).otherwise(rest)

    return let(F.upper(text), fold_rest)


def _with_folded(
    text: Column | str, upper: Column | None, body: Callable[[Column, Column], Column]
) -> Column:
    if upper is not None:
        return body(as_column(text), upper)
    return let(as_column(text), lambda t: let(folded(t), lambda u: body(t, u)))


def _holds(upper: Column, word: str) -> Column:
    """Regexes of plain letters skip through a text by their length, in a quarter of the time."""
    return upper.rlike(escape(word)) if len(word) >= 4 else upper.contains(word)


def may_hold(upper: Column, phrases: list[str]) -> Column:
    """The folded text holds the words without which none of the phrases occurs."""

    def one_list(words: list[str]) -> Column:
        shortest = [w for w in words if not any(v != w and v in w for v in words)]
        return any_of([_holds(upper, w) for w in dict.fromkeys(shortest)])

    if not any(is_span(p) for p in phrases):
        return one_list([w for p in phrases for w in guard_words(p)[0]])
    return any_of([reduce(lambda a, b: a & b, map(one_list, guard_words(p))) for p in phrases])


def _matches(text: Column, upper: Column, phrases: list[str]) -> Column:
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, upper.rlike(any_phrase(phrases, ASCII))).otherwise(
        text.rlike(any_phrase(phrases))
    )


def _finds(text: Column, upper: Column, phrases: list[str]) -> Column:
    return may_hold(upper, phrases) & _matches(text, upper, phrases)


def finds_any(text: Column | str, phrases: list[str], upper: Column | None = None) -> Column:
    """The text holds one of the phrases; ``upper`` is its folded form if already at hand."""
    plain = [p for p in phrases if not is_span(p)]
    groups = [g for g in [plain] if g] + [[p] for p in phrases if is_span(p)]
    return _with_folded(text, upper, lambda t, u: any_of([_finds(t, u, g) for g in groups]))


def has_foreign_markers(content: Column | str, upper: Column | None = None) -> Column:
    return finds_any(content, rules.FOREIGN_MARKERS, upper)


def has_dialect_markers(content: Column | str, upper: Column | None = None) -> Column:
    """Most files of the dialect show a marker early, so the regex for the plain ones comes first."""
    plain = [p for p in rules.DIALECT_MARKERS if not is_span(p)]
    spans = [p for p in rules.DIALECT_MARKERS if is_span(p)]
    return _with_folded(
        content, upper, lambda t, u: _matches(t, u, plain) | finds_any(t, spans, u)
    )


def is_dialect(content: Column | str, upper: Column | None = None) -> Column:
    """Plausibly the wanted dialect: no marker of another one, at least one of its own."""
    return _with_folded(
        content, upper, lambda t, u: ~has_foreign_markers(t, u) & has_dialect_markers(t, u)
    )


def is_modern(content: Column | str) -> Column:
    """Uses one of the dialect's newer features."""
    return finds_any(content, rules.MODERN_MARKERS)


def feature_tags(content: Column | str) -> Column:
    """Names of the features found, in table order."""

    def tags(text: Column, upper: Column) -> Column:
        found = [
            F.when(_finds(text, upper, phrases), F.lit(tag)) for tag, _, phrases in rules.FEATURES
        ]
        return F.array_compact(F.array(*found))

    return _with_folded(content, None, tags)


def feature_score(tags: Column | str) -> Column:
    """Sum of the weights of the tags; unknown tags and a missing list weigh nothing."""
    weights = F.create_map(*[F.lit(v) for tag, w, _ in rules.FEATURES for v in (tag, w)])
    total = F.aggregate(
        as_column(tags),
        F.lit(0),
        lambda acc, tag: acc + F.coalesce(F.try_element_at(weights, tag), F.lit(0)),
    )
    return F.coalesce(total, F.lit(0))
