"""Read a question and its code out of a generated answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .patterns import any_text, escape
from .text import as_column, let, strip

_FENCE = (
    f"(?is){rules.CODE_FENCE}(?:{'|'.join(map(escape, rules.FENCE_LANGUAGES))})?"
    rf"\n(.*?){rules.CODE_FENCE}"
)


def has_marker(answer: Column | str) -> Column:
    return as_column(answer).contains(rules.ANSWER_MARKER)


def is_unsure(answer: Column | str) -> Column:
    """A phrase of doubt anywhere in the answer, its code included."""
    return as_column(answer).rlike(any_text(rules.LOW_CONFIDENCE_TEXTS))


def long_enough(question: Column, code: Column) -> Column:
    return (F.length(question) >= rules.MIN_QUESTION) & (F.length(code) >= rules.MIN_CODE)


def parse_answer(answer: Column | str) -> Column:
    """Struct of instruction and code, null when the answer lacks a part or is not usable."""

    def pair(text: Column, cut: Column) -> Column:
        before = F.substring(text, F.lit(1), cut - F.lit(1))
        after = F.substring(text, cut + F.lit(len(rules.ANSWER_DIVIDER)), F.length(text))
        question = strip(F.replace(before, F.lit(rules.ANSWER_MARKER), F.lit("")))
        code = strip(F.regexp_extract(after, _FENCE, 1))
        both = F.struct(question.alias("instruction"), code.alias("code"))
        return let(both, lambda p: F.when(long_enough(p["instruction"], p["code"]), p))

    def read(text: Column) -> Column:
        usable = has_marker(text) & text.contains(rules.ANSWER_DIVIDER) & ~is_unsure(text)
        cut = F.instr(text, rules.ANSWER_DIVIDER)
        return F.when(usable, let(cut, lambda at: pair(text, at)))

    return let(as_column(answer), read)
