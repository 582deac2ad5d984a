"""Compile the phrase lists of ``rules.py`` into regular expressions.

Three flavours of the same phrases: ``SPARK`` for Catalyst's Java regexes, with the character
classes spelled out so that letters, digits and white space mean what they mean in Unicode text,
``ASCII`` for the same regexes on upper-cased texts of that alphabet alone, where they need no case
folding and only small character classes, and ``RE2`` for SQL engines whose regexes know neither
lookarounds nor atomic groups.
"""

from __future__ import annotations

import re
from typing import NamedTuple

# White space and line ends as text processing usually counts them, file separators included.
LINE_ENDS = r"\n\r\x0B\f\x1C-\x1E\x85\u2028\u2029"
INLINE_SPACES = r"\t\x1F\x20\xA0\u1680\u2000-\u200A\u202F\u205F\u3000"
SPACES = INLINE_SPACES + LINE_ENDS
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NON_NEWLINE_SPACES = INLINE_SPACES + LINE_ENDS.removeprefix(r"\n")
LINE_END = rf"(?>\r\n|[{LINE_ENDS}])"


class Flavour(NamedTuple):
    flags: str
    space: str
    name: str
    digit: str
    non_end: str
    word_start: str
    word_end: str
    atomic: bool
    upper: bool = False


SPARK = Flavour(
    flags="(?ius)",
    space=f"[{SPACES}]",
    name=r"[\p{L}\p{N}_]",
    digit=r"\p{Nd}",
    non_end=f"[^{LINE_ENDS}]",
    word_start=r"(?<![\p{L}\p{N}_])",
    word_end=r"(?![\p{L}\p{N}_])",
    atomic=True,
)
# What SPARK finds in a text of ASCII characters, this finds in the upper-cased text.
ASCII = Flavour(
    flags="(?s)",
    space=r"[\t-\r\x1C-\x20]",
    name="[A-Z0-9_]",
    digit="[0-9]",
    non_end=r"[^\n\r\x0B\f\x1C-\x1E]",
    word_start="(?<![A-Z0-9_])",
    word_end="(?![A-Z0-9_])",
    atomic=True,
    upper=True,
)
RE2 = Flavour(
    flags="(?is)",
    space=r"\s",
    name=r"\w",
    digit=r"\d",
    non_end=r"[^\n]",
    word_start=r"\b",
    word_end=r"\b",
    atomic=False,
)

_TOKEN = re.compile(r"\[[^\]]+\]|\S+")
_PLACEHOLDER = re.compile(r"<(name|n|gap|one|opt)>")
_SPECIALS = re.compile(r"([.^$*+?{}\[\]\\|()])")


def escape(text: str) -> str:
    return _SPECIALS.sub(r"\\\1", text)


def _piece(text: str, fl: Flavour) -> str:
    """A token without alternatives: literal text with placeholders."""
    atoms = {
        "name": fl.name + "+",
        "n": fl.digit + "+",
        "gap": fl.space + "+",
        "one": r"[^\n]",
        "opt": fl.non_end + "?",
    }
    literal = (lambda t: escape(t.upper())) if fl.upper else escape
    out, at = "", 0
    for m in _PLACEHOLDER.finditer(text):
        out += literal(text[at:m.start()]) + atoms[m.group(1)]
        at = m.end()
    return out + literal(text[at:])


def _token(token: str, fl: Flavour) -> str:
    choices = [_piece(t, fl) for t in token.split("/")] if token != "/" else ["/"]
    return choices[0] if len(choices) == 1 else f"(?:{'|'.join(choices)})"


def _is_punctuation(token: str) -> bool:
    return not re.search(r"[\w@<]", token)


def _body(words: str, fl: Flavour, whole: bool = True) -> str:
    """A phrase without ``...``, unanchored on the left."""
    out, glue, last = "", "", ""
    for token in _TOKEN.findall(words):
        if token.startswith("["):
            out += glue + f"(?:{_body(token[1:-1], fl, False)}{fl.space}+)?"
            glue = ""
        elif _is_punctuation(token):
            out += (f"{fl.space}*" if out else "") + _token(token, fl)
            glue = f"{fl.space}*"
        elif token == "<gap>":
            out += f"{fl.space}+"
            glue = ""
        else:
            out += glue + _token(token, fl)
            glue = f"{fl.space}+"
        last = token
    ends_in_word = whole and bool(re.search(r"\w$", last))
    return out + (fl.word_end if ends_in_word else "")


def phrase(text: str, fl: Flavour = SPARK) -> str:
    """One phrase as a regex without flags."""
    whole = not text.startswith("~")
    words = text.lstrip("~")
    start = fl.word_start if whole else ""
    if " ... " not in words:
        return start + _body(words, fl, whole)
    first, then = words.split(" ... ")
    head, tail = start + _body(first, fl), fl.word_start + _body(then, fl)
    # Only the first A matters, so look for it once: many As without a B stay linear.
    return rf"\A(?>.*?{head}).*?{tail}" if fl.atomic else f"{head}.*?{tail}"


def any_phrase(phrases: list[str], fl: Flavour = SPARK) -> str:
    """Regex that finds any of the phrases; the word-start test is shared between them."""
    shared = [p for p in phrases if not p.startswith("~") and " ... " not in p]
    single = [p for p in phrases if p not in shared]
    parts = [phrase(p, fl) for p in single]
    if shared:
        parts.insert(0, f"{fl.word_start}(?:{'|'.join(_body(p, fl) for p in shared)})")
    return fl.flags + "|".join(parts)


def any_text(texts: list[str], fl: Flavour = SPARK) -> str:
    """Regex that finds any of the literal texts."""
    return fl.flags + "|".join(_piece(t, fl) for t in texts)


def either(*patterns: str, fl: Flavour = SPARK) -> str:
    """Join compiled regexes of one flavour into one."""
    return fl.flags + "|".join(p.removeprefix(fl.flags) for p in patterns)


def is_span(text: str) -> bool:
    return " ... " in text


def longest_word(text: str) -> str:
    """The longest word of a literal text, without which the text cannot occur."""
    return max(re.findall(r"\w+", _PLACEHOLDER.sub(" ", text)), key=len)


def guard_words(text: str) -> list[list[str]]:
    """Plain upper-case words without which a phrase cannot occur.

    One list per part of the phrase; a text that holds no word of some list does not hold the
    phrase, so a plain substring search can rule most texts out before any regex runs.
    """
    guards = []
    for part in text.lstrip("~").split(" ... "):
        best: list[str] = []
        for token in _TOKEN.findall(part):
            if token.startswith("["):
                continue
            # The later words of a phrase are the telling ones; very short ones rule little out.
            words = [max(re.findall(r"\w+|@+", _PLACEHOLDER.sub(" ", t)) or [""], key=len)
                     for t in token.split("/")]
            if not best or min(map(len, words)) >= 3:
                best = words
        guards.append([w.upper() for w in best])
    return guards
