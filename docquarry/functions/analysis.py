"""Text analysis as native Spark expressions.

An :class:`Analyzer` says which characters form a token.  The same rule is used
three ways: to split a column into tokens, to split a short query string on the
driver, and to build a regular expression that finds a whole token inside a raw
text.  The last form lets most text predicates run as one ``rlike`` without
materialising a token array.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The common English stop word list of the "stop" token filter.
ENGLISH_STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such "
    "that the their then there these they this to was will with"
).split()

# The ASCII white space that Java's \s stands for.
_ASCII_SPACE = " \t\n\x0b\f\r"


def _word_char(ch: str) -> bool:
    return ch == "_" or unicodedata.category(ch)[0] in "LN"


def _letter(ch: str) -> bool:
    return unicodedata.category(ch)[0] == "L"


def _not_space(ch: str) -> bool:
    return ch not in _ASCII_SPACE


@dataclass(frozen=True)
class Analyzer:
    """Token rule: a character class, lower-casing and stop words.

    ``inside`` is the Java character class of a token character and ``is_inside``
    the same test for one character on the driver.  ``whole`` keeps the value as a
    single token.
    """

    inside: str = r"[\p{L}\p{N}_]"
    is_inside: Callable[[str], bool] = _word_char
    lowercase: bool = True
    stop_words: frozenset[str] = frozenset()
    whole: bool = False

    def with_stop_words(self, words: Iterable[str] = ENGLISH_STOP_WORDS) -> Analyzer:
        return replace(self, stop_words=frozenset(words))

    def lowered(self) -> Analyzer:
        """The same rule over lower-cased text, for comparing without regard to case."""
        return self if self.lowercase else replace(
            self, lowercase=True, stop_words=frozenset(w.lower() for w in self.stop_words))

    # -- column side -----------------------------------------------------
    def text(self, col: Column) -> Column:
        return F.lower(col) if self.lowercase else col

    def tokens(self, col: Column, shortest: int = 1, longest: int | None = None) -> Column:
        """Tokens of a text column, in order, repeats kept; of certain lengths, if given."""
        if self.whole:
            parts = F.when(col.isNotNull(), F.array(self.text(col)))
        else:
            pattern = self.inside + "+" if longest is None else (
                f"(?<!{self.inside}){self.inside}{{{shortest},{longest}}}+(?!{self.inside})")
            # Unlike split, this compiles the pattern once and not for every row.
            parts = F.regexp_extract_all(self.text(col), F.lit(pattern), F.lit(0))
        if self.stop_words:
            stop = sorted(self.stop_words)
            parts = F.filter(parts, lambda t: ~t.isin(stop))
        return parts

    def token_regex(self, body: str) -> str:
        """Regex that finds a whole token matching ``body`` inside a text."""
        if self.whole:
            return rf"(?s)\A(?:{body})\z"
        return f"(?<!{self.inside})(?:{body})(?!{self.inside})"

    def any_char(self) -> str:
        return r"[\s\S]" if self.whole else self.inside

    def produces(self, word: str) -> bool:
        """Whether ``word`` can occur as a token of this analyzer."""
        return self.split(word) == [word]

    @property
    def plain(self) -> bool:
        """A value is its own single token: stored tokens are used as they are."""
        return self.whole and not self.lowercase and not self.stop_words

    # -- driver side -----------------------------------------------------
    def split(self, text: str) -> list[str]:
        """Tokens of a query string."""
        text = text.lower() if self.lowercase else text
        if self.whole:
            parts = [text]
        else:
            parts = "".join(c if self.is_inside(c) else "\n" for c in text).split("\n")
        return [p for p in parts if p and p not in self.stop_words]

    # -- predicates ------------------------------------------------------
    def has_any(self, col: Column, words: Iterable[str]) -> Column:
        """At least one of the words is a token of ``col``."""
        words = [w for w in dict.fromkeys(words) if self.produces(w)]
        if not words:
            return F.lit(False)
        text = self.text(col)
        # Contains is a cheap byte search; it spares the regex on most non-matches.
        near = reduce(lambda a, b: a | b, [text.contains(w) for w in words])
        return near & text.rlike(self.token_regex("|".join(map(quote, words))))

    def has_all(self, col: Column, words: Iterable[str]) -> Column:
        words = list(dict.fromkeys(words))
        return reduce(lambda a, b: a & b, [self.has_any(col, [w]) for w in words])


def quote(text: str) -> str:
    """Escape a literal for a Java regular expression."""
    return "".join(c if c.isalnum() or c == "_" or ord(c) > 127 else "\\" + c for c in text)


STANDARD = Analyzer()
ANALYZERS: dict[str, Analyzer] = {
    "standard": STANDARD,
    "simple": Analyzer(r"\p{L}", _letter),
    "stop": Analyzer(r"\p{L}", _letter).with_stop_words(),
    "whitespace": Analyzer(r"\S", _not_space, lowercase=False),
    "keyword": Analyzer(whole=True, lowercase=False),
}


def analyzer(spec: str | Analyzer | None) -> Analyzer:
    """Look up an analyzer by name; an :class:`Analyzer` passes through."""
    if isinstance(spec, Analyzer):
        return spec
    try:
        return ANALYZERS[spec or "standard"]
    except KeyError:
        raise ValueError(f"unknown analyzer {spec!r}") from None


@dataclass(frozen=True)
class Normalizer:
    """Whole-value clean-up of a keyword column."""

    lowercase: bool = True
    trim: bool = False
    translate: tuple[str, str] | None = None

    def apply(self, col: Column) -> Column:
        if self.trim:
            col = F.trim(col)
        if self.lowercase:
            col = F.lower(col)
        if self.translate:
            col = F.translate(col, *self.translate)
        return col

    def query(self, value: str) -> str:
        """The same for a value that is searched for."""
        value = value.strip(" ") if self.trim else value
        value = value.lower() if self.lowercase else value
        if self.translate:
            old, new = self.translate
            value = value.translate({ord(c): new[i] if i < len(new) else None
                                     for i, c in enumerate(old)})
        return value


NORMALIZERS: dict[str, Normalizer] = {
    "lowercase": Normalizer(),
    "trim": Normalizer(lowercase=False, trim=True),
    "lowercase_trim": Normalizer(trim=True),
}


def normalizer(spec: str | Mapping | Normalizer) -> Normalizer:
    """Look up a normalizer by name, or read it from stored field options."""
    if isinstance(spec, Normalizer):
        return spec
    if isinstance(spec, Mapping):
        pair = spec.get("translate")
        return Normalizer(**{**spec, "translate": tuple(pair) if pair else None})
    try:
        return NORMALIZERS[spec]
    except KeyError:
        raise ValueError(f"unknown normalizer {spec!r}") from None
