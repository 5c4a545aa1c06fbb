"""Edit-distance matching of strings of any length.

The distance is optimal string alignment: insert, delete, substitute and swap of
two neighbours, no part edited twice.  A swap costs two edits of the plain Levenshtein
distance at most, so for a short word lengths and then ``levenshtein`` at twice the bound
leave few strings, and only these are looked at; without swaps ``levenshtein`` is the distance.
Its work grows with the square of the length, so a long word goes without it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquarry.functions.values import let


#: Longest word for which ``levenshtein`` comes first.
SHORT = 32


def max_edits(fuzziness: int | str, word: str) -> int:
    """Edits allowed for ``word``: 0, 1, 2, ``AUTO`` or ``AUTO:low,high``."""
    text = str(fuzziness).upper()
    if text.startswith("AUTO"):
        low, high = (int(p) for p in text[5:].split(",")) if text[4:] else (3, 6)
        return 0 if len(word) < low else 1 if len(word) < high else 2
    try:
        edits = int(text)
    except ValueError:
        raise ValueError(f"bad fuzziness {fuzziness!r}") from None
    if edits not in (0, 1, 2):
        raise ValueError("fuzziness must be 0, 1, 2 or AUTO")
    return edits


def lengths(word: str, edits: int) -> tuple[int, int]:
    """Shortest and longest string within ``edits`` of ``word``."""
    return max(len(word) - edits, 1), len(word) + edits


def within(value: Column, word: str, edits: int, prefix_length: int = 0,
           transpositions: bool = True) -> Column:
    """Whether a string is within ``edits`` of ``word`` and keeps its prefix."""
    low, high = len(word) - edits, len(word) + edits
    test = F.length(value).between(low, high)
    if prefix_length:
        test &= value.startswith(word[:prefix_length])
    # A kept prefix is not edited, so what follows it is compared alone.
    tail = F.substring(value, prefix_length + 1, high) if prefix_length else value
    rest = word[prefix_length:]
    if len(rest) > SHORT:
        return test & let(tail, lambda v: _near(v, rest, edits, transpositions))
    if not transpositions:
        return test & (F.levenshtein(tail, F.lit(rest), edits) >= 0)
    return test & (F.levenshtein(tail, F.lit(rest), 2 * edits) >= 0) & let(
        tail, lambda v: _near(v, rest, edits, True))


def _near(value: Column, word: str, edits: int, swaps: bool) -> Column:
    """Whether one or two edits lead from a string to a word.

    What both begin and end with alike is cut off; that changes no distance.  If anything is left
    of both, first and last characters differ, so there is an edit at either end and, with
    two edits, nothing but equal characters in between: each first edit puts the rest on
    one diagonal, which has to reach the last edit in one slide.
    """
    def middle(sides: Column) -> Column:
        low, high = sides["begin"], sides["end"]
        parts = F.struct(F.substring(value, low + 1, sides["size"] - low - high).alias("a"),
                         F.substring(F.lit(word), low + 1, len(word) - low - high).alias("b"))
        return let(parts, lambda p: _edited(p["a"], p["b"], edits, swaps))

    def ends(begin: Column) -> Column:
        size = F.length(value)
        end = let(F.reverse(value), lambda v: _alike(v, word[::-1], F.least(size, F.lit(len(word))) - begin))
        return let(F.struct(begin.alias("begin"), end.alias("end"), size.alias("size")), middle)

    return let(_alike(value, word, F.least(F.length(value), F.lit(len(word)))), ends)


def _alike(value: Column, word: str, most: Column) -> Column:
    """How many characters both begin with, ``most`` at most, by halving steps."""
    steps = [1 << n for n in reversed(range(len(word).bit_length()))]

    def further(at: Column, step: Column) -> Column:
        same = F.substring(value, at + 1, step) == F.substring(F.lit(word), at + 1, step)
        return F.when((at + step <= most) & same, at + step).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)).cast("array<int>"), F.lit(0), further)


def _from(text: Column, start: int) -> Column:
    return F.substring(text, F.lit(start + 1), F.length(text))


def _without(text: Column, end: int) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - end)


def _edited(a: Column, b: Column, edits: int, swaps: bool) -> Column:
    """The same of two strings that neither begin nor end alike."""
    m, n = F.length(a), F.length(b)
    one = (m <= 1) & (n <= 1)
    if swaps:
        one |= (m == 2) & (n == 2) & (a == F.reverse(b))
    if edits == 1:
        return one
    firsts = [((m >= 1) & (n >= 1), _from(a, 1), _from(b, 1)), (m >= 1, _from(a, 1), b), (n >= 1, a, _from(b, 1))]
    if swaps:
        swapped = (m >= 2) & (n >= 2) & (F.substring(a, 1, 2) == F.reverse(F.substring(b, 1, 2)))
        firsts.append((swapped, _from(a, 2), _from(b, 2)))
    tests = [one]
    for possible, rest, other in firsts:
        tests.append(possible & let(F.struct(rest.alias("r"), other.alias("o")), lambda p: _last_edit(p["r"], p["o"], swaps)))
    return reduce(lambda x, y: x | y, tests)


def _last_edit(r: Column, o: Column, swaps: bool) -> Column:
    """Nothing is left, or one edit at the end."""
    m, n = F.length(r), F.length(o)
    found = ((r == o) | ((m >= 1) & (n >= 1) & (_without(r, 1) == _without(o, 1)))
             | ((m >= 1) & (_without(r, 1) == o)) | ((n >= 1) & (r == _without(o, 1))))
    if not swaps:
        return found
    return found | ((m >= 2) & (n >= 2) & (_without(r, 2) == _without(o, 2))
                    & (F.right(r, F.lit(2)) == F.reverse(F.right(o, F.lit(2)))))
