"""Internet addresses in order: texts as 16 bytes, blocks as intervals.

Both families share one line of 16 bytes: an IPv4 address stands at its place among IPv6
addresses (``::ffff:a.b.c.d``).  Bytes compare as addresses do, texts don't.
"""

from __future__ import annotations

import ipaddress
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquarry.functions.values import Unparsable, let

BYTES = 16
_MAPPED = "00000000000000000000ffff"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DOTTED = rf"{_OCTET}(?:\.{_OCTET}){{3}}"


def packed(value: Any) -> bytes:
    """One address as its bytes."""
    try:
        found = ipaddress.ip_address(str(value))
    except ValueError:
        raise Unparsable(f"{value!r} is not an address") from None
    if found.version == 4:
        return bytes.fromhex(_MAPPED) + found.packed
    if found.scope_id:
        raise Unparsable(f"{value!r} has a zone")
    return found.packed


def block(value: Any) -> tuple[bytes, bytes]:
    """First and last address of ``address/bits``; an address is a block of one."""
    text = str(value)
    address, slash, bits = text.partition("/")
    first = packed(address)
    if not slash:
        return first, first
    shift = 96 if "." in address and ":" not in address else 0
    if not bits.isascii() or not bits.isdigit() or int(bits) > 128 - shift:
        raise Unparsable(f"{value!r} is not a block of addresses")
    free = (1 << (128 - shift - int(bits))) - 1
    low = int.from_bytes(first, "big") & ~free
    return low.to_bytes(BYTES, "big"), (low | free).to_bytes(BYTES, "big")


def literal(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(packed(value))


def _hex(text: Column) -> Column:
    """32 hexadecimal digits of an address, null if it is none."""
    def family(low: Column) -> Column:
        four = F.concat(F.lit(_MAPPED), _quad(low))
        return F.when(low.rlike(f"^{_DOTTED}$"), four).when(F.contains(low, F.lit(":")), let(_long(low), _six))
    return let(F.lower(text), family)


def _quad(dotted: Column) -> Column:
    """Eight digits of four octets."""
    return F.array_join(F.transform(
        F.split(dotted, r"\."), lambda o: F.lpad(F.hex(o.try_cast("long")), 2, "0")), "")


def _long(low: Column) -> Column:
    """An IPv6 address whose dotted end, if any, is spelled as two groups; null if that end is bad."""
    def joined(tail: Column) -> Column:
        quad = let(_quad(tail), lambda q: F.concat(F.substring(q, 1, 4), F.lit(":"), F.substring(q, 5, 4)))
        head = F.substring(low, F.lit(1), F.length(low) - F.length(tail))
        return F.when(~F.contains(tail, F.lit(".")), low).when(tail.rlike(f"^{_DOTTED}$"), F.concat(head, quad))
    return let(F.substring_index(low, ":", -1), joined)


def _six(low: Column) -> Column:
    """Digits of eight groups, those between two colons filled in."""
    def groups(half: Column) -> Column:
        return F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":", -1))

    def filled(halves: Column) -> Column:
        sides = F.struct(groups(F.get(halves, 0)).alias("left"),
                         groups(F.coalesce(F.get(halves, 1), F.lit(""))).alias("right"),
                         F.size(halves).alias("halves"))
        return let(sides, whole)

    def whole(sides: Column) -> Column:
        left, right = sides["left"], sides["right"]
        known = F.size(left) + F.size(right)
        fits = ((sides["halves"] == 1) & (known == 8)) | ((sides["halves"] == 2) & (known <= 7))
        valid = F.forall(F.concat(left, right), lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        digits = lambda part: F.array_join(F.transform(part, lambda g: F.lpad(g, 4, "0")), "")
        return F.when(fits & valid, F.concat(
            digits(left), F.repeat(F.lit("0000"), (8 - known).cast("int")), digits(right)))

    return let(F.split(low, "::", -1), filled)


def ordered(text: Column) -> Column:
    """An address column as its 16 bytes; null where the text is no address."""
    return F.unhex(_hex(text))


def checked(text: Column) -> Column:
    """The text if it is an address, else null."""
    return F.when(_hex(text).isNotNull(), text)


def spelled(address: Column) -> Column:
    """Bytes as text: dotted if IPv4, else eight groups of four digits."""
    return _spelled(F.lower(F.hex(address)))


def _spelled(hexadecimal: Column) -> Column:
    def text(digits: Column) -> Column:
        dotted = F.concat_ws(".", *[F.conv(F.substring(digits, i, 2), 16, 10) for i in (25, 27, 29, 31)])
        groups = F.concat_ws(":", *[F.substring(digits, i, 4) for i in range(1, 33, 4)])
        return F.when(digits.isNotNull(), F.when(digits.startswith(_MAPPED), dotted).otherwise(groups))
    return let(hexadecimal, text)


def bounds(text: Column) -> Column:
    """A block column as texts ``gte`` and ``lte``; a plain address is a block of one."""
    def of_parts(parts: Column) -> Column:
        given = F.get(parts, 1)
        shift = F.when(F.contains(F.get(parts, 0), F.lit(":")), 0).otherwise(96)
        wanted = F.when(F.size(parts) == 1, F.lit(128)).when(
            (F.size(parts) == 2) & given.rlike("^[0-9]{1,3}$"), given.try_cast("int") + shift)
        return let(F.struct(_hex(F.get(parts, 0)).alias("digits"), wanted.alias("bits")), both)

    def both(block_: Column) -> Column:
        digits, bits = block_["digits"], block_["bits"]

        def end(last: bool) -> Column:
            def octet(i: Column) -> Column:
                value = F.conv(F.substring(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
                free = F.element_at(F.array(*[F.lit((1 << n) - 1) for n in range(9)]),
                                    (F.least(F.greatest(8 * (i + 1) - bits, F.lit(0)), F.lit(8)) + 1).cast("int"))
                kept = value.bitwiseOR(free) if last else value.bitwiseAND(255 - free)
                return F.lower(F.lpad(F.hex(kept.cast("long")), 2, "0"))
            return _spelled(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BYTES - 1)), octet), ""))

        return F.when(digits.isNotNull() & (bits <= 128), F.struct(end(False).alias("gte"), end(True).alias("lte")))

    return let(F.split(text, "/", -1), of_parts)
