"""Geohash cells in closed form.

Each axis is cut into ``2**bits`` equal cells and a cell owns its *upper* edge,
so its number is ``ceil(x / size) - 1`` counted from the lower end. The two cell
numbers are interleaved bit by bit, longitude first, five bits to a character.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerocell.schemas import GEOHASH_ALPHABET, GEOHASH_PRECISION

LON_SPAN, LAT_SPAN = 360.0, 180.0


def axis_bits(precision: int) -> tuple[int, int]:
    """Number of (longitude, latitude) bits in a code of this many characters."""
    total = 5 * precision
    return total - total // 2, total // 2


def _cell_number(value: Column, span: float, bits: int) -> Column:
    half = 1 << (bits - 1)
    number = F.ceil(value / F.lit(span / (1 << bits))) + F.lit(half - 1)
    return F.greatest(F.lit(0), F.least(F.lit(2 * half - 1), number))


def _character_table(lon_bits: int, lat_bits: int, lon_first: bool) -> str:
    """The alphabet ordered by (longitude bits, latitude bits) of one character."""

    def digit(lon: int, lat: int) -> int:
        axes = [[lon, lon_bits], [lat, lat_bits]]
        turn, value = (0 if lon_first else 1), 0
        for _ in range(5):
            axes[turn][1] -= 1
            value = 2 * value + (axes[turn][0] >> axes[turn][1] & 1)
            turn = 1 - turn
        return value

    return "".join(
        GEOHASH_ALPHABET[digit(lon, lat)] for lon in range(1 << lon_bits) for lat in range(1 << lat_bits)
    )


# Characters take turns: the first, third, .. hold three longitude bits, the others two.
_TABLES = (_character_table(3, 2, True), _character_table(2, 3, False))


def character_tables() -> tuple[str, str]:
    """The alphabets of the characters at even and at odd places, in the order of their bits by axis."""
    return _TABLES


def _cell_of(value: float, span: float, bits: int) -> int:
    half = 1 << (bits - 1)
    return max(0, min(2 * half - 1, math.ceil(value / (span / (1 << bits))) + half - 1))


def _code(number: int, precision: int) -> str:
    return "".join(GEOHASH_ALPHABET[number >> 5 * (precision - 1 - p) & 31] for p in range(precision))


def box_cover(
    lamin: float, lamax: float, lomin: float, lomax: float, precision: int = GEOHASH_PRECISION, most: int = 32
) -> list[tuple[str, str]]:
    """At most ``most`` ranges of codes that together hold every cell of a box, ends included.

    Codes follow the halving of the earth, a bit of longitude and one of
    latitude in turn, so every part of that tree is one range. The part with the
    most cells outside the box is halved next, until the ranges would be too
    many or fit exactly. A box with its ends the wrong way round holds nothing.
    """
    lon_bits, lat_bits = axis_bits(precision)
    total = lon_bits + lat_bits
    box = (
        (_cell_of(lomin, LON_SPAN, lon_bits), _cell_of(lomax, LON_SPAN, lon_bits)),
        (_cell_of(lamin, LAT_SPAN, lat_bits), _cell_of(lamax, LAT_SPAN, lat_bits)),
    )
    if lamin > lamax or lomin > lomax:
        return []

    def part(lon: int, lat: int, lon_left: int, lat_left: int):
        """``(cells outside, corner, bits left)`` of a part that meets the box, else None."""
        inside = 1
        for (low, high), first, left in ((box[0], lon, lon_left), (box[1], lat, lat_left)):
            inside *= max(0, min(high, first + (1 << left) - 1) - max(low, first) + 1)
        return ((inside - (1 << (lon_left + lat_left))), lon, lat, lon_left, lat_left) if inside else None

    # A heap of negative waste: the most wasteful part comes first.
    parts = [part(0, 0, lon_bits, lat_bits)]
    while parts[0][0] < 0 and len(parts) < most:
        _, lon, lat, lon_left, lat_left = heapq.heappop(parts)
        if (total - lon_left - lat_left) % 2 == 0:
            halves = [part(lon + k * (1 << (lon_left - 1)), lat, lon_left - 1, lat_left) for k in (0, 1)]
        else:
            halves = [part(lon, lat + k * (1 << (lat_left - 1)), lon_left, lat_left - 1) for k in (0, 1)]
        for half in filter(None, halves):
            heapq.heappush(parts, half)

    def number(lon: int, lat: int) -> int:
        code = 0
        for nth in range(total):
            axis, left = (lon, lon_bits) if nth % 2 == 0 else (lat, lat_bits)
            code = 2 * code + (axis >> (left - 1 - nth // 2) & 1)
        return code

    ranges: list[list[int]] = []
    for low, cells in sorted((number(lon, lat), 1 << (a + b)) for _, lon, lat, a, b in parts):
        if ranges and ranges[-1][1] + 1 == low:
            ranges[-1][1] = low + cells - 1
        else:
            ranges.append([low, low + cells - 1])
    return [(_code(low, precision), _code(high, precision)) for low, high in ranges]


def geohash(lat: Column, lon: Column, precision: int = GEOHASH_PRECISION) -> Column:
    """Code of the cell holding a point; null when a coordinate is missing."""
    lon_left, lat_left = axis_bits(precision)
    lon_cell = _cell_number(lon, LON_SPAN, lon_left)
    lat_cell = _cell_number(lat, LAT_SPAN, lat_left)
    characters = []
    for position in range(precision):
        lon_take, lat_take = (3, 2) if position % 2 == 0 else (2, 3)
        lon_left, lat_left = lon_left - lon_take, lat_left - lat_take
        # The bits this character adds, longitude in the high part of the table index.
        high = F.shiftright(lon_cell, lon_left).bitwiseAND(F.lit((1 << lon_take) - 1))
        low = F.shiftright(lat_cell, lat_left).bitwiseAND(F.lit((1 << lat_take) - 1))
        index = (high * F.lit(1 << lat_take) + low + F.lit(1)).cast("int")
        characters.append(F.substring(F.lit(_TABLES[position % 2]), index, F.lit(1)))
    # greatest and least skip nulls, so a missing coordinate is handled here.
    return F.when(lat.isNotNull() & lon.isNotNull(), F.concat(*characters))


def geohash_centroid(code: Column, precision: int = GEOHASH_PRECISION) -> Column:
    """Struct ``(lat, lon)`` of a cell's centre, four decimals.

    Null when the code is not of this precision or holds a foreign character.
    """
    lowered = F.lower(code)
    digits = [
        F.instr(F.lit(GEOHASH_ALPHABET), F.substring(lowered, p + 1, 1)) - F.lit(1)
        for p in range(precision)
    ]
    valid = F.length(code) == precision
    for digit in digits:
        valid = valid & (digit >= 0)
    numbers = [F.lit(0).cast("bigint"), F.lit(0).cast("bigint")]
    for nth in range(5 * precision):
        bit = F.shiftright(digits[nth // 5], 4 - nth % 5).bitwiseAND(F.lit(1))
        numbers[nth % 2] = numbers[nth % 2] * F.lit(2) + bit
    lon_bits, lat_bits = axis_bits(precision)

    def centre(number: Column, span: float, bits: int) -> Column:
        size = span / (1 << bits)
        return F.round(F.lit(-span / 2) + (number + F.lit(0.5)) * F.lit(size), 4)

    return F.when(
        valid,
        F.struct(
            centre(numbers[1], LAT_SPAN, lat_bits).alias("lat"),
            centre(numbers[0], LON_SPAN, lon_bits).alias("lon"),
        ),
    )
