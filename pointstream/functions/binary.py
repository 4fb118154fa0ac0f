"""Column functions over BINARY: hex text and little-endian fields.

All of them are built-in expressions, so a decode stays in whole-stage codegen.
Offsets are 1-based, as in ``substring``.
"""

from pyspark.sql import Column, functions as F

from pointstream.schemas import HEADER_BYTES

ColumnOrName = Column | str

_SIGN_BIT = 1 << 31
_EXPONENT_MASK = 0xFF
_FRACTION_BITS = 23
_FRACTION_MASK = (1 << _FRACTION_BITS) - 1


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def hex_text(payload: ColumnOrName) -> Column:
    """Bytes as upper-case hex text."""
    return F.hex(_col(payload))


def strip_header_text(text: ColumnOrName) -> Column:
    """Hex text without the datagram header (two characters per byte)."""
    return _col(text).substr(F.lit(2 * HEADER_BYTES + 1), F.length(_col(text)))


def hex_bytes(text: ColumnOrName) -> Column:
    """Hex text back to bytes."""
    return F.unhex(_col(text))


def unsigned_word(data: ColumnOrName, offset: int, length: int) -> Column:
    """``length`` bytes (1 to 7) read big-endian as a non-negative BIGINT."""
    return F.conv(F.hex(F.substring(_col(data), offset, length)), 16, 10).cast("bigint")


def packed_word(data: ColumnOrName, offset: int) -> Column:
    """Eight bytes read big-endian as the 64 bits of a signed BIGINT."""
    return F.conv(F.hex(F.substring(_col(data), offset, 8)), 16, -10).cast("bigint")


def swap32(word: Column) -> Column:
    """The low 32 bits of a BIGINT with their four bytes in reverse order, unsigned."""
    return (
        word.bitwiseAND(0xFF) * (1 << 24)
        + F.shiftright(word, 8).bitwiseAND(0xFF) * (1 << 16)
        + F.shiftright(word, 16).bitwiseAND(0xFF) * (1 << 8)
        + F.shiftright(word, 24).bitwiseAND(0xFF)
    )


def signed32(bits: Column) -> Column:
    """Unsigned 32-bit pattern as the signed number it stands for (BIGINT)."""
    return F.when(bits >= _SIGN_BIT, bits - (1 << 32)).otherwise(bits)


def float32_of_bits(bits: Column) -> Column:
    """IEEE-754 single-precision pattern as FLOAT, bit for bit.

    Every step is exact in double precision: the significand is an integer
    below 2^24 and the scale is a power of two.
    """
    exponent = F.shiftright(bits, _FRACTION_BITS).bitwiseAND(_EXPONENT_MASK)
    fraction = bits.bitwiseAND(_FRACTION_MASK)
    magnitude = (
        F.when(
            exponent == _EXPONENT_MASK,
            F.when(fraction == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan"))),
        )
        .when(exponent == 0, fraction * F.lit(2.0**-149))
        .otherwise((fraction + (1 << _FRACTION_BITS)) * F.pow(F.lit(2.0), exponent - 150))
    )
    sign = F.when(bits >= _SIGN_BIT, F.lit(-1.0)).otherwise(F.lit(1.0))
    return (sign * magnitude).cast("float")


def le_int32(data: ColumnOrName, offset: int) -> Column:
    """Signed little-endian 32-bit integer at a byte offset."""
    return signed32(swap32(unsigned_word(data, offset, 4))).cast("int")


def le_float32(data: ColumnOrName, offset: int) -> Column:
    """Little-endian IEEE-754 single at a byte offset."""
    return float32_of_bits(swap32(unsigned_word(data, offset, 4)))


def unsigned_byte(data: ColumnOrName, offset: int) -> Column:
    """Byte at an offset as 0 to 255."""
    return unsigned_word(data, offset, 1).cast("int")
