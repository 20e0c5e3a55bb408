"""Hex payload decoding: integers, words, addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH = 64  # digits of a 256-bit word
LIMB = 15  # hex digits per limb: 60 bits, always inside a BIGINT


def _is_hex(col: Column) -> Column:
    return (F.length(col) <= WIDTH + 2) & col.rlike("^0[xX][0-9a-fA-F]+$")


def _word(col: Column) -> Column:
    """Digits without prefix, padded to a whole word."""
    return F.lpad(F.substring(col, 3, WIDTH), WIDTH, "0")


def _limb(col: Column, index: int) -> Column:
    """60-bit piece of a word, counted from its low end, as BIGINT."""
    start = max(WIDTH - LIMB * (index + 1), 0)
    width = min(LIMB, WIDTH - LIMB * index)
    return F.conv(F.substring(_word(col), start + 1, width), 16, 10).cast("bigint")


def _zeros(col: Column, digits: int) -> Column:
    """Whether the first `digits` digits of the word are all 0."""
    return F.substring(_word(col), 1, digits) == F.lit("0" * digits)


def _fits(col: Column, digits: int) -> Column:
    """Whether the text is a hex word whose value needs at most `digits` digits."""
    return col.rlike(f"^0[xX]0{{0,{WIDTH - digits}}}[0-9a-fA-F]{{1,{digits}}}$")


def _short(col: Column) -> Column:
    """Value of a text that fits one limb."""
    return F.conv(F.substring(col, 3, WIDTH), 16, 10).cast("bigint")


def hex_long(col: Column) -> Column:
    """Hex text to BIGINT; NULL for non-hex text and beyond 60 bits."""
    return F.when(_fits(col, LIMB), _short(col))


def hex_dec(col: Column) -> Column:
    """Hex text to DECIMAL(38,0); NULL where 38 digits do not hold the value."""
    wide = lambda c: c.cast("decimal(20,0)")
    step = lambda n: F.lit(str(16 ** (LIMB * n))).cast("decimal(38,0)")
    # Two limbs stay below 16^30, so this sum cannot overflow.
    middle = (wide(_limb(col, 1)) * F.lit(str(16**LIMB)).cast("decimal(20,0)") + wide(_limb(col, 0))).cast("decimal(38,0)")
    top = F.conv(F.substring(_word(col), WIDTH - 31, 2), 16, 10).cast("decimal(3,0)")
    whole = F.try_add(F.try_multiply(top, step(2)).cast("decimal(38,0)"), middle)
    return F.when(_fits(col, LIMB), _short(col).cast("decimal(38,0)")) \
        .when(_fits(col, 32), whole.cast("decimal(38,0)"))


def hex_dbl(col: Column) -> Column:
    """Hex text to DOUBLE: exact decimal first, limb sum beyond 38 digits."""
    total = _limb(col, 4).cast("double") * F.lit(float(16 ** (4 * LIMB)))
    for i in range(3, -1, -1):
        total = total + _limb(col, i).cast("double") * F.lit(float(16 ** (LIMB * i)))
    return F.coalesce(hex_dec(col).cast("double"), F.when(_is_hex(col), total))


PIECE = 7         # hex digits per step of the long conversion; a step stays inside a BIGINT
BASE = 10**9      # nine decimal digits


def _long_division(digits: Column, base: int, count: int) -> Column:
    """`count` limbs to the given base, high one first, of 70 hex digits read from their high end.

    A limb is the sum of what each piece adds to it, plus one carry; ten such products stay inside a BIGINT.
    """
    # What piece i adds to limb j, for each one; low pieces add nothing to high limbs.
    weights = [[(i, 16 ** (PIECE * (9 - i)) // base**j % base) for i in range(10)] for j in range(count)]
    long = lambda n: F.lit(n).cast("bigint")
    once = lambda col, use: F.get(F.transform(F.array(col), use), F.lit(0))
    pieces = once(digits, lambda d: F.array(*[
        F.conv(F.substring(d, i * PIECE + 1, PIECE), 16, 10).cast("bigint") for i in range(10)]))
    sums = once(pieces, lambda p: F.array(*[reduce(
        lambda a, b: a + b, [F.get(p, F.lit(i)) * long(n) for i, n in limb if n] or [long(0)]) for limb in weights]))

    def carry(state: Column, limb: Column) -> Column:
        value = limb + state["carry"]
        return F.struct(F.call_function("div", value, F.lit(base).cast("bigint")).alias("carry"),
                        F.concat(state["out"], F.array(value % base)).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("out"))
    return F.reverse(F.aggregate(sums, start, carry)["out"])


def _long_text(col: Column) -> Column:
    """Decimal text of a whole word, piece by piece from its high end."""
    limbs = _long_division(F.lpad(_word(col), 70, "0"), BASE, 9)
    text = F.array_join(F.transform(limbs, lambda d: F.lpad(d.cast("string"), 9, "0")), "")
    return F.ltrim(text, F.lit("0"))


def hex_text(col: Column | str) -> Column:
    """Exact decimal text of a hex integer of up to 256 bits; NULL for any other text."""
    col = F.col(col) if isinstance(col, str) else col
    short = hex_dec(col)
    return F.when(short.isNotNull(), short.cast("string")).when(_is_hex(col), _long_text(col))


def text_long(col: Column) -> Column:
    """Decimal text to BIGINT, NULL on blanks and garbage."""
    return col.try_cast("bigint")


def word_address(col: Column) -> Column:
    """Address in the last 40 digits of a word; shorter text only lower-cased."""
    return F.when(
        F.length(col) >= 40, F.concat(F.lit("0x"), F.right(F.lower(col), F.lit(40)))
    ).otherwise(F.lower(col))


def word_count(col: Column) -> Column:
    """Number of words of a `0x` payload, the last one possibly short."""
    digits = F.coalesce(F.length(col), F.lit(0)) - 2
    return F.when(digits > 0, F.ceil(digits / WIDTH).cast("int")).otherwise(0)


def word_at(col: Column, index: Column) -> Column:
    """0-based word of a payload, with prefix."""
    return F.concat(F.lit("0x"), F.substring(col, index * WIDTH + 3, F.lit(WIDTH)))


def words(col: Column) -> Column:
    """`0x` payload to its 64-digit words, each with prefix; blank payload to []."""
    count = word_count(col)
    parts = F.transform(
        F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: word_at(col, i)
    )
    return F.when(count > 0, parts).otherwise(F.array().cast("array<string>"))


def item(array: Column, index: int) -> Column:
    """1-based array element, NULL past the end."""
    return F.get(array, F.lit(index - 1))


ALPHABET58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"  # fixed value


BASE58 = 58**5  # five characters of a content id


def base58(col: Column | str) -> Column:
    """Hex digest of up to 32 bytes to its base-58 content id (sha2-256 multihash); NULL for any other text."""
    col = F.col(col) if isinstance(col, str) else col
    good = (F.length(col) <= WIDTH + 2) & (F.length(col) % 2 == 0) & col.rlike("^0x[0-9a-fA-F]*$")
    limbs = _long_division(F.lpad(F.concat(F.lit("1220"), F.substring(col, 3, WIDTH)), 70, "0"), BASE58, 10)

    def letters(limb: Column) -> Column:
        at = lambda k: F.call_function("div", limb, F.lit(58**k).cast("bigint")) % 58 + 1
        return F.concat(*[F.substring(F.lit(ALPHABET58), at(k).cast("int"), F.lit(1)) for k in range(4, -1, -1)])

    return F.when(good, F.ltrim(F.array_join(F.transform(limbs, letters), ""), F.lit(ALPHABET58[0])))
