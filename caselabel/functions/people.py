"""Ages, roles, national and tax ids, and keyed masks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselabel import vocab

#: Rounds of the permutation behind the masks of digits.
ROUNDS = 10


def age_group(age: Column) -> Column:
    """Life-stage group with closed integer bounds; other values have no group."""
    return (
        F.when(age.between(0, 11), vocab.AGE_GROUPS[0])
        .when(age.between(12, 17), vocab.AGE_GROUPS[1])
        .when(age.between(18, 29), vocab.AGE_GROUPS[2])
        .when(age.between(30, 64), vocab.AGE_GROUPS[3])
        .when(age.between(65, 100), vocab.AGE_GROUPS[4])
        .otherwise(vocab.NO_INFORMATION)
    )


def age_band(age: Column) -> Column:
    """Age band with half-open bounds up to 100."""
    return (
        F.when((age < 0) | (age > 100), vocab.NO_INFORMATION)
        .when(age < 15, vocab.AGE_BANDS[0])
        .when(age < 25, vocab.AGE_BANDS[1])
        .when(age < 35, vocab.AGE_BANDS[2])
        .when(age < 45, vocab.AGE_BANDS[3])
        .when(age < 65, vocab.AGE_BANDS[4])
        .when(age <= 100, vocab.AGE_BANDS[5])
        .otherwise(vocab.NO_INFORMATION)
    )


def is_minor(age: Column) -> Column:
    """Minor, adult or, for a negative or missing age, no information."""
    return (
        F.when(age.isNull() | (age < 0), vocab.NO_INFORMATION)
        .when(age < 18, vocab.MINOR)
        .otherwise(vocab.ADULT)
    )


def valid_id_card(card: Column) -> Column:
    """True for a ten-digit national id whose last digit is the mod-10 check."""
    total = F.lit(0)
    for position in range(1, 10):
        digit = F.substring(card, position, 1).try_cast("int")
        if position % 2:
            doubled = 2 * digit
            digit = F.when(doubled > 9, doubled - 9).otherwise(doubled)
        total = total + digit
    check = F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10))
    well_formed = card.rlike("^[0-9]{10}$") & (card != "0" * 10)
    return F.coalesce(well_formed & (check == F.substring(card, 10, 1).try_cast("int")), F.lit(False))


def valid_tax_id(tax_id: Column) -> Column:
    """True for 13 digits that end in 001 and start with a valid national id."""
    shaped = tax_id.rlike("^[0-9]{10}001$")
    return F.coalesce(shaped & valid_id_card(F.substring(tax_id, 1, 10)), F.lit(False))


def masked_digits(value: Column, secret: str, width: int = vocab.KEY_WIDTH) -> Column:
    """Repeatable mask of a key of ``width`` digits, again ``width`` digits and different for every key.

    A keyed permutation: the key's digits are cut into two halves, and each of
    ``ROUNDS`` rounds adds to one half, modulo its size, a keyed hash of the other
    half.  Such a round can be undone (``unmasked_digits``), so two keys never
    share a mask.  Any other text, of another length or with other characters,
    gets its whole hash (``masked_hex``), which no key of digits can get.
    """
    return _permuted(value, secret, width, range(ROUNDS), 1, masked_hex(value, secret))


def unmasked_digits(mask: Column, secret: str, width: int = vocab.KEY_WIDTH) -> Column:
    """The key that ``masked_digits`` has masked; NULL for what is no mask of digits."""
    return _permuted(mask, secret, width, range(ROUNDS - 1, -1, -1), -1, F.lit(None).cast("string"))


def _permuted(value: Column, secret: str, width: int, rounds: Iterable[int], sign: int, otherwise: Column) -> Column:
    if not 2 <= width <= 17:
        raise ValueError("a mask has between 2 and 17 digits")
    _require(secret)
    high, low = 10 ** (width // 2), 10 ** (width - width // 2)
    number = value.try_cast("bigint")

    def added(round_: Column, half: Column, other: Column, size: int) -> Column:
        hashed = _keyed(F.concat_ws(":", round_.cast("string"), other.cast("string")), secret)
        step = F.conv(F.substring(hashed, 1, 15), 16, 10).cast("bigint")
        return F.pmod(half + F.lit(sign) * F.pmod(step, F.lit(size)), F.lit(size))

    def turn(halves: Column, round_: Column) -> Column:
        even = round_ % 2 == 0
        return F.struct(
            F.when(even, added(round_, halves["high"], halves["low"], high)).otherwise(halves["high"]).cast("bigint").alias("high"),
            F.when(even, halves["low"]).otherwise(added(round_, halves["low"], halves["high"], low)).cast("bigint").alias("low"),
        )

    low_size = F.lit(low).cast("bigint")
    halves = F.struct(F.call_function("div", number, low_size).alias("high"), F.pmod(number, low_size).alias("low"))
    turned = F.aggregate(F.array(*[F.lit(r) for r in rounds]), halves, turn, lambda h: h["high"] * F.lit(low) + h["low"])
    shaped = value.rlike(f"^[0-9]{{{width}}}$")
    return F.when(shaped, F.lpad(turned.cast("string"), width, "0")).when(value.isNotNull(), otherwise)


def masked_hex(value: Column, secret: str) -> Column:
    """Repeatable mask that keeps the whole keyed SHA-256 as hex text."""
    return _keyed(value, secret)


def masked_name(value: Column, secret: str, prefix: str = "nombre_") -> Column:
    """Repeatable pseudonym ``nombre_<hash>``; names need no fixed width, so the whole hash is kept."""
    return F.concat(F.lit(prefix), masked_hex(value, secret))


def _require(secret: str) -> None:
    if not secret:
        raise ValueError("masking needs a secret; plain hashes of short keys can be listed")


def _keyed(value: Column, secret: str) -> Column:
    _require(secret)
    return F.sha2(F.concat(F.lit(secret), value), 256)
