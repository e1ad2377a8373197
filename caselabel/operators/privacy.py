"""Masking identifiers and reporting on the quality of id numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselabel.functions import people as pp


def mask_key(df: DataFrame, key: str, secret: str, out: str = "NDD_MASKED") -> DataFrame:
    """Add a repeatable 15-digit mask of the key, no two keys alike; the secret comes from the caller."""
    return df.withColumn(out, pp.masked_digits(F.col(key), secret))


def unmask_key(df: DataFrame, mask: str, secret: str, out: str = "NDD") -> DataFrame:
    """Add the key behind a mask of digits, for the holder of the secret."""
    return df.withColumn(out, pp.unmasked_digits(F.col(mask), secret))


def mask_names(df: DataFrame, name: str, secret: str, out: str = "NOMBRE_OFUZCADO") -> DataFrame:
    """Add a repeatable pseudonym of a name."""
    return df.withColumn(out, pp.masked_name(F.col(name), secret))


def mask_dictionary(df: DataFrame, key: str, secret: str, out: str = "NDD_OFUSCADA") -> DataFrame:
    """Distinct keys with their mask, for the holder of the data."""
    return mask_key(df.select(key).where(F.col(key).isNotNull()).distinct(), key, secret, out)


def mask_collisions(dictionary: DataFrame, mask: str = "NDD_OFUSCADA") -> DataFrame:
    """Keys, masks and keys that share their mask with another one."""
    copies = dictionary.groupBy(mask).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_keys"),
        F.count(F.lit(1)).alias("n_masks"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("colliding_keys"),
    )


def _quality(df: DataFrame, group: str, number: str, valid) -> DataFrame:
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(number).isNull()).alias("missing"),
        F.count_if(valid).alias("valid"),
        F.count_if(F.col(number).isNotNull() & ~valid).alias("invalid"),
    )


def id_card_quality(df: DataFrame, group: str, card: str) -> DataFrame:
    """Missing, valid and invalid national ids per group."""
    return _quality(df, group, card, pp.valid_id_card(F.col(card)))


def tax_id_quality(df: DataFrame, group: str, tax_id: str) -> DataFrame:
    """Missing, valid and invalid tax ids per group."""
    return _quality(df, group, tax_id, pp.valid_tax_id(F.col(tax_id)))
