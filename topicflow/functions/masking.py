"""Masking as Column expressions; all stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text a fixed mask writes.
FIXED_MASK = "*****"


def mask_fixed(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit(FIXED_MASK))


def mask_sha1(c: Column) -> Column:
    """Hex of SHA-1 taken twice over the UTF-8 bytes."""
    return F.sha1(F.unhex(F.sha1(c.cast("binary"))))


def _salted_sha512(c: Column, salt: Column) -> Column:
    salted = F.concat(salt.cast("binary"), c.cast("binary"))
    return F.sha2(F.unhex(F.sha2(salted, 512)), 512)


def mask_sha512(c: Column, salt: str) -> Column:
    """Hex of SHA-512 taken twice, the salt put before every value."""
    return _salted_sha512(c, F.lit(salt))


def mask_sha512_random(c: Column, seed: Column) -> Column:
    """As above with a salt of its own per value; not repeatable by design.

    ``seed`` is a random text that differs for every value masked.
    """
    return _salted_sha512(c, seed)
