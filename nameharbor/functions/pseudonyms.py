"""Salted pseudonyms of the four name levels."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LEVELS

LabelAnonymizer = Callable[[Column], Column]


def identity(name: Column) -> Column:
    return name


def sha256_with(salt: str) -> LabelAnonymizer:
    """Hex SHA-256 over the whole string of a level with the salt behind it."""
    return lambda name: F.sha2(F.concat(name, F.lit(salt)), 256)


@dataclass(frozen=True)
class Anonymizer:
    tld: LabelAnonymizer = identity
    public_suffix: LabelAnonymizer = identity
    apex: LabelAnonymizer = identity
    fqdn: LabelAnonymizer = identity

    @classmethod
    def sha256(cls, tld: str, public_suffix: str, apex: str, fqdn: str) -> Anonymizer:
        """The four salts, all required."""
        return cls(*(sha256_with(salt) for salt in (tld, public_suffix, apex, fqdn)))

    def of(self, level: str, name: Column) -> Column:
        return getattr(self, level)(name)


def with_pseudonyms(rows: DataFrame, anonymizer: Anonymizer) -> DataFrame:
    """Add ``<level>_anon`` for every level column."""
    return rows.withColumns({f"{level}_anon": anonymizer.of(level, F.col(level)) for level in LEVELS})
