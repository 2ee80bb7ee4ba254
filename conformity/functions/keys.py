"""Keys for matching names and identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Legal forms left out of company names. Fixed values.
LEGAL_FORMS = ("llc", "inc", "incorporated", "corp", "co", "ltd")


def is_usable(c: Column) -> Column:
    """Neither null nor blank (blanks are spaces; tabs count as text)."""
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def company_key(c: Column) -> Column:
    """A company name for matching: lower case, no points, commas or legal forms, single spaces."""
    plain = F.regexp_replace(F.trim(F.lower(c)), "[.,]", "")
    bare = F.regexp_replace(plain, rf"\b({'|'.join(LEGAL_FORMS)})\b", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


NORMALIZERS = {"exact": lambda c: c, "lower_trim": lambda c: F.lower(F.trim(c)), "company_name": company_key}


def identity_json(columns: list[str]) -> Column:
    """Never null, as the second value tells the optimizer: whether it is null need not be found out by making it."""
    return F.coalesce(F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in columns]), {"ignoreNullFields": "false"}), F.lit(""))


def identity_field(identity: Column | str, name: str) -> Column:
    """One component of an identity JSON."""
    return F.get_json_object(identity, f"$.{name}")
