"""Reusable predicates, all native column expressions (stay inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BROWSED_OFFICES, EXCLUDED_PUBLICATION_KINDS, FALLBACK_EXCLUDED_OFFICES


def nonempty(c: Column | str) -> Column:
    """``NULLIF(c, '') IS NOT NULL``: NULL and the empty string both count as missing."""
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")).isNotNull()


def in_year_range(year: Column | str, year_range: tuple[int | None, int | None] | None) -> Column:
    """Half-open ``lo <= year < hi``; either bound may be ``None``; NULL years drop."""
    y = F.col(year) if isinstance(year, str) else year
    cond = F.lit(True)
    if year_range is None:
        return cond
    lo, hi = year_range
    if lo is not None:
        cond = cond & (y >= lo)
    if hi is not None:
        cond = cond & (y < hi)
    return cond


def browsed_office(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).isin(*BROWSED_OFFICES)


def fallback_office_allowed(c: Column | str) -> Column:
    """``office NOT IN (...)``; a NULL office is dropped, as in SQL."""
    return ~(F.col(c) if isinstance(c, str) else c).isin(*FALLBACK_EXCLUDED_OFFICES)


def excluded_publication(auth: str = "publn_auth", kind: str = "publn_kind") -> Column:
    """Disjunction of (authority, kind set) pairs marking petty patents and similar."""
    cond = F.lit(False)
    for office, kinds in EXCLUDED_PUBLICATION_KINDS:
        cond = cond | ((F.col(auth) == office) & F.col(kind).isin(*kinds))
    return cond
