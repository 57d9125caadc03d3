"""Frozen run configuration shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, replace

from .constants import DEFAULT_YEAR_RANGE

ROLE_INV = "inv"
ROLE_APP = "app"


@dataclass(frozen=True)
class Config:
    """Knobs that distinguish the three imputation scripts.

    role               own role: ``"inv"`` (invt_seq_nr > 0) or ``"app"`` (applt_seq_nr > 0)
    national_kind      ``"A"`` keeps appln_kind = 'A'; ``"not_w"`` keeps appln_kind != 'W'
                       for the national branch of the classifier
    year_range         half-open [lo, hi) on appln_filing_year; ``None`` = no filter
    use_exclusions     drop applications with an excluded publication kind
    require_publication  keep only applications with a numbered, non-D2 publication
    pct_person         ``"reference"`` reproduces the NULL person on pct first filings of
                       the location script; ``"corrected"`` keeps the real person
    dedupe_cross_role  collapse the person x code fan-out of sources 5 and 6 (country)
    """

    role: str = ROLE_INV
    national_kind: str = "not_w"
    year_range: tuple[int | None, int | None] | None = None
    use_exclusions: bool = False
    require_publication: bool = False
    pct_person: str = "corrected"
    dedupe_cross_role: bool = False

    def __post_init__(self) -> None:
        if self.role not in (ROLE_INV, ROLE_APP):
            raise ValueError(f"role must be 'inv' or 'app', not {self.role!r}")
        if self.national_kind not in ("A", "not_w"):
            raise ValueError(f"national_kind must be 'A' or 'not_w', not {self.national_kind!r}")
        if self.pct_person not in ("reference", "corrected"):
            raise ValueError(f"pct_person must be 'reference' or 'corrected', not {self.pct_person!r}")

    @property
    def own_seq(self) -> str:
        return "invt_seq_nr" if self.role == ROLE_INV else "applt_seq_nr"

    @property
    def other_seq(self) -> str:
        return "applt_seq_nr" if self.role == ROLE_INV else "invt_seq_nr"

    @property
    def other_role(self) -> str:
        return ROLE_APP if self.role == ROLE_INV else ROLE_INV

    def with_role(self, role: str) -> "Config":
        return replace(self, role=role)


# Presets matching the three imputation scripts.
LOCATION_INV = Config(
    role=ROLE_INV,
    national_kind="A",
    year_range=DEFAULT_YEAR_RANGE,
    use_exclusions=True,
    require_publication=True,
    pct_person="reference",
)
LOCATION_APP = replace(LOCATION_INV, role=ROLE_APP)
COUNTRY_APP = Config(role=ROLE_APP, national_kind="not_w", year_range=DEFAULT_YEAR_RANGE)
COUNTRY_INV = Config(role=ROLE_INV, national_kind="not_w", year_range=None)
