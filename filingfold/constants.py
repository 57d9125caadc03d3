"""Fixed values that must equal the reference's for right results.

FIXED VALUES — stated plainly, in the order the reference lists them.
"""

from __future__ import annotations

# FIXED VALUES: the 52 patent offices that are browsed (EU27 + OECD + BRICS + EPO + WIPO).
BROWSED_OFFICES: tuple[str, ...] = (
    "AL", "AT", "AU", "BE", "BG", "BR", "CA", "CH", "CL", "CN", "CY", "CZ", "DE",
    "DK", "EE", "EP", "ES", "FI", "FR", "GB", "GR", "HR", "HU", "IB", "IE", "IL",
    "IN", "IS", "IT", "JP", "KR", "LT", "LU", "LV", "MK", "MT", "MX", "NL", "NO",
    "NZ", "PL", "PT", "RO", "RS", "RU", "SE", "SI", "SK", "SM", "TR", "US", "ZA",
)

# FIXED VALUES: publication (authority, kind) pairs whose application is excluded
# (petty patents and similar), in the reference's order.
EXCLUDED_PUBLICATION_KINDS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("AU", ("A3", "B3", "B4", "C1", "C4", "D0")),
    ("BE", ("A6", "A7")),
    ("FR", ("A3", "A4", "A7")),
    ("IE", ("A2", "B2")),
    ("NL", ("C1",)),
    ("SI", ("A2",)),
    ("US", ("E", "E1", "H", "H1", "I4", "P", "P1", "P2", "P3", "S1")),
)

# FIXED VALUES: offices that never become a country code in the office fallback (source 7).
FALLBACK_EXCLUDED_OFFICES: tuple[str, ...] = ("EP", "AP", "EA", "GC", "OA", "WO")

# FIXED VALUES: country labels attached to ctry_code, in the reference's order.
# Codes not listed get NULL (no ELSE branch in the reference).
COUNTRY_LABELS: tuple[tuple[str, str], ...] = (
    ("AU", "Australia"),
    ("AT", "Austria"),
    ("BE", "Belgium"),
    ("BR", "Brazil"),
    ("BG", "Bulgaria"),
    ("CA", "Canada"),
    ("CL", "Chile"),
    ("CN", "China"),
    ("HR", "Croatia"),
    ("CZ", "Czech Republic"),
    ("DK", "Denmark"),
    ("EE", "Estonia"),
    ("FI", "Finland"),
    ("FR", "France"),
    ("DE", "Germany"),
    ("GR", "Greece"),
    ("HU", "Hungary"),
    ("IS", "Iceland"),
    ("IN", "India"),
    ("IE", "Ireland"),
    ("IL", "Israel"),
    ("IT", "Italy"),
    ("JP", "Japan"),
    ("KR", "South Korea"),
    ("LV", "Latvia"),
    ("MT", "Malta"),
    ("MX", "Mexico"),
    ("NL", "Netherlands"),
    ("NZ", "New Zealand"),
    ("NO", "Norway"),
    ("PL", "Poland"),
    ("PT", "Portugal"),
    ("RO", "Romania"),
    ("RU", "Russia"),
    ("SK", "Slovakia"),
    ("SI", "Slovenia"),
    ("ZA", "South Africa"),
    ("ES", "Spain"),
    ("SE", "Sweden"),
    ("CH", "Switzerland"),
    ("TR", "Turkey"),
    ("GB", "United Kingdom"),
    ("US", "United States"),
    ("LU", "Luxembourg"),
    ("LT", "Lithuania"),
    ("LI", "Liechtenstein"),
    ("HK", "Hong Kong"),
)

# FIXED VALUES: data_source codes of the geocoded address table.
DS_PATSTAT = "PATSTATREGPAT"
DS_USPTO = "USPTO"
DS_PCT = "PCT"
DS_EU = "EU"
DS_JP = "JP"
DS_KR = "KR"
DS_CN = "CN"

# FIXED VALUES: first-filing classes, in first-match-wins order.
TYPE_PRIORITY = "priority"
TYPE_PCT = "pct"
TYPE_CONTINUAL = "continual"
TYPE_TECH_REL = "tech_rel"
TYPE_SINGLE = "single"

# FIXED VALUES: bridge stage tags.
BRIDGE_PRIORITY = "PRIORITY"
BRIDGE_PCT = "PCT"
BRIDGE_CONTINUAL = "CONTINUAL"
BRIDGE_TECH_REL = "TECH_REL"
BRIDGE_SINGLE = "SINGLE"

# FIXED VALUES: filing year window [lo, hi) of the location and applicant-country scripts.
DEFAULT_YEAR_RANGE = (1980, 2016)

# FIXED VALUES: PCT relation types read from the WIPO address table, per role.
PCT_RELATIONS_INV_WITH_SOURCE = 4
PCT_RELATIONS_INV_ANY_SOURCE = (7, 6)
PCT_RELATIONS_APP_WITH_SOURCE = 1
PCT_RELATIONS_APP_ANY_SOURCE = (7,)
