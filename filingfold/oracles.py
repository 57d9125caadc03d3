"""DuckDB oracle SQL for every registered query.

Two halves:

* the fixture adapter as CTEs over the driver's star tables (same expressions as
  ``sources.fixtures``);
  that suffices: a first-match rule table for the classifier, one link table for the
  pools, windows for the earliest candidate and the waterfall's tiers, and "not yet a
  member" / "already a first filing" steps for the bridge.

Fixed values are stated here once more and not imported from the code under test, so a
wrong constant shows.  Every query is a single ``WITH ... SELECT``.
"""

from __future__ import annotations

import math

from .config import COUNTRY_APP, COUNTRY_INV, LOCATION_APP, LOCATION_INV, ROLE_APP, ROLE_INV, Config
from .sources.fixtures import (
    FAMILY_OFFSET,
    FIXTURE_OFFICES,
    FIXTURE_PART_SOURCES,
    LOCATION_OFFSET_CUSTOMER,
    LOCATION_OFFSET_PART,
)
from .sources.schemas import ADMIN_NAME_COLUMNS

# FIXED VALUES: browsed offices, excluded publication kinds, offices barred from the
# fallback, country labels.
_BROWSED_OFFICES: tuple[str, ...] = (
    "AL", "AT", "AU", "BE", "BG", "BR", "CA", "CH", "CL", "CN", "CY", "CZ", "DE",
    "DK", "EE", "EP", "ES", "FI", "FR", "GB", "GR", "HR", "HU", "IB", "IE", "IL",
    "IN", "IS", "IT", "JP", "KR", "LT", "LU", "LV", "MK", "MT", "MX", "NL", "NO",
    "NZ", "PL", "PT", "RO", "RS", "RU", "SE", "SI", "SK", "SM", "TR", "US", "ZA",
)

_EXCLUDED_PUBLICATION_KINDS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("AU", ("A3", "B3", "B4", "C1", "C4", "D0")),
    ("BE", ("A6", "A7")),
    ("FR", ("A3", "A4", "A7")),
    ("IE", ("A2", "B2")),
    ("NL", ("C1",)),
    ("SI", ("A2",)),
    ("US", ("E", "E1", "H", "H1", "I4", "P", "P1", "P2", "P3", "S1")),
)

_FALLBACK_EXCLUDED_OFFICES: tuple[str, ...] = ("EP", "AP", "EA", "GC", "OA", "WO")

_COUNTRY_LABELS: tuple[tuple[str, str], ...] = (
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

# FIXED VALUES: EPSG 5243 (Lambert conic, Germany) on GRS 80: axis, flattening, origin,
# standard parallels, false easting and northing.
_AXIS, _FLATTENING = 6378137.0, 1 / 298.257222101
_ORIGIN_LAT, _ORIGIN_LNG, _PARALLEL_1, _PARALLEL_2 = 51.0, 10.5, 48.666666666666664, 53.666666666666664
_FALSE_EAST, _FALSE_NORTH = 0.0, 0.0


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(values) -> str:
    return ", ".join(_q(v) for v in values)


def _case_index(expr: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


# ----------------------------------------------------------------------------- adapter


def _adapter() -> list[str]:
    off_c = _case_index("c.c_nationkey", FIXTURE_OFFICES)
    off_s = _case_index("s_nationkey", FIXTURE_OFFICES)
    off_cc = _case_index("c_nationkey", FIXTURE_OFFICES)
    part_src = _case_index("p_partkey % 5", FIXTURE_PART_SOURCES)
    cust, part = LOCATION_OFFSET_CUSTOMER, LOCATION_OFFSET_PART

    def link(step: int) -> str:
        far = f"((l_suppkey + 1) * {step} + l_linenumber)"
        at = f"(l_orderkey + 1 + CASE WHEN l_orderkey + 1 > {far} THEN -{far} ELSE {far} END)"
        target = f"({at} - {at} % {2 * step} + 1)"
        return f"CAST({target} + CASE WHEN {target} = l_orderkey + 1 THEN {2 * step} ELSE 0 END AS BIGINT)"

    return [
        f"""orders_k AS (
  SELECT o.o_orderkey + 1 AS k, o.o_orderdate, o.o_orderstatus, {off_c} AS off
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)""",
        f"""tls201_appln AS (
  SELECT k AS appln_id,
    CASE WHEN k % 6 = 0 THEN 'WO' ELSE off END AS appln_auth,
    CASE WHEN k % 6 = 0 THEN 'W' WHEN k % 17 = 0 THEN 'U' WHEN k % 101 = 0 THEN NULL ELSE 'A' END AS appln_kind,
    CASE WHEN k % 6 = 0 THEN off ELSE '' END AS receiving_office,
    CAST(CASE WHEN k % 12 = 1 AND k > 12 THEN k - 1 WHEN k % 12 = 2 AND k > 12 THEN k - 2 ELSE 0 END AS BIGINT) AS internat_appln_id,
    CASE WHEN k % 30 = 0 OR (k > 12 AND (k % 12 = 2 OR k % 24 = 1)) THEN 'Y' ELSE 'N' END AS nat_phase,
    CASE WHEN k % 12 = 1 AND k > 12 THEN 'Y' ELSE 'N' END AS reg_phase,
    CAST(CASE WHEN k % 5 = 0 THEN greatest(k - 7, 1) ELSE k END AS BIGINT) AS earliest_filing_id,
    CAST(CASE WHEN k % 4 = 0 THEN k ELSE {FAMILY_OFFSET} + (k - k % 4) END AS BIGINT) AS docdb_family_id,
    CAST(k - k % 10 AS BIGINT) AS inpadoc_family_id,
    CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS appln_filing_date,
    CAST(CASE WHEN k % 50 = 0 THEN 2016 WHEN k % 50 = 1 THEN 1979 ELSE year(o_orderdate) END AS INTEGER) AS appln_filing_year,
    CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS earliest_publn_date,
    CAST(CASE WHEN k % 97 = 0 THEN NULL ELSE year(o_orderdate) END AS INTEGER) AS earliest_publn_year,
    CAST(k * 10 + 1 AS BIGINT) AS earliest_pat_publn_id,
    CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS granted
  FROM orders_k)""",
        """tls204_appln_prior AS (
  SELECT appln_id, prior_appln_id,
    CAST(row_number() OVER (PARTITION BY appln_id ORDER BY prior_appln_id) AS INTEGER) AS prior_appln_seq_nr
  FROM (SELECT DISTINCT l_orderkey + 1 AS appln_id, l_partkey + 1 AS prior_appln_id
        FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey + 1 <> l_partkey + 1))""",
        f"""tls216_appln_contn AS (
  SELECT DISTINCT l_orderkey + 1 AS appln_id, {link(3)} AS parent_appln_id
  FROM lineitem WHERE l_returnflag = 'A')""",
        f"""tls205_tech_rel AS (
  SELECT DISTINCT l_orderkey + 1 AS appln_id, {link(5)} AS tech_rel_appln_id
  FROM lineitem WHERE l_returnflag = 'N')""",
        f"""tls207_pers_appln AS (
  SELECT * FROM (SELECT DISTINCT l_suppkey + 1 AS person_id, l_orderkey + 1 AS appln_id,
      CAST(CASE WHEN l_linenumber = 1 THEN 2 ELSE 0 END AS INTEGER) AS applt_seq_nr,
      CAST(l_linenumber AS INTEGER) AS invt_seq_nr FROM lineitem)
  UNION ALL
  SELECT {cust} + o_custkey, o_orderkey + 1, CAST(1 AS INTEGER), CAST(0 AS INTEGER) FROM orders)""",
        f"""tls206_person AS (
  SELECT s_suppkey + 1 AS person_id,
    CASE WHEN s_suppkey % 4 = 1 THEN {off_s} WHEN s_suppkey % 4 = 2 THEN NULL ELSE '' END AS person_ctry_code
  FROM supplier
  UNION ALL
  SELECT {cust} + c_custkey,
    CASE WHEN c_custkey % 3 = 1 THEN {off_cc} WHEN c_custkey % 3 = 2 THEN NULL ELSE '' END
  FROM customer)""",
        """tls211_pat_publn AS (
  SELECT CAST(appln_id * 10 + n AS BIGINT) AS pat_publn_id, appln_auth AS publn_auth,
    CASE WHEN appln_id % 29 = 0 THEN NULL ELSE CAST(appln_id AS VARCHAR) END AS publn_nr,
    CASE WHEN n = 2 THEN 'B1' WHEN appln_id % 19 = 0 THEN 'D2'
         WHEN appln_auth = 'US' AND appln_id % 3 = 0 THEN 'P1'
         WHEN appln_auth IN ('AU', 'FR') AND appln_id % 3 = 0 THEN 'A3' ELSE 'A1' END AS publn_kind,
    appln_id
  FROM (SELECT appln_id, appln_auth, 1 AS n FROM tls201_appln WHERE appln_id % 31 <> 0
        UNION ALL
        SELECT appln_id, appln_auth, 2 AS n FROM tls201_appln WHERE appln_id % 31 <> 0 AND appln_id % 4 = 2))""",
        f"""addr_raw AS (
  SELECT s_suppkey + 1 AS location_id, CASE WHEN s_suppkey % 2 = 0 THEN 'USPTO' ELSE 'PATSTATREGPAT' END AS data_source FROM supplier
  UNION ALL
  SELECT {cust} + c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'USPTO' ELSE 'PATSTATREGPAT' END FROM customer
  UNION ALL
  SELECT {part} + p_partkey, {part_src} FROM part)""",
        """addresses_coordinates_all AS (
  SELECT location_id, 'addr_' || CAST(location_id AS VARCHAR) AS unformattedaddress, data_source,
    CAST(lat_d AS REAL) AS lat, CAST(lng_d AS REAL) AS lng,
    CAST(lat_d AS DECIMAL(20,15)) AS lat_exact, CAST(lng_d AS DECIMAL(20,15)) AS lng_exact,
    CASE WHEN location_id % 2 = 0 THEN 'API' ELSE 'GEONAMES' END AS coord_source
  FROM (SELECT location_id, data_source,
          CASE WHEN location_id % 3 = 0 THEN NULL ELSE CAST((location_id * 37) % 170 - 85 AS DOUBLE) + 0.25 END AS lat_d,
          CASE WHEN location_id % 3 = 0 THEN NULL ELSE CAST((location_id * 73) % 360 - 180 AS DOUBLE) + 0.25 END AS lng_d
        FROM addr_raw))""",
        f"""person_location_id AS (
  SELECT s_suppkey + 1 AS person_id, s_suppkey + 1 AS location_id FROM supplier WHERE s_suppkey % 4 = 1
  UNION ALL
  SELECT {cust} + c_custkey, {cust} + c_custkey FROM customer WHERE c_custkey % 3 = 1)""",
        f"""addresses_pct AS (
  SELECT DISTINCT l_orderkey + 1 - l_orderkey % 3 AS appln_id,
    'addr_' || CAST({part} + CASE WHEN l_linenumber % 2 = 1 THEN l_partkey - l_partkey % 5 ELSE l_partkey END AS VARCHAR) AS address_text,
    CAST(1 + l_suppkey % 8 AS INTEGER) AS relation_type_id
  FROM lineitem WHERE l_returnflag = 'N')""",
        f"""ial_all AS (
  SELECT DISTINCT l_orderkey + 1 - l_orderkey % 6 AS appln_id, {part} + l_partkey AS location_id,
    CASE WHEN l_suppkey % 2 = 0 THEN 'INV' ELSE 'APP' END AS app_inv, l_partkey % 5 AS part_rem
  FROM lineitem)""",
        "inventor_applicant_location_id AS (SELECT appln_id, location_id, app_inv FROM ial_all WHERE part_rem = 1)",
        "inventor_applicant_location_id_jp AS (SELECT appln_id, location_id, app_inv FROM ial_all WHERE part_rem = 2)",
        "inventor_applicant_location_id_kr AS (SELECT appln_id, location_id, app_inv FROM ial_all WHERE part_rem = 3)",
        "inventor_applicant_location_id_cn AS (SELECT appln_id, location_id, app_inv FROM ial_all WHERE part_rem = 4)",
        """admin_levels AS (
  SELECT CAST(n_nationkey AS BIGINT) AS gid, n_name AS name_0, r_name AS name_1,
    CAST(NULL AS VARCHAR) AS name_2, CAST(NULL AS VARCHAR) AS name_3, CAST(NULL AS VARCHAR) AS name_4,
    CAST(NULL AS VARCHAR) AS name_5, 'Region' AS engtype_1, CAST(NULL AS VARCHAR) AS engtype_2,
    CAST(NULL AS VARCHAR) AS engtype_3, CAST(NULL AS VARCHAR) AS engtype_4, CAST(NULL AS VARCHAR) AS engtype_5,
    CAST(-125 + 50 * (n_nationkey % 5) AS DOUBLE) AS x0, CAST(-75 + 6 * (n_nationkey - n_nationkey % 5) AS DOUBLE) AS y0
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)""",
    ] + _lookups()


def _lookups() -> list[str]:
    """C0: applications with a publication of an excluded kind."""
    listed = " OR ".join(f"(publn_auth = {_q(a)} AND publn_kind IN ({_in_list(k)}))" for a, k in _EXCLUDED_PUBLICATION_KINDS)
    return [f"excluded AS (SELECT DISTINCT appln_id, publn_auth, publn_kind FROM tls211_pat_publn WHERE {listed})"]


# --------------------------------------------------------------------------- geometry

_NAMES = ", ".join(ADMIN_NAME_COLUMNS)
_DEG = repr(math.pi / 180)


def _isometric(lat: float) -> float:
    """tan(pi/4 - lat/2) corrected for the ellipsoid (EPSG guidance note 7-2, 9802)."""
    e = math.sqrt(2 * _FLATTENING - _FLATTENING**2)
    s = e * math.sin(math.radians(lat))
    return math.tan(math.pi / 4 - math.radians(lat) / 2) / ((1 - s) / (1 + s)) ** (e / 2)


def _parallel_radius(lat: float) -> float:
    e2 = 2 * _FLATTENING - _FLATTENING**2
    return math.cos(math.radians(lat)) / math.sqrt(1 - e2 * math.sin(math.radians(lat)) ** 2)


def _lcc_sql(lng: str, lat: str) -> tuple[str, str]:
    """Easting and northing, rounded to millimetres."""
    e = math.sqrt(2 * _FLATTENING - _FLATTENING**2)
    m1, m2, t1, t2 = _parallel_radius(_PARALLEL_1), _parallel_radius(_PARALLEL_2), _isometric(_PARALLEL_1), _isometric(_PARALLEL_2)
    n = (math.log(m1) - math.log(m2)) / (math.log(t1) - math.log(t2))
    scale = _AXIS * m1 / (n * t1**n)
    at_origin = scale * _isometric(_ORIGIN_LAT) ** n
    sine = f"({e!r} * sin(CAST({lat} AS DOUBLE) * {_DEG}))"
    iso = f"(tan({math.pi / 4!r} - CAST({lat} AS DOUBLE) * {_DEG} / 2) / pow((1 - {sine}) / (1 + {sine}), {e / 2!r}))"
    radius = f"({scale!r} * pow({iso}, {n!r}))"
    # Longitude east of the axis, brought to -180 .. 180 degrees.
    east_of = f"(CAST({lng} AS DOUBLE) - {_ORIGIN_LNG!r})"
    wrapped = f"({east_of} - 360 * floor(({east_of} + 180) / 360))"
    angle = f"({n!r} * {wrapped} * {_DEG})"
    known = f"{lat} IS NOT NULL AND {lng} IS NOT NULL AND CAST({lat} AS DOUBLE) > -90"
    return (
        f"CASE WHEN {known} THEN round({_FALSE_EAST!r} + {radius} * sin({angle}), 3) END",
        f"CASE WHEN {known} THEN round({_FALSE_NORTH!r} + {at_origin!r} - {radius} * cos({angle}), 3) END",
    )


def _geo_ctes() -> list[str]:
    """``named_address``: every address with the lowest-id polygon's names and geometry."""
    mx, my = _lcc_sql("lng_exact", "lat_exact")
    inside = (
        "CAST(d.lng_exact AS DOUBLE) > g.x0 AND CAST(d.lng_exact AS DOUBLE) < g.x0 + 50 "
        "AND CAST(d.lat_exact AS DOUBLE) > g.y0 AND CAST(d.lat_exact AS DOUBLE) < g.y0 + 30"
    )
    return [
        f"""polygon_of AS (
  SELECT d.location_id, min(g.gid) AS gid FROM addresses_coordinates_all d JOIN admin_levels g ON {inside} GROUP BY d.location_id)""",
        f"""named_address AS (
  SELECT d.*, {_cols("g.", ADMIN_NAME_COLUMNS)},
    CASE WHEN lat_exact IS NOT NULL THEN CAST(lng_exact AS DOUBLE) END AS geom_x,
    CASE WHEN lng_exact IS NOT NULL THEN CAST(lat_exact AS DOUBLE) END AS geom_y,
    {mx} AS geom_m_x, {my} AS geom_m_y
  FROM addresses_coordinates_all d LEFT JOIN polygon_of USING (location_id) LEFT JOIN admin_levels g USING (gid))""",
    ]


# Location payloads (geometry flattened): of the location table, of the result table.
_LOC_PAYLOAD = (*ADMIN_NAME_COLUMNS, "lng_exact", "lat_exact", "lng", "lat", "geom_x", "geom_y", "geom_m_x", "geom_m_y")
_GEOC_PAYLOAD = (*ADMIN_NAME_COLUMNS, "lat", "lng", "lat_exact", "lng_exact", "geom_x", "geom_y", "geom_m_x", "geom_m_y", "coord_source")
_LOC_ROW = (*_LOC_PAYLOAD, "data_source", "coord_source")


def _cols(prefix: str, cols) -> str:
    return ", ".join(f"{prefix}{c}" for c in cols)


_SEQ = {ROLE_INV: "invt_seq_nr", ROLE_APP: "applt_seq_nr"}
# FIXED VALUES: relation types that need a listed address source, and those that do
# not; office mappings read for the role.
_TEXT_RELATIONS = {ROLE_INV: (4, (6, 7)), ROLE_APP: (1, (7,))}
_OFFICE_TABLES = {
    ROLE_INV: (("EU", ""), ("JP", "_jp"), ("KR", "_kr")),
    ROLE_APP: (("EU", ""), ("JP", "_jp"), ("KR", "_kr"), ("CN", "_cn")),
}


def _located_ctes(*roles: str) -> list[str]:
    """``at_{role}``: location rows of the persons in a role; every kind of evidence is
    distinct by itself, then all are appended."""
    ctes = []
    for role in roles:
        listed, free = _TEXT_RELATIONS[role]
        evidence = [
            (
                "DISTINCT unformattedaddress, appln_id, person_id",
                f"tls207_pers_appln JOIN person_location_id USING (person_id) JOIN named_address USING (location_id) "
                f"WHERE {_SEQ[role]} > 0 AND data_source IN ('PATSTATREGPAT', 'USPTO')",
            ),
            (
                "DISTINCT unformattedaddress, appln_id, CAST(0 AS BIGINT) AS person_id",
                "addresses_pct JOIN named_address ON (address_text = unformattedaddress) "
                f"WHERE (relation_type_id = {listed} AND data_source IN ('PCT', 'PATSTATREGPAT', 'USPTO')) "
                f"OR (relation_type_id IN ({', '.join(map(str, free))}))",
            ),
        ]
        evidence += [
            (
                "DISTINCT appln_id, CAST(0 AS BIGINT) AS person_id",
                f"inventor_applicant_location_id{suffix} JOIN named_address USING (location_id) "
                f"WHERE app_inv = {_q(role.upper())} AND data_source = {_q(office)}",
            )
            for office, suffix in _OFFICE_TABLES[role]
        ]
        keep = f"appln_id, person_id, {', '.join(_LOC_ROW)}"
        parts = [f"SELECT {keep} FROM (SELECT {ids}, {', '.join(_LOC_ROW)} FROM {source})" for ids, source in evidence]
        ctes.append(f"at_{role} AS (\n  " + "\n  UNION ALL ".join(parts) + ")")
    return ctes


# ---------------------------------------------------------------------- first filings


def _first_filing_ctes(cfg: Config, tag: str) -> list[str]:
    """``first_{tag}``: the classifier as a table of rules; an application takes the
    class of its first rule."""
    national = "appln_kind = 'A'" if cfg.national_kind == "A" else "appln_kind <> 'W'"
    offices = _in_list(_BROWSED_OFFICES)
    tests = [
        f"(({national} AND appln_auth IN ({offices})) OR (appln_kind = 'W' AND receiving_office IN ({offices})))",
        "internat_appln_id = 0",
    ]
    lo, hi = cfg.year_range or (None, None)
    tests += [f"appln_filing_year >= {lo}"] if lo is not None else []
    tests += [f"appln_filing_year < {hi}"] if hi is not None else []
    if cfg.use_exclusions:
        tests.append("NOT EXISTS (FROM excluded x WHERE x.appln_id = e.appln_id)")
    if cfg.require_publication:
        tests.append("EXISTS (FROM tls211_pat_publn x WHERE x.appln_id = e.appln_id AND x.publn_nr IS NOT NULL AND x.publn_kind <> 'D2')")
    rules = [
        ("priority", "appln_id IN (SELECT prior_appln_id FROM tls204_appln_prior)"),
        ("pct", "appln_kind = 'W' AND nat_phase = 'N' AND reg_phase = 'N' AND appln_id = earliest_filing_id"),
        ("continual", "appln_id IN (SELECT parent_appln_id FROM tls216_appln_contn)"),
        ("tech_rel", "appln_id IN (SELECT tech_rel_appln_id FROM tls205_tech_rel)"),
        ("single", "docdb_family_id IN (SELECT docdb_family_id FROM tls201_appln GROUP BY ALL HAVING count(DISTINCT appln_id) = 1)"),
    ]
    matches = " UNION ALL ".join(
        f"SELECT appln_id, {rank} AS rank, {_q(type_)} AS type FROM eligible_{tag} WHERE {rule}" for rank, (type_, rule) in enumerate(rules)
    )
    person = "CASE WHEN type = 'pct' THEN NULL ELSE person_id END" if cfg.pct_person == "reference" else "person_id"
    return [
        f"eligible_{tag} AS (SELECT * FROM tls201_appln e WHERE {' AND '.join(tests)})",
        f"class_{tag} AS (SELECT appln_id, arg_min(type, rank) AS type FROM ({matches}) GROUP BY appln_id)",
        f"""first_{tag} AS (
  SELECT DISTINCT appln_id, appln_kind, {person} AS person_id, appln_auth AS patent_office, appln_filing_year, appln_filing_date, type
  FROM eligible_{tag} JOIN class_{tag} USING (appln_id) JOIN tls207_pers_appln USING (appln_id) WHERE {_SEQ[cfg.role]} > 0)""",
        f"filing_{tag} AS (SELECT DISTINCT appln_id, patent_office, appln_filing_date, appln_filing_year, type FROM first_{tag})",
    ]


# ------------------------------------------------------------------------------- pool


def _pool_ctes(tag: str) -> list[str]:
    """``pool_{tag}`` (filing grain) and ``person_pool_{tag}``: later filings linked to a
    first filing by the link of its own class."""
    return [
        """later AS (
  SELECT 'priority' AS type, prior_appln_id AS appln_id, appln_id AS subsequent_id, max(prior_appln_seq_nr) OVER of_later AS nb
  FROM tls204_appln_prior WINDOW of_later AS (PARTITION BY appln_id)
  UNION ALL
  SELECT 'continual', parent_appln_id, appln_id, count(*) OVER of_later FROM tls216_appln_contn WINDOW of_later AS (PARTITION BY appln_id)
  UNION ALL
  SELECT 'tech_rel', tech_rel_appln_id, appln_id, count(*) OVER of_later FROM tls205_tech_rel WINDOW of_later AS (PARTITION BY appln_id)
  UNION ALL
  SELECT 'pct', internat_appln_id, appln_id, unnest([1, 2]) AS nb FROM tls201_appln WHERE internat_appln_id <> 0 AND reg_phase = 'Y' AND nat_phase = 'Y'
  UNION ALL
  SELECT 'pct', internat_appln_id, appln_id, CASE WHEN reg_phase = 'Y' THEN 1 ELSE 2 END
  FROM tls201_appln WHERE internat_appln_id <> 0 AND (reg_phase = 'Y') <> (nat_phase = 'Y'))""",
        f"""pool_{tag} AS (
  SELECT DISTINCT f.appln_id, l.subsequent_id, f.patent_office, f.appln_filing_year, s.appln_filing_date AS subsequent_date,
    CAST(l.nb AS INTEGER) AS nb_priorities, f.type
  FROM filing_{tag} f JOIN later l USING (appln_id, type) JOIN tls201_appln s ON (s.appln_id = l.subsequent_id))""",
        f"""person_pool_{tag} AS (
  SELECT DISTINCT p.*, w.person_id AS subsequent_person_id, w.applt_seq_nr, w.invt_seq_nr
  FROM pool_{tag} p JOIN tls207_pers_appln w ON (w.appln_id = p.subsequent_id))""",
    ]


def _earliest(name: str, source: str) -> str:
    """The rows of ``source`` that belong to the earliest subsequent filing, by date,
    then by id; a filing without date never counts."""
    return (
        f"{name} AS (SELECT *, subsequent_date AS min_date FROM ({source}) WHERE subsequent_date IS NOT NULL "
        "QUALIFY rank() OVER (PARTITION BY appln_id ORDER BY subsequent_date, subsequent_id) = 1)"
    )


def _tiers(name: str, tiers: list[tuple[int, str]], columns: str) -> str:
    """All candidate rows of the lowest source each application has."""
    rows = " UNION ALL ".join(f"SELECT {columns}, {source} AS source FROM ({sql})" for source, sql in tiers)
    return f"{name} AS (SELECT * FROM ({rows}) QUALIFY source = min(source) OVER (PARTITION BY appln_id))"


# ------------------------------------------------------------------ country pipeline


def _codes_ctes() -> list[str]:
    return [
        f"code_{role} AS (SELECT DISTINCT w.appln_id, person_id, person_ctry_code AS ctry_code "
        f"FROM tls207_pers_appln w JOIN tls206_person USING (person_id) WHERE {seq} > 0)"
        for role, seq in _SEQ.items()
    ]


def _label_case(col: str) -> str:
    return f"CASE {col} " + " ".join(f"WHEN {_q(code)} THEN {_q(label)}" for code, label in _COUNTRY_LABELS) + " END"


def _country_ctes(cfg: Config, tag: str) -> list[str]:
    own, other, has = cfg.role, cfg.other_role, "ctry_code <> ''"
    nb = {2: "nb_priorities = 1", 3: "nb_priorities > 1", 5: "nb_priorities = 1", 6: "nb_priorities > 1"}
    ctes = _codes_ctes() + _first_filing_ctes(cfg, tag) + _pool_ctes(tag)
    ctes.append(
        f"own_{tag} AS MATERIALIZED (SELECT DISTINCT f.appln_id, f.person_id, patent_office, appln_filing_date, appln_filing_year, ctry_code, type "
        f"FROM first_{tag} f LEFT JOIN code_{own} c ON (c.appln_id = f.appln_id AND c.person_id = f.person_id))"
    )
    ctes.append(
        f"other_{tag} AS MATERIALIZED (SELECT DISTINCT f.appln_id, patent_office, appln_filing_year, ctry_code, type "
        f"FROM first_{tag} f JOIN code_{other} c USING (appln_id) WHERE {has})"
    )
    for n in (2, 3):
        ctes.append(_earliest(
            f"best{n}_{tag}",
            f"SELECT p.*, ctry_code FROM person_pool_{tag} p JOIN code_{own} c ON (c.appln_id = subsequent_id AND c.person_id = subsequent_person_id) "
            f"WHERE {nb[n]} AND {_SEQ[own]} > 0 AND {has}",
        ))
    for n in (5, 6):
        ctes.append(_earliest(
            f"best{n}_{tag}",
            f"SELECT p.*, ctry_code FROM person_pool_{tag} p JOIN code_{other} c ON (c.appln_id = subsequent_id) "
            f"WHERE {nb[n]} AND {_SEQ[other]} > 0 AND {has}",
        ))
    nobody = "CAST(0 AS BIGINT) AS person_id"
    ctes.append(_tiers(f"filled_{tag}", [
        (1, f"SELECT * FROM own_{tag} WHERE {has}"),
        (2, f"SELECT *, subsequent_person_id AS person_id FROM best2_{tag}"),
        (3, f"SELECT *, subsequent_person_id AS person_id FROM best3_{tag}"),
        (4, f"SELECT *, {nobody} FROM other_{tag}"),
        (5, f"SELECT *, {nobody} FROM best5_{tag}"),
        (6, f"SELECT *, {nobody} FROM best6_{tag}"),
        (7, f"SELECT appln_id, {nobody}, patent_office AS ctry_code FROM first_{tag} WHERE patent_office NOT IN ({_in_list(_FALLBACK_EXCLUDED_OFFICES)})"),
    ], "appln_id, person_id, ctry_code"))
    ctes.append(
        f"""country_{tag} AS (
  SELECT appln_id, person_id, patent_office, appln_filing_date AS priority_date, appln_filing_year AS priority_year, ctry_code,
    CAST(source AS INTEGER) AS source, type, {_label_case("ctry_code")} AS country
  FROM filled_{tag} JOIN filing_{tag} USING (appln_id))"""
    )
    return ctes


# ----------------------------------------------------------------- location pipeline


def _location_ctes(cfg: Config, tag: str) -> list[str]:
    payload = ", ".join(_GEOC_PAYLOAD)
    at = {own: f"(SELECT * FROM at_{own} WHERE lat IS NOT NULL)" for own in (cfg.role, cfg.other_role)}
    own, other = at[cfg.role], at[cfg.other_role]
    ctes = _geo_ctes() + _located_ctes(ROLE_INV, ROLE_APP) + _first_filing_ctes(cfg, tag) + _pool_ctes(tag)
    ctes.append(
        f"""own_{tag} AS MATERIALIZED (
  SELECT appln_id, {payload} FROM (SELECT DISTINCT appln_id, person_id, {payload} FROM first_{tag} JOIN {own} USING (appln_id, person_id))
  UNION ALL
  SELECT DISTINCT appln_id, {payload} FROM filing_{tag} JOIN {own} USING (appln_id) WHERE person_id = 0)"""
    )
    ctes.append(f"other_{tag} AS MATERIALIZED (SELECT DISTINCT appln_id, {payload} FROM filing_{tag} JOIN {other} USING (appln_id))")
    for n, rows, nb in ((2, own, "= 1"), (3, own, "> 1"), (5, other, "= 1"), (6, other, "> 1")):
        ctes.append(_earliest(
            f"best{n}_{tag}",
            f"SELECT p.*, {payload} FROM pool_{tag} p JOIN {rows} r ON (r.appln_id = p.subsequent_id) WHERE nb_priorities {nb}",
        ))
    ctes.append(_tiers(f"filled_{tag}", [
        (1, f"FROM own_{tag}"), (2, f"FROM best2_{tag}"), (3, f"FROM best3_{tag}"),
        (4, f"FROM other_{tag}"), (5, f"FROM best5_{tag}"), (6, f"FROM best6_{tag}"),
    ], f"appln_id, {payload}"))
    ctes.append(
        f"""geocoded_{tag} AS (
  SELECT appln_id, patent_office, appln_filing_date AS priority_date, appln_filing_year AS priority_year, {payload},
    CAST(source AS INTEGER) AS source, type
  FROM filled_{tag} JOIN filing_{tag} USING (appln_id))"""
    )
    return ctes


# ----------------------------------------------------------------------------- bridge

_BR_APPLN = (
    "appln_auth", "appln_kind", "appln_filing_date", "appln_filing_year", "earliest_publn_date", "earliest_publn_year",
    "earliest_pat_publn_id", "granted", "docdb_family_id", "inpadoc_family_id",
)


def _bridge_ctes() -> list[str]:
    """Pairs (first filing f, member m) step by step, then the wide columns once."""
    new, known = "new member", "known first filing"
    phase = "internat_appln_id <> 0 AND 'Y' IN (reg_phase, nat_phase)"
    steps = [
        ("PRIORITY", "SELECT prior_appln_id AS f, unnest([appln_id, prior_appln_id]) AS m FROM tls204_appln_prior", None),
        ("PCT", "SELECT appln_id AS f, appln_id AS m FROM tls201_appln WHERE internat_appln_id = 0 AND appln_kind = 'W' AND earliest_filing_id = appln_id", new),
        ("PCT", f"SELECT internat_appln_id AS f, appln_id AS m FROM tls201_appln WHERE {phase}", "under PCT"),
        ("CONTINUAL", "SELECT parent_appln_id AS f, parent_appln_id AS m FROM tls216_appln_contn", new),
        ("CONTINUAL", "SELECT parent_appln_id AS f, appln_id AS m FROM tls216_appln_contn", known),
        ("TECH_REL", "SELECT tech_rel_appln_id AS f, tech_rel_appln_id AS m FROM tls205_tech_rel", new),
        ("TECH_REL", "SELECT tech_rel_appln_id AS f, appln_id AS m FROM tls205_tech_rel", known),
        ("SINGLE", "SELECT min(appln_id) AS f, min(appln_id) AS m FROM tls201_appln GROUP BY docdb_family_id HAVING count(DISTINCT appln_id) = 1", new),
    ]
    ctes = ["out AS MATERIALIZED (SELECT DISTINCT appln_id AS m FROM tls211_pat_publn SEMI JOIN tls201_appln USING (appln_id))"]
    for i, (type_, pairs, rule) in enumerate(steps):
        test = {
            None: "true",
            new: f"NOT EXISTS (FROM upto{i - 1} u WHERE u.m = c.m)",
            known: f"EXISTS (FROM upto{i - 1} u WHERE u.f = c.f)",
            "under PCT": f"EXISTS (FROM upto{i - 1} u WHERE u.f = c.f AND u.type = 'PCT')",
        }[rule]
        ctes.append(f"step{i} AS MATERIALIZED (SELECT DISTINCT f, m, {_q(type_)} AS type FROM ({pairs}) c SEMI JOIN out USING (m) WHERE {test})")
        before = f"FROM upto{i - 1} UNION ALL " if i else ""
        ctes.append(f"upto{i} AS MATERIALIZED ({before}FROM step{i})")
    ctes.append(
        f"""bridge AS (
  SELECT u.f AS prior_appln_id, b.*, {_cols("a.", _BR_APPLN)}, u.type
  FROM upto{len(steps) - 1} u JOIN tls211_pat_publn b ON (b.appln_id = u.m) JOIN tls201_appln a ON (a.appln_id = u.m))"""
    )
    return ctes


# ---------------------------------------------------------------------------- queries

_FIRST = "appln_id, appln_kind, person_id, patent_office, appln_filing_year, appln_filing_date, type"
_COUNTRY = "appln_id, person_id, patent_office, priority_date, priority_year, ctry_code, source, type, country"
_PERSON_POOL = (
    "appln_id, subsequent_id, subsequent_person_id, applt_seq_nr, invt_seq_nr, patent_office, "
    "appln_filing_year, subsequent_date, nb_priorities, type"
)
_POOL = "appln_id, subsequent_id, patent_office, appln_filing_year, subsequent_date, nb_priorities, type"
_BEST_OWN = "appln_id, subsequent_id, subsequent_person_id, ctry_code, type, min_date"
_BEST_OTHER = "appln_id, subsequent_id, ctry_code, type, min_date"
_LEAN = "appln_id, lat, lng, lat_exact, lng_exact, coord_source"
_GEOC = ", ".join(("appln_id", "patent_office", "priority_date", "priority_year", *_GEOC_PAYLOAD, "source", "type"))
_BEST_LOCATION = ", ".join(("appln_id", "subsequent_id", *_GEOC_PAYLOAD, "type", "min_date"))


def _exact_as_double(cols: str) -> str:
    """Select list with the exact coordinates as DOUBLE (see queries._exact_as_double)."""
    out = []
    for c in (x.strip() for x in cols.split(",")):
        out.append(f"CAST({c} AS DOUBLE) AS {c}" if c in ("lat_exact", "lng_exact") else c)
    return ", ".join(out)


def _with(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(_adapter() + ctes) + "\n" + select


def oracle_queries() -> dict[str, str]:
    out = {
        "excluded_applications": _with([], "SELECT appln_id, publn_auth, publn_kind FROM excluded"),
        "first_filings_loc": _with(_first_filing_ctes(LOCATION_INV, "li"), f"SELECT {_FIRST} FROM first_li"),
        "country_codes_inv": _with(_codes_ctes(), "SELECT appln_id, person_id, ctry_code FROM code_inv"),
        "country_codes_app": _with(_codes_ctes(), "SELECT appln_id, person_id, ctry_code FROM code_app"),
        "country_label": _with([], f"SELECT DISTINCT person_ctry_code AS ctry_code, {_label_case('person_ctry_code')} AS country FROM tls206_person"),
        "geocode_admin": _with(_geo_ctes(), f"SELECT location_id, {_NAMES} FROM named_address"),
        "project_metres": _with(_geo_ctes(), "SELECT location_id, geom_x, geom_y, geom_m_x, geom_m_y FROM named_address"),
        "bridge": _with(_bridge_ctes(), "SELECT * FROM bridge"),
        "pool_location": _with(_first_filing_ctes(LOCATION_INV, "li") + _pool_ctes("li"), f"SELECT {_POOL} FROM pool_li"),
    }
    # The inventor preset's keys have no suffix; the applicant preset's end in _app.
    for cfg, suffix, name in ((COUNTRY_INV, "", "inv"), (COUNTRY_APP, "_app", "app")):
        tag = f"c{name[0]}"
        ctes = _country_ctes(cfg, tag)
        pools = _first_filing_ctes(cfg, tag) + _pool_ctes(tag)
        out[f"first_filings_{name}"] = _with(_first_filing_ctes(cfg, tag), f"SELECT {_FIRST} FROM first_{tag}")
        for type_ in ("priority", "continual", "tech_rel", "pct"):
            out[f"pool_{type_}{suffix}"] = _with(pools, f"SELECT {_PERSON_POOL} FROM person_pool_{tag} WHERE type = '{type_}'")
        out[f"direct_own{suffix}"] = _with(ctes, f"SELECT appln_id, person_id, patent_office, appln_filing_date, appln_filing_year, ctry_code, type FROM own_{tag}")
        out[f"direct_other{suffix}"] = _with(ctes, f"SELECT appln_id, patent_office, appln_filing_year, ctry_code, type FROM other_{tag}")
        for key, n, cols in (("earliest_equivalent", 2, _BEST_OWN), ("earliest_other", 3, _BEST_OWN), ("earliest_equivalent_other_role", 5, _BEST_OTHER), ("earliest_other_other_role", 6, _BEST_OTHER)):
            out[f"{key}{suffix}"] = _with(ctes, f"SELECT {cols} FROM best{n}_{tag}")
        out[f"impute_country_{name}"] = _with(ctes, f"SELECT {_COUNTRY} FROM country_{tag}")
    ci = _country_ctes(COUNTRY_INV, "ci")
    out["office_fallback"] = _with(ci, "SELECT appln_id, person_id, ctry_code, source, type FROM country_ci WHERE source = 7")
    out["export_csv"] = _with(ci, f"SELECT {_COUNTRY} FROM country_ci")
    for role in (ROLE_INV, ROLE_APP):
        rows = ", ".join(("appln_id", "person_id", *_LOC_ROW))
        out[f"locations_{role}"] = _with(_geo_ctes() + _located_ctes(role), f"SELECT {_exact_as_double(rows)} FROM at_{role}")
    li = _location_ctes(LOCATION_INV, "li")
    out["impute_location_inv"] = _with(li, f"SELECT {_exact_as_double(_GEOC)} FROM geocoded_li")
    out["impute_location_app"] = _with(_location_ctes(LOCATION_APP, "la"), f"SELECT {_exact_as_double(_GEOC)} FROM geocoded_la")
    out["direct_own_locations"] = _with(li, f"SELECT {_exact_as_double(_LEAN)} FROM own_li")
    out["direct_other_locations"] = _with(li, f"SELECT {_exact_as_double(_LEAN)} FROM other_li")
    for key, n in (("earliest_equivalent_location", 2), ("earliest_other_location", 3), ("earliest_equivalent_location_other_role", 5), ("earliest_other_location_other_role", 6)):
        out[key] = _with(li, f"SELECT {_exact_as_double(_BEST_LOCATION)} FROM best{n}_li")
    # Other ways to the same tables.
    out["impute_country_laid_out"] = out["refresh_country"] = out["impute_country_inv"]
    out["geocode_from_binary"] = out["geocode_admin"]
    stamped = _COUNTRY.replace("country", "TIMESTAMP '2024-02-29 12:34:56' AS lastupdate, country")
    out["impute_country_stamped"] = _with(_country_ctes(COUNTRY_APP, "ca"), f"SELECT {stamped} FROM country_ca")
    return out


def register_sql() -> dict[str, str]:
    """The SQL of the register-only pipelines over tables named as in the register
    (tls201_appln, tls204_appln_prior, ...), without the star-schema adapter: used to
    test the plans on arbitrary registers."""

    def w(ctes: list[str], select: str) -> str:
        return "WITH " + ",\n".join(_lookups() + ctes) + "\n" + select

    return {
        "first_filings_loc": w(_first_filing_ctes(LOCATION_INV, "li"), f"SELECT {_FIRST} FROM first_li"),
        "first_filings_app": w(_first_filing_ctes(COUNTRY_APP, "ca"), f"SELECT {_FIRST} FROM first_ca"),
        "impute_country_inv": w(_country_ctes(COUNTRY_INV, "ci"), f"SELECT {_COUNTRY} FROM country_ci"),
        "impute_country_app": w(_country_ctes(COUNTRY_APP, "ca"), f"SELECT {_COUNTRY} FROM country_ca"),
        "bridge": w(_bridge_ctes(), "SELECT * FROM bridge"),
    }
