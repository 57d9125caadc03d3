"""C2 country code of each person and C4 location union.

Location rows are ids.  ``address_ids`` numbers the address table's distinct points
(the coordinates and their source) and spots (address text, data source, point), so the
joins and DISTINCTs of C4 and of the waterfall carry longs.  An address text is known by
a 128-bit key made in the scan; texts are shuffled once, to see whether two of them share
a key, and rows of such a key carry their text beside it.  Coordinates, administrative
names and geometry are attached once, after the waterfall.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ROLE_APP, ROLE_INV
from ..constants import (
    DS_CN,
    DS_EU,
    DS_JP,
    DS_KR,
    DS_PATSTAT,
    DS_PCT,
    DS_USPTO,
    PCT_RELATIONS_APP_ANY_SOURCE,
    PCT_RELATIONS_APP_WITH_SOURCE,
    PCT_RELATIONS_INV_ANY_SOURCE,
    PCT_RELATIONS_INV_WITH_SOURCE,
)
from ..session import cut_lineage
from ..sources.register import LocationInputs, Register
from ..sources.schemas import LEAN_LOCATION_COLUMNS

LOCATION_ROW_COLUMNS = (
    "appln_id", "person_id", "lng_exact", "lat_exact", "lng", "lat", "data_source", "coord_source",
)
LOCATION_IDS = ("spot_id", "point_id", "located")


def _seq(role: str) -> str:
    return "invt_seq_nr" if role == ROLE_INV else "applt_seq_nr"


def country_codes(reg: Register, role: str) -> DataFrame:
    """C2: DISTINCT (appln_id, person_id, ctry_code) of persons in ``role``.

    Both sides are made distinct before the join, which is then distinct itself:
    nothing above needs the join's partitioning, so AQE may split a person on very
    many applications."""
    persons = reg.pers_appln.filter(F.col(_seq(role)) > 0).select("appln_id", "person_id").distinct()
    return persons.join(person_codes(reg), "person_id").select("appln_id", "person_id", "ctry_code")


def person_codes(reg: Register) -> DataFrame:
    """Distinct (person_id, ctry_code)."""
    return reg.person.select("person_id", F.col("person_ctry_code").alias("ctry_code")).distinct()


# ------------------------------------------------------------------ address dictionary


def text_key(text: Column) -> tuple[Column, Column]:
    """128-bit key of a text; NULL for NULL, which no join on it matches."""
    return F.when(text.isNotNull(), F.xxhash64(text)), F.when(text.isNotNull(), F.xxhash64(F.lit(1), text))


@dataclass(frozen=True)
class AddressIds:
    """The address table by ids, all written.  ``entries``: location_id, data_source, the
    text's key (``key`` columns), spot_id, point_id, located (has a latitude).  ``spots``:
    spot_id, data_source, point_id.  ``points``: point_id and the lean columns.
    ``texts``: the WIPO texts, appln_id, relation_type_id and the text's key."""

    entries: DataFrame
    spots: DataFrame
    points: DataFrame
    texts: DataFrame
    key: tuple[str, ...]


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a distinct long per row, fixed by writing it."""
    return cut_lineage(df.withColumn(name, F.monotonically_increasing_id()))


def _with_id(df: DataFrame, ids: DataFrame, columns: tuple[str, ...], name: str) -> DataFrame:
    """``name`` of each row's ``columns``; NULL equals NULL, as in a DISTINCT."""
    other = ids.select(*[F.col(c).alias(f"_{c}") for c in columns], name)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]
    return df.join(other, same).drop(*[f"_{c}" for c in columns])


def address_ids(loc: LocationInputs, key_of: Callable[[Column], tuple[Column, Column]] = text_key) -> AddressIds:
    """Number points and spots; key the texts of the address table and of WIPO."""
    k1, k2 = key_of(F.col("unformattedaddress"))
    addr = loc.addresses.select("location_id", "data_source", *LEAN_LOCATION_COLUMNS, k1.alias("k1"), k2.alias("k2"), "unformattedaddress")
    k1, k2 = key_of(F.col("address_text"))
    pct = loc.addresses_pct.select("appln_id", "relation_type_id", k1.alias("k1"), k2.alias("k2"), F.col("address_text"))
    # The one exchange of texts: keys that stand for more than one of them.
    every = addr.select("k1", "k2", F.col("unformattedaddress").alias("t")).unionByName(pct.select("k1", "k2", F.col("address_text").alias("t")))
    shared = cut_lineage(
        every.filter(F.col("t").isNotNull()).distinct()
        .groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("k1", "k2")
    )
    key: tuple[str, ...] = ("k1", "k2")
    if not shared.isEmpty():
        # Rows of a shared key are told apart by the text itself; others carry "".
        marked = shared.withColumn("_shared", F.lit(True))
        own = lambda c: F.when(F.col("_shared"), F.col(c)).otherwise(F.lit(""))
        addr = addr.join(marked, ["k1", "k2"], "left").withColumn("k3", own("unformattedaddress"))
        pct = pct.join(marked, ["k1", "k2"], "left").withColumn("k3", own("address_text"))
        key = ("k1", "k2", "k3")
    addr = addr.select("location_id", "data_source", *LEAN_LOCATION_COLUMNS, *key)

    points = numbered(addr.select(*LEAN_LOCATION_COLUMNS).distinct(), "point_id")
    located = F.col("lat").isNotNull().alias("located")
    narrow = cut_lineage(
        _with_id(addr, points, LEAN_LOCATION_COLUMNS, "point_id").select("location_id", "data_source", *key, "point_id", located)
    )
    parts = (*key, "data_source", "point_id")
    spots = numbered(narrow.select(*parts).distinct(), "spot_id")
    entries = cut_lineage(_with_id(narrow, spots, parts, "spot_id"))
    texts = pct.select("appln_id", "relation_type_id", *key)
    return AddressIds(entries, spots.select("spot_id", "data_source", "point_id"), points, texts, key)


# ---------------------------------------------------------------------- location union


def location_rows(reg: Register, loc: LocationInputs, ids: AddressIds | None = None, role: str | None = None) -> DataFrame:
    """C4 for both roles in one plan, or for one ``role``, by ids: (role, appln_id,
    person_id, spot_id, point_id, located) of the inventor and applicant location tables,
    tagged with ``role`` ('inv' / 'app').  A source row that qualifies for
    both roles is emitted once per role; DISTINCT is taken within each branch and
    role, as the reference does per table.  Each input table is scanned and
    shuffled once for both roles.  Where the DISTINCT keys contain the join key (a
    person, an address text), both sides are distinct before the join, which is then
    distinct itself: nothing above it holds rows in memory or needs its partitioning, so
    AQE may split a hot person or text."""
    ids = ids or address_ids(loc)
    addr = ids.entries
    person_id0 = F.lit(0).cast("long").alias("person_id")
    wanted = (ROLE_INV, ROLE_APP) if role is None else (role,)

    def any_of(*tests: F.Column) -> F.Column:
        return reduce(lambda a, b: a | b, tests)

    def roles(**tests: F.Column) -> F.Column:
        return F.explode(F.array_compact(F.array(*[F.when(tests[r], F.lit(r)) for r in wanted])))

    # Register persons geocoded by location id (PATSTAT/REGPAT and USPTO addresses).
    named = [(F.col(_seq(r)) > 0).alias(r) for r in wanted]
    persons = reg.pers_appln.filter(any_of(*named)).groupBy("person_id", "appln_id").agg(*[F.max(n).alias(r) for n, r in zip(named, wanted)])
    by_person = (
        addr.filter(F.col("data_source").isin(DS_PATSTAT, DS_USPTO))
        .select("location_id", *LOCATION_IDS)
        .join(loc.person_location, "location_id")
        .select("person_id", *LOCATION_IDS)
        .distinct()
        .join(persons, "person_id")
        .select(roles(**{r: F.col(r) for r in wanted}).alias("role"), "appln_id", "person_id", *LOCATION_IDS)
    )

    # WIPO addresses matched on the free text.  The reference writes
    # ``ds IN (...) AND rel = a OR rel = b ...`` without parentheses, so the
    # data_source test only guards the first relation type (kept as written).
    # A spot has one text, so texts by application and spots join to distinct rows.
    rel = F.col("relation_type_id")
    listed = F.col("data_source").isin(DS_PCT, DS_PATSTAT, DS_USPTO)
    relations = {
        ROLE_INV: (rel == PCT_RELATIONS_INV_WITH_SOURCE, rel.isin(*PCT_RELATIONS_INV_ANY_SOURCE)),
        ROLE_APP: (rel == PCT_RELATIONS_APP_WITH_SOURCE, rel.isin(*PCT_RELATIONS_APP_ANY_SOURCE)),
    }
    tests = {name: test for r in wanted for name, test in zip((f"{r}_listed", f"{r}_any"), relations[r])}
    texts = ids.texts.filter(any_of(*tests.values())).groupBy("appln_id", *ids.key).agg(*[F.max(t).alias(n) for n, t in tests.items()])
    by_role = {r: (listed & F.col(f"{r}_listed")) | F.col(f"{r}_any") for r in wanted}
    by_text = (
        addr.select(*ids.key, "data_source", *LOCATION_IDS)
        .distinct()
        .join(texts, list(ids.key))
        .select(roles(**by_role).alias("role"), "appln_id", person_id0, *LOCATION_IDS)
    )

    # Office mappings tag each row 'INV' or 'APP'.  The Chinese office is read for
    # applicants only (a comment announces KR; the statement reads CN).  Their DISTINCT
    # leaves the text out: spots of one office and point are one row, any stands for it.
    def by_office(mapping: DataFrame, source: str, tags: tuple[str, ...]) -> DataFrame:
        tags = tuple(t for t in tags if t.lower() in wanted)
        return (
            addr.filter(F.col("data_source") == source)
            .select("location_id", *LOCATION_IDS)
            .join(mapping.filter(F.col("app_inv").isin(*tags)), "location_id")
            .groupBy(F.lower(F.col("app_inv")).alias("role"), "appln_id", "point_id", "located")
            .agg(F.min("spot_id").alias("spot_id"))
            .select("role", "appln_id", person_id0, *LOCATION_IDS)
        )

    branches = [
        by_person,
        by_text,
        by_office(loc.appln_location_eu, DS_EU, ("INV", "APP")),
        by_office(loc.appln_location_jp, DS_JP, ("INV", "APP")),
        by_office(loc.appln_location_kr, DS_KR, ("INV", "APP")),
    ]
    if ROLE_APP in wanted:
        branches.append(by_office(loc.appln_location_cn, DS_CN, ("APP",)))
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b)
    return out


def locations(reg: Register, loc: LocationInputs, role: str) -> DataFrame:
    """C4: geocoded locations of persons in ``role`` (the reference's five inventor
    or six applicant branches, appended)."""
    ids = address_ids(loc)
    rows = role_rows(location_rows(reg, loc, ids, role), role).select("appln_id", "person_id", "spot_id")
    dictionary = cut_lineage(ids.spots.join(ids.points, "point_id").drop("point_id"))
    return rows.join(dictionary, "spot_id").select(*LOCATION_ROW_COLUMNS)


def role_rows(rows: DataFrame, role: str) -> DataFrame:
    return rows.filter(F.col("role") == role).drop("role")
