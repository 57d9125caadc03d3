"""C5 earliest candidate and C7 direct information.

The reference joins the whole pool to the information table, takes the minimum
date, joins back, takes the minimum subsequent id, and joins back again.  Here the
winner is chosen at filing grain first — the lexicographic minimum of
(subsequent_date, subsequent_id) over pool filings that have usable information —
and only the winner is expanded to its information rows.  ``min(struct)`` is a
combinable aggregate, so a first filing with millions of subsequent filings costs
one partial row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.predicates import nonempty
from ..operators.info import country_codes, person_codes
from ..sources.register import Register
from ..sources.schemas import LEAN_LOCATION_COLUMNS

EQUIVALENT = "equivalent"  # nb_priorities = 1
OTHER = "other"  # nb_priorities > 1


def _nb_filter(kind: str) -> F.Column:
    nb = F.col("nb_priorities")
    return nb == 1 if kind == EQUIVALENT else nb > 1


def earliest_winner(pool: DataFrame, kind: str, usable: DataFrame) -> DataFrame:
    """(appln_id, subsequent_id, min_date): the earliest usable subsequent filing,
    ties on the date broken by the lowest id.  NULL dates never win (``min`` skips
    them and ``= min`` never matches NULL)."""
    cand = (
        pool.filter(_nb_filter(kind) & F.col("subsequent_date").isNotNull())
        .select("appln_id", "subsequent_id", "subsequent_date")
        .join(usable.select("subsequent_id").distinct(), "subsequent_id", "left_semi")
    )
    return (
        cand.groupBy("appln_id")
        .agg(F.min(F.struct("subsequent_date", "subsequent_id")).alias("w"))
        .select("appln_id", F.col("w.subsequent_id").alias("subsequent_id"), F.col("w.subsequent_date").alias("min_date"))
    )


# ---------------------------------------------------------------- country information


def own_code_rows(reg: Register, cfg: Config) -> DataFrame:
    """Own-role rows of every filing usable for sources 2 and 3:
    (subsequent_id, person_id, ctry_code), one per distinct person row with a code.

    The reference joins the pool's person rows to the code table on (filing, person);
    the code table is itself those person rows joined to the person table, so one
    join on person_id gives the same multiset.  Both sides are distinct before the
    join, so nothing above rides on its partitioning and AQE may split a hot person."""
    rows = reg.pers_appln.filter(F.col(cfg.own_seq) > 0).select("appln_id", "person_id", "applt_seq_nr", "invt_seq_nr").distinct()
    return rows.join(person_codes(reg).filter(nonempty("ctry_code")), "person_id").select(
        F.col("appln_id").alias("subsequent_id"), "person_id", "ctry_code"
    )


def other_code_rows(reg: Register, cfg: Config) -> DataFrame:
    """Other-role rows for sources 5 and 6: (subsequent_id, person_id = 0, ctry_code).

    The reference joins these codes on the filing id only, while its pool has one row
    per person row of the filing, so each code row appears once per other-role person
    row (k x m rows).  The rows here are the m code rows; ``copies_of`` has k, and
    ``expand_copies`` repeats the rows of the chosen filings, after the winner is
    known.  ``dedupe_cross_role`` keeps distinct codes once."""
    codes = country_codes(reg, cfg.other_role).filter(nonempty("ctry_code"))
    rows = codes.select(F.col("appln_id").alias("subsequent_id"), F.lit(0).cast("long").alias("person_id"), "ctry_code")
    return rows.distinct() if cfg.dedupe_cross_role else rows


def copies_of(reg: Register, cfg: Config) -> DataFrame | None:
    """(subsequent_id, copies): how often each other-role row of a filing appears."""
    if cfg.dedupe_cross_role:
        return None
    return (
        reg.pers_appln.filter(F.col(cfg.other_seq) > 0)
        .select(F.col("appln_id").alias("subsequent_id"), "person_id", "applt_seq_nr", "invt_seq_nr")
        .distinct()
        .groupBy("subsequent_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def expand_copies(rows: DataFrame) -> DataFrame:
    """Each row as often as its ``copies`` says (once where it is null)."""
    n = F.coalesce(F.col("copies"), F.lit(1)).cast("int")
    return rows.withColumn("copies", F.explode(F.sequence(F.lit(1), n))).drop("copies")


def direct_own_codes(pf: DataFrame, reg: Register, cfg: Config) -> DataFrame:
    """Country source 1 table (PRIORITY_FILINGS1): every first-filing person with its
    own-role code, if any (left join)."""
    codes = country_codes(reg, cfg.role)
    return (
        pf.join(codes, ["appln_id", "person_id"], "left")
        .select("appln_id", "person_id", "patent_office", "appln_filing_date", "appln_filing_year", "ctry_code", "type")
        .distinct()
    )


def direct_other_codes(pf_apps: DataFrame, reg: Register, cfg: Config) -> DataFrame:
    """Country source 4 table (PRIORITY_FILINGS4): distinct other-role codes per first filing."""
    codes = country_codes(reg, cfg.other_role).filter(nonempty("ctry_code"))
    return (
        pf_apps.join(codes.select("appln_id", "ctry_code"), "appln_id")
        .select("appln_id", "patent_office", "appln_filing_year", "ctry_code", "type")
        .distinct()
    )


# --------------------------------------------------------------- location information

LEAN = LEAN_LOCATION_COLUMNS


#: A location row of the waterfall, by the id of its lean columns (``operators.info``).
POINT = ("point_id",)


def located(locs: DataFrame, payload: tuple[str, ...] = LEAN) -> DataFrame:
    return locs.filter(F.col("located") if payload == POINT else F.col("lat").isNotNull())


def direct_own_locations(pf: DataFrame, own_locs: DataFrame, payload: tuple[str, ...] = LEAN) -> DataFrame:
    """Location source 1 rows: persons matched on (appln_id, person_id), plus the
    person-less (person_id = 0) locations matched on appln_id; each branch DISTINCT,
    then appended."""
    locs = located(own_locs, payload)
    by_person = (
        pf.select("appln_id", "person_id")
        .join(locs, ["appln_id", "person_id"])
        .select("appln_id", "person_id", *payload)
        .distinct()
        .drop("person_id")
    )
    anonymous = (
        pf.select("appln_id")
        .distinct()
        .join(locs.filter(F.col("person_id") == 0), "appln_id")
        .select("appln_id", *payload)
        .distinct()
    )
    return by_person.unionByName(anonymous)


def direct_other_locations(pf_apps: DataFrame, other_locs: DataFrame, payload: tuple[str, ...] = LEAN) -> DataFrame:
    """Location source 4 rows: distinct other-role locations of the first filing."""
    return pf_apps.select("appln_id").join(located(other_locs, payload), "appln_id").select("appln_id", *payload).distinct()


def locations_by_subsequent(locs: DataFrame, payload: tuple[str, ...] = LEAN) -> DataFrame:
    """Location rows of a subsequent filing (all persons), as stored: sources 2, 3, 5, 6."""
    return located(locs, payload).select(F.col("appln_id").alias("subsequent_id"), *payload)
