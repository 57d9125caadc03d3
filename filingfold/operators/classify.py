"""C0 excluded applications and C1 first-filing classifier.

The reference builds the first-filing table with nine inserts, each anti-joined
against the rows inserted so far.  The eligibility conditions are the same in
every insert, so the same table is obtained in one pass: filter the applications
once (pushed into the scan), reduce every id set the classes and the publication
tests need to one row per application with a single aggregation (first match wins
= lowest rank), and join the persons once.  All joins key on appln_id, so one hash
partitioning serves the facts join, the person join and the final DISTINCT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..constants import (
    TYPE_CONTINUAL,
    TYPE_PCT,
    TYPE_PRIORITY,
    TYPE_SINGLE,
    TYPE_TECH_REL,
)
from ..functions.predicates import browsed_office, excluded_publication, in_year_range
from ..sources.layout import written_in_buckets
from ..sources.register import Register

PF_COLUMNS = (
    "appln_id", "appln_kind", "person_id", "patent_office",
    "appln_filing_year", "appln_filing_date", "type",
)

RANK_PRIORITY, RANK_PCT, RANK_CONTINUAL, RANK_TECH_REL, RANK_SINGLE = 1, 2, 3, 4, 5


def excluded_applications(reg: Register) -> DataFrame:
    """C0: DISTINCT (appln_id, publn_auth, publn_kind) of excluded publications."""
    return reg.publn.filter(excluded_publication()).select("appln_id", "publn_auth", "publn_kind").distinct()


def single_family_applications(appln: DataFrame) -> DataFrame:
    """Applications whose docdb family has exactly one distinct appln_id in the whole
    register.  ``count(DISTINCT id) = 1`` is ``min(id) = max(id)``, which aggregates
    map-side, so a huge family costs one partial row per task, not one group."""
    return (
        appln.filter(F.col("docdb_family_id").isNotNull())
        .groupBy("docdb_family_id")
        .agg(F.min("appln_id").alias("lo"), F.max("appln_id").alias("hi"))
        .filter(F.col("lo") == F.col("hi"))
        .select(F.col("lo").alias("appln_id"))
    )


def pct_first(appln_kind="appln_kind") -> F.Column:
    return (
        (F.col(appln_kind) == "W")
        & (F.col("nat_phase") == "N")
        & (F.col("reg_phase") == "N")
        & (F.col("appln_id") == F.col("earliest_filing_id"))
    )


def eligible_applications(reg: Register, cfg: Config) -> DataFrame:
    """Applications that pass the row-level conditions shared by the nine inserts
    (office, kind, no PCT parent, year window); pushed into the parquet scan."""
    kind = F.col("appln_kind")
    national_kind = (kind == "A") if cfg.national_kind == "A" else (kind != "W")
    national = national_kind & browsed_office("appln_auth")
    international = (kind == "W") & browsed_office("receiving_office")
    return reg.appln.filter(
        (national | international)
        & (F.col("internat_appln_id") == 0)
        & in_year_range("appln_filing_year", cfg.year_range)
    ).select(
        "appln_id", "appln_kind", "appln_auth", "appln_filing_year", "appln_filing_date",
        "nat_phase", "reg_phase", "earliest_filing_id",
    )


def application_facts(reg: Register, cfg: Config) -> DataFrame:
    """Everything the classifier needs from other tables, per application, in one
    aggregation: the best id-set class (rank 1, 3, 4 or 5; pct = 2 is a row test),
    whether a publication is excluded, and whether one is numbered and not D2.
    All id sets are appended and reduced with combinable min/max, so there is one
    shuffle for all of them and hot ids pre-aggregate map-side."""
    null_int = F.lit(None).cast("int")

    def ranked(df: DataFrame, col: str, rank: int) -> DataFrame:
        return df.select(
            F.col(col).alias("appln_id"), F.lit(rank).alias("rank"),
            null_int.alias("excluded"), null_int.alias("published"),
        )

    facts = (
        ranked(reg.prior, "prior_appln_id", RANK_PRIORITY)
        .unionByName(ranked(reg.contn, "parent_appln_id", RANK_CONTINUAL))
        .unionByName(ranked(reg.tech_rel, "tech_rel_appln_id", RANK_TECH_REL))
        .unionByName(ranked(single_family_applications(reg.appln), "appln_id", RANK_SINGLE))
    )
    if cfg.use_exclusions or cfg.require_publication:
        numbered = F.col("publn_nr").isNotNull() & (F.col("publn_kind") != "D2")
        facts = facts.unionByName(
            reg.publn.select(
                "appln_id", null_int.alias("rank"),
                excluded_publication().cast("int").alias("excluded"), numbered.cast("int").alias("published"),
            )
        )
    return (
        facts.filter(F.col("appln_id").isNotNull())
        .groupBy("appln_id")
        .agg(F.min("rank").alias("rank"), F.max("excluded").alias("excluded"), F.max("published").alias("published"))
    )


def _facts_by_bucket(reg: Register, eligible: DataFrame, cfg: Config) -> DataFrame:
    """``eligible`` with its facts over a laid-out register: each link table is reduced
    to its first filings within its buckets and meets tls201 there.  Only the ids of
    families of one, and publications where the preset asks for them, are exchanged."""
    found = eligible
    for type_, rank in (("priority", RANK_PRIORITY), ("continual", RANK_CONTINUAL), ("tech_rel", RANK_TECH_REL)):
        found = reg.layout.by_first[type_].attach(found, **{f"rank_{type_}": F.min(F.lit(rank))})
    single = single_family_applications(reg.appln).withColumn("rank_single", F.lit(RANK_SINGLE))
    found = found.join(single, "appln_id", "left")
    found = found.withColumn("rank", F.least("rank_priority", "rank_continual", "rank_tech_rel", "rank_single"))
    if not (cfg.use_exclusions or cfg.require_publication):
        return found
    numbered = F.col("publn_nr").isNotNull() & (F.col("publn_kind") != "D2")
    facts = reg.publn.groupBy("appln_id").agg(
        F.max(excluded_publication().cast("int")).alias("excluded"), F.max(numbered.cast("int")).alias("published")
    )
    return found.join(facts, "appln_id", "left")


def first_filings(reg: Register, cfg: Config, only: DataFrame | None = None) -> DataFrame:
    """C1: the first-filing table (one row per application x person in own role).
    ``only``: a written table of the applications (appln_id) to look at."""
    rank = F.col("rank")
    eligible = eligible_applications(reg, cfg)
    if only is not None:
        eligible = eligible.join(only, "appln_id", "left_semi")
    if reg.layout is None:
        typed = eligible.join(application_facts(reg, cfg), "appln_id", "left")
    else:
        typed = _facts_by_bucket(reg, eligible, cfg)
    if cfg.use_exclusions:
        # LEFT JOIN toExclude ... IS NULL: one excluded publication drops the application.
        typed = typed.filter(F.coalesce(F.col("excluded"), F.lit(0)) == 0)
    if cfg.require_publication:
        typed = typed.filter(F.col("published") == 1)
    typed = typed.withColumn(
        "type",
        F.when(rank == RANK_PRIORITY, F.lit(TYPE_PRIORITY))
        .when(pct_first(), F.lit(TYPE_PCT))
        .when(rank == RANK_CONTINUAL, F.lit(TYPE_CONTINUAL))
        .when(rank == RANK_TECH_REL, F.lit(TYPE_TECH_REL))
        .when(rank == RANK_SINGLE, F.lit(TYPE_SINGLE)),
    ).filter(F.col("type").isNotNull())
    if reg.layout is not None:  # read twice, for rows in buckets and for hot ones
        typed = written_in_buckets(typed, "appln_id", reg.layout.buckets, dealt=True)
    person = F.col("person_id")
    if cfg.pct_person == "reference":
        # The location script selects the person of the anti-joined side for pct
        # filings, which is always NULL: one row with a NULL person per application.
        person = F.when(F.col("type") == TYPE_PCT, F.lit(None).cast("long")).otherwise(person)

    def own_role(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col(cfg.own_seq) > 0).select(
            "appln_id",
            "appln_kind",
            person.alias("person_id"),
            F.col("appln_auth").alias("patent_office"),
            "appln_filing_year",
            "appln_filing_date",
            "type",
        ).distinct()

    if reg.layout is not None:
        return reg.layout.persons.rows_of(typed, own_role)
    return own_role(typed.join(reg.pers_appln.select("appln_id", "person_id", cfg.own_seq), "appln_id"))


def first_filing_applications(pf: DataFrame) -> DataFrame:
    """One row per first filing with the attributes the outputs carry."""
    return pf.select("appln_id", "patent_office", "appln_filing_date", "appln_filing_year", "type").distinct()
