"""C6 subsequent-filing pool.

The pool is built at *filing* grain: (appln_id, subsequent_id, subsequent_date,
nb_priorities, type).  nb_priorities = 1 marks an "equivalent", > 1 an "other
subsequent filing".  The country scripts expand it to persons of the subsequent
filing (``person_pool``); the pipelines only expand the chosen filing to its rows, and
repeat those last (``operators.waterfall.fill``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import TYPE_CONTINUAL, TYPE_PCT, TYPE_PRIORITY, TYPE_TECH_REL
from ..sources.layout import written_in_buckets
from ..sources.register import Register

POOL_COLUMNS = ("appln_id", "subsequent_id", "subsequent_date", "nb_priorities", "type")
PERSON_POOL_COLUMNS = (
    "appln_id", "subsequent_id", "subsequent_person_id", "applt_seq_nr", "invt_seq_nr",
    "patent_office", "appln_filing_year", "subsequent_date", "nb_priorities", "type",
)


def _firsts(pf_apps: DataFrame, type_: str) -> DataFrame:
    return pf_apps.filter(F.col("type") == type_).select("appln_id")


# Link tables that define a pool: (type, table, column holding the first filing).
def _link_tables(reg: Register):
    return (
        (TYPE_PRIORITY, reg.prior, "prior_appln_id"),
        (TYPE_CONTINUAL, reg.contn, "parent_appln_id"),
        (TYPE_TECH_REL, reg.tech_rel, "tech_rel_appln_id"),
    )


def linked_pool(reg: Register, pf_apps: DataFrame) -> DataFrame:
    """Priority, continual and technical-relation pools in one plan.

    The three link tables are appended once, tagged with their pool type.  That one
    union feeds both the nb_priorities aggregate (highest claim number for
    priorities, number of rows for continuations and relations; over *all* rows of
    the subsequent filing) and the pairs (first filing, subsequent filing) kept for
    first filings of the matching type; the subsequent filing's date and nb are
    then joined on subsequent_id, so tls201 is scanned once for all three types."""
    if reg.layout is not None:
        return _linked_by_bucket(reg, pf_apps)
    links = None
    for type_, table, first_col in _link_tables(reg):
        seq = F.col("prior_appln_seq_nr") if type_ == TYPE_PRIORITY else F.lit(None).cast("int")
        part = table.select(
            F.col(first_col).alias("appln_id"),
            F.col("appln_id").alias("subsequent_id"),
            F.lit(type_).alias("type"),
            seq.alias("seq"),
        )
        links = part if links is None else links.unionByName(part)
    t = F.col("type")
    nb = links.groupBy("subsequent_id").agg(
        F.max(F.when(t == TYPE_PRIORITY, F.col("seq"))).alias("nb_priority"),
        F.count(F.when(t == TYPE_CONTINUAL, F.lit(1))).alias("nb_continual"),
        F.count(F.when(t == TYPE_TECH_REL, F.lit(1))).alias("nb_tech_rel"),
    )
    pairs = links.select("appln_id", "subsequent_id", "type").join(
        pf_apps.select("appln_id", "type"), ["appln_id", "type"], "left_semi"
    )
    nb_of_type = (
        F.when(t == TYPE_PRIORITY, F.col("nb_priority"))
        .when(t == TYPE_CONTINUAL, F.col("nb_continual"))
        .otherwise(F.col("nb_tech_rel"))
        .cast("int")
    )
    return (
        pairs.join(_dated(reg), "subsequent_id")
        .join(nb, "subsequent_id")
        .select("appln_id", "subsequent_id", "subsequent_date", nb_of_type.alias("nb_priorities"), "type")
        .distinct()
    )


def _linked_by_bucket(reg: Register, pf_apps: DataFrame) -> DataFrame:
    """``linked_pool`` over a laid-out register.  Links of the wanted first filings are
    taken within the buckets by first filing; only these pairs are exchanged, and meet
    tls201 and the counts within the buckets by later filing."""
    pairs = None
    for type_, links in reg.layout.by_first.items():
        found = links.rows_of(_firsts(pf_apps, type_), lambda rows: rows.distinct()).withColumn("type", F.lit(type_))
        pairs = found if pairs is None else pairs.unionByName(found)
    later = written_in_buckets(pairs, "subsequent_id", reg.layout.buckets)
    dated = later.select("subsequent_id").distinct().join(_dated(reg), "subsequent_id")
    counted = reg.layout.by_later["priority"].attach(dated, priority=F.max("seq"))
    for type_ in ("continual", "tech_rel"):
        counted = reg.layout.by_later[type_].attach(counted, **{type_: F.count(F.lit(1)).cast("int")})
    nb = F.coalesce(*[F.when(F.col("type") == t, F.col(t)) for t in reg.layout.by_later])
    return later.join(counted, "subsequent_id").select("appln_id", "subsequent_id", "subsequent_date", nb.alias("nb_priorities"), "type")


def _dated(reg: Register) -> DataFrame:
    return reg.appln.select(F.col("appln_id").alias("subsequent_id"), F.col("appln_filing_date").alias("subsequent_date"))


def pool_priority(reg: Register, pf_apps: DataFrame) -> DataFrame:
    """Filings claiming the first filing as priority; nb = highest claim sequence number."""
    return linked_pool(reg, pf_apps).filter(F.col("type") == TYPE_PRIORITY)


def pool_continual(reg: Register, pf_apps: DataFrame) -> DataFrame:
    """Continuations of the first filing; nb = number of parents of the continuation."""
    return linked_pool(reg, pf_apps).filter(F.col("type") == TYPE_CONTINUAL)


def pool_tech_rel(reg: Register, pf_apps: DataFrame) -> DataFrame:
    """Technically related filings; nb = number of relations of the related filing."""
    return linked_pool(reg, pf_apps).filter(F.col("type") == TYPE_TECH_REL)


def pool_pct(reg: Register, pf_apps: DataFrame) -> DataFrame:
    """Regional-phase (nb = 1) and national-phase (nb = 2) entries of a PCT first filing.
    A filing in both phases is in both."""
    children = (
        reg.appln.filter(F.col("internat_appln_id") != 0)
        .select(
            F.col("internat_appln_id").alias("appln_id"),
            F.col("appln_id").alias("subsequent_id"),
            F.col("appln_filing_date").alias("subsequent_date"),
            "reg_phase",
            "nat_phase",
        )
        .join(_firsts(pf_apps, TYPE_PCT), "appln_id", "left_semi")
    )
    nb = F.explode(
        F.array_compact(
            F.array(
                F.when(F.col("reg_phase") == "Y", F.lit(1)),
                F.when(F.col("nat_phase") == "Y", F.lit(2)),
            )
        )
    )
    return (
        children.select("appln_id", "subsequent_id", "subsequent_date", nb.alias("nb_priorities"))
        .distinct()
        .withColumn("type", F.lit(TYPE_PCT))
    )


def subsequent_pool(reg: Register, pf_apps: DataFrame) -> DataFrame:
    """All pools appended (filing grain)."""
    return linked_pool(reg, pf_apps).unionByName(pool_pct(reg, pf_apps))


def person_pool(reg: Register, pool: DataFrame, pf_apps: DataFrame) -> DataFrame:
    """The country scripts' pool: one row per distinct person row of the subsequent
    filing.  All sides are distinct before the joins, so the result is, and no DISTINCT
    above rides on a join's partitioning: AQE may split a first filing with very many
    subsequent filings (``pf_apps`` should be a written table, as in the plans)."""
    persons = reg.pers_appln.select(
        F.col("appln_id").alias("subsequent_id"),
        F.col("person_id").alias("subsequent_person_id"),
        "applt_seq_nr",
        "invt_seq_nr",
    ).distinct()
    attrs = pf_apps.select("appln_id", "patent_office", "appln_filing_year")
    return (
        pool.join(persons, "subsequent_id")
        .join(attrs, "appln_id")
        .select(*PERSON_POOL_COLUMNS)
    )
