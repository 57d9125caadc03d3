"""C10 family bridge: first filing -> every publication in its family.

The reference appends eight stages to one table, each stage reading what the earlier
ones left.  What a stage needs of the earlier ones is two facts per application: is
it a member yet, and is it a first filing yet.  They are kept as flags in one table
per application, extended twice (``_known``): after the phases of PCT filings and
after the continuations.  Each stage is then a semi-join of (prior, member) pairs with
the flags of the moment; publication and application columns are joined once at the
end.  Stages are DISTINCT within themselves and appended without a global DISTINCT (a
pair may appear under two types).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BRIDGE_CONTINUAL, BRIDGE_PCT, BRIDGE_PRIORITY, BRIDGE_SINGLE, BRIDGE_TECH_REL
from ..operators.classify import single_family_applications
from ..session import cut_lineage
from ..sources.register import Register
from .prefilter import existing, worth_thinning

APPLN_COLUMNS = (
    "appln_auth", "appln_kind", "appln_filing_date", "appln_filing_year", "earliest_publn_date",
    "earliest_publn_year", "earliest_pat_publn_id", "granted", "docdb_family_id", "inpadoc_family_id",
)


def _pairs(df: DataFrame, prior: str, member: str) -> DataFrame:
    return df.select(F.col(prior).alias("prior_appln_id"), F.col(member).alias("appln_id"))


def _flags(*facts: tuple[DataFrame, str]) -> DataFrame:
    """One row per application that any of the frames holds, with a boolean column for
    each: whether the id is in it.  The frames are appended as (id, bit) and reduced with
    one combinable aggregate, so there is one exchange of two columns for all of them."""
    parts = [ids.toDF("appln_id").withColumn("bits", F.lit(1 << i)) for i, (ids, _) in enumerate(facts)]
    bits = reduce(DataFrame.unionByName, parts).filter(F.col("appln_id").isNotNull()).groupBy("appln_id").agg(F.bit_or("bits").alias("bits"))
    return bits.select("appln_id", *[(F.col("bits").bitwiseAND(F.lit(1 << i)) != 0).alias(name) for i, (_, name) in enumerate(facts)])


def _known(flags: DataFrame, *facts: tuple[DataFrame, str]) -> DataFrame:
    """``flags`` (one row per application) with further boolean columns: whether the
    id is in the given frame.  Ids are aggregated first, so a first filing with
    millions of members is one row in the join."""
    for ids, name in facts:
        flags = flags.join(ids.toDF("appln_id").distinct().withColumn(name, F.lit(True)), "appln_id", "left")
        flags = flags.withColumn(name, F.coalesce(name, F.lit(False)))
    return flags


def bridge_pairs(reg: Register) -> DataFrame:
    """(prior_appln_id, appln_id, type) for every stage, appended."""
    a = reg.appln
    published = cut_lineage(reg.publn.select("appln_id").distinct().join(a.select("appln_id"), "appln_id", "left_semi"))

    def pub(pairs: DataFrame) -> DataFrame:
        return pairs.join(published, "appln_id", "left_semi").distinct()

    def itself(ids: DataFrame) -> DataFrame:
        return ids.select(F.col("appln_id").alias("prior_appln_id"), "appln_id")

    def under(pairs: DataFrame, firsts: DataFrame) -> DataFrame:
        known = firsts.select(F.col("appln_id").alias("prior_appln_id"))
        return pub(pairs.join(known, "prior_appln_id", "left_semi"))

    def typed(pairs: DataFrame, type_: str) -> DataFrame:
        return pairs.select("prior_appln_id", "appln_id", F.lit(type_).alias("type"))

    # 1. Priority claims: the claiming filings and the claimed filing itself (UNION).
    claims = cut_lineage(
        pub(_pairs(reg.prior, "prior_appln_id", "appln_id").unionByName(_pairs(reg.prior, "prior_appln_id", "prior_appln_id")))
    )
    pct = a.filter(
        (F.col("internat_appln_id") == 0) & (F.col("appln_kind") == "W") & (F.col("appln_id") == F.col("earliest_filing_id"))
    )
    claimed = claims.select("prior_appln_id")
    flags = _flags(
        (published, "pub"), (claims.select("appln_id"), "member"), (claimed, "first"), (pct.select("appln_id"), "pct"),
        (reg.contn.select("parent_appln_id"), "parent"), (reg.tech_rel.select("tech_rel_appln_id"), "related"),
        (single_family_applications(a).select("appln_id"), "single"),
    ).filter(F.col("pub") | F.col("first"))
    # 2. PCT applications that start a family, if not yet a member.
    flags = cut_lineage(flags.withColumn("s2", F.col("pub") & F.col("pct") & ~F.col("member")))
    stage2 = itself(flags.filter(F.col("s2")))
    # 3. Regional / national phase entries of a PCT first filing of stage 2.
    phases = a.filter((F.col("internat_appln_id") != 0) & ((F.col("reg_phase") == "Y") | (F.col("nat_phase") == "Y")))
    stage3 = under(_pairs(phases, "internat_appln_id", "appln_id"), flags.filter(F.col("s2")))
    # 4. Parents of continuations, if not yet a member.
    flags = _known(flags, (stage3.select("appln_id"), "m3"))
    flags = flags.withColumn("member", F.col("member") | F.col("s2") | F.col("m3"))
    flags = flags.withColumn("s4", F.col("pub") & F.col("parent") & ~F.col("member"))
    flags = cut_lineage(flags.withColumn("first", F.col("first") | F.col("s2") | F.col("s4")))
    stage4 = itself(flags.filter(F.col("s4")))
    # 5. Continuations of any first filing so far (no type test).
    stage5 = under(_pairs(reg.contn, "parent_appln_id", "appln_id"), flags.filter(F.col("first")))
    # 6. Technically related filings, if not yet a member.
    flags = _known(flags, (stage5.select("appln_id"), "m5"))
    flags = flags.withColumn("member", F.col("member") | F.col("s4") | F.col("m5"))
    flags = flags.withColumn("s6", F.col("pub") & F.col("related") & ~F.col("member"))
    flags = cut_lineage(flags.withColumn("first", F.col("first") | F.col("s6")))
    stage6 = itself(flags.filter(F.col("s6")))
    # 7. Filings related to any first filing so far.
    stage7 = under(_pairs(reg.tech_rel, "tech_rel_appln_id", "appln_id"), flags.filter(F.col("first")))
    # 8. Families of one, if not yet a member.
    left = flags.filter(F.col("pub") & F.col("single") & ~F.col("member") & ~F.col("s6")).select("appln_id")
    stage8 = itself(left.join(stage7.select("appln_id").distinct(), "appln_id", "left_anti"))

    out = typed(claims, BRIDGE_PRIORITY)
    for stage, type_ in (
        (stage2, BRIDGE_PCT), (stage3, BRIDGE_PCT), (stage4, BRIDGE_CONTINUAL), (stage5, BRIDGE_CONTINUAL),
        (stage6, BRIDGE_TECH_REL), (stage7, BRIDGE_TECH_REL), (stage8, BRIDGE_SINGLE),
    ):
        out = out.unionByName(typed(stage, type_))
    return out


def bridge(reg: Register) -> DataFrame:
    """The bridge table without ``lastupdate``: prior_appln_id, every publication
    column of the member, the member's application columns, type."""
    pairs, publn, appln = bridge_pairs(reg), reg.publn, reg.appln.select("appln_id", *APPLN_COLUMNS)
    publn_cols = publn.columns
    if worth_thinning(publn):  # only members' publications and applications leave the scans
        pairs = cut_lineage(pairs)
        members = cut_lineage(pairs.select("appln_id").distinct())
        publn, appln = existing(publn, "appln_id", members), existing(appln, "appln_id", members)
    return (
        pairs.join(publn, "appln_id")
        .join(appln, "appln_id")
        .select("prior_appln_id", *publn_cols, *APPLN_COLUMNS, "type")
    )
