"""Test adapter: derive register and location tables from the driver's star schema.

The driver supplies TPC-H-like tables and no patent tables, so the rows are
derived column by column as specified in FIXTURES.md.  The same expressions are
written as DuckDB SQL in ``filingfold.oracles.adapter_sql``; both must change
together.  Everything here is plain DataFrame expressions, so the adapter scales
with the star tables.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import schemas as S
from .register import LocationInputs, Register

# FIXED VALUES: office of a customer or supplier, indexed by its 0-based nation key.
FIXTURE_OFFICES = (
    "AL", "AT", "AU", "BE", "BR", "CA", "CH", "CN", "DE", "EP", "FR", "GB", "IB",
    "IN", "IT", "JP", "KR", "MX", "NL", "SE", "SM", "US", "TW", "XX", "LI",
)
# FIXED VALUES: data_source of a part address by p_partkey % 5.
FIXTURE_PART_SOURCES = ("PCT", "EU", "JP", "KR", "CN")
LOCATION_OFFSET_CUSTOMER = 1_000_000
LOCATION_OFFSET_PART = 2_000_000
FAMILY_OFFSET = 100_000_000


def _office(nation_key) -> F.Column:
    return F.try_element_at(F.array(*[F.lit(c) for c in FIXTURE_OFFICES]), (nation_key + 1).cast("int"))


def _star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _publications(appln: DataFrame) -> DataFrame:
    """tls211, derived from tls201."""
    pk = F.col("appln_id")
    both = F.when(pk % 4 == 2, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    publn = appln.filter(pk % 31 != 0).select("appln_id", "appln_auth", F.explode(both).alias("n")).select(
        (pk * 10 + F.col("n")).alias("pat_publn_id"),
        F.col("appln_auth").alias("publn_auth"),
        F.when(pk % 29 == 0, F.lit(None).cast("string")).otherwise(pk.cast("string")).alias("publn_nr"),
        F.when(F.col("n") == 2, F.lit("B1"))
        .when(pk % 19 == 0, F.lit("D2"))
        .when((F.col("appln_auth") == "US") & (pk % 3 == 0), F.lit("P1"))
        .when(F.col("appln_auth").isin("AU", "FR") & (pk % 3 == 0), F.lit("A3"))
        .otherwise(F.lit("A1"))
        .alias("publn_kind"),
        pk.alias("appln_id"),
    )
    return _cast_to(publn, S.TLS211_PAT_PUBLN)


def register_from_star(spark: SparkSession, sf_dir: str) -> Register:
    orders = _star(spark, sf_dir, "orders")
    customer = _star(spark, sf_dir, "customer")
    supplier = _star(spark, sf_dir, "supplier")
    lineitem = _star(spark, sf_dir, "lineitem")

    k = F.col("o_orderkey") + 1
    off = _office(F.col("c_nationkey"))
    filing_date = F.when(k % 97 == 0, F.lit(None).cast("date")).otherwise(F.to_date("o_orderdate"))
    appln = (
        orders.join(customer.select("c_custkey", "c_nationkey"), orders.o_custkey == customer.c_custkey, "left")
        .select(
            k.alias("appln_id"),
            F.when(k % 6 == 0, F.lit("WO")).otherwise(off).alias("appln_auth"),
            F.when(k % 6 == 0, F.lit("W"))
            .when(k % 17 == 0, F.lit("U"))
            .when(k % 101 == 0, F.lit(None).cast("string"))
            .otherwise(F.lit("A"))
            .alias("appln_kind"),
            F.when(k % 6 == 0, off).otherwise(F.lit("")).alias("receiving_office"),
            F.when((k % 12 == 1) & (k > 12), k - 1)
            .when((k % 12 == 2) & (k > 12), k - 2)
            .otherwise(F.lit(0).cast("long"))
            .alias("internat_appln_id"),
            F.when((k % 30 == 0) | ((k > 12) & ((k % 12 == 2) | (k % 24 == 1))), F.lit("Y"))
            .otherwise(F.lit("N"))
            .alias("nat_phase"),
            F.when((k % 12 == 1) & (k > 12), F.lit("Y")).otherwise(F.lit("N")).alias("reg_phase"),
            F.when(k % 5 == 0, F.greatest(k - 7, F.lit(1).cast("long"))).otherwise(k).alias("earliest_filing_id"),
            F.when(k % 4 == 0, k).otherwise(F.lit(FAMILY_OFFSET) + (k - k % 4)).alias("docdb_family_id"),
            (k - k % 10).alias("inpadoc_family_id"),
            filing_date.alias("appln_filing_date"),
            F.when(k % 50 == 0, F.lit(2016))
            .when(k % 50 == 1, F.lit(1979))
            .otherwise(F.year(F.to_date("o_orderdate")))
            .alias("appln_filing_year"),
            filing_date.alias("earliest_publn_date"),
            F.year(filing_date).alias("earliest_publn_year"),
            (k * 10 + 1).alias("earliest_pat_publn_id"),
            F.when(F.col("o_orderstatus") == "F", F.lit("Y")).otherwise(F.lit("N")).alias("granted"),
        )
    )
    appln = _cast_to(appln, S.TLS201_APPLN)

    a = F.col("l_orderkey") + 1
    prior = (
        lineitem.filter(F.col("l_returnflag") == "R")
        .select(a.alias("appln_id"), (F.col("l_partkey") + 1).alias("prior_appln_id"))
        .filter(F.col("appln_id") != F.col("prior_appln_id"))
        .distinct()
        .withColumn(
            "prior_appln_seq_nr",
            F.row_number().over(Window.partitionBy("appln_id").orderBy("prior_appln_id")),
        )
    )
    prior = _cast_to(prior, S.TLS204_APPLN_PRIOR)

    def _link(flag: str, step: int, other: str) -> DataFrame:
        # Every line of the flag links to an earlier filing, or to a later one where
        # there is no earlier; targets are gathered on one in 2 * step filings, and no
        # filing links to itself.
        far = (F.col("l_suppkey") + 1) * step + F.col("l_linenumber")
        at = F.when(a > far, a - far).otherwise(a + far)
        target = at - at % (2 * step) + 1
        return (
            lineitem.filter(F.col("l_returnflag") == flag)
            .select(a.alias("appln_id"), (target + F.when(target == a, 2 * step).otherwise(0)).alias(other))
            .distinct()
        )

    contn = _cast_to(_link("A", 3, "parent_appln_id"), S.TLS216_APPLN_CONTN)
    tech_rel = _cast_to(_link("N", 5, "tech_rel_appln_id"), S.TLS205_TECH_REL)

    pers_appln = (
        lineitem.select(
            (F.col("l_suppkey") + 1).alias("person_id"),
            a.alias("appln_id"),
            F.when(F.col("l_linenumber") == 1, F.lit(2)).otherwise(F.lit(0)).alias("applt_seq_nr"),
            F.col("l_linenumber").alias("invt_seq_nr"),
        )
        .distinct()
        .unionByName(
            orders.select(
                (F.lit(LOCATION_OFFSET_CUSTOMER) + F.col("o_custkey")).alias("person_id"),
                k.alias("appln_id"),
                F.lit(1).alias("applt_seq_nr"),
                F.lit(0).alias("invt_seq_nr"),
            )
        )
    )
    pers_appln = _cast_to(pers_appln, S.TLS207_PERS_APPLN)

    person = supplier.select(
        (F.col("s_suppkey") + 1).alias("person_id"),
        F.when(F.col("s_suppkey") % 4 == 1, _office(F.col("s_nationkey")))
        .when(F.col("s_suppkey") % 4 == 2, F.lit(None).cast("string"))
        .otherwise(F.lit(""))
        .alias("person_ctry_code"),
    ).unionByName(
        customer.select(
            (F.lit(LOCATION_OFFSET_CUSTOMER) + F.col("c_custkey")).alias("person_id"),
            F.when(F.col("c_custkey") % 3 == 1, _office(F.col("c_nationkey")))
            .when(F.col("c_custkey") % 3 == 2, F.lit(None).cast("string"))
            .otherwise(F.lit(""))
            .alias("person_ctry_code"),
        )
    )
    person = _cast_to(person, S.TLS206_PERSON)

    return Register(
        appln=appln, prior=prior, tech_rel=tech_rel, person=person,
        pers_appln=pers_appln, publn=_publications(appln), contn=contn,
    )


def _coord(loc_id: F.Column, mult: int, mod: int, shift: int) -> F.Column:
    return F.when(loc_id % 3 == 0, F.lit(None).cast("double")).otherwise(
        ((loc_id * mult) % mod - shift).cast("double") + F.lit(0.25)
    )


def locations_from_star(spark: SparkSession, sf_dir: str) -> LocationInputs:
    customer = _star(spark, sf_dir, "customer")
    supplier = _star(spark, sf_dir, "supplier")
    part = _star(spark, sf_dir, "part")
    lineitem = _star(spark, sf_dir, "lineitem")
    nation = _star(spark, sf_dir, "nation")
    region = _star(spark, sf_dir, "region")

    def _person_source(key: str) -> F.Column:
        return F.when(F.col(key) % 2 == 0, F.lit("USPTO")).otherwise(F.lit("PATSTATREGPAT"))

    raw = (
        supplier.select((F.col("s_suppkey") + 1).alias("location_id"), _person_source("s_suppkey").alias("data_source"))
        .unionByName(
            customer.select(
                (F.lit(LOCATION_OFFSET_CUSTOMER) + F.col("c_custkey")).alias("location_id"),
                _person_source("c_custkey").alias("data_source"),
            )
        )
        .unionByName(
            part.select(
                (F.lit(LOCATION_OFFSET_PART) + F.col("p_partkey")).alias("location_id"),
                F.element_at(
                    F.array(*[F.lit(s) for s in FIXTURE_PART_SOURCES]), (F.col("p_partkey") % 5 + 1).cast("int")
                ).alias("data_source"),
            )
        )
    )
    lid = F.col("location_id")
    lat = _coord(lid, 37, 170, 85)
    lng = _coord(lid, 73, 360, 180)
    addresses = raw.select(
        lid,
        F.concat(F.lit("addr_"), lid.cast("string")).alias("unformattedaddress"),
        "data_source",
        lat.alias("lat"),
        lng.alias("lng"),
        lat.alias("lat_exact"),
        lng.alias("lng_exact"),
        F.when(lid % 2 == 0, F.lit("API")).otherwise(F.lit("GEONAMES")).alias("coord_source"),
    )
    addresses = _cast_to(addresses, S.ADDRESSES)

    person_location = (
        supplier.filter(F.col("s_suppkey") % 4 == 1)
        .select((F.col("s_suppkey") + 1).alias("person_id"))
        .unionByName(
            customer.filter(F.col("c_custkey") % 3 == 1).select(
                (F.lit(LOCATION_OFFSET_CUSTOMER) + F.col("c_custkey")).alias("person_id")
            )
        )
        .withColumn("location_id", F.col("person_id"))
    )
    person_location = _cast_to(person_location, S.PERSON_LOCATION)

    a = F.col("l_orderkey") + 1
    pct_part = F.when(F.col("l_linenumber") % 2 == 1, F.col("l_partkey") - F.col("l_partkey") % 5).otherwise(
        F.col("l_partkey")
    )
    addresses_pct = (
        lineitem.filter(F.col("l_returnflag") == "N")
        .select(
            (a - F.col("l_orderkey") % 3).alias("appln_id"),  # gathered on one filing in three
            F.concat(F.lit("addr_"), (F.lit(LOCATION_OFFSET_PART) + pct_part).cast("string")).alias("address_text"),
            (F.col("l_suppkey") % 8 + 1).alias("relation_type_id"),
        )
        .distinct()
    )
    addresses_pct = _cast_to(addresses_pct, S.ADDRESSES_PCT)

    def _appln_location(rem: int) -> DataFrame:
        df = (
            lineitem.filter(F.col("l_partkey") % 5 == rem)
            .select(
                (a - F.col("l_orderkey") % 6).alias("appln_id"),  # gathered on one filing in six
                (F.lit(LOCATION_OFFSET_PART) + F.col("l_partkey")).alias("location_id"),
                F.when(F.col("l_suppkey") % 2 == 0, F.lit("INV")).otherwise(F.lit("APP")).alias("app_inv"),
            )
            .distinct()
        )
        return _cast_to(df, S.APPLN_LOCATION)

    i = F.col("n_nationkey")
    x0 = (F.lit(-125) + (i % 5) * 50).cast("double")
    y0 = (F.lit(-75) + (i - i % 5) * 6).cast("double")

    def _pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    ring = F.array(_pt(x0, y0), _pt(x0 + 50, y0), _pt(x0 + 50, y0 + 30), _pt(x0, y0 + 30), _pt(x0, y0))
    null = F.lit(None).cast("string")
    admin = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        i.cast("long").alias("gid"),
        F.col("n_name").alias("name_0"),
        F.col("r_name").alias("name_1"),
        null.alias("name_2"), null.alias("name_3"), null.alias("name_4"), null.alias("name_5"),
        F.lit("Region").alias("engtype_1"),
        null.alias("engtype_2"), null.alias("engtype_3"), null.alias("engtype_4"), null.alias("engtype_5"),
        F.array(ring).alias("rings"),
    )
    admin = _cast_to(admin, S.ADMIN_LEVELS)

    return LocationInputs(
        addresses=addresses,
        admin_levels=admin,
        person_location=person_location,
        addresses_pct=addresses_pct,
        appln_location_eu=_appln_location(1),
        appln_location_jp=_appln_location(2),
        appln_location_kr=_appln_location(3),
        appln_location_cn=_appln_location(4),
    )


def _cast_to(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


# Bump when any expression above changes, so stale materialised fixtures are not reused.
FIXTURE_VERSION = "4"
STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _fs_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def star_state(spark: SparkSession, sf_dir: str) -> str:
    """Names, lengths and modification times of the star tables' files: other data
    under the same path is another state."""
    seen = []
    for name in STAR_TABLES:
        fs, p = _file_system(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
        seen += sorted((str(s.getPath()), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p))
    return repr(seen)


def fixture_root(spark: SparkSession, sf_dir: str, state: str) -> str:
    """Folder for the derived tables: under the session's checkpoint folder (shared on
    a cluster), keyed by the state of the star tables and the adapter version."""
    import hashlib

    from ..session import ensure_checkpoint_dir

    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    key = hashlib.sha1(f"{sf_dir.rstrip('/')}|{state}|{FIXTURE_VERSION}".encode()).hexdigest()[:16]
    return f"{base.rstrip('/')}/filingfold-fixtures/{key}"


#: Folder of each table, by its field in ``Register`` or ``LocationInputs``, in the order of writing.
FIXTURE_TABLES = {
    "appln": "tls201_appln",
    "prior": "tls204_appln_prior",
    "tech_rel": "tls205_tech_rel",
    "person": "tls206_person",
    "pers_appln": "tls207_pers_appln",
    "publn": "tls211_pat_publn",
    "contn": "tls216_appln_contn",
    "addresses": "addresses_coordinates_all",
    "admin_levels": "admin_levels",
    "person_location": "person_location_id",
    "addresses_pct": "addresses_pct",
    "appln_location_eu": "inventor_applicant_location_id",
    "appln_location_jp": "inventor_applicant_location_id_jp",
    "appln_location_kr": "inventor_applicant_location_id_kr",
    "appln_location_cn": "inventor_applicant_location_id_cn",
}
_SCHEMAS = S.REGISTER_TABLES | S.LOCATION_TABLES


def _written(spark: SparkSession, root: str, name: str, table: DataFrame) -> DataFrame:
    """Write a derived table as parquet below ``root`` once per state of the inputs; later
    calls reuse it.  It is written to a folder of this call and renamed as a whole, so
    sessions never share a half-written one."""
    import uuid

    path = f"{root}/{name}"
    if not _fs_exists(spark, path):
        own = f"{root}-{uuid.uuid4().hex}/_{name}"  # hidden, should it land inside another session's
        table.write.parquet(own)
        fs, target = _file_system(spark, path)
        fs.mkdirs(target.getParent())
        if not fs.exists(target):  # else another session was first
            fs.rename(_file_system(spark, own)[1], target)
    return spark.read.schema(_SCHEMAS[name]).parquet(path)


# Inputs and the tables written so far, per (Spark application, folder, state of the inputs).
# DataFrames are immutable plans, so sharing them between queries of one session is safe.
_INPUTS: dict[tuple[str, str, str], tuple[Register, LocationInputs, frozenset[str]]] = {}


def fixture_inputs(spark: SparkSession, sf_dir: str, stored: tuple[str, ...] = tuple(FIXTURE_TABLES)) -> tuple[Register, LocationInputs]:
    """Register and location inputs derived from the star schema at ``sf_dir``.

    ``stored``: the tables (fields of either class) that the caller reads more than once;
    these are written first and are scans of stored files.  Every other table is its
    derivation, computed where it is read, unless it has been written before."""
    state = star_state(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, state)
    reg, loc, done = _INPUTS.get(key) or (register_from_star(spark, sf_dir), locations_from_star(spark, sf_dir), frozenset())
    root = fixture_root(spark, sf_dir, state)
    for field, name in FIXTURE_TABLES.items():
        if field not in stored or field in done:
            continue
        owner = reg if hasattr(reg, field) else loc
        table = _written(spark, root, name, getattr(owner, field))
        if owner is loc:
            loc = replace(loc, **{field: table})
        else:
            reg = replace(reg, **{field: table})
        done |= {field}
        if field == "appln" and "publn" not in done:
            reg = replace(reg, publn=_publications(reg.appln))
    _INPUTS[key] = (reg, loc, done)
    return reg, loc
