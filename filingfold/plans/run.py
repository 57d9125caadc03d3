"""End-to-end run: every result table of the reference from a register snapshot.

    python -m filingfold.plans.run REGISTER_DIR LOCATIONS_DIR OUT_DIR [--lay-out]

reads the register (``tls201_appln/`` ... ``tls216_appln_contn/``) and the location
inputs as parquet, and writes, under OUT_DIR:

* ``geoc_inv/``, ``geoc_app/``                   location of inventors / applicants
* ``pf_inv_pers_ctry_all/``, ``pf_app_pers_ctry_all/``  country of inventors / applicants
* ``family_bridge/``              the family bridge
* ``ctry_inv_person_csv/``, ``ctry_app_person_csv/``  the two ordered CSV exports

Parquet outputs keep geometry as ``struct<x,y>``; the country tables and the bridge
carry ``lastupdate``.  Pass ``LOCATIONS_DIR = -`` to skip the location tables.
``--lay-out`` first writes the register in buckets by application (``sources.layout``),
which pays where several result tables are made of a large register.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from ..config import COUNTRY_APP, COUNTRY_INV, LOCATION_APP, LOCATION_INV
from ..session import RECOMMENDED_CONF
from ..sources.layout import lay_out
from ..sources.register import LocationInputs, Register, read_locations, read_register
from ..sources.sinks import export_csv
from .bridge import build_bridge
from .country import impute_country
from .location import impute_location


def run(spark: SparkSession, reg: Register, loc: LocationInputs | None, out: str) -> dict[str, str]:
    """Write every result table under ``out``; returns name -> path."""
    out = out.rstrip("/")
    written: dict[str, str] = {}

    def save(name: str, df) -> None:
        path = f"{out}/{name}"
        df.write.mode("overwrite").parquet(path)
        written[name] = path

    for name, cfg in (("pf_inv_pers_ctry_all", COUNTRY_INV), ("pf_app_pers_ctry_all", COUNTRY_APP)):
        save(name, impute_country(reg, cfg))
        # The export reads the written table back, so the waterfall runs once.
        table = spark.read.parquet(written[name])
        csv = f"{out}/ctry_{name[3:6]}_person_csv"
        export_csv(table, csv, stored=True)
        written[f"ctry_{name[3:6]}_person_csv"] = csv
    if loc is not None:
        for name, cfg in (("geoc_inv", LOCATION_INV), ("geoc_app", LOCATION_APP)):
            save(name, impute_location(reg, loc, cfg))
    save("family_bridge", build_bridge(reg))
    return written


def main(argv: list[str]) -> int:
    laid_out = "--lay-out" in argv
    argv = [a for a in argv if a != "--lay-out"]
    if len(argv) != 4:
        print(__doc__)
        return 2
    builder = SparkSession.builder
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    reg = read_register(spark, argv[1])
    reg = lay_out(reg) if laid_out else reg
    loc = None if argv[2] == "-" else read_locations(spark, argv[2])
    for name, path in run(spark, reg, loc, argv[3]).items():
        print(name, path)
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
