from __future__ import annotations

import glob
import os
import tempfile

from pyspark.sql import functions as F

from filingfold.sources.sinks import export_csv, read_export


def test_export_is_sorted_with_postgres_style_nulls(spark):
    df = spark.createDataFrame(
        [(3, None, 'say "hi"'), (1, "", " x "), (2, "DE", None)], "appln_id long, ctry_code string, note string"
    ).withColumn("stamp", F.to_timestamp(F.lit("2020-01-02 03:04:05.123456")))
    out = os.path.join(tempfile.mkdtemp(prefix="filingfold-csv-"), "export")
    export_csv(df, out)
    # Concatenated in name order, the files are one CSV with one header.
    lines = []
    for name in sorted(glob.glob(os.path.join(out, "[!_.]*"))):
        with open(name, encoding="utf-8") as fh:
            lines += fh.read().splitlines()
    stamp = "2020-01-02 03:04:05.123456"
    assert lines == ["appln_id,ctry_code,note,stamp", f'1,"", x ,{stamp}', f"2,DE,,{stamp}", f'3,,"say ""hi""",{stamp}']
    back = read_export(spark, out, df.schema).orderBy("appln_id")
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in df.orderBy("appln_id").collect()]


def test_reruns_are_byte_equal_with_ties(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    # Several persons per application, one application with a third of all rows.
    df = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 40).alias("appln_id"), (F.col("id") % 700).alias("person_id"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.lit("DE")).alias("ctry_code"),
    )
    texts = []
    for n in (1, 7):
        out = os.path.join(tempfile.mkdtemp(prefix="filingfold-csv-"), "export")
        export_csv(df.repartition(n, F.rand(n)), out)
        parts = sorted(glob.glob(os.path.join(out, "[!_.]*")))
        texts.append("".join(open(name, encoding="utf-8").read() for name in parts))
        assert len(parts) > 2
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert texts[0] == texts[1] and texts[0].count("\n") == 3_001
