"""C13 export: ordered CSV with one header, empty string for NULL, UTF-8.

The reference streams the whole table through one client connection to one file.
Here the sort is a range-partitioned ``orderBy`` and every task writes its own part,
without a header; the header is one small file that sorts before the parts.  The
files of the directory, concatenated in name order, are the reference's file; nothing
passes through the driver.

Rows are ordered by the export's key and then by all other columns, so equal tables give
equal bytes, and ranges may cut between the rows of one key: an application with very
many persons is spread over several parts.  Spark chooses the ranges by running its input
once more; the input is therefore written first and the ranges come from a scan of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import cut_lineage

OPTIONS = {
    "nullValue": "",
    "emptyValue": '""',
    "escape": '"',
    "encoding": "UTF-8",
    "sep": ",",
    # PostgreSQL keeps surrounding whitespace and writes timestamps as
    # "yyyy-MM-dd HH:mm:ss.ffffff"; Spark's writer trims and uses ISO-8601.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
}
#: Sorts before "part-...", and is not hidden from other readers as "_..." would be.
HEADER = "header.csv"


def export_csv(df: DataFrame, path: str, order_by: str = "appln_id", mode: str = "overwrite", stored: bool = False) -> None:
    """Write ``df`` below ``path``.  ``stored``: it is a table already, and not written first."""
    rows = df if stored else cut_lineage(df)
    rows.orderBy(order_by, *[c for c in df.columns if c != order_by]).write.mode(mode).options(**OPTIONS).csv(path)
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(f"{path.rstrip('/')}/{HEADER}")
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write((",".join(df.columns) + "\n").encode("utf-8"))
    out.close()


def read_export(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """An exported directory as a table (its parts; the header is not data).  The null
    mark differs from "", so that a quoted empty string stays one."""
    options = OPTIONS | {"emptyValue": "", "nullValue": "\\N"}
    return spark.read.schema(schema).options(**options).csv(f"{path.rstrip('/')}/part-*")
