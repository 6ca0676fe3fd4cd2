"""Delimited files (SRC-1 ... SRC-3, SNK-7).

``;``-separated with a header and ``"`` quotes.  Spark reads an unquoted empty
field as NULL and a quoted ``""`` as ''.  The district file marks missing
values with ``?``; for the other tables the null token is set to a character
that cannot occur, so '' and NULL stay two values (the transaction table's
``k_symbol`` needs that).  Writing uses the defaults: NULL as an unquoted empty
field, '' as ``""``, so a write/read round trip keeps both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import scratch_path

# File options of the source extracts.
SEPARATOR = ";"
QUOTE = '"'
UNUSED_NULL_TOKEN = "\u0000"
NULL_TOKEN = {"district": "?"}

# File layouts (column order as in the files).
FILE_LAYOUTS = {
    "district": [f.name for f in schemas.DISTRICT.fields],
    "account": [f.name for f in schemas.ACCOUNT.fields],
    "client": [f.name for f in schemas.CLIENT.fields],
    "disposition": ["disp_id", "client_id", "account_id", "type"],
    "trans": ["trans_id", "account_id", "date", "type", "operation", "amount", "balance",
              "k_symbol", "bank", "account"],
    "trans_loadtest": schemas.TRANS_LOADTEST_LAYOUT,
}
BASE_SCHEMA = {
    "district": schemas.DISTRICT, "account": schemas.ACCOUNT, "client": schemas.CLIENT,
    "disposition": schemas.DISPOSITION, "trans": schemas.TRANS, "trans_loadtest": schemas.TRANS,
}
CANONICAL = {k: [f.name for f in v.fields] for k, v in BASE_SCHEMA.items()}


def read_delimited(spark: SparkSession, path: str, table: str,
                   schema: T.StructType | None = None) -> DataFrame:
    """SRC-1/SRC-2: read with an explicit schema bound by position, then put the
    columns into the table's canonical order."""
    layout = FILE_LAYOUTS[table]
    sch = schema or schemas.layout_schema(layout, BASE_SCHEMA[table])
    df = (spark.read.schema(sch)
          .option("sep", SEPARATOR).option("header", "true").option("quote", QUOTE)
          .option("escape", QUOTE)
          .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
          .option("nullValue", NULL_TOKEN.get(table, UNUSED_NULL_TOKEN))
          .option("mode", "FAILFAST")
          .csv(path))
    return df.select(*CANONICAL[table])


REJECTED = "__line"


def read_with_rejects(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """SRC-3: the rows of a file that may hold broken lines, and the broken lines by themselves.

    A line is broken if it has another number of fields than the layout or a field that isn't of its
    column's type.  All columns are parsed whatever is asked of the result (a pruned scan would find fewer
    broken lines), so store what is used more than once.
    """
    layout = schemas.layout_schema(FILE_LAYOUTS[table], BASE_SCHEMA[table])
    marked = T.StructType([*layout.fields, T.StructField(REJECTED, T.StringType(), True)])
    lines = (spark.read.schema(marked)
             .option("sep", SEPARATOR).option("header", "true").option("quote", QUOTE).option("escape", QUOTE)
             .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
             .option("nullValue", NULL_TOKEN.get(table, UNUSED_NULL_TOKEN))
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED).option("columnPruning", "false")
             .csv(path))
    kept = scratch_path(spark, "parsed-lines")
    lines.write.parquet(kept)
    lines = spark.read.schema(marked).parquet(kept)
    return (lines.where(F.col(REJECTED).isNull()).select(*CANONICAL[table]),
            lines.where(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("line")))


def write_delimited(df: DataFrame, path: str, table: str, mode: str = "overwrite") -> None:
    """SNK-7: write in the table's file layout (a directory of part files)."""
    (df.select(*FILE_LAYOUTS[table]).write.mode(mode)
     .option("sep", SEPARATOR).option("header", "true").option("quote", QUOTE)
     .option("escape", QUOTE)
     # Writers trim blanks by default; a one-space k_symbol must survive.
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
