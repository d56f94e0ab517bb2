"""Row numbers of tables without a key: the order of the source itself.

A scan knows where each row lies: its file, and its place within the file.  That
address is unique, never null, and the same at every rerun, task count and split size, so
``numbered`` turns it into a row number (0, 1, ... in the order of file paths and of
the rows in each file) that serves as the key of every operator that needs one:
exact splits, skipping rows, epoch orders, batches, shards.

* Parquet scans give the row's place in its file (``_metadata.row_index``), so the
  number is a projection over the scan plus one offset a file.
* Other formats (CSV, JSON, text) only know the block that a task reads
  (``_metadata.file_block_start``).  Such a table is parsed once and written with
  its block and a counter of its task; the place within the block is the counter
  minus the block's least one.  Blocks may be cut anywhere, rows keep their order, so the
  number does not depend on the cut.

Offsets are prefix sums over one count a file (or block), and that table is broadcast: by a
shuffle on the file all rows of one file would meet in one task.  An empty table has
no rows to number; a table that is no scan of files has no order and raises.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize

FILE, BLOCK, PLACE = "__file", "__block", "__place"
BLOCK_MESSAGE = "the table's files changed while their rows were counted"


def _metadata_fields(df: DataFrame) -> set[str]:
    """Fields of the scan's hidden column; raises for what is no scan of files."""
    try:
        return set(df.select("_metadata").schema["_metadata"].dataType.names)
    except AnalysisException as e:
        raise ValueError("only a scan of files (with projections and filters on it) "
                         "has an order of its own") from e


def with_address(df: DataFrame) -> DataFrame:
    """``df`` plus file, block (0 where places count from the file's start) and place."""
    fields = _metadata_fields(df)
    if "row_index" in fields:
        return df.select("*", F.col("_metadata.file_path").alias(FILE), F.lit(0).cast("long").alias(BLOCK),
                         F.col("_metadata.row_index").alias(PLACE))
    if "file_block_start" not in fields:
        raise ValueError("this format tells neither the rows nor the blocks of its files")
    return materialize(df.select("*", F.col("_metadata.file_path").alias(FILE),
                                 F.col("_metadata.file_block_start").alias(BLOCK),
                                 F.monotonically_increasing_id().alias(PLACE)), "addressed")


def offsets(addressed: DataFrame) -> DataFrame:
    """Per file and block: rows before it in the order of the table, and its least place.

    One row a block; the running sum over them is the only ordered window."""
    per = addressed.groupBy(FILE, BLOCK).agg(F.count(F.lit(1)).alias("__n"), F.min(PLACE).alias("__least"))
    before = Window.orderBy(FILE, BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return per.select(F.col(FILE).alias("__ofile"), F.col(BLOCK).alias("__oblock"), "__least",
                      F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))


def numbered(df: DataFrame, col: str = "row") -> DataFrame:
    """``df`` plus ``col``: the row's number in the order of its files (long, from 0).

    ``df`` is a scan, possibly projected.  Filters belong after this call: places
    count the rows of the files, and a filtered scan leaves gaps (they
    stay unique and ordered, but not contiguous for Parquet)."""
    if col in df.columns:
        raise ValueError(f"the table has a column {col!r}")
    at = with_address(df)
    found = at.join(F.broadcast(offsets(at)), (F.col(FILE) == F.col("__ofile")) & (F.col(BLOCK) == F.col("__oblock")), "left")
    number = F.when(F.col("__before").isNull(), F.raise_error(F.lit(BLOCK_MESSAGE)).cast("long")).otherwise(
        F.col("__before") + F.col(PLACE) - F.col("__least"))
    return found.select(*df.columns, number.alias(col))
