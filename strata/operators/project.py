"""Column selection, positional slices, feature vectors, row access.

Everything here is a projection or a filter, so Catalyst prunes the scan to
the columns that survive and pushes filters to the reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import as_list
from strata.functions.vectors import assemble


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B1: drop a fixed list of columns (all of them must exist)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def select_except(df: DataFrame, exclude: str | Sequence[str]) -> DataFrame:
    """B2: every column but the excluded ones (e.g. the label)."""
    ex = set(as_list(exclude))
    return df.select(*[c for c in df.columns if c not in ex])


def all_but_last(df: DataFrame) -> DataFrame:
    """Positional feature slice ``[:, :-1]``."""
    return df.select(*df.columns[:-1])


def columns_from(df: DataFrame, start: int) -> DataFrame:
    """Positional slice ``[:, start:]``."""
    return df.select(*df.columns[start:])


def label_column(df: DataFrame, label: str) -> Column:
    """The label column by name (never by position, see Q1)."""
    if label not in df.columns:
        raise KeyError(label)
    return F.col(label)


def skip_first(df: DataFrame, order_by: str, n: int = 1) -> DataFrame:
    """Drop the first ``n`` rows in ``order_by`` order (a unique key).

    The cut is found with a bounded top-n (each task keeps n rows), then
    the table is filtered: no sort of the data."""
    if n <= 0:
        return df
    top = df.select(order_by).orderBy(order_by).limit(n).agg(F.max(order_by).alias("m"))
    cut = top.collect()[0]["m"]
    if cut is None:
        return df
    return df.filter(F.col(order_by) > F.lit(cut))


def cast_features(df: DataFrame, cols: Sequence[str], dtype: str = "float") -> DataFrame:
    """Cast feature columns (ANSI mode: bad strings raise, as the
    reference's ``astype`` does)."""
    return df.withColumns({c: F.col(c).cast(dtype) for c in cols})


def concat_columns(df: DataFrame, features: Sequence[str], label: str | Sequence[str]) -> DataFrame:
    """Feature columns and label columns side by side.  Both come from the
    same rows, so this is a projection: no join and no positional zip."""
    return df.select(*features, *as_list(label))


def overwrite(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Replace a subset of columns in place."""
    return df.withColumns(exprs)


def assemble_features(df: DataFrame, cols: Sequence[str], out_col: str = "features",
                      keep: Sequence[str] = (), dtype: str = "double") -> DataFrame:
    """Dense ``array<double>`` feature vector plus the kept columns."""
    return df.select(*keep, assemble(cols, dtype).alias(out_col))


def feature_columns(df: DataFrame, label: str, key: str | Sequence[str] = ()) -> list[str]:
    """Feature column names: everything but label and key, by name (fixes Q1)."""
    ex = {label, *as_list(key)}
    return [c for c in df.columns if c not in ex]


def dataset_length(df: DataFrame) -> int:
    """``len(dataset)``."""
    return df.count()


def fetch_rows(df: DataFrame, pos_col: str, positions: Sequence[int] | DataFrame) -> DataFrame:
    """Rows at given 0-based positions (``pos_col`` from E0/E3).
    ``request`` is the place in the request; a position asked for twice comes twice.

    ``positions`` is a short list, or a table ``(request, <pos_col>)`` of any
    size: both are joined, so Spark broadcasts what is small and shuffles what is not."""
    if not isinstance(positions, DataFrame):
        positions = df.sparkSession.createDataFrame(
            [(i, int(p)) for i, p in enumerate(positions)], f"request long, {pos_col} long")
    return df.join(positions.select("request", pos_col), pos_col)
