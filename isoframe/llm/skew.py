"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is common if it holds more than one row in SHARES, and more than FEW.
#: Fewer than SHARES keys can be.
SHARES, FEW = 1000, 1000


def dealt_join(rows: DataFrame, others: DataFrame, keys: list[str], how: str = "inner", counted: DataFrame | None = None) -> DataFrame:
    """``rows`` joined to ``others``, with the rows of common keys dealt out.

    A common key's rows go to as many parts as it has shares of a thousandth of
    all rows, and the few rows that ``others`` has for it to each part, so no
    task needs more than about a thousandth of the rows for one key.  The part
    of a row follows from its values, so a retry deals it alike.  ``rows`` is
    read more than once and should be cheap to read; ``others`` has few rows a
    key.  Rows with a null key meet nothing.  ``how`` is inner or left_semi.
    ``counted`` is a cheaper table with the keys of ``rows``, to be counted for it.
    """
    counted = rows if counted is None else counted
    counts = counted.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > FEW)
    # Those that may be common; with the threshold below, fewer than SHARES.
    found = counts.orderBy(F.desc("n_rows")).limit(SHARES)
    largest = found.collect()
    if not largest:
        return rows.join(others, keys, how)
    total = counted.count()
    common = [(*(r[k] for k in keys), -(-r["n_rows"] * SHARES // total)) for r in largest if r["n_rows"] * SHARES > total]
    schema = ", ".join([*(f"`{k}` {found.schema[k].dataType.simpleString()}" for k in keys), "parts long"])
    parts = F.broadcast(rows.sparkSession.createDataFrame(common, schema))
    values = list(rows.columns)
    deal = F.pmod(F.xxhash64(*values), F.coalesce("parts", F.lit(1))).cast("long").alias("part")
    a = rows.join(parts, keys, "left").select(*values, deal)
    b = others.join(parts, keys, "left").select(*others.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    return a.join(b, [*keys, "part"], how).drop("part")
