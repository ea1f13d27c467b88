"""Semi-join reduction by a bitmap of fixed size."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap: sixteen for each wanted id, and 2^27 (16 megabytes) at most, whatever the data.
FEWEST, MOST = 20, 27


def keep_ids(df: DataFrame, id_col: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose id may be in ``wanted`` (one column of longs, each once): all that are, and few others, dropped before
    they are shuffled for the join that follows. The bitmap is built by aggregation; with n ids it lets a share of
    1 - exp(-n / bits) of the other rows through: a sixteenth up to eight million ids, then slowly more."""
    spark = df.sparkSession
    name = wanted.columns[0]
    bits = min(MOST, max(FEWEST, int(wanted.count() * 16).bit_length()))
    spot = F.pmod(F.xxhash64(F.col(name)), F.lit(1 << bits))
    rows = wanted.select(F.shiftright(spot, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64({name}), 64) as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas()
    table = np.zeros(1 << (bits - 6), dtype=np.int64)
    table[rows["word"].to_numpy(dtype=np.int64)] = rows["bit"].to_numpy(dtype=np.int64)
    shared = spark.sparkContext.broadcast(table.view(np.uint64))

    @F.pandas_udf("boolean")
    def may_be(spot: pd.Series) -> pd.Series:
        s = spot.to_numpy(dtype=np.int64)
        return pd.Series((shared.value[s >> 6] >> (s & 63).astype(np.uint64)) & np.uint64(1) == 1)

    return df.where(may_be(F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(1 << bits))))
