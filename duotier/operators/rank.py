"""Exact row numbers without pulling a group into one task.

`hash_rank` numbers the rows of a group by a hash of their key.  A window over
the group would send all of it to one task; here rows are windowed within
(group, first digits of the hash), and the sizes of those parts are summed up in
a table of at most groups x 16**digits rows.  The same steps run at every size.

`dense_codes` numbers distinct values in their order: Spark's own global sort and
`zipWithIndex`, so no task holds more than its range of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_H, _P, _POS, _CNT, _OFF = "_rk_h", "_rk_p", "_rk_pos", "_rk_cnt", "_rk_off"


def hash_rank(
    df: DataFrame, by: str, digest: Column, tie: Column, rn: str = "rn", group_size: str = "group_size", digits: int = 3
) -> DataFrame:
    """Add `rn`, the 1-based place of each row in its group by (digest, tie), and the group's size.

    `digest` is text in hexadecimal digits, spread evenly; a group's rows are dealt to 16**digits parts."""
    tagged = df.withColumn(_H, digest).withColumn(_P, F.substring(_H, 1, digits))
    inside = Window.partitionBy(by, _P).orderBy(_H, tie)
    tagged = tagged.withColumn(_POS, F.row_number().over(inside))
    counts = tagged.groupBy(by, _P).agg(F.count(F.lit(1)).alias(_CNT))
    before = Window.partitionBy(by).orderBy(_P)
    counts = counts.select(
        F.col(by).alias("_rk_by"), F.col(_P).alias("_rk_part"),
        (F.sum(_CNT).over(before) - F.col(_CNT)).alias(_OFF),
        F.sum(_CNT).over(Window.partitionBy(by)).alias(group_size),
    )
    same = F.col(by).eqNullSafe(F.col("_rk_by")) & (F.col(_P) == F.col("_rk_part"))
    return (
        tagged.join(counts, same)
        .withColumn(rn, F.col(_OFF) + F.col(_POS))
        .drop(_H, _P, _POS, _OFF, "_rk_by", "_rk_part")
    )


def dense_codes(df: DataFrame, col: str, rank_col: str) -> DataFrame:
    """Distinct values of `col` with their 1-based rank in ascending order."""
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)
    schema = T.StructType([distinct.schema[col], T.StructField(rank_col, T.LongType(), False)])
    return df.sparkSession.createDataFrame(distinct.rdd.zipWithIndex().map(lambda x: (x[0][0], x[1] + 1)), schema)
