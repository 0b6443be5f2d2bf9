"""Plain forms of operators, as expectations."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def dense_rank_window(df, group, score, rank="rank"):
    window = Window.partitionBy(group).orderBy(F.col(score).desc_nulls_last())
    return df.withColumn(rank, F.dense_rank().over(window))
