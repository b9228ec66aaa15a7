import datetime as dt

from pyspark.sql import types as T

from courtside import schemas


def elo_rows(spark, rows):
    """raw.elo rows from short tuples:
    (date, team1, team2, score1, score2[, elo1_pre, elo2_pre, prob1, elo1_post, elo2_post, neutral, playoff])
    """
    out = []
    for i, r in enumerate(rows):
        d, t1, t2, s1, s2, *rest = r
        pre1, pre2, p1, post1, post2, neutral, playoff = (rest + [None] * 7)[:7]
        pre1 = 1500.0 if pre1 is None else pre1
        pre2 = 1500.0 if pre2 is None else pre2
        p1 = 0.5 if p1 is None else p1
        post1 = pre1 if post1 is None else post1
        post2 = pre2 - (post1 - pre1) if post2 is None else post2
        out.append((i, dt.date.fromisoformat(d) if d else None, 2000, neutral or 0, playoff or 0,
                    t1, t2, pre1, pre2, p1, 1.0 - p1, post1, post2, s1, s2))
    return spark.createDataFrame(out, schemas.RAW_ELO)


def aliases(spark, rows):
    return spark.createDataFrame(rows, schemas.TEAM_ALIASES)


def one_col(spark, values, name="x", dtype=T.IntegerType()):
    return spark.createDataFrame([(v,) for v in values],
                                 T.StructType([T.StructField(name, dtype)]))
