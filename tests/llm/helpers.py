"""Small inputs shared by the operator tests."""

from pyspark.sql import functions as F

LONG = "Und der die das. " * 20_000


def documents(spark, rows, lang=None):
    """Documents with extra columns whose names clash with what operators add."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, score double, label string, fp long, salt int, length int"
    return spark.createDataFrame([(i, t, lang, None, None, -1.0, "x", 7, 3, 9) for i, t in rows], kind)


ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "...!!!"), (5, LONG), (6, "Same text here."), (6, "Same text here."), (7, "Same text here."), (None, "no id"), (8, "日本 ÉÈ ß   x")]


def odd(spark):
    return documents(spark, ODD)


def empty(spark):
    return documents(spark, [])


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def labelled(spark, sf):
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    return read("documents"), read("labels")


def held_out(df, folds, held):
    return df.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held)
