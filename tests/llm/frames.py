"""Small document tables with every awkward case."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i}" for i in range(60_000))

AWKWARD = [
    (1, "one two three four five six seven", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "one  two\tthree four\nfive six seven", "en", "a", 1),
    (4, "one  two\tthree four\nfive six seven", "en", "a", 1),
    (None, "no id here", "en", None, 1),
    (None, None, None, None, None),
    (5, LONG, "en", "a", 1),
    (6, LONG + " end", "en", "a", 1),
    (7, "   ", "en", "a", 3),
    (8, "Ünï \U0001f600 日本 mail me at a.b@c.de now", "de", "b", 9),
]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


def clashing(spark):
    """The same rows with extra columns named as the operators name their own."""
    from pyspark.sql import functions as F

    names = ["id", "row", "digest", "n", "key", "rank", "words", "doc", "keep_id", "run", "_digest"]
    return awkward(spark).select("*", *[F.lit(n).alias(n) for n in names])


def empty(spark):
    return spark.createDataFrame([], DOCS)


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)
