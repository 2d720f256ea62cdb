"""Small inputs shared by the tests of the training-data operators."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators use inside.
CLASH = "row string, size int, key string, hash string, fingerprint int, component_id int, kept int, ids int, spans int, n_words int"


def documents(spark, rows):
    """(doc_id, text[, lang[, source]]) -> documents."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def with_clashes(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(None).cast(c.split(" ")[1]).alias(c.split(" ")[0]) for c in CLASH.split(", ")])


def words(n, start=0, step=1):
    return " ".join(f"w{start + i * step}" for i in range(n))


LONG = words(30_000)
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (5, LONG, None, None), (None, "no id here"), (6, "\x1c é ß 漢字 🙂 ́")]
