"""Small documents with the awkward cases that every operator must take."""

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows):
    """rows: (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)


def awkward(spark):
    words = " ".join(f"word{i}" for i in range(30))
    return documents(spark, [
        (1, words, "a"), (2, words, "a"), (2, words, "a"), (3, None, "b"), (4, "", None), (5, "short", None), (None, "no key at all here", "b"),
        (None, None, None), (6, "long " * 20_000, "c"), (7, "Ünïcode texte\tavec\x0bdes blancs\n", "c"), (8, " \n ", "a"),
    ])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
