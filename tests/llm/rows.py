"""Frames of documents for the tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None):
    """One document per text, ids from 0."""
    rows = [
        (i, t, "en", sources[i] if sources else "src0", None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def by_id(df, key="doc_id"):
    """Rows as dicts, by id."""
    return {r[key]: r.asDict() for r in df.collect()}
