"""Small tables for the tests of the text operators."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, langs=None):
    """One row per text (or (doc_id, text) pair); null langs unless given."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    langs = langs or [None] * len(rows)
    data = [(i, t, lang, None, None if t is None else len(t)) for (i, t), lang in zip(rows, langs)]
    return spark.createDataFrame(data, SCHEMA)


def awkward(spark):
    """Null, empty, blank, tied, repeated and very long texts, null ids, clashing columns."""
    long = " ".join(f"w{i % 977} x{i % 31}" for i in range(30_000))
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "a"), (4, "A"), (5, "a"), (5, "a"), (6, long), (7, long), (None, "b c"), (None, None), (9, "Ä ä İ"), (10, "!?")]
    frame = documents(spark, rows)
    for name in ("digest", "p", "node", "key", "normal", "line", "h", "n", "component", "keep_id", "token", "w", "score", "lang_pred"):
        frame = frame.selectExpr("*", f"'clash' as `{name}`")
    return frame
