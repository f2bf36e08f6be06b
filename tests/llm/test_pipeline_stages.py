"""Stages of the corpus pipeline on odd rows."""

import corpus_pipeline as pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id long, pii string"
LONG = " ".join(f"word{i}" for i in range(60))


def rows_of(df):
    return sorted((r["doc_id"] or -1, "null" if r["text"] is None else r["text"], r["component_id"], r["pii"]) for r in df.collect())


def test_one_row_of_every_id_and_group(spark):
    """Repeated rows, rows of one id with other texts, copies, nulls and empty texts, and columns named like helpers."""
    rows = [(1, LONG, 9), (1, LONG, 9), (2, LONG + " end", 9), (3, "something else here entirely now", 9), (3, "another text of the same id", 9),
            (4, None, 9), (4, None, 9), (5, "", 9), (None, LONG, 9), (None, LONG, 9)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, c, "mine") for i, t, c in rows], SCHEMA)
    got = pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert rows_of(got) == sorted([(1, LONG, 9, "mine"), (3, "another text of the same id", 9, "mine"), (4, "null", 9, "mine"),
                                   (5, "", 9, "mine"), (-1, LONG, 9, "mine"), (-1, LONG, 9, "mine")])
    assert pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0


def test_personal_data_keeps_user_columns(spark):
    docs = spark.createDataFrame([(1, "write to a@b.org", "en", "s", 16, 9, "mine"), (2, None, "en", "s", None, 9, None)], SCHEMA)
    got = {r["doc_id"]: r for r in pipeline.personal_data(spark, docs, "").collect()}
    assert got[1]["text"] == "write to [EMAIL]" and got[1]["n_chars"] == 16 and got[1]["pii"] == "mine"
    assert got[2]["text"] is None and got[2]["n_chars"] is None
    assert pipeline.personal_data(spark, docs.limit(0), "").columns == docs.columns
