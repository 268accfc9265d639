"""Small fixtures shared by the tests of the training-data operators."""

from __future__ import annotations

import folioscope.llm.queries  # noqa: F401  registers the queries

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SMALL = "/root/testdata/sf0.001"


def documents(spark, texts, **columns):
    """Rows of the documents table from texts, with ids from 0 and one language and source."""
    rows = [
        (
            columns.get("ids", range(len(texts)))[i],
            t,
            columns.get("langs", ["en"] * len(texts))[i],
            columns.get("sources", ["s"] * len(texts))[i],
            None if t is None else len(t),
        )
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def tables(folder, **frames) -> str:
    """Write frames as the tables of a data folder and return its path."""
    for name, frame in frames.items():
        frame.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
