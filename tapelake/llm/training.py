"""A bounded sample of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.columns import inputs
from tapelake.workspace import materialize


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: Column,
    most: int,
    allowed: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """At most ``most`` documents (doc_id, text, label), chosen by a hash of doc_id.

    ``label`` and ``allowed`` are expressions over ``labels``. Rows without id or
    label are left out, of several labels of an id the largest counts, and of
    several texts of an id the smallest. The chosen ids are broadcast: ``most``
    bounds them. The sample is written to the shared folder.
    """
    chosen = (
        labels.where(allowed)
        .select(labels["doc_id"].alias("key"), label.alias("label"))
        .dropna()
        .groupBy("key")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(most)
    )
    chosen = materialize(chosen, "chosen-labels")
    texts = inputs(docs, doc_id=id_col, text=text_col)
    rows = (
        texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["key"])
        .groupBy("doc_id", "label")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    )
    return materialize(rows, "labelled")
