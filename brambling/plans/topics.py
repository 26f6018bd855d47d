"""Topic clusters end to end: embed, scale, reduce, cluster, name."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brambling.operators import corpus, encode, models
from brambling.operators.aggregate import mode_per_class
from brambling.session import settle


def topic_clusters(docs: DataFrame, key: str, label: str, text: str, vectors: DataFrame, k: int, dims: int = 15) -> DataFrame:
    """Cluster documents by their mean word vector; each cluster is named after the class it stands for."""
    embedded = corpus.doc_embedding(docs, key, text, vectors).filter(F.col("embedding").isNotNull())
    embedded = settle(embedded.join(docs.select(key, label), key))
    width = len(embedded.first()["embedding"])
    columns = [f"e{i}" for i in range(width)]
    wide = embedded.select(key, label, *[F.col("embedding")[i].alias(c) for i, c in enumerate(columns)])
    scaled = models.assemble(encode.scale(wide, encode.fit_ranges(wide, columns)), columns, [key, label])
    scores, _ = models.principal_components(scaled, k=dims)
    reduced = settle(models.assemble_array(scores, "scores", [key, label]))
    clusters = models.kmeans(reduced, k).transform(reduced).select(key, label, F.col("prediction").alias("cluster"))
    names = mode_per_class(clusters, label, "cluster").select("cluster", F.col("mapped_label").alias("named")).distinct()
    return clusters.join(names, "cluster", "left").select(key, label, "cluster", "named")
