"""A bounded, repeatable sample of labelled documents, drawn by a hash of the id in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps of the hash by which a sample is drawn.
SPREAD = 1_000_000_007


def labelled_sample(documents: DataFrame, labels: tuple[str, ...], size: int, chars: int, usable: Column | None = None) -> dict[str, list[str]]:
    """label -> at most ``size`` texts of at most ``chars`` characters: those of the least hashes, twice as many looked at.

    Reads the label column once to learn how many rows each label has, then the texts of the sampled rows only.
    """
    keyed = documents.filter(F.col("lang").isin(*labels) & F.col("text").isNotNull()).withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)))
    share = {r["lang"]: min(SPREAD, SPREAD * size * 2 // r["count"] + 1) for r in documents.filter(F.col("lang").isin(*labels)).groupBy("lang").count().collect()}  # one row per label
    below = F.lit(False)
    for label, bound in share.items():
        below = below | ((F.col("lang") == label) & (F.col("h") < bound))
    sample = keyed.filter(below)
    if usable is not None:
        sample = sample.filter(usable)
    rows: dict[str, list[str]] = {label: [] for label in labels}
    slim = sample.select("lang", "h", "doc_id", F.left("text", F.lit(chars)).alias("text"))
    for row in sorted(slim.limit(4 * size * len(labels)).collect(), key=lambda r: (r["h"], r["doc_id"] or 0)):
        if len(rows[row["lang"]]) < size:
            rows[row["lang"]].append(row["text"])
    return rows
