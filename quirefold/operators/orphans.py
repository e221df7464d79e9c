"""Problem 2: rows that refer to documents which do not exist, or did not exist yet at the row's own time.

Only distinct non-null foreign keys meet the parent table: each child table is first reduced to one row per key with
its earliest row time (partial aggregation takes the heat out of hot keys), left-anti-joined (absent) or joined (late
candidates) with the parent keys, and the few flagged keys are joined back to the rows. For that the flagged keys are
repeated in SALTS buckets and each row looks in one of them, so that one hot key does not end in one task.

Defined results: null keys are not cases; a repeated row (same id) is reported once; rows or parents without an instant
are never ``late``; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.session import cut

DAY_US = 86_400_000_000
#: Buckets over which the rows of one key are spread in the join back.
SALTS = 16


def orphan_rows(children: DataFrame, parents: DataFrame, grace_us: int = DAY_US) -> DataFrame:
    """(table_name, row_id, row_us, reason) of ``children`` (table_name, row_id, document_id, row_us) against ``parents`` (document_id, created_us)."""
    refs = children.filter(F.col("document_id").isNotNull())
    keys = cut(refs.groupBy("document_id").agg(F.min("row_us").alias("first_us")))  # one row per key, used twice
    known = parents.filter(F.col("document_id").isNotNull()).select("document_id", "created_us")
    absent = keys.join(known, "document_id", "left_anti").select("document_id", F.lit(None).cast("boolean").alias("known"), F.lit(None).cast("long").alias("created_us"))
    late = keys.join(known, "document_id").filter(F.col("first_us") + grace_us < F.col("created_us")).select("document_id", F.lit(True).alias("known"), "created_us")
    flagged = absent.unionByName(late).select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = refs.withColumn("salt", F.pmod(F.xxhash64("table_name", "row_id"), F.lit(SALTS)).cast("int"))
    hit = salted.join(flagged, ["document_id", "salt"])
    reason = F.when(F.col("known").isNull(), "absent").when(F.col("row_us") + grace_us < F.col("created_us"), "late")
    return hit.withColumn("reason", reason).filter("reason IS NOT NULL").select("table_name", "row_id", "row_us", "reason").dropDuplicates(["table_name", "row_id", "reason"])


def child_tables(base_tables: dict[str, DataFrame], logs_us: DataFrame) -> DataFrame:
    """The three child tables as one: page_contents and document_assets by created_at, the logs by their parsed instant (id, document_id, row_us)."""
    parts = [
        base_tables[name].select(F.lit(name).alias("table_name"), F.col("id").alias("row_id"), "document_id", F.unix_micros("created_at").alias("row_us"))
        for name in ("document_assets", "page_contents")
    ]
    parts.append(logs_us.select(F.lit("process_logs").alias("table_name"), F.col("id").alias("row_id"), "document_id", "row_us"))
    return reduce(DataFrame.unionByName, parts)


def orphan_counts(rows: DataFrame) -> DataFrame:
    """table_name, month (YYYY-MM in UTC, null without an instant), reason, n_rows."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("row_us") / DAY_US).cast("int"))  # of UTC, whatever the session's zone
    month = F.date_format(day, "yyyy-MM")
    return rows.groupBy("table_name", month.alias("month"), "reason").agg(F.count("*").alias("n_rows"))
