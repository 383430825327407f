"""Keyed table maintenance: an ordered change log applied to item ids.

Rules (those of the item service this replaces):

* create: title required, 1-200 characters; description at most 2000
  characters; ``completed`` starts false, ``created_at`` is the change time;
* update: each given field replaces the old value, missing fields keep it;
  a given title must be 1-200 characters, a description at most 2000;
* delete: removes the item;
* an update or delete of an id that does not exist (never created, or
  deleted) is rejected; ids are never re-used, so a second create is rejected.

Sequential replay per id reduces to two numbers: ``c0``, the first valid
create, and ``d0``, the first delete after it. A valid change is accepted when
it is the ``c0`` create, or an update/delete with ``c0 < seq <= d0``. Both
numbers are per-id aggregates (map-side combined, so a hot id is not one
task); they are joined back to the log through a table with one row per id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: field limits of the item schema ---
TITLE_MIN, TITLE_MAX = 1, 200
DESCRIPTION_MAX = 2000
# --- end of fixed values ---

ITEM_COLUMNS = ["id", "title", "description", "completed", "created_at"]


def changes_validate(changes: DataFrame) -> DataFrame:
    """Adds ``valid`` (bool) and ``reason`` (NULL when valid)."""
    op, title, desc = F.col("op"), F.col("title"), F.col("description")
    t_len, d_len = F.char_length(title), F.char_length(desc)
    bad_title = (t_len < TITLE_MIN) | (t_len > TITLE_MAX)
    reason = (F.when(~op.isin("create", "update", "delete"), F.lit("unknown operation"))
              .when((op == "create") & title.isNull(), F.lit("title required"))
              .when(op.isin("create", "update") & title.isNotNull() & bad_title,
                    F.lit("title length"))
              .when(op.isin("create", "update") & desc.isNotNull() & (d_len > DESCRIPTION_MAX),
                    F.lit("description length")))
    return changes.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def _lifetimes(validated: DataFrame) -> DataFrame:
    """Per id: c0 (first valid create) and d0 (first delete after c0)."""
    good = validated.where("valid")
    c0 = good.where(F.col("op") == "create").groupBy("id").agg(F.min("seq").alias("c0"))
    d0 = (good.where(F.col("op") == "delete").join(c0, "id")
          .where(F.col("seq") > F.col("c0")).groupBy("id").agg(F.min("seq").alias("d0")))
    return c0.join(d0, "id", "left")


def changes_decide(changes: DataFrame) -> DataFrame:
    """Every change with ``accepted`` and a ``reason`` for rejected ones."""
    v = changes_validate(changes)
    life = _lifetimes(v)
    j = v.join(life, "id", "left")
    seq, op = F.col("seq"), F.col("op")
    in_life = (seq > F.col("c0")) & (F.col("d0").isNull() | (seq <= F.col("d0")))
    accepted = F.col("valid") & F.coalesce(
        ((op == "create") & (seq == F.col("c0"))) | (op.isin("update", "delete") & in_life),
        F.lit(False))
    reason = (F.when(~F.col("valid"), F.col("reason"))
              .when(accepted, F.lit(None).cast("string"))
              .when(op == "create", F.lit("id exists"))
              .otherwise(F.lit("not found")))
    return (j.withColumn("accepted", accepted).withColumn("reason", reason)
            .drop("valid"))


def changes_apply(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(snapshot, rejects). Snapshot: live items with the latest given value
    of each field; rejects: the refused changes with a reason."""
    decided = changes_decide(changes)
    live = decided.where(F.col("accepted") & F.col("d0").isNull())

    def latest(c):
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("seq")))

    completed = F.when(F.col("op") == "create", F.lit(False)).otherwise(F.col("completed"))
    snap = (live.withColumn("completed", completed)
            .groupBy("id").agg(latest("title").alias("title"),
                               latest("description").alias("description"),
                               latest("completed").alias("completed"),
                               F.min(F.when(F.col("op") == "create", F.col("ts"))).alias("created_at"))
            .select(*ITEM_COLUMNS))
    rejects = decided.where(~F.col("accepted")).drop("accepted", "c0", "d0")
    return snap, rejects


def lookup_by_id(items: DataFrame, requests: DataFrame, key: str = "id") -> DataFrame:
    """Each requested id with its item, or ``found = false`` (not found)."""
    req = requests.select(key).distinct()
    return (req.join(items.withColumn("found", F.lit(True)), key, "left")
            .withColumn("found", F.coalesce("found", F.lit(False))))


def snapshot_newest_first(items: DataFrame) -> DataFrame:
    """All items, highest id first; ``completed`` as boolean."""
    return (items.withColumn("completed", F.col("completed").cast("boolean"))
            .orderBy(F.col("id").desc()))
