"""Reference checks against a parent table.

Only the distinct parent keys take part in the joins. Nothing is hinted: Spark broadcasts the keys
when they turn out small, and otherwise sorts and merges with skewed child keys split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.functions.text import blank


def _renamed(parent: DataFrame, parent_key: str, key: str) -> DataFrame:
    keys = parent.select(F.col(parent_key).alias(key))
    return keys.filter(F.col(key).isNotNull())


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None, skip_blank: bool = False) -> DataFrame:
    """Rows without a parent (J1, J3). `skip_blank` leaves out rows whose key is blank."""
    rows = child.filter(~blank(key)) if skip_blank else child
    return rows.join(_renamed(parent, parent_key or key, key), key, "left_anti").select(*child.columns)


def with_parent(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows whose parent exists (J4); never multiplies rows."""
    return child.join(_renamed(parent, parent_key or key, key), key, "left_semi").select(*child.columns)


def mark_parent(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None, blank_ok: bool = False, out: str = "has_parent"
) -> DataFrame:
    """Add a flag for both outputs in one pass (J1 and J2 together). `blank_ok` accepts blank keys."""
    # Skewed partitions are only split when the join reads both exchanges directly. De-duplicating
    # on a struct leaves the keys partitioned by something else, so that the join gets its own.
    keys = _renamed(parent, parent_key or key, key).groupBy(F.struct(key).alias("__one")).agg(F.lit(True).alias(out))
    keys = keys.select(F.col(f"__one.{key}").cast("string").alias("__join"), out)
    # A NULL key would meet in one task; a stand-in made of the row spreads such rows and matches nothing.
    # It is the same when a task runs again.
    text = F.col(key).cast("string")
    hashed = [c for c, kind in child.dtypes if "variant" not in kind and "map<" not in kind]
    child_key = F.coalesce(text, F.concat(F.lit("\x00"), F.xxhash64(*[F.col(f"`{c}`") for c in hashed]).cast("string")))
    joined = child.withColumn("__join", child_key).join(keys, "__join", "left")
    flag = F.coalesce(F.col(out), F.lit(False))
    if blank_ok:
        flag = flag | blank(text)
    return joined.withColumn(out, flag).select(*child.columns, out)


def present_or_blank(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows whose key is blank or has a parent."""
    return mark_parent(child, parent, key, parent_key, blank_ok=True).filter("has_parent").drop("has_parent")


def check_reference(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Orphaned keys and their row counts; NULL keys pass, as in a foreign key."""
    # Counted by key first: the join then sees each key once, however often it occurs.
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return orphans(counted, parent, key, parent_key)


def require_reference(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> None:
    """Fail when a row has no parent."""
    bad = check_reference(child, parent, key, parent_key).limit(5).collect()
    if bad:
        raise ValueError(f"{key} without parent, for example {[r[0] for r in bad]}")
