"""Lookup indexes (master data, tags) and the joins that use them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import quoted
from plumbline.operators.skew import MAX_BROADCAST_BYTES, lookup_join, row_spread, settled_with_size

UNKNOWN = "Unknown"  # fixed value: a master-data value that never has an id

STRETCH = 50_000  # catalogue positions that are sorted in one task


def masterdata_index(relations: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(key, value, id) from flat relation rows ``entry_pos, code, name, rel_pos, value, id``.

    An entry is found under its code and under its name. A later entry with the same key replaces the earlier one as a
    whole, also when it has no relations (its row then has a NULL ``rel_pos``); inside an entry the last duplicate value wins.
    """
    keyed = relations.withColumn("key", F.explode(F.array_distinct(F.array("code", "name"))))
    keyed = keyed.filter(F.coalesce(F.col("key"), F.lit("")) != "")
    last = keyed.groupBy("key").agg(F.max("entry_pos").alias("last_pos"))
    # Reduce before joining: one row per key, entry and value is left whatever the number of duplicates.
    values = keyed.filter("rel_pos IS NOT NULL").groupBy("key", "entry_pos", "value").agg(
        F.max_by("id", "rel_pos").alias("id")
    )
    last, size = settled_with_size(last.withColumnRenamed("key", "_key"))
    kept = lookup_join(
        values, F.col("key"), last, "_key", F.xxhash64("key", "entry_pos", "value"), max_bytes=max_bytes, index_bytes=size
    )
    return kept.filter("entry_pos = last_pos").select("key", "value", "id")


def masterdata_id(
    df: DataFrame, column: str, index: DataFrame, key: str, out: str, spread: Column,
    max_bytes: int = MAX_BROADCAST_BYTES, index_bytes: int | None = None,
) -> DataFrame:
    """Id of a master-data value; NULL and "Unknown" have none, and neither has a value that is not listed."""
    text = quoted(column).cast("string")
    listed = index.filter(F.col("key") == key).select("value", F.col("id").alias(out))
    wanted = F.when(text != UNKNOWN, text)
    return lookup_join(df, wanted, listed, "value", spread, max_bytes=max_bytes, index_bytes=index_bytes)


def masterdata_ids(
    df: DataFrame, wanted: Mapping[str, str], index: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, spread: Column | None = None
) -> DataFrame:
    """The ids of several master-data columns: ``wanted`` names the new column for each column and key of the index.

    The values of all columns are counted in one pass and looked up in the index by one join. What is found is as large as
    the different values in use, not as the index: up to the bound it is broadcast and no wide row moves, beyond it see
    ``_ids_by_combination``. ``df`` stands in the plan once, whatever the number of columns.
    """
    if not wanted:
        return df
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), _searched(c).alias("value")) for c in wanted])
    used = df.select(F.explode(pairs).alias("pair")).select("pair.*").filter("value IS NOT NULL")
    used = used.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    listed = index.groupBy("key", "value").agg(F.first("id").alias("id"))
    found, size = settled_with_size(used.join(listed, ["key", "value"]))
    spread = row_spread(df) if spread is None else spread
    if size > max_bytes:
        return _ids_by_combination(df, wanted, found, size, spread, max_bytes)
    for column, out in wanted.items():
        own = found.filter(F.col("key") == column).select("value", F.col("id").alias(out))
        df = lookup_join(df, _searched(column), own, "value", spread, max_bytes=max_bytes, index_bytes=size)
    return df


def _searched(column: str) -> Column:
    """The value to look up as text; NULL where there is nothing to look up."""
    text = quoted(column).cast("string")
    return F.when(text != UNKNOWN, text)


def _told(*values: Column) -> Column:
    """One text for several values that differs wherever one of them does; NULL if all are NULL."""
    parts = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.when(F.coalesce(*values).isNotNull(), F.concat(*parts))


def _ids_by_combination(
    df: DataFrame, wanted: Mapping[str, str], found: DataFrame, size: int, spread: Column, max_bytes: int
) -> DataFrame:
    """The ids of all columns through the different combinations of values that rows hold.

    Each combination is unpivoted into narrow rows (combination, column, value), which are joined with the values found
    and grouped by combination again; then the rows of ``df`` look their combination up. One shuffle of narrow rows and one
    of wide ones, for any number of columns; frequent values and frequent combinations are taken out by a bounded broadcast.
    """
    told = _told(*[_searched(c) for c in wanted])
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), _searched(c).alias("value")) for c in wanted])
    combinations = df.select(told.alias("_told"), pairs.alias("pairs")).filter("_told IS NOT NULL")
    combinations = combinations.groupBy("_told").agg(F.count(F.lit(1)).alias("n"), F.first("pairs").alias("pairs"))
    combinations, _ = settled_with_size(combinations)
    narrow = combinations.select("_told", F.inline("pairs")).filter("value IS NOT NULL")
    known = found.select(_told(F.col("key"), F.col("value")).alias("_pair"), "id")
    often = found.select(_told(F.col("key"), F.col("value")).alias("value"), "n")
    answered = lookup_join(
        narrow, _told(F.col("key"), F.col("value")), known, "_pair", F.xxhash64("_told", "key"), max_bytes=max_bytes,
        index_bytes=size, frequent=often,
    )
    answered = answered.filter("id IS NOT NULL").groupBy("_told").agg(
        *[F.max(F.when(F.col("key") == c, F.col("id"))).alias(out) for c, out in wanted.items()]
    )
    answered, size = settled_with_size(answered)
    often = combinations.select(F.col("_told").alias("value"), "n")
    return lookup_join(df, told, answered, "_told", spread, max_bytes=max_bytes, index_bytes=size, frequent=often)


def usable_tags(tags: DataFrame) -> DataFrame:
    return tags.filter((F.col("name") != "") & (F.col("uid") != "")).select("name", "uid", "pos")


def tag_index(tags: DataFrame) -> DataFrame:
    """(name, uids): the uids of every tag name in catalogue order; rows without name or uid are ignored.

    ``pos`` is the row's position in the catalogue (rows without one come first, in any order). A name's tags are sorted
    in stretches of STRETCH positions, each in a task of its own; the stretches are then put together in order. A task
    holds the list of the one name it puts together, which is a single asset's own document and stays whole.
    """
    stretch = F.coalesce(F.floor(F.col("pos") / STRETCH), F.lit(-(2**62))).alias("stretch")
    # Dealt by both columns: the first grouping would otherwise gather all stretches of one name in one task.
    dealt = usable_tags(tags).select("name", stretch, F.struct(F.coalesce("pos", F.lit(-(2**62))).alias("pos"), "uid").alias("tag")).repartition("name", "stretch")
    sorted_ = dealt.groupBy("name", "stretch").agg(F.array_sort(F.collect_list("tag")).alias("tags"))
    sorted_ = sorted_.select("name", F.struct("stretch", F.transform("tags", lambda t: t["uid"]).alias("uids")).alias("list"))
    return sorted_.groupBy("name").agg(F.flatten(F.transform(F.array_sort(F.collect_list("list")), lambda x: x["uids"])).alias("uids"))


def attach_signals(df: DataFrame, tags: DataFrame, id_column: str, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Add ``signals`` (ordered array<struct<uid, type, name>>, empty if there are none): one row stays one row.

    The lists are built once and their size is known from that pass. A row without an id has no signals.
    """
    index, size = settled_with_size(tag_index(tags))
    id_text = quoted(id_column).cast("string")
    columns = df.columns
    found = lookup_join(df, id_text, index, "name", row_spread(df), may_be_hot=False, max_bytes=max_bytes, index_bytes=size)
    signals = F.transform("uids", lambda uid: F.struct(
        uid.alias("uid"), F.lit("SIGNAL").alias("type"), id_text.alias("name")
    ))
    return found.select(*[quoted(c) for c in columns], F.coalesce(signals, F.array()).alias("signals"))
