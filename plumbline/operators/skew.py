"""Joins that hold up when one key owns a large share of the rows, and the size check in front of every broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import sql_name

MAX_BROADCAST_BYTES = 32 * 1024 * 1024

# Keys that are taken out of a shuffled join by a broadcast of their own. A key with more than 1/HOT_KEYS of all rows
# is always among the HOT_KEYS most frequent ones, so what stays in the shuffle is spread; and the broadcast side is
# bounded by this number whatever the data holds. Rows of other keys are never dropped, they take the shuffled join.
HOT_KEYS = 1000
_SPREAD = 4096

BITMAP_BITS = 27


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see: the one the session names, else one below the warehouse, which a cluster shares as well."""
    context = spark.sparkContext
    named, current = spark.conf.get("spark.checkpoint.dir", None), context.getCheckpointDir()
    if not current:
        named = named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_plumbline"
        context.setCheckpointDir(named)
    return named or current


def settled(df: DataFrame) -> DataFrame:
    """The frame computed once and kept in the shared checkpoint folder, so that losing executors loses nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def row_spread(df: DataFrame) -> Column:
    """A hash that tells rows apart as far as their content does."""
    return F.xxhash64(*[sql_name(n) for n, kind in df.dtypes if not kind.startswith(("map", "variant"))])


def total_bytes(df: DataFrame) -> Column:
    """Aggregate for the rough in-memory size of a frame: text and nested value lengths plus 16 bytes per field."""
    widths = []
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            widths.append(f"coalesce(octet_length({sql_name(name)}), 0)")
        elif kind.startswith(("array", "struct", "map")):
            widths.append(f"coalesce(length(to_json(struct({sql_name(name)}))), 0)")
    per_row = " + ".join([f"{16 * len(df.columns)}L", *widths])
    return F.expr(f"coalesce(sum({per_row}), 0L)").alias("bytes")


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame by one aggregation over it."""
    return df.agg(total_bytes(df)).first()["bytes"]


def settled_with_size(df: DataFrame) -> tuple[DataFrame, int]:
    """The settled frame and its size, in one pass. A repeated task may count twice, so the size errs upwards."""
    seen = Observation()
    kept = settled(df.observe(seen, total_bytes(df)))
    return kept, seen.get["bytes"]


def bit_table(keys: DataFrame, key: str, level: int) -> DataFrame:
    """A bitmap of 2^BITMAP_BITS positions over the hashes of the keys, as rows of 4 KB: 16 MB at most, whatever the data hold."""
    at = F.shiftrightunsigned(F.xxhash64(F.lit(level), F.col(key)), 64 - BITMAP_BITS) + 1
    bits = keys.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("_bucket"))
    return settled(bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("_bits")))


def with_bit(df: DataFrame, key: Column, table: DataFrame, level: int, name: str) -> DataFrame:
    """Add whether the bitmap has the bit of the key; a NULL key has none. A broadcast of fixed size, no row moves."""
    at = F.shiftrightunsigned(F.xxhash64(F.lit(level), key), 64 - BITMAP_BITS) + 1
    at = F.when(key.isNotNull(), at)
    byte = F.conv(F.hex(F.expr("substring(_bits, CAST(_position DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    spots = df.withColumns({"_at": F.bitmap_bucket_number(at), "_position": F.bitmap_bit_position(at)})
    found = spots.join(F.broadcast(table), F.col("_at") == F.col("_bucket"), "left")
    bit = F.getbit(byte, F.pmod("_position", F.lit(8)).cast("int")) == 1
    return found.select(*[F.col(sql_name(c)) for c in df.columns], F.coalesce(bit, F.lit(False)).alias(name))


def _sieve(df: DataFrame, keys: DataFrame, wanted: Column) -> tuple[list[DataFrame], DataFrame] | None:
    """Bitmaps that take turns in letting keys through wrongly, and the exact small set that is left in the end.

    The first bitmap holds the listed keys; the second those keys of ``df`` that pass the first one and are not listed;
    the third the listed keys that pass the second, and so on. Each set is a small share of the one two steps before
    it, until it can be broadcast. None if the sets do not shrink, which takes hundreds of millions of keys.
    """
    tables = [bit_table(keys, "_key", 0)]
    asked = with_bit(df.select(wanted.alias("_key")), F.col("_key"), tables[0], 0, "_bit").filter("_bit").select("_key").distinct()
    before = None
    current, size = settled_with_size(asked.join(keys, "_key", "left_anti"))
    previous = keys
    while size > MAX_BROADCAST_BYTES:
        level = len(tables)
        tables.append(bit_table(current, "_key", level))
        passed, next_size = settled_with_size(with_bit(previous, F.col("_key"), tables[level], level, "_bit").filter("_bit").select("_key"))
        if before is not None and next_size > before // 2:
            return None
        previous, current, before, size = current, passed, size, next_size
    return tables, current


def mark_members(
    df: DataFrame, keys: DataFrame, key: str, eligible: Column, flag: str, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Add a boolean column telling for which eligible rows ``key`` is listed in ``keys(key, n)``.

    ``keys`` holds each key once with its number of rows. It is settled first, so its size is known: below the bound it
    is broadcast. Beyond it the rows pass a sieve of broadcast bitmaps of fixed size whose errors are listed exactly
    (see ``_sieve``): the wide rows are scanned once and never move. Only where the sieve does not converge are rows
    joined by shuffle, the hottest keys by a broadcast of their own.
    """
    keys, size = settled_with_size(keys.select(F.col(key).alias("_key"), "n"))
    wanted = F.when(eligible, F.col(key))
    listed = keys.select("_key", F.lit(True).alias(flag))
    if size <= max_bytes:
        joined = df.join(F.broadcast(listed), wanted == F.col("_key"), "left")
        return joined.drop("_key").withColumn(flag, F.coalesce(flag, F.lit(False)))

    sieve = _sieve(df, keys.select("_key"), wanted)
    if sieve is None:
        return _shuffled_members(df, keys, key, eligible, flag)
    tables, rest = sieve
    marked = df
    for level, table in enumerate(tables):
        marked = with_bit(marked, wanted, table, level, f"_bit{level}")
    rest = rest.select("_key", F.lit(True).alias("_rest"))
    marked = marked.join(F.broadcast(rest), wanted == F.col("_key"), "left")
    #: Stopped by an even bitmap: not listed; by an odd one: listed. Past all of them the exact rest decides.
    last = len(tables) % 2 == 1
    answer = F.when(F.col("_rest").isNotNull(), F.lit(not last)).otherwise(F.lit(last))
    for level in reversed(range(len(tables))):
        answer = F.when(~F.col(f"_bit{level}"), F.lit(level % 2 == 1)).otherwise(answer)
    return marked.select(*[F.col(sql_name(c)) for c in df.columns], answer.alias(flag))


def _shuffled_members(df: DataFrame, keys: DataFrame, key: str, eligible: Column, flag: str) -> DataFrame:
    """The hottest keys by broadcast, the rest of the rows that search something by a join on the key."""
    listed = keys.select("_key", F.lit(True).alias(flag))
    wanted = F.when(eligible, F.col(key))
    hot = keys.orderBy(F.desc("n"), "_key").limit(HOT_KEYS).select("_key", F.lit(True).alias(flag))
    marked = df.join(F.broadcast(hot), wanted == F.col("_key"), "left").drop("_key")
    open_rows = F.coalesce(eligible, F.lit(False)) & F.col(key).isNotNull() & F.col(flag).isNull()
    answered = marked.filter(~open_rows)
    searched = marked.filter(open_rows).drop(flag).join(listed, F.col(key) == F.col("_key"), "left").drop("_key")
    both = answered.unionByName(searched.select(*answered.columns))
    return both.withColumn(flag, F.coalesce(flag, F.lit(False)))


def lookup_join(
    df: DataFrame, key: Column, index: DataFrame, index_key: str, spread: Column, may_be_hot: bool = True,
    max_bytes: int = MAX_BROADCAST_BYTES, index_bytes: int | None = None, frequent: DataFrame | None = None,
) -> DataFrame:
    """Left join of ``df`` to an index (unique on ``index_key``), adding the index's other columns.

    A small index is broadcast. A large one is joined by shuffle in two steps: the values that most rows of ``df`` hold
    are looked up through a broadcast of at most HOT_KEYS index rows, all other rows by a shuffle on the key. Rows that
    search nothing (NULL key, or answered already) would all fall on one partition; ``spread`` (a column that differs
    from row to row, such as the row's id) deals them out instead. ``frequent`` (value, n) hands in how often values occur,
    if that is known; otherwise ``df`` is counted once. What was counted is settled, so ``df`` stands in the plan once.
    """
    values = [c for c in index.columns if c != index_key]
    index = index.withColumnRenamed(index_key, "_index_key")
    size = measured_bytes(index) if index_bytes is None else index_bytes
    if size <= max_bytes:
        return df.join(F.broadcast(index), key == F.col("_index_key"), "left").drop("_index_key")

    keyed = df.withColumn("_search", key)
    if may_be_hot:
        if frequent is None:
            frequent = keyed.filter("_search IS NOT NULL").groupBy("_search").agg(F.count(F.lit(1)).alias("n"))
        else:
            frequent = frequent.select(F.col("value").alias("_search"), "n")
        frequent = settled(frequent.orderBy(F.desc("n"), "_search").limit(HOT_KEYS).select("_search"))
        # Both sides of these joins are at most HOT_KEYS rows; the large index is only scanned.
        found = index.join(F.broadcast(frequent), F.col("_search") == F.col("_index_key"))
        found = found.select("_index_key", F.struct(*values).alias("_hot"))
        hot = frequent.join(F.broadcast(found), F.col("_search") == F.col("_index_key"), "left")
        hot = hot.select(F.col("_search").alias("_hot_key"), "_hot")
        keyed = keyed.join(F.broadcast(hot), F.col("_search") == F.col("_hot_key"), "left")
    else:
        keyed = keyed.withColumns({"_hot_key": F.lit(None), "_hot": F.lit(None)})
    searching = F.col("_search").isNotNull() & F.col("_hot_key").isNull()
    # One text key for both kinds of rows. A second, constant salt column on the index side would not do: Catalyst
    # folds the constant into a plain condition and shuffles by the first key alone.
    dealt = F.concat(F.lit("s"), F.pmod(F.xxhash64(spread), F.lit(_SPREAD)).cast("string"))
    found_by = F.concat(F.lit("k"), F.col("_search").cast("string"))
    keyed = keyed.withColumn("_left_key", F.when(searching, found_by).otherwise(dealt))
    right = index.filter("_index_key IS NOT NULL").select(
        F.concat(F.lit("k"), F.col("_index_key").cast("string")).alias("_right_key"), F.struct(*values).alias("_found")
    )
    joined = keyed.join(right, F.col("_left_key") == F.col("_right_key"), "left")
    answer = F.when(F.col("_hot_key").isNotNull(), F.col("_hot")).otherwise(F.col("_found")) if may_be_hot \
        else F.col("_found")
    return joined.withColumn("_answer", answer).select(*[F.col(sql_name(c)) for c in df.columns], *[F.col("_answer")[v].alias(v) for v in values])
