"""Join strategies with an explicit size check before anything is broadcast.

``broadcast()`` ships one side to every executor, so it is used only after a
cheap aggregate has measured that side.  Beyond the limit the join stays a
shuffle join: of the large side only those rows move whose key meets a bitmap of the other side's
keys (a filter of bounded size), or none where the large side is a table bucketed by the key.
The skew-prone lookups split their hot keys over several
tasks (salting) instead of sending a hot key to one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eligo.session import materialize

# Defaults; each caller may pass its own.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_ROWS_PER_TASK = 5_000_000
_ROW_OVERHEAD_BYTES = 32
_FIXED_BYTES = {
    T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
    T.DoubleType: 8, T.DecimalType: 16, T.BooleanType: 1, T.DateType: 4,
    T.TimestampType: 8, T.TimestampNTZType: 8,
}
_LEAST_HOT_BYTES = 4096   # some hot keys always fit
_OTHER_BYTES = 64   # nested types: a flat guess per value


@dataclass(frozen=True)
class SizeEstimate:
    rows: int
    bytes: int


def estimate_size(df: DataFrame) -> SizeEstimate:
    """Row count and approximate in-memory bytes, measured by one aggregate job.

    Fixed-width columns count their default size; strings and binaries their
    actual byte length.
    """
    fixed = _ROW_OVERHEAD_BYTES
    var: list[Column] = []
    for f in df.schema.fields:
        if type(f.dataType) in _FIXED_BYTES:
            fixed += _FIXED_BYTES[type(f.dataType)]
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            var.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
        else:
            fixed += _OTHER_BYTES
    var_sum = F.sum(sum(var[1:], var[0])) if var else F.lit(0)
    row = df.agg(F.count(F.lit(1)).alias("n"), var_sum.alias("v")).first()
    rows = int(row["n"] or 0)
    return SizeEstimate(rows, rows * fixed + int(row["v"] or 0))


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame | None:
    """``broadcast(df)`` when ``df`` measures at most ``max_bytes``, else ``None``."""
    if max_bytes <= 0:
        return None
    return F.broadcast(df) if estimate_size(df).bytes <= max_bytes else None


def split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return df.where(~any_null), df.where(any_null)


@dataclass(frozen=True)
class KeySet:
    """Distinct join keys, measured once; ``frame`` is broadcast when small.  A larger one has a bitmap filter:
    rows it rules out stay where they are, only the others are shuffled to the exact join."""

    frame: DataFrame
    keys: tuple[str, ...]
    broadcast: bool
    bitmap: "KeyBitmap | None" = None


def key_set(keys_df: DataFrame, keys: list[str], max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
            max_bitmap_bytes: int | None = None) -> KeySet:
    small = keys_df.select(*keys).dropDuplicates()
    size = estimate_size(small)
    if 0 < max_broadcast_bytes and size.bytes <= max_broadcast_bytes:
        return KeySet(F.broadcast(small), tuple(keys), True)
    most = MAX_BITMAP_BYTES if max_bitmap_bytes is None else max_bitmap_bytes
    # The distinct keys are not needed to set bits; copies set a bit again.
    bitmap = key_bitmap(keys_df.select(*keys), keys, size.rows, most) if most > 0 else None
    # The planner guesses a key set's size from the file it was read from, which a good compression makes far too small.
    return KeySet(small.hint("merge"), tuple(keys), False, bitmap)


def _as_key_set(keys_df, keys, max_broadcast_bytes) -> KeySet:
    return keys_df if isinstance(keys_df, KeySet) else key_set(keys_df, keys, max_broadcast_bytes)


def semi_join(big: DataFrame, keys_df: "DataFrame | KeySet", keys: list[str],
              max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Rows of ``big`` whose key occurs in ``keys_df``.

    With a small key set the join is a map-only broadcast hash join: ``big`` is
    scanned once and never shuffled.  Otherwise the rows that the key bitmap lets pass are shuffled.
    """
    ks = _as_key_set(keys_df, keys, max_broadcast_bytes)
    if ks.bitmap is not None:
        big, _ = ks.bitmap.split(big)
    return big.join(ks.frame, list(ks.keys), "left_semi")


def anti_join(big: DataFrame, keys_df: "DataFrame | KeySet", keys: list[str],
              max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Rows of ``big`` whose key does not occur in ``keys_df`` (NULL keys never occur).

    Small key set: broadcast, map-only.  Otherwise a shuffle join of the rows that the key bitmap lets
    pass; all others bypass the shuffle, rows with a NULL key among them (they cannot match, and would
    all land in the one task that NULL hashes to).
    """
    ks = _as_key_set(keys_df, keys, max_broadcast_bytes)
    if ks.broadcast:
        return big.join(ks.frame, list(ks.keys), "left_anti")
    if ks.bitmap is not None:
        maybe, surely_not = ks.bitmap.split(big)
        return maybe.join(ks.frame, list(ks.keys), "left_anti").unionByName(surely_not)
    keyed, unkeyed = split_null_keys(big, list(ks.keys))
    return keyed.join(ks.frame, list(ks.keys), "left_anti").unionByName(unkeyed)


def bucketed_anti_join(big: DataFrame, keys_df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """``anti_join`` for a ``big`` that lies in ``buckets`` buckets by ``keys``: the key set is dealt out
    like the buckets, so ``big`` is read as it lies and never shuffled, however large the key set.  (NULL keys
    match nothing and lie in their bucket.)"""
    small = keys_df.select(*keys).dropDuplicates()
    if buckets:
        small = small.repartition(buckets, *keys)
    return big.join(small.hint("merge"), keys, "left_anti")


def with_offer_bucket(df: DataFrame, n: int, key: str = "offer_id", name: str = "offer_bucket") -> DataFrame:
    """``df`` with the directory of its offer: the second partition level of a state table."""
    return df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))


def pruned_semi_join(big: DataFrame, keys_df: DataFrame, keys: list[str], n: int, max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                     name: str = "offer_bucket") -> DataFrame:
    """``semi_join`` for a ``big`` that lies in directories by ``offer_bucket``: the keys' buckets prune its scan at run time.

    The range test on the bucket holds for every key; it is what makes the planner expect the key set to be selective.
    """
    small = with_offer_bucket(keys_df.select(*keys).dropDuplicates(), n, name=name).where(F.col(name).between(0, n - 1))
    b = bounded_broadcast(small, max_broadcast_bytes)
    return big.join(small if b is None else b, [*keys, name], "left_semi")


# ---- key bitmap -------------------------------------------------------------------

MAX_BITMAP_BYTES = 16 * 1024 * 1024   # each join collects the filter to the driver once
_BLOCK_BITS = 32768      # fixed value: positions of one bitmap_construct_agg
_BITS_PER_KEY = 16       # about 6 % of foreign keys then meet a set bit


def _bit_number(keys, bits: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(bits))


@dataclass(frozen=True)
class KeyBitmap:
    """A bounded filter of a key set: bit ``hash(key) mod bits`` is set for every key.  ``blocks`` holds the set
    bits as (block, words): 32,768 bits each, in 512 longs; blocks without a key have no row."""

    blocks: DataFrame
    keys: tuple[str, ...]
    bits: int

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows whose key may be in the set, rows whose key is not), both map-only; a NULL key is not in any set."""
        n = _bit_number(self.keys, self.bits)
        known = F.lit(True)
        for k in self.keys:
            known = known & F.col(k).isNotNull()
        at = df.withColumn("_n", F.when(known, n)).withColumn("_block", F.floor(F.col("_n") / F.lit(_BLOCK_BITS)))
        probed = at.join(F.broadcast(self.blocks.where(F.col("_block").isNotNull())), "_block", "left")   # both sides then share one broadcast
        place = F.col("_n") % F.lit(_BLOCK_BITS)
        word = F.get("_words", F.floor(place / F.lit(64)).cast("int"))
        # bytes of a word run from the highest to the lowest, bits of a byte from the lowest: position xor 56
        bit = F.coalesce(F.getbit(word, (place % F.lit(64)).cast("int").bitwiseXOR(F.lit(56))) == 1, F.lit(False))
        return probed.where(bit).select(*df.columns), probed.where(~bit).select(*df.columns)


def key_bitmap(keys_df: DataFrame, keys: list[str], n_keys: int, max_bytes: int = MAX_BITMAP_BYTES) -> KeyBitmap:
    """The filter of ``keys_df``, some bits for each of its ``n_keys`` keys; at most ``max_bytes`` however many there are."""
    bits = _BLOCK_BITS
    while bits < n_keys * _BITS_PER_KEY and bits * 2 <= max_bytes * 8:
        bits *= 2
    known = keys_df.dropna(subset=keys).select(_bit_number(keys, bits).alias("n"))
    # bitmap_* number positions from 1
    maps = known.select(F.bitmap_bucket_number(F.col("n") + 1).alias("b"), F.bitmap_bit_position(F.col("n") + 1).alias("p")) \
        .groupBy("b").agg(F.bitmap_construct_agg("p").alias("m"))
    # Byte i of a map holds positions 8i to 8i + 7, lowest bit first; eight of its bytes are a word, the first one highest.
    words = F.transform(F.sequence(F.lit(0), F.lit(_BLOCK_BITS // 64 - 1)), lambda i: F.conv(
        F.hex(F.substring(F.col("m"), i * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))
    blocks = maps.select((F.col("b") - 1).alias("_block"), words.alias("_words"))
    return KeyBitmap(materialize(blocks, "key-bitmap"), tuple(keys), bits)


def lookup_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "left",
                max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                rows_per_task: int = DEFAULT_ROWS_PER_TASK,
                hot_keys_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Join a large ``fact`` to a dimension that holds one row per ``key``.

    1. Dimension measured small enough: broadcast it, no shuffle of ``fact``.
    2. Otherwise a shuffle join in which every key with more than
       ``rows_per_task`` fact rows is salted: its fact rows spread over
       ``ceil(count / rows_per_task)`` buckets by a hash of the row and of the task it
       is read in (stable when a task is re-run; copies of a row spread as well), and its
       dimension row is copied to each bucket.  The hot-key list is bounded by
       ``rows / rows_per_task`` entries.  Should it not fit ``hot_keys_broadcast_bytes``,
       ``rows_per_task`` is doubled until it does, so the hottest keys are always split.

    The dimension and the hot-key list are stored once; measuring and joining both read
    that copy.
    """
    if how not in ("left", "inner"):
        raise ValueError("lookup_join supports left and inner joins")
    dim = materialize(dim, "lookup-dim")
    b = bounded_broadcast(dim, max_broadcast_bytes)
    if b is not None:
        return fact.join(b, key, how)

    # A NULL key matches nothing: those rows skip the shuffle (and the salting).
    fact, unkeyed = split_null_keys(fact, [key])
    if how == "left":
        dim_cols = [F.lit(None).cast(f.dataType).alias(f.name)
                    for f in dim.schema.fields if f.name != key]
        unkeyed = unkeyed.select("*", *dim_cols)
    else:
        unkeyed = None

    def _with_unkeyed(joined: DataFrame) -> DataFrame:
        return joined if unkeyed is None else joined.unionByName(unkeyed)

    counts = materialize(fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                         .where(F.col("_n") > rows_per_task), "lookup-hot-keys")
    hot = counts
    while estimate_size(hot).bytes > max(hot_keys_broadcast_bytes, _LEAST_HOT_BYTES):
        rows_per_task *= 2
        hot = counts.where(F.col("_n") > rows_per_task)
    hot_b = F.broadcast(hot.select(key, F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("int").alias("_buckets")))

    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in fact.columns])
    salted_fact = (fact.join(hot_b, key, "left")
                   .withColumn("_salt", F.when(F.col("_buckets").isNull(), F.lit(0))
                               .otherwise(F.pmod(row_hash, F.col("_buckets"))))
                   .drop("_buckets"))
    salted_dim = (dim.join(hot_b, key, "left")
                  .withColumn("_salt", F.explode(F.sequence(
                      F.lit(0), F.coalesce(F.col("_buckets"), F.lit(1)) - 1)))
                  .drop("_buckets"))
    return _with_unkeyed(salted_fact.join(salted_dim, [key, "_salt"], how).drop("_salt"))
