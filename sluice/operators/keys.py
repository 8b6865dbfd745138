"""Composite-key uniqueness within a file (R2) without a skew-prone window.

``count() OVER (PARTITION BY file, keys)`` would send every row of a hot key to
one task. Instead the group sizes are a partial (map-side combined)
aggregate, only groups with more than one member are kept, and those are
joined back on the null-safe key. The duplicate table is broadcast only when
its measured size is under the budget; otherwise the rows go through a shuffle
join on two hashes of the key and the file (no key text is sorted); the key values decide
after the match, and AQE's skew-join split handles a hot key on the big side. Where keys are
free texts, and rows so wide, a Bloom filter of the key hashes picks the rows that may have a
duplicate key, and only these are shuffled; that makes the rows twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_budget

KEY_COUNT = "_key_count"


def duplicate_groups(df: DataFrame, keys: list[str], file_col: str = "source_filename") -> DataFrame:
    """(file, keys..., _key_count) for every key tuple seen more than once in a file."""
    return (
        df.groupBy(file_col, *keys)
        .agg(F.count(F.lit(1)).alias(KEY_COUNT))
        .where(F.col(KEY_COUNT) > 1)
    )


def key_hashes(keys: list[str]) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of the key tuple (null distinct from '')."""
    parts = []
    for k in keys:
        parts += [F.col(k).isNull(), F.coalesce(F.col(k), F.lit(""))]
    return F.xxhash64(*parts), F.xxhash64(F.lit("second hash"), *parts)


def duplicate_groups_two_phase(
    df: DataFrame,
    keys: list[str],
    file_col: str = "source_filename",
    budget: int | None = None,
    cached: list[DataFrame] | None = None,
) -> DataFrame:
    """Same result as ``duplicate_groups`` without shuffling wide key values.

    Phase 1 groups by (file, 128-bit hash of the keys): only the hashes cross
    the network, and a hash group of one row is certainly a unique key.
    Phase 2 counts exactly, by the key values, only the rows of hash groups
    with more than one member (duplicates, plus any hash collision).
    The hash groups are persisted; they are added to ``cached`` for the caller
    to release.
    """
    h1, h2 = key_hashes(keys)
    hashed = df.select(file_col, *keys, h1.alias("_h1"), h2.alias("_h2"))
    candidates = (
        hashed.groupBy(file_col, "_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .select(file_col, "_h1", "_h2")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    if cached is not None:
        cached.append(candidates)
    n = candidates.count()
    budget = broadcast_budget(df.sparkSession) if budget is None else budget
    cand = F.broadcast(candidates) if n * 128 <= budget else candidates
    rows = hashed.join(cand, [file_col, "_h1", "_h2"], "left_semi")
    return duplicate_groups(rows, keys, file_col)


#: Memory of a broadcast word of 64 bits; the fewest words.
WORD_BYTES, LEAST_WORDS = 64, 1024


def _marked(rows: DataFrame, dups: DataFrame, budget: int) -> DataFrame:
    """Adds ``_maybe``: false where no duplicate key has the row's key hash.

    A Bloom filter with one hash as a broadcast table of words of bits: as many as
    the budget holds, so its size does not grow with the duplicates; with more of
    them it rules out fewer rows."""
    words = max(LEAST_WORDS, 1 << max(0, (budget // WORD_BYTES).bit_length() - 1))
    spot = lambda h: F.col(h).bitwiseAND(64 * words - 1)
    bit = lambda h: F.col(h).bitwiseAND(63).cast("int")
    table = dups.groupBy(F.shiftright(spot("_dh1"), 6).alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit("_dh1"))).alias("_bits"))
    there = F.call_function("shiftright", F.col("_bits"), bit("_h1")).bitwiseAND(1) == 1
    rows = rows.join(F.broadcast(table), F.shiftright(spot("_h1"), 6) == F.col("_word"), "left")
    return rows.withColumn("_maybe", F.coalesce(there, F.lit(False))).drop("_word", "_bits")


def with_key_counts(
    df: DataFrame,
    keys: list[str],
    file_col: str = "source_filename",
    budget: int | None = None,
    count_from: DataFrame | None = None,
    two_phase: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """Add ``_key_count`` (null for unique keys). Returns (frame, cached dup table).

    ``count_from`` (default ``df``) is the frame the group sizes are counted
    on: the same rows, possibly before a repartition. The caller unpersists
    the returned duplicate table after the last use.
    """
    if not keys:
        return df.withColumn(KEY_COUNT, F.lit(None).cast("long")), None
    spark: SparkSession = df.sparkSession
    renamed = {k: f"_dk{i}" for i, k in enumerate([file_col, *keys])}
    source = count_from if count_from is not None else df
    held: list[DataFrame] = []
    groups = (
        duplicate_groups_two_phase(source, keys, file_col, budget, held)
        if two_phase
        else duplicate_groups(source, keys, file_col)
    )
    dups = groups.select(
        *[F.col(k).alias(v) for k, v in renamed.items()], KEY_COUNT
    )
    dups = dups.persist(StorageLevel.MEMORY_AND_DISK)
    # Size check: row count and key bytes of the duplicate table.
    width = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.length(F.col(v)), F.lit(0)) + F.lit(8) for v in renamed.values()],
    )
    rows, nbytes = dups.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    for candidates in held:  # the duplicate table is materialized now
        candidates.unpersist()
    budget = broadcast_budget(spark) if budget is None else budget
    same_key = [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys]
    same_file = F.col(file_col) == F.col(renamed[file_col])
    if nbytes > budget:
        h1, h2 = key_hashes([renamed[k] for k in keys])
        hashed = dups.withColumns({"_dh1": h1, "_dh2": h2})
        # Equal hashes of different duplicate keys would match a row twice.
        if hashed.select(renamed[file_col], "_dh1", "_dh2").distinct().count() == rows:
            h1, h2 = key_hashes(keys)
            rows_hashed = df.withColumns({"_h1": h1, "_h2": h2})
            same_hash = (F.col("_h1") == F.col("_dh1")) & (F.col("_h2") == F.col("_dh2")) & same_file
            if not two_phase:  # narrow rows: moving all of them costs less than making them twice
                out = rows_hashed.join(hashed, same_hash, "left")
                out = out.withColumn(KEY_COUNT, F.when(reduce(Column.__and__, same_key), F.col(KEY_COUNT)))
                return out.drop("_h1", "_h2", "_dh1", "_dh2", *renamed.values()), dups
            marked = _marked(rows_hashed, hashed, budget)
            out = marked.where("_maybe").drop("_maybe").join(hashed, same_hash, "left")
            out = out.withColumn(KEY_COUNT, F.when(reduce(Column.__and__, same_key), F.col(KEY_COUNT)))
            out = out.drop("_h1", "_h2", "_dh1", "_dh2", *renamed.values())
            # rows whose key is certainly unique stay where they are
            unique = marked.where("NOT _maybe").drop("_maybe", "_h1", "_h2").withColumn(KEY_COUNT, F.lit(None).cast("long"))
            return out.unionByName(unique), dups
    right = F.broadcast(dups) if nbytes <= budget else dups
    out = df.join(right, reduce(Column.__and__, same_key, same_file), "left").drop(*renamed.values())
    return out, dups
