"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane import scratch

# A lookup side is broadcast only when it was measured to have no more rows and
# no more bytes, all columns written as JSON, than this.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more fact rows than this is split into pieces of at most so many.
ROWS_PER_PIECE = 1_000_000
# The list of split keys is broadcast. Beyond MOST_SPLIT * ROWS_PER_PIECE fact
# rows the pieces grow instead of the list: it has fewer rows whatever the data.
MOST_SPLIT = 100_000


def is_small(df: DataFrame, most_rows: int | None = None) -> bool:
    """Whether ``df`` fits a broadcast.

    Rows are counted first, which for a stored table reads file footers only.
    The bytes are measured when the rows are few. A limit would not be cheaper:
    it moves up to that many rows from every partition into one task.
    """
    if df.count() > (BROADCAST_ROWS if most_rows is None else most_rows):
        return False
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    return (df.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES


def hot_keys(counts: DataFrame, key: str, rows: str = "rows") -> DataFrame:
    """Keys with more rows than a piece, with the number of pieces (``_fan``) to split each into.

    ``counts`` has one row per key. The result has fewer than MOST_SPLIT rows.
    """
    piece = counts.agg(
        F.greatest(F.lit(float(ROWS_PER_PIECE)), F.sum(rows).cast("double") / MOST_SPLIT).alias("piece")
    ).scalar()
    return counts.where(F.col(key).isNotNull() & (F.col(rows) > piece)).select(
        F.col(key), F.ceil(F.col(rows) / piece).alias("_fan")
    )


def salted_join(
    fact: DataFrame, lookup: DataFrame, key: str, hot: DataFrame, spread: str, how: str = "left"
) -> DataFrame:
    """Join on ``key`` with each hot key's rows spread over several partitions.

    Fact rows of a hot key get a salt from ``spread`` (a column with many
    values); the lookup row of a hot key is repeated once per salt. Rows with
    other keys have salt 0 on both sides, so the result equals the plain join.
    Rows without a key match nothing and are spread by the whole hash.
    """
    small = F.broadcast(hot)  # bounded by hot_keys
    hashed = F.xxhash64(F.col(spread))
    salt = (
        F.when(F.col(key).isNull(), hashed)
        .when(F.col("_fan").isNotNull(), F.pmod(hashed, F.col("_fan")))
        .otherwise(F.lit(0).cast("bigint"))
    )
    left = fact.join(small, key, "left").withColumn("_salt", salt).drop("_fan")
    one = F.lit(1).cast("bigint")
    copies = F.sequence(one - one, F.coalesce(F.col("_fan"), one) - one)
    right = lookup.join(small, key, "left").withColumn("_salt", F.explode(copies)).drop("_fan")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    key: str,
    spread: str,
    broadcast_rows: int | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Left join to a lookup table: broadcast when measured small, salted otherwise.

    Salting needs the hot keys, which take a pass over the key column.
    ``keys_from`` names a frame that holds the same keys but is cheaper to
    read, such as the fact before an earlier join.
    """
    if is_small(lookup, broadcast_rows):
        return fact.join(F.broadcast(lookup), key, "left")
    keys = fact if keys_from is None else keys_from
    counts = keys.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    hot = scratch.durable(hot_keys(counts, key), "hot-keys")
    return salted_join(fact, lookup, key, hot, spread)


def matches_or_alone(
    dim: DataFrame, fact: DataFrame, key: str, spread: str, broadcast_rows: int | None = None
) -> DataFrame:
    """Left join from a dimension to its fact rows: every match, and unmatched dimension rows once.

    The match is made from the fact side, where hot keys can be spread; the
    unmatched rows are found from the distinct keys.
    """
    known = dim.withColumn("_known", F.lit(True))
    matched = lookup_join(fact, known, key, spread, broadcast_rows).where("_known").drop("_known")
    alone = dim.join(fact.select(key).distinct(), key, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def insert_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus those ``rows`` whose key it lacks; rows already there stay as they are.

    A key given several times in ``rows`` is inserted once. Only the target's
    keys take part in the look-up, first narrowed to the keys being inserted.
    """
    fresh = rows.dropDuplicates(keys)
    present = target.select(*keys).join(fresh.select(*keys), keys, "left_semi")
    return target.unionByName(fresh.join(present, keys, "left_anti"))


def share_of_total(df: DataFrame, amount: str, total: Column | None = None) -> Column:
    """``amount`` as percent of its sum over all rows, the sum taken in its own aggregation."""
    whole = total if total is not None else df.agg(F.sum(amount)).scalar()
    return F.col(amount).cast("double") * 100.0 / whole
