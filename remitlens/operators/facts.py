"""Transfer → fact rows, the flow self-join, shard union/dedup and copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions import scalars as S


def export_join(transfers: DataFrame, users: DataFrame) -> DataFrame:
    """transactions ⋈ sender (account+user) ⋈ receiver (account+user), inner.

    ``users`` carries one account per user (user_id, account_number, province,
    district, full_name). Both joins are equi-joins on a key of ``users``; AQE
    turns them into broadcast joins at runtime when the measured user side is
    small and keeps sort-merge otherwise, and splits a hot sender partition.
    """
    s = users.select(
        F.col("user_id").alias("from_id"), F.col("user_id").alias("from_user_id"),
        F.col("account_number").alias("from_account"), F.col("full_name").alias("from_name"),
        F.col("province").alias("from_province"), F.col("district").alias("from_district"))
    r = users.select(
        F.col("user_id").alias("to_id"), F.col("user_id").alias("to_user_id"),
        F.col("account_number").alias("to_account"), F.col("full_name").alias("to_name"),
        F.col("province").alias("to_province"), F.col("district").alias("to_district"))
    return transfers.join(s, "from_id").join(r, "to_id")


def normalized_places(users: DataFrame) -> DataFrame:
    """``users`` with province and district normalised: once per user instead of
    on both rows of every transfer (``fact_geo_explode(..., normalize_locations=False)``)."""
    return users.withColumns({c: S.normalize_location(F.col(c)) for c in ("province", "district")})


def fact_geo_explode(geo: DataFrame, normalize_locations: bool = True) -> DataFrame:
    """One transfer → an OUT row at the sender's location and an IN row at the receiver's.

    Single scan + ``explode`` of a two-element array (no self-union). Adds the
    partition values year, quarter ('Qn') and month ('yyyy-MM'). Provinces and
    districts are normalised ('Hà Nội' → 'HaNoi') unless the users' were before
    the join (``normalized_places``).
    """
    out_row = F.struct(
        F.col("from_user_id").alias("owner_user_id"), F.col("from_account").alias("owner_account_id"),
        F.lit("OUT").alias("direction"), F.col("to_account").alias("counterparty_account_id"),
        F.col("from_province").alias("province"), F.col("from_district").alias("district"))
    in_row = F.struct(
        F.col("to_user_id").alias("owner_user_id"), F.col("to_account").alias("owner_account_id"),
        F.lit("IN").alias("direction"), F.col("from_account").alias("counterparty_account_id"),
        F.col("to_province").alias("province"), F.col("to_district").alias("district"))
    sides = geo.select("transaction_id", "amount", "status", "created_at",
                       F.explode(F.array(out_row, in_row)).alias("side"))

    def loc(c):  # after the explode, so each row is normalised once
        return S.normalize_location(F.col(f"side.{c}")) if normalize_locations else F.col(f"side.{c}")

    return sides.select("transaction_id", "side.owner_user_id", "side.owner_account_id", "side.direction",
                        "side.counterparty_account_id", "amount", "status", "created_at",
                        loc("province").alias("province"), loc("district").alias("district"),
                        F.year("created_at").alias("year"), S.quarter_of(F.col("created_at")).alias("quarter"),
                        S.month_of(F.col("created_at")).alias("month"))


def flow_join(fact: DataFrame) -> DataFrame:
    """OUT and IN sides of each transfer → (transaction_id, from_province, to_province, amount).

    One shuffle and one sort on (transaction_id, direction) instead of a
    two-sided join. A duplicated side keeps one whole row: the latest by
    created_at (an unparsable time comes last), then the smallest province and
    amount. Transfers that miss a side drop; the time itself is not needed.
    """
    sides = fact.where(F.col("direction").isin("OUT", "IN") & F.col("transaction_id").isNotNull()) \
        .select("transaction_id", "direction", "created_at", "province", "amount")
    ordered = Window.partitionBy("transaction_id").orderBy(
        "direction", F.col("created_at").desc_nulls_last(), "province", "amount")
    first = sides.withColumn("_before", F.lag("direction").over(ordered)) \
        .where(F.col("_before").isNull() | (F.col("_before") != F.col("direction")))
    by_side = Window.partitionBy("transaction_id").orderBy("direction")  # IN, then OUT
    return (first.select("transaction_id", "direction", F.col("province").alias("to_province"),
                         F.lead("province").over(by_side).alias("from_province"),
                         F.lead("amount").over(by_side).alias("amount"),
                         F.lead("direction").over(by_side).alias("_next"))
            .where((F.col("direction") == "IN") & (F.col("_next") == "OUT"))
            .select("transaction_id", "from_province", "to_province", "amount"))


def shard_tag(transfers: DataFrame, users: DataFrame) -> DataFrame:
    """Regional shards: every transfer in its sender's region, plus one SUCCESS copy
    in the receiver's region when that differs (cross-region copy)."""
    region = users.select("user_id", "region")
    t = (transfers
         .join(region.withColumnRenamed("user_id", "from_id").withColumnRenamed("region", "from_region"), "from_id")
         .join(region.withColumnRenamed("user_id", "to_id").withColumnRenamed("region", "to_region"), "to_id"))
    # One pass over the tagged transfers: each emits its home row and, when the
    # regions differ, its copy (instead of two union branches re-running the joins).
    home = F.struct(*[F.col(c) for c in transfers.columns], F.col("from_region").alias("shard"))
    copy = F.when(F.col("from_region") != F.col("to_region"),
                  F.struct(*[F.lit("SUCCESS").alias(c) if c == "status" else F.col(c) for c in transfers.columns],
                           F.col("to_region").alias("shard")))
    return (t.select(F.explode(F.array(home, copy)).alias("r")).where(F.col("r").isNotNull())
            .select(*[F.col(f"r.{c}").alias(c) for c in transfers.columns], F.col("r.shard").alias("shard")))


def cross_region_copy(tagged: DataFrame, columns: list[str], existing: DataFrame | None = None,
                      key: str = "transaction_id") -> DataFrame:
    """Copy of each cross-region transfer for the receiver's shard, status SUCCESS;
    none for an id that the receiver's shard holds already (``existing``: key, shard)."""
    copies = (tagged.where(F.col("from_region") != F.col("to_region"))
              .select(*[F.lit("SUCCESS").alias(c) if c == "status" else F.col(c) for c in columns],
                      F.col("to_region").alias("shard")))
    return copies if existing is None else copies.join(existing.select(key, "shard"), [key, "shard"], "left_anti")


def export_union_dedup(shards: DataFrame, shard_order: list[str], key: str = "transaction_id") -> DataFrame:
    """Union of regional extracts de-duplicated by id; the last shard in ``shard_order`` wins.

    Top-1 per key (``row_number() = 1``): Spark trims each key map-side before
    the one shuffle. Equal ids in one shard are ordered by their other columns.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in shard_order]), F.col("shard"))
    cols = [c for c in shards.columns if c != key]
    w = Window.partitionBy(key).orderBy(rank.desc(), *cols)
    return (shards.withColumn("_turn", F.row_number().over(w)).where(F.col("_turn") == 1)
            .select(key, *cols))
