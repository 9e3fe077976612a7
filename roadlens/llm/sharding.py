"""Sharding by vector bin packing: bytes, words and rows of every shard stay close together.

Rows with equal text form a group. A group is placed whole unless it is larger than an eighth of a
shard; then its rows are dealt in turn to pieces of that size, so no shard has to take it all.
Groups that are larger than a *parcel* are items of their own, all others are gathered in a fixed
number of parcels by the hash of their text. Items are placed one by one, the largest first, each on
the shard with the highest dot product of its vector with the shard's residual capacity.

The items are bounded: ``parcels`` gathered ones, and large pieces, of which there can be no more than
``2 * dims * parcels`` since each takes a parcel's share of the whole in one dimension. They are the
only thing that reaches the driver. Rows meet their shard through a join on the item's key, and get
their slot from totals of hash ranges, so no shard has to be ordered in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.frames import masked, running_total, stored, table, words_in

PIECES_PER_SHARD = 8
DIMS = ("_bytes", "_words", "_rows")


def pack(items: pd.DataFrame, n_shards: int) -> np.ndarray:
    """The shard of every item (columns ``DIMS``), largest first, by the best fit of the dot product.

    Only shards that keep to their capacity in every dimension are asked; if none does, the one with
    the fewest bytes takes the item. Ties go to the lowest shard.
    """
    size = items[list(DIMS)].to_numpy(dtype=float)
    total = size.sum(axis=0)
    share = size / np.where(total > 0, total, 1) * n_shards
    order = np.lexsort((np.arange(len(items)), -share.sum(axis=1), -share.max(axis=1)))
    load = np.zeros((n_shards, len(DIMS)))
    shard = np.zeros(len(items), dtype=int)
    for i in order:
        after = load + share[i]
        fits = (after <= 1).all(axis=1)
        if fits.any():
            fit = np.where(fits, (1 - load) @ share[i], -np.inf)
            best = int(fit.argmax())
        else:
            best = int(np.lexsort((after.max(axis=1), after[:, 0]))[0])
        load[best] = after[best]
        shard[i] = best
    return shard


def place(
    docs: DataFrame, n_shards: int = 40, parcels_per_shard: int = 128, id_col: str = "doc_id", text_col: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard and slot (gapless from 0 in a shard).

    ``carry`` names columns of ``docs`` to take along in a struct ``_row``. A null text is the empty one for grouping, has size 16 and crc32 0. Null ids share one hash;
    repeated rows get slots of their own. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("_text"),
            words_in(text_col).alias("_words"),
            *([F.struct(*[F.col(c) for c in carry]).alias("_row")] if carry else []),
        ),
        "shard-rows",
    )
    parcels = n_shards * parcels_per_shard
    key = ["_text", "text_crc32"]
    groups = rows.groupBy(*key).agg(
        F.sum("size").alias("_bytes"), F.sum("_words").alias("_words"), F.count("*").alias("_rows")
    )
    whole = groups.agg(*[F.sum(d).alias(d) for d in DIMS]).first()
    share = F.greatest(*[F.col(d) * (parcels / max(whole[d] or 0, 1)) for d in DIMS])
    parcel = F.pmod(F.col("_text"), F.lit(parcels)).cast("int")
    groups = groups.withColumn("_share", share)
    large = groups.filter("_share > 1").withColumn(
        "_pieces", F.least(F.ceil(F.col("_share") / (parcels_per_shard / PIECES_PER_SHARD)), F.col("_rows")).cast("int")
    )
    in_piece = F.floor((F.col("_rows") + F.col("_pieces") - 1 - F.col("_piece")) / F.col("_pieces"))
    pieces = large.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))).select(
        *key, "_pieces", "_piece", F.lit(-1).alias("_parcel"),
        *[(F.col(d) / F.col("_rows") * in_piece).alias(d) for d in DIMS],
    )
    gathered = groups.filter("_share <= 1").groupBy(parcel.alias("_parcel")).agg(
        *[F.sum(d).cast("double").alias(d) for d in DIMS]
    )
    items = (
        pieces.unionByName(gathered, allowMissingColumns=True)
        .orderBy("_parcel", *key, "_piece")
        .withColumns({k: F.col(k).cast("string") for k in key})  # whole numbers would turn into floats
        .toPandas()
    )
    items["shard"] = pack(items, n_shards)
    spark = docs.sparkSession
    of_parcel = items.loc[items["_parcel"] >= 0, ["_parcel", "shard"]]
    of_piece = items.loc[items["_parcel"] < 0]
    lists = of_piece.groupby(["_text", "text_crc32"], as_index=False).agg(_shards=("shard", list))
    small = spark.createDataFrame(of_parcel.values.tolist(), "_parcel int, _small int")
    apart = spark.createDataFrame(lists.values.tolist(), "_t string, _c string, _shards array<int>")
    same = (F.col("_text") == F.col("_t").cast("long")) & (F.col("text_crc32") == F.col("_c").cast("long"))
    order = F.md5(F.concat_ws("/", F.col("doc_id").cast("string"), F.col("_text").cast("string")))
    found = (
        rows.withColumn("_parcel", parcel)
        .withColumn("_order", order)
        .join(F.broadcast(small), "_parcel", "left")
        .join(F.broadcast(apart), same, "left")
    )
    dealt = running_total(
        found.filter(F.size("_shards") > 1), ["_text", "text_crc32"], ["_order", "doc_id"],
        F.lit(1).cast("long"), "_ordinal", buckets=256,
    )
    in_turn = F.element_at("_shards", F.pmod(F.col("_ordinal"), F.size("_shards").cast("long")).cast("int") + 1)
    whole_groups = found.filter("_shards is null or size(_shards) = 1")
    placed = dealt.withColumn("shard", in_turn).unionByName(
        whole_groups.withColumn("shard", F.coalesce(F.element_at("_shards", 1), F.col("_small"))), allowMissingColumns=True
    )
    return running_total(
        placed, ["shard"], ["_order", "doc_id", "text_crc32", "size"], F.lit(1).cast("long"), "slot", buckets=256
    ).select("doc_id", "size", "text_crc32", "shard", "slot", *(["_row"] if carry else []))


def into_shards(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``shard`` and ``slot`` as last columns.

    If ``docs`` has columns of these names, they are replaced.
    """
    rows, names = masked(docs.drop("shard", "slot"))
    placed = place(rows, n_shards, id_col=names[id_col], text_col=names[text_col], carry=list(names.values()))
    return placed.select([F.col(f"_row.{new}").alias(old) for old, new in names.items()] + ["shard", "slot"])


def op7_sharding(spark, sf_dir) -> DataFrame:
    """All documents in 40 shards of near equal sizes; the law is ``bytes``."""
    return place(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
