"""Exact deduplication by progressive refinement, with DataFrame operations only.

Rows are grouped by length, then by a hash of the first characters; only rows that still share both with another row
have their full content hashed. What one step hands to the next is a bitmap of fixed size, so no text is ever shuffled
and nothing that grows with the corpus is broadcast. A set bit that no group owns costs a hash, never a wrong answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_join
from .common import WHITE_SPACE, row_number, steady, whole_text, without_rows, written

#: Bits in one row of the bitmap; fixed by bitmap_construct_agg, which returns 4096 bytes.
ROW_BITS = 32768


def normalised(text_col: str) -> Column:
    return F.translate(whole_text(text_col), WHITE_SPACE, "")


def _bitmap(slots: DataFrame) -> DataFrame:
    """One row for each ROW_BITS slots: _at, and the slots present as bits."""
    return slots.groupBy(F.expr(f"_slot div {ROW_BITS}").alias("_at")).agg(F.bitmap_construct_agg(F.col("_slot") % ROW_BITS).alias("_bits"))


def _bit(slot: Column, bits: Column) -> Column:
    """Whether the bitmap row has the slot's bit; null without a row."""
    inside = slot % ROW_BITS
    byte = F.conv(F.hex(bits.substr((F.floor(inside / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return (F.floor(byte / F.pow(F.lit(2.0), inside % 8)) % 2) == 1


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None, prefix_chars: int = 64, bitmap_bits: int = 1 << 24) -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, then the columns of carry (expressions on docs).

    Texts are equal when identical after deleting all of [\\x20\\x09-\\x0D]; a null text counts as empty, so null, empty
    and blank texts form one group. The row with the most code points in its original text stays, then the smallest id;
    a null id comes after all others. Of repeated rows (same id and text) the first one read stays. An empty table
    gives an empty result. Other columns of docs don't matter. A text of any length is hashed where it is read, so that
    it costs its own task a pass over it and no shuffle. The broadcast bitmap has bitmap_bits / 8 bytes at most.
    """
    norm, text = normalised(text_col), whole_text(text_col)
    length, prefix = F.octet_length(norm), F.xxhash64(F.substring(norm, 1, prefix_chars))
    # The id of a row within its scan: the same in both passes, since both read the same splits.
    numbered = steady(docs).withColumn("_row", row_number())

    keys = written(numbered.select(length.alias("_len"), prefix.alias("_pre")), "exact-keys")
    # Rows are counted by length and prefix before they are shuffled, so that a frequent length is a few rows only.
    counts = keys.groupBy("_len", "_pre").count()
    same_length = counts.groupBy("_len").agg(F.sum("count").alias("rows")).where("rows > 1").select("_len")
    same_prefix = counts.where("count > 1").join(same_length, "_len", "left_semi")
    slot = F.pmod(F.xxhash64("_len", "_pre"), F.lit(bitmap_bits))
    bitmap = F.broadcast(_bitmap(same_prefix.select(slot.alias("_slot"))))

    extra = carry or {}
    rows = (
        numbered.select("_row", F.col(id_col).alias("_id"), F.length(text).alias("_chars"), norm.alias("_norm"), length.alias("_len"), prefix.alias("_pre"), *(c.alias(k) for k, c in extra.items()))
        .withColumn("_slot", slot)
        .withColumn("_at", F.expr(f"_slot div {ROW_BITS}"))
        .join(bitmap, "_at", "left")
        .select("_row", "_id", "_chars", F.when(_bit(F.col("_slot"), F.col("_bits")), F.sha2("_norm", 256)).alias("_full"), *extra)
    )
    rows = written(rows, "exact-rows")

    order = F.struct((-F.col("_chars")).alias("chars"), F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    groups = written(rows.where("_full is not null").groupBy("_full").agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_best")).where("_n > 1"), "exact-groups")
    # Rows without a full hash are known to be alone; of the others, a large group's rows are found by a broadcast.
    alone = rows.where("_full is null").withColumns({"_n": F.lit(None).cast("long"), "_best": F.lit(None).cast(groups.schema["_best"].dataType)})
    shared = hot_join(rows.where("_full is not null"), groups, ["_full"], "_n", "left").select(alone.columns)
    return alone.union(shared).select(
        F.col("_id").alias(id_col),
        F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_best.id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).alias("group_size"),
        (F.col("_n").isNull() | (F.col("_best.row") == F.col("_row"))).alias("kept"),
        *extra,
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs less the rows that exact_dedup drops; the columns stay as they are."""
    docs = steady(docs)
    return without_rows(docs, exact_dedup(docs, id_col, text_col, {"_key": row_number()}).where("not kept"))
