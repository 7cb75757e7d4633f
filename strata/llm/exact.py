"""Exact duplicates by progressive refinement: length, hash of the beginning, hash of the whole.

Only DataFrame functions. The first pass keeps two numbers per document. Lengths, and pairs of
length and beginning, that occur once are out; the others become a bitmap of a fixed size,
so that the second pass knows, document by document and without moving texts, whose whole
content has to be hashed. A wrong hit in the bitmap costs one more hash and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, attach, fresh, picked, within, without
from strata.scratch import materialise

HEAD = 256
# Size of the bitmap; 2^24 bits are 2 MB on every executor.
FILTER_BITS = 1 << 24


def normalised(text: Column) -> Column:
    """White space as one space each; NULL is an empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _slot(bits: int) -> Column:
    return F.pmod(F.xxhash64("_length", "_head"), F.lit(bits)) + 1


def _is_set() -> Column:
    """Whether the bit of ``_slot`` is set in ``_bits``; a missing bitmap has none."""
    place = "bitmap_bit_position(_slot)"
    byte = f"conv(hex(substring(_bits, cast({place} div 8 as int) + 1, 1)), 16, 10)"
    bit = f"shiftright(cast({byte} as int), cast({place} % 8 as int)) & 1"
    return F.expr(f"coalesce({bit} = 1, false)")


def _keyed(rows: DataFrame, head: int) -> DataFrame:
    return rows.withColumn("_norm", normalised(F.col("_text"))).withColumns(
        {
            "_length": F.octet_length("_norm"),
            "_head": F.xxhash64(F.substring("_norm", 1, head)),
        }
    )


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    head: int = HEAD,
    filter_bits: int = FILTER_BITS,
    digests: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, keep_id, group_size, kept.

    Texts are equal when they are the same after :func:`normalised`; the row with the smallest
    key stays. NULL and empty texts are equal to each other. A NULL key never wins against
    another; where a group has only NULL keys, keep_id is NULL and its rows are kept. Rows that
    repeat key and text all say kept here, and :func:`exact_dedup` keeps one of them. With
    ``digests`` the SHA-256 of every normalised text is a further column, text_sha256.
    """
    rows = picked(docs, _key=key, _text=text)
    first = materialise(_keyed(rows, head).select("_length", "_head"), "exact-heads")
    # A length that occurs once has no beginning that occurs twice: one grouping does both steps,
    # and documents of one length are counted in the map tasks and never meet in one.
    heads = first.groupBy("_length", "_head").count()
    slots = heads.filter("count > 1").select(_slot(filter_bits).alias("_slot"))
    bitmap = slots.groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits")
    )
    second = _keyed(rows, head).withColumn("_slot", _slot(filter_bits))
    second = second.withColumn("_bucket", F.bitmap_bucket_number("_slot"))
    second = second.join(F.broadcast(bitmap), "_bucket", "left")
    second = second.withColumn("_survives", _is_set())
    whole = F.sha2("_norm", 256)
    second = second.select(
        "_key",
        "_survives",
        (whole if digests else F.when(F.col("_survives"), whole)).alias("_hash"),
    )
    second = materialise(second, "exact-hashes")
    alive = second.filter("_survives")
    groups = alive.groupBy("_hash").agg(
        F.min("_key").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    groups = groups.filter("group_size > 1")
    found = attach(alive, groups, "_hash", "group_size", ["_key"], second.count())
    single = second.filter("NOT _survives").withColumns(
        {"keep_id": F.lit(None).cast(docs.schema[key].dataType), "group_size": F.lit(None).cast("long")}
    )
    both = found.unionByName(single)
    keep = F.when(F.col("group_size").isNull(), F.col("_key")).otherwise(F.col("keep_id"))
    result = both.select(
        F.col("_key").alias(key),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_key").eqNullSafe(keep).alias("kept"),
        F.col("_hash").alias("text_sha256"),
    )
    return result if digests else result.drop("text_sha256")


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without later copies, columns as they are; see :func:`exact_groups`.

    Of rows that repeat both key and text one stays. Where keys are unique and never NULL,
    whole texts are hashed only where the refinement has left them; otherwise rows are told
    apart by key and hash, so all are hashed. NULL and empty texts are copies of each other, long
    texts are compared whole, an empty table stays empty, and columns may have any name.
    """
    groups = materialise(exact_groups(docs, key, text), "exact-groups")
    dropped = groups.filter("NOT kept")
    unsure = groups.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1))
    if unsure.isEmpty():
        return without(docs, dropped.select(key), {key: F.col(key)})
    groups = materialise(exact_groups(docs, key, text, digests=True), "exact-groups")
    names = {key: F.col(key), "text_sha256": F.sha2(normalised(F.col(text)), 256)}
    kept = without(docs, groups.filter("NOT kept"), names)
    repeated = groups.filter("kept").groupBy(key, "text_sha256").count().filter("count > 1")
    repeated = materialise(repeated, "exact-repeated")
    if repeated.isEmpty():
        return kept
    marks = {fresh(docs, f"_{n}"): c for n, c in names.items()}
    again = within(kept, repeated, names).withColumns(marks)
    once = again.dropDuplicates(list(marks)).select(*docs.columns)
    return without(kept, repeated, names).unionByName(once)
