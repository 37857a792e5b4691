"""Exact dedup: two passes of Bloom filtering, then a grouping of the rows that may be repeated.

Texts are equal when they are the same after each run of white space became one space; they are compared by the
SHA-256 of that form, made once per row where the text is read. The first pass counts, by aggregation, how many rows hit
each cell of a Bloom filter; cells hit twice become bitmaps of 4 KB. A row whose cells are not all hit twice occurs once.
The second pass tests every row against the bitmaps of its block: rows that may be repeated are shuffled and grouped by
their hash, the rest pass straight through. No repeated row is ever missed, and a row passed on by chance is a group of
one, so results are exact whatever the filter lets through.

The filter has ``CELLS_PER_ROW`` cells a row (about one row in seventy is passed on by chance) up to ``MAX_BLOCKS``
bitmaps, 256 MB, which bounds what is broadcast. Beyond some 130 million rows the share passed on by chance grows, up to
a plain grouping of all hashes. A cell hit by a third of all rows is counted in each task before the shuffle; so are
groups. Groups of over a ``HEAVY``-th of the rows passed on are ``HEAVY`` at most: those are broadcast, the other groups
meet their rows in a shuffle in which no hash holds more than that share.

Null text counts as empty. A null id comes after all others. Of rows with the same text and the same least id, any one
stays and the others are dropped, repeated rows included. Very long texts are hashed like others and never shuffled by
``duplicates``. An empty table gives an empty result. Other columns are not read by ``duplicates``, whatever their
names, and come back unchanged from ``keep_first``.

The number of rows is counted when a plan is made (``duplicates`` also writes its hashes below the shared folder).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.sources.scratch import cut

#: Cells of one bitmap, as ``bitmap_construct_agg`` makes them.
BLOCK = 32_768
CELLS_PER_ROW = 16
#: Cells of one row, all in one block.
PROBES = 2
#: Bitmaps of a filter at most: 65,536 of 4 KB are 256 MB.
MAX_BLOCKS = 1 << 16
#: A group of more than this part of all rows passed on is met by broadcast.
HEAVY = 1000


def normal_text(text: Column) -> Column:
    """Each run of white space (space, 0x09 to 0x0D) as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def text_hash(text: Column) -> Column:
    return F.sha2(normal_text(text), 256)


def _block(sha: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(sha), F.lit(blocks))


def _probes(sha: Column) -> list[Column]:
    """Places of a hash's cells in its block."""
    return [F.pmod(F.xxhash64(sha, F.lit(k)), F.lit(BLOCK)) for k in range(1, PROBES + 1)]


def filter_of(hashes: DataFrame, sha: str, n_rows: int) -> tuple[DataFrame, int]:
    """First pass: rows ``block``, ``bitmap`` of the cells hit by two rows or more, and the number of blocks.

    A row's cells are distinct, so that a row alone never hits a cell twice.
    """
    blocks = max(1, min(MAX_BLOCKS, -(-n_rows * CELLS_PER_ROW // BLOCK)))
    cells = hashes.select(_block(F.col(sha), blocks).alias("block"), F.explode(F.array_distinct(F.array(*_probes(F.col(sha))))).alias("at"))
    twice = cells.groupBy("block", "at").count().where("count > 1")
    return twice.groupBy("block").agg(F.bitmap_construct_agg("at").alias("bitmap")), blocks


def maybe_repeated(hashes: DataFrame, sha: str, bitmaps: DataFrame, blocks: int, name: str) -> DataFrame:
    """Second pass: ``hashes`` with the boolean ``name``, false where the row certainly occurs once."""

    def hit(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("__bitmap"), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10)
        return F.getbit(byte.cast("int"), F.pmod(at, F.lit(8)).cast("int")) == 1

    # MAX_BLOCKS bitmaps at most: the broadcast is bounded whatever the number of rows.
    held = F.broadcast(bitmaps.select(F.col("block").alias("__block"), F.col("bitmap").alias("__bitmap")))
    joined = hashes.join(held, _block(F.col(sha), blocks) == F.col("__block"), "left")
    first, *rest = [hit(at) for at in _probes(F.col(sha))]
    for other in rest:
        first = first & other
    return joined.withColumn(name, F.coalesce(first, F.lit(False))).drop("__block", "__bitmap")


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``keep_id`` (id of the row that stays), ``group_size``, ``kept``,
    ``text_sha256`` (of the normalised text)."""
    hashes = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("sha"), F.monotonically_increasing_id().alias("row"))
    # Row numbers hold from here on, and the texts are read once.
    hashes = cut(hashes, "hashes")
    bitmaps, blocks = filter_of(hashes, "sha", hashes.count())
    tested = cut(maybe_repeated(hashes, "sha", bitmaps, blocks, "maybe"), "tested")
    again = tested.where("maybe").drop("maybe")
    # The least id with nulls last, then any one row: the order of two structs is that of their fields.
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row"))
    groups = again.groupBy("sha").agg(F.min(order).alias("first"), F.count("*").alias("size"))
    groups = cut(groups.select("sha", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "size"), "groups")
    shared = groups.where("size > 1")
    passed = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    is_heavy = F.col("size") * HEAVY > passed
    heavy = shared.where(is_heavy).withColumnsRenamed({c: f"heavy_{c}" for c in groups.columns})
    by_heavy = again.join(F.broadcast(heavy), F.col("sha") == F.col("heavy_sha"), "left")
    met = by_heavy.where("heavy_sha is not null").select("id", "sha", "row", *[F.col(f"heavy_{c}").alias(c) for c in groups.columns if c != "sha"])
    light = by_heavy.where("heavy_sha is null").select("id", "sha", "row").join(shared.where(~is_heavy), "sha", "left")
    alone = tested.where("not maybe").select("id", "sha", "row", *[F.lit(None).cast(groups.schema[c].dataType).alias(c) for c in groups.columns if c != "sha"])
    rows = alone.unionByName(met).unionByName(light)
    found = F.col("size").isNotNull()
    return rows.select(
        F.col("id").alias(id_col),
        F.when(found, F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).alias("group_size"),
        (~found | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text another row of a smaller id has; all columns, unchanged.

    Rows that occur once are not shuffled. Of the others each task sends one row per text it holds.
    """
    sha, maybe, place = _fresh(docs, "__sha", "__maybe", "__place")
    hashed = docs.withColumn(sha, text_hash(F.col(text_col)))
    hashes = cut(hashed.select(F.col(sha).alias("sha")), "hashes")
    bitmaps, blocks = filter_of(hashes, "sha", hashes.count())
    bitmaps = cut(bitmaps, "bitmaps")
    tested = maybe_repeated(hashed, sha, bitmaps, blocks, maybe)
    order = Window.partitionBy(sha).orderBy(F.col(id_col).asc_nulls_last())
    first = tested.where(maybe).withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return tested.where(~F.col(maybe)).select(*docs.columns).union(first.select(*docs.columns))


def _fresh(docs: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns} | {"__block", "__bitmap"}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out
