"""Mixing sources to target weights: fixed-length blocks of words, drawn for output shards.

The words of a source, document after document in a pseudorandom order, are cut into blocks of ``block`` words. Each
output shard of ``shard`` slots draws its slots' sources: a multinomial draw of the source counts by the targets'
shares, under the condition that all shards together take of every source the blocks its target asks for (to the
rounding of one block; free draws could exceed ``most`` times a source). For that the slots of all shards are drawn
without replacement, by a pseudorandom permutation of their numbers. A source's slots run through its blocks by a
pseudorandom permutation of the block numbers, another for each pass, so no block is taken twice more often than
another, and slots and blocks are joined by number. Everything is a DataFrame expression; randomness is a hash of the
seed, so reruns agree.

Sources in order of code points, null last, weigh 1, 2, 3, repeating; a target stops at ``most`` times the source's
words, and the excess is shared by weight among the others. Null text has no words. Rows with the same id are rows of
their own only if their texts differ; equal rows share a key and are packed one after the other. An empty table gives
an empty result; without any words targets and takes are zero. A very long text is many blocks of one document. Other
columns are not read by ``mixed_documents``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.sources.scratch import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Documents that get their places in a source together, on average.
LOT = 1000
#: Rounds of the permutation.
ROUNDS = 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: int = 3, most: float = 3.0) -> DataFrame:
    """Rows ``source``, ``source_size`` to ``source_no``, ``weight``, ``target``: one row per source, few of them.

    With sources in order of cap over weight, those before the first that stays below its cap are capped.
    """
    numbered = sizes.withColumn("source_no", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    rows = numbered.withColumn("weight", ((F.col("source_no") - 1) % weights + 1).cast("double")).withColumn("cap", F.col("source_size") * most)
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(whole).cast("double")
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    share = left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("share", share)
    # The share of the first source that its cap doesn't stop holds for all after it.
    free = F.when(F.col("cap") >= F.col("weight") * F.col("share"), F.struct(F.col("cap") / F.col("weight"), "source_no", "share"))
    level = F.min(free).over(whole)["share"]
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce(level, F.lit(0.0)))
    return rows.withColumn("target", target).select("source", "source_size", "source_no", "weight", "target")


def _hash(seed: int, *cols: Column) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def _unit(h: Column) -> Column:
    """A hash as a number from 0 up to 1."""
    return h.bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def permuted(index: Column, size: Column, seed: int, *keys: Column) -> Column:
    """A pseudorandom permutation of 0 .. size - 1: in each round a number and its partner swap, or not, by a hash."""

    def swap(x: Column, k: Column) -> Column:
        partner = F.pmod(F.pmod(_hash(seed, F.lit(1), k, *keys), size) - x, size)
        return F.when(_hash(seed, F.lit(2), k, F.greatest(x, partner), *keys) % 2 == 0, x).otherwise(partner)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, swap)


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that is computed once per row, however often later expressions use it."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def placed(docs: DataFrame, targets: DataFrame, text_col: str, source_col: str, keys: list[str], seed: int) -> DataFrame:
    """``docs`` with ``size`` joined to their source's row, and ``place``: the words of the source before them.

    Places are counted in lots of about LOT documents, then lot after lot: no task holds a source.
    """
    n = docs.count()
    lots = max(1, -(-n // LOT))
    rows = docs.join(targets.withColumnRenamed("source", "own_source"), F.col(source_col).eqNullSafe(F.col("own_source")))
    rows = rows.withColumn("lot", F.pmod(_hash(seed, *(F.col(k) for k in keys)), F.lit(lots)))
    by_lot = rows.groupBy("source_no", "lot").agg(F.sum("size").alias("lot_size"))
    earlier = Window.partitionBy("source_no").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    by_lot = by_lot.select("source_no", "lot", F.coalesce(F.sum("lot_size").over(earlier), F.lit(0)).alias("lot_place"))
    inside = Window.partitionBy("source_no", "lot").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("in_lot", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.join(by_lot, ["source_no", "lot"]).withColumn("place", F.col("lot_place") + F.col("in_lot"))


def slots(targets: DataFrame, block: int, shard: int, seed: int) -> DataFrame:
    """``source_no``, ``pass``, ``index``, ``shard``, ``slot``: which block each slot of each output shard holds."""
    plan = targets.where("source_size > 0").withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    plan = plan.withColumn("wanted", F.round(F.col("target") / F.col("source_size") * F.col("blocks")).cast("long"))
    plan = plan.withColumn("upto", F.sum("wanted").over(Window.orderBy("source_no")))
    # The sources' shares, one entry per source: every slot of every shard draws from them.
    shares = F.sort_array(F.collect_list(F.struct("upto", "source_no", "blocks", "wanted")))
    total = plan.agg(F.max("upto")).first()[0] or 0
    shards = targets.sparkSession.range(-(-total // shard)).select(F.col("id").alias("shard"))
    one = shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(shard - 1))).alias("slot")).withColumn("number", F.col("shard") * shard + F.col("slot"))
    one = one.where(F.col("number") < total)
    one = _once(one, "draw", permuted(F.col("number"), F.lit(total), seed, F.lit("draw"))).withColumn("shares", plan.agg(shares).scalar())
    one = _once(one, "own", F.element_at(F.filter("shares", lambda s: s["upto"] > F.col("draw")), 1))
    one = _once(one.select("shard", "slot", "draw", "own.*"), "turn", F.col("draw") - F.col("upto") + F.col("wanted"))
    one = _once(one, "pass", F.floor(F.col("turn") / F.col("blocks")))
    index = permuted(F.pmod("turn", "blocks"), F.col("blocks"), seed, F.col("source_no"), F.col("pass"))
    return one.select("source_no", "pass", index.alias("index"), "shard", "slot")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = 64, shard: int = 1024, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """Documents with ``size``, ``source_size``, ``target`` and their ``key`` and ``place``; and the pieces taken.

    A piece (``shard``, ``slot``, ``pass``, ``key``, ``start``, ``length``) is a run of words of a document in a slot.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), F.xxhash64(id_col, text_col, source_col).alias("key"))
    rows = cut(rows, "sizes")
    targets = cut(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    laid = cut(placed(rows, targets, "text", "source", ["key"], seed), "laid")
    first, last = F.floor(F.col("place") / block), F.floor((F.col("place") + F.col("size") - 1) / block)
    blocks = laid.where("size > 0").select("source_no", "key", "place", "size", F.explode(F.sequence(first, last)).alias("index"))
    begin = F.greatest(F.col("index") * block, F.col("place"))
    end = F.least((F.col("index") + 1) * block, F.col("place") + F.col("size"))
    blocks = blocks.select("source_no", "index", "key", "place", (begin - F.col("place")).alias("start"), (end - begin).alias("length"))
    # Both sides grow with the input; the optimizer's guess of a range that is exploded would be far too small.
    pieces = slots(targets, block, shard, seed).hint("merge").join(blocks, ["source_no", "index"])
    return laid, pieces


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = 64, seed: int = 7) -> DataFrame:
    """``id_col``, ``size``, ``source_size``, ``target``, ``taken``: how many words of each document the mix takes."""
    laid, pieces = mix(docs, id_col, text_col, source_col, block, seed=seed)
    taken = pieces.groupBy("key", "place").agg(F.sum("length").alias("taken"))
    out = laid.join(taken, ["key", "place"], "left").where("size > 0").unionByName(laid.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = 64, seed: int = 7) -> DataFrame:
    """``docs`` as the mix takes them: each text is the words taken of it, pass by pass and in their order.

    Words that follow one another in the document are joined by one space; where words between them are not taken, or
    another pass begins, a new line does. So each line is a run of the document's words. Documents the mix takes nothing of are not in it; equal rows come as one, with the words taken of all of them.
    """
    _, pieces = mix(docs, id_col, text_col, source_col, block, seed=seed)
    taken = pieces.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("pass", "start", "length"))).alias("taken"))
    key = F.xxhash64(id_col, text_col, source_col)
    rows = docs.select(F.struct(*docs.columns).alias("row"), key.alias("key")).join(taken, "key")
    rows = rows.withColumn("number", F.row_number().over(Window.partitionBy("key").orderBy("key"))).where("number = 1")
    rows = _once(rows, "words", F.regexp_extract_all(F.col(f"row.`{text_col}`"), F.lit(WORD), F.lit(0)))

    def run(piece: Column, at: Column) -> Column:
        before = F.get("taken", at - 1)
        follows = (before["pass"] == piece["pass"]) & (before["start"] + before["length"] == piece["start"])
        own = F.array_join(F.slice("words", (piece["start"] + 1).cast("int"), piece["length"].cast("int")), " ")
        return F.concat(F.when(at == 0, "").when(follows, " ").otherwise("\n"), own)

    text = F.array_join(F.transform("taken", run), "")
    return rows.withColumn("row", F.col("row").withField(f"`{text_col}`", text)).select("row.*")
