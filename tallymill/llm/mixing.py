"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Slot ``j`` of the mix has the point ``frac((j + 1) * golden ratio)``; the source in whose part of
the cumulative targets the point falls gets the slot. The slots of a source are ranked, its
documents are shuffled and laid end to end, and its r-th slot takes the r-th block of words.
A source starts over when it has been used up. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallymill.session import written_table

#: Weights by the order of the sources, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix per word of the input, and the most often a document may be used.
SHARE = 1.5
REPEATS = 2
#: Words of a slot; slots that are ranked together; documents that are laid out together, on average.
BLOCK = 64
CHUNK = 1 << 16
LAID = 4096
#: Equal parts of the unit interval by which points find their source.
CELLS = 256
GOLDEN = 0.6180339887498949
SALT = "mix"


def words(text: Column) -> Column:
    """Words of a text, cut at ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(sid, source, source_size, target) from (source, source_size); sid numbers the sources.

    Targets go by weight but stop at ``repeats`` times the size of their source; what is above
    is shared out again by weight until nothing is. That level is found in one pass: in the
    order of size per weight, the sources that stop come first. One row per source is all that
    these windows see.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    start, here, end = Window.unboundedPreceding, Window.currentRow, Window.unboundedFollowing
    sid = F.row_number().over(by_name)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (sid - 1) % len(weights) + 1)
    rows = sizes.select(sid.alias("sid"), "source", "source_size", weight.alias("weight"))
    rows = rows.withColumn("most", F.col("source_size") * float(repeats))
    total = F.sum("source_size").over(by_level.rowsBetween(start, end)) * share
    stopped = F.coalesce(F.sum("most").over(by_level.rowsBetween(start, -1)), F.lit(0.0))
    level = (total - stopped) / F.sum("weight").over(by_level.rowsBetween(here, end))
    rows = rows.withColumn("level", level).withColumn("stops", F.col("most") / F.col("weight") <= F.col("level"))
    common = F.max(F.when(~F.col("stops"), F.col("level"))).over(by_level.rowsBetween(start, end))
    target = F.when(F.col("stops"), F.col("most")).otherwise(F.col("weight") * common)
    return rows.select("sid", "source", "source_size", target.alias("target"))


def schedule(spark: SparkSession, goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, sid, rank): the block of the source that each slot of the mix takes.

    ``goals`` has (sid, target). A source is done when its blocks reach its target; its later
    slots stay empty. The few blocks for which a source got no point come at the end. Slots are
    ranked in chunks, then chunks are added up, so a source with a third of all slots is not
    one task.
    """
    by_sid = Window.orderBy("sid")
    share = F.sum("target").over(by_sid) / F.sum("target").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    parts = goals.where("target >= 1").withColumn("blocks", F.ceil(F.floor("target") / block))
    parts = parts.withColumn("upper", F.when(F.lead("sid").over(by_sid).isNull(), 1.0).otherwise(share))
    parts = parts.withColumn("lower", F.lag("upper", 1, 0.0).over(by_sid)).select("sid", "blocks", "lower", "upper")
    parts = written_table(parts.coalesce(1), "mix-parts")
    slots = parts.agg(F.sum("blocks")).first()[0] or 0

    def cell(c):
        return F.least(F.floor(F.col(c) * CELLS), F.lit(CELLS - 1))

    cells = parts.withColumn("cell", F.explode(F.sequence(cell("lower"), cell("upper"))))
    points = spark.range(0, slots, 1, max(1, -(-slots // (1 << 20)))).withColumnRenamed("id", "slot")
    points = points.withColumn("point", F.expr(f"pmod((slot + 1) * {GOLDEN}D, 1D)")).withColumn("cell", cell("point"))
    held = points.join(written_table(cells.coalesce(1), "mix-cells"), "cell").where("point >= lower and point < upper")
    held = held.select("slot", "sid", "blocks", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    chunks = written_table(held.groupBy("sid", "chunk").agg(F.count("*").alias("n")), "mix-chunks")
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot"))
    ranked = held.withColumn("inside", inside).join(starts, ["sid", "chunk"])
    ranked = ranked.select("slot", "sid", (F.col("first") + F.col("inside") - 1).alias("rank"), "blocks").where("rank < blocks")
    got = chunks.groupBy("sid").agg(F.sum("n").alias("got"))
    short = parts.join(got, "sid", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < blocks")
    short = short.select("sid", F.explode(F.sequence("got", F.col("blocks") - 1)).alias("rank"))
    late = F.lit(slots) + F.row_number().over(Window.orderBy("sid", "rank")) - 1
    return ranked.select("slot", "sid", "rank").unionByName(short.select(late.alias("slot"), "sid", "rank"))


def _laid(rows: DataFrame, digits: int) -> DataFrame:
    """``rows`` (sid, id, size, order) with ``at``: the words of the source before the document.

    Running sums go over the documents with the same leading digits of the order, then over
    those groups.
    """
    rows = rows.withColumn("head", F.substring("order", 1, digits))
    group = Window.partitionBy("sid", "head").orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = rows.groupBy("sid", "head").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("sid").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    rows = rows.withColumn("inside", F.sum("size").over(group) - F.col("size")).join(starts, ["sid", "head"])
    return rows.withColumn("at", F.col("first") + F.col("inside")).drop("head", "first", "inside")


class Mix:
    """A mix of documents: ``documents`` (one row each), ``pieces`` (what each slot takes).

    ``documents``: id, source, size, source_size, target, sid, at. ``pieces``: slot, sid, rank, id,
    at, size, from_word and words (the words ``from_word`` to ``from_word + words`` of the document),
    turn (0 the first time a source is used).

    Every source's pieces add up to its target, cut to whole words; none is used more than
    ``repeats`` times. Null sources are one source, ordered last; null and empty texts have size
    0 and no pieces. Repeated rows are rows of their own. The order depends on ids alone, so
    reruns agree. An empty table gives empty tables. Other columns of ``docs`` are not looked at.
    """

    def __init__(self, docs: DataFrame, id_column="doc_id", text_column="text", source_column="source", weights=WEIGHTS, share=SHARE, repeats=REPEATS, block=BLOCK):
        spark = docs.sparkSession
        rows = docs.select(F.col(id_column).alias("id"), F.col(source_column).alias("source"), words(F.col(text_column)).alias("size"))
        rows = written_table(rows, "mix-sizes")
        sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
        goals = written_table(targets(sizes, weights, share, repeats).coalesce(1), "mix-targets")
        n, digits = rows.count(), 1
        while 16**digits * LAID < n:
            digits += 1
        order = F.md5(F.concat_ws(":", F.lit(SALT), F.coalesce(F.col("id").cast("string"), F.lit(""))))
        rows = rows.withColumn("order", order).alias("r").join(goals.alias("g"), F.expr("r.source <=> g.source"))
        rows = rows.select("id", "r.source", "size", "source_size", "target", "sid", "order")
        self.documents = written_table(_laid(rows, digits).drop("order"), "mix-laid")
        turns = self.documents.where("size > 0 and target >= 1").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        turns = turns.withColumn("begin", F.col("turn") * F.col("source_size") + F.col("at"))
        turns = turns.withColumn("end", F.least(F.col("begin") + F.col("size"), F.floor("target"))).where("end > begin")
        ranks = F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block))
        parts = turns.select("id", "sid", "at", "size", "turn", "begin", "end", F.explode(ranks).alias("rank"))
        first, last = F.greatest("begin", F.col("rank") * block), F.least("end", (F.col("rank") + 1) * block)
        parts = parts.select("id", "sid", "at", "size", "turn", "rank", (first - F.col("begin")).alias("from_word"), (last - first).alias("words"))
        self.pieces = schedule(spark, goals.select("sid", "target"), block).join(parts, ["sid", "rank"])

    def taken(self) -> DataFrame:
        """``documents`` with what the slots take of each: ``taken`` words, repeats counted, in ``n_slots`` from ``first_slot`` on.

        A slot counts once for each turn in which it takes words of the document; ``first_slot`` is null for documents
        that the mix does not use.
        """
        measures = F.sum("words").alias("taken"), F.count("*").alias("n_slots"), F.min("slot").alias("first_slot")
        sums = self.pieces.groupBy("sid", "at", "size", "id").agg(*measures)
        same = F.expr("d.sid = s.sid and d.at = s.at and d.size = s.size and d.id <=> s.id")
        both = self.documents.alias("d").join(sums.alias("s"), same, "left")
        counts = [F.coalesce(f"s.{c}", F.lit(0)).alias(c) for c in ("taken", "n_slots")]
        return both.select("d.*", *counts, "s.first_slot")

    def uses(self) -> DataFrame:
        """``documents`` with ``uses``: for each turn in which it is used, where the mix comes to it (slot, rank, at)."""
        start = F.struct("slot", "rank", "at")
        turns = self.pieces.groupBy("sid", "at", "size", "id", "turn").agg(F.min(start).alias("start"))
        starts = turns.groupBy("sid", "at", "size", "id").agg(F.sort_array(F.collect_list("start")).alias("uses"))
        same = F.expr("d.sid = s.sid and d.at = s.at and d.size = s.size and d.id <=> s.id")
        return self.documents.alias("d").join(starts.alias("s"), same).select("d.*", "uses")
