"""Archives of JSON objects written one after the other, without anything between them.

The reader cuts at ``}{"``, so a large archive splits across tasks. Nearly every piece is whole objects but for the
brace and quote that the cut took. A text that ends in ``}{`` is cut as well: whether a cut lies in a text follows
from the quotes before it, an odd number of which opens one. Each split counts its own; what it does to the
state is one row, and a prefix scan over these rows tells every split what it begins with. Objects are then put
together from their own pieces alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.functions import jsons
from postlens.operators.explode import positioned_items
from postlens.session import written

CUT = '}{"'


def split_archives(df: DataFrame, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep, pos, value)``: the objects of archives that already arrive as text rows."""
    return positioned_items(df, F.coalesce(_objects(F.col(value)), jsons.split_concatenated(F.col(value))), "pos", "value", keep)


def archive_statuses(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row ``value`` per JSON object of the archive files.

    Objects may have white space between them; those are in one piece and are parted after the cut. What doesn't
    parse, such as an object whose end was never written, is a row as it stands, with the piece after it if
    that is in its text by the quotes; every piece that parses alone starts afresh. Pieces that don't parse are
    written once to the shared folder.
    """
    # What a file begins with has its own opening brace; nothing parses both with and without another.
    objects = F.coalesce(_objects(_opened(F.col("piece"))), F.when(F.col("split") == 0, _objects(F.col("piece"))))
    judged = _pieces(spark, paths).withColumn("objects", objects)
    whole = judged.where("objects IS NOT NULL").select(F.explode("objects").alias("value"))
    broken = judged.where("objects IS NULL").select("file", "split", "at", "piece", _quotes(F.col("piece")).alias("quotes"))
    # Where a split of a file begins and ends tells which broken pieces have a whole one before them.
    ends = _pieces(spark, paths).groupBy("file", "split").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    return whole.unionByName(_objects_of(written(broken, "broken-pieces"), written(ends, "splits")))


def _pieces(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(file, split, at, piece)``: at rises within a split."""
    return spark.read.option("lineSep", CUT).text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece"),
    )


def _opened(piece: Column) -> Column:
    """A piece with the brace and quote that the cut before it took."""
    return F.concat(F.lit('{"'), piece)


def _objects(text: Column) -> Column:
    """The objects of ``text``, or of ``text`` and a closing brace; null if neither is objects alone.

    Objects that close all their texts are parted exactly; only where that leaves something that doesn't parse, as
    after an object whose end is missing, a key that opens is taken for the next object.
    """
    parses = lambda value: F.try_parse_json(value).isNotNull()

    def read(part) -> Column:
        found = F.transform(F.array(text, F.concat(text, F.lit("}"))), part)
        return F.get(F.filter(found, lambda objects: (F.size(objects) > 0) & F.forall(objects, parses)), F.lit(0))

    return F.coalesce(read(jsons.split_well_formed), read(jsons.split_concatenated))


def _quotes(piece: Column) -> Column:
    """How many quotes of ``piece`` open or close a text."""
    plain = F.regexp_replace(piece, r"(?s)\\.", "")
    return F.length(plain) - F.length(F.translate(plain, '"', ""))


def _before(value: Column, order: Window) -> Column:
    return value.over(order.rowsBetween(Window.unboundedPreceding, -1))


def _objects_of(broken: DataFrame, ends: DataFrame) -> DataFrame:
    """``value``: the objects that the broken pieces are parts of.

    A run is broken pieces that follow each other. Within a run, a cut lies in a text if the quotes since the run began,
    those that the cuts took included, are odd; only the first piece of a file has no cut before it.
    """
    order = Window.partitionBy("file", "split").orderBy("at")
    held = broken.join(ends, ["file", "split"])
    # Parity at the end of a piece, counted from the start of the split; a run that starts there takes it off again.
    first = (F.col("split") == 0) & (F.col("at") == F.col("first_at"))
    counted = held.withColumn("own", F.col("quotes") + F.when(first, 0).otherwise(1)).withColumn("first", first)
    counted = counted.withColumn("total", F.sum("own").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    follows = F.coalesce(F.lag("at").over(order) == F.col("at") - 1, F.lit(False))
    counted = counted.withColumn("follows", follows)
    base = F.last(F.when(~F.col("follows"), F.struct((F.col("total") - F.col("own")).alias("taken"), "at")), True)
    counted = counted.withColumn("run", base.over(order.rowsBetween(Window.unboundedPreceding, 0)))
    counted = counted.withColumns({
        "leading": F.col("run.at") == F.col("first_at"),
        "parity": (F.col("total") - F.col("run.taken")) % 2,
    })
    splits = counted.groupBy("file", "split").agg(
        F.max(F.when(F.col("at") == F.col("last_at"), F.struct("leading", "parity"))).alias("end"),
    )
    carried = ends.join(splits, ["file", "split"], "left").select("file", "split", "end")
    carried = _carried_parity(carried)
    stated = counted.join(carried, ["file", "split"]).withColumn("enters", F.col("leading") & F.col("open_before"))
    state = F.when(F.col("follows"), F.col("parity") - F.col("own") + F.when(F.col("enters"), F.col("carry")).otherwise(0)).when(
        F.col("enters"), F.col("carry")).otherwise(0)
    stated = stated.withColumn("in_text", F.pmod(state, F.lit(2)) == 1)
    start = F.last(F.when(~F.col("in_text"), F.struct("split", "at")), True)
    stated = stated.withColumn("start", start.over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # An object that began in an earlier split: its start is the last one there is before.
    last = stated.groupBy("file", "split").agg(F.max("start").alias("last"))
    by_file = Window.partitionBy("file").orderBy("split")
    earlier = last.select("file", "split", _before(F.last("last", True), by_file).alias("earlier"))
    placed = stated.join(earlier, ["file", "split"]).withColumn("start", F.coalesce("start", "earlier", F.struct("split", "at")))
    parts = placed.groupBy("file", "start").agg(F.array_sort(F.collect_list(F.struct("split", "at", "piece", "first"))).alias("parts"))
    rest = F.transform(F.slice("parts", F.lit(2), F.size("parts")), lambda p: p["piece"])
    head = F.col("parts")[0]
    text = F.array_join(F.concat(F.array(F.when(head["first"], head["piece"]).otherwise(_opened(head["piece"]))), rest), CUT)
    one = parts.select(F.explode(F.array(text)).alias("text")).where(F.btrim("text", F.lit(" \t\r\n")) != "")
    return one.select(F.explode(F.coalesce(_objects(F.col("text")), F.array("text"))).alias("value"))


def _carried_parity(splits: DataFrame) -> DataFrame:
    """``(file, split, open_before, carry)`` of ``splits(file, split, end)``: whether a run of broken pieces reaches up to
    the split, and the parity it brings.

    ``end(leading, parity)`` is the run that a split ends with, null if it ends with a whole piece; a leading run
    is the split's only one and passes on what it was given. So the state is a running sum since the last
    split that doesn't pass anything on.
    """
    by_file = Window.partitionBy("file").orderBy("split")
    passes = F.coalesce(F.col("end.leading"), F.lit(False))
    own = F.coalesce(F.col("end.parity"), F.lit(0))
    summed = splits.withColumn("passed", F.sum(F.when(passes, own).otherwise(0)).over(by_file.rowsBetween(Window.unboundedPreceding, 0)))
    fixed = F.when(~passes, F.struct(own.alias("parity"), "passed"))
    seen = summed.withColumn("fixed", _before(F.last(fixed, True), by_file))
    brought = _before(F.last("passed"), by_file)
    carry = F.coalesce(F.col("fixed.parity"), F.lit(0)) + F.coalesce(brought, F.lit(0)) - F.coalesce("fixed.passed", F.lit(0))
    return seen.select("file", "split", F.coalesce(F.lag("end").over(by_file).isNotNull(), F.lit(False)).alias("open_before"), (carry % 2).alias("carry"))
