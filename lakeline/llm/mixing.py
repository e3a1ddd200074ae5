"""Mixing sources to target weights: each source gives its exact share of the words.

Rows get a hash-random key and are range-sorted by (source, key) into a written table. Sums of
words per block of that table, carried on from block to block, tell in which block a source's
budget ends, and running sums inside these blocks tell the row. From then on a row's place in
the written table decides what it gives, so no row is shuffled again, no window spans a source,
and a source may hold any share of all rows. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeline.llm.arrow import BLOCK_ROWS, free_name, quoted, running_total, stored

#: What parts words.
_SPACES = " \t\n\x0b\x0c\r"
_SPACE, _WORD = "[\\x20\\x09-\\x0D]+", "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of other characters than ASCII white space; 0 for null. Each word becomes one letter
    and the rest goes, so no list of a long text's words is made."""
    letters = F.regexp_replace(F.regexp_replace(text.cast("string"), _WORD, "x"), _SPACE, "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("bigint")


def first_words(text: Column, count: Column) -> Column:
    """The text from its first to its ``count``-th word, which must not be its last."""
    inner = F.ltrim(text.cast("string"), F.lit(_SPACES))
    rest = F.element_at(F.split(inner, _SPACE, (count + 1).cast("int")), (count + 1).cast("int"))
    return F.rtrim(F.substring(inner, F.lit(1), F.length(inner) - F.length(rest)), F.lit(_SPACES))


def random_key(key: Column, seed: int) -> Column:
    """A hash that only the row's key and the seed decide, as hex digits."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")),
                          F.lit(f":{seed}")).cast("binary"))


def _exact(value) -> Column:
    """A whole number whose products don't overflow."""
    made = value if isinstance(value, Column) else F.lit(Decimal(value))
    return made.cast("decimal(38,0)")


def targets(sizes: DataFrame, weights: Sequence[int], limit: int = 3,
            total: int | None = None) -> DataFrame:
    """``source, source_size, weight, target`` of every source.

    ``sizes`` has one row per ``source`` with its ``source_size`` in words. Sources by code
    point, null last, have the weights in turn and share ``total`` words (all there are) by
    them. Targets stop at ``limit`` times the source's size, and what is over is shared again by
    weight among the others, until none is above; if all stand at their limits, less than
    ``total`` is given. A source without words has target 0. A round of sharing is one row of
    sums, so the number of sources has no bound.
    """
    if not weights or limit <= 0 or any(w <= 0 or w != int(w) for w in weights):
        raise ValueError("weights must be whole numbers above 0, and the limit above 0")
    by_code = [F.col("source").isNull(), F.col("source")]
    named = stored(sizes.select("source", "source_size").repartitionByRange(*by_code)
                   .sortWithinPartitions(*by_code), "sources")
    turn = F.array(*(F.lit(int(w)).cast("bigint") for w in weights))
    weighed = stored(
        running_total(named, [F.col("source"), F.col("source_size")], [], F.lit(1), "rank")
        .select("source", "source_size",
                F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int"))
                .alias("weight")), "weighed-sources")
    size, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    words = (size or 0) if total is None else total
    if words < 0:
        raise ValueError("the total must not be below 0")
    full = F.col("source_size") * limit
    left, weight, at_limit = words, weight or 0, -1
    while True:
        # A share is left / weight for each unit of weight.
        over = _exact(full) * _exact(weight) < _exact(left) * _exact(F.col("weight"))
        stop = weighed.agg(F.count_if(over).alias("n"),
                           F.sum(F.when(over, full)).alias("full"),
                           F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
        if stop["n"] == at_limit or not stop["weight"]:
            break
        left, weight, at_limit = words - (stop["full"] or 0), stop["weight"], stop["n"]
    share = F.lit(left).cast("double") * F.col("weight") / F.lit(weight or 1).cast("double")
    return weighed.withColumn(
        "target", F.when(F.lit(not stop["weight"]) | over, full.cast("double")).otherwise(share))


def mix(docs: DataFrame, *, key: str = "doc_id", source: str = "source", text: str = "text",
        weights: Sequence[int] = (1, 2, 3), limit: int = 3, total: int | None = None,
        seed: int = 0, with_rows: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row: ``doc_id, source, size, source_size, target, taken``; and the whole row in
    ``row``, if asked for.

    ``size`` counts the text's words (null and empty: 0), ``target`` is that of ``targets``.
    A source gives its target, rounded to whole words, exactly: all its rows as often as they
    fit, and once more rows in the order of their random keys, the last of them in part. So
    ``taken``, the words that the mix has of a row, is from 0 to ``limit`` times its size. Rows
    with one key are ordered by size and a hash of the text; repeated rows are as many rows, of
    which any may be the one that is cut. A null key is a key, a null source is a source. An
    empty table gives no rows; other columns of ``docs``, whatever their names, are not read
    unless ``with_rows``.
    """
    words = quoted(text).cast("string")
    rows = docs.select(
        quoted(key).alias("doc_id"), quoted(source).cast("string").alias("source"),
        word_count(words).alias("size"), F.xxhash64(words).alias("hash"),
        random_key(quoted(key), seed).alias("draw"),
        *([F.struct(*(quoted(c) for c in docs.columns)).alias("row")] if with_rows else []))
    # Null has a name as well, so that plain joins and windows find it.
    rows = rows.withColumn("name", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    if not with_rows:
        rows = stored(rows, "mix-sizes")  # texts are read once, not for the ranges as well
    order = ["name", "draw", "size", "hash"]
    placed = _with_places(stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order), "mix"), block_rows)

    blocks = placed.groupBy("name", "block").agg(F.sum("size").alias("words"),
                                                 F.first("source").alias("source"))
    blocks = stored(blocks, "mix-blocks")
    aims = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")),
                   weights, limit, total)
    aims = stored(aims.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"), "source_size",
        "target", *_parts(F.round("target").cast("bigint"), F.col("source_size"))), "mix-targets")
    # Written, so that Spark knows that it is small when it plans the last pass over all rows.
    plan = stored(aims.join(_cuts(placed, blocks, aims), "name", "left"), "mix-plan")

    place = F.struct("block", "at")
    more = (F.when(place < F.col("cut"), F.col("size"))
            .when(place == F.col("cut"), F.col("part")).otherwise(F.lit(0)))
    taken = F.col("epochs") * F.col("size") + F.when(F.col("cut").isNull(), F.lit(0)).otherwise(
        more)
    return placed.join(plan, "name").select(
        "doc_id", "source", "size", "source_size", "target",
        taken.cast("bigint").alias("taken"), *(["row"] if with_rows else []))


def _with_places(table: DataFrame, block_rows: int) -> DataFrame:
    """A written table's rows with their place: the block, and the row's number in its file."""
    name, at = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    return table.select("*", at.alias("at"), F.struct(
        F.regexp_extract(name, r"part-(\d+)", 1).cast("bigint").alias("part"),
        F.regexp_extract(name, r"-c(\d+)", 1).cast("bigint").alias("file"),
        F.floor(at / block_rows).alias("block")).alias("block"))


def _parts(budget: Column, size: Column) -> list[Column]:
    """How often the whole source fits into its budget, and the words beyond that."""
    one = F.greatest(size, F.lit(1))
    return [F.floor(budget / one).cast("bigint").alias("epochs"),
            F.when(size > 0, F.pmod(budget, one)).otherwise(F.lit(0)).alias("rest")]


def _cuts(placed: DataFrame, blocks: DataFrame, aims: DataFrame) -> DataFrame:
    """Per source with a rest: the place of the row where it ends, and the words taken there."""
    before = Window.partitionBy("name").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    ends = stored(blocks.join(aims.where("rest > 0").select("name", "rest"), "name")
            .withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0)))
            .where("base < rest AND rest <= base + words").select("name", "block", "base", "rest"),
        "mix-ends")
    inside = Window.partitionBy("name", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return (placed.select("name", "block", "at", "size").join(ends, ["name", "block"])
            .withColumn("done", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .where("done < rest AND rest <= done + size")
            .select("name", F.struct("block", "at").alias("cut"),
                    (F.col("rest") - F.col("done")).alias("part")))


def mixture(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are taken, ``epoch`` counting from
    0, and of the row where a source's budget ends only the words that are left. Rows without
    words are in no mix. A column named epoch keeps its name; the new one is then another."""
    epoch, columns = free_name(docs, "epoch"), docs.columns
    rows = mix(docs, text=text, with_rows=True, **options).where("taken > 0")
    copies = rows.select("row", "size", "taken", F.explode(
        F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / F.col("size")).cast("int")))
        .alias("epoch"))
    whole = F.col("row")[text]
    left = F.col("taken") - F.col("size") * F.col("epoch")
    cut = F.when(left >= F.col("size"), whole).otherwise(first_words(whole, left))
    return copies.select(*(cut.alias(c) if c == text else F.col("row")[c].alias(c)
                           for c in columns), F.col("epoch").alias(epoch))
