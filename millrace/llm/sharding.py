"""Shards of nearly equal size that keep equal texts together.

Groups of equal texts are put in the order of a hash of the text and added up to ``2 ** ATOM_BITS`` ordered atoms,
so that a group is never split and the list of sizes has one bound for any input.  The smallest capacity for which a
greedy walk over the atoms needs no more than the wanted number of shards is found by binary search, and the
atoms are cut under that capacity.  The text is read once; only narrow rows are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.storage import materialize

ATOM_BITS = 16
CELLS = 1024


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, atom`` of every row; a NULL text counts as an empty one (size 1)."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(body), F.lit(1 << ATOM_BITS)).cast("int").alias("atom"),
    )


def minimax_cuts(atoms: DataFrame, shards: int) -> DataFrame:
    """One row ``capacity, cuts`` for rows of ``atom, size``; ``cuts`` are the first atoms of shards 1, 2, ...

    ``capacity`` is the least that a contiguous partition of the atoms into ``shards`` can have as its largest
    part.  Below it every shard closes as near as possible to an even share of what is left, unless the atoms after
    it would then not fit, so that one huge group does not leave other shards empty.  No rows: capacity 0, no cuts.
    """
    sizes = (
        atoms.groupBy("atom").agg(F.sum("size").alias("bytes"))
        .agg(F.sort_array(F.collect_list(F.struct("atom", "bytes"))).alias("sizes"))  # 2 ** ATOM_BITS entries at most
    )
    grown = "if(a.load + x.bytes <= {cap}, {same}, {next})"
    need = "aggregate(sizes, named_struct('load', 0L, 'parts', 1), (a, x) -> " + grown.format(
        cap="({cap})",
        same="named_struct('load', a.load + x.bytes, 'parts', a.parts)",
        next="named_struct('load', x.bytes, 'parts', a.parts + 1)",
    ) + ", a -> a.parts)"
    middle = "(b.lo + b.hi) div 2"
    searched = sizes.selectExpr(
        "sizes",
        "aggregate(sizes, 0L, (a, x) -> a + x.bytes) AS total",
        "coalesce(array_max(transform(sizes, x -> x.bytes)), 0L) AS largest",
    ).selectExpr("sizes", "total", f"greatest(largest, (total + {shards - 1}) div {shards}) AS least", "largest").selectExpr(
        "sizes",
        "total",
        f"""aggregate(sequence(1, 62), named_struct('lo', least, 'hi', least + largest), (b, i) -> CASE
            WHEN b.lo >= b.hi THEN b
            WHEN {need.format(cap=middle)} <= {shards} THEN named_struct('lo', b.lo, 'hi', {middle})
            ELSE named_struct('lo', {middle} + 1, 'hi', b.hi) END, b -> b.lo) AS capacity""",
    )
    # The shortest heads that leave a rest for 1, 2, ... shards: a greedy walk from the end.
    fits = searched.selectExpr(
        "*",
        """aggregate(reverse(sizes), named_struct('load', 0L, 'at', total, 'heads', array(cast(null AS bigint))), (a, x) -> """
        + grown.format(
            cap="capacity",
            same="named_struct('load', a.load + x.bytes, 'at', a.at - x.bytes, 'heads', a.heads)",
            next="named_struct('load', x.bytes, 'at', a.at - x.bytes, 'heads', array_append(a.heads, a.at))",
        )
        + """, a -> array_append(slice(a.heads, 2, size(a.heads)), a.at)) AS heads""",
    )
    left = f"({shards} - size(a.cuts))"  # shards not closed yet, the open one included
    rest_fits = f"a.at >= coalesce(try_element_at(heads, {left} - 1), 0L)"
    wanted = f"a.at + x.bytes div 2 > a.begin + (total - a.begin) div {left}"
    closes = f"a.at > a.begin AND {left} > 1 AND (a.at - a.begin + x.bytes > capacity OR ({wanted} AND {rest_fits}))"
    return fits.selectExpr(
        "capacity",
        f"""aggregate(sizes, named_struct('begin', 0L, 'at', 0L, 'cuts', cast(array() AS array<int>)), (a, x) -> if({closes},
            named_struct('begin', a.at, 'at', a.at + x.bytes, 'cuts', array_append(a.cuts, x.atom)),
            named_struct('begin', a.begin, 'at', a.at + x.bytes, 'cuts', a.cuts)), a -> a.cuts) AS cuts""",
    )


def placed(rows: DataFrame, shards: int) -> DataFrame:
    """Rows of ``measured`` with ``shard`` and ``slot``, which counts from 0 inside each shard.

    Slots are numbered in ``CELLS`` cells per shard dealt by a hash of the row, so a group of copies is spread over
    them; the rows before a cell come from a table with one row per shard and cell.
    """
    cuts = minimax_cuts(rows, shards).head()["cuts"]  # shards - 1 numbers
    spread = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(CELLS)).cast("int")
    dealt = rows.withColumn("shard", _shard(cuts)).withColumn("_cell", spread)
    counts = dealt.groupBy("shard", "_cell").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_cell").orderBy("doc_id", "text_crc32", "size")
    return (
        dealt.withColumn("_rank", F.row_number().over(inside))
        .join(before, ["shard", "_cell"])
        .withColumn("slot", (F.col("_before") + F.col("_rank") - 1).cast("bigint"))
        .drop("_cell", "_before", "_rank", "atom")
    )


def shard_documents(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: every row of ``docs`` in one of ``shards`` shards.

    The law is ``bytes``: equal texts stay together and the largest shard is as small as contiguous cuts of the atoms
    allow.  NULL and empty texts are one group of size-1 rows; NULL or repeated ids are rows like all others, and an
    empty table gives no rows.  Other columns of ``docs`` are not read.
    """
    rows = materialize(measured(docs, doc_id, text), "measured")
    law = placed(rows, shards)
    return law.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, text: str = "text", files: int = 8) -> None:
    """Write all columns of ``docs`` below ``path/shard=k``, about ``files`` files to a shard however large its groups are."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumn("_atom", F.pmod(F.xxhash64(body), F.lit(1 << ATOM_BITS)).cast("int"))
    sized = rows.select(F.col("_atom").alias("atom"), (F.octet_length(body) + 1).cast("bigint").alias("size"))
    cuts = minimax_cuts(sized, shards).head()["cuts"]
    out = rows.withColumn("atom", F.col("_atom")).withColumn("shard", _shard(cuts)).drop("_atom", "atom")
    dealt = out.repartition(shards * files, "shard", F.pmod(F.monotonically_increasing_id(), F.lit(files)))
    dealt.write.partitionBy("shard").parquet(path)


def _shard(cuts: list[int]) -> Column:
    return sum(((F.col("atom") >= c).cast("int") for c in cuts), F.lit(0))
