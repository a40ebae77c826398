"""The given tables, projected into the operators' input schemas (whole tables, no sampling)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW = 7200
SLIDE = 600
ROOT = 0
REGIONS = 8


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def instant(df: DataFrame, column: str) -> Column:
    """A timestamp column as an instant; times without a zone are read as UTC."""
    if dict(df.dtypes)[column] == "timestamp_ntz":
        since = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})")
        return F.timestamp_micros(since)
    return F.col(column)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "lang", "text")
    return docs.select("doc_id", "lang", F.explode(F.split("text", "\n")).alias("line"))


def statuses(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    tag = lambda i: F.concat(F.lit("t"), (i % 20).cast("string"))
    empty = F.array().cast("array<string>")
    retweeted = F.struct(
        (F.col("event_id") - 1 - F.col("user_id") % 3).alias("id"),
        F.lit(None).cast("string").alias("user"),
        F.lit(None).cast("string").alias("text"),
    )
    return events.select(
        F.col("event_id").alias("id"),
        instant(events, "ts").alias("ts"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user"),
        F.col("event_type").alias("text"),
        F.when(F.col("user_id") % 4 == 0, "de").when(F.col("user_id") % 4 == 1, "no").otherwise("en").alias("lang"),
        F.when(k % 4 == 0, empty).when(k % 4 == 1, F.array(tag(k))).otherwise(F.array(tag(k), tag(k * 7))).alias("hashtags"),
        F.when(F.col("event_type") == "view", retweeted).alias("retweet_of"),
    )


def records(spark: SparkSession, sf: str) -> DataFrame:
    """``url, content``: documents with phone numbers appended."""
    pad = lambda m, n: f"lpad(cast(doc_id % {m} as string), {n}, '0')"
    content = (
        f"text || ' tel +31 (0)20-' || {pad(400, 7)} || '. mob 0031 6 1' || {pad(300, 7)}"
        f" || ', fax +31 99 1234567. free +31 800 ' || {pad(50, 4)} || '.'"
    )
    url = "'http://' || source || '.example.com/' || cast(doc_id as string)"
    return documents(spark, sf).selectExpr(f"{url} as url", f"{content} as content")


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    return records(spark, sf).select(F.concat(F.lit("WARC-Target-URI: "), "url", F.lit("\r\n\r\n"), "content").alias("value"))


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    doc = F.col("doc_id").cast("string")
    uri = (
        F.when(F.col("doc_id") % 7 == 0, "ftp://x")
        .when(F.col("doc_id") % 11 == 0, F.concat(F.lit("file:/d/"), doc))
        .when(F.col("doc_id") % 13 == 0, "s3:/bucket")
        .otherwise(F.concat(F.lit("s3://bucket/"), doc))
    )
    return table(spark, sf, "documents").select(uri.alias("value"))


def cast_people(spark: SparkSession, sf: str) -> DataFrame:
    """``actor_id, titles``: one title per row, repeats included."""
    title = F.col("l_orderkey") * 64 + F.floor((F.col("l_quantity") - 1) / 2)
    return table(spark, sf, "lineitem").select(F.col("l_partkey").alias("actor_id"), F.array(title).alias("titles"))


def chosen_people(spark: SparkSession, sf: str) -> DataFrame:
    """``actor_id`` of the people of one size, a fiftieth of all."""
    return table(spark, sf, "part").filter("p_size = 1").select(F.col("p_partkey").alias("actor_id"))


def actors(spark: SparkSession, sf: str, edges: DataFrame) -> DataFrame:
    """``actor_id, name, is_male`` of everybody in ``edges``."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("actor_id"), F.col("p_name").alias("name"))
    return parts.join(edges.select("actor_id").distinct(), "actor_id", "left_semi").withColumn(
        "is_male", F.col("actor_id") % 2 == 0
    )


def variants(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 113 == 0, "chrUn")
        .otherwise(F.concat(F.lit("chr"), (F.col("l_suppkey") % 22 + 1).cast("string"))).alias("chrom"),
        (F.col("l_partkey") * 50000 + F.col("l_linenumber")).alias("pos"),
        F.col("l_returnflag").alias("ref"),
        F.col("l_linestatus").alias("alt"),
        "l_quantity",
        "l_discount",
    )


def variant_lines(spark: SparkSession, sf: str) -> DataFrame:
    row = F.concat_ws(
        "\t", F.concat(F.lit("chr"), F.col("l_suppkey") % 22 + 1), F.col("l_partkey") * 50000 + F.col("l_linenumber"),
        F.concat(F.lit("rs"), "l_orderkey"), "l_returnflag", "l_linestatus",
    )
    comment = F.concat(F.lit("#order "), "l_orderkey")
    return table(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") == 7, comment).otherwise(row).alias("value"))


def contigs(spark: SparkSession, sf: str) -> DataFrame:
    """24 contigs: chrM, chr1 to chr22 and one that is not canonical."""
    c = F.col("idx")
    name = F.when(c == 0, "chrM").when(c == 23, "chrUn_gl1").otherwise(F.concat(F.lit("chr"), c.cast("string")))
    rows = table(spark, sf, "lineitem").groupBy((F.col("l_suppkey") % 24).cast("int").alias("idx")).agg(F.max("l_partkey").alias("_top"))
    top = rows.agg(F.max("_top")).scalar()
    return rows.select("idx", name.alias("name"), ((top + 1) * 50000 + c).alias("length"))


def reads(spark: SparkSession, sf: str) -> DataFrame:
    start = F.col("l_partkey") * 50 + F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        F.concat_ws("_", "l_orderkey", "l_linenumber").alias("name"),
        F.when(F.col("l_orderkey") % 101 != 0, F.col("l_suppkey") % 27).alias("ref_index"),
        start.alias("start"),
        (start + F.col("l_quantity").cast("bigint")).alias("end"),
        (F.col("l_returnflag") == "R").alias("unmapped"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        F.col("l_quantity").cast("bigint").alias("score"),
    )


def axis_reads(spark: SparkSession, sf: str) -> DataFrame:
    """Reads on the variants' contigs."""
    return table(spark, sf, "lineitem").select(
        F.concat_ws("_", "l_orderkey", "l_linenumber").alias("name"),
        (F.col("l_suppkey") % 22 + 1).cast("int").alias("ref_index"),
        (F.col("l_partkey") * 50000 + F.col("l_linenumber")).alias("pos"),
    )


def targets(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        (F.col("p_partkey") % 27).alias("ref_index"),
        (F.col("p_partkey") * 50).alias("start"),
        (F.col("p_partkey") * 50 + F.col("p_size") * 10).alias("end"),
    )


def raw_reads(spark: SparkSession, sf: str) -> DataFrame:
    grp = F.col("o_custkey") % 40
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pair"),
        F.when(F.col("o_orderkey") % 97 != 0, grp).alias("grp"),
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderpriority").alias("seq"),
        F.repeat(F.char(grp + 64), F.lit(5)).alias("qual"),
    )


def film_people(spark: SparkSession, sf: str) -> DataFrame:
    year = "case when i = 4 and s_suppkey % 7 = 0 then '????' else cast(2005 + (s_suppkey + i) % 16 as string) end"
    title = f"case when i = 3 then '\"' else '' end || 'Film' || i || ' (' || {year} || ') [x]'"
    return table(spark, sf, "supplier").selectExpr(
        "s_name as name", "s_suppkey % 2 = 0 as is_male", f"transform(sequence(0, 4), i -> {title}) as titles"
    )


def list_lines(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier")
    last = suppliers.agg(F.max("s_suppkey")).scalar()
    value = (
        F.when(F.col("s_suppkey") == 2, "Name  Titles")
        .when(F.col("s_suppkey") == 3, "----  ------")
        .when(F.col("s_suppkey") == last - 2, "-----")
        .otherwise(F.concat_ws("\t", "s_name", F.lit("Film (2012)")))
    )
    return suppliers.select((F.col("s_suppkey") + 1).alias("line_no"), value.alias("value"))


def sam_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Reads as SAM lines: a header line in place of some, too few fields in others, contig names that no dictionary has."""
    start = F.col("l_partkey") * 50 + F.col("l_linenumber")
    flag = F.when(F.col("l_returnflag") == "R", 4).otherwise(0) + F.when(F.col("l_linestatus") == "F", 16).otherwise(0)
    name = F.concat_ws("_", "l_orderkey", "l_linenumber")
    cigar = F.concat(F.col("l_quantity").cast("bigint"), F.lit("M2I"), "l_linenumber", F.lit("D3S"))
    row = F.concat_ws("\t", name, flag, F.concat(F.lit("chr"), F.col("l_suppkey") % 27), start, F.lit(60), cigar, F.lit("="), start, F.lit(0), "l_shipmode_", "l_qual_")
    lines = table(spark, sf, "lineitem").withColumns({"l_shipmode_": F.lit("ACGT"), "l_qual_": F.repeat(F.col("l_returnflag"), F.lit(4))})
    value = F.when(F.col("l_linenumber") == 6, F.concat(F.lit("@CO\t"), name)).when(F.col("l_linenumber") == 7, F.concat_ws("\t", name, F.lit("0"))).otherwise(row)
    return lines.select(value.alias("value"))


def people_records(spark: SparkSession, sf: str) -> DataFrame:
    """Raw people records: a name, blank fields and line breaks between tabs, titles."""
    value = "s_name || chr(9) || chr(9) || 'Film (' || (2000 + s_suppkey % 20) || ')' || chr(10) || chr(9) || case when s_suppkey % 3 = 0 then '' else 'Two' end || chr(9)"
    return table(spark, sf, "supplier").selectExpr(f"case when s_suppkey % 11 = 0 then chr(9) || chr(9) else {value} end as value")


def marker_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names of chunk files, some without a number."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(F.when(key % 9 == 0, "done.txt").otherwise(F.format_string("fastq_%06d.fq", key.cast("bigint"))).alias("value"))


def foreign_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of documents, some with a letter of another script in front."""
    letter = F.when(F.length("line") % 5 == 0, "あ").when(F.length("line") % 5 == 1, "한").when(F.length("line") % 5 == 2, "ア").otherwise("")
    return lines(spark, sf).select("doc_id", F.concat(letter, F.col("line")).alias("line"))
