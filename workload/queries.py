"""``name -> (spark, sf_dir) -> DataFrame``.  Arrays and instants are rendered as text and numbers for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.status import clean_status, has_hangul, has_hiragana
from millrace.operators import graph, intervals, langs, people, phones, reads, social, variants, words
from millrace.sources.archive import parse_wet, split_manifest
from millrace.sinks.files import density_lines, freq_lines, to_bed, to_region_strings
from millrace.sources.genome import parse_sam, parse_variants
from millrace.sources.text import trim_list_file
from millrace.plans.storage import materialize
from workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _seconds(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.unix_seconds(c) for c in ("window_start", "window_end") if c in df.columns})


# Text.  A line break ends a segment, so the word operators take whole texts as they are.


@query
def lines(spark, sf):
    return t.lines(spark, sf)


@query
def segments(spark, sf):
    return words.segments(t.lines(spark, sf)).select(
        F.concat_ws(" ", "words").alias("segment"), F.size("words").cast("bigint").alias("n_words")
    )


@query
def word_counts(spark, sf):
    return words.word_counts(t.documents(spark, sf), "text")


@query
def bigram_counts(spark, sf):
    return words.bigram_counts(t.documents(spark, sf), "text")


@query
def word_freq(spark, sf):
    return words.word_freq(t.documents(spark, sf), "text")


@query
def predecessor_lists(spark, sf):
    return words.predecessor_lists(t.documents(spark, sf), "text")


@query
def clean_text(spark, sf):
    return t.lines(spark, sf).select("doc_id", clean_status(F.col("line")).alias("cleaned"))


QUERIES["clean_status"] = QUERIES.pop("clean_text")


@query
def lang_names(spark, sf):
    return langs.lang_names(t.table(spark, sf, "documents"))


@query
def lang_profiles(spark, sf):
    return langs.lang_profiles(t.documents(spark, sf))


@query
def detect_lang(spark, sf):
    docs = t.documents(spark, sf)
    return langs.detect_lang(docs, langs.lang_profiles(docs))


# Statuses


@query
def tweet_windows(spark, sf):
    return _seconds(social.tweet_windows(t.statuses(spark, sf), t.WINDOW, t.SLIDE).select("id", "window_start", "window_end"))


@query
def retweet_counts(spark, sf):
    return _seconds(social.retweet_counts(t.statuses(spark, sf), t.WINDOW, t.SLIDE))


@query
def hashtag_counts(spark, sf):
    return _seconds(social.hashtag_counts(t.statuses(spark, sf), t.WINDOW, t.SLIDE))


@query
def tag_popularity(spark, sf):
    st = t.statuses(spark, sf)
    tagged = social.first_tag(social.originals(social.filter_lang(st)))
    counts = social.hashtag_counts(st, t.WINDOW, t.SLIDE)
    rows = social.tag_popularity(social.tweet_windows(tagged, t.WINDOW, t.SLIDE), counts)
    return _seconds(rows.select("window_start", "id", "tag", "hashtagcount"))


def _board(spark, sf):
    return social.tweet_board(t.statuses(spark, sf), t.WINDOW, t.SLIDE, ordered=False, details=False)


@query
def tweet_board(spark, sf):
    return _seconds(social.tweet_board(t.statuses(spark, sf), t.WINDOW, t.SLIDE))


@query
def board_top3(spark, sf):
    return _seconds(social.board_details(social.board_topn(_board(spark, sf)), t.statuses(spark, sf)))


@query
def board_numbered(spark, sf):
    rows = social.number_rows(social.board_topn(_board(spark, sf)))
    return _seconds(rows.select("row_no", "window_end", "hashtagcount", "hashtag", "id", "retweets"))


@query
def board_top10(spark, sf):
    return _seconds(social.board_details(social.board_preview(_board(spark, sf)), t.statuses(spark, sf)))


# Phone numbers


@query
def wet_records(spark, sf):
    return parse_wet(t.raw_records(spark, sf))


@query
def manifest_split(spark, sf):
    return split_manifest(t.manifest(spark, sf))


@query
def phone_hits(spark, sf):
    return phones.phone_hits(t.records(spark, sf))


@query
def phone_index(spark, sf):
    return phones.phone_index(phones.phone_hits(t.records(spark, sf)))


@query
def phone_legacy(spark, sf):
    return phones.phone_legacy(t.records(spark, sf))


@query
def phone_stats(spark, sf):
    return phones.phone_stats(phones.phone_hits(t.records(spark, sf)), split_manifest(t.manifest(spark, sf)))


# People and titles


@query
def list_trim(spark, sf):
    return trim_list_file(t.list_lines(spark, sf))


@query
def titles_clean(spark, sf):
    return people.clean_titles(t.film_people(spark, sf)).withColumn("titles", F.concat_ws("|", "titles"))


@query
def people_union(spark, sf):
    everybody = t.film_people(spark, sf)
    males, females = everybody.filter("is_male").drop("is_male"), everybody.filter("not is_male").drop("is_male")
    return people.people_union(males, females).select("name", "is_male", F.concat_ws("|", "titles").alias("titles"))


@query
def people_ids(spark, sf):
    kept = people.clean_titles(t.film_people(spark, sf))
    return people.with_surrogate_id(kept, [F.desc("is_male"), F.col("name")]).select("actor_id", "name", "is_male")


def _edges(spark, sf):
    return people.bipartite_edges(t.cast_people(spark, sf))


@query
def bipartite_edges(spark, sf):
    return _edges(spark, sf)


@query
def costar_pairs(spark, sf):
    return graph.costar_pairs(_edges(spark, sf), t.chosen_people(spark, sf))


@query
def costar_counts(spark, sf):
    return graph.costar_counts(_edges(spark, sf))


@query
def bfs_distance(spark, sf):
    return graph.bfs_distance(_edges(spark, sf), t.ROOT)


@query
def distance_histogram(spark, sf):
    edges = graph.clustered(_edges(spark, sf))
    return graph.distance_histogram(t.actors(spark, sf, edges.by_actor), graph.bfs_distance(edges, t.ROOT))


@query
def separation_summary(spark, sf):
    edges = graph.clustered(_edges(spark, sf))
    return graph.separation_summary(t.actors(spark, sf, edges.by_actor), graph.bfs_distance(edges, t.ROOT), edges.by_movie)


@query
def people_at_distance(spark, sf):
    edges = graph.clustered(_edges(spark, sf))
    return graph.people_at_distance(t.actors(spark, sf, edges.by_actor), graph.bfs_distance(edges, t.ROOT))


# Variants


def _index(spark, sf):
    return variants.contig_index(t.contigs(spark, sf))


def _density(spark, sf, ordered=False):
    return variants.variant_density(t.variants(spark, sf), _index(spark, sf), ordered=ordered)


def _offsets(spark, sf, density):
    return variants.contig_offsets(variants.contigs_present(density), t.contigs(spark, sf))


@query
def variants_scan(spark, sf):
    return parse_variants(t.variant_lines(spark, sf))


@query
def contig_index(spark, sf):
    return _index(spark, sf)


@query
def variant_density(spark, sf):
    return _density(spark, sf, ordered=True)


@query
def variant_density_chunks(spark, sf):
    return variants.variant_density_chunks(t.variants(spark, sf), _index(spark, sf), size=1000)


@query
def contig_offsets(spark, sf):
    return _offsets(spark, sf, _density(spark, sf))


@query
def variants_per_region(spark, sf):
    return variants.variants_per_region(_density(spark, sf), t.REGIONS)


@query
def region_pack(spark, sf):
    return variants.region_pack(_density(spark, sf), t.REGIONS)


@query
def order_rejects(spark, sf):
    return variants.order_rejects(t.variants(spark, sf))


@query
def density_rejects(spark, sf):
    return variants.density_rejects(t.variants(spark, sf), _index(spark, sf))


@query
def variant_order(spark, sf):
    return variants.variant_order(t.variants(spark, sf)).select("chrom_no", "chrom", "pos", "ref", "alt")


def _call_sets(spark, sf):
    calls = t.variants(spark, sf)
    return calls.filter("l_quantity <= 30"), calls.filter("l_discount >= 0.03")


@query
def variant_concordance(spark, sf):
    return variants.variant_concordance(*_call_sets(spark, sf))


@query
def variant_common(spark, sf):
    return variants.variant_common(*_call_sets(spark, sf))


@query
def variant_missing(spark, sf):
    return variants.variant_missing(*_call_sets(spark, sf))


# Reads and intervals


@query
def reads_filtered(spark, sf):
    return reads.mapped_reads(t.reads(spark, sf)).select("name", "ref_index", "start", "end")


def _assigned(spark, sf):
    density = materialize(_density(spark, sf), "density")
    regions = variants.region_pack(density, t.REGIONS)
    return reads.region_assign(t.axis_reads(spark, sf), regions, _offsets(spark, sf, density), t.REGIONS)


@query
def region_assign(spark, sf):
    return _assigned(spark, sf)


@query
def reads_per_region(spark, sf):
    return reads.reads_per_region(_assigned(spark, sf))


def _covered(spark, sf):
    return intervals.covered_intervals(reads.mapped_reads(t.reads(spark, sf)))


@query
def covered_intervals(spark, sf):
    return _covered(spark, sf)


@query
def merge_overlap(spark, sf):
    named = t.reads(spark, sf).select(F.concat(F.lit("Chr"), "ref_index").alias("chrom"), "start", "end")
    return intervals.merge_overlap(named, 20)


@query
def interval_intersect(spark, sf):
    return intervals.interval_intersect(t.targets(spark, sf), intervals.half_open(_covered(spark, sf)), key="ref_index")


@query
def quality_encoding(spark, sf):
    return reads.quality_encoding(t.raw_reads(spark, sf)).select(
        "pair", "grp", "illumina", F.concat_ws(",", F.col("quals").cast("array<string>")).alias("quals"), "bad"
    )


@query
def read_groups(spark, sf):
    return reads.read_groups(t.reads(spark, sf).select("name", "ref_index"))


@query
def mark_duplicates(spark, sf):
    return reads.mark_duplicates(t.reads(spark, sf)).select("name", "ref_index", "start", "strand", "score", "duplicate")


@query
def interleave_chunks(spark, sf):
    mates = t.raw_reads(spark, sf).select("pair", "name", "seq", "qual")
    second = mates.withColumns({"name": F.concat("name", F.lit("/2")), "seq": F.reverse("seq")})
    return reads.interleave_chunks(mates, second)


# Lines as the writers put them, and the parsers of single lines


@query
def multiword_segments(spark, sf):
    return words.multiword(words.segments(t.lines(spark, sf))).select(F.concat_ws(" ", "words").alias("segment"))


@query
def script_tests(spark, sf):
    lines = t.foreign_lines(spark, sf)
    return lines.select("doc_id", has_hiragana(F.col("line")).alias("hiragana"), has_hangul(F.col("line")).alias("hangul"))


@query
def word_freq_lines(spark, sf):
    return freq_lines(words.word_freq(t.documents(spark, sf), "text"))


@query
def density_text(spark, sf):
    return density_lines(_density(spark, sf))


@query
def bed_lines(spark, sf):
    return to_bed(_covered(spark, sf), chrom="ref_index")


@query
def bed_lines_compatible(spark, sf):
    return to_bed(_covered(spark, sf), chrom="ref_index", bed_compat=True)


@query
def region_strings(spark, sf):
    return to_region_strings(_covered(spark, sf), chrom="ref_index")


@query
def sam_reads(spark, sf):
    return parse_sam(t.sam_lines(spark, sf), t.contigs(spark, sf))


@query
def people_records(spark, sf):
    return people.parse_people(t.people_records(spark, sf), True).withColumn("titles", F.concat_ws("|", "titles"))


@query
def chunk_ids(spark, sf):
    return reads.chunk_id(t.marker_names(spark, sf))


@query
def separation_lines(spark, sf):
    edges = graph.clustered(_edges(spark, sf))
    report = graph.separation_report(t.actors(spark, sf, edges.by_actor), graph.bfs_distance(edges, t.ROOT), edges.by_movie)
    return report.filter("section IN (0, 1, 3, 4)").select("line")
