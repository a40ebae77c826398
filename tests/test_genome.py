from __future__ import annotations

import random
from pathlib import Path

import pytest

from millrace.operators import external, intervals, reads, variants
from millrace.plans.islands import merged
from millrace.sinks import files
from millrace.sources import genome
from millrace.sources.text import numbered_lines, scan_lines

DICT = "@HD\tVN:1.0\n@SQ\tSN:chrM\tLN:16571\tUR:x\n@SQ\tSN:chr1\tLN:249250621\n@SQ\tSN:chr1_gl\tLN:100\n@SQ\tSN:chr2\tLN:oops\n@SQ\tSN:chrX\tLN:7\n"


@pytest.fixture(scope="module")
def contigs(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("dict") / "d.dict"
    path.write_text(DICT)
    return genome.scan_dict(spark, str(path))


def _text(folder):
    return "".join(p.read_text() for p in sorted(Path(folder).glob("part-*")))


def test_dictionary(contigs):
    assert [tuple(r) for r in contigs.orderBy("idx").collect()] == [
        (0, "chrM", 16571), (1, "chr1", 249250621), (2, "chr1_gl", 100), (3, "chr2", 0), (4, "chrX", 7),
    ]
    assert [(r.contig_no, r.name) for r in variants.contig_index(contigs).collect()] == [(0, "chrM"), (1, "chr1"), (2, "chr2"), (3, "chrX")]


def test_numbered_lines_over_many_blocks(spark, tmp_path):
    texts = {f"{n}.txt": [f"{n}-{i}" + "x" * (i % 50) for i in range(3000)] for n in ("a", "b")}
    for name, rows in texts.items():
        (tmp_path / name).write_text("\n".join(rows) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        got = numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert {(Path(r.file).name, r.line_no): r.value for r in got} == {
        (name, i): x for name, rows in texts.items() for i, x in enumerate(rows, 1)
    }
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert scan_lines(spark, str(tmp_path), 6).rdd.getNumPartitions() >= 6
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_density_round_trip(spark, contigs, tmp_path):
    vcf = "##x\n#CHROM\tPOS\nchr1\t999999\trs1\tA\tC\t.\nchr1\t1000000\trs2\tA\tC\nchr1\t1500000\trs3\tG\tT\nchrM\t5\trs4\tA\tG\nchrQ\t1\trs\tA\tC\nbad\n"
    (tmp_path / "v.vcf").write_text(vcf)
    scanned = genome.scan_variants(spark, str(tmp_path / "v.vcf"))
    index = variants.contig_index(contigs)
    density = variants.variant_density(scanned, index)
    want = [("chrM", 0, 1, 1), ("chr1", 1, 1, 1), ("chr1", 1, 2, 2)]
    assert [tuple(r) for r in density.collect()] == want
    files.write_density(density, str(tmp_path / "out"))
    assert _text(tmp_path / "out").splitlines()[1] == "chr1\t1\t1\t1"
    assert sorted(map(tuple, genome.read_density(spark, str(tmp_path / "out")).collect())) == sorted(want)
    assert [tuple(r) for r in variants.density_rejects(scanned, index).collect()] == [("chrQ", 1)]


def test_chunks_of_distinct_positions(spark):
    rng = random.Random(5)
    rows = [("chr1", rng.randrange(400_000)) for _ in range(3000)] + [("chr2", i) for i in range(10)] + [("chr1", 77)] * 50
    index = spark.createDataFrame([(0, "chr1", 1), (1, "chr2", 1)], "contig_no int, name string, length bigint")
    got = {(r.chrom, r.chunk): r.n for r in variants.variant_density_chunks(spark.createDataFrame(rows, "chrom string, pos bigint"), index, size=64).collect()}
    want = {}
    for chrom in ("chr1", "chr2"):
        places = sorted({p for c, p in rows if c == chrom})
        for i, p in enumerate(places):
            want[chrom, i // 64] = want.get((chrom, i // 64), 0) + rows.count((chrom, p))
    assert got == want


def _pack(spark, ns, regions):
    rows = [("c", 0, i + 1, n) for i, n in enumerate(ns)]
    return [tuple(r) for r in variants.region_pack(spark.createDataFrame(rows, genome.DENSITY_SCHEMA), regions).collect()]


def test_region_packing(spark):
    assert _pack(spark, [5, 7, 1, 9, 2, 3, 8], 3) == [(0, 0.0, 3e6), (1, 3e6, 6e6)]
    assert _pack(spark, [5], 3) == []


def test_region_edges_are_strict(spark):
    regions = spark.createDataFrame([(0, 0.0, 3e6), (1, 3e6, 6e6)], "region int, start double, end double")
    offsets = spark.createDataFrame([(1, "c", 0), (2, "d", 5_000_000)], "idx int, chrom string, offset bigint")
    places = [(1, 0), (1, 1), (1, 2_999_999), (1, 3_000_000), (1, 3_000_001), (1, 6_000_000), (2, 999_999), (2, 1_000_000), (9, 1)]
    assigned = reads.region_assign(spark.createDataFrame(places, "ref_index int, pos bigint"), regions, offsets, 3)
    got = {(r.ref_index, r.pos): r.region for r in assigned.collect()}
    assert [got[p] for p in places] == [2, 0, 0, 2, 1, 2, 1, 2, 2]


def test_order_and_write(spark, tmp_path):
    lines = ["chr2\t5\ta\tA\tC", "chrX\t1\tb\tA\tC", "chr1\t9\tc\tA\tC", "chr1\t2\td\tA\tC", "chrM\t1\te\tA\tC", "chrY\t3\tf\tA\tC"]
    parsed = genome.parse_variants(spark.createDataFrame([(x,) for x in lines], "value string"))
    files.write_variants(variants.variant_order(parsed), str(tmp_path / "v"))
    assert _text(tmp_path / "v").splitlines() == [lines[3], lines[2], lines[0], lines[1], lines[5]]


def test_cover_fixture(spark):
    rows = [(1, 100, 150), (1, 110, 120), (1, 201, 210), (1, 262, 270), (2, 5, 9)]
    cover = intervals.covered_intervals(spark.createDataFrame(rows, "ref_index int, start bigint, end bigint"))
    assert sorted(map(tuple, cover.collect())) == [(1, 100, 210), (1, 262, 270), (2, 5, 9)]
    bed = files.to_bed(cover, "ref_index", bed_compat=True)
    assert sorted(r.value for r in bed.collect()) == ["1\t261\t269", "1\t99\t209", "2\t4\t8"]
    assert sorted(r.value for r in files.to_region_strings(cover, "ref_index").collect()) == ["1:100-210", "1:262-270", "2:5-9"]


def _merge_by_hand(rows, gap):
    out = []
    for key, start, end in sorted(rows):
        if out and out[-1][0] == key and start <= out[-1][2] + gap:
            out[-1][2] = max(out[-1][2], end)
        else:
            out.append([key, start, end])
    return sorted(tuple(x) for x in out)


@pytest.fixture(params=[1, 3, 16])
def sort_partitions(spark, request):
    """Scans over so many sort partitions, however few rows there are."""
    names = {"spark.sql.shuffle.partitions": str(request.param), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def test_ranks_of_positions_over_sort_partitions(spark, sort_partitions):
    rng = random.Random(sort_partitions)
    rows = [(rng.choice(["chr1", "chr2", "chrX"]), rng.choice([rng.randrange(50), rng.randrange(10**9)])) for _ in range(400)]
    index = spark.createDataFrame([(0, "chr1", 9), (1, "chr2", 9)], "contig_no int, name string, length bigint")
    got = variants.variant_density_chunks(spark.createDataFrame(rows, "chrom string, pos bigint"), index, size=10)
    want = {}
    for k, name in enumerate(["chr1", "chr2"]):
        ranks = {p: i // 10 for i, p in enumerate(sorted({p for c, p in rows if c == name}))}
        for c, p in rows:
            if c == name:
                want[name, k, ranks[p]] = want.get((name, k, ranks[p]), 0) + 1
    assert {(r.chrom, r.idx, r.chunk): r.n for r in got.collect()} == want


@pytest.mark.parametrize("gap", [0, 3, 51])
def test_merging_over_sort_partitions(spark, sort_partitions, gap):
    rng = random.Random(sort_partitions + gap)
    rows = [("k", s, s + rng.choice([0, 1, 5, 40, 300])) for s in (rng.randrange(4000) for _ in range(120))] + [("j", 1, 900), ("j", 5, 6), ("j", 960, 970)]
    got = merged(spark.createDataFrame(rows, "key string, start bigint, end bigint"), "key", "start", "end", gap)
    assert sorted(map(tuple, got.collect())) == _merge_by_hand(rows, gap)


def test_merge_overlap(spark):
    rows = [("chr1", 5, 10), ("CHR1", 12, 20), ("chr1", 40, 50), ("chr1", 49, 60)]
    got = intervals.merge_overlap(spark.createDataFrame(rows, "chrom string, start bigint, end bigint"), 4)
    assert sorted(map(tuple, got.collect())) == [("chr1", 1, 20), ("chr1", 36, 60)]


@pytest.mark.parametrize("width", [3, 50, 4096])
def test_intersect_equals_all_pairs(spark, width):
    rng = random.Random(width)
    make = lambda: [(rng.choice("xy"), s, s + rng.randrange(60)) for s in (rng.randrange(600) for _ in range(60))]
    a, b = make(), make()
    schema = "chrom string, start bigint, end bigint"
    got = intervals.interval_intersect(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), bin_width=width)
    want = [(c, max(s, t), min(e, f)) for c, s, e in a for d, t, f in b if c == d and max(s, t) < min(e, f)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


SAM = "@HD\tx\nr1\t0\tchr1\t100\t60\t10M2I5D3S\t*\t0\t0\tACGT\tIIII\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\nr3\t16\tchr2\t7\t1\t4=1X2N\t*\t0\t0\tA\tI\nshort\t1\n"


def test_sam_and_regions(spark, contigs, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.sam").write_text(SAM)
    got = genome.scan_sam(spark, str(tmp_path / "in"), contigs).orderBy("qname")
    assert [(r.qname, r.ref_index, r.pos, r.align_end, r.unmapped, r.strand) for r in got.collect()] == [
        ("r1", 1, 100, 114, False, "+"), ("r2", None, 0, -1, True, "+"), ("r3", 3, 7, 13, False, "-"),
    ]
    assert got.first().file.endswith("a.sam")
    assert sorted(r.qname for r in reads.mapped_reads(got).collect()) == ["r1", "r3"]
    rows = [(i % 3, 1, (i * 7919) % 1000, f"q{i}") for i in range(500)]
    files.write_regions(spark.createDataFrame(rows, "region int, ref_index int, pos bigint, qname string"), str(tmp_path / "reg"))
    back = spark.read.parquet(str(tmp_path / "reg"))
    assert sorted((r.region, r.ref_index, r.pos, r.qname) for r in back.collect()) == sorted(rows)
    for part in Path(tmp_path / "reg").glob("region=*/*.parquet"):
        places = [r.pos for r in spark.read.parquet(str(part)).collect()]
        assert places == sorted(places)


def _fastq(n, mate):
    return "".join(f"@p{i}/{mate}\nAC{i}\n+\n@{'I' * (i % 3 + 1)}\n" for i in range(n))


def test_fastq_interleave_and_pipe(spark, tmp_path):
    (tmp_path / "1.fq").write_text(_fastq(11, 1))
    (tmp_path / "2.fq").write_text(_fastq(9, 2))
    one, two = genome.scan_fastq_pair(spark, str(tmp_path / "1.fq"), str(tmp_path / "2.fq"))
    chunks = reads.interleave_chunks(one, two, size=4)
    rows = sorted((r.chunk, r.slot, r.pair, r.mate, r.name, r.qual) for r in chunks.collect())
    assert [(r[0] * 4 + r[1], r[2], r[3]) for r in rows] == [(i, i // 2, i % 2) for i in range(18)]
    assert rows[3][4] == "p1/2" and rows[3][5] == "@II"
    markers = files.write_chunks(chunks, str(tmp_path / "chunks"))
    assert sorted(r.value for r in markers.collect()) == [f"fastq_{i:04d}.fq" for i in range(5)]
    assert sorted(r.chunk for r in reads.chunk_id(markers, "value").collect()) == list(range(5))

    named = chunks.withColumn("line", chunks["name"])
    counted = external.pipe_chunks(named, "chunk", ["wc", "-l"], order="slot").collect()
    assert {r.chunk: (r.exit_code, int(r.stdout)) for r in counted} == {**{i: (0, 4) for i in range(4)}, 4: (0, 2)}
    copied = external.pipe_chunks(named, "chunk", lambda c: ["cat"] if c else ["no-such-command"], order="slot").collect()
    assert {r.chunk: r.exit_code for r in copied} == {0: 127, 1: 0, 2: 0, 3: 0, 4: 0}
    assert [r.stdout for r in copied if r.chunk == 4] == ["p8/1\np8/2\n"]


def test_duplicates_and_groups(spark):
    rows = [("a", 1, 5, "+", 9), ("b", 1, 5, "+", 9), ("c", 1, 5, "+", 3), ("d", 1, 5, "-", 3), ("a", 1, 5, "+", 2)]
    marked = reads.mark_duplicates(spark.createDataFrame(rows, "name string, ref_index int, start bigint, strand string, score bigint"))
    assert sorted((r.name, r.strand, r.duplicate) for r in marked.collect()) == [
        ("a", "+", False), ("a", "+", False), ("b", "+", True), ("c", "+", True), ("d", "-", False),
    ]
    assert reads.read_groups(marked, rgid="X").first().rgid == "X"
    odd = rows + [("u", None, 5, "+", 9), ("v", None, 5, "+", 1), ("w", 1, 5, "+", None)]
    got = reads.mark_duplicates(spark.createDataFrame(odd, "name string, ref_index int, start bigint, strand string, score bigint"))
    assert {r.name: r.duplicate for r in got.collect() if r.name in "uvw"} == {"u": False, "v": False, "w": True}
    assert got.count() == len(odd)


def test_duplicates_of_scanned_reads(spark, tmp_path):
    line = lambda name, flag, contig, pos: "\t".join([name, str(flag), contig, str(pos), "60", "4M", "*", "0", "0", "ACGT", "IIII"])
    (tmp_path / "x.sam").write_text("@HD\n" + "\n".join([line("a", 0, "chr1", 5), line("b", 0, "chr1", 5), line("c", 4, "*", 0), line("d", 4, "*", 0)]) + "\n")
    contigs = spark.createDataFrame([(0, "chr1", 100)], "idx int, name string, length bigint")
    aligned = genome.scan_sam(spark, str(tmp_path / "x.sam"), contigs).selectExpr("qname AS name", "ref_index", "pos AS start", "strand", "40L AS score")
    assert {r.name: r.duplicate for r in reads.mark_duplicates(aligned).collect()} == {"a": False, "b": True, "c": False, "d": False}


def test_encoding_of_reads_without_a_group(spark):
    rows = [(None, "h@"), (None, "?h"), ("s", "!I")]
    got = reads.quality_encoding(spark.createDataFrame(rows, "grp string, qual string")).collect()
    assert sorted((r.grp or "", r.illumina, r.quals) for r in got) == [("", True, [-1, 40]), ("", True, [40, 0]), ("s", False, [0, 40])]


def test_encoding(spark):
    rows = [("s", "!I"), ("s", "II"), ("i", "h@"), ("i", "?h")]
    got = reads.quality_encoding(spark.createDataFrame(rows, "grp string, qual string"))
    assert sorted((r.grp, r.illumina, r.quals, r.bad) for r in got.collect()) == [
        ("i", True, [-1, 40], True), ("i", True, [40, 0], False), ("s", False, [0, 40], False), ("s", False, [40, 40], False),
    ]


def test_concordance(spark):
    schema = "chrom string, pos bigint, ref string, alt string"
    a = spark.createDataFrame([("chr1", 1, "A", "C"), ("chr1", 1, "A", "C"), ("chr1", 2, "A", "C"), ("chr1", 3, "A", "G")], schema)
    b = spark.createDataFrame([("chr1", 1, "A", "C"), ("chr1", 3, "A", "T"), ("chr1", 9, "A", "C")], schema)
    assert tuple(variants.variant_concordance(a, b).first()) == (3, 1, 2)
    assert variants.variant_common(a, b).count() == 1 and variants.variant_missing(a, b).count() == 2


def test_long_intervals_meet_short_ones_in_few_rows(spark):
    """Lengths from 1 to a whole contig on both sides, against all pairs; a long interval makes a handful of rows."""
    rng = random.Random(8)
    make = lambda n: [(rng.randrange(2), s, s + rng.choice([1, 7, 500, 40_000, 3_000_000, 240_000_000])) for s in (rng.randrange(250_000_000) for _ in range(n))]
    rows = {"a": make(150) + [(0, 5, 5), (1, -7, 3)], "b": make(120) + [(0, 0, 250_000_000)]}
    dfs = {k: spark.createDataFrame(v, "chrom int, start bigint, end bigint") for k, v in rows.items()}
    want = sorted((c, max(s, t), min(e, f)) for c, s, e in rows["a"] for d, t, f in rows["b"] if c == d and s < e and t < f and max(s, t) < min(e, f))
    assert sorted(map(tuple, intervals.interval_intersect(dfs["a"], dfs["b"]).collect())) == want
    homes = sorted({r["_home"] for r in intervals._at_home(dfs["a"], "chrom", intervals.OVERLAP_BIN).collect()})
    whole = spark.createDataFrame([(0, 0, 250_000_000)], "chrom int, start bigint, end bigint")
    assert intervals._in_bins(intervals._at_home(whole, "chrom", intervals.OVERLAP_BIN), "b", "chrom", homes, intervals.OVERLAP_BIN).count() <= 2 * len(homes)
