"""Near duplicates by one-permutation MinHash, with every link confirmed on the full sets of word shingles.

A document's shingle hashes are split into ``bins`` by their leading bits and the least of each bin kept (one
permutation); an empty bin takes the value of another one, found by its own sequence of random probes (optimal
densification).  ``rows`` neighbouring bins make a band, and documents that agree on a band share a bucket.  Each
bucket gives one star of candidate pairs, from a centre to its other members.  Copies of a set are one document here.

A star alone can miss a link between two members that are both unlike the centre.  So, after the stars' components
are known, members of a bucket whose components differ are compared as well, as far as an upper bound on their
similarity allows: the shingles that a document shares with no other one in question cannot be in an intersection.
A large bucket is dealt to cells of a bounded size, and a cell counts the intersections of all its pairs at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.links import components
from millrace.llm.words import WordHashes, binary, mixed, pieces, small_batches, windows, words_of
from millrace.plans.storage import materialize

SHINGLE = 5
SIMILARITY_PCT = 80
BANDS = 24
ROWS = 4  # at similarity 0.8 a pair misses all 24 bands of 4 with probability 3e-6
CELL = 2 << 20  # shingles, 16 MB, of a bucket's rows that ask, and of those that answer, in one cell of the comparison
CELL_ROWS = 8192
COMMON = 256  # a shingle that one in so many pairs of a cell share is counted by a product of matrices
BLOCK = 1 << 22  # numbers in a matrix, or shared shingles counted at once


def _probes(bins: int) -> np.ndarray:
    """For every bin a fixed random order of all bins."""
    rng = np.random.default_rng(20170)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def densified(shingles: np.ndarray, bins: int, probes: np.ndarray) -> np.ndarray:
    """The one-permutation signature of sorted distinct shingle hashes (at least one)."""
    bits = bins.bit_length() - 1
    at = (shingles >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    filled = np.zeros(bins, bool)
    filled[at[first]] = True
    least = np.zeros(bins, np.uint64)
    least[at[first]] = shingles[first]
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = probes[empty]
        least[empty] = least[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return least


def _shingle_sets(batch: pa.RecordBatch, shingle: int, hashes: WordHashes) -> Iterator[tuple[int, np.ndarray]]:
    for doc, text in zip(batch.column("doc_id").to_pylist(), binary(batch.column("text")), strict=True):
        yield doc, np.unique(windows(hashes.of(words_of(text)), shingle))


def signatures(docs: DataFrame, shingle: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, copy`` (digest of the whole set) and ``buckets``, one hash for each band."""
    bins = 1 << (bands * rows - 1).bit_length()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, probes = WordHashes(), _probes(bins)
        for batch in (p for b in batches for p in pieces(b)):
            ids, sizes, copies, buckets = [], [], [], []
            for doc, found in _shingle_sets(batch, shingle, hashes):
                ids.append(doc)
                sizes.append(len(found))
                copies.append(xxhash.xxh3_128_digest(found.tobytes()))
                if len(found):
                    least = densified(found, bins, probes)[: bands * rows].reshape(bands, rows)
                    buckets.append(_band_hashes(least).view(np.int64).tolist())
                else:
                    buckets.append([])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(copies, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "copy", "buckets"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        sign, "doc_id bigint, n_shingles bigint, copy binary, buckets array<bigint>"
    )


def _band_hashes(least: np.ndarray) -> np.ndarray:
    out = np.arange(1, len(least) + 1, dtype=np.uint64)
    for k in range(least.shape[1]):
        out = mixed(out + least[:, k])
    return out


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``id, shingles``: the full sets, as sorted hashes."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in (p for b in batches for p in pieces(b)):
            found = list(_shingle_sets(batch, shingle, hashes))
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in found], pa.int64()), pa.array([s.view(np.int64) for _, s in found], pa.list_(pa.int64()))],
                ["id", "shingles"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(sets, "id bigint, shingles array<bigint>")


def _linked(common: Column, n_a: Column, n_b: Column, pct: int) -> Column:
    """100 * intersection >= pct * union."""
    return 100 * common >= pct * (n_a + n_b - common)


def confirmed(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("_a", "_b"))
    return both.filter(_linked(common, F.size("_a"), F.size("_b"), pct)).select("a", "b")


def link_groups(reps: DataFrame, docs: DataFrame, shingle: int, pct: int) -> DataFrame:
    """``node, component`` of the documents ``id, n, buckets`` that are linked with another one."""
    rows = reps.select("id", "n", F.explode("buckets").alias("bucket"))
    # Another centre in each band: the order of ids differs from bucket to bucket.
    centre = F.min_by(F.struct("id", "n"), F.xxhash64("bucket", "id")).alias("centre")
    buckets = materialize(rows.groupBy("bucket").agg(F.count("*").alias("m"), centre).filter("m > 1").drop("m"), "buckets")
    members = materialize(rows.join(buckets, "bucket"), "members")

    star = members.filter(F.col("centre.id") != F.col("id")).filter(
        (100 * F.least("n", "centre.n") >= pct * F.greatest("n", "centre.n"))
    )
    pairs = materialize(star.select(F.col("centre.id").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    asked = members.select("id").distinct()
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    texts = named.join(asked.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
    # Rows that repeat an id and a text repeat its set; one of them is enough.
    sets = shingle_sets(texts.dropDuplicates(["doc_id", "text"]), shingle)
    sets = materialize(sets.withColumn("n", F.size("shingles").cast("bigint")).withColumn("set", F.xxhash64("shingles")), "sets")
    links = materialize(confirmed(pairs, sets, pct), "links")
    labels = materialize(components(links), "labels")

    more = materialize(_unlike_centre(members, labels, sets, pct), "more")
    return components(links.union(more))


def _unlike_centre(members: DataFrame, labels: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """Links ``a, b`` between different components of one bucket, one of each two components of a cell.

    The centre is left out, as its star has been confirmed.  ``m``, the shingles of a document that another document in
    question has too, bounds every intersection.  All but the largest component of a bucket ask, all members answer.
    """
    tagged = members.filter((F.col("centre.id") != F.col("id")) | (F.col("centre.n") != F.col("n"))).select("bucket", "id", "n")
    tagged = tagged.join(labels.withColumnRenamed("node", "id"), "id", "left")
    opened = materialize(_split(tagged.withColumn("component", F.coalesce("component", "id"))).drop("main"), "opened")
    asked = opened.select("id").distinct()
    own = (
        sets.join(asked, "id", "left_semi").select("id", "set", F.explode("shingles").alias("s"))
        .groupBy("s").agg(F.count("*").alias("df"), F.min("id").alias("id"), F.min("set").alias("set")).filter("df = 1")
        .groupBy("id", "set").agg(F.count("*").alias("own"))
    )
    m = F.col("n") - F.coalesce("own", F.lit(0))
    # Unlike sets have a union of one more than their intersection at least.
    sized = opened.join(sets.select("id", "n", "set"), ["id", "n"]).join(materialize(own, "own"), ["id", "set"], "left").filter(
        (100 * m >= pct * F.col("n")) & (100 * m >= pct * (m + 1))
    )
    left = materialize(_split(sized.select("bucket", "id", "n", "component", "set")), "left")
    cells = _in_cells(left.withColumn("asks", F.col("component") != F.col("main")))
    carried = cells.join(sets.select("id", "set", "shingles"), ["id", "set"]).drop("set")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            found = _cell_links(cell, pct)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    dealt = carried.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return dealt.mapInArrow(compare, "a bigint, b bigint").distinct()


def _split(rows: DataFrame) -> DataFrame:
    """The rows of buckets with several components, and ``main``, the largest of them."""
    parts = rows.groupBy("bucket", "component").agg(F.count("*").alias("k"))
    split = parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("k", "component")).alias("main"))
    return rows.join(materialize(split.filter("parts > 1").drop("parts"), "split"), "bucket")


def _in_cells(rows: DataFrame) -> DataFrame:
    """``bucket, i, j`` with the rows that ask and answer there: every one that asks meets every one that answers in one cell.

    A bucket is one cell up to ``CELL`` shingles or ``CELL_ROWS`` rows that ask or answer; beyond, either is dealt to parts.
    """
    def many(of: Column) -> Column:
        return F.greatest(F.ceil(F.sum(F.when(of, F.col("n"))) / CELL), F.ceil(F.count_if(of) / CELL_ROWS), F.lit(1)).cast("int")

    parts = rows.groupBy("bucket").agg(many(F.col("asks")).alias("asking"), many(F.lit(True)).alias("answering"))
    at = rows.join(materialize(parts, "parts"), "bucket")
    at = at.withColumn("_i", F.pmod(F.hash("id", "set"), "asking")).withColumn("_j", F.pmod(F.hash("set", "id"), "answering"))
    answers = F.transform(F.sequence(F.lit(0), F.col("asking") - 1), lambda i: F.struct(i.alias("i"), F.col("_j").alias("j")))
    asks = F.transform(F.sequence(F.lit(0), F.col("answering") - 1), lambda j: F.struct(F.col("_i").alias("i"), j.alias("j")))
    at = at.withColumn("_at", F.explode(F.when(F.col("asks"), F.array_union(answers, asks)).otherwise(answers)))
    return at.select(
        "bucket", "_at.i", "_at.j", "id", "set", "component",
        (F.col("asks") & (F.col("_at.i") == F.col("_i"))).alias("asks"), (F.col("_at.j") == F.col("_j")).alias("answers"),
    )


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each cell, which come one cell after another."""
    held, last = [], None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("bucket", "i", "j")], axis=1)
        ends = [*(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for start, end in zip([0, *ends], ends, strict=False):
            if start == end:
                continue
            if (key := keys[start].tobytes()) != last and held:
                yield pa.concat_batches(held)
                held = []
            last = key
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.concat_batches(held)


def _cell_links(cell: pa.RecordBatch, pct: int) -> np.ndarray:
    """Rows ``a, b``: of each two components with links between rows that ask and rows that answer, one link."""
    asks, answers = (cell.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "answers"))
    ask, have = np.flatnonzero(asks), np.flatnonzero(answers)
    ids, component = (cell.column(c).to_numpy() for c in ("id", "component"))
    shingles = cell.column("shingles")
    sizes = shingles.value_lengths().to_numpy().astype(np.int64)
    kinds, kind = np.unique(component, return_inverse=True)
    found: dict[int, tuple[int, int]] = {}
    for x, y, common in _intersections(shingles.flatten().to_numpy(), sizes, ask, have):
        linked = (100 + pct) * common >= pct * (sizes[x][:, None] + sizes[y])
        at, to = np.nonzero(linked & (kind[x][:, None] != kind[y]))
        a, b = x[at], y[to]
        of_two = np.minimum(kind[a], kind[b]) * len(kinds) + np.maximum(kind[a], kind[b])
        for two, k in zip(*(u.tolist() for u in np.unique(of_two, return_index=True)), strict=True):
            found.setdefault(two, (ids[a[k]], ids[b[k]]))
    return np.array(list(found.values()), np.int64).reshape(-1, 2)


def _intersections(shingles: np.ndarray, sizes: np.ndarray, ask: np.ndarray, have: np.ndarray) -> Iterator[tuple]:
    """Blocks of ``ask`` and ``have`` and how many shingles their rows share, from all rows' shingles and their numbers.

    Shingles that many of the pairs share are a product of two matrices, others are counted from lists of their rows.
    """
    number = np.unique(shingles, return_inverse=True)[1]
    starts = np.cumsum(sizes) - sizes
    wide = int(number.max(initial=-1)) + 1

    def taken(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the rows, and the number of the shingle."""
        of = np.repeat(np.arange(len(rows)), sizes[rows])
        within = np.arange(len(of)) - np.repeat(np.cumsum(sizes[rows]) - sizes[rows], sizes[rows])
        return of, number[np.repeat(starts[rows], sizes[rows]) + within]

    in_ask, in_have = (np.bincount(taken(rows)[1], minlength=wide) for rows in (ask, have))
    often = np.flatnonzero(in_ask * in_have * COMMON >= max(1, len(ask) * len(have)))
    column = np.full(wide, -1)
    column[often] = np.arange(len(often))
    rare = (in_ask > 0) & (in_have > 0) & (column < 0)
    step = max(1, min(1024, BLOCK // max(1, len(often))))

    def dense(of: np.ndarray, which: np.ndarray, rows: int) -> np.ndarray:
        out = np.zeros((rows, len(often)), np.float32)
        at = column[which] >= 0
        out[of[at], column[which[at]]] = 1
        return out

    for x in (ask[k : k + step] for k in range(0, len(ask), step)):
        of, which = taken(x)
        left = dense(of, which, len(x))
        of, which = of[rare[which]], which[rare[which]]
        order = np.argsort(which, kind="stable")
        of, held = of[order], np.bincount(which, minlength=wide)
        first = np.cumsum(held) - held
        for y in (have[k : k + step] for k in range(0, len(have), step)):
            to, which = taken(y)
            common = (left @ dense(to, which, len(y)).T).astype(np.int64)
            to, which = to[held[which] > 0], which[held[which] > 0]
            ends = np.cumsum(held[which])
            cuts = np.searchsorted(ends, np.arange(BLOCK, ends[-1] + BLOCK if len(ends) else 0, BLOCK), side="right")
            for part in np.split(np.arange(len(which)), cuts):
                many = held[which[part]]
                within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                np.add.at(common, (of[np.repeat(first[which[part]], many) + within], np.repeat(to[part], many)), 1)
            yield x, y, common


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, pct: int = SIMILARITY_PCT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row for each row of ``docs``.

    Two documents are linked if ``100 * |intersection| >= pct * |union|`` of their sets of ``shingle``-word shingles.
    ``component_id`` is the smallest id that links lead to.  A text of fewer words is one shingle; an empty or NULL
    text has none and is linked with nothing.  Rows that share an id are one document and share its component.  A row
    without an id is linked with nothing, has no component, and is kept.  An empty table gives no rows.
    """
    named = small_batches(docs).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signed = materialize(signatures(named, shingle), "signatures")
    known = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = materialize(
        known.groupBy("copy").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets")), "reps"
    )
    groups = materialize(link_groups(reps.drop("copy"), named, shingle, pct), "groups")
    classes = materialize(
        reps.select("copy", "id").join(groups.withColumnRenamed("node", "id"), "id", "left")
        .select("copy", F.coalesce("component", "id").alias("class")), "classes"
    )
    found = signed.drop("buckets").join(classes, "copy", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("class")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )
