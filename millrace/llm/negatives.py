"""Hard negatives by exact search in an inverted multi-index.

Vectors are cut in two halves with a codebook each, fitted on a bounded sample; a pair of codes is a cell.  All rows are
indexed: sorted by cell and laid into shards of ``SHARD_ROWS`` rows, so that a crowded cell spans as many shards as it needs.
A search asks for the best rows inside a window of scores.  It goes to the shard with the highest bound first, which raises
the window's lower end, and then to every other shard whose bound reaches that end.  Inside a shard a heap runs over pairs of
codes by the sum of their half-score bounds (score with the centre plus the radius times the anchor half's length), and stops
when all windows are certified: full, with no bound left that reaches their last row.  Nothing is approximate.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.numbering import numbered
from millrace.plans.storage import materialize

SAMPLE = 16_384  # rows that the codebooks are fitted on
SHARD_ROWS = 4096
ANCHORS = 1024  # anchors of a task at most, about
CELL_ROWS = 256  # rows for a cell on average, while there are at most MOST_CODES codes
MOST_CODES = 128
STEP = 2048  # rows between two looks at the windows
LOW, HIGH = -(1 << 62), 1 << 62


@dataclass
class Books:
    """What a task needs to know: the codebooks, and which cells lie in which shard."""

    width: int
    kind: str  # numpy type of a component in ``v``
    exact: str  # numpy type in which all inner products are exact
    centres: tuple[np.ndarray, np.ndarray]
    shards: np.ndarray  # of the entries, ascending
    cells: np.ndarray  # two codes of each entry
    radii: np.ndarray  # two radii of each entry


@dataclass
class Index:
    rows: DataFrame  # row, vec_id, label, v, c1, c2, shard
    books: Books


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256) -> DataFrame:
    """``row, vec_id, label, x``: rows that take part, components as ``floor(scale * x)``; ``row`` tells equal rows apart.

    Rows without an id, a label or a vector, or with a component that is NULL or not finite, take no part.
    """
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    named = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), x.alias("x"), finite.alias("_ok"))
    kept = named.filter("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL AND _ok")
    ints = F.transform("x", lambda c: F.floor(c * scale).cast("bigint"))
    return materialize(kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.col("label").cast("bigint").alias("label"), ints.alias("x")), "vectors")


def _matrix(column: pa.Array, width: int, kind: str) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), kind)
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _packed(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Rows of a binary column of ``width`` components each."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _codebook(x: np.ndarray, codes: int, rounds: int = 8) -> np.ndarray:
    """Centres of ``x`` by Lloyd's rounds from evenly spread rows; a code without rows keeps its centre."""
    order = np.lexsort(x.T[::-1]) if x.shape[1] else np.arange(len(x))
    centres = x[order[np.linspace(0, len(x) - 1, codes).astype(int)]].copy()
    for _ in range(rounds):
        of = _nearest(x, centres)
        n = np.bincount(of, minlength=codes)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * (x @ centres.T)).argmin(1)


def indexed(rows: DataFrame) -> Index | None:
    """The index of ``usable`` rows; None where there are none.  Shorter vectors count as padded with zeros."""
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"), F.max(F.array_max(F.transform("x", F.abs))).alias("most")).head()
    if not shape.n:
        return None
    size, width, most = shape.n, shape.width + shape.width % 2, int(shape.most or 0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    largest = most * most * max(1, width)
    exact = "float32" if largest < 1 << 24 else "float64" if largest < 1 << 53 else "object"
    half = width // 2
    sample = rows.orderBy(F.xxhash64("vec_id", "x"), "row").limit(SAMPLE).select("x").toArrow().column(0)  # bounded
    fit = _matrix(sample, width, "f8")
    codes = int(max(1, min(MOST_CODES, (size / CELL_ROWS) ** 0.5, len(fit))))
    centres = (_codebook(fit[:, :half], codes), _codebook(fit[:, half:], codes))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(3), width, "i8")
            sides = [x[:, :half].astype("f8"), x[:, half:].astype("f8")]
            of = [_nearest(s, c) for s, c in zip(sides, centres, strict=True)]
            far = [np.sqrt(((s - c[o]) ** 2).sum(1)) for s, c, o in zip(sides, centres, of, strict=True)]
            v = pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())
            arrays = [*batch.columns[:3], v, *(pa.array(o, pa.int32()) for o in of), *(pa.array(f, pa.float64()) for f in far)]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "vec_id", "label", "v", "c1", "c2", "r1", "r2"])

    schema = "row bigint, vec_id bigint, label bigint, v binary, c1 int, c2 int, r1 double, r2 double"
    placed = numbered(rows.mapInArrow(assign, schema), [F.col("c1"), F.col("c2"), F.col("row")], name="place")
    placed = materialize(placed.withColumn("shard", F.floor((F.col("place") - 1) / SHARD_ROWS).cast("int")).drop("place"), "index")
    # One entry for each cell of a shard: at most the cells plus the shards.
    entries = placed.groupBy("shard", "c1", "c2").agg(F.max("r1").alias("r1"), F.max("r2").alias("r2")).orderBy("shard", "c1", "c2").toArrow()
    column = lambda name: entries.column(name).to_numpy()
    cells, radii = np.stack([column("c1"), column("c2")]), np.stack([column("r1"), column("r2")])
    return Index(placed.drop("r1", "r2"), Books(width, kind, exact, centres, column("shard"), cells, radii))


REQUEST = "anchor bigint, label bigint, v binary, slots array<int>, los array<bigint>, his array<bigint>, want int, same boolean"
FOUND = "anchor bigint, slot int, score bigint, vec_id bigint"


def _bounds(q: np.ndarray, books: Books) -> tuple[np.ndarray, np.ndarray]:
    """Half-score bounds of anchors (rows of ``q``) for each entry of the directory."""
    half = q.shape[1] // 2
    out = []
    for k, side in enumerate((q[:, :half], q[:, half:])):
        scores = side @ books.centres[k].T
        reach = np.sqrt((side**2).sum(1))[:, None] * books.radii[k]
        out.append(scores[:, books.cells[k]] + reach)
    return out[0], out[1]


def _slack(bounds: np.ndarray) -> np.ndarray:
    """Bounds that rounding cannot have made too small."""
    return bounds + np.abs(bounds) * 1e-9 + 1


def _routed(requests: DataFrame, books: Books, first: bool) -> DataFrame:
    """Requests with each ``shard`` they go to: the one of highest bound, or all others that can hold a row of a window."""
    starts = np.flatnonzero(np.concatenate([[True], books.shards[1:] != books.shards[:-1]]))
    shards = books.shards[starts]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                one, two = _bounds(_packed(batch.column(2), books.kind, books.width).astype("f8"), books)
                reach = np.maximum.reduceat(_slack(one) + _slack(two), starts, axis=1)
                best = reach.argmax(1)
                if first:
                    at, to = np.arange(len(best)), best
                else:
                    least = np.array([min(los, default=HIGH) for los in batch.column(4).to_pylist()], "f8")
                    open_ = reach >= least[:, None]
                    open_[np.arange(len(best)), best] = False
                    at, to = np.nonzero(open_)
                for k in range(0, len(at), 4096):
                    part = batch.take(pa.array(at[k : k + 4096]))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shards[to[k : k + 4096]], pa.int32())], [*part.schema.names, "shard"])

    return requests.mapInArrow(route, REQUEST + ", shard int")


def _visit(x: np.ndarray, starts: np.ndarray, code1: np.ndarray, code2: np.ndarray, b1: np.ndarray, b2: np.ndarray) -> Iterator[tuple[int, float]]:
    """Cells of a shard by falling sums of half-score bounds, each with its sum: the multi-sequence walk over two sorted lists."""
    cell = {(a, b): k for k, (a, b) in enumerate(zip(code1.tolist(), code2.tolist(), strict=True))}
    order1, order2 = np.argsort(-b1, kind="stable"), np.argsort(-b2, kind="stable")
    s1, s2 = b1[order1].tolist(), b2[order2].tolist()
    order1, order2 = order1.tolist(), order2.tolist()
    heap, left = [(-(s1[0] + s2[0]), 0, 0)], len(cell)
    while heap and left:
        bound, i, j = heapq.heappop(heap)
        if (k := cell.get((order1[i], order2[j]))) is not None:
            left -= 1
            yield k, -bound
        # Each pair is pushed once: down the first list from any place, along the second from its head only.
        if j + 1 < len(s2):
            heapq.heappush(heap, (-(s1[i] + s2[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(s1):
            heapq.heappush(heap, (-(s1[i + 1] + s2[0]), i + 1, 0))


class _Shard:
    """Rows of one shard by cell, with local codes, so that the two lists hold no code that the shard has no row of."""

    def __init__(self, table: pa.Table, books: Books):
        c1, c2 = table.column("c1").to_numpy(), table.column("c2").to_numpy()
        order = np.lexsort((table.column("vec_id").to_numpy(), c2, c1))
        self.row, self.vec_id, self.label = (table.column(c).to_numpy()[order] for c in ("row", "vec_id", "label"))
        ints = _packed(table.column("v").combine_chunks(), books.kind, books.width)[order]
        self.x = ints.astype(books.exact) if books.exact != "object" else np.array(ints.tolist(), object).reshape(ints.shape)
        c1, c2 = c1[order], c2[order]
        self.starts = np.flatnonzero(np.concatenate([[True], (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])]))
        self.ends = np.append(self.starts[1:], len(c1))
        self.exact, half = books.exact, books.width // 2
        self.codes, self.local, self.radius = [], [], []
        for k, code in enumerate((c1, c2)):
            codes, local = np.unique(code, return_inverse=True)
            centres = books.centres[k][codes]
            side = (ints[:, :half] if k == 0 else ints[:, half:]).astype("f8")
            radius = np.zeros(len(codes))
            np.maximum.at(radius, local, np.sqrt(((side - centres[local]) ** 2).sum(1)))
            self.codes.append(centres)
            self.local.append(local[self.starts])
            self.radius.append(radius)

    def search(self, anchor: int, label: int, q: np.ndarray, slots, los, his, want: int, same: bool) -> Iterator[tuple[int, int, int, int]]:
        """``anchor, slot, score, vec_id`` of the best ``want`` rows of each window, other rows than the anchor's."""
        half, flat = len(q) // 2, q.astype("f8")
        b = [_slack(c @ s + r * np.sqrt((s**2).sum())) for c, r, s in zip(self.codes, self.radius, (flat[:half], flat[half:]), strict=True)]
        exact = q.astype(self.exact) if self.exact != "object" else np.array(q.tolist(), object)
        windows = [_Window(lo, hi, want) for lo, hi in zip(los, his, strict=True)]
        held, size = [], 0

        def look() -> None:
            spans = [slice(self.starts[k], self.ends[k]) for k in held]
            take = lambda column: np.concatenate([column[s] for s in spans])
            scores = np.concatenate([self.x[s] @ exact for s in spans]).astype("i8")
            at = np.flatnonzero((scores >= min(w.lo for w in windows)) & ((take(self.label) == label) == same) & (take(self.row) != anchor))
            if len(at):
                ids = take(self.vec_id)[at]
                for w in windows:
                    w.add(scores[at], ids)

        for k, bound in _visit(self.x, self.starts, *self.local, *b):
            if all(w.certain(bound) for w in windows):
                break
            held.append(k)
            size += self.ends[k] - self.starts[k]
            if size >= STEP:
                look()
                held, size = [], 0
        if held:
            look()
        for slot, w in zip(slots, windows, strict=True):
            for score, vec_id in zip(w.scores.tolist(), w.ids.tolist(), strict=True):
                yield anchor, slot, score, vec_id


class _Window:
    """The best rows with ``lo <= score <= hi``: higher scores first, equal ones by smaller id."""

    def __init__(self, lo: int, hi: int, want: int):
        self.lo, self.hi, self.want = lo, hi, want
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = (scores >= self.lo) & (scores <= self.hi)
        if not inside.any():
            return
        scores, ids = np.concatenate([self.scores, scores[inside]]), np.concatenate([self.ids, ids[inside]])
        if len(scores) > self.want:
            scores, ids = self._best(scores, ids)
        order = np.lexsort((ids, -scores))[: self.want]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.want:
            self.lo = max(self.lo, int(self.scores[-1]))

    def _best(self, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kth = -np.partition(-scores, self.want - 1)[self.want - 1]
        return scores[scores >= kth], ids[scores >= kth]

    def certain(self, bound: float) -> bool:
        """Whether no row of a score up to ``bound`` can come in: below the window, or below its last row when it is full."""
        return bound < self.lo


def _asked(routed: DataFrame, index: Index) -> DataFrame:
    """Answers of every shard to the requests that went to it; a shard with many requests answers in several tasks."""
    routed = materialize(routed, "routed")
    tasks = routed.groupBy("shard").agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("tasks"))  # a row for each shard
    left = routed.join(tasks, "shard").withColumn("task", F.pmod(F.xxhash64("anchor"), "tasks").cast("int")).drop("tasks")
    right = index.rows.join(tasks, "shard").withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))).drop("tasks")
    books = index.books

    def answer(key, asked: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if asked.num_rows and rows.num_rows:
            shard = _Shard(rows, books)
            q = _packed(asked.column("v").combine_chunks(), books.kind, books.width)
            names = ("anchor", "label", "slots", "los", "his", "want", "same")
            for k, (anchor, label, slots, los, his, want, same) in enumerate(zip(*(asked.column(c).to_pylist() for c in names), strict=True)):
                found += shard.search(anchor, label, q[k], slots, los, his, want, same)
        columns = list(zip(*found, strict=True)) or [[]] * 4
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["anchor", "slot", "score", "vec_id"])

    return left.groupBy("shard", "task").cogroup(right.groupBy("shard", "task")).applyInArrow(answer, FOUND)


def _best_of(found: DataFrame, want: int) -> DataFrame:
    """The first ``want`` answers of each window, with their ``rank``; a window has ``want`` answers of a shard at most."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= want)


def searched(requests: DataFrame, index: Index, want: int) -> DataFrame:
    """``anchor, slot, score, vec_id, rank``: the best ``want`` rows of each window of ``requests`` (columns as ``REQUEST``)."""
    requests = materialize(requests, "requests")
    first = materialize(_best_of(_asked(_routed(requests, index.books, True), index), want), "first")
    # A window that is full already needs no rows below its last one.
    full = first.filter(F.col("rank") == want).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("full"))
    raised = requests.join(full, "anchor", "left").withColumn(
        "los", F.zip_with("slots", "los", lambda s, lo: F.greatest(lo, F.coalesce(F.try_element_at("full", s), lo)))).select(*requests.columns)
    rest = _asked(_routed(raised, index.books, False), index)
    return materialize(_best_of(first.drop("rank").unionByName(rest), want), "answers")


def hard_negatives(
    vectors: DataFrame, *, anchors: str = "vec_id % 50 = 0", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows of the condition ``anchors`` over ``vec_id`` and ``label``.  An anchor's positives are its best
    ``positives`` other rows of the same label; for each, its best ``negatives`` rows of other labels are returned whose score
    is between ``low`` and ``high`` percent of the positive's.  A score is the inner product of ``floor(scale * x)``; equal
    scores go by smaller id.  Which rows take part: ``usable``.  Repeated rows are rows of their own, as anchors, positives and
    negatives; only an anchor itself is left out.  A positive score of 0 has negatives of score 0, one below 0 has none.  Fewer
    rows than asked for give all there are; an empty table gives none.  Scores must fit 64 bits.  Other columns are not read.
    """
    spark = vectors.sparkSession
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    rows = usable(vectors, vec_id, vector, label, scale)
    index = indexed(rows)
    if index is None:
        return spark.createDataFrame([], out)
    chosen = materialize(index.rows.filter(F.expr(anchors)).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "v"), "anchors")
    bigints = lambda *xs: F.array(*(F.lit(x).cast("bigint") for x in xs))
    ask = chosen.select("anchor", "label", "v", F.array(F.lit(0)).alias("slots"), bigints(LOW).alias("los"), bigints(HIGH).alias("his"),
                        F.lit(positives).alias("want"), F.lit(True).alias("same"))
    found = searched(ask, index, positives).select("anchor", F.col("rank").alias("slot"), F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id"))
    # low * p <= 100 * n <= high * p in whole numbers; `div` rounds to zero, which is the floor from 0 on.
    windows = found.filter("positive_score >= 0").groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        "slot", F.expr(f"(positive_score * {low} + 99) div 100").alias("lo"), F.expr(f"(positive_score * {high}) div 100").alias("hi")))).alias("w"))
    ask = chosen.join(windows, "anchor").select(
        "anchor", "label", "v", F.col("w.slot").alias("slots"), F.col("w.lo").alias("los"), F.col("w.hi").alias("his"),
        F.lit(negatives).alias("want"), F.lit(False).alias("same"))
    answers = searched(ask, index, negatives).select("anchor", "slot", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return answers.join(found, ["anchor", "slot"]).join(chosen.select("anchor", "anchor_id"), "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
