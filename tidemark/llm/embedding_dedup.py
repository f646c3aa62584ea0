"""Near-duplicate vectors: all pairs by cosine, compared in tiles along principal components.

* Equal vectors are one *node* with a multiplicity: copies are merged before any comparison.
* Nodes are turned to the axes of a principal component analysis, fitted on a bounded sample, with the leading axes
  first. A turn changes no cosine. They are dealt to tiles by a median tree over the leading axes, fitted on the same
  sample; a tile holds vectors of one leaf, is a box there, and is one row of a written table, in the vectors' own precision.
* That table is joined with itself as a product of its files: a task reads two of them where they lie, so nothing is
  shuffled, and the disk holds a vector a fixed number of times, however many tiles it is compared with. Pairs of tiles whose
  boxes are too far apart are dropped by the join's condition, before their vectors move to Python.
* In a pair of tiles, products are summed over the leading axes first; what the other axes can add is at most the product of the
  norms of the two rests. A rest is one more axis, so the sum and that bound are one matrix product, in single precision with room
  for its rounding. The pairs left are computed from the original components in double precision.
* A task returns the number of links of each node and a forest of its links, never the pairs.

Every row is compared, with every row whose tile can be near enough. A vector that is null, empty or zero, or has null or
non-finite components, links with nothing; so do vectors of different lengths with each other. Ties and repeated rows
are links like any other. Rows find the figures of their vector by its MD5. The input is read more than once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidemark.llm.components import components
from tidemark.llm.spread import written
from tidemark.session import settings

THRESHOLD = 0.9
# The axes and the tree are fitted on at most so many rows.
SAMPLE = 4000
# Rows of a tile and bytes of its vectors, at most.
TILE = 32768
TILE_BYTES = 8 << 20
BLOCK = 512
# Bytes of vectors in a file of tiles; few rows are spread over up to so many files.
PART_BYTES = 32 << 20
PARTS = 16
# Bytes of turned vectors that a task keeps for the next pairs of tiles.
KEPT_BYTES = 32 << 20
# Rounding of sums in any order.
SLACK = 1e-9
# Squared norms outside of these may have lost digits, or all.
SOUND = (1e-280, 1e280)


@dataclass(frozen=True)
class Axes:
    """A rotation with the leading axes first, and the cuts of a median tree: of node k the axis k's depth says."""

    turn: np.ndarray
    cuts: np.ndarray  # of a complete binary tree, level by level

    @property
    def depth(self) -> int:
        return int(np.log2(len(self.cuts) + 1))

    def leaf(self, turned: np.ndarray) -> np.ndarray:
        place = np.zeros(len(turned), np.int64)
        for level in range(self.depth):
            above = turned[:, level % turned.shape[1]] > self.cuts[place]
            place = 2 * place + 1 + above
        return place - len(self.cuts)


def fit_axes(sample: np.ndarray, depth: int) -> Axes:
    """``sample``: unit vectors. The axes of their second moments, by descending spread about the mean."""
    centred = sample - sample.mean(0)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    turn = vectors[:, ::-1].copy()
    turned = sample @ turn
    cuts = np.zeros(2**depth - 1)
    place = np.zeros(len(turned), np.int64)
    for level in range(depth):
        axis = turned[:, level % turned.shape[1]]
        for node in range(2**level - 1, 2 ** (level + 1) - 1):
            own = axis[place == node]
            cuts[node] = np.median(own) if len(own) else 0.0
        place = 2 * place + 1 + (axis > cuts[place])
    return Axes(turn, cuts)


def _matrix(data, kind: str, size: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, size)


def _rows(column: pa.Array, kind: str, size: int) -> np.ndarray:
    return _matrix(b"".join(column.to_pylist()), kind, size)


def _unit(a: np.ndarray) -> np.ndarray:
    a = a.astype("f8")
    a /= np.abs(a).max(1, keepdims=True)
    a /= np.sqrt((a * a).sum(1, keepdims=True))
    return a


def _screen(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Unit vectors on the axes of ``turn`` and, as one axis more, the norm of what these leave."""
    lead = x @ turn
    rest = np.sqrt(np.maximum((x * x).sum(1) - (lead * lead).sum(1), 0))
    return np.c_[lead, rest].astype("f4")


def _slack(axes: int) -> float:
    """What rounding to single precision can take from a product of two rows of a screen."""
    return (axes + 8) * 2.0**-23


def leading(sample: np.ndarray, turn: np.ndarray, threshold: float) -> int:
    """With how many leading axes the comparison is cheapest, by the pairs of the sample.

    The weights are nanoseconds as measured: of an axis, of a pair that is left without need, and of looking for pairs in a block.
    """
    x, size = sample[:2000], len(turn)
    linked = int((x @ x.T >= threshold).sum())
    best, cost = size, np.inf
    for n in sorted({min(size, k) for k in (7, 15, 23, 31, 47, 63, 95, 127, 255, 511, size)}):
        own = _screen(x, turn[:, :n])
        left = int((own @ own.T >= threshold - _slack(n)).sum()) - linked
        share = max(left, 0) / max(len(x) * (len(x) - 1), 1)
        nanoseconds = 0.02 * (n + 1) + 100 * share + 0.4 * min(1, share * BLOCK * BLOCK)
        if nanoseconds < cost:
            best, cost = n, nanoseconds
    return best


@dataclass(frozen=True)
class Side:
    """Some vectors as given, and their screen."""

    vectors: np.ndarray
    screen: np.ndarray

    def __len__(self) -> int:
        return len(self.vectors)

    def block(self, lo: int, rows: int) -> "Side":
        return Side(self.vectors[lo : lo + rows], self.screen[lo : lo + rows])


def _linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the vectors of two lists, one by one, have a cosine of at least the threshold."""
    a, b = a.astype("f8"), b.astype("f8")
    norms = np.sqrt(np.einsum("nd,nd->n", a, a)) * np.sqrt(np.einsum("nd,nd->n", b, b))
    return np.einsum("nd,nd->n", a, b) / norms >= threshold


def _close(left: Side, right: Side, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place on the left, place on the right) with a cosine of at least the threshold."""
    bound = left.screen @ right.screen.T
    least = np.float32(threshold - _slack(left.screen.shape[1]))
    if not bound.max() >= least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    some = np.flatnonzero(bound.max(1) >= least)
    i, j = np.nonzero(bound[some] >= least)
    i = some[i]
    sure = np.zeros(len(i), bool)
    if len(i) > bound.size // 32:
        # Mostly near ones: whole products are cheaper, and leave few pairs that are not clear.
        product = _unit(left.vectors) @ _unit(right.vectors).T
        i, j = np.nonzero(product >= threshold - SLACK)
        sound = [_sound(side.vectors) for side in (left, right)]
        sure = (product[i, j] >= threshold + SLACK) & sound[0][i] & sound[1][j]
    for open_ in np.array_split(np.flatnonzero(~sure), 1 + len(i) // (1 << 16)):
        sure[open_] = _linked(left.vectors[i[open_]], right.vectors[j[open_]], threshold)
    return i[sure], j[sure]


def _sound(a: np.ndarray) -> np.ndarray:
    a = a.astype("f8")
    squares = np.einsum("nd,nd->n", a, a)
    return (squares > SOUND[0]) & (squares < SOUND[1])


class _Found:
    """Links of the nodes of the tiles that a task has seen, and their union into the least places."""

    def __init__(self):
        self.first: dict[int, int] = {}
        self.node = self.links = self.label = np.zeros(0, np.int64)

    def place(self, tile: int, node: np.ndarray) -> int:
        """Where the nodes of the tile start."""
        if tile not in self.first:
            self.first[tile] = len(self.node)
            self.label = np.r_[self.label, np.arange(len(node)) + len(self.node)]
            self.node = np.r_[self.node, node]
            self.links = np.r_[self.links, np.zeros(len(node), np.int64)]
        return self.first[tile]

    def count(self, at: int, i: np.ndarray, copies: np.ndarray) -> None:
        counts = np.bincount(i, copies).astype(np.int64)
        self.links[at : at + len(counts)] += counts

    def unite(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            apart = self.label[i] != self.label[j]
            i, j = i[apart], j[apart]
            if not len(i):
                return
            a, b = self.label[i], self.label[j]
            least = np.minimum(a, b)
            np.minimum.at(self.label, a, least)
            np.minimum.at(self.label, b, least)
            while (self.label != self.label[self.label]).any():
                self.label = self.label[self.label]

    def batch(self) -> pa.RecordBatch:
        some = self.links > 0
        columns = [pa.array(c[some]) for c in (self.node, self.links, self.node[self.label])]
        return pa.RecordBatch.from_arrays(columns, ["node", "links", "least"])


def _compare(turn: np.ndarray, kind: str, threshold: float):
    """Links within pairs of tiles (``first_`` and ``other_``)."""
    size, rows, limit = len(turn), BLOCK, KEPT_BYTES

    def run(batches):
        found, kept = _Found(), {}

        def side(batch, k, name):
            tile = batch.column(f"{name}_tile")[k].as_py()
            node, copies = (np.frombuffer(batch.column(f"{name}_{c}")[k].as_buffer(), "<i8") for c in ("nodes", "copies"))
            vectors = _matrix(batch.column(f"{name}_vectors")[k].as_buffer(), kind, size)
            if tile not in kept:
                while kept and (len(kept) + 1) * max(s.nbytes for s in kept.values()) > limit:
                    del kept[next(iter(kept))]
                kept[tile] = _screen(_unit(vectors), turn)
            return tile, Side(vectors, kept[tile]), copies, found.place(tile, node)

        for batch in batches:
            for k in range(batch.num_rows):
                first, left, left_copies, at = side(batch, k, "first")
                other, right, right_copies, to = side(batch, k, "other")
                for lo in range(0, len(left), rows):
                    for hi in range(lo if first == other else 0, len(right), rows):
                        i, j = _close(left.block(lo, rows), right.block(hi, rows), threshold)
                        if first == other and lo == hi:
                            i, j = i[i < j], j[i < j]
                        if len(i):
                            found.count(at + lo, i, right_copies[hi + j])
                            found.count(to + hi, j, left_copies[lo + i])
                            found.unite(at + lo + i, to + hi + j)
        yield found.batch()

    return run


def _step(table: DataFrame, label: str, **values: str) -> DataFrame:
    """The frame as a written table. The shuffles on the way to it go at once, so that steps do not add up on disk."""
    with settings(table.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true", **values):
        return written(table, label)


def _can_link() -> Column:
    """Whether a row can link: never null."""
    v = F.transform("embedding", lambda c: c.cast("double"))
    good = (
        F.col("embedding").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        & F.exists(v, lambda c: c != 0)
    )
    return F.coalesce(good, F.lit(False)) & F.col("vec_id").isNotNull()


def _kind(vectors: DataFrame) -> str:
    """How components are kept: as given if they are single, in double precision otherwise."""
    return "<f4" if isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else "<f8"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector: little-endian components of the rows that can link."""
    rows, kind = vectors.select("vec_id", "embedding").where(_can_link()), _kind(vectors)
    arrow = pa.float32() if kind == "<f4" else pa.float64()

    def run(batches):
        for batch in batches:
            column = batch.column("embedding")
            flat = column.flatten().cast(arrow).to_numpy(zero_copy_only=False)
            sizes = np.diff(np.asarray(column.offsets))
            edges = np.concatenate([[0], np.cumsum(sizes)])
            places = pa.py_buffer((edges * np.dtype(kind).itemsize).astype("<i4"))
            data = pa.py_buffer(np.ascontiguousarray(flat, kind))
            blobs = pa.Array.from_buffers(pa.binary(), len(sizes), [None, places, data])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), blobs], ["vec_id", "vector"])

    id_kind = vectors.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {id_kind}, vector binary")


TILES = "tile long, low array<double>, high array<double>, nodes binary, copies binary, vectors binary"


def tiles(own: DataFrame, axes: Axes, kind: str, files: int, limit: int) -> DataFrame:
    """The nodes (node, copies, vector) in rows of at most ``limit``, each of one leaf, with their box on the tree's axes."""
    size = len(axes.turn)
    lead = Axes(np.ascontiguousarray(axes.turn[:, : min(axes.depth, size) or 1]), axes.cuts)

    def dealt(batches):
        for batch in batches:
            leaf = lead.leaf(_unit(_rows(batch.column("vector"), kind, size)) @ lead.turn)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    def tile(held: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        vectors = b"".join(table.column("vector").to_pylist())
        x = _unit(_matrix(vectors, kind, size)) @ lead.turn
        columns = [pa.array([number]), *(pa.array([list(box)], pa.list_(pa.float64())) for box in (x.min(0), x.max(0)))]
        columns += [pa.array([table.column(c).to_numpy().astype("<i8").tobytes()], pa.binary()) for c in ("node", "copies")]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([vectors], pa.binary())], ["tile", "low", "high", "nodes", "copies", "vectors"]
        )

    def packed(batches):
        number = TaskContext.get().partitionId() << 32
        held, count, last = [], 0, None
        for batch in batches:
            leaf = batch.column("leaf").to_numpy()
            at = 0
            while at < len(leaf):
                if count and (count == limit or leaf[at] != last):
                    yield tile(held, number)
                    held, count, number = [], 0, number + 1
                last = leaf[at]
                end = min(int(np.searchsorted(leaf, last, "right")), at + limit - count)
                held.append(batch.slice(at, end - at))
                count, at = count + end - at, end
        if count:
            yield tile(held, number)

    leaves = own.select("node", "copies", "vector").mapInArrow(dealt, "node long, copies long, vector binary, leaf long")
    spread = leaves.repartitionByRange(files, "leaf", "node").sortWithinPartitions("leaf")
    return _step(spread.mapInArrow(packed, TILES), "tiles")


def links(nodes: DataFrame, kind: str, size: int, threshold: float = THRESHOLD) -> DataFrame:
    """Links and a forest of the nodes (node, vector, copies) of one vector length, as a written table."""
    width = np.dtype(kind).itemsize * size
    own = nodes.where(F.octet_length("vector") == width)
    n = own.count()
    sample = _unit(
        _matrix(b"".join(r[0] for r in own.orderBy(F.xxhash64("vector")).limit(SAMPLE).select("vector").collect()), kind, size)
    )
    limit = max(1, min(TILE, TILE_BYTES // width))
    depth = int(np.clip(np.ceil(np.log2(max(n / limit, 1))), 0, int(np.log2(SAMPLE / 16))))
    axes = fit_axes(sample, depth)
    files = max(-(-n * width // PART_BYTES), min(PARTS, -(-n // limit)))
    dealt = tiles(own, axes, kind, files, limit)

    first, other = (dealt.select(*[F.col(c).alias(f"{name}_{c}") for c in dealt.columns]) for name in ("first", "other"))
    # Unit vectors are near if their distance is at most this; boxes further apart have no link.
    reach = float(np.sqrt(max(2 - 2 * threshold, 0)) + 1e-6)
    gaps = [
        F.greatest(F.col("first_low")[k] - F.col("other_high")[k], F.col("other_low")[k] - F.col("first_high")[k], F.lit(0.0))
        for k in range(min(depth, size) or 1)
    ]
    near = sum((gap * gap for gap in gaps), F.lit(0.0)) <= reach**2
    # Each two tiles meet once, on either side by turns, so that the product's tasks have as much to do each.
    even = (F.col("first_tile") + F.col("other_tile")) % 2 == 0
    once = (F.col("first_tile") == F.col("other_tile")) | ((F.col("first_tile") < F.col("other_tile")) == even)
    pairs = first.hint("shuffle_replicate_nl").join(other, near & once)
    turn = np.ascontiguousarray(axes.turn[:, : leading(sample, axes.turn, threshold)])
    found = pairs.select(*[f"{name}_{c}" for name in ("first", "other") for c in ("tile", "nodes", "copies", "vectors")])
    # A file of tiles is one partition; a pair of tiles is one batch.
    whole = str(2 * PART_BYTES)
    return _step(
        found.mapInArrow(_compare(turn, kind, threshold), "node long, links long, least long"),
        "links",
        spark__sql__files__maxPartitionBytes=whole,
        spark__sql__files__openCostInBytes=whole,
        spark__sql__execution__arrow__maxRecordsPerBatch="1",
    )


def classes(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (least id reachable) and kept."""
    rows, kind = usable(vectors), _kind(vectors)
    name = F.unhex(F.md5("vector")).alias("name")
    nodes = _step(
        rows.groupBy("vector")
        .agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
        .select(F.monotonically_increasing_id().alias("node"), "vec_id", "copies", name, "vector"),
        "nodes",
    )
    widths = [r[0] for r in nodes.select(F.octet_length("vector")).distinct().collect()]
    found = None
    for width in sorted(widths):
        own = links(nodes, kind, width // np.dtype(kind).itemsize, threshold)
        found = own if found is None else found.unionAll(own)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "node long, links long, least long")
    joined = components(found.select(F.col("least").alias("a"), F.col("node").alias("b")))
    least_id = joined.join(nodes, "node").groupBy("component").agg(F.min("vec_id").alias("component_id"))
    by_vector = _step(
        nodes.join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
        .join(joined.join(least_id, "component").select("node", "component_id"), "node", "left")
        .select(
            "name",
            F.coalesce("component_id", "vec_id").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "classes",
    )
    # A row has the figures of its own vector, also where its id is repeated with another one.
    linked = rows.select("vec_id", name).join(by_vector, "name").select(
        "vec_id", F.col("n_links").cast("long"), "component_id"
    )
    alone = vectors.where(~_can_link()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        linked.unionAll(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
