"""Near-duplicate embeddings by an exact comparison of tiles that stay where they are stored.

Distinct vectors are stored once, in tiles of bounded size, one row for each tile.
Every two tiles meet in a task that reads both from the store, so no vector is
copied or shuffled for the comparison: disk grows with the rows, not with the
pairs, and a task's memory with its tiles.

Two tiles are compared by one bound.  Vectors of length one are turned to
principal axes of a sample; a few leading coordinates and the length of the rest
bound the cosine from above (Cauchy-Schwarz), as a short matrix product.  What
passes is verified exactly by its cosine in double precision; where much passes,
a product of all coordinates decides all but those within its rounding of
``least``.  Inside a tile vectors lie in order of their nearest pivot, and blocks
whose centres are too far apart for their radii are not compared, which prunes
most of clustered data.  On data spread evenly over many dimensions the work is
that of a full comparison in the leading coordinates.

Equal vectors are one from the start.  A task keeps a number of links and a local
group for each of its vectors and returns these, so a group of any size is never
emitted as pairs.

Axes, leading coordinates and pivots only steer the work.

Edge cases: vectors that are NULL, zero, or hold NULL or non-finite components
link with nothing, nor do vectors of different lengths; a row without vec_id
takes part, and a group of such rows alone has a NULL component; repeated rows
link with one another; an empty table gives no row.  ``vectors`` is read twice
and must give the same rows each time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from shiftscore.llm.common import store, text_batches
from shiftscore.llm.components import components

LEAST = 0.95
#: Vectors, and components, of a tile at most; tiles that a task reads from either side; all only steer the work.
PIECE, TILE_VALUES, TASK_TILES = 16_384, 1 << 20, 8
#: Pivots, and vectors of the sample.
PIVOTS, SAMPLE = 256, 2048
#: Rows compared at once with so many others, and rows of a block that is left out as a whole.
STRIP, CHUNK, BLOCK = 128, 2048, 128
#: Share of a strip's pairs from which on it is decided by a full product, and cost of a pair that passes the bound in vain.
MUCH, IN_VAIN = 0.02, 200_000
#: Tiles are large rows: a row group holds a few, and sizes are looked at after each.
TILE_FILES = {"parquet.block.size": 8 << 20, "parquet.enable.dictionary": "false", "parquet.block.size.row.check.min": 1,
              "parquet.block.size.row.check.max": 1, "parquet.page.size.row.check.min": 1}


def rounding(k: int) -> float:
    """More than a product of two unit vectors with ``k`` coordinates is off in single precision."""
    return (k + 8) * 1.2e-7


def units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one in double precision, and the lengths."""
    vectors = vectors.astype(np.float64)
    with np.errstate(all="ignore"):
        norms = np.linalg.norm(vectors, axis=1)
        return vectors / norms[:, None], norms


def leading(axes: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Leading coordinates and the length of the rest, in single precision."""
    x = unit @ axes
    return np.column_stack([x, np.sqrt(np.maximum(0, (unit * unit).sum(axis=1) - (x * x).sum(axis=1)))]).astype(np.float32)


def chained(points: np.ndarray) -> np.ndarray:
    """``points`` in such an order that each is followed by the nearest of those left, so that neighbours are in a row."""
    near, at, order = points @ points.T, 0, []
    for _ in range(len(points)):
        order.append(at)
        near[:, at] = -np.inf
        at = int(near[at].argmax())
    return points[order]


class Space:
    """Leading axes and pivots for vectors of one length."""

    def __init__(self, d: int, sample: np.ndarray, least: float):
        self.d, self.least = d, least
        self.gap = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-5
        unit = units(sample)[0]
        unit = unit[np.isfinite(unit).all(axis=1)]
        # Axes by one half and their number by the other, or the axes would seem better than they are.
        half, unit = unit[::2], unit[1::2] if len(unit) > 1 else unit
        half = half - half.mean(axis=0) if len(half) else half
        turn = np.linalg.eigh(half.T @ half)[1][:, ::-1]
        above = np.triu(np.ones((len(unit), len(unit)), dtype=bool), 1) & (unit @ unit.T < least)
        best = math.inf
        for k in [*(x for x in (4, 8, 12, 16, 20, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512) if x < d), d]:
            axes = np.ascontiguousarray(turn[:, :k])
            lead = leading(axes, unit)
            # Coordinates that a pair costs: a product's fixed part, the product, and an exact check of what passes in vain.
            cost = 40 + k + IN_VAIN * (above & (lead @ lead.T >= least)).sum() / max(1, above.sum())
            if cost < best:
                best, self.axes, self.pivots = cost, axes, chained(lead[:PIVOTS])


class Tile:
    """Vectors in order of their nearest pivot, with ids, numbers of copies and blocks."""

    def __init__(self, space: Space, number: int, uid: np.ndarray, copies: np.ndarray, vectors: np.ndarray):
        unit, norms = units(vectors)
        lead = leading(space.axes, unit)
        order = np.argsort((lead @ space.pivots.T).argmax(axis=1), kind="stable") if len(space.pivots) else np.arange(len(lead))
        self.number, self.uid, self.copies, self.vectors, self.norms = number, uid[order], copies[order], vectors[order], norms[order]
        self.lead = lead[order]
        self.starts = np.arange(0, len(lead), BLOCK)
        self.centres, self.radii = self.balls(self.starts, BLOCK)

    def __len__(self) -> int:
        return len(self.uid)

    def unit(self, at: np.ndarray) -> np.ndarray:
        return units(self.vectors[at])[0].astype(np.float32)

    def balls(self, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        centres = np.array([self.lead[s:s + size].mean(axis=0, dtype=np.float64) for s in starts])
        return centres, np.array([np.linalg.norm(self.lead[s:s + size] - c, axis=1).max() for s, c in zip(starts, centres)])


def linked(space: Space, x: Tile, y: Tile) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``x`` and ``y`` of the pairs that link, by strips."""
    least, same = space.least, x is y
    bound = np.float32(least - 2 * rounding(space.axes.shape[1] + 1))
    strips = np.arange(0, len(x), STRIP)
    centres, radii = x.balls(strips, STRIP)
    far = np.sqrt(np.maximum(0, (centres * centres).sum(axis=1)[:, None] + (y.centres * y.centres).sum(axis=1) - 2 * centres @ y.centres.T))
    apart = far - radii[:, None] - y.radii > space.gap  # False for what is not a number
    if same:
        apart |= y.starts + BLOCK <= strips[:, None]
    products, passes = np.empty(STRIP * CHUNK, dtype=np.float32), np.empty(STRIP * CHUNK, dtype=bool)
    for s, out in zip(strips, apart):
        if out.all():
            continue
        blocks = np.flatnonzero(~out)
        lo, hi = y.starts[blocks[0]], min(y.starts[blocks[-1]] + BLOCK, len(y))
        places = np.arange(lo, hi)
        if len(blocks) == blocks[-1] - blocks[0] + 1:
            others = y.lead[lo:hi]
        else:
            places = places[np.repeat(~out[blocks[0]:blocks[-1] + 1], BLOCK)[:hi - lo]]
            others = y.lead[places]
        lead = x.lead[s:s + STRIP]
        for c in range(0, len(places), CHUNK):
            some = others[c:c + CHUNK]
            shape = len(lead), len(some)
            product, passed = (room[:shape[0] * shape[1]].reshape(shape) for room in (products, passes))
            np.greater_equal(np.matmul(lead, some.T, out=product), bound, out=passed)
            rows = np.flatnonzero(passed.any(axis=1))
            if not len(rows):
                continue
            i, j = np.nonzero(passed[rows])
            sure = i[:0], j[:0]
            if len(i) > MUCH * passed.size:
                cosine, near = x.unit(s + rows) @ y.unit(places[c:c + CHUNK]).T, 2 * rounding(space.d)
                sure, (i, j) = np.nonzero(cosine >= least + near), np.nonzero(np.abs(cosine - least) < near)
            for (i, j), verified in ((sure, True), ((i, j), False)):
                for cut in range(0, len(i), 50_000):
                    p, q = s + rows[i[cut:cut + 50_000]], places[c + j[cut:cut + 50_000]]
                    if same:
                        p, q = p[p < q], q[p < q]
                    if not verified:
                        with np.errstate(all="ignore"):
                            cosine = np.einsum("ij,ij->i", x.vectors[p].astype(np.float64), y.vectors[q].astype(np.float64)) / (x.norms[p] * y.norms[q])
                        p, q = p[cosine >= least], q[cosine >= least]
                    if len(p):
                        yield p, q


def local_groups(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``size`` places the least one that links reach."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class Met:
    """Numbers of links and local groups of the vectors of a task."""

    def __init__(self):
        self.first, self.waiting, self.edges = {}, [], 0
        self.uid = self.n = self.label = np.empty(0, dtype=np.int64)

    def place(self, tile: Tile) -> int:
        """Place of the tile's first vector."""
        if tile.number not in self.first:
            self.first[tile.number] = len(self.uid)
            self.label = np.concatenate([self.label, np.arange(len(self.uid), len(self.uid) + len(tile))])
            self.uid = np.concatenate([self.uid, tile.uid])
            self.n = np.concatenate([self.n, np.zeros(len(tile), dtype=np.int64)])
        return self.first[tile.number]

    def add(self, x: Tile, y: Tile, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.place(x), self.place(y)
        self.n[a:a + len(x)] += np.bincount(i, y.copies[j], len(x)).astype(np.int64)
        self.n[b:b + len(y)] += np.bincount(j, x.copies[i], len(y)).astype(np.int64)
        i, j = self.label[a + i], self.label[b + j]
        new = i != j
        if new.any():
            self.waiting.append((i[new], j[new]))
            self.edges += int(new.sum())
        if self.edges > 200_000:
            self.merge()

    def merge(self) -> None:
        """Take in the links that wait; all labels stay places of the least vector reached."""
        if self.edges:
            ends = np.concatenate([np.concatenate(c) for c in zip(*self.waiting)])
            nodes, at = np.unique(ends, return_inverse=True)
            into = np.arange(len(self.label))
            into[nodes] = nodes[local_groups(len(nodes), at[:self.edges], at[self.edges:])]
            self.label = into[self.label]
        self.waiting, self.edges = [], 0

    def results(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        met = np.flatnonzero(self.n)
        for cut in range(0, len(met), 50_000):
            some = met[cut:cut + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.uid[some]), pa.array(self.n[some]), pa.array(self.uid[self.label[some]])], ["uid", "n", "other"])


def tiles_of(distinct: DataFrame) -> DataFrame:
    """Stored tiles of distinct vectors: ``tile, d``, the vectors as one binary, and the other columns as arrays."""
    piece, values = PIECE, TILE_VALUES
    single = isinstance(distinct.schema["vector"].dataType.elementType, FloatType)
    if not single:
        distinct = distinct.withColumn("vector", F.col("vector").cast("array<double>"))
    others = [f for f in distinct.schema if f.name != "vector"]

    def tile(d: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        ends = pa.array([0, rows.num_rows], pa.int32())
        whole = [pa.ListArray.from_arrays(ends, rows.column(f.name).chunk(0)) for f in others]
        content = rows.column("vector").chunk(0).flatten().to_numpy(zero_copy_only=False).astype("<f4" if single else "<f8")
        return pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), *whole, pa.array([content.tobytes()], pa.binary())],
                                          ["d", *(f.name for f in others), "vectors"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, total = {}, {}, 0
        for batch in batches:
            length = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            lengths = np.unique(length).tolist()
            for d in lengths:
                part, most = batch if len(lengths) == 1 else batch.filter(pa.array(length == d)), max(1, min(piece, values // d))
                while part.num_rows:
                    some = part.slice(0, most - rows.get(d, 0))
                    part = part.slice(some.num_rows)
                    held.setdefault(d, []).append(some)
                    rows[d] = rows.get(d, 0) + some.num_rows
                    total += some.num_rows * d
                    if rows[d] == most:
                        total -= most * d
                        yield tile(d, held.pop(d))
                        del rows[d]
            if total > 4 * values:  # many lengths
                for d, parts in held.items():
                    yield tile(d, parts)
                held, rows, total = {}, {}, 0
        for d, parts in held.items():
            yield tile(d, parts)

    made = distinct.mapInArrow(of, "d int, " + ", ".join(f"`{f.name}` array<{f.dataType.simpleString()}>" for f in others) + ", vectors binary")
    width = F.lit(4 if single else 8)
    return store(made.withColumns({"tile": F.monotonically_increasing_id(), "width": width}), "tiles", TILE_FILES)


def sample_of(tiles: DataFrame, d: int) -> np.ndarray:
    """At most ``SAMPLE`` vectors out of a few tiles."""
    few = [r["tile"] for r in tiles.orderBy(F.xxhash64("tile"), "tile").select("tile").limit(16).collect()]
    each = SAMPLE // len(few)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, content in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.frombuffer(content, f"<f{width}").reshape(-1, d)
                x = x[np.random.default_rng(42).permutation(len(x))[:each]].astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["some"])

    found = tiles.filter(F.col("tile").isin(few)).select("width", "vectors").mapInArrow(of, "some binary").collect()
    return np.concatenate([np.frombuffer(r["some"]).reshape(-1, d) for r in found])


def compared(tiles: DataFrame, d: int, n: int, least: float) -> DataFrame:
    """``uid, n, other``: links counted, and a member of the same local group, among ``n`` tiles of vectors of length ``d``."""
    spark = tiles.sparkSession
    shared = spark.sparkContext.broadcast(Space(d, sample_of(tiles, d), least))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, met, x, others = shared.value, Met(), None, {}
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: column[r] for name, column in zip(batch.schema.names, batch.columns)}

                def tile(side: str) -> Tile | None:
                    number, uid, copies, width, content = (row[f"{side}_{c}"] for c in ("tile", "uid", "copies", "width", "vectors"))
                    return Tile(space, number.as_py(), uid.values.to_numpy(zero_copy_only=False), copies.values.to_numpy(zero_copy_only=False),
                                np.frombuffer(content.as_buffer(), f"<f{width.as_py()}").reshape(-1, d)) if content.is_valid else None

                x = tile("a") or x
                if (y := tile("b")) is not None:
                    others[y.number] = y
                if row["meet"].as_py():
                    y = others[row["b_tile"].as_py()]
                    assert x.number == row["a_tile"].as_py()
                    x = y if x.number == y.number else x
                    for i, j in linked(space, x, y):
                        met.add(x, y, i, j)
        yield from met.results()

    # Enough tasks for all cores; beyond that some tiles in each, so that a task returns its vectors once.
    parts = min(n, max(math.ceil(n / TASK_TILES), 4 * math.ceil(math.sqrt(spark.sparkContext.defaultParallelism))))
    columns = ["uid", "copies", "width", "vectors"]
    one = tiles.select("tile", *columns).coalesce(parts).withColumn("first", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0)
    a, b = (one.toDF(*[f"{side}_{c}" for c in one.columns]).hint("shuffle_replicate_nl") for side in "ab")
    # Each two tiles meet once, in this order or that, so that tasks have about the same to do.
    even = F.xxhash64("a_tile").bitwiseXOR(F.xxhash64("b_tile")).bitwiseAND(F.lit(1)) == 0
    meet = (F.col("a_tile") <= F.col("b_tile")) == even
    # A task gets the content of each tile once: of one side's with the other's first.
    pairs = a.join(b, meet | F.col("a_first") | F.col("b_first")).select(
        "a_tile", "b_tile", meet.alias("meet"), *[F.when(F.col("b_first"), F.col(f"a_{c}")).alias(f"a_{c}") for c in columns],
        *[F.when(F.col("a_first"), F.col(f"b_{c}")).alias(f"b_{c}") for c in columns])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    text_batches(spark, 1)
    try:
        return store(pairs.mapInArrow(of, "uid long, n long, other long"), "links")
    finally:
        text_batches(spark, int(before))


def links_of(reps: DataFrame, d: int, n: int, least: float) -> DataFrame:
    """``uid, n, other`` for ``n`` distinct vectors of length ``d`` (``uid, copies, vector``)."""
    tiles = tiles_of(reps)
    return compared(tiles, d, tiles.count(), least)


def near_duplicates(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (``vec_id, embedding``)."""
    spark = vectors.sparkSession
    text_batches(spark)
    v = F.col("embedding")
    plain = v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    usable = plain & F.exists(v, lambda x: x != 0)
    hashes = {"h0": F.xxhash64(F.lit(1), v), "h1": F.xxhash64(F.lit(2), v)}
    vec_id = F.col("vec_id").cast("long")
    rows = store(vectors.select(vec_id.alias("vec_id"), F.when(usable, F.size(v)).alias("d"), *[c.alias(k) for k, c in hashes.items()]), "vectors")
    size = rows.agg(F.count("d"), F.sum("d")).first()
    most = max(1, math.ceil(size[0] / PIECE), math.ceil((size[1] or 0) / TILE_VALUES),
               min(spark.sparkContext.defaultParallelism, math.ceil(size[0] / 2048)))
    # The only vectors that are shuffled: one of each that a task finds equal.
    distinct = vectors.filter(usable).groupBy(*[c.alias(k) for k, c in hashes.items()]).agg(
        F.min(vec_id).alias("first_id"), F.count("*").alias("copies"), F.any_value(v).alias("vector")).coalesce(most)
    tiles = tiles_of(distinct.withColumn("uid", F.monotonically_increasing_id()))
    met = None
    for r in tiles.groupBy("d").count().orderBy("d").collect():  # a row for each length
        one = compared(tiles.filter(F.col("d") == r["d"]), r["d"], r["count"], least)
        met = one if met is None else met.union(one)
    if met is None:
        met = spark.createDataFrame([], "uid long, n long, other long")
    reps = tiles.select(F.explode(F.arrays_zip("uid", "h0", "h1", "first_id", "copies")).alias("r")).select("r.*")
    groups = components(met.select(F.col("uid").alias("a"), F.col("other").alias("b")))
    numbers = met.groupBy("uid").agg(F.sum("n").alias("n"))
    member = reps.join(numbers, "uid", "left").join(groups, reps["uid"] == groups["node"], "left")
    member = store(member.select("h0", "h1", "first_id", "copies", F.coalesce("n", F.lit(0)).alias("n"),
                                 F.coalesce("component", "uid").alias("component")), "members")
    least_id = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = member.join(least_id, "component").select(
        "h0", "h1", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    good = rows.filter("d IS NOT NULL").join(classes, ["h0", "h1"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("d IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``embeddings``, linked at a cosine of 0.95."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id)::BIGINT AS n_links,
       r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = e.vec_id
"""
