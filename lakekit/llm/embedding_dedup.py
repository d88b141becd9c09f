"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells.

Vectors of one label are dealt into cells by k-means on the unit sphere (trained on a bounded
sample of each label).  Two vectors within the angle t of each other can lie in two cells: a
vector x of cell c also visits cell d > c when x . (c - d) / |c - d| <= sin t, for only then can
a vector that is nearer to d than to c be within t of x.  So no link is lost, whatever the cells.

In a cell, blocks of vectors are multiplied with blocks of vectors; only counts and one link
per vector and block leave a task.  Vectors within t / 2 of the cell's centre are all linked with
each other, so they are counted, not multiplied: a group of near copies of any size costs its
rows, not their square.  Equal vectors are one vector with a number of copies.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import release, staged
from lakekit.llm.components import connected

COSINE = 0.93
CELL_ROWS = 2048        # vectors in a cell, on average
MOST_CELLS = 512        # cells of one label
SAMPLE = 8192           # vectors of one label that its cells are trained on
SPARE = 4               # ids looked at for each one in a sample
ROUNDS = 8
BLOCK = 1024            # vectors in a block, on average
ASSIGN_ROWS = 20_000    # vectors assigned to cells in one task, on average
SLACK = 1e-9            # rounding in the bounds


def directions(vectors: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(values, starts, sizes, whether it has one) of the vectors' directions in double precision:
    vectors of one dimension are normalised together.  One that is NULL, empty or zero, or holds
    NULL or a component that isn't finite, has none."""
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy().astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    values = np.array(vectors.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)      # NULL becomes NaN
    able = np.zeros(len(sizes), bool)
    for width in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == width)
        at = starts[rows][:, None] + np.arange(width)
        x = values[at]
        largest = np.abs(x).max(1)
        good = np.isfinite(largest) & (largest > 0)
        x = x[good] / largest[good, None]
        values[at[good]] = x / np.sqrt((x * x).sum(1))[:, None] + 0.0       # no negative zeros
        able[rows[good]] = True
    return values, starts, sizes, able


def unit(vector) -> np.ndarray | None:
    """The direction of one vector; None if it has none."""
    values, _, _, able = directions(pa.array([vector], pa.list_(pa.float64())))
    return values if able[0] else None


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Up to k unit centres; x holds unit vectors in a fixed order (the first centre is the
    first vector, each further one the vector worst served so far)."""
    chosen, best = [0], x @ x[0]
    for _ in range(1, min(k, len(x))):
        far = int(best.argmin())
        if best[far] > 1 - SLACK:
            break
        chosen.append(far)
        best = np.maximum(best, x @ x[far])
    centres = x[chosen]
    for _ in range(rounds):
        at = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > SLACK, sums / np.maximum(length, SLACK), centres)
    return centres


def _matrix(column, width: int | None = None) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _distinct(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label (with the dimension: vectors of other lengths have no cosine), print, unit."""
    def run(batches):
        for batch in batches:
            values, starts, sizes, able = directions(batch.column(2))
            data = memoryview(values.tobytes())
            prints = [hashlib.blake2b(data[8 * a: 8 * (a + n)], digest_size=16).digest() if ok else None for a, n, ok in zip(starts.tolist(), sizes.tolist(), able.tolist())]
            kept = np.where(able, sizes, 0)
            offsets = np.append(0, np.cumsum(kept)).astype(np.int32)
            units = pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(~able, False)), pa.array(values[np.repeat(able, sizes)]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(prints, pa.binary()), units], names=["id", "label", "print", "unit"])

    able = F.when(F.col(id_col).isNotNull() & F.col(label_col).isNotNull(), F.col(vector_col).cast("array<double>"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.concat_ws("/", F.size(vector_col).cast("string"), F.col(label_col).cast("string")).alias("label"), able)
    return rows.mapInArrow(run, "id long, label string, print binary, unit array<double>")


def _centres(units: DataFrame, sizes: DataFrame) -> DataFrame:
    """label, cell, centre of the labels that need more than one cell."""
    large = sizes.where(F.col("n") > CELL_ROWS)
    # only ids with a small hash go on: a few times the sample, however large the label
    order = F.pmod(F.xxhash64("id"), F.lit(1 << 31))
    near = units.join(large, "label").where(order < F.lit(float(SPARE * SAMPLE * (1 << 31))) / F.col("n"))
    first = Window.partitionBy("label").orderBy(order, "id")
    ids = near.select("label", "id", "n").withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= SAMPLE).select("label", "id", "n")

    def train(sample: pa.Table) -> pa.Table:
        sample = sample.sort_by("id")
        k = min(MOST_CELLS, -(-sample["n"][0].as_py() // CELL_ROWS))
        centres = spherical_kmeans(_matrix(sample["unit"]), k)
        return pa.table({"label": pa.array([sample["label"][0].as_py()] * len(centres)), "cell": pa.array(range(len(centres)), pa.int32()), "centre": pa.array(list(centres), pa.list_(pa.float64()))})

    sample = units.select("label", "id", "unit").join(ids, ["label", "id"])
    return sample.groupBy("label").applyInArrow(train, "label string, cell int, centre array<double>")


def _assigned(units: DataFrame, sizes: DataFrame, centres: DataFrame, cosine: float) -> DataFrame:
    """label, cell, own (else a visit), tight, id, copies, unit: a row for each cell it goes to."""
    salts = sizes.select("label", F.ceil(F.col("n") / ASSIGN_ROWS).cast("long").alias("salts"))
    left = units.join(salts, "label").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts"))).drop("salts", "print")
    right = centres.join(salts, "label").select("label", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), "cell", "centre")
    sine, half = math.sqrt(1 - cosine * cosine), math.sqrt((1 + cosine) / 2)

    def assign(rows: pa.Table, cells: pa.Table) -> pa.Table:
        n = rows.num_rows
        at, cell, own, tight = np.arange(n), np.zeros(n, np.int32), np.ones(n, bool), np.zeros(n, bool)
        if n and cells.num_rows:
            cells = cells.sort_by("cell")
            x, c = _matrix(rows["unit"]), _matrix(cells["centre"])
            near = x @ c.T
            cell = near.argmax(1).astype(np.int32)
            tight = near.max(1) >= half + SLACK
            visits = []
            for k in range(len(c)):
                mine = np.flatnonzero(cell == k)
                gap = np.linalg.norm(c[k] - c[k + 1:], axis=1)
                reach = near[mine, k][:, None] - near[mine, k + 1:] <= (sine + SLACK) * gap + SLACK
                r, d = np.nonzero(reach)
                visits.append((mine[r], (k + 1 + d).astype(np.int32)))
            visitors, to = (np.concatenate(v) for v in zip(*visits))
            at, cell = np.concatenate([at, visitors]), np.concatenate([cell, to])
            own, tight = np.append(own, np.zeros(len(visitors), bool)), np.append(tight, np.zeros(len(visitors), bool))
        rows = rows.take(pa.array(at))
        return pa.table({"label": rows["label"], "cell": pa.array(cell, pa.int32()), "own": pa.array(own), "tight": pa.array(tight), "id": rows["id"], "copies": rows["copies"], "unit": rows["unit"]})

    return (left.groupBy("label", "salt").cogroup(right.groupBy("label", "salt"))
            .applyInArrow(assign, "label string, cell int, own boolean, tight boolean, id long, copies long, unit array<double>"))


def _multiply(assigned: DataFrame, cosine: float) -> DataFrame:
    """id, n (copies of others linked), low (an id it is linked with, over others), by block."""
    cell = ["label", "cell"]
    counts = assigned.groupBy(*cell, "own", "tight").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    split = assigned.join(staged(counts, "cell-blocks"), [*cell, "own", "tight"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    blocks = split.select(*cell, "own", "tight", "part").distinct()
    blocks = staged(blocks, "cell-parts")
    # every block of a cell's own vectors meets its own and visiting ones, but for two tight ones
    index = blocks.where("own").select(*cell, F.col("tight").alias("i_tight"), F.col("part").alias("i_part"))
    query = blocks.select(*cell, F.col("own").alias("q_own"), F.col("tight").alias("q_tight"), F.col("part").alias("q_part"))
    tasks = staged(index.join(query, cell).where("not (i_tight and q_tight)"), "cell-tasks")
    key = [*cell, "i_tight", "i_part", "q_own", "q_tight", "q_part"]
    data = ["id", "copies", "unit"]

    def side(rows: DataFrame, names: dict[str, str]) -> DataFrame:
        held = rows.select(*cell, *(F.col(c).alias(names[c]) for c in names), *data)
        return held.join(tasks, [*cell, *names.values()]).select(*(F.col(c).alias(c) for c in [*key, *data]))

    left = side(split.where("own"), {"tight": "i_tight", "part": "i_part"})
    right = side(split, {"own": "q_own", "tight": "q_tight", "part": "q_part"})

    def product(index: pa.Table, query: pa.Table) -> pa.Table:
        out_id, out_n, out_low = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if index.num_rows and query.num_rows:
            ids, copies, x = index["id"].to_numpy(), index["copies"].to_numpy(), _matrix(index["unit"])
            visit = not query["q_own"][0].as_py()
            for at in range(0, query.num_rows, BLOCK):
                part = query.slice(at, BLOCK)
                q_ids, q_copies = part["id"].to_numpy(), part["copies"].to_numpy()
                hit = (_matrix(part["unit"]) @ x.T >= cosine) & (q_ids[:, None] != ids)
                rows, cols = np.flatnonzero(hit.any(1)), np.flatnonzero(hit.any(0))
                if not len(rows):
                    continue
                hit = hit[np.ix_(rows, cols)]
                low, low_i = _lowest(hit, q_ids[rows], ids[cols])
                out_id.append(q_ids[rows]), out_n.append(hit @ copies[cols]), out_low.append(low)
                # a visit is looked at from one side only, a pair of own vectors from both
                out_id.append(ids[cols]), out_n.append(hit.T @ q_copies[rows] * visit), out_low.append(low_i)
        return pa.table({"id": pa.array(np.concatenate(out_id)), "n": pa.array(np.concatenate(out_n).astype(np.int64)), "low": pa.array(np.concatenate(out_low))})

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(product, "id long, n long, low long")
    together = assigned.where("tight").groupBy(*cell).agg(F.sum("copies").alias("all"), F.min("id").alias("low"))
    return found.union(assigned.where("tight").select(*cell, "id", "copies").join(together, cell).select("id", F.col("all") - F.col("copies"), "low"))


def _lowest(hit: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id in each row's and column's component of a block's links."""
    a, b, most = a.copy(), b.copy(), np.iinfo(np.int64).max
    while True:
        a2 = np.minimum(a, np.where(hit, b, most).min(1))
        b2 = np.minimum(b, np.where(hit, a2[:, None], most).min(0))
        if (a2 == a).all() and (b2 == b).all():
            return a, b
        a, b = a2, b2


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, n_links, component_id, kept: one row per input row.

    A vector that is NULL, empty, zero or holds NULL or non-finite components, and one
    without a label or an id, links with nothing and is kept (its component is its id).
    Vectors of different lengths don't link.  Rows with the same id share a component; equal
    rows count as links of each other only by other ids' rows.  An empty table gives no rows.
    """
    rows = staged(_distinct(vectors, id_col, vector_col, label_col), "embedding-units")
    units = staged(rows.where(F.col("print").isNotNull()).groupBy("label", "print").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.any_value("unit").alias("unit")), "embedding-distinct")
    sizes = staged(units.groupBy("label").agg(F.count("*").alias("n")), "embedding-labels")
    centres = staged(_centres(units, sizes), "embedding-centres")
    assigned = staged(_assigned(units, sizes, centres, cosine), "embedding-cells")
    found = staged(_multiply(assigned, cosine), "embedding-links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    same = rows.join(units.where("copies > 1").select("label", "print", F.col("id").alias("b")), ["label", "print"]).where("id <> b").select(F.col("id").alias("a"), "b")
    labels = connected(found.where("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b")).union(same))
    final = units.select("label", "print", "id", "copies").join(counts, "id", "left").join(labels, "id", "left").where("copies > 1 or n > 0 or component <> id")
    final = staged(final.select("label", "print", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")), "embedding-final")
    release(units, sizes, centres, assigned, found)
    component = F.coalesce("component", "id")
    return (rows.select("id", "label", "print").join(final, ["label", "print"], "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")))
