"""Embedding near-dedup by PCA-ordered tiled comparison.

Unit vectors are turned to principal axes, largest variance first. Tiles of vectors accumulate products over
the leading axes; the product of the norms of what is left bounds the rest, and pairs that cannot reach the
threshold any more are dropped before the next axes are read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helio.llm.common import cut
from helio.llm.components import components, group_of

STEPS = (8, 16, 32)
#: Components that are turned to principal axes at most (those behind stay as they are), and rows that the axes are fitted on.
MOST_AXES, SAMPLE = 1024, 20_000
BLOCK = 1024


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first where squares would leave the range of doubles."""
    top = np.abs(x).max(1, keepdims=True, initial=0)
    odd = ((top < 1e-100) | (top > 1e100)) & (top > 0)
    if odd.any():
        x = np.where(odd, x / np.where(odd, top, 1), x)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def by_length(column: pa.Array):
    """(rows, matrix of doubles) for each length that occurs in a column of lists without nulls."""
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(ends)
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        yield rows, values[ends[rows][:, None] + np.arange(size)[None, :]]


def turned(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors along the axes; what lies behind the axes' components stays, a shorter vector counts as filled up with zeros."""
    n = len(axes)
    return np.concatenate([x[:, :n] @ axes[: x.shape[1]], x[:, n:]], axis=1)


def principal_axes(classes: DataFrame, dims: int, rows: int) -> np.ndarray:
    """Columns: axes of the unit vectors of up to about SAMPLE classes (node, v), largest variance first; fitted in one task on the first ``dims`` components.

    The axes only decide how soon a pair is dropped, so a sample does not change results.
    """
    places = 1 << 40
    near = F.pmod(F.xxhash64("node"), F.lit(places)) < int(min(1.0, SAMPLE / max(rows, 1)) * places)

    def run(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            for _, x in by_length(batch.column("v")):
                x = unit(x)[:, :dims]
                total[: x.shape[1], : x.shape[1]] += x.T @ x
        values, axes = np.linalg.eigh(total)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(axes[:, np.argsort(-values)])], pa.binary())], ["axes"])

    row = classes.where(near).select("v").coalesce(1).mapInArrow(run, "axes binary").first()
    return pickle.loads(row["axes"]) if row else np.eye(dims)


def linked(a: np.ndarray, b: np.ndarray, axes: np.ndarray, least: float, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of a and b (unit vectors) whose product reaches ``least``; of the ``same`` rows each pair once. Works in blocks of BLOCK rows."""
    ra, rb = turned(a, axes), turned(b, axes)
    dims = ra.shape[1]
    steps = [d for d in STEPS if d < dims]
    rest = {d: tuple(np.sqrt(np.maximum(0, (r[:, d:] ** 2).sum(1))) for r in (ra, rb)) for d in steps}
    out = [(np.zeros(0, np.int64),) * 2]
    for p in range(0, len(a), BLOCK):
        for q in range(p if same else 0, len(b), BLOCK):
            x, y = ra[p : p + BLOCK], rb[q : q + BLOCK]
            if steps:
                d = steps[0]
                i, j = np.nonzero(x[:, :d] @ y[:, :d].T + rest[d][0][p : p + BLOCK, None] * rest[d][1][None, q : q + BLOCK] >= least - 1e-9)
            else:
                i, j = np.nonzero(x @ y.T >= least - 1e-9)
            if same and p == q:
                once = i < j
                i, j = i[once], j[once]
            if steps:
                part = np.einsum("ij,ij->i", x[i, : steps[0]], y[j, : steps[0]])
                for lo, hi in zip(steps[:-1], steps[1:], strict=True):
                    part = part + np.einsum("ij,ij->i", x[i, lo:hi], y[j, lo:hi])
                    alive = part + rest[hi][0][p + i] * rest[hi][1][q + j] >= least - 1e-9
                    i, j, part = i[alive], j[alive], part[alive]
            sure = np.einsum("ij,ij->i", a[p + i], b[q + j]) >= least
            out.append((p + i[sure], q + j[sure]))
    i, j = (np.concatenate(x) for x in zip(*out, strict=True))
    return i, j


def near_vectors(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", tile_cells: int = 1 << 18) -> DataFrame:
    """One row per input row: ``id_col``, n_links, component_id, kept.

    Rows link when their labels are equal and not null (``label_col`` None: all rows) and their cosine in
    double precision is at least ``least``. Vectors that are null, empty, zero, of other lengths, or hold null
    or non-finite components link with nothing; very small and very large finite ones are scaled first. Equal vectors are
    compared once and counted as often as they occur. ``component_id`` is the least id reachable over links. A
    null id counts as a link of others but stands alone itself (component null, kept). An empty table gives no
    rows; ids of any type that can be ordered will do, and other columns are ignored.

    Vectors of a label are dealt into cells along the leading axes, as wide as two linked vectors can be apart:
    one axis for small labels, up to three for large ones. Cells are dealt into tiles of about ``tile_cells``
    numbers; each tile meets those of its cell and of the cells beside it that hold any. So no label meets in one task.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), (F.col(label_col) if label_col else F.lit(0)).alias("label"))
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col("v").isNotNull() & F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("_key", F.when(F.coalesce(fine, F.lit(False)), F.sha2(F.concat_ws("|", F.col("label").cast("string"), F.col("v").cast("string")), 256)))
    good, bad = rows.where("_key IS NOT NULL"), rows.where("_key IS NULL")
    grouped = good.groupBy("_key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"), F.first("label").alias("label"))
    classes = cut(grouped.withColumn("node", F.monotonically_increasing_id()).withColumn("size", F.size("v")))
    longest, count = classes.agg(F.max("size"), F.count(F.lit(1))).first()
    axes = principal_axes(classes, min(longest or 1, MOST_AXES), count)
    reach = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-9
    shared = vectors.sparkSession.sparkContext.broadcast(axes)
    cells = ("c1", "c2", "c3")

    def place(batches):
        axes = shared.value
        for batch in batches:
            at = np.zeros((len(batch), 3), np.int64)
            for index, x in by_length(batch.column("v")):
                along = unit(x)[:, : len(axes)] @ axes[: x.shape[1], :3]
                at[index, : along.shape[1]] = np.floor(along / reach).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(at[:, k]) for k in range(3))], [*batch.schema.names, *cells])

    kinds = {c: classes.schema[c].dataType.simpleString() for c in ("label", "v")}
    placed = classes.select("node", "n", "v", "label", "size").mapInArrow(place, f"node long, n long, v {kinds['v']}, label {kinds['label']}, size int, c1 long, c2 long, c3 long")
    tile = F.greatest(F.lit(16), F.floor(F.lit(tile_cells) / F.col("size")))
    per_label = classes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("_n"))
    used = cut(per_label.select("label", "size", (F.col("_n") > 4 * tile).alias("_two"), (F.col("_n") > 64 * tile).alias("_three")))
    placed = placed.join(used, ["label", "size"]).withColumns({"c2": F.when(F.col("_two"), F.col("c2")).otherwise(F.lit(0).cast("long")), "c3": F.when(F.col("_three"), F.col("c3")).otherwise(F.lit(0).cast("long"))}).drop("_two", "_three")
    placed = cut(placed)
    where = ["label", "size", *cells]
    tiles = cut(placed.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / F.first(tile)).alias("tiles")))
    steps = F.array(*[F.struct(*[F.lit(d).cast("long").alias(f"d{k}") for k, d in enumerate(s, 1)]) for s in np.ndindex(3, 3, 3)])
    moved = tiles.withColumn("_d", F.explode(F.transform(steps, lambda s: F.struct(*[(s[f"d{k}"] - 1).alias(f"d{k}") for k in (1, 2, 3)]))))
    # Each cell tells the cells beside it how many tiles it has: from there, it lies in direction d.
    moved = moved.select("label", "size", *[(F.col(c) - F.col(f"_d.d{k}")).alias(c) for k, c in enumerate(cells, 1)], F.struct("_d.d1", "_d.d2", "_d.d3", "tiles").alias("_to"))
    around = cut(moved.groupBy(*where).agg(F.collect_list("_to").alias("_around")).join(tiles, where))
    wide = placed.join(around, where).withColumn("t", F.pmod(F.xxhash64("node"), "tiles"))
    zero = F.lit(0).cast("long")

    def meet(to, o):
        """The pair of tiles that this row's and the other tile form: named from the cell that comes first."""
        d = [to[f"d{k}"] for k in (1, 2, 3)]
        here, first = (d[0] == 0) & (d[1] == 0) & (d[2] == 0), F.array(*d) > F.array(zero, zero, zero)
        own = F.col("t")
        base = [F.when(here | first, F.col(c)).otherwise(F.col(c) + x).alias(c) for c, x in zip(cells, d, strict=True)]
        turn = [F.when(first, x).otherwise(-x).alias(f"d{k}") for k, x in enumerate(d, 1)]
        i = F.when(here, F.least(own, o)).when(first, own).otherwise(o)
        j = F.when(here, F.greatest(own, o)).when(first, o).otherwise(own)
        return F.struct(*base, *turn, i.alias("i"), j.alias("j"), F.when(here, own > o).otherwise(~first).alias("second"))

    pairs = F.flatten(F.transform("_around", lambda to: F.transform(F.sequence(zero, to["tiles"] - 1), lambda o: meet(to, o))))
    dealt = wide.select("node", "n", "v", "label", "size", F.explode(pairs).alias("p")).select("node", "n", "v", "label", "size", "p.*")
    result = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        (_, x), = by_length(table.column("v").chunk(0))
        x = unit(x)
        node, n, second = (table.column(c).to_numpy() for c in ("node", "n", "second"))
        key = [table.column(c)[0].as_py() for c in ("d1", "d2", "d3", "i", "j")]
        if not any(key[:3]) and key[3] == key[4]:
            i, j = linked(x, x, shared.value, least, same=True)
        else:
            left, right = np.flatnonzero(~second), np.flatnonzero(second)
            i, j = linked(x[left], x[right], shared.value, least)
            i, j = left[i], right[j]
        links = (np.bincount(i, n[j], len(x)) + np.bincount(j, n[i], len(x))).astype(np.int64)
        has = np.flatnonzero(links)
        group = group_of(len(x), i, j)  # a forest over the links instead of all of them
        return pa.table([node[has], node[group[has]], links[has]], schema=result)

    found = cut(dealt.groupBy("label", "size", *cells, "d1", "d2", "d3", "i", "j").applyInArrow(compare, "a long, b long, links long"))
    joined = components(found.select("a", "b")).withColumnRenamed("id", "node")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    known = classes.select("_key", "node", "id", "n").join(joined, "node", "left").join(counts, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    least_id = cut(known.groupBy("component").agg(F.min("id").alias("_least")))
    known = known.join(least_id, "component").select("_key", "_least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("_links"))
    out = good.select("id", "_key").join(known, "_key").select("id", "_least", "_links").unionByName(bad.select("id", F.col("id").alias("_least"), F.lit(0).cast("long").alias("_links")))
    component = F.when(F.col("id").isNotNull(), F.coalesce("_least", "id"))
    return out.select(F.col("id").alias(id_col), F.col("_links").cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
