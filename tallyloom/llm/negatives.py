"""Hard negatives by exact integer scores in a residue number system.

Vectors are integers. Their components are taken modulo a few primes, as centred residues so small that a float32 matrix
product over ``DEPTH`` dimensions is exact; the products modulo each prime are put together by the Chinese remainder theorem
to the exact signed inner product. How many primes it takes follows from the longest vector (Cauchy and Schwarz).

The anchors are a stated query set, held against all rows in blocks: rows and anchors are dealt to the cells of a grid, each
task multiplies one block of anchors with one block of rows and passes on the best few rows of each anchor, and these are
merged. It takes two passes: the first finds each anchor's positives, the second the negatives in the window that each
positive's score opens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.storage import stored

# Primes below 1024, so that 64 products of two centred residues stay below 2^24.
PRIMES = (1021, 1019, 1013, 1009, 997, 991)
DEPTH = 64
ANCHOR_BLOCK, ROW_BLOCK = 16_384, 32_768
TILE_ANCHORS, TILE_ROWS = 256, 4_096
# Scores stay below this, so that a hundred times a score and the product of the primes fit a long.
MOST = 1 << 56
NOTHING = np.iinfo(np.int64).min
NO_ID = (1 << 63) - 1


def primes_for(bound: int) -> tuple[int, ...]:
    """As many primes as tell all scores from -bound to bound apart."""
    product = 1
    for n, p in enumerate(PRIMES, 1):
        product *= p
        if product > 2 * bound + 1:
            return PRIMES[:n]
    raise ValueError(f"scores up to {bound} are too large")


def residues(vectors: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """The centred residues of each component, a float32 matrix for each prime."""
    out = []
    for p in primes:
        r = vectors % p
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def products(left: list[np.ndarray], right: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """The exact inner products of all rows of ``left`` and ``right``, from their residues."""
    value, modulus = None, 1
    for a, b, p in zip(left, right, primes, strict=True):
        total = np.zeros((len(a), len(b)), np.int64)
        for k in range(0, a.shape[1], DEPTH):
            total += (a[:, k : k + DEPTH] @ b[:, k : k + DEPTH].T).astype(np.int64)
        total %= p
        if value is None:
            value = total
        else:  # the next digit in the mixed radix of the primes so far
            digit = (total - value) % p * pow(modulus, -1, p) % p
            value += modulus * digit
        modulus *= p
    return np.where(value > modulus // 2, value - modulus, value)


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """List rows as one integer matrix; shorter rows end in zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def best(scores: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The largest of each row, then the next, ``k`` times, as places and values; the first of equal ones. Overwrites them."""
    line = np.arange(len(scores))
    for _ in range(k):
        at = scores.argmax(axis=1)
        yield at, scores[line, at].copy()
        scores[line, at] = NOTHING


def in_cells(
    anchors: DataFrame, rows: DataFrame, grid: tuple[int, int], select: Callable[..., Iterator[dict]], bound: int, width: int, schema: str
) -> DataFrame:
    """``select`` over the exact scores of every tile of every cell of anchors x rows.

    Each row goes to one column of the grid and so to each of its lines, each anchor the other way round. A cell holds at
    most about ``ANCHOR_BLOCK`` anchors and ``ROW_BLOCK`` rows.
    """
    lines, columns = grid
    primes = primes_for(bound)

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        # In the order of ties, so that the first of equal scores is the right one.
        right = right.sort_by([("tie", "ascending"), ("row", "ascending")])
        found: list[dict] = []
        if left.num_rows and right.num_rows:
            whole = matrix(right["vec"], width)
            for a in range(0, left.num_rows, TILE_ANCHORS):
                part = left.slice(a, TILE_ANCHORS)
                ours = residues(matrix(part["vec"], width), primes)
                for r in range(0, right.num_rows, TILE_ROWS):
                    theirs = residues(whole[r : r + TILE_ROWS], primes)
                    found.extend(select(part, right.slice(r, TILE_ROWS), products(ours, theirs, primes)))
        names = [f.split()[0] for f in schema.split(",")]
        if not found:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        return pa.table({n: np.concatenate([f[n] for f in found]) for n in names})

    anchors = anchors.toDF(*anchors.columns)  # columns of its own, as both sides come from one table
    left = anchors.withColumns({"line": F.pmod("row", F.lit(lines)), "column": F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))})
    right = rows.withColumns({"line": F.explode(F.sequence(F.lit(0), F.lit(lines - 1))), "column": F.pmod("row", F.lit(columns))})
    keys = [F.col("line").cast("long"), F.col("column").cast("long")]
    left, right = (x.withColumns({"line": keys[0], "column": keys[1]}).repartition(lines * columns, "line", "column") for x in (left, right))
    return left.groupBy("line", "column").cogroup(right.groupBy("line", "column")).applyInArrow(cell, schema)


def same_label(k: int) -> Callable[..., Iterator[dict]]:
    """Of each anchor the ``k`` best other rows of its label."""

    def select(part: pa.Table, rows: pa.Table, scores: np.ndarray) -> Iterator[dict]:
        mine, ids = part["row"].to_numpy(), rows["row"].to_numpy()
        fits = (part["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None, :]) & (mine[:, None] != ids[None, :])
        scores[~fits] = NOTHING
        tie = rows["tie"].to_numpy()
        for at, value in best(scores, k):
            hit = value != NOTHING
            yield {"anchor": mine[hit], "row": ids[at[hit]], "tie": tie[at[hit]], "score": value[hit]}

    return select


def in_windows(k: int, low: int, high: int) -> Callable[..., Iterator[dict]]:
    """Of each anchor and positive the ``k`` best rows of other labels from ``low`` to ``high`` per cent of its score."""

    def select(part: pa.Table, rows: pa.Table, scores: np.ndarray) -> Iterator[dict]:
        mine, ids, tie = part["row"].to_numpy(), rows["row"].to_numpy(), rows["tie"].to_numpy()
        scores[part["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None, :]] = NOTHING
        limits = part["positives"].to_pylist()
        for place in range(max(map(len, limits), default=0)):
            has = np.array([len(p) > place for p in limits])
            top = np.array([p[place] if len(p) > place else 0 for p in limits], np.int64)[has]
            own = scores[has]
            open_ = (own != NOTHING) & (100 * np.where(own == NOTHING, 0, own) <= high * top[:, None])
            open_ &= 100 * np.where(own == NOTHING, 0, own) >= low * top[:, None]
            for at, value in best(np.where(open_, own, NOTHING), k):
                hit = value != NOTHING
                yield {
                    "anchor": mine[has][hit],
                    "place": np.full(hit.sum(), place + 1, np.int64),
                    "row": ids[at[hit]],
                    "tie": tie[at[hit]],
                    "score": value[hit],
                }

    return select


def integers(vector: str, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def first_of(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best of each group with their ``rank``; cells have passed on at most ``k`` each."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "tie", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(
    rows: DataFrame,
    anchors: Column,
    scale: int = 256,
    n_positives: int = 5,
    n_negatives: int = 5,
    low: int = 80,
    high: int = 100,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Components become ``floor(scale * x)``; a score is the integer inner product. An anchor's positives are the
    ``n_positives`` best other rows of its label, the negatives of each the ``n_negatives`` best rows of other labels whose
    score is from ``low`` to ``high`` per cent of the positive's (0 <= low <= high). Equal scores go by the smaller id, then by
    the order of the rows.

    Rows with a null label, a null vector or a null or non-finite component take no part. An empty vector scores 0, a shorter
    one counts as if it ended in zeros. Rows that share an id are rows of their own, each of them an anchor if the id is;
    a null id is no anchor and comes after all others among ties. An anchor without positives, or a positive without
    negatives in its window, gives no row. Scores that could reach 2^56 are refused with a ``ValueError``.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = stored(
        rows.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & finite).select(
            F.monotonically_increasing_id().alias("row"),
            F.col(vec_id).cast("long").alias("id"),
            F.coalesce(F.col(vec_id).cast("long"), F.lit(NO_ID)).alias("tie"),
            F.col(label).cast("long").alias("label"),
            integers(vector, scale).alias("vec"),
            F.coalesce(anchors, F.lit(False)).alias("anchor"),
        )
    )
    squares = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    size = kept.agg(F.count("row"), F.count_if("anchor"), F.max(squares), F.max(F.size("vec"))).head()
    n_rows, n_anchors, longest, width = size[0], size[1], size[2] or 0.0, size[3] or 0
    bound = int(longest * 1.000001) + 1
    if bound >= MOST:
        raise ValueError("the vectors are too long for exact scores in 64 bits")
    # At least two cells a core, so that small tables are shared out as well.
    columns = max(-(-n_rows // ROW_BLOCK), min(2 * kept.sparkSession.sparkContext.defaultParallelism, -(-n_rows // 64)), 1)
    grid = (max(-(-n_anchors // ANCHOR_BLOCK), 1), columns)
    rows_, asked = kept.select("row", "tie", "label", "vec"), kept.where("anchor").select("row", "label", "vec")

    near = in_cells(asked, rows_, grid, same_label(n_positives), bound, width, "anchor long, row long, tie long, score long")
    positives = stored(first_of(near, ["anchor"], n_positives).withColumnRenamed("row", "positive"))
    scores = positives.groupBy("anchor").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"]).alias("positives")
    )
    asked = asked.join(scores, F.col("row") == F.col("anchor")).select("row", "label", "vec", "positives")
    kind = "anchor long, place long, row long, tie long, score long"
    found = first_of(in_cells(asked, rows_, grid, in_windows(n_negatives, low, high), bound, width, kind), ["anchor", "place"], n_negatives)

    ids = kept.select(F.col("row").alias("of"), "id")
    named = positives.join(ids, F.col("positive") == F.col("of")).select(
        "anchor", F.col("rank").cast("long").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    anchor_ids = kept.where("anchor").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    negatives = found.join(ids, F.col("row") == F.col("of")).select(
        "anchor", "place", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return (
        negatives.join(named, ["anchor", "place"])
        .join(anchor_ids, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
