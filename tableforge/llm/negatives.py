"""Hard negatives of anchor vectors, with bounds along a spanning tree of the anchors.

A score is the inner product of two integer vectors. For an anchor c with parent p in the
tree and a candidate x, the score of c lies within |c - p| |x| of the score of p. A task holds a
batch of candidates, walks the tree from its root and keeps for each candidate the least and
the greatest score that it can have. Only candidates whose interval meets the window of an
anchor are scored exactly; for the others the interval grows by the next edge.

Two passes over the candidates: the first finds the positives, the rows of an anchor's own
label with the highest scores (the window opens at the lowest one found so far), the second
the negatives in the windows that these positives set. Anchors come in blocks of bounded
size, sent to all tasks, as a query set against all rows. A task hands on a few rows for
each anchor, not pairs; the best of all tasks are chosen by a window over these.

Rows with a null label, a null vector, or a null or non-finite component take no part.
Components beyond 2^27 count as 2^27. Shorter vectors are filled up with zeros. Rows with
null ids are candidates, after all others among ties, but no anchors. Rows with the same id
are rows of their own: an anchor's copies are candidates for it, and each copy of an anchor is an
anchor. An empty table, or one without anchors, gives an empty table. Only the columns
``vec_id``, ``label`` and ``embedding`` are looked at, so other names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableforge.llm.common import written
from tableforge.workspace import new_folder

#: Anchors that are sent to all tasks at once.
BLOCK = 2048
SCALE = 256
LARGEST = 1 << 27
#: Sums up to this are exact as floating-point numbers.
EXACT = float(1 << 53)
NO_ID = np.iinfo(np.int64).max

FOUND = "anchor int, positive int, uid long, vec_id long, score long"


@dataclass(frozen=True)
class WindowRule:
    """How many positives and negatives, and the shares (in percent) of a positive's score."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100


@dataclass
class Anchors:
    """A block of anchors in the order of the walk, and the tree over them."""

    uid: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    vectors: np.ndarray
    #: Place of the parent in the order (-1 for the root), and the length of the edge to it.
    parent: np.ndarray
    edge: np.ndarray
    #: The last of the children of its parent: the parent's bounds are no longer needed.
    last: np.ndarray


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent of each vector and the distance to it, in a tree with the shortest edges."""
    count = len(vectors)
    parent, edge = np.full(count, -1), np.zeros(count)
    near, by = np.full(count, np.inf), np.full(count, -1)
    outside = np.ones(count, bool)
    squares = (vectors * vectors).sum(axis=1)
    at = 0
    for _ in range(count):
        outside[at] = False
        parent[at], edge[at] = by[at], 0.0 if by[at] < 0 else near[at]
        away = np.sqrt(np.maximum(squares + squares[at] - 2 * (vectors @ vectors[at]), 0))
        closer = outside & (away < near)
        near[closer], by[closer] = away[closer], at
        at = int(np.argmin(np.where(outside, near, np.inf)))
    return parent, edge


def walk(parent: np.ndarray) -> list[int]:
    """Parents before children, and of siblings the one with the largest subtree last.

    The bounds that wait for a later sibling are then of at most log n anchors.
    """
    children: dict[int, list[int]] = {}
    for node, above in enumerate(parent):
        children.setdefault(int(above), []).append(node)
    order, stack = [], list(children.get(-1, ()))
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(children.get(node, ()))
    size = np.ones(len(parent), int)
    for node in reversed(order):
        if parent[node] >= 0:
            size[parent[node]] += size[node]
    order, stack = [], list(children.get(-1, ()))
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(sorted(children.get(node, ()), key=lambda child: -size[child]))
    return order


def tree_of(uid: np.ndarray, vec_id: np.ndarray, label: np.ndarray, vectors: np.ndarray) -> Anchors:
    parent, edge = spanning_tree(vectors.astype(float))
    order = np.array(walk(parent), int)
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    above = parent[order]
    above = np.where(above < 0, -1, place[above])
    last = np.zeros(len(order), bool)
    for at in {int(a): k for k, a in enumerate(above)}.values():
        last[at] = True
    return Anchors(uid[order], vec_id[order], label[order], vectors[order], above, edge[order], last)


@dataclass
class Candidates:
    uid: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    vectors: np.ndarray


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of whole numbers as a matrix, shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _candidates(batch: pa.RecordBatch) -> Candidates:
    uid, vec_id, label, vector = (batch.column(name) for name in ("uid", "vec_id", "label", "vector"))
    ids = vec_id.fill_null(NO_ID).to_numpy()
    return Candidates(uid.to_numpy(), ids, label.to_numpy(), _matrix(vector))


def _same_width(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1])))


Choose = Callable[[int, Candidates, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def walk_batch(anchors: Anchors, batch: Candidates, wanted: Choose, found: Callable) -> int:
    """Hand each anchor's exact scores of the candidates that ``wanted`` names to ``found``.

    ``wanted`` gets an anchor's place and the bounds of all candidates. Returns how many scores
    were computed.
    """
    width = max(batch.vectors.shape[1], anchors.vectors.shape[1])
    rows, nodes = _same_width(batch.vectors, width), _same_width(anchors.vectors, width)
    norms = np.sqrt((rows.astype(float) ** 2).sum(axis=1))
    longest = np.sqrt((nodes.astype(float) ** 2).sum(axis=1)).max(initial=0.0)
    kind = float if longest * norms.max(initial=0.0) < EXACT / 4 else np.int64
    rows, nodes = rows.astype(kind), nodes.astype(kind)
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    scored = 0
    for at in range(len(nodes)):
        above = int(anchors.parent[at])
        if above < 0:
            low, high = np.full(len(rows), -np.inf), np.full(len(rows), np.inf)
        else:
            # A little more than the edge, for what rounding takes away.
            reach = norms * (anchors.edge[at] * (1 + 1e-9) + 1e-6) + 1
            low, high = bounds[above]
            low, high = low - reach, high + reach
            if anchors.last[at]:
                del bounds[above]
        pick = wanted(at, batch, low, high)
        if above < 0:
            scores = rows @ nodes[at]
            low, high = scores.astype(float), scores.astype(float)
            scores = scores[pick]
        else:
            scores = (rows if len(pick) == len(rows) else rows[pick]) @ nodes[at]
            low[pick] = high[pick] = scores
        scored += len(pick)
        bounds[at] = low, high
        found(at, batch, pick, scores.astype(np.int64))
    return scored


class Best:
    """The first rows by score, id and place in the table, of all that were added."""

    def __init__(self, most: int):
        self.most = most
        self.rows = np.empty((0, 3), np.int64)

    def add(self, uid: np.ndarray, vec_id: np.ndarray, score: np.ndarray) -> None:
        if len(uid) > 4 * self.most:
            lowest = np.partition(score, len(score) - self.most)[len(score) - self.most]
            keep = score >= lowest
            uid, vec_id, score = uid[keep], vec_id[keep], score[keep]
        rows = np.concatenate([self.rows, np.column_stack([uid, vec_id, score])])
        self.rows = rows[np.lexsort((rows[:, 0], rows[:, 1], -rows[:, 2]))[: self.most]]

    @property
    def least(self) -> float:
        """Scores below this are of no use."""
        return float(self.rows[-1, 2]) if len(self.rows) == self.most else -np.inf


def _batch_of(found: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    rows = np.concatenate([best for _, _, best in found] or [np.empty((0, 3), np.int64)])
    anchor = np.repeat([a for a, _, _ in found], [len(best) for _, _, best in found]).astype(np.int32)
    positive = np.repeat([p for _, p, _ in found], [len(best) for _, _, best in found]).astype(np.int32)
    ids = pa.array(rows[:, 1], mask=rows[:, 1] == NO_ID)
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor), pa.array(positive), pa.array(rows[:, 0]), ids, pa.array(rows[:, 2])],
        ["anchor", "positive", "uid", "vec_id", "score"],
    )


def _positives(sent, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = sent.value
        best = [Best(most) for _ in anchors.uid]

        def found(at: int, batch: Candidates, pick: np.ndarray, scores: np.ndarray) -> None:
            best[at].add(batch.uid[pick], batch.vec_id[pick], scores)

        for part in batches:
            batch = _candidates(part)
            alike = {label: np.flatnonzero(batch.label == label) for label in np.unique(batch.label)}
            none = np.empty(0, int)

            def wanted(at: int, batch: Candidates, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                own = alike.get(anchors.label[at], none)  # noqa: B023
                return own[(high[own] >= best[at].least) & (batch.uid[own] != anchors.uid[at])]

            walk_batch(anchors, batch, wanted, found)
        yield _batch_of([(at, 0, x.rows) for at, x in enumerate(best)])

    return positives


def _negatives(sent, rule: WindowRule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, scores_of = sent.value
        # Windows by positive: whole scores from low to high, both included.
        windows = [
            [(-(-rule.low * int(s) // 100), rule.high * int(s) // 100) for s in scores] for scores in scores_of
        ]
        least = np.array([min((low for low, _ in w), default=1) for w in windows], float)
        most = np.array([max((high for _, high in w), default=0) for w in windows], float)
        best = [[Best(rule.negatives) for _ in w] for w in windows]

        def wanted(at: int, batch: Candidates, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            meets = (high >= least[at]) & (low <= most[at]) & (batch.label != anchors.label[at])
            return np.flatnonzero(meets) if least[at] <= most[at] else np.empty(0, int)

        def found(at: int, batch: Candidates, pick: np.ndarray, scores: np.ndarray) -> None:
            inside = (scores >= least[at]) & (scores <= most[at])
            pick, scores = pick[inside], scores[inside]
            for (low, high), x in zip(windows[at], best[at], strict=True):
                fits = (scores >= max(low, x.least)) & (scores <= high)
                if fits.any():
                    x.add(batch.uid[pick[fits]], batch.vec_id[pick[fits]], scores[fits])

        for part in batches:
            walk_batch(anchors, _candidates(part), wanted, found)
        yield _batch_of([(at, k, x.rows) for at, row in enumerate(best) for k, x in enumerate(row)])

    return negatives


def _best_rows(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each group; each task sends no more than these."""
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("uid")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rank") <= most)


def usable_vectors(rows: DataFrame, label: Column) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part, in whole numbers, with a ``uid``."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(
        "embedding",
        lambda x: F.least(
            F.greatest(F.floor(SCALE * x.cast("double")), F.lit(-LARGEST)), F.lit(LARGEST)
        ).cast("int"),
    )
    kept = rows.where(label.isNotNull() & F.col("embedding").isNotNull()).where(finite)
    kept = kept.select(
        F.col("vec_id").cast("long"), label.cast("long").alias("label"), whole.alias("vector")
    )
    return kept.withColumn("uid", F.monotonically_increasing_id())


def _block(rows: DataFrame) -> Anchors:
    table = rows.orderBy("uid").toArrow().combine_chunks()
    columns = [table.column(name).combine_chunks() for name in ("uid", "vec_id", "label")]
    vectors = table.column("vector").combine_chunks()
    return tree_of(*(column.to_numpy() for column in columns), _matrix(vectors))


def mine_negatives(
    vectors: DataFrame, is_anchor: Column, rule: WindowRule = WindowRule(), block: int = BLOCK  # noqa: B008
) -> DataFrame:
    """Negatives for each anchor and positive, of the rows of ``usable_vectors``."""
    spark = vectors.sparkSession
    rows = written(vectors, "vectors")
    anchors = rows.where(is_anchor)
    blocks = -(-anchors.count() // block)
    anchors = written(anchors.withColumn("block", F.expr(f"uid % {max(blocks, 1)}")), "anchors")
    path = new_folder(spark, "negatives")
    schema = (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
        "negative_score long, anchor_uid long, positive int"
    )
    spark.createDataFrame([], schema).write.parquet(path)
    for number in range(blocks):
        part = anchors.where(F.col("block") == number)
        if part.isEmpty():
            continue
        tree = _block(part)
        sent = spark.sparkContext.broadcast(tree)  # a block of anchors: bounded
        found = rows.mapInArrow(_positives(sent, rule.positives), FOUND)
        positives = written(_best_rows(found, ["anchor"], rule.positives), "positives")
        scores: list[list[int]] = [[] for _ in tree.uid]
        for at, score in positives.orderBy("anchor", "rank").select("anchor", "score").collect():
            scores[at].append(score)
        both = spark.sparkContext.broadcast((tree, scores))
        found = rows.mapInArrow(_negatives(both, rule), FOUND)
        negatives = _best_rows(found, ["anchor", "positive"], rule.negatives)
        named = positives.select(
            "anchor",
            (F.col("rank") - 1).alias("positive"),
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
        ids = [(k, int(uid), int(i)) for k, (uid, i) in enumerate(zip(tree.uid, tree.vec_id, strict=True))]
        ids = spark.createDataFrame(ids, "anchor int, anchor_uid long, anchor_id long")
        done = negatives.join(named, ["anchor", "positive"]).join(F.broadcast(ids), "anchor")
        done.select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
            "anchor_uid",
            "positive",
        ).write.mode("append").parquet(path)
        sent.destroy()
        both.destroy()
    return spark.read.schema(schema).parquet(path)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    mined = mine_negatives(usable_vectors(rows, moved), F.col("vec_id") % 100 == 0)
    return mined.drop("anchor_uid", "positive")


#: The same by scores of all pairs.
ORACLE = f"""
WITH usable AS (
  SELECT row_number() OVER () AS uid, vec_id::BIGINT AS vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
), scores AS (
  SELECT a.uid AS anchor_uid, a.vec_id AS anchor_id, b.uid, b.vec_id, a.label = b.label AS alike,
    list_dot_product(a.vector, b.vector)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.uid <> b.uid
), positives AS (
  SELECT * FROM scores WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_uid ORDER BY score DESC, vec_id NULLS LAST, uid) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
  (row_number() OVER (PARTITION BY p.anchor_uid, p.uid ORDER BY n.score DESC, n.vec_id NULLS LAST, n.uid))::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON p.anchor_uid = n.anchor_uid AND NOT n.alike
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""
