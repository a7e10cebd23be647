"""Hard negatives by maximum inner product search with coordinate pruning (LEMP; Teflioudi and Gemulla, 2016).

1. Rows are dealt by (dimension, length class, label, id) to blocks of bounded size.  A block holds its rows' vectors
   and, for each coordinate, the rows in order of that coordinate of the unit vector: the sorted coordinate lists.
   The lengths of a class differ by a tenth at most.
2. Blocks are put together to chunks, anchors to groups, both of bounded size, and every chunk meets every group that
   it has to (an anchor's positives are only looked for in chunks that hold its label).  In a chunk, blocks are taken
   from the longest vectors down.
3. For an anchor q and the least score of use so far, a row p of a block must have cos(q, p) >= least / (|q| longest).
   So for a coordinate f the angle between p and the axis is within arccos of that bound of q's: p_f lies in a range.
   The ranges of q's focus coordinates (the greatest ones) are looked up in the sorted lists, the candidates of the
   shortest are held against the other ranges, and what is left is verified by exact integer inner products.
4. The least score of use rises while blocks are read: it is the score of the fifth positive so far, and for
   negatives the lowest of the bands' lower ends and third negatives so far.
5. Bests of chunks are put together by ranking; positives first, since they set the bands of the negatives.

Pruning never drops a row that can count: ranges are widened by more than rounding can move them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..tables import settle

#: Rows of a block, of a chunk (about), and anchors of a group (about).
BLOCK_ROWS, CHUNK_ROWS, GROUP_ANCHORS = 2048, 16384, 2048
FOCUS, CLASS_RATIO, SLACK = 6, 0.9, 1e-5
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95


def vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, dim, v, sq): floor(256 x) of every component as long and their sum of squares.

    Rows with a null id or label, or a null vector, or a null, infinite or NaN component, take no part.
    """
    v = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    fit = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = v.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & fit)
    whole = whole.select("vec_id", "label", F.size("x").alias("dim"), F.transform("x", lambda x: F.floor(x * 256)).alias("v"))
    return whole.withColumn("sq", F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _block(part: pa.Table, dim: int, n_before: int) -> dict:
    v = _matrix(part.column("v"), dim)
    length = np.sqrt(part.column("sq").to_numpy())
    unit = v / np.where(length > 0, length, 1.0)[:, None]
    ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
    order = np.argsort(unit, axis=0, kind="stable").T.astype(np.uint16)
    narrow = not len(v) or not dim or np.abs(v).max() < 1 << 31
    return {"dim": dim, "least_id": int(ids[0]), "number": n_before, "n": len(ids), "longest": float(length.max()), "labels": sorted(set(labels.tolist())), "ids": ids.astype("<i8").tobytes(), "own": labels.astype("<i8").tobytes(), "width": 4 if narrow else 8, "vectors": v.astype("<i4" if narrow else "<i8").tobytes(), "orders": order.astype("<u2").tobytes()}


_BLOCKS = pa.schema([("dim", pa.int32()), ("least_id", pa.int64()), ("number", pa.int64()), ("n", pa.int32()), ("longest", pa.float64()), ("labels", pa.list_(pa.int64())), ("ids", pa.binary()), ("own", pa.binary()), ("width", pa.int32()), ("vectors", pa.binary()), ("orders", pa.binary())])


def blocks_of(rows: DataFrame, partitions: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of rows of :func:`vectors` of one dimension and length class, each with its sorted coordinate lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        kind, n, number = None, 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, n, number
            if n:
                yield pa.RecordBatch.from_pylist([_block(pa.concat_tables(held), kind[0], number)], _BLOCKS)
                held, n, number = [], 0, number + 1

        for batch in batches:
            t = pa.Table.from_batches([batch])
            kinds = np.stack([t.column("dim").to_numpy(), t.column("size_class").to_numpy()])
            ends = [*(np.flatnonzero((kinds[:, 1:] != kinds[:, :-1]).any(axis=0)) + 1).tolist(), t.num_rows]
            at = 0
            for end in ends:
                while at < end:
                    now = (int(kinds[0, at]), int(kinds[1, at]))
                    if now != kind:
                        yield from flush()
                        kind = now
                    take = min(end - at, block_rows - n)
                    held.append(t.slice(at, take))
                    n, at = n + take, at + take
                    if n == block_rows:
                        yield from flush()
        yield from flush()

    order = ["dim", "size_class", "label", "vec_id", "v"]
    size_class = F.when(F.col("sq") > 0, F.ceil(F.log("sq") / (2 * math.log(CLASS_RATIO)))).otherwise(2**31 - 1).cast("int")  # longer vectors have lower numbers
    dealt = rows.withColumn("size_class", size_class).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return dealt.select("vec_id", "label", "dim", "v", "sq", "size_class").mapInArrow(run, "dim int, least_id long, number long, n int, longest double, labels array<long>, ids binary, own binary, width int, vectors binary, orders binary")


class _Block:
    def __init__(self, row: dict, needed: np.dtype):
        n, dim = row["n"], row["dim"]
        self.longest = row["longest"]
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["own"], "<i8")
        v = np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(n, dim)
        self.v = v.astype(needed)
        self.order = np.frombuffer(row["orders"], "<u2").reshape(dim, n)
        length = np.sqrt((v.astype(float) ** 2).sum(axis=1))
        self.unit = np.ascontiguousarray((v / np.where(length > 0, length, 1.0)[:, None]).T)
        self.sorted: dict[int, np.ndarray] = {}

    def list_of(self, f: int) -> np.ndarray:
        if f not in self.sorted:
            self.sorted[f] = self.unit[f][self.order[f]]
        return self.sorted[f]

    def candidates(self, focus: list[int], low: list[float], high: list[float]) -> np.ndarray:
        """Rows inside the ranges of all focus coordinates: those of the shortest list, held against the other ranges."""
        spans = [self.list_of(f).searchsorted((a, b)) for f, a, b in zip(focus, low, high)]
        first = min(range(len(focus)), key=lambda k: spans[k][1] - spans[k][0])
        found = self.order[focus[first]][spans[first][0] : spans[first][1]]
        for k, f in enumerate(focus):
            if k != first and len(found):
                x = self.unit[f][found]
                found = found[(x >= low[k]) & (x <= high[k])]
        return found


def ranges(cosine: np.ndarray, unit_q: np.ndarray, focus: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the focus coordinates of a unit vector must lie to have at least this cosine with each row of ``unit_q``."""
    reach = np.arccos(np.clip(cosine, -1, 1))[:, None]
    own = np.arccos(np.clip(np.take_along_axis(unit_q, focus, axis=1), -1, 1))
    return np.cos(np.minimum(own + reach, np.pi)) - SLACK, np.cos(np.maximum(own - reach, 0)) + SLACK


def _search(blocks: pa.Table, anchors: pa.Table, least: Callable[[int], float], take: Callable[[int, np.ndarray, np.ndarray, np.ndarray], None]) -> None:
    """Hand ``take`` the (scores, ids, labels) of all rows that can reach ``least`` of an anchor, block by block."""
    rows = sorted(blocks.to_pylist(), key=lambda r: (-r["longest"], r["dim"], r["least_id"], r["number"]))
    dims = anchors.column("dim").to_numpy()
    for dim in sorted({r["dim"] for r in rows} & set(dims.tolist())):
        at = np.flatnonzero(dims == dim)
        part = anchors.take(pa.array(at))
        q, length = _matrix(part.column("v"), dim), np.sqrt(part.column("sq").to_numpy())
        own = [r for r in rows if r["dim"] == dim]
        bound = float(length.max()) * max(r["longest"] for r in own) * 1.000001
        if bound >= 2**63:
            raise ValueError("scores beyond a long")
        kind = np.dtype(np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64)  # all partial sums are exact
        asked = q.astype(kind)
        unit = q / np.where(length > 0, length, 1.0)[:, None]
        focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        focus_list = focus.tolist()
        for row in own:
            b = _Block(row, kind)
            low_score = np.array([least(int(k)) for k in at])
            with np.errstate(divide="ignore", invalid="ignore"):
                cosine = np.where(low_score > 0, low_score / (length * b.longest), -1.0)
            low, high = (x.tolist() for x in ranges(cosine, unit, focus))
            for k in range(len(at)):
                if cosine[k] > 1 + SLACK:
                    continue
                if cosine[k] <= 0 or not dim:  # nothing to prune by yet
                    scores, ids, labels = b.v @ asked[k], b.ids, b.labels
                else:
                    found = b.candidates(focus_list[k], low[k], high[k])
                    if not len(found):
                        continue
                    scores, ids, labels = b.v[found] @ asked[k], b.ids[found], b.labels[found]
                take(int(at[k]), scores.astype(np.int64), ids, labels)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


_NONE = np.zeros(0, np.int64)


def _best_positives(k: int):
    def run(blocks: pa.Table, anchors: pa.Table) -> pa.Table:
        own, name = anchors.column("label").to_numpy(), anchors.column("vec_id").to_numpy()
        best = [(_NONE, _NONE)] * anchors.num_rows

        def least(a: int) -> float:
            return float(best[a][0][-1]) if len(best[a][0]) == k else -math.inf

        def take(a: int, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
            keep = (labels == own[a]) & (ids != name[a]) & (scores >= least(a))
            if keep.any():
                best[a] = _first(np.append(best[a][0], scores[keep]), np.append(best[a][1], ids[keep]), k)

        if blocks.num_rows and anchors.num_rows:
            _search(blocks, anchors, least, take)
        n = [len(s) for s, _ in best]
        return pa.table({"anchor_id": np.repeat(name, n), "score": np.concatenate([_NONE, *(s for s, _ in best)]), "id": np.concatenate([_NONE, *(i for _, i in best)])})

    return run


def _best_negatives(k: int, low: int, high: int):
    def run(blocks: pa.Table, anchors: pa.Table) -> pa.Table:
        own, name = anchors.column("label").to_numpy(), anchors.column("vec_id").to_numpy()
        bands = [[(-(-low * s // 100), high * s // 100) for s in scores] for scores in anchors.column("scores").to_pylist()]
        best = [[(_NONE, _NONE)] * len(b) for b in bands]
        worst = [[float(a) if a <= b else math.inf for a, b in band] for band in bands]  # the least score of use in each band

        def take(a: int, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
            keep = (labels != own[a]) & (scores >= min(worst[a]))
            if not keep.any():
                return
            scores, ids = _first(scores[keep], ids[keep], int(keep.sum()))
            for j, (_, top) in enumerate(bands[a]):
                at = int(np.searchsorted(-scores, -top, "left"))
                near, who = scores[at : at + k], ids[at : at + k]
                use = near >= worst[a][j]
                if use.any():
                    best[a][j] = _first(np.append(best[a][j][0], near[use]), np.append(best[a][j][1], who[use]), k)
                    if len(best[a][j][0]) == k:
                        worst[a][j] = float(best[a][j][0][-1])

        if blocks.num_rows and anchors.num_rows:
            _search(blocks, anchors, lambda a: min(worst[a], default=math.inf), take)
        each = [(a, j, s, i) for a, found in enumerate(best) for j, (s, i) in enumerate(found)]
        n = [len(s) for *_, s, _ in each]
        return pa.table({"anchor_id": np.repeat(name[[a for a, *_ in each]], n) if each else _NONE, "positive": np.repeat(np.array([j for _, j, *_ in each], np.int32), n), "score": np.concatenate([_NONE, *(s for *_, s, _ in each)]), "id": np.concatenate([_NONE, *(i for *_, i in each)])})

    return run


def _ranked(found: DataFrame, of: list[str], k: int, rank: str) -> DataFrame:
    return found.withColumn(rank, F.row_number().over(W.partitionBy(*of).orderBy(F.desc("score"), "id"))).where(F.col(rank) <= k)


def hard_negatives(
    embeddings: DataFrame, anchor_every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS, group_anchors: int = GROUP_ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, embedding, label).

    A row's score is its integer inner product with the anchor, of components floor(256 x); higher scores come first,
    ties by smaller vec_id.  Anchors are rows whose vec_id is divisible by ``anchor_every``; positives are the first other
    rows of the anchor's label, and for each the first rows of another label whose score is between ``low`` and ``high``
    percent of the positive's follow.  A positive score below 0 has no such row.
    Rows with a null id, label, vector or component, or a component that is not finite, take no part; vectors of other
    dimensions never meet.  A row that is repeated counts as often as it comes, but rows with the anchor's own id are not its
    partners, and of several rows of an anchor's id that of the least label and vector is the anchor.  Without rows or
    anchors the result is empty.  Scores beyond a long are an error.
    """
    rows = settle(vectors(embeddings), "vectors")
    total = rows.count()
    chosen = rows.where(F.col("vec_id") % anchor_every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "v", "dim", "sq")).alias("r"))
    anchors = settle(chosen.select("vec_id", "r.label", "r.dim", "r.v", "r.sq"), "anchors")
    chunks, groups = max(1, -(-total // chunk_rows)), max(1, -(-anchors.count() // group_anchors))
    index = settle(blocks_of(rows, max(1, -(-total // (2 * block_rows))), block_rows).withColumn("chunk", F.pmod(F.xxhash64("dim", "least_id", "number", "longest"), F.lit(chunks)).cast("int")), "blocks")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = index.withColumn("group", every(groups)).groupBy("chunk", "group")
    asked = anchors.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))

    holds = settle(index.select("chunk", "dim", F.explode("labels").alias("label")).distinct(), "labels")
    near = asked.join(holds, ["dim", "label"]).groupBy("chunk", "group")
    found = dealt.cogroup(near).applyInArrow(_best_positives(positives), "anchor_id long, score long, id long")
    best = settle(_ranked(found, ["anchor_id"], positives, "k"), "positives")

    given = best.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("k", "id", "score"))).alias("p"))  # a few positives of each
    bound = asked.join(given.select(F.col("anchor_id").alias("vec_id"), F.col("p.score").alias("scores")), "vec_id").withColumn("chunk", every(chunks))
    found = dealt.cogroup(bound.groupBy("chunk", "group")).applyInArrow(_best_negatives(negatives, low, high), "anchor_id long, positive int, score long, id long")
    worst = _ranked(found, ["anchor_id", "positive"], negatives, "rank").withColumn("k", F.col("positive") + 1)
    named = worst.join(best.select("anchor_id", "k", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["anchor_id", "k"])
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
