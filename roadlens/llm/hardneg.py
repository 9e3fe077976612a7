"""Hard negatives: rows of another label that are almost as close to an anchor as its positives.

A multiway tree of split points (GNAT) is grown on a sample; every row goes down it to the nearest split
point of each node, and every node keeps, over all rows, the least and greatest distance of each child's
rows to each of its split points, and the range of their norms. A window of scores around an anchor is an
annulus of distances once the norms are known: a child is left out where, for any split point, its range
does not meet what the annulus allows. Leaves that remain are read exactly.

An anchor is answered in three rounds. Its own leaf gives five positives and so a bound; leaves that may
hold a score at least as high give the positives; leaves that meet the windows of the positives give the
negatives. Leaves are stored in blocks of bounded size, so that a vector with very many copies is many
blocks; anchors go to blocks in packs. The sample bounds the tree, the tree bounds what goes to workers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.frames import map_batches, stored, table

SCALE = 256
#: Rows of the sample the tree is grown on, split points of a node, sample rows of a leaf.
SAMPLE, DEGREE, LEAF = 16_384, 8, 512
BLOCK_ROWS = 1 << 16
#: Cells of a matrix of scores.
CELLS = 1 << 22
POSITIVES = NEGATIVES = 5
#: Window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 80, 100
SLACK = 1e-6

ROWS = "leaf int, vec_id long, label long, vec binary"
VISITS = "leaf int, block int, anchors binary"


@dataclass
class Node:
    """Split points, and the child of each: a node, or a leaf as ``-1 - leaf``. ``low`` and ``high`` are
    distances of the children's rows (second axis) to the split points (first axis), ``norms`` the
    squares of the rows' lengths."""

    points: np.ndarray
    kids: list[int]
    low: np.ndarray = field(init=False)
    high: np.ndarray = field(init=False)
    norms: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        m = len(self.points)
        self.low, self.high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        self.norms = np.tile([np.inf, -np.inf], (m, 1))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


class Tree:
    def __init__(self, sample: np.ndarray, degree: int = DEGREE, leaf: int = LEAF, seed: int = 0):
        self.nodes: list[Node] = []
        self.leaves = 0
        self.paths: list[list[tuple[int, int]]] = []
        self.root = self._grow(sample, degree, leaf, np.random.default_rng(seed), [])

    def _grow(self, rows: np.ndarray, degree: int, leaf: int, rng, path: list[tuple[int, int]]) -> int:
        chosen = self._split_points(rows, degree, rng) if len(rows) > leaf else rows[:0]
        if len(chosen) < 2:
            self.paths.append(path)
            self.leaves += 1
            return -self.leaves
        number = len(self.nodes)
        self.nodes.append(node := Node(chosen, []))
        nearest = distances(rows, chosen).argmin(1)
        for j in range(len(chosen)):
            node.kids.append(self._grow(rows[nearest == j], degree, leaf, rng, [*path, (number, j)]))
        return number

    @staticmethod
    def _split_points(rows: np.ndarray, degree: int, rng) -> np.ndarray:
        """Points far from each other, out of three times as many."""
        some = rows[rng.choice(len(rows), min(len(rows), 3 * degree), replace=False)]
        chosen = [0]
        nearest = distances(some, some[:1])[:, 0]
        while len(chosen) < degree and nearest.max() > SLACK:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, distances(some, some[chosen[-1:]])[:, 0])
        return some[chosen]

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        leaf = np.zeros(len(rows), dtype=np.int32)
        todo = [(self.root, np.arange(len(rows)))]
        while todo:
            at, which = todo.pop()
            if at < 0:
                leaf[which] = -1 - at
            elif len(which):
                node = self.nodes[at]
                nearest = distances(rows[which], node.points).argmin(1)
                todo += [(kid, which[nearest == j]) for j, kid in enumerate(node.kids)]
        return leaf

    def visits(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves that may hold a score in ``[low, high]``, with the rows that have to look there."""
        norm = (rows * rows).sum(1)[:, None]
        todo = [(self.root, np.arange(len(rows)))]
        while todo:
            at, which = todo.pop()
            if at < 0 or not len(which):
                if len(which):
                    yield -1 - at, which
                continue
            node = self.nodes[at]
            d = distances(rows[which], node.points)[:, :, None]
            least, most = node.norms.T
            # A child without rows has no norms: it is as far from everything as can be.
            most, least = np.where(most < least, -1, most), np.where(most < least, 0, least)
            far = norm[which] + most - 2 * low[which, None]
            near = np.sqrt(np.maximum(norm[which] + least - 2 * high[which, None], 0))[:, None, :]
            possible = (far > -SLACK) & (most >= least)
            far = np.sqrt(np.maximum(far, 0))[:, None, :]
            meets = (node.high >= np.maximum(d - far, near - d) - SLACK * (1 + d)) & (node.low <= (d + far) * (1 + SLACK) + SLACK)
            possible &= meets.all(1)
            todo += [(kid, which[possible[:, j]]) for j, kid in enumerate(node.kids)]


def _matrix(vectors: list[bytes], kind: str, width: int) -> np.ndarray:
    """Vectors as the rows of a matrix; shorter ones end in zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        row = np.frombuffer(v, dtype=kind)
        out[i, : len(row)] = row
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-valued vectors, in single precision where their lengths show that no sum of
    some of the products can leave its whole numbers."""
    most = np.sqrt((a * a).sum(1).max(initial=0) * (b * b).sum(1).max(initial=0))
    if most < 1 << 23:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.float64)
    return a @ b.T


def best(s: np.ndarray, usable: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest usable scores of every row of ``s`` as (row, column), ties by column."""
    held = np.where(usable, s, -np.inf)
    if held.shape[1] > k:
        usable = usable & (held >= np.partition(held, -k, axis=1)[:, -k, None])
    row, column = np.nonzero(usable)
    order = np.lexsort((column, -held[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def _integers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(batch.column(name).to_numpy(zero_copy_only=False))


class Index:
    """All rows in a tree, its leaves in blocks."""

    def __init__(self, rows: DataFrame, sample: int = SAMPLE, degree: int = DEGREE, leaf: int = LEAF, block_rows: int = BLOCK_ROWS):
        """``rows``: vec_id long, label long, vec (array of floats or doubles of whole values)."""
        single = dict(rows.dtypes)["vec"] == "array<float>"
        self.kind = kind = "<f4" if single else "<f8"
        n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
        self.width = width
        drawn = rows if n <= sample else rows.sample(False, sample / n, 7)
        vectors = [np.asarray(r.vec, dtype=kind).tobytes() for r in drawn.select("vec").collect()]
        self.tree = tree = Tree(_matrix(vectors, kind, width), degree, leaf)

        def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            blobs = [np.asarray(v, dtype=kind).tobytes() for v in batch.column("vec").to_pylist()]
            leaves = tree.assign(_matrix(blobs, kind, width))
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaves), batch.column("vec_id"), batch.column("label"), pa.array(blobs, pa.binary())],
                names=["leaf", "vec_id", "label", "vec"],
            )

        self.rows = stored(map_batches(rows.select("vec_id", "label", "vec"), ROWS, place), "hardneg_rows")
        sizes = self.rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("n_blocks"))
        #: One row a leaf, bounded by the tree.
        self.n_blocks = {r.leaf: r.n_blocks for r in sizes.collect()}
        blocks = self.rows.join(F.broadcast(sizes), "leaf").withColumn(
            "block", F.pmod(F.monotonically_increasing_id(), F.col("n_blocks")).cast("int")
        )

        def pack(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("vec_id")
            leaf, block = rows.column("leaf")[0].as_py(), rows.column("block")[0].as_py()
            vectors = _matrix(rows.column("vec").to_pylist(), kind, width)
            norms = (vectors * vectors).sum(1)
            ranges = []
            for number, kid in tree.paths[leaf]:
                d = distances(vectors, tree.nodes[number].points)
                ranges += [
                    {"node": number, "kid": kid, "point": i, "low": a, "high": b, "least": norms.min(), "most": norms.max()}
                    for i, (a, b) in enumerate(zip(d.min(0), d.max(0)))
                ]
            blobs = [rows.column(c).to_numpy().astype(np.int64).tobytes() for c in ("vec_id", "label")]
            return pa.table({
                "leaf": pa.array([leaf], pa.int32()), "block": pa.array([block], pa.int32()),
                "ids": pa.array(blobs[:1], pa.binary()), "labels": pa.array(blobs[1:], pa.binary()),
                "vecs": pa.array([vectors.astype(kind).tobytes()], pa.binary()),
                "ranges": pa.array([ranges], pa.list_(pa.struct([(c, pa.int32()) for c in ("node", "kid", "point")] + [(c, pa.float64()) for c in ("low", "high", "least", "most")]))),
            })

        packed = blocks.groupBy("leaf", "block").applyInArrow(
            pack,
            "leaf int, block int, ids binary, labels binary, vecs binary,"
            " ranges array<struct<node:int,kid:int,point:int,low:double,high:double,least:double,most:double>>",
        )
        packed = stored(packed, "hardneg_blocks")
        self.blocks = packed.drop("ranges")
        ranges = packed.select(F.inline("ranges")).groupBy("node", "kid", "point").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.min("least").alias("least"), F.max("most").alias("most")
        )
        for r in ranges.collect():
            node = tree.nodes[r.node]
            node.low[r.point, r.kid], node.high[r.point, r.kid] = r.low, r.high
            node.norms[r.kid] = r.least, r.most

    def look(self, anchors: DataFrame, windows: int, home: bool = False) -> DataFrame:
        """Sends anchors (vec_id, pack long, label, vec, leaf, lows and highs: array<long>) to the blocks of the
        leaves that may hold a score between their least low and greatest high: rows (leaf, block, anchors)."""
        tree, kind, width, n_blocks = self.tree, self.kind, self.width, self.n_blocks

        def route(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows = _matrix(batch.column("vec").to_pylist(), kind, width)
            bounds = [
                np.array(batch.column(c).to_pylist(), dtype=np.float64).reshape(len(rows), windows) for c in ("lows", "highs")
            ]
            own = _integers(batch, "leaf")
            if home:
                found = [(int(x), np.flatnonzero(own == x)) for x in np.unique(own)]
            else:
                found = tree.visits(rows, bounds[0].min(1), bounds[1].max(1))
            numbers = np.stack([_integers(batch, c) for c in ("vec_id", "pack", "label", "leaf")], axis=1)
            for leaf, which in found:
                pack = _packed(kind, numbers[which], rows[which], *(b[which] for b in bounds))
                for block in range(n_blocks.get(leaf, 0)):
                    columns = [pa.array([leaf], pa.int32()), pa.array([block], pa.int32()), pa.array([pack], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["leaf", "block", "anchors"])

        return map_batches(anchors, VISITS, route)

    def scored(self, visits: DataFrame, windows: int, k: int, same_label: bool, skip_home: bool = False) -> DataFrame:
        """The ``k`` best rows of a block for every window of every anchor that visits it: anchor_id, pack,
        window, id, score."""
        kind, width = self.kind, self.width

        def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for leaf, *blobs, packed in zip(*(batch.column(c).to_pylist() for c in ("leaf", "ids", "labels", "vecs", "anchors"))):
                ids, labels = (np.frombuffer(b, dtype=np.int64) for b in blobs[:2])
                vectors = np.frombuffer(blobs[2], dtype=kind).reshape(len(ids), width).astype(np.float64)
                numbers, rows, lows, highs = _unpacked(kind, packed, width, windows)
                if skip_home:
                    there = numbers[:, 3] != leaf
                    numbers, rows, lows, highs = numbers[there], rows[there], lows[there], highs[there]
                step = max(1, CELLS // len(ids))
                for first in range(0, len(rows), step):
                    part = slice(first, first + step)
                    s = scores(rows[part], vectors)
                    same = labels == numbers[part, 2, None]
                    allowed = same & (ids != numbers[part, 0, None]) if same_label else ~same
                    for w in range(windows):
                        inside = allowed & (s >= lows[part, w, None]) & (s <= highs[part, w, None])
                        row, column = best(s, inside, k)
                        if len(row):
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(numbers[part][row, 0]), pa.array(numbers[part][row, 1]),
                                    pa.array(np.full(len(row), w, dtype=np.int32)), pa.array(ids[column]),
                                    pa.array(s[row, column].astype(np.int64)),
                                ],
                                names=["anchor_id", "pack", "window", "id", "score"],
                            )

        joined = visits.join(self.blocks, ["leaf", "block"])
        return map_batches(joined, "anchor_id long, pack long, window int, id long, score long", score)


def _packed(kind: str, numbers: np.ndarray, rows: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> bytes:
    """Anchors as bytes: their number, ids, packs, labels and leaves, vectors, and ends of windows."""
    head = np.array([len(numbers), *numbers.ravel()], dtype=np.int64)
    return head.tobytes() + b"".join(x.astype(t).tobytes() for x, t in ((lows, "<f8"), (highs, "<f8"), (rows, kind)))


def _unpacked(kind: str, data: bytes, width: int, windows: int) -> tuple[np.ndarray, ...]:
    n = int(np.frombuffer(data, dtype=np.int64, count=1)[0])
    out, at = [], 8
    for columns, t in ((4, "<i8"), (windows, "<f8"), (windows, "<f8"), (width, kind)):
        part = np.frombuffer(data, dtype=t, count=n * columns, offset=at).reshape(n, columns)
        at += part.nbytes
        out.append(part)
    numbers, lows, highs, rows = out
    return numbers, rows.astype(np.float64), lows, highs


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label and whole-valued vectors of the rows that take part."""
    vector, label = F.col(f"`{vector_col}`"), F.col(f"`{label_col}`")
    named = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.cast("long").alias("label"), vector.alias("vec"))
    finite = F.forall("vec", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    element = dict(named.dtypes)["vec"][6:-1]
    whole = F.transform("vec", lambda x: F.floor(x.cast("double") * SCALE).cast(element))
    return named.filter("vec_id is not null and label is not null and vec is not null").filter(finite).withColumn("vec", whole)


def hard_negatives(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    anchor_every: int = 100, sample: int = SAMPLE, degree: int = DEGREE, leaf: int = LEAF, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose id is divisible by ``anchor_every``; scores are inner products of the vectors
    times 256, rounded down. An anchor's positives are its five best rows of the same label and another
    id; for each, the five best rows of another label with 80 to 100 hundredths of its score are returned.
    Ties go to the smaller id. Rows without id, label or vector, or with a missing or not finite component,
    take no part; shorter vectors end in zeros; anchors that repeat in all three are answered once, other
    repeated rows count as rows; scores are exact below 2 to the power of 53. An empty table, or one without anchors, gives
    an empty result.
    """
    index = Index(usable(rows, id_col, vector_col, label_col), sample, degree, leaf, block_rows)
    number = F.xxhash64("vec_id", "label", "vec")
    anchors = stored(
        index.rows.filter(F.col("vec_id") % anchor_every == 0).withColumn("pack", number).dropDuplicates(["vec_id", "label", "vec"]),
        "hardneg_anchors",
    )

    def bounds(low, high) -> list:
        return [F.array(low.cast("double")).alias("lows"), F.array(high.cast("double")).alias("highs")]

    least, most = F.lit(float("-inf")), F.lit(float("inf"))
    key = ["anchor_id", "pack"]
    order = (F.col("score").desc(), "id")

    def top(found: DataFrame, by: list[str], k: int, place: str) -> DataFrame:
        return found.withColumn(place, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(place) <= k)

    at_home = index.scored(index.look(anchors.select("*", *bounds(least, most)), 1, home=True), 1, POSITIVES, True)
    at_home = stored(top(at_home, key, POSITIVES, "place"), "hardneg_home")
    fifth = at_home.filter(F.col("place") == POSITIVES).select(F.col("anchor_id").alias("vec_id"), "pack", F.col("score").alias("fifth"))
    bounded = anchors.join(fifth, ["vec_id", "pack"], "left")
    wide = bounded.select(*anchors.columns, *bounds(F.coalesce(F.col("fifth").cast("double"), least), most))
    elsewhere = index.scored(index.look(wide, 1), 1, POSITIVES, True, skip_home=True)
    positives = top(elsewhere.unionByName(at_home.drop("place")), key, POSITIVES, "place")
    listed = stored(
        positives.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("positives")), "hardneg_positives"
    )
    # Windows that do not exist are empty: their low end is above the high end.
    score = lambda i: F.get("positives", F.lit(i))["score"]
    low = [F.coalesce(F.ceil(score(i) * LOW / 100).cast("double"), most) for i in range(POSITIVES)]
    high = [F.coalesce(F.floor(score(i) * HIGH / 100).cast("double"), least) for i in range(POSITIVES)]
    asked = anchors.join(listed.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "pack"]).select(
        *anchors.columns, F.array(*low).alias("lows"), F.array(*high).alias("highs")
    )
    negatives = index.scored(index.look(asked, POSITIVES), POSITIVES, NEGATIVES, False)
    ranked = top(negatives, [*key, "window"], NEGATIVES, "rank")
    of = F.get("positives", F.col("window"))
    return ranked.join(listed, key).select(
        "anchor_id", of["id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        of["score"].alias("positive_score"), F.col("score").alias("negative_score"),
    )


def op13_hard_negatives(spark, sf_dir) -> DataFrame:
    """All embeddings; ids divisible by 7 have the next label."""
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", shifted))


OP13_SQL = """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id as id, b.label as label,
    list_inner_product(a.v, b.v)::bigint as score
  from vectors a join vectors b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, id as positive_id, score as positive_score from pairs where label = anchor_label
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, p.positive_id,
  row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.id)::int as rank,
  n.id as negative_id, p.positive_score, n.score as negative_score
from positives p join pairs n on n.anchor_id = p.anchor_id and n.label <> n.anchor_label
  and 80 * p.positive_score <= 100 * n.score and n.score <= p.positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.id) <= 5
"""
