"""Vector code compression: product codes whose codebooks are fitted by Lloyd rounds over cover trees.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook of its own.
The rows are cut into blocks inside their partition, without a shuffle. For every block and part position
a cover tree is built once over the block's distinct parts and stored with the number, the sum and the
farthest distance of the points below every node. A round walks each tree from its root: where the
nearest entry is nearer than any other by more than twice a node's radius, no point below can prefer
another (triangle inequality), so the node's sum and count go to the entry as they are. Only nodes that stay
undecided descend; single points are compared exactly, in whole numbers. Tasks add up their blocks, Spark adds
up the tasks, and the driver sees one sum per entry and component.

The tree is the one of a farthest-first order: its prefixes are nets, in which points are farther apart than
the net's radius and all others lie within it. A radius halves from level to level, a point's parent is the
nearest point of the next coarser net.

Defined cases: a null vector, or one with a null or non-finite component, is dropped. Components are cut to
+-``LARGEST`` before scaling, so that distances are exact in 64 bits. Shorter vectors count as filled up with
zeros to the longest kept one, and that to a multiple of the number of parts. Rows that repeat a vec_id stay
rows; ties for the first codebook go by vector, nulls of vec_id come last. With fewer vectors than entries
the codebook is as short. Equal parts weigh as often as they occur. An empty table gives an empty result.
Columns are taken by name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sublens.llm.scratch import written

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LARGEST = 4095.0
BLOCK = 1024
# Relative room for rounding when distances are compared by their square roots.
_ROOM = 1e-9

# A block of rows is one stored row, so that the parts of a vector never come apart.
def _arrays(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, T.ArrayType(kind)) for name in names]


_TREE = T.StructType([
    *_arrays(T.IntegerType(), "points", "members", "node_point", "child_from", "child_to"),
    *_arrays(T.LongType(), "weights", "counts", "sums"),
    *_arrays(T.DoubleType(), "radius"),
])
_BLOCK = T.StructType([
    *_arrays(T.LongType(), "vec_ids", "labels"),
    T.StructField("width", T.IntegerType()),
    *_arrays(_TREE, "trees"),
])


class CoverTree:
    """A cover tree over distinct points of whole numbers, each with a weight.

    Node 0 is the root; a node's children are ``child_from`` to ``child_to``, always behind it. A node
    without children is a single point. ``radius`` is the distance of its farthest point below.
    """

    def __init__(self, points, weights, node_point, child_from, child_to, radius, counts, sums):
        self.points, self.weights = points, weights
        self.node_point, self.child_from, self.child_to = node_point, child_from, child_to
        self.radius, self.counts, self.sums = radius, counts, sums

    @classmethod
    def built(cls, points: np.ndarray, weights: np.ndarray) -> CoverTree:
        n = len(points)
        level, parent = _nets(points)
        # Nodes of several points: a point at a level where others hang below it, coarsest first.
        later = np.arange(1, n)
        pairs = np.unique(np.stack([-level[later], parent[later]], 1), axis=0) if n > 1 else np.zeros((0, 2), np.int64)
        key_of = {(int(p), int(-lv)): i for i, (lv, p) in enumerate(pairs)}
        levels_of: dict[int, list[int]] = {}
        for lv, p in pairs:
            levels_of.setdefault(int(p), []).append(int(-lv))  # from coarse to fine
        children: list[list[tuple[int, int]]] = [[] for _ in pairs]
        for p, levels in levels_of.items():
            for lv, finer in zip(levels, [*levels[1:], None]):
                children[key_of[p, lv]].append((p, finer))
        for y in later:
            own = levels_of.get(int(y))
            children[key_of[int(parent[y]), int(level[y])]].append((int(y), own[0] if own else None))
        # Sums and radii below each such node: points climb to their ancestor, level by level.
        counts = np.zeros(len(pairs), np.int64)
        sums = np.zeros((len(pairs), points.shape[1]), np.int64)
        radius = np.zeros(len(pairs))
        above = np.arange(n)
        weighted = points * weights[:, None]
        for lv in np.unique(level[later]) if n > 1 else []:
            climbs = np.arange(n)
            rising = later[level[later] == lv]
            climbs[rising] = parent[rising]
            above = climbs[above]
            node = np.full(n, -1)
            here = np.flatnonzero(pairs[:, 0] == -lv)
            node[pairs[here, 1]] = here
            at = node[above]
            inside = np.flatnonzero(at >= 0)
            np.add.at(counts, at[inside], weights[inside])
            np.add.at(sums, at[inside], weighted[inside])
            gap = points[inside] - points[above[inside]]
            np.maximum.at(radius, at[inside], np.sqrt((gap * gap).sum(1).astype(np.float64)))
        # Numbered breadth first, so that the children of a node stand side by side.
        root = (0, levels_of[0][0] if 0 in levels_of else None)
        order, spans, i = [root], [], 0
        while i < len(order):
            p, lv = order[i]
            below = children[key_of[p, lv]] if lv is not None else []
            spans.append((len(order), len(order) + len(below)))
            order.extend(below)
            i += 1
        source = np.array([key_of[p, lv] if lv is not None else -1 for p, lv in order], np.int64)
        node_point = np.array([p for p, _ in order], np.int64)
        single = source < 0
        spans = np.array(spans, np.int64)
        node_counts, node_sums, node_radius = weights[node_point].copy(), weighted[node_point].copy(), np.zeros(len(order))
        node_counts[~single], node_sums[~single] = counts[source[~single]], sums[source[~single]]
        node_radius[~single] = radius[source[~single]]
        return cls(points, weights, node_point, spans[:, 0], spans[:, 1], node_radius, node_counts, node_sums)

    def assigned(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nodes, entries, distances): nodes that go to an entry as a whole; together they hold every point
        once. The squared distances are exact for nodes of a single point, 0 elsewhere."""
        nodes, found, gaps = [], [], []
        front = np.zeros(1, np.int64)
        while len(front):
            squares = squared_distances(self.points[self.node_point[front]], book)
            best = squares.argmin(1)
            nearest = squares[np.arange(len(front)), best]
            single = self.child_from[front] == self.child_to[front]
            if len(book) > 1:
                rest = squares.copy()
                rest[np.arange(len(front)), best] = np.iinfo(np.int64).max
                first, second = np.sqrt(nearest.astype(np.float64)), np.sqrt(rest.min(1).astype(np.float64))
                reach = 2 * self.radius[front]
                whole = second - first > reach + _ROOM * (first + second + reach)
            else:
                whole = np.ones(len(front), bool)
            done = single | whole
            nodes.append(front[done])
            found.append(best[done])
            gaps.append(np.where(single, nearest, 0)[done])
            front = _ranges(self.child_from[front[~done]], self.child_to[front[~done]])
        return np.concatenate(nodes), np.concatenate(found), np.concatenate(gaps)

    def entry_sums(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nodes, entries, _ = self.assigned(book)
        counts, sums = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
        np.add.at(counts, entries, self.counts[nodes])
        np.add.at(sums, entries, self.sums[nodes])
        return counts, sums

    def entries(self, book: np.ndarray) -> np.ndarray:
        """The entry of every point: that of the decided node above it."""
        nodes, found, _ = self.assigned(book)
        out = np.full(len(self.points), -1)
        while len(nodes):
            single = self.child_from[nodes] == self.child_to[nodes]
            out[self.node_point[nodes[single]]] = found[single]
            starts, ends = self.child_from[nodes[~single]], self.child_to[nodes[~single]]
            found = np.repeat(found[~single], ends - starts)
            nodes = _ranges(starts, ends)
        return out


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All whole numbers of several ranges, one after the other."""
    lengths = ends - starts
    before = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.repeat(starts, lengths) + np.arange(lengths.sum()) - before


def squared_distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    gap = points[:, None, :] - book[None, :, :]
    return np.einsum("nkd,nkd->nk", gap, gap)


def _nets(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Level and parent of every point but the first, by farthest-first order: at level l a point is within
    2**(l + 1) of its parent and farther than 2**l from every point of a coarser level."""
    n = len(points)
    level, parent = np.zeros(n, np.int64), np.zeros(n, np.int64)
    gap = points - points[0]
    nearest = (gap * gap).sum(1)
    owner = np.zeros(n, np.int64)
    now = None
    for _ in range(n - 1):
        x = int(nearest.argmax())
        square = int(nearest[x])
        # 4**l < square <= 4**(l + 1)
        here = (square - 1).bit_length() // 2 if square > 1 else 0
        here = here - 1 if square <= 4**here else here
        if here != now:
            now, coarser = here, owner.copy()
        level[x], parent[x] = here, coarser[x]
        gap = points - points[x]
        far = (gap * gap).sum(1)
        closer = far < nearest
        nearest[closer], owner[closer] = far[closer], x
    return level, parent


def _whole_numbers(vectors: pa.Array, width: int) -> np.ndarray:
    """Whole numbers of the vectors, one row each, filled up with zeros to ``width``."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    offsets = np.asarray(vectors.offsets, np.int64)
    values = np.asarray(vectors.values.slice(offsets[0], offsets[-1] - offsets[0]), np.float64)
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), width), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, _ranges(np.zeros_like(lengths), lengths)] = np.floor(np.clip(values, -LARGEST, LARGEST) * SCALE)
    return out


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id, vector and label of the rows whose vector is whole and finite."""
    vector = vectors["embedding"].cast("array<double>")
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vectors.select(
        vectors["vec_id"].cast("bigint").alias("vec_id"), vector.alias("vector"), vectors["label"].cast("bigint").alias("label")
    ).where(F.col("vector").isNotNull() & F.forall("vector", sound))


def blocks(rows: DataFrame, width: int, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """One row per block: ids and labels of its vectors, and for every part position the distinct parts, the
    one that each vector has, and the cover tree over them. ``width`` is that of a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(_BLOCK)
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                piece = batch.slice(at, block)
                numbers = _whole_numbers(piece.column(1), width * parts)
                trees = []
                for part in range(parts):
                    cut = numbers[:, part * width : (part + 1) * width]
                    points, members, weights = np.unique(cut, axis=0, return_inverse=True, return_counts=True)
                    tree = CoverTree.built(points, weights.astype(np.int64))
                    trees.append({
                        "points": points.ravel(), "weights": weights, "members": members.ravel(),
                        "node_point": tree.node_point, "child_from": tree.child_from, "child_to": tree.child_to,
                        "radius": tree.radius, "counts": tree.counts, "sums": tree.sums.ravel(),
                    })
                values = [piece.column(0).to_pylist(), piece.column(2).to_pylist(), width, trees]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    return rows.select("vec_id", "vector", "label").mapInArrow(run, _BLOCK)


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array, list[CoverTree], list[np.ndarray]]]:
    """(ids, labels, trees, members) of every stored block; ids and labels may be left out of the batches."""
    for batch in batches:
        for i in range(batch.num_rows):
            width = batch.column("width")[i].as_py()
            stored = batch.column("trees")[i].values
            cells = {f.name: stored.field(f.name) for f in stored.type}
            trees, members = [], []
            for part in range(len(stored)):
                own = {k: np.asarray(v[part].values) for k, v in cells.items()}
                own = {k: v if k == "radius" else v.astype(np.int64) for k, v in own.items()}
                members.append(own.pop("members", None))
                own["points"] = own["points"].reshape(-1, width)
                own["sums"] = own["sums"].reshape(-1, width)
                trees.append(CoverTree(**own))
            ids, labels = (
                batch.column(c)[i].values if c in batch.schema.names else None for c in ("vec_ids", "labels")
            )
            yield ids, labels, trees, members


def moved(stored: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: every entry becomes the floor of the mean of its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(book), np.int64) for book in books]
        sums = [np.zeros(book.shape, np.int64) for book in books]
        for _, _, trees, _ in _blocks_of(batches):
            for p, tree in enumerate(trees):
                c, s = tree.entry_sums(books[p])
                counts[p] += c
                sums[p] += s
        part, entry, place, total, n = [], [], [], [], []
        for p, book in enumerate(books):
            for e in np.flatnonzero(counts[p]):
                part += [p] * book.shape[1]
                entry += [int(e)] * book.shape[1]
                place += range(book.shape[1])
                total += sums[p][e].tolist()
                n += [int(counts[p][e])] * book.shape[1]
        values = [*[pa.array(v, pa.int32()) for v in (part, entry, place)], *[pa.array(v, pa.int64()) for v in (total, n)]]
        yield pa.RecordBatch.from_arrays(values, ["part", "entry", "place", "total", "n"])

    given = stored.select("width", "trees").mapInArrow(run, "part int, entry int, place int, total bigint, n bigint")
    exact = F.sum(F.col("total").cast("decimal(38,0)"))
    added = given.groupBy("part", "entry", "place").agg(exact.alias("total"), F.sum("n").alias("n"))
    # At most one row per entry and component, whatever the number of vectors.
    out = [book.copy() for book in books]
    for row in added.collect():
        out[row["part"]][row["entry"], row["place"]] = int(row["total"]) // row["n"]
    return out


def coded(stored: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code, error: the nearest entry of every part, and the sum of their squared distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, trees, members in _blocks_of(batches):
            codes = np.zeros((len(ids), len(books)), np.uint8)
            errors = np.zeros(len(ids), np.int64)
            for p, (tree, book) in enumerate(zip(trees, books)):
                entries = tree.entries(book)
                gap = tree.points - book[entries]
                codes[:, p] = entries[members[p]]
                errors += (gap * gap).sum(1)[members[p]]
            text = pa.array([row.tobytes().hex() for row in codes], pa.string())
            yield pa.RecordBatch.from_arrays([ids, labels, text, pa.array(errors)], ["vec_id", "label", "code", "error"])

    return stored.mapInArrow(run, "vec_id bigint, label bigint, code string, error bigint")


def first_books(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids."""
    head = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").toArrow()
    numbers = _whole_numbers(head.column(0).combine_chunks(), width * parts)
    return [numbers[:, p * width : (p + 1) * width].copy() for p in range(parts)]


def fitted(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK):
    """(stored blocks with their trees, codebooks). The trees are built once and read in every round."""
    rows = kept(vectors)
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    stored = written(blocks(rows, width, parts, block), "code-trees")
    books = first_books(rows, width, parts, entries)
    for _ in range(rounds if len(books[0]) else 0):
        books = moved(stored, books)
    return stored, books


def books_digest(books: list[np.ndarray]) -> str:
    values = [str(int(x)) for book in books for entry in book for x in entry]
    return hashlib.sha256(",".join(values).encode()).hexdigest()


def digest(vectors: DataFrame) -> DataFrame:
    stored, books = fitted(vectors)
    codes = written(coded(stored, books), "codes")
    totals = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    c, t = codes.alias("c"), totals.alias("t")
    return c.join(t, F.col("c.label").eqNullSafe(F.col("t.label"))).select(
        "c.vec_id", "c.code", "c.error", "t.label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same rounds by plain comparison of every part with every entry."""
    distance = "list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    ctes = [
        f"""numbered as (
  select row_number() over (order by vec_id, embedding) as id, vec_id, label,
    list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"""pieces as materialized (
  select id, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] as v
  from numbered, range({parts}) as r(part))""",
        f"book0 as materialized (select part, id - 1 as entry, v from pieces where id <= {entries})",
    ]
    for k in range(rounds + 1):
        ctes.append(f"""near{k} as materialized (
  select p.id, p.part, arg_min(b.entry, ({distance}, b.entry)) as entry, min({distance}) as square
  from pieces as p join book{k} as b on b.part = p.part group by p.id, p.part)""")
        if k < rounds:
            ctes.append(f"""mean{k} as (
  select part, entry, list(x order by place) as v from (
    select p.part, n.entry, place, cast(floor(sum(p.v[place]) / count(*)) as bigint) as x
    from pieces as p join near{k} as n on n.id = p.id and n.part = p.part, unnest(range(1, len(p.v) + 1)) as u(place)
    group by all)
  group by all)""")
            ctes.append(f"""book{k + 1} as materialized (
  select b.part, b.entry, coalesce(m.v, b.v) as v
  from book{k} as b left join mean{k} as m on m.part = b.part and m.entry = b.entry)""")
    ctes.append(f"""coded as (
  select id, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(square) as bigint) as error
  from near{rounds} group by id)""")
    return f"""with {", ".join(ctes)}
select n.vec_id, c.code, c.error, cast(sum(c.error) over (partition by n.label) as bigint) as label_error,
  (select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) from book{rounds}) as codebooks_sha256
from coded as c join numbered as n on n.id = c.id"""


ORACLE_SQL = _oracle()
