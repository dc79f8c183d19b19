"""N-gram Jaccard join: documents whose sets of word shingles overlap enough, and their components.

Sizes are cut into bands, so that a partner of a set lies in its own band or a neighbouring one. Two
sets of a band pair can differ in at most d shingles. Each set is dealt by hash into k > d parts, so
any two linked sets agree in some part; k leaves room for weak parts, and a set with more weak parts
than that room is dealt once more with a larger k. Empty parts are weak, and so are parts of one
shingle while larger ones are enough: a passage that many texts hold fills such parts alone and would
chain unlike texts into groups that grow faster than the table. A part that is not weak becomes one key:
sets that share a key are candidates, all others cannot link.

Candidates go into tiles. In a tile every set is compared with the bit signatures of the sets of fitting
size: each differing bit stands for a different shingle, so bit counts bound the overlap from above.
Only pairs that pass and are not connected yet get the exact intersection of their sorted arrays. A
tile returns the links that connect its sets, never all pairs. Groups too large for a tile are dealt into
other parts by another hash, as linked sets share a key of every dealing: what chained unlike sets by chance
rarely does so again. Where that no longer helps, they are cut by band and hash: first each piece with a few sets of its group in common, then, only where the group is
still in several components, pairs of pieces.

Copies of one set are joined by the set's hash, pre-aggregated. Only the smallest document of a set
meets others in tiles; a bitmap keeps most other copies from making keys. Sets are 64-bit shingle
hashes; exactness is up to collisions of these.

Defined cases: without words or text a set is empty and links with nothing; fewer words than ``n`` make
one shingle. Rows that share a doc_id are one document that links with what any of them links with.
Rows without doc_id get n_shingles, no component, and link with nothing. Ties need no rule, as a
component is named by its smallest doc_id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sublens.llm.batches import SPACES, Words, mapped, mixed, slices, windows
from sublens.llm.components import component_labels
from sublens.llm.filters import maybe_members
from sublens.llm.scratch import written

N = 4
# Least similarity, as a fraction.
OF, PER = 85, 100
# Shingles in a tile (16 MB of hashes); pieces of large groups are about half as large.
TILE = 2 << 20
BITS = 2048
# Differing shingles from which on parts of one shingle are weak.
SINGLES = 8


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(texts, SPACES)
    hashes = words.hashes()
    rolled = windows(hashes, n)
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= n:
            yield np.unique(rolled[a : b - n + 1])
        elif b > a:
            yield windows(hashes[a:b], int(b - a))
        else:
            yield np.zeros(0, np.uint64)


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles and two hashes of the set."""

    def start():
        def run(texts: pa.Array) -> list:
            rows = [
                (len(s), int(mixed(s).sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mixed(~s)).view(np.int64)) if len(s) else 0)
                for s in shingle_sets(texts, n)
            ]
            return list(zip(*rows)) if rows else [[], [], []]

        return run

    fields = {"n_shingles": T.LongType(), "set1": T.LongType(), "set2": T.LongType()}
    return mapped(docs, fields, start, ["doc_id"])


class Bands:
    """Size bands of a similarity of/per: band i holds sizes from low[i] up to low[i + 1]."""

    def __init__(self, of: int, per: int):
        self.of, self.per, self.low = of, per, [1]

    def band(self, size: int) -> int:
        while self.low[-1] <= size:
            self.low.append(self.low[-1] * self.per // self.of + 1)
        return int(np.searchsorted(self.low, size, "right")) - 1

    def differences(self, band: int) -> int:
        """Most differing shingles of a link whose smaller set is in the band."""
        high = self.low[band + 1] - 1
        both = high + high * self.per // self.of
        # overlap >= of / (of + per) of the sum of sizes
        return both - -(-2 * self.of * both // (self.of + self.per))


def part_keys(shingles: np.ndarray, bands: Bands, dealing: int = 0) -> list[np.ndarray]:
    """Keys of one set: as the smaller of a pair in its own band, as the larger in the band below."""
    out = []
    dealt = (mixed(shingles + np.uint64(dealing)) if dealing else shingles) >> np.uint64(32)
    spread = mixed(shingles ^ np.uint64(0x5851F42D4C957F2D))
    own = bands.band(len(shingles))
    for band in {own, max(0, own - 1)}:
        d, level = bands.differences(band), 0
        if not d:
            continue  # only equal sets link
        few = d < SINGLES
        while True:
            # of two linked sets both or neither have a weak part where they agree, and they agree in
            # room + 1 parts: one is not weak unless both sets have more weak parts than room
            least, room = (1, 2 * 4**level) if few or level > 1 else (2, (d // 8 + 2, d // 3 + 4)[level])
            k = d + 1 + room
            part = ((dealt * np.uint64(k)) >> np.uint64(32)).astype(np.int64)
            filled = np.bincount(part, minlength=k)
            sums = sum(
                np.bincount(part, (half & np.uint64(0xFFFFFFFF)).astype(float), k).astype(np.uint64) << np.uint64(s)
                for s, half in ((0, spread), (32, spread >> np.uint64(32)))
            )
            tag = np.uint64((band << 40) + (level << 32)) + np.arange(k, dtype=np.uint64)
            out.append(mixed(sums + mixed(tag))[filled >= least])
            if np.count_nonzero(filled < least) <= room:
                break
            level += 1
    return out


def keyed(docs: DataFrame, n: int, of: int, per: int, dealing: int = 0) -> DataFrame:
    """key, doc_id of every part that is not weak."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(of, per)
        for batch in batches:
            for part in slices(batch, 1):
                keys, rows = [], []
                for row, shingles in enumerate(shingle_sets(part.column(1), n)):
                    for found in part_keys(shingles, bands, dealing) if len(shingles) else ():
                        keys.append(found)
                        rows.append(np.full(len(found), row))
                if keys:
                    ids = part.column(0).take(pa.array(np.concatenate(rows)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), ids], ["key", "doc_id"])

    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType)])
    return docs.filter("doc_id is not null").select("doc_id", "text").mapInArrow(run, schema)


def candidates(docs: DataFrame, n: int, of: int, per: int, dealing: int = 0, groups: DataFrame | None = None) -> DataFrame:
    """Edges from every document of a key to the key's smallest document, inside ``groups`` (doc_id, root)."""
    parts, key = keyed(docs, n, of, per, dealing), ["key"]
    if groups is not None:
        parts, key = parts.join(groups, "doc_id"), ["key", "root"]
    least = F.min("doc_id").over(Window.partitionBy(*key))
    return parts.withColumn("least", least).filter("doc_id <> least").select("doc_id", "least").distinct()


class _Forest:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i


def tile_links(sets: list[np.ndarray], known: list, pieces: list, of: int, per: int) -> list[tuple[int, int]]:
    """Links that connect the sets of a tile. ``known`` names components found before; sets of one
    piece have been compared already, unless all pieces are None."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order])
    bits = np.zeros((len(order), BITS // 64), np.uint64)
    for row, i in enumerate(order):
        at = (sets[i] >> np.uint64(20)) % np.uint64(BITS)
        np.bitwise_or.at(bits[row], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    forest, first, links = _Forest(len(order)), {}, []
    for row, i in enumerate(order):
        if known[i] is not None:
            forest.parent[forest.root(row)] = forest.root(first.setdefault(known[i], row))
    ends = np.searchsorted(sizes, sizes * per // of, "right")
    for row, i in enumerate(order):
        a, b = row + 1, int(ends[row])
        if not sizes[row] or a >= b:
            continue
        apart = np.bitwise_count(bits[a:b] ^ bits[row]).sum(1, dtype=np.int64)
        both = sizes[a:b] + sizes[row]
        # overlap o <= (both - apart) / 2, and a link needs per * o >= of * (both - o)
        fits = np.flatnonzero((of + per) * ((both - apart) // 2) >= of * both)
        for other in (fits + a).tolist():
            j = order[other]
            if (pieces[i] is not None and pieces[i] == pieces[j]) or forest.root(row) == forest.root(other):
                continue
            overlap = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if (of + per) * overlap >= of * (len(sets[i]) + len(sets[j])):
                forest.parent[forest.root(other)] = forest.root(row)
                links.append((i, j))
    return links


def tiles_joined(rows: DataFrame, n: int, of: int, per: int) -> DataFrame:
    """Links in each tile of rows (tile, doc_id, known, piece, text)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sets = []
        for batch in table.select(["text"]).to_batches():
            for part in slices(batch, 0):
                sets.extend(shingle_sets(part.column(0), n))
        links = tile_links(sets, table["known"].to_pylist(), table["piece"].to_pylist(), of, per)
        ids = table["doc_id"]
        index = lambda side: pa.array([x[side] for x in links], pa.int64())
        return pa.table({"a": ids.take(index(0)), "b": ids.take(index(1))})

    kind = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return rows.groupBy("tile").applyInArrow(run, schema)


def links(docs: DataFrame, sizes: DataFrame, n: int, of: int, per: int, tile: int = TILE) -> DataFrame:
    """Links between different sets that connect whatever is linked.

    ``sizes``: doc_id, n_shingles of a document of each set; the others are left out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    full = docs.select("doc_id", "text").filter("doc_id is not null")
    band = F.floor(F.log(F.col("n").cast("double")) / np.log(per / of)).cast("int")

    def grouped(among: DataFrame, *dealt) -> tuple[DataFrame, DataFrame, int]:
        near = written(candidates(maybe_members(full, among), n, of, per, *dealt), "jaccard-candidates", keep_shuffles=False)
        groups = component_labels(near.select("doc_id", "least"), "jaccard-groups")
        members = groups.join(sizes.groupBy("doc_id").agg(F.max("n_shingles").alias("n")), groups["node"] == F.col("doc_id"))
        weights = members.groupBy("root").agg(F.sum("n").alias("weight"))
        placed = written(
            members.join(weights, "root").select("doc_id", "root", "weight", band.alias("band"), "n"), "jaccard-members"
        )
        over = placed.filter(F.col("weight") > tile)
        return placed.filter(F.col("weight") <= tile), over, over.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    small, large, load = grouped(sizes)
    before, dealing = 2 * load, 0
    while load and 4 * load <= 3 * before:
        before, dealing = load, dealing + 1
        more, large, load = grouped(large, dealing, large.select("doc_id", "root"))
        small = small.unionByName(more)

    def found(rows: DataFrame) -> DataFrame:
        # a table that grows with the documents; the same join at every size
        tiled = maybe_members(full, rows).join(rows.hint("merge"), "doc_id")
        return written(tiles_joined(tiled, n, of, per), "jaccard-links", keep_shuffles=False)

    none = F.lit(None)
    whole = small.select(
        F.struct("root", F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(0).alias("z"), F.lit(0).alias("w")).alias("tile"),
        "doc_id",
        none.cast(kind).alias("known"),
        none.cast("string").alias("piece"),
    )
    done = found(whole)
    if not load:
        return done
    # pieces of half a tile at most, by band and hash
    loads = large.groupBy("root", "band").agg(F.sum("n").alias("load"), F.min("doc_id").alias("pivot"))
    cut = large.join(loads, ["root", "band"]).withColumn(
        "pieces", F.ceil(F.col("load") * 2 / tile).cast("int")
    ).withColumn("sub", F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("int"))
    cut = written(cut.select("doc_id", "root", "band", "pieces", "sub", "pivot"), "jaccard-pieces")
    # first the pieces, each with the pivots of its own band and the next
    own = cut.select("root", "band", "sub", "doc_id")
    pivots = cut.filter("doc_id = pivot").select("root", F.explode(F.array("band", F.col("band") - 1)).alias("band"), "pieces", "doc_id")
    shared = (
        cut.select("root", "band", "sub").distinct().join(pivots.select("root", "band", "doc_id"), ["root", "band"])
    )
    first = own.unionByName(shared).distinct().select(
        F.struct("root", F.col("band").alias("x"), F.col("sub").alias("y"), F.lit(-1).alias("z"), F.lit(-1).alias("w")).alias("tile"),
        "doc_id",
        none.cast(kind).alias("known"),
        none.cast("string").alias("piece"),
    )
    near_links = found(first)
    parts = component_labels(near_links, "jaccard-parts")
    state = cut.join(
        parts.select("node", F.col("root").alias("known_root")), cut["doc_id"] == F.col("node"), "left"
    ).select(*[cut[c] for c in cut.columns], F.coalesce("known_root", "doc_id").alias("known"))
    open_ = state.groupBy("root").agg(F.min("known").alias("low"), F.max("known").alias("high")).filter("low <> high")
    rest = state.join(open_.select("root"), "root")
    counts = rest.select("root", "band", "pieces").distinct()
    partner = counts.select("root", F.col("band").alias("other"), F.col("pieces").alias("others"))
    # a piece meets every piece of its own band and of the next ones
    meets = (
        rest.join(partner, "root")
        .filter(F.abs(F.col("other") - F.col("band")) <= 1)
        .select("root", "band", "sub", "other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("k"), "doc_id", "known")
    )
    mine, theirs = F.struct("band", "sub"), F.struct(F.col("other").alias("band"), F.col("k").alias("sub"))
    low, high = F.least(mine, theirs), F.greatest(mine, theirs)
    second = meets.filter(mine != theirs).select(
        F.struct("root", low["band"].alias("x"), low["sub"].alias("y"), high["band"].alias("z"), high["sub"].alias("w")).alias("tile"),
        "doc_id",
        "known",
        F.concat_ws("/", "band", "sub").alias("piece"),
    )
    return done.unionByName(near_links).unionByName(found(second))


def jaccard_components(docs: DataFrame, n: int = N, of: int = OF, per: int = PER, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id, a row for each row of docs."""
    plain = docs.select("doc_id", "text")
    sets = written(signatures(plain, n), "jaccard-sets")
    full = sets.filter("n_shingles > 0 and doc_id is not null")
    least = written(
        full.groupBy("n_shingles", "set1", "set2").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")),
        "jaccard-distinct",
    )
    copies = full.join(least.filter("copies > 1"), ["n_shingles", "set1", "set2"]).select("doc_id", "least")
    between = links(plain, least.select(F.col("least").alias("doc_id"), "n_shingles"), n, of, per, tile)
    labels = component_labels(
        copies.toDF("a", "b").unionByName(between), "jaccard-components"
    )
    return sets.join(labels, sets["doc_id"] == labels["node"], "left").select(
        sets["doc_id"], "n_shingles", F.coalesce("root", sets["doc_id"]).alias("component_id")
    )


def digest(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs)


def stage(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: the one that names it. Rows without id stay."""
    found = jaccard_components(docs)
    gone = written(found.filter("component_id <> doc_id").select("doc_id").distinct(), "jaccard-removed")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


ORACLE_SQL = """
with recursive lists as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i + 1 : i + 4], ' ') as s
  from (select doc_id, w, unnest(range(greatest(len(w) - 3, 1))) as i from lists where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as o
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
linked as (
  select x, y from common join sizes sx on sx.doc_id = x join sizes sy on sy.doc_id = y
  where 185 * o >= 85 * (sx.n + sy.n)),
edges as (select x, y from linked union all select y, x from linked),
reach as (
  select x as doc_id, y as other from edges
  union
  select reach.doc_id, edges.y from reach join edges on reach.other = edges.x)
select l.doc_id, coalesce(any_value(s.n), 0) as n_shingles, least(l.doc_id, coalesce(min(r.other), l.doc_id)) as component_id
from lists l left join sizes s on l.doc_id = s.doc_id left join reach r on l.doc_id = r.doc_id
group by l.doc_id
"""
