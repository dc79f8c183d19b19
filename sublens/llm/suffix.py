"""Suffix-array dedup: byte strings of a given length that occur twice, over a logarithmic index family.

Suffixes are indexed where a text's own content says so: of the ``WIDTH - GRAM + 1`` grams of GRAM bytes
in any string of WIDTH bytes, the one with the smallest hash (the leftmost of equals) is an anchor. Equal
strings have the same anchor at the same place, so every long match shows as two anchors with one key.
About one byte in eighty is an anchor.

Each batch of documents gets a sparse suffix array: its anchors in the byte order of their first GRAM
bytes, within buckets. The batch is merge-scanned against every existing level, an ordered list of
heads of suffixes, for heads that occur in both; then it becomes a level itself, and levels that
stand for equally many batches merge before the next batch comes. So n batches keep about log n levels, and a
head is rewritten about log n times. All tables are bucketed and ordered alike, and scans and merges need no
shuffle.

Anchors that share their head are extended to both sides. A string of WIDTH bytes around an anchor is told
by the number of its bytes before the anchor, 0 to LEFT. For a range of these numbers, the *core* is what
all its strings share and the *hull* what they cover together. Anchors are ordered by core and hull: one
whose neighbour has the same hull shares all strings of the range, one without a neighbour of the same core
shares none, and for the others the range is cut in four and compared again, down to single strings. The
order alone decides, so nothing is joined, and a boundary costs a few rows in each of four rounds. Anchors
of many small heads are compared in one task; those of a head with more than ``LARGE`` different
surroundings are ordered over all tasks, by the same rule (neighbours across a task's border are settled
from the first and last row of each task). Cores are compared by 64-bit hash.
Texts that cannot hold a match stay out of shuffles by a filter of bounded size.

Defined cases: null text is empty. A text of fewer than WIDTH bytes loses nothing. Texts that occur
twice are removed whole (if long enough); repeated rows are such texts. Rows without doc_id are rows
like others. Overlapping repeats in one text count. Ties do not occur: a byte is covered or it is not.
A text is worked on as a whole in one task, with about forty bytes of memory for each of its bytes. Extra
columns are passed over. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sublens.llm.batches import BYTE_CODES, bytes_of, mixed, powers, slices
from sublens.llm.filters import maybe_members
from sublens.llm.scratch import folder, same_row, text_key, written

WIDTH, GRAM = 200, 40
LEFT = WIDTH - GRAM
BATCHES = 4
# Surroundings compared in one task: 360 bytes each, and some ten times that in hashes.
LARGE = 4_000
FAN = 4
ROUNDS = 4  # FAN ** ROUNDS strings at least
SEEN = 50_000
BLOCK = 1 << 22
_PLACE = 28
_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_inverses = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    global _inverses
    if len(_inverses) < n:
        steps = np.full(max(n, 2 * len(_inverses)), _INVERSE)
        steps[0] = 1
        _inverses = np.multiply.accumulate(steps)
    return _inverses[:n]


class Rolling:
    """Hash of any byte range of ``data`` from prefix sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_CODES[data] * powers(len(data)), out=self.sums[1:])
        self.back = inverse_powers(len(data) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]


def anchors(data: np.ndarray, offsets: np.ndarray, roll: Rolling) -> np.ndarray:
    """Places of the anchors of all texts."""
    starts = np.concatenate([np.arange(a, b - WIDTH + 1) for a, b in zip(offsets[:-1], offsets[1:]) if b - a >= WIDTH] or [np.zeros(0, np.int64)])
    low = np.uint64((1 << _PLACE) - 1)
    found = []
    for k in range(0, len(starts), BLOCK):
        some = starts[k : k + BLOCK]
        at = np.arange(some[0], some[-1] + LEFT + 1)
        least = (mixed(roll(at, at + GRAM)) & ~low) | (at - some[0]).astype(np.uint64)
        # least over 1, 2, 4, ... 128 grams, then over all LEFT + 1
        reach = 1
        while reach * 2 <= LEFT + 1:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        rest = LEFT + 1 - reach
        some = some - some[0]
        found.append((np.minimum(least[some], least[some + rest]) & low).astype(np.int64) + at[0])
    return np.unique(np.concatenate(found)) if found else starts


def _surroundings(place, first, last):
    """Range of all strings of WIDTH bytes around an anchor, within its text."""
    return np.maximum(place - LEFT, first), np.minimum(place + WIDTH, last)


def heads(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """The first GRAM bytes of each suffix."""
    rows = np.ascontiguousarray(data[at[:, None] + np.arange(GRAM)])
    offsets = (np.arange(len(at) + 1) * GRAM).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def suffixes(docs: DataFrame, batches: int = 1) -> DataFrame:
    """head, around, doc_id, text_key, pos, batch of each anchor. A text the task has just met is passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for part in slices(batch, 2):
                fresh = []
                for row, key in enumerate(part.column(1).to_pylist()):
                    if key not in met:
                        fresh.append(row)
                        met.add(key)
                if len(met) > SEEN:
                    met.clear()
                part = part.take(pa.array(fresh, pa.int64()))
                data, offsets = bytes_of(part.column(2))
                roll = Rolling(data)
                at = anchors(data, offsets, roll)
                if not len(at):
                    continue
                row = np.searchsorted(offsets, at, "right") - 1
                a, b = _surroundings(at, offsets[row], offsets[row + 1])
                shape = ((at - a) * 1024 + (b - at)).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        heads(data, at),
                        pa.array(mixed(roll(a, b) + mixed(shape)).view(np.int64)),
                        part.column(0).take(pa.array(row)),
                        part.column(1).take(pa.array(row)),
                        pa.array((at - offsets[row]).astype(np.int32)),
                        part.column(3).take(pa.array(row)),
                    ],
                    ["head", "around", "doc_id", "text_key", "pos", "batch"],
                )

    kind = docs.schema["doc_id"].dataType
    fields = [("head", T.BinaryType()), ("around", T.LongType()), ("doc_id", kind), ("text_key", T.LongType()), ("pos", T.IntegerType()), ("batch", T.IntegerType())]
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch")
    rows = docs.filter(F.octet_length("text") >= WIDTH).select("doc_id", text_key(F.col("text")).alias("text_key"), "text", batch)
    return rows.mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))


class SuffixIndex:
    """The index family. ``add`` takes batches; ``matched`` then holds all suffixes whose head occurs twice."""

    def __init__(self, spark: SparkSession):
        self.spark, self.buckets = spark, int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables: list[str] = []
        self.arrays: list[DataFrame] = []
        self.levels: list[tuple[int, DataFrame]] = []
        self.found: list[DataFrame] = []

    def _stored(self, df: DataFrame, *split: str) -> DataFrame:
        """A table bucketed, and in the byte order of the heads; ``df`` is dealt by head already."""
        name = f"suffix_{uuid.uuid4().hex}"
        rows = df.write.option("path", f"{folder(self.spark)}/{name}").bucketBy(self.buckets, "head").sortBy("head")
        (rows.partitionBy(*split) if split else rows).saveAsTable(name)
        self.tables.append(name)
        return self.spark.table(name)

    def add(self, docs: DataFrame, batches: int = 1) -> None:
        """Store the suffix arrays of ``batches`` batches in one pass over ``docs``, and take them in one by one."""
        rows = suffixes(docs, batches).repartition(self.buckets, "head")
        arrays = self._stored(rows, "batch")
        self.arrays.append(arrays)
        for k in range(batches):
            self._take(arrays.filter(F.col("batch") == k).select("head"))

    def _take(self, own: DataFrame) -> None:
        """Merge-scan a batch against every level; its own array is the lowest level from then on.

        Levels of equal size merge when the next batch comes. The scans are parts of one plan that runs in ``matched``.
        """
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, last), (_, before) = self.levels.pop(), self.levels.pop()
            self.levels.append((2 * size, self._stored(before.unionByName(last).distinct())))
        self.found.append(own.groupBy("head").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("head"))
        for _, level in self.levels:
            self.found.append(own.join(level.hint("merge"), "head", "left_semi"))
        self.levels.append((1, own))

    def matched(self) -> DataFrame:
        """key (hash of the head), around, doc_id, text_key, pos of all suffixes whose head occurs twice, in any batch."""
        known, rows = self.found[0], self.arrays[0]
        for more in self.found[1:]:
            known = known.unionByName(more)
        for more in self.arrays[1:]:
            rows = rows.unionByName(more)
        hits = rows.join(known.distinct().hint("merge"), "head")
        return hits.select(F.xxhash64("head").alias("key"), "around", "doc_id", "text_key", "pos")

    def close(self) -> None:
        """Drop the tables and their files."""
        for name in self.tables:
            self.spark.sql(f"drop table if exists {name}")
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder(self.spark)}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.tables = []


def _fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Surroundings of wanted anchors (key, large, single, doc_id, text_key, pos): adds left and around."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                data, offsets = bytes_of(part.column(2))
                lists = part.column(3)
                row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                flat = lists.flatten()
                place = flat.field("pos").to_numpy() + offsets[row]
                a, b = _surroundings(place, offsets[row], offsets[row + 1])
                text = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        flat.field("key"), flat.field("large"), flat.field("single"),
                        part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
                        flat.field("pos"), pa.array((place - a).astype(np.int32)),
                        pa.array([text[x:y] for x, y in zip(a.tolist(), b.tolist())], pa.binary()),
                    ],
                    [f.name for f in schema],
                )

    kind = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("key", T.LongType()), T.StructField("large", T.BooleanType()), T.StructField("single", T.BooleanType()),
            T.StructField("doc_id", kind), T.StructField("text_key", T.LongType()), T.StructField("pos", T.IntegerType()),
            T.StructField("left", T.IntegerType()), T.StructField("around", T.BinaryType()),
        ]
    )
    per_text = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("key", "large", "single", "pos")).alias("list"))
    texts = maybe_members(docs.select("doc_id", "text"), wanted).withColumn("text_key", text_key(F.col("text")))
    # repeated rows are removed whole elsewhere
    joined = texts.join(per_text.hint("merge"), same_row(texts, per_text)).select(texts["doc_id"], texts["text_key"], "text", "list")
    return joined.mapInArrow(run, schema)


class Ranges:
    """Ranges lo..hi of strings around anchors: rows of surroundings that begin ``left`` bytes before the anchor."""

    def __init__(self, around: pa.Array, left: np.ndarray):
        self.data, self.offsets = bytes_of(around.cast(pa.large_binary()).view(pa.large_utf8()))
        self.left, self.right = left, np.diff(self.offsets) - left
        self.roll = Rolling(self.data)

    def cut(self, row: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """Each range in up to FAN parts, as the range it comes from, row, lo and hi; a part without a string
        inside the text is left out."""
        size = (hi - lo) // FAN + 1
        source = np.repeat(np.arange(len(row)), FAN)
        row, low, high, size = (x[source] for x in (row, lo, hi, size))
        low = low + size * np.tile(np.arange(FAN), len(lo))
        high = np.minimum(high, low + size - 1)
        good = (low <= high) & (low <= self.left[row]) & (WIDTH - high <= self.right[row])
        return source[good], row[good], low[good], high[good]

    def core(self, row, lo, hi) -> np.ndarray:
        place = self.offsets[row] + self.left[row]
        return mixed(self.roll(place - lo, place + WIDTH - hi) + mixed(lo.astype(np.uint64)))

    def hull(self, row, lo, hi):
        """Bytes before and after the anchor."""
        return np.minimum(hi, self.left[row]), np.minimum(WIDTH - lo, self.right[row])

    def hull_hash(self, row, lo, hi) -> np.ndarray:
        before, after = self.hull(row, lo, hi)
        place = self.offsets[row] + self.left[row]
        return mixed(self.roll(place - before, place + after) + mixed((before * 1024 + after).astype(np.uint64)))


def judged(same_core: np.ndarray, same_hull: np.ndarray, single: np.ndarray):
    """For rows in order, from whether neighbours agree (one entry more than rows): found (the whole range
    occurs elsewhere), going on (one row of a hull, if the core has others), and ``single`` as it is then."""
    twice = same_hull[:-1] | same_hull[1:]
    going = np.where(twice, ~same_hull[:-1], same_core[:-1] | same_core[1:])
    return twice & single, going, single & ~twice


def _borders(inner: np.ndarray, n: int) -> np.ndarray:
    """From the n - 1 pairs of neighbours to all n + 1 borders."""
    out = np.zeros(n + 1, bool)
    out[1:n] = inner
    return out


def _repeated(rows: DataFrame) -> DataFrame:
    """doc_id, text_key, start, end of repeated strings among rows of a piece; of single rows only."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ranges = Ranges(pa.concat_arrays(table["around"].chunks), table["left"].to_numpy().astype(np.int64))
        row, single = np.arange(len(table)), table["single"].to_numpy(zero_copy_only=False)
        lo, hi = np.zeros(len(table), np.int64), np.full(len(table), LEFT)
        found = []
        for _ in range(ROUNDS):
            source, row, lo, hi = ranges.cut(row, lo, hi)
            core, hull, single = ranges.core(row, lo, hi), ranges.hull_hash(row, lo, hi), single[source]
            order = np.lexsort((row, hull, core))
            row, lo, hi, core, hull, single = (x[order] for x in (row, lo, hi, core, hull, single))
            same_core = _borders(core[1:] == core[:-1], len(row))
            same_hull = same_core & _borders(hull[1:] == hull[:-1], len(row))
            hit, going, single = judged(same_core, same_hull, single)
            found.append((row[hit], *ranges.hull(row[hit], lo[hit], hi[hit])))
            row, lo, hi, single = (x[going] for x in (row, lo, hi, single))
        row, before, after = (np.concatenate(x) for x in zip(*found))
        pos = table["pos"].to_numpy()[row]
        return pa.table(
            {
                "doc_id": table["doc_id"].take(pa.array(row)),
                "text_key": table["text_key"].take(pa.array(row)),
                "start": pa.array((pos - before).astype(np.int32)),
                "end": pa.array((pos + after).astype(np.int32)),
            }
        )

    return rows.groupBy("piece").applyInArrow(run, _spans_schema(rows))


def _spans_schema(rows: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("text_key", T.LongType()),
            T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
        ]
    )


RANGE = ["core", "before", "around"]


def _parts(rows: DataFrame, first: bool) -> DataFrame:
    """Ranges of rows cut in parts, each with its core and the bytes of its hull, ``before`` of them before the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                before, lo, hi = (part.column(i).to_numpy().astype(np.int64) for i in (4, 6, 7))
                ranges = Ranges(part.column(5), before)
                row, place, low, high = ranges.cut(np.arange(len(before)), lo, hi)
                a, b = ranges.hull(place, low, high)
                middle = ranges.offsets[place] + before[place]
                text = ranges.data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(i).take(pa.array(row)) for i in range(4)],
                        pa.array(a.astype(np.int32)),
                        pa.array([text[x:y] for x, y in zip((middle - a).tolist(), (middle + b).tolist())], pa.binary()),
                        pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)),
                        pa.array(ranges.core(place, low, high).view(np.int64)),
                    ],
                    names,
                )

    lo, hi = (F.lit(0), F.lit(LEFT)) if first else (F.col("lo"), F.col("hi"))
    given = rows.select(
        "doc_id", "text_key", "pos", "single", F.col("left" if first else "before").alias("before"), "around",
        lo.cast("int").alias("lo"), hi.cast("int").alias("hi"),
    )
    names = [*given.columns, "core"]
    return given.mapInArrow(run, T.StructType([*given.schema.fields, T.StructField("core", T.LongType())]))


def _neighbours(parts: DataFrame) -> DataFrame:
    """Rows of parts that matter, with found, going and single as in ``judged``, and whether a row is the first
    or last of its task (edge) and has no neighbour of its hull there (alone)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, core_before, hull_before, fresh = None, False, False, True

        def made(rows: pa.Table, core: np.ndarray, hull: np.ndarray, edge: np.ndarray) -> list[pa.RecordBatch]:
            found, going, single = judged(core, hull, rows["single"].to_numpy())
            alone = ~(hull[:-1] | hull[1:])
            going |= edge & alone
            keep = pa.array(found | going | edge)
            rows = rows.set_column(rows.column_names.index("single"), "single", pa.array(single))
            for name, flags in (("found", found), ("going", going), ("edge", edge), ("alone", alone)):
                rows = rows.append_column(name, pa.array(flags))
            return rows.filter(keep).combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = (pa.concat_tables([held, table]) if held is not None else table).combine_chunks()
            core, left, around = (pa.concat_arrays(table[c].chunks) for c in RANGE)
            inner = pc.equal(core[1:], core[:-1]).to_numpy(zero_copy_only=False)
            whole = inner & (pc.equal(left[1:], left[:-1]).to_numpy(zero_copy_only=False))
            whole &= pc.equal(around[1:], around[:-1]).to_numpy(zero_copy_only=False)
            # the last row waits for the next batch
            n = len(table) - 1
            core, hull = np.append(core_before, inner), np.append(hull_before, whole)
            edge = np.zeros(n, bool)
            if n:
                edge[0], fresh = fresh, False
                yield from made(table.slice(0, n), core, hull, edge)
            held, core_before, hull_before = table.slice(n), core[-1], hull[-1]
        if held is not None:
            yield from made(held, np.array([core_before, False]), np.array([hull_before, False]), np.array([True]))

    flags = [T.StructField(c, T.BooleanType()) for c in ("found", "going", "edge", "alone")]
    keys = [*RANGE, F.xxhash64("doc_id", "text_key", "pos")]
    return parts.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, T.StructType([*parts.schema.fields, *flags]))


def _repeated_large(rows: DataFrame) -> list[DataFrame]:
    """The same for heads of many surroundings: ordered over all tasks, one table for each round."""
    found = []
    for k in range(ROUNDS):
        # stored, as finding the borders of the ranges reads them once more
        near = written(_neighbours(written(_parts(rows, k == 0), "suffix-parts")), "suffix-ranges")
        # two rows of each task at most: those of one hull are neighbours across a border
        edges = near.filter("edge").withColumn("twice", F.count(F.lit(1)).over(Window.partitionBy(*RANGE)) > 1)
        edges = edges.withColumn("found", F.col("found") | (F.col("alone") & F.col("twice") & F.col("single")))
        edges = edges.withColumn("single", F.col("single") & ~F.col("twice")).drop("twice")
        settled = near.filter("not edge").unionByName(edges)
        start = F.col("pos") - F.col("before")
        found.append(settled.filter("found").select("doc_id", "text_key", start.alias("start"), (start + F.octet_length("around")).cast("int").alias("end")))
        rows = settled.filter("going")
    return found


def spans(docs: DataFrame, batches: int = BATCHES, large: int = LARGE) -> DataFrame:
    """doc_id, text_key, spans: ranges (start, end) of bytes that repeated strings cover, not merged."""
    spark = docs.sparkSession
    plain = docs.select("doc_id", "text")
    index = SuffixIndex(spark)
    index.add(plain, batches)
    hits = written(index.matched(), "suffix-hits")
    index.close()
    classes = written(
        hits.groupBy("key", "around").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_key", "pos")).alias("one")
        ),
        "suffix-classes",
    )
    shared = classes.filter("n > 1").select("key", "around")
    settled = hits.join(shared.hint("merge"), ["key", "around"]).select(
        "doc_id", "text_key", F.greatest(F.col("pos") - LEFT, F.lit(0)).alias("start"), (F.col("pos") + WIDTH).alias("end")
    )
    several = classes.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 and least = 1")
    wanted = written(
        classes.join(several.hint("merge"), "key").select(
            "key", (F.col("kinds") > large).alias("large"), (F.col("n") == 1).alias("single"), "one.doc_id", "one.text_key", "one.pos"
        ),
        "suffix-wanted",
    )
    size = wanted.groupBy("large").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {row["large"]: row["n"] for row in size}
    fetched = written(_fetched(plain, wanted), "suffix-around")
    pieces = max(1, counts.get(False, 0) // large)
    small = fetched.filter("not large").withColumn("piece", F.pmod("key", F.lit(pieces)))
    ranges = settled.unionByName(_repeated(small))
    if counts.get(True):
        for more in _repeated_large(fetched.filter("large")):
            ranges = ranges.unionByName(more)
    copies = copied(plain)
    return written(
        ranges.unionByName(copies).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "end")).alias("spans")),
        "suffix-spans",
    )


def copied(docs: DataFrame) -> DataFrame:
    """Whole range of texts that occur twice."""
    rows = docs.filter(F.octet_length("text") >= WIDTH).select(
        "doc_id", text_key(F.col("text")).alias("text_key"), F.xxhash64(F.lit(1), "text").alias("second"), F.octet_length("text").alias("end")
    )
    rows = written(rows, "suffix-texts")
    key = ["text_key", "second", "end"]
    twice = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return rows.join(twice.hint("merge"), key).select("doc_id", "text_key", F.lit(0).alias("start"), "end")


def without_repeats(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary)."""
    kind = docs.schema["doc_id"].dataType
    fields = [("doc_id", kind), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept", T.BinaryType())]
    schema = T.StructType([T.StructField(*f) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                columns = [[] for _ in range(4)]
                for text, ranges in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    data, kept, reach, n = (text or "").encode(), [], 0, 0
                    for a, b in sorted((x["start"], x["end"]) for x in ranges or []):
                        if a > reach or not n:
                            kept.append(data[reach:a])
                            n += 1
                        reach = max(reach, b)
                    kept.append(data[reach:])
                    kept = b"".join(kept)
                    for column, value in zip(columns, (len(data), len(data) - len(kept), n, kept)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]],
                    [f.name for f in schema],
                )

    rows = docs.select("doc_id", "text")
    near = maybe_members(rows, found).withColumn("text_key", text_key(F.col("text")))
    touched = near.join(found.hint("merge"), same_row(near, found), "left").select(near["doc_id"], "text", "spans").mapInArrow(run, schema)
    text = F.coalesce("text", F.lit(""))
    rest = maybe_members(rows, found, inside=False).select(
        "doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"), text.cast("binary").alias("kept"),
    )
    return touched.unionByName(rest)


def suffix_dedup(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    return without_repeats(docs, spans(docs, batches))


def digest(docs: DataFrame) -> DataFrame:
    return suffix_dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
