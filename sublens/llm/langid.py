"""Language identification by prediction by partial matching.

Each language has a context tree over bytes of order up to ``ORDER``: how often a byte followed each
context. The code length of a byte is that of PPM with escapes (method C) in the longest context the
tree knows: seen there, count / (count + kinds); else kinds / (count + kinds) for the escape, and
on with the context shortened by its first byte, down to all 256 bytes alike. The language whose frozen
tree gives the shortest code for a text is predicted; the score is its share when code lengths are
read as probabilities.

Counting is one pass with counts merged inside each task before they are summed per (language, gram).
Lower orders, and what each context was followed by, are summed from all counts before anything is left
out. A tree is bounded by its own language alone: of each order it holds at most its ``MAX_GRAMS`` most
frequent grams (whole levels of frequency), however large other languages are. Every language is scored:
``BLOCK_LANGS`` trees are broadcast at a time, and the best of each block is carried to the next, so the
model that a task holds has a fixed greatest size. Scoring turns each distinct gram of a batch into its
code lengths and sums these per text; nothing is shuffled. With more than one block the texts are stored
again between blocks.

Defined cases: null text, and text without a letter, is ``und`` with score 0, as is everything if there
was nothing to learn. Ties go to the first language name. Null languages are not learned. Repeated
rows count as often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sublens.llm.batches import bytes_of, mapped, slices
from sublens.llm.scratch import dropped, written

ORDER = 3
MAX_GRAMS = 1 << 18
BLOCK_LANGS = 4
HELD = 400_000
UNDETERMINED = "und"


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte, it and the three bytes before it in its text as one number, and how many of
    the three there are."""
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    wide = data.astype(np.uint32)
    code = wide.copy()
    for back in range(1, ORDER + 1):
        code[back:] |= wide[:-back] << np.uint32(8 * back)
    known = np.minimum(place, ORDER)
    # bytes of the text before do not belong to the context
    short = np.flatnonzero(known < ORDER)
    code[short] &= ((np.uint64(1) << (8 * (known[short].astype(np.uint64) + np.uint64(1)))) - np.uint64(1)).astype(np.uint32)
    return code, known


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, known, gram, n: how often each byte followed each full context; short contexts apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

        def emptied():
            for (lang, known), (codes, counts) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang]).take(pa.array(np.zeros(len(codes), np.int64))),
                        pa.array(np.full(len(codes), known, np.int32)),
                        pa.array(codes.astype(np.int64)),
                        pa.array(counts),
                    ],
                    ["lang", "known", "gram", "n"],
                )
            held.clear()

        for batch in batches:
            for part in slices(batch, 1):
                rows = defaultdict(list)
                for row, lang in enumerate(part.column(0).to_pylist()):
                    rows[lang].append(row)
                for lang, own in rows.items():
                    code, known = grams(*bytes_of(part.column(1).take(pa.array(own))))
                    for k in range(ORDER + 1):
                        found, n = np.unique(code[known == k], return_counts=True)
                        if not len(found):
                            continue
                        before = held.get((lang, k), (found[:0], n[:0]))
                        both = np.concatenate([before[0], found])
                        keys, at = np.unique(both, return_inverse=True)
                        sums = np.bincount(at, np.concatenate([before[1], n])).astype(np.int64)
                        held[lang, k] = keys, sums
                if sum(len(x[0]) for x in held.values()) > HELD:
                    yield from emptied()
        yield from emptied()

    schema = "lang string, known int, gram bigint, n bigint"
    rows = docs.filter("lang is not null and text is not null").select("lang", "text")
    return rows.mapInArrow(run, schema).groupBy("lang", "known", "gram").agg(F.sum("n").alias("n"))


class Trees:
    """Code lengths under the trees of all languages, from rows (lang, known, gram, n)."""

    def __init__(self, rows: list[tuple[str, int, int, int]]):
        self.langs = sorted({r[0] for r in rows})
        column = {lang: i for i, lang in enumerate(self.langs)}
        lang = np.array([column[r[0]] for r in rows], np.int64)
        known = np.array([r[1] for r in rows], np.int64)
        gram = np.array([r[2] for r in rows], np.uint64)
        n = np.array([r[3] for r in rows], np.int64)
        # a byte counts in every context that ends before it, so lower orders are sums of higher ones
        self.levels = []
        for order in range(ORDER + 1):
            long = known >= order
            mask = np.uint64((1 << (8 * (order + 1))) - 1)
            self.levels.append(self._level(lang[long], gram[long] & mask, n[long]))

    def _level(self, lang, gram, n):
        width = len(self.langs)
        keys, at = np.unique(gram, return_inverse=True)
        count = np.bincount(at * width + lang, n, len(keys) * width).reshape(len(keys), width)
        contexts, inside = np.unique(keys >> np.uint64(8), return_inverse=True)
        total = np.stack([np.bincount(inside, count[:, j], len(contexts)) for j in range(width)], 1) if len(keys) else np.zeros((0, width))
        kinds = np.stack([np.bincount(inside, count[:, j] > 0, len(contexts)) for j in range(width)], 1) if len(keys) else np.zeros((0, width))
        return keys, count, contexts, total, kinds

    @classmethod
    def cut(cls, table: pa.Table) -> "Trees":
        """From rows (lang, order, gram, n, total, kinds): total and kinds are those of the gram's context
        over all counts, also those that are not among the rows."""
        trees = cls([])
        trees.langs = sorted(set(table["lang"].unique().to_pylist()))
        column = pa.array(trees.langs, pa.string())
        lang = pa.compute.index_in(table["lang"], column).to_numpy().astype(np.int64)
        order, n, total, kinds = (table[c].to_numpy() for c in ("order", "n", "total", "kinds"))
        gram = table["gram"].to_numpy().astype(np.uint64)
        trees.levels = []
        for k in range(ORDER + 1):
            own = order == k
            keys, count, contexts, *_ = trees._level(lang[own], gram[own], n[own])
            at = np.searchsorted(contexts, gram[own] >> np.uint64(8))
            whole = np.zeros((2, len(contexts), len(trees.langs)))
            whole[0, at, lang[own]] = total[own]
            whole[1, at, lang[own]] = kinds[own]
            trees.levels.append((keys, count, contexts, *whole))
        return trees

    def code_lengths(self, gram: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Bits of each gram's last byte in its context, a column per language."""
        width = len(self.langs)
        bits = np.zeros((len(gram), width))
        open_ = np.ones((len(gram), width), bool)
        for order in range(ORDER, -1, -1):
            keys, count, contexts, total, kinds = self.levels[order]
            if not len(keys):
                continue
            wide = gram & np.uint64((1 << (8 * (order + 1))) - 1)
            at = np.minimum(np.searchsorted(keys, wide), len(keys) - 1)
            c = np.where((keys[at] == wide)[:, None], count[at], 0)
            context = wide >> np.uint64(8)
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            there = (contexts[at] == context)[:, None] & (known >= order)[:, None]
            t, k = np.where(there, total[at], 0), np.where(there, kinds[at], 0)
            usable = open_ & (t > 0)
            hit = usable & (c > 0)
            bits[hit] -= np.log2(c[hit] / (t[hit] + k[hit]))
            open_ &= ~hit
            missed = usable & ~hit
            bits[missed] -= np.log2(k[missed] / (t[missed] + k[missed]))
        return bits + 8.0 * open_


def bounded(counts: DataFrame) -> DataFrame:
    """lang, order, gram, n, total, kinds: each language's tree within its own bound."""
    order = F.explode(F.sequence(F.lit(0), F.col("known"))).alias("order")
    mask = F.expr("shiftleft(1L, 8 * (order + 1)) - 1")
    sums = (
        counts.select("lang", order, "gram", "n")
        .groupBy("lang", "order", F.col("gram").bitwiseAND(mask).alias("gram"))
        .agg(F.sum("n").alias("n"))
    )
    # a context is followed by 256 bytes at most
    context = Window.partitionBy("lang", "order", F.shiftright("gram", 8))
    whole = sums.withColumns({"total": F.sum("n").over(context), "kinds": F.count(F.lit(1)).over(context)})
    stored = written(whole.withColumn("level", F.floor(8 * F.log2("n")).cast("int")), "langid-levels")
    # how many grams each level of frequency has, some hundred rows a language: the cut keeps whole levels
    down = Window.partitionBy("lang", "order").orderBy(F.desc("level"))
    levels = stored.groupBy("lang", "order", "level").agg(F.count(F.lit(1)).alias("grams"))
    taken = levels.withColumn("taken", F.sum("grams").over(down)).filter(F.col("taken") <= MAX_GRAMS)
    kept = stored.join(taken.select("lang", "order", "level"), ["lang", "order", "level"], "left_semi")
    return written(kept.drop("level"), "langid-trees")


def learned(docs: DataFrame) -> Iterator[Trees]:
    """The trees of all languages, some languages at a time, by name."""
    trees = bounded(written(gram_counts(docs), "langid-grams"))
    names = sorted(r[0] for r in trees.select("lang").distinct().collect())
    for at in range(0, len(names), BLOCK_LANGS):
        block = trees.filter(F.col("lang").isin(names[at : at + BLOCK_LANGS]))
        yield Trees.cut(block.select("lang", "order", "gram", "n", "total", "kinds").toArrow())


SLOTS = 20
BLOCK = 1 << 18


def scored(docs: DataFrame, shared, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of docs with the best language of a block of trees (null without a letter), its
    bits, and the sum over the block of the probabilities relative to it."""

    def start():
        trees = shared.value
        names = trees.langs
        # code lengths of grams met so far, found by a hash of the gram
        codes = np.full(1 << SLOTS, -1, np.int64)
        table = np.zeros((1 << SLOTS, max(1, len(names))), np.float32)

        def lengths(gram: np.ndarray, known: np.ndarray) -> np.ndarray:
            key = (gram.astype(np.int64) << 2) | known
            slot = ((gram * np.uint32(2654435761) + known.astype(np.uint32) * np.uint32(40503)) >> np.uint32(32 - SLOTS)).astype(np.int64)
            new = np.flatnonzero(codes[slot] != key)
            if len(new):
                fresh, first = np.unique(key[new], return_index=True)
                at = new[first]
                table[slot[at]] = trees.code_lengths(gram[at].astype(np.uint64), known[at])
                codes[slot[at]] = key[at]
            out = table[slot]
            clash = np.flatnonzero(codes[slot] != key)
            if len(clash):
                out[clash] = trees.code_lengths(gram[clash].astype(np.uint64), known[clash])
            return out

        def run(texts: pa.Array) -> list:
            data, offsets = bytes_of(texts)
            n = len(texts)
            lower = data | 0x20
            latin = np.append(0, np.cumsum((lower >= 97) & (lower <= 122)))
            lettered = latin[offsets[1:]] > latin[offsets[:-1]]
            for i in np.flatnonzero(~lettered & (np.diff(offsets) > 0)):
                lettered[i] = any(c.isalpha() for c in texts[int(i)].as_py() or "")
            gram, known = grams(data, offsets)
            bits = np.zeros((n, len(names)))
            for a in range(0, len(data), BLOCK):
                b = min(a + BLOCK, len(data))
                sums = np.zeros((b - a + 1, len(names)))
                np.cumsum(lengths(gram[a:b], known[a:b]), 0, np.float64, sums[1:])
                inside = np.clip(offsets, a, b) - a
                bits += sums[inside[1:]] - sums[inside[:-1]]
            best = bits.argmin(1)
            least = bits.min(1)
            return [
                [names[b] if ok else None for b, ok in zip(best, lettered)],
                least,
                np.exp2(np.clip(least[:, None] - bits, -1000, 0)).sum(1),
            ]

        return run

    return mapped(docs, {"block_best": T.StringType(), "block_bits": T.DoubleType(), "block_sum": T.DoubleType()}, start, keep)


def _joined(before: DataFrame, keep: list[str]) -> DataFrame:
    """The best of the blocks so far and of a further one, which come by name: a tie stays with the first."""
    ahead = F.col("block_bits") < F.col("bits")
    scaled = lambda x: F.pow(F.lit(2.0), F.greatest(x, F.lit(-1000.0)))
    new, old = F.col("block_bits"), F.col("bits")
    return before.select(
        *keep,
        F.when(ahead, F.col("block_best")).otherwise(F.col("best")).alias("best"),
        F.least(new, old).alias("bits"),
        F.when(ahead, F.col("block_sum") + F.col("total") * scaled(new - old))
        .otherwise(F.col("total") + F.col("block_sum") * scaled(old - new))
        .alias("total"),
    )


def identified(docs: DataFrame, blocks: Iterator[Trees], keep: list[str]) -> DataFrame:
    """Columns ``keep`` of docs with lang_pred and score. ``keep`` may not hold the names of the carry."""
    carry = ["best", "bits", "total"]
    out, last, stored = docs.select(*keep, "text"), next(blocks, None), None
    if last is None:
        return out.select(*keep, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    first = True
    while last is not None:
        following = next(blocks, None)
        shared = docs.sparkSession.sparkContext.broadcast(last)
        carried = [*keep, *([] if following is None else ["text"])]
        found = scored(out, shared, carried if first else [*carried, *carry])
        if first:
            out = found.toDF(*carried, *carry)
        else:
            out = _joined(found, carried)
        first, last = False, following
        if following is not None:
            # a block's trees are given up before the next are broadcast
            out, before = written(out, "langid-block"), stored
            shared.destroy()
            if before is not None:
                dropped(before)
            stored = out
    return out.select(
        *keep,
        F.coalesce("best", F.lit(UNDETERMINED)).alias("lang_pred"),
        F.when(F.col("best").isNull(), F.lit(0.0)).otherwise(1 / F.col("total")).alias("score"),
    )


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def digest(docs: DataFrame) -> DataFrame:
    blocks = learned(docs.filter(~F.coalesce(held_out(), F.lit(True))))
    return identified(docs, blocks, ["doc_id"]).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
