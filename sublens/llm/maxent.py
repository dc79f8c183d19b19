"""LM scoring: a hashed maximum-entropy model with class-factored softmax.

A token is predicted from the two before it. The ``TOP`` most frequent words and the end of text are
symbols of their own, all other words fall into ``BINS`` symbols by the hash of their last letters;
inside such a bin a word has its add-one share of the training counts. P(symbol) = P(class) P(symbol in
class), both softmaxes over the sum of the weight rows that the context selects: a bias, the previous
token (bigram), the one before it (skip), and both together (trigram), hashed into ``ROWS`` rows.

Three passes over the texts, each with counts merged inside tasks: words (all of them, exactly), then
(context, symbol) events of the training texts, then scores. Weights are learned in ``ROUNDS`` rounds:
the events, dealt by context over ``PARTS`` tasks, give gradient steps on the broadcast weights, and the
changes of each row are averaged by how much a task has seen of it. Scoring fills a table of code
lengths for the contexts that a batch brings and looks tokens up in it.

Exact counts of all words are needed for every text, but only a bounded head (``HEAD`` words) is
broadcast. Rarer words leave the scoring pass as (text, hash, how often) and meet their counts in a
join by hash; none of them is frequent, so no key is hot. Words are told apart by 64-bit hashes.

Defined cases: null text is empty and consists of its end alone. Rows with null doc_id are never learned
from and count as not held out. Repeated rows count as often as they occur and are scored each on
its own. With nothing to learn from, the base score is 0 per token and the model is uniform over
symbols. Ties in frequency are cut together, so they need no order. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sublens.llm.batches import SPACES, Words, mapped, mixed, slices
from sublens.llm.scratch import written

TOP, BINS = 511, 256
SYMBOLS = TOP + 1 + BINS
END = TOP
CLASSES = 24
MEMBERS = SYMBOLS // CLASSES
# Symbols of contexts: the most frequent words, the end, and bins again.
NEAR, NEAR_BINS = 63, 64
CONTEXT = NEAR + 1 + NEAR_BINS
ROWS = 4096
HEAD = 1 << 18
HELD = 1_000_000
PARTS, ROUNDS, STEPS, RATE = 6, 5, 8, 0.2
# Weight of a Gaussian prior around the start: contexts with few events stay close to plain frequencies.
PRIOR = 2.0


def endings(words: Words) -> np.ndarray:
    """Hash of the last three bytes of each word."""
    code = np.zeros(len(words.start), np.uint64)
    for back in range(1, 4):
        at = words.end - back
        code = code * np.uint64(257) + np.where(at >= words.start, words.data[np.maximum(at, 0)], 0).astype(np.uint64)
    return mixed(code + np.uint64(1))


class Merged:
    """Sums by key, held in a task and handed out when there are many."""

    def __init__(self, columns: int):
        self.keys, self.sums = np.zeros(0, np.int64), np.zeros((0, columns), np.int64)

    def add(self, keys: np.ndarray, sums: np.ndarray) -> None:
        self.keys, at = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        values = np.concatenate([self.sums, sums])
        self.sums = np.stack(
            [np.bincount(at, values[:, j], len(self.keys)) for j in range(values.shape[1])], 1
        ).astype(np.int64)

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        out = self.keys, self.sums
        self.__init__(self.sums.shape[1])
        return out


def word_counts(docs: DataFrame) -> DataFrame:
    """h, c, n: per word its count in rows with ``learn``, and in all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Merged(2)

        def out() -> pa.RecordBatch:
            keys, sums = held.taken()
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["h", "c", "n"])

        for batch in batches:
            for part in slices(batch, 1):
                words = Words(part.column(1), SPACES)
                learn = np.repeat(np.array(part.column(0).to_pylist(), bool), words.counts)
                keys, at = np.unique(word_keys(words), return_inverse=True)
                held.add(keys, np.stack([np.bincount(at, learn, len(keys)), np.bincount(at, None, len(keys))], 1).astype(np.int64))
                if len(held.keys) > HELD:
                    yield out()
        yield out()

    rows = docs.select("learn", "text").mapInArrow(run, "h bigint, c bigint, n bigint")
    return rows.groupBy("h").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def word_keys(words: Words) -> np.ndarray:
    """64-bit word hash whose low bits are the bin of the word's ending."""
    low = np.uint64(BINS - 1)
    return ((words.hashes() & ~low) | (endings(words) & low)).view(np.int64)


def bin_of(keys):
    return keys & (BINS - 1)


class Lexicon:
    """What scoring needs of the counts: the head by key, the order of symbols, sizes of bins."""

    def __init__(self, keys: np.ndarray, c: np.ndarray, tokens: int, kinds: int, bin_size: np.ndarray):
        order = np.lexsort((keys, -c))
        symbol = np.full(len(keys), -1, np.int32)
        symbol[order[:TOP]] = np.arange(min(TOP, len(keys)))
        by_key = np.argsort(keys)
        self.keys, self.c, self.symbol = keys[by_key], c[by_key], symbol[by_key]
        self.tokens, self.kinds = tokens, kinds
        # train tokens and kinds of the bin's words that are no symbols, and one for the unknown
        self.bin_size = bin_size

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key in the head (0 where none), and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def symbols(self, keys: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return TOP + 1 + bin_of(keys)
        own = self.symbol[at]
        return np.where(there & (own >= 0), own, TOP + 1 + bin_of(keys))


def near_symbols(symbols: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return np.where(symbols < NEAR, symbols, NEAR + 1 + (keys & (NEAR_BINS - 1)))


def events(words: Words, lexicon: Lexicon) -> tuple[np.ndarray, ...]:
    """All tokens of a slice, ends included: context number and symbol, then place of each end, and the
    words' keys, places in the head and whether they are there."""
    keys = word_keys(words)
    at, there = lexicon.find(keys)
    symbols = lexicon.symbols(keys, at, there)
    ends = words.first[1:] + np.arange(len(words.counts))
    token, near = (np.zeros(len(keys) + len(ends), np.int64) for _ in range(2))
    is_word = np.ones(len(token), bool)
    is_word[ends] = False
    token[is_word], token[ends] = symbols, END
    near[is_word], near[ends] = near_symbols(symbols, keys), NEAR
    # before the first word of a text stand two ends
    one, two = np.append(NEAR, near[:-1]), np.append([NEAR, NEAR], near[:-2])[: len(near)]
    starts = np.append(0, ends[:-1] + 1)
    two[starts] = NEAR
    second = starts + 1
    two[second[second < len(two)]] = NEAR
    return one * CONTEXT + two, token, ends, keys, at, there


def event_counts(docs: DataFrame, shared) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Merged(1)

        def out() -> pa.RecordBatch:
            keys, sums = held.taken()
            return pa.RecordBatch.from_arrays(
                [pa.array((keys // SYMBOLS).astype(np.int32)), pa.array((keys % SYMBOLS).astype(np.int32)), pa.array(sums[:, 0])],
                ["context", "symbol", "n"],
            )

        for batch in batches:
            for part in slices(batch, 0):
                context, token, *_ = events(Words(part.column(0), SPACES), shared.value)
                keys, n = np.unique(context * SYMBOLS + token, return_counts=True)
                held.add(keys, n[:, None])
                if len(held.keys) > HELD:
                    yield out()
        yield out()

    rows = docs.filter("learn").select("text").mapInArrow(run, "context int, symbol int, n bigint")
    return rows.groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def feature_rows(contexts: np.ndarray) -> np.ndarray:
    """Weight rows of each context: bias, bigram, skip, trigram."""
    one, two = np.divmod(contexts.astype(np.uint64), np.uint64(CONTEXT))
    kinds = [one * np.uint64(0), one, two, one * np.uint64(CONTEXT) + two]
    return np.stack([(mixed(x * np.uint64(4) + np.uint64(k)) % np.uint64(ROWS)).astype(np.int64) for k, x in enumerate(kinds)], 1)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def probabilities(weights: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(class) and P(symbol in class) for each context."""
    z = weights[feature_rows(contexts)].sum(1)
    return _softmax(z[:, :CLASSES]), _softmax(z[:, CLASSES:].reshape(len(z), CLASSES, MEMBERS))


def start_weights(symbol_counts: np.ndarray) -> np.ndarray:
    """All zero but for the bias row, which gives each symbol its add-one frequency."""
    weights = np.zeros((ROWS, CLASSES + SYMBOLS), np.float32)
    grouped = (symbol_counts + 1.0).reshape(CLASSES, MEMBERS)
    bias = feature_rows(np.zeros(1, np.int64))[0, 0]
    weights[bias, :CLASSES] = np.log(grouped.sum(1) / grouped.sum())
    weights[bias, CLASSES:] = np.log(grouped / grouped.sum(1, keepdims=True)).ravel()
    return weights


def gradient_steps(
    weights: np.ndarray, squares: np.ndarray, start: np.ndarray, contexts: np.ndarray, counts: np.ndarray, steps: int
) -> None:
    """Ascend the posterior of counts[context, symbol] in place, a rate per weight."""
    rows = feature_rows(contexts)
    orders = [np.argsort(rows[:, k], kind="stable") for k in range(rows.shape[1])]
    cuts = [np.flatnonzero(np.diff(rows[o, k], prepend=-1)) for k, o in enumerate(orders)]
    grouped = counts.reshape(len(contexts), CLASSES, MEMBERS)
    per_class = grouped.sum(2)
    total = per_class.sum()
    for _ in range(steps):
        p, q = probabilities(weights, contexts)
        up = np.concatenate(
            [per_class - per_class.sum(1, keepdims=True) * p, (grouped - per_class[:, :, None] * q).reshape(len(contexts), -1)], 1
        ) / total
        for k, (order, cut) in enumerate(zip(orders, cuts)):
            at = rows[order[cut], k]
            g = np.add.reduceat(up[order], cut) - PRIOR / total * (weights[at] - start[at])
            squares[at] += g * g
            weights[at] += RATE * g / np.sqrt(squares[at] + 1e-12)


def _round(shared):
    def run(table: pa.Table) -> pa.Table:
        given, squares, totals = shared.value
        start, weights, squares = start_weights(totals), given.copy(), squares.copy()
        contexts, at = np.unique(table["context"].to_numpy(), return_inverse=True)
        counts = np.zeros((len(contexts), SYMBOLS), np.float32)
        np.add.at(counts, (at, table["symbol"].to_numpy()), table["n"].to_numpy())
        gradient_steps(weights, squares, start, contexts, counts, STEPS)
        seen = np.zeros(ROWS)
        np.add.at(seen, feature_rows(contexts), counts.sum(1)[:, None])
        pack = lambda x, kind: pa.array([x.astype(kind).tobytes()], pa.binary())
        return pa.table(
            {
                "part": pa.array([table["part"][0].as_py()], pa.int32()),
                "seen": pack(seen, np.float32),
                # half precision: changes of all tasks may reach the driver together
                "change": pack(weights - given, np.float16),
            }
        )

    return run


def trained(counts: DataFrame) -> np.ndarray:
    """Weights [ROWS, CLASSES + SYMBOLS] from stored event counts."""
    spark = counts.sparkSession
    width = CLASSES + SYMBOLS
    totals = np.zeros(SYMBOLS)
    for row in counts.groupBy("symbol").agg(F.sum("n").alias("n")).collect():
        totals[row["symbol"]] = row["n"]
    weights, squares = start_weights(totals), np.zeros((ROWS, width), np.float32)
    dealt = written(
        counts.withColumn("part", F.pmod(F.xxhash64("context"), F.lit(PARTS)).cast("int")), "maxent-parts"
    )
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast((weights, squares, totals))
        seen, change = np.zeros(ROWS), np.zeros((ROWS, width), np.float32)
        # PARTS rows of fixed size, one at a time
        results = dealt.groupBy("part").applyInArrow(
            _round(shared), "part int, seen binary, change binary"
        )
        for row in results.toLocalIterator():
            share = np.frombuffer(row["seen"], np.float32)
            seen += share
            change += share[:, None] * np.frombuffer(row["change"], np.float16).reshape(ROWS, width)
        change *= (1 / np.maximum(seen, 1)).astype(np.float32)[:, None]
        # rates fall with the distance a weight has gone
        weights, squares = weights + change, squares + (1e-3 * change) ** 2
        # all results are in; the driver lets go of its copy as well
        shared.destroy()
    return weights


PARTIAL = {
    "n_tokens": T.LongType(),
    "known": T.LongType(),
    "base": T.DoubleType(),
    "model": T.DoubleType(),
    "rare": T.ArrayType(T.LongType()),
    "times": T.ArrayType(T.IntegerType()),
}


def _scorer(lexicon: Lexicon, weights: np.ndarray, ends_known: int):
    table = np.zeros((CONTEXT * CONTEXT, SYMBOLS), np.float32)
    filled = np.zeros(CONTEXT * CONTEXT, bool)
    log_count = np.log10(lexicon.c + 1.0)
    log_bin = np.log10(lexicon.bin_size)
    unit = np.log10(lexicon.tokens + lexicon.kinds + 1.0)

    def run(texts: pa.Array) -> list:
        words = Words(texts, SPACES)
        context, token, ends, keys, at, there = events(words, lexicon)
        new = np.unique(context[~filled[context]])
        for a in range(0, len(new), 512):
            own = new[a : a + 512]
            p, q = probabilities(weights, own)
            table[own] = np.log10(np.maximum(p[:, :, None] * q, 1e-30)).reshape(len(own), -1)
            filled[own] = True
        owner = np.repeat(np.arange(len(texts)), words.counts)
        token_owner = np.repeat(np.arange(len(texts)), words.counts + 1)
        n = len(texts)
        model = np.bincount(token_owner, table[context, token], n)
        in_bin = token[np.delete(np.arange(len(token)), ends)] > END
        counted = np.where(there, log_count[at] if len(log_count) else 0.0, 0.0)
        model += np.bincount(owner, in_bin * (counted - log_bin[bin_of(keys)]), n)
        n_tokens = words.counts + 1
        base = np.bincount(owner, counted, n) + np.log10(ends_known + 1.0) - n_tokens * unit
        known = np.bincount(owner, there & ((lexicon.c[at] if len(log_count) else 0) > 0), n).astype(np.int64) + (ends_known > 0)
        lists, times = [], []
        rare = np.flatnonzero(~there)
        cuts = np.searchsorted(owner[rare], np.arange(n + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            found, often = np.unique(keys[rare[a:b]], return_counts=True)
            lists.append(found)
            times.append(often)
        return [n_tokens, known, base, model, pa.array(lists, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))]

    return run


def lexicon_of(vocabulary: DataFrame, train_texts: int) -> tuple[Lexicon, Column]:
    """The head, and the condition on c that tells its words from rare ones.

    Both go by the training counts alone; a word that is not in them is never in the head.
    """
    level = F.when(F.col("c") > 0, F.floor(8 * F.log2("c")).cast("int")).otherwise(-1)
    # counts per level of frequency: some hundred rows
    levels = vocabulary.where("c > 0").groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("level")).collect()
    taken, least = 0, 2**31 - 1
    for row in levels:
        taken += row["words"]
        if taken > HEAD:
            break
        least = row["level"]
    head = vocabulary.filter(level >= least).select("h", "c").toArrow()
    keys, c = (head[x].to_numpy() for x in ("h", "c"))
    totals = vocabulary.agg(F.sum("c").alias("c"), F.sum((F.col("c") > 0).cast("long")).alias("kinds")).first()
    size = np.ones(BINS)
    for row in (
        vocabulary.groupBy(F.col("h").bitwiseAND(BINS - 1).alias("bin")).agg(F.sum(F.col("c") + (F.col("c") > 0).cast("long")).alias("size")).collect()
    ):
        size[row["bin"]] += row["size"]
    lexicon = Lexicon(keys, c, (totals["c"] or 0) + train_texts, (totals["kinds"] or 0) + (train_texts > 0), size)
    own = lexicon.symbol >= 0
    np.subtract.at(lexicon.bin_size, bin_of(lexicon.keys[own]), lexicon.c[own] + (lexicon.c[own] > 0))
    return lexicon, level >= least


def language_model_scores(docs: DataFrame, learn: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row; log10 throughout."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    train_texts = rows.filter("learn").count()
    vocabulary = written(word_counts(rows), "maxent-words")
    lexicon, in_head = lexicon_of(vocabulary, train_texts)
    shared = spark.sparkContext.broadcast(lexicon)
    weights = trained(written(event_counts(rows, shared), "maxent-events"))
    shared_weights = spark.sparkContext.broadcast(weights)
    partial = written(
        mapped(rows, PARTIAL, lambda: _scorer(shared.value, shared_weights.value, train_texts), ["doc_id"]).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "maxent-partial",
    )
    rare = partial.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("h"), "x.times")
    tail = (
        rare.join(vocabulary.filter(~in_head).select("h", "c"), "h")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("rare_log"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    none = F.lit(0)
    return partial.drop("rare", "times").join(tail, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", none)).alias("n_known"),
        F.lit(lexicon.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_log", none)).alias("base_score"),
        (F.col("model") + F.coalesce("rare_log", none)).alias("score"),
    )


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2


def digest(docs: DataFrame) -> DataFrame:
    return language_model_scores(docs.select("doc_id", "text"), ~held_out()).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
