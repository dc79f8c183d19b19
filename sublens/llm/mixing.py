"""Mixing sources to target weights: exact quotas per source, split among output shards by a hypergeometric tree.

Sources weigh 1, 2, 3 in turn and share all words by weight; a share above three times the source's size is
cut there and the rest shared anew, until none is above. In each source the documents stand in an order
drawn by a seeded digest of their id and size. The mix takes the first ``quota`` words of that order,
starting over at its end, so a source gets its target to the word and no document more than three
times its size.

* **Splitting tree.** The words a source gives are cut into blocks. The root holds every source's number of
  blocks; each node deals its blocks to the two halves of its shards by a multivariate hypergeometric draw,
  which is what cutting a shuffled deck of all blocks in two would give, without the deck. Quotas stay exact
  at every node. A leaf takes the next blocks of each source's permuted block numbers, so the shards'
  blocks are disjoint and cover the quota. Inside a shard a digest orders the pieces.
* **No sort of a whole source.** A document's place is its bucket's offset plus the running size inside the
  bucket. Buckets are ranges of the digest, about as many as a bucket has documents, so both windows hold
  about the square root of the source's rows, also for a source with most of the corpus.
* Text is read once, to count words and to take a digest. Only ids and numbers are shuffled, by
  (source, bucket) and by (source, block), both of even size.

Everything is expressed in DataFrame and SQL functions.

Defined cases: null text and blank text have size 0 and are never taken. A null source is a source of its
own, the last one. A null id is an id like any other. Rows that agree in id, source, text and size stand
side by side as one slot and share what it is taken evenly, the first ones a word more; with another text
each has its own place. A very long document spans many blocks. With no words at all every target is 0;
an empty table gives an empty result. Columns are taken by name, so extra ones do not matter. The number of
sources is taken to be small enough for one row of an array each; the largest count of blocks is
``MOST_BLOCKS`` (blocks grow beyond it). Targets and quotas are exact up to 2**53 words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sublens.llm.scratch import written

SEED = "mix"
CAP = 3
WEIGHTS = 3
BLOCK_WORDS = 4096
SHARD_WORDS = 1 << 22
MOST_BLOCKS = 1 << 29
KEY_BITS = 60
# Levels of the tree between two dealings of its nodes over the tasks.
LEVELS_A_STAGE = 8
# Primes above MOST_BLOCKS, as multipliers that have no factor in common with a block count.
PRIMES = (1073741827, 1073741831, 1073741833, 1073741839)
# ln(n!) for n < 16; beyond, Stirling's series is exact to 12 digits.
_LN_FACTORIALS = [math.lgamma(n + 1) for n in range(16)]


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, text_key of every row."""
    text = F.coalesce(docs["text"], F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    return docs.select(
        docs["doc_id"],
        docs["source"],
        F.size(words).cast("bigint").alias("size"),
        F.xxhash64(text).alias("text_key"),
    )


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: source_rank, slots (documents), source_size, target and quota (whole words)."""
    summed = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("slots"))
    ranked = summed.withColumn("source_rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    ranked = ranked.withColumn("weight", ((F.col("source_rank") - 1) % WEIGHTS + 1).cast("bigint"))
    # Sources fill up in the order of size by weight; those that stop at the cap come first.
    room = F.col("source_size") * CAP
    filling = Window.orderBy(F.expr("source_size * 6 div weight"), "source_rank")
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    steps = ranked.withColumns(
        {
            "words": F.sum("source_size").over(everything),
            "full": F.coalesce(
                F.sum(room).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")
            ),
            "open_weight": F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    exact = "decimal(38,0)"
    capped = (F.col("words") - F.col("full")).cast(exact) * F.col("weight") > room.cast(exact) * F.col("open_weight")
    marked = steps.withColumn("capped", capped)
    rest = F.col("words") - F.sum(F.when(F.col("capped"), room).otherwise(0)).over(everything)
    shares = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    given = marked.withColumns({"rest": rest, "shares": F.greatest(shares, F.lit(1).cast("bigint"))})
    part = F.col("rest") * F.col("weight")
    return given.select(
        "source",
        "source_rank",
        "slots",
        "source_size",
        F.when(F.col("capped"), room.cast("double")).otherwise(part.cast("double") / F.col("shares")).alias("target"),
        F.when(F.col("capped"), room).otherwise(F.expr("(2 * rest * weight + shares) div (2 * shares)")).alias("quota"),
    )


def blocked(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``targets`` with the size of a block and the number of blocks that a source gives."""
    whole = F.sum("quota").over(Window.partitionBy())
    most = F.ceil(whole / F.lit(MOST_BLOCKS)).cast("bigint")
    return targets.withColumn("block_words", F.greatest(F.lit(block_words).cast("bigint"), most)).withColumn(
        "blocks", F.expr("(quota + block_words - 1) div block_words")
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, also inside a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def _ln_factorial(n: Column) -> Column:
    def stirling(x: Column) -> Column:
        return (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + (
            1 / 12 - (1 / 360 - 1 / (1260 * x * x)) / (x * x)
        ) / x

    exact = F.get(F.array(*[F.lit(v) for v in _LN_FACTORIALS]), n.cast("int"))
    return F.when(n < len(_LN_FACTORIALS), exact).otherwise(_let(n.cast("double"), stirling))


def _ln_choose(n: Column, k: Column) -> Column:
    return _ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k)


def hypergeometric(whole: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``whole`` are among its ``marked``, by inversion at ``u`` in [0, 1).

    The sum starts ten standard deviations below the mean, where less than 1e-20 of the mass lies, and
    ends as far above it. A result is always possible: between drawn + marked - whole and both of them.
    """
    share = marked.cast("double") / F.greatest(whole, F.lit(1))
    left = (whole - drawn).cast("double") / F.greatest(whole - 1, F.lit(1))
    bounds = F.struct(
        F.greatest(F.lit(0).cast("bigint"), drawn + marked - whole).alias("low"),
        F.least(drawn, marked).alias("high"),
        F.floor(drawn * share).alias("mean"),
        (F.ceil(10 * F.sqrt(F.greatest(drawn * share * (1 - share) * left, F.lit(0.0)))).cast("bigint") + 2).alias("reach"),
    )

    def ends(b: Column) -> Column:
        return F.struct(
            F.greatest(b["low"], b["mean"] - b["reach"]).alias("first"),
            F.least(b["high"], b["mean"] + b["reach"]).alias("last"),
        )

    def walked(e: Column) -> Column:
        first, last = e["first"], e["last"]
        chance = F.exp(
            _ln_choose(marked, first) + _ln_choose(whole - marked, drawn - first) - _ln_choose(whole, drawn)
        )
        start = F.struct(chance.alias("p"), F.lit(0.0).alias("sum"), F.lit(None).cast("bigint").alias("x"))

        def step(state: Column, k: Column) -> Column:
            up = (marked - k).cast("double") * (drawn - k) / ((k + 1).cast("double") * (whole - marked - drawn + k + 1))
            return F.struct(
                (state["p"] * up).alias("p"),
                (state["sum"] + state["p"]).alias("sum"),
                F.coalesce(state["x"], F.when(state["sum"] + state["p"] > u, k)).alias("x"),
            )

        return F.when(first == last, first).otherwise(
            F.coalesce(F.aggregate(F.sequence(first, last), start, step, lambda state: state["x"]), last)
        )

    return _let(_let(bounds, ends), walked)


def _left_quotas(seed: str) -> Column:
    """The left half's blocks per source, when it takes ``left_blocks`` of the node's ``blocks``."""

    def deal(state: Column, item: Column) -> Column:
        u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "low", "high", item["rank"]), 11) / F.lit(float(1 << 53))
        x = hypergeometric(state["whole"], item["n"], state["drawn"], u)
        return F.struct(
            (state["whole"] - item["n"]).alias("whole"),
            (state["drawn"] - x).alias("drawn"),
            F.concat(state["quotas"], F.array(F.struct(item["rank"].alias("rank"), x.alias("n")))).alias("quotas"),
        )

    none = F.array().cast("array<struct<rank:int,n:bigint>>")
    start = F.struct(F.col("blocks").alias("whole"), F.col("left_blocks").alias("drawn"), none.alias("quotas"))
    return F.aggregate("quotas", start, deal, lambda state: state["quotas"])


def splitting_tree(sources: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """shard, source_rank, n: each shard's number of blocks of each source. Shards differ by one block at most.

    ``sources`` holds source_rank and blocks. A node is one row: its shards low to high, and a quota per source.
    """
    root = sources.agg(
        F.sort_array(
            F.collect_list(F.struct(F.col("source_rank").cast("int").alias("rank"), F.col("blocks").alias("n")))
        ).alias("quotas"),
        F.sum("blocks").alias("blocks"),
    ).where(F.col("blocks") > 0)
    all_blocks = F.col("all_blocks")
    nodes = root.select(
        F.lit(0).cast("bigint").alias("low"),
        F.lit(shards).cast("bigint").alias("high"),
        F.col("blocks").alias("all_blocks"),
        "blocks",
        "quotas",
    )
    # Blocks of the shards before a shard, so that all shards are within one block of each other.
    before = lambda shard: F.floor(all_blocks * shard / F.lit(shards))
    for level in range(max(shards - 1, 0).bit_length()):
        if level and level % LEVELS_A_STAGE == 0:
            nodes = nodes.repartition("low")
        middle = F.expr("(low + high) div 2")
        cut = nodes.withColumn("middle", middle).withColumn("left_blocks", before(F.col("middle")) - before(F.col("low")))
        cut = cut.withColumn(
            "left_quotas", F.when(F.col("high") - F.col("low") > 1, _left_quotas(seed)).otherwise(F.col("quotas"))
        )
        right = F.zip_with(
            "quotas", "left_quotas", lambda a, b: F.struct(a["rank"].alias("rank"), (a["n"] - b["n"]).alias("n"))
        )

        def half(low, high, blocks, quotas):
            return F.struct(low.alias("low"), high.alias("high"), blocks.alias("blocks"), quotas.alias("quotas"))

        halves = F.array(
            half(F.col("low"), F.col("middle"), F.col("left_blocks"), F.col("left_quotas")),
            half(F.col("middle"), F.col("high"), F.col("blocks") - F.col("left_blocks"), right),
        )
        kept = F.array(half(F.col("low"), F.col("high"), F.col("blocks"), F.col("quotas")))
        nodes = cut.select(
            "all_blocks", F.inline(F.when(F.col("high") - F.col("low") > 1, halves).otherwise(kept))
        )
    return nodes.select(F.col("low").alias("shard"), F.inline("quotas")).select(
        "shard", F.col("rank").alias("source_rank"), "n"
    )


def drawn_blocks(sources: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """source_rank, block, shard: every block of every quota, in one shard."""
    leaves = splitting_tree(sources, shards, seed).where(F.col("n") > 0)
    before = Window.partitionBy("source_rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranges = leaves.withColumn("from", F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")))
    dealt = ranges.join(sources.select("source_rank", "blocks"), "source_rank")
    pick = F.xxhash64(F.lit(seed), "source_rank")
    prime = F.get(F.array(*[F.lit(p).cast("bigint") for p in PRIMES]), F.pmod(pick, F.lit(len(PRIMES))).cast("int"))
    shift = F.pmod(F.xxhash64(F.lit(seed), pick), F.col("blocks"))
    numbered = dealt.withColumn("i", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("n") - 1)))
    return numbered.select(
        "source_rank", ((F.col("i") * (prime % F.col("blocks")) + shift) % F.col("blocks")).alias("block"), "shard"
    )


def slots(sized: DataFrame, sources: DataFrame, seed: str = SEED) -> DataFrame:
    """Each document's place in its source's drawn order: words start to start + times * size.

    ``times`` counts rows that agree in everything; they share a slot.
    """
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size"))
    key = F.conv(F.substring(F.md5(name), 1, KEY_BITS // 4), 16, 10).cast("bigint")
    grouped = sized.groupBy("doc_id", "source", "size", "text_key").agg(F.count(F.lit(1)).alias("times"))
    known = grouped.join(sources, grouped["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    bits = F.floor(F.length(F.bin("slots")) / 2).cast("int")
    placed = known.withColumn("key", key).withColumn(
        "bucket", F.call_function("shiftright", F.col("key"), F.lit(KEY_BITS) - bits)
    )
    where = ["source_rank", "bucket"]
    before = Window.partitionBy("source_rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*where)
        .agg(F.sum(F.col("times") * F.col("size")).alias("held"))
        .select(*where, F.coalesce(F.sum("held").over(before), F.lit(0).cast("bigint")).alias("offset"))
    )
    inside = (
        Window.partitionBy(*where)
        .orderBy("key", F.asc_nulls_last("doc_id"), "size", "text_key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = F.coalesce(F.sum(F.col("times") * F.col("size")).over(inside), F.lit(0).cast("bigint"))
    return (
        placed.withColumn("ahead", ahead)
        .join(offsets, where)
        .withColumn("start", F.col("offset") + F.col("ahead"))
        .drop("key", "bucket", "offset", "ahead")
    )


def pieces(placed: DataFrame) -> DataFrame:
    """The parts of the slots that the quota covers, one row per slot, pass and block.

    ``from_word`` and ``to_word`` count inside the slot, to_word exclusive.
    """
    passes = placed.where(F.col("size") > 0).withColumn(
        "pass", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(CAP - 1).cast("bigint")))
    )
    first = F.col("pass") * F.col("source_size") + F.col("start")
    cut = passes.withColumns(
        {"first": first, "end": F.least(F.col("quota"), first + F.col("times") * F.col("size"))}
    ).where(F.col("first") < F.col("end"))
    spread = cut.withColumn(
        "block",
        F.explode(F.sequence(F.expr("first div block_words"), F.expr("(end - 1) div block_words"))),
    )
    opens, closes = F.col("block") * F.col("block_words"), (F.col("block") + 1) * F.col("block_words")
    return spread.withColumns(
        {
            "from_word": F.greatest(F.col("first"), opens) - F.col("first"),
            "to_word": F.least(F.col("end"), closes) - F.col("first"),
        }
    ).drop("first", "end")


def plan(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """Stored sources with quotas and blocks, and stored sizes of the documents."""
    sized = written(sizes(docs), "mix-sizes")
    return written(blocked(source_targets(sized), block_words), "mix-sources"), sized


def shard_count(sources: DataFrame, shard_words: int = SHARD_WORDS) -> int:
    words = sources.agg(F.sum("quota")).first()[0] or 0
    return max(1, -(-words // shard_words))


def mixed(
    sources: DataFrame, placed: DataFrame, shards: int, seed: str = SEED
) -> DataFrame:
    """The mix: shard, order, doc_id, source, text_key, size, times, pass, block, from_word, to_word.

    Rows of a shard in ``order`` are its text; ``texts`` gives the words themselves.
    """
    order = F.xxhash64(F.lit(seed), "shard", "source_rank", "block", "doc_id", "text_key", "pass", "from_word")
    return (
        pieces(placed)
        .join(drawn_blocks(sources, shards, seed), ["source_rank", "block"])
        .withColumn("order", order)
        .select(
            "shard", "order", "doc_id", "source", "text_key", "size", "times", "pass", "block", "from_word", "to_word"
        )
    )


def texts(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """shard, order, text: the words of the mix, shuffled inside each shard. One row per piece and copy."""
    text = F.coalesce(docs["text"], F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    named = docs.select(docs["doc_id"], docs["source"], F.xxhash64(text).alias("text_key"), words.alias("words"))
    named = named.dropDuplicates(["doc_id", "source", "text_key"])
    copies = mix.withColumn(
        "copy", F.explode(F.sequence(F.expr("from_word div size"), F.expr("(to_word - 1) div size")))
    )
    begin = F.greatest(F.col("from_word") - F.col("copy") * F.col("size"), F.lit(0).cast("bigint"))
    end = F.least(F.col("to_word") - F.col("copy") * F.col("size"), F.col("size"))
    cut = copies.withColumns({"begin": begin, "n": end - begin}).alias("m")
    same = (
        F.col("m.doc_id").eqNullSafe(F.col("d.doc_id"))
        & F.col("m.source").eqNullSafe(F.col("d.source"))
        & (F.col("m.text_key") == F.col("d.text_key"))
    )
    joined = cut.join(named.alias("d"), same)
    sliced = F.slice("words", F.col("begin").cast("int") + 1, F.col("n").cast("int"))
    return (
        joined.select("shard", "order", "copy", F.array_join(sliced, " ").alias("text"))
        .repartition("shard")
        .sortWithinPartitions("shard", "order", "copy")
        .select("shard", "order", "text")
    )


def digest(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    sources, sized = plan(docs, block_words)
    placed = written(slots(sized, sources), "mix-slots")
    mix = mixed(sources, placed, shard_count(sources, shard_words))
    slot = ["doc_id", "source", "text_key", "size"]
    taken = mix.groupBy(*slot).agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    p, t = placed.alias("p"), taken.alias("t")
    same = F.col(f"p.{slot[0]}").eqNullSafe(F.col(f"t.{slot[0]}"))
    for name in slot[1:]:
        same = same & F.col(f"p.{name}").eqNullSafe(F.col(f"t.{name}"))
    shared = p.join(t, same, "left").select(
        "p.doc_id", "p.size", "p.source_size", "p.target", "p.times", F.coalesce("t.taken", F.lit(0)).alias("taken")
    )
    # Rows of one slot, in two steps so that no array grows with a hot group.
    step = 4096
    ranges = shared.withColumn(
        "range", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(times - 1) div {step}")))
    )
    copies = ranges.withColumn(
        "copy",
        F.explode(
            F.sequence(
                F.col("range") * step, F.least(F.col("times"), (F.col("range") + 1) * step) - 1
            )
        ),
    )
    more = F.when(F.col("copy") < F.col("taken") % F.col("times"), 1).otherwise(0)
    return copies.select(
        "doc_id", "size", "source_size", "target", (F.expr("taken div times") + more).cast("bigint").alias("taken")
    )


# The order and the quotas are the same in both engines; which shard a block goes to does not show here.
ORACLE_SQL = r"""
with sized as (
  select doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    row_number() over () as id
  from documents),
sums as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
ranked as (
  select *, row_number() over (order by source nulls last) as place from sums),
weighted as (select *, (place - 1) % 3 + 1 as weight from ranked),
filled as (
  select *, source_size * 6 // weight as filling, sum(source_size) over () as words from weighted),
stops as (
  select *, (words - coalesce(sum(3 * source_size) over (order by filling, place rows between unbounded preceding
        and 1 preceding), 0)) * weight
      > 3 * source_size * sum(weight) over (order by filling, place rows between current row and unbounded following)
      as capped
  from filled),
rest as (
  select sum(source_size) - coalesce(sum(3 * source_size) filter (capped), 0) as words,
    coalesce(sum(weight) filter (not capped), 1) as shares
  from stops),
targets as (
  select f.source, f.source_size, case when capped then cast(3 * f.source_size as double)
      else cast(r.words * f.weight as double) / r.shares end as target,
    cast(case when capped then 3 * f.source_size
      else (2 * r.words * f.weight + r.shares) // (2 * r.shares) end as bigint) as quota
  from stops as f, rest as r),
placed as (
  select d.doc_id, d.size, t.source_size, t.target, t.quota,
    coalesce(sum(d.size) over (partition by d.source
      order by substr(md5('mix:' || coalesce(cast(d.doc_id as varchar), '') || ':' || d.size), 1, 15), d.doc_id, d.size, d.id
      rows between unbounded preceding and 1 preceding), 0) as start
  from sized as d join targets as t on t.source is not distinct from d.source)
select doc_id, size, source_size, target,
  cast(case when source_size = 0 then 0 else quota // source_size * size
    + greatest(0, least(size, quota % source_size - start)) end as bigint) as taken
from placed
"""
