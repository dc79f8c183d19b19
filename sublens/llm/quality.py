"""Quality rules: fixed floors, and robust multivariate outliers per language and source.

Every document gets a vector of transformed statistics. For each (lang, source) the
minimum-covariance-determinant estimate of centre and scatter is found by concentration steps: from a
coordinatewise robust start, keep the share ``core`` of the rows with the smallest Mahalanobis
distance, estimate anew from them, repeat. A document whose distance from its group's final estimate
exceeds ``cutoff`` is rejected.

The statistics are whole numbers (``SCALE`` steps to a unit), so sums of them and of their products are
exact and a rerun after a lost executor gives the same estimate. A step costs one aggregation: rows
are summed per group and distance bin (pre-aggregated in the map tasks, so a hot source is no hot
task), and a running sum over the bins picks the core. Text is read once; steps read only the stored
statistics. Estimates stay in stored tables, one row per group; nothing goes through the driver.

Defined cases: null text has no words and fails the floor. Null lang or source is a value like any
other. A group with fewer than ``min_rows`` documents is pooled with the other small sources of its
language, then with all small rest groups; if even these are fewer, the estimate over all documents of
the language judges them, then that over all documents. Only a table with fewer than ``min_rows`` in all
is kept without a verdict. Statistics that do not vary get the variance ``floor``. Repeated rows are judged alike, each on
its own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sublens.llm.scratch import written

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STATISTICS = ("word_length", "symbol_share", "dup_line_share", "repeat_share")
P = len(STATISTICS)
SCALE = 256
# Per unit of variance; keeps a statistic that is constant in the core from rejecting small changes.
FLOOR = 0.25
# The standard deviation that repetition has at least, as a share of the lines or words, and the lines
# and words added below: a single header line repeated in a short clean text is little evidence.
LINE_SPREAD, LINE_PRIOR = 0.04, 8
WORD_SPREAD, WORD_PRIOR = 0.05, 50
CORE = 0.75
# Square of the robust distance: the chi-square quantile of 1 - 1e-6 for four statistics.
CUTOFF = 33.4
MIN_ROWS = 200
STEPS = 4
BINS = 32


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (long)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    full_lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    compact = F.translate(text, SPACES, "")
    base = docs.select(
        *docs.columns,
        words.alias("w_"),
        full_lines.alias("lines_"),
        F.char_length(compact).cast("bigint").alias("word_chars"),
        (F.char_length(compact) - F.char_length(F.translate(compact, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    ).withColumn("n_words", F.size("w_").cast("bigint"))
    # A window is its hash with the low bits, as many as positions need, replaced by its position:
    # sorting plain longs then puts equal windows side by side.
    bits = F.expr("cast(length(bin(n_words)) as int)")
    window = F.transform(
        F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), F.col("n_words").cast("int") - 3)).otherwise(
            F.array().cast("array<int>")
        ),
        lambda i: F.xxhash64(F.get("w_", i), F.get("w_", i + 1), F.get("w_", i + 2))
        .bitwiseAND(F.col("high_"))
        .bitwiseOR(i.cast("bigint")),
    )
    packed = base.withColumn("high_", F.call_function("shiftleft", F.lit(-1).cast("bigint"), bits)).withColumn(
        "sorted_", F.sort_array(window)
    )
    head = lambda x: x.bitwiseAND(F.col("high_"))
    twice = F.filter(
        "sorted_",
        lambda x, i: F.coalesce(head(x) == head(F.get("sorted_", i + 1)), F.lit(False))
        | F.coalesce((i > 0) & (head(x) == head(F.get("sorted_", i - 1))), F.lit(False)),
    )
    found = packed.withColumn(
        "at_", F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(F.bitwise_not(F.col("high_")))))
    )
    covered = F.aggregate(
        F.transform("at_", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("at_", i + 1) - x, F.lit(3)))),
        F.lit(0).cast("bigint"),
        lambda n, x: n + x,
    )
    return found.select(
        *docs.columns,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("bigint").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("lines_").cast("bigint").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def transformed(stats: DataFrame) -> DataFrame:
    """x1..xP, whole numbers. The symbol share goes through a logarithm that is about linear below 1 %.
    The repetition shares are linear and in units in which FLOOR is the square of their least spread, so
    that either alone can pass the cutoff."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    values = (
        8 * F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        F.log1p(100 * F.col("n_symbols") / words),
        FLOOR**0.5 / LINE_SPREAD * F.col("n_dup_lines") / (F.col("n_lines") + LINE_PRIOR),
        FLOOR**0.5 / WORD_SPREAD * F.col("n_repeat_words") / (F.col("n_words") + WORD_PRIOR),
    )
    return stats.withColumns({f"x{i + 1}": F.round(v * SCALE).cast("bigint") for i, v in enumerate(values)})


X = [f"x{i + 1}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _number(name: str) -> Column:
    return F.col(name).cast("double") / SCALE


def squared_distance() -> Column:
    """Of x from centre m under the Cholesky factor l, by forward substitution."""
    solved: list[Column] = []
    for i in range(P):
        rest = _number(X[i]) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * solved[j]
        solved.append(rest / F.col(f"l{i}{i}"))
    total = solved[0] * solved[0]
    for y in solved[1:]:
        total = total + y * y
    return total


def _factored(moments: DataFrame, keep: list[str]) -> DataFrame:
    """Cholesky factor l of the covariance v, one column after the other."""
    out = moments
    for j in range(P):
        for i in range(j, P):
            rest = F.col(f"v{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # v holds FLOOR on its diagonal, so the pivot is at least that but for rounding
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(FLOOR / 4))) if i == j else rest / F.col(f"l{j}{j}"))
    return out.select(*keep, *[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i, j in PAIRS])


def _start(rows: DataFrame) -> DataFrame:
    """Median and quartile range of each coordinate. The values are few whole numbers, so exact."""
    quartiles = rows.groupBy("pool").agg(
        *[F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i, x in enumerate(X)]
    )
    spread = [(F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / (1.349 * SCALE) for i in range(P)]
    return _factored(
        quartiles.select(
            "pool",
            *[(F.col(f"q{i}")[1] / SCALE).alias(f"m{i}") for i in range(P)],
            *[((spread[i] * spread[i] + FLOOR) if i == j else F.lit(0.0)).alias(f"v{i}{j}") for i, j in PAIRS],
        ),
        ["pool"],
    )


def _concentrated(rows: DataFrame, estimate: DataFrame, core: float, widen: float = 1.0) -> DataFrame:
    """Centre and scatter of the share ``core`` of each pool that lies closest to ``estimate``."""
    binned = rows.join(estimate, "pool").select(
        "pool", *X, F.floor(BINS * F.log2(squared_distance() + 1e-6)).cast("int").alias("bin")
    )
    sums = binned.groupBy("pool", "bin").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(x).alias(f"s{i}") for i, x in enumerate(X)],
        *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"t{i}{j}") for i, j in PAIRS],
    )
    # one row per distance bin: a few hundred for a pool, whatever its size
    pool = Window.partitionBy("pool")
    inner = (
        sums.withColumn("below", F.sum("n").over(pool.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("total", F.sum("n").over(pool))
        .filter(F.coalesce("below", F.lit(0)) < core * F.col("total"))
        .groupBy("pool")
        .agg(*[F.sum(c).alias(c) for c in ["n", *[f"s{i}" for i in range(P)], *[f"t{i}{j}" for i, j in PAIRS]]])
    )
    mean = [F.col(f"s{i}").cast("double") / F.col("n") for i in range(P)]
    return _factored(
        inner.select(
            "pool",
            *[(mean[i] / SCALE).alias(f"m{i}") for i in range(P)],
            *[
                (widen * (F.col(f"t{i}{j}").cast("double") / F.col("n") - mean[i] * mean[j]) / SCALE**2
                 + (FLOOR if i == j else 0.0)).alias(f"v{i}{j}")
                for i, j in PAIRS
            ],
        ),
        ["pool"],
    )


def _label(*names: str) -> Column:
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


ALL = "all"


def _language() -> Column:
    return F.concat(F.lit("all "), _label("lang"))


def pools(rows: DataFrame, min_rows: int) -> DataFrame:
    """lang, source, pool: which estimate serves a language and source; none if the table is too small."""
    sizes = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    langs = sizes.groupBy(F.col("lang").alias("of_lang")).agg(
        F.sum("n").alias("n_lang"), F.sum(F.when(F.col("n") < min_rows, F.col("n"))).alias("n_rest")
    )
    n_last, n_all = langs.agg(
        F.sum(F.when(F.col("n_rest") < min_rows, F.col("n_rest"))), F.sum("n_lang")
    ).first()
    named = sizes.join(langs, F.col("lang").eqNullSafe(F.col("of_lang")))
    return named.select(
        "lang",
        "source",
        F.when(F.col("n") >= min_rows, _label("lang", "source"))
        .when(F.col("n_rest") >= min_rows, _label("lang"))
        .when(F.lit((n_last or 0) >= min_rows), F.lit("rest"))
        .when(F.col("n_lang") >= min_rows, _language())
        .when(F.lit((n_all or 0) >= min_rows), F.lit(ALL))
        .alias("pool"),
    )


def feeding(assigned: DataFrame) -> DataFrame:
    """lang, source, pool: the pools a language and source is estimated in. Besides its own these are, where
    a small rest is served by them, all documents of its language and all documents: three at most."""
    every = F.explode(F.array_distinct(F.array("pool", _language(), F.lit(ALL)))).alias("pool")
    return assigned.select("lang", "source", every).join(assigned.select("pool").distinct(), "pool", "left_semi")


def on_group(left: DataFrame, right: DataFrame) -> Column:
    return left["lang"].eqNullSafe(right["lang"]) & left["source"].eqNullSafe(right["source"])


def outlier_model(stats: DataFrame, core: float = CORE, steps: int = STEPS, min_rows: int = MIN_ROWS) -> DataFrame:
    """lang, source and the final estimate, from stored statistics of documents above the floor."""
    rows = transformed(stats).filter(~base_failed())
    assigned = written(pools(rows, min_rows).filter("pool is not null"), "quality-pools")
    fed = feeding(assigned)
    fit = written(
        rows.join(fed, on_group(rows, fed)).select(fed["pool"], *X), "quality-vectors"
    )
    estimate = written(_start(fit), "quality-start")
    for step in range(steps):
        # the core of a normal sample is narrower than the sample; the last step makes up for it
        widen = CONSISTENCY if step == steps - 1 else 1.0
        estimate = written(_concentrated(fit, estimate, core, widen), f"quality-step-{step}")
    return written(assigned.join(estimate, "pool").drop("pool"), "quality-model")


# Chi-square, P = 4, core 0.75: 0.75 / P(chi2 with 6 degrees <= 5.385), 5.385 being its 0.75 quantile.
CONSISTENCY = 0.75 / 0.5047


def judged(stats: DataFrame, model: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``stats`` with base_failed, distance2 (null without an estimate) and kept."""
    rows = transformed(stats)
    joined = rows.join(model, on_group(rows, model), "left").select(
        *[rows[c] for c in stats.columns], base_failed().alias("base_failed"), squared_distance().alias("distance2")
    )
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance2") <= cutoff, F.lit(True)))


def digest(docs: DataFrame) -> DataFrame:
    stats = written(counted(docs.select("doc_id", "text", "lang", "source")).drop("text"), "quality-stats")
    return judged(stats, outlier_model(stats)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2"
    )


def stage(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows.

    The statistics are counted a second time rather than joined back, so no text is shuffled.
    """
    plain = docs.select(
        *[F.col(c).alias(f"in_{c}") for c in docs.columns if c not in ("text", "lang", "source")], "text", "lang", "source"
    )
    stats = written(counted(docs.select("text", "lang", "source")).drop("text"), "quality-stats")
    # A non-deterministic column, so that the filter is not moved below the counting: there it would be
    # written out in terms of the text, and count anew for every word.
    counts = counted(plain).withColumn("counted_in", F.spark_partition_id())
    kept = judged(counts, outlier_model(stats)).filter("kept and counted_in >= 0")
    return kept.select([F.col(c if c in ("text", "lang", "source") else f"in_{c}").alias(c) for c in docs.columns])
