"""Filter interaction audit: what every filter removes in every order of the filters, per part.

Five filters judge each document once, whatever the order, so a document is a mask of the filters it
fails. Documents are summed to mask cells, at most 32 for a part. A recursive query then starts from the
empty prefix, joins the masks that occur and extends each prefix by every unused letter, carrying the bits
that were applied before; a level of the recursion says for each mask what that step does with it. The cells
meet those verdicts by their mask and give the step's counts.

* Text is read once. Only ids, digests and flags are shuffled: once by id to meet the labels, once by digest
  for the copies.
* Copies of a text are summed per part and label before their digest brings them together, so a text that
  a third of all documents share is one row a part.
* The recursion holds no document and no part: 32 masks times 326 prefixes at most, whatever the tables hold.
  A step only depends on the letters before it, not on their order, so the cells meet 80 verdicts a mask,
  not 325.

Defined cases: a null text is an empty one and a copy of other empty ones. A null source is the empty
part. A null id is no smaller than any and has no smaller one. Rows that repeat an id with its text are
not copies of each other; each counts. Several labels of one document count as good or toxic if one does. A
document without a label is neither. A long text is one value of one row. An empty table gives an empty
result. Columns are taken by name from their own table, so clashing extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sublens.llm.scratch import written

LETTERS = "ABCDE"
COPY_BIT = 1 << LETTERS.index("E")
METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(text: Column) -> Column:
    """Bits of the filters A to D, which a text fails by itself."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("bigint") < 50 * F.size(words).cast("bigint"),
        "C": 100 * capitals.cast("bigint") > 2 * F.char_length(text).cast("bigint"),
        "D": text.rlike("[#$%&*|]"),
    }
    bits = [F.when(test, 1 << LETTERS.index(letter)).otherwise(0) for letter, test in tests.items()]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents per part and set of failed filters."""
    text = F.coalesce(docs["text"], F.lit(""))
    judged = docs.select(
        docs["doc_id"],
        F.coalesce(docs["source"], F.lit("")).alias("part"),
        failures(text).alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    told = labels.groupBy(labels["doc_id"]).agg(
        F.max((labels["quality"] == 1).cast("int")).alias("good"), F.max((labels["toxic"] == 1).cast("int")).alias("toxic")
    )
    kinds = ["digest", "part", "mask", "good", "toxic"]
    # Grouped by the id that the join dealt the rows by: no shuffle, and repeated rows become one.
    rows = (
        judged.join(told, "doc_id", "left")
        .fillna(0, ["good", "toxic"])
        .groupBy("doc_id", *kinds)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    alike = rows.groupBy(*kinds).agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("at_first"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
    )
    owner = F.min("first").over(Window.partitionBy("digest"))
    originals = F.when(F.col("first") == F.col("owner"), F.col("at_first")).otherwise(0)
    split = alike.withColumn("owner", owner).withColumn("copies", F.col("n") - F.col("nameless") - originals)
    both = F.array(
        F.struct(F.col("mask").bitwiseOR(F.lit(COPY_BIT)).alias("mask"), F.col("copies").alias("n")),
        F.struct(F.col("mask"), (F.col("n") - F.col("copies")).alias("n")),
    )
    return (
        split.select("part", "good", "toxic", F.inline(both))
        .where(F.col("n") > 0)
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("good")).alias("good"),
            F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
        )
    )


# A row is a prefix of an order and a mask: ``bit`` is the prefix's last letter, ``before`` the ones applied
# ahead of it, and the verdicts say what this step does with the documents of the mask.
_WALK = """
WITH RECURSIVE walk(filter_order, step, before, bit, mask) AS (
  SELECT '', 0, 0, 0, mask FROM {masks}
  UNION ALL
  SELECT concat(filter_order, substr({letters}, f + 1, 1)), step + 1, before | bit, shiftleft(1, f), mask
  FROM walk LATERAL VIEW explode(filter(sequence(0, length({letters}) - 1), i -> getbit(before | bit, i) = 0)) t AS f
  WHERE step < length({letters}))
SELECT filter_order, step, before, bit, mask,
  mask & (before | bit) = 0 AS kept,
  mask & before = 0 AND mask & bit <> 0 AS removed,
  mask & before <> 0 AND mask & bit <> 0 AS redundant,
  mask = bit AS unique_fails
FROM walk WHERE step > 0
"""


def verdicts(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """What each step of each prefix does with each mask that occurs."""
    return cells.sparkSession.sql(_WALK, masks=cells.select("mask").distinct(), letters=letters)


def metrics(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Counts per part, whole order and step. ``cells`` is read twice and should be stored."""
    walk = written(verdicts(cells, letters), "audit-walk")
    when = ["before", "bit"]
    kinds = ["kept", "removed", "redundant", "unique_fails"]

    def of(amount: str, kind: str) -> Column:
        return F.sum(F.when(F.col(kind), F.col(amount)).otherwise(0))

    steps = (
        cells.join(walk.select(*when, "mask", *kinds).distinct(), "mask")
        .groupBy("part", *when)
        .agg(
            *[of("n", kind).alias(kind) for kind in kinds],
            of("good", "removed").alias("good_lost"),
            of("toxic", "removed").alias("toxic_lost"),
        )
    )
    prefixes = walk.select(F.col("filter_order").alias("prefix"), "step", *when).distinct()
    whole = prefixes.where(F.col("step") == len(letters)).select(F.col("prefix").alias("filter_order"))
    orders = whole.select(
        "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step")
    ).withColumn("prefix", F.expr("left(filter_order, step)"))
    orders = orders.join(prefixes.drop("step"), "prefix").select("filter_order", "step", *when)
    # A filter's share over all orders: each step counts once for every order that holds it.
    times = orders.groupBy(*when).agg(F.count(F.lit(1)).alias("times"))
    shared = steps.join(times, when).withColumn(
        "shapley", F.sum(F.col("removed") * F.col("times")).over(Window.partitionBy("part", "bit"))
    )
    return shared.join(orders, when).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), *METRICS, "shapley"
    )


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return metrics(written(mask_cells(docs, labels), "audit-cells"))


ORACLE_SQL = r"""
with recursive worded as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
marks as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id),
failed as (
  select w.doc_id, part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    {'A': len(words) < 200,
     'B': 100 * len(list_distinct(words)) < 50 * len(words),
     'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
     'D': regexp_matches(text, '[#$%&*|]'),
     'E': coalesce(w.doc_id > min(w.doc_id) over (partition by text), false)} as f
  from worded as w left join marks as m on m.doc_id = w.doc_id),
letters(letter) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
fails as (
  select part, good, toxic,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: case x when 'A' then f.A when 'B' then f.B when 'C' then f.C
      when 'D' then f.D else f.E end) as letters
  from failed),
cells as (
  select part, letters, count(*) as n, sum(good) as good, sum(toxic) as toxic from fails group by all),
orders(filter_order) as (
  select '' union all
  select filter_order || letter from orders, letters where not contains(filter_order, letter)),
steps as (
  select filter_order, step, substr(filter_order, step, 1) as letter, substr(filter_order, 1, step - 1) as earlier
  from orders, range(1, 6) as r(step) where length(filter_order) = 5),
looked as (
  select part, filter_order, step, letter, n, good, toxic, contains(array_to_string(letters, ''), letter) as fails_it,
    len(list_filter(letters, lambda x: contains(earlier, x))) > 0 as gone, len(letters) = 1 as only_one
  from cells, steps),
counted as (
  select part, filter_order, step, letter,
    sum(n) filter (not gone and not fails_it) as kept,
    sum(n) filter (not gone and fails_it) as removed,
    sum(n) filter (gone and fails_it) as redundant,
    sum(n) filter (fails_it and only_one) as unique_fails,
    sum(good) filter (not gone and fails_it) as good_lost,
    sum(toxic) filter (not gone and fails_it) as toxic_lost
  from looked group by all)
select part, filter_order, cast(step as int) as step, cast(coalesce(kept, 0) as bigint) as kept,
  cast(coalesce(removed, 0) as bigint) as removed, cast(coalesce(redundant, 0) as bigint) as redundant,
  cast(coalesce(unique_fails, 0) as bigint) as unique_fails, cast(coalesce(good_lost, 0) as bigint) as good_lost,
  cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
  cast(sum(coalesce(removed, 0)) over (partition by part, letter) as bigint) as shapley
from counted
"""
