"""Line dedup: lines that several documents share stay in one document only.

A line's key is the line without white space at its ends and with A-Z in lower case. A key of at
least ``min_chars`` code points that occurs in at least ``min_docs`` documents loses all its lines
except in the largest doc_id that holds it.

Only hashes travel. They are partitioned by range and sorted within a partition by document (largest
first) and position, so that one pass over the stream sees the keeping document of a key first and
knows by the end of the key how many documents hold it. A key that makes up a noticeable part of all
lines (found by a heavy-hitter sketch, which decides only where rows go) leaves that path and is
counted with pre-aggregation instead, so no task gets all rows of a hot key. The result is a sparse
bitmap per document; texts are touched again only to apply it.

Defined cases: null text is one empty line and stays null. An empty line, or one shorter than
``min_chars``, is never dropped. Documents are told apart by doc_id: rows that share a doc_id count
as one document, and all of them keep the lines that the document keeps. A null doc_id is one
document, smaller than any other. An empty table gives an empty result. Other columns pass through
unread; clashing names are refused by none, since only doc_id and text are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sublens.llm.scratch import same_row, text_key, written

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A key is hot from one row in HOT_SHARE on: then no cold key fills more than a small partition,
# and there are at most HOT_SHARE hot keys, which bounds the table of their owners.
HOT_SHARE = 512
TRACKED = 8192


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else. ``lower`` does just that for a text of ASCII only."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, text_key, position and 128 hash bits of every line that is long enough."""
    lines = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.posexplode(lines_of(F.col("text"))))
    keys = lines.select(
        "doc_id", "text_key", F.col("pos"), lower_ascii(F.btrim("col", F.lit(SPACES))).alias("key")
    ).filter(F.char_length("key") >= min_chars)
    return keys.select(
        "doc_id", "text_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def hot_keys(seen: DataFrame) -> list[int]:
    """First hash halves that may hold more than one row in HOT_SHARE: at most HOT_SHARE of them."""
    row = seen.agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h1, {HOT_SHARE}, {TRACKED})").alias("top")
    ).first()
    return [item["item"] for item in row["top"] or [] if item["count"] * HOT_SHARE > max(row["n"], 10 * HOT_SHARE)]


def drops(seen: DataFrame, min_docs: int) -> DataFrame:
    """doc_id, text_key and position of every line to drop."""
    hot = F.col("h1").isin(hot_keys(seen))
    order = Window.partitionBy("h1", "h2").orderBy(F.col("doc_id").desc_nulls_last())
    whole = Window.partitionBy("h1", "h2")
    streamed = (
        seen.filter(~hot)
        .repartitionByRange("h1", "h2")
        .sortWithinPartitions("h1", "h2", F.col("doc_id").desc_nulls_last(), "pos")
        .withColumn("nth", F.dense_rank().over(order))
        .withColumn("n_docs", F.max("nth").over(whole))
        .filter((F.col("nth") > 1) & (F.col("n_docs") >= min_docs))
    )
    heavy = seen.filter(hot)
    owners = (
        heavy.select("h1", "h2", "doc_id")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("owner"))
        .filter(F.col("n_docs") >= min_docs)
    )
    # at most HOT_SHARE rows
    shared = heavy.join(F.broadcast(owners), ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("owner")))
    columns = ["doc_id", "text_key", "pos"]
    return streamed.select(columns).unionByName(shared.select(columns))


def line_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per document that loses lines: doc_id, text_key, dropped.

    ``dropped`` is a sparse bitmap, array<struct<word, bits>> sorted by word: bit b of word w stands
    for line 64 * w + b. Words without a set bit are left out; no text is carried.
    """
    seen = written(occurrences(docs, min_chars), "line-occurrences")
    bits = (
        drops(seen, min_docs)
        .repartition("doc_id", "text_key")
        .groupBy("doc_id", "text_key", F.shiftright("pos", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("bits"))
    )
    return bits.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped")
    )


def without_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text (null only where text is null)."""
    keyed = docs.withColumn("text_key", text_key(F.col("text")))
    joined = keyed.join(bitmaps, same_row(keyed, bitmaps), "left").select(
        *[keyed[c] for c in docs.columns], bitmaps["dropped"]
    )
    # the bitmap with its empty words, so that a line finds its word by index
    words = F.transform(
        "dropped",
        lambda x, i: F.concat(
            F.array_repeat(
                F.lit(0).cast("bigint"),
                x["word"] - F.when(i == 0, -1).otherwise(F.get("dropped", i - 1)["word"]) - 1,
            ),
            F.array(x["bits"]),
        ),
    )
    dense = joined.withColumn("line_words", F.flatten(words)).withColumn("all_lines", lines_of(F.col("text")))
    kept = F.filter(
        "all_lines",
        lambda x, i: F.coalesce(F.getbit(F.get("line_words", F.shiftright(i, 6)), i.bitwiseAND(63)), F.lit(0)) == 0,
    )
    return dense.select(
        *docs.columns,
        F.size("all_lines").cast("bigint").alias("n_lines"),
        F.when(F.col("dropped").isNull(), F.lit(0))
        .otherwise(F.aggregate("dropped", F.lit(0), lambda n, x: n + F.bit_count(x["bits"])))
        .cast("bigint")
        .alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    return without_lines(docs, line_bitmaps(docs, min_chars, min_docs))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    plain = docs.select("doc_id", "text")
    return line_dedup(plain).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


def stage(docs: DataFrame) -> DataFrame:
    """``docs`` without the dropped lines, with n_chars following where there is one.

    Documents stay, also those that lose all lines (their text is then empty).
    """
    plain = docs.select([F.col(c).alias(f"in_{c}") for c in docs.columns if c not in ("doc_id", "text")] + ["doc_id", "text"])
    out = line_dedup(plain)
    changed = {"doc_id": F.col("doc_id"), "text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("n_dropped") == 0, F.col("in_n_chars")).otherwise(
            F.char_length("kept_text").cast(kind)
        )
    return out.select([changed.get(c, F.col(f"in_{c}")).alias(c) for c in docs.columns])


ORACLE_SQL = """
with lines as (
  select doc_id, unnest(l) as line, unnest(range(len(l))) as pos
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)),
keys as (
  select doc_id, line, pos,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines),
shared as (
  select key, max(doc_id) as owner from keys
  where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
judged as (
  select keys.*, shared.key is not null and doc_id <> owner as gone
  from keys left join shared on keys.key = shared.key)
select doc_id, count(*) as n_lines, cast(sum(case when gone then 1 else 0 end) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""
