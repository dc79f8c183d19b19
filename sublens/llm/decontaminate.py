"""Benchmark decontamination: word windows of the benchmark, found in documents.

An item's windows are its runs of ``n`` consecutive words; an item with fewer words, but not none, is
one window. The set of window hashes of a block of items is broadcast; tasks roll the same hash over
the words of each document, take the positions that hit, and compare the words themselves before a hit
counts. Documents are never shuffled.

The broadcast is bounded: items are dealt into blocks of about ``block_bytes`` of text by their
measured total. One block is the rule, and then one scan does all; with more, the documents are scanned
once per block, and only hits are stored and put together by document. The driver holds one block at a
time: a block's broadcast is removed once its hits are stored, before the next block is read.

A window that many items share is held once, with the list of its items. A document meets that list once for
each distinct window, however often the window occurs in it.

Defined cases: null text has no words, is not hit and not contaminated. A null item text has no
windows; an item without id marks words but adds no name to the list. Repeated items count once,
repeated documents each. Without items nothing is hit. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sublens.llm.batches import NOT_ALNUM, Words, mapped, windows
from sublens.llm.scratch import same_row, text_key, written

WINDOW = 13
BLOCK_BYTES = 4 << 20
FOUND = {
    "n_words": T.LongType(),
    "runs": T.ArrayType(T.StructType([T.StructField("from", T.IntegerType()), T.StructField("to", T.IntegerType())])),
    "items": T.ArrayType(T.StringType()),
}
_FILTER_BITS = 20


class ItemWindows:
    """Distinct windows of a block of benchmark items, per window length sorted by hash, each with its items.

    ``by_length`` holds for each length the hashes, a place of each window in the items' words, the bounds of
    its items in the list that follows, that list, and a filter of the hashes' leading bits.
    """

    def __init__(self, items: list[tuple[str | None, str | None]], n: int = WINDOW):
        self.ids = [item for item, _ in items]
        words = Words(pa.array([text or "" for _, text in items], pa.string()), NOT_ALNUM)
        self.data, self.start, self.end = words.data, words.start, words.end
        hashes, counts = words.hashes(), words.counts
        self.by_length = {}
        for length in sorted(set(np.minimum(counts[counts > 0], n).tolist())):
            owners = np.flatnonzero(np.minimum(counts, n) == length)
            at = np.concatenate([np.arange(words.first[i], words.first[i + 1] - length + 1) for i in owners])
            item = np.repeat(owners, counts[owners] - length + 1)
            keys = windows(hashes, length)[at]
            order = np.argsort(keys, kind="stable")
            keys, at, item = keys[order], at[order], item[order]
            first = np.concatenate([[True], keys[1:] != keys[:-1]])
            self._part_by_words(first, at, item, length)
            begins = np.flatnonzero(first)
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[keys >> np.uint64(64 - _FILTER_BITS)] = True
            self.by_length[length] = (keys[begins], at[begins], np.append(begins, len(keys)), item, seen)

    def _part_by_words(self, first: np.ndarray, at: np.ndarray, item: np.ndarray, length: int) -> None:
        """Where windows of one hash differ in their words, put equal ones side by side and mark where each begins."""
        begins = np.flatnonzero(first)
        ends = np.append(begins[1:], len(first))
        for a, b in zip(begins[ends - begins > 1].tolist(), ends[ends - begins > 1].tolist()):
            found = [self.text(place, length) for place in at[a:b].tolist()]
            if all(words == found[0] for words in found):
                continue
            order = sorted(range(b - a), key=found.__getitem__)
            at[a:b], item[a:b] = at[a:b][order], item[a:b][order]
            first[a + 1 : b] = [found[y] != found[x] for x, y in zip(order, order[1:])]

    def text(self, at: int, length: int) -> list[bytes]:
        return [self.data[a:b].tobytes() for a, b in zip(self.start[at : at + length], self.end[at : at + length])]

    def names(self, found: set[tuple[int, int]]) -> set[str]:
        """Ids of the items that hold any of some windows, given as length and number."""
        items: set[int] = set()
        for length, k in found:
            _, _, bounds, item, _ = self.by_length[length]
            items.update(item[bounds[k] : bounds[k + 1]].tolist())
        return {self.ids[i] for i in items if self.ids[i] is not None}


def _scanner(block: ItemWindows):
    def scan(texts: pa.Array) -> list:
        words = Words(texts, NOT_ALNUM)
        hashes, room = words.hashes(), words.room()
        n = len(hashes)
        covered = np.zeros(n + 1, np.int32)
        met: dict[int, set[tuple[int, int]]] = {}
        for length, (keys, at, _, _, seen) in block.by_length.items():
            rolled = windows(hashes, length)
            hits = np.flatnonzero(seen[rolled >> np.uint64(64 - _FILTER_BITS)])
            hits = hits[room[hits] >= length]
            low, high = np.searchsorted(keys, rolled[hits], "left"), np.searchsorted(keys, rolled[hits], "right")
            hits, low, high = hits[high > low], low[high > low], high[high > low]
            docs = np.searchsorted(words.first, hits, "right") - 1
            own: dict[int, list[bytes]] = {}
            for i, doc, a, b in zip(hits.tolist(), docs.tolist(), low.tolist(), high.tolist()):
                text = [words.data[s:e].tobytes() for s, e in zip(words.start[i : i + length], words.end[i : i + length])]
                for k in range(a, b):
                    if k not in own:
                        own[k] = block.text(at[k], length)
                    if own[k] == text:
                        covered[i] += 1
                        covered[i + length] -= 1
                        met.setdefault(doc, set()).add((length, k))
                        break
        named = {doc: block.names(found) for doc, found in met.items()}
        runs: list[list] = [[] for _ in range(len(texts))]
        if named:
            inside = np.cumsum(covered[:-1]) > 0
            for doc in named:
                a, b = words.first[doc], words.first[doc + 1]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], inside[a:b].view(np.int8), [0]])))
                runs[doc] = [{"from": int(x), "to": int(y)} for x, y in zip(edges[::2], edges[1::2])]
        return [words.counts, runs, [sorted(named.get(d, ())) for d in range(len(texts))]]

    return scan


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The benchmark's items, dealt into tables of about ``block_bytes`` of text; none if there is no text."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes)
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return [items.filter(dealt == k).distinct() for k in range(count)]


def shared_windows(docs: DataFrame, items: DataFrame | None, n: int):
    """The windows of one block as a broadcast."""
    rows = [tuple(row) for row in items.toLocalIterator()] if items is not None else []
    return docs.sparkSession.sparkContext.broadcast(ItemWindows(rows, n))


def scanned(docs: DataFrame, shared, keep: list[str]) -> DataFrame:
    return mapped(docs, FOUND, lambda: _scanner(shared.value), keep)


def hits(docs: DataFrame, benchmark: DataFrame, keep: list[str], n: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns ``keep`` of docs, with n_words, n_hit and the sorted ids of the items that occur."""
    each = blocks(benchmark, block_bytes)
    if len(each) <= 1:
        found = scanned(docs, shared_windows(docs, each[0] if each else None, n), keep)
    else:
        keyed = docs.withColumn("text_key", text_key(F.col("text")))
        parts = None
        for items in each:
            shared = shared_windows(docs, items, n)
            own = scanned(keyed, shared, ["doc_id", "text_key"]).filter(F.size("runs") > 0).distinct()
            stored = written(own, "decontaminate-hits")
            # nothing reads this block again
            shared.destroy()
            parts = stored if parts is None else parts.unionByName(stored)
        # at most one row per block and document
        joined = parts.groupBy("doc_id", "text_key").agg(
            F.flatten(F.collect_list("runs")).alias("runs"), F.flatten(F.collect_list("items")).alias("items")
        )
        counted = scanned(keyed, shared_windows(docs, None, n), [*keep, *[c for c in ("doc_id", "text_key") if c not in keep]])
        found = counted.drop("runs", "items").join(joined, same_row(counted, joined), "left").select(
            *[counted[c] for c in keep],
            "n_words",
            F.coalesce("runs", F.array().cast(FOUND["runs"])).alias("runs"),
            F.coalesce("items", F.array().cast(FOUND["items"])).alias("items"),
        )
    return found.select(
        *keep,
        "n_words",
        _covered(F.col("runs")).alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"),
    )


def _covered(runs: Column) -> Column:
    """Words in the union of the runs."""
    nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("reach"))
    step = lambda done, run: F.struct(
        (done["n"] + F.greatest(F.lit(0), run["to"] - F.greatest(run["from"], done["reach"]))).alias("n"),
        F.greatest(done["reach"], run["to"]).alias("reach"),
    )
    return F.aggregate(F.array_sort(runs), nothing, step)["n"]


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return hits(docs, benchmark, ["doc_id"]).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def stage(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents; the others stay as they are."""
    names = [f"in_{c}" if c != "text" else c for c in docs.columns]
    plain = docs.toDF(*names).withColumns({c: F.col(f"in_{c}") for c in ("doc_id",)})
    return hits(plain, benchmark, names).filter(~contaminated()).select(names).toDF(*docs.columns)


ORACLE_SQL = """
with all_words as (
  select 'd' as kind, cast(doc_id as varchar) as id, doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents
  union all
  select 'b', cast(item_id as varchar), null, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') from benchmark),
bench as (
  select id as item_id, least(len(w), 13) as n, unnest(range(len(w) - least(len(w), 13) + 1)) as i, w
  from all_words where kind = 'b' and len(w) > 0),
item_windows as (select distinct item_id, n, array_to_string(w[i + 1 : i + n], ' ') as win from bench),
lengths as (select distinct n from item_windows),
doc_windows as (
  select doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') as win
  from (select doc_id, n, w, unnest(range(len(w) - n + 1)) as i
        from all_words cross join lengths where kind = 'd' and len(w) >= n)),
found as (select doc_id, doc_windows.n as n, i, item_id from doc_windows join item_windows
          on doc_windows.n = item_windows.n and doc_windows.win = item_windows.win),
hit as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, i + unnest(range(n)) as p from found) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, item_id from found) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
from all_words d left join hit on d.doc_id = hit.doc_id left join named on d.doc_id = named.doc_id
where d.kind = 'd'
"""
