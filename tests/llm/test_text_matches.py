"""Jaccard join, suffix dedup, decontamination and BPE against brute force and the library."""

import hashlib
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sublens.llm import bpe, decontaminate, jaccard, scratch, suffix
from tests.llm.rows import SCHEMA, changed, frame, odd_rows, prose

ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def near_rows():
    base = prose(1, 10)
    rows = [(100 + i, changed(base, i, i % 4)) for i in range(30)]
    rows += [(200 + i, prose(50)) for i in range(12)] + [(300 + i, prose(300 + i)) for i in range(20)]
    rows += [(400 + i, changed(prose(77, 8), i, 7)) for i in range(8)]
    return rows + odd_rows()


def brute_components(rows):
    sets = []
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
        sets.append((doc, {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()))
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 85 * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return Counter((d, len(s), root(d) if d is not None else None) for d, s in sets)


@pytest.mark.parametrize("tile", [jaccard.TILE, 600])
def test_jaccard_components_match_brute_force(spark, tile):
    rows = near_rows()
    found = jaccard.jaccard_components(frame(spark, rows), tile=tile).collect()
    assert Counter(tuple(r) for r in found) == brute_components(rows)


def test_parts_of_linked_sets_always_share_a_key():
    import numpy as np

    rng, bands = np.random.default_rng(3), jaccard.Bands(85, 100)
    for size in [7, 8, 12, 13, 20, 40, 75, 150, 400]:
        for _ in range(30):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            differ = (15 * 2 * size) // 185 // 2
            b = np.unique(np.concatenate([a[differ:], rng.integers(0, 2**63, differ, dtype=np.uint64)]))
            keys = [set(np.concatenate(jaccard.part_keys(np.unique(x), bands) or [np.zeros(0, np.uint64)]).tolist()) for x in (a, b)]
            assert differ == 0 or keys[0] & keys[1]


def test_linked_sets_of_unlike_sizes_share_a_key_and_a_common_passage_makes_few():
    rng, bands = np.random.default_rng(4), jaccard.Bands(85, 100)
    keys = lambda x: np.concatenate(jaccard.part_keys(np.unique(x), bands) or [np.zeros(0, np.uint64)])
    draw = lambda n: rng.integers(0, 2**64 - 1, n, dtype=np.uint64)
    for size in [40, 47, 60, 100, 155, 300, 700]:
        for _ in range(20):
            whole = draw(size)
            assert set(keys(whole).tolist()) & set(keys(whole[size * 15 // 100 :]).tolist())
    # a line of ten shingles in otherwise unlike sets; parts that one of these fills alone would chain them
    held = 0
    for _ in range(4):
        line = draw(10)
        holders = Counter(k for _ in range(400) for k in set(keys(np.concatenate([line, draw(190)])).tolist()))
        held += sum(n for n in holders.values() if n > 1)
    assert held < 130


def test_a_group_by_chance_does_not_outlast_another_dealing(spark, monkeypatch):
    loads, plain = [], jaccard.tiles_joined

    def noted(rows, *rest):
        loads.append(rows.select("doc_id").distinct().count())
        return plain(rows, *rest)

    monkeypatch.setattr(jaccard, "tiles_joined", noted)
    line = prose(999, 1, 13)
    rows = [(i, prose(2000 + i, 3, 8) + " " + line) for i in range(250)] + [(1000 + i, changed(prose(3, 8), i, 1)) for i in range(4)]
    found = jaccard.jaccard_components(frame(spark, rows), tile=600).collect()
    assert Counter(tuple(r) for r in found) == brute_components(rows)
    assert sum(loads) < 60


@pytest.mark.parametrize("tile", [jaccard.TILE, 600])
def test_one_document_of_a_set_meets_others_in_tiles(spark, monkeypatch, tile):
    met, plain = [], jaccard.tiles_joined

    def noted(rows, *rest):
        met.extend(r[0] for r in rows.select("doc_id").collect())
        return plain(rows, *rest)

    monkeypatch.setattr(jaccard, "tiles_joined", noted)
    base = prose(1, 10)
    near = [(1000 * i, changed(base, i, 1 + i % 3)) for i in range(1, 7)]
    rows = [(d + k, t) for d, t in near for k in range(8)] + [(9000 + k, prose(2, 8)) for k in range(20)] + odd_rows()
    # copies lie in other tasks than the first of them
    docs = frame(spark, sorted(rows, key=lambda r: (r[0] or 0) % 1000)).repartition(16)
    found = jaccard.jaccard_components(docs, tile=tile).collect()
    assert Counter(tuple(r) for r in found) == brute_components(rows)
    assert set(met) == {d for d, _ in near}


def test_shuffle_files_go_with_the_end_of_a_write(spark):
    files = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")))
    before, mode = files(), spark.conf.get(scratch.CLEANUP)
    table = spark.range(1000).groupBy(F.expr("id % 7").alias("k")).count()
    scratch.written(table, "kept")
    assert files() - before
    before, gone = files(), scratch.written(table, "gone", keep_shuffles=False)
    assert spark.conf.get(scratch.CLEANUP) == mode
    until = time.time() + 30
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before and gone.count() == 7


def test_jaccard_stage_keeps_one_of_each_group(spark):
    docs = frame(spark, [r for r in near_rows() if r[0] is not None]).withColumn("component_id", F.lit(0))
    out = jaccard.stage(docs)
    assert out.columns == docs.columns
    want = {d for (d, _, c), _ in brute_components([r for r in near_rows() if r[0] is not None]).items() if d == c}
    assert {r[0] for r in out.select("doc_id").collect()} == want


def brute_repeats(rows):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[p : p + 200] for _, b in data for p in range(len(b) - 199))
    out = Counter()
    for d, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - 199):
            if seen[b[p : p + 200]] > 1:
                gone[p : p + 200] = b"\x01" * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out[d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("large", [suffix.LARGE, 3])
def test_suffix_dedup_matches_brute_force(spark, large):
    passage = prose(9, 3)
    rows = [(10 + i, prose(40 + i, 3) + passage[: 190 + 2 * i] + prose(70 + i, 2)) for i in range(12)]
    rows += [(50, passage + " " + passage), (51, "x" * 950), (52, changed(prose(41, 3), 1, 2))] + odd_rows()
    # one passage in many surroundings, cut at both ends and with changed words
    rows += [(100 + i, prose(200 + i, 2) + changed(passage, i, i % 3)[i % 50 : 900 - i] + prose(300 + i, 2)) for i in range(60)]
    docs = frame(spark, rows).withColumn("key", F.lit(0)).withColumn("single", F.lit(0))
    found = suffix.without_repeats(docs, suffix.spans(docs, 4, large)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)
    )
    assert Counter(tuple(r) for r in found.collect()) == brute_repeats(rows)


def contamination(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII_LOWER))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add(item)
    out = Counter()
    for d, t in rows:
        w, hit, named = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    named |= windows[tuple(w[i : i + n])]
        ids = sorted(str(i) for i in named if i is not None)
        out[d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)] += 1
    return out


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 300])
def test_decontamination_matches_brute_force(spark, block_bytes):
    items = [(i, prose(500 + i, 2, 12)) for i in range(6)] + [(10, "few words only"), (11, None), (12, "..."), (None, prose(500, 2, 12)), (0, prose(500, 2, 12))]
    rows = [(10 + i, prose(i, 4) + "\n" + prose(500 + i % 8, 2, 12)[: 60 + 20 * i]) for i in range(10)]
    rows += [(30, "Few, WORDS: only!"), (31, prose(3, 300) + " few words only " + prose(4, 300))] + odd_rows()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.hits(frame(spark, rows), bench, ["doc_id"], block_bytes=block_bytes).select(
        "doc_id", "n_words", "n_hit", F.size("items").alias("n"), F.sha2(F.array_join("items", ","), 256), decontaminate.contaminated()
    )
    assert Counter(tuple(r) for r in found.collect()) == contamination(rows, items)


def test_windows_of_many_items_are_held_once_and_told_apart_by_their_words(monkeypatch):
    shared = prose(500, 1, 14)
    items = [(f"i{i}", shared + " " + prose(600 + i, 1, 9)) for i in range(40)] + [(None, shared), ("few", "few words only")]
    texts = [(" " + shared) * 30, prose(1, 4), prose(610, 1, 9), None, "", "x few words only y " + shared]
    rows = pa.array([t or "" for t in texts], pa.string())
    block = decontaminate.ItemWindows(items)
    keys, _, bounds, item, _ = block.by_length[13]
    assert len(set(keys.tolist())) == len(keys) and max(bounds[1:] - bounds[:-1]) == 41 and len(item) > len(keys)
    want = decontaminate._scanner(block)(rows)
    assert want[2][0] == sorted(f"i{i}" for i in range(40)) and "few" in want[2][5] and want[2][1] == []
    # every window of a length under one hash
    monkeypatch.setattr(decontaminate, "windows", lambda hashes, n: np.zeros(max(0, len(hashes) - n + 1), np.uint64))
    found = decontaminate._scanner(decontaminate.ItemWindows(items))(rows)
    assert [list(map(list, c)) if i else list(c) for i, c in enumerate(found)] == [list(map(list, c)) if i else list(c) for i, c in enumerate(want)]


def test_decontamination_holds_one_block_at_a_time(spark, monkeypatch):
    made, plain = [], decontaminate.shared_windows

    def noted(docs, items, n):
        assert not any(shared._jbroadcast.isValid() for shared in made)
        made.append(plain(docs, items, n))
        return made[-1]

    monkeypatch.setattr(decontaminate, "shared_windows", noted)
    bench = spark.createDataFrame([(i, prose(500 + i, 2, 12)) for i in range(6)], "item_id bigint, text string")
    found = decontaminate.hits(frame(spark, [(1, prose(502, 2, 12)), (2, prose(1, 3))]), bench, ["doc_id"], block_bytes=400)
    assert sorted((r["doc_id"], r["items"]) for r in found.collect()) == [(1, ["2"]), (2, [])] and len(made) > 2


def test_decontamination_stage_drops_contaminated_documents(spark):
    bench = spark.createDataFrame([(1, prose(500, 2, 12))], "item_id bigint, text string")
    docs = frame(spark, [(1, prose(500, 2, 12)), (2, prose(2)), (None, None)]).withColumn("items", F.lit("clash"))
    out = decontaminate.stage(docs, bench)
    assert out.columns == docs.columns and {r[0] for r in out.select("doc_id").collect()} == {2, None}


def test_bpe_agrees_with_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_path())
    rows = odd_rows() + [(20, "It's they'LL <|endoftext|>x " + "ab" * 200), (21, "ΣΑΣ İstanbul é \x1c\x85 ½٣")]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = Counter()
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(tuple(r) for r in bpe.digest(frame(spark, rows)).collect()) == want


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.digest(empty, bench).count() == decontaminate.digest(frame(spark, odd_rows()), bench).count() - len(odd_rows()) == 0
    for run in (jaccard.digest, jaccard.stage, suffix.digest, bpe.digest, bpe.stage):
        assert run(empty).count() == 0
