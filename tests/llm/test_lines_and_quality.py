"""Line dedup and quality rules against brute force, and their odd cases."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sublens.llm import line_dedup, quality
from tests.llm.rows import SCHEMA, frame, odd_rows, prose

SPACE = " \t\n\x0b\x0c\r"
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def brute_lines(rows):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(SPACE).translate(ASCII_LOWER)
            if len(key) >= 20:
                holders[key].add(doc)
    order = lambda d: (d is not None, d)
    owner = {k: max(v, key=order) for k, v in holders.items() if len(v) >= 3}
    out = Counter()
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if owner.get(x.strip(SPACE).translate(ASCII_LOWER), doc) == doc]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out[doc, len(lines), len(lines) - len(kept), digest] += 1
    return out


SHARED = "This line stands in very many documents"


def line_rows():
    rows = [(i, f"{prose(i, 2)}\n  {SHARED.upper() if i % 2 else SHARED} \n{prose(i % 5, 2)}\n{SHARED}") for i in range(20, 60)]
    return rows + [(d, t) for d, t, *_ in odd_rows()] + [(100, "short line\n" * 3), (101, "\n".join([SHARED] * 70))]


def test_line_dedup_matches_brute_force(spark):
    rows = line_rows()
    found = Counter(tuple(r) for r in line_dedup.digest(frame(spark, rows)).collect())
    assert found == brute_lines(rows)


def test_line_dedup_hot_keys_take_the_other_path(spark, monkeypatch):
    rows = line_rows()
    docs = frame(spark, rows)
    hot = docs.select(F.xxhash64(F.lower(F.lit(SHARED)))).first()[0]
    monkeypatch.setattr(line_dedup, "hot_keys", lambda seen: [hot])
    assert Counter(tuple(r) for r in line_dedup.digest(docs).collect()) == brute_lines(rows)


def test_line_stage_keeps_rows_and_columns_with_clashing_names(spark):
    docs = frame(spark, line_rows()).withColumns({"text_key": F.lit(1), "dropped": F.lit("x"), "pos": F.lit(2)})
    out = line_dedup.stage(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.filter("n_chars <> char_length(text)").count() == 0


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    twice = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(twice),
        len(words) < 50 or 100 * len(twice) > 50 * len(words),
    )


def quality_rows():
    junk = [" ".join(w + s for w, s in zip(prose(i).split(), ["###", "$$$", "***", "%%%"] * 40)) for i in range(900, 910)]
    rows = [(i, prose(i, 8), "en", f"s{i % 2}") for i in range(500)]
    rows += [(600 + i, text, "en", "s0") for i, text in enumerate(junk)]
    rows += [(700 + i, prose(i, 8), "fr" if i % 2 else None, None) for i in range(8)]
    rows += [(800, "a b c " * 60, "en", "s0"), (801, "one two three four five six\n" * 9, "en", "s1")]
    return rows + [(d, t, None, "s9") for d, t in odd_rows()]


@pytest.fixture(scope="module")
def judged(spark):
    return quality.digest(frame(spark, quality_rows())).collect()


def test_quality_counts_match_brute_force(judged):
    want = Counter((d, *brute_counts(t)) for d, t, *_ in quality_rows())
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[c] for c in columns) for r in judged) == want


def test_quality_rejects_junk_and_keeps_clean_documents(judged):
    kept = {r["doc_id"]: r["kept"] for r in judged}
    assert not any(kept[600 + i] for i in range(10)) and not kept[800] and not kept[801]
    assert all(kept[i] for i in range(500)) and all(kept[700 + i] for i in range(8))


def test_quality_rejects_repetition_alone_beside_short_clean_texts(spark):
    def repeated(seed, lines, times, words=14):
        own = prose(seed, lines - times, words).split("\n")
        return "\n".join(own + own[:1] * times)

    few_lines = "\n".join(["one short header line of nine words in all"] * 2 + [prose(3, 4, 9)])
    rows = [(i, prose(i, 8)) for i in range(300)] + [(400 + i, prose(i, 4)) for i in range(100)]
    rows += [(1000, repeated(1, 20, 6)), (1001, repeated(2, 10, 3)), (1002, few_lines + "\n" + prose(4, 1, 9))]
    # words alone: runs of four words that occur twice, each in a line of its own
    runs = prose(7, 1, 200).split(" ")
    pairs = [" ".join(runs[4 * i : 4 * i + 4]) for i in range(25)]
    rows += [(1003, "\n".join(f"{p} w{i} x{i} y{i} z{i}" for i, p in enumerate(pairs + pairs[:20])))]
    counts = {d: brute_counts(t) for d, t in rows if d >= 1000}
    assert not any(c[5] for c in counts.values())
    assert counts[1000][3] == 6 and counts[1001][3] == 3 and counts[1002][3] == 1 and counts[1003][3] == 0
    kept = {r["doc_id"]: r["kept"] for r in quality.digest(frame(spark, rows)).collect()}
    assert not kept[1000] and not kept[1001] and not kept[1003]
    assert kept[1002] and all(kept[d] for d in kept if d < 1000)


def test_small_rests_are_judged_by_their_language_or_by_all_documents(spark):
    junk = [" ".join(w + "###" for w in prose(900 + i).split()) for i in range(3)]
    rows = [(i, prose(i, 8), "en", "hot") for i in range(300)]
    rows += [(400 + i, prose(400 + i, 8), *group) for i, group in enumerate([("en", "s1"), ("fr", "s2"), (None, None)] * 5)]
    rows += [(500 + i, text, *group) for i, (text, group) in enumerate(zip(junk, [("en", "s1"), ("fr", "s2"), (None, None)]))]
    docs = frame(spark, rows)
    found = quality.pools(quality.transformed(quality.counted(docs)), quality.MIN_ROWS).collect()
    assert {(r["lang"], r["source"]): r["pool"] for r in found if r["lang"] != "en" or r["source"] != "hot"} == {
        ("en", "s1"): 'all {"lang":"en"}', ("fr", "s2"): "all", (None, None): "all",
    }
    judged = {r["doc_id"]: r for r in quality.digest(docs).collect()}
    assert len(judged) == len(rows) and all(r["distance2"] is not None for r in judged.values())
    assert {d for d, r in judged.items() if not r["kept"]} == {500, 501, 502}


def test_quality_stage_agrees_with_the_digest(spark, judged):
    docs = frame(spark, quality_rows()).withColumns({"n_words": F.lit("clash"), "kept": F.lit(False)})
    out = quality.stage(docs)
    assert out.columns == docs.columns
    assert Counter(r[0] for r in out.select("doc_id").collect()) == Counter(r["doc_id"] for r in judged if r["kept"])


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for run in (line_dedup.digest, line_dedup.stage, quality.digest, quality.stage):
        assert run(empty).count() == 0
