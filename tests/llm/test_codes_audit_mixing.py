"""Vector codes, filter audit and source mixing: against brute force and SQL, on odd rows and hot groups."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sublens.llm import audit, codes, mixing
from tests.llm.rows import frame, odd_rows, prose

VECTORS = "vec_id bigint, embedding array<float>, label int, code string"


# Vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(1, -(-max((len(r[1]) for r in kept), default=0) // parts))
    whole = [[math.floor(4096 * float(np.float32(x))) for x in r[1]] for r in kept]
    whole = [v + [0] * (width * parts - len(v)) for v in whole]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        squares = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return min(range(len(book)), key=lambda i: (squares[i], i)), min(squares)

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for v in cut:
                groups[nearest(v[p], books[p])[0]].append(v[p])
            books[p] = [
                [sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else e for i, e in enumerate(books[p])
            ]
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(s for _, s in f) for f in found]
    totals = Counter()
    for r, e in zip(kept, errors):
        totals[r[2]] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter(
        (r[0], "".join(f"{i:02x}" for i, _ in f), e, totals[r[2]], digest) for r, f, e in zip(kept, found, errors)
    )


def vectors(seed, n, width=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.4, (5, width))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.1, width)).astype(np.float32).tolist(), i % 3, "x") for i in range(n)]
    # a hot vector, copies, and points on a grid for many equal distances
    rows += [(n + i, rows[7][1], None, "x") for i in range(n // 3)]
    rows += [(3 * n + i, [float(x) for x in rng.integers(-1, 2, width) / 4], 9, "x") for i in range(n // 3)]
    return rows


@pytest.mark.parametrize("block", [7, 64, 1024])
def test_codes_equal_plain_rounds_whatever_the_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(codes.blocks, "__defaults__", (codes.PARTS, block))
    monkeypatch.setattr(codes.fitted, "__defaults__", (codes.PARTS, codes.ENTRIES, codes.ROUNDS, block))
    rows = vectors(1, 90)
    odd = [
        (None, rows[3][1], 1, "x"),
        (500, None, 1, "x"),
        (501, [*rows[0][1][:-1], None], 1, "x"),
        (502, [*rows[0][1][:-1], math.nan], 1, "x"),
        (503, [*rows[0][1][:-1], -math.inf], 1, "x"),
        (504, rows[0][1][:5], 2, "x"),
        (2, rows[2][1], 2, "x"),
        (2, rows[2][1], 2, "x"),
    ]
    table = spark.createDataFrame(rows + odd, VECTORS).repartition(3)
    found = codes.digest(table)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(tuple(r) for r in found.collect()) == plain_codes(rows + odd)


def test_codes_of_few_and_of_no_vectors(spark):
    few = [(5, [0.5] * 8, None, "x"), (3, [0.25] * 8, None, "x"), (4, [-1e30] * 8, 1, "x")]
    got = {r["vec_id"]: r for r in codes.digest(spark.createDataFrame(few, VECTORS)).collect()}
    assert {k: (r["code"], r["error"]) for k, r in got.items()} == {
        3: ("00" * 8, 0), 4: ("01" * 8, 0), 5: ("02" * 8, 0)
    }
    assert codes.digest(spark.createDataFrame([], VECTORS)).count() == 0
    assert codes.digest(spark.createDataFrame([(1, [], 1, "x")], VECTORS).limit(5)).first()["code"] == "00" * 8


def test_cover_tree_holds_its_promises():
    rng = np.random.default_rng(3)
    points, weights = np.unique(rng.integers(-40, 40, (400, 3)), axis=0, return_counts=True)
    tree = codes.CoverTree.built(points, weights)
    level, parent = codes._nets(points)
    assert sorted(tree.node_point[tree.child_from == tree.child_to]) == list(range(len(points)))
    for node in range(len(tree.node_point)):
        below, front = [], [node]
        while front:
            x = front.pop()
            kids = range(tree.child_from[x], tree.child_to[x])
            front.extend(kids)
            if not kids:
                below.append(tree.node_point[x])
        gap = np.sqrt(((points[below] - points[tree.node_point[node]]) ** 2).sum(1))
        assert np.isclose(gap.max(), tree.radius[node])
        assert tree.counts[node] == weights[below].sum()
        assert (tree.sums[node] == (points[below] * weights[below][:, None]).sum(0)).all()
    for lv in np.unique(level[1:]):
        coarser = [0, *np.flatnonzero(level > lv).tolist()]
        coarser = sorted(set(coarser) - ({0} if len(points) == 1 else set()))
        here = [y for y in np.flatnonzero(level == lv) if y != 0]
        net = np.array(sorted({0, *coarser, *here}))
        between = np.sqrt(((points[net][:, None] - points[net][None]) ** 2).sum(2))
        assert between[~np.eye(len(net), dtype=bool)].min() > 2.0**lv
        assert all(math.dist(points[y], points[parent[y]]) <= 2.0 ** (lv + 1) for y in here)
        assert all(parent[y] == 0 or level[parent[y]] > lv for y in here)


def test_whole_subtrees_are_assigned_without_their_points():
    rng = np.random.default_rng(5)
    centres = rng.integers(-4000, 4000, (16, 8))
    points = np.unique((centres[rng.integers(0, 16, 1000)] + rng.integers(-20, 20, (1000, 8))), axis=0)
    tree = codes.CoverTree.built(points, np.ones(len(points), np.int64))
    nodes, _, _ = tree.assigned(centres)
    assert len(nodes) < 100 and tree.counts[nodes].sum() == len(points)
    assert (tree.entries(centres) == codes.squared_distances(points, centres).argmin(1)).all()


# Filter audit


def plain_audit(docs, labels):
    first = {}
    for d, text, _, _ in docs:
        if d is not None:
            first[text or ""] = min(first.get(text or "", d), d)
    good, toxic = ({d for d, q, t in labels if (q, t)[k] == 1} for k in (0, 1))
    judged = []
    for d, text, _, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        fails |= {"E"} if d is not None and first[text] < d else set()
        judged.append((source or "", fails, d in good, d in toxic))
    out = {}
    for part in {p for p, *_ in judged}:
        rows, shapley = {}, Counter()
        for order in map("".join, permutations("ABCDE")):
            left = [x for x in judged if x[0] == part]
            for k, letter in enumerate(order):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                failing = [x for x in judged if x[0] == part and letter in x[1]]
                shapley[letter] += len(gone)
                rows[part, order, k + 1] = [
                    len(left), len(gone), len(failing) - len(gone), sum(x[1] == {letter} for x in failing),
                    sum(x[2] for x in gone), sum(x[3] for x in gone),
                ]
        for (p, order, step), row in rows.items():
            out[p, order, step] = (*row, shapley[order[step - 1]])
    return out


def test_audit_equals_walking_every_order(spark):
    long = [(i, prose(i, 18, 14), "en", f"s{i % 2}") for i in range(40, 60)]
    docs = [(*r, "en", "s1") if len(r) == 2 else r for r in odd_rows()] + long
    docs += [(100 + i, long[0][1], "en", ["s0", None, ""][i % 3]) for i in range(12)]
    docs += [(120 + i, "same word " * 150 + "#" * (i % 2), "de", "s0") for i in range(6)]
    docs += [(130, "LOUD WORDS " + prose(9, 20), "en", "s1"), (131, "é" * 300, "en", "s2"), (100, long[0][1], "en", "s0")]
    labels = [(d, (i % 2), (i % 3 == 0) * 1) for i, (d, *_) in enumerate(docs)] + [(44, 1, None), (44, 0, 1), (9999, 1, 1)]
    named = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("source", F.lit("clash"))
    table = frame(spark, docs).withColumn("mask", F.lit("clash")).withColumn("quality", F.lit(1)).repartition(4)
    found = audit.digest(table, named)
    want = plain_audit(docs, [x for x in labels if x[0] is not None])
    got = {tuple(r)[:3]: tuple(r)[3:] for r in found.collect()}
    assert got == want


def test_audit_of_an_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audit.digest(frame(spark, []), labels).count() == 0


def test_audit_walk_holds_every_prefix_of_every_order(spark):
    cells = spark.createDataFrame([(0,), (3,), (31,)], "mask int")
    walk = audit.verdicts(cells)
    assert walk.count() == 3 * 325
    assert walk.where("step = 5").select("filter_order").distinct().count() == 120
    assert walk.where("mask = 31 and removed").count() == 5


# Source mixing


def plain_targets(sizes_by_source):
    """Shares by weight, cut at the cap and reshared until none is above it."""
    names = sorted((s for s in sizes_by_source if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes_by_source else []
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), sum(sizes_by_source.values())
    while open_:
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes_by_source[s] + 1e-9}
        if not over:
            target |= share
            break
        target |= {s: 3.0 * sizes_by_source[s] for s in over}
        rest -= sum(target[s] for s in over)
        open_ -= over
    return target


def mixing_rows():
    rows = [(*r, "en", "s1") if len(r) == 2 else r for r in odd_rows()]
    rows += [(200 + i, prose(i, 2 + i % 9), "en", "hot") for i in range(60)]
    rows += [(300 + i, prose(i, 1, 5), "en", s) for i, s in enumerate(["tiny", "Tiny", "élan", None, None, ""])]
    rows += [(400, "copy of one row", "en", "s1")] * 40
    return rows


def test_mixing_reaches_every_target_to_the_word(spark):
    rows = mixing_rows()
    table = frame(spark, rows).withColumn("size", F.lit("clash")).withColumn("target", F.lit(None))
    found = mixing.digest(table.repartition(5), block_words=32, shard_words=200).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by_source = Counter()
    for _, text, _, source in rows:
        by_source[source] += size(text)
    target = plain_targets(by_source)
    want = Counter((d, size(t), by_source[s], round(target[s], 6)) for d, t, _, s in rows)
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in found) == want
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in found)
    taken = Counter()
    for r in found:
        taken[r["source_size"], round(r["target"], 6)] += r["taken"]
    goal = Counter()
    for s in by_source:
        goal[by_source[s], round(target[s], 6)] += math.floor(target[s] + 0.5)
    assert taken == goal
    again = mixing.digest(table.repartition(2), block_words=32, shard_words=200).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_mixing_without_words_or_rows(spark):
    assert mixing.digest(frame(spark, [])).count() == 0
    got = mixing.digest(frame(spark, [(1, None), (2, " ")])).collect()
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in got] == [(0, 0, 0.0, 0)] * 2


def test_mixing_deals_disjoint_blocks_that_cover_the_quota(spark):
    table = frame(spark, mixing_rows())
    sources, sized = mixing.plan(table, block_words=16)
    drawn = mixing.drawn_blocks(sources, 13).collect()
    quotas = {r["source_rank"]: r["blocks"] for r in sources.collect()}
    assert Counter((r["source_rank"], r["block"]) for r in drawn) == Counter(
        (s, b) for s, n in quotas.items() for b in range(n)
    )
    held = Counter(r["shard"] for r in drawn)
    assert set(held) == set(range(13)) and max(held.values()) - min(held.values()) <= 1


def test_mixed_texts_are_the_planned_words(spark):
    rows = [(i, prose(i, 3), "en", f"s{i % 3}") for i in range(9)] + [(50, "a b c", "en", "s0")] * 4
    table = frame(spark, rows)
    sources, sized = mixing.plan(table, block_words=10)
    placed = mixing.slots(sized, sources)
    mix = mixing.mixed(sources, placed, 3)
    out = mixing.texts(table, mix)
    words = out.select(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert words == sources.agg(F.sum("quota")).first()[0]
    known = {w for _, t, _, _ in rows for w in t.split()}
    assert {w for r in out.collect() for w in r["text"].split(" ")} <= known


@pytest.mark.parametrize("whole,marked,drawn", [(12, 5, 6), (40, 39, 20), (500, 250, 100), (9000, 30, 4500), (7, 0, 3), (7, 7, 3)])
def test_draws_are_hypergeometric(spark, whole, marked, drawn):
    n = 4000
    big = [F.lit(v).cast("bigint") for v in (whole, marked, drawn)]
    found = Counter(
        r["x"] for r in spark.range(n).select(mixing.hypergeometric(*big, (F.col("id") + 0.5) / n).alias("x")).collect()
    )
    exact = {
        k: math.comb(marked, k) * math.comb(whole - marked, drawn - k) / math.comb(whole, drawn)
        for k in range(max(0, drawn + marked - whole), min(marked, drawn) + 1)
    }
    assert set(found) <= set(exact)
    assert all(abs(found[k] / n - p) <= 1.01 / n for k, p in exact.items())


def test_halves_of_the_tree_vary_with_the_seed_but_keep_the_mean(spark):
    sources = spark.createDataFrame([(1, 30), (2, 10), (3, 20)], "source_rank int, blocks bigint")
    lefts = [
        {r["source_rank"]: r["n"] for r in mixing.splitting_tree(sources, 2, f"seed{i}").where("shard = 0").collect()}
        for i in range(25)
    ]
    assert len({tuple(sorted(x.items())) for x in lefts}) > 5
    assert all(sum(x.values()) == 30 for x in lefts)
    assert abs(sum(x[1] for x in lefts) / 25 - 15) < 2


@pytest.mark.parametrize("name", ["op11", "op12", "op13"])
def test_sql_agrees_on_a_test_table(spark, name):
    from checks.compare import connect, differences
    from sublens.llm.queries import ORACLES, QUERIES

    sf_dir = "/root/testdata/sf0.001"
    (query,) = [q for q in QUERIES if q.startswith(name + "_")]
    assert differences(QUERIES[query](spark, sf_dir), connect(sf_dir), ORACLES[query]) == []
