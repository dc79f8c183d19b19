"""LM scoring, language identification, personal data and toxicity: brute force where there is one, held-out
quality elsewhere, and the odd cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sublens.llm import langid, maxent, pii, toxicity
from tests.llm.rows import SCHEMA, frame, odd_rows, prose

ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def remainder(doc, n):
    return zlib.crc32(str(doc).encode()) % n if doc is not None else None


def test_lm_base_score_matches_brute_force_and_the_model_beats_it(spark):
    pick = random.Random(4)
    # the second word of each pair follows from the first
    paired = [" ".join(f"W{k} v{k}" for k in pick.choices(range(15), k=40)) for _ in range(120)]
    rows = [(100 + i, t) for i, t in enumerate(paired)] + odd_rows()
    tokens = [(d, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII_LOWER)) + [None]) for d, t in rows]
    counts = Counter(w for d, ws in tokens if d is not None and remainder(d, 7) != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    found = maxent.digest(frame(spark, rows)).collect()
    want = Counter()
    for d, ws in tokens:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        want[d, remainder(d, 7) == 2, len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 4)] += 1
    assert Counter((*tuple(r)[:5], round(r["base_score"], 4)) for r in found) == want
    held = [r for r in found if r["held_out"] and 100 <= (r["doc_id"] or 0) < 220]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_scores_do_not_depend_on_held_out_texts(spark):
    rows = [(i, prose(i, 4)) for i in range(100, 160)]
    held = next(d for d, _ in rows if remainder(d, 7) == 2)
    # words of its own that are more frequent than any other, and copies of common ones
    other = [(d, "zebra the the " * 400 + "quagga " * 900 if d == held else t) for d, t in rows]
    first, second = ({r["doc_id"]: r for r in maxent.digest(frame(spark, x)).collect()} for x in (rows, other))
    for d, _ in rows:
        if d != held:
            assert math.isclose(first[d]["score"], second[d]["score"], rel_tol=1e-7), d
            assert first[d]["base_score"] == second[d]["base_score"]


def test_lm_rare_words_meet_their_counts_in_the_join(spark, monkeypatch):
    rows = frame(spark, [(i, prose(i, 4)) for i in range(100, 160)])
    whole = {r["doc_id"]: r for r in maxent.digest(rows).collect()}
    monkeypatch.setattr(maxent, "HEAD", 20)
    for r in maxent.digest(rows).collect():
        same = whole[r["doc_id"]]
        assert (r["n_known"], round(r["base_score"], 6)) == (same["n_known"], round(same["base_score"], 6))


def test_lm_probabilities_sum_to_one():
    weights = np.random.default_rng(1).normal(size=(maxent.ROWS, maxent.CLASSES + maxent.SYMBOLS)).astype(np.float32)
    p, q = maxent.probabilities(weights, np.arange(50))
    assert np.allclose((p[:, :, None] * q).sum((1, 2)), 1, atol=1e-4)


def test_lm_with_nothing_to_learn_from(spark):
    out = maxent.digest(frame(spark, [(None, "a b"), (None, None)])).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in out] == [(0, 0, 0.0)] * 2
    assert all(r["score"] < 0 for r in out)


def toy_language(seed, letters):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(30))


def test_language_is_found_in_held_out_documents(spark):
    rows = [(i, toy_language(i, "aeinorst"), "xx", "s") for i in range(60)]
    rows += [(100 + i, toy_language(i, "éèaouclm"), "yy", "s") for i in range(60)]
    rows += [(300, "123 ...", "xx", "s"), (301, None, "yy", "s"), (302, toy_language(9, "aeinorst"), None, "s")]
    found = {r["doc_id"]: r for r in langid.digest(frame(spark, rows)).collect()}
    assert all(found[i]["lang_pred"] == "xx" and found[100 + i]["lang_pred"] == "yy" for i in range(60))
    assert found[300]["lang_pred"] == found[301]["lang_pred"] == "und" and found[302]["lang_pred"] == "xx"
    assert all(r["held_out"] == (remainder(d, 4) == 2) and 0 <= r["score"] <= 1 for d, r in found.items())


def test_every_language_is_known_beside_a_hot_one(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_GRAMS", 300)
    monkeypatch.setattr(langid, "BLOCK_LANGS", 12)
    pick = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{k:02}": pick.sample(letters, 5) for k in range(34)}
    said = lambda of, n: " ".join("".join(pick.choices(of, k=4)) for _ in range(n))
    rows = [(1000 * k + i, said(of, 40), lang, "s") for k, (lang, of) in enumerate(own.items()) for i in range(8)]
    rows += [(100_000 + i, said(letters, 60), "hot", "s") for i in range(200)]
    found = {r["doc_id"]: r for r in langid.digest(frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    assert all(found[d]["lang_pred"] == lang for d, _, lang, _ in rows)
    alone = [r for r in rows if r[2] == "l03"]
    trees = lambda some: {
        tuple(r) for r in langid.bounded(langid.gram_counts(frame(spark, some))).filter("lang = 'l03'").collect()
    }
    assert trees(alone) == trees(rows)
    # lower orders hold all bytes, whatever the highest order has room for
    assert sum(r[3] for r in trees(rows) if r[1] == 0) == sum(len(t) for _, t, *_ in alone)


def test_code_lengths_match_a_plain_ppm():
    texts = {"a": ["abracadabra", "banana band"], "b": ["xyzzy", "abxy"]}
    rows = Counter()
    for lang, own in texts.items():
        for text in own:
            data = text.encode()
            for i in range(len(data)):
                known = min(i, 3)
                rows[lang, known, int.from_bytes(data[i - known : i + 1], "big")] += 1
    trees = langid.Trees([(*k, n) for k, n in rows.items()])

    def plain(lang, context, byte):
        bits = 0.0
        for order in range(len(context), -1, -1):
            tail = context[len(context) - order :]
            after = Counter(
                t.encode()[i] for t in texts[lang] for i in range(order, len(t)) if t.encode()[i - order : i] == tail
            )
            if not after:
                continue
            total = sum(after.values()) + len(after)
            if after[byte]:
                return bits - math.log2(after[byte] / total)
            bits -= math.log2(len(after) / total)
        return bits + 8

    for text in ("abra", "band xyz", "qab"):
        data = np.frombuffer(text.encode(), np.uint8)
        gram, known = langid.grams(data, np.array([0, len(data)]))
        got = trees.code_lengths(gram.astype(np.uint64), known)
        for i in range(len(data)):
            for column, lang in enumerate(trees.langs):
                assert abs(got[i, column] - plain(lang, bytes(data[max(0, i - 3) : i]), int(data[i]))) < 1e-6


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def base_of(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(spans)]


def test_personal_data_base_spans_match_brute_force(spark):
    texts = [
        "write to a.b@c.com_x@y.zz and é@x.y.z, 1.2.3.4.5.6.7.8 or 300.1.1.1 and 01.002.0003.4",
        "card 4111 1111 1111 1111, 4111-1111-1111-1112, 79927398713000 +1 (555) 123-4567 + 12 +12345",
        "a@b.c" * 50 + "@" * 20 + "9" * 400 + ".1.1.1",
        "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" and password=531ccd051a92ebcb68 end 😀 b@c.de",
    ]
    rows = [(100 + i, t) for i, t in enumerate(texts)] + odd_rows()
    found = pii.digest(frame(spark, rows)).collect()
    want = Counter((d, hashlib.sha256(",".join(base_of(t)).encode()).hexdigest()) for d, t in rows)
    assert Counter((r["doc_id"], r["base_sha256"]) for r in found) == want
    for r in found:
        base = base_of(dict((d, t) for d, t in rows)[r["doc_id"]])
        assert set(base) <= set(r["spans"].split(",")) | {""}
        assert r["n_email"] == sum(s.startswith("email") for s in base)
    secrets = next(r["spans"] for r in found if r["doc_id"] == 103)
    assert secrets.count("secret:") == 2


def test_reliable_labelers_are_told_from_noise():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < good, truth, ~truth) + 1 for good in (0.95, 0.9, 0.85, 0.5)], 1)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    true, table = pii.reliabilities(patterns, n.astype(float))
    assert table[1, 0, 2] > 0.85 and abs(table[1, 3, 2] - table[0, 3, 2]) < 0.15
    assert abs((true * n).sum() / n.sum() - 0.4) < 0.05


def test_toxicity_learns_from_labels_and_scores_every_row(spark):
    bad = ["vile", "awful", "hateful"]
    rows = [(i, prose(i, 2) + (f" {bad[i % 3]} {bad[(i + 1) % 3]} thing" if i % 4 == 0 else "")) for i in range(600)] + odd_rows()
    labels = [(i, 1, int(i % 4 == 0)) for i in range(600)] + [(None, 1, 1), (7, 0, None), (8, 0, 5)]
    docs = frame(spark, rows).withColumns({"toxic": F.lit(1), "label": F.lit(0), "score": F.lit(2.0)})
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = toxicity.digest(docs, table).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    held = [r for r in found if r["held_out"] and r["doc_id"] is not None and r["doc_id"] >= 10]
    right = [r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held]
    assert sum(right) > 0.9 * len(right)
    assert all(r["held_out"] == (remainder(r["doc_id"], 5) == 0) for r in found)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for run in (maxent.digest, langid.digest, pii.digest, lambda d: toxicity.digest(d, labels)):
        assert run(empty).count() == 0
    assert {r["score"] for r in toxicity.digest(frame(spark, odd_rows()), labels).collect()} == {0.5}


def test_toxicity_model_is_plain_ftrl(spark):
    rows = [(i, prose(i, 2) + (" vile scum of the road" if i % 3 == 0 else ""), "en", "s") for i in range(40)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)], "doc_id bigint, toxic int")
    given = toxicity.labelled(frame(spark, rows), labels, F.lit(True), 100)
    bias, at, w = toxicity.trained(given)
    z, n = {}, {}

    def weight(i):
        l1 = 0 if i == "bias" else toxicity.L1
        if abs(z.get(i, 0)) <= l1:
            return 0.0
        signed = l1 if z[i] > 0 else -l1
        return -(z[i] - signed) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for row in sorted(given.collect(), key=lambda r: (r.place, r.doc_id)):
            names = [*row.features, "bias"]
            weights = [weight(i) for i in names]
            g = 1 / (1 + 2.718281828459045 ** -sum(weights)) - row.label
            for i, x in zip(names, weights):
                old = n.get(i, 0.0)
                n[i] = old + g * g
                z[i] = z.get(i, 0.0) + g - (n[i] ** 0.5 - old**0.5) / toxicity.ALPHA * x
    want = {i: weight(i) for i in z if i != "bias" and weight(i)}
    assert want and {int(i): x for i, x in zip(at, w)} == pytest.approx(want) and bias == pytest.approx(weight("bias"))
