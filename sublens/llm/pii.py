"""Personal data: fixed patterns, and weak supervision for what they leave.

E-mail addresses, IP addresses, card and phone numbers of the fixed patterns are always reported.
Wider patterns give candidates for more: secrets, numbers of persons, names after a title, masked e-mail
addresses. Labelers vote on each candidate, yes, no or not at all: the strict form of its kind (regex),
a list of cue words before it (gazetteer), what stands around it (context), and its mix of characters.
Expectation-maximisation over the counted vote patterns estimates how reliable each labeler is and how
likely each pattern is personal data; a logistic classifier of the votes and the length, trained on these
soft labels, decides on spans.

Text is read once, by SQL functions; spans and candidates are stored. Vote patterns are counted with
pre-aggregation; there are at most ``PATTERNS`` of them, whatever the input, and only they reach the
driver, where the two small fits run. Decisions go back as one array indexed by the pattern. Nothing
else is shuffled.

Defined cases: null text is empty and has no spans. Added spans that overlap a fixed one are dropped, and
candidates do not overlap each other, so there are no ties but equal starts, which sort by kind.
Repeated rows get equal spans. Without candidates there is nothing to learn or add. An empty table gives
an empty result. Positions count code points from 0; ends are exclusive.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.llm.scratch import written

# Fixed patterns of the contract. A leading "last match or no such character before" keeps a long run
# from being tried from each of its characters; it changes no leftmost match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"(?:\G|(?<![0-9]))[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
ADDED = ("secret", "number", "name", "masked_email")
RANK = {kind: i for i, kind in enumerate([*BASE, *ADDED])}

_TITLE = r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame)"
_AT, _DOT = r"\x20?[\[(]\x20?at\x20?[\])]\x20?", r"\x20?[\[(]\x20?dot\x20?[\])]\x20?"
# Widest forms, tried in this order at every place.
WIDE = {
    "secret": r"\b(?i:password|passwd|pwd|token|secret|api[_-]?key)\x20?[=:]\x20?\"?[A-Za-z0-9+/_.-]{6,200}\"?",
    "masked_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}" + _AT + r"[A-Za-z0-9-]{1,64}" + _DOT + r"[A-Za-z0-9-]{1,64}",
    "name": r"\b" + _TITLE + r"\.?\x20\p{Lu}\p{Ll}{1,40}(?:\x20\p{Lu}\p{Ll}{1,40})?",
    "number": r"(?<![0-9A-Za-z.+-])\(?[0-9](?:[().\x20-]{0,2}[0-9]){6,17}(?![0-9A-Za-z])",
}
STRICT = {
    "secret": r"^.{2,12}\x20?[=:]\x20?\"?(?=[^\"]*[0-9])[A-Za-z0-9+/_-]{12,}\"?$",
    "masked_email": r"^[A-Za-z][A-Za-z0-9._%+-]+" + _AT + r"[A-Za-z][A-Za-z0-9-]+" + _DOT + r"[A-Za-z]{2,}$",
    "name": r"^\p{L}+\.?\x20\p{Lu}\p{Ll}{2,}\x20\p{Lu}\p{Ll}{2,}$",
    "number": r"^(?:\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4})$",
}
# Gazetteer of cue words, by kind.
CUES = {
    "secret": ("password", "passwd", "token", "secret", "key", "login"),
    "masked_email": ("mail", "contact", "write", "kontakt", "correo"),
    "name": ("name", "signed", "contact", "dear", "sincerely"),
    "number": ("phone", "tel", "call", "mobile", "fax", "ssn", "social security", "telefon", "móvil"),
}
NEAR = 32
VOTES = 4
LENGTHS = (12, 20, 32)
PATTERNS = len(ADDED) * 3**VOTES * (len(LENGTHS) + 1)
ACCEPT = 0.5


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match>> of all matches: lengths of gaps and matches, added up."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(done: Column, pair: Column) -> Column:
        first = done["at"] + F.char_length(pair["gap"])
        last = first + F.char_length(pair["match"])
        span = F.struct(first.alias("start"), last.alias("end"), pair["match"].alias("match"))
        return F.struct(last.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    # the gap after the last match has no partner
    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("match")), lambda p: p["match"].isNotNull())
    return F.aggregate(pairs, start, step)["out"]


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.char_length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        digits = _digits(match)
        return F.when(F.char_length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(_digits(match)).between(10, 15)
    return F.lit(True)


def _span(kind: str, x: Column) -> Column:
    return F.struct(
        x["start"].alias("start"), F.lit(RANK[kind]).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end")
    )


def _valid_spans(kind: str, matches: Column) -> Column:
    return F.transform(F.filter(matches, lambda x: _valid(kind, x["match"])), lambda x: _span(kind, x))


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint")


# A character that every match holds: texts without it are not searched.
_NEEDS = {"email": "@", "phone": "+", "ip": None, "card": None}


def base_spans(text: Column) -> Column:
    """array<struct<start, rank, kind, end>> of the fixed patterns, by start, then kind as listed."""
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    lists = []
    for kind, pattern in BASE.items():
        spans = _valid_spans(kind, located(text, pattern))
        sign = _NEEDS[kind]
        there = F.contains(text, F.lit(sign)) if sign else text.rlike("[0-9]")
        lists.append(F.when(there, spans).otherwise(none))
    return F.sort_array(F.concat(*lists))


def _vote(yes: Column, no: Column) -> Column:
    """2 yes, 1 no, 0 neither."""
    return F.when(yes, F.lit(2)).when(no, F.lit(1)).otherwise(F.lit(0))


def _kind_of(match: Column) -> Column:
    kinds = F.lit(ADDED.index("number"))
    for kind in ("name", "masked_email", "secret"):
        kinds = F.when(match.rlike("^(?:" + WIDE[kind] + ")$"), F.lit(ADDED.index(kind))).otherwise(kinds)
    return kinds


def _pattern(text: Column, x: Column, kind: Column) -> Column:
    """Kind, votes and length class of a candidate as one number below PATTERNS."""
    match = x["match"]
    before = F.lower(F.substr(text, F.greatest(x["start"] - NEAR + 1, F.lit(1)), F.least(x["start"], F.lit(NEAR))))
    after = F.substr(text, x["end"] + 1, F.lit(1))
    pick = lambda by_kind: F.get(F.array(*[by_kind[k] for k in ADDED]), kind)
    strict = pick({k: match.rlike(STRICT[k]) for k in ADDED})
    cue = pick({k: before.rlike("|".join(CUES[k])) for k in ADDED})
    digits, n = F.char_length(_digits(match)), F.char_length(match)
    votes = [
        _vote(strict, ~strict),
        _vote(cue, F.lit(False)),
        _vote(after.rlike(r"^[\s.,;)]?$"), before.rlike(r"[#|*$%]\s*$") | after.rlike(r"^[=/_%]$")),
        _vote(
            pick({"secret": digits >= 4, "number": digits.between(9, 12), "name": digits == 0, "masked_email": digits <= 6}),
            pick({"secret": digits == 0, "number": digits < 8, "name": n < 6, "masked_email": n > 80}),
        ),
    ]
    code = kind
    for vote in votes:
        code = code * 3 + vote
    size = sum((n > limit).cast("int") for limit in LENGTHS)
    return code * (len(LENGTHS) + 1) + size


def found(docs: DataFrame) -> DataFrame:
    """doc_id, base spans, and candidates array<struct<start, end, kind, pattern>> that touch none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text_")).withColumn("base", base_spans(F.col("text_")))
    wide = "|".join(WIDE[k] for k in ("secret", "masked_email", "name", "number"))
    free = F.filter(
        located(F.col("text_"), wide),
        lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )
    named = rows.withColumn("free", free).withColumn(
        "free", F.transform("free", lambda x: F.struct(x["start"], x["end"], x["match"], _kind_of(x["match"]).alias("kind")))
    )
    return named.select(
        "doc_id",
        "base",
        F.transform(
            "free",
            lambda x: F.struct(
                x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"),
                _pattern(F.col("text_"), x, x["kind"]).alias("pattern"),
            ),
        ).alias("candidates"),
    )


def _unpacked(pattern: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    code, size = np.divmod(pattern, len(LENGTHS) + 1)
    votes = []
    for _ in range(VOTES):
        code, vote = np.divmod(code, 3)
        votes.append(vote)
    return code, np.stack(votes[::-1], 1), size


def reliabilities(votes: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """EM on votes of 0 (none), 1 (no), 2 (yes): each pattern's probability of being true, and each
    labeler's chance of each vote given the truth, table [truth, labeler, vote]."""
    true = np.clip(0.5 + 0.2 * ((votes == 2).sum(1) - (votes == 1).sum(1)), 0.05, 0.95)
    for _ in range(rounds):
        table = np.zeros((2, VOTES, 3))
        for truth, share in enumerate((1 - true, true)):
            for labeler in range(VOTES):
                # two imagined votes each, right ones more often, keep the classes from changing places
                prior = np.array([1.0, 0.5 + (truth == 0), 0.5 + (truth == 1)])
                sums = np.bincount(votes[:, labeler], share * weight, 3) + prior
                table[truth, labeler] = sums / sums.sum()
        prior = np.clip((true * weight).sum() / weight.sum(), 0.01, 0.99)
        logs = [np.log(p) + sum(np.log(table[t, k, votes[:, k]]) for k in range(VOTES)) for t, p in ((0, 1 - prior), (1, prior))]
        true = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -35, 35)))
    return true, table


def classifier(features: np.ndarray, soft: np.ndarray, weight: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Logistic regression on soft labels, by gradient steps scaled per coordinate."""
    w, total = np.zeros(features.shape[1]), weight.sum()
    squares = np.full(features.shape[1], 1e-8)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -35, 35)))
        gradient = features.T @ ((p - soft) * weight) / total + 1e-4 * w
        squares += gradient**2
        w -= 0.5 * gradient / np.sqrt(squares)
    return w


def span_scores(counts: list[tuple[int, int]]) -> list[float]:
    """Probability of every pattern from the counts of those that occur."""
    every = np.arange(PATTERNS)
    if not counts:
        return [0.0] * PATTERNS
    seen, weight = np.array([c[0] for c in counts]), np.array([c[1] for c in counts], float)
    kind, votes, size = _unpacked(every)
    features = np.concatenate(
        [np.ones((PATTERNS, 1)), np.eye(len(ADDED))[kind], *[np.eye(3)[votes[:, k]] for k in range(VOTES)], np.eye(len(LENGTHS) + 1)[size]], 1
    )
    soft = np.zeros(len(seen))
    for k in range(len(ADDED)):
        own = kind[seen] == k
        if own.any():
            soft[own] = reliabilities(votes[seen][own], weight[own])[0]
    w = classifier(features[seen], soft, weight)
    return (1 / (1 + np.exp(-np.clip(features @ w, -35, 35)))).tolist()


def personal_data(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """doc_id, base and spans: arrays of (start, rank, kind, end), spans being base and what was added."""
    stored = written(found(docs), "pii-spans")
    counts = (
        stored.select(F.explode("candidates").alias("c")).groupBy("c.pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern")
    )
    scores = F.lit(span_scores([tuple(r) for r in counts.collect()]))  # at most PATTERNS rows
    kinds = F.array(*[F.lit(k) for k in ADDED])
    added = F.transform(
        F.filter("candidates", lambda x: F.get(scores, x["pattern"]) >= accept),
        lambda x: F.struct(
            x["start"].alias("start"), (x["kind"] + len(BASE)).alias("rank"), F.get(kinds, x["kind"]).alias("kind"), x["end"].alias("end")
        ),
    )
    return stored.select("doc_id", "base", F.sort_array(F.concat("base", added)).alias("spans"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    rows = personal_data(docs.select("doc_id", "text"))
    return rows.select(
        "doc_id",
        *[_count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )
