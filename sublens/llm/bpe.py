"""BPE encoding and decoding with forced-boundary splitting.

A vocabulary file in the JSON format of the ``tokenizers`` library is read on the worker; its path is a
parameter. From the vocabulary follow the byte pairs that occur inside no token. Between such two bytes
no merge can ever reach across, so a text is cut there, the fragments are encoded independently and the
results are put together. (White space and the borders of the pre-tokenizer's pieces are cuts anyway.)

Fragments of a slice are merged together: one row per fragment in a matrix of symbols, each round merges
the leftmost pair of lowest rank of every row. White-space-free chunks already seen by the worker are
not encoded again; that store is emptied when it holds ``CACHED`` chunks. Nothing is shuffled.

Defined cases: null or empty text has no ids, decodes to the empty text and has the digest of the
empty text. Every row is encoded on its own, so ties and repeated rows need no rule. Fragments longer
than ``WIDE`` symbols are merged one by one with a heap. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sublens.llm.batches import mapped

CACHED = 200_000
WIDE = 64
NONE = np.int32(2**31 - 1)
# The pre-tokenizer's pattern, fixed by the vocabulary file; white space spelled out for code points
# below SIMPLE, where all Unicode versions agree. Texts beyond go through the library's own splitter.
SIMPLE = 0x250
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+")
CHUNKS = regex.compile(r"[^ \t\n\r]+")


def byte_alphabet() -> dict[str, int]:
    """Character of each byte in a byte-level vocabulary: itself if printable, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, self.alphabet = spec["model"], byte_alphabet()
        ids, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.path, self._library = path, None
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.size = max([*ids.values(), *self.special.values()]) + 1
        names = dict.fromkeys(range(self.size), "") | {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        # decoding without a decoder: names joined by spaces
        coded = [names[i].encode() + b" " for i in range(self.size)]
        self.name_bytes = np.frombuffer(b"".join(coded), np.uint8)
        self.name_length = np.array([len(x) for x in coded])
        self.name_start = np.cumsum(self.name_length) - self.name_length
        of_byte = sorted(self.alphabet, key=self.alphabet.get)
        self.inner = np.array([ids[c] for c in of_byte], np.int32)
        self.last = np.array([ids[c + suffix] for c in of_byte], np.int32)
        # pairs that some token holds: between two inner bytes, and before the last byte of a word
        self.joined = np.zeros((2, 256, 256), bool)
        for token in ids:
            ends = bool(suffix) and token.endswith(suffix) and len(token) > len(suffix)
            spelled = [self.alphabet[c] for c in (token[: -len(suffix)] if ends else token) if c in self.alphabet]
            for k, (a, b) in enumerate(zip(spelled, spelled[1:])):
                self.joined[int(ends and k == len(spelled) - 2), a, b] = True
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in merges], np.int64)
        self.made = np.array([ids[a + b] for a, b in merges], np.int32)
        order = np.argsort(keys, kind="stable")
        self.pairs, self.ranks = keys[order], order.astype(np.int32)

    @property
    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._library

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of symbol pairs, NONE where there is none or a symbol is missing (-1)."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where((self.pairs[at] == keys) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def pieces(self, chunk: str) -> list[bytes | int]:
        """UTF-8 of the pre-tokenizer's pieces of a chunk without white space, or ids of special tokens."""
        if self.special_pattern and "<|" in chunk and self.special_pattern.search(chunk):
            parts = [x for x in self.special_pattern.split(chunk) if x]
            return [y for x in parts for y in ([self.special[x]] if x in self.special else self.pieces(x))]
        if max(chunk) < chr(SIMPLE):
            return [x.encode() for x in PIECES.findall(chunk.lower())]
        normal = self.library.normalizer.normalize_str(chunk)
        split = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(self.alphabet[c] for c in piece) for piece, _ in split]

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each word has."""
        sizes = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes)
        final = np.zeros(len(raw), bool)
        final[ends - 1] = True
        symbols = np.where(final, self.last[raw], self.inner[raw])
        cut = np.ones(len(raw), bool)
        cut[1:] = ~self.joined[final[1:].view(np.int8), raw[:-1], raw[1:]]
        cut[ends[:-1]] = True
        start = np.flatnonzero(cut)
        length = np.diff(np.append(start, len(raw)))
        out = np.full(len(raw), -1, np.int32)
        low = 1
        for wide in (1, 4, 8, 16, 32, WIDE):
            rows = np.flatnonzero((length >= low) & (length <= wide))
            low = wide + 1
            if len(rows):
                grid = start[rows][:, None] + np.arange(wide)
                inside = np.arange(wide) < length[rows][:, None]
                matrix = np.where(inside, symbols[np.minimum(grid, len(raw) - 1)], -1)
                out[grid[inside]] = self._rounds(matrix)[inside]
        for k in np.flatnonzero(length > WIDE):
            found = self._one(symbols[start[k] : start[k] + length[k]].tolist())
            out[start[k] : start[k] + len(found)] = found
        kept = out >= 0
        return out[kept], np.add.reduceat(kept, ends - sizes)

    def _rounds(self, matrix: np.ndarray) -> np.ndarray:
        n, wide = matrix.shape
        done = matrix.copy()
        if wide == 1:
            return done
        live, columns = np.arange(n), np.arange(wide)
        rank = self.rank(matrix[:, :-1], matrix[:, 1:])
        while len(live):
            at = rank.argmin(1)
            best = rank[np.arange(len(live)), at]
            more = best < NONE
            done[live[~more]] = matrix[~more]
            live, matrix, rank, at, best = live[more], matrix[more], rank[more], at[more], best[more]
            if not len(live):
                break
            row = np.arange(len(live))
            shift = np.minimum(columns + (columns > at[:, None]), wide - 1)
            matrix = np.take_along_axis(matrix, shift, 1)
            matrix[:, -1] = -1
            matrix[row, at] = self.made[best]
            rank = np.take_along_axis(rank, np.minimum(shift[:, :-1], wide - 2), 1)
            rank[:, -1] = NONE
            right = np.minimum(at, wide - 2)
            rank[row, right] = self.rank(matrix[row, right], matrix[row, right + 1])
            left = np.maximum(at - 1, 0)
            rank[row, left] = self.rank(matrix[row, left], matrix[row, left + 1])
        return done

    def _one(self, symbols: list[int]) -> list[int]:
        n = len(symbols)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        ranks = self.rank(np.array(symbols[:-1]), np.array(symbols[1:]))
        heap = [(int(r), i, symbols[i], symbols[i + 1]) for i, r in enumerate(ranks) if r < NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i], symbols[j], after[i] = int(self.made[r]), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0:
                    rank = int(self.rank(np.array([symbols[x]]), np.array([symbols[y]]))[0])
                    if rank < NONE:
                        heapq.heappush(heap, (rank, x, symbols[x], symbols[y]))
        return [s for s in symbols if s >= 0]


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + length[0] - 1, then the same of 1, and so on."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)


class Encoder:
    """Ids of texts; remembers the chunks it has encoded."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self):
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.start = self.length = np.zeros(0, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        words, owners, special = [], [], []
        for k, chunk in enumerate(chunks):
            for piece in self.vocabulary.pieces(chunk):
                owners.append(k)
                if isinstance(piece, int):
                    special.append((len(words), piece))
                    piece = b"!"  # one id, replaced below
                words.append(piece)
        if words:
            ids, counts = self.vocabulary.merged(words)
            first = np.cumsum(counts) - counts
            for at, token in special:
                ids[first[at]] = token
            per_chunk = np.bincount(owners, counts, len(chunks)).astype(np.int64)
        else:
            ids, per_chunk = np.zeros(0, np.int32), np.zeros(len(chunks), np.int64)
        self.start = np.append(self.start, len(self.ids) + np.cumsum(per_chunk) - per_chunk)
        self.length = np.append(self.length, per_chunk)
        self.ids = np.append(self.ids, ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and n + 1 offsets."""
        split = [CHUNKS.findall(t) if t else [] for t in texts.to_pylist()]
        if len(self.known) > CACHED:
            self._forget()
        known = self.known
        new = list({c for chunks in split for c in chunks if c not in known})
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self._learn(new)
        each = np.fromiter((known[c] for chunks in split for c in chunks), np.int64)
        length = self.length[each]
        ids = self.ids[ranges(self.start[each], length)]
        chunk_ends = np.cumsum([0, *map(len, split)])
        return ids, np.append(0, np.cumsum(length))[chunk_ends]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    )


def decode(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    length = vocabulary.name_length[ids]
    data = vocabulary.name_bytes[ranges(vocabulary.name_start[ids], length)]
    ends = np.append(0, np.cumsum(length))[offsets]
    # the space after the last name of a text goes
    full = np.flatnonzero(np.diff(ends))
    keep = np.ones(len(data), bool)
    keep[ends[full + 1] - 1] = False
    return _strings(data[keep], np.append(0, np.cumsum(np.diff(ends) - (np.diff(ends) > 0))))


ENCODED = {"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType()}


def encoded(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of docs with ``ids`` and the text ``decoded`` from them."""

    def start():
        vocabulary = _vocabulary(path)
        encoder = Encoder(vocabulary)

        def run(texts: pa.Array) -> list:
            ids, offsets = encoder.encode(texts)
            return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)), decode(vocabulary, ids, offsets)]

        return run

    return mapped(docs, ENCODED, start, keep)


_loaded: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    """Read once per Python worker."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digest(docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    return encoded(docs, path or default_path(), list(keep)).select(
        *keep,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def stage(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, and the digests of ids and decoded text."""
    return encoded(docs, path or default_path(), ["doc_id"]).select(
        "doc_id",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
