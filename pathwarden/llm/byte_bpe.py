"""Byte-level BPE by replaying the merges over a corpus of words, and decoding.

A batch of texts is one corpus: its distinct words lie in one array of tokens, and an inverted index lists, for each
merged token, the places whose pair makes it. Merges are applied in rank order; each touches its places and their
neighbours only. Words repeat, so a corpus of many texts costs little more than its vocabulary, and a word of any length
costs n log n.

Edge cases: a null text is an empty one and gives no ids. Repeated rows are encoded one by one. An empty table gives an
empty result. Whole texts are encoded, whatever their length. Other columns stay; only those named like a result are replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwarden.llm.packing import free_name

#: Memory of a task: characters of text encoded at once, and words remembered between batches. Neither changes ids.
BATCH_CHARS = 8_000_000
KNOWN_WORDS = 400_000
#: Fewer places than this are merged one by one, which is then faster.
FEW = 24


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their rank, from a file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Coder:
    """Encodes and decodes with one table of ranks and one pattern of words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.words = regex.compile(pattern)
        self.made: dict[int, int] = {}
        self.known: dict[str, tuple[int, ...]] = {}

    def rank_of(self, left: int, right: int) -> int:
        """The rank of the token that a pair makes, or -1. Negative tokens stand for word ends and make none."""
        if left < 0 or right < 0:
            return -1
        pair = left << 32 | right
        rank = self.made.get(pair)
        if rank is None:
            if len(self.made) >= KNOWN_WORDS:
                self.made.clear()
            rank = self.made[pair] = self.ranks.get(self.bytes_of[left] + self.bytes_of[right], -1)
        return rank

    def ranks_of(self, pairs: np.ndarray) -> np.ndarray:
        """The rank that each pair (left << 32 | right) makes, or -1; each distinct pair is looked up once."""
        distinct, which = np.unique(pairs, return_inverse=True)
        found = [self.rank_of(pair >> 32, pair & 0xFFFFFFFF) for pair in distinct.tolist()]
        return np.array(found, np.int64)[which]

    def replay(self, words: list[str]) -> list[tuple[int, ...]]:
        """The ids of each word. One pass over the merges, for all words together."""
        if not words:
            return []
        coded = [word.encode() for word in words]
        lengths = np.array([len(c) + 1 for c in coded], np.int64)
        ends = np.cumsum(lengths)
        word_of = np.repeat(np.arange(len(words)), lengths)
        # A word ends with -1, which makes no pair; -2 is a place that became part of the token before it.
        token = np.array(self.single, np.int64)[np.frombuffer(b"\0".join(coded) + b"\0", np.uint8)]
        token[ends - 1] = -1
        after = np.arange(1, len(token) + 1)
        before = np.arange(-1, len(token) - 1)
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def put(places: np.ndarray, ranks: np.ndarray) -> None:
            """Enter places under the rank of their pair, in order of place."""
            made = ranks >= 0
            places, ranks = places[made], ranks[made]
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            bounds = [0, *cuts.tolist(), len(ranks)]
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                if low < high:
                    put_one(places[low:high], int(ranks[low]))

        def put_one(places, rank: int) -> None:
            if rank in index:
                index[rank].append(places)
            else:
                index[rank] = [places]
                heappush(queue, rank)

        def one_by_one(places: list[int], rank: int) -> None:
            """Merge places from left to right. A word in which a lower rank came up waits until that one is done."""
            wait_until = -1
            for place in places:
                if place < wait_until:
                    put_one([place], rank)
                    continue
                gone = int(after[place])
                if token[place] < 0 or self.rank_of(int(token[place]), int(token[gone])) != rank:
                    continue
                token[place], token[gone] = rank, -2
                following = int(after[gone])
                after[place], before[following] = following, place
                prev = int(before[place])
                right, left = self.rank_of(rank, int(token[following])), self.rank_of(int(token[prev]) if prev >= 0 else -1, rank)
                for at, new in ((place, right), (prev, left)):
                    if new >= 0:
                        put_one([at], new)
                        if new < rank:
                            wait_until = int(ends[word_of[place]])

        inside = np.flatnonzero((token[:-1] >= 0) & (token[1:] >= 0))
        put(inside, self.ranks_of(token[inside] << 32 | token[inside + 1]))
        while queue:
            rank = heappop(queue)
            places = np.unique(np.concatenate(index.pop(rank)).astype(np.int64))
            if len(places) < FEW:
                one_by_one(places.tolist(), rank)
                continue
            # Words with one such place are merged at once; in the others the order of places counts.
            places = places[token[places] >= 0]
            places = places[token[after[places]] >= 0]
            pairs = token[places] << 32 | token[after[places]]
            places = places[self.ranks_of(pairs) == rank]
            owner = word_of[places]
            same = owner[1:] == owner[:-1]
            alone = np.ones(len(places), bool)
            alone[1:] &= ~same
            alone[:-1] &= ~same
            many, places = places[~alone], places[alone]
            gone = after[places]
            following = after[gone]
            token[places], token[gone] = rank, -2
            after[places], before[following] = following, places
            to_right = places[token[following] >= 0]
            prev = before[places]
            to_left = prev[(prev >= 0) & (token[prev] >= 0)]
            put(to_right, self.ranks_of(rank << 32 | token[after[to_right]]))
            put(to_left, self.ranks_of(token[to_left] << 32 | rank))
            one_by_one(many.tolist(), rank)
        kept = token >= 0
        begins = np.concatenate([[0], np.cumsum(kept)]).tolist()
        ids = token[kept].tolist()
        return [tuple(ids[begins[end - size] : begins[end]]) for end, size in zip(ends.tolist(), lengths.tolist(), strict=True)]

    def learn(self, words: set[str]) -> None:
        """Remember the ids of new words. A word that is a token keeps its rank; the others are merged."""
        open_words = []
        for word in words:
            rank = self.ranks.get(word.encode())
            if rank is None:
                open_words.append(word)
            else:
                self.known[word] = (rank,)
        self.known.update(zip(open_words, self.replay(open_words), strict=True))

    def split(self, texts: list[str]) -> list[list[str]]:
        """The words of each text, all of them known from then on."""
        split = [self.words.findall(text) for text in texts]
        new = set(chain.from_iterable(split))
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known = {}
        self.learn(new.difference(self.known))
        return split

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text."""
        for words in self.split(texts):
            yield list(chain.from_iterable(map(self.known.__getitem__, words)))

    def digests(self, texts: list[str], with_ids: bool = False) -> Iterator[dict]:
        """For each text the number of ids, the digest of the ids and that of the bytes they decode to; and the ids, if wanted.

        A word's ids are spelled out and decoded once a batch, not once a place.
        """
        split = self.split(texts)
        used = set(chain.from_iterable(split))
        spelled = {word: " ".join(map(str, self.known[word])) for word in used}
        decoded = {word: self.decode(self.known[word]) for word in used}
        for words in split:
            ids = " ".join(map(spelled.__getitem__, words))
            row = {
                "n_tokens": ids.count(" ") + 1 if ids else 0,
                "ids_sha256": hashlib.sha256(ids.encode()).hexdigest(),
                "decoded_sha256": hashlib.sha256(b"".join(map(decoded.__getitem__, words))).hexdigest(),
            }
            if with_ids:
                row["ids"] = list(chain.from_iterable(map(self.known.__getitem__, words)))
            yield row

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def in_batches(texts: list[str], most: int = BATCH_CHARS) -> Iterator[list[str]]:
    batch, size = [], 0
    for text in texts:
        batch.append(text)
        size += len(text)
        if size >= most:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def _per_text(ranks: dict[bytes, int], pattern: str, kind: str, of_type: pa.DataType, rows_of):
    """A UDF over a text column that gives `rows_of(coder, texts)`, with one coder for a task."""

    @F.arrow_udf(kind)
    def coded(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Coder(ranks, pattern)
        for part in parts:
            texts = [t.as_py() or "" for t in part]
            yield pa.array([row for batch in in_batches(texts) for row in rows_of(coder, batch)], of_type)

    return coded


def encode_column(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", to: str = "ids") -> DataFrame:
    """Add the ids of each text as an array."""
    return docs.withColumn(to, _per_text(ranks, pattern, "array<int>", pa.list_(pa.int32()), Coder.encode)(F.col(text)))


def decode_column(rows: DataFrame, ranks: dict[bytes, int], ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Add the bytes that an array of ids stands for (binary; an id sequence may be no valid text)."""
    bytes_of = {rank: token for token, rank in ranks.items()}

    @F.arrow_udf("binary")
    def decoded(arrays: pa.Array) -> pa.Array:
        return pa.array([None if a.as_py() is None else b"".join(map(bytes_of.__getitem__, a.as_py())) for a in arrays], pa.binary())

    return rows.withColumn(to, decoded(F.col(ids)))


def digest_columns(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", with_ids: bool = False) -> DataFrame:
    """Add n_tokens, ids_sha256 and decoded_sha256: what was encoded and what its ids decode to; and the ids, if wanted."""
    fields = {"n_tokens": ("bigint", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}
    if with_ids:
        fields["ids"] = ("array<int>", pa.list_(pa.int32()))
    kind = f"struct<{', '.join(f'{name}: {ddl}' for name, (ddl, _) in fields.items())}>"
    of_type = pa.struct([(name, arrow) for name, (_, arrow) in fields.items()])
    udf = _per_text(ranks, pattern, kind, of_type, lambda coder, texts: coder.digests(texts, with_ids))
    name = free_name(docs.columns, "_coded")
    return docs.withColumn(name, udf(F.col(text))).withColumns({f: F.col(f"{name}.{f}") for f in fields}).drop(name)
