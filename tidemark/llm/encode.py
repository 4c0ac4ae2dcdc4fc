"""Encoding of texts with a public byte-level BPE vocabulary.

Texts are cut into pieces by the vocabulary's pattern; the distinct pieces of a
batch are merged together as length-bucketed padded matrices: every round, each
row merges its leftmost pair of least rank, looked up in a hash table of pairs,
and rows and columns are compacted. Texts pass through Arrow batches inside the
tasks that read them; nothing is shuffled.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder of the vocabulary files; every executor must have it.
TOKENIZERS = "/opt/tokenizers"
#: How texts are cut into pieces before merging. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_RANK = np.int32(2**31 - 1)
#: Pieces above this many bytes have a matrix of their own.
LONG_PIECE = 512
#: Bytes of pieces whose ids are kept for the next texts.
KEPT_BYTES = 2_000_000


class PairTable:
    """Hash table from a pair of ids to the id of their merge (which is its rank)."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray) -> None:
        self.bits = max(4, int(np.ceil(np.log2(len(merged) * 2 + 2))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NO_RANK, np.int32)
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at, waiting = self._slot(keys), np.arange(len(keys))
        while len(waiting):
            free = self.keys[at[waiting]] < 0
            first = waiting[free]
            _, keep = np.unique(at[first], return_index=True)
            placed = first[keep]
            self.keys[at[placed]], self.values[at[placed]] = keys[placed], merged[placed]
            waiting = np.setdiff1d(waiting, placed, assume_unique=True)
            at[waiting] = (at[waiting] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NO_RANK where there is none (or an id is negative)."""
        keys = (left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)).ravel()
        out = np.full(keys.shape, NO_RANK, np.int32)
        ask = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        at = self._slot(keys[ask])
        while len(ask):
            there = self.keys[at]
            hit = there == keys[ask]
            out[ask[hit]] = self.values[at[hit]]
            go = ~hit & (there >= 0)
            ask, at = ask[go], (at[go] + 1) & ((1 << self.bits) - 1)
        return out.reshape(left.shape)


class Vocabulary:
    """Ranks of a ``.tiktoken`` file (base64 bytes and rank by line) as a pair table."""

    def __init__(self, path: str) -> None:
        import regex

        self.cut = regex.compile(PATTERN).findall
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(path).read_bytes().splitlines() if line)}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() if len(t) > 1 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.pairs = PairTable(*(np.array(x, np.int64) for x in zip(*pairs, strict=True)))
        self.known: dict[str, list[int]] = {}
        self.known_bytes = 0

    def _merge_matrix(self, ids: np.ndarray) -> list[list[int]]:
        """Rows of byte ids, padded with -1, merged until no pair has a rank."""
        done: list[list[int] | None] = [None] * len(ids)
        rows = np.arange(len(ids))
        ranks = self.pairs.lookup(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(1)
            each = np.arange(len(rows))
            best = ranks[each, at]
            over = best == NO_RANK
            if over.any():
                for r, row in zip(rows[over], ids[over], strict=True):
                    done[r] = row[row >= 0].tolist()
                rows, ids, ranks, at, best = rows[~over], ids[~over], ranks[~over], at[~over], best[~over]
                each = np.arange(len(rows))
                if not len(rows):
                    break
            column = np.arange(ids.shape[1] - 1)
            shifted = column[None, :] > at[:, None]
            ids = np.where(shifted, ids[:, 1:], ids[:, :-1])
            ids[each, at] = best
            if ids.shape[1] == 1:
                ids = np.pad(ids, ((0, 0), (0, 1)), constant_values=-1)
            # Only the pairs on either side of a merge have a new rank.
            ranks = np.where(shifted[:, : ranks.shape[1] - 1], ranks[:, 1:], ranks[:, :-1]) if ranks.shape[1] > 1 else ranks
            for side in (at - 1, at):
                ok = (side >= 0) & (side < ranks.shape[1])
                ranks[each[ok], side[ok]] = self.pairs.lookup(ids[each[ok], side[ok]], ids[each[ok], side[ok] + 1])
        return done  # type: ignore[return-value]

    def _merge_long(self, ids: np.ndarray) -> list[int]:
        """The same merges of one long piece.

        Places are kept by the rank of their pair. All places of the least rank
        merge in one round, the leftmost of those that overlap; if that makes a
        pair of lower rank, only the leftmost of all merges. Places are linked, so
        a round costs as much as it merges, not as much as the piece is long.
        """
        n = len(ids)
        ids, after, before = ids.copy(), np.arange(1, n + 1), np.arange(-1, n)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def wait(places: np.ndarray, ranks: np.ndarray) -> None:
            places, ranks = places[ranks != NO_RANK], ranks[ranks != NO_RANK]
            order = np.argsort(ranks, kind="stable")
            cuts = np.flatnonzero(np.diff(ranks[order])) + 1
            for some in np.split(places[order], cuts) if len(order) else []:
                rank = int(self.pairs.lookup(ids[some[:1]], ids[after[some[:1]]])[0])
                if rank not in waiting:
                    waiting[rank] = []
                    heapq.heappush(queue, rank)
                waiting[rank].append(some)

        wait(np.arange(n - 1), self.pairs.lookup(ids[:-1], ids[1:]))
        while queue:
            least = heapq.heappop(queue)
            at = np.unique(np.concatenate(waiting.pop(least)))
            at = at[(ids[at] >= 0) & (after[at] < n)]
            at = at[self.pairs.lookup(ids[at], ids[after[at]]) == least]
            # In a run of overlapping places every second one merges.
            run = np.flatnonzero(np.concatenate([[True], after[at[:-1]] != at[1:]])) if len(at) else at
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(run, append=len(at)))) % 2 == 0]
            for some in (at, at[:1]) if len(at) else ():
                right, first = after[some], ids[some]
                second, beyond = ids[right], after[right]
                ids[some], ids[right], after[some], before[beyond] = least, -1, beyond, some
                left, on = before[some], some[beyond < n]
                left = left[left >= 0]
                ranks = [self.pairs.lookup(ids[x], ids[after[x]]) for x in (left, on)]
                if len(some) == 1 or not any((r < least).any() for r in ranks):
                    break
                before[beyond], after[some], ids[right], ids[some] = right, right, second, first
                wait(at[1:], np.full(len(at) - 1, least))
            else:
                continue
            for x, r in zip((left, on), ranks, strict=True):
                wait(x, r)
        return ids[ids >= 0].tolist()

    def learn(self, pieces: list[str]) -> None:
        """Put the ids of distinct pieces into ``known``."""
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            b = p.encode("utf-8", "replace")
            self.known_bytes += len(b)
            if len(b) > LONG_PIECE:
                self.known[p] = self._merge_long(self.byte_ids[np.frombuffer(b, np.uint8)])
            else:
                by_width.setdefault(max(2, 1 << (len(b) - 1).bit_length()), []).append((p, b))
        for width, some in by_width.items():
            for k in range(0, len(some), 1 << 15):
                part = some[k : k + (1 << 15)]
                sizes = np.array([len(b) for _, b in part])
                ids = np.full((len(part), width), -1, np.int32)
                ids[np.arange(width)[None, :] < sizes[:, None]] = self.byte_ids[np.frombuffer(b"".join(b for _, b in part), np.uint8)]
                self.known.update(zip((p for p, _ in part), self._merge_matrix(ids), strict=True))

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text, a million characters' worth of texts at a time."""
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size < 1_000_000):
                size += len(texts[end])
                end += 1
            cut = [self.cut(t) for t in texts[start:end]]
            if self.known_bytes > KEPT_BYTES:
                self.known.clear()
                self.known_bytes = 0
            self.learn(list({p for c in cut for p in c} - self.known.keys()))
            known = self.known
            for c in cut:
                yield [i for p in c for i in known[p]]
            start = end


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def token_ids(text: Column, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Column:
    """Ids of a text by a public byte-level vocabulary, without special tokens.

    Null and empty texts have no ids (an empty list). Strings of special tokens
    in a text are ordinary text. Any length of text is encoded whole.
    """
    path = f"{folder}/{name}.tiktoken"

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocab = vocabulary(path)
        for batch in batches:
            yield pd.Series(list(vocab.encode(batch.fillna("").tolist())), dtype=object)

    return encode(text)


def token_count(text: Column, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Column:
    """Number of ids of a text; 0 for null and empty texts."""
    path = f"{folder}/{name}.tiktoken"

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocab = vocabulary(path)
        for batch in batches:
            yield pd.Series([len(ids) for ids in vocab.encode(batch.fillna("").tolist())], dtype="int64")

    return count(text)


def encoded(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """key and ids of every row."""
    return df.select(key, token_ids(F.col(text), name, folder).alias("ids"))
