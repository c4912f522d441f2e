"""Byte-pair encoding of a whole corpus by the merge ranks of a public tokenizer.

The text is cut by the tokenizer's pattern; each piece is merged with a
priority queue of merge ranks over a doubly linked list of symbols, skipping
queue entries whose symbols have changed since. Pieces recur, so each worker
keeps the ids of pieces it has seen; the memory of that is bounded and refilled
from nothing, which changes no result.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

#: Pieces a worker remembers at once.
REMEMBERED = 400_000
#: Vocabulary files larger than this are refused: they are sent to every executor.
MOST_VOCABULARY_BYTES = 64_000_000
# Fixed value: the pattern whose cuts are known to fall where encode() looks for them; texts of others are cut by the pattern itself.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Vocabulary file of base64 strings and ranks -> string -> id."""
    return {base64.b64decode(s): int(n) for s, n in (line.split() for line in raw.splitlines() if line)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: always the lowest rank first, of equal ones the leftmost."""
    n = len(piece)
    symbol: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    queue = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            queue.append((rank, i, piece[i : i + 2]))
    heapq.heapify(queue)
    while queue:
        rank, i, joined = heapq.heappop(queue)
        left = symbol[i]
        j = after[i]
        if left is None or j >= n or left + symbol[j] != joined:
            continue  # stale: one of the two has been merged since
        symbol[i], symbol[j] = joined, None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            rank = ranks.get(joined + symbol[k])
            if rank is not None:
                heapq.heappush(queue, (rank, i, joined + symbol[k]))
        if (h := before[i]) >= 0:
            rank = ranks.get(symbol[h] + joined)
            if rank is not None:
                heapq.heappush(queue, (rank, h, symbol[h] + joined))
    return [ranks[s] for s in symbol if s is not None]


class Encoder:
    """Encoder of one worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.ranks, self.cut = ranks, regex.compile(pattern)
        self.by_words = pattern == WORD_PATTERN
        # runs of blanks other than the single space between two words
        self.uneven = regex.compile(r"(\s\s+|[^\S ])")
        self.first, self.later = _Memory(self, ""), _Memory(self, " ")

    def pieces(self, text: str) -> bytes:
        """Ids as 32-bit integers of a text cut by the pattern."""
        ids: list[int] = []
        for m in self.cut.finditer(text):
            ids += merge_piece(m[0].encode("utf-8", "surrogatepass"), self.ranks)
        return np.array(ids, np.int32).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_words:
            return self.pieces(text)
        # The pattern cuts before a space between two characters that are not blank. Of a longer run it cuts off
        # all but the last blank, and that one too unless it is the space which goes with the next word.
        parts: list[bytes] = []
        words = self.first
        pieces = self.uneven.split(text)
        for k, piece in enumerate(pieces):
            if k % 2 == 0:
                if piece:
                    head, *rest = piece.split(" ")
                    parts.append(words[head])
                    parts += map(self.later.__getitem__, rest)
                continue
            if k == len(pieces) - 2 and not pieces[k + 1]:
                parts.append(self.first[piece])
            elif piece[-1] == " ":
                parts.append(self.first[piece[:-1]])
                words = self.later
            else:
                parts += (self.first[piece[:-1]], self.first[piece[-1]])
                words = self.first
        return b"".join(parts)


class _Memory(dict):
    """Chunk -> ids, with the given text before each chunk."""

    def __init__(self, encoder: Encoder, before: str) -> None:
        super().__init__()
        self.encoder, self.before = encoder, before

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        got = self.encoder.pieces(self.before + chunk)
        if len(chunk) <= 64:
            self[chunk] = got
        return got


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        raw = f.read(MOST_VOCABULARY_BYTES + 1)
    if len(raw) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MOST_VOCABULARY_BYTES} bytes")
    return raw


def encode_corpus(df: DataFrame, id_col: str, text_col: str, vocabulary: str, pattern: str) -> DataFrame:
    """Token ids of every row's text: (id_col, ids array<int>).

    vocabulary: path of a file of base64 strings and ranks on the driver, from
    where it is broadcast (its size is checked). No special tokens are added and
    their strings are ordinary text.

    Defined results: null and empty texts give an empty list; repeated rows and
    ids come out as often as they stand; very long texts are worked whole; an
    empty table gives no rows; other columns are not read. No shuffle.
    """
    spark: SparkSession = df.sparkSession
    sent = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(read_ranks(sent.value), pattern)
        for batch in batches:
            # as few rows at a time as keep the ids of long texts below the list's 32-bit offsets
            parts = [encoder.encode(t) if t else b"" for t in batch.column(1).to_pylist()]
            start = 0
            while start < len(parts):
                stop, size = start, 0
                while stop < len(parts) and (stop == start or size + len(parts[stop]) < 1 << 27):
                    size += len(parts[stop])
                    stop += 1
                lengths = np.fromiter(map(len, parts[start:stop]), np.int64, stop - start) // 4
                offsets = np.zeros(len(lengths) + 1, np.int32)
                np.cumsum(lengths, out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(parts[start:stop]), np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.ListArray.from_arrays(pa.array(offsets), values)], names=[id_col, "ids"])
                start = stop

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode_corpus(df: DataFrame, id_col: str, ids_col: str, vocabulary: str) -> DataFrame:
    """Texts of token ids, by concatenating vocabulary strings: (id_col, text).

    Null ids give null, an empty list the empty text; an unknown id raises.
    """
    sent = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = {n: s for s, n in read_ranks(sent.value).items()}
        for batch in batches:
            texts = [None if ids is None else b"".join(map(strings.__getitem__, ids)).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")
