"""Held-out test passages inside training documents.

A leak is a run of `run` consecutive words that item and document share. Items
and documents differ in size by orders of magnitude, which ruins the Jaccard
estimate of a plain MinHash; so both are cut into parts of one size class, all
windows of `run` words. A shared run is then a pair of equal windows, contained
in each other completely, and equal windows have equal MinHash values: the
least hash of the window's word shingles. The items' values are the index. They
are sent to the workers in blocks of bounded size, so a document that meets none
is never moved; where a value is met, the window must hold all the shingles of
an item's window in their order. What is found is joined to the items and
verified word by word, each text for itself.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from humusgrid.llm.forms import canonical_form
from humusgrid.session import cut_lineage

#: Item values of one block, the bound of what is sent to the workers at once; there is one pass over the documents a block.
MOST_SENT = 1_000_000
REMEMBERED = 500_000
SHINGLE = 5
#: A word broken at a line end; the hyphen may be one of several characters.
BROKEN = re.compile("(?<=\\w)[-\u2010\u2011\u00ac\u00ad][ \\t]*\r?\n[ \\t]*(?=\\w)")
INNER_HYPHEN = re.compile("[-\u2010\u2011]")


def word_key(token: str) -> str:
    """A word as it is compared: its canonical form without surrounding punctuation and hyphens within."""
    s = canonical_form(token)
    start, end = 0, len(s)
    while start < end and not _inner(s[start]):
        start += 1
    while end > start and not _inner(s[end - 1]):
        end -= 1
    return INNER_HYPHEN.sub("", s[start:end])


def _inner(ch: str) -> bool:
    return ch.isalnum() or unicodedata.category(ch)[0] in "LMN"


class WordHashes(dict):
    """Token -> 64-bit hash of its key; 0 for what is no word."""

    def __missing__(self, token: str) -> int:
        key = word_key(token)
        got = (xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass")) | 1) if key else 0
        if len(self) >= REMEMBERED:
            self.clear()
        if len(token) <= 64:
            self[token] = got
        return got

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the words of a text, broken ones joined."""
        if not text:
            return np.empty(0, np.uint64)
        if "\n" in text:
            text = BROKEN.sub("", text)
        tokens = text.split()
        out = np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))
        return out[out != 0]


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of each run of SHINGLE words, in place of its first."""
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(SHINGLE):
            h = h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_minima(words: np.ndarray, run: int) -> np.ndarray:
    """MinHash value of every window of `run` words."""
    h = shingle_hashes(words)
    width = run - SHINGLE + 1
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    span, out = 1, h
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if span < width:
        out = np.minimum(out[: len(out) - (width - span)], out[width - span :])
    return out[:n]


def window_shingles(words: np.ndarray, at: np.ndarray, run: int) -> np.ndarray:
    """One number for all shingles, in their order, of the windows that begin at the given words."""
    h = shingle_hashes(words)
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(run - SHINGLE + 1):
            out = (out ^ h[at + i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
    return out


def longest_shared_run(doc: np.ndarray, item: np.ndarray, run: int) -> int:
    """Longest run of words that stands in both, where it has at least `run` words; else 0.

    The document's shingles are looked up in the item's; only stretches of
    enough contained shingles in a row are compared word by word.
    """
    inside = np.isin(shingle_hashes(doc), shingle_hashes(item))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    best = 0
    for start, end in zip(edge[::2], edge[1::2]):
        if end - start >= run - SHINGLE + 1:
            row = np.zeros(len(item) + 1, np.int32)
            for w in doc[start : end + SHINGLE - 1]:
                row[1:] = np.where(item == w, row[:-1] + 1, 0)
                best = max(best, int(row.max()))
    return best if best >= run else 0


def _windows(df: DataFrame, id_col: str, text_col: str, run: int, wanted: Broadcast | None) -> DataFrame:
    """(id, text_key, words, windows): texts with windows, where wanted is given with windows of an item.

    windows holds (value, shingles) of the distinct windows. wanted: (values in
    order, shingles in order) of the items' windows.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def one_way(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            words = [hashes.of(t) for t in batch.column(2).to_pylist()]
            if not words:
                continue
            size = np.fromiter(map(len, words), np.int64, len(words))
            end = np.cumsum(size)
            together = np.concatenate(words)
            mins = window_minima(together, run)
            # windows that reach into the next text do not count
            owner = np.repeat(np.arange(len(words)), size)[: len(mins)]
            good = np.arange(len(mins)) + run <= end[owner]
            if wanted is not None:
                values, shingles = wanted.value
                good &= _among(mins, values)
            at = np.flatnonzero(good)
            own = window_shingles(together, at, run)
            if wanted is not None:
                held = _among(own, shingles)
                at, own = at[held], own[held]
            if not len(at):
                continue
            rows = owner[at]
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            kept = pa.array(rows[first])
            lists = [np.unique(np.stack((m, w), axis=1), axis=0) for m, w in zip(np.split(mins[at], first[1:]), np.split(own, first[1:]))]
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32))
            pair = np.concatenate(lists).view(np.int64)
            windows = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["value", "shingles"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(kept), batch.column(1).take(kept), pa.array([words[k].view(np.int64) for k in rows[first]], pa.list_(pa.int64())), windows],
                names=["id", "text_key", "words", "windows"],
            )

    texts = df.select(id_col, F.xxhash64(text_col).alias("text_key"), text_col)
    return texts.mapInArrow(one_way, f"id {kind}, text_key bigint, words array<bigint>, windows array<struct<value:bigint,shingles:bigint>>")


def _among(found: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(found), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, found), len(sorted_values) - 1)] == found


def leaked_items(documents: DataFrame, items: DataFrame, doc_id: str, item_id: str, text_col: str = "text", run: int = 15, most_sent: int = MOST_SENT) -> DataFrame:
    """Documents that repeat at least `run` consecutive words of an item: (doc_id, item_id, words).

    words is the length of the longest shared run. Words are compared without
    letter case and surrounding punctuation and by their look; words broken over
    lines are whole; tokens without letter or digit are no words.

    Defined results: null, blank and shorter texts leak nothing; repeated
    documents each have their own row, rows of one id have one row for each item
    that any of their texts leaks; several items with the same text are all
    named; empty tables give no rows; only the named columns are read.
    """
    if run < SHINGLE:
        raise ValueError(f"run must be at least {SHINGLE}")
    spark = documents.sparkSession
    index = cut_lineage(_windows(items, item_id, text_col, run, None).distinct(), "items")
    posted = index.select(F.col("id").alias("item"), F.col("text_key").alias("item_key"), F.explode("windows").alias("window"))
    values = posted.select("window").distinct()
    blocks = max(1, -(-values.count() // most_sent))
    found = None
    for b in range(blocks):
        own = values if blocks == 1 else values.filter(F.pmod("window.value", F.lit(blocks)) == b)
        held = own.select("window.value", "window.shingles").toArrow()  # about most_sent rows
        sorted_ = tuple(np.unique(held.column(c).to_numpy().view(np.uint64)) for c in ("value", "shingles"))
        part = _windows(documents, doc_id, text_col, run, spark.sparkContext.broadcast(sorted_))
        found = part if found is None else found.unionByName(part)
    # texts with a window of an item: few, so that their words are written once and moved only where they are verified
    docs = cut_lineage(found.select(F.col("id").alias("doc"), F.col("text_key").alias("doc_key"), F.col("words").alias("doc_words"), "windows"), "leaks")
    hits = docs.select("doc", "doc_key", F.explode("windows").alias("window"))
    pairs = hits.join(posted, "window").select("doc", "doc_key", "item", "item_key").distinct()
    texts = docs.select("doc", "doc_key", "doc_words").distinct().withColumnsRenamed({"doc": "d", "doc_key": "dk"})
    passages = index.select(F.col("id").alias("i"), F.col("text_key").alias("ik"), F.col("words").alias("item_words"))
    worded = pairs.join(texts, F.col("doc").eqNullSafe(F.col("d")) & (F.col("doc_key") == F.col("dk"))).join(passages, F.col("item").eqNullSafe(F.col("i")) & (F.col("item_key") == F.col("ik")))

    def _words(cell: pa.ListScalar) -> np.ndarray:
        return np.asarray(cell.values).view(np.uint64)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [longest_shared_run(_words(d), _words(i), run) for d, i in zip(batch.column(2), batch.column(3))]
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best, pa.int32())], names=[doc_id, item_id, "words"])
            yield out.filter(pc.greater(out.column(2), 0))

    kinds = f"`{doc_id}` {documents.schema[doc_id].dataType.simpleString()}, `{item_id}` {items.schema[item_id].dataType.simpleString()}, words int"
    verified = worded.select("doc", "item", "doc_words", "item_words").mapInArrow(verify, kinds)
    return verified.groupBy(doc_id, item_id).agg(F.max("words").alias("words"))
