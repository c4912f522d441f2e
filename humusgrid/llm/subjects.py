"""Subject areas of documents by latent Dirichlet topics.

The topic model is fitted over the paragraphs of all documents, without labels:
each pass is a distributed E-step (every partition infers the topic proportions
of its paragraphs and sums expected word counts) and an M-step that adds the
sums, combined in rounds of bounded size. There are several topics for each
subject. The fitted topics are then mapped to subjects by their top terms: where
these terms stand in labelled documents, the labels say what they speak of. A
document gets a subject where the topics of that subject lead the proportions of
one of its paragraphs.

Bounds, all of them parameters: the paragraphs that start the topics (SEEDS), the
labelled documents that the terms are looked up in (LABELLED), and the frequency
from which a word is learnt (RARE, RATE), which bounds the model, topics times
words, that is sent to the workers.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from humusgrid.llm.leaks import word_key
from humusgrid.session import cut_lineage

#: Labelled documents in which the topics' terms are looked up, at most; taken by the hash of their id.
LABELLED = 20_000
#: Paragraphs that start the topics, at most, and the known words that such a paragraph has at least.
SEEDS, SEED_WORDS = 6_000, 8
#: Features by which the starting paragraphs are compared: words by hash, so that their number is fixed.
FEATURES = 2048
#: Words that make up more than this share of all words tell no subject.
COMMON = 0.003
#: Words rarer than this many uses, or than this share of all words, are not learnt from; so there are at most 1 / RATE words.
RARE, RATE = 3, 1e-6
#: Topics of each subject, and topics more for what belongs to no subject.
TOPICS, BACKGROUND = 4, 14
PASSES, INNER, INNER_LAST = 3, 3, 6
ALPHA, ETA = 0.1, 0.01
TOP_TERMS = 40
#: Uses of a topic's top terms in one labelled document that count, at most, and the uses over all that a topic needs to be judged by labels.
USES, SUPPORT = 20.0, 2.0
#: Share of a topic's top-term uses that stand in documents of its subject.
AGREE = 0.5
#: A paragraph has a subject from this share of its known words, and this many of them.
SHARE, EVIDENCE = 0.3, 3.0
#: Words of one block of sums, and partial sums added by one task.
BLOCK, FAN = 512, 32
REMEMBERED = 400_000
#: Words whose topic shares are summed at once.
TOGETHER = 16_384
PARAGRAPH = re.compile(r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)\s*")
LINE = re.compile(r"\r\n|\r|\n")


def paragraphs(text: str | None) -> list[str]:
    """Paragraphs of a text: parts between blank lines, or lines where there are none."""
    if not text:
        return []
    parts = PARAGRAPH.split(text)
    return parts if len(parts) > 1 else LINE.split(text)


def word_hash(word: str) -> int:
    """Number of a word as a signed integer; 0 for what has no letter."""
    if not any(ch.isalpha() for ch in word):
        return 0
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) | 1)))


class _Words(dict):
    """Token -> hash of its word; the words themselves are kept by their hashes."""

    def __init__(self) -> None:
        super().__init__()
        self.named: dict[int, str] = {}

    def __missing__(self, token: str) -> int:
        word = word_key(token)
        got = word_hash(word)
        if got:
            self.named[got] = word
        if len(token) <= 64:
            self[token] = got
        return got


def read_words(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One reading of all texts: rows (id, words) of paragraphs, and rows (hash, word, n) of word counts."""
    kind = documents.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        counts: dict[int, int] = defaultdict(int)
        id_type = None

        def told() -> pa.RecordBatch:
            n = len(counts)
            made = pa.RecordBatch.from_arrays(
                [pa.nulls(n, id_type), pa.nulls(n, pa.list_(pa.int64())), pa.array(list(counts), pa.int64()), pa.array([words.named[h] for h in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["id", "words", "hash", "word", "n"],
            )
            counts.clear()
            words.clear()
            words.named.clear()
            return made

        for batch in batches:
            id_type = batch.column(0).type
            rows, parts = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for paragraph in paragraphs(text):
                    tokens = paragraph.split()
                    own = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
                    own = own[own != 0]
                    if len(own):
                        rows.append(i)
                        parts.append(own)
            if parts:
                values = np.concatenate(parts)
                offsets = np.zeros(len(parts) + 1, np.int32)
                np.cumsum([len(p) for p in parts], out=offsets[1:])
                for h, n in zip(*(x.tolist() for x in np.unique(values, return_counts=True))):
                    counts[h] += n
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())],
                    names=["id", "words", "hash", "word", "n"],
                )
            if len(words) > REMEMBERED:
                yield told()
        if counts:
            yield told()

    return documents.select(id_col, text_col).mapInArrow(run, f"id {kind}, words array<bigint>, hash bigint, word string, n bigint")


def choose_vocabulary(counts: DataFrame) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(hashes in order, words, uses) of the words that the model knows: neither rare nor common."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    # few words are common where there are few at all
    kept = counts.groupBy("hash").agg(F.min("word").alias("word"), F.sum("n").alias("n")).filter((F.col("n") >= max(RARE, RATE * total)) & (F.col("n") <= max(COMMON * total, 30)))
    rows = kept.toArrow()
    hashes = rows.column("hash").to_numpy()
    order = np.argsort(hashes)
    words = rows.column("word").to_pylist()
    return hashes[order], [words[i] for i in order], rows.column("n").to_numpy()[order].astype(float)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.offsets)[:-1] - column.offsets[0].as_py()


def known_words(read: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """(id, words): word numbers of every paragraph that has any the model knows."""
    kind = read.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            if not batch.num_rows or not len(known):
                continue
            values, start = _flat(batch.column(1))
            at = np.minimum(np.searchsorted(known, values), len(known) - 1)
            held = known[at] == values
            sums = np.concatenate(([0], np.cumsum(held)))
            ends = np.append(start[1:], len(values))
            size = sums[ends] - sums[start]
            full = np.flatnonzero(size)
            offsets = np.zeros(len(full) + 1, np.int32)
            np.cumsum(size[full], out=offsets[1:])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(full)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(at[held].astype(np.int32)))], names=["id", "words"])

    return read.filter("words is not null").select("id", "words").mapInArrow(run, f"id {kind}, words array<int>")


def word_shares(beta: np.ndarray) -> np.ndarray:
    """topic x word -> word x topic, rows adding up to one."""
    return np.ascontiguousarray((beta / beta.sum(axis=0)).T.astype(np.float32))


def infer(words: np.ndarray, start: np.ndarray, beta: np.ndarray, rounds: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(paragraph numbers, words, topic shares of the words), for paragraphs of equal length together.

    words: word numbers of all paragraphs; start: first word of each; beta:
    word x topic, each word's row adding up to one (its scale cancels out).
    Mean-field updates of the proportions, in the form that needs no digamma
    (maximum a posteriori). Paragraphs of one length make a block, so that an
    update is two batched products and the word topics are read once.
    """
    size = np.diff(np.append(start, len(words)))
    order = np.argsort(size, kind="stable")
    edges = np.flatnonzero(np.diff(size[order])) + 1
    for rows in np.split(order, edges):
        own = words[start[rows][:, None] + np.arange(size[rows[0]])]
        by_word = beta[own]
        turned = by_word.transpose(0, 2, 1)
        # the first update, from equal proportions
        theta = by_word.sum(axis=1, keepdims=True) + np.float32(ALPHA)
        theta /= theta.sum(axis=2, keepdims=True)
        for _ in range(rounds - 1):
            norm = 1.0 / (theta @ turned + 1e-30)
            theta *= norm @ by_word
            theta += ALPHA
            theta /= theta.sum(axis=2, keepdims=True)
        by_word *= theta
        by_word /= by_word.sum(axis=2, keepdims=True) + 1e-30
        yield rows, own, by_word


def expected_counts(bags: DataFrame, beta: Broadcast, rounds: int) -> np.ndarray:
    """One distributed E-step: expected count of every word in every topic.

    Every task sends the blocks of words it met; partial sums are added FAN at a
    time, so that no task holds the sums of all.
    """
    n_words, n_topics = beta.value.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = beta.value
        sums = np.zeros((n_words, n_topics), np.float32)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> None:
            flat, share = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(flat, kind="stable")
            met, first = np.unique(flat[order], return_index=True)
            sums[met] += np.add.reduceat(share[order], first, axis=0)
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            words, start = _flat(batch.column(0))
            size = 0
            for _, own, share in infer(words, start, model, rounds):
                held.append((own.ravel(), share.reshape(-1, n_topics)))
                size += own.size
                if size >= TOGETHER:
                    flush()
                    size = 0
            if held:
                flush()
        task = TaskContext.get().partitionId() // FAN
        rows = [(task, b, sums[b : b + BLOCK].tobytes()) for b in range(0, n_words, BLOCK) if sums[b : b + BLOCK].any()]
        tasks, blocks, values = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(tasks, pa.int32()), pa.array(blocks, pa.int32()), pa.array(values, pa.binary())], names=["part", "block", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(v, np.float32) for v in group.column("sums").to_pylist()], axis=0, dtype=np.float64).astype(np.float32)
        return pa.table({"part": pa.array([group.column("part")[0].as_py() // FAN], pa.int32()), "block": group.column("block").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, block int, sums binary"
    left = -(-bags.rdd.getNumPartitions() // FAN)
    parts = bags.select("words").mapInArrow(run, schema).groupBy("part", "block").applyInArrow(add, schema)
    while left > 1:
        parts = parts.groupBy("part", "block").applyInArrow(add, schema)
        left = -(-left // FAN)
    out = np.zeros((n_words, n_topics))
    for part in parts.collect():
        values = np.frombuffer(part["sums"], np.float32).reshape(-1, n_topics)
        out[part["block"] : part["block"] + len(values)] += values
    return out.T


def start_topics(bags: DataFrame, n_words: int, uses: np.ndarray, topics: int, seeds: int = SEEDS) -> np.ndarray:
    """Topics to begin with: clusters of a bounded sample of paragraphs, without any label."""
    rng = np.random.default_rng(7)
    share = uses / max(uses.sum(), 1)
    rows = bags.filter(F.size("words") >= SEED_WORDS).select("words").orderBy(F.xxhash64("words"), "words").limit(seeds).toArrow().column("words").to_pylist()
    if not rows:
        return share * rng.gamma(100.0, 0.01, (topics, n_words))
    feature = rng.integers(0, FEATURES, n_words)
    x = np.zeros((len(rows), FEATURES), np.float32)
    for i, words in enumerate(rows):
        np.add.at(x[i], feature[words], 1)
    x = np.sqrt(x) * np.log((len(rows) + 1) / ((x > 0).sum(axis=0) + 1)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
    # centres far from each other, each the best of some tries
    centres = [0]
    far = 1 - x @ x[0]
    while len(centres) < topics and (weight := far.clip(1e-6) ** 2 * (far > 1e-4)).sum() > 0:
        tries = rng.choice(len(x), 8, p=weight / weight.sum())
        reached = np.minimum(far, 1 - x[tries] @ x.T)
        best = int(reached.sum(axis=1).argmin())
        centres.append(int(tries[best]))
        far = reached[best]
    centre = x[centres].copy()
    for _ in range(10):
        own = (x @ centre.T).argmax(axis=1)
        for k in range(len(centre)):
            if (own == k).any():
                centre[k] = x[own == k].sum(axis=0)
                centre[k] /= np.linalg.norm(centre[k]) + 1e-9
    out = np.zeros((len(centre), n_words))
    for i, words in enumerate(rows):
        np.add.at(out[own[i]], words, 1)
    return out + 0.3 * share * out.sum(axis=1, keepdims=True).clip(50)


@dataclass
class SubjectModel:
    """Fitted topics and their subjects (None for topics of no subject)."""

    vocabulary: list[str]
    beta: np.ndarray  # topic x word
    subjects: list[str | None]
    names: list[str]  # the subjects in order
    agree: np.ndarray  # share of each topic's top terms in documents of its subject

    def top_terms(self, n: int = TOP_TERMS) -> list[list[str]]:
        return [[self.vocabulary[i] for i in row] for row in top_terms(self.beta, n)]


def top_terms(beta: np.ndarray, n: int = TOP_TERMS) -> np.ndarray:
    """Numbers of the n words of each topic that are frequent in it and more so than in others."""
    lift = beta * np.log(beta / beta.mean(axis=0) + 1e-12)
    return np.argsort(-lift, axis=1)[:, :n]


def term_uses(bags: DataFrame, held: DataFrame, beta: np.ndarray) -> tuple[list, np.ndarray]:
    """(ids, document x topic): uses of each topic's top terms, as that topic, in the held documents (a bounded number)."""
    n_topics, n_words = beta.shape
    marked = np.zeros((n_words, n_topics), np.float32)
    for k, row in enumerate(top_terms(beta)):
        marked[row, k] = 1
    sent = bags.sparkSession.sparkContext.broadcast((word_shares(beta), marked))
    kind = bags.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, marked = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            words, start = _flat(batch.column(1))
            uses = np.zeros((len(start), n_topics), np.float32)
            for rows, own, share in infer(words, start, model, INNER_LAST):
                uses[rows] = (share * marked[own]).sum(axis=1)
            row, topic = np.nonzero(uses > 0.05)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(topic.astype(np.int32)), pa.array(uses[row, topic].astype(float))], names=["id", "topic", "uses"])

    # the held ids are at most LABELLED
    rows = bags.join(F.broadcast(held), "id").select("id", "words").mapInArrow(run, f"id {kind}, topic int, uses double").groupBy("id", "topic").agg(F.sum("uses").alias("uses")).toArrow()
    ids = sorted(set(rows.column("id").to_pylist()))
    place = {d: i for i, d in enumerate(ids)}
    out = np.zeros((len(ids), n_topics))
    out[[place[d] for d in rows.column("id").to_pylist()], rows.column("topic").to_numpy()] = rows.column("uses").to_numpy()
    return ids, np.minimum(out, USES)


def map_topics(beta: np.ndarray, uses: np.ndarray, labels: np.ndarray, described: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(subject number or -1, agreement) of each topic, by its top terms.

    uses: document x topic, uses of the top terms; labels: document x subject.
    A document of several labels speaks for the one whose topics it is known by
    from other documents. Topics whose terms no labelled text uses are judged
    by the words of the subjects' descriptions.
    """
    n_topics, n_subjects = len(beta), labels.shape[1] if len(labels) else len(described)
    subject, agree = np.full(n_topics, -1), np.zeros(n_topics)
    if not n_subjects:
        return subject, agree
    total = uses.sum(axis=0)
    if len(uses):
        held = uses.T @ labels / (total[:, None] + 1e-9)
        belief = np.clip(held, 1e-6, None) ** 4
        belief /= belief.sum(axis=1, keepdims=True)
        for _ in range(20):
            heard = np.zeros_like(belief)
            # each document divides its uses of a topic among its labels
            for u, own in zip(uses, labels):
                part = belief * own
                heard += u[:, None] * part / (part.sum(axis=1, keepdims=True) + 1e-12)
            belief = (heard + 1e-3) * np.clip(held, 1e-6, None) ** 2
            belief /= belief.sum(axis=1, keepdims=True)
        best = belief.argmax(axis=1)
        agree = held[np.arange(n_topics), best]
        told = (total >= SUPPORT) & (agree >= AGREE)
        subject[told] = best[told]
    lift = np.maximum(beta * np.log(beta / beta.mean(axis=0) + 1e-12), 0)
    owned = described / (described.sum(axis=0) + 1e-12)
    for k in np.flatnonzero(total < SUPPORT) if len(uses) else range(n_topics):
        top = np.argsort(-lift[k])[:TOP_TERMS]
        score = owned[:, top] @ lift[k][top] / (lift[k][top].sum() + 1e-12)
        if score.max() >= 0.05:
            subject[k], agree[k] = int(score.argmax()), score.max()
    return subject, agree


def fit_subjects(documents: DataFrame, subjects: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", passes: int = PASSES) -> tuple[SubjectModel, DataFrame]:
    """Model over all documents, and the table of their paragraphs' words."""
    spark: SparkSession = documents.sparkSession
    read = cut_lineage(read_words(documents, id_col, text_col), "words")
    hashes, vocabulary, uses = choose_vocabulary(read.filter("n is not null").select("hash", "word", "n"))
    bags = cut_lineage(known_words(read, spark.sparkContext.broadcast(hashes)), "bags")
    listed = subjects.filter("subject is not null").groupBy("subject").agg(F.max("description").alias("description")).orderBy("subject").collect()
    names = [r["subject"] for r in listed]
    n_words = max(len(vocabulary), 1)
    uses = uses if len(uses) else np.ones(1)
    topics = start_topics(bags, n_words, uses, TOPICS * max(len(names), 1) + BACKGROUND)
    for _ in range(passes):
        beta = topics + ETA * topics.sum(axis=1, keepdims=True) / n_words + 1e-12
        now = spark.sparkContext.broadcast(word_shares(beta / beta.sum(axis=1, keepdims=True)))
        topics = expected_counts(bags, now, INNER)
        now.unpersist()
    beta = topics + ETA + 1e-12
    beta = beta / beta.sum(axis=1, keepdims=True)

    place = {int(h): i for i, h in enumerate(hashes)}
    described = np.zeros((len(names), n_words))
    for i, r in enumerate(listed):
        for token in (r["description"] or "").split():
            if (w := place.get(word_hash(word_key(token)))) is not None:
                described[i, w] += 1
    named = labels.select(F.col(id_col).alias("id"), "subject").filter(F.col("id").isNotNull()).join(subjects.select("subject").distinct(), "subject").distinct()
    # as many as the bound holds, in the order of a hash, which any number of documents shares
    held = named.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(LABELLED)
    number = {s: i for i, s in enumerate(names)}
    told = [(r["id"], number[r["subject"]]) for r in named.join(F.broadcast(held), "id").collect() if r["subject"] in number]
    ids, used = term_uses(bags, held, beta) if told else ([], np.zeros((0, len(beta))))
    row = {d: i for i, d in enumerate(ids)}
    marks = np.zeros((len(ids), len(names)))
    for d, s in told:
        if d in row:
            marks[row[d], s] = 1
    subject, agree = map_topics(beta, used, marks, described)
    return SubjectModel(vocabulary, beta, [names[s] if s >= 0 else None for s in subject], names, agree), bags


def document_subjects(documents: DataFrame, subjects: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", passes: int = PASSES) -> DataFrame:
    """Subjects to which a document gives a paragraph of its own: (id_col, subject, paragraphs).

    The subject of a paragraph is the one whose topics lead its proportions.

    Defined results: null, blank and empty texts, lists without words of a
    subject and paragraphs without a leading subject have none; a passing
    mention is outweighed by its paragraph; rows of one id are one document;
    wrong, repeated or incomplete labels are outvoted by others of the topic;
    without labels the descriptions of the subjects name the topics; empty
    tables give no rows.
    """
    spark = documents.sparkSession
    model, bags = fit_subjects(documents, subjects, labels, id_col, text_col, passes)
    kind = documents.schema[id_col].dataType.simpleString()
    names = model.names
    to_subject = np.zeros((len(model.subjects), max(len(names), 1)), np.float32)
    for k, s in enumerate(model.subjects):
        if s is not None:
            to_subject[k, names.index(s)] = 1
    sent = spark.sparkContext.broadcast((word_shares(model.beta), to_subject, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beta, to_subject, names = sent.value
        listed = pa.array(names, pa.string())
        for batch in batches:
            if not batch.num_rows or not names:
                continue
            words, start = _flat(batch.column(1))
            proportion = np.empty((len(start), beta.shape[1]), np.float32)
            size = np.empty(len(start))
            for rows, own, share in infer(words, start, beta, INNER_LAST):
                proportion[rows] = share.mean(axis=1)
                size[rows] = own.shape[1]
            told = proportion @ to_subject
            best = told.argmax(axis=1)
            most = told[np.arange(len(told)), best]
            keep = np.flatnonzero((most * size >= EVIDENCE) & (most >= SHARE))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), listed.take(pa.array(best[keep]))], names=[id_col, "subject"])

    found = bags.mapInArrow(run, f"`{id_col}` {kind}, subject string")
    return found.groupBy(id_col, "subject").agg(F.count(F.lit(1)).alias("paragraphs"))
