"""A hashed maximum-entropy language model, learned from all training texts and scored in sparse numpy batches.

Tokens are words with A-Z lower-cased, then one end token per text. A word belongs to a class: the most frequent words are classes
of their own, all others are put together by their endings; classes belong to clusters. The probability of a token is

    P(cluster | history) * P(class | cluster, history) * P(word | class)

The first two are softmaxes over sparse features of the history, each hashed to a few rows of weights: the last word, the last two
words, the word before the last (a skip), the endings of the last three. The third follows from the counts. A token costs
two short softmaxes instead of one over the vocabulary, and all probabilities of a history sum to one, an unknown word per class
included.

Counts are exact: tasks count locally, one shuffle adds up. Weights start from the counts of the classes. Every round gives each
task the current weights; it takes gradient steps over its texts of the round and returns what it changed, and the changes are
averaged, weighted by how often each row was met, in a tree of groups of bounded size. Every training text is in one round.

For scoring, words of at least a ``2^-head_bits`` share of all tokens (so at most ``2^head_bits`` words, whatever the corpus) are
broadcast with their counts; the others are joined by a shuffle. No table that grows with the corpus is broadcast or collected.

Null and empty texts consist of the end token. Repeated rows are scored again. With no training text every class has the same share.
An empty table gives an empty result; columns that are not asked for are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia.llm.store import stored
from alluvia.llm.toxicity import id_bucket
from alluvia.llm.words import Words, mixed, text_batches
from alluvia.queries.registry import table

#: Additive smoothing of all counts.
SMOOTHING = 0.1
#: Clusters and classes in a cluster; a row of weights has one value for each.
WIDE = 16
ENDINGS = 12 * WIDE  # classes by ending, after those of single words
SINGLES = WIDE * WIDE - ENDINGS
END = np.uint64(0x5EED0F_E4D << 8)  # the end token's key, of ending class 0
START = np.uint64(0x57A27_0 << 8)  # the history before a text
#: Hashed rows of each feature: last word, last two words, word before the last, endings of the last three words.
FEATURES = (1024, 1024, 512, 512, 512, 512)
N_FEATURES = sum(FEATURES)  # times WIDE it is 2^16, so row numbers fit 16 bits and sort by radix
#: Rows of weights: the constant feature's for clusters and for the classes of each cluster, then all others' in that order.
UPPER = 1 + WIDE
LOWER = UPPER + N_FEATURES
N_ROWS = LOWER + N_FEATURES * WIDE
BLOCK = 1024  # weight rows that travel together
FAN_IN = 64  # changes of one block that one group averages


@dataclass(frozen=True)
class Settings:
    rounds: int = 2
    batch: int = 2048
    rate: float = 0.15
    head_bits: int = 21


@dataclass
class Counts:
    """What scoring needs to know of the corpus beside the counts of single words; a few hundred numbers."""

    tokens: int
    words: int
    singles: np.ndarray  # keys of the classes that are single words, by count
    class_tokens: np.ndarray
    class_words: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros((N_ROWS, WIDE), np.float32))

    def __post_init__(self):
        order = np.argsort(self.singles)
        self.single_keys, self.single_class = self.singles[order], order

    def classes(self, keys: np.ndarray) -> np.ndarray:
        made = SINGLES + (keys & np.uint64(255)).astype(np.int64)
        if len(self.singles):
            at = np.minimum(np.searchsorted(self.single_keys, keys), len(self.singles) - 1)
            made = np.where(self.single_keys[at] == keys, self.single_class[at], made)
        return made

    def word_denominators(self) -> np.ndarray:
        return self.class_tokens + SMOOTHING * (self.class_words + 1)


def sequences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and ending hashes of the tokens of some texts, and the tokens of each text.

    A key is a 64-bit hash of the word whose last byte is its class by ending.
    """
    w = Words(texts, fold=True)
    long_end = w.spans.hashes(np.maximum(w.starts, w.ends - 4), w.ends)
    short_end = w.spans.hashes(np.maximum(w.starts, w.ends - 2), w.ends)
    ending = (short_end % np.uint64(ENDINGS // WIDE)) * np.uint64(WIDE) + long_end % np.uint64(WIDE)
    counts = w.counts + 1
    keys, ends = np.full(int(counts.sum()), END, np.uint64), np.zeros(int(counts.sum()), np.uint64)
    at = np.arange(len(w.starts)) + w.text_of_word()
    keys[at] = (w.hashes() & ~np.uint64(255)) | ending
    ends[at] = long_end
    return keys, ends, counts


def features(keys: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Feature numbers of every token's history, one per hashed feature."""
    nth = np.arange(len(keys)) - np.repeat(np.cumsum(counts) - counts, counts)

    def back(x, n, outside):
        moved = np.full(len(x), outside, np.uint64)
        moved[n:] = x[:-n] if n < len(x) else x[:0]
        moved[nth < n] = outside
        return moved

    k1, k2 = back(keys, 1, START), back(keys, 2, START)
    values = [k1, mixed(k1) ^ k2, k2, back(ends, 1, START), back(ends, 2, START), back(ends, 3, START)]
    made = np.empty((len(keys), len(FEATURES)), np.uint16)
    first = 0
    for n, (value, size) in enumerate(zip(values, FEATURES, strict=True)):
        made[:, n] = first + (mixed(value + np.uint64(n)) % np.uint64(size)).astype(np.int64)
        first += size
    return made


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    x -= np.log(np.exp(x).sum(1, keepdims=True))
    return x


def row_pairs(feats: np.ndarray, cluster: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the hashed features, counted from ``UPPER`` and ``LOWER``."""
    return feats, feats * np.uint16(WIDE) + cluster[:, None].astype(np.uint16)


def summed(weights: np.ndarray, constant: np.ndarray, first: int, rows: np.ndarray) -> np.ndarray:
    part = weights[first:]
    out = np.take(part, rows[:, 0], axis=0, mode="clip")  # every row number is in range; "clip" spares the test and a copy
    out += constant
    met = np.empty_like(out)
    for k in range(1, rows.shape[1]):
        np.take(part, rows[:, k], axis=0, out=met, mode="clip")
        out += met
    return out


def class_log10(model: Counts, keys, ends, counts, batch: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """log10 P(class | history) of every token, and the classes."""
    feats, classes = features(keys, ends, counts), model.classes(keys)
    made, w = np.empty(len(keys)), model.weights
    for a in range(0, len(keys), batch):
        c = classes[a:a + batch]
        upper, lower = row_pairs(feats[a:a + batch], c // WIDE)
        nth = np.arange(len(c))
        made[a:a + batch] = (log_softmax(summed(w, w[0], UPPER, upper))[nth, c // WIDE]
                             + log_softmax(summed(w, w[1 + c // WIDE], LOWER, lower))[nth, c % WIDE])
    return made / np.log(10), classes


def run_sums(x: np.ndarray, starts: np.ndarray, sizes: np.ndarray, short: int = 6) -> np.ndarray:
    """Sum of every run of rows. Most runs are short: their second rows are added all at once, then their third ones, and so on."""
    total = np.take(x, starts, axis=0)
    some = np.flatnonzero((sizes > 1) & (sizes <= short))
    for k in range(1, short):
        some = some[sizes[some] > k]
        if not len(some):
            break
        total[some] += np.take(x, starts[some] + k, axis=0)
    long = np.flatnonzero(sizes > short)
    if len(long):
        size = sizes[long]
        total[long] = np.add.reduceat(x[np.repeat(sizes > short, sizes)], np.cumsum(size) - size, axis=0)
    return total


class Learner:
    """Gradient steps of one task, from shared weights."""

    def __init__(self, model: Counts, settings: Settings):
        self.model, self.settings = model, settings
        self.weights = model.weights.copy()
        self.seen = np.full(self.weights.shape, 1.0, np.float32)
        self.met = np.zeros(len(self.weights), np.int64)

    def learn(self, texts: list[str | None]) -> None:
        keys, ends, counts = sequences(texts)
        feats, classes = features(keys, ends, counts), self.model.classes(keys)
        steps = -(-len(keys) // self.settings.batch)
        for a in range(steps):
            some = slice(a, None, steps)  # the tokens of a step come from all over the chunk
            c = classes[some]
            nth = np.arange(len(c))
            upper, lower = row_pairs(feats[some], c // WIDE)
            chosen = (c // WIDE)[:, None] == np.arange(WIDE)
            constants = (np.ones((1, len(c)), np.float32), chosen.T.astype(np.float32))
            for rows, at, own, first, target in zip((upper, lower), (0, 1 + c // WIDE), constants, (UPPER, LOWER), (c // WIDE, c % WIDE), strict=True):
                grad = -np.exp(log_softmax(summed(self.weights, self.weights[at], first, rows)))
                grad[nth, target] += 1
                self.step(np.arange(len(own)) + (first == LOWER), own @ grad, own.sum(1))
                self.move(rows, first, grad)

    def move(self, rows: np.ndarray, first: int, grad: np.ndarray) -> None:
        """Sums up the gradients of each row that a batch met."""
        flat = rows.ravel()
        by_row = np.argsort(flat, kind="stable")
        own = flat[by_row]
        starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        sizes = np.diff(np.append(starts, len(flat)))
        total = run_sums(np.take(grad, by_row // rows.shape[1], axis=0, mode="clip"), starts, sizes)
        self.step(own[starts].astype(np.int64) + first, total, sizes)

    def step(self, own: np.ndarray, total: np.ndarray, met: np.ndarray) -> None:
        """One Adagrad step."""
        self.met[own] += met.astype(np.int64)
        seen = np.take(self.seen, own, axis=0, mode="clip")
        seen += total * total
        self.seen[own] = seen
        np.sqrt(seen, out=seen)
        np.divide(total, seen, out=seen)
        seen *= self.settings.rate
        seen += np.take(self.weights, own, axis=0, mode="clip")
        self.weights[own] = seen

    def changes(self):
        """Blocks of changed rows: number, times met, change."""
        for block in range(0, len(self.weights), BLOCK):
            met = self.met[block:block + BLOCK]
            if met.any():
                change = self.weights[block:block + BLOCK] - self.model.weights[block:block + BLOCK]
                yield block, met.astype(np.float32), change.astype(np.float16)


_CHANGE = T.StructType([T.StructField("block", T.LongType()), T.StructField("salt", T.LongType()),
                        T.StructField("met", T.BinaryType()), T.StructField("change", T.BinaryType())])


def _averaged(group: pa.Table) -> pa.Table:
    """One row for a group's rows: summed meetings, mean change weighted by them."""
    met, change = 0, 0
    for m, c in zip(group["met"], group["change"], strict=True):
        n = np.frombuffer(m.as_buffer(), np.float32)
        met = met + n
        change = change + n[:, None] * np.frombuffer(c.as_buffer(), np.float16).reshape(-1, WIDE).astype(np.float32)
    mean = (change / np.maximum(met, 1)[:, None]).astype(np.float16)
    return pa.table({"block": [group["block"][0].as_py()], "salt": [group["salt"][0].as_py()], "met": [met.tobytes()], "change": [mean.tobytes()]})


def count_words(texts: DataFrame, held: int = 1_500_000) -> DataFrame:
    """(key, n) of every token of the column ``text``: counted in the tasks first, then added up in one shuffle."""
    def run(batches):
        keys, counts, size = [], [], 0

        def merged():
            all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
            distinct, inverse = np.unique(all_keys, return_inverse=True)
            return distinct, np.bincount(inverse, weights=all_counts).astype(np.int64)

        for (column,) in text_batches(batches, "text"):
            k, c = np.unique(sequences(column.to_pylist())[0], return_counts=True)
            keys.append(k)
            counts.append(c)
            size += len(k)
            if size > held:
                k, c = merged()
                keys, counts, size = [k], [c], len(k)
                if size > held // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], ["key", "n"])
                    keys, counts, size = [], [], 0
        if keys:
            k, c = merged()
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], ["key", "n"])

    local = texts.select("text").mapInArrow(run, T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType())]))
    return local.groupBy("key").agg(F.sum("n").alias("n"))


def corpus_counts(vocabulary: DataFrame) -> Counts:
    """Totals, single-word classes and class sums: at most 64 and 192 rows reach the driver."""
    top = [r["key"] for r in vocabulary.orderBy(F.desc("n"), "key").limit(SINGLES).collect()]
    ending = F.col("key").bitwiseAND(255)
    single = F.col("key").isin(top) if top else F.lit(False)
    tokens, words = np.zeros(WIDE * WIDE), np.zeros(WIDE * WIDE)
    place = {k: i for i, k in enumerate(top)}
    rows = vocabulary.groupBy(ending.alias("ending"), F.when(single, F.col("key")).alias("single")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    for r in rows:
        at = place[r["single"]] if r["single"] is not None else SINGLES + r["ending"]
        tokens[at] += r["n"]
        words[at] += r["words"]
    model = Counts(int(tokens.sum()), int(words.sum()), np.array(top, np.int64).view(np.uint64), tokens, words)
    share = (tokens + SMOOTHING) / (tokens + SMOOTHING).sum()
    by_cluster = share.reshape(WIDE, WIDE)
    model.weights[0] = np.log(by_cluster.sum(1))
    model.weights[1:WIDE + 1] = np.log(by_cluster / by_cluster.sum(1, keepdims=True))
    return model


def learn(texts: DataFrame, model: Counts, settings: Settings) -> None:
    """Rounds of distributed gradient updates; ``texts`` has ``text`` and ``round``."""
    spark = texts.sparkSession
    for n in range(settings.rounds):
        shared = spark.sparkContext.broadcast(model)

        def run(batches, shared=shared):
            learner = None
            for (column,) in text_batches(batches, "text"):
                learner = learner or Learner(shared.value, settings)
                learner.learn(column.to_pylist())
            if learner:
                salt = TaskContext.get().partitionId()
                for block, met, change in learner.changes():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64()), pa.array([salt], pa.int64()), pa.array([met.tobytes()]), pa.array([change.tobytes()])],
                        _CHANGE.fieldNames())

        changes = texts.filter(F.col("round") == n).select("text").mapInArrow(run, _CHANGE)
        # As many levels as the tasks ask for: a group never has more than FAN_IN changes of one block.
        tree, width = changes, changes.rdd.getNumPartitions()
        while True:
            width = -(-width // FAN_IN)
            tree = tree.withColumn("salt", F.floor(F.col("salt") / FAN_IN)).groupBy("block", "salt").applyInArrow(_averaged, _CHANGE)
            if width <= 1:
                break
        for r in tree.collect():  # all weights once, whatever the corpus
            change = np.frombuffer(r["change"], np.float16).reshape(-1, WIDE)
            model.weights[r["block"]:r["block"] + len(change)] += change
        shared.unpersist()


_SCORED = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("key", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType()),
    T.StructField("rare", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType())),
])


def scored(docs: DataFrame, model: Counts, head: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Per text: sums over its frequent words, and its other words with their numbers. ``docs`` has ``key`` and ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast((model, head))
    base_all = model.tokens + SMOOTHING * (model.words + 1)

    def run(batches):
        m, (known, known_counts) = shared.value
        log_words = np.log10(m.word_denominators())
        row = TaskContext.get().partitionId() << 33
        for column, ids in text_batches(batches, "text", "key"):
            keys, ends, counts = sequences(column.to_pylist())
            class_part, classes = class_log10(m, keys, ends, counts)
            at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
            found = known[at] == keys if len(known) else np.zeros(len(keys), bool)
            log_count = np.log10(np.where(found, known_counts[at] if len(known) else 0, 0) + SMOOTHING)
            word_part = np.where(classes < SINGLES, 0, log_count - log_words[classes])
            text = np.repeat(np.arange(len(counts)), counts)
            add = lambda x: np.bincount(text, weights=x, minlength=len(counts))
            rare = np.flatnonzero(~found)
            order = rare[np.lexsort((keys[rare], text[rare]))]
            k, t = keys[order], text[order]
            starts = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])])) if len(k) else np.zeros(0, np.int64)
            times = np.diff(np.append(starts, len(k))).astype(np.int32)
            offsets = pa.array(np.searchsorted(t[starts], np.arange(len(counts) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(len(counts))), ids, pa.array(counts), pa.array(add(found).astype(np.int64)),
                pa.array(add(np.where(found, log_count - np.log10(base_all), 0))),
                pa.array(add(class_part + np.where(found, word_part, 0))),
                pa.ListArray.from_arrays(offsets, pa.array(k[starts].view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(times)),
            ], _SCORED.fieldNames())
            row += len(counts)

    return docs.select("text", "key").mapInArrow(run, _SCORED)


def score(docs: DataFrame, training: Column, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score of every row, learning from the rows that ``training`` picks."""
    picked = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), training.alias("training"))
    lessons = picked.filter("training").select(
        "text", F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit("round")), F.lit(settings.rounds)).alias("round"))
    vocabulary = stored(count_words(lessons), "maxent-words")
    model = corpus_counts(vocabulary)
    learn(lessons, model, settings)
    # At most 2^head_bits words can have so large a share.
    rows = vocabulary.filter(F.col("n") > model.tokens / (1 << settings.head_bits)).toArrow()
    order = np.argsort(np.asarray(rows["key"]).view(np.uint64))
    head = np.asarray(rows["key"]).view(np.uint64)[order], np.asarray(rows["n"])[order]
    partial = stored(scored(picked, model, head), "maxent-partial")
    words = partial.select("row", F.explode(F.arrays_zip(F.col("rare").alias("key"), "times")).alias("w")).select("row", "w.key", "w.times")
    base_all = float(np.log10(model.tokens + SMOOTHING * (model.words + 1)))
    log_words = F.array(*map(F.lit, np.log10(model.word_denominators())[SINGLES:].tolist()))
    log_count = F.log10(F.coalesce("n", F.lit(0)) + SMOOTHING)
    rest = words.join(vocabulary, "key", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rest_known"),
        F.sum(F.col("times") * (log_count - base_all)).alias("rest_base"),
        F.sum(F.col("times") * (log_count - F.get(log_words, F.col("key").bitwiseAND(255).cast("int")))).alias("rest_score"))
    whole = partial.drop("rare", "times").join(rest, "row", "left")
    return whole.select(
        F.col("key").alias(key), "n_tokens", (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rest_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rest_score", F.lit(0.0))).alias("score"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_bucket(F.col("doc_id"), 10) == 0
    rows = score(table(spark, sf_dir, "documents"), ~held_out)
    return rows.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
