"""Toxicity by a convolutional text classifier, trained and scored in numpy.

A word is a run of letters, digits and non-ASCII characters, A-Z lower-cased. Its embedding is the sum of hashed rows for the word
and for its first 3 to 6 bytes, so that unseen endings of a known stem are recognised. Filters of several widths run over the whole
text, each keeps its largest response anywhere in it, and a logistic layer over these gives the score.

Learning reads at most ``Settings.sample`` different labelled rows, by hashes of ids, then of ids and texts. All
labelled rows outside this sample calibrate: they shift the logits to where the classes part, and set one decision threshold per
language (the overall one where a language has few labels). Where they are few, the rows that were learned from count as well. The language column only chooses the threshold; a score depends on the text alone.

Null and empty texts get the score of a text in which no filter responds. Without labelled rows of both classes every score is the
share of toxic labels (0 without labels). Conflicting labels of one document count as toxic; labels that are null are no labels.
Repeated rows are scored again; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia.llm.store import stored
from alluvia.llm.words import NOT_LETTERS, SMALL_CHUNK_BYTES, Words, chunks, map_texts, mixed
from alluvia.queries.registry import table


#: Fixed value: bins of logits in one unit.
BINS = 50


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled rows that are learned from, whatever the table's size."""

    sample: int = 12_000
    buckets: int = 1 << 18
    width: int = 8
    filters: int = 8
    spans: tuple[int, ...] = (1, 2, 3)
    prefixes: tuple[int, ...] = (3, 4, 5, 6)
    epochs: int = 6
    batch: int = 32
    rate: float = 0.1
    decay: float = 1e-4
    seed: int = 7
    few_labels: int = 30


def word_ids(texts: list[str | None], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the embedding table for each word (one column per feature), and the number of words of each text."""
    w = Words(texts, fold=True, gaps=NOT_LETTERS)
    columns = [w.hashes()]
    for n in settings.prefixes:
        ends = np.minimum(w.starts + n, w.ends)
        columns.append(mixed(w.spans.hashes(w.starts, ends) + np.uint64(n * 0x51ED27)))
    ids = np.stack([c % np.uint64(settings.buckets) for c in columns], 1).astype(np.int32)
    return ids, w.counts


class Network:
    def __init__(self, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        s = self.settings = settings
        self.table = rng.normal(0, 0.02, (s.buckets, s.width)).astype(np.float32)
        self.filters = [rng.normal(0, 1 / np.sqrt(n * s.width), (n * s.width, s.filters)).astype(np.float32) for n in s.spans]
        self.bias = [np.full(s.filters, 0.01, np.float32) for _ in s.spans]
        self.out = rng.normal(0, 0.3, len(s.spans) * s.filters).astype(np.float32)
        self.base = np.float32(0)

    def pooled(self, ids: np.ndarray, counts: np.ndarray, with_places: bool = False):
        """Largest response of every filter in each text, and where it was. A text is framed by empty words."""
        s, n = self.settings, len(counts)
        reach = max(s.spans) - 1
        starts = np.cumsum(counts + reach) - counts - reach
        rows = np.zeros((int(counts.sum()) + reach * n + reach, s.width), np.float32)
        at = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(len(ids))
        summed = self.table[ids[:, 0]]
        for k in range(1, ids.shape[1]):
            summed += self.table[ids[:, k]]
        rows[at] = summed
        size = len(rows) - reach
        made, places = [], []
        for span, weights, bias in zip(s.spans, self.filters, self.bias, strict=True):
            z = rows[:size] @ weights[:s.width]
            for j in range(1, span):
                z += rows[j:size + j] @ weights[j * s.width:(j + 1) * s.width]
            best = np.maximum.reduceat(z, starts, axis=0) if n else np.zeros((0, s.filters), np.float32)
            made.append(np.maximum(best + bias, 0))
            if with_places:
                first = np.full((n, s.filters), size, np.int64)
                text = np.repeat(np.arange(n), np.diff(np.append(starts, size)))
                hit, column = np.nonzero(z == best[text])
                np.minimum.at(first, (text[hit], column), hit)
                places.append(first)
        return np.concatenate(made, 1), places, rows, at

    def logits(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.pooled(ids, counts)[0] @ self.out + self.base

    def step(self, ids, counts, wanted, state: dict) -> None:
        """One Adagrad update from a batch of texts; gradients reach only the words that won a filter."""
        s = self.settings
        pooled, places, rows, at = self.pooled(ids, counts, True)
        p = 1 / (1 + np.exp(-(pooled @ self.out + self.base)))
        d = ((p - wanted) / len(wanted)).astype(np.float32)
        back = np.full(len(rows), -1, np.int64)
        back[at] = np.arange(len(at))
        d_pooled = d[:, None] * self.out[None, :] * (pooled > 0)
        word_rows, word_grads = [], []
        moves = {"out": (self.out, pooled.T @ d + s.decay * self.out), "base": (None, d.sum())}
        for k, span in enumerate(s.spans):
            g = d_pooled[:, k * s.filters:(k + 1) * s.filters]
            d_filter = np.zeros_like(self.filters[k])
            for j in range(span):
                x = rows[places[k] + j]  # text, filter, width
                d_filter[j * s.width:(j + 1) * s.width] = np.einsum("tfw,tf->wf", x, g)
                own = self.filters[k][j * s.width:(j + 1) * s.width]
                word = back[(places[k] + j).ravel()]
                grads = (g[:, :, None] * own.T[None]).reshape(-1, s.width)
                real = (word >= 0) & (np.abs(grads).sum(1) > 0)
                word_rows.append(word[real])
                word_grads.append(grads[real])
            moves[f"f{k}"] = (self.filters[k], d_filter + s.decay * self.filters[k])
            moves[f"b{k}"] = (self.bias[k], g.sum(0))
        for name, (value, grad) in moves.items():
            seen = state[name] = state.get(name, 1e-3) + np.square(grad)
            change = (s.rate * grad / np.sqrt(seen)).astype(np.float32)
            if value is None:
                self.base -= change
            else:
                value -= change
        word, grads = np.concatenate(word_rows), np.concatenate(word_grads)
        if len(word):
            wanted_rows, inverse = np.unique(ids[word].ravel(), return_inverse=True)
            total = np.zeros((len(wanted_rows), s.width), np.float32)
            np.add.at(total, inverse, np.repeat(grads, ids.shape[1], 0))
            state["table"][wanted_rows] += np.square(total)
            self.table[wanted_rows] -= s.rate * total / np.sqrt(state["table"][wanted_rows])

    def fit(self, ids: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> None:
        s = self.settings
        rng = np.random.default_rng(s.seed)
        ends = np.cumsum(counts)
        state: dict = {"table": np.full(self.table.shape, 1e-3, np.float32)}
        self.base = np.float32(np.log(wanted.mean() / (1 - wanted.mean())))
        for _ in range(s.epochs):
            order = rng.permutation(len(counts))
            for k in range(0, len(order), s.batch):
                rows = order[k:k + s.batch]
                words = np.concatenate([np.arange(ends[r] - counts[r], ends[r]) for r in rows])
                self.step(ids[words], counts[rows], wanted[rows], state)


def parting(logits: np.ndarray, wanted: np.ndarray, times: np.ndarray | None = None) -> float:
    """The logit that misplaces the fewest rows; the middle of the widest gap among those. A row can stand for several."""
    order = np.argsort(logits, kind="stable")
    n = np.ones(len(logits)) if times is None else times[order]
    x, y = logits[order], wanted[order] * n
    below = np.concatenate([[0], np.cumsum(n - y)])
    wrong = np.concatenate([[0], np.cumsum(y)]) + below[-1] - below
    wrong[1:-1][x[1:] == x[:-1]] = np.inf  # equal logits cannot be parted
    edges = np.concatenate([[x[0] - 1], x, [x[-1] + 1]])
    gaps = np.where(wrong == wrong.min(), edges[1:] - edges[:-1], -1)
    k = int(gaps.argmax())
    return float((edges[k] + edges[k + 1]) / 2)


def learn(texts: list[str | None], wanted: np.ndarray, settings: Settings) -> bytes:
    """A model as bytes: the network, before it is calibrated."""
    wanted = wanted.astype(np.float64)
    if not len(wanted) or wanted.min() == wanted.max():
        return pickle.dumps({"constant": float(wanted.mean()) if len(wanted) else 0.0, "thresholds": {None: 0.5}})
    sizes = np.array([len(t or "") for t in texts])
    parts = [word_ids(texts[a:b], settings) for a, b in chunks(sizes, SMALL_CHUNK_BYTES)]  # only row numbers stay in memory, 20 bytes a word
    ids, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    del parts
    network = Network(settings)
    network.fit(ids, counts, wanted)
    used = np.flatnonzero(np.any(network.table != Network(settings).table, 1))  # other rows follow from the seed
    return pickle.dumps({"settings": settings, "shift": 0.0, "thresholds": {None: 0.3}, "used": used, "rows": network.table[used],
                         "filters": network.filters, "bias": network.bias, "out": network.out, "base": network.base})


class Scorer:
    def __init__(self, model: bytes):
        self.model = m = pickle.loads(model)
        self.thresholds = m["thresholds"]
        if "constant" not in m:
            self.network = n = Network(m["settings"])
            n.table[m["used"]] = m["rows"]
            n.filters, n.bias, n.out, n.base = m["filters"], m["bias"], m["out"], m["base"]

    def logits(self, texts: list[str | None]) -> np.ndarray:
        ids, counts = word_ids(texts, self.model["settings"])
        return self.network.logits(ids, counts).astype(np.float64) + self.model["shift"]

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if "constant" in self.model:
            return np.full(len(texts), self.model["constant"])
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))


def calibrated(model: bytes, rows: DataFrame, marked: DataFrame, known: DataFrame, settings: Settings) -> bytes:
    """The model with its shift and its thresholds by language (None: all others), from all labelled rows.

    ``rows`` has id, text, digest and language; ``known`` the id and digest of rows that were learned from. Rows are counted by bins of
    their logits, so the driver gets at most a few thousand counts of each language.
    """
    m = pickle.loads(model)
    if "constant" in m:
        return model
    shared = rows.sparkSession.sparkContext.broadcast(model)
    held: list[Scorer] = []

    def compute(texts):
        if not held:
            held.append(Scorer(shared.value))
        return [np.floor(np.clip(held[0].logits(texts), -60, 60) * BINS).astype(np.int32)]

    binned = map_texts(rows, "text", compute, [T.StructField("bin", T.IntegerType())], "_logit", ["id", "digest", "language"], SMALL_CHUNK_BYTES)
    binned = binned.select("id", "digest", "language", F.col("_logit.bin").alias("bin")).distinct()
    binned = binned.join(F.broadcast(known.select("id", "digest", F.lit(True).alias("learned"))), ["id", "digest"], "left")
    # Counted by id first: an id with very many rows meets its label as a few counts.
    counts = binned.groupBy("id", "language", "learned", "bin").count().join(marked.select("id", "wanted"), "id")
    counts = counts.groupBy("language", "learned", "bin", F.col("wanted").cast("int").alias("wanted")).agg(F.sum("count").alias("n")).collect()
    table_ = np.array([[(c.bin + 0.5) / BINS, c.wanted, c.n, bool(c.learned)] for c in counts], np.float64).reshape(-1, 4)
    spoken = np.array([c.language or "" for c in counts])

    def part(own: np.ndarray) -> float | None:
        for some in (own & (table_[:, 3] == 0), own):
            x, wanted, n, _ = table_[some].T
            if min((wanted * n).sum(), ((1 - wanted) * n).sum()) >= settings.few_labels:
                return parting(x, wanted, n)
        return None

    every = np.ones(len(table_), bool)
    overall = part(every)
    # With few labels in all, what there is.
    m["shift"] = float(np.log(0.3 / 0.7) - (parting(*table_[:, :3].T) if overall is None else overall))
    m["thresholds"] = {None: 0.3}
    for language in sorted(set(spoken.tolist()) - {""}):
        own = part(spoken == language)
        if own is not None:
            m["thresholds"][language] = float(1 / (1 + np.exp(-(own + m["shift"]))))
    return pickle.dumps(m)


def id_bucket(key: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def digest(text: Column) -> Column:
    """Tells texts of one id apart; null is empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), label: str = "toxic", key: str = "doc_id",
          text: str = "text", language: str = "lang") -> bytes:
    """Fit on a bounded sample, in one task.

    The sample is drawn from ids and digests alone: ids and rows are both bounded by ``settings.sample``, so they are broadcast to the
    scan of the texts, and no text that is not learned from is moved.
    """
    marked = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(label).alias("wanted"))
    marked = stored(marked.withColumn("order", F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string")), 1)), "toxicity-labels")
    # Twice the rows that are wanted have an order below this, so no task sorts more than those.
    share = min(1.0, 2 * settings.sample / max(1, marked.count()))
    drawn = marked.filter(F.col("order") <= share * 2.0**63).orderBy("order", "id").limit(settings.sample).drop("order")
    spoken = F.col(language) if language in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), spoken.alias("language"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    # An id can have any number of rows: equal ones count once, and the others are drawn by a second hash before texts meet.
    known = stored(rows.select("id", "digest").join(F.broadcast(drawn), "id").distinct().withColumn(
        "order", F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string"), "digest"), 1)), "toxicity-rows")
    share = min(1.0, 2 * settings.sample / max(1, known.count()))
    known = stored(known.filter(F.col("order") <= share * 2.0**63).orderBy("order", "id", "digest").limit(settings.sample).drop("order"), "toxicity-sample")
    lessons = rows.join(F.broadcast(known), ["id", "digest"]).groupBy("id", "digest").agg(
        F.min("text").alias("text"), F.max(F.col("wanted").cast("int")).alias("wanted"))

    def run(batches):
        parts = pa.Table.from_batches(list(batches), pa.schema([("id", pa.string()), ("text", pa.string()), ("wanted", pa.int32())]))
        parts = parts.sort_by([("id", "ascending"), ("text", "ascending")])
        model = learn(parts["text"].to_pylist(), parts["wanted"].to_numpy(), settings)
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    one = lessons.select(F.col("id").cast("string"), "text", "wanted").repartition(1).mapInArrow(
        run, T.StructType([T.StructField("model", T.BinaryType())]))
    got = one.collect()
    model = bytes(got[0]["model"]) if got else learn([], np.zeros(0), settings)
    return calibrated(model, rows, marked, known, settings)


def score(docs: DataFrame, model: bytes, text: str = "text", keep: list[str] | None = None, into: str = "toxicity") -> DataFrame:
    """The columns ``keep`` and a struct ``into`` with the ``score`` of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held: list[Scorer] = []

    def compute(texts):
        if not held:
            held.append(Scorer(shared.value))
        return [held[0](texts)]

    return map_texts(docs, text, compute, [T.StructField("score", T.DoubleType())], into, keep, SMALL_CHUNK_BYTES)


def threshold(model: bytes, language: Column) -> Column:
    """The decision threshold of each row's language."""
    thresholds = Scorer(model).thresholds
    chosen = F.lit(thresholds[None])
    for name, value in thresholds.items():
        if name is not None:
            chosen = F.when(language == name, F.lit(value)).otherwise(chosen)
    return chosen


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.filter(id_bucket(F.col("doc_id"), 4) != 2))
    return score(docs, model, keep=["doc_id"]).select(
        "doc_id", (id_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "toxicity.score",
        F.when(F.col("toxicity.score") >= 0.3, 1).otherwise(0).alias("predicted"))
