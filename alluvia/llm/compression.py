"""Quality by compression: two zstandard dictionaries, and a calibrated score from compressed sizes.

One dictionary is built from good and one from bad labelled text. A whole text is compressed in independent blocks with either, so
that the dictionaries count at every place of it. The normalised difference of the two sizes says which kind of text it is nearer to,
the good size's share of the text says how repetitive it is; a logistic curve over these and the text's length gives the score.

The dictionaries read at most ``Settings.sample`` labelled rows of each class, of one half of all ids (by a hash), and of these rows'
text a hashed choice of blocks, about ``Settings.sample_bytes`` of each class. All labelled rows outside this sample calibrate the curve,
whatever their number: they are counted in cells of a grid of fixed size, and only these counts reach the driver.

Null and empty texts have size 0 and get what the curve gives there. Without labelled text of both classes every score is the
smoothed share of good labels. A null label or id is no label; of conflicting labels of one id the worst counts. Repeated
rows are learned from once and scored each; an empty table gives an empty result; labels and ids are no inputs of a score.
"""

from __future__ import annotations

import pickle
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia.llm.store import stored
from alluvia.llm.words import map_texts
from alluvia.queries.registry import table

#: The calibration grid: cells in a unit of the difference, of the share and of the binary logarithm of the length. With differences
#: from -1 to 1, shares up to 2 (a block can grow a little) and logarithms up to 40 there are at most 400 x 100 x 40 cells.
CELLS = (200, 50, 1)
TOP = (1.0, 2.0, 40.0)


@dataclass(frozen=True)
class Settings:
    """``sample`` and ``sample_bytes`` bound what each dictionary is built from, whatever the table's size."""

    sample: int = 4_000
    sample_bytes: int = 8_000_000
    dictionary: int = 1 << 18
    block: int = 1024
    level: int = 3


def blocks_of(text: str | None, size: int) -> list[bytes]:
    raw = text.encode() if text else b""
    return [raw[k:k + size] for k in range(0, len(raw), size)]


def dictionary(samples: list[bytes], settings: Settings) -> bytes:
    """A trained dictionary; the samples themselves where they are too few to train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(settings.dictionary, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-settings.dictionary:]


class Sizes:
    """Compressed sizes of whole texts under the two dictionaries."""

    def __init__(self, bad: bytes, good: bytes, settings: Settings):
        import zstandard

        self.settings = settings
        self.compressors = []
        for made in (bad, good):
            d = zstandard.ZstdCompressionDict(made)
            d.precompute_compress(level=settings.level)
            self.compressors.append(zstandard.ZstdCompressor(
                level=settings.level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """Of each text: normalised difference, share of the good size, binary logarithm of the length."""
        bad, good = (c.compress for c in self.compressors)
        sizes = np.zeros((len(texts), 3), np.float64)
        for n, text in enumerate(texts):
            for b in blocks_of(text, self.settings.block):
                sizes[n] += len(bad(b)), len(good(b)), len(b)
        both = np.maximum(sizes[:, 0] + sizes[:, 1], 1)
        made = np.stack([(sizes[:, 0] - sizes[:, 1]) / both, sizes[:, 1] / np.maximum(sizes[:, 2], 1), np.log2(1 + sizes[:, 2])], 1)
        return np.clip(made, (-1, 0, 0), TOP)


def terms(measured: np.ndarray) -> np.ndarray:
    """What the curve is linear in."""
    difference, share, length = measured.T
    return np.stack([np.ones(len(measured)), 20 * difference, share, length / 10, 2 * difference * length, share**2, 1 / (share + 0.05)], 1)


def curve(measured: np.ndarray, good: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton steps. Targets are a little inside 0 and 1, by the number of rows of each class."""
    x, n = terms(measured), times.astype(np.float64)
    n_good, n_bad = float(n[good].sum()), float(n[~good].sum())
    wanted = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w)), x.T @ (n * (p - wanted)) + 1e-3 * w)
        w -= step * min(1.0, 5 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return w


class Scorer:
    def __init__(self, model: bytes):
        self.model = pickle.loads(model)
        if "constant" not in self.model:
            self.sizes = Sizes(self.model["bad"], self.model["good"], self.model["settings"])

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if "constant" in self.model:
            return np.full(len(texts), self.model["constant"])
        return 1 / (1 + np.exp(-np.clip(terms(self.sizes(texts)) @ self.model["weights"], -30, 30)))


def _drawn(rows: DataFrame, by: list[str], most: int, purpose: str) -> DataFrame:
    """At most ``most`` rows of each class, those of the least hash of ``by``."""
    rows = stored(rows.withColumn("order", F.shiftrightunsigned(F.xxhash64(*by), 1)), purpose)
    counted = {r.wanted: r["count"] for r in rows.groupBy("wanted").count().collect()}
    # Only twice the rows that are wanted lie below this, so that no task sorts more.
    share = F.when(F.col("wanted"), min(1.0, 2 * most / max(1, counted.get(True, 1)))).otherwise(min(1.0, 2 * most / max(1, counted.get(False, 1))))
    some = rows.filter(F.col("order") <= share * 2.0**63)
    first = F.row_number().over(Window.partitionBy("wanted").orderBy("order", *by))
    return some.withColumn("rank", first).filter(F.col("rank") <= most).drop("rank", "order")


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), label: str = "quality", key: str = "doc_id",
          text: str = "text") -> bytes:
    """Dictionaries from the sample, in one task; the curve from all other labelled rows."""
    spark = docs.sparkSession
    marked = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        (F.min(label) >= 1).alias("wanted"))
    marked = stored(marked, "compression-labels")
    rows = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("text")).withColumn(
        "digest", F.xxhash64(F.coalesce("text", F.lit(""))))
    ids = _drawn(marked.filter(F.xxhash64(F.col("id"), F.lit("half")) % 2 == 0), ["id"], settings.sample, "compression-ids")
    # An id can have any number of rows: equal ones count once, the others are drawn by a second hash. Both draws are bounded by
    # the sample, so they are broadcast, and no text that is not learned from is moved.
    named = rows.select("id", "digest", F.octet_length("text").alias("bytes")).join(F.broadcast(stored(ids, "compression-drawn")), "id")
    named = named.groupBy("id", "digest", "wanted").agg(F.max("bytes").alias("bytes"))
    known = stored(_drawn(named, ["id", "digest"], settings.sample, "compression-rows"), "compression-sample")
    total = {r.wanted: r.bytes for r in known.groupBy("wanted").agg(F.sum("bytes").alias("bytes")).collect()}
    kept = {w: min(1.0, settings.sample_bytes / max(1, total.get(w) or 1)) * 2**32 for w in (False, True)}

    def cut(batches):
        for batch in batches:
            for wanted, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                chosen = [b for b in blocks_of(body, settings.block) if zlib.crc32(b) < kept[wanted]]
                yield pa.RecordBatch.from_arrays([pa.array([wanted] * len(chosen), pa.bool_()), pa.array(chosen, pa.binary())], ["wanted", "block"])

    def build(batches):
        held: dict[bool, list[bytes]] = {False: [], True: []}
        for batch in batches:
            for wanted, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[wanted].append(b)
        made = [dictionary(sorted(held[w], key=lambda b: (zlib.crc32(b), b)), settings) for w in (False, True)]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in made], ["bad", "good"])

    lessons = rows.join(F.broadcast(known.select("id", "digest", "wanted")), ["id", "digest"])
    # Distinct blocks: rows that repeat a text don't weigh more, and few bytes go to the one task that builds the dictionaries.
    blocks = lessons.select("wanted", "text").mapInArrow(cut, "wanted boolean, block binary").distinct()
    made = blocks.repartition(1).mapInArrow(build, "bad binary, good binary").collect()
    if not made or not made[0].bad or not made[0].good:
        got = marked.agg(F.count("*").alias("n"), F.count_if("wanted").alias("good")).first()
        return pickle.dumps({"constant": (got.good + 1) / (got.n + 2)})
    bad, good = bytes(made[0].bad), bytes(made[0].good)
    shared = spark.sparkContext.broadcast((bad, good))
    held: list[Sizes] = []

    def measure(texts):
        if not held:
            held.append(Sizes(*shared.value, settings))
        return list(held[0](texts).T)

    names = ("difference", "share", "length")
    measured = map_texts(rows, "text", measure, [T.StructField(n, T.DoubleType()) for n in names], "m", ["id", "digest"])
    cell = [F.floor(F.col(f"m.{n}") * k).alias(f"c_{n}") for n, k in zip(names, CELLS, strict=True)]
    once = measured.groupBy("id", "digest").agg(F.first("m").alias("m"))
    once = once.join(F.broadcast(known.select("id", "digest", F.lit(True).alias("learned"))), ["id", "digest"], "left")
    sums = [F.sum(f"m.{n}").alias(n) for n in names]
    # Summed by id and cell first: an id with very many rows meets its label as a few sums.
    by_id = once.groupBy("id", F.coalesce("learned", F.lit(False)).alias("learned"), *cell).agg(*sums, F.count("*").alias("n"))
    cells = by_id.join(marked, "id").groupBy("wanted", "learned", *(f"c_{n}" for n in names)).agg(
        *(F.sum(n).alias(n) for n in (*names, "n"))).collect()
    x = np.array([[c[n] / c.n for n in names] for c in cells], np.float64).reshape(-1, 3)
    wanted, learned, n = (np.array([c[k] for c in cells]) for k in ("wanted", "learned", "n"))
    use = ~learned.astype(bool)
    if not (wanted[use].any() and (~wanted[use]).any()):  # no labels outside the sample: those inside have to do
        use[:] = True
    return pickle.dumps({"bad": bad, "good": good, "settings": settings, "weights": curve(x[use], wanted[use], n[use])})


def score(docs: DataFrame, model: bytes, text: str = "text", keep: list[str] | None = None, into: str = "quality") -> DataFrame:
    """The columns ``keep`` and a struct ``into`` with the ``score`` of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held: list[Scorer] = []

    def compute(texts):
        if not held:
            held.append(Scorer(shared.value))
        return [held[0](texts)]

    return map_texts(docs, text, compute, [T.StructField("score", T.DoubleType())], into, keep)


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4
    model = train(docs, labels.filter(part != 2))
    return score(docs, model, keep=["doc_id"]).select(
        "doc_id", (part == 2).alias("held_out"), "quality.score",
        F.when(F.col("quality.score") >= 0.7, 1).otherwise(0).alias("predicted"))
