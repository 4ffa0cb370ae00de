"""Near-duplicate groups by improved consistent weighted sampling over TF-IDF shingles.

* Shingles are five words (A-Z lower-cased); the j-th repetition of a shingle in a text is an element of its own, so term frequency
  is a matter of sets. An element weighs the idf of its shingle, ``ln(1 + N / df)``, relative to that at a df of ``rare`` of all documents;
  rarer shingles weigh 1, and none weighs below ``least_weight``. Shingles above ``rare`` are few whatever the corpus (their number is at most shingles per document / rare), and
  they are found exactly: hashed counters over all documents name the heavy buckets, a second pass counts the shingles in those.
* Consistent weighted sampling gives every text ``bands * rows`` samples; two texts agree in a sample with the probability of their
  weighted Jaccard similarity. Texts that agree in all rows of a band are candidates.
* In a band's group each text is linked to those its samples agree with best (a spanning forest), never all with all. Links are
  verified on the elements: weighted Jaccard similarity, or the unweighted one, of at least ``similarity``.
* Groups whose texts are then still in several components are compared exactly, in blocks of bounded size that return links between
  components only. So no link between candidates is lost, and no pair list of a group is ever written.
* Components are found by label propagation with pointer jumping over stored tables.

Exact copies are one text: texts are told apart by a 64-bit digest, and only their ids are joined back. Elements are compared as 32-bit
hashes. Texts of one to four words are one shingle. Texts without words, empty and null ones alike, are copies of the text they
equal and near nothing else. Every row gets a class, rows with a null id too; repeated rows share one. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia.llm.store import stored
from alluvia.llm.words import SMALL_CHUNK_BYTES, Words, mixed, text_batches
from alluvia.llm.workers import small_batches
from alluvia.queries.registry import table


@dataclass(frozen=True)
class Settings:
    words: int = 5
    similarity: float = 0.8
    bands: int = 24
    rows: int = 4
    rare: float = 0.01
    bucket_bits: int = 18
    least_weight: float = 0.5  # of any shingle: so copies agree in many samples even where their group is most of the corpus
    likely: float = 0.5  # agreement of samples below which a candidate is not verified
    block: int = 512


def digest(text: Column) -> Column:
    """64 bits of the text's md5."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit("")).cast("binary")), 1, 16), 16, -10).cast("long")


def shingles(texts: list[str | None], settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every text with their numbers: text, hash, count; sorted by text."""
    w = Words(texts, fold=True)
    hashes = w.hashes()
    _, text, window = w.windows(hashes, settings.words)
    short = np.flatnonzero((w.counts > 0) & (w.counts < settings.words))
    for t in short:  # one shingle each
        own = hashes[w.first[t]:w.last[t]]
        window = np.append(window, mixed(np.bitwise_xor.reduce(mixed(own + np.arange(len(own), dtype=np.uint64)), keepdims=True)))
        text = np.append(text, t)
    order = np.lexsort((window, text))
    text, window = text[order], window[order]
    new = np.flatnonzero(np.concatenate([[True], (window[1:] != window[:-1]) | (text[1:] != text[:-1])])) if len(text) else np.zeros(0, int)
    return text[new], window[new], np.diff(np.append(new, len(text)))


def gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at the middles of n equal shares."""
    x = np.concatenate([np.geomspace(1e-6, 1e-2, 2000)[:-1], np.linspace(1e-2, 40, 200_000)])
    return np.interp((np.arange(n) + 0.5) / n, 1 - (1 + x) * np.exp(-x), x)


class Sampler:
    """Consistent weighted samples; every number depends on the element, its weight and the sample's number alone."""

    def __init__(self, n: int):
        rng = np.random.default_rng(11)
        self.factors = rng.integers(1 << 62, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.r = gamma_quantiles(1 << 12).astype(np.float32)
        self.log_c = np.log(gamma_quantiles(1 << 16)).astype(np.float32)

    def samples(self, elements: np.ndarray, log_weight: np.ndarray | None, starts: np.ndarray, step: int = 1 << 15) -> np.ndarray:
        """Per text (``starts`` of its elements, none empty) the smallest ln a of every sample, as 32 bits."""
        made = np.full((len(starts), len(self.factors)), np.inf, np.float32)
        edges = np.append(starts, len(elements))
        first = 0
        while first < len(starts):
            last = max(first + 1, int(np.searchsorted(edges, edges[first] + step, "right")) - 1)
            a, b = edges[first], edges[last]
            h, own = elements[a:b], starts[first:last] - a
            lw = None if log_weight is None else log_weight[a:b]
            for k, factor in enumerate(self.factors):
                x = h * factor
                x ^= x >> np.uint64(32)
                r = self.r[x >> np.uint64(52)]
                beta = ((x & np.uint64(0xFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(1 / 65536)
                if lw is None:  # floor(0 / r + beta) is 0
                    log_a = self.log_c[(x >> np.uint64(24)) & np.uint64(0xFFFF)] - r * (1 - beta)
                else:
                    log_a = self.log_c[(x >> np.uint64(24)) & np.uint64(0xFFFF)] - r * (np.floor(lw / r + beta) - beta + 1)
                made[first:last, k] = np.minimum.reduceat(log_a, own)
            first = last
        return made.view(np.uint32)


def frequent_shingles(texts: DataFrame, n: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and idf weights of the shingles in more than ``rare`` of the ``n`` documents; their number is bounded."""
    least, size, part = settings.rare * n, 1 << settings.bucket_bits, 1 << 12

    def buckets(batches):
        counts = np.zeros(size, np.int64)
        for (column,) in text_batches(batches, "text", most=SMALL_CHUNK_BYTES):
            counts += np.bincount((shingles(column.to_pylist(), settings)[1] % np.uint64(size)).astype(np.int64), minlength=size)
        for at in range(0, size, part):
            if counts[at:at + part].any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([counts[at:at + part].astype(np.int32).tobytes()])], ["at", "counts"])

    def added(group: pa.Table) -> pa.Table:
        total = 0
        for c in group["counts"]:
            total = total + np.frombuffer(c.as_buffer(), np.int32).astype(np.int64)
        heavy = np.flatnonzero(total >= least) + group["at"][0].as_py()
        return pa.table({"bucket": pa.array(heavy, pa.int64())})

    kind = T.StructType([T.StructField("at", T.LongType()), T.StructField("counts", T.BinaryType())])
    heavy = texts.select("text").mapInArrow(buckets, kind).groupBy("at").applyInArrow(
        added, T.StructType([T.StructField("bucket", T.LongType())])).toArrow()["bucket"].to_numpy()
    if not len(heavy):
        return np.zeros(0, np.uint64), np.zeros(0, np.float32)
    marked = np.zeros(size, bool)
    marked[heavy] = True
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(marked))

    def counted(batches):
        wanted = np.unpackbits(shared.value).astype(bool)
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for (column,) in text_batches(batches, "text", most=SMALL_CHUNK_BYTES):
            h = shingles(column.to_pylist(), settings)[1]
            h = h[wanted[(h % np.uint64(size)).astype(np.int64)]]
            keys, inverse = np.unique(np.concatenate([keys, h]), return_inverse=True)
            counts = np.bincount(inverse, weights=np.concatenate([counts, np.ones(len(h), np.int64)]), minlength=len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["hash", "n"])

    kind = T.StructType([T.StructField("hash", T.LongType()), T.StructField("n", T.LongType())])
    rows = texts.select("text").mapInArrow(counted, kind).groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") > least).toArrow()
    hashes, counts = rows["hash"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(hashes)
    weights = np.log(1 + n / counts[order]) / np.log(1 + 1 / settings.rare)
    return hashes[order], np.maximum(weights, settings.least_weight).astype(np.float32)


class Weights:
    def __init__(self, hashes: np.ndarray, weights: np.ndarray):
        self.hashes, self.weights = hashes, weights

    def of(self, h: np.ndarray) -> np.ndarray | None:
        """None when every one weighs 1."""
        if not len(self.hashes):
            return None
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        met = self.hashes[at] == h
        return np.where(met, self.weights[at], np.float32(1)) if met.any() else None


_SIGNED = T.StructType([
    T.StructField("node", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("samples", T.BinaryType()),
    T.StructField("elements", T.BinaryType()), T.StructField("weights", T.BinaryType()),
])


def signed(texts: DataFrame, weights: Weights, settings: Settings) -> DataFrame:
    """Per distinct text of each task: band keys, samples (16 bits each), sorted elements and, where not all 1, their weights."""
    shared = texts.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        sampler, idf, met = Sampler(settings.bands * settings.rows), shared.value, set()
        for column, nodes in text_batches(batches, "text", "node", most=SMALL_CHUNK_BYTES):
            kept = [(n, t) for n, t in zip(nodes.to_pylist(), column.to_pylist(), strict=True) if not (n in met or met.add(n))]
            if not kept:
                continue
            text, h, count = shingles([t for _, t in kept], settings)
            if not len(text):
                continue
            of = np.repeat(np.arange(len(text)), count)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            element = mixed(h[of] + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            weight, text = idf.of(h[of]), text[of]
            starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
            samples = sampler.samples(element, None if weight is None else np.log(weight), starts)
            keys = np.empty((len(starts), settings.bands), np.uint64)
            for b in range(settings.bands):
                key = np.full(len(starts), b, np.uint64)
                for k in range(b * settings.rows, (b + 1) * settings.rows):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + samples[:, k])
                keys[:, b] = key
            short = (samples ^ (samples >> np.uint32(16))).astype(np.uint16)
            small = (element >> np.uint64(32)).astype(np.uint32)
            ends = np.append(starts[1:], len(text))
            elements, given = [], []
            for a, b in zip(starts, ends, strict=True):
                order = np.argsort(small[a:b])
                elements.append(small[a:b][order].tobytes())
                given.append(b"" if weight is None or (weight[a:b] == 1).all() else weight[a:b][order].tobytes())
            yield pa.RecordBatch.from_arrays([
                pa.array([kept[t][0] for t in text[starts]], pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(starts) + 1, dtype=np.int32) * settings.bands), pa.array(keys.ravel().view(np.int64))),
                pa.array([s.tobytes() for s in short], pa.binary()), pa.array(elements, pa.binary()), pa.array(given, pa.binary()),
            ], _SIGNED.fieldNames())

    return texts.select("text", "node").mapInArrow(run, _SIGNED)


def runs(batches, key: list[str], most: int):
    """Stretches of rows with equal keys from sorted Arrow batches, as dicts of lists; longer ones in pieces of ``most`` rows."""
    held, last = None, None
    for batch in batches:
        columns = batch.to_pydict()
        keys = list(zip(*(columns[k] for k in key), strict=True))
        a = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[a]:
                if keys and last == keys[a]:
                    for c in held:
                        held[c].extend(columns[c][a:i])
                elif keys:
                    if held:
                        yield held
                    held, last = {c: columns[c][a:i] for c in columns}, keys[a]
                while held and len(held[key[0]]) > most:
                    yield {c: v[:most] for c, v in held.items()}
                    # The first row stays with every piece, so that pieces have one text in common.
                    held = {c: v[:1] + v[most:] for c, v in held.items()}
                a = i
    if held:
        yield held


def forest(agreement: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Edges of a maximum spanning forest over pairs of at least ``least``, by repeated best choice of each component."""
    n = len(agreement)
    component, edges = np.arange(n), []
    while True:
        outside = np.where(component[:, None] == component[None, :], -1, agreement)
        best = outside.argmax(1)
        value = outside[np.arange(n), best]
        if value.max(initial=-1) < least:
            return edges
        for c in np.unique(component):
            own = np.flatnonzero(component == c)
            i = own[value[own].argmax()]
            if value[i] >= least and component[i] != component[best[i]]:
                edges.append((int(i), int(best[i])))
                component[component == component[i]] = component[best[i]]


_PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _pairs(made: list[tuple[int, int]]) -> pa.RecordBatch:
    made = [(min(p), max(p)) for p in made]
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in made], pa.int64()), pa.array([p[1] for p in made], pa.int64())], ["a", "b"])


def candidates(groups: DataFrame, settings: Settings) -> DataFrame:
    """Pairs worth verifying from rows (band, node, samples): each group's forest."""
    def run(batches):
        found = []
        for g in runs(batches, ["band"], 2 * settings.block):
            nodes = g["node"]
            s = np.stack([np.frombuffer(x, np.uint16) for x in g["samples"]])
            if len(nodes) == 2:
                if (s[0] == s[1]).mean() >= settings.likely:
                    found.append((nodes[0], nodes[1]))
            elif len(nodes) > 2:
                agreement = np.zeros((len(nodes), len(nodes)), np.float32)
                for k in range(s.shape[1]):
                    agreement += s[:, k, None] == s[None, :, k]
                found.extend((nodes[i], nodes[j]) for i, j in forest(agreement / s.shape[1], settings.likely))
            if len(found) > 20_000:
                yield _pairs(list(dict.fromkeys(found)))
                found = []
        yield _pairs(list(dict.fromkeys(found)))

    dealt = groups.select("band", "node", "samples").repartition("band").sortWithinPartitions("band", "node")
    return dealt.mapInArrow(run, _PAIR).distinct()


def similar(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray, least: float) -> bool:
    """Weighted or unweighted Jaccard similarity of two sorted element arrays."""
    _, i, j = np.intersect1d(a, b, assume_unique=False, return_indices=True)
    if len(i) >= least * (len(a) + len(b) - len(i)):
        return True
    if not len(wa) and not len(wb):
        return False
    wa, wb = (w if len(w) else np.ones(n, np.float32) for w, n in ((wa, len(a)), (wb, len(b))))
    both = np.minimum(wa[i], wb[j]).sum()
    return bool(both >= least * (wa.sum() + wb.sum() - both))


def verified(pairs: DataFrame, rows: DataFrame, settings: Settings) -> DataFrame:
    """The pairs that are similar enough. ``rows`` has node, elements, weights."""
    left = rows.select(F.col("node").alias("a"), F.col("elements").alias("ea"), F.col("weights").alias("wa"))
    right = rows.select(F.col("node").alias("b"), F.col("elements").alias("eb"), F.col("weights").alias("wb"))

    def run(batches):
        for batch in batches:
            c = batch.to_pydict()
            kept = [(a, b) for a, b, ea, wa, eb, wb in zip(c["a"], c["b"], c["ea"], c["wa"], c["eb"], c["wb"], strict=True)
                    if similar(np.frombuffer(ea, np.uint32), np.frombuffer(wa, np.float32),
                               np.frombuffer(eb, np.uint32), np.frombuffer(wb, np.float32), settings.similarity)]
            yield _pairs(kept)

    return pairs.join(left, "a").join(right, "b").select("a", "b", "ea", "wa", "eb", "wb").mapInArrow(run, _PAIR)


def components(links: DataFrame, n: int | None = None) -> DataFrame:
    """(node, label) of every node that has a link: the least node it is connected with. ``n`` is the number of texts."""
    edges = stored(links.union(links.select("b", "a")).distinct(), "near-edges", n)
    labels = stored(edges.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "near-labels", n)
    while True:
        seen = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        moved = stored(labels.join(seen, "node").join(jump, "label").select(
            "node", F.least("label", "near", "far").alias("label"), (F.least("label", "near", "far") < F.col("label")).alias("moved")), "near-labels", n)
        if moved.filter("moved").isEmpty():
            return moved.select("node", "label")
        labels = moved.select("node", "label")


def linked_in_block(nodes, labels, elements, weights, settings: Settings) -> list[tuple[int, int]]:
    """Links between different components of a block, one for each pair of components."""
    sets = [np.frombuffer(e, np.uint32) for e in elements]
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    given = np.concatenate([np.frombuffer(w, np.float32) if w else np.ones(n, np.float32) for w, n in zip(weights, sizes, strict=True)])
    _, column, times = np.unique(every, return_inverse=True, return_counts=True)
    common = times[column] > 1
    place = np.cumsum(times > 1) - 1
    totals = np.bincount(owner, weights=given, minlength=len(sets))
    both, both_weighted = np.zeros((len(sets),) * 2, np.float32), np.zeros((len(sets),) * 2, np.float32)
    order = np.argsort(column[common], kind="stable")
    own, col, w = owner[common][order], place[column[common]][order], given[common][order]
    width = 2048
    for first in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        a, b = np.searchsorted(col, [first, first + width])
        x = np.zeros((len(sets), width), np.float32)
        x[own[a:b], col[a:b] - first] = 1
        both += x @ x.T
        x[own[a:b], col[a:b] - first] = np.sqrt(w[a:b])  # an element weighs the same in every text
        both_weighted += x @ x.T
    near = (both >= settings.similarity * (sizes[:, None] + sizes[None, :] - both)) | (
        both_weighted >= settings.similarity * (totals[:, None] + totals[None, :] - both_weighted) - 1e-3)
    code = np.unique(np.array(labels), return_inverse=True)[1]
    i, j = np.nonzero(np.triu(near & (code[:, None] != code[None, :]), 1))
    low, high = np.minimum(code[i], code[j]), np.maximum(code[i], code[j])
    pick = np.unique(low * len(sets) + high, return_index=True)[1]
    return [(nodes[i[p]], nodes[j[p]]) for p in pick]


def remaining(groups: DataFrame, labels: DataFrame, rows: DataFrame, settings: Settings, n: int | None = None) -> DataFrame:
    """Links between components inside groups of three and more, compared exactly block against block."""
    named = groups.select("band", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed_groups = named.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"),
                                             F.bit_xor(F.xxhash64("node")).alias("members"))
    # Bands often put the same texts together: one of them is enough.
    open_groups = mixed_groups.filter("size > 2 AND low < high").groupBy("members", "size").agg(F.min("band").alias("band"))
    numbered = named.join(open_groups.select("band", "size"), "band").withColumn(
        "block", F.floor(F.rand(5) * F.ceil(F.col("size") / settings.block)))
    numbered = stored(numbered, "near-blocks", n)  # the drawn blocks must not change
    blocks = F.ceil(F.col("size") / settings.block)
    pair = lambda x: F.struct(F.least("block", x).alias("i"), F.greatest("block", x).alias("j"))
    dealt = numbered.withColumn("p", F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda x: pair(x.cast("long")))))
    dealt = dealt.join(rows.select("node", "elements", "weights"), "node").select(
        "band", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "node", "label", "elements", "weights")

    def run(batches):
        for g in runs(batches, ["band", "i", "j"], 8 * settings.block):
            if len(set(g["label"])) > 1:
                yield _pairs(linked_in_block(g["node"], g["label"], g["elements"], g["weights"], settings))

    return dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "node").mapInArrow(run, _PAIR).distinct()


def classes(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """(node, label) for texts that are near others; ``digest`` of a text is its node, and its own label where it is not listed."""
    with small_batches(docs.sparkSession):  # rows with the elements of two texts are long
        return _classes(docs, settings, text)


def _classes(docs: DataFrame, settings: Settings, text: str) -> DataFrame:
    texts = docs.select(F.col(text).alias("text"), digest(F.col(text)).alias("node"))
    n = texts.count()
    weights = Weights(*frequent_shingles(texts, n, settings))
    signs = stored(signed(texts, weights, settings), "near-signs", n)
    per_band = signs.select("node", F.explode("bands").alias("band")).distinct()
    several = per_band.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("band")
    groups = stored(per_band.join(several, "band"), "near-groups", n)
    wanted = groups.select("node").distinct()
    kept = signs.join(wanted, "node").dropDuplicates(["node"]).select("node", "samples", "elements", "weights")
    rows = stored(kept, "near-rows", n)
    links = stored(verified(candidates(groups.join(rows.select("node", "samples"), "node"), settings), rows, settings), "near-links", n)
    labels = components(links, n)
    more = stored(remaining(groups, labels, rows, settings, n), "near-more", n)
    return labels if more.isEmpty() else components(links.union(more), n)


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, class_id (the least key of the class, if any is not null) and class_size."""
    labels = classes(docs, settings, text)
    ids = docs.select(F.col(key).alias("key"), digest(F.col(text)).alias("node"))
    known = ids.join(labels, "node", "left").select("key", F.coalesce("label", "node").alias("label"))
    # Stored, so that the join below deals both sides anew and a large class can be split.
    per = stored(known.groupBy("label").agg(F.min("key").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "near-classes", docs.count())
    return known.join(per, "label").select(F.col("key").alias(key), "class_id", "class_size")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
