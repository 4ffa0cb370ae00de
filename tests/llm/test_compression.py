"""The compression classifier: held-out accuracy, exact sizes, and odd tables."""

from __future__ import annotations

import random
import zlib

import numpy as np
import zstandard
from pyspark.sql import functions as F

from alluvia.llm import compression
from alluvia.llm.queries import QUERIES
from alluvia.queries.registry import table


def test_held_out_rows(llm):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op11_quality_classifier"](llm, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(table(llm, folder, "labels"), "doc_id", "left").collect()
    assert len(rows) == table(llm, folder, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.quality is not None]
    right = {k: [r.predicted == k for r in held if r.quality == k] for k in (0, 1)}
    assert np.mean(right[1]) >= 0.97 and np.mean(right[0]) >= 0.93
    # Calibrated: as many good ones as the scores say, within 3 %.
    assert abs(np.mean([r.score for r in held]) - np.mean([r.quality for r in held])) < 0.03


def test_labels_of_the_held_out_fold_are_not_read(llm):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(llm, folder, "documents"), table(llm, folder, "labels")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    flipped = labels.withColumn("quality", F.when(part == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    models = [compression.train(docs, x.filter(part != 2)) for x in (labels, flipped)]
    scores = [{r.doc_id: r.quality.score for r in compression.score(docs, m, keep=["doc_id"]).collect()} for m in models]
    assert scores[0] == scores[1]


def test_sizes_are_those_of_whole_texts():
    settings = compression.Settings(block=64)
    texts = [None, "", "x", "été " * 500, "abc " * 3 + "#" * 1000]
    bad, good = b"#%$# $%#" * 50, "été abc ".encode() * 50
    got = compression.Sizes(bad, good, settings)(texts)
    for text, (difference, share, length) in zip(texts, got, strict=True):
        raw = (text or "").encode()
        sizes = []
        for d in (bad, good):
            c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
            sizes.append(sum(len(c.compress(raw[k:k + 64])) for k in range(0, len(raw), 64)))
        assert abs(difference - (sizes[0] - sizes[1]) / max(1, sum(sizes))) < 1e-12
        assert abs(share - min(2, sizes[1] / max(1, len(raw)))) < 1e-12 and length == np.log2(1 + len(raw))


def test_bounded_sample_and_a_hot_id(llm):
    rng = random.Random(3)
    good = [" ".join(f"word{rng.randrange(300)}" for _ in range(60)) for _ in range(200)]
    junk = ["".join(rng.choice("#$%&*|<>") for _ in range(300)) for _ in range(200)]
    rows = [(n, t) for n, t in enumerate(good + junk)] + [(7, x) for x in good for _ in range(3)]  # id 7 has most rows
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    labels = llm.createDataFrame([(n, int(n < 200)) for n in range(400)] + [(3, None), (None, 1)], "doc_id bigint, quality int")
    model = compression.train(docs, labels, compression.Settings(sample=40, sample_bytes=4000))
    scored = compression.score(docs, model).collect()
    assert sum((r.quality.score >= 0.7) == (r.text[0] == "w") for r in scored) >= 0.98 * len(scored)


def test_odd_rows_and_few_labels(llm, odd, nothing):
    labels = llm.createDataFrame([(5, 1), (6, 0)], "doc_id bigint, quality int")
    none = labels.filter("false")
    for given in (labels, none, labels.filter("quality = 1")):
        model = compression.train(odd, given)
        scored = compression.score(odd, model)
        assert scored.columns == [*odd.columns, "quality"] and scored.count() == odd.count()
        assert scored.filter("quality.score between 0 and 1").count() == odd.count()
        assert compression.score(nothing, model).count() == 0
    assert compression.Scorer(compression.train(nothing, labels))(["x"])[0] == 0.5
