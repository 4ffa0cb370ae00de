"""Operators that look at the whole corpus, and the pipeline."""

from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from alluvia.llm import decontamination, maxent, mixing, near_dedup, quality, store, toxicity, workers
from alluvia.llm.queries import QUERIES
from alluvia.llm.store import LEAST_TASKS, stored
from tests.conf import settings

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# -- near duplicates ---------------------------------------------------------------------------


def true_components(texts):
    """By all pairs: unweighted similarity of the five-word shingles with their numbers."""
    def shingles(t):
        w = WORD.findall(t.translate(LOWER))
        return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()

    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = sum((sets[i] & sets[j]).values())
            if texts[i] == texts[j] or both and both >= 0.8 * (sum(sets[i].values()) + sum(sets[j].values()) - both):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def test_classes_against_all_pairs(llm):
    rng = random.Random(5)
    texts = ["", "", None, "one two three", "one two three", "One two three", "one two four"]
    base = prose(rng, 150)
    texts += [base, base.upper(), base]
    for _ in range(60):  # a chain of edits: neighbours are near, far ones are not
        words = texts[-1].split()
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [prose(rng, 100) for _ in range(40)] + ["same words again and again " * 30, "same words again and again " * 31]
    rows = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(rows).collect()}
    wanted = true_components([t or "" for t in texts])
    by_class, by_component = defaultdict(set), defaultdict(set)
    for i, c in enumerate(wanted):
        by_class[got[i]].add(i)
        by_component[c].add(i)
    assert sorted(map(sorted, by_component.values())) == sorted(map(sorted, by_class.values()))
    assert all(got[i] == min(members) for members in by_class.values() for i in members)


def test_large_group_is_compared_in_blocks(llm):
    rng = random.Random(6)
    base = prose(rng, 120).split()
    texts = []
    for _ in range(90):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8])):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    rows = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    settings = near_dedup.Settings(block=8)  # many blocks and cut runs
    got = [r.class_id for r in sorted(near_dedup.near_duplicates(rows, settings).collect())]
    wanted = true_components(texts)
    assert all((got[i] == got[j]) == (wanted[i] == wanted[j]) for i in range(90) for j in range(i))


def test_samples_agree_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
    weight = rng.uniform(0.2, 1, 600).astype(np.float32)
    a, b = np.arange(0, 500), np.arange(100, 600)
    sampler = near_dedup.Sampler(1500)
    sign = lambda rows: sampler.samples(h[rows], np.log(weight[rows]), np.array([0]))[0]
    similarity = weight[100:500].sum() / weight.sum()
    assert abs((sign(a) == sign(b)).mean() - similarity) < 0.05


def test_frequent_shingles_are_exact(llm):
    texts = ["a b c d e f g"] * 40 + [prose(random.Random(i), 30) for i in range(60)]
    rows = llm.createDataFrame([(t,) for t in texts], "text string").repartition(7)
    hashes, weights = near_dedup.frequent_shingles(rows, 100, near_dedup.Settings(rare=0.1))
    assert len(hashes) == 3 and np.allclose(weights, math.log(1 + 100 / 40) / math.log(1 + 1 / 0.1)) and weights[0] > 0.5


def test_small_intermediates_are_few_files(llm, tmp_path, monkeypatch):
    """A task costs its files, however wide the shuffles before it are."""
    rng = random.Random(5)
    base = prose(rng, 120)
    rows = [(i, base + f" end{i}" if i % 3 else prose(rng, 60)) for i in range(300)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(40)
    monkeypatch.setattr(store, "shared_folder", lambda spark, purpose: f"{tmp_path}/{len(list(tmp_path.iterdir()))}-{purpose}")
    with settings(llm, {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        classes = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert len(classes) == 300 and {classes[i] for i in range(300) if i % 3} == {1}
    written = Counter(p.parent.name for p in tmp_path.rglob("*.parquet"))
    assert written and max(written.values()) <= LEAST_TASKS


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_near_copies_pass_in_small_batches(llm, monkeypatch):
    """Every step that writes runs with small batches; their size changes no class, and the session's setting comes back."""
    rng = random.Random(6)
    bases = [prose(rng, 300) for _ in range(6)]
    rows = [(i, bases[i % 6] + f" end{i}" if i % 4 else prose(rng, 80)) for i in range(240)]
    docs, seen = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(3), []

    def watched(df, purpose, rows=None):
        seen.append(int(df.sparkSession.conf.get(BATCH).rstrip("b")))
        return stored(df, purpose, rows)

    monkeypatch.setattr(near_dedup, "stored", watched)
    found = []
    with settings(llm, {BATCH: "32000000b"}):
        for size in (workers.BATCH_BYTES, 3_000):  # the smaller cuts every group of candidates
            monkeypatch.setattr(workers, "BATCH_BYTES", size)
            seen.clear()
            labels = near_dedup.classes(docs)
            assert llm.conf.get(BATCH) == "32000000b" and seen and set(seen) == {size} and size <= 4 << 20
            found.append({(r.node, r.label) for r in labels.collect()})
    assert found[0] == found[1] and len({label for _, label in found[0]}) == 6 and len(found[0]) == 180


def test_workers_hold_small_arrays(llm, monkeypatch):
    """What the pipeline's Python steps take for one Arrow batch of 4 MB, texts and results included."""
    rng = random.Random(7)
    texts = [prose(rng, 300) for _ in range(2_400)]
    assert sum(map(len, texts)) > 3_500_000
    docs = llm.createDataFrame([(i, texts[0] if i < 9 else t) for i, t in enumerate(texts[:60])], "node bigint, text string")
    taken, real = {}, type(docs).mapInArrow

    def watched(df, func, schema, *rest, **more):
        taken.setdefault(func.__qualname__.split(".")[0] + " " + func.__name__ + f" {len(df.columns)}", func)
        return real(df, func, schema, *rest, **more)

    monkeypatch.setattr(type(docs), "mapInArrow", watched)
    model = toxicity.learn(texts[:40], np.arange(40) % 2, toxicity.Settings(epochs=1))
    weights = near_dedup.Weights(*near_dedup.frequent_shingles(docs, 60, near_dedup.Settings(rare=0.1)))
    near_dedup.signed(docs, weights, near_dedup.Settings())
    steps = dict(taken)
    for name, made in (("quality", lambda: quality.ledger(docs)), ("toxicity", lambda: toxicity.score(docs, model))):
        taken.clear()
        made()
        (steps[name],) = taken.values()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["node", "text"])
    assert len(steps) == 5
    for name, step in steps.items():
        for _ in step(iter([batch.slice(0, 30)])):  # what every worker holds once
            pass
        tracemalloc.start()
        for _ in step(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 40_000_000, name


def test_small_batches_bound_what_a_worker_gets(llm):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    wide = llm.range(0, 2_000, 1, 1).select(F.repeat(F.lit("abcdefgh"), 1_250).alias("text"))
    with workers.small_batches(llm):
        got = wide.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 2_000 and max(r.size for r in got) < workers.BATCH_BYTES + 20_000


# -- decontamination ---------------------------------------------------------------------------

ITEM = "A farmer named Anna has 12 apples and gives 5 kg of pears to her friend Tom who lives in old Berlin near the river"


@pytest.mark.parametrize("text, verbatim", [
    ("Some words before. " + ITEM + " and after", True),
    ("before " + ITEM.lower().replace("anna", "Anna").replace("tom", "Tom").replace("berlin", "Berlin"), True),
    ("x " + ITEM.replace("Anna", "Maria").replace("12", "40").replace("5 kg", "7 lb").replace("Tom", "Paul").replace("Berlin", "Rome"), False),
    ("x " + ITEM.replace("Tom", "Anna"), None),  # two names became one
    ("A farmer named Anna has 12 apples but nothing else is the same as there in what follows", None),
    ("", None), (None, None),
])
def test_reparameterised_items(llm, text, verbatim):
    items = llm.createDataFrame([(1, ITEM), (2, "too short here"), (3, None), (1, ITEM)], "item_id int, text string")
    docs = llm.createDataFrame([(7, text), (7, text), (8, "nothing of that kind is to be found in here at all")], "doc_id int, text string")
    got = decontamination.leaks(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.verbatim) for r in got] == ([] if verbatim is None else [(7, 1, verbatim)])


@pytest.mark.parametrize(("item", "text"), [
    ("12 + 7 = 19, 3 x 4 = 12, 81 / 9 = 9", "so 12 + 7 = 19, 3 x 4 = 12, 81 / 9 = 9 it is"),  # hardly a literal word
    ("What is the capital of France?", "Question: What is the capital of France? Answer: Paris"),  # typed in the document alone
    ("boiling point helium", "we ask for the Boiling Point, helium of course"), ("zyzzyva", "a Zyzzyva!"),
])
def test_exact_copies_of_any_item(llm, item, text):
    items = llm.createDataFrame([(1, item), (2, None), (3, "")], "item_id int, text string")
    docs = llm.createDataFrame([(1, text), (2, "nothing of it: 12, capital, boiling"), (3, None)], "doc_id int, text string")
    found = decontamination.leaks(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.verbatim) for r in found] == [(1, 1, True)]


def test_broadcast_and_shuffle_agree(llm, small):
    docs, items = llm.read.parquet(f"{small}/documents.parquet"), llm.read.parquet(f"{small}/benchmark.parquet")
    plain = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")
    flat = lambda t: " " + " ".join(plain.findall(t.lower())) + " "
    wanted = {(d.doc_id, b.item_id) for d in docs.collect() for b in items.collect() if flat(b.text) in flat(d.text)}
    for rows in (1_000_000, 0):
        got = decontamination.leaks(docs, items, decontamination.Settings(broadcast_rows=rows)).collect()
        assert {(r.doc_id, r.item_id) for r in got} == wanted


# -- mixing ------------------------------------------------------------------------------------


def test_targets_are_met_in_slices(llm):
    rng = random.Random(2)
    sizes = [(i, rng.choice(["a", "b", "c", "d", None]), "w " * rng.randrange(0, 60)) for i in range(3000)]
    rows = llm.createDataFrame(sizes + [(9999, "tiny", "w w w")], "doc_id int, source string, text string")
    whole = {(r.doc_id, r.taken, tuple(r.times)) for r in mixing.mix(rows).collect()}
    for per_slice in (50, 7):
        assert {(r.doc_id, r.taken, tuple(r.times)) for r in mixing.mix(rows, per_slice=per_slice).collect()} == whole
    made = mixing.mix(rows)
    assert made.filter("taken > 3 * size").count() == 0
    source = made.join(rows.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.first("target").alias("target"), F.sum("taken").alias("taken"), F.first("source_size").alias("size")).collect()
    assert all(abs(r.taken - r.target) <= 60 and r.target <= 3 * r["size"] + 1e-6 for r in source)
    assert abs(sum(r.target for r in source) - sum(r["size"] for r in source)) < 1e-6
    times = mixing.curriculum(rows).select("time").rdd.map(lambda r: r[0]).collect()
    assert times == sorted(times) and 0 <= times[0] and times[-1] <= 1


# -- toxicity ----------------------------------------------------------------------------------


def test_unseen_endings_and_held_out_rows(llm):
    rng = random.Random(4)
    stems = ["grobl", "zwackt", "fnord"]

    def text(toxic):
        words = prose(rng, rng.randrange(5, 80)).split()
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(stems) + rng.choice("abcdefgh") + str(rng.randrange(30)))
        return " ".join(words)

    rows = [(i, i % 4 == 0) for i in range(1600)]
    docs = llm.createDataFrame([(i, text(t), "en") for i, t in rows], "doc_id bigint, text string, lang string")
    labels = llm.createDataFrame([(i, int(t)) for i, t in rows] + [(0, 0), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels.filter(toxicity.id_bucket(F.col("doc_id"), 4) != 2))
    scored = {r.doc_id: r.toxicity.score for r in toxicity.score(docs, model).collect()}
    held = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((scored[i] >= 0.3) == t for i, t in held) >= 0.97 * len(held)
    assert toxicity.train(docs, labels.filter(toxicity.id_bucket(F.col("doc_id"), 4) != 2)) == model


def test_sample_bounds_rows(llm, monkeypatch):
    """One id with most rows, equal and different ones."""
    monkeypatch.setattr(toxicity, "learn", lambda texts, wanted, settings: repr(sorted(texts)).encode())
    monkeypatch.setattr(toxicity, "calibrated", lambda model, *_: model)
    docs = llm.createDataFrame([(1, "same", "en")] * 300 + [(1, f"text {k}", "en") for k in range(50)] + [(2, "fine", "en")], "doc_id int, text string, lang string")
    labels = llm.createDataFrame([(1, 1), (2, 0)], "doc_id int, toxic int")
    read = eval(toxicity.train(docs, labels, toxicity.Settings(sample=20)))
    assert len(read) == len(set(read)) == 20
    assert len(eval(toxicity.train(docs, labels, toxicity.Settings(sample=200)))) == 52


def test_thresholds_come_from_all_labelled_rows(llm):
    """A rare language has hardly a row in the sample, but enough labels outside it."""
    rows = [(k, f"{'awful stupid' if k % 2 else 'kind gentle'} words {k}", "xx" if k % 50 < 2 else "en", k % 2) for k in range(4000)]
    docs = llm.createDataFrame(rows, "doc_id int, text string, lang string, toxic int")
    settings = toxicity.Settings(sample=300)
    model = toxicity.train(docs.drop("toxic"), docs.select("doc_id", "toxic"), settings)
    found = toxicity.Scorer(model).thresholds
    assert set(found) == {None, "xx", "en"}
    told = toxicity.score(docs, model).filter((F.col("toxicity.score") >= toxicity.threshold(model, F.col("lang"))) != (F.col("toxic") == 1))
    assert told.count() == 0


def test_no_labels(llm, odd, nothing):
    labels = llm.createDataFrame([(1, 0)], "doc_id bigint, toxic int")
    for few in (labels, labels.limit(0)):
        assert {r.made.score for r in toxicity.score(odd, toxicity.train(odd, few), into="made").collect()} == {0.0}
    assert toxicity.score(nothing, toxicity.train(nothing, labels), into="made").count() == 0


# -- language model ----------------------------------------------------------------------------


def test_base_scores_and_gain(llm, small):
    got = QUERIES["op10_lm_score"](llm, small).collect()
    docs = {r.doc_id: [*WORD.findall((r.text or "").translate(LOWER)), None] for r in llm.read.parquet(f"{small}/documents.parquet").collect()}
    counts = Counter()
    for i, words in docs.items():
        if zlib.crc32(str(i).encode()) % 10:
            counts.update(words)
    total, distinct = sum(counts.values()), len(counts)
    for r in got:
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in docs[r.doc_id])
        assert abs(base - r.base_score) < 1e-6 * abs(base) and r.train_tokens == total
        assert (r.n_tokens, r.n_known) == (len(docs[r.doc_id]), sum(counts[w] > 0 for w in docs[r.doc_id]))
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_probabilities_sum_to_one(llm):
    texts = llm.createDataFrame([("a b c a b. the end of it",), ("b a c. b a",)] * 20, "text string")
    words = stored(maxent.count_words(texts), "test-words")
    model = maxent.corpus_counts(words)
    maxent.learn(texts.withColumn("round", F.lit(0)), model, maxent.Settings(rounds=1, batch=16))
    rows = words.collect()
    keys = np.array([r.key for r in rows]).view(np.uint64)
    classes = model.classes(keys)
    inside = [(r.n + 0.1) / model.word_denominators()[c] if c >= maxent.SINGLES else 1.0 for r, c in zip(rows, classes, strict=True)]
    by_class = np.bincount(classes, weights=inside, minlength=256)
    unknown = np.where(np.arange(256) >= maxent.SINGLES, 0.1 / model.word_denominators(), 0)
    seen = np.unique(classes)
    assert np.allclose((by_class + unknown)[seen], 1)
    w = model.weights
    upper = np.exp(maxent.log_softmax(w[:1]))[0]
    lower = np.exp(maxent.log_softmax(w[1:17]))
    assert np.isclose((upper[:, None] * lower).sum(), 1)


def test_skip_word_chooses_inside_a_cluster():
    """Both words share a cluster, the last word and all endings: only the word before the last tells which one follows."""
    said = ["redstone then apple", "bluestone then melon"] * 20
    keys = maxent.sequences(said[:2])[0]
    model = maxent.Counts(160, 6, np.sort(np.unique(keys)), np.full(256, 1.0), np.full(256, 1.0))
    learner = maxent.Learner(model, maxent.Settings(batch=64))
    for _ in range(60):
        learner.learn(said)
    model.weights = learner.weights
    made, classes = maxent.class_log10(model, *maxent.sequences(said[:2]))
    assert set(classes // maxent.WIDE) == {0} and (10 ** made[[2, 6]] > 0.9).all()


def test_steps_and_features_of_the_learner():
    assert maxent.Settings().batch <= 2048
    keys, ends, counts = maxent.sequences(["one two three four", "five two three four"])
    feats = maxent.features(keys, ends, counts)
    assert (feats[3] != feats[8]).sum() == 1  # the third ending back
    upper, lower = maxent.row_pairs(feats, np.full(len(keys), maxent.WIDE - 1))
    assert lower.shape == upper.shape and int(lower.max()) < maxent.N_FEATURES * maxent.WIDE


def test_odd_tables(llm, odd, nothing):
    rows = maxent.score(odd, F.lit(True)).collect()
    assert len(rows) == odd.count() and all(r.score <= 0 and r.base_score <= 0 for r in rows)
    assert maxent.score(nothing, F.lit(True)).count() == 0
    none = maxent.score(odd, F.lit(False)).collect()
    assert {r.n_known for r in none} == {0} and {r.train_tokens for r in none} == {0}
    assert near_dedup.near_duplicates(nothing).count() == 0
    classes = near_dedup.near_duplicates(odd).collect()
    assert len(classes) == odd.count() and sorted(r.class_size for r in classes if r.class_id == 5) == [1, 3, 3, 3]
    assert decontamination.leaks(odd, nothing.select(F.col("doc_id").alias("item_id"), "text")).count() == 0
    assert decontamination.leaks(nothing, odd.select(F.col("doc_id").alias("item_id"), "text")).count() == 0
    assert mixing.mix(odd).count() == odd.count() and mixing.mix(nothing).count() == 0


# -- pipeline ----------------------------------------------------------------------------------


def test_stages_take_odd_tables(llm, odd, nothing, small):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(llm, docs, small)
            assert made.columns[:len(docs.columns)] == docs.columns, name
            assert len(made.columns) == len(docs.columns) + 2 * (name == "mixing")
            docs = stored(made, f"test-{name}")


def test_query_counts_the_mix_in_training_order(llm, small, tmp_path, monkeypatch):
    """What the query says of a document is what the written training order holds."""
    monkeypatch.setattr(mixing, "stored", lambda df, purpose, rows=None: df.write.parquet(f"{tmp_path}/{purpose}") or llm.read.parquet(f"{tmp_path}/{purpose}"))
    told = {r.doc_id: (r.copies, r.taken, r.first_time) for r in QUERIES["op6_source_mixing"](llm, small).collect()}
    parts = sorted((tmp_path / "mix-order").glob("*.parquet"))
    files = [[(r.time, r.doc_id, r.copy, r.size) for r in llm.read.parquet(str(p)).collect()] for p in parts]
    met = [row for rows in files for row in rows if row[0] is not None]
    assert met == sorted(met) and len(met) == sum(c for c, _, _ in told.values()) > 100
    again = defaultdict(list)
    for time, doc, _, size in met:
        again[doc].append((time, size))
    assert told == {d: (len(again[d]), sum(s for _, s in again[d]), round(min(again[d])[0], 6) if again[d] else None) for d in told}


def test_repeated_rows_are_mixed_once(llm, small):
    """Five equal rows are one document: its source takes what it should, and no row is met more often than it may be."""
    rng = random.Random(3)
    rows = [(i, "ab"[i % 2], prose(rng, rng.randrange(5, 30))) for i in range(400)]
    rows += [(9, "a", "one text that is repeated")] * 5 + [(9, "b", "one text that is repeated")] * 2 + [(None, None, None)] * 3
    docs = llm.createDataFrame(rows, "doc_id bigint, source string, text string")
    made = corpus_pipeline.mix_sources(llm, docs, small).collect()
    keys = [(r.doc_id, r.text, r.copy) for r in made]
    assert len(keys) == len(set(keys))
    distinct = {(i, t): s for i, s, t in sorted(rows, key=str)}
    sizes, taken = Counter(), Counter()
    for (_, t), s in distinct.items():
        sizes[s] += len(WORD.findall(t or ""))
    for r in made:
        taken[distinct[r.doc_id, r.text]] += len(WORD.findall(r.text))
    targets = {"a": sum(sizes.values()) / 3, "b": sum(sizes.values()) * 2 / 3}
    assert all(abs(taken[s] - targets[s]) <= 30 for s in targets)


def test_pipeline_decisions(llm, small):
    docs = llm.read.parquet(f"{small}/documents.parquet")
    labels = {r.doc_id: r for r in llm.read.parquet(f"{small}/labels.parquet").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(llm, docs, small), f"test-{name}")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert not any(labels[i].toxic for i in kept["toxicity"] & labels.keys())
    assert not any(labels[i].quality == 0 for i in kept["quality"] & labels.keys())
    texts = [r.text for r in docs.select("text").collect()]
    assert len(set(texts)) == len(texts)
    mixed = corpus_pipeline.run(llm, small)
    assert {r.doc_id for r in mixed.select("doc_id").collect()} <= kept["decontamination"]
    assert mixed.groupBy("doc_id", "copy").count().filter("count > 1").count() == 0
