"""Prefix trie of conversations, with subtree totals by time-forward processing.

A conversation's path is the sequence of its turns (role and text); each distinct prefix is a node. The totals of a node come from
below, so nodes are sorted in reverse level order and each one sends its finished totals forward to its parent, through a priority
queue that spills to the shared folder. The trie is cut into shards: a node whose ``weight`` (the turns that its members have from
it on, which is at least the size of its subtree) is above a limit belongs to the top, and every subtree below the top is a unit
that one task holds. Units are worked off first, and their roots' totals, summed by parent, are the top's messages. The limit is at
least ``Settings.unit`` and so high that the top has at most ``Settings.top`` nodes, whatever the input, for all
weights add up to the sum of n * (n + 1) / 2 over the conversations' lengths n. So the top is one bounded task and a bounded broadcast.

A node's key is the sum, modulo 2^61 in two lanes, of a hash for each of its turns with its depth, so a running sum along a path
gives all prefixes. Paths are range-sorted by conversation and depth, and only the one conversation that continues from the
partition before needs a carry: a conversation may have any number of turns. Nodes are counted with partial aggregation.

Turns without a conversation id belong to none. Turns are ordered by turn (null first), ties by a digest of role and text; repeated rows
are repeated turns. Null roles and texts are empty. An empty table has no nodes, not even a root. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alluvia.llm.store import stored
from alluvia.llm.words import Words, mixed, text_batches
from alluvia.queries.registry import table
from alluvia.session import shared_folder

#: Keys are sums modulo 2^61, so that Spark adds two of them without overflow.
MASK = (1 << 61) - 1
ROWS = 10_000  # of an output batch


@dataclass(frozen=True)
class Settings:
    """``unit``: least weight limit of a shard. ``top``: bound on the nodes above all shards. ``held``: messages in memory."""

    unit: int = 100_000
    top: int = 200_000
    held: int = 200_000
    piece: int = 4_000  # ids of one run that are hashed at once


# -- turns and paths ---------------------------------------------------------------------------


def digested(conversations: DataFrame) -> DataFrame:
    """``conv, turn, digest, words`` of every turn: texts go no further than this."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))

    def run(batches):
        for texts, roles, convs, turns in text_batches(batches, "text", "role", "conv", "turn"):
            said = texts.to_pylist()
            digests = [hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()[:16] for r, t in zip(roles.to_pylist(), said, strict=True)]
            yield pa.RecordBatch.from_arrays([convs, turns, pa.array(digests, pa.binary()), pa.array(Words(said).counts)],
                                             ["conv", "turn", "digest", "words"])

    kind = conversations.schema["turn"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv long, turn {kind}, digest binary, words long")


def numbered(turns: DataFrame) -> DataFrame:
    """Range-sorted turns with their place ``at`` inside (``part``, conversation). Copies of one turn may lie in several parts."""
    keys = ["conv", "turn", "digest", "copy"]
    rows = turns.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches):
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            sizes = np.diff(np.append(starts, len(conv)))
            at = np.arange(len(conv)) - np.repeat(starts, sizes)
            if conv[0] == last:
                at[:sizes[0]] += n
            last, n = conv[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(conv), part)), batch.column(0), pa.array(at), batch.column(1), batch.column(2)],
                                             ["part", "conv", "at", "digest", "words"])

    return rows.select("conv", "digest", "words").mapInArrow(run, "part long, conv long, at long, digest binary, words long")


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that borrow the head of another: ``(turns by conv and depth, conversations with their length)``.

    Of ``most`` kinds by their id's crc32, a conversation takes its first 0 to ``most - 1`` turns from the one whose id is its own rounded
    down to a multiple of ``every``.
    """
    pieces = turns.groupBy("conv", "part").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("conv")
    pieces = pieces.select("conv", "part", (F.sum("n").over(whole.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(whole).alias("total"))
    pieces = stored(pieces, "trie-pieces")
    convs = pieces.groupBy("conv").agg(F.max("total").alias("total"))
    convs = convs.withColumn("head", F.crc32(F.col("conv").cast("string").cast("binary")) % most).withColumn("base", F.col("conv") - F.col("conv") % every)
    bases = convs.select(F.col("conv").alias("base"), F.col("total").alias("there"))
    convs = convs.join(bases, "base", "left").withColumn("lent", F.least("head", F.coalesce("there", F.lit(0))))
    convs = stored(convs.withColumn("length", F.col("lent") + F.greatest(F.col("total") - F.col("head"), F.lit(0))), "trie-conversations")
    placed = turns.join(pieces.join(convs.select("conv", "head", "lent", "length"), "conv"), ["conv", "part"])
    placed = placed.withColumn("index", F.col("before") + F.col("at"))
    own = placed.filter("index >= head").withColumn("depth", F.expr("index - head + lent + 1"))
    heads = turns.filter((F.col("conv") % every == 0) & (F.col("at") < most - 1)).join(pieces, ["conv", "part"])
    heads = heads.select(F.col("conv").alias("base"), (F.col("before") + F.col("at")).alias("index"), "digest", "words")
    borrowed = convs.join(heads, "base").filter("index < head").withColumn("depth", F.col("index") + 1)
    columns = ["conv", "depth", "length", "digest", "words"]
    return own.select(columns).unionByName(borrowed.select(columns)), convs.select("conv", "length")


def paths(turns: DataFrame) -> DataFrame:
    """Each turn of each conversation with the key of the prefix that it ends (k1, k2) and of the one before (p1, p2)."""
    rows = turns.repartitionByRange("conv", "depth").sortWithinPartitions("conv", "depth")
    lanes = ["s1", "s2", "h1", "h2"]

    def run(batches):
        part, last, carried = TaskContext.get().partitionId(), None, [np.uint64(0)] * 2
        for batch in batches:
            conv, depth = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(conv):
                continue
            halves = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint64).reshape(-1, 2)
            starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            sizes = np.diff(np.append(starts, len(conv)))
            made = []
            for lane in (0, 1):
                place = mixed(depth.astype(np.uint64) * np.uint64(2) + np.uint64(lane))
                term = mixed(halves[:, lane] ^ place) & np.uint64(MASK)
                running = np.cumsum(term, dtype=np.uint64)
                running -= np.repeat(running[starts] - term[starts], sizes)
                if conv[0] == last:
                    running[:sizes[0]] += carried[lane]
                carried[lane] = running[-1]
                made.append((running & np.uint64(MASK), term))
            last = conv[-1]
            columns = [pa.array(x.astype(np.int64)) for x in (made[0][0], made[1][0], made[0][1], made[1][1])]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(conv), part)), batch.column(0), batch.column(1), batch.column(2), batch.column(4), *columns],
                                             ["part", "conv", "depth", "length", "words", *lanes])

    rows = rows.select("conv", "depth", "length", "digest", "words")
    sums = stored(rows.mapInArrow(run, "part long, conv long, depth long, length long, words long, s1 long, s2 long, h1 long, h2 long"), "trie-paths")
    # What a conversation had in earlier parts. A part has at most one that began before it, so this has no more rows than parts.
    ends = sums.groupBy("conv", "part").agg(*(F.max_by(s, "depth").cast("decimal(20,0)").alias(s) for s in ("s1", "s2")))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("conv", "part", *(F.sum(s).over(earlier).alias(c) for s, c in (("s1", "c1"), ("s2", "c2")))).filter("c1 IS NOT NULL")
    carry = carry.select("conv", "part", *((F.col(c) % (MASK + 1)).cast("long").alias(c) for c in ("c1", "c2")))
    rows = sums.join(F.broadcast(stored(carry, "trie-carries")), ["conv", "part"], "left")
    for n in "12":
        rows = rows.withColumn(f"k{n}", (F.col(f"s{n}") + F.coalesce(f"c{n}", F.lit(0))).bitwiseAND(F.lit(MASK)))
        rows = rows.withColumn(f"p{n}", (F.col(f"k{n}") - F.col(f"h{n}")).bitwiseAND(F.lit(MASK)))
    return rows.select("conv", "depth", "length", "words", "k1", "k2", "p1", "p2")


def nodes(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each node, the root included; a node is named by its smallest member and its depth."""
    inner = steps.groupBy("k1", "k2").agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("depth").alias("depth"), F.min("conv").alias("conv_id"),
        F.count("*").alias("n_convs"), F.max("words").alias("words"), F.sum(F.expr("length - depth + 1")).alias("weight"))
    nothing = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        *(nothing.alias(c) for c in ("k1", "k2")), *(F.lit(None).cast("long").alias(c) for c in ("p1", "p2")), nothing.alias("depth"),
        "conv_id", "n_convs", nothing.alias("words"), nothing.alias("weight"))
    return inner.unionByName(root)


# -- time-forward processing -------------------------------------------------------------------


class Runs:
    """Sorted runs of messages in a folder that all executors see; a run is deleted when it has been read."""

    def __init__(self, folder: str):
        from pyarrow import fs

        plain = re.sub("^file:/+", "/", folder)
        self.files, self.folder = (fs.LocalFileSystem(), plain) if plain.startswith("/") else fs.FileSystem.from_uri(folder)

    def write(self, items: list) -> str:
        self.files.create_dir(self.folder, recursive=True)
        name = f"{self.folder}/{uuid.uuid4().hex}.run"
        with self.files.open_output_stream(name) as out:
            for k in range(0, len(items), ROWS):
                pickle.dump(items[k:k + ROWS], out)
        return name

    def read(self, name: str) -> Iterator:
        with self.files.open_input_stream(name) as source:
            while True:
                try:
                    items = pickle.load(source)
                except EOFError:
                    break
                yield from items
        self.files.delete_file(name)


class SpillingQueue:
    """A priority queue that keeps at most ``held`` messages in memory, besides one block of each run it has written."""

    def __init__(self, held: int, folder: str):
        self.held, self.folder = held, folder
        self.heap: list = []
        self.heads: list = []
        self.runs: Runs | None = None
        self.spills = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.held:  # the later half goes out
            self.heap.sort()
            self.runs = self.runs or Runs(self.folder)
            run = self.runs.read(self.runs.write(self.heap[self.held // 2:]))
            del self.heap[self.held // 2:]
            self.spills += 1
            heapq.heappush(self.heads, (next(run), self.spills, run))

    def first(self) -> tuple | None:
        best = self.heap[0] if self.heap else None
        return self.heads[0][0] if self.heads and (best is None or self.heads[0][0] < best) else best

    def pop(self) -> tuple:
        if self.heap and (not self.heads or self.heap[0] < self.heads[0][0]):
            return heapq.heappop(self.heap)
        item, n, run = heapq.heappop(self.heads)
        following = next(run, None)
        if following is not None:
            heapq.heappush(self.heads, (following, n, run))
        return item


NODE = ["u1", "u2", "k1", "k2", "p1", "p2", "depth", "conv_id", "n_convs", "saved", "children", "leaves"]
TOTAL = ["k1", "k2", "p1", "p2", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "open"]


def time_forward(batches, held: int, folder: str) -> Iterator[pa.RecordBatch]:
    """Nodes in order (unit, reverse level) to nodes with totals.

    ``saved``, ``children`` and ``leaves`` come in with what a node has of its own and from units below. A node is finished when its
    turn comes, as all its children came before; it travels to its parent as a message and comes out when the parent takes it, or as
    ``open`` when the parent isn't in its unit.
    """
    queue = SpillingQueue(held, folder)
    out: list[tuple] = []

    def emit(message: tuple, parent: int | None, is_open: bool) -> None:
        k1, k2, p1, p2, depth, conv, n_convs, children, leaves, saved = message[1]
        out.append((k1, k2, p1, p2, depth, conv, parent, n_convs, children, leaves, saved, is_open))

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64()] * (len(TOTAL) - 1) + [pa.bool_()]
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, TOTAL)

    for rows in batches:
        for u1, u2, k1, k2, p1, p2, depth, conv, n_convs, saved, children, leaves in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            now = (u1, u2, -depth, k1, k2)
            while (message := queue.first()) is not None and message[0] <= now:
                queue.pop()
                if message[0] == now:
                    children, leaves, saved = children + 1, leaves + message[1][8], saved + message[1][9]
                    emit(message, conv, False)
                else:  # its parent would have come before this node
                    emit(message, None, True)
            done = (k1, k2, p1, p2, depth, conv, n_convs, children, leaves if children else 1, saved)
            if p1 is None:
                emit((now, done), None, False)
            else:
                queue.push(((u1, u2, 1 - depth, p1, p2), done))
            if len(out) >= ROWS:
                yield batch()
    while queue.first() is not None:
        emit(queue.pop(), None, True)
        if len(out) >= ROWS:
            yield batch()
    if out:
        yield batch()


def totals(found: DataFrame, steps: DataFrame, most: float, settings: Settings = Settings()) -> DataFrame:
    """``found`` (stored nodes) with subtree totals; ``most`` is at least the sum of all weights."""
    spark = found.sparkSession
    folder, held = shared_folder(spark, "trie-queue"), settings.held
    limit = max(settings.unit, int(most / settings.top))
    found = found.withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    above = (F.col("weight") > limit) | (F.col("depth") == 0)
    top = stored(found.filter(above), "trie-top")  # at most settings.top nodes and the root
    schema = ", ".join(f"{c} {'boolean' if c == 'open' else 'long'}" for c in TOTAL)

    def run(batches):
        return time_forward(batches, held, folder)

    # A conversation's unit is named by the first node of its path that is below the top.
    above_own = top.select("k1", "k2")
    above_parent = top.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    units = steps.join(F.broadcast(above_parent), ["p1", "p2"], "left_semi").join(F.broadcast(above_own), ["k1", "k2"], "left_anti")
    units = units.select(F.col("conv").alias("conv_id"), F.col("k1").alias("u1"), F.col("k2").alias("u2"))
    nothing = F.lit(0).cast("long")
    below = found.filter(~above).join(units, "conv_id").withColumns({"children": nothing, "leaves": nothing}).select(NODE)
    order = ["u1", "u2", F.desc("depth"), "k1", "k2"]
    finished = stored(below.repartition("u1", "u2").sortWithinPartitions(*order).mapInArrow(run, schema), "trie-units")
    sent = finished.filter("open").groupBy("p1", "p2").agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("more"))
    sent = sent.withColumnsRenamed({"p1": "k1", "p2": "k2"})
    top = top.join(sent, ["k1", "k2"], "left").withColumns({
        "u1": nothing, "u2": nothing, "saved": F.col("saved") + F.coalesce("more", nothing),
        **{c: F.coalesce(c, nothing) for c in ("children", "leaves")}})
    crown = stored(top.select(NODE).repartition(1).sortWithinPartitions(*order).mapInArrow(run, schema), "trie-crown")
    owners = crown.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    roots = finished.filter("open").drop("parent_conv_id").join(F.broadcast(owners), ["p1", "p2"])
    return finished.filter("NOT open").unionByName(roots).unionByName(crown).drop("open", "p1", "p2")


def ends(steps: DataFrame, convs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The digest of the ids of the conversations that end at a node, for each node with such.

    A digest of a sequence is a walk along it, but a node may have any number of ends: they are range-sorted, each range writes runs of ids as
    text, and one task then hashes a node's runs in order without holding more than one of them.
    """
    last = steps.filter("depth = length").select("k1", "k2", "conv")
    nothing = F.lit(0).cast("long")
    last = last.unionByName(convs.filter("length = 0").select(nothing.alias("k1"), nothing.alias("k2"), "conv"))
    most = settings.piece

    def cut(batches):
        for batch in batches:
            k1, k2, conv = (c.to_numpy() for c in batch.columns)
            if not len(conv):
                continue
            starts = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
            runs = [(a, b) for s, e in zip(starts, np.append(starts[1:], len(conv)), strict=True)
                    for a in range(s, e, most) for b in [min(e, a + most)]]
            first = [a for a, _ in runs]
            said = [",".join(map(str, conv[a:b].tolist())) for a, b in runs]
            yield pa.RecordBatch.from_arrays([pa.array(k1[first]), pa.array(k2[first]), pa.array(conv[first]), pa.array(said)],
                                             ["k1", "k2", "conv", "run"])

    def walk(batches):
        node, state, out = None, None, []
        for batch in batches:
            for a, b, said in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, b) == node:
                    state.update(b"," + said.encode())
                    continue
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (a, b), hashlib.sha256(said.encode())
            if len(out) >= ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["k1", "k2", "ends_sha256"])
                out = []
        if node is not None:
            out.append((*node, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["k1", "k2", "ends_sha256"])

    keys = ["k1", "k2", "conv"]
    runs = last.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(cut, "k1 long, k2 long, conv long, run string")
    return runs.repartition("k1", "k2").sortWithinPartitions(*keys).select("k1", "k2", "run").mapInArrow(
        walk, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The trie of ``turns`` (conv, depth from 1, length, digest, words) of ``convs`` (conv, length; also those without turns)."""
    steps = paths(turns)
    found = stored(nodes(steps, convs), "trie-nodes")
    most = convs.agg(F.sum(F.expr("cast(length AS double) * (length + 1) / 2")).alias("n")).first().n or 0
    whole = totals(found, steps, most, settings)
    none = hashlib.sha256(b"").hexdigest()
    return whole.join(ends(steps, convs, settings), ["k1", "k2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(numbered(stored(digested(table(spark, sf_dir, "conversations")), "trie-digests")), "trie-turns")
    return prefix_trie(*rebuilt(turns))


_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295)"""

OP12_SQL = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
q AS (SELECT c, count(*) AS n, {_CRC32} % 4 AS h, c - c % 20 AS base FROM t GROUP BY c),
k AS (SELECT q.*, least(q.h, coalesce(b.n, 0)) AS lent, least(q.h, coalesce(b.n, 0)) + greatest(q.n - q.h, 0) AS len
  FROM q LEFT JOIN q b ON b.c = q.base),
s AS (
  SELECT k.c, t.i + 1 AS d, k.len, t.r, t.x FROM k JOIN t ON t.c = k.base AND t.i < k.h
  UNION ALL SELECT k.c, t.i - k.h + k.lent + 1, k.len, t.r, t.x FROM k JOIN t ON t.c = k.c AND t.i >= k.h),
p AS (
  SELECT c, d, len, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS words,
    sha256(string_agg(length(r) || ':' || length(x) || ':' || r || x, '') OVER (PARTITION BY c ORDER BY d)) AS key FROM s
  UNION ALL SELECT c, 0, len, 0, '' FROM k),
n AS (
  SELECT key, d, min(c) AS c, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = len), '')) AS ends
  FROM p GROUP BY key, d),
up AS (SELECT n.key, a.key AS parent FROM n JOIN p a ON a.c = n.c AND a.d = n.d - 1),
kids AS (SELECT parent AS key, count(*) AS n_children FROM up GROUP BY parent),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (key)),
below AS (
  SELECT a.key, sum(CASE WHEN m.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((m.n_convs - 1) * m.words) AS saved
  FROM m JOIN p a ON a.c = m.c AND a.d <= m.d GROUP BY a.key)
SELECT m.c AS conv_id, CAST(m.d AS BIGINT) AS depth, o.c AS parent_conv_id, m.n_convs, m.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN below USING (key) LEFT JOIN up USING (key) LEFT JOIN n o ON o.key = up.parent
"""
