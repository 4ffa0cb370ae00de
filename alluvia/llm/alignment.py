"""Alignment of two tokenizers over a corpus, with inverted pair bitmaps.

Both tokenizers cut the same bytes, so their tokens overlap in byte ranges: every pair of overlapping occurrences is a link, and the
places where tokens of both end cut a text into groups. The corpus knows of every pair of ids in how many documents it is linked.

An index in blocks: a block holds at most ``Settings.documents`` documents and about ``Settings.text_bytes`` of text. For
each pair it has a compressed bitmap of its documents and, where a document links the pair more than once, multiplicity planes: plane j
has the documents whose multiplicity less one has bit j set. Bitmaps of chunks are OR-merged into the block's; documents of
different blocks are different, so a pair's document count is the sum of its popcounts over the blocks, and no task ever
holds a pair's bitmap over the whole corpus. Counts then go back to the blocks that ask for them, and the postings add
them up for each document: only (block, pair) rows are shuffled, never (document, pair) rows.

Texts are cut at single spaces between visible characters, where both tokenizers always begin a token (a token has a space only at its
beginning); a segment is tokenized and aligned once per task. ``Tokenizers`` checks that the piece vocabulary allows this and
takes texts whole where it does not.

Null and empty texts, and texts that either tokenizer doesn't give back byte for byte, have no tokens: zeros and an empty
digest. Special strings inside texts are plain text. Repeated rows and rows with a null id are documents of their own. An
empty table gives an empty result; other columns are not looked at. No text is cut short; one without spaces is one segment.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import re
from dataclasses import dataclass
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alluvia.llm.store import stored
from alluvia.llm.words import text_batches
from alluvia.queries.registry import table

#: A single space between two characters that no tokenizer takes for white space.
SAFE_CUT = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")
#: Fixed value: the character that stands for a space in the piece vocabulary.
SPACE = "▁"


@dataclass(frozen=True)
class Settings:
    """Bounds of a block, and what a task remembers; none of them changes a result."""

    documents: int = 1 << 16  # a document's number inside its block fits 16 bits
    text_bytes: int = 16_000_000
    remembered: int = 500_000  # segments
    remembered_length: int = 20_000_000  # characters


def byte_level_characters() -> dict[str, int]:
    """The character that stands for each byte: itself where it is visible in Latin-1, else the next one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + n): b for n, b in enumerate(hidden)}


class Tokenizers:
    """A: byte-level pieces (of a space and the text). B: pieces with byte fallback (which add the space themselves)."""

    def __init__(self, file_a: str, file_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        of_char = byte_level_characters()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for piece, n in entries.items():
            self.bytes_a[n] = bytes(of_char[c] for c in piece) if all(c in of_char for c in piece) else piece.encode()
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace(SPACE, " ").encode() for n, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.whole = any(SPACE in p.lstrip(SPACE) for p in pieces)
        size = self.size = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [str(n).encode() + mark for mark in (b",", b"|", b";", b"") for n in range(size)]
        self.written_length = np.array(list(map(len, self.written)), np.int64)

    def segments(self, text: str) -> list[str]:
        return [text] if self.whole else SAFE_CUT.split(text)

    def aligned(self, segments: list[str]) -> Aligned:
        raw = [b" " + s.encode() for s in segments]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + s for s in segments], add_special_tokens=False)]
        ids_b = self.b.encode(segments, num_threads=1)
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(raw)) for ids in (ids_a, ids_b))
        good = np.ones(len(raw), bool)
        for ids, bytes_of, lengths, n in ((ids_a, self.bytes_a, self.length_a, n_a), (ids_b, self.bytes_b, self.length_b, n_b)):
            flat = np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))
            ends = np.concatenate([[0], np.cumsum(lengths[flat])])
            # Equal as a whole, and every segment as long as its tokens: then each segment is equal.
            if not (np.array_equal(ends[np.cumsum(n)], np.cumsum(size)) and b"".join(map(bytes_of.__getitem__, flat.tolist())) == b"".join(raw)):
                good &= [b"".join(map(bytes_of.__getitem__, x)) == r for x, r in zip(ids, raw, strict=True)]
        n_a, n_b = n_a * good, n_b * good
        a, b = (np.fromiter(chain.from_iterable(compress(ids, good)), np.int64, int(n.sum())) for ids, n in ((ids_a, n_a), (ids_b, n_b)))
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        segment_ends = np.cumsum(size * good)
        # Between two neighbouring ends, of whichever tokenizer, lie one token of A and one of B: that is a link.
        ends = np.sort(np.concatenate([end_a, end_b]))
        ends = ends[np.diff(ends, prepend=0) != 0]
        pairs = a[np.searchsorted(end_a, ends)] * len(self.bytes_b) + b[np.searchsorted(end_b, ends)]
        links = np.diff(np.searchsorted(ends, segment_ends, side="right"), prepend=0)
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        groups = np.diff(np.searchsorted(common, segment_ends, side="right"), prepend=0)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        # Of each group first its tokens of A, then those of B; the mark behind a token says what comes next.
        code = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
        code[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = a + self.size * last_a
        mark_b = 2 * last_b
        mark_b[np.cumsum(n_b)[good] - 1] = 3
        code[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = b + self.size * mark_b
        text = b"".join(map(self.written.__getitem__, code.tolist()))
        at = np.concatenate([[0], np.cumsum(self.written_length[code])])[np.cumsum(n_a + n_b)].tolist()
        return Aligned(np.stack([n_a, n_b, groups, links], 1), good, pairs, [text[x:y] for x, y in zip([0, *at[:-1]], at, strict=True)] if at else [])


@dataclass
class Aligned:
    """Segments: tokens of A, of B, groups and links of each; whether its bytes came back (else all zeros); the pairs of all links in
    order; its groups as text."""

    figures: np.ndarray
    good: np.ndarray
    pairs: np.ndarray
    groups: list[bytes]


class Bitmaps:
    """Compressed bitmaps over the documents of a block, for some of its pairs: few documents as a list, many as bits."""

    def __init__(self, pairs: np.ndarray, documents: np.ndarray, n_documents: int):
        """From entries ``(pair, document)`` in any order; an entry given twice is one bit."""
        self.n_documents = n_documents
        entries = np.sort(pairs.astype(np.int64) << 16 | documents.astype(np.int64))
        entries = entries[np.diff(entries, prepend=-1) != 0]
        pair, document = entries >> 16, (entries & 0xFFFF).astype(np.uint16)
        starts = np.flatnonzero(np.diff(pair, prepend=-1))
        self.pairs, self.counts = pair[starts], np.diff(starts, append=len(pair))
        self.dense = self.counts * 16 > n_documents
        spread = np.repeat(self.dense, self.counts)
        self.listed = document[~spread]
        self.bits = np.zeros((int(self.dense.sum()), (n_documents + 7) // 8), np.uint8)
        row = np.repeat(np.arange(len(self.bits)), self.counts[self.dense])
        np.bitwise_or.at(self.bits, (row, document[spread] >> 3), np.uint8(128) >> (document[spread] & 7).astype(np.uint8))

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``pairs`` and documents of all set bits."""
        few, many = np.flatnonzero(~self.dense), np.flatnonzero(self.dense)
        places, documents = [np.repeat(few, self.counts[few])], [self.listed.astype(np.int64)]
        step = max(1, (1 << 24) // max(1, self.n_documents))
        for k in range(0, len(many), step):  # some rows at a time, as unpacked bits take eight times their space
            row, document = np.nonzero(np.unpackbits(self.bits[k:k + step], axis=1, count=self.n_documents))
            places.append(many[k + row])
            documents.append(document)
        return np.concatenate(places), np.concatenate(documents)

    @classmethod
    def either(cls, parts: list[Bitmaps], offsets: list[int], n_documents: int) -> Bitmaps:
        """OR of bitmaps whose documents are moved by ``offsets``."""
        found = [(p.pairs[at], document + k) for p, k in zip(parts, offsets, strict=True) for at, document in [p.entries()]]
        return cls(*(np.concatenate([f[n] for f in found]) for n in (0, 1)), n_documents) if found else cls(*np.zeros((2, 0), np.int64), n_documents)


class Postings:
    """The index of some documents: plane 0 says which documents link a pair, plane 1 + j has bit j of their multiplicity less one."""

    def __init__(self, planes: list[Bitmaps], n_documents: int):
        self.planes, self.n_documents = planes, n_documents

    @classmethod
    def of(cls, pairs: np.ndarray, documents: np.ndarray, times: np.ndarray, n_documents: int) -> Postings:
        planes, rest, j = [Bitmaps(pairs, documents, n_documents)], times - 1, 0
        while (rest >> j).any():
            some = (rest >> j & 1) == 1
            planes.append(Bitmaps(pairs[some], documents[some], n_documents))
            j += 1
        return cls(planes, n_documents)

    @classmethod
    def merged(cls, parts: list[Postings]) -> Postings:
        """One index over the documents of all parts, in order."""
        offsets = np.cumsum([0] + [p.n_documents for p in parts]).tolist()
        planes = [Bitmaps.either([p.planes[j] for p in parts if j < len(p.planes)],
                                 [k for p, k in zip(parts, offsets, strict=False) if j < len(p.planes)], offsets[-1])
                  for j in range(max(len(p.planes) for p in parts))]
        return cls(planes, offsets[-1])

    def weights(self):
        """Planes and what a set bit of each is worth."""
        return zip(self.planes, [1, *(1 << j for j in range(len(self.planes) - 1))], strict=True)

    def links(self) -> np.ndarray:
        """Links of each pair of plane 0, from popcounts."""
        total = np.zeros(len(self.planes[0].pairs), np.int64)
        for plane, weight in self.weights():
            total[np.searchsorted(self.planes[0].pairs, plane.pairs)] += weight * plane.counts
        return total

    def added(self, scores: np.ndarray) -> np.ndarray:
        """For each document the sum of a pair's score over its links; ``scores`` follow the pairs of plane 0."""
        total = np.zeros(self.n_documents, np.int64)
        for plane, weight in self.weights():
            at, document = plane.entries()
            np.add.at(total, document, weight * scores[np.searchsorted(self.planes[0].pairs, plane.pairs)][at])
        return total


class Chunks:
    """Texts to documents' figures and postings; remembers aligned segments."""

    def __init__(self, tokenizers: Tokenizers, settings: Settings):
        self.tokenizers, self.settings = tokenizers, settings
        self.forget()

    def forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.length = 0
        self.known = Aligned(np.zeros((0, 4), np.int64), np.zeros(0, bool), np.zeros(0, np.int64), [])

    def read(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[str], Postings]:
        """Tokens of A, of B, groups and links of each text; its groups' digest; the postings of all."""
        if len(self.seen) > self.settings.remembered or self.length > self.settings.remembered_length:
            self.forget()
        seen, known, n = self.seen, self.known, len(texts)
        lengths, code, before = [], [], len(seen)
        for t in texts:
            cut = self.tokenizers.segments(t) if t else []
            lengths.append(len(cut))
            code += [seen.setdefault(x, len(seen)) for x in cut]
        if len(seen) > before:
            fresh = list(islice(seen, before, None))
            made = self.tokenizers.aligned(fresh)
            self.length += sum(map(len, fresh))
            known.figures, known.good, known.pairs = (np.concatenate(x) for x in (
                (known.figures, made.figures), (known.good, made.good), (known.pairs, made.pairs)))
            known.groups += made.groups
        text = np.repeat(np.arange(n), lengths)
        used = np.array(code, np.int64)
        bad = np.zeros(n, bool)
        bad[text[~known.good[used]]] = True
        sums = np.zeros((n, 4), np.int64)
        np.add.at(sums, text, known.figures[used])
        sums[bad] = 0
        digests, at = [], 0
        for k, m in enumerate(lengths):
            whole = m and not bad[k]
            digests.append(hashlib.sha256(b";".join(map(known.groups.__getitem__, code[at:at + m]))).hexdigest() if whole else "")
            at += m
        # Every segment's pairs, once for each time that a text has it.
        sizes = known.figures[:, 3]
        begins = np.cumsum(sizes) - sizes
        used, text = used[~bad[text]], text[~bad[text]]
        owner = np.repeat(text, sizes[used])
        place = np.repeat(begins[used] - (np.cumsum(sizes[used]) - sizes[used]), sizes[used]) + np.arange(len(owner))
        entries = np.sort(known.pairs[place] << 16 | owner)
        starts = np.flatnonzero(np.diff(entries, prepend=-1))
        entries, times = entries[starts], np.diff(starts, append=len(entries))
        return list(sums.T), digests, Postings.of(entries >> 16, entries & 0xFFFF, times, n)


BLOCKS = """block long, documents array<struct<key: {key}, n_a: long, n_b: long, n_groups: long, n_links: long, groups_sha256: string>>,
pairs array<long>, n_documents array<long>, n_links array<long>, postings binary"""


def index_blocks(docs: DataFrame, file_a: str | None = None, file_b: str | None = None, key: str = "doc_id", text: str = "text",
                 settings: Settings = Settings()) -> DataFrame:
    """One row for each block: its documents with their own figures, its pairs with popcounts, and the postings. No shuffle.

    The files are paths that every executor has; by default the public vocabularies of 50,000 and 32,000 pieces.
    """
    kind = docs.schema[key].dataType.simpleString()
    n_fields = ("n_a", "n_b", "n_groups", "n_links")

    def run(batches):
        import public_tokenizers

        chunks = Chunks(Tokenizers(file_a or public_tokenizers.path("byte_bpe_50k.json"),
                                   file_b or public_tokenizers.path("piece_bpe_32k.model")), settings)
        first, made = (TaskContext.get().partitionId() << 32), 0
        rows, parts, held = [], [], 0

        def block():
            postings = Postings.merged(parts)
            columns = [pa.array([first + made]), pa.array([rows], documents_type), pa.array([postings.planes[0].pairs.tolist()], pa.list_(pa.int64())),
                       pa.array([postings.planes[0].counts.tolist()], pa.list_(pa.int64())),
                       pa.array([postings.links().tolist()], pa.list_(pa.int64())), pa.array([pickle.dumps(postings)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["block", "documents", "pairs", "n_documents", "n_links", "postings"])

        for texts, ids in text_batches(batches, text, key):
            documents_type = pa.list_(pa.struct([("key", ids.type), *((n, pa.int64()) for n in n_fields), ("groups_sha256", pa.string())]))
            for at in range(0, len(texts), settings.documents):
                some = texts.slice(at, settings.documents)
                size = some.nbytes
                if rows and (len(rows) + len(some) > settings.documents or held + size > settings.text_bytes):
                    yield block()
                    rows, parts, held, made = [], [], 0, made + 1
                figures, digests, postings = chunks.read(some.to_pylist())
                names = ("key", *n_fields, "groups_sha256")
                rows += [dict(zip(names, r, strict=True)) for r in zip(
                    ids.slice(at, settings.documents).to_pylist(), *(f.tolist() for f in figures), digests, strict=True)]
                parts.append(postings)
                held += size
        if rows:
            yield block()

    return docs.select(key, text).mapInArrow(run, BLOCKS.format(key=kind))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """Every linked pair: in how many documents (popcounts of the blocks' bitmaps) and how often (popcounts of all planes)."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "n_documents", "n_links")).alias("p"))
    return each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.n_documents").alias("n_documents"), F.sum("p.n_links").alias("n_links"))


def scored_pairs(counts: DataFrame, size_b: int) -> DataFrame:
    """``counts`` with the ids ``a`` and ``b``, and ``best``: no pair of this ``a`` is in more documents."""
    counts = counts.withColumn("a", F.expr(f"pair div {size_b}")).withColumn("b", F.col("pair") % size_b)
    # One row for each id of the vocabulary of A: a proven bound for the broadcast.
    highest = counts.groupBy("a").agg(F.max("n_documents").alias("highest"))
    return counts.join(F.broadcast(highest), "a").withColumn("best", F.col("n_documents") == F.col("highest")).drop("highest")


def returned(blocks: DataFrame, scores: DataFrame) -> DataFrame:
    """Each document with ``n_best`` and ``count_sum``: a block gets the scores of its pairs, and its postings add them up."""
    asked = blocks.select(F.col("block").alias("asking"), F.explode("pairs").alias("pair")).join(scores.select("pair", "n_documents", "best"), "pair")
    document = blocks.schema["documents"].dataType.elementType
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in document.fields) + ", n_best long, count_sum long"

    def answer(block: pa.Table, answers: pa.Table) -> pa.Table:
        postings = pickle.loads(block["postings"][0].as_py())
        pair = answers["pair"].to_numpy()
        order = np.argsort(pair)
        count = answers["n_documents"].to_numpy()[order]
        best = answers["best"].to_numpy().astype(np.int64)[order]
        documents = pa.StructArray.from_arrays(block["documents"].combine_chunks().flatten().flatten(), names=document.names)
        columns = [*documents.flatten(), pa.array(postings.added(best)), pa.array(postings.added(count))]
        return pa.Table.from_arrays(columns, [*document.names, "n_best", "count_sum"])

    return (blocks.select("block", "documents", "postings").groupBy("block").cogroup(asked.groupBy("asking"))
            .applyInArrow(answer, schema))


def align(docs: DataFrame, file_a: str | None = None, file_b: str | None = None, key: str = "doc_id", text: str = "text",
          settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """``(documents, pairs)``: every document with its figures and scores, and every linked pair ``(a, b)`` with its counts."""
    import sentencepiece
    import public_tokenizers

    size_b = sentencepiece.SentencePieceProcessor(model_file=file_b or public_tokenizers.path("piece_bpe_32k.model")).get_piece_size()
    blocks = stored(index_blocks(docs, file_a, file_b, key, text, settings), "alignment-blocks")
    pairs = stored(scored_pairs(pair_counts(blocks), size_b), "alignment-pairs")
    return returned(blocks, pairs).withColumnRenamed("key", key), pairs.drop("pair")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = align(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
