"""Cross-tokenizer alignment against a plain version over whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from alluvia.llm import alignment
from alluvia.llm.queries import QUERIES
from alluvia.queries.registry import table


def by_hand(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, sha), and the pairs with their counts: every two tokens compared."""
    a_lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of = alignment.byte_level_characters()
    linked, figures = [], []
    for text in texts:
        links, row = Counter(), (0, 0, 0, 0, "")
        whole = (" " + (text or "")).encode()
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_lib.encode(text or "")
        bytes_a = [bytes(byte_of[c] for c in a_lib.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode()
                   for i in b]
        if text and b"".join(bytes_a) == whole == b"".join(bytes_b):
            ends_a = [sum(map(len, bytes_a[:k + 1])) for k in range(len(a))]
            ends_b = [sum(map(len, bytes_b[:k + 1])) for k in range(len(b))]
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    if max(ends_a[i] - len(bytes_a[i]), ends_b[j] - len(bytes_b[j])) < min(ends_a[i], ends_b[j]):
                        links[x, y] += 1
            cuts = sorted(set(ends_a) & set(ends_b))
            parts, start = [], 0
            for cut in cuts:
                parts.append(",".join(str(x) for x, e in zip(a, ends_a) if start < e <= cut) + "|"
                             + ",".join(str(y) for y, e in zip(b, ends_b) if start < e <= cut))
                start = cut
            row = (len(a), len(b), len(cuts), sum(links.values()), hashlib.sha256(";".join(parts).encode()).hexdigest())
        linked.append(links)
        figures.append(row)
    documents, total = Counter(), Counter()
    for links in linked:
        documents.update(links.keys())
        total.update(links)
    highest = defaultdict(int)
    for (x, _), n in documents.items():
        highest[x] = max(highest[x], n)
    rows = [(*row[:4], sum(n for (x, y), n in links.items() if documents[x, y] == highest[x]),
             sum(n * documents[p] for p, n in links.items()), row[4]) for row, links in zip(figures, linked)]
    return rows, {p: (documents[p], total[p], documents[p] == highest[p[0]]) for p in documents}


def strange_texts():
    rng = random.Random(8)
    alphabet = ["a", "b", "'s", " ", " ", "  ", "\n", "\t", "é", "ñ", "日本", "🎉", "1", "23", "!", "▁", "\x00", "́", "\xa0", " ",
                "the ", "ing ", "<|endoftext|>", "<s>", "</s>", "<0x41>", "_", "~ ", "\r\n", "\x1c", "\x85"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(300)]


TEXTS = [None, "", " ", "  ", " a", "a ", "hello world", "hello world", "a▁b", "<|endoftext|> <s> </s> <0x41>", "the the the the the",
         "don't we'll ' s", "á b ́c", "x" * 300, *strange_texts()]


def same(llm, texts, settings=alignment.Settings(), parts=3):
    rows = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(parts)
    documents, pairs = alignment.align(rows, settings=settings)
    wanted, wanted_pairs = by_hand(texts)
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in documents.collect()}
    assert [got[n] for n in range(len(texts))] == wanted
    assert {(r.a, r.b): (r.n_documents, r.n_links, r.best) for r in pairs.collect()} == wanted_pairs


def test_against_all_pairs_of_tokens(llm):
    same(llm, TEXTS)


def test_blocks_of_few_documents(llm):
    same(llm, TEXTS, alignment.Settings(documents=7, text_bytes=500, remembered=5, remembered_length=50), parts=2)


def test_given_tables(llm, small):
    got = {r.doc_id: tuple(r[1:]) for r in QUERIES["op13_tokenizer_alignment"](llm, small).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").collect()}
    docs = table(llm, small, "documents").orderBy(F.length("text"), "doc_id").select("doc_id", "text").limit(60).collect()
    for r, wanted in zip(docs, by_hand([d.text for d in docs])[0]):
        assert got[r.doc_id] == (*wanted[:4], wanted[6])
    assert len(got) == table(llm, small, "documents").count()


def test_odd_rows_and_clashing_names(llm, odd, nothing):
    documents, _ = alignment.align(odd)
    rows = documents.collect()
    assert len(rows) == odd.count() and sum(r.doc_id is None for r in rows) == 1
    by_id = {r.doc_id: r for r in rows if r.doc_id in (1, 2, 6, 7)}
    assert by_id[1].n_a == by_id[2].n_b == 0 and by_id[1].groups_sha256 == ""
    assert by_id[6].n_a >= 60_000 and by_id[7].n_links > 0
    assert alignment.align(nothing)[0].count() == 0


def test_planes_hold_every_multiplicity(llm):
    same(llm, ["to " * n + "be" for n in (1, 2, 3, 4, 5, 9, 17, 1, 2)] + ["be"] * 20)


def test_merging_is_or():
    import numpy as np

    rng = random.Random(2)
    entries = [{(rng.randrange(9), rng.randrange(30)) for _ in range(40)} for _ in range(3)]
    parts = [alignment.Bitmaps(*np.array(sorted(e)).T, 30) for e in entries]
    both = alignment.Bitmaps.either(parts, [0, 0, 30], 60)
    at, document = both.entries()
    wanted = entries[0] | entries[1] | {(p, d + 30) for p, d in entries[2]}
    assert set(zip(both.pairs[at].tolist(), document.tolist())) == wanted and both.counts.sum() == len(wanted)
