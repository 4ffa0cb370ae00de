"""Token counts of a byte-fallback BPE vocabulary by rank-synchronous array merging.

Texts are cut into pre-tokens at places that no vocabulary piece crosses. The distinct pre-tokens of a batch are held as one
ragged array of symbols. In every step each pre-token applies the pair of its lowest rank, all pre-tokens at once, until no
pre-token has a pair left; the surviving symbols are its tokens, where a character outside the vocabulary counts as its bytes.

Null and empty texts have no tokens; no text is cut, and a text's length only adds to the number of its pre-tokens. Repeated
rows are counted again, an empty table gives an empty result, other columns are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alluvia.llm.words import map_texts
from alluvia.queries.registry import table

#: Fixed value: the character that stands for a space in the vocabulary.
SPACE = "▁"
#: Counted pre-tokens that a task remembers; beyond that it starts anew, which only costs time.
REMEMBERED = 300_000
#: Pre-tokens of more symbols also merge at places that nothing else can disturb.
LONG = 64
NO_RANK = np.iinfo(np.int32).max


class Vocabulary:
    """Symbols, and for every pair of symbols that makes a piece: the piece and its rank."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = [i for i in range(model.get_piece_size())
               if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in ids}
        symbols = {p: n for n, p in enumerate(dict.fromkeys([*pieces, *sorted({c for p in pieces for c in p})]))}
        self.n = len(symbols)
        self.unknown = self.n
        ranks = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        made = sorted((symbols[p[:k]] * (self.n + 1) + symbols[p[k:]], ranks[score], symbols[p])
                      for p, score in pieces.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols)
        self.keys = np.array([m[0] for m in made], np.int64)
        self.rank = np.array([m[1] for m in made], np.int32)
        self.piece = np.array([m[2] for m in made], np.int32)
        self.of_char = np.full(0x110000, self.unknown, np.int32)
        bytes_of = np.array([1] * 0x80 + [2] * 0x780 + [3] * 0xF800 + [4] * 0x100000, np.uint8)
        self.char_cost = bytes_of
        self.is_piece = np.zeros(self.n + 1, bool)
        for p, n in symbols.items():
            if len(p) == 1:
                self.of_char[ord(p)] = n
            self.is_piece[n] = p in pieces
        # A piece is calm when nothing it can next become ranks as low as itself: then all places of its pair can merge at once.
        own = np.full(self.n + 1, NO_RANK, np.int64)
        for p, score in pieces.items():
            own[symbols[p]] = ranks[score]
        reached = np.full(self.n + 1, NO_RANK, np.int64)
        np.minimum.at(reached, self.keys // (self.n + 1), self.rank)
        np.minimum.at(reached, self.keys % (self.n + 1), self.rank)
        self.calm = reached > own
        self.longest = max(map(len, pieces), default=1) + 1
        joined = {c for p in pieces if len(p) > 1 for c in p}
        alone = "".join(c for c in "\n\t\r" if c not in joined)
        crossing = any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.cut = (lambda text: [text]) if crossing else re.compile(
            f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|[{alone}]" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs in the table, -1 where the pair makes no piece."""
        wanted = left.astype(np.int64) * (self.n + 1) + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        at[self.keys[at] != wanted] = -1
        return at

    def undisturbed(self, rank: np.ndarray) -> np.ndarray:
        """Places that are merged whatever happens elsewhere: no lower rank is near, and none as low before it.

        What could come first is a pair of a lower rank with a symbol beside the place. Such a symbol is a piece, so all merges that make
        it lie within the longest piece's reach, and the first of them is a pair that is there already.
        """
        reach = self.longest

        def least(x):  # of the ``reach`` places before each
            padded = np.concatenate([np.full(reach, NO_RANK, x.dtype), x])
            width, lowest = 1, padded
            while width < reach:  # minima over doubling widths, from each place on
                step = min(width, reach - width)
                lowest = np.minimum(lowest[:len(lowest) - step], lowest[step:])
                width += step
            return lowest[:len(x)]

        return np.flatnonzero((rank != NO_RANK) & (rank < least(rank)) & (rank <= least(rank[::-1])[::-1]))

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.of_char[chars]
        cost = np.where(self.is_piece[symbol], 1, self.char_cost[chars]).astype(np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        total = np.zeros(len(words), np.int64)
        while len(symbol):
            at = self.pairs(symbol[:-1], symbol[1:])
            at[word[:-1] != word[1:]] = -1
            rank = np.where(at >= 0, self.rank[at], NO_RANK)
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(np.append(rank, NO_RANK), starts)
            sizes = np.diff(np.append(starts, len(symbol)))
            # Pre-tokens without a pair are done.
            done = best == NO_RANK
            if done.any():
                total[word[starts[done]]] = np.add.reduceat(cost, starts)[done]
                alive = np.repeat(~done, sizes)
                symbol, cost, word = symbol[alive], cost[alive], word[alive]
                rank, at = np.append(rank, NO_RANK)[alive][:-1], np.append(at, -1)[alive][:-1]
                starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else starts[:0]
                best, sizes = best[~done], sizes[~done]
                if not len(symbol):
                    break
            low = np.repeat(best, sizes)[:-1] == rank
            low &= rank != NO_RANK
            alone = self.undisturbed(rank) if sizes.max() > LONG else None
            place = np.flatnonzero(low)
            # Of overlapping places the left one goes first: every second one of a run of neighbours.
            run_start = np.concatenate([[True], np.diff(place) != 1])
            nth = np.arange(len(place)) - np.repeat(np.flatnonzero(run_start), np.diff(np.append(np.flatnonzero(run_start), len(place))))
            place = place[nth % 2 == 0]
            # Where a merge could open a pair of a rank as low, only the leftmost place of the pre-token goes.
            made = self.piece[at[place]]
            first = np.concatenate([[True], word[place][1:] != word[place][:-1]])
            restless = np.zeros(len(total), bool)
            restless[word[place[~self.calm[made]]]] = True
            go = first | ~restless[word[place]]
            place, made = place[go], made[go]
            if alone is not None:
                place = np.union1d(place, alone)
                made = self.piece[at[place]]
            symbol[place] = made
            cost[place] = 1
            keep = np.ones(len(symbol), bool)
            keep[place + 1] = False
            symbol, cost, word = symbol[keep], cost[keep], word[keep]
        return total


def count_tokens(docs: DataFrame, model_file: str | None = None, text: str = "text", keep: list[str] | None = None,
                 into: str = "tokens") -> DataFrame:
    """The columns ``keep`` and a struct ``into`` of n_bytes and n_tokens.

    ``model_file`` is a path that every executor has; by default the public vocabulary of 32,000 pieces.
    """
    held: dict[str, object] = {}

    def compute(texts):
        if not held:
            import public_tokenizers

            held["v"], held["seen"] = Vocabulary(model_file or public_tokenizers.path("piece_bpe_32k.model")), {}
        vocabulary, seen = held["v"], held["seen"]
        if len(seen) > REMEMBERED:
            seen.clear()
        cut = [vocabulary.cut(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        fresh = list({w for words in cut for w in words if w not in seen})
        if fresh:
            seen.update(zip(fresh, vocabulary.count(fresh).tolist(), strict=True))
        return [np.array([len(t.encode()) if t else 0 for t in texts], np.int64),
                np.array([sum(map(seen.__getitem__, words)) for words in cut], np.int64)]

    return map_texts(docs, text, compute, [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())],
                     into, keep)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return counted.select("doc_id", "tokens.n_bytes", "tokens.n_tokens", (F.col("tokens.n_tokens") > 4096).alias("over_limit"))
