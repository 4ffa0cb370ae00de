"""Words of many texts as flat numpy arrays, and the way texts get to numpy and back inside Spark tasks.

A word is a maximal run of bytes other than space and the controls 9-13, all of them ASCII, so that UTF-8 bytes can be cut
without decoding. Spans (words, lines, windows) get 64-bit hashes from one running polynomial: ``hash(span)`` is a difference
of prefix sums times an inverse power, so every span of a chunk costs the same whatever its length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The separators of words.
SEPARATORS = b" \t\n\x0b\x0c\r"
#: Bytes of text handled at once: bounds a task's memory to some 40 times this, or to its longest text's share.
CHUNK_BYTES = 2_000_000
#: The same for steps whose arrays are widest. A worker keeps what its largest chunk took, long after its task.
SMALL_CHUNK_BYTES = 500_000

_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[list(SEPARATORS)] = True
#: The gaps between runs of letters, digits and non-ASCII characters.
NOT_LETTERS = np.array([b < 0x80 and not (chr(b).isdigit() or chr(b).isalpha()) for b in range(256)])
#: Lower-cases A-Z and nothing else.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        _powers[kind] = np.multiply.accumulate(have)
    return _powers[kind][:n]


class Spans:
    """Hashes of contiguous spans over one sequence of values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        terms = values.astype(np.uint64)
        terms += np.uint64(1)  # else a zero value would leave no trace
        terms *= _power("up", _BASE, n + 1)[:n]
        np.cumsum(terms, out=self.sums[1:])
        self.down = _power("down", _INVERSE, n + 1)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])


_PLACES = mixed(np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans of bytes for which no two texts are known to collide, as the running polynomial has them for texts built for it.

    A tree: eight bytes make a number, and level by level eight numbers, each mixed with its place, make one. Spans may overlap; the
    work grows with their lengths.
    """
    sizes = ends - starts
    # Empty spans have no leaf: they keep the hash of their size.
    real = np.flatnonzero(sizes)
    size = sizes[real]
    at = np.repeat(starts[real] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    values = data[at].astype(np.uint64)
    result = np.zeros(len(sizes), np.uint64)
    owner, leaf = real, True
    while len(owner):
        place = (np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)) & 7
        values = values << (place.astype(np.uint64) << np.uint64(3)) if leaf else mixed(values ^ _PLACES[place])
        values = mixed(np.add.reduceat(values, np.flatnonzero(place == 0)))
        size, leaf = (size + 7) // 8, False
        done = size == 1
        begin = np.cumsum(size) - size
        result[owner[done]] = values[begin[done]]
        values = values[np.repeat(~done, size)]
        owner, size = owner[~done], size[~done]
    return mixed(result + mixed(sizes.astype(np.uint64) ^ np.uint64(0xD1B54A32D192ED03)))


class Words:
    """The words of some texts: ``starts``/``ends`` in ``data``, and the range of words of each text."""

    def __init__(self, texts: list[str | None], fold: bool = False, gaps: np.ndarray = _IS_SEPARATOR):
        parts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        self.n_texts = len(parts)
        raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        self.data = FOLD[raw] if fold else raw
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        self.text_starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]) if parts else np.zeros(0, np.int64)
        self.text_ends = self.text_starts + lengths
        gap = gaps[raw]
        edges = np.diff(np.concatenate([[True], gap]).view(np.int8))
        self.starts = np.flatnonzero(edges == -1)
        self.ends = np.flatnonzero(edges == 1)
        self.gap = gap
        self.first = np.searchsorted(self.starts, self.text_starts)
        self.last = np.searchsorted(self.starts, self.text_ends)
        self.counts = self.last - self.first
        self._spans: Spans | None = None

    @property
    def spans(self) -> Spans:
        if self._spans is None:
            self._spans = Spans(self.data)
        return self._spans

    def hashes(self) -> np.ndarray:
        return self.spans.hashes(self.starts, self.ends)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.counts)

    def windows(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every window of ``size`` words inside one text: its first word, its text, its hash."""
        per_text = np.maximum(self.counts - size + 1, 0)
        text = np.repeat(np.arange(self.n_texts), per_text)
        offset = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        first = self.first[text] + offset
        return first, text, Spans(hashes).hashes(first, first + size)

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """Sums over the bytes of each text."""
        running = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return running[self.text_ends] - running[self.text_starts]

    def per_word(self, marks: np.ndarray) -> np.ndarray:
        """Sums over the words of each text."""
        running = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return running[self.last] - running[self.first]


def chunks(sizes: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of about ``most`` bytes each; one larger row is a range of its own."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += int(n) + 1
    if start < len(sizes):
        yield start, len(sizes)


def text_batches(batches, *columns, most: int = CHUNK_BYTES):
    """Chunks of the columns of Arrow batches, of about ``most`` bytes of the first."""
    for batch in batches:
        source = batch.column(batch.schema.get_field_index(columns[0]))
        for a, b in chunks(np.asarray(pa.compute.fill_null(pa.compute.binary_length(source), 0)), most):
            yield [batch.column(batch.schema.get_field_index(c)).slice(a, b - a) for c in columns]


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def map_texts(df: DataFrame, text: str, compute: Callable[[list[str | None]], list], fields: list[T.StructField],
              into: str, keep: list[str] | None = None, most: int = CHUNK_BYTES) -> DataFrame:
    """The columns ``keep`` (all when not given) and a struct ``into`` that ``compute`` makes from chunks of about ``most`` bytes of text.

    ``compute`` gets a list of texts and returns one array (numpy or Arrow) per field. No shuffle; a task holds one chunk
    beside the Arrow batch it came in.
    """
    keep = df.columns if keep is None else keep
    columns = list(dict.fromkeys([*keep, text]))
    kinds = {f.name: f for f in df.schema.fields}
    schema = T.StructType([*(kinds[k] for k in keep), T.StructField(into, T.StructType(fields))])
    names = [f.name for f in fields]

    def run(batches):
        for batch in batches:
            source = batch.column(batch.schema.get_field_index(text))
            sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(source), 0))
            for a, b in chunks(sizes, most):
                made = [x if isinstance(x, pa.Array) else pa.array(x) for x in compute(source.slice(a, b - a).to_pylist())]
                kept = [batch.column(batch.schema.get_field_index(k)).slice(a, b - a) for k in keep]
                yield pa.RecordBatch.from_arrays([*kept, pa.StructArray.from_arrays(made, names=names)], names=[*keep, into])

    return df.select(*(df[c] for c in columns)).mapInArrow(run, schema)
