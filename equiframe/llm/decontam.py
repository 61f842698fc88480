"""Benchmark decontamination with suffix arrays over the training texts.

Each task turns its documents, about ``SHARD_WORDS`` words at a time, into a
shard: word ids with a gap after every document, and a suffix array over it.
Every suffix of every benchmark item is looked up in it by binary search; the
equal range of a window holds all its verbatim occurrences, and occurrences on
one diagonal (item start and document start moving together) are joined into
the longest verbatim matches.  Equal windows are one window with a list of the
places it has in the items, so a prompt shared by many items costs a row for each
occurrence, not one for each item and occurrence; a match is given once, with the
first of the items' places that agree over all of it and their number.  Ids come from the benchmark's vocabulary, words
it lacks match nothing, and the array keeps only suffixes whose first words
occur in the benchmark, ordered by their first ``window`` words: a test suffix
can land on no other.

The benchmark is written once to the shared folder and read by the tasks in
blocks of ``BLOCK_WORDS`` words, so its size is bounded nowhere and neither
the driver nor a task ever holds all of it.

Words are runs of ASCII letters, digits and everything beyond ASCII, with A-Z
lower-cased.  A window is ``window`` consecutive words of an item; an item of
fewer words, but not none, is one window.

Defined cases: NULL text has no words; an item with NULL id hits but is not
listed; repeated items are listed once; an empty table on either side gives no
hit; repeated rows get equal results; a very long text is a shard of its own and
is searched whole; further columns pass through ``clean`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equiframe.llm.shared import filesystem, shared_path

WINDOW = 10
SHARD_WORDS = 1_000_000
BLOCK_WORDS = 500_000
_HASHED = 1 << 22
#: Words: digits, lower-cased letters and bytes beyond ASCII; all else separates.
_WORDS = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
               for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_WORDS).split()


def _mixed(a: np.ndarray, b: np.ndarray | None = None, c: np.ndarray | None = None) -> np.ndarray:
    """A slot of the gram table for one to three ids in a row."""
    h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for x in (b, c):
        if x is not None:
            h = (h ^ (h >> np.uint64(29)) ^ x.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(42)).astype(np.int64)


class Block:
    """Items of a benchmark block and their distinct windows, each with the
    places it stands at (item and start, numbered through the block)."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window, self.names = window, [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        ids = [[number.setdefault(w, len(number) + 1) for w in ws] for _, ws in items]
        self.gram = min([3, window, *map(len, ids)])
        #: Place of each item's first word; a gap keeps the places of two items apart.
        self.base = np.concatenate([[0], np.cumsum([len(x) + 1 for x in ids])[:-1]]).astype(np.int64)
        rows, places = [], []
        for x, base in zip(ids, self.base.tolist()):
            n = min(window, len(x))
            for s in range(len(x) - n + 1):
                rows.append(x[s:s + n] + [0] * (window - n))
                places.append(base + s)
        keys = np.ascontiguousarray(np.array(rows, ">u4").reshape(-1, window)).view(f"S{4 * window}").ravel()
        self.low, first, which = np.unique(keys, return_index=True, return_inverse=True)
        grid = np.array(rows, ">u4").reshape(-1, window)[first]
        self.length = (grid != 0).sum(1)
        high = grid.copy()
        high[np.arange(window)[None, :] >= self.length[:, None]] = 0xFFFFFFFF
        self.high = np.ascontiguousarray(high).view(f"S{4 * window}").ravel()
        self.places = np.array(places, np.int64)[np.argsort(which, kind="stable")]  # ascending for each window
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(grid)))])
        self.table = np.zeros(_HASHED, bool)
        if len(grid):
            # a suffix array position starts a window, so window starts suffice
            self.table[_mixed(*(grid[:, k] for k in range(self.gram)))] = True

    def places_of(self, which: int) -> np.ndarray:
        return self.places[self.begin[which]:self.begin[which + 1]]

    def items_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, places, "right") - 1

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window number, position) of every verbatim occurrence in a shard:
        its suffix array is built and each distinct window's equal range looked
        up.  A position has at most one row for each length of a window, however
        many items share it."""
        n, g = self.window, self.gram
        x = np.concatenate([ids, np.zeros(n, np.uint32)])
        at = np.flatnonzero(ids)
        for k in range(1, g):
            at = at[x[at + k] != 0]
        at = at[self.table[_mixed(*(x[at + k] for k in range(g)))]]
        if not len(at):
            return at, at
        grid = x[at[:, None] + np.arange(n)[None, :]].astype(">u4")
        for k in range(1, n):  # nothing is compared beyond the end of a text
            grid[:, k][grid[:, k - 1] == 0] = 0
        keys = np.ascontiguousarray(grid).view(f"S{4 * n}").ravel()
        order = np.argsort(keys, kind="stable")
        keys, at = keys[order], at[order]
        left = np.searchsorted(keys, self.low, "left")
        right = np.searchsorted(keys, self.high, "right")
        many = np.maximum(right - left, 0)
        which = np.repeat(np.arange(len(many)), many)
        first = np.repeat(left - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
        return which, at[first + np.arange(len(which))]

    def stretches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurring windows, their positions and the rows where a stretch begins
        (and the end): whole windows at consecutive positions, or one short item."""
        which, at = self.occurrences(ids)
        order = np.lexsort((at, self.length[which]))
        which, at = which[order], at[order]
        whole = self.length[which] == self.window
        new = np.ones(len(at), bool)
        new[1:] = ~(whole[1:] & whole[:-1] & (at[1:] == at[:-1] + 1))
        return which, at, np.append(np.flatnonzero(new), len(at))

    def passages(self, windows: np.ndarray) -> tuple[list[tuple[int, int, int, int]], list[str]]:
        """What a stretch of windows has in common with the items: its longest
        verbatim matches (offset, words, least place, number of places) and the
        names of the items.  Places that agree over a whole match are one row;
        they are followed window by window on their diagonals."""
        out, items = [], []
        on, since = np.empty(0, np.int64), np.empty(0, np.int64)
        size = int(self.length[windows[0]])
        for j in range(len(windows) + 1):
            now = self.places_of(windows[j]) - j if j < len(windows) else np.empty(0, np.int64)
            items.append(np.unique(self.items_of(now + j)))
            goes_on = np.isin(on, now, assume_unique=True)
            ended, begun = on[~goes_on], since[~goes_on]
            for b in np.unique(begun).tolist():
                of = ended[begun == b] + b
                out.append((b, j - 1 - b + size, int(of.min()), len(of)))
            starts = now[np.isin(now, on, assume_unique=True, invert=True)]
            on = np.concatenate([on[goes_on], starts])
            since = np.concatenate([since[goes_on], np.full(len(starts), j)])
        found = {self.names[i] for i in np.unique(np.concatenate(items)).tolist()}
        return out, sorted(x for x in found if x is not None)


def put_benchmark(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> str:
    """The benchmark's items in the shared folder, for the tasks, in order of
    their ids (NULL last) and texts: the first place of a match is the same in every run."""
    path = shared_path(benchmark.sparkSession, "benchmark-items")
    (benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).cast("binary").alias("raw"))
              .dropDuplicates().orderBy(F.col("item_id").asc_nulls_last(), "raw").write.parquet(path))
    return path


def blocks(path: str, window: int = WINDOW) -> Iterator[Block]:
    """The stored benchmark, a block at a time."""
    import pyarrow.dataset as ds

    fs, p = filesystem(path)
    items, total = [], 0
    for batch in ds.dataset(p, filesystem=fs, format="parquet").to_batches(columns=["item_id", "raw"], batch_size=1024):
        for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ws := words_of(raw or b""):
                items.append((name, ws))
                total += len(ws)
            if total >= BLOCK_WORDS:
                yield Block(items, window)
                items, total = [], 0
    if items:
        yield Block(items, window)


_LOADED: dict = {}


def _kept_blocks(path: str, window: int) -> Iterator[Block]:
    """:func:`blocks`; a benchmark of one block stays in the worker."""
    if (path, window) in _LOADED:
        yield _LOADED[path, window]
        return
    whole, block = 0, None
    for whole, block in enumerate(blocks(path, window), 1):
        yield block
    if whole == 1:
        _LOADED.clear()
        _LOADED[path, window] = block


def shard_results(texts: list[list[bytes]], path: str, window: int = WINDOW, places: bool = True) -> list[tuple]:
    """(words hit, item names, matches) of each document of a shard, without
    names and matches if not ``places``.  A stretch that stands often is compared
    with the items once."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    hits = np.zeros(starts[-1] + 1, np.int32)
    names: list[set] = [set() for _ in texts]
    found: list[dict] = [{} for _ in texts]
    for block in _kept_blocks(path, window):
        ids = np.zeros(starts[-1], np.uint32)
        get = block.vocabulary.get
        for words, s in zip(texts, starts):
            if words:
                ids[s:s + len(words)] = [get(w, 0) for w in words]
        which, at, cuts = block.stretches(ids)
        if not len(at):
            continue
        first, last = cuts[:-1], cuts[1:] - 1
        np.add.at(hits, at[first], 1)
        np.add.at(hits, at[last] + block.length[which[last]], -1)
        if not places:
            continue
        known: dict[bytes, tuple] = {}
        doc = np.searchsorted(starts, at[first], "right") - 1
        done: set = set()
        for d, i, j, s in zip(doc.tolist(), first.tolist(), cuts[1:].tolist(), (at[first] - starts[doc]).tolist()):
            stretch = which[i:j].tobytes()
            if stretch not in known:
                known[stretch] = block.passages(which[i:j])
            passages, items = known[stretch]
            if (d, stretch) not in done:
                done.add((d, stretch))
                names[d].update(items)
            for offset, n, place, many in passages:
                item = int(block.items_of(np.int64(place)))
                witness = (block.names[item], place - int(block.base[item]))
                old = found[d].get((s + offset, n))  # of another block
                found[d][s + offset, n] = (*(old[:2] if old else witness), many + (old[2] if old else 0))
    inside = np.concatenate([[0], np.cumsum(np.cumsum(hits[:-1]) > 0)])
    return [(int(inside[starts[d] + sizes[d]] - inside[starts[d]]), sorted(names[d]),
             [(*w[:2], *m, w[2]) for m, w in sorted(found[d].items())]) for d in range(len(texts))]


def _by_shard(batches, place: int, shard_words: int):
    """(rows, their words) in shards of about ``shard_words`` words."""
    for b in batches:
        begin, words, total = 0, [], 0
        for i, t in enumerate(b.column(place).to_pylist()):
            words.append(words_of(t.encode() if isinstance(t, str) else t or b""))
            total += len(words[-1])
            if total >= shard_words:
                yield b.slice(begin, i + 1 - begin), words
                begin, words, total = i + 1, [], 0
        if words:
            yield b.slice(begin), words


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("item_id", T.StringType()), T.StructField("item_start", T.LongType()),
        T.StructField("doc_start", T.LongType()), T.StructField("n_words", T.LongType()),
        T.StructField("n_places", T.LongType())])))])
_MATCH_FIELDS = ("item_id", "item_start", "doc_start", "n_words", "n_places")
_MATCH = pa.list_(pa.struct([(n, pa.string() if n == "item_id" else pa.int64()) for n in _MATCH_FIELDS]))


def search(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
           window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: words, words hit, items with occurring windows
    and the longest verbatim matches: first item and start, start in the document,
    words, and how many places of the benchmark hold it."""
    path = put_benchmark(benchmark)

    def run(batches):
        for b, words in _by_shard(batches, 1, shard_words):
            res = shard_results(words, path, window)
            matches = [[dict(zip(_MATCH_FIELDS, m)) for m in r[2]] for r in res]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array([r[0] for r in res], pa.int64()),
                 pa.array([r[1] for r in res], pa.list_(pa.string())), pa.array(matches, _MATCH)],
                names=SCHEMA.fieldNames())

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("binary").alias("raw")).mapInArrow(run, SCHEMA)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
          shard_words: int = SHARD_WORDS) -> DataFrame:
    """The rows of ``docs`` without a hit, with their columns."""
    path, place = put_benchmark(benchmark), docs.columns.index(text)

    def run(batches):
        for b, words in _by_shard(batches, place, shard_words):
            yield b.filter(pa.array([r[0] == 0 for r in shard_results(words, path, window, places=False)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
