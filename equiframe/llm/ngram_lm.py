"""Language-model scoring with an Elias-Fano n-gram trie.

Tokens are the words of a text, A-Z lower-cased, and one end per text.  The
model is an interpolated bigram model with absolute discounting over add-one
unigrams, learnt from all training texts.  It is stored as a trie of two
levels, each in parts that tasks write and every scoring task maps:

* level 1: the 64-bit hashes of the words as an Elias-Fano sequence, a word's
  id being its rank, and the words' counts;
* level 2: for each context (previous word, or the start of a text) the ids of
  the words that follow.  Contexts point to their range by a monotone
  Elias-Fano pointer sequence; the ids of a range are stored relative to the
  end of the range before it, which makes the whole level one monotone
  sequence, and are found by successor search within the context's range.
  Smoothed log10 probabilities, and backoff weights of contexts, are quantised
  to 8 bits by codebooks of equal-width bins, one a part.

Counting: partitions count words and bigrams of their texts before anything is
shuffled.  Bigrams travel as sorted, compressed runs to parts of about
``PART_TOKENS`` tokens, cut by the contexts' counts; a frequent context is cut
within its followers, so no part depends on how frequent a word is.  Contexts
cut by part borders get their number of followers from the parts' manifest.

Nothing of the model passes through the driver but the manifests, a row per
part.  Defined cases: NULL text is empty and is one end token; a NULL id
counts as empty text for the training split; without training texts every
token has probability 1; words are told apart by 64-bit hash; repeated rows
are scored alike (and counted as often as they stand); an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equiframe.llm.eliasfano import Sequence, encode
from equiframe.llm.shared import map_file, shared_path, stored, write_file

DISCOUNT = 0.75
PART_WORDS, PART_TOKENS = 500_000, 4_000_000
SLICE = 8 << 20        # bytes of text handled at a time
END = xxhash.xxh64_intdigest(b"")  # no word is empty
_CODES = 256


def slices(batches, most: int = SLICE):
    """Batches cut to about ``most`` bytes of text (last column)."""
    for b in batches:
        begin, size = 0, 0
        for i, t in enumerate(b.column(b.num_columns - 1).to_pylist()):
            size += len(t or b"")
            if size >= most:
                yield b.slice(begin, i + 1 - begin)
                begin, size = i + 1, 0
        if begin < b.num_rows:
            yield b.slice(begin)


def tokens(raws: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the distinct tokens, number of each token in that list, end
    of each text): the end token is number 0."""
    number: dict[bytes, int] = {b"": 0}
    flat: list[int] = []
    ends = np.empty(len(raws), np.int64)
    for i, raw in enumerate(raws):
        flat += [number.setdefault(w, len(number)) for w in raw.lower().split()] if raw else ()
        flat.append(0)
        ends[i] = len(flat)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in number], np.uint64)
    return hashes, np.array(flat, np.int64), ends


def _part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


# ---- level 1 ---------------------------------------------------------------

def _count_words(batches):
    held: Counter = Counter()

    def rows():
        h = np.array([xxhash.xxh64_intdigest(w) for w in held], np.uint64).view(np.int64)
        n = np.fromiter(held.values(), np.int64, len(held))
        held.clear()
        for a in range(0, len(h), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(h[a:a + (1 << 16)]), pa.array(n[a:a + (1 << 16)])],
                                             names=["h", "n"])

    for b in batches:
        for raw in b.column(0).to_pylist():
            if raw:
                held.update(raw.lower().split())
            held[b""] += 1
            if len(held) > 600_000:  # bounded memory: partial counts leave early
                yield from rows()
    yield from rows()


MANIFEST1 = "part long, file string, n long, total long"


def _write_words(path: str):
    def write(group: pd.DataFrame) -> pd.DataFrame:
        h = group["h"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        n = group["n"].to_numpy()[order]
        name, part = f"{path}/words/{uuid.uuid4().hex}", int(group["part"].iloc[0])
        write_file(name + ".ids", encode(h[order]))
        write_file(name + ".counts", n.astype("<u8").tobytes())
        return pd.DataFrame({"part": [part], "file": [name], "n": [len(n)], "total": [int(n.sum())]})

    return write


class Words:
    """Level 1: ids and counts of words, over the mapped parts."""

    def __init__(self, manifest: list[tuple[int, str, int, int]], parts: int):
        self.parts = parts
        self.first = np.zeros(parts + 1, np.int64)
        self.known: dict[int, tuple[Sequence, np.ndarray]] = {}
        for part, file, n, _ in manifest:
            self.first[part + 1] = n
            self.known[part] = (Sequence(map_file(file + ".ids", np.uint8)), map_file(file + ".counts", "<u8"))
        self.first = np.cumsum(self.first)
        self.size = int(self.first[-1])
        self.total = sum(t for *_, t in manifest)

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Ids of hashes, -1 for words that training lacks."""
        out, order = np.full(len(h), -1, np.int64), np.argsort(h)
        part = _part_of(h[order], self.parts)
        for p in np.unique(part).tolist():
            if p in self.known:
                mine = order[slice(*np.searchsorted(part, [p, p + 1]))]
                at = self.known[p][0].find(h[mine])
                out[mine] = np.where(at >= 0, at + self.first[p], -1)
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Counts of ids (0 of -1)."""
        out = np.zeros(len(ids), np.int64)
        part = np.searchsorted(self.first, ids, "right") - 1
        for p in np.unique(part[ids >= 0]).tolist():
            mine = np.flatnonzero((part == p) & (ids >= 0))
            out[mine] = self.known[p][1][ids[mine] - self.first[p]]
        return out


# ---- level 2 ---------------------------------------------------------------

def bigrams(raws: list, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, contexts, token ids of the distinct tokens, ends) of a slice; the
    context of a text's first token is ``words.size``, of a word that training
    lacks -1."""
    hashes, flat, ends = tokens(raws)
    ids = words.ids(hashes)[flat]
    context = np.empty_like(ids)
    context[1:] = ids[:-1]
    context[np.concatenate([[0], ends[:-1]])] = words.size
    return ids, context, flat, ends


def _key(context: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return (context.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64)


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run of keys with their counts: differences, byte by byte in
    planes, compressed."""
    step = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    n = counts.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(np.vstack([step, n])).tobytes())


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(16, -1)
    keys = np.cumsum(np.ascontiguousarray(planes[:8].T).view(np.uint64).ravel(), dtype=np.uint64)
    return keys, np.ascontiguousarray(planes[8:].T).view("<u8").ravel().astype(np.int64)


class Cuts:
    """Parts of level 2: a bigram's place is its context's tokens before it
    plus, within the context, the share of ids below its word's.  Contexts'
    cumulated counts are needed only at the borders of level-1 parts and inside
    the mapped part that a context lies in."""

    def __init__(self, words: Words, parts: int):
        self.words, self.parts = words, parts
        total = [int(words.known[p][1].sum()) if p in words.known else 0 for p in range(words.parts)]
        self.before = np.concatenate([[0], np.cumsum(total)]).astype(np.int64)
        self.sums: dict[int, np.ndarray] = {}

    def part(self, context: np.ndarray, ids: np.ndarray, starts: int) -> np.ndarray:
        """Part of each bigram; ``starts`` is the count of text starts."""
        w, span = self.words, self.words.total + starts
        low, own = np.empty(len(context), np.float64), np.empty(len(context), np.float64)
        at = np.searchsorted(w.first, context, "right") - 1
        for p in np.unique(at).tolist():
            mine = np.flatnonzero(at == p)
            if p >= w.parts:  # the start of a text, after all words
                low[mine], own[mine] = w.total, starts
                continue
            if p not in self.sums:
                self.sums[p] = np.concatenate([[0], np.cumsum(w.known[p][1].astype(np.int64))])
            k = context[mine] - w.first[p]
            low[mine] = self.before[p] + self.sums[p][k]
            own[mine] = self.sums[p][k + 1] - self.sums[p][k]
        place = (low + own * (ids / max(w.size, 1))) / max(span, 1)
        return np.minimum((place * self.parts).astype(np.int64), self.parts - 1)


MANIFEST2 = "part long, file string, n long, first_context long, last_context long, first_n long, last_n long"


def _merged(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of all runs and their summed counts."""
    pairs = [unpack(r) for r in runs]
    keys, counts = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    at = np.flatnonzero(new)
    return keys[at], np.add.reduceat(counts, at)


def level(keys: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(first context, pointers, monotone ids) of a part's sorted keys.
    Pointers have an entry for every context from the first to the last, and
    the end; ids are relative to the end of the range before theirs."""
    context = (keys >> np.uint64(32)).astype(np.int64)
    ids = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    last = np.append(begins[1:], len(keys)) - 1
    shift = np.concatenate([[0], np.cumsum(ids[last] + 1)[:-1]])
    monotone = ids + np.repeat(shift, last - begins + 1)
    pointers = np.searchsorted(context, np.arange(context[0], context[-1] + 2))
    return int(context[0]), pointers, monotone


def _write_bigrams(path: str):
    def write(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _merged(group["run"].to_list())
        first, pointers, monotone = level(keys)
        name = f"{path}/bigrams/{uuid.uuid4().hex}"
        write_file(name + ".trie", encode(pointers) + encode(monotone))
        write_file(name + ".counts", _small_counts(counts))
        return pd.DataFrame({"part": [int(key[0])], "file": [name], "n": [len(keys)], "first_context": [first],
                             "last_context": [first + len(pointers) - 2],
                             "first_n": [int(pointers[1])], "last_n": [int(len(keys) - pointers[-2])]})

    return write


def _small_counts(counts: np.ndarray) -> bytes:
    """Counts, compressed: most are small."""
    planes = counts.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(planes).tobytes())


def codebook(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of each value, value of each code): bins of equal width, so no
    value is off by more than the width; a code stands for its bin's mean."""
    low, high = (values.min(), values.max()) if len(values) else (0.0, 0.0)
    code = np.minimum((values - low) * (_CODES / ((high - low) or 1.0)), _CODES - 1).astype(np.uint8)
    total = np.bincount(code, values, _CODES)
    return code, (total / np.maximum(np.bincount(code, minlength=_CODES), 1)).astype("<f4")


def _finish(path: str, words_manifest: list, parts: int, discount: float, starts: int):
    """Probabilities and backoff weights of each part, quantised."""
    def run(batches):
        words = _opened_words(words_manifest, parts)
        scale = words.total + words.size + 1
        for b in batches:
            for row in b.to_pylist():
                data = map_file(row["file"] + ".trie", np.uint8)
                pointers = Sequence(data)
                monotone = Sequence(data, pointers.end)
                start = pointers.get(np.arange(pointers.n)).astype(np.int64)
                many = np.diff(start)
                which = np.repeat(np.arange(len(many)), many)
                values = monotone.get(np.arange(monotone.n)).astype(np.int64)
                used = np.flatnonzero(many)
                shift = np.zeros(len(many), np.int64)
                shift[used[1:]] = values[start[used[1:]] - 1] + 1
                ids = values - shift[which]
                planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(
                    map_file(row["file"] + ".counts", np.uint8).tobytes()), np.uint8).reshape(8, -1)
                counts = np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.float64)
                context = row["first_context"] + np.arange(len(many))
                whole = np.where(context == words.size, starts,
                                 words.counts(np.where(context < words.size, context, -1))).astype(np.float64)
                followers = many.astype(np.float64)
                followers[0], followers[-1] = row["first_all"], row["last_all"]
                backoff = discount * followers / np.maximum(whole, 1)
                lower = (words.counts(ids) + 1) / scale
                p = (counts - discount) / whole[which] + backoff[which] * lower
                codes, book = codebook(np.log10(p))
                weight = np.where(many > 0, np.log10(np.where(many > 0, backoff, 1)), 0.0)
                weights, weight_book = codebook(weight)
                write_file(row["file"] + ".model", book.tobytes() + weight_book.tobytes() + codes.tobytes()
                           + weights.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]], pa.int64())], names=["part"])

    return run


class Bigrams:
    """Level 2 over the mapped parts."""

    def __init__(self, manifest: list[dict]):
        self.parts = sorted(manifest, key=lambda r: r["part"])
        self.opened: dict[int, tuple] = {}

    def _open(self, k: int) -> tuple:
        if k not in self.opened:
            row = self.parts[k]
            data = map_file(row["file"] + ".trie", np.uint8)
            pointers = Sequence(data)
            monotone = Sequence(data, pointers.end)
            model = map_file(row["file"] + ".model", np.uint8)
            books = np.frombuffer(model[:2048].tobytes(), "<f4")
            self.opened[k] = (row["first_context"], pointers, monotone, books[:256], books[256:],
                              model[2048:2048 + monotone.n], model[2048 + monotone.n:])
        return self.opened[k]

    def log10(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For ascending distinct keys (context and id): whether the bigram is
        known, its log10 probability if it is, its context's backoff weight."""
        found, logs, weight = np.zeros(len(keys), bool), np.zeros(len(keys)), np.zeros(len(keys))
        all_contexts = (keys >> np.uint64(32)).astype(np.int64)
        for k, row in enumerate(self.parts):
            a, b = np.searchsorted(all_contexts, [row["first_context"], row["last_context"] + 1])
            if a == b:
                continue
            first, pointers, monotone, book, weight_book, codes, weights = self._open(k)
            # a context's range is looked up once, for all its words
            context, which = np.unique(all_contexts[a:b], return_inverse=True)
            ends = np.unique(np.concatenate([context, context + 1])) - first
            value = pointers.get(ends).astype(np.int64)
            begin = value[np.searchsorted(ends, context - first)]
            end = value[np.searchsorted(ends, context + 1 - first)]
            shift = np.zeros(len(context), np.uint64)
            later = np.flatnonzero((begin > 0) & (end > begin))
            shift[later] = monotone.get(begin[later] - 1) + np.uint64(1)
            known = (end > begin)[which]
            weight[a:b][known] = weight_book[weights[context - first]][which][known]
            search = np.flatnonzero(known & ~found[a:b])
            ids = keys[a:b][search] & np.uint64(0xFFFFFFFF)
            at = which[search]
            place = monotone.find(shift[at] + ids, begin[at], end[at])
            hit = np.flatnonzero(place >= 0)
            logs[a + search[hit]] = book[codes[place[hit]]]
            found[a + search[hit]] = True
        return found, logs, weight


_OPEN: dict = {}


def _opened_words(manifest: list, parts: int) -> Words:
    key = manifest[0][1] if manifest else None
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = Words(manifest, parts)
    return _OPEN[key]


def _opened_model(model: dict) -> tuple[Words, Bigrams]:
    words = _opened_words(model["words"], model["parts"])
    key = ("bigrams", model["path"])
    if key not in _OPEN:
        _OPEN[key] = Bigrams(model["bigrams"])
    return words, _OPEN[key]


def train(texts: DataFrame, path: str | None = None, discount: float = DISCOUNT, part_words: int = PART_WORDS,
          part_tokens: int = PART_TOKENS) -> dict:
    """Build the trie from the one column (UTF-8) of ``texts``.  Returns what
    scoring tasks need to open it: folder and manifests."""
    spark = texts.sparkSession
    path = path or shared_path(spark, "ngram-trie")
    counts = texts.mapInArrow(_count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    counts = stored(counts, "ngram-words")
    parts = max(1, -(-counts.count() // part_words))
    part = F.shiftright(F.shiftrightunsigned("h", 32) * parts, 32)
    words = stored(counts.withColumn("part", part).groupBy("part").applyInPandas(_write_words(path), MANIFEST1),
                   "ngram-words-manifest")
    words = sorted(tuple(r) for r in words.collect())
    total, size = sum(w[3] for w in words), sum(w[2] for w in words)
    if size >= 1 << 32:
        raise ValueError("more than 2**32 - 1 distinct words")
    starts = texts.count()
    cuts = max(1, -(-total // part_tokens))

    def runs(batches):
        vocabulary = _opened_words(words, parts)
        cut = Cuts(vocabulary, cuts)
        held, many = [], 0

        def leave():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            at = cut.part((keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), starts)
            ends = np.flatnonzero(np.concatenate([at[1:] != at[:-1], [True]])) + 1
            begin = 0
            for end in ends.tolist():
                yield pa.RecordBatch.from_arrays([pa.array([int(at[begin])], pa.int64()),
                                                  pa.array([pack(keys[begin:end], n[begin:end])], pa.binary())],
                                                 names=["part", "run"])
                begin = end

        for b in slices(batches):
            ids, context, _, _ = bigrams(b.column(0).to_pylist(), vocabulary)
            held.append(_key(context, ids))
            many += len(ids)
            if many >= 4_000_000:
                yield from leave()
                many = 0
        if held:
            yield from leave()

    parted = texts.mapInArrow(runs, "part long, run binary").groupBy("part").applyInPandas(_write_bigrams(path), MANIFEST2)
    parted = stored(parted, "ngram-bigrams-manifest")
    # followers of contexts that part borders cut: a row or two a part
    ends = parted.select(F.col("first_context").alias("c"), F.col("first_n").alias("k")).union(
        parted.filter("last_context > first_context").select("last_context", "last_n"))
    sums = ends.groupBy("c").agg(F.sum("k").alias("k"))
    ready = (parted.join(sums.select(F.col("c").alias("first_context"), F.col("k").alias("first_all")), "first_context")
                   .join(sums.select(F.col("c").alias("last_context"), F.col("k").alias("last_all")), "last_context"))
    done = stored(ready.repartition(max(1, min(cuts, 4 * spark.sparkContext.defaultParallelism)), "part")
                       .mapInArrow(_finish(path, words, parts, discount, starts), "part long"), "ngram-finished")
    rows = parted.join(done, "part").orderBy("part").collect()
    return {"path": path, "words": words, "parts": parts, "total": total, "size": size,
            "bigrams": [{k: r[k] for k in ("part", "file", "first_context", "last_context")} for r in rows]}


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_slice(raws: list, words: Words, level2: Bigrams) -> tuple[np.ndarray, ...]:
    """(tokens, known tokens, base score, score) of each text."""
    hashes, flat, ends = tokens(raws)
    distinct = words.ids(hashes)
    counts = words.counts(distinct)
    unigram = np.log10((counts + 1) / (words.total + words.size + 1))
    ids = distinct[flat]
    context = np.empty_like(ids)
    context[1:] = ids[:-1]
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    context[begins] = words.size
    logs = unigram[flat]
    # words that training lacks take the rank after all others: no bigram has it
    known = np.flatnonzero(context >= 0)
    keys, back = np.unique(_key(context[known], np.where(ids[known] >= 0, ids[known], 0xFFFFFFFF)), return_inverse=True)
    found, own, weight = level2.log10(keys)
    logs[known] = np.where(found[back], own[back], logs[known] + weight[back])
    if not words.total:
        unigram, logs = np.zeros_like(unigram), np.zeros_like(logs)
    add = lambda x: np.add.reduceat(x, begins) if len(begins) else x[:0]
    return np.diff(ends, prepend=0), add((counts > 0)[flat].astype(np.int64)), add(unigram[flat]), add(logs)


def held_out(doc_id: Column, modulus: int = 7, rest: int = 2) -> Column:
    """Whether a document is kept from training: crc32 of its id as text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == rest


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """Train on the documents that are not held out, score all
    (``SCORES``)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"),
                       F.col(text).cast("binary").alias("raw"))
    model = train(rows.filter(~F.col("held_out")).select("raw"), **options)

    def run(batches):
        words, level2 = _opened_model(model)
        for b in slices(batches):
            n, known, base, own = score_slice(b.column(2).to_pylist(), words, level2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n), pa.array(known),
                 pa.array(np.full(len(n), words.total, np.int64)), pa.array(base), pa.array(own)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.mapInArrow(run, SCORES)
