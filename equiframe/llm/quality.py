"""Quality rules by distribution divergence.

Every document's character-class histogram and common-word histogram are
compared with the reference of its own language by Jensen-Shannon distance
(square root of the divergence, base 2: 0 equal, 1 disjoint).  The references
are sums over *all* documents of a language that pass the base rules, so that
texts rejected anyway do not shape them: one pass counts classes and words per
partition, Spark adds the partial counts, and the ``COMMON`` most frequent
words of each language make its word reference.  Every language of
``MIN_REFERENCE`` such words or more has one, a number that does not depend on
the rest of the corpus.

A document is judged by one reference, whatever the number of languages.  The
references of the ``HELD`` languages with most words go to every task, those of
the others come by a join; which way a reference comes changes no verdict.
Minimum-length guards: with fewer than ``min_words`` words the word histogram,
with fewer than ``min_chars`` characters the class histogram is too noisy to be
judged and passes; so does a document whose language has too little text for a
reference.

Defined cases: NULL or empty text has no words and fails the base rules; a
NULL language counts as a language of its own; an empty table gives an empty
result (and no reference: nothing diverges); very long texts are counted and
judged whole; repeated rows are judged alike; further columns pass through
untouched.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equiframe.llm.shared import stored

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
COMMON = 48            # words of a word reference
#: Words of a language for a reference: sampling moves a histogram of 49 bins
#: by about sqrt(48 / (8 ln 2 MIN_REFERENCE)) = 0.04, a tenth of WORD_LIMIT.
MIN_REFERENCE = 5_000
HELD = 1_000           # languages whose references go to every task; the others' are joined
CLASS_LIMIT = 0.24     # Jensen-Shannon distances beyond which a text is rejected
WORD_LIMIT = 0.405
MIN_CHARS = 200
#: By the same formula a clean text of 211 words strays from its language by half of
#: WORD_LIMIT, one of 60 by nine tenths of it: shorter ones cannot be told from junk.
MIN_WORDS = 211

#: Classes of bytes: lower, upper, digit, white space, sentence mark, symbol,
#: other ASCII, letter beyond ASCII (lead bytes), continuation (not counted).
N_CLASSES = 8


def _class_table() -> np.ndarray:
    table = np.full(256, 6, np.uint8)
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                               WHITE, b".,;:!?'\"()-", b"#*$%&|<>@=+_~^/\\[]{}`")):
        table[list(chars)] = k
    table[0xC0:] = 7
    table[0x80:0xC0] = N_CLASSES
    return table


_CLASSES = _class_table()
#: Lower case, with ASCII marks and digits as white space: "The," counts as "the".
_PLAIN = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256)).lower()


def base_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a
    UTF-8 text; words are runs of characters other than ASCII white space."""
    words = raw.split()
    seen, dup = set(), 0
    if b"\n" in raw:
        for line in raw.split(b"\n"):
            if line in seen:
                dup += 1
            elif line.strip():
                seen.add(line)
    return (len(words), len(raw.translate(None, WHITE).decode("utf-8", "replace")),
            len(raw) - len(raw.translate(None, SYMBOLS)), dup, repeated_words(words))


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    k = len(number)
    pairs = ids[:-1] * k + ids[1:]
    if k >= 1 << 20:  # three numbers would not fit 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * k + ids[2:]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    covered = np.zeros(len(words), bool)
    starts = np.zeros(len(keys), bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    for shift in range(3):
        covered[shift:shift + len(keys)] |= starts
    return int(covered.sum())


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def class_histogram(raw: bytes) -> np.ndarray:
    return np.bincount(_CLASSES[np.frombuffer(raw, np.uint8)], minlength=N_CLASSES + 1)[:N_CLASSES]


def plain_words(raw: bytes) -> list[bytes]:
    return raw.translate(_PLAIN).split()


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of ``p`` to each row of ``q``
    (counts; an all-zero row is at distance 0 from anything)."""
    ps, qs = p.sum(1, keepdims=True), q.sum(1, keepdims=True)
    p, q = (p / np.maximum(ps, 1))[:, None, :], (q / np.maximum(qs, 1))[None, :, :]
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(2)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(2)
    out = np.sqrt(np.clip((left + right) / 2, 0, 1))
    return np.where((ps == 0) | (qs.T == 0), 0.0, out)


_COUNTS = "lang string, kind string, word binary, n long"


def _count(batches):
    classes: dict = defaultdict(lambda: np.zeros(N_CLASSES, np.int64))
    words: dict = defaultdict(Counter)

    def rows():
        out = [(g, "class", bytes([i]), int(n)) for g, h in classes.items() for i, n in enumerate(h) if n]
        out += [(g, "word", w, n) for g, c in words.items() for w, n in c.items()]
        out += [(g, "total", b"", sum(c.values())) for g, c in words.items() if c]
        classes.clear()
        words.clear()
        for i in range(0, len(out), 50_000):
            yield _record_batch(out[i:i + 50_000])

    for batch in batches:
        for raw, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if raw and not base_failed(len(ws := raw.split()), repeated_words(ws)):
                classes[lang] += class_histogram(raw)
                words[lang].update(plain_words(raw))
        if sum(map(len, words.values())) > 1_000_000:  # bounded memory: partial counts leave early
            yield from rows()
    yield from rows()


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.binary()),
         pa.array(cols[3], pa.int64())], names=["lang", "kind", "word", "n"])


def references(docs: DataFrame, text: str = "text", lang: str = "lang", common: int = COMMON,
               held: int = HELD) -> dict:
    """{"lang": names, "classes": counts, "words": [word lists], "counts":
    [count arrays with the rest last]} of the ``held`` languages with most
    words, over all documents that pass the base rules; "more": a stored table
    of the references of all other languages that have one, None if there is
    none.  What reaches the driver is at most (common + N_CLASSES) * held rows."""
    parts = docs.select(F.col(text).cast("binary").alias("raw"), F.col(lang).cast("string").alias("lang")) \
                .mapInArrow(_count, _COUNTS)
    sums = stored(parts.groupBy("lang", "kind", "word").agg(F.sum("n").alias("n")), "quality-counts")
    totals = sums.filter("kind = 'total'").filter(F.col("n") >= MIN_REFERENCE).select("lang", "n")
    first = totals.orderBy(F.desc("n"), "lang").limit(held + 1).collect()
    large = {r.lang: r.n for r in first[:held]}
    if not large:
        return {"lang": [], "classes": np.zeros((0, N_CLASSES)), "words": [], "counts": [], "more": None}
    known = _among(F.col("lang"), large)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = sums.filter("kind = 'word'").filter(known).withColumn("r", rank).filter(F.col("r") <= common).collect()
    langs = sorted(large, key=lambda g: (g is None, g or ""))
    classes = {g: np.zeros(N_CLASSES) for g in langs}
    for r in sums.filter("kind = 'class'").filter(known).collect():
        classes[r.lang][r.word[0]] = r.n
    words: dict = {g: [] for g in langs}
    for r in sorted(top, key=lambda r: r.r):
        words[r.lang].append((bytes(r.word), r.n))
    more = None
    if len(first) > held:
        rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "word"))
        item = F.struct("word", "n")
        more = stored(sums.filter(~known).withColumn("r", rank).filter(F.col("r") <= max(common, N_CLASSES))
                      .groupBy("lang").agg(
                          F.max(F.when(F.col("kind") == "total", F.col("n"))).alias("total"),
                          F.collect_list(F.when(F.col("kind") == "class", item)).alias("classes"),
                          F.collect_list(F.when((F.col("kind") == "word") & (F.col("r") <= common), item)).alias("words"))
                      .filter(F.col("total") >= MIN_REFERENCE), "quality-references")
    return {"lang": langs, "classes": np.array([classes[g] for g in langs]),
            "words": [[w for w, _ in words[g]] for g in langs],
            "counts": [np.array([n for _, n in words[g]] + [large[g] - sum(n for _, n in words[g])], float)
                       for g in langs], "more": more}


def _among(lang, names):
    """Whether a language (NULL is one) is in ``names``."""
    return F.coalesce(lang.isin([g for g in names if g is not None]), F.lit(None in names))


_OWN = "equiframe_own_reference"
_ITEMS = "array<struct<word:binary,n:bigint>>"
_OWN_TYPE = f"struct<total:bigint,classes:{_ITEMS},words:{_ITEMS}>"


def _with_own(docs: DataFrame, ref: dict, text: str, lang: str) -> DataFrame:
    """``docs`` and the reference of each row's language, where the tasks do
    not hold it.  Only languages beyond the ``HELD`` largest are joined, so
    no large one meets in one task."""
    none = docs.withColumn(_OWN, F.lit(None).cast(_OWN_TYPE))
    if ref.get("more") is None:
        return none
    held = _among(F.col(lang).cast("string"), set(ref["lang"])) | (F.coalesce(F.length(text), F.lit(0)) == 0)
    more = ref["more"].select(F.col("lang").alias(_OWN + "_lang"), F.struct("total", "classes", "words").alias(_OWN))
    joined = docs.filter(~held).join(more, F.col(lang).cast("string").eqNullSafe(F.col(_OWN + "_lang")), "left")
    return none.filter(held).unionByName(joined.drop(_OWN + "_lang"))


def _as_reference(own: dict) -> dict:
    """A row of the stored references in the form of ``references``."""
    classes = np.zeros((1, N_CLASSES))
    for c in own["classes"]:
        classes[0, c["word"][0]] = c["n"]
    counts = [w["n"] for w in own["words"]]
    return {"lang": [None], "classes": classes, "words": [[w["word"] for w in own["words"]]],
            "counts": [np.array(counts + [own["total"] - sum(counts)], float)]}


def divergences(raws: list[bytes], ref: dict, langs: list, owns: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class and word distance of each text to the reference of its language
    (0 without one) and whether there is one.  ``owns``: references that ``ref`` lacks."""
    by_class, by_word, judged = np.zeros(len(raws)), np.zeros(len(raws)), np.zeros(len(raws), bool)
    number = {g: k for k, g in enumerate(ref["lang"])}
    for g in set(langs) & set(number):
        at, k = [i for i, x in enumerate(langs) if x == g], number[g]
        by_class[at], by_word[at] = _distances([raws[i] for i in at], ref["classes"][k], ref["words"][k], ref["counts"][k])
        judged[at] = True
    for i, own in enumerate(owns or ()):
        if own is not None:
            one = _as_reference(own)
            found = _distances([raws[i]], one["classes"][0], one["words"][0], one["counts"][0])
            by_class[i], by_word[i], judged[i] = found[0][0], found[1][0], True
    return by_class, by_word, judged


def _distances(raws: list[bytes], classes: np.ndarray, words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = {w: k for k, w in enumerate(words)}
    hist = np.zeros((len(raws), len(words) + 1))
    for i, raw in enumerate(raws):
        ws = plain_words(raw)
        for w, n in Counter(filter(place.__contains__, ws)).items():
            hist[i, place[w]] = n
        hist[i, -1] = len(ws) - hist[i].sum()
    return (distance(np.array([class_histogram(r) for r in raws], float), classes[None, :])[:, 0],
            distance(hist, counts[None, :])[:, 0])


def verdicts(raws: list[bytes], langs: list, ref: dict, owns: list | None = None, class_limit: float = CLASS_LIMIT,
             word_limit: float = WORD_LIMIT, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> list[tuple]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, class distance, word distance, kept) of each text in its
    language; ``owns``: the references of these that ``ref`` lacks."""
    by_class, by_word, judged = divergences(raws, ref, langs, owns)
    out = []
    for raw, c, w, has in zip(raws, by_class.tolist(), by_word.tolist(), judged.tolist()):
        base = base_counts(raw)
        failed = base_failed(base[0], base[4])
        far = (base[1] >= min_chars and c > class_limit) or (base[0] >= min_words and w > word_limit)
        out.append((*base, failed, c, w, not failed and not (has and far)))
    return out


SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in (
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    T.StructField("base_failed", T.BooleanType()), T.StructField("class_distance", T.DoubleType()),
    T.StructField("word_distance", T.DoubleType()), T.StructField("kept", T.BooleanType())])


def _texts(column) -> list[bytes]:
    return [r or b"" for r in column.to_pylist()]


def score(docs: DataFrame, ref: dict | None = None, text: str = "text", doc_id: str = "doc_id",
          lang: str = "lang", **limits) -> DataFrame:
    """One row per document: counts, distances and verdict (``SCHEMA``)."""
    ref = ref or references(docs, text, lang)
    held = {k: v for k, v in ref.items() if k != "more"}
    names = SCHEMA.fieldNames()
    types = [pa.int64()] * 6 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]

    def run(batches):
        for b in batches:
            found = verdicts(_texts(b.column(1)), b.column(2).to_pylist(), held, b.column(3).to_pylist(), **limits)
            cols = list(zip(*found)) or [[] for _ in names[1:]]
            yield pa.RecordBatch.from_arrays(
                [b.column(0)] + [pa.array(c, t) for c, t in zip(cols, types[1:])], names=names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("raw"),
                       F.col(lang).cast("string").alias("lang"))
    return _with_own(rows, ref, "raw", "lang").mapInArrow(run, SCHEMA)


def keep(docs: DataFrame, ref: dict | None = None, text: str = "text", lang: str = "lang", **limits) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    ref = ref or references(docs, text, lang)
    held = {k: v for k, v in ref.items() if k != "more"}
    width, place, lang_place = len(docs.columns), docs.columns.index(text), docs.columns.index(lang)

    def run(batches):
        for b in batches:
            raws = [(t or "").encode() for t in b.column(place).to_pylist()]
            langs = [None if g is None else str(g) for g in b.column(lang_place).to_pylist()]
            found = verdicts(raws, langs, held, b.column(width).to_pylist(), **limits)
            yield b.select(list(range(width))).filter(pa.array([v[-1] for v in found], pa.bool_()))

    return _with_own(docs, ref, text, lang).mapInArrow(run, docs.schema)
