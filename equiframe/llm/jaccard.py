"""N-gram Jaccard join: size-aware, heavy-light.

A document's set holds its distinct 4-word shingles (64-bit hashes); two sets
link when 100 * |intersection| >= 85 * |union|, that is, when they share at
least need(n, m) = ceil(85 (n + m) / 185) shingles.  Equal sets are one class
(128-bit digest of the sorted set), and only classes are joined.

Small sets, up to a boundary: for every partner size m a set of n shingles
enumerates all its subsets of need(n, m) shingles (by leaving out the few
others) under a key of both sizes and the subset's hash.  Sets that meet
under a key share that subset and link; each key links its members to one of
them, so groups yield as many rows as members.

Large sets: inverted lists are scanned.  First, two sets that link share at
least ``slack`` of their (n - ceil(0.85 n) + slack) least shingle hashes, so a
set with fewer shared ones among them has no partner and leaves.  Of what
remains, all shingles are listed; shingles of one set alone cannot be shared,
and a set with more than n - ceil(0.85 n) of them leaves.  Sets that share one
of their rarest shingles (a prefix filter, rarest first) form families; a
family's tasks scan the inverted lists of its sets and count overlaps exactly.
A task searches its sets from link to link, and never visits a set twice: a
group of near copies costs as much as its size.  Families too large for one
task are cut into blocks, and each pair of blocks is one task.

The boundary minimises the cost over the size histogram: subsets enumerated up
to it, ``SCAN_COST`` postings per shingle above it.  Sets at the boundary that
may link with larger ones take part on both sides.

Result: the links' connected components.  Defined cases: a text without words
has an empty set and links with nothing; fewer than 4 words are one shingle;
documents with NULL id take part and count as larger than any id (a component
of such alone has component_id NULL); rows that repeat an id or a whole row
are rows of their own; an empty table gives an empty result; further columns
pass through ``one_of_each`` untouched.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equiframe.llm.components import components
from equiframe.llm.shared import not_last, or_last, stored

WORDS = 4
NUM, DEN = 85, 100     # links from NUM / DEN on
MOST_SMALL = 32        # sizes among which the boundary is chosen
SLACK = 12             # a set's least hashes: one in so many beyond the necessary
SCAN_COST = 4          # postings moved per shingle of a large set
TASK_SHINGLES = 1_500_000
SALTS = 8
_REMEMBERED = 200_000


def need(n: int, m: int) -> int:
    """Least overlap of sets of n and m shingles that link."""
    return -(-NUM * (n + m) // (NUM + DEN))


def least_overlap(n):
    """Least overlap of a set of n with any partner."""
    return -(-NUM * n // DEN)


def partners(n: int) -> range:
    return range(least_overlap(n), DEN * n // NUM + 1)


def slack(n):
    """How many of a set's least hashes a partner must share."""
    return np.maximum(1, n // SLACK)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(raws: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    digest = xxhash.xxh64_intdigest
    split = [raw.lower().split() for raw in raws]
    flat = np.array([digest(w) for ws in split for w in ws], np.uint64)
    rolled = _mix(flat)
    for k in range(1, words):
        rolled = _mix(rolled[:-1] * np.uint64(0x9E3779B97F4A7C15) + flat[k:]) if len(rolled) > 1 else rolled[:0]
    out, at = [], 0
    for ws in split:
        n = len(ws)
        if n >= words:
            out.append(np.unique(rolled[at:at + n - words + 1]))
        elif n:
            out.append(np.array([digest(b" ".join(ws), seed=n)], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _text_slices(column, most: int = 1 << 23):
    """(start, texts) in slices of about ``most`` bytes."""
    start, texts, size = 0, [], 0
    for t in column.to_pylist():
        texts.append(t or b"")
        size += len(texts[-1])
        if size >= most:
            yield start, texts
            start, texts, size = start + len(texts), [], 0
    if texts:
        yield start, texts


_SKETCH = "did long, n long, sig binary, node long, text_hash long, least array<long>"


def _sketch(batches):
    """Set size and digest of each row; for the first row of a set seen here,
    the hashes that the first filter needs (all, of a small set)."""
    seen: set[bytes] = set()
    for b in batches:
        for start, raws in _text_slices(b.column(1)):
            sets = shingle_sets(raws)
            sigs, least = [], []
            for s in sets:
                sig = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                sigs.append(sig)
                n = len(s)
                k = 0 if sig is None or sig in seen else n if n <= MOST_SMALL else min(
                    n, n - least_overlap(n) + int(slack(n)))
                least.append(s[:k])
                if sig is not None:
                    seen.add(sig)
            if len(seen) > _REMEMBERED:
                seen.clear()
            m = len(raws)
            node = [None if g is None else int.from_bytes(g[:8], "big", signed=True) for g in sigs]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(start, m), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.binary()),
                 pa.array(node, pa.int64()), b.column(2).slice(start, m), _lists(least)],
                names=["did", "n", "sig", "node", "text_hash", "least"])


def _sets_of(batches):
    """(id, n, shingles) of the rows whose set is the wanted one."""
    for b in batches:
        for start, raws in _text_slices(b.column(2)):
            sets = shingle_sets(raws)
            ids, wanted = (b.column(k).slice(start, len(raws)).to_pylist() for k in (0, 1))
            mine = [(i, s) for i, sig, s in zip(ids, wanted, sets) if xxhash.xxh3_128_digest(s.tobytes()) == sig]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[0] for m in mine], pa.int64()), pa.array([len(m[1]) for m in mine], pa.int64()),
                 _lists([m[1] for m in mine])], names=["id", "n", "shingles"])


def boundary(histogram: dict[int, int]) -> int:
    """The size up to which subsets are enumerated: least total cost."""
    best, at, total = None, 0, SCAN_COST * sum(n * k for n, k in histogram.items())
    for x in range(MOST_SMALL + 1):
        k = histogram.get(x, 0)
        if x:
            total += k * (sum(comb(x, need(x, m)) for m in partners(x)) - SCAN_COST * x)
        both = sum(SCAN_COST * n * histogram.get(n, 0) for n in range(least_overlap(x + 1), x + 1)) if x else 0
        if best is None or total + both <= best:
            best, at = total + both, x
    return at


def _subsets(batches):
    """(key, id, n, other) for every subset that a partner could share."""
    for b in batches:
        keys, ids, sizes, others = [], [], [], []
        for i, n, s in zip(*(c.to_pylist() for c in b.columns)):
            mixed = [int(x) for x in _mix(np.array(s, np.int64).view(np.uint64))]
            whole = sum(mixed)
            for m in partners(n):
                c = need(n, m)
                pair = f"{min(n, m)},{max(n, m)}:".encode()
                for left in combinations(mixed, n - c):
                    kept = (whole - sum(left)) & 0xFFFFFFFFFFFFFFFF
                    keys.append(xxhash.xxh3_128_digest(pair + kept.to_bytes(8, "little")))
                    ids.append(i)
                    sizes.append(n)
                    others.append(m)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64()),
                                          pa.array(sizes, pa.int64()), pa.array(others, pa.int64())],
                                         names=["key", "id", "n", "other"])


def _small_links(small: DataFrame) -> DataFrame:
    """Edges among small sets: under each key, from every member to the least
    member of the other size (of the same size, where both are equal)."""
    rows = small.mapInArrow(_subsets, "key binary, id long, n long, other long")
    least = rows.groupBy("key", "n").agg(F.min("id").alias("v"))
    met = rows.withColumn("match", F.col("other")).join(least.withColumnRenamed("n", "match"), ["key", "match"])
    return met.select(F.col("id").alias("u"), "v").filter("u <> v").distinct()


def _scan(group: pd.DataFrame) -> pd.DataFrame:
    """Spanning links of the sets of one task, by scanning inverted lists."""
    ids, sizes = group["id"].to_numpy(), group["n"].to_numpy()
    sets = group["shingles"].to_list()
    k = len(ids)
    owner = np.repeat(np.arange(k), [len(s) for s in sets])
    token = np.unique(np.concatenate(sets), return_inverse=True)[1] if k else owner
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    links: list[tuple[int, int]] = []
    unvisited = np.ones(k, bool)

    def inverted():
        alive = unvisited[owner]
        order = np.argsort(token[alive], kind="stable")
        listed = owner[alive][order]
        starts = np.searchsorted(token[alive][order], np.arange(token.max() + 2))
        return listed, starts, int(unvisited.sum())

    listed, starts, size = inverted() if k else (owner, owner, 0)
    left = k
    for seed in range(k):
        if not unvisited[seed]:
            continue
        unvisited[seed] = False
        left -= 1
        stack = [seed]
        while stack and left:
            x = stack.pop()
            mine = token[ends[x]:ends[x + 1]]
            a, n = starts[mine], starts[mine + 1] - starts[mine]
            total = int(n.sum())
            if not total:
                continue
            at = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
            if total > k:
                overlap = np.bincount(listed[at], minlength=k)
                met = np.flatnonzero(overlap)
                overlap = overlap[met]
            else:
                met, overlap = np.unique(listed[at], return_counts=True)
            linked = met[unvisited[met] & (overlap * (NUM + DEN) >= NUM * (sizes[met] + sizes[x]))]
            unvisited[linked] = False
            left -= len(linked)
            links += [(x, int(y)) for y in linked]
            stack += linked.tolist()
            if left * 2 < size:  # lists of what is still to be found
                listed, starts, size = inverted()
        if not left:
            break
    return pd.DataFrame({"u": ids[[a for a, _ in links]], "v": ids[[b for _, b in links]]})


def _survivors(sketch: DataFrame, classes: DataFrame, low: int) -> DataFrame:
    """Classes of at least ``low`` shingles that pass the first filter.  One
    shuffle and sort of the least hashes tells, by its neighbours in the list
    of its hash, whether a set is counted there already and whether another
    set stands beside it."""
    postings = (sketch.filter((F.size("least") > 0) & (F.col("n") >= low))
                      .select("node", F.explode("least").alias("token")))
    listed = Window.partitionBy("token").orderBy("node")
    before = F.lag("node").over(listed)
    counts = (postings.select("node", before.alias("before"), F.max("node").over(Window.partitionBy("token")).alias("most"))
                      .filter("(before is null or before <> node) and (before is not null or most <> node)")
                      .groupBy("node").agg(F.count("*").alias("k")))
    least = F.ceil(F.col("n") * NUM / DEN)
    enough = F.greatest(F.lit(1), F.floor(least / SLACK))
    return (classes.filter(F.col("n") >= low).join(counts, "node").filter(F.col("k") >= enough)
                   .select("id", "sig", F.col("cid").alias("did"), "text_hash"))


def _texts_of(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The text of each class of ``found``: that of one of its rows, named by
    id and text, as rows without an id (or with the same one) are many."""
    return rows.join(found, ["did", "text_hash"]).select("id", "sig", "raw")


def _families(sets: DataFrame) -> DataFrame:
    """(id, n, shingles, family): shared shingles of the sets that may have a
    partner."""
    postings = sets.select("id", F.explode("shingles").alias("token"))
    listed = (postings.withColumn("df", F.count("*").over(Window.partitionBy("token"))).filter("df > 1")
                      .groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("s")))
    spare = F.col("n") - F.ceil(F.col("n") * NUM / DEN)  # shingles that a link can leave unmatched
    alone = F.col("n") - F.size("s")
    kept = stored(sets.select("id", "n").join(listed, "id").filter(alone <= spare)
                      .withColumn("prefix", F.slice("s", 1, (spare + 1 - alone).cast("int")))
                      .select("id", "n", F.col("s.token").alias("shingles"), F.col("prefix.token").alias("prefix")),
                  "jaccard-sets", release=True)
    rare = kept.select("id", F.explode("prefix").alias("token"))
    first = F.min("id").over(Window.partitionBy("token"))
    edges = rare.select(F.col("id").alias("u"), first.alias("v")).filter("u <> v")
    roots = components(edges)
    least = roots.select(F.col("root").alias("id"), F.col("root").alias("family")).distinct()
    return kept.select("id", "n", "shingles").join(
        roots.select(F.col("node").alias("id"), F.col("root").alias("family")).union(least), "id")


def _large_links(family: DataFrame, task_shingles: int) -> DataFrame:
    """Edges within families.  Small families share a task, a family beyond
    ``task_shingles`` is cut into blocks and tasks take two blocks each."""
    family = stored(family, "jaccard-families")
    sums = family.groupBy("family").agg(F.sum(F.size("shingles")).alias("w"), F.count("*").alias("k")).filter("k > 1")
    total = sums.agg(F.sum("w")).first()[0] or 0
    tasks = max(1, -(-int(total) * 2 // task_shingles))
    cut = sums.select("family", F.ceil(F.col("w") / F.lit(task_shingles / 2)).alias("blocks"))
    rows = family.join(cut, "family")
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                        lambda j: F.struct(F.least(F.col("block"), j).alias("i"), F.greatest(F.col("block"), j).alias("j")))
    pairs = F.filter(pairs, lambda p: (p["i"] < p["j"]) | (F.col("blocks") == 1))
    place = F.when(F.col("blocks") <= 2, F.struct(F.pmod(F.xxhash64("family"), F.lit(tasks)).alias("g"),
                                                 F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"))) \
             .otherwise(F.struct(F.xxhash64("family").alias("g"), F.col("pair.i").alias("i"), F.col("pair.j").alias("j")))
    dealt = (rows.withColumn("block", block)
                 .withColumn("pair", F.explode(F.when(F.col("blocks") <= 2, F.slice(pairs, 1, 1)).otherwise(pairs)))
                 .select(place.alias("place"), "id", "n", "shingles").select("place.*", "id", "n", "shingles"))
    return dealt.groupBy("g", "i", "j").applyInPandas(_scan, "u long, v long")


def join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", task_shingles: int = TASK_SHINGLES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, component (a
    name of the component; NULL without words) and text_hash."""
    rows = docs.select(or_last(F.col(doc_id)).alias("did"), F.col(text).cast("binary").alias("raw"),
                       F.xxhash64(F.col(text)).alias("text_hash"))
    sketch = stored(rows.mapInArrow(_sketch, _SKETCH), "jaccard-sketch")
    classes = stored(sketch.filter("n > 0").groupBy("sig")
                           .agg(F.min("did").alias("cid"), F.min_by("text_hash", "did").alias("text_hash"), F.min("n").alias("n"), F.min("node").alias("node"),
                                F.count("*").alias("members"))
                           .withColumn("id", F.monotonically_increasing_id()), "jaccard-classes")
    sizes = {r.n: r["count"] for r in classes.filter(F.col("n") <= MOST_SMALL).groupBy("n").count().collect()}
    x = boundary(sizes)
    small = (sketch.filter((F.col("n") <= x) & (F.size("least") > 0)).select("sig", "least").dropDuplicates(["sig"])
                   .join(classes.filter(F.col("n") <= x).select("sig", "id", "n"), "sig").select("id", "n", "least"))
    found = stored(_survivors(sketch, classes, least_overlap(x + 1)), "jaccard-survivors", release=True)
    sets = stored(_texts_of(rows, found)
                      .mapInArrow(_sets_of, "id long, n long, shingles array<long>")
                      .dropDuplicates(["id"]), "jaccard-candidates", release=True)
    links = _small_links(small).union(_large_links(_families(sets), task_shingles))
    roots = components(links)
    every = roots.select(F.col("node").alias("id"), "root").union(
        roots.select(F.col("root").alias("id"), "root").distinct())
    linked = (classes.join(every, "id", "left").filter("members > 1 or root is not null")
                     .withColumn("root", F.coalesce("root", "id")))
    least = linked.groupBy("root").agg(F.min("cid").alias("component_id"), F.min("sig").alias("component"))
    names = linked.join(least, "root").select("sig", "component_id", "component", F.explode(
        F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    member = sketch.select("did", "n", "sig", "text_hash", F.pmod(F.xxhash64("did", "text_hash"), F.lit(SALTS)).cast("int").alias("salt"))
    return member.join(names, ["sig", "salt"], "left").select(
        not_last(F.col("did")).alias("doc_id"), F.col("n").alias("n_shingles"),
        not_last(F.coalesce("component_id", "did")).alias("component_id"),
        F.hex(F.coalesce("component", "sig")).alias("component"), "text_hash")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps the one with
    the smallest id (of equal ids, that with the smallest text hash)."""
    rows = join(docs, text, doc_id)
    linked = rows.filter("n_shingles > 0")
    first = linked.groupBy("component").agg(F.min(F.struct(or_last(F.col("doc_id")).alias("_jac_id"),
                                                           F.col("text_hash").alias("_jac_text"))).alias("f"))
    stay = first.select("f.*")
    key = ["_jac_id", "_jac_text"]
    named = docs.withColumns({key[0]: or_last(F.col(doc_id)), key[1]: F.xxhash64(F.col(text))})
    whole = named.join(stay, key, "left_semi").dropDuplicates(key)
    empty = named.filter(~F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return whole.unionByName(empty).select(*docs.columns)
