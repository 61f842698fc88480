"""Near-duplicate vectors by randomised-rotation binary codes.

Vectors link when they have the same group value (label) and a cosine of at
least ``COSINE``.  A seeded random rotation into as many dimensions as a code
has bits turns a unit vector into its *code* (the signs) and its *correction
factor*, the inner product of the rotated vector and the code's unit vector.
The code's product with another rotated vector, divided by the factor, is an
unbiased estimate of the cosine; its error stays below ``ERRORS * sqrt((1 -
f^2) / f^2 / (bits - 1))`` but for a negligible share of rotations.  Only pairs
whose upper bound reaches the limit are computed again from the vectors, in
double precision, and only that decides.

Pairs to estimate come from the same codes: ``band_bits`` bits of a code are a
key, and vectors with a key in common (same group, same band) meet.  A pair at
the limit agrees in a bit with probability ``1 - acos(COSINE) / pi``; the number
of bands is what finds it with probability ``RECALL``, closer pairs more
surely.  Keys get a bit for each doubling of the largest group, so the chance
meetings of a vector don't grow with the table.

1. Equal vectors are counted first: a class of copies is one row of any size.
2. (class, key) rows, without vectors, are counted by key; keys of one class
   end here.
3. What is left gets its code and vector by a join on the class.  A key of more
   than ``CHUNK`` classes is dealt over chunks, and each pair of chunks is work
   of its own, so no task holds more than two chunks.
4. A task returns, for each class it holds, the links it found (weighted by
   the copies) and one edge to its tree of linked classes; links are counted in
   the first band where a pair meets, never written out as pairs.
5. Components by :mod:`equiframe.llm.components`.

Every step above ends in a written table.

Defined cases: a vector that is NULL, empty, zero or holds NULL or a number
that is not finite, and one without a group value, links with nothing; vectors
of different lengths don't link; copies (rows of equal vectors, repeated rows
too) link; NULL ids are counted and never a component's id, which is NULL only
where no id is; a repeated id is kept in each of its rows; an empty table gives
an empty result; further columns pass through untouched, whatever their names,
but ``n_links``, ``component_id`` and ``kept``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equiframe.llm.components import components
from equiframe.llm.shared import stored

COSINE = 0.98
RECALL = 0.995   # probability of finding a pair that is just at the limit
ERRORS = 4.0     # width of the confidence bound
CHUNK = 1024     # classes of a key that one side of a unit of work holds
SPARE_BITS = 3   # bits of a key beyond the doublings of the largest group
SLICE = 1 << 16  # pairs computed again at a time
SEED = 13


def layout(largest: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a band's key, bands) for groups of up to ``largest`` classes."""
    width = min(62, max(8, math.ceil(math.log2(max(largest, 2))) + SPARE_BITS))
    agree = (1 - math.acos(cosine) / math.pi) ** width
    return width, max(1, math.ceil(math.log(1 - recall) / math.log1p(-agree)))


@lru_cache(8)
def rotation(dims: int, bits: int) -> np.ndarray:
    """``dims`` x ``bits``, orthonormal rows: a random rotation of the vector's
    space into one of at least as many dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dims).standard_normal((max(bits, dims), dims)))
    return (q * np.sign(np.diag(r))).T


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def encode(unit: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes as booleans, correction factors, rotated vectors)."""
    turned = unit @ rotation(unit.shape[1], bits)
    return turned >= 0, np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1]), turned


def estimates(code: np.ndarray, factor: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of the cosines of every rotated vector (rows) with
    every coded one (columns), and the half width of their bounds."""
    n = code.shape[1]
    estimate = turned.astype(np.float32) @ (code.T.astype(np.float32) * 2 - 1) / (factor.astype(np.float32) * np.float32(math.sqrt(n)))
    return estimate, ERRORS * np.sqrt(np.maximum(0, 1 - factor ** 2) / factor ** 2 / max(1, n - 1))


def keys_of(code: np.ndarray, width: int, bands: int) -> np.ndarray:
    """A number for each band's bits."""
    powers = np.left_shift(np.int64(1), np.arange(width, dtype=np.int64))
    return np.stack([code[:, k * width:(k + 1) * width] @ powers for k in range(bands)], axis=1)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _encoder(width: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = ["cls", "grp", "dims", "vector", "n", "code", "factor", "keys"]
            dims = np.array(b.column(2).to_pylist(), np.int64)
            for d in np.unique(dims):
                some = b.filter(pa.array(dims == d))
                code, factor, _ = encode(units(_matrix(some.column(3), int(d))), width * bands)
                packed = np.packbits(code, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array([p.tobytes() for p in packed], pa.binary()), pa.array(factor),
                     pa.array(list(keys_of(code, width, bands)), pa.list_(pa.int64()))], names=names)
    return run


def _links(width: int, bands: int, cosine: float):
    """Links within each unit of work; its rows come one after another."""
    bits = width * bands

    def unit(rows: list[pa.RecordBatch]):
        t = pa.Table.from_batches(rows).combine_chunks()
        dims, band = t.column("dims")[0].as_py(), t.column("band")[0].as_py()
        vectors = units(_matrix(t.column("vector").combine_chunks(), dims))
        n_bits = max(bits, dims)
        code = np.unpackbits(np.frombuffer(b"".join(t.column("code").to_pylist()), np.uint8).reshape(len(vectors), -1),
                             axis=1, count=n_bits).astype(bool)
        factor, n = t.column("factor").to_numpy(), t.column("n").to_numpy()
        side = t.column("chunk").to_numpy()
        keys = keys_of(code, width, bands)
        first = np.flatnonzero(side == side.min())
        second = first if t.column("low")[0].as_py() == t.column("high")[0].as_py() else np.flatnonzero(side == side.max())
        count, tree = np.zeros(len(vectors), np.int64), np.arange(len(vectors))
        if first is not second and side.min() == side.max():
            return None  # one chunk of the two is empty
        estimate, error = estimates(code[second], factor[second], vectors[first] @ rotation(dims, bits))
        i, j = np.nonzero(estimate + error >= cosine)
        i, j = first[i], second[j]
        new = ~(keys[i, :band] == keys[j, :band]).any(axis=1)  # else they met before
        if first is second:
            new &= i < j
        i, j = i[new], j[new]
        near = np.concatenate([np.empty(0, bool), *(np.einsum("ij,ij->i", vectors[i[k:k + SLICE]], vectors[j[k:k + SLICE]]) >= cosine
                                                    for k in range(0, len(i), SLICE))])
        i, j = i[near], j[near]
        np.add.at(count, i, n[j])
        np.add.at(count, j, n[i])
        while (tree[i] != tree[j]).any():  # the least member reaches everyone linked to it
            least = np.minimum(tree[i], tree[j])
            np.minimum.at(tree, i, least)
            np.minimum.at(tree, j, least)
            tree = tree[tree]
        some = np.flatnonzero(count)
        if not len(some):
            return None
        cls = t.column("cls").combine_chunks()
        return pa.RecordBatch.from_arrays([cls.take(pa.array(some)), pa.array(count[some]), cls.take(pa.array(tree[some]))],
                                          names=["cls", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for b in batches:
            ids = np.stack([b.column(c).to_numpy() for c in ("g", "band", "key", "low", "high")], axis=1)
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist(), len(ids)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    if last is not None and (ids[lo] != last).any():
                        if (found := unit(held)) is not None:
                            yield found
                        held = []
                    held.append(b.slice(lo, hi - lo))
                    last = ids[lo]
        if held and (found := unit(held)) is not None:
            yield found
    return run


def _spare_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def _classed(rows: DataFrame, vector_col: str, group_col: str) -> tuple[DataFrame, str]:
    """``rows`` with the class of each: a digest of group and vector, NULL for
    those that link with nothing."""
    vector = F.col(f"`{vector_col}`")
    usable = F.col(f"`{group_col}`").isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    numbers = F.array_join(F.transform(vector, lambda x: (x.cast("double") + 0.0).cast("string")), ",")  # -0.0 as 0.0
    name = _spare_name(rows, "cls")
    text = F.concat(F.col(f"`{group_col}`").cast("string"), F.lit("|"), numbers)
    return rows.withColumn(name, F.when(usable, F.unhex(F.md5(F.encode(text, "utf-8"))))), name


_SIGN = -(1 << 63)


def _by_id(least: str, digest: str) -> F.Column:
    """A class's key: keys are ordered as the least ids of the classes, those
    without an id last, so the least key of a component names its least id."""
    place = F.lpad(F.hex(F.col(least).cast("long").bitwiseXOR(F.lit(_SIGN))), 16, "0")
    return F.concat(F.unhex(F.coalesce(F.concat(F.lit("00"), place), F.lit("01" + "F" * 16))), F.col(digest))


def _id_of(key: F.Column) -> F.Column:
    """Inverse of :func:`_by_id`."""
    place = F.conv(F.hex(F.substring(key, 2, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(_SIGN))
    return F.when(F.hex(F.substring(key, 1, 1)) == "00", place)


def link(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label",
         cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """``rows`` with n_links (other rows linked directly), component_id (least
    id reachable by links, its own included) and kept (id = component_id)."""
    rows, cls = _classed(rows.drop("n_links", "component_id", "kept"), vector_col, group_col)
    classes = stored(rows.select(
        F.col(cls).alias("cls"), F.col(f"`{group_col}`").cast("string").alias("grp"), F.col(f"`{id_col}`").alias("vid"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector")).filter("cls is not null").groupBy("cls").agg(
        F.first("grp").alias("grp"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("n"), F.min("vid").alias("least")
    ).withColumn("dims", F.size("vector")).withColumn("digest", F.col("cls")).withColumn("cls", _by_id("least", "cls")),
        "vector-classes")
    largest = classes.groupBy("grp").count().agg(F.max("count")).first()[0] or 1
    width, bands = layout(largest, cosine, recall)
    coded = stored(classes.select("cls", "grp", "dims", "vector", "n").mapInArrow(
        _encoder(width, bands), "cls binary, grp string, dims int, vector array<double>, n long, code binary, factor double, keys array<long>"),
        "vector-codes")
    meets = coded.select("cls", F.xxhash64("grp", "dims").alias("g"), F.posexplode("keys").alias("band", "key"))
    full = meets.groupBy("g", "band", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    chunks = F.ceil(F.col("members") / CHUNK).cast("int")
    dealt = meets.join(full, ["g", "band", "key"]).withColumn("chunks", chunks).withColumn(
        "chunk", F.pmod(F.xxhash64("cls", F.lit(SEED)), F.col("chunks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "cls", "g", "band", "key", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    unit = ["g", "band", "key", "low", "high"]
    work = dealt.join(coded.drop("grp", "keys"), "cls")
    found = stored(work.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(
        _links(width, bands, cosine), "cls binary, links long, root binary"), "vector-links")
    counted = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cls").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "cls")
    results = classes.select("cls", "n", "digest").join(counted, "cls", "left").join(roots, "cls", "left").select(
        F.col("digest").alias(cls), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        _id_of(F.coalesce("root", "cls")).alias("component_id"))
    own = F.col(f"`{id_col}`")
    return rows.join(results, cls, "left").drop(cls).withColumns({
        "n_links": F.coalesce("n_links", F.lit(0)).cast("long"), "component_id": F.coalesce("component_id", own)}).withColumn(
        "kept", F.coalesce(own == F.col("component_id"), F.lit(False)))
