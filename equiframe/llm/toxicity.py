"""Toxicity by cumulative-link ordinal regression.

P(severity >= k) = sigmoid(w . x - theta_k) with one weight vector for all
ordered thresholds theta_1 < theta_2 < ...; the outputs are the expected
severity (the sum of those probabilities), the likeliest grade and whether
P(severity >= 1) is at least 1/2.

Features are sparse and binary: the distinct words of the whole text (A-Z
lower-cased, ASCII marks and digits separate) and their first ``PREFIXES``
bytes, so that inflected forms share what they begin with.  Of the features in
the fitting sample, those are used that stand in at least ``MIN_SHARE`` of
the toxic texts (``LEAST_TOXIC`` at least) and are ``MIN_ODDS`` times likelier there than in clean ones.

Labels say only whether a text is toxic.  Grades of the fitting sample follow
from how many distinct such words a toxic text holds: grade g begins at
``GRADES[g - 1]`` of them.  (Labels that carry grades are used as they are.)

The classifier is fitted on a bounded sample of labelled rows: of toxic and of
clean ones at most ``FIT_ROWS`` each, those with the least hash of the id.
Everything else reads whole texts of all documents.

Defined cases: NULL or empty text has no feature and severity of the intercept;
NULL labels and ids are left out of the fit; a document with several labels
takes the highest; without any toxic (or any clean) labelled document nothing
is known and all severities are 0; an empty table gives an empty result;
repeated rows are scored alike; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equiframe.llm.quality import plain_words

FIT_ROWS = 2500        # toxic, and as many clean, labelled rows at most
PREFIXES = (4, 5, 6, 7, 8, 9)   # bytes
MIN_SHARE, MIN_ODDS = 0.02, 12.0   # of toxic texts
LEAST_TOXIC, MOST_FEATURES = 4, 4000
GRADES = (0, 2, 4)     # distinct marked words from which a toxic text has grade 1, 2, 3
ROUNDS, RATE, RIDGE = 500, 0.1, 1e-4


def features(words: set[bytes], prefixes: tuple[int, ...] = PREFIXES) -> set[bytes]:
    """Words as they are; prefixes (of longer words) with a star."""
    out = set(words)
    for k in prefixes:
        out.update([w[:k] + b"*" for w in words if len(w) > k])
    return out


def choose(toxic: list[set], clean: list[set], prefixes: tuple[int, ...] = PREFIXES) -> list[bytes]:
    """Features of texts (sets of words) that mark toxic ones, the likeliest
    first.  Words, then the prefixes of each length, are counted in turn, in
    clean texts only what toxic ones hold often enough."""
    least = max(LEAST_TOXIC, MIN_SHARE * len(toxic))
    count: dict[bytes, int] = {}
    odds: dict[bytes, float] = {}
    for k in (None, *prefixes):
        a = Counter(f for words in toxic for f in (words if k is None else features(words, (k,)) - words))
        a = Counter({f: n for f, n in a.items() if n >= least})
        b = Counter(f for words in clean for f in (words if k is None else features(words, (k,))) if f in a)
        count.update(a)
        odds.update({f: ((n + 0.1) / (len(toxic) + 1)) / ((b[f] + 0.1) / (len(clean) + 1)) for f, n in a.items()})
    marked = [f for f, o in odds.items() if o >= MIN_ODDS]
    words = [f for f in marked if not f.endswith(b"*")]
    own = {f: max((count[w] for w in words if w.startswith(f[:-1])), default=0) for f in marked if f.endswith(b"*")}
    marked = [f for f in marked if own.get(f, 0) < 0.9 * count[f]]  # a prefix must cover more than one word
    return sorted(marked, key=lambda f: (-odds[f] * count[f], f))[:MOST_FEATURES]


def grade_labels(toxic: list[set], chosen: list[bytes]) -> list[int]:
    words = {f for f in chosen if not f.endswith(b"*")}
    return [sum(len(f & words) >= k for k in GRADES) for f in toxic]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[np.ndarray], grades: np.ndarray, n_features: int, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by Adam on the penalised likelihood; thresholds
    are a first one and positive steps, so they stay ordered."""
    at = np.concatenate(rows) if rows else np.empty(0, int)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    params = np.concatenate([np.zeros(n_features), [0.0], np.zeros(levels - 1)])
    m, v = np.zeros_like(params), np.zeros_like(params)
    n = max(len(rows), 1)
    for t in range(1, ROUNDS + 1):
        w, steps = params[:n_features], np.exp(params[n_features + 1:])
        theta = params[n_features] + np.concatenate([[0], np.cumsum(steps)])
        s = np.bincount(row, w[at], len(rows))
        upper = np.concatenate([np.ones((len(rows), 1)), _sigmoid(s[:, None] - theta)], 1)  # P(y >= k)
        upper = np.concatenate([upper, np.zeros((len(rows), 1))], 1)
        i = np.arange(len(rows))
        lo, hi = upper[i, grades], upper[i, grades + 1]
        p = np.maximum(lo - hi, 1e-9)
        # d log p: through P(y >= grade) and P(y >= grade + 1)
        dlo, dhi = lo * (1 - lo) / p, hi * (1 - hi) / p
        ds = dlo - dhi
        dtheta = np.zeros(levels)
        np.add.at(dtheta, grades[grades > 0] - 1, -dlo[grades > 0])
        np.add.at(dtheta, grades[grades < levels], dhi[grades < levels])
        g = np.concatenate([np.bincount(at, ds[row], n_features) / n - RIDGE * w, [dtheta.sum() / n],
                            np.cumsum(dtheta[::-1])[::-1][1:] * steps / n])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params + RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    steps = np.exp(params[n_features + 1:])
    return params[:n_features], params[n_features] + np.concatenate([[0], np.cumsum(steps)])


def fit_words(texts: list[set[bytes]], labels: list[int], graded: bool = False) -> dict | None:
    """A model from the distinct words of labelled texts; None if one kind is
    missing."""
    toxic = [t for t, y in zip(texts, labels) if y > 0]
    clean = [t for t, y in zip(texts, labels) if y == 0]
    if not toxic or not clean:
        return None
    chosen = choose(toxic, clean)
    number = {f: i for i, f in enumerate(chosen)}
    grades = np.array(([y for y in labels if y > 0] if graded else grade_labels(toxic, chosen)) + [0] * len(clean))
    rows = [np.array(sorted(number[x] for x in features(t) & number.keys()), int) for t in toxic + clean]
    weights, theta = fit(rows, grades, len(chosen), int(grades.max()))
    return {"weights": dict(zip(chosen, weights.tolist())), "theta": theta}


def severities(texts: list[set[bytes]], model: dict | None) -> list[tuple[float, int, bool]]:
    """(expected severity, likeliest grade, toxic) of each text's words."""
    if model is None:
        return [(0.0, 0, False)] * len(texts)
    weight = model["weights"]
    known = weight.keys()
    s = np.array([sum(weight[f] for f in sorted(features(t) & known)) for t in texts], float)
    above = _sigmoid(s[:, None] - model["theta"])
    each = np.concatenate([np.ones((len(texts), 1)), above], 1) - np.concatenate([above, np.zeros((len(texts), 1))], 1)
    return list(zip(above.sum(1).tolist(), each.argmax(1).tolist(), (above[:, 0] >= 0.5).tolist()))


def sample(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
           fit_rows: int = FIT_ROWS) -> tuple[list[set[bytes]], list[int]]:
    """The distinct words and labels of the fitting sample, at most
    ``fit_rows`` documents a kind."""
    known = (labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
                   .filter("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y")))
    least = [known.filter(c).orderBy(F.xxhash64("id"), "id").limit(fit_rows) for c in ("y > 0", "y = 0")]
    wanted = F.broadcast(least[0].union(least[1]))  # at most 2 * fit_rows narrow rows

    def words(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1),
                 pa.array([b" ".join(sorted(set(plain_words(t or b"")))) for t in b.column(2).to_pylist()], pa.binary())],
                names=["id", "y", "words"])

    rows = (docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("binary").alias("raw"))
                .join(wanted, "id").select("id", "y", "raw").mapInArrow(words, "id long, y int, words binary")
                .dropDuplicates(["id"]).collect())
    rows.sort(key=lambda r: r.id)
    return [set(bytes(r.words).split()) for r in rows], [r.y for r in rows]


SCORES = "doc_id long, severity double, grade int, toxic boolean"


def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
          fit_rows: int = FIT_ROWS, graded: bool = False) -> DataFrame:
    """One row per document: expected severity, likeliest grade, toxic."""
    model = fit_words(*sample(docs, labels, text, doc_id, label, fit_rows), graded)

    def run(batches):
        for b in batches:
            texts = [set(plain_words(t or b"")) for t in b.column(1).to_pylist()]
            cols = list(zip(*severities(texts, model))) if texts else [[], [], []]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.int32()),
                                              pa.array(cols[2], pa.bool_())],
                                             names=["doc_id", "severity", "grade", "toxic"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("binary").alias("raw")).mapInArrow(run, SCORES)
