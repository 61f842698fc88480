"""Runs of repeating words, found on a grammar instead of the text.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) that no neighbouring word extends keeping q, at least ``MIN_LENGTH``
words and ``MIN_EXPONENT`` periods long.

Each task takes its texts in slices of about ``SLICE_BYTES`` and numbers their
words, per text, so that no pair of words is shared by two texts.  Then

1. *Re-Pair*: rounds replace repeated neighbouring pairs by nonterminals.  A
   round replaces every pair that is more frequent than the pairs it overlaps,
   so the most frequent pair of every text goes in each; texts without a
   repeated pair leave.  What is left of a text is put under a balanced tree of
   further nonterminals that occur once.
2. *Boundaries*: a run that lies in a nonterminal's words and crosses the
   boundary between its two parts is looked for once per nonterminal, on its
   first place.  A run of four periods has two of them on one side of the
   boundary, so its period leads from the boundary to a place where the same
   ``GRAM`` words stand; equality of stretches is read from prefix hashes (two
   moduli of 31 bits), the extent by doubling steps.
3. *Translation*: what a nonterminal holds is carried down the derivations to
   all its places.
4. *Merging*: a run is found whole at the lowest nonterminal above it and cut
   short at others; intervals of a period within a larger one of the same
   period go, and of equal intervals the least period stays.

A text is one row; the memory of a slice grows with the longest text alone.
Nothing is shuffled: a lost executor costs its own tasks.

Defined cases: NULL and empty texts have no words and no run, and an empty
text; white space between kept words becomes one space; very long texts make a
slice of their own; repeated rows and ties get equal results; an empty table
gives an empty result.  Columns other than the text pass through untouched,
whatever their names; ``n_words``, ``runs`` and ``collapsed`` of the input give
way to the results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_LENGTH = 6         # words of a run, at least
MIN_EXPONENT = 4       # periods of a run, at least
GRAM = 4               # words that lead from a boundary to a period
SLICE_BYTES = 1 << 21  # bytes of text that a task handles at a time

_MODULI = ((2147483647, 1103515245), (2147483629, 69069 * 11))  # primes below 2**31, bases


class Grammar:
    """Straight-line grammar of a slice: rule k (symbol ``first + k``) derives
    ``left[k] right[k]``, ``size[k]`` words, first at word ``at[k]``."""

    def __init__(self, first: int):
        self.first = first
        self.left = np.empty(0, np.int64)
        self.right = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.at = np.empty(0, np.int64)

    def add(self, left, right, size, at) -> None:
        for name, more in (("left", left), ("right", right), ("size", size), ("at", at)):
            setattr(self, name, np.concatenate([getattr(self, name), more]))

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), np.int64)
        inner = symbols >= self.first
        out[inner] = self.size[symbols[inner] - self.first]
        return out


def numbered_pairs(seq: np.ndarray, top: int) -> np.ndarray:
    """A number for each neighbouring pair of symbols below ``top``."""
    return pd.factorize(seq[:-1] * top + seq[1:])[0]


def re_pair(words: np.ndarray, text: np.ndarray, code: np.ndarray) -> tuple[Grammar, np.ndarray, np.ndarray]:
    """(grammar, symbols left, word at which each begins) of ``words``: dense
    ids, ascending by ``text``, no id in two texts; ``code`` numbers their pairs."""
    grammar = Grammar(int(words.max()) + 1 if len(words) else 0)
    seq, at, doc = words, np.arange(len(words)), text
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(seq) > 1:
        top = grammar.first + len(grammar.left)
        joined = doc[1:] == doc[:-1]
        if len(grammar.left):
            code = numbered_pairs(seq, top)
        n_pairs = int(code.max()) + 1
        code = np.where(joined, code, -1)
        # a pair that overlaps itself (a a a) counts at every other place
        starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        even = (np.arange(len(code)) - np.repeat(starts, np.diff(np.r_[starts, len(code)]))) % 2 == 0
        count = np.bincount(code[even & joined], minlength=n_pairs)
        # frequency first; ties by a scattered number, so that a row of equally frequent pairs has many winners
        scattered = (np.arange(n_pairs, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(34)
        weight = np.where(count > 1, (count.astype(np.int64) << 30) | scattered.astype(np.int64), 0)
        mine = np.where(joined, weight[code], 0)
        run = mine[starts]  # stretches of one pair are judged as one
        wins = (run > 0) & (run > np.r_[0, run[:-1]]) & (run > np.r_[run[1:], 0])
        taken = np.repeat(wins, np.diff(np.r_[starts, len(code)])) & even
        taken &= np.bincount(code[taken], minlength=n_pairs)[code] > 1
        where = np.flatnonzero(taken)
        if not len(where):
            break
        kinds, first, rule = np.unique(code[where], return_index=True, return_inverse=True)
        lead = where[first]
        grammar.add(seq[lead], seq[lead + 1], grammar.sizes(seq[lead]) + grammar.sizes(seq[lead + 1]), at[lead])
        seq = seq.copy()
        seq[where] = top + rule
        keep = np.ones(len(seq), bool)
        keep[where + 1] = False
        # texts in which nothing was replaced are finished
        busy = np.zeros(int(doc[-1]) + 1, bool)
        busy[doc[where]] = True
        on = busy[doc]
        done.append((seq[~on], at[~on]))
        seq, at, doc = seq[on & keep], at[on & keep], doc[on & keep]
    done.append((seq, at))
    seq, at = (np.concatenate([d[k] for d in done]) for k in (0, 1))
    order = np.argsort(at, kind="stable")
    return grammar, seq[order], at[order]


class Equal:
    """Equality of stretches of a word sequence by prefix hashes."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.prefix, self.power = [], []
        for p, base in _MODULI:
            power = np.ones(self.n + 1, np.uint64)
            have = 1
            step = base % p
            while have <= self.n:  # doubling: power[have:2*have] = power[:have] * base**have
                more = min(have, self.n + 1 - have)
                power[have:have + more] = power[:more] * np.uint64(step) % np.uint64(p)
                step = step * step % p
                have += more
            value = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(2654435761) % np.uint64(p)
            prefix = np.zeros(self.n + 1, np.uint64)
            np.cumsum(value * power[:-1] % np.uint64(p), out=prefix[1:])
            self.prefix.append(prefix % np.uint64(p))
            self.power.append(power)

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words from a and from b (a < b) are equal."""
        out = np.ones(len(a), bool)
        for (p, _), prefix, power in zip(_MODULI, self.prefix, self.power):
            m = np.uint64(p)
            x = (prefix[a + size] + m - prefix[a]) % m * power[b - a] % m
            out &= x == (prefix[b + size] + m - prefix[b]) % m
        return out

    def ahead(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words from a and b on that are equal, ``most`` at most."""
        found = np.zeros(len(a), np.int64)
        step = 1 << int(max(most.max(initial=0), 1)).bit_length()
        while step:
            more = np.flatnonzero(found + step <= most)
            more = more[self.same(a[more] + found[more], b[more] + found[more], np.full(len(more), step))]
            found[more] += step
            step >>= 1
        return found

    def behind(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words before a and b that are equal, ``most`` at most."""
        found = np.zeros(len(a), np.int64)
        step = 1 << int(max(most.max(initial=0), 1)).bit_length()
        while step:
            more = np.flatnonzero(found + step <= most)
            less = found[more] + step
            more = more[self.same(a[more] - less, b[more] - less, np.full(len(more), step))]
            found[more] += step
            step >>= 1
        return found


class Places:
    """Places of the grams of GRAM words, to hop from one to the next."""

    def __init__(self, text: np.ndarray, pairs: np.ndarray):
        self.n = len(text)
        self.gram = np.full(self.n, -1, np.int64)
        often = np.bincount(pairs) > 1
        code = np.flatnonzero(often[pairs[:-2]] & often[pairs[2:]])  # of other grams there is no second place
        self.gram[code] = pd.factorize(pairs[code] * len(often) + pairs[code + 2])[0]
        code = self.gram[:self.n - GRAM + 1]
        if len(code):
            inside = text[:len(code)] == text[GRAM - 1:]
            often = np.bincount(code[code >= 0], minlength=1) > 1
            code[:] = np.where(inside & (code >= 0) & often[code], code, -1)
        have = np.flatnonzero(self.gram >= 0)
        self.keys = np.sort(self.gram[have] * self.n + have)

    def next(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """First place from ``least`` on of the gram at ``at``; n without one."""
        k = np.searchsorted(self.keys, self.gram[at] * self.n + np.minimum(least, self.n - 1))
        return self._place(at, k, self.n)

    def last(self, at: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Last place up to ``most`` of the gram at ``at``; -1 without one."""
        k = np.searchsorted(self.keys, self.gram[at] * self.n + np.maximum(most, 0), side="right") - 1
        return self._place(at, k, -1)

    def _place(self, at, k, none):
        key = self.keys[np.clip(k, 0, len(self.keys) - 1)] if len(self.keys) else np.full(len(at), -1)
        ok = (k >= 0) & (k < len(self.keys)) & (self.gram[at] >= 0) & (key // self.n == self.gram[at])
        return np.where(ok, key % self.n, none)


def crossing(equal: Equal, places: Places, words: np.ndarray, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray):
    """(boundary, start, end, period): runs within words lo..hi, cut at them,
    that begin before and end after mid; each with its least period."""
    found: list[tuple[np.ndarray, ...]] = []

    def stretch(k: np.ndarray, q: np.ndarray, anchor: np.ndarray):
        """Extent of period q about words anchor and anchor + q; kept if it is a run over the boundary."""
        end = anchor + q + equal.ahead(anchor, anchor + q, hi[k] - anchor - q)
        start = anchor - equal.behind(anchor, anchor + q, anchor - lo[k])
        ok = (start < mid[k]) & (end > mid[k]) & (end - start >= np.maximum(MIN_LENGTH, MIN_EXPONENT * q))
        found.append((k[ok], start[ok], end[ok], q[ok]))
        return start, end

    most = (hi - lo) // MIN_EXPONENT
    wide = np.flatnonzero((hi - lo >= MIN_LENGTH) & (most > 0))
    for q in range(1, GRAM):  # too short for a gram: two periods right or left of the boundary
        for right in (True, False):
            k = wide[(most[wide] >= q) & ((hi - mid if right else mid - lo)[wide] >= 2 * q)]
            a = mid[k] if right else mid[k] - 2 * q
            for j in range(q):
                ok = words[a + j] == words[a + j + q]
                k, a = k[ok], a[ok]
            stretch(k, np.full(len(k), q), a)
    # right: the gram at the boundary stands again a period later, and two periods fit
    k = wide[(most[wide] >= GRAM) & ((hi - mid)[wide] >= 2 * GRAM)]
    least = mid[k] + GRAM
    while len(k):
        at = places.next(mid[k], least)
        q = at - mid[k]
        ok = (at >= least) & (at < places.n) & (q <= most[k]) & (2 * q <= hi[k] - mid[k])
        k, q = k[ok], q[ok]
        least = mid[k] + q + 1
        square = np.flatnonzero(equal.same(mid[k], mid[k] + q, q))
        _, end = stretch(k[square], q[square], mid[k[square]])
        # a period of two that fits in this stretch would be a multiple of this one
        least[square] = np.maximum(least[square], mid[k[square]] + (end - mid[k[square]]) // 2 + 1)
    # left: the same from the boundary backwards
    k = wide[(most[wide] >= GRAM) & ((mid - lo)[wide] >= 2 * GRAM)]
    tail = mid[k] - GRAM
    upto = tail - GRAM
    while len(k):
        at = places.last(tail, upto)
        q = tail - at
        ok = (at >= 0) & (at <= upto) & (q <= most[k]) & (2 * q <= mid[k] - lo[k])
        k, q, tail = k[ok], q[ok], tail[ok]
        upto = tail - q - 1
        square = np.flatnonzero(equal.same(mid[k] - 2 * q, mid[k] - q, q))
        start, _ = stretch(k[square], q[square], mid[k[square]] - 2 * q[square])
        upto[square] = np.minimum(upto[square], tail[square] - (mid[k[square]] - start) // 2 - 1)
    k, start, end, q = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 4
    return _least_period(k, start, end, q)


def _least_period(k, start, end, q):
    order = np.lexsort((q, end, start, k))
    k, start, end, q = k[order], start[order], end[order], q[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return k[new], start[new], end[new], q[new]


def runs(words: np.ndarray, text: np.ndarray):
    """(text, start, end, period) of all runs of a slice; ``words`` ascend by
    ``text`` and no id stands in two texts.  Starts and ends count words of
    the slice."""
    if len(words) < MIN_LENGTH:
        return (np.empty(0, np.int64),) * 4
    pairs = numbered_pairs(words, int(words.max()) + 1)
    grammar, seq, at = re_pair(words, text, pairs)
    n_rules = len(grammar.left)
    equal, places = Equal(words), Places(text, pairs)
    # boundaries: of the rules, then of a balanced tree over what is left of each text
    doc = text[at]
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    last = np.r_[first[1:], len(seq)]
    begin, stop = (np.repeat(x, last - first) for x in (first, last))
    rank = np.arange(len(seq)) - begin
    mid = np.flatnonzero(rank > 0)
    reach = rank[mid] & -rank[mid]  # a boundary's level in the tree: its trailing zeros
    after = np.r_[at, len(words)]
    ends = np.r_[text[1:] != text[:-1], True]
    text_end = np.flatnonzero(ends)[np.searchsorted(np.flatnonzero(ends), at[mid])] + 1
    upper = mid + reach
    lo = np.r_[grammar.at, at[mid - reach]]
    hi = np.r_[grammar.at + grammar.size, np.where(upper < stop[mid], after[np.minimum(upper, len(seq))], text_end)]
    middle = np.r_[grammar.at + grammar.sizes(grammar.left), at[mid]]
    k, start, end, q = crossing(equal, places, words, lo, middle, hi)
    # those of rules go to every place of the rule
    of_rule = k < n_rules
    start_all, end_all, q_all = [start[~of_rule]], [end[~of_rule]], [q[~of_rule]]
    if of_rule.any():
        rk, rs, re_, rq = k[of_rule], start[of_rule], end[of_rule], q[of_rule]
        row = np.searchsorted(rk, np.arange(n_rules + 1))
        holds = np.diff(row) > 0
        for r in range(n_rules):  # parts stand before the rules that use them
            a, b = grammar.left[r] - grammar.first, grammar.right[r] - grammar.first
            if (a >= 0 and holds[a]) or (b >= 0 and holds[b]):
                holds[r] = True
        symbol, place = seq - grammar.first, at
        while len(symbol):
            ok = symbol >= 0
            ok[ok] = holds[symbol[ok]]
            symbol, place = symbol[ok], place[ok]
            times = row[symbol + 1] - row[symbol]
            each = np.repeat(np.arange(len(symbol)), times)
            own = row[symbol][each] + np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
            shift = place[each] - grammar.at[symbol[each]]
            start_all.append(rs[own] + shift)
            end_all.append(re_[own] + shift)
            q_all.append(rq[own])
            left, right = grammar.left[symbol], grammar.right[symbol]
            symbol, place = (np.r_[left, right] - grammar.first, np.r_[place, place + grammar.sizes(left)])
    start, end, q = (np.concatenate(x) for x in (start_all, end_all, q_all))
    # of one period, an interval within another goes
    of = text[start]
    order = np.lexsort((-end, start, q, of))
    of, start, end, q = of[order], start[order], end[order], q[order]
    group = np.cumsum(np.r_[True, (of[1:] != of[:-1]) | (q[1:] != q[:-1])]) if len(of) else of
    far = np.maximum.accumulate(end + group * (len(words) + 1)) - group * (len(words) + 1)
    keep = np.ones(len(of), bool)
    keep[1:] = (group[1:] != group[:-1]) | (end[1:] > far[:-1])
    return _least_period(of[keep], start[keep], end[keep], q[keep])


def _slice(raws: list[bytes]):
    """(words, runs, collapsed) of some texts: counts, lists of (start, length, period), texts."""
    lists = [r.split() for r in raws]
    counts = np.array([len(x) for x in lists], np.int64)
    ids, base = [], 0
    for x in lists:  # numbers of its own for each text
        number = {w: i for i, w in enumerate(dict.fromkeys(x), base)}
        ids.extend(map(number.__getitem__, x))
        base += len(number)
    ids = np.array(ids, np.int64)
    text = np.repeat(np.arange(len(lists)), counts)
    of, start, end, q = runs(ids, text)
    offset = np.cumsum(counts) - counts
    found: list[list[tuple[int, int, int]]] = [[] for _ in lists]
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, start + q, 1)
    np.add.at(cover, end, -1)
    dropped = np.cumsum(cover[:-1]) > 0
    for t, s, e, p in zip(of.tolist(), (start - offset[of]).tolist(), (end - offset[of]).tolist(), q.tolist()):
        found[t].append((s, e - s, p))
    collapsed = []
    for t, x in enumerate(lists):
        if found[t]:
            gone = dropped[offset[t]:offset[t] + counts[t]].tolist()
            x = [w for w, g in zip(x, gone) if not g]
        collapsed.append(b" ".join(x))
    return counts, [sorted(f, key=lambda r: (r[0], r[2])) for f in found], collapsed


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw = b.column(b.num_columns - 1)
        begin, size, held = 0, 0, []
        for i in range(b.num_rows + 1):
            if i == b.num_rows or size >= SLICE_BYTES:
                if held:
                    counts, found, collapsed = _slice(held)
                    rest = [b.column(k).slice(begin, len(held)) for k in range(b.num_columns - 1)]
                    yield pa.RecordBatch.from_arrays(
                        [*rest, pa.array(counts, pa.int64()),
                         pa.array([[{"start": s, "length": n, "period": p} for s, n, p in f] for f in found], pa.list_(_RUN)),
                         pa.array([c.decode("utf-8", "replace") for c in collapsed], pa.string())],
                        names=[*b.schema.names[:-1], "n_words", "runs", "collapsed"])
                begin, size, held = i, 0, []
            if i < b.num_rows:
                held.append(raw[i].as_py() or b"")
                size += len(held[-1])


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_words``, ``runs`` (start, length and
    period in words, by start, then period) and ``collapsed``: the words that
    no run contains after its first period, joined by one space."""
    rest = [c for c in docs.columns if c not in (text_col, "n_words", "runs", "collapsed")]
    schema = T.StructType([*[docs.schema[c] for c in rest], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(T.StructType([
                               T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))),
                           T.StructField("collapsed", T.StringType())])
    return docs.select(*[F.col(f"`{c}`") for c in rest], F.encode(F.col(text_col), "utf-8").alias("_text")) \
               .mapInArrow(_find, schema)
