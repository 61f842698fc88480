"""Run detection, conversation repair and near-duplicate vectors against
brute-force versions, on the sf0.01 tables and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest

from equiframe.llm import binary_codes, conversations, queries, runs

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- 11: runs ---------------------------------------------------------------

def brute_runs(w):
    found, n = {}, len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(6, 4 * q) and i > s:
                found.setdefault((s, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def random_words(rnd):
    k, n = rnd.choice([1, 2, 2, 3, 5, 50]), rnd.choice([0, 1, 5, 6, 7, 20, 60, 150, 400])
    if rnd.random() < 0.3:
        return [str(rnd.randrange(k)) for _ in range(n)]
    out = []
    while len(out) < n:
        u = [str(rnd.randrange(k)) for _ in range(rnd.randrange(1, 20))] * rnd.choice([1, 1, 2, 4, 5, 9, 20])
        out += u[:rnd.randrange(1, len(u) + 1)]
    return out * 5 if rnd.random() < 0.2 else out


@pytest.mark.parametrize("seed", range(8))
def test_runs_of_a_slice(seed):
    rnd = random.Random(seed)
    for _ in range(30):
        texts = [random_words(rnd) for _ in range(rnd.randrange(1, 12))]
        counts, found, left = runs._slice([" \n".join(t).encode() for t in texts])
        assert counts.tolist() == [len(t) for t in texts]
        for t, f, c in zip(texts, found, left):
            assert f == brute_runs(t) and c.decode() == collapsed(t, f)


def test_grammar_derives_its_text():
    rnd = random.Random(3)
    words = np.array([rnd.randrange(3) for _ in range(3000)] + [3 + rnd.randrange(2) for _ in range(500)], np.int64)
    text = np.repeat([0, 1], [3000, 500])
    grammar, seq, at = runs.re_pair(words, text, runs.numbered_pairs(words, 5))

    def derive(symbol):
        k = symbol - grammar.first
        return [symbol] if k < 0 else derive(grammar.left[k]) + derive(grammar.right[k])

    assert [w for s in seq for w in derive(s)] == words.tolist()
    places = np.bincount(seq, minlength=grammar.first + len(grammar.left))
    for k in range(len(grammar.left) - 1, -1, -1):
        places[[grammar.left[k]]] += places[grammar.first + k]
        places[[grammar.right[k]]] += places[grammar.first + k]
    assert places[grammar.first:].min() >= 2  # every nonterminal stands twice or more
    assert len(seq) + 2 * len(grammar.left) < 0.75 * len(words)
    for k in range(len(grammar.left)):
        assert derive(grammar.first + k) == words[grammar.at[k]:grammar.at[k] + grammar.size[k]].tolist()
    pairs = [(a, b) for a, b, s in zip(seq[:-1], seq[1:], np.diff(text[at])) if s == 0 and a != b]
    assert len(pairs) == len(set(pairs))  # no pair is left that stands twice


def test_very_repetitive_texts():
    a, b = "a", "ab"
    while len(b) < 5000:
        a, b = b, b + a
    for words, want in (("x " * 60_000, [(0, 60_000, 1)]), (" ".join(str(i % 1999) for i in range(40_000)), [(0, 40_000, 1999)]),
                        (" ".join(b), [])):
        assert runs._slice([words.encode()])[1] == [want]  # a Fibonacci word has no fourth power


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def run_row(doc_id, text):
    w = planted(doc_id, WORD.findall(text or ""))
    found = brute_runs(w)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, found).encode()).hexdigest())


def by_text(rows):
    return sorted(rows, key=str)


def test_run_query(spark, rows):
    got = queries.op11_run_detection(spark, SF)
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    short = [r for r in rows if len(r[1] or "") < 20_000]
    ids = {r[0] for r in short}
    mine = [tuple(r)[:8] for r in got.collect()]
    assert len(mine) == len(rows)
    assert by_text(r for r in mine if r[0] in ids) == by_text(run_row(r[0], r[1]) for r in short)
    assert sum(r[1] > 0 for r in mine) > 20


def test_runs_on_odd_rows(spark, edge, empty, edge_rows):
    out = runs.find(edge)
    assert set(out.columns) == set(edge.columns) - {"text"} | {"n_words", "runs", "collapsed"}
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()]
    want = []
    for d, text, _, _ in edge_rows:
        w = WORD.findall(text or "")
        found = brute_runs(w) if len(w) < 1000 else []
        want.append((d, len(w), found, collapsed(w, found)))
    assert by_text(got) == by_text(want)
    assert runs.find(empty).collect() == []
    clash = edge.select("doc_id", "text").withColumnsRenamed({"doc_id": "runs"})
    assert runs.find(clash).columns == ["n_words", "runs", "collapsed"]


# ---- 12: conversations -------------------------------------------------------

def damage(rows):
    """Rows as (conv_id, turn, role, text) after the query's damage."""
    out = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(c, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def repair_brute(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of one conversation's rows."""
    if not rows:
        return (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
    turns = [r[1] for r in rows if r[1] is not None]
    seen, faults = set(), []
    for _, _, role, text in rows:
        solid = WORD.findall(text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else
                      "truncated" if solid[-1][-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

    def after(roles, role):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((roles, role))

    def next_role(last):
        return "assistant" if last == "u" else "user"

    best = [None] * (len(rows) + 1)
    for i in range(len(rows), -1, -1):
        cell = {}
        for last in ("", "s", "u", "a"):
            options = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
            if i < len(rows):
                options.append((lambda x: (2 + x[0], "D" + x[1], x[2]))(best[i + 1][last]))
                if faults[i] not in ("blank", "duplicate"):
                    more = 5 * (faults[i] == "truncated")
                    for edit, cost, role in (("K", 0, rows[i][2]), ("R", 1, next_role(last))):
                        to = after(last, role[:1])
                        if to:
                            x = best[i + 1][to]
                            options.append((cost + more + x[0], edit + x[1], (f"{role}:{rows[i][3]}", *x[2])))
            cell[last] = min(options, default=(math.inf, "", ()))
        for _ in range(3):
            for last in cell:
                role = next_role(last)
                x = cell[after(last, role[:1])]
                cell[last] = min(cell[last], (5 + x[0], "I" + x[1], (f"{role}:", *x[2])))
        best[i] = cell
    cost, audit, lines = best[0][""]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def repaired(rows):
    per = {c: [] for c, *_ in rows}
    for r in damage(rows):
        per[r[0]].append(r)
    return by_text((c, *repair_brute(own)) for c, own in per.items())


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_conversation_repair(spark, SF)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert by_text(tuple(r) for r in got.collect()) == repaired(rows)


def _stored_conversations(spark, tmp_path, rows):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string, conv long").write.parquet(
        str(tmp_path / "conversations.parquet"))
    return str(tmp_path)


def test_repair_of_odd_rows(spark, tmp_path):
    rnd = random.Random(12)
    texts = ["Yes.", "No!", "cut", "", " \t", None, "é?  ", "a\nb.\n", "More . ", "x" * 50_000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "Assistant", "user", "assistant", "u"]
    rows = []
    for c in [*range(120), None]:
        for t in range(rnd.choice([1, 2, 3, 6, 9, 14])):
            if rnd.random() < 0.9:
                rows.append((c, rnd.choice([None, t, t, t, 2 * t, 1]), rnd.choice(roles), rnd.choice(texts), "p", 1))
            if rnd.random() < 0.15 and rows:
                rows.append(rows[-1])
    got = queries.op12_conversation_repair(spark, _stored_conversations(spark, tmp_path, rows)).collect()
    assert by_text(tuple(r) for r in got) == repaired([r[:4] for r in rows])


def test_repair_of_a_conversation_of_many_blocks(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(7, t // 2, rnd.choice(["user", "assistant", "assistant", "system"]), f"{rnd.randrange(6000)}{rnd.choice('. ')}", "", 0)
            for t in range(9000)] + [(7, 100, "user", "again.", "", 0)] * 5000 + [(8, None, "user", "again.", "", 0)] * 4500
    assert len(rows) > 3 * conversations.BLOCK
    got = queries.op12_conversation_repair(spark, _stored_conversations(spark, tmp_path, rows)).collect()
    assert by_text(tuple(r) for r in got) == repaired([r[:4] for r in rows])


def test_repair_of_nothing(spark, tmp_path):
    assert queries.op12_conversation_repair(spark, _stored_conversations(spark, tmp_path, [])).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_blocks_compose(seed):
    rnd = random.Random(seed)
    codes = bytes(rnd.choice([0, 1, 1, 2, 2, 3]) | rnd.choice([0, 0, 0, 4, 8]) for _ in range(rnd.choice([1, 5, 200, 700])))
    whole = conversations.walk(codes, conversations._ENDS, 0, True)
    cuts = sorted({0, len(codes), *(rnd.randrange(len(codes) + 1) for _ in range(4))})
    parts, cost, ends = list(zip(cuts, cuts[1:])), conversations._ENDS, []
    for lo, hi in reversed(parts):
        ends.append(cost)
        m = conversations.matrix(codes[lo:hi])
        cost = tuple(min(m[s][t] + cost[t] for t in range(4)) for s in range(4))
    state, edits, total = 0, "", 0
    for (lo, hi), end in zip(parts, reversed(ends)):
        e, state, c = conversations.walk(codes[lo:hi], end, state, hi == len(codes))
        edits, total = edits + e, total + c
    assert (edits, total) == (whole[0], whole[2]) and cost[0] == total


def test_edits_name_their_rows(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "hi."), (1, 2, "assistant", "A."), (1, 2, "assistant", "A."), (1, 3, "user", "B.")]
    repair = conversations.Repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    turns = [(r.role, r.text) for r in repair.turns().orderBy("place", "skip", "nth").collect()]
    audit = repair.cost_and_audit().first()
    assert (audit.cost, audit.audit) == repair_brute(rows)[5:7]
    text = "\n".join(f"{r}:{t}" for r, t in turns)
    assert hashlib.sha256(text.encode()).hexdigest() == repair_brute(rows)[7]
    assert "".join(r.edit for r in repair.edits().orderBy("place", "skip", "nth").collect()) == audit.audit


# ---- 13: vectors ---------------------------------------------------------------

def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_links(rows, limit=0.98):
    """(id, n_links, component, kept) of rows (id, vector, label)."""
    groups = defaultdict(list)
    for i, (_, v, g) in enumerate(rows):
        if g is not None and usable(v):
            groups[g, len(v)].append(i)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for own in groups.values():
        m = np.array([rows[i][1] for i in own], float)
        m /= np.abs(m).max(axis=1)[:, None]
        m /= np.linalg.norm(m, axis=1)[:, None]
        for a, b in zip(*np.nonzero(np.triu(m @ m.T >= limit, 1))):
            links[own[a]] += 1
            links[own[b]] += 1
            x, y = find(own[a]), find(own[b])
            root[max(x, y)] = min(x, y)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return by_text((r[0], n, least.get(find(i)), r[0] is not None and r[0] == least.get(find(i))) for i, (r, n) in enumerate(zip(rows, links)))


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.1"])
def test_vector_query(spark, sf):
    got = queries.op13_binary_codes(spark, sf)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert by_text(tuple(r) for r in got.collect()) == brute_links(rows)


def near_copies(rnd, dims, n, spread):
    base = rnd.standard_normal(dims)
    return (base + spread * np.linalg.norm(base) / math.sqrt(dims) * rnd.standard_normal((n, dims))).astype(np.float32)


def test_recall_and_precision_near_the_limit(spark):
    """Pairs from 0.96 to 1: none below the limit, at least 0.99 of the others (brute force)."""
    rnd = np.random.default_rng(1)
    rows = []
    for g in range(3):
        for k in range(150):
            for v in near_copies(rnd, 64, 4, rnd.uniform(0.02, 0.2)):
                rows.append((len(rows), v.tolist(), g))
    got = {r.vec_id: r for r in binary_codes.link(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    want = {w[0]: w for w in brute_links(rows)}
    assert all(got[i].n_links <= want[i][1] for i in want)
    assert sum(r.n_links for r in got.values()) >= 0.99 * sum(w[1] for w in want.values()) > 300


def test_a_group_wider_than_a_chunk(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, v.tolist(), 1, "c") for i, v in enumerate(near_copies(rnd, 16, 2500, 0.05))]
    rows += [(10_000 + i, rows[0][1], 1, "c") for i in range(3000)]  # copies of one vector
    assert 2500 > 2 * binary_codes.CHUNK
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in binary_codes.link(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cls string")).collect()]
    assert by_text(got) == brute_links([r[:3] for r in rows])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.1], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None),
            (6, [1.0, 0.0], None), (7, None, 1), (8, [], 1), (9, [0.0, 0.0], 1), (10, [1.0, None], 1), (11, [1.0, nan], 1),
            (12, [inf, 0.0], 1), (None, [1.0, -0.0], 1), (None, None, 1), (13, [1.0, 0.0, 0.0], 1), (14, [1e300, 1e299], 3),
            (15, [1e-300, 1e-301], 3), (None, [5.0, 5.0], 4), (None, [5.0, 5.0], 4), (16, [-1.0, 0.0], 1), (None, [1.0, 0.2], 1)]
    full = [(*r, 5, True, "x") for r in rows]
    df = spark.createDataFrame(full, "vec_id long, embedding array<double>, label int, n_links int, kept boolean, cls string")
    out = binary_codes.link(df)
    assert sorted(out.columns) == sorted(df.columns + ["component_id"])
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in out.collect()]
    assert by_text(got) == brute_links(rows)
    assert binary_codes.link(df.limit(0)).collect() == []


def test_estimates_are_unbiased_and_bounded():
    rnd = np.random.default_rng(3)
    dims, bits, errors, outside, pairs = 32, 160, [], 0, 0
    for trial in range(200):
        binary_codes.rotation.cache_clear()
        q, r = np.linalg.qr(rnd.standard_normal((bits, dims)))
        turn = (q * np.sign(np.diag(r))).T
        u = binary_codes.units(near_copies(rnd, dims, 6, 0.5).astype(float))
        turned = u @ turn
        factor = np.abs(turned).sum(axis=1) / math.sqrt(bits)
        estimate, bound = binary_codes.estimates(turned >= 0, factor, turned)
        off = ~np.eye(6, dtype=bool)
        error = (estimate - u @ u.T)[off]
        errors.append(error.mean())
        outside += (np.abs(error) > np.broadcast_to(bound, (6, 6))[off]).sum()
        pairs += off.sum()
    assert abs(np.mean(errors)) < 4 * np.std(errors) / math.sqrt(len(errors))
    assert outside <= 0.001 * pairs


@lru_cache
def _layouts():
    return [binary_codes.layout(n) for n in (0, 1, 2, 1000, 10 ** 6, 10 ** 12)]


def test_layout_keeps_its_recall():
    for width, bands in _layouts():
        agree = (1 - math.acos(0.98) / math.pi) ** width
        assert 1 - (1 - agree) ** bands >= binary_codes.RECALL
    assert [w for w, _ in _layouts()] == sorted(w for w, _ in _layouts())
