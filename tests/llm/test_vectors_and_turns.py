"""Whitening, repair of conversations, and MinHash on small tables, against plain second ways."""

import functools
import hashlib
import itertools
import math
import random
import re
import sys
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import conversations, minhash, whitening
from strata.llm.queries import QUERIES
from tests.llm.test_text_operators import as_rows, frame, plain_components

SF_DIR = "/root/testdata/sf0.001"


# -- whitening


def integers(vector):
    return [math.floor(64 * float(c)) + 1_000_000 for c in vector]


def plain_whitening(rows, count=32):
    """{(id, component): (n, deviation, whitened up to sign, share)} by numpy and exact fractions."""
    good = [(i, integers(v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in good], object)
    n, sums = len(x), x.sum(axis=0)
    centred = x * n - sums
    v = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in centred.T @ centred])
    values, vectors = np.linalg.eigh(v)
    order = [k for k in np.argsort(-values, kind="stable") if values[k] > 1e-9][:count]
    out = {}
    for (i, _), row in zip(good, centred, strict=True):
        for number, k in enumerate(order, 1):
            white = abs((row.astype(float) / n) @ vectors[:, k] / math.sqrt(values[k]))
            out[i, number] = (n, int((row * row).sum()), white, values[k] / v.trace())
    return out


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, "own", 7) for i, v in rows], "vec_id bigint, embedding array<float>, component string, n int")


def close(df, want):
    got = {(r.vec_id, r.component): r for r in df.collect()}
    assert got.keys() == want.keys()
    for key, (n, deviation, white, share) in want.items():
        r = got[key]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(white, rel=1e-6, abs=1e-6) and r.explained == pytest.approx(share, rel=1e-9)
        assert r.identity_error < 1e-9


def test_whitening_query_against_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    close(QUERIES["op11_embedding_whitening"](spark, SF_DIR), plain_whitening(rows))


def test_whitening_of_awkward_rows(spark):
    draw = random.Random(1)
    rows = [(i, [draw.gauss(0, 1 + k) for k in range(5)]) for i in range(40)]
    rows += [(99, rows[0][1]), (98, None), (97, [1.0, None, 0.0, 0.0, 0.0]), (96, [1.0, float("nan"), 0.0, 0.0, 0.0]), (95, [float("inf")] * 5)]
    rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    odd = vectors_frame(spark, [*rows, (94, [1.0] * 4), (93, [])])
    close(whitening.whiten(odd), plain_whitening(rows))
    copies = vectors_frame(spark, [(i, [0.5, -0.25]) for i in range(6)])
    assert whitening.whiten(copies).collect() == []
    empty = whitening.whiten(vectors_frame(spark, []))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(vectors_frame(spark, [(1, None), (2, [])])).collect() == []


def test_whitening_of_equal_eigenvalues_and_large_entries(spark):
    # Six corners of an octahedron: three equal eigenvalues, whose vectors must still be orthonormal.
    corners = [(k, [float(s * (j == axis)) for j in range(3)]) for k, (axis, s) in enumerate(itertools.product(range(3), (1, -1)))]
    got = whitening.whiten(vectors_frame(spark, corners)).collect()
    assert {r.component for r in got} == {1, 2, 3} and all(r.identity_error < 1e-12 and r.explained == pytest.approx(1 / 3, rel=1e-12) for r in got)
    large = [(0, [1e15, 1.0]), (1, [-3e15, 2.0]), (2, [5e14, -1.0]), (3, [1e38, 0.0])]
    got = whitening.whiten(vectors_frame(spark, large)).collect()
    assert {r.vec_id for r in got} == {0, 1, 2} and all(r.deviation is None for r in got)
    assert {r.component for r in got} == {1, 2} and all(r.identity_error < 1e-4 for r in got)


def test_exact_sums_of_any_size():
    draw = random.Random(2)
    for top in (3, 1 << 19, 1 << 40, (1 << 61) - 1):
        rows = np.array([[draw.randint(-top, top) for _ in range(4)] for _ in range(9)], np.int64)
        exact = rows.astype(object)
        assert (whitening.exact_gram(rows) == exact.T @ exact).all() and (whitening.exact_sums(rows) == exact.sum(axis=0)).all()


@pytest.mark.parametrize("d", [1, 2, 5, 8])
def test_polynomial_and_roots_are_exact(spark, d):
    draw = random.Random(d)
    half = [[draw.randint(-9, 9) for _ in range(d)] for _ in range(d)]
    matrix = [[sum(half[k][i] * half[k][j] for k in range(d)) for j in range(d)] for i in range(d)]
    # Newton's identities give the coefficients from the traces of powers.
    powers, power = [], np.array(matrix, object)
    for _ in range(d):
        powers.append(int(np.trace(power)))
        power = power @ np.array(matrix, object)
    e = [Fraction(1)]
    for k in range(1, d + 1):
        e.append(sum((-1) ** (i - 1) * e[k - i] * powers[i - 1] for i in range(1, k + 1)) / k)
    want = [int((-1) ** (d - i) * e[d - i]) for i in range(d + 1)]
    assert whitening.characteristic_polynomial(spark, matrix) == want
    roots, shift = whitening.largest_roots(want, d)
    values = np.linalg.eigvalsh(np.array(matrix, float))[::-1]
    assert [r / 2**shift for r in roots] == pytest.approx([x for x in values if x > 1e-6], rel=1e-6)


def test_repeated_roots():
    # (x - 2)^3 (x - 5) x^2
    coefficients = [0, 0, 40, -68, 42, -11, 1]
    roots, shift = whitening.largest_roots(coefficients, 9)
    assert [round((r + 1) / 2**shift, 9) for r in roots] == [5, 2, 2, 2]
    assert [whitening.roots_above(coefficients, a) for a in (0, 1, 2, 4, 5)] == [4, 4, 1, 1, 0]


# -- conversations


sys.setrecursionlimit(20_000)
WHITE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, edits, repaired lines) by trying everything with memory."""

    @functools.cache
    def go(i, state, inserted):
        found = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
        wanted = 3 if state == 2 else 2
        name = "assistant" if wanted == 3 else "user"
        if inserted < 2:
            c, e, lines = go(i, wanted, inserted + 1)
            found.append((c + 5, "I" + e, (f"{name}:", *lines)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, e, lines = go(i + 1, state, 0)
            found.append((c + 2, "D" + e, lines))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                kept = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state].get(role[:1])
                if kept is not None:
                    c, e, lines = go(i + 1, kept, 0)
                    found.append((c + extra, "K" + e, (f"{role}:{text}", *lines)))
                c, e, lines = go(i + 1, wanted, 0)
                found.append((c + 1 + extra, "R" + e, (f"{name}:{text}", *lines)))
        return min(found, key=lambda f: f[:2]) if found else (10**9, "", ())

    return go(0, 0, 0)


def plain_repair(rows):
    """The contract, one conversation after the other. Rows of one turn go by role, then by a digest of role and text."""
    convs = {}
    for conv, turn, role, text in rows:
        key = " " if conv is None else conv
        damage = zlib.crc32(f"{key}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if damage == 1 else re.sub("[.!?]", "", text) if damage == 2 else text
        role = "user" if damage == 4 else role
        convs.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(damage, 1))
    out = []
    for conv, found in convs.items():
        digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r)))
        seen, judged = set(), []
        for _, role, text in found:
            body = text.strip(WHITE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [t for t, _, _ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
        counts = [sum(f == kind for _, _, f in judged) for kind in ("blank", "duplicate", "truncated")]
        cost, edits, lines = cheapest(tuple(judged))
        out.append((conv, gaps, *counts, illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


TURNS = "conv_id bigint, turn bigint, role string, text string, copies string, kind int, conv string"


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, "own", 1, "own") for r in rows], TURNS)


def test_repair_query_against_the_contract(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_conversation_repair"](spark, SF_DIR)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert as_rows(got) == plain_repair(rows)


def test_repair_of_awkward_rows(spark):
    draw = random.Random(4)
    texts = ["Hello.", "Yes!", " ", "", None, "no end", "Again?  \n", "Ünïcode…", "dot. ", "x" * 4000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User"]
    rows = [(c, t, draw.choice(roles), draw.choice(texts)) for c in (1, 2, 3, None) for t in [None, *range(draw.randrange(2, 14))]]
    rows += [(5, 7, "user", "Alone."), rows[0], rows[0], (6, None, None, None), (8, 1, "user", "Same."), (8, 2, "assistant", "Fine."), (8, 3, "user", "Same.")]
    rows += [(7, t, ("user", "assistant")[t % 2], f"Turn {t}." if t % 5 else "Often.") for t in range(400)]  # far more than a block
    rows += [(9, 3, "user", "Copies.")] * 150
    got = conversations.repair_conversations(turns_frame(spark, rows))
    assert as_rows(got) == plain_repair(rows)
    assert conversations.repair_conversations(turns_frame(spark, [])).collect() == []


def test_conversation_without_rows_after_damage(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = conversations.repair_conversations(turns_frame(spark, [(dropped, 0, "user", "Gone.")])).collect()
    assert [tuple(r) for r in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


@pytest.mark.parametrize("size", [1, 2, 5, 64])
def test_search_in_blocks_equals_trying_everything(size):
    draw = random.Random(size)
    fault = lambda s: "blank" if s == "-" else "truncated" if s.isupper() else ""
    for n in [*range(12)] * 12 + [90]:
        symbols = "".join(draw.choice("suuuaaaxSUAX-") for _ in range(n))
        blocks = [[conversations.repair(symbols[i : i + size], b, e) for b in range(4) for e in range(4)] for i in range(0, n, size)]
        cost, edits, _ = cheapest(tuple((s.lower(), "t", fault(s)) for s in symbols))
        assert conversations.stitched(blocks) == (cost, edits)


# -- MinHash


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def plain_minhash(rows):
    sets = [plain_set(t) for _, t in rows]

    def linked(i, j):
        a, b = sets[i], sets[j]
        return i == j or (bool(a and b) and 100 * len(a & b) >= 85 * len(a | b))

    root = plain_components(set(range(len(rows))), linked)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    found = [(i, len(sets[k]), least.get(root[k])) for k, (i, _) in enumerate(rows)]
    return sorted(((i, n, c, i == c) for i, n, c in found), key=repr)


def test_minhash_query_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = QUERIES["op13_minhash_near_dedup"](spark, SF_DIR)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert as_rows(got) == plain_minhash(rows)


def near_copies(draw, count):
    words = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    out = []
    for _ in range(count):
        own = list(words)
        for _ in range(draw.choice([0, 1, 2, 3, 4])):
            own[draw.randrange(len(own))] = f"n{draw.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize(("block", "worth"), [(512, 10), (7, 10), (7, 0)])
def test_minhash_of_awkward_rows(spark, monkeypatch, block, worth):
    """Bands of one block, bands cut into blocks after rounds with leaders, and without waiting for them to pay."""
    monkeypatch.setattr(minhash, "WORTH", worth)
    monkeypatch.setattr(minhash, "BLOCK_NODES", block)
    draw = random.Random(5)
    base = [f"b{k}" for k in range(100)]
    texts = [None, "", " \n", "one", "ONE", "one two", "one two three", "One  two\tTHREE", "a b c d", "ünï ÜNÏ é", " ".join(base), " ".join(base[:-6]), " ".join(base[:-25])]
    texts += near_copies(draw, 60) + ["z " * 30_000, "y" * 5000]
    df = frame(spark, texts)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert as_rows(minhash.near_duplicates(df)) == plain_minhash(rows)
    assert minhash.near_duplicates(frame(spark, [])).collect() == []


def test_coordinates_of_the_signature_are_independent_enough():
    """Over many sets the share of equal coordinates is the similarity, and scatters as independent draws would."""
    draw = np.random.default_rng(6)
    shares = []
    for _ in range(200):
        common, one, other = (draw.integers(0, 1 << 63, n, np.uint64) for n in (60, 20, 20))
        a, b = (minhash.signature(np.concatenate([common, own]), 384) for own in (one, other))
        shares.append((a == b).mean())
    assert np.mean(shares) == pytest.approx(0.6, abs=0.01)
    assert np.std(shares) == pytest.approx(math.sqrt(0.6 * 0.4 / 384), rel=0.2)


def test_permutations_lose_nothing():
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    y = x.copy()
    minhash.second_permutation(y, np.empty_like(y))
    assert len(np.unique(minhash.first_permutation(x))) == len(np.unique(y)) == len(x)


def test_groups_with_a_common_half_stay_apart(spark):
    draw = random.Random(7)
    half = [f"h{k}" for k in range(100)]
    rows = []
    for group in "pq":
        own = [f"{group}{k}" for k in range(100)]
        for k in range(25):
            words = half + own
            words[draw.randrange(200)] = f"x{group}{k}"
            rows.append((len(rows), " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).select("doc_id", F.col("component_id")).collect()}
    assert got == {i: 0 if i < 25 else 25 for i in range(50)}
