"""Conversation repair, embedding near-duplicates and fill-in-middle on hand-written and planted rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.llm import conversations, fim, lattice

SPACES = " \t\n\x0b\x0c\r"


# --- conversation repair --------------------------------------------------------------------------------

CONVS = "conv_id long, turn long, role string, text string"


def brute_repair(rows):
    """All edit sequences of one conversation, the best of each state kept with its whole audit."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.strip(SPACES)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    # The pattern's states, written as what stands last: nothing, s, u, a.
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def closed(states):
        changed = True
        while changed:
            changed = False
            for q, (cost, audit, lines) in list(states.items()):
                made = (cost + 5, audit + "I", (*lines, names[follows[q]] + ":"))
                if follows[q] not in states or made[:2] < states[follows[q]][:2]:
                    states[follows[q]], changed = made, True
        return states

    best = closed(best)
    for (role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for q, (cost, audit, lines) in best.items():
            ways = [(q, cost + 2, "D", lines)]
            if fault not in ("blank", "duplicate"):
                cost += 5 * (fault == "truncated")
                if role[:1] == follows[q] or (role[:1], q) == ("s", ""):
                    ways.append((role[0], cost, "K", (*lines, f"{role}:{text}")))
                ways.append((follows[q], cost + 1, "R", (*lines, f"{names[follows[q]]}:{text}")))
            for state, its_cost, edit, its_lines in ways:
                made = (its_cost, audit + edit, its_lines)
                if state not in after or made[:2] < after[state][:2]:
                    after[state] = made
        best = closed(after)
    cost, audit, lines = min(v for q, v in best.items() if q in ("", "a"))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (*(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def brute_repairs(rows):
    """The query's columns for each conversation, from rows before the damage."""
    broken = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        if kind:
            broken[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, mine in broken.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, *_ in mine if t is not None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *brute_repair([r[1:] for r in mine]))
    return out


def odd_conversations(seed, conversations=150):
    rng = random.Random(seed)
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "x"), (7, 1, "", "a."), (7, 2, "tool", "b!"), (8, 1, None, ""),
            (9, 9_007_199_254_740_993, "user", "q?"), (9, 9_007_199_254_740_995, "assistant", "r."), (10, None, "user", "é世🙂?"), (10, None, "user", "é世🙂?")]
    roles, texts = ["user", "assistant", "system", "tool", "u", "unknown"], ["A.", "B", "C!", " ", "D?\n", "E e."]
    for conv in range(100, 100 + conversations):
        rows += [(conv, rng.randrange(9), rng.choice(roles), rng.choice(texts)) for _ in range(rng.randrange(12))]
    return rows


def reports(spark, rows):
    frame = spark.createDataFrame(rows, CONVS)
    got = conversations.repair_report(frame, conversations.damaged(frame)).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def test_odd_conversations_equal_brute_force(spark):
    rows = odd_conversations(1)
    assert reports(spark, rows) == brute_repairs(rows)


def test_conversations_over_many_batches(spark):
    """A conversation that goes over batches keeps its state; several share a partition."""
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["A a.", "B", "c?"]) + str(rng.randrange(9**6)) + rng.choice([".", ""])) for t in range(1, 4000)]
    rows += [(c, t, "user", f"{c} {t}.") for c in range(2, 40) for t in range(3)]
    assert reports(spark, rows) == brute_repairs(rows)


def test_edits_are_the_repaired_conversation(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "No question."), (1, 2, "user", "Q?"), (1, 3, "user", " "), (1, 4, "assistant", "cut"),
            (2, 0, "user", "Q?"), (2, 1, "user", "Q?"), (2, 2, "assistant", "A.")]
    frame = spark.createDataFrame(rows, CONVS).withColumns({"at": F.lit("mine"), "edit": F.lit("mine"), "fault": F.lit("mine"), "copy": F.lit(0)})
    edits = [tuple(r) for r in conversations.repair(frame).orderBy("conv_id", "at").collect()]
    assert edits == [
        (1, 0, "K", 0, 0, "system", "system", "S.", None),
        (1, 1, "R", 1, 1, "assistant", "user", "No question.", None),
        (1, 2, "R", 1, 2, "user", "assistant", "Q?", None),
        (1, 3, "D", 2, 3, "user", None, None, "blank"),
        (1, 4, "D", 2, 4, "assistant", None, None, "truncated"),
        (2, 0, "K", 0, 0, "user", "user", "Q?", None),
        (2, 1, "D", 2, 1, "user", None, None, "duplicate"),
        (2, 2, "K", 0, 2, "assistant", "assistant", "A.", None)]


def test_conversations_without_rows(spark):
    empty = spark.createDataFrame([], CONVS)
    assert conversations.repair(empty).count() == 0 and reports(spark, []) == {}
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert reports(spark, [(dropped, 0, "user", "Q?")]) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_repair_shuffles_texts_once(spark):
    plan = conversations.repair(spark.createDataFrame(odd_conversations(2, 5), CONVS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


# --- embeddings -----------------------------------------------------------------------------------------

def brute_links(rows, least=0.98):
    """``(vec_id, n_links, component_id, kept)`` of rows ``(vec_id, embedding, label)`` with distinct ids, sorted."""
    links = {v: set() for v, *_ in rows}
    groups = {}
    for v, e, label in rows:
        if label is not None and e is not None and len(e) and all(x is not None and np.isfinite(x) for x in e) and any(e):
            groups.setdefault((label, len(e)), []).append((v, np.array(e, dtype=float) / np.abs(np.array(e, dtype=float)).max()))
    for members in groups.values():
        x = np.stack([e for _, e in members])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for i, j in np.argwhere(x @ x.T >= least):
            if i != j:
                links[members[i][0]].add(members[j][0])
    root = {v: v for v in links}
    changed = True
    while changed:
        changed = False
        for v, others in links.items():
            low = min([root[v], *(root[o] for o in others)])
            changed |= low != root[v]
            root[v] = low
    return sorted((v, len(links[v]), root[v], root[v] == v) for v in links)


VECTORS = "vec_id long, embedding array<float>, label int"


def clustered(rng, size, cosine):
    """A vector and one whose cosine with it is the given one."""
    a = rng.normal(size=size)
    a /= np.linalg.norm(a)
    z = rng.normal(size=size)
    z -= (z @ a) * a
    return a, cosine * a + (1 - cosine**2) ** 0.5 * z / np.linalg.norm(z)


def test_nearest_lattice_points():
    rng = np.random.default_rng(0)
    y = rng.normal(size=(400, 8)) * 2
    points = lattice.nearest(y)
    halves = points * 2
    assert (halves == np.rint(halves)).all() and ((halves % 2).sum(axis=1) % 8 == 0).all() and (points.sum(axis=1) % 2 == 0).all()
    # No neighbouring point is nearer, which is enough: the 240 shortest vectors bound the cells of E8 together with the next 2,160.
    away = ((y - points) ** 2).sum(axis=1)
    steps = lattice.neighbours()
    assert len(steps) == 240 and np.allclose((steps**2).sum(axis=1), 2)
    for step in steps:
        assert (((y - points - step) ** 2).sum(axis=1) >= away - 1e-9).all()
    assert away.max() <= 1 + 1e-9


@pytest.mark.parametrize("size, cosine, least", [(64, 0.98, 0.95), (64, 0.985, 0.97), (64, 0.99, 0.98), (768, 0.98, 0.95), (8, 0.98, 0.9)])
def test_recall_of_pairs_at_a_cosine(size, cosine, least):
    rng = np.random.default_rng(size)
    a, b = map(np.stack, zip(*(clustered(rng, size, cosine) for _ in range(3000)), strict=True))
    x, y = lattice.cells(a), lattice.cells(b)
    met = ((x[:, :, :1] == y) | (x == y[:, :, :1])).any(axis=(1, 2))
    assert met.mean() >= least


def test_chance_meetings_are_rare():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 64))
    codes = lattice.cells(lattice.unit_vectors(x))
    own = codes[:, :, 0]
    pairs = sum(int((np.unique(own[:, t], return_counts=True)[1] - 1).sum()) for t in range(own.shape[1]))
    assert pairs < 40  # of 8 million pairs


def test_planted_clusters_equal_brute_force(spark):
    rng, rows = np.random.default_rng(2), []
    for cluster, members in enumerate((2, 2, 3, 9, 40, 300)):
        centre = rng.normal(size=32)
        centre /= np.linalg.norm(centre)
        for _ in range(members):
            rows.append((len(rows), (centre + 0.012 * rng.normal(size=32)).tolist(), cluster % 2))
    for _ in range(200):
        rows.append((len(rows), rng.normal(size=32).tolist(), len(rows) % 2))
    rows += [(10_000 + k, rows[20][1], rows[20][2]) for k in range(50)]  # copies, one of them under another label
    rows[-1] = (rows[-1][0], rows[-1][1], 7)
    frame = spark.createDataFrame(rows, VECTORS)
    rows = [tuple(r) for r in frame.collect()]
    want = brute_links(rows)
    whole = sorted(tuple(r) for r in lattice.similar_vectors(frame).collect())
    assert sum(r[1] for r in whole) >= 0.99 * sum(r[1] for r in want) and all(g[1] <= w[1] for g, w in zip(whole, want, strict=True))
    assert [r[2:] for r in whole] == [r[2:] for r in want]
    # Chunks change the work, not the result.
    assert sorted(tuple(r) for r in lattice.similar_vectors(frame, chunk=7).collect()) == whole


def test_odd_vectors(spark):
    one, nan, inf = [1.0, 0.0, 0.0], float("nan"), float("inf")
    rows = [(1, one, 1), (2, one, 1), (3, [2.0, 0.0, 0.0], 1), (4, one, 2), (5, one, None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1),
            (9, [1.0, None, 0.0], 1), (10, [nan, 0.0, 0.0], 1), (11, [inf, 0.0, 0.0], 1), (12, [1.0, 0.0], 1), (13, [-1.0, 0.0, 0.0], 1),
            (14, [3e38, 3e36, 0.0], 1), (15, [1e-40, 0.0, 0.0], 1), (16, [1.0, 0.0, 0.0, 0.0] * 500, 1), (17, [1.0, 0.0, 0.0, 0.0] * 500, 1)]
    frame = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("mine") for c in ("digest", "id", "n", "key", "part", "weight", "codes", "kept")})
    assert sorted(tuple(r) for r in lattice.similar_vectors(frame).collect()) == brute_links([tuple(r)[:3] for r in frame.collect()])
    assert lattice.similar_vectors(frame.limit(0)).count() == 0


def test_repeated_and_null_ids_of_vectors(spark):
    a, b = [1.0, 0.0], [0.0, 1.0]
    frame = spark.createDataFrame([(None, a, 1), (5, a, 1), (5, a, 1), (None, b, 1), (None, b, 1), (None, None, 1)], VECTORS)
    got = sorted((tuple(r) for r in lattice.similar_vectors(frame).collect()), key=repr)
    assert got == sorted([(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (None, 1, None, True), (None, 1, None, True), (None, 0, None, True)], key=repr)


def test_pairs_at_the_threshold_are_decided_exactly(spark):
    # 49/50 = 0.98 to the last bit, and just below.
    at, below = [[49.0, 99.0**0.5], [50.0, 0.0]], 0.98 - 1e-9
    rows = [(1, [50.0, 0.0], 1), (2, [49.0, 9.9498743710662], 1), (3, [50.0, 0.0], 2), (4, [below, (1 - below**2) ** 0.5], 2)]
    got = {r["vec_id"]: r["n_links"] for r in lattice.similar_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert lattice.cosine(np.array(at[0]), np.array(at[1])) == pytest.approx(0.98) and got[3] == got[4] == 0


# --- fill-in-middle -------------------------------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PIECES = st.lists(st.sampled_from(["a", "wörd", "世界", "🙂", " ", "\n", "\t\x0b", "\xa0", "<", "P>", "<P>", "<S>", "<M>", ".", "  "]), max_size=30).map("".join)


def brute_fim(text, doc_id):
    text = text or ""
    units = UNIT.findall(text)
    drawn = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return n, "plain", text, None, None
    if h4 % 100 < 80:
        return n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


@given(PIECES, st.integers(0, 5000))
@settings(max_examples=400, deadline=None)
def test_fim_equals_brute_force_and_restores(text, doc_id):
    n, form, output, *chars = fim.transform(text.encode(), doc_id)
    assert (n, form, output.decode(), *chars) == brute_fim(text, doc_id)
    assert fim.restore(output, form) == text.encode()


@given(st.binary(max_size=40), st.data())
def test_exchange_swaps_blocks(raw, data):
    a, b, c = sorted(data.draw(st.lists(st.integers(0, len(raw)), min_size=3, max_size=3)))
    buffer = bytearray(raw)
    fim.exchange(buffer, a, b, c)
    assert bytes(buffer) == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]


def test_fim_on_odd_documents(spark):
    long = " ".join(f"w{k}é" for k in range(200_000))
    rows = [(k, t) for t in (None, "", " \n", "a <M> b", "one two  three ", "wörd 世界 🙂\tx", long) for k in range(12)]
    rows += [(None, "no id at all"), (3, "again"), (3, "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("mine") for c in ("n", "form", "output", "middle_chars", "_fim", "extra")})
    made = fim.fill_in_middle(frame)
    assert set(made.columns) == {"doc_id", "text", "_fim", "extra", "n", "form", "output", "prefix_chars", "middle_chars"}
    got = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((repr((r["doc_id"], r["text"], r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"])) for r in got)) == sorted(
        repr((d, t, *brute_fim(t, d))) for d, t in rows)
    assert all(r["back"] == (r["text"] or "") and r["extra"] == "mine" for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(frame.limit(0)).count() == 0
