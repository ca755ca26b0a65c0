"""Operators on small hand-written tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import gc
import random
import re
import tracemalloc
import weakref
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.llm import bitpack, common, content_sort, labelled, langid, latent, licenses, maglev, mixing, quality, simhash, toxicity
from claimloom.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
CLASHING = ("score", "predicted", "slot", "shard", "digest", "size", "label", "copies", "id", "lanes", "row", "held_out", "lang_pred")


def docs(spark, rows, clash=False):
    """Rows of (doc_id, text[, lang, source]); ``clash`` adds columns of the operators' own names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.withColumns({c: F.lit("mine") for c in CLASHING}) if clash else df


def prose(seed, n, words=None):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) if words else f"w{rng.randrange(5000)}" for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, prose(4, 9000)), (5, "a"), (5, "a"), (None, "no id"), (None, None), (6, "é世🙂 x")]


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# --- token ids ------------------------------------------------------------------------------------------

@given(st.integers(1, 32), st.data())
@settings(max_examples=60, deadline=None)
def test_packing_is_exact_and_random_access(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=60)), dtype="<u4")
    raw = bitpack.pack(ids, bits)
    assert len(raw) == -(-len(ids) * bits // 8)
    start = data.draw(st.integers(0, len(ids)))
    n = data.draw(st.integers(0, len(ids) - start))
    assert bitpack.unpack(raw, bits, n, start).tolist() == ids[start:start + n].tolist()


ENCODER = []


@given(st.lists(st.sampled_from(["a", "Word", " ", "\n", "\t", "\xa0", "é", "'", "s", ".", ",", "1", "\x1c", "世", "  ", "\n\n", "<|endoftext|>", "ʻ", "I'll", "!", "\r\n", "🙂"])).map("".join))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_the_library(text):
    if not ENCODER:
        ENCODER.append(bitpack.Encoder(tokenizer()))
    assert ENCODER[0](text).tolist() == ENCODER[0].tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_on_texts_longer_than_a_stretch(monkeypatch):
    monkeypatch.setattr(bitpack, "STRETCH", 64)
    monkeypatch.setattr(bitpack, "REMEMBERED", 20)
    encoder, text = bitpack.Encoder(tokenizer()), prose(1, 400) + "  \n\n " + "x" * 300 + prose(2, 50)
    assert encoder(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_runs_the_library_on_many_new_words_at_once():
    import random
    import sys

    drawn, encoder, calls = random.Random(5), bitpack.Encoder(tokenizer()), []
    texts = [" ".join("".join(drawn.choices("abcdefgéüß", k=9)) + drawn.choice(["", ",", "'s", "%%"]) for _ in range(100)) for _ in range(40)]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    sys.setprofile(lambda _, event, called: event == "c_call" and called.__name__ in ("tokenize", "encode_batch_fast", "encode_batch") and calls.append(called))
    try:
        got = [encoder(t).tolist() for t in texts]
    finally:
        sys.setprofile(None)
    assert got == want
    assert 0 < len(calls) <= 2 * len(texts)  # of 4,000 new words


def test_encoder_on_texts_together(monkeypatch):
    monkeypatch.setattr(bitpack, "REMEMBERED", 300)
    encoder = bitpack.Encoder(tokenizer())
    shapes = ["x {0}y", "{0}", "x a{0}b 'tis", "x {0}{0}1'll", "\n{0}'s", " {0}\n", "{0}  {0}"]
    texts = [s.format(chr(c)) for s in shapes for c in (*range(0x250), *range(0x2000, 0x2070), 0x416, 0x4E16, 0x1F642)]
    texts += ["", "\n", " ", "\n\n", "<|endoftext|>", prose(3, 400)]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(bitpack, "STRETCH", 1000)
    assert [ids.tolist() for ids in encoder.each(texts)] == want


def test_crc32_of_joined_stretches():
    import zlib

    for n in (0, 1, 3, 4, 255, 70_000):
        a, b = bytes(range(200)), bytes(k % 251 for k in range(n))
        assert bitpack.joined_crc32(zlib.crc32(a), zlib.crc32(b), n) == zlib.crc32(a + b)


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_tokenizers_encode_whole_texts(name):
    import public_tokenizers

    encoder = bitpack.Encoder(public_tokenizers.path(name))
    assert encoder("Some  Words here.").tolist() == encoder.tokenizer.encode("Some  Words here.", add_special_tokens=False).ids


def test_packed_files(spark, tmp_path):
    import zlib

    rows = [*ODD, (9_007_199_254_740_993, "large id")]
    path = str(tmp_path / "packed")
    bitpack.write_packed(docs(spark, rows, clash=True), path, tokenizer(), block_ids=50)
    encode = bitpack.Encoder(tokenizer())
    got = sorted(bitpack.token_digests(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, None, 1, 2, 3, 4, 5, 5, 6, 9_007_199_254_740_993]
    stream, texts = [], {i: t for i, t in rows if i is not None}
    for r in got:
        if r["doc_id"] is not None:
            ids = np.append(encode(texts[r["doc_id"]] or ""), 0).astype("<u4")
            assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
        else:
            ids = bitpack.read_ids(spark, path, r["start"], r["start"] + r["n_tokens"])
        assert r["start"] == len(stream)
        stream += ids.tolist()
    assert bitpack.read_ids(spark, path, 0, len(stream)).tolist() == stream
    assert bitpack.read_ids(spark, path, 40, 260).tolist() == stream[40:260]
    empty = str(tmp_path / "empty")
    bitpack.write_packed(docs(spark, []), empty, tokenizer())
    assert bitpack.token_digests(spark, empty).count() == 0


# --- exact dedup ------------------------------------------------------------------------------------------

def brute_groups(rows):
    groups = {}
    for row in rows:
        groups.setdefault("".join((row[1] or "").translate({c: None for c in (32, *range(9, 14))})), []).append(row)
    best = {k: min(v, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for k, v in groups.items()}
    return sorted(((r[0], best[k][0], len(v)) for k, v in groups.items() for r in v), key=repr)


@pytest.mark.parametrize("hot", [0, 300])
def test_exact_groups(spark, hot):
    rows = [*ODD, (7, "a "), (8, " a"), (9, "A"), *[(100 + i, "hot copy" + " " * (i % 7)) for i in range(hot)], (50, prose(4, 9000) + " ")]
    got = content_sort.exact_groups(docs(spark, rows, clash=True)).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=repr) == brute_groups(rows)
    kept = {}
    for r in got:
        kept[r["text_sha256"]] = kept.get(r["text_sha256"], 0) + r["kept"]
    assert set(kept.values()) == {1}
    assert content_sort.exact_groups(docs(spark, [])).count() == 0


def test_exact_groups_need_no_hash_shuffle_of_texts(spark):
    plan = content_sort.exact_groups(docs(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- mixing ---------------------------------------------------------------------------------------------------

def brute_targets(sizes):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + ([None] if None in sizes else [])
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while free:
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n for n in free if share[n] > 2 * sizes[n]}
        if not over:
            return target | share
        for n in over:
            target[n] = 2.0 * sizes[n]
            left -= 2 * sizes[n]
        free -= over
    return target


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, prose(i, rng.randrange(1, 60)), "en", rng.choice(["a", "b", "b", "b", "Z", "é", None])) for i in range(400)]
    rows += [(1000, None, "en", "a"), (1001, "", "en", "none"), (1002, "  ", "en", "none")]
    got = mixing.mix(docs(spark, rows, clash=True)).collect()
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = brute_targets(sizes)
    taken = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and r["copies"] <= 2
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 60 for s in sizes)
    again = mixing.mix(docs(spark, rows[::-1]).repartition(7)).collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in again}
    frame = docs(spark, rows, clash=True)
    mixed = mixing.mixed(frame)
    assert mixed.columns == frame.columns
    assert mixed.count() == sum(r["copies"] for r in got)
    assert mixing.mix(docs(spark, [])).count() == 0 and mixing.mixed(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [(1, None)])).first()["taken"] == 0


def test_mix_of_repeated_rows(spark):
    rows = [(7, "one two", "en", "a")] * 30 + [(None, "three", "en", "a")] * 3 + [(8, "x " * 70, "en", "b")]
    got = mixing.mix(docs(spark, rows)).collect()
    assert len(got) == 34 and all(r["taken"] <= 2 * r["size"] for r in got)


def test_mix_tells_rows_of_one_id_apart(spark):
    rows = [(None, prose(i, 20), "en", "a") for i in range(200)] + [(7, prose(300 + i, 20), "en", "a") for i in range(100)]
    rows += [(1000 + i, prose(600 + i, 20), "en", "a") for i in range(300)]
    rows += [(i if i else None, prose(2000 + i, 20), "en", "b") for i in range(600)]
    frame = docs(spark, rows)
    got = mixing.mix(frame).collect()
    want = brute_targets({"a": 12_000, "b": 12_000})
    taken = {s: sum(r["taken"] for r in got if r["source"] == s) for s in want}
    kept = mixing.mixed(frame).collect()
    words = {s: sum(len(r["text"].split()) for r in kept if r["source"] == s) for s in want}
    assert words == taken and all(abs(taken[s] - want[s]) <= 20 for s in want)


# --- sharding -------------------------------------------------------------------------------------------------

def test_lookup_table_is_even_and_stable():
    before, after = (maglev.lookup_table(maglev.shard_names(n), 3203) for n in (32, 31))
    counts = np.bincount(before)
    assert counts.max() - counts.min() <= 1 and len(before) == 3203 == maglev.table_size(32)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 31)
    assert moved < 0.1 * len(before)
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            maglev.lookup_table(bad)
    assert maglev.lookup_table(["only"], 3) == [0, 0, 0]


def test_place(spark, tmp_path):
    df = docs(spark, ODD, clash=True)
    placed = maglev.place(df, 4)
    assert placed.columns == [*[c for c in df.columns if c not in ("slot", "shard")], "slot", "shard"]
    rows = placed.collect()
    assert len(rows) == len(ODD) and {r["shard"] for r in rows} <= set(range(4))
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert maglev.place(docs(spark, []), 4).count() == 0
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    maglev.write_shards(docs(spark, ODD), f"{tmp_path}/shards", 4, files_per_shard=2)
    assert spark.read.parquet(f"{tmp_path}/shards").count() == len(ODD)


# --- near-duplicates --------------------------------------------------------------------------------------------

def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 40), (40, 39), (10, 11), (12, 11), (7, 7), (2, 1), *[(100, 100 + i) for i in range(1, 60)], *[(i, i + 1) for i in range(200, 260)]]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    want = {n: 1 for n in (1, 2, 3, 39, 40)} | {n: 10 for n in (10, 11, 12)} | {n: 100 for n in range(100, 160)} | {n: 200 for n in range(200, 261)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "none").count() == 0


@pytest.mark.parametrize("crowd, pivots", [(64, 32), (2, 1), (2, 3)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, crowd, pivots):
    monkeypatch.setattr(simhash, "PIVOTS", pivots)
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = {rng.choice(base) ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(4))}) for _ in range(250)}
    prints |= {base[0] & 0xFFFFFFFF | rng.getrandbits(32) << 32 for _ in range(20)}
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p, [p]) for p in signed], "id long, lanes array<long>")
    got = simhash.links(nodes, 1, 2, simhash.hamming_links(nodes, 1, 2), crowd)
    label = {r["node"]: r["component"] for r in components(got, "test").collect()}
    parent = {p: p for p in signed}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2 and top(a) != top(b):
                parent[max(top(a), top(b))] = min(top(a), top(b))
    assert {p: label.get(p, p) for p in signed} == {p: top(p) for p in signed}


def test_a_crowded_bucket_without_links_is_not_paired_off(spark):
    rng = random.Random(6)
    prints = {0x12345678 | rng.getrandbits(32) << 32 for _ in range(3000)}
    linked = [p for p in prints][:40]
    prints |= {p ^ (1 << rng.randrange(32, 64)) ^ (1 << rng.randrange(32, 64)) for p in linked}
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p, [p]) for p in signed], "id long, lanes array<long>")
    bucket = nodes.selectExpr(f"{0x12345678}L as key", "id", "true as entry", "id as part")
    met = simhash._across(bucket, bucket, nodes, 2).distinct()
    assert met.count() < 10 * len(prints)
    found = {(r["a"], r["b"]) for r in met.collect()}
    close = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert len(close) >= 35 and close <= found


def test_near_groups_of_odd_rows(spark):
    got = simhash.near_groups(docs(spark, ODD, clash=True)).collect()
    assert len(got) == len(ODD)
    blank = [r for r in got if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in blank} == {1, 2, 3, None} and {r["component_id"] for r in blank} == {1}
    assert simhash.near_groups(docs(spark, [])).count() == 0
    assert simhash.near_groups(docs(spark, [(None, "x"), (None, "x")])).first()["component_id"] is None


def test_near_duplicates_by_fingerprint(spark):
    text = prose(1, 4000).split()
    close = [*text[:100], "changed", *text[101:]]
    rows = [(3, " ".join(text)), (2, " ".join(close)), (4, prose(9, 80)), (5, "ONE two"), (6, "one  TWO"), (6, "one  TWO"),
            (None, "no id at all here"), (None, "no id at all here"), (8, None), (7, " "), (11, prose(2, 30)), (11, prose(3, 30))]
    frame = docs(spark, rows, clash=True).withColumns({c: F.lit("mine") for c in ("fp", "part", "_near_id", "n")})
    prints = {k: simhash.simhash(t, 3)[0] & (2**64 - 1) for k, (_, t) in enumerate(rows)}
    parent = dict(zip(prints, prints, strict=True))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                parent[max(top(a), top(b))] = min(top(a), top(b))
    groups = {}
    for k, (doc_id, _) in enumerate(rows):
        groups.setdefault(top(k), []).append(doc_id)
    want = sorted(min((d for d in ids if d is not None), default=-1) for ids in groups.values())
    kept = simhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in kept.collect()) == want
    assert 3 not in want and want.count(11) == 2
    assert simhash.drop_near_duplicates(docs(spark, [])).count() == 0


def test_a_hot_node_is_dealt_out(spark, monkeypatch):
    """A star with two thirds of all edges: no task gets more than a few times its share."""
    monkeypatch.setattr(common, "HOT_ROWS", 1_000)
    star = spark.range(1, 30_001).selectExpr("id as a", "0L as b")
    chain = spark.range(100_000, 100_300).selectExpr("id as a", "id + 1 as b")
    edges = star.unionByName(chain)
    got = components(edges, "star")
    assert got.where("node < 100000").select("component").distinct().collect()[0]["component"] == 0
    assert {r["component"] for r in got.where("node >= 100000").collect()} == {100_000}
    assert got.count() == 30_001 + 301
    sizes = [r["n"] for r in hot_salted(edges).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 3 * sum(sizes) / 8


def hot_salted(edges):
    from claimloom.llm.common import with_lowest

    edges.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    edges.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = with_lowest(edges.selectExpr("b as a", "a as b").unionByName(edges), F.min("b"), 60_600, 8)
        return frame.persist() if frame.count() else frame
    finally:
        edges.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        edges.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# --- decontamination ----------------------------------------------------------------------------------------------

BENCH = "item_id long, text string"
QUESTION = "Which river flows through the ancient capital before it meets the northern sea at the great harbour? The silver Tamesh river."


def test_leaks_and_paraphrases(spark):
    filler = [prose(i, 90) for i in range(60)]
    spread = QUESTION.replace("ancient", "very old").replace("great", "large").replace("before", "shortly before")
    rows = [(i, t) for i, t in enumerate(filler)]
    rows += [(100, filler[0] + " " + QUESTION.upper() + " " + filler[1]), (101, filler[2] + "\n" + spread), (102, "The northern sea. " + filler[3]),
             (103, None), (104, ""), (100, QUESTION), (None, QUESTION)]
    bench = spark.createDataFrame([(1, QUESTION), (2, None), (3, "too short"), (4, prose(77, 30)), (4, prose(77, 30))], BENCH)
    got = latent.benchmark_leaks(docs(spark, rows, clash=True), bench).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=repr) == sorted([(100, 1), (100, 1), (101, 1), (None, 1)], key=repr)
    exact = next(r for r in got if r["doc_id"] == 100)
    assert exact["lcs"] == 1.0 and exact["answer"]
    frame = docs(spark, rows, clash=True)
    clean = latent.without_leaks(frame, bench)
    assert clean.columns == frame.columns and clean.count() == len(rows) - 4
    nothing = spark.createDataFrame([], BENCH)
    assert latent.benchmark_leaks(frame, nothing).count() == 0 and latent.without_leaks(frame, nothing).count() == len(rows)
    assert latent.benchmark_leaks(docs(spark, []), bench).count() == 0


def test_longest_common_subsequence():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y and x else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(20))] for _ in range(2))
        assert latent.lcs_length(a, b) == plain(a, b)


def test_singular_vectors_span_the_leading_space():
    rng = np.random.default_rng(1)
    left, right = np.linalg.qr(rng.normal(size=(300, 8)))[0], np.linalg.qr(rng.normal(size=(40, 8)))[0]
    a = left * np.array([50, 40, 30, 20, 10, 5, 4, 3]) @ right.T
    random_columns = rng.normal(size=(40, 14))
    found = latent.singular_vectors(a.T @ (a @ random_columns), random_columns, 4)
    assert np.linalg.norm(found.T @ right[:, :4]) == pytest.approx(2, abs=1e-3)


def test_benchmarks_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(latent, "BLOCK_PASSAGES", 2)
    items = [prose(200 + i, 40) for i in range(5)]
    rows = [(i, prose(i, 60) + " " + items[i] + " " + prose(i + 30, 60)) for i in range(5)] + [(50, prose(50, 100))]
    got = latent.benchmark_leaks(docs(spark, rows), spark.createDataFrame(list(enumerate(items)), BENCH)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, i) for i in range(5)}


def test_long_texts_are_scored_in_bounded_memory(spark, monkeypatch):
    items = [prose(200 + i, 40) for i in range(30)]
    retriever = next(latent.fit(docs(spark, [(i, prose(i, 200)) for i in range(5)]), spark.createDataFrame(list(enumerate(items)), BENCH)))
    known = [w for w in retriever.vocabulary.words if w]
    texts = [prose(9, 3000, known) + " " + items[7] + " " + prose(10, 3000, known), prose(3, 50), items[2]]
    whole = retriever.leaks(pa.array(texts, pa.large_string()))
    assert [[leak[0] for leak in row if leak[2] == 1.0] for row in whole] == [[7], [], [2]]
    monkeypatch.setattr(latent, "HALVES_AT_ONCE", 3)
    assert [[(*leak[:1], round(leak[1], 5), *leak[2:]) for leak in row] for row in retriever.leaks(pa.array(texts, pa.large_string()))] == [
        [(*leak[:1], round(leak[1], 5), *leak[2:]) for leak in row] for row in whole]
    monkeypatch.undo()
    long = " ".join(np.random.default_rng(1).choice([*known, *(f"q{k}" for k in range(2000))], 400_000))
    tracemalloc.start()
    retriever.leaks(pa.array([long], pa.large_string()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6  # the products alone would be over 250 MB


def test_one_block_is_alive_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(latent, "BLOCK_PASSAGES", 1)
    real, made, most = latent.fit, [], []

    def watched(*args):
        for retriever in real(*args):
            made.append(weakref.ref(retriever))
            gc.collect()
            most.append(sum(r() is not None for r in made))
            yield retriever
            del retriever

    monkeypatch.setattr(latent, "fit", watched)
    items = [prose(200 + i, 40) for i in range(4)]
    frame, bench = docs(spark, [(i, prose(i, 60) + " " + items[i]) for i in range(4)] + [(9, prose(9, 100))]), spark.createDataFrame(list(enumerate(items)), BENCH)
    assert {(r["doc_id"], r["item_id"]) for r in latent.benchmark_leaks(frame, bench).collect()} == {(i, i) for i in range(4)}
    assert [r["doc_id"] for r in latent.without_leaks(frame, bench).collect()] == [9]
    assert len(made) == 8 and max(most) <= 2


def test_short_items_leak_word_for_word(spark):
    rows = [(1, prose(1, 80) + " Who wrote -- Faust? " + prose(2, 80)), (2, "who faust wrote"), (3, "who wrote the faust"), (4, "He asked: who wrote Faust"), (5, "who wrote"), (6, "faust"),
            (7, "What is water? A liquid."), (8, "What is water? Nobody knows."), (9, None), (10, "--")]
    bench = spark.createDataFrame([(1, "Who wrote Faust?", None), (2, "What is water?", "a liquid"), (3, "", None), (4, prose(9, 40), None)], BENCH + ", answer string")
    got = latent.benchmark_leaks(docs(spark, rows), bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["first_word"], r["answer"]) for r in got) == [(1, 1, 80, False), (4, 1, 2, False), (7, 2, 0, True)]
    assert sorted(r["doc_id"] for r in latent.without_leaks(docs(spark, rows), bench).collect()) == [2, 3, 5, 6, 8, 9, 10]


# --- languages ------------------------------------------------------------------------------------------------------

def test_languages(spark):
    english, german = "the and that with this from have which their would".split(), "der die und nicht ein mit sich auf für über".split()
    rows = [(i, prose(i, 60, english), "en") for i in range(40)] + [(100 + i, prose(i, 60, german), "de") for i in range(40)]
    rows += [(300, None, "en"), (301, "", "de"), (302, "123 !!", None), (303, "und nicht", None), (304, prose(1, 40_000, german), None), (None, "that with", None), (303, "und nicht", None)]
    got = langid.language_predictions(docs(spark, rows, clash=True)).collect()
    by_id = {r["doc_id"]: r["lang_pred"] for r in got}
    assert len(got) == len(rows)
    assert all(by_id[i] == ("en" if i < 100 else "de") for i in by_id if i is not None and i < 200)
    assert (by_id[300], by_id[301], by_id[302], by_id[303], by_id[304], by_id[None]) == ("und", "und", "und", "de", "de", "en")
    assert all(0 <= r["score"] <= 1 for r in got)
    nothing = docs(spark, [(1, "text", None), (2, None, "en")])
    assert {r["lang_pred"] for r in langid.language_predictions(nothing).collect()} == {"und"}
    assert langid.language_predictions(docs(spark, [])).count() == 0


def test_every_language_gets_a_profile(spark):
    learned = [i for i in range(1500) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, chr(0x4E00 + 2 * i) * 3 + " " + chr(0x4E01 + 2 * i), f"l{i}") for i in range(1500)]
    profiles = langid.fit(docs(spark, rows))
    assert len(learned) > 1000 and sorted(profiles.languages) == sorted(f"l{i}" for i in learned)
    assert all(langid.identify(rows[i][1], profiles)[0] == f"l{i}" for i in learned[::100])


def test_ngrams_and_ranks_by_hand():
    keys, counts = langid.ngram_counts("Ab, ab!")
    named = {}
    for key, n in zip(keys.tolist(), counts.tolist(), strict=True):
        points = [p for p in (key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF) if p]
        named["".join("_" if p == langid.MARK else chr(p) for p in points)] = n
    assert named == {"a": 2, "b": 2, "_a": 2, "ab": 2, "b_": 2, "_ab": 2, "ab_": 2}
    profile = langid.Profiles(("x",), (np.array([5, 3, 9]),))
    assert profile.distances(np.array([3, 5, 4])).tolist() == [1 + 1 + langid.PROFILE]
    assert langid.ranked(np.array([1, 2, 3]), np.array([4, 9, 9]), 2).tolist() == [2, 3]
    whole, pieces = langid.ngram_counts("ab cd " * 50), langid.ngram_counts("ab cd " * 50, piece=60)
    assert whole[0].tolist() == pieces[0].tolist() and whole[1].tolist() == pieces[1].tolist()


@given(st.lists(st.sampled_from(["a", "B", "Σ", "é", "世", "🙂", " ", "\n", "1", "İ", "word", ". "]), max_size=40).map("".join), st.integers(1, 12))
@settings(max_examples=200, deadline=None)
def test_pieces_count_like_whole_texts(text, piece):
    whole, pieces = langid.ngram_counts(text), langid.ngram_counts(text, piece=piece)
    assert whole[0].tolist() == pieces[0].tolist() and whole[1].tolist() == pieces[1].tolist()
    # By brute force: words of letters between marks.
    words = re.sub(r"[^\W\d_]+", lambda m: m[0], "".join(c if c.isalpha() else " " for c in text.lower())).split()
    marked = "\0" + "\0".join(words) + "\0" if words else ""
    grams = [marked[i:i + n] for n in (1, 2, 3) for i in range(len(marked) - n + 1)]
    grams = [g for g in grams if g != "\0" and "\0" not in g[1:-1]]
    assert sorted(np.repeat(whole[1], 1).tolist()) == sorted(map(grams.count, set(grams)))



# --- licenses ----------------------------------------------------------------------------------------------------------

def test_licenses(spark):
    mit = licenses.TEMPLATES[0].phrase
    rows = [
        (1, "Released under the MIT license. Under the mit, license"), (2, "Apache License, Version 2.0 and CC BY-NC 4.0"),
        (3, mit.replace("software", "program").title()), (4, mit.replace("hereby", "never")), (5, "the license is under the"),
        (6, "under the mit " * 3000 + "license"), (7, None), (8, ""), (7, None), (None, "All rights reserved."),
    ]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs(spark, rows, clash=True)).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (2, 1, 5, "mit")
    assert got[2]["base_labels"] == "apache-2,cc-by-nc" and got[2]["n_base"] == 2
    assert (got[3]["labels"], got[3]["base_labels"]) == ("mit", "") and 0.7 <= got[3]["score"] < 1
    assert got[4]["labels"] == "" and got[5]["labels"] == ""
    assert (got[6]["n_words"], got[6]["n_base"], got[6]["first_word"]) == (9001, 1, 8997)
    assert got[7]["n_words"] == 0 and got[7]["first_word"] is None and got[None]["labels"] == "reserved"
    assert licenses.scan_licenses(docs(spark, [])).count() == 0


# --- classifiers ------------------------------------------------------------------------------------------------------

LABELS = "doc_id long, quality int, toxic int"


def labelled_rows():
    rows, labels = [], []
    for i in range(300):
        text = prose(i, 40)
        bad = i % 4 == 0
        if bad:
            words = text.split()
            words[5], words[20], words[30] = "idiot", "blargh", "blargh"
            text = "YOU " + " ".join(words).replace("w", "W") + " !!! ### $$$"
        rows.append((i, text))
        labels.append((i, int(not bad), int(bad)))
    return rows, labels


@pytest.mark.parametrize("module, scored, bad", [(toxicity, toxicity.toxicity_scores, 1), (quality, quality.quality_scores, 0)])
def test_classifiers(spark, module, scored, bad):
    rows, labels = labelled_rows()
    rows += [(1000, None), (1001, ""), (1002, prose(5, 30_000)), (None, "no id"), (3, rows[3][1]), (1003, None)]
    table = spark.createDataFrame([*labels, (5, None, None), (None, 1, 1), (7777, 0, 1)], LABELS).withColumn("text", F.lit("mine"))
    frame = docs(spark, rows, clash=True)
    got = scored(frame, table).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 300]
    right = [r["predicted"] == (bad if r["doc_id"] % 4 == 0 else 1 - bad) for r in held]
    assert np.mean(right) > 0.9
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1 == len({r["score"] for r in got if r["doc_id"] in (1000, 1001, 1003)})
    for one_class in (table.where("1 = 0"), table.where("toxic = 0")):
        assert len({r["score"] for r in scored(docs(spark, rows[:20]), one_class).collect()}) == 1
    assert scored(docs(spark, []), table).count() == 0


def test_held_out_labels_change_nothing(spark):
    rows, labels = labelled_rows()
    flipped = [(i, 1 - q, 1 - t) if __import__("zlib").crc32(str(i).encode()) % 4 == 2 else (i, q, t) for i, q, t in labels]
    frame = docs(spark, rows)
    for scored in (toxicity.toxicity_scores, quality.quality_scores):
        one, two = (sorted((r["doc_id"], r["score"]) for r in scored(frame, spark.createDataFrame(x, LABELS)).collect()) for x in (labels, flipped))
        assert one == two


def test_samples_are_bounded(spark):
    rows, labels = labelled_rows()
    got = labelled.labelled_sample(docs(spark, rows), spark.createDataFrame(labels, LABELS), "toxic", rows=50)
    assert got.count() == 50


def test_obfuscated_words_count_as_hits():
    lexicon = toxicity.Lexicon()
    for word in ("1d10t", "st*upid", "l.o.s.e.r", "mooorooon"):
        flags = lexicon.flag(word)
        assert flags & toxicity.DISGUISED or flags & toxicity.HIT, word
    assert not lexicon.flag("10")


def test_very_long_documents_are_learned_from(spark):
    rows = [(i, " ".join((["plain", "words"] if i % 2 else ["|||<>", "99999"]) * 13_500)) for i in range(16)]
    model = quality.fit(docs(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(16)], "doc_id long, quality int"))
    assert model.constant is None
    assert all((model.score(quality.encode_passages(t)) > 0.5) == bool(i % 2) for i, t in rows)


def test_attention_gradients():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, quality.WIDTH)) for n in (1, 3, 5)]
    model = quality.train(bags, [0, 1, 1])
    x, bag, y = np.concatenate(bags), np.repeat(np.arange(3), [1, 3, 5]), np.array([0.0, 1.0, 0.0])

    def loss():
        p = model._forward(x, bag)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    found = model.gradients(x, bag, y)
    for name in ("encode", "attend", "gate", "weigh", "score"):
        flat = model.weights[name].reshape(-1)
        k = len(flat) // 2
        kept = flat[k]
        flat[k] = kept + 1e-6
        up = loss()
        flat[k] = kept - 1e-6
        slope = (up - loss()) / 2e-6
        flat[k] = kept
        assert np.asarray(found[name]).reshape(-1)[k] == pytest.approx(slope, rel=1e-3, abs=1e-7)
