"""Each operator against a brute-force restatement, an exact round trip or held-out accuracy, and on odd input."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import decontamination, huffman, induced_sorting, language_id, mtree, packing, recompression, simhash
from millrace.llm import shingles, suffix_dedup, token_counts, tokenizing, toxicity
from millrace.llm.common import stored
from millrace.llm.graph import components
from millrace.llm.queries import QUERIES
from millrace.session import shared_folder, work_path
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.001"
ODD_TEXTS = [
    None, "", " ", "\n\t ", "a", "a b", " a  b ", "x\n\n y▁ ▁z   ", "▁", "1234 a1b2 !!", "don't DON'T 's''s",
    "hello\tworld\0q é ½ 日本 <s> </s> <unk>", "X  <|endoftext|> \n<|endoftext|>b <|startoftext|>", "a  b  c  d",
    "İstanbul ΣΑΣ ﬁ Ⅷ ſ K \x1c a\x85b ŉ", "word " * 3000, "De " * 900, "é" * 2000, "same text of two rows", "same text of two rows",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns named like the operators' own."""
    data = [(i if i % 7 else None, t, "doc", 3, "x") for i, t in enumerate(ODD_TEXTS)]
    data += [(4, ODD_TEXTS[4], "doc", 3, "x"), (5, "another text of a known id", "doc", 3, "x")]
    return spark.createDataFrame(data, "doc_id long, text string, tie string, part int, fingerprint string").repartition(3)


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.where("doc_id = -1")


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").repartition(3)


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted(rows, key=repr)


# -- tokens ------------------------------------------------------------------
@pytest.mark.parametrize("which", ["odd", "real", "nothing"])
def test_token_counts(request, which):
    from sentencepiece import SentencePieceProcessor

    docs, path = request.getfixturevalue(which), tokenizing.public_path("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    want = [(d, len((t or "").encode()), len(model.encode(t or ""))) for d, t in texts(docs)]
    assert ordered(map(tuple, token_counts.count_tokens(docs, path).collect())) == ordered(want)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(real, name):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(tokenizing.public_path(name)), tokenizing.encoder(tokenizing.public_path(name))
    for text in [*ODD_TEXTS, *(t for _, t in texts(real))]:
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(own.encode((text or "").encode()), "<u2").tolist() == want


@pytest.mark.parametrize("which", ["odd", "real", "nothing"])
def test_token_files_round_trip(request, spark, which):
    docs, path = request.getfixturevalue(which), tokenizing.public_path("word_bpe_49k.json")
    encode, folder = tokenizing.encoder(path).encode, work_path(spark, "token-files")
    huffman.write_token_files(docs, folder, path)
    got = sorted(huffman.read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    at, found = 0, []
    for r in got:
        assert (r["start"], len(r["ids"])) == (at, 4 * r["n_tokens"])
        at += r["n_tokens"]
        found.append((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()))
    want = [(d, [*np.frombuffer(encode((t or "").encode()), "<u2").tolist(), 2]) for d, t in texts(docs)]
    assert ordered(found) == ordered(want)


@pytest.mark.parametrize("limit", [3, 5, 16])
def test_code_lengths_are_optimal_and_bounded(limit):
    rng = np.random.default_rng(limit)
    counts = np.concatenate([rng.integers(1, 5, 3), 2 ** np.arange(5), [0]])
    lengths = huffman.code_lengths(counts, limit)
    assert lengths.max() <= limit and lengths[-1] == 0
    assert sum(2.0 ** -int(v) for v in lengths if v) == 1
    best = min_cost(tuple(sorted(counts[counts > 0].tolist())), limit)
    assert int((counts * lengths).sum()) == best
    ids = np.repeat(np.arange(len(counts)), counts * 40)
    rng.shuffle(ids)
    payload, checkpoints = huffman.pack_bits(ids, huffman.canonical_codes(lengths), lengths)
    assert huffman.Decoder(lengths).unpack(payload, checkpoints, len(ids)).tolist() == ids.tolist()


def min_cost(counts, limit):
    """Least total length over all length multisets that fill the code space."""
    best = None

    def walk(k, space, last, cost):
        nonlocal best
        if k == len(counts):
            best = cost if best is None else min(best, cost)
            return
        for bits in range(1, last + 1):  # rarer first, longer first
            if space - 2.0**-bits >= -1e-12:
                walk(k + 1, space - 2.0**-bits, bits, cost + counts[k] * bits)

    walk(0, 1.0, limit, 0)
    return best


@pytest.mark.parametrize("which", ["odd", "real", "nothing"])
def test_packing(request, which):
    docs, path = request.getfixturevalue(which), tokenizing.public_path("byte_bpe_50k.json")
    encode = tokenizing.encoder(path).encode
    got = packing.pack(docs, path, capacity=256).collect()
    sequences, by_start = defaultdict(list), Counter()
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        by_start[r["doc_id"], r["start"], r["ids"].hex()] += 1
        assert r["length"] == len(r["ids"]) // 4 and (r["piece"] == 0 or r["length"] == 256)
    want, total = Counter(), 0
    for d, t in texts(docs):
        ids = np.append(np.frombuffer(encode((t or "").encode()), "<u2"), 2).astype("<u4")
        total += len(ids)
        edges = [0, *range(len(ids) % 256 or min(256, len(ids)), len(ids) + 1, 256)]
        want.update((d, a, ids[a:b].tobytes().hex()) for a, b in zip(edges, edges[1:]))
    assert by_start == want
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= -(-total // 256) + 2 + total // 256 // 10


def test_plan_fills_sequences():
    rng = np.random.default_rng(1)
    counts = Counter(rng.integers(1, 1025, 200_000).tolist())
    plan = packing.Plan(counts, 1024)
    least = -(-sum(k * n for k, n in counts.items()) // 1024)
    assert plan.sequences <= least * 1.003
    for one in ({}, {1024: 3}, {700: 10}, {1: 5}, {512: 7, 1: 3}):
        assert packing.Plan(one, 1024).sequences >= -(-sum(k * n for k, n in one.items()) // 1024)
    assert packing.Plan({700: 10}, 1024).sequences == 10 and packing.Plan({1: 5}, 1024).sequences == 1


@pytest.mark.parametrize("low, high", [(332, 350), (335, 347), (300, 380), (245, 267), (20, 511)])
def test_plan_of_short_lengths_comes_near_the_bound(low, high):
    counts = dict.fromkeys(range(low, high + 1), 30_000)
    least = -(-sum(k * n for k, n in counts.items()) // 1024)
    plan = packing.Plan(counts, 1024)
    assert plan.sequences <= least * 1.01
    assert {k: int(plan.taken[k]) for k in counts} == counts


# -- classifiers ---------------------------------------------------------------
def test_toxicity_learns_pairs_and_holds_out(spark):
    rng = random.Random(4)
    filler = [f"w{i}" for i in range(300)]
    data = []
    for i in range(3000):
        words, kind = rng.sample(filler, 20), rng.randrange(4)
        words += {0: [], 1: ["insult"], 2: ["group"], 3: ["insult", "group"]}[kind]
        data.append((i, " ".join(words), int(kind == 3)))
    rows = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    machine = toxicity.learn(rows, rows.select("doc_id", "toxic"), F.col("doc_id") % 5 != 0)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(rows, machine).collect()}
    right = [(scores[i] >= 0.5) == bool(label) for i, _, label in data if i % 5 == 0]
    assert sum(right) / len(right) > 0.97
    assert (np.abs(machine.factors).max(1) > 0.05).any()


def test_toxicity_on_odd_input(spark, odd, nothing):
    labels = spark.createDataFrame([(None, 1), (2, None), (3, 1), (3, 0), (4, 0)], "doc_id long, toxic int")
    machine = toxicity.learn(odd, labels, F.lit(True))
    got = toxicity.score_toxicity(odd, machine).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score_toxicity(nothing, toxicity.learn(nothing, labels, F.lit(True))).count() == 0


def test_language_held_out(real):
    folds = F.col("doc_id") % 4 != 2
    model = language_id.learn(real, folds)
    lang = {r["doc_id"]: r["lang"] for r in real.collect()}
    got = language_id.identify(real, model).where("doc_id % 4 = 2").collect()
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in got) / len(got) > 0.95


def test_language_on_odd_input(odd, nothing, real):
    model = language_id.learn(real, F.lit(True))
    got = language_id.identify(odd, model).collect()
    assert len(got) == odd.count()
    by_id = defaultdict(set)
    for r in got:
        by_id[r["doc_id"]].add((r["lang_pred"], r["score"]))
    assert by_id[1] == by_id[2] == by_id[3] == {("und", 0.0)}
    assert language_id.identify(nothing, model).count() == 0
    blank = odd.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.learn(blank, F.lit(True)) is None
    kept = language_id.with_language(odd, model)
    assert kept.columns == odd.columns and {r["text"] for r in kept.collect()}.isdisjoint({None, "", " ", "\n\t "})


def test_language_sample_is_bounded_and_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(language_id, "TRAINING_ROWS", 100)
    seen = []
    monkeypatch.setattr(language_id, "train", lambda texts, labels: seen.extend(texts))
    data = [(None, f"null {i}", "en") for i in range(700)] + [(5, f"five {i}", "en") for i in range(700)]
    data += [(1000 + i, f"own {i}", "en") for i in range(700)] + [(None, "copy", "en")] * 900
    language_id.learn(spark.createDataFrame(data, "doc_id long, text string, lang string"), F.lit(True))
    kinds = Counter(t.split()[0] for t in seen)
    assert 80 <= len(seen) <= 100 and kinds[b"copy"] <= 1
    assert all(15 <= kinds[k] <= 55 for k in (b"null", b"five", b"own"))


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 40])
def test_codewords_differ(k):
    code = language_id.codewords(k)
    assert len({tuple(row) for row in code.tolist()}) == k


# -- search --------------------------------------------------------------------
def test_top_k_query_equals_sql(spark):
    assert difference(spark, connect(SMALL), "op3_topk_search", SMALL) is None


@pytest.mark.parametrize("shard, block", [(16_384, 1_024), (50, 7)])
def test_top_k_ties_and_bad_vectors(spark, monkeypatch, shard, block):
    monkeypatch.setattr(mtree, "SHARD", shard)
    monkeypatch.setattr(mtree, "BLOCK", block)
    rng = random.Random(2)
    data = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(3)]) for i in range(300)]
    data += [(300, None), (301, [1.0, None, 0.0]), (302, [float("nan"), 0.0, 0.0]), (303, [float("inf"), 0.0, 0.0]), (None, [0.0] * 3)]
    vectors = mtree.quantize(spark.createDataFrame(data, "vec_id long, embedding array<float>"))
    got = mtree.top_k(vectors, vectors.where("vec_id % 20 = 0"), 5).collect()
    whole = {i: np.floor(64 * np.array(v)) for i, v in data[:300]}
    want = []
    for q in range(0, 300, 20):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    assert ordered(map(tuple, got)) == ordered(want)
    assert mtree.top_k(vectors.where("vec_id < 3"), vectors.where("vec_id = 0"), 5).count() == 2
    assert mtree.top_k(vectors.where("vec_id < 0"), vectors.where("vec_id < 0"), 5).count() == 0


def test_top_k_joins_nothing_and_deals_parts(spark, monkeypatch):
    """Queries and shards meet by a shuffle: a join's planner took exploded blocks for small ones and broadcast them. Repeated ids, and
    components too large for a byte or a short, are as good as any."""
    for name, value in (("SHARD", 20), ("BLOCK", 3), ("BLOCKS", 2), ("SHARDS", 2)):
        monkeypatch.setattr(mtree, name, value)
    rng = random.Random(3)
    for most in (1, 100, 40_000):
        data = [(i % 150, [float(rng.randint(-most, most)) for _ in range(4)]) for i in range(200)]
        vectors = mtree.quantize(spark.createDataFrame(data, "vec_id long, embedding array<double>"), scale=1)
        found = mtree.top_k(vectors, vectors.where("vec_id % 10 = 0"), 6)
        assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
        want = []
        for q, a in (r for r in data if r[0] % 10 == 0):
            best = sorted((-int(sum(x * y for x, y in zip(a, b))), i) for i, b in data if i != q)[:6]
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
        assert ordered(map(tuple, found.collect())) == ordered(want)


# -- near-duplicates -----------------------------------------------------------
def plain_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(items, linked):
    parent = list(range(len(items)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(items))]


@pytest.mark.parametrize("which", ["odd", "real", "nothing"])
def test_simhash_components(request, which):
    docs = request.getfixturevalue(which)
    rows = sorted(texts(docs), key=lambda r: (r[0] is None, r[0] or 0))
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = groups_of(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    want = [(d, f"{p:016x}", rows[root][0]) for (d, _), p, root in zip(rows, prints, roots)]
    assert ordered(map(tuple, simhash.near_duplicates(docs).collect())) == ordered(want)


@pytest.mark.parametrize("chunk, budget", [(1 << 14, 3), (7, 3), (1 << 14, 7)])
def test_trie_join_finds_all_links(spark, monkeypatch, chunk, budget):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "BATCH", chunk * 10)
    rng = random.Random(1)
    found = {rng.getrandbits(64) for _ in range(150)}
    for value in list(found)[:80]:
        for _ in range(rng.randint(1, 5)):
            for _ in range(rng.randint(1, budget + 1)):
                value ^= 1 << rng.randrange(64)
            found.add(value)
    items = sorted(found)
    signed = [v - (1 << 64) if v >> 63 else v for v in items]
    entries = spark.createDataFrame([(v,) for v in signed], "node long").selectExpr(
        "node", "node AS fingerprint", "cast(null AS binary) AS sketch"
    )
    root = {r["node"]: r["root"] for r in components(simhash.links(entries, budget), "a", "b").collect()}
    want = groups_of(items, lambda a, b: (a ^ b).bit_count() <= budget)
    mine, theirs = defaultdict(set), defaultdict(set)
    for v, s, w in zip(items, signed, want):
        mine[root.get(s, s)].add(v)
        theirs[w].add(v)
    assert ordered(map(sorted, mine.values())) == ordered(map(sorted, theirs.values()))


def test_trie_tables_are_dealt_a_few_at_a_time(spark, monkeypatch):
    """So many entries that there are 36 tables of them: all at once they would lie on disk 36 times."""
    masks, labels, keep = simhash.block_choices(7, 1 << 22), [], simhash.stored
    assert len(masks) == 36
    monkeypatch.setattr(simhash, "block_choices", lambda budget, entries: masks)
    monkeypatch.setattr(simhash, "stored", lambda df, label, **options: (labels.append(label), keep(df, label, **options))[1])
    rng, items = random.Random(5), []
    for _ in range(40):
        value = rng.getrandbits(63)
        items += [value, value ^ sum(1 << b for b in rng.sample(range(63), 7)), value ^ sum(1 << b for b in rng.sample(range(63), 8))]
    entries = spark.createDataFrame([(v,) for v in items], "node long").selectExpr("node", "node AS fingerprint", "cast(null AS binary) AS sketch")
    root = {r["node"]: r["root"] for r in components(simhash.links(entries, 7), "a", "b").collect()}
    want = groups_of(items, lambda a, b: (a ^ b).bit_count() <= 7)
    assert labels == ["trie-links"] * 5
    assert len({root.get(v, v) for v in items}) == len(set(want))
    assert all((root.get(v, v) == root.get(u, u)) == (w == x) for v, w in zip(items, want) for u, x in zip(items, want))


def test_tables_between_steps_go(spark):
    folder = shared_folder(spark)
    words = [f"w{i}" for i in range(400)]
    base = random.Random(12).choices(words, k=200)
    data = [(1, " ".join(base)), (2, " ".join([*base[:199], "other"])), (3, " ".join(base[::-1])), (4, None), (None, "")]
    docs = stored(spark.createDataFrame(data, "doc_id long, text string"), "docs")
    before = set(os.listdir(folder))
    kept = simhash.without_near_duplicates(docs)
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 4}
    assert [name.rpartition("-")[0] for name in set(os.listdir(folder)) - before] == ["kept-places"]


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(500)] + [(1000 + i, 1000) for i in range(300)] + [(7, 7)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {(r["node"], r["root"]) for r in found} == {(i, 0) for i in range(501)} | {(1000 + i, 1000) for i in range(300)}
    assert len(found) == 801


def plain_similarity(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def test_pairs_just_below_the_threshold_are_no_links(spark):
    rng, data = random.Random(9), []
    words = [f"w{i}" for i in range(4000)]
    while len(data) < 300:
        base = rng.choices(words, k=240)
        other = list(base)
        for at in rng.sample(range(5, 235), 6):
            other[at] = rng.choice(words)
        pair = [" ".join(base), " ".join(other)]
        if 0.76 <= plain_similarity(*pair) < 0.8:
            data += pair
    docs = stored(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string"), "docs")
    got = simhash.near_duplicates(docs, 1, 7, True, (5, 0.8))
    assert got.where("doc_id <> component_id").count() == 0


@pytest.mark.parametrize("chunk, often, each", [(1 << 12, 64, 4), (3, 2, 4), (3, 2, 0), (1 << 12, 64, 0)])
def test_near_duplicates_at_the_threshold_equal_brute_force(spark, monkeypatch, chunk, often, each):
    monkeypatch.setattr(shingles, "CHUNK", chunk)
    monkeypatch.setattr(shingles, "PAIRS_EACH", each)
    monkeypatch.setattr(shingles, "FREQUENT", often)
    monkeypatch.setattr(shingles, "ROWS_HELD", 500)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    common, data = rng.choices(words, k=40), []
    for k in range(60):
        base = rng.choices(words, k=rng.randint(60, 250)) + (common if k % 3 == 0 else [])
        n = len(base)
        size = round(n * rng.uniform(0.02, 0.25))
        other = rng.choices(words, k=size)
        at = rng.randrange(n - size)
        edits = [base + other, other + base, base[: n - size], base[size:], base[:at] + other + base[at:], base[:at] + base[at + size :]]
        half = size // 2
        edits.append(base[:at] + other[:half] + base[at + half :])
        data += [base, *rng.sample(edits, 3)]
    data = [" ".join(w) for w in data]
    near = [(i, j) for i in range(len(data)) for j in range(i) if plain_similarity(data[i], data[j]) >= 0.8]
    assert sum(plain_similarity(data[i], data[j]) < 0.85 for i, j in near) > 20
    want = groups_of(data, lambda a, b: plain_similarity(a, b) >= 0.8)
    docs = stored(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string"), "docs")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs, 1, 7, True, (5, 0.8)).collect()}
    assert got == dict(enumerate(want))
    assert {r["doc_id"] for r in simhash.without_near_duplicates(docs).collect()} == set(want)


def test_one_document_of_a_group_stays(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    base = [rng.choices(words, k=400) for _ in range(12)]
    data = [(i, " ".join(b)) for i, b in enumerate(base)]
    for i, b in enumerate(base[:8]):  # a near copy with two changed words, an exact one, and one that is half alike
        near = list(b)
        near[100], near[300] = "changed", "too"
        data += [(100 + i, " ".join(near)), (200 + i, " ".join(b)), (300 + i, " ".join(b[:200] + rng.choices(words, k=200)))]
    docs = spark.createDataFrame([(d, t, "x") for d, t in data], "doc_id long, text string, row string").repartition(3)
    path = work_path(spark, "docs")
    docs.write.parquet(path)
    kept = simhash.without_near_duplicates(spark.read.parquet(path))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {*range(12), *range(300, 308)}


def test_one_row_stays_of_repeated_and_null_ids(spark):
    data = [(None, "a b c"), (None, "a b c"), (3, "x y z"), (3, "x y z"), (None, None), (4, ""), (5, "x y z")]
    path = work_path(spark, "docs")
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(path)
    kept = simhash.without_near_duplicates(spark.read.parquet(path)).collect()
    assert ordered(map(tuple, kept)) == ordered([(None, "a b c"), (3, "x y z"), (4, "")])


# -- substrings ----------------------------------------------------------------
def plain_word_repeats(docs, window):
    first: dict = {}
    keys = [(d is not None, d or 0, zlib.crc32((t or "").encode())) for d, t in docs]
    words = [(t or "").encode().split() for _, t in docs]
    for key, w in zip(keys, words):
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, (key, i)), (key, i))
    out = []
    for (d, _), key, w in zip(docs, keys, words):
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] != (key, i) for j in range(i, i + window)}
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def made_of_pieces(seed, n, unit):
    rng = random.Random(seed)
    base = [[unit(rng) for _ in range(400)] for _ in range(8)]
    out = []
    for _ in range(n):
        text: list[str] = []
        for _ in range(rng.randint(0, 5)):
            at = rng.randint(0, 380)
            text += rng.choice(base)[at : at + rng.randint(5, 90)]
        out.append(text)
    return out


@pytest.mark.parametrize("window", [7, 20])
def test_word_repeats(spark, window):
    rng = random.Random(window)
    data = [" ".join(t) for t in made_of_pieces(5, 80, lambda r: str(r.randint(0, 5000)))]
    data += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 150))) for _ in range(40)]
    data += [" ".join(" ".join([rng.choice("abc")] * rng.randint(1, 60)) for _ in range(rng.randint(0, 9))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string").repartition(4)
    got = recompression.remove_repeats(docs, window).collect()
    assert ordered(map(tuple, got)) == ordered(plain_word_repeats(list(enumerate(data)), window))


def test_word_repeats_on_odd_input(odd, nothing):
    got = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in recompression.remove_repeats(odd, 20).collect()}
    assert (15, 3000, 2999 + 0) in got or (15, 3000, 3000) in got
    assert (16, 900, 899) in got or (16, 900, 900) in got
    assert recompression.remove_repeats(odd, 20).count() == odd.count()
    assert recompression.remove_repeats(nothing, 20).count() == 0
    cut = recompression.replace_repeats(odd, 20)
    assert cut.columns == odd.columns and cut.count() == odd.count()


def test_repeats_leave_other_texts_as_they_are(spark):
    long = " ".join(f"w{i}" for i in range(60))
    data = [(1, f"a  b\n{long}", 7), (2, f"c\t{long}  d", 8), (3, "x  y\n z", 9), (4, None, 9)]
    docs = spark.createDataFrame(data, "doc_id long, text string, doc int")
    got = recompression.replace_repeats(docs, 20).collect()
    assert ordered(map(tuple, got)) == ordered([data[0], (2, "c d", 8), data[2], data[3]])


def plain_byte_repeats(docs, length):
    counts: Counter = Counter()
    for _, t in docs:
        b = (t or "").encode()
        counts.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = 1
        runs = int((np.diff(gone, prepend=0) == 1).sum())
        out.append((d, len(b), int(gone.sum()), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("length, chunk", [(64, 1 << 14), (64, 3), (400, 1 << 14)])
def test_byte_repeats(spark, monkeypatch, length, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    rng = random.Random(length)
    data = [" ".join(t) for t in made_of_pieces(6, 60, lambda r: r.choice("abcé") * r.randint(1, 6))]
    data += ["".join(rng.choice(["a", "b", "ab" * 30, "c" * 300]) for _ in range(rng.randint(0, 20))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string").repartition(4)
    got = [(*r[:4], bytes(r["kept"])) for r in suffix_dedup.remove_repeated_bytes(docs, length).collect()]
    assert ordered(got) == ordered(plain_byte_repeats(list(enumerate(data)), length))


def test_byte_repeats_on_odd_input(odd, nothing):
    got = {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup.remove_repeated_bytes(odd, 400).collect()}
    assert (15, 15_000, 15_000) in got and (17, 4_000, 4_000) in got and (1, 0, 0) in got
    assert suffix_dedup.remove_repeated_bytes(odd, 400).count() == odd.count()
    assert suffix_dedup.remove_repeated_bytes(nothing, 400).count() == 0


@pytest.mark.parametrize("direct, memory", [(1 << 21, 64 << 20), (4, 200)])
def test_induced_sorting(monkeypatch, direct, memory):
    monkeypatch.setattr(induced_sorting, "DIRECT", direct)
    monkeypatch.setattr(induced_sorting, "MEMORY_BYTES", memory)
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"abc"[: 2 + k % 2]) for _ in range(rng.randint(0, 150))) for k in range(120)]
    for string in [*strings, b"a" * 200, b"abc" * 50, b"ba" * 40 + b"ab" * 40]:
        symbols = np.append(np.frombuffer(string, np.uint8).astype(np.uint16) + 1, 0)
        positions, shared = [], []
        text = induced_sorting.Text(symbols)
        text.induce(*text.sorted_lms(), lambda p, s: (positions.append(p), shared.append(s)))
        plain = symbols.tolist()
        want = sorted(range(len(plain)), key=lambda i: plain[i:])
        assert np.concatenate(positions)[::-1].tolist() == want
        common = []
        for a, b in zip(want, want[1:]):
            common.append(next((k for k, (x, y) in enumerate(zip(plain[a:], plain[b:])) if x != y), 0))
        assert np.concatenate(shared).tolist()[1:] == common[::-1]


# -- decontamination -------------------------------------------------------------
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_leaks(docs, items, window=10):
    def words(text):
        return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    found = defaultdict(lambda: defaultdict(set))
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            found[n][tuple(w[k : k + n])].add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, names = words(t), set(), set()
        for n, windows in found.items():
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    names |= own
        out.append((d, len(w), len(hit), sorted(names)))
    return out


@pytest.mark.parametrize("size", [32 << 20, 100])
def test_leaks(spark, monkeypatch, odd, size):
    monkeypatch.setattr(decontamination, "BENCHMARK_BYTES", size)
    rng = random.Random(3)
    docs = [(i, "".join(rng.choice(["a ", "B ", "c, ", "É ", "d."]) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    items = [
        (i if i % 5 else None, None if i % 7 == 0 else "".join(rng.choice(["A ", "b ", "c ", "é ", "d "]) for _ in range(rng.randint(0, 14))))
        for i in range(30)
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    both = spark.createDataFrame(docs, "doc_id long, text string").union(odd.select("doc_id", "text"))
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in decontamination.find_leaks(both, bench).collect()]
    want = plain_leaks(texts(both), items)
    assert ordered(got) == ordered(want)
    clean = decontamination.without_leaks(both, bench)
    assert clean.count() == sum(hit == 0 for _, _, hit, _ in want)


def test_leaks_without_benchmark_or_documents(spark, odd, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_leaks(odd, none).where("n_hit > 0").count() == 0
    assert decontamination.find_leaks(nothing, none).count() == 0


# -- queries -------------------------------------------------------------------
@pytest.mark.parametrize("name", ["op1_toxicity", "op5_language_id"])
def test_folds(spark, name):
    modulus, fold = {"op1_toxicity": (5, 0), "op5_language_id": (4, 2)}[name]
    for r in QUERIES[name](spark, SMALL).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == fold)
        assert 0 <= r["score"] <= 1


def test_digests(spark, real):
    want = {d: (n, gone, hashlib.sha256(k.encode()).hexdigest()) for d, n, gone, k in plain_word_repeats(texts(real), 20)}
    got = {r["doc_id"]: tuple(r[1:]) for r in QUERIES["op10_substring_dedup"](spark, SMALL).collect()}
    assert got == want
    bytes_want = {d: (n, gone, runs, hashlib.sha256(k).hexdigest()) for d, n, gone, runs, k in plain_byte_repeats(texts(real), 400)}
    assert {r["doc_id"]: tuple(r[1:]) for r in QUERIES["op6_suffix_dedup"](spark, SMALL).collect()} == bytes_want
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaks = {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in plain_leaks(texts(real), items)}
    assert {r["doc_id"]: tuple(r[1:]) for r in QUERIES["op8_decontamination"](spark, SMALL).collect()} == leaks


def test_near_duplicates_do_not_depend_on_how_rows_are_read(spark, tmp_path):
    """Rows parted otherwise in every job, as when executors come and go, are still told apart; equal rows count once."""
    base = [" ".join(f"w{k}x{i}" for k in range(40)) for i in range(40)]
    data = [(i % 37, t, "a") for i, t in enumerate(base + base[:20])] + [(None, base[3], "a")] * 3 + [(500, base[39] + " end", "b")]
    spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(9).write.parquet(str(tmp_path / "d"))
    setting = "spark.sql.files.minPartitionNum"
    seen = []
    for n in ("1", "7", "40"):
        spark.conf.set(setting, n)
        kept = simhash.without_near_duplicates(spark.read.parquet(str(tmp_path / "d")))
        spark.conf.set(setting, str(int(n) + 3))  # the last job reads otherwise than those before
        seen.append(ordered(tuple(r) for r in kept.collect()))
    spark.conf.unset(setting)
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 40


@pytest.mark.parametrize("edits, linked", [((2, 3), True), ((7, 8), False)])
def test_near_duplicate_steps_grow_with_the_group(spark, monkeypatch, edits, linked):
    """Of a group of near copies, above the least similarity or below it, no step writes out the pairs."""
    rng, words, rows = random.Random(4), [f"w{i}" for i in range(4000)], []
    base = rng.choices(words, k=250)
    texts_ = []
    for _ in range(400):
        other = list(base)
        for at in rng.sample(range(5, 245), rng.randint(*edits)):
            other[at] = rng.choice(words)
        texts_.append(" ".join(other))
    pairs = [plain_similarity(*rng.sample(texts_, 2)) for _ in range(200)]
    assert (min(pairs) > 0.78) if linked else (max(pairs) < 0.78)
    keep = shingles.stored

    def counted(df, label, *more, **options):
        out = keep(df, label, *more, **options)
        if label in ("meetings", "crowd-trees", "candidates"):
            rows.append((label, out.count()))
        return out

    monkeypatch.setattr(shingles, "stored", counted)
    for n in (100, 200, 400):
        rows.clear()
        docs = stored(spark.createDataFrame(list(enumerate(texts_[:n])), "doc_id long, text string"), "docs")
        got = {r["component_id"] for r in simhash.near_duplicates(docs, 1, 7, True, (5, 0.8)).collect()}
        assert len(got) == (1 if linked else n)
        assert all(k <= (n * 80 if label == "meetings" else n) for label, k in rows), (n, rows)


def test_parities_never_exclude_a_pair_that_is_alike():
    rng = np.random.default_rng(2)
    for size in (3, 40, 500, 900, 5000):
        sets = [rng.integers(0, 1 << 63, size, dtype=np.int64).view(np.uint64)]
        for k in range(60):  # sets from alike to unlike the first
            new = rng.integers(0, 1 << 63, round(size * k / 200), dtype=np.int64).view(np.uint64)
            sets.append(np.concatenate([sets[0][len(new) :], new, new[: k % 3] + np.uint64(1)]))
        sets = [np.unique(s) for s in sets]
        marks = [shingles.parities_of(s).ljust(shingles.PARITY_MOST, b"\0") for s in sets]
        parity = np.frombuffer(b"".join(marks), np.uint64).reshape(len(sets), -1)
        sizes = np.array([len(s) for s in sets])
        x, y = np.triu_indices(len(sets), 1)
        found = set(zip(*(v.tolist() for v in shingles.Parities(parity, sizes, 0.8).possible(x, y))))
        alike = {(i, j) for i, j in zip(x.tolist(), y.tolist()) if shingles._alike(sets[i], sets[j], 0.8)}
        assert alike and alike <= found
        assert size < 40 or size > 900 or len(found) < len(x)
