"""The tokenization automaton, conversation repair and the filter audit, against libraries, search and recounts."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.llm import automaton, conversations, filter_audit
from millrace.llm.queries import QUERIES
from millrace.llm.tokenizing import public_path
from tests.compare import connect, difference
from tests.llm.test_llm import ODD_TEXTS, SMALL, nothing, odd, ordered, real, texts  # noqa: F401

NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


# -- automaton ---------------------------------------------------------------
@pytest.fixture(scope="module", params=NAMES)
def codec(request):
    from tokenizers import Tokenizer

    path = public_path(request.param)
    return automaton.Codec(*automaton.codec(path)), Tokenizer.from_file(path)


def same_as_library(codec, text):
    ours, library = codec
    ids = ours.encode(text)
    want = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)
    assert ours.decode(ids) == library.decode(want, skip_special_tokens=False), repr(text)


def test_automaton_on_odd_texts(codec):
    for text in ODD_TEXTS:
        same_as_library(codec, text or "")
    for text in ("<|endoftext", "<|startoftext|><|endoftext|>", "a" * 20_000, "ab" * 5000 + "  c", "ΣΑΣ Σ", "한국어 🙂"):
        same_as_library(codec, text)


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60))
def test_automaton_on_any_text(codec, text):
    same_as_library(codec, text)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet="abcdeiknrst' .", max_size=120))
def test_automaton_on_plain_text(codec, text):
    same_as_library(codec, text)


@settings(max_examples=200, deadline=None)
@given(data=st.data())
def test_automaton_of_any_merges(data):
    """Small vocabularies of random merges, equal halves and overlaps included, against merging step by step."""
    tokens, merges = list("abc"), []
    for _ in range(data.draw(st.integers(0, 12))):
        a, b = data.draw(st.sampled_from(tokens)), data.draw(st.sampled_from(tokens))
        if a + b not in tokens:
            tokens.append(a + b)
            merges.append((a, b))
    vocabulary = {t: i for i, t in enumerate(tokens)}
    word = data.draw(st.text(alphabet="abc", min_size=1, max_size=24))
    parts = list(word)
    for a, b in merges:
        k = 0
        while k < len(parts) - 1:
            if (parts[k], parts[k + 1]) == (a, b):
                parts[k : k + 2] = [a + b]
            k += 1
    built = automaton.Automaton(vocabulary, merges)
    found = built.encode(word)
    assert [tokens[i] for i in found] == parts
    assert all(built.leaves(a, b) for a, b in zip([None, *found], found))  # a path of the automaton


def test_automaton_refuses_other_vocabularies():
    with pytest.raises(ValueError):
        automaton.Automaton({"a": 0, "b": 1, "abb": 2}, [])
    with pytest.raises(ValueError):
        automaton.Automaton({"a": 0, "aa": 1, "aaa": 2}, [("aa", "a"), ("a", "aa"), ("a", "a")])
    with pytest.raises(ValueError):
        automaton.Automaton({"a": 0}, []).encode("ab")


@pytest.mark.parametrize("which", ["odd", "real", "nothing"])
def test_encode_and_decode(request, which):
    from tokenizers import Tokenizer

    docs = request.getfixturevalue(which)
    path = public_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = automaton.encode_texts(docs, path, decode=True)
    want = []
    for i, text in texts(docs):
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), ids, library.decode(ids, skip_special_tokens=False)))
    found = [(r[0], r[1], np.frombuffer(r[2], "<u4").tolist(), r[3]) for r in got.collect()]
    assert ordered(found) == ordered(want)
    again = automaton.decode_ids(got.select("doc_id", "ids"), path)
    assert ordered(tuple(r) for r in again.collect()) == ordered((w[0], w[3]) for w in want)


def test_op11_digests(spark):
    got = {r["doc_id"]: r for r in QUERIES["op11_bpe"](spark, SMALL).collect()}
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    for i, text in texts(spark.read.parquet(f"{SMALL}/documents.parquet")):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


# -- conversations -----------------------------------------------------------
LEGAL = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """Cost and edits by trying everything: rows of (role, must go, truncated)."""
    best = None

    def inserted(roles):
        return "u" if not roles or roles[-1] in "sa" else "a"

    def go(k, roles, cost, edits):
        nonlocal best
        if (best and cost > best[0]) or not re.fullmatch(r"s?(ua)*u?", roles):
            return
        if k == len(rows) and LEGAL.fullmatch(roles) and (best is None or (cost, edits) < best):
            best = cost, edits
        if k < len(rows):
            role, must_go, cut = rows[k]
            go(k + 1, roles, cost + 4, edits + "D")
            if not must_go:
                if role[:1] in ("s", "u", "a"):
                    go(k + 1, roles + role[:1], cost + 3 * cut, edits + "K")
                for to in "ua":
                    go(k + 1, roles + to, cost + 3 + 3 * cut, edits + "R")
        if edits[-2:] != "II":
            go(k, roles + inserted(roles), cost + 3, edits + "I")

    go(0, "", 0, "")
    return best


def test_cheapest_edits_equal_search():
    rng, steps = random.Random(5), conversations.Steps()
    for _ in range(400):
        rows = [
            (rng.choice(["user", "assistant", "system", "tool", ""]), rng.random() < 0.2, rng.random() < 0.2)
            for _ in range(rng.randint(0, 6))
        ]
        found = conversations.Conversation(steps)
        for k, (role, must_go, cut) in enumerate(rows):
            found.add(k, role.encode(), b"" if must_go else b"%d" % k + (b"" if cut else b". "), False)
        edits = found.edits()
        assert (found.cost, edits.decode()) == cheapest(rows), rows
        assert LEGAL.fullmatch("".join(role[:1].decode() for _, role, _ in found.turns(edits)))
        found.close()


def repaired_by_hand(rows):
    """The summary of one conversation's rows ``(turn, role, text)`` in order."""
    seen, faults = set(), Counter()
    marked, pairs = [], 0
    for turn, role, text in rows:
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        again = not blank and (role, text) in seen
        cut = not blank and not again and not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text)
        seen.add((role, text))
        faults.update(blank=blank, duplicate=again, truncated=cut)
        marked.append((role, blank or again, cut))
    pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, edits = cheapest(marked)
    out, roles, at = [], "", 0
    for edit in edits:
        row = (None, "", "")
        if edit != "I":
            row, at = rows[at], at + 1
        if edit == "D":
            continue
        role = row[1] if edit == "K" else {"u": "user", "a": "assistant"}["u" if not roles or roles[-1] in "sa" else "a"]
        roles += role[:1]
        out.append(f"{role}:{row[2]}")
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], pairs, cost, edits, digest


TALK = [
    (1, 0, "system", "Rules."), (1, 1, "user", "Why?"), (1, 2, "assistant", "So"), (1, 2, "assistant", "So."), (1, 5, "user", "Why?"),
    (2, None, None, None), (2, 1, "", "No initial."), (2, 1, "User", "Capital!"), (2, 3, "tool", "é.\n"), (2, 3, "tool", "é.\n"),
    (None, 7, "assistant", "Alone."), (None, None, "user", "First?"), (3, None, "user", "  "), (4, 9, "assistant", "x" * 100_000),
    (0, 1, "user", "Zero."), (5, 0, "user", "a."), (5, 1, "user", "b."), (5, 2, "user", "a."), (5, 2, "assistant", "c."),
]


def by_hand(data):
    groups: dict = {}
    for conv, turn, role, text in data:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return ordered((conv, *repaired_by_hand(sorted(rows, key=key))) for conv, rows in groups.items())


@pytest.fixture(scope="module")
def talk(spark):
    data = [(*row, "clash", 1) for row in TALK]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, gone string, again int").repartition(4)


def test_repair_on_odd_rows(spark, talk):
    assert ordered(tuple(r) for r in conversations.repair(talk).collect()) == by_hand(TALK)
    assert conversations.repair(talk.where("conv_id = -1")).collect() == []


def test_repaired_turns_give_the_hash(talk):
    turns = conversations.repaired_turns(talk).orderBy("position").collect()
    texts_of = {}
    for r in turns:
        texts_of.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in conversations.repair(talk).collect():
        lines = "\n".join(texts_of.get(r["conv_id"], []))
        assert hashlib.sha256(lines.encode()).hexdigest() == r["repaired_sha256"]


def test_conversation_whose_rows_are_all_dropped(spark):
    rows = spark.createDataFrame([(8, 1, "user", "a.", True)], "conv_id long, turn long, role string, text string, out boolean")
    got = conversations.repair(rows, gone=rows["out"]).first()
    assert tuple(got) == (8, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_giant_conversation_spills(spark, monkeypatch):
    """Thousands of rows over many Arrow batches, files that spill and backpointers in blocks give what memory gives."""
    rows = spark.range(30_000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 7 < 4, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("text "), F.col("id").cast("string"), F.when(F.col("id") % 11 == 0, "").otherwise(".")).alias("text"),
    )
    want = conversations.repair(rows).first()
    assert want["truncated"] == len(range(0, 30_000, 11))
    steps = conversations.Steps()
    monkeypatch.setattr(conversations, "HELD", 1 << 10)
    monkeypatch.setattr(conversations, "BLOCK", 100)
    found = conversations.Conversation(steps)
    for r in rows.orderBy("turn").collect():
        found.add(r["turn"], r["role"].encode(), r["text"].encode(), False)
    assert found.pointers._rolled and found.texts._rolled
    assert found.edits().decode() == want["audit"] and found.cost == want["cost"]
    out = b"\n".join(role + b":" + text for _, role, text in found.turns(want["audit"].encode()))
    assert hashlib.sha256(out).hexdigest() == want["repaired_sha256"]


def test_damage(spark, talk):
    got = conversations.damaged(talk)
    want = []
    for conv, turn, role, text in TALK:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        role = "user" if code == 4 else role
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        want += [(conv, turn, role, text, code == 0)] * (2 if code == 3 else 1)
    assert ordered(tuple(r) for r in got.select("conv_id", "turn", "role", "text", "dropped").collect()) == ordered(want)


# -- filter audit ------------------------------------------------------------
def facts_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (
        len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall("[#$%&*|]", text)),
        hashlib.sha256(text.encode()).digest(),
    )


@pytest.mark.parametrize("which", ["odd", "real", "nothing"])
def test_text_facts(request, which):
    docs = request.getfixturevalue(which)
    got = filter_audit.text_facts(docs)
    want = [(i, *facts_by_hand(t), "") for i, t in texts(docs)]
    assert ordered(tuple(r) for r in got.collect()) == ordered(want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aAbé \n#日", max_size=200), min_size=1, max_size=4))
def test_facts_of_any_texts(found):
    got = filter_audit._facts([t.encode() for t in found])
    for k, text in enumerate(found):
        assert tuple(got[n][k] for n in ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")) == facts_by_hand(text)[:5]


def test_words_are_verified_when_hashes_collide(monkeypatch):
    long_a, long_b = b"x" * 500 + b"a", b"x" * 500 + b"b"
    text = b" ".join([b"ab", b"ba", b"ab", long_a, long_b, long_a, b"12345678", b"123456789", b"12345678"])
    monkeypatch.setattr(filter_audit.WordTable, "hashes", lambda self: np.zeros(len(self.begins), np.uint64))
    assert filter_audit._facts([text, text])["n_distinct"].tolist() == [6, 6]


def audit_by_hand(docs, labels):
    """``docs``: (id, part, text); ``labels``: id to (quality 1, toxic 1)."""
    least: dict = {}
    for i, _, text in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    total: dict = {}
    for i, part, text in docs:
        words, distinct, capitals, points, symbols, _ = facts_by_hand(text)
        fails = "".join(
            f for f, bad in zip("ABCDE", (
                words < 200, 100 * distinct < 50 * words, 100 * capitals > 3 * points, symbols > 0,
                i is not None and least[text or ""] < i,
            )) if bad
        )
        good, toxic = labels.get(i, (False, False))
        total.setdefault(part or "", []).append((fails, good, toxic))
    out = []
    for part, all_docs in total.items():
        removed_by: Counter = Counter()
        rows = []
        for order in permutations("ABCDE"):
            left = all_docs
            for k, f in enumerate(order):
                here = [d for d in left if f in d[0]]
                before = sum(f in d[0] for d in all_docs) - len(here)
                left = [d for d in left if f not in d[0]]
                removed_by[f] += len(here)
                only = sum(d[0] == f for d in all_docs)
                rows.append((f, "".join(order), k + 1, len(left), len(here), before, only, sum(d[1] for d in here), sum(d[2] for d in here)))
        out += [(part, *r[1:], removed_by[r[0]]) for r in rows]
    return ordered(out)


def test_audit_on_odd_input(spark, odd):
    labels = spark.createDataFrame(
        [(1, 1, 1), (1, 0, None), (2, 1, 0), (3, None, 1), (None, 1, 1), (999, 1, 1), (18, 0, 1), (19, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    docs = odd.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 3 == 1, "x").otherwise(""))
    data = [(r["doc_id"], r["lang"], r["text"]) for r in docs.collect()]
    want = audit_by_hand(data, {1: (True, True), 2: (True, False), 3: (False, True), 18: (False, True), 19: (True, False)})
    assert ordered(tuple(r) for r in filter_audit.audit_filters(docs, labels).collect()) == want
    assert filter_audit.audit_filters(docs.where("doc_id = -1"), labels).collect() == []


@pytest.mark.parametrize("name", ["op12_conversations", "op13_filter_audit"])
def test_new_queries_equal_their_sql(spark, name):
    assert difference(spark, connect(SMALL), name, SMALL) is None


def test_pairs_of_crowded_shingles_are_written_once(spark):
    from itertools import combinations

    from millrace.llm import shingles

    # 60 sets of equal parities, none connected; each has 50 of 55 crowded shingles, more than are listed for a set.
    has = {a: {s for s in range(-20, 35) if (s + a) % 11} for a in range(60)}
    nodes = spark.createDataFrame([(a, 100, bytearray(b"\x05" * shingles.PARITY)) for a in has], "node long, size int, parity binary")
    crowds = spark.createDataFrame([(a, s) for a in has for s in has[a]], "node long, shingle long")
    roots = spark.createDataFrame([(1, 0), (0, 0)], "node long, root long")
    met = [tuple(r) for r in shingles.unconnected(crowds, nodes, roots, 0.8).collect()]
    assert set(met) == set(combinations(has, 2)) - {(0, 1)}
    assert len(met) == len(set(met))


def test_stored_leaves_no_shuffle_files(spark, tmp_path):
    from millrace.llm import common

    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = set(blocks.getAllBlocks().mkString(" ").split())
    setting = spark.conf.get(common.SHUFFLES_GO, None)
    common.stored(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert spark.conf.get(common.SHUFFLES_GO, "false") == (setting or "false")
    deadline = time.time() + 10
    while (left := {b for b in set(blocks.getAllBlocks().mkString(" ").split()) - before if b.startswith("shuffle")}) and time.time() < deadline:
        time.sleep(0.2)
    assert not left
