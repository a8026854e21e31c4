"""Code lengths under both models against their definitions, and held-out accuracy."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import docs
from pyspark.sql import functions as F

from loanweave.llm import ctw_scores as C
from loanweave.llm import ppm_language as L
from loanweave.llm.common import GramCosts, chunks, grams
from loanweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("chunk", [1, 5, 1000])
def test_sums_do_not_depend_on_chunks_or_slots(chunk):
    texts = [b"", b"a", b"banana bandana", b"xyz" * 9]
    cost = lambda codes: (codes % np.uint64(97)).astype(np.float32)[:, None]
    for slots in (2, 16):
        got = GramCosts(cost, 3, 1, slots).sums(texts, b"\0\0\0", chunk)[:, 0]
        plain = [sum(int.from_bytes((b"\0\0\0" + t)[i : i + 4]) % 97 for i in range(len(t))) for t in texts]
        assert got.tolist() == plain


def ppm_bits(train: list[bytes], text: bytes) -> float:
    """PPM, escape method C, without exclusion."""
    seen: dict[bytes, Counter] = defaultdict(Counter)
    for t in train:
        whole = L.START + t
        for i in range(L.ORDER, len(whole)):
            for k in range(L.ORDER + 1):
                seen[whole[i - k : i]][whole[i]] += 1
    total, whole = 0.0, L.START + text
    for i in range(L.ORDER, len(whole)):
        for k in range(L.ORDER, -1, -1):
            own = seen.get(whole[i - k : i])
            if own and whole[i] in own:
                total -= math.log2(own[whole[i]] / (own.total() + len(own)))
                break
            if own:
                total -= math.log2(len(own) / (own.total() + len(own)))
        else:
            total += 8
    return total


def test_ppm_costs_follow_the_definition():
    rng = random.Random(1)
    train = [bytes(rng.choices(b"abcd ", k=rng.randrange(60))) for _ in range(12)]
    codes, counts = C._counted(*(np.concatenate(x) for x in zip(*L.gram_counts(train), strict=True)))
    trees = L.ContextTrees.learned(codes, counts)
    for text in [b"abc dab", b"zzz", b"a\xff b", bytes(rng.choices(b"abcde ", k=40))]:
        (_, buffer, begins, ends), = chunks([text], L.START, 10**6)
        assert trees.costs(grams(buffer, L.ORDER)[begins[0] : ends[0]]).sum() == pytest.approx(ppm_bits(train, text))


def test_languages_of_held_out_documents(spark):
    rows = QUERIES["op8_ppm_language"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = rows.where("held_out").join(truth, "doc_id").collect()
    assert len(held) > 30 and np.mean([r.lang == r.lang_pred for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in held)


def test_texts_without_letters_are_undetermined(spark):
    frame = docs(spark, ["good words in here", "123 ...", "", None, "more good words"])
    rows = {r.doc.doc_id: r for r in L.predict(frame, ["doc_id"], L.learn(frame)).collect()}
    assert [rows[i].lang_pred for i in range(5)] == ["en", "und", "und", "und", "en"]
    assert [r.text for r in L.keep_recognised(frame).orderBy("doc_id").collect()] == ["good words in here", "more good words"]
    unlabelled = frame.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.predict(unlabelled, ["doc_id"], L.learn(unlabelled)).collect()} == {"und"}


def test_every_label_is_learned_in_blocks(spark):
    rng = random.Random(8)
    rows = []
    for k in range(300):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(6)]
        rows += [(f"l{k:03d}", " ".join(rng.choices(words, k=30))) for _ in range(4)]
    frame = docs(spark, [text for _, text in rows] + ["", None]).drop("lang").withColumn("_letters", F.lit(1))
    labels = spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "doc_id bigint, lang string")
    frame = frame.join(labels, "doc_id", "left")

    def found(languages):
        return {r.doc.doc_id: r for r in L.predict(frame, ["doc_id", "_letters"], L.learn(frame, 10**6, languages)).collect()}

    blocks, whole = found(80), found(1000)
    assert len(list(L.learn(frame, 10**6, 80))) == 4 and len(blocks) == len(rows) + 2
    assert all(blocks[i].lang_pred == whole[i].lang_pred and blocks[i].score == pytest.approx(whole[i].score) for i in whole)
    assert all(blocks[i].bits_per_byte == pytest.approx(whole[i].bits_per_byte) for i in whole)
    assert np.mean([blocks[i].lang_pred == lang for i, (lang, _) in enumerate(rows)]) > 0.95
    assert {r.lang_pred for r in whole.values()} >= {lang for lang, _ in rows[::4]}


def kt(zeros: int, ones: int) -> float:
    p = 1.0
    for i in range(zeros):
        p *= (i + 0.5) / (i + 1)
    for j in range(ones):
        p *= (j + 0.5) / (zeros + j + 1)
    return p


def test_weighting_follows_the_definition(monkeypatch):
    """Chance of one byte more = ratio of weighted probabilities with and without it."""
    depth = 2
    monkeypatch.setattr(C, "DEPTH", depth)
    monkeypatch.setattr(C.code_lengths, "__defaults__", (depth,))
    rng = random.Random(3)
    text = bytes(rng.choices(b"abcab", k=200))
    whole = C.EDGE * depth + text
    data = [(whole[i : i + depth], whole[i + depth]) for i in range(len(text))]
    kept = {0: {b""}, 1: {b"a", b"c"}, 2: {b"ba", b"bc"}}
    counts = Counter((d, c[depth - d :], s) for c, s in data for d in range(depth + 1) if c[depth - d :] in kept[d])
    rows = [(d, int.from_bytes(c), s, n) for (d, c, s), n in counts.items()]
    tree = C.ContextTree.weighted(*map(np.array, zip(*rows, strict=True)))

    def weighted(context, own, prefix):
        bits = [format(s, "08b") for _, s in own]
        bits = [b[len(prefix)] for b in bits if b.startswith(prefix)]
        here, d = kt(bits.count("0"), bits.count("1")), len(context)
        if d == depth or context not in kept[d]:
            return here
        product, rest = 1.0, own
        for child in (c for c in kept[d + 1] if c[1:] == context):
            product *= weighted(child, [x for x in rest if x[0][depth - d - 1 :] == child], prefix)
            rest = [x for x in rest if x[0][depth - d - 1 :] != child]
        return here / 2 + product * weighted(b"?" * depth, rest, prefix) / 2

    for context in (b"??", b"?a", b"?c", b"ba", b"bc"):
        for byte in b"abz\xff":
            code, bits = format(byte, "08b"), 0.0
            for k in range(8):
                more = [*data, (context, byte)]
                bits -= math.log2(weighted(b"", more, code[:k]) / weighted(b"", data, code[:k]))
            got = tree.costs(np.array([int.from_bytes(context + bytes([byte]))], np.uint64))[0, 0]
            assert got == pytest.approx(bits, abs=1e-4)


def test_contexts_are_weighted_whole(monkeypatch):
    monkeypatch.setattr(C, "WEIGHED", 20)
    rng = np.random.default_rng(1)
    context = np.sort(rng.integers(0, 12, 300))
    codes = (rng.permutation(300) << 24 | context << 8).astype(np.int64)
    batches = [pa.RecordBatch.from_arrays([codes[k : k + 7], codes[k : k + 7] % 5], names=["gram", "n"]) for k in range(0, 300, 7)]
    parts = list(C._whole_contexts(iter(batches)))
    contexts = [set((grams >> np.uint64(8) & np.uint64(65535)).tolist()) for grams, _ in parts]
    assert len(parts) > 5 and sum(map(len, contexts)) == len(set.union(*contexts)) == len(set(context.tolist()))
    assert sorted(zip(*(np.concatenate(v).tolist() for v in zip(*parts)))) == sorted(zip(codes.tolist(), (codes % 5).tolist()))


@pytest.mark.parametrize("nodes", [1, 1 << 20])
def test_every_context_takes_part(spark, nodes):
    """Costs behind all contexts, as of one tree in memory, however few are broadcast."""
    rng = random.Random(5)
    texts = ["".join(rng.choices("aab c", k=60)) for _ in range(30)] + ["", "zz unseen \u20ac", "\u20ac aab" * 9]
    learned = [i for i in range(len(texts)) if i % 7 != 2 and i != 31]
    data = [(w[i : i + 5], w[i + 5]) for k in learned for w in [C.EDGE * 5 + C.body_of(texts[k].encode())] for i in range(len(w) - 5)]
    counts = Counter((d, c[5 - d :], s) for c, s in data for d in range(6))
    rows = [(d, int.from_bytes(c), s, n) for (d, c, s), n in counts.items()]
    tree = C.ContextTree.weighted(*map(np.array, zip(*rows, strict=True)))
    found = C.scores(docs(spark, texts), F.col("doc_id").isin(learned), nodes=nodes).collect()
    for r in found:
        body = C.EDGE * 5 + C.body_of(texts[r.doc_id].encode())
        codes = np.array([int.from_bytes(body[i : i + 6]) for i in range(len(body) - 5)], np.uint64)
        assert r.score == pytest.approx(-tree.costs(codes).sum() * math.log10(2), rel=1e-5)


@pytest.mark.parametrize("frequent", [2, 10**6])
def test_base_scores(spark, frequent):
    texts = ["the cat sat", "The dog sat sat", "unseen words", None, "a b c the"]
    rows = {r.doc_id: r for r in C.scores(docs(spark, texts), F.col("doc_id") != 2, nodes=50, frequent=frequent).collect()}
    tokens = [(t or "").lower().split() for t in texts]
    count = Counter(w for i, own in enumerate(tokens) if i != 2 for w in own)
    total, distinct = count.total() + 4, len(count) + 1
    for i, own in enumerate(tokens):
        logs = [math.log10((count[w] + 1) / (total + distinct + 1)) for w in own] + [math.log10(5 / (total + distinct + 1))]
        assert rows[i].base_score == pytest.approx(sum(logs))
        assert (rows[i].n_tokens, rows[i].n_known) == (len(own) + 1, sum(w in count for w in own) + 1)
        assert rows[i].train_tokens == total and rows[i].score < 0


def test_context_tree_fits_seen_text_better(spark):
    rows = QUERIES["op9_context_tree_weighting"](spark, SF)
    mean = rows.groupBy("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.avg("bits_per_byte").alias("m")).collect()
    for r in mean:
        assert r.m < 3.2 and r.s < 0 and r.b < 0


def test_learning_nothing(spark):
    row = C.scores(docs(spark, ["ab"]), F.lit(False)).first()
    assert row.score == pytest.approx(-3 * 8 * math.log10(2)) and row.base_score == 0 and row.n_known == 0
