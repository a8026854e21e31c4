"""Personal data, WARC records, shared passages, and the stages of the pipeline."""

from __future__ import annotations

import random
import re
import time

import pytest
from conftest import WORDS, docs
from oracle import connect, differences

import corpus_pipeline
from loanweave.llm import passage_chains as C
from loanweave.llm import pii_bootstrap as P
from loanweave.llm import warc_derivatives as A
from loanweave.llm import wu_manber
from loanweave.llm.queries import ORACLES, QUERIES
from loanweave.session import stage

SF = "/root/testdata/sf0.001"
# As the contract writes them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "card":
        luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and luhn % 10 == 0
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in match.split(".")), "phone": 9 <= len(digits) <= 15}[kind]


def plain_spans(text):
    found = [(m.start(), list(PATTERNS).index(k), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m.group())]
    return [f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in sorted(found)]


def test_base_spans(spark):
    rng = random.Random(6)
    parts = ["a.b@c.de", "x@y", "@", "1.2.3.4", "1.2.3.4.5", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (234) 555-1234", "+", "é€", "0" * 30, ".", " ", "u%@d-.e.f_g@h.i", "\U0001f600"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(300)] + [None]
    rows = P.find_personal_data(docs(spark, texts), ["doc_id"]).collect()
    for r in rows:
        got = [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.base]
        assert got == plain_spans(texts[r.doc.doc_id] or ""), texts[r.doc.doc_id]


def test_contexts_discover_unseen_identifiers(spark):
    known = [f"please write mail to user{chr(97 + i % 26)}{chr(97 + i // 26)}@host.example about it" for i in range(60)]
    hidden = ["please write mail to someone@intranet about it", "a price of 12 34 is fine", "version 20 30 of it"]
    rows = {r.doc.doc_id: r.spans for r in P.find_personal_data(docs(spark, known + hidden), ["doc_id"]).collect()}
    start = hidden[0].index("someone")
    assert [(s.kind, s.start, s.end, s.base) for s in rows[60]] == [("email", start, start + len("someone@intranet"), False)]
    assert rows[61] == [] and rows[62] == [] and all(len(rows[i]) == 1 for i in range(60))


def test_contexts_discover_other_formats(spark):
    known = [f"please call +1 (555) 123-45{i} now" for i in range(10, 70)]
    hidden = ["please call 555-123-4567 now", "please call 12 34 now", "it took 555-123-4567 steps"]
    rows = {r.doc.doc_id: r.spans for r in P.find_personal_data(docs(spark, known + hidden), ["doc_id"]).collect()}
    assert [(s.kind, s.start, s.end, s.base) for s in rows[60]] == [("phone", 12, 24, False)]
    assert rows[61] == [] and all(len(rows[i]) == 1 for i in range(60))


def test_masking(spark):
    texts = ["call +1 (234) 555-1234 now", "nothing", "é a@b.co\U0001f600 1.2.3.4", None]
    rows = {r.doc_id: (r.text, r.n_chars) for r in P.mask(docs(spark, texts)).collect()}
    expected = ["call <phone> now", "nothing", "é <email>\U0001f600 <ip>"]
    assert rows == {**{i: (t, len(t)) for i, t in enumerate(expected)}, 3: (None, None)}


def test_records_are_linked_and_complete(spark):
    pages = spark.createDataFrame([(1, "http://x/", '<title>T &amp; U</title><p>a<br>b<script>no</script> &lt;c&gt; <a class="k" href="http://y/">y</a>')], "page_id int, url string, html string")
    source = A.responses(pages, "2024-01-02T03:04:05Z")
    records = A.derivatives(source, ["page_id"])
    meta, text = records.orderBy("record_type", ascending=False).collect()
    assert (meta.record_type, text.record_type, text.block) == ("metadata", "conversion", "T & U\na\nb <c> y")
    assert meta.refers_to == text.refers_to == source.first().record_id
    assert meta.concurrent_to == text.record_id and text.concurrent_to == meta.record_id
    assert "outlink: http://y/ L a/@href\r\n" in meta.block and "title: T & U\r\n" in meta.block
    assert "source-header: Content-Type: text/html; charset=utf-8\r\n" in meta.block and meta.source_payload_digest in meta.block
    for raw in [r.w for r in records.select(A.written(records).alias("w")).collect()]:
        head, body = raw.split("\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
        assert head.startswith("WARC/1.1\r\n") and body.endswith("\r\n\r\n")
        assert int(fields["Content-Length"]) == len(body[:-4].encode()) and fields["WARC-Refers-To"] == meta.refers_to


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_agree_with_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


@pytest.mark.parametrize("seed", range(5))
def test_chains_are_the_best_ones(seed):
    rng = random.Random(seed)
    matches = sorted({(rng.randrange(40), rng.randrange(40)) for _ in range(60)})
    best: dict = {}
    for x, y in matches:
        before = [best[u, v] - C.GAP_COST * (x - u + y - v) for u, v in best if u < x and v < y]
        best[x, y] = C.K + max([0, *before])
    import numpy as np

    found = C.chains(np.array([m[0] for m in matches]), np.array([m[1] for m in matches]))
    worth = lambda c: sum(C.K for _ in c) - sum(C.GAP_COST * (x - u + y - v) for (u, v), (x, y) in zip(c, c[1:], strict=False))
    assert worth(found[0]) == pytest.approx(max(best.values()))
    assert sorted(m for c in found for m in c) == matches
    assert all(u < x and v < y for c in found for (u, v), (x, y) in zip(c, c[1:], strict=False))


def test_planted_passages_are_found(spark):
    rng = random.Random(11)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, other = fresh(60), fresh(120)
    fuzzy = [w if i % 25 else f"new{i}" for i, w in enumerate(other)]
    texts = [fresh(200) for _ in range(12)]
    for d, at in ((1, 30), (4, 0), (5, 200), (9, 77)):
        texts[d][at:at] = passage
    texts[2][50:50] = other
    texts[7][10:10] = fuzzy
    texts[10] = texts[11][:]
    texts[3][0:0] = passage[:30]
    rows = C.shared_passages(docs(spark, [" ".join(t).capitalize() + "." for t in texts])).collect()
    pairs = {(r.doc_id, r.other_doc_id) for r in rows}
    assert {d for pair in pairs for d in pair} == {1, 4, 5, 9, 2, 7, 10, 11}
    assert (7, 2) in pairs and (11, 10) in pairs
    # Each is tied to an earlier one: the first in its task or over all.
    assert all(any(a == d and b in (1, 4, 5) for a, b in pairs) for d in (4, 5, 9))
    for r in rows:
        own, far = texts[r.doc_id][r.start_word : r.end_word], texts[r.other_doc_id][r.other_start_word : r.other_end_word]
        assert r.identity >= 0.8 and len(own) >= 50 and len(far) >= 50
        if r.doc_id in (4, 5, 9):
            assert own == far == passage


@pytest.mark.parametrize(("words", "apart", "more"), [(60, 60, 0), (60, 90, 0), (60, 120, 30), (100, 100, 0), (100, 200, 40)])
def test_passages_with_unrelated_text_between_are_two(spark, words, apart, more):
    rng = random.Random(words + apart + more)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    one, two = fresh(words), fresh(words)
    texts = [fresh(50) + one + fresh(apart + k * more) + two + fresh(50) for k in range(2)]
    rows = C.shared_passages(docs(spark, [" ".join(t) for t in texts])).collect()
    assert sorted(texts[1][r.start_word : r.end_word] for r in rows) == sorted([one, two])
    assert all(texts[0][r.other_start_word : r.other_end_word] == texts[1][r.start_word : r.end_word] and r.identity == 1 for r in rows)


def test_partners_that_are_not_alike_both_stay(spark):
    rng = random.Random(4)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    whole = fresh(400)
    one, two = ([w if i % 7 != k else f"new{k}n{i}" for i, w in enumerate(whole)] for k in (6, 2))
    rows = C.shared_passages(docs(spark, [" ".join(t) for t in (one, two, whole)]).coalesce(1)).collect()
    # 6 of 7 words agree with each of the two, which agree with each other in 5 of 7.
    assert {(r.doc_id, r.other_doc_id) for r in rows} == {(2, 0), (2, 1)}
    assert all(r.end_word - r.start_word > 350 for r in rows)


@pytest.mark.parametrize("parts", [1, 2, 6])
def test_a_passage_is_found_behind_shorter_ones_that_hold_its_seeds(spark, parts):
    rng = random.Random(5)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = fresh(68)
    texts = [fresh(100) + piece + fresh(100) for piece in (passage[:49], passage[19:], passage, fresh(9), fresh(9), passage)]
    # Every seed is first in one of the first two, which share 49 words with the others. Once more behind other pieces.
    texts += [fresh(100) + passage[:40] + fresh(100), fresh(100) + passage + fresh(100)]
    frame = docs(spark, [" ".join(t) for t in texts]).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    rows = C.shared_passages(frame).collect()
    whole = {(r.doc_id, r.other_doc_id) for r in rows if texts[r.doc_id][r.start_word : r.end_word] == passage}
    assert {d for d, _ in whole} == {5, 7} and whole <= {(5, 2), (7, 5), (7, 2)}


@pytest.mark.parametrize("parts", [1, 3])
def test_copies_are_tied_to_the_smallest_id_only(spark, parts):
    rng = random.Random(9)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    copied, shared = fresh(90), fresh(60)
    kinds = [copied + shared, fresh(120), shared + fresh(80)]
    texts = [" ".join(kinds[k]) + end for k, end in ((1, ""), (0, "."), (0, " !"), (2, ""), (0, ""), (0, "\n"), (1, "?"))]
    rows = C.shared_passages(docs(spark, texts).repartition(parts)).collect()
    copies = sorted((r.doc_id, r.other_doc_id, r.start_word, r.end_word, r.other_end_word, r.n_equal, r.identity) for r in rows if r.copy)
    assert copies == [(2, 1, 0, 150, 150, 150, 1.0), (4, 1, 0, 150, 150, 150, 1.0), (5, 1, 0, 150, 150, 150, 1.0), (6, 0, 0, 120, 120, 120, 1.0)]
    (passage,) = (r for r in rows if not r.copy)
    assert {passage.doc_id, passage.other_doc_id} == {1, 3} and passage.n_equal == 60


def test_first_holders_are_staged_without_repeated_columns(spark, monkeypatch):
    staged, stage = {}, C.stage
    monkeypatch.setattr(C, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    rng = random.Random(3)
    passage = " ".join(f"w{rng.randrange(10**6)}" for _ in range(80))
    assert C.shared_passages(docs(spark, [f"a {passage}", f"b {passage} c"])).count() == 1
    for name in ("seed-ties", "window-ties"):
        rows = staged[name].where("kind = 0")
        assert rows.count() and rows.where("other IS NOT NULL OR y IS NOT NULL OR row IS NULL OR x IS NULL").isEmpty()
        assert staged[name].where("kind = 1 AND (other IS NULL OR y IS NULL)").isEmpty()


def test_equal_windows_have_equal_hashes_and_seed_places():
    import numpy as np

    rng = np.random.default_rng(2)
    common = rng.integers(0, 2**16, 70).astype(np.uint64)
    found = []
    for n in (13, 57):
        words = np.concatenate([rng.integers(0, 2**16, n).astype(np.uint64), common, rng.integers(0, 2**16, 30).astype(np.uint64)])
        codes, places = C.minimizers(words)
        hashes, at = C.exact_windows(words, codes, places, codes)
        assert len(hashes) == len(words) - C.LEAST_WORDS + 1
        found.append(dict(zip(hashes.tolist(), (at - n).tolist(), strict=True)))
    same = found[0].keys() & found[1].keys()
    assert len(same) == 70 - C.LEAST_WORDS + 1 and all(found[0][h] == found[1][h] for h in same)


@pytest.mark.parametrize(("identity", "least"), [(0.85, 0.4), (0.9, 0.8), (0.95, 0.95)])
def test_recall_on_planted_passages_is_as_written(identity, least):
    import numpy as np

    rng = np.random.default_rng(1)
    fresh = lambda n: rng.integers(0, 2**63, n, dtype=np.uint64)
    found = 0
    for _ in range(60):
        passage = fresh(100)
        edited = passage.copy()
        places = rng.choice(np.arange(1, 99), round((1 - identity) * 100), replace=False)
        edited[places] = fresh(len(places))
        a, b = (np.concatenate([fresh(150), p, fresh(150)]) for p in (passage, edited))
        (codes, x), (others, y) = C.minimizers(a), C.minimizers(b)
        _, i, j = np.intersect1d(codes, others, return_indices=True)
        rows = [row for chain in C.chains(x[i], y[j]) for row in C.stretches(a, b, chain)]
        found += any(min(row[1], 250) - max(row[0], 150) >= 80 for row in rows)
    assert found >= 60 * least


def test_longest_good_parts_of_a_chain():
    import numpy as np

    fresh = iter(range(10**6))
    take = lambda n: [next(fresh) for _ in range(n)]
    # Runs of 40 words, 12 new ones between (identity 80/92), far from 70 words; and 45 words alone, which are too few.
    parts = [take(40), take(40), take(70), take(45)]
    a, b = ([*parts[0], *take(12), *parts[1], *take(150), *parts[2], *take(n), *parts[3]] for n in (300, 310))
    x = [a.index(p[k]) for p in parts for k in (0, 30)]
    y = [b.index(p[k]) for p in parts for k in (0, 30)]
    found = C.stretches(np.array(a), np.array(b), list(zip(x, y, strict=True)))
    assert found == [(0, 92, 0, 92, 80), (242, 312, 242, 312, 70)]


def expanded(rows):
    return {(s + t * k, e + t * k, *more) for s, e, *more, t, n in rows for k in range(n)}


@pytest.mark.parametrize("seed", range(6))
def test_series_are_aligned_as_one_match_after_the_other(seed):
    import numpy as np

    rng = random.Random(seed)
    fresh = lambda n: [rng.randrange(50, 10**4) for _ in range(n)]
    seen = 0
    for _ in range(60):
        period = [rng.randrange(50) for _ in range(rng.choice([1, 2, 3, 7, 12]))]
        edges = fresh(20), fresh(20)
        around = lambda n, side: fresh(n) + edges[side] * rng.randrange(2) if side == 0 else edges[side] * rng.randrange(2) + fresh(n)
        texts = [around(rng.choice([0, 70]), 0) + (period * 400)[: rng.choice([30, 60, 90, 200, 400])] + around(rng.choice([0, 70]), 1) for _ in range(2)]
        a, b = (np.array(t) for t in texts)
        key = (period * C.K)[: C.K]
        x, y = ([k for k in range(len(t)) if t[k : k + C.K] == key] for t in texts)
        for chain in C.series([(k, rng.choice([y[0], y[-1]])) for k in x]):
            if len(chain) == 1:
                continue
            own, other = np.array([k for k, _ in chain]), chain[0][1]
            found, alike = C.aligned_series(a, b, own, other)
            single = [C.aligned(a, b, [(k, other)]) for k in own.tolist()]
            assert found.tolist() == [list(whole) for whole in single]
            parts = {tuple(p) for k, whole in zip(own.tolist(), single, strict=True) for p in C.stretches(a, b, [(k, other)], whole)}
            # Without those inside another one; of equal ones in the own text any may stay.
            longest = {p[:2] for p in parts if not any(q[:2] != p[:2] and q[0] <= p[0] and q[1] >= p[1] for q in parts)}
            rows = C.repeated(a, b, own, other, found, alike)
            assert expanded(rows) <= parts and {p[:2] for p in expanded(rows)} == longest and len(rows) <= 12
            seen += len(rows)
    assert seen


def test_repeated_words_give_few_rows_for_all_their_passages(spark):
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = [fresh(60) + ["spam", "eggs"] * 45 + fresh(60), fresh(150) + ["spam", "eggs"] * 450 + fresh(150)]
    rows = C.shared_passages(docs(spark, [" ".join(t) for t in texts]).coalesce(1)).collect()
    assert {(r.doc_id, r.other_doc_id) for r in rows} == {(1, 0)} and len(rows) <= 3
    passages = expanded([(r.start_word, r.end_word, r.other_start_word, r.other_end_word, r.step, r.repeats) for r in rows])
    assert {(u, u + 90, 60, 150) for u in range(150, 961, 2)} <= passages
    assert all(texts[1][u:v] == texts[0][a:b] for u, v, a, b in passages)


def test_windows_meet_by_their_smallest_seed(spark, monkeypatch):
    staged, stage = {}, C.stage
    monkeypatch.setattr(C, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    rng = random.Random(12)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = fresh(200)
    frame = docs(spark, [" ".join(fresh(80) + passage[k:] + fresh(80)) for k in range(0, 40, 4)]).repartitionByRange(5, "doc_id")
    found = []
    # With very many shares every seed of several rows is dealt window by window.
    for shares in (C.SHARES, 10**9):
        monkeypatch.setattr(C, "SHARES", shares)
        staged.clear()
        found.append(sorted(map(str, C.shared_passages(frame).collect())))
        firsts = staged["window-ties"].where("kind = 0")
        # One row per place of a seed, not one per window.
        assert firsts.count() == firsts.select("row", "x").distinct().count()
        assert firsts.selectExpr("sum(size(windows)) / count(*) AS n").first().n > 5
    assert found[0] == found[1] and found[0]


def test_stages_of_the_pipeline(spark):
    frames = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, function in corpus_pipeline.STAGES[:-1]:
        frames.append(stage(function(spark, frames[-1], SF), name))
    start, known, single, clean, masked = ([r.asDict() for r in f.collect()] for f in frames)
    assert all(f.columns == frames[0].columns for f in frames)
    assert len(known) >= 0.98 * sum(bool(r["text"]) for r in start)
    groups = QUERIES["op6_simhash_gray_index"](spark, SF).collect()
    ids = {r["doc_id"] for r in known}
    if len(ids) == len(start):
        assert {r["doc_id"] for r in single} == {r.component_id for r in groups}
    finders = wu_manber.searches([(str(r.item_id), r.text.encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    keep = set()
    for r in single:
        words = wu_manber.words_of(r["text"].encode())
        hit = {k for finder in finders for a, b, _ in finder.find(words) for k in range(a, b)}
        if not (hit and 20 * len(hit) >= len(words)):
            keep.add(r["doc_id"])
    assert {r["doc_id"] for r in clean} == keep
    assert len(masked) == len(clean)
    for r in masked:
        assert plain_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
    pieces = corpus_pipeline.STAGES[-1][1](spark, frames[-1], SF).collect()
    assert {p.doc_id for p in pieces} == {r["doc_id"] for r in masked}


def test_patterns_are_linear_in_unbroken_runs(spark):
    """A megabyte without white space, and matches that lie side by side."""
    texts = ["a" * 1_000_000 + "@", "1" * 1_000_000, "x.y@z " + "b" * 500_000, "a@b.c_d@e.f..g@h-.i%j@k.l", "1.2.3.4.5.6.7.8 1.2.3.4"]
    start = time.time()
    found = P.find_personal_data(docs(spark, texts), ["text"]).collect()
    assert time.time() - start < 60
    spans = {r.doc.text[:30]: [(s["kind"], s["start"], s["end"]) for s in r.spans if s["base"]] for r in found}
    for text in texts[3:]:
        for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")):
            wanted = [(kind, m.start(), m.end()) for m in re.finditer(pattern, text)]
            assert [s for s in spans[text[:30]] if s[0] == kind] == wanted
