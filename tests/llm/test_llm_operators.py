"""Every operator against a plain version, and on odd rows."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from llm_rows import odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import decontaminate, fingerprint, lm_score, ngram_join, packing, phrases, pii, quality, sharding, toxicity


def by_id(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}


# ---- 1: personal data -------------------------------------------------------------


def test_base_spans(docs, rows):
    got = by_id(pii.find_personal(docs))
    assert any(r["n_email"] for r in got.values()) and any(r["n_card"] for r in got.values())
    for doc, text, *_ in rows:
        spans = brute.personal(text)
        said = ",".join(f"{k}:{a}:{b}" for k, s in spans.items() for a, b in s)
        r = got[doc]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [len(s) for s in spans.values()]
        assert r["base_sha256"] == brute.sha(said)
        assert r["spans"].startswith(said)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@-+ ()0123459é", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    want = [(k, a, b) for k, s in brute.personal(text).items() for a, b in s]
    assert pii.base_spans(text) == want


def test_terms_that_disclose_an_entity(spark):
    rows = [(i, f"note {i} from zorblax alpha{i} mail boss@corp.example beta{i} ok", "en", "s", 1) for i in range(6)]
    rows += [(100 + i, f"plain text {i} with common words from anyone ok mail note", "en", "s", 1) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = by_id(pii.find_personal(df))
    for i in range(6):
        text = rows[i][1]
        a = text.index("zorblax")
        assert got[i]["n_term"] == 1 and got[i]["spans"].endswith(f"term:{a}:{a + 7}")
    assert all(got[100 + i]["n_term"] == 0 for i in range(60))
    clean = by_id(pii.sanitised(df))
    assert "zorblax" not in clean[0]["text"] and "boss@" not in clean[0]["text"] and "[EMAIL]" in clean[0]["text"]
    assert clean[100]["text"] == rows[6][1]


def test_one_footer_under_different_texts_discloses(spark):
    foot = "this note was sent to you by our friend zorblax boss@corp.example of the house on the hill beyond the river"
    rows = [(i, f"body{i} {'word ' * i}other{i} {foot}") for i in range(1, 7)] + [(50 + i, f"quux boss2@corp.example copy {foot}") for i in range(3)]
    rows += [(100 + i, f"plain text {i} this note was sent") for i in range(60)] + [(200 + i, "lone copy vendrell one@corp.example") for i in range(3)]
    clean = by_id(pii.sanitised(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert all("zorblax" not in clean[i]["text"] for i in range(1, 7))
    assert clean[200]["text"] == "lone copy vendrell [EMAIL]"  # copies of one text support nothing


@pytest.mark.parametrize("flagged", [100_000, 0])
def test_disclosing_terms_against_all_pairs(spark, rows, flagged, monkeypatch):
    monkeypatch.setattr(pii, "FLAGGED", flagged)
    foot = "this note was sent by our friend zorblax boss@corp.example or +49 (30) 123-4567"
    every = [(r[0], r[1]) for r in rows] + [(10_000 + i, f"body{i} {'word ' * (i % 7)}other{i} {foot}") for i in range(40)] + [(None, foot), (None, foot), (10_000, None)]
    every += [(20_000 + i, f"note sent {i} kindly to house of +4930{1234567 + i % 2} near tower{i % 2} ok") for i in range(12)]
    got = pii.find_personal(spark.createDataFrame(every, "doc_id bigint, text string").repartition(3)).collect()
    order = lambda x: (x[0] is not None, x[0] or 0, x[1])
    want = sorted(((d, ",".join(s)) for (d, _), s in zip(every, brute.disclosed(every), strict=True)), key=order)
    assert sorted(((r["doc_id"], r["spans"]) for r in got), key=order) == want
    assert sum("term" in s for _, s in want) > 40


# ---- 2: n-gram Jaccard join -------------------------------------------------------


@pytest.mark.parametrize(("n", "num", "block"), [(4, 85, 2048), (5, 80, 2048), (2, 60, 3), (4, 85, 2), (1, 50, 5)])
def test_join(docs, rows, n, num, block):
    want = brute.near_copies([(r[0], r[1]) for r in rows], n, num, 100)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_join(docs, n, num, 100, block).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)


def test_rows_of_one_id_and_rows_without_an_id_are_searched_by_their_texts(spark):
    text = lambda x, w: " ".join([f"{x}{i}" for i in range(100)] + [w])
    rows = [(5, text("a", "x")), (5, text("b", "x")), (9, text("a", "y")), (10, text("b", "y"))]
    rows += [(3, text("c", "x")), (None, text("c", "y")), (None, text("d", "x")), (None, text("d", "y"))]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(0, 0), (0, 0), (0, 3), (3, 3), (5, 5), (5, 5), (9, 5), (10, 5)]


def test_of_rows_with_one_id_only_near_copies_go(spark):
    text = lambda x, w: " ".join([f"{x}{i}" for i in range(100)] + [w])
    rows = [(5, text("a", "x"), 1), (5, text("b", "x"), 1), (5, text("b", "x"), 1), (9, text("a", "y"), 1), (None, text("b", "y"), 1), (None, text("c", "x"), 1), (7, None, 1), (7, None, 1)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id bigint, text string, n bigint").withColumn("doc", F.create_map(F.lit("k"), F.lit(1)))
    kept = ngram_join.one_of_each(df).collect()
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:1]) for r in kept) == [(0, "c"), (5, "a"), (5, "b"), (7, ""), (7, "")]


def test_divide_skip_finds_all_with_enough_overlap():
    r = random.Random(3)
    for _ in range(60):
        sets = sorted((np.unique(np.array([r.randrange(40) for _ in range(r.randint(1, 30))], np.uint64)) for _ in range(25)), key=len)
        links = list(ngram_join.links_within(sets, [0] * len(sets), 60, 100))
        up = list(range(len(sets)))

        def find(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in links:
            k = len(np.intersect1d(sets[a], sets[b]))
            assert 100 * k >= 60 * (len(sets[a]) + len(sets[b]) - k)
            up[find(a)] = find(b)
        for a in range(len(sets)):
            for b in range(a):
                k = len(np.intersect1d(sets[a], sets[b]))
                if 100 * k >= 60 * (len(sets[a]) + len(sets[b]) - k):
                    assert find(a) == find(b)


def test_one_document_of_each_group_stays(docs, rows):
    want = brute.near_copies([(r[0], r[1]) for r in rows], 5, 80, 100)
    got = sorted(r["doc_id"] for r in ngram_join.one_of_each(docs).collect())
    assert got == sorted(d for d, (n, c) in want.items() if n == 0 or c == d)


# ---- 3: packing -------------------------------------------------------------------


def test_packing_keeps_all_words_and_every_constraint(docs, rows):
    got = packing.pack(docs, capacity=100, n_cells=2).collect()
    words = Counter()
    used, sources, clusters = Counter(), defaultdict(list), defaultdict(list)
    for r in got:
        words[r["doc_id"]] += r["piece_words"]
        if r["bin"] is not None and r["piece_words"] < 100:
            used[r["bin"]] += r["piece_words"]
            sources[r["bin"]].append(r["source"])
    texts = {r[0]: " ".join((r[1] or "").lower().split()) for r in rows}
    for r in got:
        if r["bin"] is not None and r["piece_words"] < 100:
            clusters[r["bin"]].append(texts[r["doc_id"]])
    assert words == Counter({r[0]: len((r[1] or "").split()) for r in rows})
    assert max(used.values()) <= 100
    for b in used:
        assert len(set(sources[b])) == len(sources[b]) and len(set(clusters[b])) == len(clusters[b])


def test_ids_come_out_as_they_went_in(spark):
    ids = [(1 << 60) + 1, (1 << 60) + 3, None, None, 7, 7]
    df = spark.createDataFrame([(d, f"text number {i}", "s") for i, d in enumerate(ids)], "doc_id bigint, text string, source string")
    got = [r["doc_id"] for r in packing.pack(df, n_cells=1).collect()]
    assert Counter(got) == Counter(ids)
    named = packing.pack(df.withColumn("doc_id", df["doc_id"].cast("string")), n_cells=2).collect()
    assert Counter(r["doc_id"] for r in named) == Counter(None if d is None else str(d) for d in ids)


def test_the_tightest_compatible_bin_is_chosen():
    r = random.Random(5)
    for _ in range(50):
        rows = [(r.randint(1, 30), r.randrange(4), r.randrange(12)) for _ in range(60)]
        got = packing.pack_cell(*zip(*rows, strict=True), capacity=30)
        bins: dict = {}
        for row, _, b, n in got:
            size, source, cluster = rows[row]
            fits = {k: v for k, v in bins.items() if v[0] >= size and source not in v[1] and cluster not in v[2]} if size < 30 else {}
            if fits:
                assert b in fits and fits[b][0] == min(v[0] for v in fits.values())
            else:
                assert b not in bins
            left, s, c = bins.get(b, (30, frozenset(), frozenset()))
            bins[b] = (left - n, s | {source}, c | {cluster})


# ---- 4: decontamination -----------------------------------------------------------


@pytest.mark.parametrize("block", [8_000_000, 100])
def test_decontamination(docs, rows, items, block):
    held = [(r["item_id"], r["text"]) for r in items.collect() if r["item_id"] is not None]
    nameless = [(None, r["text"]) for r in items.collect() if r["item_id"] is None]
    want = brute.leaks([(r[0], r[1]) for r in rows], held + nameless)
    got = by_id(decontaminate.decontaminate(docs, items, block_chars=block))
    named = brute.leaks([(r[0], r[1]) for r in rows], held)
    for d, w in want.items():
        g = got[d]
        assert (g["n_words"], g["n_hit"], g["contaminated"]) == (w[0], w[1], w[4])
        assert (g["n_items"], g["items_sha256"]) == (named[d][2], named[d][3])
    assert any(w[4] for w in want.values())
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()}
    assert kept == {d for d, w in want.items() if not w[1]}
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(docs, items, percent=5).collect()}
    assert kept == {d for d, w in want.items() if not w[4]}


def test_a_window_in_a_long_text_is_dropped(spark):
    said = " ".join(f"item{i}" for i in range(13))
    long = " ".join(f"word{i}" for i in range(3000))
    df = spark.createDataFrame([(1, f"{long} {said} {long}"), (2, long), (3, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, said)], "item_id bigint, text string")
    assert not by_id(decontaminate.decontaminate(df, bench))[1]["contaminated"]
    assert {r["doc_id"] for r in decontaminate.drop_contaminated(df, bench).collect()} == {2, 3}


# ---- 5: language model ------------------------------------------------------------


def test_base_scores_are_exact_at_any_cut(docs, rows):
    want = brute.token_scores([(r[0], r[1]) for r in rows])
    for common in (1 << 19, 20, 0):
        got = by_id(lm_score.score(docs, common=common))
        for d, w in want.items():
            g = got[d]
            assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == w[:4]
            assert g["base_score"] == pytest.approx(w[4], rel=1e-9)
            assert g["score"] < 0


def test_scores_are_those_of_exact_powers_of_two(docs, rows):
    """A false bit of the filter can only change the few rows that meet it."""
    want = brute.model_scores([(r[0], r[1]) for r in rows])
    got = {d: r["score"] for d, r in by_id(lm_score.score(docs)).items()}
    off = [abs(got[d] - w) / (1 + abs(w)) for d, w in want.items()]
    assert sorted(off)[int(0.9 * len(off))] < 1e-9 and max(off) < 0.05


def test_a_filter_of_many_parts_gives_the_scores_of_one(docs, monkeypatch):
    want = {d: r["score"] for d, r in by_id(lm_score.score(docs)).items()}
    monkeypatch.setattr(lm_score, "MAX_BITS", 1 << 16)  # a sixteenth of what the corpus asks for
    got = {d: r["score"] for d, r in by_id(lm_score.score(docs)).items()}
    assert got == pytest.approx(want, rel=1e-12)


def test_filter_levels():
    from quire.llm import _counts

    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64))
    counts = np.arange(len(keys)) % 40 + 1
    f = _counts.LogFilter(np.zeros(1 << 16, np.uint8), 64, 2, 24)
    seg, rest = f.split(keys)
    for level in range(1, 7):
        m = np.floor(np.log2(counts)) + 1 >= level
        for slot in f._slots(rest[m], level):
            p = seg[m] * np.uint64(f.slice) + slot
            np.bitwise_or.at(f.data, p >> np.uint64(3), (1 << (p & np.uint64(7))).astype(np.uint8))
    got = f.levels(keys)
    want = np.floor(np.log2(counts)) + 1
    assert (got >= want).all() and (got == want).mean() > 0.97
    more = pack_round_trip(_counts, keys, counts)
    assert more == counts.sum()


def pack_round_trip(counts_module, keys, counts) -> int:
    batch = counts_module.pack(keys, counts.astype(np.int64), 64)
    total = 0
    for k, m in zip(batch["keys"].to_pylist(), batch["more"].to_pylist(), strict=True):
        total += counts_module.unpack([k], [m])[1].sum()
    return int(total)


# ---- 6: sharding ------------------------------------------------------------------


def test_sharding(docs, rows):
    import zlib

    got = sharding.shard(docs).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40)
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(r["size"] == len(texts[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in got)


def test_shards_are_those_of_sql_and_balanced(spark):
    import duckdb

    df = spark.range(4000).selectExpr("id as doc_id", "'t' as text")
    got = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in sharding.shard(df).collect()}
    con = duckdb.connect()
    con.sql("create view documents as select range as doc_id, 't' as text from range(4000)")
    want = {r[0]: (r[1], r[2]) for r in con.sql(f"select doc_id, shard, grown_shard from ({sharding.oracle()})").fetchall()}
    odd = [(d, t) for d, t, *_ in odd_rows()] + [(None, f"without an id {i}") for i in range(200)]
    got_odd = sharding.shard(spark.createDataFrame(odd, "doc_id bigint, text string")).select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard").collect()
    con.execute("create or replace table odd (doc_id bigint, text varchar)")
    con.executemany("insert into odd values (?, ?)", odd)
    con.sql("create or replace view documents as select * from odd")
    order = lambda rows: sorted(tuple(-1 if x is None else x for x in r) for r in rows)
    assert order(got_odd) == order(con.sql(f"select doc_id, size, text_crc32, shard, slot, grown_shard from ({sharding.oracle()})").fetchall())
    assert got == want
    n = Counter(s for s, _ in got.values())
    assert len(n) == 40 and max(n.values()) < 2 * min(n.values())
    moved = sum(a != b for a, b in got.values())
    assert 50 < moved < 160


def test_a_changed_weight_moves_rows_only_into_its_subtree(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "'t' as text")
    old = {r["doc_id"]: r["shard"] for r in sharding.shard(df).collect()}
    new = {r["doc_id"]: r["shard"] for r in sharding.shard(df, weights={3: 3.0}).collect()}
    moved = {d for d in old if old[d] != new[d]}
    assert moved and all(new[d] < 10 for d in moved)  # the region of shard 3
    assert all(new[d] == 3 for d in moved if old[d] < 5)  # within its rack only into the shard itself


# ---- 7 and 8: classifiers ---------------------------------------------------------


def test_machine_learns_a_pair_that_weights_cannot():
    r = np.random.default_rng(2)
    x = r.integers(0, 2, (2000, 2))
    y = x[:, 0] ^ x[:, 1]
    rows = [{10 + j: 1 for j in range(2) if v[j]} | {99: 1} for v in x]
    m = toxicity.fit([np.array(list(r)) for r in rows], [np.array(list(r.values())) for r in rows], y)
    xs = np.zeros((len(rows), len(m.w)))
    for i, row in enumerate(rows):
        for k in row:
            xs[i, m.columns[k]] = np.log1p(1)
    assert ((m.score(xs) >= 0.5) == y).mean() > 0.97


def test_toxic_words_are_learnt(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    words = ["".join(r.choice("abcdefg") for _ in range(5)) for _ in range(200)]
    rows, labels = [], []
    for i in range(600):
        w = [r.choice(words) for _ in range(40)]
        bad = i % 6 == 0
        if bad:
            w[r.randrange(40)], w[r.randrange(40)] = "idiotic", "scumbag"
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, 1, int(bad)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    lb = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = by_id(toxicity.score(df, lb))
    held = [i for i in range(600) if got[i]["held_out"]]
    assert len(held) > 80 and np.mean([got[i]["predicted"] == int(i % 6 == 0) for i in held]) > 0.95


def test_scores_of_texts_are_those_of_all_pairs(docs, rows, labels):
    got = by_id(toxicity.score(docs, labels))
    m = toxicity.train(docs, labels)
    buckets = {i: b for b, i in m.columns.items()}
    w, v = {buckets[i]: x for i, x in enumerate(m.w)}, {buckets[i]: list(x) for i, x in enumerate(m.v)}
    for d, text, *_ in rows[:60]:
        want = brute.machine_score(toxicity.Terms(None).counts(text), m.w0, w, v)
        assert got[d]["score"] == pytest.approx(want, rel=1e-6, abs=1e-12) and got[d]["predicted"] == int(got[d]["score"] >= 0.5)


def test_site_posteriors_against_a_plain_version(docs, labels):
    got = quality.classify(docs, labels).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = brute.site_scores([(r["host"], r["path"], r["evidence"], bool((texts[r["doc_id"]] or "").split())) for r in got])
    for r, (host, path, score) in zip(got, want, strict=True):
        assert (r["host_mean"], r["path_mean"], r["score"]) == pytest.approx((host, path, score), rel=1e-9)
        assert r["quality"] == int(r["score"] >= 0.5)


def test_quality_follows_labels_and_shrinks_sites(spark):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        w = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(50)]
        bad = i % 4 == 0
        text = " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w).capitalize() + "."
        rows.append((i, text, "en", f"http://host{i % 3}.org/p{i % 2}/x" if i != 399 else "http://lone.org", 1))
        labels.append((i, int(not bad), 0))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    lb = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = by_id(quality.classify(df, lb))
    assert all(got[i]["quality"] == int(i % 4 != 0) for i in range(400))
    assert got[0]["host"] == "host0.org" and got[0]["path"] == "p0"
    overall = np.mean([g["evidence"] for g in got.values()])
    assert abs(got[399]["host_mean"] - overall) < 0.2  # one row says little


def test_an_id_of_very_many_rows_is_learnt_from_once(spark):
    rows = [(1, f"row {i} of one id") for i in range(10_000)] + [(i, f"text {i}") for i in range(2, 60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    lb = spark.createDataFrame([(i, i % 2, i % 3 % 2) for i in range(1, 60)], "doc_id bigint, quality int, toxic int")
    sample = toxicity.labelled_sample(df, lb, "toxic", 5, 20).collect()
    assert len(sample) <= 40 and len({r["doc_id"] for r in sample}) == len(sample)
    again = toxicity.labelled_sample(df.repartition(3), lb, "toxic", 5, 20).collect()
    assert sorted(sample) == sorted(again)
    assert toxicity.score(df, lb).count() == quality.classify(df, lb).count() == len(rows)


# ---- 9: fingerprints --------------------------------------------------------------


def _in_order(rows):
    """Rows by id, those of one id by the hash of their texts, null first."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, brute._xx(r[1] or ""), r[1] or ""))


@pytest.mark.parametrize("many", [False, True])
def test_fingerprints(spark, rows, many, monkeypatch):
    every = [(r[0], r[1]) for r in [*rows, *odd_rows()]]
    if many:  # several blocks, some of one id
        monkeypatch.setattr(fingerprint, "BLOCK_ROWS", 5)
        every += [(77, f"row {i} of one id") for i in range(60)] + [(None, f"row {i} of none") for i in range(60)] + [((1 << 60) + i % 3, f"far {i}") for i in range(9)]
    got = [tuple(r) for r in fingerprint.fingerprints(spark.createDataFrame(every, "doc_id bigint, text string")).collect()]
    want, order = [], _in_order(every)
    for i, (d, text) in enumerate(order):
        text, nxt = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + nxt[:half]
        a, b, c = (brute.order_minhash(t) for t in (text, edited, nxt))
        said = lambda s: "".join(f"{((x + 32) << 24) + v:08X}" for x, v in sorted(s))
        want.append((d, len(text), brute.sha(edited), said(a), said(b), brute.alike(a, b), brute.alike(a, c)))
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))
    assert order(got) == order(want)
    same = defaultdict(set)
    for d, text, *_ in rows:
        same[text].add(next(r[3] for r in got if r[0] == d))
    assert all(len(s) == 1 for s in same.values()) and len({next(iter(s)) for s in same.values()}) == len(same)


def test_no_exchange_to_one_partition(docs):
    plan = fingerprint.fingerprints(docs)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Python" not in plan and "Arrow" not in plan


def test_order_matters_and_occurrences_count(spark):
    w = [f"w{i}" for i in range(400)]
    a, b = " ".join(w), " ".join(w[200:] + w[:200])
    rows = [(1, a), (2, b), (3, "x y z " * 9), (4, "x y z " * 10), (5, a)]
    df = fingerprint.with_fingerprint(spark.createDataFrame(rows, "doc_id bigint, text string"), "text", "sig")
    sig = {r["doc_id"]: r["sig"] for r in df.collect()}
    assert sig[1] == sig[5] and sig[1] != sig[2] and sig[3] != sig[4]
    assert len(sig[1]) == 64


# ---- 10: repeated phrases ---------------------------------------------------------


@pytest.mark.parametrize(("window", "phrase"), [(50, 8), (9, 3)])
def test_repeats(docs, rows, window, phrase):
    want = brute.without_repeats([(r[0], r[1]) for r in rows], window)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in phrases.drop_repeats(docs, window, phrase).collect()}
    assert got == want
    assert any(w[1] for w in want.values())


def test_the_automaton_finds_what_goes():
    """Removals come through the automaton: one that finds nothing leaves all words."""
    words = b"a b c d e f g h i j".split()
    from quire.llm._words import WordHash, run_hashes

    hashes = WordHash()
    keys = run_hashes(hashes.of(words), 5)
    firsts = [(keys, np.full(6, 3), np.array([0, 0, 0, 1, 1, 1], np.uint32))]
    shard = phrases.Shard(5, 3, [b"c d e", b"g h i"], firsts)
    assert shard.locate(words).tolist() == [2, 6]
    assert shard.repeated(7, words, hashes) == [(0, 10)] and shard.repeated(3, words, hashes) == []
    # The second phrase is not confirmed: windows with the first alone go.
    shard = phrases.Shard(5, 3, [b"c d e", b"g h i"], [(keys[:3], np.full(3, 3), np.zeros(3, np.uint32))])
    assert shard.locate(words).tolist() == [2] and shard.repeated(7, words, hashes) == [(0, 7)]
    shard.locate = lambda words: np.empty(0, np.int64)
    assert shard.repeated(7, words, hashes) == []


def test_repeats_of_far_ids(spark):
    said = " ".join(f"w{i}" for i in range(60))
    ids = [-(1 << 62), 5, (1 << 62) + 1, (1 << 62) + 3, None]
    df = spark.createDataFrame([(d, f"{said} own{i}") for i, d in enumerate(ids)], "doc_id bigint, text string").coalesce(1)
    got = {r["doc_id"]: r["n_removed"] for r in phrases.drop_repeats(df).collect()}
    assert got == {d: 60 if d is not None and d > ids[0] else 0 for d in ids}


@pytest.mark.parametrize("texts", [False, True])
def test_repeats_in_many_batches(docs, rows, texts, monkeypatch):
    for name, value in (("BATCH", 40), ("SEGMENT", 8)):
        monkeypatch.setattr(phrases, name, value)
    want = brute.without_repeats([(r[0], r[1]) for r in rows], 9)
    got = phrases.drop_repeats(docs, 9, 3, texts).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == want
    if texts:
        assert all(brute.sha(r["kept_text"]) == r["kept_sha256"] for r in got)


@pytest.mark.parametrize("name", ["op1_pii", "op2_ngram_join", "op4_decontaminate", "op6_sharding", "op10_phrases"])
def test_oracles(spark, rows, items, name):
    """Operators with the queries' parameters against their SQL, on odd rows too."""
    import duckdb

    from quire.llm import queries

    foot = "sent by our friend zorblax boss@corp.example or +49 (30) 123-4567"
    every = [(r[0], r[1]) for r in [*rows, *odd_rows()] if len(r[1] or "") < 50_000]  # SQL lays out every window
    every += [(10_000 + i, f"body{i} {'word ' * (i % 7)}other{i} {foot}") for i in range(40)]
    df = spark.createDataFrame(every, "doc_id bigint, text string").repartition(3)
    run = {
        "op1_pii": pii.find_personal, "op2_ngram_join": lambda d: ngram_join.ngram_join(d, 4, 85, 100), "op4_decontaminate": lambda d: decontaminate.decontaminate(d, items.where("item_id is not null")).drop("row"),
        "op6_sharding": sharding.shard, "op10_phrases": phrases.drop_repeats,
    }[name](df)
    con = duckdb.connect()
    for table, types, values in (("documents", "doc_id bigint, text varchar", every), ("benchmark", "item_id bigint, text varchar", [tuple(r) for r in items.where("item_id is not null").collect()])):
        con.execute(f"create table {table} ({types})")
        con.executemany(f"insert into {table} values (?, ?)", values)
    cols = sorted(run.columns)
    want = con.sql(f"select {', '.join(cols)} from ({queries.ORACLES[name]})").fetchall()
    assert sorted((tuple(r) for r in run.select(cols).collect()), key=repr) == sorted(want, key=repr)


def test_tables_of_earlier_steps_are_released(spark):
    from pathlib import Path

    from quire.llm import _store
    from quire.llm._graph import components

    folder = Path(_store.shared_dir(spark).removeprefix("file://")) / "quire"
    edges = spark.range(200).selectExpr("id as a", "id + 1 as b").where("b % 50 <> 0")
    mark, before = _store.written(), set(folder.iterdir()) if folder.exists() else set()
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {i: i - i % 50 for i in range(200)}
    assert len(set(folder.iterdir()) - before) == 1 and _store.written() == mark + 1


def test_a_cluster_without_a_shared_folder_raises():
    from types import SimpleNamespace as N

    from quire.llm import _store

    unset = N(get=lambda *a: None)
    context = N(getConf=lambda: unset, getCheckpointDir=lambda: None, master="spark://somewhere:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        _store.shared_dir(N(sparkContext=context, conf=unset))
    set_ = N(get=lambda *a: "s3://bucket/shared/")
    assert _store.shared_dir(N(sparkContext=N(getConf=lambda: set_), conf=set_)) == "s3://bucket/shared"


# ---- odd rows, empty tables -------------------------------------------------------

RUNS = {
    "pii": lambda d, i, lb: pii.find_personal(d), "sanitised": lambda d, i, lb: pii.sanitised(d), "join": lambda d, i, lb: ngram_join.ngram_join(d), "one_of_each": lambda d, i, lb: ngram_join.one_of_each(d),
    "packing": lambda d, i, lb: packing.pack(d), "leaks": lambda d, i, lb: decontaminate.decontaminate(d, i), "drop_leaks": lambda d, i, lb: decontaminate.drop_contaminated(d, i), "lm": lambda d, i, lb: lm_score.score(d),
    "shards": lambda d, i, lb: sharding.shard(d), "toxicity": lambda d, i, lb: toxicity.score(d, lb), "quality": lambda d, i, lb: quality.classify(d, lb), "keep_good": lambda d, i, lb: quality.keep_good(d, lb),
    "fingerprints": lambda d, i, lb: fingerprint.fingerprints(d), "phrases": lambda d, i, lb: phrases.drop_repeats(d),
}
FILTERS = ("one_of_each", "drop_leaks", "keep_good")


@pytest.mark.parametrize("name", RUNS)
def test_odd_rows(name, odd, items, labels):
    got = RUNS[name](odd, items, labels).collect()
    n = odd.count()
    if name in FILTERS:
        assert 0 < len(got) <= n and set(got[0].asDict()) == set(odd.columns)
    elif name == "packing":
        assert {r["doc_id"] for r in got} == {r["doc_id"] for r in odd.select("doc_id").collect()}
    else:
        assert len(got) == n


@pytest.mark.parametrize("name", RUNS)
def test_empty_tables(name, empty, items, labels):
    assert RUNS[name](empty, items.limit(0), labels.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["toxicity", "quality", "keep_good", "leaks", "drop_leaks"])
def test_empty_side_tables(name, docs, rows, items, labels):
    got = RUNS[name](docs, items.limit(0), labels.limit(0))
    assert got.count() == len(rows)


def test_results_for_odd_rows(odd, items):
    one = lambda df, d: [r for r in df.collect() if r["doc_id"] == d]
    p = pii.find_personal(odd)
    assert one(p, 1_000_001)[0]["base_sha256"] == brute.sha("") and one(p, 1_000_006)[0]["n_card"] == 0
    j = ngram_join.ngram_join(odd)
    assert [(r["n_shingles"], r["component_id"]) for r in one(j, 1_000_002)] == [(0, 1_000_002)]
    assert sorted(r["n_shingles"] for r in one(j, 1_000_004)) == [1, 1, 2]
    kept = ngram_join.one_of_each(odd)
    assert len(one(kept, 1_000_004)) == 2 and len(one(kept, None)) == 1 and len(one(kept, 1_000_001)) == 1
    r = one(phrases.drop_repeats(odd), 1_000_007)[0]
    assert (r["n_words"], r["n_removed"]) == (60_000, 0)
    f = one(fingerprint.fingerprints(odd), 1_000_002)[0]
    assert f["n_chars"] == 0 and f["fingerprint"] == ""
    s = one(sharding.shard(odd), 1_000_001)[0]
    assert (s["size"], s["text_crc32"]) == (16, 0)
    b = one(packing.pack(odd), 1_000_001)[0]
    assert b["bin"] is None and b["n_words"] == 0
    assert len(odd_rows()) == 12
