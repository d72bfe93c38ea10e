"""Every operator against brute force, and on awkward tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from meterlens.llm import bpe, gbt, jaccard, langid, lm, packing, pii, quality, topk, toxicity, urlfilter
from meterlens.llm.bytebpe import public_path
from meterlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start string, ids string"

LONG = " ".join(f"w{i % 997} x{i}" for i in range(30_000))
AWKWARD = [
    (1, "Mail a.b@c.example.org or +1 (999) 555-0101, card 4111 1111 1111 1111.", "en", "s0"),
    (2, None, None, None), (3, "", "en", "s0"), (4, " \n\t ", "en", "s0"),
    (5, "the same words over and over again here", "en", "s0"), (6, "the same words over and over again here", "en", "s0"),
    (7, "The SAME words over and over again HERE", "de", "s1"), (None, "no id at all", "en", "s0"),
    (9, LONG, "fr", "s0"), (10, "a" * 50_000, "es", "s0"), (11, "1" * 30_000 + "@" * 2000, "es", "s0"),
    (12, "İé\u00a0x\u0301 <|endoftext|> <|startoftext|>\u2003中文\U0001f600", "fr", "s2"),
    (5, "the same words over and over again here", "en", "s0"), (14, "one", "en", "s0"), (15, "one", "en", "s0"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, a, s, None if t is None else len(t), "clash", "clash") for i, t, a, s in AWKWARD]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (None, 0, 1), (5, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")


def by_id(df):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r.doc_id].append(r)
    return out


def words(text):
    return (text or "").encode().split()


# ---- 1 ------------------------------------------------------------------------------
def test_bpe_equals_the_library(spark, docs, empty):
    t = Tokenizer.from_file(public_path(bpe.WORD_BPE))
    got = by_id(bpe.encode_decode(docs))
    assert sum(map(len, got.values())) == len(AWKWARD)
    for i, text, *_ in AWKWARD:
        ids = t.encode(text or "", add_special_tokens=False).ids
        for r in got[i]:
            assert r.ids == " ".join(map(str, ids)) and r.n_tokens == len(ids)
            assert r.decoded == t.decode(ids, skip_special_tokens=False)
    assert bpe.encode_decode(empty).count() == 0


def test_bpe_decode_join(spark):
    t = Tokenizer.from_file(public_path(bpe.WORD_BPE))
    texts = ["Hello, big world!", "", "don't <|endoftext|> x"]
    ids = [t.encode(x, add_special_tokens=False).ids for x in texts]
    rows = spark.createDataFrame(list(enumerate(ids)), "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode_ids(rows, bpe.pieces(spark)).collect()}
    assert got == {i: t.decode(x, skip_special_tokens=False) for i, x in enumerate(ids)}


# ---- 2 ------------------------------------------------------------------------------
def brute_pii(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_pii_base_spans_equal_brute_force():
    rnd, model = random.Random(1), pii.PiiModel(None, {})
    for _ in range(8000):
        text = "".join(rnd.choice("a.@-+1 (2)90é%=") for _ in range(rnd.randint(0, 40)))
        assert model.spans(text)[0] == brute_pii(text), text


def test_pii_query_and_redaction(spark, docs, empty):
    model = pii.fit_pii(spark.read.parquet(f"{SF}/documents.parquet"))
    got = by_id(pii.find_pii(docs, model))
    assert [got[1][0][f"n_{k}"] for k in pii.BASE_KINDS] == [1, 0, 1, 1]
    assert got[2][0].spans == got[3][0].spans == ""
    new = by_id(pii.redact(docs, model))
    assert new[1][0].text == "Mail [EMAIL] or [PHONE], card [CARD]." and new[1][0].n_chars == len(new[1][0].text)
    assert new[2][0].text is None and new[5][0].text == AWKWARD[4][1] and new[1][0].start == "clash"
    assert pii.find_pii(empty, pii.fit_pii(empty)).count() == 0 and pii.redact(empty, model).count() == 0


def planted_pii(n=300):
    rnd = random.Random(2)
    d = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))
    h = lambda k: "".join(rnd.choice("abcdefghjkmnpqrstuvwxyz23456789") for _ in range(k))
    for _ in range(n):
        yield f"Please phone 4{d(2)}-5{d(2)}-{d(4)} or write to a{d(3)}@b.example.org, +44 20 7946 0{d(3)}."
        yield f"Made on {d(2)}.{d(2)}.20{d(2)}0 in lots of {d(3)} and {d(5)}, see item/{h(16)} for more."
        yield f"The old password=q{h(9)}7 works, build: r{d(6)} does not."


def test_pii_adds_numbers_and_secrets_outside_the_base_rules(spark):
    model = pii.fit_pii(spark.createDataFrame([(t,) for t in planted_pii()], "text string").repartition(3))
    assert set(model.thresholds) == set(pii.ADDED_KINDS)
    assert model.redact("You may phone 415-555-0172 now.") == "You may phone [NUMBER] now."
    assert model.redact("Use password=hunter2xyz8 at 10:45.") == "Use password=[SECRET] at 10:45."
    kept = "Made on 11.12.20210 in lots of 345."
    assert model.redact(kept) == kept
    # a span that overlaps a base span is not fitted on, a base span calibrates nothing
    text = "phone +44 20 7946 0123 or 415-555-0172"
    assert [(text[a:b], y, base) for _, a, b, y, base in pii._fitting(text, pii.base_matches(text))] == [
        ("+44 20 7946 0123", 1, 1), ("415-555-0172", 1, 0)]


def test_pii_secrets_need_no_number_elsewhere(spark):
    texts = [*planted_pii(), *(f"my password: {w}horse{w}" for w in ("correct", "purple", "little", "brown") for _ in range(60))]
    model = pii.fit_pii(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    assert model.redact("Use password=hunterx2 then.") == "Use password=[SECRET] then."
    assert model.redact("Use password: correcthorse then.") == "Use password: [SECRET] then."
    assert model.redact("The note: correcthorse then.") == "The note: correcthorse then."
    assert pii.candidates("password=hunter", []) == [("secret", 9, 15, 1)]


def test_pii_sample_counts_distinct_candidates(spark):
    once = list(planted_pii())
    a, b = (pii.fit_pii(spark.createDataFrame([(t,) for t in x], "text string").repartition(3), limit=400)
            for x in (once, once + once[:30] * 60))
    assert a.thresholds and a.thresholds == b.thresholds and np.array_equal(a.trees.value, b.trees.value)


# ---- 3 ------------------------------------------------------------------------------
def test_langid_fuses_evidence(spark, docs, empty):
    langs, logp = langid.count_trigrams(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = [(1, "http://a.example.fr/x", "<html lang='fr'><body></body></html>"), (2, None, None),
            (3, "x", ""), (4, "http://b.example.de/", "<html><p>der die das und nicht ein Wort mit schönen Umlauten für Straßen</p></html>"),
            (None, "http://a.example.fr/", "<html lang=\"fr\">" + "le la les des une dans " * 4000)] + [
            (10 + i, "http://a.example.fr/y", "<html lang=fr><p>que les vaux de la leur aux êtres</p></html>") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in langid.identify(langid.page_evidence(pages), langs, logp).collect()}
    assert len(got) == len(rows)
    # no text: host and declaration decide
    assert got[1].text_lang is None and got[1].lang == got[10].lang and got[1].declared == "fr"
    assert all(0 < r.posterior <= 1 + 1e-9 for r in got.values())
    assert langid.identify(langid.page_evidence(pages.limit(0)), langs, logp).count() == 0
    none, nothing = langid.count_trigrams(empty)
    assert {r.lang for r in langid.identify(langid.page_evidence(pages), none, nothing).collect()} == {None}


def test_langid_on_pages(spark):
    got = QUERIES["op3_langid"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url"), "page_id").collect()
    right = sum(r.lang == re.search(r"example\.[a-z]+/([a-z]+)/", r.url)[1] for r in got)
    assert right >= 0.98 * len(got)


# ---- 4 ------------------------------------------------------------------------------
def test_packing_is_gapless_and_equals_the_library(spark, docs, empty):
    t = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    pieces = packing.pack(docs, with_ids=True)
    rows = pieces.collect()
    at = collections.defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) > 0
        at[r.sequence_id].append((r.offset, r.length))
    for seq, parts in at.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == 2048 or seq == max(at)
    docs_ids = sorted(t.encode(x or "", add_special_tokens=False).ids + [1] for _, x, *_ in AWKWARD)
    whole, cur = [], []
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        cur += r.ids
        if len(cur) == r.doc_tokens:
            whole.append(cur)
            cur = []
    assert sorted(whole) == docs_ids
    seqs = packing.sequences(pieces).collect()
    assert all(len(r.ids) == 2048 or len(r.ids) & (len(r.ids) - 1) == 0 for r in seqs)
    assert packing.pack(empty).count() == 0


# ---- 5 ------------------------------------------------------------------------------
def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = (QUERIES["op5_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
           .filter("held_out").select("toxic", "predicted").collect())
    hit = [r.predicted for r in got if r.toxic == 1]
    wrong = [r.predicted for r in got if r.toxic == 0]
    assert sum(hit) >= 0.9 * len(hit) and sum(wrong) <= 0.03 * len(wrong)


def test_toxicity_awkward(spark, docs, empty, labels):
    full, lab = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(full, lab)
    got = by_id(toxicity.score_toxicity(docs, model))
    assert sum(map(len, got.values())) == len(AWKWARD)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for x in got.values() for r in x)
    assert got[2][0].score == got[3][0].score == got[4][0].score
    assert got[9][0].held_out == (zlib.crc32(b"9") % 4 == 2)
    none = toxicity.fit_toxicity(docs, labels)
    assert {r.score for x in by_id(toxicity.score_toxicity(docs, none)).values() for r in x} == {0.0}
    assert toxicity.score_toxicity(empty, model).count() == 0 and toxicity.keep_ordinary(docs, none).count() == len(AWKWARD)


# ---- 6 ------------------------------------------------------------------------------
URLS = ["http://A.Example.NET/en/x?q#f", "https://net/", "http://net", "x://example.com/de/", "http://q.example.com/dex/",
        "http://b.org/fr/1", "http://xnet/", "http://evilexample.net/en/", None, "", "no scheme.net/", "a://b://c.net/x",
        "http://" + "l." * 3000 + "net/" + "p/" * 5000, "http://É.net/É", "http://a.net?x/y"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_url_rules(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(urlfilter, "BROADCAST_RULES", -1)
    pages = spark.createDataFrame([(i, u, "c") for i, u in enumerate(URLS)] + [(None, URLS[0], "c"), (0, URLS[0], "c")],
                                  "page_id long, url string, host string")
    got = urlfilter.judge_urls(pages, urlfilter.rule_table(spark)).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        url = URLS[r.page_id or 0] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), h + p, v) for h, p, v in urlfilter.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best[1], best[2])


# ---- 7 ------------------------------------------------------------------------------
def test_lm_gradients_and_normalisation():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 50, 300)
    starts = np.array([0, 100, 101, 300])
    net = lm.Attention.fresh(np.bincount(ids, minlength=lm.END_ID + 1).astype(float), np.arange(lm.END_ID + 1) % 2 == 0, rng)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    before, after = net.slot[lm.shifted(ids, starts)], net.slot[ids]
    index, valid, scored = lm.windows(starts)
    assert scored.sum() == 300 and sorted(index[:, lm.BACK:][scored]) == list(range(300))
    args = (before[index], valid, after[index][:, lm.BACK:], scored)
    loss, grad = net.gradients(*args)
    for name in ("emb", "pos", "q", "k", "v", "o", "w1", "w2", "wc", "bm"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        step = 1e-5
        net.w[name][at] += step
        up = net.gradients(*args)[0]
        net.w[name][at] -= 2 * step
        down = net.gradients(*args)[0]
        net.w[name][at] += step
        assert abs((up - down) / (2 * step) - grad[name][at]) < 1e-4 * max(1, abs(grad[name][at])), name
    # a place's probabilities over the vocabulary sum to one, and later ids don't matter
    z = net.states(*args[:2])[-1][scored][:1]
    slots = np.arange(lm.CLASSES * lm.MEMBERS)
    assert abs(np.exp(net.head(np.repeat(z, len(slots), 0), slots)[0]).sum() - 1) < 1e-6
    first, _ = net.log_probs(lm.shifted(ids, starts), ids, starts)
    # scoring is the training pass without what only gradients need
    assert -first.mean() == pytest.approx(loss, rel=1e-5)
    ids2 = ids.copy()
    ids2[200:] = 3
    again, _ = net.log_probs(lm.shifted(ids2, starts), ids2, starts)
    assert np.allclose(first[:200], again[:200])


def test_lm_tokens_have_mass_of_at_most_one():
    """All words of up to seven ids over two that begin and two that continue, after the
    same context, the end, and the two other parts of the mixture."""
    rng = np.random.default_rng(3)
    begins = np.zeros(lm.END_ID + 1, bool)
    begins[[10, 11, lm.END_ID]] = True
    counts = np.zeros(lm.END_ID + 1)
    counts[[10, 11, 20, 21, lm.END_ID]] = 9e6, 5e6, 3e6, 2e6, 1e6
    net = lm.Attention.fresh(counts, begins, rng)
    net.w = {k: v + rng.normal(0, 0.2, v.shape).astype(np.float32) if k not in ("bm", "bc") else v for k, v in net.w.items()}
    words = [(a, *rest) for a in (10, 11) for n in range(7) for rest in itertools.product((20, 21), repeat=n)]
    total = 0.0
    for word in [*words, (lm.END_ID,)]:
        tokens = [(10, 20), word] + ([] if word[0] == lm.END_ID else [(lm.END_ID,)])
        ids, at = np.array(sum(tokens, ())), np.cumsum([0, *map(len, tokens)])
        starts = np.array([0, len(ids)])
        got = net.log_probs(lm.shifted(ids, starts), ids, starts)
        total += np.exp(lm.token_log_probs(*got, at, np.array([t[0] == lm.END_ID for t in tokens]))[1])
    assert 0.9 < total <= 1 + 1e-5  # longer words and ids never seen have the rest
    # three known tokens and the end share the other two parts; whatever comes next, both sum to 1
    token, starts = np.array([0, 0, 1, -1, 2, -1]), np.array([0, 4, 6])
    part = np.exp(lm.mixed(np.full(6, -np.inf), np.zeros(6), token, starts))
    want = lm.EARLIER / (lm.NETWORK + lm.SHARE + lm.EARLIER)
    assert np.allclose(part, [0, want, 0, 0, 0, 0])
    whole = np.exp(lm.mixed(np.zeros(6), np.ones(6), np.zeros(6, int), np.array([0, 6])))
    assert np.allclose(whole, 1)


def test_lm_scores(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(lm, "STEPS", 3)
    got = by_id(lm.score_texts(docs))
    lower = {i: bytes.lower((t or "").encode()).split() + [None] for i, t, *_ in AWKWARD}
    count = collections.Counter()
    for i, t, *_ in AWKWARD:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            count.update(lower[i])
    n, v = sum(count.values()), len(count)
    assert sum(map(len, got.values())) == len(AWKWARD)
    for i, rows in got.items():
        for r in rows:
            want = math.fsum(math.log10((count[w] + 1) / (n + v + 1)) for w in lower[i])
            assert r.base_score == pytest.approx(want) and r.train_tokens == n and r.n_tokens == len(lower[i])
            assert r.n_known == sum(count[w] > 0 for w in lower[i]) and math.isfinite(r.score) and r.score < 0
    assert lm.score_texts(empty).count() == 0


def test_lm_trains_on_every_window(spark, monkeypatch):
    monkeypatch.setattr(lm, "STEPS", 1)
    seen, rounds, real = [], [], lm._round
    monkeypatch.setattr(lm, "_round", lambda *a: rounds.append(real(*a)) or rounds[-1])
    monkeypatch.setattr(lm, "subword_counts", lambda *a, real=lm.subword_counts: seen.append(real(*a)) or seen[-1])
    texts = [f"common words and item{i} " * (1 + i % 40) for i in range(1200)]  # more documents than any fixed sample
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert lm.score_texts(df).count() == len(texts)
    bpe = lm._encoder((public_path("byte_bpe_50k.json"), public_path("byte_bpe_50k.tiktoken")))
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    ids = [sum((list(np.frombuffer(x, "<u2")) for x in bpe.spaced_words([w.encode() for w in t.split()])), []) + [lm.END_ID]
           for t in train]
    want = collections.Counter(x for t in ids for x in t)
    assert {i: int(n) for i, n in enumerate(seen[0]) if n} == want
    epochs = math.ceil(lm.STEPS * lm.BATCH * lm.SCORED / sum(want.values()))
    assert sum(r.n for x in rounds for r in x.select("n").collect()) == epochs * sum(-(-len(t) // lm.SCORED) for t in ids)


# ---- 8 ------------------------------------------------------------------------------
def test_quality_counts(spark, docs, empty, labels):
    model = quality.fit_quality(docs, labels)
    got = by_id(quality.judge_quality(docs, model))
    for i, text, *_ in AWKWARD:
        w, t = [x.decode() for x in words(text)], text or ""
        windows = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        twice = collections.Counter(windows)
        mark = {k for j, x in enumerate(windows) if twice[x] > 1 for k in (j, j + 1, j + 2)}
        lines = [x for x in t.split("\n") if x.encode().split()]
        r = got[i][0]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(mark))
        assert r.base_failed == (len(w) < 50 or 100 * len(mark) > 50 * len(w)) and r.kept == (not r.base_failed)
    assert quality.judge_quality(empty, model).count() == 0
    assert {r.doc_id for r in quality.keep_good(docs, model).collect()} == {9}


def test_trees_keep_monotone():
    rng = np.random.default_rng(3)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (rng.random(600) < 0.1)).astype(float)
    model = gbt.fit(x, y, monotone=[1, -1, 0], trees=25)
    grid = np.full((50, 3), 0.5)
    grid[:, 0] = np.linspace(0, 1, 50)
    assert (np.diff(model.raw(grid)) >= -1e-9).all()
    grid[:, 0], grid[:, 1] = 0.5, np.linspace(0, 1, 50)
    assert (np.diff(model.raw(grid)) <= 1e-9).all()
    assert ((model.proba(x) > 0.5) == (x[:, 0] > 0.5)).mean() > 0.9


# ---- 9 ------------------------------------------------------------------------------
def brute_components(rows, k, num, den):
    sets = {}
    for i, text in rows:
        w = [x.lower() for x in words(text)]
        s = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
        sets[i] = s
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (2, 4, 5)])
def test_jaccard_components(spark, k, num, den):
    rnd = random.Random(k)
    rows, vocab = [], [f"v{i}" for i in range(60)]
    for g in range(25):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 5, 7, 9, 14, 30, 80, 200]))]
        for _ in range(rnd.randint(1, 9)):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 25))):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(df, k, num, den).collect()}
    assert got == brute_components(rows, k, num, den)


def test_jaccard_awkward(spark, docs, empty):
    got = by_id(jaccard.similar_documents(docs, 4, 85, 100))
    assert sum(map(len, got.values())) == len(AWKWARD)
    assert {got[i][0].component_id for i in (5, 6, 7)} == {5} and got[15][0].component_id == 14
    assert [got[i][0].component_id for i in (2, 3, 4)] == [2, 3, 4] and got[None][0].component_id is None
    kept = jaccard.keep_one(docs).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id) == [1, 2, 3, 4, 5, 9, 10, 11, 12, 14]
    assert sum(r.doc_id is None for r in kept) == 1 and kept[0].start == "clash"
    assert jaccard.similar_documents(empty, 4, 85, 100).count() == 0


# ---- 10 -----------------------------------------------------------------------------
def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "TREE", 300)
    monkeypatch.setattr(topk, "BLOCK", 7)
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(0, 1, (900, 8)) + 3 * rng.normal(0, 1, (6, 8))[rng.integers(0, 6, 900)], 1)
    rows = [(i, v.tolist(), "c") for i, v in enumerate(x)]
    rows[100] = (100, None, "c")
    rows[101] = (101, [float("nan")] + [0.0] * 7, "c")
    rows[150] = (150, [None] + [0.0] * 7, "c")
    rows[102] = (102, [0.0] * 8, "c")
    rows += [(None, [1.0] * 8, "c"), (50, rows[50][1], "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(3)
    got = collections.defaultdict(list)
    for r in topk.top_k(df, df.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    good = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v, _ in rows if i is not None and v
            and all(e is not None and math.isfinite(e) for e in v)]
    want = {}
    for i, q in good:
        if i % 50 == 0:
            want[i] = sorted(((j, int(q @ v)) for j, v in good if j != i), key=lambda p: (-p[1], p[0]))[:5]
    assert got == want
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


# ---- pipeline -----------------------------------------------------------------------
def test_pipeline_stages(spark, docs, empty):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "pii", "packing"]
    at = spark.read.parquet(f"{SF}/documents.parquet")
    before = at.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, SF)
        assert out.columns == at.columns
        at = spark.createDataFrame(out.toPandas(), out.schema)
        assert at.count() <= before
        before = at.count()
    assert corpus_pipeline.run(spark, SF).select("doc_id").distinct().count() == before
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
        stage(spark, docs, SF).count()


def test_digests(spark):
    got = {r.doc_id: r for r in QUERIES["op2_pii"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in brute_pii(r.text or ""))
        assert got[r.doc_id].base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert got[r.doc_id].spans.startswith(line)


def test_block_keys_pack_and_unpack():
    rng = np.random.default_rng(1)
    key = np.sort(jaccard.bucketed(rng.integers(0, 2 ** 63, 999, dtype=np.int64).astype(np.uint64), 7))
    assert (jaccard.unpack_sorted(jaccard.pack_sorted(key)) == key.astype(np.int64)).all()
    ids = np.array([-2 ** 63, -1, 0, 5, 2 ** 63 - 1])
    assert (jaccard.unpack_numbers(jaccard.pack_numbers(ids)) == ids).all()
    assert len(jaccard.unpack_numbers(jaccard.pack_numbers(ids[:0]))) == 0


def test_pii_time_grows_with_the_text_and_credentials_stay_in():
    import time

    trees = pii.gbt.fit(np.random.default_rng(0).random((60, len(pii.FEATURES))), np.arange(60) % 2.0, trees=2)
    model = pii.PiiModel(trees, {"number": 2.0, "secret": 2.0})  # no score reaches these
    base, spans = model.spans('a token = "0123456789abcdef0123" and password: plainword')
    assert not base and spans == [("secret", 11, 31)]
    unit = 'mail a.b@c.org, call 555 123 4567, token="a1b2c3d4e5f6g7h8", id 12345-678-9012; '

    def spent(n: int) -> float:
        text, at = unit * n, time.process_time()
        assert len(model.spans(text)[1]) >= 2 * n
        return time.process_time() - at

    spent(10)
    assert spent(8_000) < 30 * spent(800)  # 64 kB, 640 kB
    long = "x9" * 400_000
    assert pii.candidate_features(long, 0, len(long))[1] == 400_000
