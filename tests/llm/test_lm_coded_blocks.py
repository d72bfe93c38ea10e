"""The language model splits and spells a text once, and all rounds and the scoring read that."""

from __future__ import annotations

import numpy as np
import pytest

from meterlens.llm import lm
from meterlens.llm.bytebpe import public_path
from meterlens.llm.util import unpack_bytes

PATHS = (public_path("byte_bpe_50k.json"), public_path("byte_bpe_50k.tiktoken"))
TEXTS = ["Some words and some more words", None, "", " \t\n", "ünïcode WORDS 漢字 and\x0bmore", "x" * 300] + [
    f"text{i} again and again " * (1 + i % 50) for i in range(300)]


def test_rounds_read_spelt_blocks(spark, monkeypatch):
    monkeypatch.setattr(lm, "STEPS", 1)
    read, real = [], lm._round
    monkeypatch.setattr(lm, "_round", lambda *a: read.append(a[0]) or real(*a))
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    assert lm.score_texts(df).count() == len(TEXTS)
    assert len(read) >= lm.ROUNDS and "texts" not in read[0].columns
    bpe, got = lm._encoder(PATHS), {}
    for r in read[0].collect():
        starts, token = lm._numbers(r.starts, "<i8"), lm._numbers(r.tokens, "<i4")
        ids, at = lm.id_stream(token, unpack_bytes(r.spelt))
        got |= {d: ids[at[a]:at[z]].tolist() for d, a, z in zip(r.doc_ids, starts, starts[1:])}
    for i, t in enumerate(TEXTS):
        words = bytes.lower((t or "").encode()).split()
        assert got[i] == [int(x) for w in bpe.spaced_words(words) for x in np.frombuffer(w, "<u2")] + [lm.END_ID]


def test_scores_do_not_depend_on_runs_of_texts(spark, monkeypatch):
    """A block's texts are scored in runs of some PLACES; untrained weights make the scores comparable."""
    monkeypatch.setattr(lm, "fit_network", lambda blocks, counts, paths: lm.Attention.fresh(
        counts, lm.beginning(paths[0]), np.random.default_rng(7)))
    texts = [*TEXTS, *(f"a{i % 3} b c{i % 2} " * (lm.PLACES // 8) for i in range(5)), "end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one, many = ({r.doc_id: r for r in lm.score_texts(x).collect()} for x in (df.coalesce(1), df.repartition(8)))
    assert one.keys() == many.keys() == set(range(len(texts)))
    for i, r in one.items():
        assert r[:5] == many[i][:5] and r.n_tokens == len((texts[i] or "").encode().split()) + 1
        assert r.base_score == pytest.approx(many[i].base_score) and r.score == pytest.approx(many[i].score, rel=1e-5)
    assert sum(r.n_tokens for r in one.values()) > 2 * lm.PLACES
    runs = list(lm.spans(np.array([0, lm.PLACES, lm.PLACES + 1, 4 * lm.PLACES, 4 * lm.PLACES])))
    assert runs == [(0, 1), (1, 2), (2, 3), (3, 4)]


def test_passes_equal_plain_attention():
    """The folded weights and the column of ones against softmax attention as it is written down."""
    rng = np.random.default_rng(5)
    ids, starts = rng.integers(0, 60, 200), np.array([0, 3, 90, 200])
    net = lm.Attention.fresh(np.bincount(ids, minlength=lm.END_ID + 1).astype(float), np.arange(lm.END_ID + 1) % 2 == 0, rng)
    w = net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    before, after = net.slot[lm.shifted(ids, starts)], net.slot[ids]
    index, valid, scored = lm.windows(starts)
    z = net.states(before[index], valid)[-1]
    got = net.head(z[scored], after[index[:, lm.BACK:][scored]])[0]
    for row, (places, use) in enumerate(zip(index, valid)):
        e = w["emb"][before[places]] + w["pos"]
        for j in np.flatnonzero(scored[row]):
            keys = [k for k in range(lm.BACK + j + 1) if use[k]]
            s = e[keys] @ w["k"] @ (e[lm.BACK + j] @ w["q"]) * lm.DIM ** -0.5
            a = np.exp(s - s.max())
            h = e[lm.BACK + j] + a / a.sum() @ (e[keys] @ w["v"]) @ w["o"]
            assert np.allclose(z[row, j], h + np.maximum(h @ w["w1"] + w["b1"], 0) @ w["w2"])
    flat, y = z[scored], after[index[:, lm.BACK:][scored]]
    c, m = np.divmod(y, lm.MEMBERS)
    step = lambda x: x - np.log(np.exp(x).sum(-1, keepdims=True))
    want = [step(v @ w["wc"] + w["bc"])[i] + step(v @ w["wm"][i] + w["bm"][i])[k] for v, i, k in zip(flat, c, m)]
    assert np.allclose(got, want)
