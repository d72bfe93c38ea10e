"""Language-model scoring with a causal self-attention model trained in numpy.

Words ([^\\x20\\x09-\\x0D]+, A-Z lower-cased) and one end per text are the
tokens.  Each is spelt in subword ids of a public byte-level vocabulary.  One
attention layer reads the ids in windows of ``WINDOW`` that overlap by ``BACK``, so every
id is scored once, behind at least so much context; windows are batched and
masked.  Its output is a two-step softmax (class, member) over the most
frequent ids that begin a token and over those that continue one, in classes
of their own, each with an escape to a smoothed distribution of all others.
A token's network probability is that of its ids, given that a token begins,
and of a token's beginning after them: so tokens that are prefixes of one
another share no mass, and all tokens together have at most 1.  A text's probability mixes,
token by token, this with the token's share among all training tokens and its
share among the text's earlier tokens.

Texts are split and spelt once: a block of texts is written as tokens that number
its distinct words, and the subword ids of each of these.  Token and subword counts
cover all training documents: blocks send their distinct words with counts to hash
buckets, where copies of a word meet once per block; the totals return to the
blocks.  The network trains on every window of every training document: the
documents are dealt to rounds of doubling size, in a round each partition
takes steps over its own windows, and the weights are averaged in a tree.

Edge cases: null and empty texts are the end alone; null ids are in the
training fold and get a row; repeated rows get a row each (and count each);
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meterlens.llm.bpe import blocks as numbered
from meterlens.llm.bytebpe import BYTE_BPE, byte_bpe, public_path
from meterlens.llm.util import fold, mix64, pack_bytes, split_words, unpack_bytes, word_hash, written

HELD_OUT_MOD, HELD_OUT = 7, 2
END_ID = 50256
#: Rounds of an epoch; each is as large as all before it, so that weights agree before the long ones.
ROUNDS = 7
#: Windows of a step and its rate; small corpora are read again until they make STEPS steps.
STEPS, BATCH, RATE = 500, 192, 5e-3
WINDOW, BACK, DIM, HIDDEN = 32, 8, 16, 32
SCORED = WINDOW - BACK
#: Ids whose windows are laid out at a time (or one text).
PLACES = 200_000
#: Classes of the output, the first BEGIN of them for ids that begin a token.
CLASSES, BEGIN, MEMBERS = 32, 16, 64
#: Weights in the mixture: network, training tokens, earlier tokens of the text.
NETWORK, SHARE, EARLIER = 0.5, 0.3, 0.2


def in_training(doc_id: Column) -> Column:
    return fold(doc_id, HELD_OUT_MOD) != HELD_OUT


# ---- network ------------------------------------------------------------------------
@dataclass
class Attention:
    slot: np.ndarray       # vocabulary id -> class * MEMBERS + member; the first of either kind is the escape
    escape: np.ndarray     # log probability of an id behind its kind's escape
    w: dict[str, np.ndarray]

    @staticmethod
    def fresh(counts: np.ndarray, begins: np.ndarray, rng: np.random.Generator) -> Attention:
        """``begins`` tells which ids begin a token."""
        slot, escape = np.zeros(len(counts), np.int64), np.zeros(len(counts))
        for kind, first, classes in ((begins, 0, BEGIN), (~begins, BEGIN * MEMBERS, CLASSES - BEGIN)):
            ids = np.flatnonzero(kind)
            head = ids[np.argsort(-counts[ids], kind="stable")][: classes * MEMBERS - 1]
            head = head[counts[head] > 0]
            slot[ids] = first
            slot[head] = first + np.arange(1, len(head) + 1)
            rest = np.where(slot[ids] == first, counts[ids] + 0.1, 0)
            with np.errstate(divide="ignore"):
                escape[ids] = np.log(rest / max(rest.sum(), 0.1))
        norm = lambda *s: rng.normal(0, s[0] ** -0.5, s).astype(np.float32)
        w = {"emb": rng.normal(0, 0.3, (CLASSES * MEMBERS, DIM)).astype(np.float32),
             "pos": rng.normal(0, 0.1, (WINDOW, DIM)).astype(np.float32),
             "q": norm(DIM, DIM), "k": norm(DIM, DIM), "v": norm(DIM, DIM), "o": norm(DIM, DIM),
             "w1": norm(DIM, HIDDEN), "b1": np.zeros(HIDDEN, np.float32), "w2": norm(HIDDEN, DIM),
             "wc": norm(DIM, CLASSES), "bc": np.zeros(CLASSES, np.float32),
             "wm": rng.normal(0, DIM ** -0.5, (CLASSES, DIM, MEMBERS)).astype(np.float32),
             "bm": np.zeros((CLASSES, MEMBERS), np.float32)}
        hits = np.zeros(CLASSES * MEMBERS)
        np.add.at(hits, slot, counts)
        hits = (hits + 0.1).reshape(CLASSES, MEMBERS)
        w["bm"] = np.log(hits / hits.sum(1, keepdims=True)).astype(np.float32)
        w["bc"] = np.log(hits.sum(1) / hits.sum()).astype(np.float32)
        return Attention(slot, escape, w)

    def states(self, ids: np.ndarray, valid: np.ndarray) -> tuple:
        """Hidden states of the last SCORED places of each window; ``valid`` masks keys.

        The weights of queries and keys, and of values and output, are multiplied
        first, and embeddings carry a column of ones (zeros where nothing is): its
        share of the values is the attention's sum, by which only they are divided."""
        w = self.w
        e = np.empty((*ids.shape, DIM + 1), w["emb"].dtype)
        np.add(w["emb"].take(ids, axis=0), w["pos"], out=e[..., :DIM])
        e[..., DIM] = 1
        if not valid.all():
            e[~valid] = 0
        half = e[:, BACK:, :DIM].reshape(-1, DIM)
        t = (half @ (w["q"] @ w["k"].T * e.dtype.type(DIM ** -0.5))).reshape(-1, SCORED, DIM)
        s = t @ e[..., :DIM].transpose(0, 2, 1)
        np.clip(s, -60, 60, out=s)
        np.exp(s, out=s)
        s *= _SEEN
        x = (s @ e).reshape(-1, DIM + 1)
        total = x[:, DIM:]
        x = x[:, :DIM] / total
        h = half + x @ (w["v"] @ w["o"])
        r = h @ w["w1"]
        r += w["b1"]
        np.maximum(r, 0, out=r)
        return e, half, t, s, x, total, h, r, (h + r @ w["w2"]).reshape(t.shape)

    def head(self, z: np.ndarray, slots: np.ndarray) -> tuple:
        """Log probabilities of ``slots`` after states ``z``, and what gradients need:
        the order of classes with its edges, and in it states with a column of ones,
        classes, members, and the exponentials of both steps with their sums."""
        w, n = self.w, len(z)
        order = np.argsort((slots // MEMBERS).astype(np.uint8), kind="stable")
        c, m = np.divmod(slots[order], MEMBERS)
        edge = np.searchsorted(c, np.arange(CLASSES + 1))
        one = np.empty((n, DIM + 1), z.dtype)
        one[:, :DIM] = z.take(order, axis=0)
        one[:, DIM] = 1
        pc_ = one @ np.vstack([w["wc"], w["bc"]])
        pm = np.empty((n, MEMBERS), z.dtype)
        wm = np.concatenate([w["wm"], w["bm"][:, None]], axis=1)
        for i in range(CLASSES):
            if edge[i] < edge[i + 1]:
                np.matmul(one[edge[i]:edge[i + 1]], wm[i], out=pm[edge[i]:edge[i + 1]])
        np.clip(pc_, -60, 60, out=pc_)
        np.clip(pm, -60, 60, out=pm)
        row = np.arange(n)
        got = pc_[row, c] + pm[row, m]
        np.exp(pc_, out=pc_)
        np.exp(pm, out=pm)
        tc, tm = pc_ @ np.ones(CLASSES, z.dtype), pm @ np.ones(MEMBERS, z.dtype)
        got -= np.log(tc) + np.log(tm)
        out = np.empty_like(got)
        out[order] = got
        return out, order, edge, one, c, m, pc_, tc, pm, tm

    def gradients(self, ids, valid, target, scored) -> tuple[float, dict[str, np.ndarray]]:
        w = self.w
        e, half, t, s, x, total, h, r, z = self.states(ids, valid)
        use = np.flatnonzero(scored)
        logp, order, edge, one, c, m, pc_, tc, pm, tm = self.head(z.reshape(-1, DIM).take(use, axis=0), target[scored])
        n, g = len(use), {}
        row = np.arange(n)
        # exponentials less their sum at the target, over the sum, are the gradient of the logits
        pc_[row, c] -= tc
        pm[row, m] -= tm
        tc, tm = (1 / (n * tc))[:, None], (1 / (n * tm))[:, None]
        both = (one * tc).T @ pc_
        g["wc"], g["bc"] = both[:DIM], both[DIM]
        g["wm"], g["bm"] = np.zeros_like(w["wm"]), np.zeros_like(w["bm"])
        dflat, over = np.empty((n, DIM), z.dtype), one * tm
        for i in range(CLASSES):
            a, b = edge[i], edge[i + 1]
            if a < b:
                both = over[a:b].T @ pm[a:b]
                g["wm"][i], g["bm"][i] = both[:DIM], both[DIM]
                np.matmul(pm[a:b], w["wm"][i].T, out=dflat[a:b])
        dflat *= tm
        dflat += pc_ @ w["wc"].T * tc
        dz = np.zeros_like(half)
        dz[use[order]] = dflat
        g["w2"] = r.T @ dz
        dr = dz @ w["w2"].T
        dr *= r > 0
        g["w1"], g["b1"] = h.T @ dr, np.ones(len(dr), dr.dtype) @ dr
        dh = dz + dr @ w["w1"].T
        vo = x.T @ dh
        g["v"], g["o"] = vo @ w["o"].T, w["v"].T @ vo
        dx = np.empty((len(dh), DIM + 1), dh.dtype)
        dx[:, :DIM] = dh @ (w["v"] @ w["o"]).T / total
        dx[:, DIM] = -np.einsum("ij,ij->i", dx[:, :DIM], x)
        dx = dx.reshape(*t.shape[:2], DIM + 1)
        ds = dx @ e.transpose(0, 2, 1)
        ds *= s
        scale = e.dtype.type(DIM ** -0.5)
        dt = (ds @ e[..., :DIM]).reshape(-1, DIM)
        qk = half.T @ dt * scale
        g["q"], g["k"] = qk @ w["k"], qk.T @ w["q"]
        de = s.transpose(0, 2, 1) @ dx[..., :DIM] + ds.transpose(0, 2, 1) @ t
        de[:, BACK:] += (dh + dt @ (w["k"] @ w["q"].T * scale)).reshape(t.shape)
        if not valid.all():
            de[~valid] = 0
        g["pos"] = de.sum(0)
        g["emb"] = np.zeros_like(w["emb"])
        order = np.argsort(ids.astype(np.uint16), axis=None, kind="stable")
        seen = ids.ravel()[order]
        first = np.flatnonzero(np.diff(seen, prepend=-1))
        g["emb"][seen[first]] = np.add.reduceat(de.reshape(-1, DIM).take(order, axis=0), first)
        return float(-logp.mean()), g

    def log_probs(self, before: np.ndarray, after: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural log probabilities of each id ``after`` the ids ``before`` it, and
        of a token beginning there; ``starts`` are the texts' first places and the end."""
        out, begin = np.zeros(len(after)), np.zeros(len(after))
        for text, last in spans(starts):
            a, b = int(starts[text]), int(starts[last])
            index, valid, scored = windows(starts[text:last + 1] - a)
            slots_in, slots_out = self.slot[before[a:b]], self.slot[after[a:b]]
            for at in range(0, len(index), 512):
                i, use = index[at:at + 512], scored[at:at + 512]
                z = self.states(slots_in[i], valid[at:at + 512])[-1]
                place = a + i[:, BACK:][use]
                got, order, _, _, _, _, p, total, _, _ = self.head(z[use], slots_out[place - a])
                out[place], begin[place[order]] = got, np.log(p[:, :BEGIN] @ np.ones(BEGIN, p.dtype) / total)
            rare = np.flatnonzero((slots_out == 0) | (slots_out == BEGIN * MEMBERS))
            out[a + rare] += self.escape[after[a:b][rare]]
        return out, begin


_SEEN = (np.arange(WINDOW)[None, :] <= np.arange(BACK, WINDOW)[:, None]).astype(np.float32)


def spans(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts, first and behind the last, of some PLACES places each (or one
    text); they bound the memory."""
    text = 0
    while text < len(starts) - 1:
        last = max(text + 1, int(np.searchsorted(starts, starts[text] + PLACES, side="right")) - 1)
        yield text, last
        text = last


def windows(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places in the stream, which exist, which of the last SCORED are scored).
    A text's windows advance by SCORED places; each place is scored once."""
    size = np.diff(starts)
    count = -(-size // SCORED)
    text = np.repeat(np.arange(len(size)), count)
    turn = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    place = (turn * SCORED - BACK)[:, None] + np.arange(WINDOW)
    valid = (place >= 0) & (place < size[text][:, None])
    index = np.where(valid, place + starts[:-1][text][:, None], 0)
    return index, valid, valid[:, BACK:]


@dataclass
class State:
    """What a round starts from and leaves: weights, Adam's moments, steps taken."""
    w: dict[str, np.ndarray]
    m: dict[str, np.ndarray]
    v: dict[str, np.ndarray]
    step: int = 0

    @staticmethod
    def fresh(w: dict[str, np.ndarray]) -> State:
        return State(w, *[{k: np.zeros_like(x) for k, x in w.items()} for _ in range(2)])

    def pack(self) -> np.ndarray:
        return np.concatenate([x.ravel() for part in (self.w, self.m, self.v) for x in part.values()])

    def unpack(self, flat: np.ndarray, step: int) -> State:
        at, parts = 0, []
        for part in (self.w, self.m, self.v):
            parts.append({})
            for k, x in part.items():
                parts[-1][k] = flat[at:at + x.size].reshape(x.shape).astype(np.float32)
                at += x.size
        return State(*parts, step)

    def update(self, g: dict[str, np.ndarray], rate: float) -> None:
        self.step += 1
        rate *= min(1.0, self.step / 20) / (1 - 0.9 ** self.step)
        soft = np.float32((1 - 0.98 ** self.step) ** -0.5)
        for k, x in self.w.items():
            m, v = self.m[k], self.v[k]
            m *= np.float32(0.9)
            m += np.float32(0.1) * g[k]
            v *= np.float32(0.98)
            v += np.square(np.float32(0.02 ** 0.5) * g[k])
            root = np.sqrt(v)
            root *= soft
            root += np.float32(1e-8)
            x -= np.float32(rate) * np.divide(m, root, out=root)


def train(model: Attention, state: State, ids: np.ndarray, starts: np.ndarray, rate, rng: np.random.Generator) -> int:
    """One pass in random order over all windows of a stream (each text ends with
    END_ID); ``rate`` maps the windows done to the rate.  Returns the windows."""
    before, after = model.slot[shifted(ids, starts)], model.slot[ids]
    index, valid, scored = windows(starts)
    done = 0
    for pick in np.array_split(rng.permutation(len(index)), max(1, round(len(index) / BATCH))):
        i = index[pick]
        _, g = model.gradients(before[i], valid[pick], after[i][:, BACK:], scored[pick])
        state.update(g, rate(done))
        done += len(pick)
    return done


def shifted(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The id before each place; END_ID before a text's first."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[starts[:-1]] = END_ID
    return before


# ---- texts to token and id streams --------------------------------------------------
def coded_blocks(docs: DataFrame, paths: tuple[str, str], buckets: int) -> DataFrame:
    """``block, doc_ids, starts, tokens, words, spelt``: texts as token starts and
    tokens, which are numbers of the block's distinct words (-1: a text's end); the
    words, in the order of their hash buckets, and the subword ids of each."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(paths)
        for block, b in numbered(batches):
            starts, at, words = split_words(b.column("text"), lower=True)
            order = np.argsort(_bucket(words, buckets), kind="stable")
            words, number = words.take(pa.array(order)), np.empty(len(order), np.int32)
            number[order] = np.arange(len(order), dtype=np.int32)
            token = np.insert(number[at], starts[1:], -1)
            ids = b.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays([ids])),
                 _packed(starts + np.arange(len(starts)), "<i8"), _packed(token, "<i4"), pa.array([pack_bytes(words)], pa.binary()),
                 pa.array([pack_bytes(pa.array(bpe.spaced_words(words.to_pylist()), pa.binary()))], pa.binary())],
                ["block", "doc_ids", "starts", "tokens", "words", "spelt"])

    return (docs.select("doc_id", "text")
                .mapInArrow(code, f"block long, doc_ids array<{kind}>, starts binary, tokens binary, words binary, spelt binary"))


def _bucket(words: pa.Array, buckets: int) -> np.ndarray:
    return (word_hash(words) % np.uint64(buckets)).astype(np.int32)


def _packed(x: np.ndarray, kind: str) -> pa.Array:
    return pa.array([zstandard.compress(x.astype(kind).tobytes(), 1)], pa.binary())


def _numbers(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), kind)


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """One row at a time, as a row is a block."""
    for b in batches:
        for row in range(b.num_rows):
            yield tuple(b.column(c)[row].as_py() for c in columns)


def id_stream(token: np.ndarray, spelt: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of a stream of tokens, id starts of each token and the end); ``spelt``
    has the ids of each token's number, and -1 is the end."""
    spelt = pa.concat_arrays([spelt, pa.array([np.array([END_ID], "<u2").tobytes()], pa.binary())])
    got = spelt.take(pa.array(np.where(token < 0, len(spelt) - 1, token)))
    _, offsets, data = got.buffers()
    ends = np.frombuffer(offsets, np.int32)[: len(token) + 1].astype(np.int64) // 2
    return np.frombuffer(data, "<u2")[: ends[-1]].astype(np.int32) if len(token) else np.zeros(0, np.int32), ends


def _encoder(paths: tuple[str, str]):
    return byte_bpe(*paths)


def _round(blocks: DataFrame, model: Attention, state: State, cut: tuple[float, float],
           done: tuple[float, float], expected: float, seed: int) -> DataFrame:
    """``part, n, step, state``: each partition's state after its windows of the
    texts whose place hash lies in ``cut``, and how many windows these were.
    ``done`` is the share of all training before and after the round, and
    ``expected`` a partition's likely windows; both set the rate only."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        mine = state.unpack(state.pack(), state.step)
        here = Attention(model.slot, model.escape, mine.w)
        rng = np.random.default_rng([seed, part])

        def rate(seen: int) -> float:
            return RATE * (1 - 0.9 * (done[0] + (done[1] - done[0]) * min(1.0, (n + seen) / expected)))

        for block, train_, starts, token, spelt in _rows(batches, "block", "train", "starts", "tokens", "spelt"):
            turn = mix64((np.uint64(block) << np.uint64(20)) + np.arange(len(train_), dtype=np.uint64)) / 2.0 ** 64
            use = np.flatnonzero(np.array(train_, dtype=bool) & (turn >= cut[0]) & (turn < cut[1]))
            if not len(use):
                continue
            use, starts = rng.permutation(use), _numbers(starts, "<i8")
            first, size = starts[use], np.diff(starts)[use]
            starts = np.append(0, np.cumsum(size))
            place = np.arange(starts[-1]) + np.repeat(first - starts[:-1], size)
            ids, ends = id_stream(_numbers(token, "<i4")[place], unpack_bytes(spelt))
            starts = ends[starts]
            for text, last in spans(starts):
                a, z = int(starts[text]), int(starts[last])
                n += train(here, mine, ids[a:z], starts[text:last + 1] - a, rate, rng)
        if n:
            yield _state_row(part, n, mine.step, mine.pack())

    return blocks.select("block", "train", "starts", "tokens", "spelt").mapInArrow(fit, _STATE)


_STATE = "part int, n long, step long, state binary"


def _state_row(part: int, n: int, step: int, flat: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([step], pa.int64()),
                                       pa.array([flat.astype("<f4").tobytes()], pa.binary())], ["part", "n", "step", "state"])


def _average(rows: pa.Table) -> pa.Table:
    """One row of many: states weighted by their windows, in the order of ``part``."""
    rows, total = rows.sort_by("part"), 0.0
    n = rows.column("n").to_pylist()
    for k, x in zip(n, rows.column("state")):
        total = total + k / sum(n) * np.frombuffer(x.as_py(), "<f4").astype(np.float64)
    return pa.Table.from_batches([_state_row(rows.column("part")[0].as_py(), sum(n), max(rows.column("step").to_pylist()), total)])


def beginning(json_path: str) -> np.ndarray:
    """Which subword ids begin a token: those that spell a leading space, and the end."""
    out = np.zeros(END_ID + 1, bool)
    with open(json_path, encoding="utf-8") as f:
        for piece, id_ in json.load(f)["model"]["vocab"].items():
            out[id_] = piece.startswith("\u0120")  # the byte-level alphabet's sign for a space
    out[END_ID] = True
    return out


def token_log_probs(logp: np.ndarray, begin: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Log probability of each token from those of its ids, which start at ``at``;
    ``end`` marks the tokens that end a text, after which none begins."""
    if not len(end):
        return np.zeros(0)
    first = begin[at[:-1]]
    return np.add.reduceat(logp, at[:-1]) - first + np.where(end, 0.0, np.append(first[1:], 0.0))


def mixed(network: np.ndarray, share: np.ndarray, token: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Log probability of each token: the network's, its ``share`` of the training
    tokens (None: there are none) and of the text's earlier tokens."""
    size = np.diff(starts)
    if not len(token):
        return np.zeros(0)
    place = np.arange(len(token)) - np.repeat(starts[:-1], size)
    group = np.repeat(np.arange(len(size)), size) * (int(token.max()) + 2) + token + 1
    order = np.argsort(group, kind="stable")
    new = np.append(True, np.diff(group[order]) != 0)
    run = np.flatnonzero(new)[np.cumsum(new) - 1]
    seen = np.empty(len(token))
    seen[order] = np.arange(len(token)) - run
    w_share = 0.0 if share is None else SHARE
    w_early = np.where(place > 0, EARLIER, 0.0)
    other = (0.0 if share is None else w_share * share) + w_early * seen / np.maximum(place, 1)
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log(NETWORK) + network, np.log(other)) - np.log(NETWORK + w_share + w_early)


def fit_network(blocks: DataFrame, counts: np.ndarray, paths: tuple[str, str]) -> Attention:
    """Train on all windows of all training documents in ``blocks``; ``counts``
    are these documents' subword ids."""
    model = Attention.fresh(counts, beginning(paths[0]), np.random.default_rng(7))
    if not counts.sum():
        return model
    state = State.fresh(model.w)
    epochs = math.ceil(STEPS * BATCH * SCORED / counts.sum())
    parts = max(1, blocks.rdd.getNumPartitions())
    groups = math.isqrt(parts - 1) + 1
    cuts = [0.0, *(2.0 ** (i - ROUNDS) for i in range(1, ROUNDS)), 1.0]
    for epoch in range(epochs):
        for i, cut in enumerate(zip(cuts, cuts[1:])):
            share = cut[1] - cut[0]
            done = ((epoch + cut[0]) / epochs, (epoch + cut[1]) / epochs)
            rows = _round(blocks, model, state, cut, done, counts.sum() / SCORED * share / parts, epoch * ROUNDS + i)
            got = rows.groupBy(F.pmod("part", F.lit(groups))).applyInArrow(_average, _STATE).toArrow()
            if got.num_rows:
                top = _average(got)
                state = state.unpack(np.frombuffer(top.column("state")[0].as_py(), "<f4"), top.column("step")[0].as_py())
    return Attention(model.slot, model.escape, state.w)


# ---- token counts over all training documents ---------------------------------------
def _counted(train_: list[bool], starts: bytes, token: bytes, words: int) -> np.ndarray:
    """How often each word of a block occurs in its training documents."""
    seen = np.repeat(np.array(train_, dtype=bool), np.diff(_numbers(starts, "<i8")))
    return np.bincount(_numbers(token, "<i4")[seen] + 1, minlength=words + 1)[1:]


def _block_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """``bucket, block, words, n``: distinct words of a block and how often they
    occur in its training documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, train_, starts, token, words in _rows(batches, "block", "train", "starts", "tokens", "words"):
            words = unpack_bytes(words)
            n = _counted(train_, starts, token, len(words)).astype("<i8")
            full, first = np.unique(_bucket(words, buckets), return_index=True)
            cut = list(zip(first.tolist(), [*first[1:].tolist(), len(words)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int64()),
                 pa.array([pack_bytes(words.slice(x, z - x)) for x, z in cut], pa.binary()),
                 pa.array([n[x:z].tobytes() for x, z in cut], pa.binary())], ["bucket", "block", "words", "n"])

    return (blocks.select("block", "train", "starts", "tokens", "words")
                  .mapInArrow(count, "bucket int, block long, words binary, n binary"))


def _totals(words: DataFrame, buckets: int) -> DataFrame:
    """``block, bucket, n, kinds, tokens``: totals over all blocks, in the order of
    the block's words; the last two are the partition's known words and training
    tokens, on its first row only.
    A bucket holds a word once per block, and buckets grow with the shuffle width."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, bucket, words, n = [], [], [], [np.zeros(0, np.int64)]
        for bl, bu, packed, count in _rows(batches, "block", "bucket", "words", "n"):
            block.append(bl)
            bucket.append(bu)
            words.append(unpack_bytes(packed))
            n.append(np.frombuffer(count, "<i8"))
        if not block:
            return
        size = [len(w) for w in words]
        coded = pa.concat_arrays(words).dictionary_encode()
        at = coded.indices.to_numpy()
        sums = np.bincount(at, np.concatenate(n), len(coded.dictionary)).astype(np.int64)
        ends = np.cumsum(size)
        for i, (bl, bu, z, s) in enumerate(zip(block, bucket, ends, size)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([bl], pa.int64()), pa.array([bu], pa.int32()), _packed(sums[at[z - s:z]], "<i8"),
                 pa.array([0 if i else int((sums > 0).sum())], pa.int64()),
                 pa.array([0 if i else int(sums.sum())], pa.int64())], ["block", "bucket", "n", "kinds", "tokens"])

    return (words.repartition(buckets, "bucket")
                 .mapInArrow(total, "block long, bucket int, n binary, kinds long, tokens long"))


def subword_counts(blocks: DataFrame, ends: int) -> np.ndarray:
    """Occurrences of each subword id in all training documents, of which there are ``ends``."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for train_, starts, token, spelt in _rows(batches, "train", "starts", "tokens", "spelt"):
            spelt = unpack_bytes(spelt)
            times = _counted(train_, starts, token, len(spelt))
            ids = np.frombuffer(spelt.buffers()[2] or b"", "<u2")
            n = np.bincount(ids, np.repeat(times, pc.binary_length(spelt).to_numpy() // 2), END_ID + 1).astype(np.int64)
            id_ = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(id_, pa.int32()), pa.array(n[id_], pa.int64())], ["id", "n"])

    got = (blocks.select("train", "starts", "tokens", "spelt").mapInArrow(spread, "id int, n long")
                 .groupBy("id").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(END_ID + 1)
    out[got.column("id").to_numpy()] = got.column("n").to_numpy()
    out[END_ID] += ends
    return out


def score_texts(docs: DataFrame, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    paths = (json_path or public_path(f"{BYTE_BPE}.json"), ranks_path or public_path(f"{BYTE_BPE}.tiktoken"))
    docs = docs.select("doc_id", "text")
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flag = F.transform("doc_ids", lambda d: in_training(d))
    blocks = written(coded_blocks(docs, paths, buckets).withColumn("train", flag), "lm-blocks")
    totals = written(_totals(_block_words(blocks, buckets), buckets), "lm-totals")
    facts = totals.agg(F.sum("kinds"), F.sum("tokens")).first()
    ends = blocks.agg(F.sum(F.size(F.filter("train", lambda t: t)))).first()[0] or 0
    kinds, tokens = (facts[0] or 0) + (ends > 0), (facts[1] or 0) + ends
    model = fit_network(blocks, subword_counts(blocks, ends), paths)
    kind = docs.schema["doc_id"].dataType
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    types = [to_arrow_type(kind), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    empty = pa.table([pa.array([], t) for t in types], names=names)
    floor = np.log10(tokens + (kinds + 1))

    def score(texts: pa.Table, counts: pa.Table) -> pa.Table:
        # the block's words lie in the order of buckets
        n = np.concatenate([np.zeros(0, np.int64), *(_numbers(x, "<i8") for x in counts.sort_by("bucket").column("n").to_pylist())])
        out = []
        for row in range(texts.num_rows):
            starts, tokens_ = (_numbers(texts.column(c)[row].as_py(), k) for c, k in (("starts", "<i8"), ("tokens", "<i4")))
            spelt = unpack_bytes(texts.column("spelt")[row].as_py())
            held = ~np.array(texts.column("train")[row].as_py(), dtype=bool)
            for text, last in spans(starts):
                token, first = tokens_[starts[text]:starts[last]].astype(np.int64), starts[text:last + 1] - starts[text]
                ids, at = id_stream(token, spelt)
                c = np.append(n, ends)[token]  # -1, the end, is the last
                network = token_log_probs(*model.log_probs(shifted(ids, at[first]), ids, at[first]), at, token < 0)
                total = mixed(network, c / tokens if tokens else None, token, first)
                size, first = np.diff(first), first[:-1]
                out.append(pa.table([
                    pa.chunked_array([texts.column("doc_ids")[row].values[text:last]]), pa.array(held[text:last]), pa.array(size),
                    pa.array(np.add.reduceat((c > 0).astype(np.int64), first)), pa.array(np.full(len(size), tokens)),
                    pa.array(np.add.reduceat(np.log10(c + 1.0), first) - size * floor),
                    pa.array(np.add.reduceat(total, first) / np.log(10))], names=names))
        return pa.concat_tables(out) if out else empty

    return (blocks.drop("words").groupBy("block").cogroup(totals.select("block", "bucket", "n").groupBy("block"))
            .applyInArrow(score, f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, "
                                 "train_tokens long, base_score double, score double"))
