"""Toxicity scores from a bidirectional gated recurrent network, trained in numpy.

A word enters as its own vector (known words) beside the summed vectors of its
runs of three to five characters. Two gated recurrent layers read a window of ``WIDTH`` words
in both directions; attention pools their states into one logit. A text's windows
start every ``STEP`` words, overlap, and cover all of it; its score comes from the
highest logit and the share of windows that seem toxic, by a logistic curve fitted
on all windows of the learned rows.

Only documents are labelled, not windows, so learning goes in rounds: first any
window of a toxic document counts as toxic, then only those that the network so
far takes for toxic itself, which also leaves wrong labels aside.

Bounds: at most ``POSITIVES`` and ``NEGATIVES`` labelled documents are learned from,
chosen by hash of their id. Of each, ``SAMPLED`` windows, evenly spread, reach the driver
for the network's weights; for the curve tasks read all its windows with the trained
network and return four numbers. All documents are scored, whole.

Cases: null and empty texts have one window without words and its score; texts of
any length are scored in pieces; labels that are null, or of unknown
documents, teach nothing; a document labelled twice is toxic if one label says so;
of several texts of one id that of the least hash is learned from;
repeated rows get equal scores; without both labels to learn from, scores are 0;
other columns are kept by ``kept_rows`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusqa.llm.common import ALNUM, Words, mixed, pieces
from corpusqa.sources.shared import written

WIDTH, STEP = 32, 24
WORD_DIM, CHAR_DIM, HIDDEN, ATTEND = 8, 8, 8, 8
NGRAMS, CHAR_ROWS = (3, 4, 5), 1 << 14
VOCABULARY = 20_000
POSITIVES, NEGATIVES, SAMPLED = 1200, 2400, 16
SEED = 7
#: Words in fewer learned documents have no vector of their own.
RARE = 5
DECAY = 3e-4
MIN_STEPS = 150


def ngrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the character table for each word, one word after the other, and how many each has.

    The runs of ``NGRAMS`` characters of a word with a mark at both its ends.
    """
    marked = b"\0" + b"\0".join(words) + b"\0"
    code = np.frombuffer(marked.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.cumsum(code == 0) - 1
    rows, owner = [], []
    for n in NGRAMS:
        inside = np.ones(max(0, len(code) - n + 1), bool)
        h = np.full(len(inside), n, np.uint64)
        for j in range(n):
            part = code[j : j + len(inside)]
            h = h * np.uint64(0x100000001B3) + part
            if 0 < j < n - 1:
                inside &= part > 0
        rows.append((mixed(h[inside]) & np.uint64(CHAR_ROWS - 1)).astype(np.int64))
        owner.append(word[1 : 1 + len(inside)][inside])
    rows, owner = np.concatenate(rows), np.concatenate(owner)
    return rows[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


@dataclass
class Lexicon:
    """Distinct words of some text: hash, character rows one word after the other, where each begins, how many."""

    h: np.ndarray
    rows: np.ndarray
    first: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(words: Words) -> tuple[Lexicon, np.ndarray]:
        """The lexicon and each word's number in it."""
        h, one, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        cut = zip(words.start[one].tolist(), words.end[one].tolist())
        rows, size = ngrams([words.data[a:b] for a, b in cut])
        return Lexicon(h, rows, np.cumsum(size) - size, size), number.reshape(-1)


def windows(first: np.ndarray, width: int = WIDTH, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers ``[windows, width]`` (-1 past a text's end) and each window's text."""
    n = np.diff(first)
    count = np.maximum(1, -(-(n - width) // step) + 1)
    text = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    at = (nth * step)[:, None] + np.arange(width)
    return np.where(at < n[text][:, None], first[text][:, None] + at, -1), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _summed(row: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Sums of ``values`` by row number."""
    out = np.zeros((rows, values.shape[1]), values.dtype)
    order = np.argsort(row, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(row[order]) > 0))[: len(row)]
    if len(row):
        out[row[order[first]]] = np.add.reduceat(values[order], first, axis=0)
    return out


@dataclass
class Network:
    vocabulary: np.ndarray  # sorted hashes of the known words
    p: dict[str, np.ndarray] = field(default_factory=dict)
    curve: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def start(self, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        x, h = WORD_DIM + CHAR_DIM, HIDDEN

        def draw(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {
            "word": draw(len(self.vocabulary) + 1, WORD_DIM, scale=0.1),
            "char": draw(CHAR_ROWS, CHAR_DIM, scale=0.1),
            "W": draw(2, x, 3 * h, scale=x**-0.5), "U": draw(2, h, 3 * h, scale=h**-0.5),
            "b": np.zeros((2, 1, 3 * h), np.float32),
            "A": draw(2 * h, ATTEND, scale=(2 * h) ** -0.5), "a": np.zeros(ATTEND, np.float32),
            "v": draw(ATTEND, scale=ATTEND**-0.5),
            "w": draw(2 * h, scale=(2 * h) ** -0.5), "o": np.zeros(1, np.float32),
        }

    def inputs(self, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
        """Input vectors of the lexicon's words, and their rows in the word table (0: unknown)."""
        at = np.minimum(np.searchsorted(self.vocabulary, lexicon.h), max(len(self.vocabulary) - 1, 0))
        known = self.vocabulary[at] == lexicon.h if len(self.vocabulary) else np.zeros(len(at), bool)
        row = np.where(known, at + 1, 0)
        if not len(row):
            return np.zeros((0, WORD_DIM + CHAR_DIM), self.p["word"].dtype), row
        char = np.add.reduceat(self.p["char"][lexicon.rows], lexicon.first, axis=0) / np.sqrt(lexicon.size)[:, None]
        return np.concatenate([self.p["word"][row], char], axis=1).astype(self.p["word"].dtype), row

    def forward(self, gates: np.ndarray, at: np.ndarray, keep: bool = False):
        """Logits of windows ``at`` ([B, T] numbers of words, -1: none).

        ``gates`` ([3, 2, words + 1, H], the last word's zero) are the words' shares
        in the gates z, r and the new state, forwards and backwards.
        """
        p, (size, width), h = self.p, at.shape, HIDDEN
        kind, last = gates.dtype, gates.shape[2] - 1
        mask = (at >= 0).astype(kind)
        at = np.where(at < 0, last, at)
        # both directions side by side: rows 0..size forwards, then backwards
        turn = np.concatenate([at, at[:, ::-1] + last + 1]).T.copy()
        live = np.concatenate([mask, mask[:, ::-1]]).T[:, :, None].copy()
        whole = bool(mask.all())
        flat = [g.reshape(-1, h) for g in gates]
        weights = [np.ascontiguousarray(p["U"][:, :, i * h : (i + 1) * h]) for i in range(3)]
        state = np.zeros((2 * size, h), kind)
        states = np.zeros((width, size, 2, h), kind)
        kept = []
        for t in range(width):
            z, r, own = ((state.reshape(2, size, h) @ w).reshape(-1, h) for w in weights)
            for gate, share in ((z, flat[0]), (r, flat[1])):
                gate += np.take(share, turn[t], axis=0)
                gate *= kind.type(0.5)
                np.tanh(gate, out=gate)
                gate += 1
                gate *= kind.type(0.5)  # the logistic curve
            new = r * own
            new += np.take(flat[2], turn[t], axis=0)
            np.tanh(new, out=new)
            if keep:
                kept.append((state, own, z, r, new, live[t]))
            step = state - new
            step *= z
            step += new
            state = step if whole else state + live[t] * (step - state)
            states[t, :, 0] = state[:size]
            states[width - 1 - t, :, 1] = state[size:]
        states = states.reshape(width, size, 2 * h)
        look = states @ p["A"]
        look += p["a"]
        np.tanh(look, out=look)
        force = np.where(mask.T > 0, look @ p["v"], kind.type(-1e9))
        force = np.exp(force - force.max(axis=0)) * mask.T
        attend = force / np.maximum(force.sum(axis=0), kind.type(1e-9))
        pooled = np.einsum("tb,tbh->bh", attend, states)
        logit = pooled @ p["w"] + p["o"][0]
        return (logit, (turn, states, look, attend, pooled, kept)) if keep else logit

    def word_gates(self, x: np.ndarray) -> np.ndarray:
        share = x @ self.p["W"] + self.p["b"]
        share = np.concatenate([share, np.zeros_like(share[:, :1])], axis=1)
        return np.ascontiguousarray(share.reshape(2, -1, 3, HIDDEN).transpose(2, 0, 1, 3))

    def gradients(self, lexicon: Lexicon, at: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of windows and its gradient."""
        p, h, (size, width) = self.p, HIDDEN, at.shape
        x, row = self.inputs(lexicon)
        gates = self.word_gates(x)
        logit, (turn, states, look, attend, pooled, kept) = self.forward(gates, at, keep=True)
        loss = float(np.mean(np.logaddexp(0, logit) - label * logit))
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d_logit = ((_sigmoid(logit) - label) / size).astype(states.dtype)
        g["w"], g["o"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * p["w"]
        d_states = attend[:, :, None] * d_pooled
        d_attend = (states * d_pooled).sum(axis=2)
        d_force = attend * (d_attend - (attend * d_attend).sum(axis=0))
        g["v"] = np.tensordot(d_force, look, 2)
        d_look = d_force[:, :, None] * p["v"] * (1 - look * look)
        g["a"] = d_look.sum(axis=(0, 1))
        g["A"] = states.reshape(-1, 2 * h).T @ d_look.reshape(-1, ATTEND)
        d_states = (d_states + d_look @ p["A"].T).reshape(width, size, 2, h)
        d_shares = np.zeros((width, 2 * size, 3 * h), states.dtype)
        d_state = np.zeros((2 * size, h), states.dtype)
        turned = p["U"].transpose(0, 2, 1)
        for t in range(width - 1, -1, -1):
            state, own, z, r, new, m = kept[t]
            d_state[:size] += d_states[t, :, 0]
            d_state[size:] += d_states[width - 1 - t, :, 1]
            d_after = m * d_state
            d_new = d_after * (1 - z) * (1 - new * new)
            d_z = d_after * (state - new) * z * (1 - z)
            d_r = d_new * own * r * (1 - r)
            d_shares[t] = np.concatenate([d_z, d_r, d_new], axis=1)
            d_own = np.concatenate([d_z, d_r, d_new * r], axis=1).reshape(2, size, 3 * h)
            g["U"] += state.reshape(2, size, h).transpose(0, 2, 1) @ d_own
            d_state = d_state - d_after + d_after * z + (d_own @ turned).reshape(-1, h)
        d_gates = _summed(turn.reshape(-1), d_shares.reshape(-1, 3 * h), 2 * (len(x) + 1))
        d_gates = d_gates.reshape(2, len(x) + 1, 3 * h)[:, : len(x)]
        g["b"] = d_gates.sum(axis=1, keepdims=True)
        g["W"] = x.T @ d_gates
        d_x = (d_gates @ p["W"].transpose(0, 2, 1)).sum(axis=0)
        g["word"] = _summed(row, d_x[:, :WORD_DIM], len(p["word"]))
        each = np.repeat(d_x[:, WORD_DIM:] / np.sqrt(lexicon.size)[:, None], lexicon.size, axis=0)
        g["char"] = _summed(lexicon.rows, each, CHAR_ROWS)
        return loss, g

    def traits(self, texts: list[str | None]) -> np.ndarray:
        """``traits`` of each text from the logits of all its windows."""
        out = [np.zeros((0, 4))]
        for _, piece in pieces(texts):
            words = Words(piece, ALNUM, True)
            lexicon, number = Lexicon.of(words)
            gates = self.word_gates(self.inputs(lexicon)[0])
            at, text = windows(words.first)
            own = np.append(number, -1)  # -1 stays -1
            logit = np.concatenate([self.forward(gates, own[at[lo : lo + 2048]]) for lo in range(0, len(at), 2048)])
            out.append(traits(logit, np.searchsorted(text, np.arange(len(piece)))))
        return np.concatenate(out)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """A score of each text."""
        return np.round(_sigmoid(self.traits(texts) @ self.curve), 6)


def traits(logit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """What counts of a text's windows: the highest logit, how many seem toxic of how many."""
    n = np.diff(np.append(first, len(logit)))
    share = np.add.reduceat(_sigmoid(logit.astype(float)), first) / n
    return np.stack([np.maximum.reduceat(logit, first), 10 * share, np.log(n), np.ones(len(n))], axis=1)


def _subset(lexicon: Lexicon, numbers: np.ndarray) -> tuple[Lexicon, np.ndarray]:
    """The lexicon of only the words in ``numbers``, and these anew."""
    used, again = np.unique(numbers, return_inverse=True)
    again = again.reshape(numbers.shape)
    if used[0] < 0:
        used, again = used[1:], again - 1
    size = lexicon.size[used]
    first = np.cumsum(size) - size
    at = np.repeat(lexicon.first[used] - first, size) + np.arange(size.sum())
    return Lexicon(lexicon.h[used], lexicon.rows[at], first, size), again


def train(
    texts: list[list[str]], toxic: np.ndarray, weight: np.ndarray, whole: Callable[[Network], np.ndarray],
    rounds: int = 4, batch: int = 256, rate: float = 0.02, seed: int = SEED,
) -> Network:
    """Learn from documents given as lists of windows; ``weight`` says how many documents each stands for.

    ``whole`` gives the traits of the whole documents under the trained network, for the curve.
    """
    flat = [w for windows_ in texts for w in windows_]
    owner = np.repeat(np.arange(len(texts)), [len(w) for w in texts])
    words = Words([w.encode() for w in flat], ALNUM, True)
    lexicon, number = Lexicon.of(words)
    at = np.append(number, -1)[windows(words.first, WIDTH, WIDTH)[0]]  # one window for each text
    pairs = np.unique(np.stack([owner[np.repeat(np.arange(len(flat)), np.diff(words.first))], number]), axis=1)
    seen = np.bincount(pairs[1], minlength=len(lexicon.h))
    common = np.argsort(-seen, kind="stable")[:VOCABULARY]
    net = Network(np.sort(lexicon.h[common[seen[common] >= RARE]]))
    net.start(seed)
    rng = np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in net.p.items()}
    square = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    positive = toxic[owner] == 1
    chosen = np.flatnonzero(positive)
    clean = np.flatnonzero(~positive)

    def all_logits() -> np.ndarray:
        gates = net.word_gates(net.inputs(lexicon)[0])
        return np.concatenate([net.forward(gates, at[lo : lo + 2048]) for lo in range(0, len(at), 2048)])

    for turn in range(rounds):
        if turn:
            logit = all_logits()
            sure = positive & (logit > 0)
            chosen = np.flatnonzero(sure if sure.any() else positive)
        some = rng.choice(clean, min(len(clean), max(2 * len(chosen), 4000)), replace=False)
        pool = np.concatenate([chosen, some])
        for _ in range(max(2, -(-MIN_STEPS * batch // (rounds * len(pool))))):
            order = rng.permutation(pool)
            for lo in range(0, len(order), batch):
                pick = order[lo : lo + batch]
                small, ids = _subset(lexicon, at[pick])
                _, grad = net.gradients(small, ids, positive[pick].astype(np.float32))
                step += 1
                for k, g in grad.items():
                    g = np.clip(g, -1, 1) + DECAY * net.p[k]
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.01 * (g * g - square[k])
                    net.p[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
    net.curve = _logistic(whole(net), toxic.astype(float), weight)
    return net


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients of a weighted logistic curve by Newton's method, slightly regularised."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-6)
    x, weight, beta = x / scale, weight / weight.mean(), np.zeros(x.shape[1])
    for _ in range(30):
        prob = _sigmoid(x @ beta)
        grad = x.T @ (weight * (y - prob)) - 0.05 * beta
        curve = (x * (weight * prob * (1 - prob))[:, None]).T @ x + 0.05 * np.eye(len(beta))
        beta = beta + np.clip(np.linalg.solve(curve, grad), -5, 5)
    return beta / scale


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learned(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    positives: int = POSITIVES, negatives: int = NEGATIVES, sampled: int = SAMPLED,
) -> Network | None:
    """A network from labelled rows outside the held-out third; None without both labels."""
    known = (
        labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("id")).agg((F.max(label) > 0).cast("int").alias("toxic"))
    )
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    sides = [
        known.filter(F.col("toxic") == side).orderBy(F.xxhash64("id"), "id").limit(n)
        for side, n in ((1, positives), (0, negatives))
    ]

    @F.pandas_udf("array<string>")
    def spread(texts: pd.Series) -> pd.Series:
        out = []
        for data in texts.fillna(""):
            words = Words([data.encode()], ALNUM, True)
            count = max(1, -(-(len(words) - WIDTH) // STEP) + 1)
            nth = np.unique(np.linspace(0, count - 1, min(count, sampled)).astype(int))
            out.append([words.joined(k * STEP, min(len(words), k * STEP + WIDTH)) if len(words) else "" for k in nth.tolist()])
        return pd.Series(out)

    chosen = F.broadcast(sides[0].union(sides[1]))
    texts = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(chosen, "id")
    # at most positives + negatives rows: tasks keep one text of an id before the shuffle, always the same one
    sample = written(texts.groupBy("id", "toxic").agg(F.min_by("t", F.xxhash64("t")).alias("t")), "learned")
    rows = sample.select("id", "toxic", spread("t").alias("windows")).toPandas()
    toxic = rows["toxic"].to_numpy()
    if not 0 < toxic.sum() < len(toxic):
        return None
    rows = rows.sort_values("id")
    toxic = rows["toxic"].to_numpy()
    weight = np.where(toxic == 1, sizes[1] / toxic.sum(), sizes[0] / (toxic == 0).sum())

    def whole(network: Network) -> np.ndarray:
        @F.pandas_udf("array<double>")
        def measured(texts: pd.Series) -> pd.Series:
            return pd.Series(list(network.traits(texts.tolist())))

        found = sample.select("id", measured("t").alias("traits")).toPandas().sort_values("id")
        return np.stack(found["traits"].to_list())

    return train([list(w) for w in rows["windows"]], toxic, weight, whole)


def score(text: Column, network: Network | None) -> Column:
    """Scores of a text column, 0 to 1."""
    if network is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(network.scores(texts.tolist()))

    return of(F.coalesce(text, F.lit("")))


def kept_rows(docs: DataFrame, labels: DataFrame, limit: float = 0.7, text: str = "text", **names) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score under ``limit``."""
    network = learned(docs, labels, text=text, **names)
    rows = docs.select(F.struct("*").alias("row"), score(F.col(text), network).alias("score"))
    return rows.filter(F.col("score") < limit).select("row.*")
