"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are read in windows of WINDOW bytes, forwards and backwards by a gated recurrent unit each; both
states give a distribution over languages at every position, and a document's probabilities are the mean over all its
positions. Training is backpropagation through time in numpy, Adam on the cross-entropy of all positions, over windows of
a bounded sample of labelled documents: at most `max_labelled`, shared evenly between the languages and picked by a hash
of doc_id, so a rare language has as many as a frequent one. Tasks cut `max_windows` windows in all, spread evenly over
each text; windows alone reach the driver. Languages beyond the 256 most frequent labels are not learned. The number of
steps does not depend on the sample. Labelling is one pass without shuffle: a task's windows run side by side as one
matrix per step.

Defined results: a null text, or one without a letter (a character for which str.isalpha holds), is `und` with score 0,
and so is every text if there is no labelled document; null labels are ignored; a doc_id with several labels or texts is
learned with its least label and text; languages with equal probabilities rank by name; repeated rows are labelled each;
a row without a doc_id is labelled, held out of nothing and not learned from; very long texts are read whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import bounded_sample, crc_bucket, ids_and_texts, labelled_texts, slices, written

WINDOW = 64
SIDE_BY_SIDE = 2048
UNDETERMINED = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


@dataclass
class Network:
    """Parameters by name, each direction's with f or b: E (256, 3H) input of reset, update, new; U (H, 3H) state's;
    c (H) bias of the state's part of new. W (2H, L), d (L) give the languages."""

    languages: list[str]
    p: dict[str, np.ndarray]

    @property
    def hidden(self) -> int:
        return self.p["Uf"].shape[0]

    def states(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool = False) -> tuple[np.ndarray, list]:
        """x (T, B) bytes, mask (T, B, 1). -> states (T, B, H) and what the way back needs."""
        E, U, c = (self.p[n + way] for n in "EUc")
        H, steps = self.hidden, range(len(x)) if way == "f" else range(len(x) - 1, -1, -1)
        h = np.zeros((x.shape[1], H), np.float32)
        out, trace = np.empty((*x.shape, H), np.float32), []
        for t in steps:
            inputs, state = E[x[t]], h @ U
            gates = _sigmoid(inputs[:, : 2 * H] + state[:, : 2 * H])
            state_new = state[:, 2 * H :] + c
            new = np.tanh(inputs[:, 2 * H :] + gates[:, :H] * state_new)
            old = h
            h = (new + gates[:, H:] * (h - new)) * mask[t]
            out[t] = h
            if keep:
                trace.append((t, old, gates, state_new, new))
        return out, trace

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """(T, B, L) of each position."""
        both = np.concatenate([self.states(x, mask, w)[0] for w in "fb"], axis=2)
        return _softmax(both @ self.p["W"] + self.p["d"])

    def documents(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(mean probabilities of each text's positions, how many positions have each label), rows per text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        n_windows = -(-sizes // WINDOW)
        pooled, labelled = (np.zeros((len(texts), len(self.languages)), k) for k in (np.float64, np.int64))
        data = np.frombuffer(b"".join(texts) + bytes(WINDOW), np.uint8)
        owner = np.repeat(np.arange(len(texts)), n_windows)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        starts = (np.cumsum(sizes) - sizes)[owner] + within * WINDOW
        lengths = np.minimum(WINDOW, sizes[owner] - within * WINDOW)
        for i in range(0, len(owner), SIDE_BY_SIDE):
            s, n, o = (a[i : i + SIDE_BY_SIDE] for a in (starts, lengths, owner))
            steps = np.arange(int(n.max()))
            x = data[s[None, :] + steps[:, None]]
            mask = (steps[:, None] < n[None, :]).astype(np.float32)[:, :, None]
            p = self.probabilities(x, mask)
            won = np.argmax(p, axis=2)
            p *= mask
            for k in range(len(self.languages)):
                labelled[:, k] += np.bincount(o, ((won == k) & (mask[:, :, 0] > 0)).sum(0), len(texts)).astype(np.int64)
                pooled[:, k] += np.bincount(o, p[:, :, k].sum(0), len(texts))
        return pooled / np.maximum(sizes, 1)[:, None], labelled


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(-1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(-1, keepdims=True)
    return z


def start(languages: list[str], hidden: int, seed: int) -> Network:
    r = np.random.default_rng(seed)
    p = {}
    for w in "fb":
        p["E" + w] = r.normal(0, 0.3, (256, 3 * hidden))
        p["U" + w] = r.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
        p["c" + w] = np.zeros(hidden)
    p["W"], p["d"] = r.normal(0, 0.1, (2 * hidden, len(languages))), np.zeros(len(languages))
    return Network(languages, {k: v.astype(np.float32) for k, v in p.items()})


def gradients(net: Network, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy of all positions and its gradients. x (T, B), mask (T, B, 1), y (B)."""
    H = net.hidden
    runs = {w: net.states(x, mask, w, keep=True) for w in "fb"}
    both = np.concatenate([runs[w][0] for w in "fb"], axis=2)
    p = _softmax(both @ net.p["W"] + net.p["d"])
    total = mask.sum()
    right = p[:, np.arange(len(y)), y]
    loss = float(-(np.log(right + 1e-9) * mask[:, :, 0]).sum() / total)
    p[:, np.arange(len(y)), y] -= 1
    dz = p * (mask / total)
    flat = dz.reshape(-1, dz.shape[2])
    g = {"W": both.reshape(-1, 2 * H).T @ flat, "d": flat.sum(0)}
    d_both = dz @ net.p["W"].T
    for i, w in enumerate("fb"):
        U = net.p["U" + w]
        dE, dU, dc = np.zeros_like(net.p["E" + w]), np.zeros_like(U), np.zeros_like(net.p["c" + w])
        dh = np.zeros((x.shape[1], H), np.float32)
        inputs, where = [], []
        for t, old, gates, state_new, new in reversed(runs[w][1]):
            dh = (dh + d_both[t, :, i * H : (i + 1) * H]) * mask[t]
            r, z = gates[:, :H], gates[:, H:]
            d_new = dh * (1 - z) * (1 - new * new)
            d_r, d_z = d_new * state_new * r * (1 - r), dh * (old - new) * z * (1 - z)
            d_state = np.concatenate([d_r, d_z, d_new * r], axis=1)
            inputs.append(np.concatenate([d_r, d_z, d_new], axis=1))
            where.append(x[t])
            dU += old.T @ d_state
            dc += d_state[:, 2 * H :].sum(0)
            dh = dh * z + d_state @ U.T
        inputs, where = np.concatenate(inputs), np.concatenate(where)
        for k in range(3 * H):
            dE[:, k] = np.bincount(where, inputs[:, k], 256)
        g |= {"E" + w: dE, "U" + w: dU, "c" + w: dc}
    return loss, g


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def windows_of(raw: bytes, n: int) -> list[bytes]:
    """Up to n different windows, spread evenly."""
    at = np.unique(np.linspace(0, max(0, len(raw) - WINDOW), n).astype(int))
    return [raw[i : i + WINDOW] for i in at.tolist() if raw]


def train(
    windows: list[bytes], labels: list[str], hidden: int = 8, steps: int = 500, batch: int = 192, rate: float = 0.02,
    seed: int = 5,
) -> Network | None:
    """The network of labelled windows; each step takes as many of every language."""
    languages = sorted(set(labels))
    if not languages:
        return None
    r = np.random.default_rng(seed)
    pools: list[list[bytes]] = [[] for _ in languages]
    for window, label in zip(windows, labels):
        pools[languages.index(label)].append(window)
    pools_of = list(range(len(languages)))
    net = start(languages, hidden, seed)
    first, second = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        y = np.array([pools_of[i % len(pools_of)] for i in range(batch)])
        chosen = [pools[k][r.integers(len(pools[k]))] for k in y]
        x = np.zeros((WINDOW, batch), np.uint8)
        mask = np.zeros((WINDOW, batch, 1), np.float32)
        for j, text in enumerate(chosen):
            x[: len(text), j] = np.frombuffer(text, np.uint8)
            mask[: len(text), j] = 1
        _, g = gradients(net, x, mask, y)
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        for k, v in g.items():
            v = v * min(1.0, 1.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            net.p[k] = (net.p[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, usable: Column | None = None, max_labelled: int = 2000, max_windows: int = 16_384, **how) -> Network | None:
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
    ).filter("doc_id is not null and lang is not null")
    picked = written(bounded_sample(known if usable is None else known.filter(usable), "doc_id", max_labelled, "lang"), "language-sample")
    per_text = max(1, max_windows // max(1, picked.count()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [windows_of((t or "").encode(), per_text) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("lang"), pa.array(found, pa.list_(pa.binary()))],
                names=["doc_id", "lang", "windows"],
            )

    rows = labelled_texts(docs, picked).select("doc_id", "lang", "text").mapInArrow(
        cut, "doc_id long, lang string, windows array<binary>",
    ).toPandas().sort_values("doc_id")
    pairs = [(bytes(w), lang) for lang, own in zip(rows["lang"], rows["windows"]) for w in own]
    return train([w for w, _ in pairs], [lang for _, lang in pairs], **how)


def label(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred, score, n_positions, n_agreeing (positions labelled as the document)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for b in slices(batches, "text", 4 << 20):
            texts = [t or "" for t in b.column("text").to_pylist()]
            raw = [t.encode() for t in texts]
            read = np.array([net is not None and has_letter(t) for t in texts], bool)
            lang, score, agree = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            at = np.flatnonzero(read)
            if len(at):
                pooled, labelled = net.documents([raw[i] for i in at])
                best = pooled.argmax(1)
                score[at], agree[at] = np.clip(pooled[np.arange(len(at)), best], 0, 1), labelled[np.arange(len(at)), best]
                for i, k in zip(at.tolist(), best.tolist()):
                    lang[i] = net.languages[k]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(lang), pa.array(score), pa.array([len(t) for t in raw], pa.int64()), pa.array(agree)],
                names=["doc_id", "lang_pred", "score", "n_positions", "n_agreeing"],
            )

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double, n_positions long, n_agreeing long")


def held_out_labels(docs: DataFrame, folds: int = 5, fold: int = 0, max_labelled: int = 2000) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ...: learned without the held-out fold of doc_ids, applied to all."""
    net = fit(docs, crc_bucket(F.col("doc_id"), folds) != fold, max_labelled)
    out = label(docs, net)
    return out.select(
        "doc_id", F.coalesce(crc_bucket(F.col("doc_id"), folds) == fold, F.lit(False)).alias("held_out"), "lang_pred", "score",
        "n_positions", "n_agreeing",
    )
