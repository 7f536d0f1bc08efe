"""Document quality by attention over passages (operator 10).

A document is a bag of passages of ``PASSAGE`` words that share one label. Every passage of the
whole text is encoded by the shares of its characters, hashed words, and how words repeat. A passage
becomes ``h = tanh(W x + b)``; a gate ``w . (tanh(V h) * sigmoid(U h))``, made to sum to 1 over the
document, says how much it counts; the weighted sum of h gives the probability of label 1.

The model is fitted on the driver from a bounded, documented number of labelled documents, which
tasks encode; scoring runs over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.llm.storage import column
from tablelog.llm.words import SPACE, Words, ranges, text_bytes

PASSAGE = 48
#: Labelled documents that the model is fitted on, at most: those of the smallest hashes of keys.
SAMPLE = 4000
#: Passages of one of these, at most, that it is fitted on.
FITTED = 64

_HASHED = 64
_SHARES = 64

# Kinds of bytes: letters, upper case, digits, space, line end, control, beyond ASCII, each other sign.
_KIND = np.full(256, 31, np.int64)
_KIND[:128] = 30
_KIND[97:123] = np.arange(26)
_KIND[65:91], _KIND[48:58], _KIND[32], _KIND[10] = 26, 27, 28, 29
_SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]
_KIND[_SIGNS] = 32 + np.arange(len(_SIGNS))

#: Numbers that encode a passage.
WIDTH = _SHARES + _HASHED + 6


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row of ``WIDTH`` numbers per passage, and where each text's passages begin.

    A text without words has one passage of zeros.
    """
    words = Words(texts, SPACE)
    data, _ = text_bytes(texts)
    counts = words.counts()
    n = np.maximum(-(-counts // PASSAGE), 1)
    at = np.concatenate([[0], np.cumsum(n)])
    total = int(at[-1])
    turn = ranges(np.zeros(len(n), np.int64), n)
    first = np.repeat(words.row[:-1], n) + turn * PASSAGE
    size = np.clip(np.repeat(words.row[1:], n) - first, 0, PASSAGE)
    out = np.zeros((total, WIDTH), np.float32)
    full = np.flatnonzero(size)
    if not len(full):
        return out, at

    begin = words.start[first[full]]
    length = np.diff(np.append(begin, len(data)))
    owner = np.repeat(np.arange(len(full)), length)
    shares = np.bincount(owner * _SHARES + _KIND[data[begin[0] :]], minlength=len(full) * _SHARES).reshape(-1, _SHARES)
    out[full, :_SHARES] = np.sqrt(shares / np.maximum(length, 1)[:, None])

    of = np.repeat(np.arange(len(full)), size[full])
    index = ranges(first[full], size[full])
    h = words.hash[index]
    sign = np.where(h >> np.uint64(40) & np.uint64(1), 1.0, -1.0)
    hashed = np.bincount(of * _HASHED + (h >> np.uint64(50) & np.uint64(_HASHED - 1)).astype(np.int64), sign, len(full) * _HASHED)
    words_in = size[full].astype(np.float32)
    out[full, _SHARES : _SHARES + _HASHED] = hashed.reshape(-1, _HASHED) / np.sqrt(words_in)[:, None]

    grid = np.zeros((len(full), PASSAGE), np.uint64)
    grid[of, index - first[full][of]] = h
    more = out[:, _SHARES + _HASHED :]
    for j, back in enumerate((1, 2)):
        more[full, j] = ((grid[:, back:] == grid[:, :-back]) & (grid[:, back:] != 0)).sum(1) / words_in
    grid.sort(axis=1)
    more[full, 2] = ((grid[:, 1:] == grid[:, :-1]) & (grid[:, 1:] != 0)).sum(1) / words_in
    more[full, 3] = np.log1p(length / words_in)
    more[full, 4] = words_in / PASSAGE
    more[full, 5] = 1
    return out, at


# --- the model ------------------------------------------------------------------------------------


@dataclass
class Model:
    """Weights by name, the encoding's mean and spread, and the score where nothing was learned."""

    weights: dict[str, np.ndarray] | None
    mean: np.ndarray
    spread: np.ndarray
    prior: float

    def scores(self, passages: np.ndarray, at: np.ndarray) -> np.ndarray:
        n = len(at) - 1
        if self.weights is None or not n:
            return np.full(n, self.prior)
        return _forward(self.weights, (passages - self.mean) / self.spread, at)["p"].astype(np.float64)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w: dict, x: np.ndarray, at: np.ndarray) -> dict:
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    h = np.tanh(x @ w["W"] + w["b"])
    t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    e = (t * g) @ w["w"]
    e = np.exp(e - np.maximum.reduceat(e, at[:-1])[doc])
    a = e / np.add.reduceat(e, at[:-1])[doc]
    z = np.add.reduceat(a[:, None] * h, at[:-1])
    return {"doc": doc, "h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ w["c"] + w["d"])}


def _gradients(w: dict, x: np.ndarray, at: np.ndarray, y: np.ndarray) -> dict:
    f = _forward(w, x, at)
    doc, h, a = f["doc"], f["h"], f["a"]
    err = (f["p"] - y) / len(y)
    dz = err[:, None] * w["c"][None, :]
    da = (dz[doc] * h).sum(1)
    de = a * (da - np.add.reduceat(a * da, at[:-1])[doc])
    dt, dg = de[:, None] * w["w"] * f["g"], de[:, None] * w["w"] * f["t"]
    dt, dg = dt * (1 - f["t"] ** 2), dg * f["g"] * (1 - f["g"])
    dh = (a[:, None] * dz[doc] + dt @ w["V"].T + dg @ w["U"].T) * (1 - h**2)
    return {
        "W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ err, "d": err.sum(keepdims=True)
    }


def fit(passages: np.ndarray, at: np.ndarray, y: np.ndarray, *, hidden: int = 24, gate: int = 12, epochs: int = 8, seed: int = 7) -> Model:
    """Fit by Adam on whole documents, 64 at a time; the same input gives the same model.

    Few documents are gone through more often than ``epochs`` times, for 400 steps in all.
    """
    prior = float(y.mean()) if len(y) else 0.5
    mean, spread = (passages.mean(0), passages.std(0) + 0.05) if len(passages) else (np.zeros(WIDTH), np.ones(WIDTH))
    if len(np.unique(y)) < 2:
        return Model(None, mean, spread, prior)
    rng = np.random.Generator(np.random.PCG64(seed))
    shapes = {"W": (WIDTH, hidden), "V": (hidden, gate), "U": (hidden, gate), "w": (gate,), "c": (hidden,)}
    w = {k: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32) for k, s in shapes.items()}
    w |= {"b": np.zeros(hidden, np.float32), "d": np.array([np.log(prior / (1 - prior))], np.float32)}
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    x = ((passages - mean) / spread).astype(np.float32)
    step = 0
    rounds = max(epochs, -(-400 * 64 // len(y)))
    for turn in range(rounds):
        order = rng.permutation(len(y))
        rate = 4e-3 * 0.8 ** (turn * epochs / rounds)
        for i in range(0, len(order), 64):
            own = order[i : i + 64]
            n = np.diff(at)[own]
            part = np.concatenate([[0], np.cumsum(n)])
            g = _gradients(w, x[ranges(at[:-1][own], n)], part, y[own])
            step += 1
            for k in w:
                grad = g[k] + 1e-4 * w[k] * (k in shapes)
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad**2
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model({k: x.astype(np.float32) for k, x in w.items()}, mean, spread, prior)


def held_out(key: Column) -> Column:
    """True for the fifth of the keys that nothing is learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Encoded passages of labelled texts; of a long one ``FITTED`` that are spread over all of it."""
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            passages, at = encode(part.column(2))
            blobs = []
            for a, b in zip(at.tolist(), at[1:].tolist()):
                own = np.arange(a, b) if b - a <= FITTED else a + np.arange(FITTED) * (b - a) // FITTED
                blobs.append(passages[own].astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(blobs, pa.binary())], ["key", "y", "bag"])


def learn(
    docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, key: str = "doc_id", text: str = "text", label_key: str = "doc_id", label: str = "quality"
) -> Model:
    """The model of ``labels``, from at most ``sample`` labelled keys outside the held-out fifth.

    The keys of the smallest hashes are taken; of a key's texts the one of the smallest hash counts, with
    ``FITTED`` passages at most. Scores always read all passages. Labels other than 0 and 1 and NULL keys are left out;
    a key labelled several times counts with its lowest label. Without labels every score is 0.5,
    with one label alone it is that label.
    """
    asked = labels.select(column(labels, label_key).alias("key"), column(labels, label).cast("int").alias("y"))
    asked = asked.filter(F.col("y").isin(0, 1) & F.col("key").isNotNull() & ~held_out(F.col("key")))
    asked = asked.groupBy("key").agg(F.min("y").alias("y")).orderBy(F.xxhash64("key"), "key").limit(sample)
    rows = docs.select(column(docs, key).alias("key"), column(docs, text).alias("text"))
    rows = rows.join(F.broadcast(asked), "key")  # ``sample`` keys at most
    # One text for each key, however many rows it has: fitting sees ``sample`` times ``FITTED`` passages at most.
    rows = rows.groupBy("key", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    bags = rows.mapInArrow(_bags, f"key {kind}, y int, bag binary").orderBy("key", F.xxhash64("bag")).toArrow()
    parts = [np.frombuffer(x.as_buffer(), np.float16).reshape(-1, WIDTH) for x in bags["bag"]]
    at = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
    passages = np.concatenate(parts).astype(np.float32) if parts else np.zeros((0, WIDTH), np.float32)
    return fit(passages, at, bags["y"].to_numpy().astype(np.float32))


def score(docs: DataFrame, model: Model, *, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 in a further column ``name``; higher is likelier label 1.

    Only the text is read. A NULL text counts as empty, and empty texts are scored like others.
    Equal texts have equal scores. A column that is called ``name`` already is replaced.
    """
    docs = docs.select([column(docs, c) for c in docs.columns if c != name or c == text])
    place, names = docs.columns.index(text), [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                values = model.scores(*encode(part.column(place)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.float64())], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
