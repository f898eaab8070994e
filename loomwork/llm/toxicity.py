"""Toxicity by compression distance: the same windows under a toxic and an ordinary zstandard dictionary.

A text is lowered, every position is written as a four-byte code of the three bytes that begin there (so that matches count
for more than zstandard's own overhead), and the whole of it is cut into overlapping windows. Each window is compressed
under both dictionaries; what the toxic one saves is the window's distance. Both dictionaries hold the same ordinary prose;
the toxic one also holds the passages of toxic training texts that are typical of them: stretches of byte n-grams found in
significantly more contexts than in ordinary texts. Counting contexts instead of texts keeps copied texts from looking
typical. A logistic curve over the distances of a text, fitted on training rows that the dictionaries have not seen, turns
them into a calibrated score with the threshold at one half.

Training reads a bounded sample: up to ``rows`` labelled rows per label, of at most ``MAX_CHARS`` characters each, picked by
the hash of their ids. Scoring reads whole texts in pieces of bounded size.

Defined cases: null and empty texts are scored like a text whose windows save nothing; without rows of both labels every
score is the share of toxic rows in the sample (0 without any).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import add_columns

GRAM, CONTEXT = 5, 8
WINDOW, HOP = 32, 24
MAX_CHARS = 32_768
PROSE_BYTES, TOXIC_BYTES = 4_000, 4_000
LEVEL = 3
PIECE = 1 << 20


def folded(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "surrogatepass") + b" "


def expanded(data: bytes) -> bytes:
    """Four bytes for each position: a hash of the three bytes from there on."""
    a = np.frombuffer(data + b"  ", np.uint8).astype(np.uint32)
    h = (a[:-2] * np.uint32(0x9E3779B1)) ^ (a[1:-1] * np.uint32(0x85EBCA77)) ^ ((a[2:] + np.uint32(7)) * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h ^ (h >> np.uint32(12))).astype("<u4").tobytes()


def gram_hashes(data: bytes, width: int) -> np.ndarray:
    """64-bit hashes of all ``width``-byte strings."""
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(a) - width + 1), np.uint64)
    for k in range(width):
        out = (out + a[k:k + len(out)] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def contexts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(gram, number of different contexts before it), by gram."""
    pairs = []
    for data in texts:
        grams = gram_hashes(b" " * CONTEXT + data, GRAM)[CONTEXT:]
        before = gram_hashes(b" " * CONTEXT + data, CONTEXT)[:len(grams)]
        pairs.append(np.stack([grams, before]))
    if not pairs:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    grams, before = np.concatenate(pairs, axis=1)
    once = np.unique(grams * np.uint64(0xD6E8FEB86659FD93) ^ before, return_index=True)[1]
    return np.unique(grams[once], return_counts=True)


def typical_passages(toxic: list[bytes], ordinary: list[bytes], least: float = 8.0) -> list[bytes]:
    """Stretches of toxic texts covered by typical n-grams, the most frequent first."""
    grams, here = contexts(toxic)
    others, there = contexts(ordinary)
    place = np.minimum(np.searchsorted(others, grams), max(0, len(others) - 1))
    away = np.where(others[place] == grams, there[place], 0) if len(others) else np.zeros(len(grams))
    n1, n0 = max(1, here.sum()), max(1, there.sum())
    pooled = (here + away) / (n1 + n0)
    z = (here / n1 - away / n0) / np.sqrt(pooled * (1 / n1 + 1 / n0) + 1e-18)
    typical = np.sort(grams[(z > least) & (here >= 8) & (here / n1 > 4 * away / n0)])
    found: dict[bytes, int] = {}
    for data in toxic:
        hot = np.isin(gram_hashes(data, GRAM), typical)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hot.astype(np.int8), [0]])))
        for begin, end in zip(edges[::2], edges[1::2]):
            passage = data[begin:end + GRAM - 1]
            found[passage] = found.get(passage, 0) + 1
    out, text, size = [], b"", 0
    for passage in sorted(found, key=lambda p: (-found[p], p)):
        if passage not in text and size + len(passage) <= TOXIC_BYTES:
            out.append(passage)
            text += passage + b"\x00"
            size += len(passage)
    return out


@dataclass
class Model:
    """The two dictionaries' contents and the logistic curve; without dictionaries only a constant score."""

    prose: bytes = b""
    toxic: bytes = b""
    middle: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    constant: float = 0.0

    def compressors(self):
        made = []
        for content in (expanded(self.prose), expanded(b" " + self.toxic + b" " + self.prose)):
            words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False, write_dict_id=False, write_checksum=False))
        return made

    def features(self, texts: list[str]) -> np.ndarray:
        plain, toxic = self.compressors()
        out = np.zeros((len(texts), 6))
        for i, text in enumerate(texts):
            data = folded(text)
            saved = []
            for start in range(0, len(data), PIECE):
                codes = expanded(data[start:start + PIECE + WINDOW])
                for at in range(0, max(1, min(PIECE, len(data) - start) - WINDOW + HOP), HOP):
                    window = codes[4 * at:4 * (at + WINDOW)]
                    saved.append(len(plain.compress(window)) - len(toxic.compress(window)))
            m = np.sort(np.array(saved, float))
            out[i] = m[-1], m[-3:].mean(), m.mean(), math.sqrt((m >= 6).mean()), math.sqrt((m >= 12).mean()), math.sqrt((m >= 18).mean())
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        if not len(self.middle):
            return np.full(len(texts), self.constant)
        x = (self.features(texts) - self.middle) / self.spread
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (intercept first) by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w, keep = np.zeros(x.shape[1]), np.diag([0.0, *[ridge * len(x) / 10] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep + 1e-9 * np.eye(x.shape[1]), x.T @ (y - p) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> dict[int, list[str]]:
    """Per label the texts of at most ``rows`` labelled rows, in the order of a hash of their ids."""
    known = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).select(F.col("doc_id").alias("_id"), "toxic")
    ordered = None
    for label in (0, 1):  # the lowest hashes of each label: a bounded list, so the texts are read with a broadcast join
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("_id"), "_id").limit(rows)
        ordered = part if ordered is None else ordered.unionByName(part)
    chosen = docs.select("doc_id", "text").join(F.broadcast(ordered), F.col("doc_id") == F.col("_id")) \
        .where(F.col("text").isNotNull() & (F.length("text") <= MAX_CHARS)).select("doc_id", "toxic", "text")
    out: dict[int, list[str]] = {0: [], 1: []}
    for row in sorted(chosen.collect(), key=lambda r: (r["doc_id"] * 2654435761 % (1 << 32), r["text"])):
        if len(out[row["toxic"]]) < rows:
            out[row["toxic"]].append(row["text"])
    return out


def fit(docs: DataFrame, labels: DataFrame, rows: int = 2000) -> Model:
    """Fit on at most ``rows`` rows per label of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) covers."""
    sample = labelled_sample(docs, labels, rows)
    ordinary, toxic = sample[0], sample[1]
    if len(ordinary) < 8 or len(toxic) < 8:
        total = len(ordinary) + len(toxic)
        return Model(constant=len(toxic) / total if total else 0.0)
    cut_o, cut_t = 2 * len(ordinary) // 3, 2 * len(toxic) // 3
    seen = [folded(t) for t in ordinary[:cut_o]]
    passages = typical_passages([folded(t) for t in toxic[:cut_t]], seen)
    share = max(1, PROSE_BYTES // max(1, min(100, len(seen))))
    prose = b"".join(t[:share] for t in seen[:100])[:PROSE_BYTES]
    model = Model(prose, b"".join(reversed(passages)))
    rest = ordinary[cut_o:] + toxic[cut_t:]
    x = model.features(rest)
    y = np.array([0.0] * len(ordinary[cut_o:]) + [1.0] * len(toxic[cut_t:]))
    model.middle, model.spread = x.mean(0), np.maximum(x.std(0), 1e-9)
    model.weights = logistic((x - model.middle) / model.spread, y)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from one half on), from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        values = shared.value.scores(texts)
        return [values.tolist(), (values >= 0.5).astype(int).tolist()]

    return add_columns(docs, "score double, predicted int", run)
