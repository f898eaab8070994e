"""Language identification with string kernels.

A text is the set of its character n-grams of one to four letters (blended spectrum, presence only). The kernel of two texts
is the number of shared n-grams over the geometric mean of their set sizes. A bounded sample of labelled texts is mapped by
the Nyström method onto landmark texts, and one kernel ridge regression per language is fitted there. A text's scores are
linear in its presence vector, so the landmark product is folded into one matrix and batches of texts are scored by a
single matrix product.

The scores of a text sum to one whatever it is, so they tell languages apart but not whether a text fits any of them. That
is judged by coverage: the share of a text's n-grams of letters that are common in a language. Floors of coverage are set
on the labelled sample, each text held against the others of its language and against the other languages.

Defined cases: null, empty and letterless texts are ``und`` with score 0; with no labelled row at all everything is ``und``.
Equal scores go to the first language in code point order. Whole texts are read, in pieces of bounded size.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import add_columns

ORDERS = 4
BITS = 15
WIDTH = 1 << BITS
PIECE = 1 << 20
UNKNOWN = "und"
LEAST_TEXTS = 8
NO_WORD, DIGIT, NO_LETTERS = re.compile(r"[\W_]+"), re.compile(r"\d"), re.compile(r"[\W\d_]+")


def presence(text: str) -> np.ndarray:
    """One byte per n-gram bucket: does the text hold an n-gram of it? Pieces of long texts overlap by three letters."""
    seen = np.zeros(WIDTH, np.uint8)
    letters = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for start in range(0, max(1, len(letters) - ORDERS + 1), PIECE):
        piece = letters[start:start + PIECE + ORDERS - 1]
        code = np.zeros(len(piece), np.uint32)
        for order in range(1, min(ORDERS, len(piece)) + 1):
            code = (code[:len(piece) - order + 1] + np.uint32(order)) * np.uint32(0x01000193) ^ piece[order - 1:]
            seen[(code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)] = 1
    return seen


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def letters_only(text: str) -> str:
    """The words without digits, single spaces around them: numbers, keys and punctuation are of no language.

    If all words have digits, their letters stand alone.
    """
    words = [word for word in NO_WORD.split(text) if word and not DIGIT.search(word)]
    return f" {' '.join(words or NO_LETTERS.sub(' ', text).split())} "


@dataclass
class Model:
    """Folded weights (bucket x language), one intercept per language and the languages in code point order.

    ``common`` (language x bucket) marks the n-grams of letters that are common in a language, ``floors`` the coverage that
    its texts reach; it is 0 for languages with too few labelled texts to tell.
    """

    weights: np.ndarray
    intercept: np.ndarray
    languages: list[str]
    common: np.ndarray = field(default_factory=lambda: np.zeros((0, WIDTH), np.uint8))
    floors: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def scores(self, texts: list[str], rows: int = 64) -> np.ndarray:
        out = np.empty((len(texts), len(self.languages)), np.float64)
        block = np.empty((rows, WIDTH), np.float32)
        for start in range(0, len(texts), rows):
            part = texts[start:start + rows]
            for i, text in enumerate(part):
                block[i] = presence(text)
            x = block[:len(part)]
            out[start:start + rows] = (x @ self.weights) / np.sqrt(np.maximum(x.sum(1), 1))[:, None] + self.intercept
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        scores = np.clip(self.scores(texts), 0.0, 1.0)
        best = scores.argmax(1)
        known = [has_letter(t) for t in texts]
        return ([self.languages[b] if k else UNKNOWN for b, k in zip(best, known)],
                [float(s[b]) if k else 0.0 for s, b, k in zip(scores, best, known)])

    def fits(self, texts: list[str], rows: int = 64) -> list[bool]:
        """Does a text reach the floor of a language, or has the one it is nearest to none?

        A text in several learned languages need not reach any floor: then all languages together must cover it, up to
        half of what the highest floor lets pass.
        """
        floor = dict(zip(self.languages, self.floors))
        predicted = self.predict(texts)[0]
        out = [name != UNKNOWN for name in predicted]
        judged = [i for i, name in enumerate(predicted) if name != UNKNOWN and floor[name]]
        for start in range(0, len(judged), rows):
            part = judged[start:start + rows]
            seen = np.stack([presence(letters_only(texts[i])) for i in part])
            one = ((coverage(seen, self.common) >= self.floors) & (self.floors > 0)).any(1)
            mixed = coverage(seen, self.common.max(0)[None])[:, 0] >= (1 + self.floors.max()) / 2
            for i, fit in zip(part, one | mixed):
                out[i] = bool(fit)
        return out


def coverage(seen: np.ndarray, common: np.ndarray) -> np.ndarray:
    """(text x language) share of each text's n-grams that are common in each language."""
    x = seen.astype(np.float32)
    return (x @ common.T.astype(np.float32)) / np.maximum(x.sum(1), 1)[:, None]


def coverage_floors(sample: list[tuple[str, bytes]], names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``common`` and ``floors`` from (language, packed presence bits of the letters).

    An n-gram is common if one in a hundred texts of the language hold it, and one more. A floor lies half way between what
    the median text reaches, itself not counted, and what the median text of the nearest other language does; if texts of
    the language scatter wider than that, below their fifth percentile by as much as that is below the median.
    """
    seen = {name: np.unpackbits(np.frombuffer(b"".join(bits for lang, bits in sample if lang == name), np.uint8)).reshape(-1, WIDTH) for name in names}
    held = np.array([seen[name].sum(0, dtype=np.int64) for name in names])
    least = np.array([1 + len(seen[name]) // 100 for name in names])
    common = (held >= least[:, None]).astype(np.uint8)
    reached = {name: np.median(coverage(seen[name], common), axis=0) for name in names}
    floors = np.zeros(len(names))
    for i, name in enumerate(names):
        if len(seen[name]) < LEAST_TEXTS:
            continue
        own = coverage(seen[name], (held[i] > least[i])[None])[:, 0]
        middle, low = np.median(own), np.quantile(own, 0.05)
        other = max([common[i].mean(), *[reached[n][i] for n in names if n != name and len(seen[n]) >= LEAST_TEXTS]])
        floors[i] = max(0.0, min((middle + other) / 2, 2 * low - middle))
    return common, floors


def labelled_sample(train: DataFrame, rows: int, languages: int) -> list[tuple[str, bytes, bytes]]:
    """Up to ``rows`` labelled presence vectors as (language, packed bits, those of the letters), shared evenly by the most
    frequent languages.

    Rows are picked by the hash of their id; the texts themselves stay on the executors.
    """
    counts = (train.where(F.col("lang").isNotNull()).groupBy("lang").count()
              .orderBy(F.desc("count"), "lang").limit(languages).collect())
    if not counts:
        return []
    share = math.ceil(rows / len(counts))
    wanted, span = F.lit(-1), 1 << 30
    for row in counts:
        limit = min(span, math.ceil(span * 1.3 * share / row["count"]) + 1)
        wanted = F.when(F.col("lang") == row["lang"], F.lit(limit)).otherwise(wanted)
    picked = (train.select(F.col("lang"), F.col("text"), F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(span)).alias("_place"))
              .where(F.col("lang").isNotNull() & (F.col("_place") < wanted)))
    vectors = add_columns(picked, "_bits binary, _letters binary", lambda texts: [
        [np.packbits(presence(t)).tobytes() for t in texts], [np.packbits(presence(letters_only(t))).tobytes() for t in texts]])
    found = vectors.select("lang", "_place", "_bits", "_letters").collect()
    out, taken = [], {}
    for row in sorted(found, key=lambda r: (r["_place"], r["lang"], bytes(r["_bits"]))):
        if taken.get(row["lang"], 0) < share:
            taken[row["lang"]] = taken.get(row["lang"], 0) + 1
            out.append((row["lang"], bytes(row["_bits"]), bytes(row["_letters"])))
    return out


def fit(train: DataFrame, rows: int = 2000, landmarks: int = 240, ridge: float = 1e-2, languages: int = 256) -> Model:
    """Fit on at most about ``rows`` labelled rows of ``train`` (doc_id, text, lang); ``landmarks`` of them span the map."""
    sample = labelled_sample(train, rows, languages)
    if not sample:
        return Model(np.zeros((WIDTH, 0), np.float32), np.zeros(0), [])
    names = sorted({lang for lang, _, _ in sample})
    common, floors = coverage_floors([(lang, letters) for lang, _, letters in sample], names)
    sample = [(lang, bits) for lang, bits, _ in sample]
    sample.sort(key=lambda row: row[1])
    chosen, taken = [], {}
    for i, (lang, _) in enumerate(sample):
        if taken.get(lang, 0) < math.ceil(landmarks / len(names)):
            taken[lang] = taken.get(lang, 0) + 1
            chosen.append(i)

    def dense(part):
        return np.unpackbits(np.frombuffer(b"".join(bits for _, bits in part), np.uint8)).reshape(len(part), WIDTH).astype(np.float32)

    marks = dense([sample[i] for i in chosen])
    marks /= np.sqrt(np.maximum(marks.sum(1), 1))[:, None]
    kernel = np.empty((len(sample), len(chosen)), np.float64)
    for start in range(0, len(sample), 200):
        x = dense(sample[start:start + 200])
        kernel[start:start + 200] = (x @ marks.T) / np.sqrt(np.maximum(x.sum(1), 1))[:, None]
    values, vectors = np.linalg.eigh(kernel[chosen])
    kept = values > 1e-6 * values[-1]
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    features = kernel @ whiten
    target = np.array([[float(lang == name) for name in names] for lang, _ in sample])
    middle, mean = features.mean(0), target.mean(0)
    centred = features - middle
    gram = centred.T @ centred + ridge * len(sample) * np.eye(centred.shape[1]) / centred.shape[1]
    beta = np.linalg.solve(gram, centred.T @ (target - mean))
    return Model((marks.T @ (whiten @ beta)).astype(np.float32), mean - middle @ beta, names, common, floors)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return add_columns(docs, "lang_pred string, score double", lambda texts: list(shared.value.predict(texts)))


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose text has a letter and fits a learned language; columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    judged = add_columns(docs, "_fits boolean", lambda texts: [shared.value.fits(texts)])
    return judged.where("_fits").select(*[F.col(f"`{c}`") for c in docs.columns])
