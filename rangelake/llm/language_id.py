"""Language ID by a string kernel.

The kernel is the blended spectrum of presence: of the character 1-, 2- and 3-grams (letters in lower case, anything else
a gap), how many two texts share, over the geometric mean of how many each has. Landmark texts of each language span a
Nystroem approximation, and one-versus-rest kernel ridge regression is solved in it, so scoring a batch is two matrix
products: presence by landmarks, then kernel values by languages. The score is the winner's decision value, from -1..1
moved to 0..1.

``known_language`` drops texts that resemble no learned language: of the 3-grams at their places, those with a letter, too
few stand in any landmark. The bound is REJECT times the share that all but QUANTILE of the labelled texts reach which are
no landmarks. A text is dropped if its share is below by more than DOUBT deviations of a draw of as many 3-grams, so a
text of very few letters, which tells nothing, stays.

Fitted on a bounded sample: of each of the LANGUAGES most frequent values of lang, TRAIN texts (LANDMARKS of them as
landmarks) of at most LONGEST characters, drawn by a hash of doc_id, and at most SAMPLE texts in all; every text is then
scored whole. Languages that the sample holds are learned. No letter is left out: n-grams are numbers made of their code
points, and looked up among those of the landmarks.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing can be learned.
Rows with a null lang are never learned from. Repeated rows are scored alike. An empty table gives an empty result.
Other columns are ignored, and carried along by ``known_language``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangelake.llm.shared import in_fold, steps

TRAIN, LANDMARKS, LONGEST, LANGUAGES, SAMPLE = 200, 32, 20_000, 200, 4000
RIDGE = 1e-2
#: Bits of a code point, and characters of a text that are worked on at once.
_BITS, PIECE = 21, 1 << 16
#: What part of the usual share of known 3-grams a text needs, what part of the labelled texts is unusual, and the doubt.
REJECT, QUANTILE, DOUBT = 0.5, 0.01, 2.0
FOLDS, HELD_OUT = 3, 1


@cache
def _letters() -> np.ndarray:
    """Of each code point: that of its letter in lower case; 0, a gap, if it is no letter."""
    out = np.zeros(0x110000, dtype=np.int32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            lower = c.lower()
            out[code] = ord(lower) if len(lower) == 1 else code
    return out


def _grams(text: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers of the 1-, 2- and 3-grams of a text, in pieces of a long one, each two characters over into the next."""
    for at in range(0, len(text), PIECE):
        c = _letters().take(np.frombuffer(text[at : at + PIECE + 2].encode("utf-32-le", "surrogatepass"), dtype="<u4")).astype(np.int64)
        two = (c[:-1] << _BITS) | c[1:]
        yield c, two, (two[:-1] << _BITS) | c[2:]


@dataclass(frozen=True)
class Model:
    known: tuple[np.ndarray, ...]  # numbers of the landmarks' n-grams in ascending order, for n = 1, 2, 3
    landmarks: np.ndarray  # columns (1-, 2- and 3-grams in this order) x landmarks, of length 1
    weights: np.ndarray  # landmarks x languages
    languages: tuple[str, ...]
    bound: float = 0.0  # share of known 3-grams below which a text is foreign

    def _columns(self, n: int, grams: np.ndarray) -> np.ndarray:
        """Columns of n-grams; a column behind the last one for those that no landmark has."""
        known = self.known[n - 1]
        none = sum(map(len, self.known))
        if not len(known):
            return np.full(len(grams), none)
        at = np.searchsorted(known, grams)
        at[at == len(known)] = 0
        return np.where(known.take(at) == grams, at + sum(map(len, self.known[: n - 1])), none)

    def familiar(self, text: str) -> tuple[int, int]:
        """How many 3-grams with a letter stand in a landmark, and how many there are; a gap is on either side of the text."""
        known = total = 0
        for _, _, grams in _grams(f" {text} "):
            grams = grams[grams > 0]
            known += int((self._columns(3, grams) < self.landmarks.shape[0]).sum())
            total += len(grams)
        return known, total

    def foreign(self, text: str) -> bool:
        known, total = self.familiar(text)
        return known < self.bound * total - DOUBT * (total * self.bound * (1 - self.bound)) ** 0.5

    def presence(self, texts: list[str]) -> np.ndarray:
        n = self.landmarks.shape[0]
        out = np.zeros((len(texts), n + 1), dtype=np.float32)
        for row, text in zip(out, texts, strict=True):
            for pieces in _grams(text):
                for k, grams in enumerate(pieces, 1):
                    row[self._columns(k, grams)] = 1
        return out[:, :n]

    def kernel(self, texts: list[str]) -> np.ndarray:
        p = self.presence(texts)
        size = np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))
        return (p @ self.landmarks) / size

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        scores = np.zeros(len(texts))
        names = ["und"] * len(texts)
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if self.languages else []
        for lo in range(0, len(known), 64):
            rows = known[lo : lo + 64]
            decisions = self.kernel([texts[i] for i in rows]) @ self.weights
            best = decisions.argmax(axis=1)
            scores[rows] = np.clip((decisions[np.arange(len(rows)), best].astype(float) + 1) / 2, 0, 1)
            for i, b in zip(rows, best.tolist(), strict=True):
                names[i] = self.languages[b]
        return names, scores


def fit(sample: list[tuple[str, str]]) -> Model:
    """sample: (language, text), the first LANDMARKS of each language being its landmarks."""
    sample = [(lang, text) for lang, text in sample if any(map(str.isalpha, text))]
    languages = tuple(sorted({lang for lang, _ in sample}))
    if not languages:
        return Model((), np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32), ())
    seen: Counter = Counter()
    marks, others = [], []
    for lang, text in sample:
        seen[lang] += 1
        (marks if seen[lang] <= LANDMARKS else others).append(text)
    used = tuple(np.unique(np.concatenate([np.unique(piece[n]) for t in marks for piece in _grams(t)])) for n in range(3))
    model = Model(used, np.zeros((sum(map(len, used)), 1), np.float32), np.zeros((1, 1)), languages)
    p = model.presence(marks)
    model = Model(used, (p / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))).T.copy(), np.zeros((1, 1)), languages)
    values, vectors = np.linalg.eigh(model.kernel(marks).astype(np.float64))
    keep = values > 1e-8 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = model.kernel([t for _, t in sample]).astype(np.float64) @ root
    targets = np.array([[1.0 if lang == x else -1.0 for x in languages] for lang, _ in sample])
    ridge = RIDGE * len(sample) / max(1, features.shape[1]) * np.eye(features.shape[1])
    weights = root @ np.linalg.solve(features.T @ features + ridge, features.T @ targets)
    shares = [known / max(1, total) for known, total in map(model.familiar, others or marks)]
    return Model(used, model.landmarks, weights.astype(np.float32), languages, REJECT * float(np.quantile(shares, QUANTILE)))


def train(docs: DataFrame) -> Model:
    """Fits on the bounded sample of labelled rows outside the held-out fold."""
    labelled = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~in_fold(F.col("doc_id"), FOLDS, HELD_OUT) & (F.length("text") <= LONGEST))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()}
    if not counts:
        return fit([])
    most = min(TRAIN, max(1, SAMPLE // len(counts)))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2.0 * most / n))])
    rows = labelled.filter(draw < share[F.col("lang")]).select("lang", "text", draw.alias("draw")).collect()
    picked: dict[str, dict[str, None]] = {}
    for r in sorted(rows, key=lambda r: (r["draw"], r["text"])):
        own = picked.setdefault(r["lang"], {})
        if len(own) < most:
            own[r["text"]] = None  # copies count once
    return fit([(lang, text) for lang in sorted(picked) for text in picked[lang]])


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            names, scores = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", in_fold(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "text")
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def known_language(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are ``und`` or resemble no learned language; all rows if nothing could be learned."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = batch.column("text").to_pylist()
            names, _ = shared.value.predict(texts)
            yield batch.filter(pa.array([n != "und" and not shared.value.foreign(t) for n, t in zip(names, texts, strict=True)], pa.bool_())) if shared.value.languages else batch

    return docs.mapInArrow(keep, docs.schema)
