"""Language identification with error-correcting output codes.

Every language has a codeword of bits; for each bit a binary classifier tells the languages with a one from
those with a zero, by log-odds of hashed character n-grams (1 to 3) under either side.  The n-gram counts of
all labelled documents are summed in Spark, so nothing is sampled; a second pass over the same documents
gives each bit's scale and reliability.  Decoding sums a logistic loss over the bits, weighted by their
reliability, and takes the nearest codeword; a runner-up within ``AMBIGUOUS`` marks the row.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without labelled documents
every text is ``und``; with one language every text is that one; rows with a null label teach nothing;
equal losses go to the first language in order; copies get equal results; an empty table gives no rows;
extra columns are ignored.  A text is read in whole, some megabytes of texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brambling.llm.common import col

BUCKETS = 1 << 13
SLICE_CHARS = 2_000_000
AMBIGUOUS = 0.2     # share of the runner-up at and above which a decision is flagged
SHRINK = 10.0       # n-grams of no evidence added to every text
UNKNOWN = "und"
_UNIT = 1 << 24     # margins are summed as whole numbers, so that sums do not depend on their order
_MULTIPLIER = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def codewords(k: int, seed: int = 5) -> np.ndarray:
    """(k, bits) of -1 and 1: all splits for few languages, else the best of many random codes."""
    if k <= 5:
        rows = [[1 if i == 0 or not (c >> (i - 1)) & 1 else -1 for c in range(1, 2 ** (k - 1))] for i in range(k)]
        return np.array(rows, np.int8).reshape(k, -1)
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(k)))
    best, far = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (k, bits))
        code = code[:, np.abs(code.sum(0)) < k]
        apart = int(((code[:, None, :] != code[None, :, :]).sum(2) + np.eye(k, dtype=int) * bits).min())
        if apart > far:
            best, far = code, apart
    return best


def gram_counts(texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(row, n-gram counts by bucket); an n-gram with no letter among its first two characters is left out."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) <= SLICE_CHARS):
            size += len(texts[upto])
            upto += 1
        part = texts[at:upto]
        code = np.frombuffer("\n\n\n".join([*part, ""]).lower().encode("utf-32-le", "surrogatepass"), "<u4")
        letter = _letters()[code]
        code = np.where(letter, code, np.uint32(32)).astype(np.uint64)
        first = code * _MULTIPLIER[0]
        second = (first ^ (first >> np.uint64(29)))[:-1] * _MULTIPLIER[1] + code[1:]
        third = (second ^ (second >> np.uint64(31)))[:-1] * _MULTIPLIER[2] + code[2:]
        shift = np.uint64(64 - (BUCKETS - 1).bit_length())
        bucket = lambda x: ((x ^ (x >> np.uint64(32))) * _MULTIPLIER[0] >> shift).astype(np.int32)
        keys = [bucket(first), bucket(second), bucket(third)]
        keep = [letter, letter[:-1] | letter[1:], letter[:-2] | letter[1:-1]]
        lo = 0
        for i, text in enumerate(part):
            hi = lo + len(text.lower())
            counts = sum(np.bincount(k[lo:hi][m[lo:hi]], minlength=BUCKETS) for k, m in zip(keys, keep))
            yield at + i, counts
            lo = hi + 3
        at = upto


def _blocks(texts: list[str], size: int = 128) -> Iterator[tuple[int, np.ndarray]]:
    """Counts of ``size`` rows at a time as one matrix."""
    held, start = [], 0
    for i, counts in gram_counts(texts):
        held.append(counts)
        if len(held) == size:
            yield start, np.stack(held)
            held, start = [], i + 1
    if held:
        yield start, np.stack(held)


def _count(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their n-gram counts; ``labelled`` is (text, lang)."""

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, counts in gram_counts(texts):
                sums[langs[i]] = sums.get(langs[i], 0) + counts
        for lang, counts in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * BUCKETS), pa.array(range(BUCKETS), pa.int32()), pa.array(counts.astype(np.int64))], names=["lang", "bucket", "n"])

    total = labelled.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = total.filter(F.col("n") > 0).toArrow()          # a row per language and bucket at most
    langs = sorted(set(got["lang"].to_pylist()))
    table = np.zeros((len(langs), BUCKETS))
    table[np.searchsorted(langs, got["lang"].to_pylist()) if langs else [], got["bucket"].to_numpy()] = got["n"].to_numpy()
    return langs, table


class Model:
    """Codewords, bit classifiers and their scales; small enough to travel with the tasks."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.code = langs, codewords(max(len(langs), 1))
        share = counts / np.maximum(counts.sum(1, keepdims=True), 1)
        side = lambda sign: np.stack([share[self.code[:, b] == sign].mean(0) for b in range(self.code.shape[1])], 1)
        floor = 0.05 / BUCKETS
        self.weight = (np.log(side(1) + floor) - np.log(side(-1) + floor)).astype(np.float32) if len(langs) > 1 else np.zeros((BUCKETS, 0), np.float32)
        self.middle = self.scale = self.trust = np.ones(self.code.shape[1])

    def margins(self, counts: np.ndarray) -> np.ndarray:
        total = counts.sum(1, keepdims=True)
        return (counts.astype(np.float32) @ self.weight).astype(np.float64) / (total + SHRINK)

    def calibrate(self, n: np.ndarray, s: np.ndarray, ss: np.ndarray) -> None:
        """Scale and reliability of each bit from number, sum and squares of margins per language and bit."""
        mean = s / np.maximum(n, 1)
        spread = np.maximum(ss / np.maximum(n, 1) - mean ** 2, 1e-8)
        one = [np.where(self.code[:, b] == 1)[0] for b in range(self.code.shape[1])]
        zero = [np.where(self.code[:, b] == -1)[0] for b in range(self.code.shape[1])]
        high = np.array([mean[r, b].mean() for b, r in enumerate(one)])
        low = np.array([mean[r, b].mean() for b, r in enumerate(zero)])
        noise = spread.mean(0)
        self.middle, self.scale = (high + low) / 2, np.maximum(high - low, 0) / noise
        apart = np.clip((high - low) / (2 * np.sqrt(noise)), 0, 6)
        hit = 1 / (1 + np.exp(-1.702 * apart))             # share of rows on the right side of the middle
        self.trust = np.maximum(2 * hit - 1, 1e-3)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, its share, index of the runner-up, and whether the two are close."""
        z = np.clip((margins - self.middle) * self.scale, -12, 12)
        loss = (np.logaddexp(0, -z[:, None, :] * self.code[None]) * self.trust).sum(2)
        share = np.exp(-(loss - loss.min(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(len(loss))
        best, second = order[:, 0], order[:, 1] if loss.shape[1] > 1 else order[:, 0]
        close = (share[rows, second] >= AMBIGUOUS) & (best != second)
        return best, share[rows, best], second, close


def fit(docs: DataFrame, held_out: Column, text: str = "text", lang: str = "lang") -> Model:
    """Learn from the rows that have a label and are not held out."""
    labelled = docs.filter(~held_out & col(lang).isNotNull() & col(text).isNotNull()).select(col(text).alias("text"), col(lang).alias("lang"))
    model = Model(*_count(labelled))
    if len(model.langs) < 2:
        return model

    def measure(batches):
        k, bits = model.code.shape
        sums = np.zeros((k, bits, 3), np.int64)
        for b in batches:
            texts = b.column(0).to_pylist()
            at = np.searchsorted(model.langs, b.column(1).to_pylist())
            for start, counts in _blocks(texts):
                m = model.margins(counts)
                part = np.stack([np.full(m.shape, 1), np.rint(m * _UNIT), np.rint(m * m * _UNIT)], 2).astype(np.int64)
                np.add.at(sums, at[start:start + len(m)], part)
        flat = sums.reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), *[pa.array(flat[:, j]) for j in range(3)]], names=["cell", "n", "s", "ss"])

    measured = labelled.mapInArrow(measure, "cell int, n long, s long, ss long").groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")])
    got = sorted(measured.collect())                        # a row per language and bit
    shaped = [np.array([r[j] for r in got], float).reshape(model.code.shape) for j in (1, 2, 3)]
    model.calibrate(shaped[0], shaped[1] / _UNIT, shaped[2] / _UNIT)
    return model


def identify(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, runner_up, ambiguous) for every row."""
    given = docs.select(col(id).alias("doc_id"), F.when(col(text).rlike(r"\p{L}"), col(text)).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        m = shared.value
        names = np.array([*m.langs, UNKNOWN], object)
        for b in batches:
            n = b.num_rows
            texts = b.column(1).to_pylist()
            there = [i for i, t in enumerate(texts) if t is not None] if m.langs else []
            best, second = np.full(n, len(m.langs)), np.full(n, len(m.langs))
            score, close = np.zeros(n), np.zeros(n, bool)
            for start, counts in _blocks([texts[i] for i in there]):
                rows = there[start:start + len(counts)]
                best[rows], score[rows], second[rows], close[rows] = m.decode(m.margins(counts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names[best], pa.string()), pa.array(score), pa.array(names[second], pa.string()), pa.array(close)],
                                             names=["doc_id", "lang_pred", "score", "runner_up", "ambiguous"])

    return given.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double, runner_up string, ambiguous boolean")


def fold(id: Column) -> Column:
    """Fifth of the documents an id falls into; a null id counts as an empty text."""
    return F.crc32(F.encode(F.coalesce(id.cast("string"), F.lit("")), "utf-8")) % 5
