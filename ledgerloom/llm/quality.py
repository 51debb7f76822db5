"""A quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document.  Expectation-maximisation
over the counts of vote patterns (of all documents; at most 3 to the number of labellers) estimates
how each labeller votes on good and on bad documents, and with that the posterior label
of every pattern.  The posteriors train a linear scorer on hashed features of words, word shapes and
repetition, fitted on a sample of at most ``fit_rows`` documents (those with the smallest hash of
id and text).  Every document is then scored, whole.

Nulls and edges: a null, empty or blank text has no words; labellers that need words abstain on it, and it
is scored by the bias and its length alone.  Rows that repeat an id are voted on and scored one by one; a null id stays null.
An empty table trains nothing and gives an empty result.  If all documents look
alike, the scorer follows the majority.  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_value
from ledgerloom.llm.words import Words, by_size, words_of

by_value(__name__)

GOOD, BAD, ABSTAIN = 0, 1, 2
DIMENSIONS = 1 << 15
FIT_ROWS = 8000
AT_ONCE = 2 << 20  # bytes of text whose words are looked at together; their arrays take ten times that and more
FEW = 8  # below so many words all labellers abstain
LEAST = 20.0  # words that a text's hashed features are shared among at least
# value of a measure at which a labeller votes good, and from which on it votes bad; it abstains between them
LABELLERS: tuple[tuple[str, float, float], ...] = (
    ("symbols", 0.06, 0.12),  # share of bytes that are ASCII symbols
    ("capitals", 0.15, 0.60),  # share of ASCII letters that are capitals
    ("repeats", 0.05, 0.15),  # share of words equal to one of the two before
    ("same_lines", 0.10, 0.30),  # share of lines that stood before
    ("marked", 0.02, 0.10),  # share of words that end in two symbols
    ("bare", 0.02, 0.10),  # share of words without letter or digit
    ("endless", 0.96, 0.99),  # share of words that end no sentence
    ("uneven", 2.0, 3.5),  # distance of the mean word length from six bytes
)


def measures(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """The words of a batch, and for every text one value per labeller; NaN makes it abstain."""
    words = words_of(texts)
    data = words.data
    upper = (data >= 0x41) & (data <= 0x5A)
    letter = upper | ((data >= 0x61) & (data <= 0x7A))
    plain = letter | ((data >= 0x30) & (data <= 0x39)) | (data >= 0x80)
    sizes = np.diff(words.bounds)
    last = data[np.maximum(words.bounds[1:] - 1, 0)] if len(data) else np.zeros(0, np.uint8)
    second = np.where(sizes > 1, data[np.maximum(words.bounds[1:] - 2, 0)], 0x61) if len(data) else last
    is_symbol = lambda b: ~((b >= 0x80) | ((b >= 0x30) & (b <= 0x39)) | (((b | 0x20) >= 0x61) & ((b | 0x20) <= 0x7A)))
    per = lambda values: words.per_text(values.astype(np.float64)[words.codes])
    count = words.counts.astype(np.float64)
    size = per(sizes)
    codes = words.codes
    again = np.zeros(len(codes), bool)
    again[1:] = codes[1:] == codes[:-1]
    again[2:] |= codes[2:] == codes[:-2]
    lines = [t.split(b"\n") for t in (x or b"" for x in texts.cast(pa.large_binary()).to_pylist())]
    repeated = np.array([1 - len(set(x)) / len(x) if len(x) > 3 else np.nan for x in lines])
    with np.errstate(invalid="ignore", divide="ignore"):
        out = np.stack(
            [
                per(words.per_word(~plain)) / size,
                per(words.per_word(upper)) / per(words.per_word(letter)),
                words.per_text(again.astype(np.float64)) / count,
                repeated,
                per(is_symbol(last) & is_symbol(second)) / count,
                per(words.per_word(plain) == 0) / count,
                np.where(count >= 30, 1 - per(np.isin(last, list(b".!?")) & ~is_symbol(second)) / count, np.nan),
                np.abs(size / count - 6),
            ],
            axis=1,
        )
    out = out.reshape(len(texts), len(LABELLERS))
    out[count < FEW] = np.nan  # shares of a few words say nothing
    return words, out


def votes_of(values: np.ndarray) -> np.ndarray:
    low, high = (np.array([x[i] for x in LABELLERS]) for i in (1, 2))
    return np.select([values < low, values >= high], [GOOD, BAD], ABSTAIN)


def pattern_of(votes: np.ndarray) -> np.ndarray:
    return votes @ 3 ** np.arange(votes.shape[1])


@dataclass
class LabelModel:
    prior: np.ndarray  # of good and bad
    tables: np.ndarray  # labeller, true label, vote -> probability among votes; abstaining tells nothing

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability that a document with these votes is good."""
        n = self.tables.shape[0]
        logs = np.log(self.prior)[None, :] + np.log(self.tables)[np.arange(n)[None, :], :, votes].sum(axis=1)
        logs -= logs.max(axis=1, keepdims=True)
        weights = np.exp(logs)
        return weights[:, GOOD] / weights.sum(axis=1)


def fit_label_model(patterns: dict[int, int], labellers: int, steps: int = 100) -> LabelModel:
    """Expectation-maximisation over the pattern counts, begun at the majority of the votes."""
    keys = np.array(sorted(patterns), np.int64)
    counts = np.array([patterns[k] for k in keys.tolist()], np.float64)
    votes = keys[:, None] // 3 ** np.arange(labellers) % 3
    for_good, for_bad = (votes == GOOD).sum(axis=1), (votes == BAD).sum(axis=1)
    # good votes are the common case, so two bad ones outweigh them at first
    good = 1 / (1 + np.exp(3.0 * for_bad - 0.5 * for_good - 1.0))
    for _ in range(steps):
        weights = np.stack([good, 1 - good]) * counts
        prior = weights.sum(axis=1) + 1
        cast = np.stack([[[(w * (votes[:, j] == v)).sum() for v in (GOOD, BAD)] for w in weights] for j in range(labellers)]) + 0.5
        shares = cast / cast.sum(axis=2, keepdims=True)
        model = LabelModel(prior / prior.sum(), np.concatenate([shares, np.ones((labellers, 2, 1))], axis=2))
        before, good = good, model.posterior(votes)
        if np.abs(good - before).max() < 1e-6:
            break
    return model


def _shape(word: bytes) -> bytes:
    """Letters, capitals and digits as classes, runs of one class or symbol once."""
    out = bytearray()
    for b in word:
        c = 97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b
        if not out or out[-1] != c:
            out.append(c)
    return bytes(out)


def feature_codes(words: Words) -> np.ndarray:
    """Two hashed features of every distinct word: the word and its shape."""
    digest = xxhash.xxh3_64_intdigest
    found = [(digest(w.lower(), 1) % DIMENSIONS, digest(_shape(w), 2) % DIMENSIONS) for w in words.distinct()]
    return np.array(found, np.int64).reshape(-1, 2)


def text_features(values: np.ndarray) -> np.ndarray:
    """Per text the measures themselves, bounded, and whether each exists."""
    known = ~np.isnan(values)
    scale = np.array([x[2] for x in LABELLERS])
    return np.concatenate([np.where(known, np.minimum(values / scale, 2.0), 0.0), known], axis=1)


@dataclass
class Scorer:
    hashed: np.ndarray
    plain: np.ndarray
    bias: float

    def score(self, words: Words, values: np.ndarray) -> np.ndarray:
        codes = feature_codes(words)
        weights = self.hashed[codes].sum(axis=1) if len(codes) else np.zeros(0)
        means = words.per_text(weights[words.codes]) / np.maximum(words.counts, LEAST)
        return 1 / (1 + np.exp(-np.clip(means + text_features(values) @ self.plain + self.bias, -50, 50)))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def vote(rows: DataFrame) -> DataFrame:
    """The vote pattern of every row."""

    def run(batches):
        for batch in by_size(batches, 1, AT_ONCE):
            _, values = measures(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pattern_of(votes_of(values)), pa.int64())], names=["doc_id", "pattern"]
            )

    return rows.mapInArrow(run, "doc_id long, pattern long")


def _training_rows(rows: DataFrame, fit_rows: int) -> DataFrame:
    """Hashed counts of at most ``fit_rows`` rows, those with the smallest hash of id and text."""
    drawn = rows.withColumn("draw", F.xxhash64("doc_id", "text", F.lit(4)))
    last = drawn.select("draw").orderBy("draw").limit(fit_rows).agg(F.max("draw")).first()[0]

    def run(batches):
        for batch in by_size(batches, 1, AT_ONCE):
            words, values = measures(batch.column(1))
            codes, flat = feature_codes(words), text_features(values)
            out = []
            for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
                places, counts = np.unique(codes[words.codes[a:b]], return_counts=True)
                out.append((places.astype(np.int32), counts.astype(np.float32) / max(b - a, LEAST), flat[i]))
            kinds = [pa.list_(pa.int32()), pa.list_(pa.float32()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(pattern_of(votes_of(values)), pa.int64()), *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]],
                names=["draw", "pattern", "places", "shares", "plain"],
            )

    picked = drawn.where(F.col("draw") <= F.lit(last))
    found = picked.mapInArrow(run, "draw long, pattern long, places array<int>, shares array<float>, plain array<double>")
    return found.orderBy("draw").limit(fit_rows)  # copies of one row share its hash


def fit_scorer(places: list[np.ndarray], shares: list[np.ndarray], plain: np.ndarray, wanted: np.ndarray, steps: int = 300,
               rate: float = 0.5, decay: float = 1e-5) -> Scorer:
    """Logistic regression on soft labels, by full-batch AdaGrad; both classes weigh the same."""
    at = np.repeat(np.arange(len(places)), [len(p) for p in places])
    where = np.concatenate(places) if places else np.zeros(0, np.int64)
    value = np.concatenate(shares).astype(np.float64) if shares else np.zeros(0)
    hashed, flat, bias = np.zeros(DIMENSIONS), np.zeros(plain.shape[1]), 0.0
    squares = [np.full(DIMENSIONS, 1e-6), np.full(plain.shape[1], 1e-6), 1e-6]
    good = max(wanted.sum(), 1e-9)
    bad = max((1 - wanted).sum(), 1e-9)
    n = len(wanted)
    for _ in range(steps if n else 0):
        z = np.bincount(at, value * hashed[where], minlength=n) + plain @ flat + bias
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        error = (1 - wanted) * p / bad - wanted * (1 - p) / good
        steps_now = [
            np.bincount(where, value * error[at], minlength=DIMENSIONS) + decay * hashed,
            plain.T @ error + decay * flat,
            error.sum(),
        ]
        for i, g in enumerate(steps_now):
            squares[i] = squares[i] + g * g
        hashed = hashed - rate * steps_now[0] / np.sqrt(squares[0])
        flat = flat - rate * steps_now[1] / np.sqrt(squares[1])
        bias = bias - rate * steps_now[2] / np.sqrt(squares[2])
    return Scorer(hashed, flat, float(bias))


@dataclass
class Classifier:
    labels: LabelModel
    scorer: Scorer
    threshold: float = 0.5


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Classifier | None:
    rows = _rows(docs, id_col, text_col)
    counted = vote(rows).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3 ** 8 rows
    if not counted:
        return None
    model = fit_label_model({r.pattern: r.n for r in counted}, len(LABELLERS))
    sample = _training_rows(rows, fit_rows).toArrow()
    patterns = sample.column("pattern").to_numpy()
    wanted = model.posterior(patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3)
    lists = [[np.asarray(x) for x in sample.column(name).to_numpy()] for name in ("places", "shares")]
    plain = np.array(sample.column("plain").to_pylist(), np.float64).reshape(-1, 2 * len(LABELLERS))
    return Classifier(model, fit_scorer(*lists, plain, wanted))


def _scored(docs: DataFrame, model: Classifier, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        for batch in by_size(batches, 1, AT_ONCE):
            words, values = measures(batch.column(1))
            score = model.scorer.score(words, values)
            votes = votes_of(values)
            columns = [
                batch.column(0),
                pa.array((votes == GOOD).sum(axis=1), pa.int32()),
                pa.array((votes == BAD).sum(axis=1), pa.int32()),
                pa.array(model.labels.posterior(votes), pa.float64()),
                pa.array(score, pa.float64()),
                pa.array(score >= model.threshold),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "good_votes", "bad_votes", "posterior", "score", "keep"])

    return _rows(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, good_votes int, bad_votes int, posterior double, score double, keep boolean"
    )


def classify(docs: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, votes, posterior of the votes, score and ``keep`` of every row."""
    model = fit(docs, fit_rows, id_col, text_col)
    if model is None:
        model = Classifier(fit_label_model({0: 1}, len(LABELLERS)), fit_scorer([], [], np.zeros((0, 2 * len(LABELLERS))), np.zeros(0)))
    return _scored(docs, model, id_col, text_col)


def keep_good(docs: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their columns."""
    model = fit(docs, fit_rows, id_col, text_col)
    if model is None:
        return docs
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in by_size(batches, at, AT_ONCE):
            words, values = measures(batch.column(at).cast(pa.string()))
            yield batch.filter(pa.array(model.scorer.score(words, values) >= model.threshold))

    return docs.mapInArrow(run, docs.schema)
