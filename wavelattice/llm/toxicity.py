"""Toxicity by non-negative positive-unlabelled learning.

The classifier is a linear model over hashed words and byte 5-grams (present or not, scaled to unit length), fitted in
numpy from confirmed toxic texts and unlabelled texts; a present bin has as its value the log ratio of its counts in the two. With class prior p, the risk is ``p * R_P(+) + max(0, R_U(-) - p * R_P(-))``: the unlabelled texts count
as clean, corrected by what the toxic ones among them contribute. Where a step would make the corrected part negative
(the model begins to memorise), that part's gradient is followed upwards instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wavelattice.llm.common import crc_of, keyed_fraction, table, text_pieces
from wavelattice.llm.tokens import FOLD, U64, mix, words

BITS = 17
BINS = 1 << BITS
GRAM = 5
#: Rows that the fit reads: confirmed toxic ones and unlabelled ones (about; drawn by a hash of the id).
POSITIVE_ROWS = 3000
UNLABELLED_ROWS = 8000
EPOCHS = 15
BATCHES = 8
RATE = 0.3
DECAY = 1e-6
_BLOCK_DOCS = 64
#: Added to the counts from which a bin's value comes, and to the squared length of a text.
_PRIOR_COUNT = 20.0
_FLOOR = 5.0


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bin) pairs, sorted: words in the lower half of the bins, 5-grams in the upper.

    ASCII other than letters counts as a blank and ASCII case is folded.
    """
    docs, bins = [], []
    seen = np.zeros(_BLOCK_DOCS * BINS, bool)  # marking in a bitmap is cheaper than sorting
    for at in range(0, len(offsets) - 1, _BLOCK_DOCS):
        o = offsets[at:at + _BLOCK_DOCS + 1]
        x, o = FOLD[data[o[0]:o[-1]]], o - o[0]
        _, _, doc, h = words(x, o)
        seen[(doc << BITS) + (h >> U64(65 - BITS)).astype(np.int64)] = True
        if len(x) >= GRAM:
            owner = np.repeat(np.arange(len(o) - 1), np.diff(o))
            wide, gram = x.astype(U64), np.zeros(len(x) - GRAM + 1, U64)
            for j in range(GRAM):
                gram = (gram << U64(8)) + wide[j:j + len(gram)]
            inside = owner[:len(gram)] == owner[GRAM - 1:]
            pos = (owner[:len(gram)] << BITS) + (BINS >> 1) + (mix(gram) >> U64(65 - BITS)).astype(np.int64)
            seen[pos[inside]] = True
        hit = np.flatnonzero(seen[:(len(o) - 1) << BITS])
        seen[hit] = False
        docs.append((hit >> BITS) + at), bins.append(hit & (BINS - 1))
    return (np.concatenate(docs), np.concatenate(bins)) if docs else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class Rows:
    """Sparse presence rows."""

    def __init__(self, blobs: list[bytes]):
        parts = [np.frombuffer(b, np.int32) for b in blobs]
        self.n = len(parts)
        self.size = np.array([len(p) for p in parts], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        self.bins = np.concatenate([*parts, np.zeros(0, np.int32)])

    def margin(self, rows: np.ndarray, w: np.ndarray, b: float, value: np.ndarray) -> tuple:
        """Margins, and bins, owners and scales for the gradient; ``value``: of each bin where it is present."""
        at = np.repeat(self.start[rows] - np.concatenate([[0], np.cumsum(self.size[rows])[:-1]]), self.size[rows])
        bins = self.bins[at + np.arange(len(at))]
        owner = np.repeat(np.arange(len(rows)), self.size[rows])
        scale = 1 / np.sqrt(_FLOOR + np.bincount(owner, value[bins] ** 2, minlength=len(rows)))
        return np.bincount(owner, (w * value)[bins], minlength=len(rows)) * scale + b, bins, owner, scale


def fit(positive: list[bytes], unlabelled: list[bytes], prior: float) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, intercept and values of the bins, by Adagrad on the non-negative risk with logistic loss."""
    p, u = Rows(positive), Rows(unlabelled)
    n_p, n_u = np.bincount(p.bins, minlength=BINS), np.bincount(u.bins, minlength=BINS) * (p.n / u.n)
    value = np.log((n_p + _PRIOR_COUNT) / (n_u + _PRIOR_COUNT))
    w, b = np.zeros(BINS), float(np.log(prior / (1 - prior)))
    power_w, power_b = np.full(BINS, 1e-8), 1e-8
    rng = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for rp, ru in zip(np.array_split(rng.permutation(p.n), BATCHES), np.array_split(rng.permutation(u.n), BATCHES)):
            if not len(rp) or not len(ru):
                continue
            zp, bp, op, kp = p.margin(rp, w, b, value)
            zu, bu, ou, ku = u.margin(ru, w, b, value)
            sp, su = _logistic(zp), _logistic(zu)
            corrected = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            if corrected >= 0:
                gp, gu = prior * (sp - 1 - sp) / len(rp), su / len(ru)
            else:  # go back up on the corrected part alone
                gp, gu = prior * sp / len(rp), -su / len(ru)
            g = value * (np.bincount(bp, (gp * kp)[op], minlength=BINS) + np.bincount(bu, (gu * ku)[ou], minlength=BINS)) + DECAY * w
            gb = gp.sum() + gu.sum()
            power_w += g * g
            power_b += gb * gb
            w -= RATE * g / np.sqrt(power_w)
            b -= RATE * gb / np.sqrt(power_b)
    return w, b, value


def _bins_of(df: DataFrame) -> DataFrame:
    def run(batches):
        for part, data, offsets in text_pieces(batches, "text"):
            doc, bins = features(data, offsets)
            cut = np.searchsorted(doc, np.arange(part.num_rows + 1))
            bins = bins.astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([bins[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary())],
                                             names=["positive", "bins"])
    return df.mapInArrow(run, "positive boolean, bins binary")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic",
          positive_rows: int = POSITIVE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS):
    """Model from documents and labels, or None without confirmed toxic texts. The prior is that of all given labels."""
    per = labels.where(F.col(key).isNotNull() & F.col(toxic).isNotNull()).groupBy(key).agg(F.max(toxic).alias("_toxic"))
    n_pos, n_all = per.agg(F.coalesce(F.sum((F.col("_toxic") == 1).cast("bigint")), F.lit(0)), F.count(F.lit(1))).first()
    n_docs = docs.count()
    if not n_pos or not n_docs:
        return None
    prior = min(0.9, max(1e-3, n_pos / n_all))
    chosen = per.where((F.col("_toxic") == 1) & (keyed_fraction(F.col(key), "positive") < min(1.0, positive_rows / n_pos)))
    # at most about positive_rows ids, whatever the size of the input
    ids = F.broadcast(chosen.select(F.col(key).alias("_id")).limit(2 * positive_rows))
    share = min(1.0, unlabelled_rows / n_docs)
    tagged = docs.select(F.col(key), F.col(text).alias("text")).join(ids, F.col(key) == F.col("_id"), "left")
    tagged = tagged.where(F.col("_id").isNotNull() | (keyed_fraction(F.col(key), "unlabelled") < share))
    found = _bins_of(tagged.select(F.col("_id").isNotNull().alias("positive"), "text"))

    def learn(batches):
        t = pa.Table.from_batches(list(batches), schema=pa.schema([("positive", pa.bool_()), ("bins", pa.binary())]))
        rows = sorted(zip(t.column(0).to_pylist(), t.column(1).to_pylist()))  # the order of arrival does not count
        pos, unl = [x for y, x in rows if y], [x for y, x in rows if not y]
        if pos and unl:
            w, b, value = fit(pos, unl, prior)
            both = np.stack([w * value, value ** 2]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([both.tobytes()], pa.binary()), pa.array([b])], names=["w", "b"])

    model = found.limit(2 * (positive_rows + unlabelled_rows)).coalesce(1).mapInArrow(learn, "w binary, b double").collect()
    return (np.frombuffer(model[0]["w"], np.float32).reshape(2, BINS).astype(np.float64), model[0]["b"]) if model else None


def score(docs: DataFrame, model, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of ``docs`` with ``into``: the probability of the toxic class; 0 if there is no model."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # one weight per bin
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches):
        for part, data, offsets in text_pieces(batches, text):
            out = np.zeros(part.num_rows)
            if shipped.value is not None:
                (w, square), b = shipped.value
                doc, bins = features(data, offsets)
                length = np.sqrt(_FLOOR + np.bincount(doc, square[bins], minlength=part.num_rows))
                out = _logistic(np.bincount(doc, w[bins], minlength=part.num_rows) / length + b)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.float64())], names=[*part.schema.names, into])

    return docs.mapInArrow(run, f"{schema}, `{into}` double")


def rate_documents(docs: DataFrame, labels: DataFrame, held_out, key: str = "doc_id", text: str = "text",
                   toxic: str = "toxic") -> DataFrame:
    """``key, held_out, score, predicted`` for every document, learned from rows that are not held out.

    ``held_out`` is a condition on the key, applied to documents and labels alike. Several labels of a document count as
    toxic if one does; null labels are none. Null and empty texts get the score of a text without words. Without a
    confirmed toxic text every score is 0. Repeated rows get equal scores. Other columns are not read.
    """
    src = docs.select(key, text)
    model = train(src.where(~held_out), labels.where(~held_out), key, text, toxic)
    out = score(src, model, text)
    return out.select(key, held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark, sf: str) -> DataFrame:
    return rate_documents(table(spark, sf, "documents"), table(spark, sf, "labels"), crc_of() % 5 == 0)
