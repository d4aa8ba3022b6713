"""Language identification with a blended-spectrum presence kernel.

A text is the set of its byte n-grams of several lengths (hashed), and the kernel of two texts is the number of common
n-grams over the root of the product of their numbers. Nyström landmarks approximate the kernel machine, and a ridge
regression per language against the rest is fitted on a bounded, stratified sample of labelled rows. As the kernel is
linear in the presence vectors, landmarks and ridge weights fold into one matrix (n-gram by language), and a
batch of texts is scored by one matrix product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wavelattice.llm.common import crc_of, keyed_fraction, table, text_pieces
from wavelattice.llm.tokens import FOLD, U64, mix

ORDERS = (1, 2, 3, 4)
BINS = 1 << 15
LANDMARKS = 384
RIDGE = 1e-3
#: Labelled rows that the fit reads, over all languages (about; drawn by a hash of the id).
SAMPLE_ROWS = 3000
UNKNOWN = "und"
_BLOCK_DOCS = 256


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts by hashed n-grams, bool. ASCII other than letters counts as a blank; case is folded for ASCII."""
    n_docs = len(offsets) - 1
    out = np.zeros((n_docs, BINS), bool)
    flat = out.ravel()
    x = FOLD[data].astype(U64)
    base = np.repeat(np.arange(n_docs, dtype=np.int64) * BINS, np.diff(offsets))
    gram = np.zeros(len(x), U64)
    for n in range(1, max(ORDERS) + 1):
        gram = gram[:len(x) - n + 1] * U64(257) + x[n - 1:] + U64(1) if len(x) >= n else gram[:0]
        if n in ORDERS and len(gram):
            bins = (mix(gram + U64(n << 56)) >> U64(49)).astype(np.int64)
            inside = base[:len(gram)] == base[n - 1:]
            flat[(base[:len(gram)] + bins)[inside]] = True
    return out


def _blocks(data: np.ndarray, offsets: np.ndarray):
    for at in range(0, len(offsets) - 1, _BLOCK_DOCS):
        o = offsets[at:at + _BLOCK_DOCS + 1]
        yield presence(data[o[0]:o[-1]], o - o[0])


def _unit(bits: np.ndarray) -> np.ndarray:
    x = bits.astype(np.float32)
    return x / np.sqrt(np.maximum(1.0, x.sum(axis=1, keepdims=True)))


def fit(packed: list[bytes], langs: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, folded weights (n-gram by language) and intercepts from packed presence rows."""
    names = sorted(set(langs))
    y = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    rows = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), BINS // 8)
    take = np.random.default_rng(7).permutation(len(rows))[:LANDMARKS]
    marks = _unit(np.unpackbits(rows[take], axis=1))
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    phi = np.concatenate([_unit(np.unpackbits(rows[i:i + 256], axis=1)) @ marks.T for i in range(0, len(rows), 256)])
    phi = phi.astype(np.float64) @ root
    share = np.array([langs.count(n) for n in names], float)
    weight = sum((y[:, j] > 0) / share[j] for j in range(len(names)))  # every language weighs the same
    weight *= len(rows) / weight.sum()
    mean, target = (phi * weight[:, None]).mean(axis=0), (y * weight[:, None]).mean(axis=0)
    a, b = (phi - mean) * np.sqrt(weight)[:, None], (y - target) * np.sqrt(weight)[:, None]
    w = np.linalg.solve(a.T @ a / len(rows) + RIDGE * np.eye(a.shape[1]), a.T @ b / len(rows))
    return names, (marks.T.astype(np.float64) @ (root @ w)).astype(np.float32), target - mean @ w


def train(docs: DataFrame, key: str, text: str, lang: str, sample_rows: int = SAMPLE_ROWS):
    """Fit on about ``sample_rows`` rows with text and language, the same number of every language where it has them."""
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(lang).count().collect()}  # one row per language
    if not counts:
        return None
    each = max(1, sample_rows // len(counts))
    share = F.element_at(F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, each / n))]), F.col(lang))
    drawn = usable.where(keyed_fraction(F.col(key), "langid") < share).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def bits(batches):
        for part, data, offsets in text_pieces(batches, "text"):
            rows = np.concatenate([np.packbits(b, axis=1) for b in _blocks(data, offsets)])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in rows], pa.binary())],
                                             names=["lang", "bits"])

    def learn(batches):
        t = pa.Table.from_batches(list(batches), schema=pa.schema([("lang", pa.string()), ("bits", pa.binary())]))
        if t.num_rows:
            t = t.sort_by([("lang", "ascending"), ("bits", "ascending")])  # the order of arrival does not count
            names, w, b = fit(t.column("bits").to_pylist(), t.column("lang").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([np.ascontiguousarray(c).tobytes() for c in w.T], pa.binary()),
                                              pa.array(b, pa.float64())], names=["lang", "weights", "bias"])

    model = (drawn.mapInArrow(bits, "lang string, bits binary").limit(2 * sample_rows + 100).coalesce(1)
             .mapInArrow(learn, "lang string, weights binary, bias double").collect())  # 128 KB per language
    if not model:
        return None
    model.sort(key=lambda r: r["lang"])
    return ([r["lang"] for r in model], np.stack([np.frombuffer(r["weights"], np.float32) for r in model], axis=1),
            np.array([r["bias"] for r in model]))


def classify(docs: DataFrame, model, key: str, text: str) -> DataFrame:
    """``key, lang_pred, score``; null texts and texts without a letter are ``und`` with score 0."""
    kind = docs.schema[key].dataType.simpleString()
    src = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    src = src.withColumn("_letter", F.col("_text").rlike(r"\p{L}"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, data, offsets in text_pieces(batches, "_text"):
            letter = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
            if shipped.value is None:
                pred, score = np.full(len(letter), UNKNOWN, object), np.zeros(len(letter))
            else:
                names, w, b = shipped.value
                out = []
                for bits in _blocks(data, offsets):
                    x = bits.astype(np.float32)
                    out.append((x @ w) / np.sqrt(np.maximum(1.0, x.sum(axis=1, keepdims=True))) + b)
                f = np.concatenate(out)
                best = f.argmax(axis=1)
                score = np.clip((f[np.arange(len(f)), best] + 1) / 2, 0, 1)
                pred = np.where(letter, np.array(names, object)[best], UNKNOWN)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pred, pa.string()),
                                              pa.array(np.where(letter, score, 0.0), pa.float64())], names=[key, "lang_pred", "score"])

    return src.mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")


def identify_languages(docs: DataFrame, held_out, key: str = "doc_id", text: str = "text", lang: str = "lang",
                       sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``key, held_out, lang_pred, score`` for every row, learned from rows that are not held out.

    Rows with a null language are not learned from. Null texts and texts without a letter are ``und``, score 0; so is
    everything if there is nothing to learn from. Repeated rows get equal predictions. Other columns are not read.
    """
    model = train(docs.where(~held_out), key, text, lang, sample_rows)
    out = classify(docs, model, key, text)
    return out.select(key, held_out.alias("held_out"), "lang_pred", "score")


def query(spark, sf: str) -> DataFrame:
    return identify_languages(table(spark, sf, "documents").select("doc_id", "text", "lang"), crc_of() % 4 == 2)
