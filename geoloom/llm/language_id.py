"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes one space, and the 1-, 2- and 3-grams of code
points are hashed into ``BUCKETS``. Document frequencies cover every learning row. Weights are learned
on a bounded sample by follow-the-regularised-leader with elastic-net penalties (McMahan et al., 2013),
one coordinate learning rate each; a temperature fitted on a part of the sample that the weights
haven't seen calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.tables import row_key, texts

BUCKETS, BLOCK = 1 << 15, 1 << 20
UNDETERMINED = "und"
_letter: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Whether a code point is a letter (general category L), for all planes."""
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letter


def _add(c: np.ndarray, counts: np.ndarray, done: int) -> None:
    """Count the n-grams of c that end behind its first ``done`` code points."""
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ np.uint32(0x51ED270B)) * np.uint32(0x85EBCA6B) + c[1:] * np.uint32(0xC2B2AE35)
    three = (two[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(0x165667B1) + c[2:] * np.uint32(0x9E3779B1)
    for n, h in enumerate((one, two, three)):
        h = h[max(0, done - n) :]
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        counts += np.bincount(h >> np.uint32(17), minlength=BUCKETS)


def ngrams(text: bytes, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of a text's n-grams; empty if it has no letter. A long text is worked through in blocks."""
    counts, any_letter = np.zeros(BUCKETS, np.int64), False
    whole = text.decode("utf-8", "replace").lower()
    last, done, joined = np.array([32], np.uint32), 0, True  # what stands before the block, how much of that is counted, whether it ends without a letter
    for at in range(0, len(whole), block):
        c = np.frombuffer(whole[at : at + block].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[c]
        any_letter |= bool(letter.any())
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first of a run of other characters stands for the run
        keep[0] |= not joined
        joined = not letter[-1]
        x = np.concatenate((last, np.where(letter, c, 32)[keep], [32] if at + block >= len(whole) else [])).astype(np.uint32)
        _add(x, counts, done)
        last = x[-2:]
        done = len(last)
    at = np.flatnonzero(counts) if any_letter else np.zeros(0, np.int64)
    return at, counts[at]


def weigh(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    return x / max(np.sqrt(x @ x), 1e-12)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # languages x (BUCKETS + 1), the last for the bias
    temperature: float

    def scores(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.weights[:, at] @ weigh(at, counts, self.idf) + self.weights[:, -1]

    def probabilities(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return softmax(self.scores(at, counts) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(languages: list[str], idf: np.ndarray, rows: list[tuple], alpha: float = 0.5, beta: float = 1.0, l1: float = 0.002, l2: float = 0.01, epochs: int = 4) -> Model:
    """rows: (language, buckets, counts). Every fifth row is kept for the temperature."""
    k = len(languages)
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))
    index = {x: i for i, x in enumerate(languages)}
    learn = [r for i, r in enumerate(rows) if i % 5] or rows
    held = rows[::5]

    def weights(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(learn)):
            language, at, counts = learn[i]
            x = np.append(weigh(at, counts, idf), 1.0)
            at = np.append(at, BUCKETS)
            w = weights(at)
            error = softmax(x @ w)
            error[index[language]] -= 1
            g = x[:, None] * error
            more = g * g
            z[at] += g - (np.sqrt(n[at] + more) - np.sqrt(n[at])) / alpha * w
            n[at] += more
    model = Model(languages, idf, np.ascontiguousarray(weights(np.arange(BUCKETS + 1)).T), 1.0)
    if held:
        found, truth = np.array([model.scores(at, counts) for _, at, counts in held]), np.array([index[x] for x, _, _ in held])
        loss = lambda t: -np.log(softmax(found / t)[np.arange(len(truth)), truth] + 1e-12).mean()
        model.temperature = float(min(np.geomspace(0.3, 5, 60), key=loss))
    return model


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text in texts(batch, "text"):
            df[ngrams(text)[0]] += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["bucket", "n"])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [ngrams(t) for t in texts(batch, "text")]
        rest = [batch.column(batch.schema.get_field_index(c)) for c in ("k", "lang")]
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([*rest, pa.array([x[0].astype(np.int32) for x in found], kind), pa.array([x[1].astype(np.int32) for x in found], kind)], names=["k", "lang", "at", "counts"])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, str, np.ndarray, np.ndarray]]:
    """(k, lang, at, counts) of each row; the arrays stay in Arrow's memory."""
    k, lang, at, counts = (batch.column(batch.schema.get_field_index(c)) for c in ("k", "lang", "at", "counts"))
    i, j = at.offsets.to_numpy(), counts.offsets.to_numpy()
    at, counts = at.values.to_numpy(), counts.values.to_numpy()
    for r in range(batch.num_rows):
        yield k[r].as_py(), lang[r].as_py(), at[i[r] : i[r + 1]], counts[j[r] : j[r + 1]]


def learn(docs: DataFrame, sample_rows: int = 2400) -> Model | None:
    """The model of ``docs`` (doc_id, text, lang): rows with a null lang or doc_id teach nothing; None without rows.

    Document frequencies are of all rows. Weights are learned from about ``sample_rows`` rows, as many of
    each language as far as there are: those of least hash of doc_id and text, repeated rows taken once.
    """
    rows = docs.select("doc_id", "text", "lang", row_key().alias("k")).where("lang is not null and doc_id is not null")
    counted = rows.groupBy("lang").agg(F.count("*").alias("n"), F.countDistinct("k").alias("different")).collect()
    per = {r["lang"]: r["different"] for r in counted}
    if not per:
        return None
    languages, total = sorted(per), sum(r["n"] for r in counted)
    df = np.zeros(BUCKETS)
    found = rows.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    df[found["bucket"].to_numpy()] = found["n"].to_numpy()
    idf = np.log((1 + total) / (1 + df)) + 1
    each = max(20, sample_rows // len(languages))
    # twice as many as wanted by hash, of these the least of each language
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, 2 * each / per[lang]))])
    place = F.pmod("k", F.lit(1 << 40))
    chosen = rows.where(place < share[F.col("lang")] * float(1 << 40)).dropDuplicates(["k", "lang"])
    chosen = chosen.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(place, "k"))).where(F.col("rank") <= each)
    gathered = chosen.select("k", "lang", "text").mapInArrow(_grams, "k long, lang string, at array<int>, counts array<int>").toArrow()
    sample = [row for batch in gathered.to_batches() for row in _rows(batch) if len(row[2])]
    return fit(languages, idf, [x[1:] for x in sorted(sample, key=lambda x: (x[0], x[1]))])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred and score (probability of lang_pred) appended, any columns of these names replaced.

    lang_pred is ``und`` and score 0 where the text is null or has no letter, and everywhere without a model.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = [], []
            for text in texts(batch, "text"):
                at, counts = ngrams(text) if model else ((), ())
                if len(at):
                    p = model.probabilities(at, counts)
                    best.append(model.languages[int(p.argmax())])
                    score.append(float(p.max()))
                else:
                    best.append(UNDETERMINED)
                    score.append(0.0)
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(best, pa.string()), pa.array(score, pa.float64())], names=[*(f.name for f in kept), "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    schema = StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.select(*[f.name for f in kept]).mapInArrow(run, schema)


def held_out(modulus: int, remainder: int):
    """Whether crc32 of doc_id as text leaves ``remainder``; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


def query(docs: DataFrame) -> DataFrame:
    model = learn(docs.where(~held_out(4, 2)))
    return identify(docs.select("doc_id", held_out(4, 2).alias("held_out"), "text"), model).drop("text")
