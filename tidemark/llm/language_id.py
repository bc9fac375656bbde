"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features: the lower-cased text with everything but letters turned into spaces; all 1- to 3-grams of its code
points, hashed to BUCKETS; weights (1 + ln count) * idf, scaled to length 1. Document frequencies are counted
over all training documents. The model is fitted by follow-the-regularised-leader (per-coordinate rates, elastic
net) on at most PER_LANGUAGE documents of each language, chosen by a hash of their id; that bound is the only
sampling, everything else covers all rows. A fifth of the fitted sample is kept from FTRL and sets the
temperature by which logits are divided.

Predictions use the text alone. Defined results: a null text or one without a letter is ``und`` with score 0, as
is every text if there is no training document; a text may have any length, as a task holds one batch of texts; an empty
table gives no rows; repeated rows each get a row; ``held_out`` is null for a null
doc_id, which is never trained on; other columns are ignored. Both passes over the texts are maps; only one row
for each hash bucket and task is shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm.texts import map_batches, to_batch

BITS = 15
BUCKETS = 1 << BITS
PER_LANGUAGE = 400
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-4, 1e-4
FOLDS = 5
MIN_SCORE = 0.5
UNKNOWN = "und"

_FOLD = np.array([i if chr(i).isalpha() else 32 for i in range(0x10000)], dtype=np.uint32)
_M1, _M2, _M3, _MIX = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Hash buckets of the text's n-grams and their counts; None if it has no letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if points.max() < 0x10000:
        points = _FOLD[points]
    else:
        points = np.array([p if chr(p).isalpha() else 32 for p in points.tolist()], dtype=np.uint32)
    letters = points != 32
    if not letters.any():
        return None
    points = points[letters | np.concatenate(([True], letters[:-1]))]  # one space for each gap
    padded = np.concatenate((points[:0], np.array([32], np.uint32), points, np.array([32], np.uint32)))
    one = padded * _M1
    two = (one[:-1] ^ (one[:-1] >> np.uint32(13))) * _M2 + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(11))) * _M3 + one[2:]
    hashed = np.concatenate((one, two, three))
    hashed = ((hashed ^ (hashed >> np.uint32(15))) * _MIX) >> np.uint32(32 - BITS)
    counts = np.bincount(hashed, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def weigh(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1.0 + np.log(counts)) * idf[at]
    return (x / np.linalg.norm(x)).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # one row for each bucket, one column for each language
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features(text) if self.languages else None
        if found is None:
            return UNKNOWN, 0.0
        p = softmax(weigh(*found, self.idf) @ self.weights[found[0]] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> np.ndarray:
    """Weights from (buckets, weights, class) rows by FTRL-proximal, each row's gradient in turn."""
    z = np.zeros((BUCKETS, classes), np.float32)
    n = np.zeros((BUCKETS, classes), np.float32)

    def weights(at):
        return np.where(np.abs(z[at]) <= L1, 0.0, -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for at, x, label in rows:
            w = weights(at)
            error = softmax(x @ w)
            error[label] -= 1.0
            gradient = x[:, None] * error
            squared = gradient * gradient
            z[at] += gradient - (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / ALPHA * w
            n[at] += squared
    return weights(slice(None)).astype(np.float32)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, on a fixed grid."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.05, 20.0, 121)
    losses = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            found = features(text)
            if found is not None:
                df[found[0]] += 1
    at = np.flatnonzero(df)
    yield to_batch({"bucket": at, "df": df[at]}, {"bucket": pa.int32(), "df": pa.int64()})


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t) for t in batch.column("text").to_pylist()]
        keep = [i for i, f in enumerate(found) if f is not None]
        yield to_batch(
            {
                "order": [batch.column("order")[i].as_py() for i in keep],
                "lang": [batch.column("lang")[i].as_py() for i in keep],
                "at": [found[i][0].astype(np.uint16).tobytes() for i in keep],
                "counts": [found[i][1].astype(np.uint32).tobytes() for i in keep],
            },
            {"order": pa.int64(), "lang": pa.string(), "at": pa.binary(), "counts": pa.binary()},
        )


def train(documents: DataFrame) -> Model:
    """The model of (doc_id, text, lang), learnt outside the held-out fold."""
    known = documents.select("text", "lang", F.xxhash64("doc_id").alias("order")).filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    sizes = {row["lang"]: row["n"] for row in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0), np.float32), 1.0)
    counted = map_batches(known.select("text"), _frequencies, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df"))
    df = np.zeros(BUCKETS)
    for row in counted.toLocalIterator():
        df[row["bucket"]] = row["df"]
    idf = np.log((1.0 + sum(sizes.values())) / (1.0 + df)) + 1.0

    place = (F.col("order").cast("double") / 2.0**64) + 0.5
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(PER_LANGUAGE / n)).otherwise(share)
    sample = map_batches(known.filter(place < share), _sample, "order long, lang string, at binary, counts binary")
    rows = []
    for row in sorted(sample.collect(), key=lambda r: (r["order"], r["lang"], bytes(r["at"]))):
        at = np.frombuffer(row["at"], np.uint16).astype(np.int64)
        rows.append((at, weigh(at, np.frombuffer(row["counts"], np.uint32), idf), languages.index(row["lang"])))
    tuning, fitting = rows[::FOLDS], [r for i, r in enumerate(rows) if i % FOLDS]
    weights = fit_ftrl(fitting or rows, len(languages))
    logits = np.array([x @ weights[at] for at, x, _ in tuning]).reshape(len(tuning), len(languages))
    return Model(languages, idf, weights, fit_temperature(logits, np.array([label for _, _, label in tuning], int)))


def identify(texts: DataFrame, model: Model, keep: list[str], said: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns of ``texts``, of any types, with the language and its score under the names ``said``."""
    shared = texts.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers, whatever the input
    given = texts.select(*[F.col(f"`{name}`") for name in keep], F.col("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.predict(t.as_py()) for t in batch.column(len(keep))]
            columns = [*batch.columns[: len(keep)], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *said])

    schema = StructType([*given.schema.fields[: len(keep)], StructField(said[0], StringType()), StructField(said[1], DoubleType())])
    return map_batches(given, work, schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(documents)
    return identify(documents.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), model, ["doc_id", "held_out"])


def stage_language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: not ``und``, with a score of at least MIN_SCORE. All columns stay."""
    said = f"_{uuid.uuid4().hex}", f"_{uuid.uuid4().hex}"  # no column of docs has these names
    judged = identify(docs, train(docs.select("doc_id", "text", "lang")), docs.columns, said)
    return judged.filter((F.col(said[0]) != UNKNOWN) & (F.col(said[1]) >= MIN_SCORE)).drop(*said)
