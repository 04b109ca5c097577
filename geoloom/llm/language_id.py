"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all labelled rows. The regression is fitted by follow-the-regularised-leader with
elastic-net penalties on a sample of labelled texts bounded by TRAIN_PER_LANGUAGE, TRAIN_TEXTS and MAX_LANGUAGES, and one
part of the sample that it doesn't see sets the temperature of the softmax.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.textvec import GOLDEN, U, give_back, mix64
from geoloom.llm.vectors import summed

BUCKETS = 1 << 15
#: Labelled texts that a language gives to the fit at most: those of the least hash, each once.
TRAIN_PER_LANGUAGE = 600
#: Labelled texts that all languages give together, one of each at least, and languages that the fit learns at most: those
#: of the most different texts. Values of a dirty column beyond them are not learned.
TRAIN_TEXTS = 12_000
MAX_LANGUAGES = 256
#: Hashes are thinned out in so many steps.
STEPS = 1 << 20
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.01
UNKNOWN = "und"

#: Runs of other characters than letters and the marks on them.
NO_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's character 1- to 3-grams and their counts; runs without letters count as one space."""
    letters = NO_LETTERS.sub(" ", (text or "").lower()).strip()
    if not LETTER.search(letters):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    two = codes[:-1] << U(21) | codes[1:]
    three = two[:-1] << U(21) | codes[2:]
    salted = np.concatenate((codes, two + GOLDEN, three))
    counts = np.bincount((mix64(salted) >> U(49)).astype(np.int64), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass
class Model:
    """The weights other than 0 stand bucket by bucket: those of bucket b from begin[b] on, each with its language."""

    languages: list[str]
    idf: np.ndarray
    begin: np.ndarray
    language: np.ndarray
    weight: np.ndarray
    temperature: float

    @staticmethod
    def of(languages: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float) -> Model:
        at, language = np.nonzero(weights.T)
        return Model(languages, idf, np.searchsorted(at, np.arange(BUCKETS + 1)), language.astype(np.int32), weights.T[at, language], temperature)

    def logits(self, found: np.ndarray, values: np.ndarray) -> np.ndarray:
        count = self.begin[found + 1] - self.begin[found]
        at = np.arange(count.sum()) + np.repeat(self.begin[found] - np.cumsum(count) + count, count)
        return np.bincount(self.language[at], self.weight[at] * np.repeat(values, count), len(self.languages))

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        found, counts = grams(text)
        values = np.log1p(counts) * self.idf[found]
        return found, values / max(np.sqrt(values @ values), 1e-12)

    def predict(self, text: str | None) -> tuple[str, float]:
        found, values = self.features(text)
        if not len(found) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(found, values) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, epochs: int = EPOCHS, seed: int = 7) -> np.ndarray:
    """Weights (classes, BUCKETS) after FTRL-proximal passes over rows (class, buckets, values)."""
    z, n = np.zeros((classes, BUCKETS)), np.zeros((classes, BUCKETS))

    def weights(at) -> np.ndarray:
        far = np.sign(z[:, at]) * L1 - z[:, at]
        return np.where(np.abs(z[:, at]) <= L1, 0.0, far / ((BETA + np.sqrt(n[:, at])) / ALPHA + L2))

    for epoch in range(epochs):
        for k in np.random.default_rng(seed + epoch).permutation(len(rows)):
            label, at, values = rows[k]
            w = weights(at)
            p = softmax(w @ values)
            p[label] -= 1
            g = p[:, None] * values
            more = n[:, at] + g * g
            z[:, at] += g - (np.sqrt(more) - np.sqrt(n[:, at])) / ALPHA * w
            n[:, at] = more
    return weights(slice(None)).astype(np.float32)


def fit_temperature(logits: list[np.ndarray], labels: list[int]) -> float:
    """The temperature between 1/20 and 20 with the least negative log-likelihood."""
    low, high = np.log(0.05), np.log(20.0)

    def loss(t: float) -> float:
        return -sum(np.log(max(softmax(x / np.exp(t))[y], 1e-12)) for x, y in zip(logits, labels, strict=True))

    for _ in range(40):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def remainder(id_col: str, m: int) -> Column:
    """crc32 of the id as text mod m; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % m


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """A model from the rows of labelled whose language is not null. Without any text it knows no language.

    Every language with a text that has a letter is learned, up to MAX_LANGUAGES, however often its texts repeat: equal
    texts count once in the fit. The driver holds half a MB for each language and the vectors of TRAIN_TEXTS texts.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang IS NOT NULL")
    place = F.xxhash64("text")
    sizes = rows.where(F.col("text").rlike(r"\p{L}")).groupBy("lang").agg(F.approx_count_distinct(place, 0.02).alias("texts"))
    most = sizes.orderBy(F.desc("texts"), "lang").limit(MAX_LANGUAGES).collect()
    languages = sorted(row.lang for row in most)
    if not languages:
        return Model.of([], np.ones(BUCKETS), np.zeros((0, BUCKETS), np.float32), 1.0)
    wanted = min(TRAIN_PER_LANGUAGE, max(1, TRAIN_TEXTS // len(languages)))

    def fill(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for text in batch.column(0):
            total[grams(text.as_py())[0]] += 1
        total[BUCKETS] += len(batch)

    df = summed(rows.select("text"), fill, BUCKETS + 1)
    idf = np.log((1 + df[BUCKETS]) / (1 + df[:BUCKETS])) + 1

    # A share of each language's hashes that holds half as many texts again as wanted, then the least of these.
    shares = labelled.sparkSession.createDataFrame([(row.lang, min(STEPS, STEPS * (3 * wanted // 2 + 20) // max(row.texts, 1))) for row in most], "lang string, share long")
    own = F.pmod(place, F.lit(STEPS))
    near = rows.where(F.col("text").rlike(r"\p{L}")).join(F.broadcast(shares), "lang").where(own < F.col("share"))  # MAX_LANGUAGES rows
    near = near.select("lang", "text", place.alias("place")).dropDuplicates(["lang", "place"])
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("place", F.lit(STEPS)), "place"))
    drawn = near.withColumn("turn", turn).where(F.col("turn") <= wanted)

    def vectors(batches):
        for batch in batches:
            found = [grams(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a.astype("<u2").tobytes() for a, _ in found], pa.binary()), pa.array([c.astype("<u4").tobytes() for _, c in found], pa.binary())], ["lang", "at", "counts"]
            )

    sample = []
    for row in drawn.select("lang", "text").mapInArrow(vectors, "lang string, at binary, counts binary").collect():  # bounded by the sample
        at = np.frombuffer(row.at, "<u2").astype(np.int64)
        if len(at):
            values = np.log1p(np.frombuffer(row.counts, "<u4")) * idf[at]
            sample.append((languages.index(row.lang), at, values / np.sqrt(values @ values)))
    sample.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes()))
    # A fifth of each language is held back, but no language's last text.
    count = dict.fromkeys(range(len(languages)), 0)
    kept, held = [], []
    for row in sample:
        (held if count[row[0]] % 5 == 4 else kept).append(row)
        count[row[0]] += 1
    weights = fit_ftrl(kept, len(languages))
    temperature = fit_temperature([weights[:, at] @ values for _, at, values in held], [y for y, _, _ in held]) if held else 1.0
    del sample, kept, held
    give_back()
    return Model.of(languages, idf, weights, temperature)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score, which replace columns of these names.

    A null text and one without a letter get und and score 0; the score of others is the calibrated probability of the
    language. Nothing but the text decides. An empty table gives an empty result.
    """
    rows = docs.drop("lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most a weight for each language and bucket
    place = rows.columns.index(text_col)

    def predict(batches):
        for batch in batches:
            found = [sent.value.predict(text.as_py()) for text in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([lang for lang, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", lang_pred string, score double"
    return rows.mapInArrow(predict, schema)


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score): trained on the rows with crc32(id) mod 3 other than 1, predicted for all.

    Null and empty texts and those without a letter get und and 0, as all do if no language can be learned. Null ids
    count as empty text; they and repeated rows are rows like others, whose equal texts get equal predictions; other columns
    are not read; an empty table gives an empty result.
    """
    model = train(docs.where(remainder(id_col, 3) != 1), lang_col, text_col)
    rows = docs.select(id_col, (remainder(id_col, 3) == 1).alias("held_out"), text_col)
    return identify(rows, model, text_col).drop(text_col)
