"""Toxicity by maximal scoring segments over token log-odds.

Tokens are words and their inner letter runs of five. Log-odds of toxic against other labelled texts have a Dirichlet
prior at the tokens' overall shares. A word scores the best lower bound among its tokens that are significant; any other
common word scores its upper bound where that is below -DRIFT, and all else costs DRIFT, so that chance segments stay
short. A linear scan finds all maximal scoring segments of a text. Tokens chosen on four fifths of the labelled texts
give, on the fifth that they haven't seen, the extreme-value law of the best segment of a text that is not toxic. The
same rule then chooses tokens on all of them, and these are scored by that law: a few more words score than it was
fitted to, each by stronger evidence. A segment counts if the law expects it at most LEVEL times in so many words, and a
logistic fit turns what a text's segments exceed the law by into a score.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.language_id import remainder
from geoloom.llm.textvec import slices, span_hashes, tidy, words
from geoloom.storage import cut_lineage

#: Labelled rows that the fit takes at most: one of each id, those of the least id hash. One in CALIBRATE of them sets
#: the extreme-value law of tokens that are chosen on the others.
TRAIN_ROWS = 40_000
CALIBRATE = 5
#: A word in so large a share of the texts has a score of its own even if it is not significant.
COMMON = 0.005
#: A segment counts if so many or fewer like it are expected in a text of this length that is not toxic.
LEVEL = 0.05
PRIOR_SHARE = 0.04
#: Prior of the texts without a token at least, as a share of all.
LEAST_PRIOR = 1e-6
SIGNIFICANT = 2.8
#: Least lower bound of the log-odds of a scoring token: weaker ones follow topics and styles.
LEAST = 3.5
DRIFT = 0.1
RUN = 5
#: Words whose scores a task keeps.
KEPT_WORDS = 400_000


@lru_cache(maxsize=200_000)
def tokens_of(word: str) -> tuple[str, ...]:
    """A word's tokens: its letters in lower case, and their inner runs."""
    letters = word.lower()
    if not letters.isalpha():
        letters = "".join(filter(str.isalpha, letters))
    runs = {"~" + letters[k : k + RUN] for k in range(len(letters) - RUN + 1)} if len(letters) >= RUN else set()
    return (letters, *runs) if letters else ()


def words_of(text: str | None) -> set[str]:
    """The different words of a text: runs of characters other than 0x20 and 0x09-0x0D."""
    return {w.decode("utf-8", "replace") for w in (text or "").encode("utf-8", "replace").split()}


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last) of a text's token scores, in linear time.

    Ruzzo and Tompa's scan: each positive score opens a segment that merges with the nearest earlier one whose left sum is
    lower, as long as the right sum grows. Each segment keeps which that one is, so those between are never seen again.
    """
    sums = np.append(0.0, np.cumsum(scores))
    at = np.flatnonzero(scores > 0)
    found: list[tuple[float, float, int, int, int]] = []
    for low, high, k in zip(sums[at].tolist(), sums[at + 1].tolist(), at.tolist(), strict=True):
        first, j = k, len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= low:
                j = found[j][4]
            if j < 0 or found[j][1] >= high:
                break
            low, _, first, _, before = found[j]
            del found[j:]
            j = before
        found.append((low, high, first, k, j))
    return [(high - low, first, last) for low, high, first, last, _ in found]


def fit_maxima(best: np.ndarray, words: np.ndarray) -> tuple[float, float]:
    """(decay, rate) of the law P(best <= x) = exp(-rate * words * exp(-decay * x)) for the best segments of texts.

    The likelihood is that of the law cut off at 0, where a text has no segment; one made-up text of middling best score
    keeps it finite. Given the decay the best rate is known, and the decay is the best of a grid.
    """
    best = np.append(best, np.mean(best[best > 0]) if (best > 0).any() else LEAST)
    words = np.append(words, max(1.0, float(np.mean(words)) if len(words) else 1.0))
    above = best > 0
    options = []
    for decay in np.geomspace(0.05, 5, 120):
        rate = above.sum() / (words * np.exp(-decay * best)).sum()
        options.append((above.sum() * (np.log(rate) + np.log(decay) - 1) - decay * best[above].sum(), decay, rate))
    return max(options)[1:]


@dataclass
class Model:
    """scores: what words and runs (~) score, where it is not -DRIFT; the law of maxima; the logistic fit."""

    scores: dict[str, float]
    decay: float
    rate: float
    slope: float
    offset: float

    def word_score(self, word: str) -> float:
        """The best score among a word's tokens if that is positive, else that of the word itself."""
        own = [self.scores.get(t, -DRIFT) for t in tokens_of(word)]
        best = max(own, default=-DRIFT)
        return best if best > 0 or not own else own[0]

    def scan(self, column: pa.Array):
        """Number of words, and the scoring segments with their first and last word, of each text of a column.

        A slice's distinct words are scored once, and known again by their hashes.
        """
        known, values = getattr(self, "_known", (np.empty(0, np.uint64), np.empty(0)))
        for part in slices(column):
            found = words(part)
            distinct, first, each = np.unique(span_hashes(part.data, found.start, found.end), return_index=True, return_inverse=True)
            if len(known) + len(distinct) > KEPT_WORDS:
                known, values = known[:0], values[:0]
            new = ~np.isin(distinct, known, assume_unique=True)
            if new.any():
                data, some = part.data.tobytes(), first[new]
                own = [self.word_score(data[a:b].decode("utf-8", "replace")) for a, b in zip(found.start[some].tolist(), found.end[some].tolist(), strict=True)]
                known, values = np.concatenate((known, distinct[new])), np.concatenate((values, own))
                order = np.argsort(known)
                known, values = known[order], values[order]
            scores = values[np.searchsorted(known, distinct)][each]
            some = np.append(0, np.cumsum(scores > 0))[found.first]
            for a, b, there in zip(found.first[:-1].tolist(), found.first[1:].tolist(), np.diff(some).tolist(), strict=True):
                yield b - a, segments(scores[a:b]) if there else []
        self._known = known, values

    def significant(self, n: int, found: list[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
        """The segments of which the law expects LEVEL at most in n words."""
        return [s for s in found if self.rate * n * np.exp(-self.decay * s[0]) <= LEVEL]

    def excess(self, n: int, found: list[tuple[float, int, int]]) -> float:
        """By how much a text's significant segments together exceed what the law expects in n words, damped; 0 without any."""
        return float(np.log1p(sum(self.decay * s - np.log(self.rate * n) for s, _, _ in self.significant(n, found))))


def _count(batches):
    """Texts of either label that have each token, within a task."""
    yes, no = Counter(), Counter()
    names = lambda: pa.RecordBatch.from_arrays([pa.array(keys := list(yes.keys() | no.keys())), pa.array([yes[k] for k in keys], pa.int64()), pa.array([no[k] for k in keys], pa.int64())], ["token", "yes", "no"])
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            (yes if label else no).update({t for w in words_of(text.as_py()) for t in tokens_of(w)})
            if len(yes) + len(no) > 1_000_000:
                yield names()
                yes.clear()
                no.clear()
    if yes or no:
        yield names()


def _outside(batches, whole: frozenset[str], runs: frozenset[str]):
    """Texts of either label that have each run in a word that is not itself among whole, within a task."""
    yes, no = Counter(), Counter()
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = (tokens_of(w) for w in words_of(text.as_py()))
            (yes if label else no).update({t for found in own if found and found[0] not in whole for t in found if t in runs})
    keys = list(yes.keys() | no.keys())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([yes[k] for k in keys], pa.int64()), pa.array([no[k] for k in keys], pa.int64())], ["token", "yes", "no"])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, float]:
    """Slope and offset of a logistic fit by Newton steps, halved until the penalised loss falls."""

    def loss(v: np.ndarray) -> float:
        m = v[0] * x + v[1]
        return float(np.logaddexp(0, m).sum() - (y * m).sum() + ridge / 2 * (v @ v))

    v = np.array([0.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(v[0] * x + v[1], -30, 30)))
        w = p * (1 - p)
        grad = np.array([((p - y) * x).sum(), (p - y).sum()]) + ridge * v
        step = np.linalg.solve(np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum() + ridge]]), grad)
        while loss(v - step) > loss(v) and np.abs(step).max() > 1e-9:
            step = step / 2
        v = v - step
        if np.abs(step).max() <= 1e-9:
            break
    return max(float(v[0]), 1e-3), float(v[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from the labelled rows of docs. Null labels don't count, and of several labels of an id the highest does,
    of several texts of an id the one of the least hash; without both labels every text scores near the one there is
    (0 if there is none). A token of all labelled texts says nothing."""
    labelled = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    labelled = labelled.groupBy("id").agg(F.max("label").alias("label"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    chosen = labelled.join(rows.select("id"), "id", "left_semi").orderBy(F.xxhash64("id")).limit(TRAIN_ROWS)
    one = F.min(F.struct(F.xxhash64("text").alias("mark"), "text")).alias("one")
    rows = rows.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(one).select("id", "label", "one.text")
    rows = cut_lineage(rows)  # TRAIN_ROWS at most, read six times below
    apart = F.pmod(F.hash("id"), F.lit(CALIBRATE)) == 0
    model = Model(choose(rows.where(~apart).select("label", "text")), 1.0, 1.0, 1.0, 0.0)

    def scan(batches):
        for batch in batches:
            found = list(model.scan(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([k for k, _ in found], pa.int64()), pa.array([[s for s, _, _ in f] for _, f in found], pa.list_(pa.float64()))], ["label", "n", "segments"])

    seen = rows.where(apart).select("label", "text").mapInArrow(scan, "label int, n long, segments array<double>").collect()  # TRAIN_ROWS / CALIBRATE rows of numbers
    if {r.label for r in seen} != {0, 1}:
        return Model({}, 1.0, 1.0, 1.0, 4.0 if any(r.label for r in seen) else -4.0)
    clean = [r for r in seen if not r.label]
    model.decay, model.rate = fit_maxima(np.array([max(r.segments, default=0.0) for r in clean]), np.array([float(max(r.n, 1)) for r in clean]))
    x = np.array([model.excess(r.n, [(s, 0, 0) for s in r.segments]) for r in seen])
    slope, offset = logistic(x, np.array([float(r.label) for r in seen]))
    return Model(choose(rows.select("label", "text")), model.decay, model.rate, slope, offset)


def choose(rows: DataFrame) -> dict[str, float]:
    """What the words and runs of rows (label, text) score, where that is not -DRIFT; nothing unless both labels are there."""
    n = {row.label: row["count"] for row in rows.groupBy("label").count().collect()}
    toxic, other = n.get(1, 0), n.get(0, 0)
    if not toxic or not other:
        return {}
    counted = rows.mapInArrow(_count, "token string, yes long, no long").groupBy("token").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    prior = PRIOR_SHARE * (toxic + other)
    a = prior * (F.col("yes") + F.col("no")) / (toxic + other)
    up, down = F.col("yes") + a, F.col("no") + a
    # The texts without the token have a prior too, a small one even where there is none.
    without = lambda total, own: F.greatest(total + prior - own, F.lit(LEAST_PRIOR * (total + prior)))
    off_up, off_down = without(toxic, up), without(other, down)
    odds = F.log(up / off_up) - F.log(down / off_down)
    spread = F.sqrt(1 / up + 1 / down + 1 / off_up + 1 / off_down)
    scoring = (F.col("yes") > 2) & (odds / spread >= SIGNIFICANT) & (odds - spread >= LEAST)
    common = ~F.col("token").startswith("~") & (F.col("yes") + F.col("no") >= COMMON * (toxic + other)) & (odds + spread < -DRIFT)
    found = counted.select("token", F.when(scoring, odds - spread).when(common, odds + spread).alias("score")).where("score IS NOT NULL")
    scores = {row.token: row.score for row in found.collect()}  # bounded by the texts of TRAIN_ROWS rows and the share

    # A run that owes its odds to one scoring word, and is common in the other texts' own words, says nothing of these.
    whole = frozenset(t for t, v in scores.items() if v > 0 and t[0] != "~")
    runs = frozenset(t for t in scores if t[0] == "~")
    alone = rows.mapInArrow(lambda batches: _outside(batches, whole, runs), "token string, yes long, no long").groupBy("token").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    for row in alone.where("no > 0").collect():  # runs at most
        if np.log((row.yes + 0.5) / toxic) - np.log((row.no + 0.5) / other) < LEAST:
            del scores[row.token]
    return scores


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, held_out, score, predicted, segments, first_word, last_word) for every row of docs.

    Learns from labels whose crc32(id) mod 5 is not 0. Nothing but the text decides a score: null and empty texts get
    that of a text without a scoring token. segments counts the significant segments; first_word and last_word bound
    the best one (null if there is none). Null ids and repeated rows are rows like others; other columns are not
    read; an empty table gives an empty result.
    """
    model = train(docs.where(remainder(id_col, 5) != 0), labels, id_col, text_col, label_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by what it is fitted on
    rows = docs.select(F.col(id_col).alias("id"), (remainder(id_col, 5) == 0).alias("held_out"), F.col(text_col).cast("string").alias("text"))

    @tidy
    def score(batches):
        m = sent.value
        for batch in batches:
            found = [(n, m.significant(n, f)) for n, f in m.scan(batch.column(2))]
            x = np.array([m.excess(n, f) for n, f in found])
            p = 1 / (1 + np.exp(-np.clip(m.slope * x + m.offset, -30, 30)))
            best = [max(f, default=(0, None, None)) for _, f in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32)), pa.array([len(f) for _, f in found], pa.int64()), pa.array([b[1] for b in best], pa.int64()), pa.array([b[2] for b in best], pa.int64())],
                ["id", "held_out", "score", "predicted", "segments", "first_word", "last_word"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(score, f"id {kind}, held_out boolean, score double, predicted int, segments long, first_word long, last_word long").withColumnRenamed("id", id_col)
