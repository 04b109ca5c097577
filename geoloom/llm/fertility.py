"""Quality rules by tokeniser fertility.

Two public vocabularies measure every text, word by word: characters per byte-level token, the share of byte-fallback
pieces, and the entropy of the piece distribution against the most that so many pieces can have. Bands around the middle
half of all texts of a language reject what lies far outside. A language's quartiles are drawn towards those of the texts
in the row's script, and a script's towards those of all texts, as much as PULL texts would draw them, so that few
texts set no band alone. Texts that fail the base rules are rejected first. Words are runs of characters other than
0x20 and 0x09-0x0D.
"""

from __future__ import annotations

import itertools
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.textvec import slices, span_hashes, windows, words
from geoloom.storage import cut_lineage

# The symbols that the base counts ask for.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

#: A measure is rejected further than SPREADS middle-half widths (REACH at least) outside the middle half.
SPREADS = 2.0
REACH = {"chars_per_token": 0.05, "fallback_share": 0.02, "entropy_share": 0.06}
#: Measures are counted in bins of 1 / BINS, so quartiles are the same however the rows are dealt out.
BINS = 1000
#: Texts that the quartiles of the wider group count for beside a group's own.
PULL = 20
#: A table of bands of up to so many rows is sent to the tasks; a longer one is joined by shuffle.
FEW_BANDS = 10_000
#: Words whose measures a task keeps.
CACHE_ENTRIES = 200_000

# Names of Unicode scripts. Letters of others, also those of several scripts, count as Other.
SCRIPTS = [
    "none", "Latin", "Greek", "Cyrillic", "Armenian", "Hebrew", "Arabic", "Syriac", "Thaana", "Devanagari", "Bengali", "Gurmukhi", "Gujarati", "Oriya", "Tamil",
    "Telugu", "Kannada", "Malayalam", "Sinhala", "Thai", "Lao", "Tibetan", "Myanmar", "Georgian", "Ethiopic", "Cherokee", "Khmer", "Mongolian", "Balinese", "Javanese",
    "Han", "Hiragana", "Katakana", "Hangul", "Bopomofo", "Other",
]
#: Code points that scripts() tells apart: the planes of letters. Higher ones hold none.
LAST_CODE = 0x40000


@lru_cache(maxsize=1)
def script_table() -> np.ndarray:
    """The number of each code point's script; 0 for what is no letter or mark of a script."""
    every = "".join(map(chr, (c for c in range(LAST_CODE) if not 0xD800 <= c < 0xE000)))
    out = np.zeros(LAST_CODE + 1, np.uint8)
    for pattern, k in [(r"\p{L}+", len(SCRIPTS) - 1), *((rf"\p{{Script={name}}}+", k) for k, name in enumerate(SCRIPTS[1:-1], 1))]:
        for m in regex.finditer(pattern, every):
            a, b = ord(m[0][0]), ord(m[0][-1]) + 1
            out[a:b] = k
    out[0xD800:0xE000] = 0
    return out


def scripts(part) -> list[str]:
    """The script that most letters of each row of a slice have, the first listed of equals; none without a letter."""
    if not part.rows:
        return []
    table, data = script_table(), part.data
    if len(data) and data.max() >= 0x80:
        # One number for each byte that isn't a continuation, so that rows keep their places.
        heads = (data & 0xC0) != 0x80
        try:
            codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        except UnicodeDecodeError:  # bytes that are no UTF-8 have no script
            codes = np.where(data[heads] < 0x80, data[heads], LAST_CODE)
        begin = np.append(0, np.cumsum(heads))[part.begin]
    else:
        codes, begin = data, part.begin
    found = table[np.minimum(codes, LAST_CODE) if codes.dtype != np.uint8 else codes]
    at = np.flatnonzero(found)
    row = np.searchsorted(begin, at, "right") - 1
    counts = np.bincount(row * len(SCRIPTS) + found[at], minlength=part.rows * len(SCRIPTS)).reshape(part.rows, -1)
    return [SCRIPTS[k] for k in counts.argmax(axis=1)]


def base_counts(part) -> np.ndarray:
    """For each row of a slice: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    found, rows, data = words(part), part.rows, part.data
    n_words = np.diff(found.first)
    out = np.zeros((rows, 5), np.int64)
    out[:, 0] = n_words
    if not len(data):
        return out
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = np.concatenate(([0], np.cumsum(heads[found.end] - heads[found.start])))
    out[:, 1] = chars[found.first[1:]] - chars[found.first[:-1]]
    marks = np.concatenate(([0], np.cumsum(SYMBOLS[data])))
    out[:, 2] = marks[part.begin[1:]] - marks[part.begin[:-1]]

    ends = np.flatnonzero(data == 10)
    edge = np.zeros(len(data) + 1, bool)
    edge[part.begin[:-1]] = True
    edge[ends + 1] = True
    edge[len(data)] = False
    start = np.flatnonzero(edge)
    stop = np.concatenate((start[1:], [len(data)]))
    stop = stop - ((data[stop - 1] == 10) & (stop > start))
    has_word = np.searchsorted(found.start, stop) > np.searchsorted(found.start, start)
    start, stop = start[has_word], stop[has_word]
    row = np.searchsorted(part.begin, start, "right") - 1
    out[:, 3] = np.bincount(row[_repeats(row, span_hashes(data, start, stop))], minlength=rows)[:rows]

    runs, first = windows(span_hashes(data, found.start, found.end), found.first, 3, short=False)
    of = np.repeat(np.arange(rows), np.diff(first))
    again = _repeats(of, runs, every=True)
    where = np.arange(len(runs)) + np.repeat(found.first[:-1] - first[:-1], np.diff(first))
    covered = np.zeros(len(found.start), bool)
    for j in range(3):
        covered[where[again] + j] = True
    sums = np.concatenate(([0], np.cumsum(covered)))
    out[:, 4] = sums[found.first[1:]] - sums[found.first[:-1]]
    return out


def _repeats(row: np.ndarray, hashes: np.ndarray, every: bool = False) -> np.ndarray:
    """Which entries equal an earlier one of their row; with every, which equal any other one."""
    order = np.lexsort((hashes, row))
    same = np.zeros(len(row), bool)
    same[1:] = (row[order][1:] == row[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    if every:
        same[:-1] |= same[1:]
    out = np.zeros(len(row), bool)
    out[order] = same  # lexsort is stable: the first of equals is the earliest
    return out


class Fertility:
    """Measures of texts by their distinct words; what a word gives is kept, by its hash, while there are not too many."""

    def __init__(self, bytes_path: str, pieces_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.tokens = Tokenizer.from_file(bytes_path)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.fallback = np.array([self.pieces.is_byte(i) or self.pieces.is_unknown(i) for i in range(self.pieces.vocab_size())])
        self.hashes, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.begin, self.ids = np.zeros(1, np.int64), np.empty(0, np.int64)

    def _learn(self, hashes: np.ndarray, names: list[bytes]) -> None:
        """Keep what words give, those of hashes after the known ones."""
        plain = [w.decode("utf-8", "replace") for w in names]
        counts = np.array([len(e.ids) for e in self.tokens.encode_batch([" " + w for w in plain], add_special_tokens=False)], np.int64)
        found = self.pieces.encode(plain, num_threads=1)
        lengths = np.array([len(i) for i in found], np.int64)
        ids = np.fromiter(itertools.chain.from_iterable(found), np.int64, int(lengths.sum()))
        hashes, counts = np.concatenate((self.hashes, hashes)), np.concatenate((self.counts, counts))
        begin, ids = np.concatenate((self.begin, self.begin[-1] + np.cumsum(lengths))), np.concatenate((self.ids, ids))
        order = np.argsort(hashes)
        self.hashes, self.counts, (self.begin, self.ids) = hashes[order], counts[order], _taken(begin, ids, order)

    def measure(self, part) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Byte-level tokens, pieces, fallback share and entropy share of the words of each text of a slice."""
        found, rows = words(part), part.rows
        distinct, first, each = np.unique(span_hashes(part.data, found.start, found.end), return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > CACHE_ENTRIES:
            self.hashes, self.counts, self.begin, self.ids = self.hashes[:0], self.counts[:0], self.begin[:1], self.ids[:0]
        new = ~np.isin(distinct, self.hashes, assume_unique=True)
        if new.any():
            data = part.data.tobytes()
            self._learn(distinct[new], [data[a:b] for a, b in zip(found.start[first[new]].tolist(), found.end[first[new]].tolist(), strict=True)])
        place = np.searchsorted(self.hashes, distinct)[each]
        row = np.repeat(np.arange(rows), np.diff(found.first))
        tokens = np.bincount(row, self.counts[place], rows).astype(np.int64)
        begin, ids = _taken(self.begin, self.ids, place)
        of = np.repeat(row, np.diff(begin))
        n = np.bincount(of, minlength=rows)
        share = np.bincount(of, self.fallback[ids], rows) / np.maximum(n, 1)
        key, count = np.unique(of * len(self.fallback) + ids, return_counts=True)
        own = key // len(self.fallback)
        p = count / n[own]
        entropy = np.bincount(own, -p * np.log(p), rows) / np.log(np.maximum(n, 2))
        return tokens, n, share, entropy


def _taken(begin: np.ndarray, data: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of data that begin so (one number more), in the order of place."""
    lengths = np.diff(begin)[place]
    out = np.append(0, np.cumsum(lengths))
    return out, data[np.arange(out[-1]) + np.repeat(begin[:-1][place] - out[:-1], lengths)]


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, n_pieces long, fallback_share double, entropy_share double"


def measure(docs: DataFrame, bytes_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, lang, script, base counts, fertility measures) for every row of docs."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        fertility = Fertility(bytes_path, pieces_path)
        names = ["id", "lang", "script", *(m.split()[0] for m in MEASURES.split(", "))]
        for batch in batches:
            at = 0
            for part in slices(batch.column(2)):
                base, measured = base_counts(part), fertility.measure(part)
                own = batch.slice(at, part.rows)
                yield pa.RecordBatch.from_arrays([*own.columns[:2], pa.array(scripts(part), pa.string()), *(pa.array(base[:, k]) for k in range(5)), *map(pa.array, measured)], names)
                at += part.rows

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang string, script string, {MEASURES}")


def quartiles(rows: DataFrame) -> DataFrame:
    """(level, name, docs, ends: low_<measure>..., high_<measure>...) of languages (0), scripts (1) and all texts (2).

    A quartile is the least bin up to which a quarter (three quarters) of a group's rows lie. Rows without a measure
    don't count towards it.
    """
    level = lambda n, name: F.struct(F.lit(n).alias("level"), name.alias("name"))
    value = lambda m: F.struct(F.lit(m).alias("measure"), F.floor(F.col(m) * BINS + 0.5).cast("long").alias("bin"))
    each = rows.select(F.explode(F.array(level(0, F.col("lang")), level(1, F.col("script")), level(2, F.lit("all")))).alias("g"), *REACH)
    each = each.select("g.level", "g.name", F.explode(F.array(*map(value, REACH))).alias("m")).select("level", "name", "m.measure", "m.bin")
    counts = each.where("bin IS NOT NULL").groupBy("level", "name", "measure", "bin").count()
    group = Window.partitionBy("level", "name", "measure")
    ranked = counts.withColumn("upto", F.sum("count").over(group.orderBy("bin"))).withColumn("docs", F.sum("count").over(group))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("docs"), F.col("bin"))) / BINS
    ends = ranked.groupBy("level", "name", "measure").agg(F.max("docs").alias("docs"), at(0.25).alias("low"), at(0.75).alias("high"))
    wide = ends.groupBy("level", "name").agg(
        F.max("docs").alias("docs"), *(F.max(F.when(F.col("measure") == m, F.col(end))).alias(f"{end}_{m}") for m in REACH for end in ("low", "high"))
    )
    return wide.select("level", "name", "docs", F.struct(*(f"{end}_{m}" for m in REACH for end in ("low", "high"))).alias("ends"))


def drawn(own: Column, docs: Column, wider: Column) -> Column:
    """A quartile of so many texts, drawn towards that of the wider group; the wider one where there is no own."""
    return F.when(own.isNull(), wider).when(wider.isNull(), own).otherwise((docs * own + PULL * wider) / (docs + PULL))


def apply_rules(docs: DataFrame, bytes_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, script, base counts, measures, base_failed, kept) for every row of docs.

    base_failed: fewer than 50 words, or more than half of them in three-word windows found twice or more in the text.
    kept: not base_failed and every measure within the band of its language, drawn towards those of its script and of all
    texts. Bands come from the rows that pass the base rules; where none does there is no band to fail. A null language counts as und, a null text as one without
    words (base_failed). Null ids and repeated rows are rows like others; other columns are not read; an empty table
    gives an empty result.
    """
    rows = measure(docs, bytes_path, pieces_path, id_col, text_col, lang_col)
    rows = rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    rows = cut_lineage(rows.withColumn("chars_per_token", F.when(F.col("n_tokens") > 0, F.col("word_chars") / F.col("n_tokens"))))
    found = cut_lineage(quartiles(rows.where("NOT base_failed")))
    if found.limit(FEW_BANDS + 1).count() <= FEW_BANDS:
        found = F.broadcast(found)
    out = rows.withColumn("every", F.lit("all"))
    for k, name in enumerate(("lang", "script", "every")):
        own = found.where(F.col("level") == k).select(F.col("name").alias(name), F.col("docs").alias(f"docs_{k}"), F.col("ends").alias(f"ends_{k}"))
        out = out.join(own, name, "left")
    within = F.lit(True)
    for m, reach in REACH.items():
        low, high = (drawn(F.col(f"ends_0.{end}_{m}"), F.col("docs_0"), drawn(F.col(f"ends_1.{end}_{m}"), F.col("docs_1"), F.col(f"ends_2.{end}_{m}"))) for end in ("low", "high"))
        room = F.greatest((high - low) * SPREADS, F.lit(reach))
        within &= F.coalesce(F.col(m).between(low - room, high + room), F.lit(True))
    out = out.withColumn("kept", ~F.col("base_failed") & within)
    return out.select(F.col("id").alias(id_col), "script", *(m.split()[0] for m in MEASURES.split(", ")), "chars_per_token", "base_failed", "kept")
