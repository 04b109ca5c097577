"""Each operator against a brute-force version, a library, SQL or held-out labels, and on awkward rows."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from conftest import SMALL, same_rows
from pyspark.sql import functions as F

from geoloom.llm import bpe, bpe_codec, fertility, fingerprints, language_id, line_dedup, mixing, ngram_join, queries, token_counts, token_index, toxicity

P = queries.vocabulary
BYTES, PIECES_FILE, MULTI = P("byte_bpe_50k.json"), P("piece_bpe_32k.model"), P("byte_bpe_multi_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{k}" for k in range(30_000))
TEXTS = [
    None, "", " \n\t ", "one", "one", "a b c d", "a b c d e f", "A B C D E F", "Ünïcode 日本語 naïve café — ½ ٣٤", "x" * 5000, "<|endoftext|> in <|endoftext|>",
    "tabs\tand  spaces \r\n lines\n\n", "  odd spaces ", "'s 'll I'll we've 123 4567 !!??", LONG, LONG + " more", "🙂🙂 👩‍👩‍👧", "line one\nline two\nline one\n", "0", "﻿bom",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, t, "en" if k % 3 else None, "s" if k % 2 else None, len(t or "")) for k, t in enumerate(TEXTS)]
    rows += [(None, "a null id", "en", "s", 9), (3, "one", "en", "s", 3), (3, "one", "en", "s", 3)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return queries.documents(spark, SMALL)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_rows_of_the_sql(spark, name):
    same_rows(queries.queries()[name](spark, SMALL), queries.oracle_sql()[name])


CALLS = {
    "toxicity": lambda d: toxicity.score_toxicity(d, d.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))),
    "fertility": lambda d: fertility.apply_rules(d, BYTES, PIECES_FILE),
    "mixing": mixing.mix,
    "line_dedup": line_dedup.dedup_lines,
    "fingerprints": fingerprints.fingerprint_with_next,
    "ngram_join": ngram_join.ngram_jaccard_classes,
    "language_id": language_id.predict_languages,
    "token_counts": lambda d: token_counts.count_tokens(d, BYTES),
    "token_index": lambda d: token_index.encode_and_read(d, BYTES),
    "bpe_codec": lambda d: bpe_codec.round_trip(d, MULTI),
}


@pytest.mark.parametrize("name", list(CALLS))
def test_every_row_once_on_awkward_rows(odd, name):
    clash = odd.withColumns({c: F.lit("x") for c in ("id", "size", "mark", "pos", "node", "n", "score", "n_lines", "range", "block")})
    found = [r.doc_id for r in CALLS[name](clash).select("doc_id").collect()]
    want = [r.doc_id for r in odd.select("doc_id").collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", list(CALLS))
def test_an_empty_table(odd, name):
    assert CALLS[name](odd.where("false")).count() == 0


def test_codec_equals_tiktoken(spark, odd, small):
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for docs in (odd, small):
        want = sorted(((d.doc_id, np.array(library.encode_ordinary(d.text or ""), "<u4").tobytes(), (d.text or "").encode()) for d in docs.collect()), key=str)
        encoded = bpe_codec.encode(docs, MULTI)
        assert sorted(((r.doc_id, bytes(r.ids)) for r in encoded.collect()), key=str) == sorted(((i, x) for i, x, _ in want), key=str)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        found = bpe_codec.round_trip(docs, MULTI).collect()
        assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found), key=str) == sorted(((i, len(x) // 4, sha(x), sha(t)) for i, x, t in want), key=str)


def test_rank_queue_merges_long_pre_tokens_as_tiktoken():
    import base64

    import pyarrow as pa
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    library = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("abcdeéß日"), n)) for n in (31, 32, 33, 500, 20_000)] + ["a" * 5001]
    texts += ["".join(rng.choice(list("a \n\t'sx\u3000\xa0"), rng.integers(1, 40))) for _ in range(1000)]
    found = [np.frombuffer(x.as_py(), "<u4").tolist() for column in bpe_codec.encoder(MULTI)(pa.array(texts)) for x in column]
    assert found == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("few", [0, 3, 10**9])
def test_rank_queue_equals_merging_one_by_one(monkeypatch, few):
    """Random merges, where new pairs often have ranks below the one at hand."""
    import pyarrow as pa

    monkeypatch.setattr(bpe, "FEW", few)
    rng = np.random.default_rng(11)
    for _ in range(60):
        size = int(rng.integers(2, 40))
        # ids 0 and 1 are bytes, rank r makes id r + 2 of two random ids
        pairs = {(int(a), int(b)): r for r, (a, b) in enumerate(rng.integers(0, rng.integers(2, size + 3), (size, 2)))}
        merges = bpe.Merges([b % 2 for b in range(256)], size, np.array([a << bpe.SHIFT | b for a, b in pairs]), np.array([*pairs.values()]), [r + 2 for r in range(size)])
        pieces = [bytes(rng.integers(0, 2, n).tolist()) for n in rng.integers(0, 40, 30)]
        ids, begin = merges.merge(pa.array(pieces, pa.binary()))
        for piece, a, b in zip(pieces, begin[:-1], begin[1:], strict=True):
            row = list(piece)
            while len(row) > 1 and (least := min((pairs.get(p, 1 << 30), k) for k, p in enumerate(itertools.pairwise(row))))[0] < 1 << 30:
                row[least[1] : least[1] + 2] = [least[0] + 2]
            assert ids[a:b].tolist() == row


def _tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTES)


def test_counts_and_index_equal_the_library(odd, small):
    library = _tokenizer()
    for docs in (odd, small):
        rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or ""))
        ids = [library.encode(r.text or "", add_special_tokens=False).ids for r in rows]
        counts = token_counts.count_tokens(docs, BYTES).collect()
        want = [(r.doc_id, len((r.text or "").encode()), len(i), len(i) > 1024) for r, i in zip(rows, ids, strict=True)]
        assert sorted(map(tuple, counts), key=str) == sorted(want, key=str)
        starts = np.cumsum([0] + [len(i) + 1 for i in ids]).tolist()
        want = [(r.doc_id, s, len(i) + 1, zlib.crc32(np.array([*i, 2], "<u4").tobytes())) for r, s, i in zip(rows, starts, ids, strict=False)]
        assert sorted(map(tuple, token_index.encode_and_read(docs, BYTES).collect()), key=str) == sorted(want, key=str)


def test_keyed_access(spark, small, odd, tmp_path):
    ids = lambda text: [*_tokenizer().encode(text or "", add_special_tokens=False).ids, 2]
    for name, docs, wanted in (("small", small, [3, 77, 10**9]), ("odd", odd, [0, 3, 14, 10**9]), ("none", odd.where("false"), [1]), ("no key", odd, [])):
        token_index.write_index(docs, BYTES, str(tmp_path / name))
        found = sorted((r.id, np.frombuffer(r.ids, "<u4").tolist()) for r in token_index.fetch(spark, str(tmp_path / name), wanted).collect())
        assert found == sorted((r.doc_id, ids(r.text)) for r in docs.collect() if r.doc_id in wanted)


def test_minimal_perfect_hash():
    hashes = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64))
    _, slots = token_index.build_index(hashes)
    assert sorted(slots.tolist()) == list(range(len(hashes)))


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_copies(seed: int, groups: int = 12, each: int = 6):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        base = rng.integers(0, 900, rng.integers(5, 400)).tolist()
        for _ in range(each):
            row = list(base)
            for _ in range(rng.integers(0, 1 + len(row) // 25)):
                row[rng.integers(0, len(row))] = int(rng.integers(0, 900))
            out.append(" ".join(f"w{k}" for k in (row + rng.integers(0, 900, rng.integers(0, 8)).tolist())))
    return out


def test_join_equals_brute_force(spark, odd):
    texts = near_copies(2) + near_copies(9, 20, 3)
    docs = spark.createDataFrame([(100 + k, t, None, None, 0) for k, t in enumerate(texts)], SCHEMA).unionByName(odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))
    rows = docs.collect()
    sets = {r.doc_id: shingles(r.text) for r in rows}
    links = {i: set() for i in sets}
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            links[a].add(b)
            links[b].add(a)

    def least(i):
        seen, todo = {i}, [i]
        while todo:
            todo += [x for x in links[todo.pop()] if x not in seen and not seen.add(x)]
        return min(seen)

    want = sorted((i, len(s), least(i), len(links[i])) for i, s in sets.items())
    assert sorted(map(tuple, ngram_join.ngram_jaccard_classes(docs).collect())) == want


def test_packing():
    x = np.sort(np.random.default_rng(0).integers(0, 2**63, 1000).astype(np.uint64))
    assert (ngram_join.unpack(ngram_join.pack(x)) == x >> np.uint64(16)).all()


def base_counts(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    covered = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)} if len(windows) < 3000 else set()
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_base_rules_equal_brute_force(odd, small):
    for docs in (odd, small):
        rows = fertility.apply_rules(docs, BYTES, PIECES_FILE).collect()
        found = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows if r.n_words < 3000), key=str)
        assert found == sorted(((r.doc_id, *c) for r in docs.collect() if (c := base_counts(r.text))[0] < 3000), key=str)
        assert all(not r.kept for r in rows if r.base_failed)


def test_fingerprints_follow_edits(spark, odd, small):
    rows = sorted(((r.doc_id, r.text or "") for r in small.collect()), reverse=True)
    found = {r.doc_id: r for r in fingerprints.fingerprint_with_next(small).collect()}
    for (i, text), (j, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        edited = fingerprints.edit(text, after)
        assert found[i].n_chars == len(text) and found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert found[i].near_next == fingerprints.likeness(fingerprints.fingerprint(text), fingerprints.fingerprint(after))
        assert (found[i].fingerprint == found[j].fingerprint) or text != after
    base = LONG[:3000]
    swapped = base[1500:] + base[:1500]
    near = fingerprints.likeness(fingerprints.fingerprint(base), fingerprints.fingerprint(base[:1400] + "!" + base[1400:]))
    assert near > 0.9 and near > fingerprints.likeness(fingerprints.fingerprint(base), fingerprints.fingerprint(swapped))


def test_fertility_measures_bands_and_verdicts_equal_brute_force(spark, odd, small):
    import collections
    import math

    import sentencepiece

    library, pieces = _tokenizer(), sentencepiece.SentencePieceProcessor(model_file=PIECES_FILE)
    rare = spark.createDataFrame([(9000 + k, " ".join(f"слово{j} и" for j in range(60 + k)), "ru" if k < 3 else "bg", None, 0) for k in range(25)], SCHEMA)
    docs = small.unionByName(odd).unionByName(rare)
    want = []
    for r in docs.collect():
        w = WORD.findall(r.text or "")
        ids = [i for x in w for i in pieces.encode(x)]
        n, tokens = len(ids), sum(len(library.encode(" " + x, add_special_tokens=False).ids) for x in w)
        share = sum(pieces.is_byte(i) or pieces.is_unknown(i) for i in ids) / n if n else 0.0
        entropy = -sum(c / n * math.log(c / n) for c in collections.Counter(ids).values()) / math.log(n) if n > 1 else 0.0
        want.append((r.doc_id, r.text, r.lang or "und", tokens, n, share, entropy, sum(map(len, w)) / tokens if tokens else None))
    found = fertility.apply_rules(docs, BYTES, PIECES_FILE)
    by_id = collections.defaultdict(list)
    for r in found.collect():
        by_id[r.doc_id].append(r)
    rows = []
    for i, _, lang, tokens, n, share, entropy, chars in want:
        r = by_id[i][0] if len({x.n_tokens for x in by_id[i]}) == 1 else next(x for x in by_id[i] if x.n_tokens == tokens)
        assert (r.n_tokens, r.n_pieces) == (tokens, n) and abs(r.fallback_share - share) < 1e-9 and abs(r.entropy_share - entropy) < 1e-9
        rows.append((lang, r.script, r.base_failed, r.kept, {"chars_per_token": chars, "fallback_share": r.fallback_share, "entropy_share": r.entropy_share}))
    assert {x[1] for x in rows} >= {"none", "Latin", "Cyrillic"}

    def quartile(m, q, keep):
        bins = sorted(math.floor(x[4][m] * 1000 + 0.5) for x in rows if not x[2] and keep(x))
        return (bins[math.ceil(q * len(bins)) - 1] / 1000, len(bins)) if bins else (None, 0)

    def drawn(m, q, groups):
        (own, n), rest = quartile(m, q, groups[0]), groups[1:]
        if not rest:
            return own
        wider = drawn(m, q, rest)
        return wider if own is None else (n * own + 20 * wider) / (n + 20)

    for lang, script, failed, kept, measures in rows:
        if failed:
            assert not kept
            continue
        groups = [lambda x, lang=lang: x[0] == lang, lambda x, script=script: x[1] == script, lambda x: True]
        ends = {}
        for m in measures:
            low, high = drawn(m, 0.25, groups), drawn(m, 0.75, groups)
            room = max((high - low) * 2, fertility.REACH[m])
            ends[m] = (low - room, high + room)
        if all(min(abs(measures[m] - e) for e in ends[m]) > 1e-9 for m in measures):
            assert kept == all(ends[m][0] <= measures[m] <= ends[m][1] for m in measures)


def test_scripts_follow_unicode(spark):
    texts = {
        "Thai": "ภาษาไทย x", "Armenian": "Հայերեն", "Georgian": "ქართული", "Ethiopic": "አማርኛ", "Javanese": "ꦗꦮ", "none": "×÷ 12 🙂", "Latin": "Tiếng Việt ấy", "Han": "𠀀𠀁 漢",
        "Devanagari": "हिन्दी", "Hangul": "한국어", "Hiragana": "ひらがな", "Cyrillic": "слово", "Greek": "λόγος", "Hebrew": "עברית", "Arabic": "العربية", "Other": "𐌰𐌱𐌲",
    }
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts.values())], SCHEMA)
    found = {r.doc_id: r.script for r in fertility.apply_rules(docs, BYTES, PIECES_FILE).collect()}
    assert [found[k] for k in range(len(texts))] == list(texts)


def test_languages_of_repeated_texts_are_learned(spark):
    """Three texts a language, each 400 times, and a third of all rows one text; many values that are no language."""
    base = {"de": ["der Hund und die Katze", "das ist ein Haus", "wir gehen nach Hause"], "fr": ["le chien et le chat", "c'est une maison", "nous allons chez nous"], "es": ["el perro y el gato", "esta es una casa", "nos vamos a casa"]}
    rows = [(k, t, lang, None, 0) for lang, texts in base.items() for k, t in enumerate(texts * 400)]
    rows += [(9, None, "xx", None, 0), (9, "123", "yy", None, 0)]
    model = language_id.train(spark.createDataFrame(rows, SCHEMA))
    assert model.languages == ["de", "es", "fr"]
    assert all(model.predict(t)[0] == lang for lang, texts in base.items() for t in texts)
    dirty = spark.range(3000).select(F.concat(F.lit("v"), F.col("id")).alias("lang"), F.concat(F.lit("word "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"))
    own = spark.createDataFrame(rows, SCHEMA).select("lang", "text")
    model = language_id.train(dirty.union(own))
    assert {"de", "es", "fr"} <= set(model.languages) and len(model.languages) == language_id.MAX_LANGUAGES


def test_tokens_of_all_labelled_texts_and_repeated_ids(spark, monkeypatch):
    rows = [(k, "the plain words here" if k % 2 else "the nasty insult there", None, None, 0) for k in range(60)]
    rows += [(1, f"the plain copy {k}", None, None, 0) for k in range(500)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = docs.select("doc_id", (1 - F.col("doc_id") % 2).alias("toxic")).distinct()
    found = toxicity.score_toxicity(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    scores = toxicity.choose(docs.select((1 - F.col("doc_id") % 2).cast("int").alias("label"), "text"))
    assert "the" not in scores
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 20)
    kept = []
    monkeypatch.setattr(toxicity, "cut_lineage", lambda df: kept.append(df) or df)
    toxicity.train(docs, labels)
    assert kept[0].count() == 20 and kept[0].select("id").distinct().count() == 20


def signature(text):
    """Order MinHash one function after another, over Python's whole numbers."""
    mask = (1 << 64) - 1

    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    step = [mix(k * 0xD1342543DE82EF95 & mask) | 1 for k in range(1, 65)]
    c = [ord(x) for x in text]
    if len(c) < fingerprints.SIZE:
        hashes = [mix(sum(a * b for a, b in zip(c, step, strict=False)) + len(c) * int(fingerprints.GOLDEN) & mask)] if c else []
    else:
        hashes = c
        for s in (1, 2, 4):
            hashes = [mix(a * step[s] + b * step[s + 8] & mask) for a, b in zip(hashes, hashes[s:], strict=False)]
    low = (1 << len(hashes).bit_length()) - 1
    turns, numbered = {}, []
    for place, h in enumerate(hashes):
        kmer = h >> low.bit_length()
        turn = turns[kmer] = turns.get(kmer, -1) + 1
        numbered.append((mix((kmer << low.bit_length()) + turn * int(fingerprints.GOLDEN) & mask) & ~low | place, place))
    out = []
    for seed in fingerprints.SEEDS.tolist() if numbered else ():
        least = sorted(numbered, key=lambda x: x[0] - seed & mask)[: fingerprints.PICK]
        tuples = [x & ~low & mask for x, _ in sorted(least, key=lambda x: x[1])]
        out.append(mix(sum(a * b for a, b in zip(tuples, step, strict=False)) + len(tuples) * int(fingerprints.GOLDEN) & mask) >> 48 or 1)
    return out or [0] * fingerprints.FUNCTIONS


def test_signatures_equal_brute_force():
    rng = np.random.default_rng(2)
    texts = ["", "a", "abcdefg", "abcdefgh", "a" * 300, "日本語のテキスト" * 5, LONG[:30_000]] + ["".join(rng.choice(list("abc é"), n)) for n in rng.integers(1, 900, 40)]
    for text in texts:
        assert fingerprints.fingerprint(text).tolist() == signature(text)


def test_short_texts_feel_the_order_too():
    rng = np.random.default_rng(6)
    for n in (60, 100, 400, 3000):
        texts = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), n)) for _ in range(40)]
        swapped = np.mean([fingerprints.likeness(fingerprints.fingerprint(t), fingerprints.fingerprint(t[n // 2 :] + t[: n // 2])) for t in texts])
        assert 0.2 < swapped < 0.6


def test_many_rows_of_one_id_are_cut_by_hash(spark):
    rows = [(5, f"text number {k} of many " * 3) for k in range(300)] + [(None, f"no id {k}") for k in range(200)] + [(k, f"own {k}") for k in range(10)] + [(5, "the same")] * 20
    found = fingerprints.fingerprint_with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert sorted(((r.doc_id is None, r.doc_id, r.n_chars) for r in found), key=str) == sorted(((i is None, i, len(t)) for i, t in rows), key=str)
    edited = {r.edited_sha256 for r in found if r.doc_id == 6}
    texts = [t for i, t in rows if i == 5]
    assert edited <= {hashlib.sha256(fingerprints.edit("own 6", t).encode()).hexdigest() for t in texts} and len(edited) == 1


def test_one_step_of_ftrl():
    from geoloom.llm.language_id import ALPHA, BETA, L1, L2

    at, values = np.array([3, 9]), np.array([0.6, 0.8])
    w = language_id.fit_ftrl([(1, at, values)], 3, epochs=1)
    for k in range(3):
        g = (1 / 3 - (k == 1)) * values  # all weights are 0 at first
        z, n = g, g * g
        assert np.allclose(w[k, at], np.where(np.abs(z) <= L1, 0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)), atol=1e-6)
    assert np.count_nonzero(w) == 6


def test_temperature_undoes_a_scale():
    rng = np.random.default_rng(1)
    true = rng.normal(size=(4000, 3)) * 2
    labels = [int(rng.choice(3, p=language_id.softmax(x))) for x in true]
    assert abs(language_id.fit_temperature(list(true * 2.5), labels) / 2.5 - 1) < 0.1


def test_texts_without_a_letter_have_no_language(spark, small):
    model = language_id.train(small)
    texts = ["½ ²", "Ⅷ", "①", "_", "12 ٣", "🙂", "", None, "\u0301", "a", "日"]
    rows = language_id.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).orderBy("doc_id").collect()
    assert [r.lang_pred == "und" for r in rows] == [True] * 9 + [False] * 2
    assert all((r.score == 0) == (r.lang_pred == "und") and 0 <= r.score <= 1 for r in rows)
    text = small.where("text IS NOT NULL").first().text
    found, values = model.features(text)
    dense = np.zeros((len(model.languages), language_id.BUCKETS))
    dense[model.language, np.repeat(np.arange(language_id.BUCKETS), np.diff(model.begin))] = model.weight
    assert np.allclose(model.logits(found, values), dense[:, found] @ values)


def test_language_on_held_out_rows(spark):
    docs = queries.documents(spark, SMALL.replace("0.001", "0.01"))
    found = language_id.predict_languages(docs).where("held_out").join(docs.where("lang IS NOT NULL").select("doc_id", "lang"), "doc_id").where("lang_pred <> 'und'")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_toxicity_on_held_out_rows(spark):
    """A few of the given labels are wrong at random (toxic ones on plain gibberish), so recall has a ceiling."""
    folder = SMALL.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic IS NOT NULL").select("doc_id", "toxic")
    rows = queries.op1_toxicity(spark, folder).where("held_out").join(labels, "doc_id").collect()
    yes, no = np.array([r.score for r in rows if r.toxic]), np.array([r.score for r in rows if not r.toxic])
    assert (yes >= 0.5).mean() > 0.7 and (no >= 0.5).mean() < 0.01
    assert np.mean([(a > no).mean() + (a == no).mean() / 2 for a in yes]) > 0.85


def test_maximal_segments_equal_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(300):
        x = np.round(rng.choice([-1.0, -0.7, 2.03, 1.51], rng.integers(1, 14)) + rng.random() / 100, 4)

        def split(lo, hi):
            best = max(((x[a : b + 1].sum(), a - b, a, b) for a in range(lo, hi) for b in range(a, hi)), default=(0,))
            return split(lo, best[2]) + [(best[2], best[3])] + split(best[3] + 1, hi) if best[0] > 1e-9 else []

        assert [(a, b) for _, a, b in toxicity.segments(x)] == split(0, len(x))


def test_segments_of_long_sparse_texts_take_linear_time():
    import time

    x = np.full(16_000 * 20, -0.1)
    x[::20] = 1.0
    began = time.perf_counter()
    assert len(toxicity.segments(x)) == 16_000
    assert time.perf_counter() - began < 1


def test_law_of_maxima_finds_its_parameters():
    rng = np.random.default_rng(8)
    words = rng.integers(50, 2000, 20_000).astype(float)
    best = np.maximum(0, (np.log(1e-3 * words) - np.log(-np.log(rng.random(20_000)))) / 0.8)
    decay, rate = toxicity.fit_maxima(best, words)
    assert abs(decay - 0.8) < 0.05 and abs(rate / 1e-3 - 1) < 0.1


def test_mix_meets_targets(small):
    rows = mixing.mix(small).collect()
    for source in {(r.source_size, r.target) for r in rows}:
        own = [r for r in rows if (r.source_size, r.target) == source]
        assert abs(sum(r.taken for r in own) - source[1]) <= 0.02 * source[1] + 2 * mixing.BLOCK_WORDS
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(small.repartition(7)).collect()), key=str)


def cut_lines(rows, least):
    """What stays of (id, text) rows in order: a line goes if a run of lines of least characters round it stands earlier."""
    lines = [(k, j, x) for k, (_, text) in enumerate(rows) for j, x in enumerate(text.split("\n"))]
    gone = set()
    for b, (kb, jb, _) in enumerate(lines):
        for a in range(b):
            n = total = 0
            while b + n < len(lines) and lines[a + n][0] == lines[a][0] and lines[b + n][0] == kb and lines[a + n][2] == lines[b + n][2]:
                total += len(lines[b + n][2]) + 1
                n += 1
            if total >= least:
                gone |= {(kb, jb + x) for x in range(n)}
    return [(i, "\n".join(x for j, x in enumerate(text.split("\n")) if (k, j) not in gone)) for k, (i, text) in enumerate(rows)]


def test_line_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    known = ["", "x", "a line of some length", "y" * 45, "z" * 130, "another line", "-" * 99, "=" * 100, "#" * 199, "+" * 210]
    for _ in range(4):
        rows = [(k, "\n".join(known[j] for j in rng.integers(0, len(known), rng.integers(1, 25)) ** 2 % len(known))) for k in range(25)]
        blocks = [rows[k][1] for k in rng.integers(0, 25, 5)]
        rows += [(25 + k, f"own {k}\n{blocks[a]}\n{blocks[b]}") for k, (a, b) in enumerate(rng.integers(0, 5, (10, 2)))]
        found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
        assert [(r.doc_id, r.text) for r in found] == cut_lines(rows, 200)


def test_line_dedup_joins_runs_whose_lines_come_first_elsewhere(spark):
    one, two = "1" * 140, "2" * 140
    docs = spark.createDataFrame([(1, one, 1, 2), (2, two, 3, 4), (3, f"{one}\n{two}", 5, 6), (4, f"{one}\n{two}", 7, 8), (5, None, 9, 9)], "doc_id long, text string, _id int, gone int")
    found = line_dedup.dedup_lines(docs)
    assert found.columns == ["doc_id", "text", "_id", "gone", "n_lines", "n_removed"]
    assert [tuple(r) for r in found.orderBy("doc_id").collect()] == [(1, one, 1, 2, 1, 0), (2, two, 3, 4, 1, 0), (3, f"{one}\n{two}", 5, 6, 2, 0), (4, "", 7, 8, 2, 2), (5, None, 9, 9, 0, 0)]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as c

    assert [n for n, _ in c.STAGES] == ["language_id", "line_dedup", "ngram_jaccard_join", "source_mixing", "bpe_encoding"]
    docs = queries.documents(spark, SMALL)
    for k, (_, stage) in enumerate(c.STAGES[:-1]):
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    last = sorted(map(tuple, c.STAGES[-1][1](spark, docs, SMALL).collect()))
    assert last == sorted(map(tuple, c.run(spark, SMALL).collect())) and len(last) > 100


def test_stages_on_awkward_rows_and_empty_tables(spark, odd):
    """Each stage alone, against its rule worked out here."""
    import corpus_pipeline as c

    stages = dict(c.STAGES)
    clash = odd.unionByName(spark.createDataFrame([(70, "same id, one text of it", "en", "t", 1), (70, "same id, quite another text", "en", None, 2)], SCHEMA)).withColumn("key", F.lit("k")).withColumn("id", F.lit(1))
    for stage in stages.values():
        assert stage(spark, clash.where("false"), SMALL).count() == 0
    rows = [(r.doc_id, r.text) for r in clash.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])

    kept = [(r.doc_id, r.text) for r in stages["language_id"](spark, clash, SMALL).collect()]
    assert set(kept) <= {r for r in rows if r[1] and any(x.isalpha() for x in r[1])} and len(kept) > 5

    found = sorted(((r.doc_id, r.text) for r in stages["line_dedup"](spark, clash, SMALL).collect()), key=str)
    texts = [r for r in rows if r[1] is not None]
    order = sorted(set(texts), key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5(f"{'n' if r[0] is None else f'i{r[0]}'}:{r[1]}".encode()).digest()))
    cut = dict(zip(order, [t for _, t in cut_lines(order, 200)], strict=True))
    want = [(i, cut[i, t]) for i, t in texts if cut[i, t] == t or WORD.search(cut[i, t])]
    assert found == sorted([*want, *(r for r in rows if r[1] is None)], key=str)

    found = sorted(((r.doc_id, r.text) for r in stages["ngram_jaccard_join"](spark, clash, SMALL).collect()), key=str)
    left = []
    sets = {r: shingles(r[1]) for r in set(rows)}
    for r in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        if not any(sets[r] and 100 * len(sets[r] & sets[x]) >= 75 * len(sets[r] | sets[x]) for x in left):
            left.append(r)
    assert found == sorted(left, key=str)

    mixed = mixing.mix(clash).collect()
    found = [(r.doc_id, r.text) for r in stages["source_mixing"](spark, clash, SMALL).collect()]
    assert all(found.count(r) <= 2 * rows.count(r) for r in set(rows)) and set(found) <= {r for r in rows if WORD.search(r[1] or "")}
    assert abs(sum(len(WORD.findall(t)) for _, t in found) - sum(r.taken for r in mixed)) <= max(r.size for r in mixed)

    assert sorted((r.doc_id, r.decoded_sha256) for r in stages["bpe_encoding"](spark, clash.where("doc_id IS NOT NULL"), SMALL).collect()) == sorted((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows if i is not None)


def test_the_mixed_stage_meets_its_targets(spark):
    """Within a tenth and half a long document, since documents come whole."""
    import corpus_pipeline as c

    docs = queries.documents(spark, SMALL.replace("0.001", "0.01"))
    size = mixing.word_count(F.col("text"))
    sizes = {r.source: (r.words, r.longest) for r in docs.groupBy("source").agg(F.sum(size).alias("words"), F.max(size).alias("longest")).collect()}
    target = dict(mixing.mix(docs).select("source_size", "target").distinct().collect())
    words = dict(dict(c.STAGES)["source_mixing"](spark, docs, SMALL).groupBy("source").agg(F.sum(size)).collect())
    assert all(abs(words.get(s, 0) - target[n]) <= 0.1 * target[n] + longest / 2 for s, (n, longest) in sizes.items() if n)
