"""Whitening, sentence pieces and conversation repair against brute force, the library, SQL, and awkward rows."""

import hashlib
import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoloom.llm import conversation_repair, queries, sentence_pieces, whitening

MODEL = queries.vocabulary("piece_bpe_32k.model")


# ---- whitening


def plain(rows):
    """(n, deviation, whitened up to the sign, explained) by id, in exact sums and a plain covariance."""
    rows = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({x for _, x in rows})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    covariance = np.cov(np.array(distinct, float).T, bias=True)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    return {i: (n, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), ((np.array(x) - np.array(sums) / n) @ vectors) / np.sqrt(values), values / np.trace(covariance)) for i, x in rows}


def test_whitening_equals_a_plain_one(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    want = plain([(r.vec_id, r.embedding) for r in table.collect()])
    signs = {}
    found = queries.op11_whitening(spark, SMALL).collect()
    assert len(found) == 4 * table.count()
    for r in found:
        n, deviation, whitened, explained = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        value = whitened[r.component - 1]
        sign = signs.setdefault(r.component, np.sign(value * r.whitened))
        assert abs(sign * r.whitened - value) < 1e-8 and abs(r.explained - explained[r.component - 1]) < 1e-9 and r.identity_error < 1e-9


@pytest.mark.parametrize("most", [3, (1 << 20) - 1, 1 << 20, 1 << 31, 1 << 45])
def test_limb_products_are_exact(most):
    values = np.random.default_rng(1).integers(-most, most, (9000, 3))
    values[0], values[1] = most - 1, -most
    want = values.astype(object).T @ values.astype(object)
    assert (whitening.gram(values) == want).all() and (whitening.gram(values.astype(object)) == want).all()
    big = values[:40].astype(object) ** 5
    assert (whitening.gram(big) == big.T @ big).all()


def test_whitening_of_awkward_rows(spark):
    schema = "vec_id long, embedding array<float>, id string, x int, n int, component int"
    odd = [(1, [1.0, 2.0, 0.0]), (1, [1.0, 2.0, 0.0]), (None, [0.5, -1.0, 3.0]), (2, None), (3, [math.nan, 1.0, 1.0]), (4, [None, 1.0, 1.0]), (5, [math.inf, 1.0, 1.0]), (9, [-0.0, 0.001, 7.0]), (10, [4.0, 1.0]), (11, [])]
    df = spark.createDataFrame([(a, b, "x", 1, 1, 1) for a, b in odd], schema)
    found = whitening.whitened_digest(df).collect()
    assert sorted((str(r.vec_id), r.component) for r in found) == sorted((str(i), c) for i in (1, 1, None, 9, 10, 11) for c in (1, 2, 3))
    assert {r.n for r in found} == {5} and found[0].identity_error < 1e-9
    want = plain([(i, [*v, 0.0, 0.0, 0.0][:3]) for i, v in odd if v is not None])
    assert all(r.deviation == want[r.vec_id][1] for r in found)
    assert whitening.whitened_digest(df.where("false")).count() == 0
    one = whitening.whitened_digest(df.where("vec_id = 1")).collect()
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, 0.0, 0.0, 1.0)}
    huge = whitening.whiten(df.select(F.lit(1).alias("vec_id"), F.array(F.lit(1e16), F.lit(0.0)).alias("embedding")).limit(1).union(df.select(F.lit(2), F.array(F.lit(-1e16), F.lit(0.0))).limit(1))).collect()
    assert {int(r.deviation) for r in huge} == {(512 * 10**16) ** 2} and {r.whitened for r in huge if r.component == 1} == {1.0, -1.0}
    with pytest.raises(ValueError):
        whitening.whiten(df.select("vec_id", F.array_repeat(F.lit(0.0), whitening.MAX_SIZE + 1).alias("embedding")))


# ---- sentence pieces


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=MODEL)


def same_ids(library, texts):
    at = 0
    decode = sentence_pieces.decoder(MODEL)
    for ids in sentence_pieces.encoder(MODEL)(pa.array(texts, pa.string())):
        for own, text in zip(ids.to_pylist(), decode(ids).to_pylist(), strict=True):
            want = library.encode(texts[at] or "", add_eos=True)
            assert np.frombuffer(own, "<u4").tolist() == want, texts[at]
            assert text == library.decode(want).encode(), texts[at]
            at += 1
    assert at == len(texts)


def test_pieces_equal_the_library(library, spark):
    some = ["", None, " ", "  ", "a", " a", "▁a", "a▁ ▁b", "a\n\tb", "\x00x", "<s>", "<0x41>", "x</s>y", "日本語 naïve café — ½ ٣٤", "🙂🙂 👩‍👩‍👧", "﻿bom", "͸x", "a" * 5000, "thequickbrownfox" * 500]
    some += [" " * k + rest for k in (15, 16, 17, 31, 32, 33, 48, 1000) for rest in ("", "the", "͸", "\n")] + ["x" + " " * k + "y" for k in range(14, 36)]
    same_ids(library, some)
    same_ids(library, [r.text for r in queries.documents(spark, SMALL).collect()])


@given(st.lists(st.text(st.sampled_from(list("abehting  ▁\né日🙂͸1=<s>/"))), max_size=8))
@settings(max_examples=150, deadline=None)
def test_pieces_of_any_text(library, texts):
    same_ids(library, texts)


def test_pieces_of_long_runs_without_a_space(library):
    draw = random.Random(2)
    same_ids(library, ["".join(draw.choices(letters, k=4000)) for letters in ("ACGT", "abcdefghijklmnopqrstuvwxyz", "aab", "ab▁ ") for _ in range(3)])


def test_decoding_ids_that_no_text_gives(library):
    byte = {b: library.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
    cases = [[byte[0xE6], byte[0x97], 264], [byte[0xFF]], [byte[0xF0], byte[0x9F], 2, 1], [2], [1, 28705, 264, 2], [byte[0xC3], 264, byte[0xA9]], []]
    ids = pa.array([np.array(c, "<u4").tobytes() for c in cases], pa.binary())
    assert sentence_pieces.decoder(MODEL)(ids).to_pylist() == [library.decode(c).encode() for c in cases]


def test_piece_rows(spark, library):
    rows = [(1, "one two", "x"), (1, "one two", "x"), (None, None, "y"), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = sentence_pieces.round_trip(docs, MODEL).collect()
    want = []
    for i, text, _ in rows:
        ids = library.encode(text or "", add_eos=True)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    back = sentence_pieces.decode(sentence_pieces.encode(docs, MODEL), MODEL).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((i, t or "") for i, t, _ in rows), key=str)
    assert sentence_pieces.round_trip(docs.where("false"), MODEL).count() == 0


# ---- conversation repair


def cheapest(turns):
    """The least (cost, audit) over all ways to edit turns (initial, fault), by a search through all of them up to a cost."""
    fits = lambda s: not s.lstrip("s") and len(s) == 0 or (t := s[1:] if s[:1] == "s" else s) and t == "ua" * (len(t) // 2) and len(t) % 2 == 0
    options = []
    for initial, fault in turns:
        own = [(2, "D", "")]
        if fault in (0, 3):
            extra = 5 * (fault == 3)
            own += [(extra, "K", initial or "?"), (1 + extra, "R", "u"), (1 + extra, "R", "a")]
        options.append(own)
    gaps = [[(0, "", ""), (5, "I", "u"), (5, "I", "a"), (10, "II", "ua"), (10, "II", "au")]] * (len(turns) + 1)
    mixed = [gaps[0], *itertools.chain.from_iterable(zip(options, gaps[1:], strict=True))]
    bound = 2 * len(turns)
    found = []

    def go(at, cost, audit, spelt):
        if cost > bound:
            return
        if at == len(mixed):
            if fits(spelt):
                found.append((cost, audit))
            return
        for c, letters, roles in mixed[at]:
            go(at + 1, cost + c, audit + letters, spelt + roles)

    go(0, 0, "", "")
    return min(found)


def test_repair_is_the_cheapest(spark):
    draw = random.Random(5)
    texts = {0: "fine %d.", 1: " ", 2: "seen.", 3: "open %d"}
    rows, want = [], {}
    for conv in range(250):
        turns = []
        for k in range(draw.choice([1, 2, 3, 4])):
            role, fault = draw.choice(["user", "assistant", "system", "tool"]), draw.choice([0, 0, 0, 1, 2, 3])
            seen = any(r == role and f == 2 for r, f in turns)
            turns.append((role, fault))
            rows.append((conv, k, role, texts[fault] % k if "%" in texts[fault] else texts[fault], False))
            want.setdefault(conv, []).append((role[0] if role[0] in "sua" else "", 0 if fault == 2 and not seen else fault))
    found = conversation_repair.repair(spark.createDataFrame(rows, "conv long, turn long, role string, text string, dropped boolean")).collect()
    assert {r.conv: (r.cost, r.audit) for r in found} == {c: cheapest(t) for c, t in want.items()}


def odd_conversations(spark):
    draw, rows = random.Random(3), []
    for c in [*range(120), None, -5]:
        for k in range(draw.choice([0, 1, 1, 2, 3, 5, 8, 150 if c and c < 3 else 4])):
            turn = draw.choice([None, k, k, k, -k, 10**9])
            role = draw.choice(["user", "assistant", "system", "user", "assistant", "", None, "ünder", "Sys", "tool"])
            rows.append((c, turn, role, draw.choice([None, "", "  \n", "hi", "hi.", "ok?", "ok? \n", "é!", "no\nend", "x" * 50 + "."]), "a", True))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string, dropped boolean")


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_repair_of_awkward_rows_equals_the_sql(spark, batch):
    import duckdb

    df = odd_conversations(spark)
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    want = con.sql(conversation_repair.oracle())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = conversation_repair.repair_damaged(df)
        assert rows_of(found.columns, [tuple(r) for r in found.collect()]) == rows_of(want.columns, want.fetchall())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert conversation_repair.repair_damaged(df.where("false")).count() == 0


def test_repaired_turns_give_the_hash(spark):
    damaged = conversation_repair.damage(odd_conversations(spark))
    audits = conversation_repair.repair(damaged)
    turns = {}
    for r in conversation_repair.repaired_turns(damaged, audits).collect():
        turns.setdefault(r.conv, []).append((r.place, f"{r.role}:{r.text}"))
    for r in audits.collect():
        own = sorted(turns.get(r.conv, []))
        assert [k for k, _ in own] == list(range(1, len(own) + 1))
        assert hashlib.sha256("\n".join(x for _, x in own).encode()).hexdigest() == r.repaired_sha256
