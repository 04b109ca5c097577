"""N-gram Jaccard join: documents whose sets of word n-grams are alike, as classes and numbers of links.

Method: a blocked sparse product of the document by n-gram incidence matrix. In any one order of all n-grams, the
least k that two linked sets share stand among the first |x| - ceil(t |x|) + k of either. So a set with too few n-grams
there that come twice links with nothing, and of the others the first |x| - ceil(t |x|) + 1 suffice as posting lists.
The order is rarest first, after a count sketch of fixed size of the n-grams that come again within a task (it steers
cost, never the result). A first pass over the chosen n-grams, packed and without their documents, finds those that
come twice and marks them in a bitmap of fixed size; only marked ones go into posting lists (a full bitmap costs
shuffled rows, never links). The least node of each posting list leads it; the documents that a leader has met form
its group, so every pair that shares a posting list shares a group. Documents whose size bounds rule out all others of
a group leave it. Groups are cut into blocks, and each pair of blocks accumulates exact overlap counts of the whole
sets in one task and discards pairs below the bound that the sizes give. A task returns a spanning star for each class
it found and the number of links of each document, never the pairs.

Equal sets are one node from the start, so a group of copies is one row.
"""

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.textvec import BYTE, LOWER, Slice, give_back, slices, span_hashes, tidy, windows, words
from geoloom.operators.graph import connected_components
from geoloom.storage import cut_lineage

#: The sketch has 2**SKETCH_BITS cells of four bits (16 MB), whatever the input.
SKETCH_BITS = 25
FILTER_BITS = 24
#: The bitmap of n-grams that come twice has 2**SHARED_BITS bits (16 MB), whatever the input.
SHARED_BITS = 27
#: k is SPARE of a set's n-grams, rounded down, and one at least.
SPARE = (3, 20)
#: Packed runs of n-grams for each shuffle partition, so that partitions get even shares; n-grams a task holds at most.
RUNS_PER_PARTITION = 16
HELD_GRAMS = 1_000_000
CHUNK_BITS = 20
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 1_000_000
SEEN = 200_000


def shingle_sets(part: Slice, size: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its word n-grams, A-Z lower-cased."""
    found = words(part)
    hashes, begin = windows(span_hashes(part.data, found.start, found.end, BYTE[LOWER]), found.first, size)
    for lo, hi in zip(begin[:-1], begin[1:], strict=True):
        s = np.sort(hashes[lo:hi])
        yield s[np.concatenate(([True], s[1:] != s[:-1]))] if hi > lo else s


def pack(grams: np.ndarray) -> bytes:
    """Sorted hashes, each cut to its upper 48 bits, as their steps; equal neighbours stay."""
    steps = grams >> np.uint64(16)
    steps[1:] -= steps[:-1].copy()
    return zlib.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    """The upper 48 bits of the hashes that were packed."""
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)


def _sign(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _node(sign: bytes) -> int:
    return int.from_bytes(sign[:8], "little", signed=True)


@tidy
def _describe(batches, size: int):
    """A row for each document (n, sign), then the task's sketch of its n-grams in chunks."""
    sketch = np.zeros(1 << SKETCH_BITS, np.uint8)
    kind = pa.schema([("id", pa.null()), ("n", pa.int64()), ("sign", pa.binary()), ("node", pa.int64()), ("chunk", pa.int32()), ("counts", pa.binary())])
    for batch in batches:
        kind = kind.set(0, batch.schema.field(0))
        ns, signs = [], []
        for part in slices(batch.column(1)):
            sets = list(shingle_sets(part, size))
            ns += map(len, sets)
            signs += [_sign(s) if len(s) else None for s in sets]
            if len(cells := np.concatenate(sets)):
                at, counts = np.unique(cells >> np.uint64(64 - SKETCH_BITS), return_counts=True)
                at = at.astype(np.int64)
                sketch[at] = np.minimum(sketch[at] + counts, 255)
        none = pa.nulls(len(ns))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ns, pa.int64()), pa.array(signs, pa.binary()), pa.array([s and _node(s) for s in signs], pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())], schema=kind
        )
    if pa.types.is_null(kind.field(0).type):
        return
    sketch[sketch == 1] = 0  # most n-grams come once; those that many documents share come again in a task
    for k, counts in enumerate(sketch.reshape(-1, 1 << CHUNK_BITS)):
        if counts.any():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind.field(0).type), pa.array([0], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.array([k], pa.int32()), pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())],
                schema=kind,
            )


@tidy
def _sum_chunks(batches):
    """Add up the sketches of all tasks, chunk by chunk, and keep the binary logarithm of each cell, two a byte."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[k] = sums.get(k, 0) + np.frombuffer(zlib.decompress(counts), np.uint8).astype(np.uint32)
    for k, s in sums.items():
        logs = np.minimum(np.log2(np.maximum(s, 1).astype(np.float64)), 15).astype(np.uint8)
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([k], pa.int32()), "logs": pa.array([(logs[::2] | logs[1::2] << 4).tobytes()], pa.binary())})


def _rarity(logs: np.ndarray, s: np.ndarray) -> np.ndarray:
    """What the sketch says of each n-gram: the binary logarithm of how many documents have one of its cell."""
    cell = (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
    return logs[cell >> 1] >> (cell & 1).astype(np.uint8) * np.uint8(4) & np.uint8(15)


def _fresh(batches, size: int) -> Iterator[tuple[np.ndarray, bytes]]:
    """The sets of a task's documents, each once as far as the bounded memory of seen ones reaches."""
    seen: set[bytes] = set()
    for batch in batches:
        for part in slices(batch.column(0)):
            for s in shingle_sets(part, size):
                if len(s) and (sign := _sign(s)) not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(sign)
                    yield s, sign


def _lead(n: int, num: int, den: int) -> tuple[int, int, int]:
    """Of a set's n n-grams in order: how many a linked set must share one of, how many it must share k of, and the
    least k among all sets that it can link with."""
    k = lambda m: max(1, SPARE[0] * m // SPARE[1])
    least = -(-num * n // den)
    return n - least + 1, min(n, n - least + k(n)), k(least)


def _ordered(s: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """A set's n-grams, rarest first by the sketch, then by hash."""
    return s[np.argsort(_rarity(logs, s), kind="stable")]


@tidy
def _runs(batches, size: int, num: int, den: int, sketch, runs: int):
    """(run, packed): a task's chosen n-grams, each twice at most, cut by hash into runs."""
    logs, held, have = sketch.value, [], 0

    def cut():
        grams = np.sort(np.concatenate(held))
        grams = grams[np.concatenate(([True, True], grams[2:] != grams[:-2]))[: len(grams)]]
        of = ((grams >> np.uint64(32)) * np.uint64(runs)) >> np.uint64(32)
        edge = np.concatenate(([0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(grams)]))
        packed = [pack(grams[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(of[edge[:-1]].astype(np.int32)), pa.array(packed, pa.binary())], ["run", "packed"])

    for s, _ in _fresh(batches, size):
        held.append(_ordered(s, logs)[: _lead(len(s), num, den)[1]])
        have += len(held[-1])
        if have >= HELD_GRAMS:
            yield cut()
            held, have = [], 0
    if have:
        yield cut()


@tidy
def _twice(batches):
    """(chunk, bits): the marks of the n-grams that come twice in the runs of a partition."""
    runs: dict[int, list[bytes]] = {}
    for batch in batches:
        for k, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            runs.setdefault(k, []).append(packed)
    for parts in runs.values():
        grams = np.sort(np.concatenate([unpack(p) for p in parts]))
        cells = np.unique(grams[1:][grams[1:] == grams[:-1]] >> np.uint64(48 - SHARED_BITS)).astype(np.int64)
        if len(cells):
            low, high = int(cells[0]) >> 3, (int(cells[-1]) >> 3) + 1
            bits = np.zeros((high - low) * 8, np.uint8)
            bits[cells - low * 8] = 1
            yield pa.RecordBatch.from_pydict({"low": pa.array([low], pa.int32()), "bits": pa.array([zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)], pa.binary())})


def _marked(s: np.ndarray, bits: np.ndarray) -> np.ndarray:
    cell = (s >> np.uint64(64 - SHARED_BITS)).astype(np.int64)
    return bits[cell >> 3] >> (cell & 7).astype(np.uint8) & np.uint8(1) == 1


@tidy
def _postings(batches, size: int, num: int, den: int, sketch, shared):
    """(gram, node) for the chosen n-grams of each set that are marked as coming twice."""
    logs, bits = sketch.value, shared.value
    grams, nodes, have = [], [], 0
    to_batch = lambda: pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.concatenate(nodes))], ["gram", "node"])
    for s, sign in _fresh(batches, size):
        one, some, least = _lead(len(s), num, den)
        chosen = _ordered(s, logs)[:some]
        known = _marked(chosen, bits)
        if known.sum() < least:
            continue
        chosen = chosen[:one][known[:one]]
        grams.append(chosen)
        nodes.append(np.full(len(chosen), _node(sign), np.int64))
        have += len(chosen)
        if have >= 100_000:
            yield to_batch()
            grams, nodes, have = [], [], 0
    if have:
        yield to_batch()


@tidy
def _mark(batches):
    """The nodes that came by, as chunks of a bitmap."""
    bits = np.zeros(1 << FILTER_BITS, bool)
    for batch in batches:
        bits[batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)] = True
    for k, part in enumerate(np.packbits(bits).reshape(64, -1)):
        if part.any():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([k], pa.int32()), "bits": pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())})


@tidy
def _or_chunks(batches):
    got: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(zlib.decompress(bits), np.uint8)
            got[k] = got[k] | part if k in got else part
    for k, part in got.items():
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([k], pa.int32()), "bits": pa.array([part.tobytes()], pa.binary())})


@tidy
def _active_sets(batches, size: int, active):
    """Sign and set of the documents whose node may be active."""
    bits = np.unpackbits(active.value).astype(bool)
    rows: list[tuple[bytes, bytes]] = []
    have = 0
    for s, sign in _fresh(batches, size):
        node = _node(sign)
        if bits[(node & (1 << 64) - 1) >> (64 - FILTER_BITS)]:
            rows.append((sign, pack(s)))
            have += 8 * len(s)
            if have > 8 << 20:
                yield _set_batch(rows)
                rows, have = [], 0
    if rows:
        yield _set_batch(rows)


def _set_batch(rows):
    sign, grams = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(sign, pa.binary()), pa.array(grams, pa.binary())], ["sign", "grams"])


def _overlaps(sets: list[np.ndarray], steps: int = 4_000_000) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of the incidence matrix its overlap counts with the later rows: one row of the sparse product."""
    sizes = np.array([len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner = np.repeat(np.arange(len(sets)), sizes)[order]
    ends = np.cumsum(np.bincount(column))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    later = ends[column] - place - 1
    begin = np.concatenate(([0], np.cumsum(sizes)))
    for a in range(len(sets) - 1):
        at, n = place[begin[a] : begin[a + 1]] + 1, later[begin[a] : begin[a + 1]]
        at, n = at[n > 0], n[n > 0]
        counts = np.zeros(len(sets), np.int64)
        while len(n):
            cut = max(1, int(np.searchsorted(np.cumsum(n), steps, "right")))
            shift = np.repeat(at[:cut] - np.concatenate(([0], np.cumsum(n[:cut])[:-1])), n[:cut])
            counts += np.bincount(owner[shift + np.arange(len(shift))], minlength=len(sets))
            at, n = at[cut:], n[cut:]
        yield a, counts


LINKS = pa.schema([("sign", pa.binary()), ("root", pa.binary()), ("links", pa.int64())])


def _multiply(key, table: pa.Table, num: int, den: int) -> pa.Table:
    """Links within one pair of blocks: each document's least partner in its class here, and its number of links."""
    leader, left, right = (k.as_py() for k in key)
    table = table.sort_by("sign")
    signs, side, copies = (table.column(c).to_pylist() for c in ("sign", "block", "copies"))
    leaders = [frozenset(x) for x in table.column("leaders").to_pylist()]
    sets = [unpack(g) for g in table.column("grams").to_pylist()]
    sizes, parent, links = np.array([len(s) for s in sets]), list(range(len(sets))), [0] * len(sets)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, shared in _overlaps(sets) if len(sets) > 1 else ():
        for b in np.flatnonzero((shared > 0) & (den * shared >= num * (sizes[a] + sizes - shared))):
            b = int(b)
            if left != right and side[a] == side[b]:
                continue
            if min(leaders[a] & leaders[b]) == leader:  # the pair counts in one group alone
                links[a] += copies[b]
                links[b] += copies[a]
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    found = [k for k in range(len(sets)) if links[k] or find(k) != k]
    return pa.table([[signs[k] for k in found], [signs[find(k)] for k in found], [links[k] for k in found]], schema=LINKS)


def ngram_jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """(id, n_shingles, component_id, n_links) for every row of docs, linked where Jaccard >= num/den.

    A row's set holds the distinct runs of size words ([^\\x20\\x09-\\x0D]+, A-Z lower-cased); a text of fewer words is
    one run. Null texts and texts without words have the empty set (n_shingles 0), link with nothing and are a class
    of their own. component_id is the least id that links reach. n_links counts the other rows that link directly,
    copies included. Rows with a null id link as others do but never name a class, unless it has no other id (null).
    Repeated ids count as rows. Other columns of docs are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    both = cut_lineage(texts.mapInArrow(partial(_describe, size=size), f"id {kind}, n long, sign binary, node long, chunk int, counts binary"))
    base = both.where("chunk IS NULL").select("id", "n", "sign", "node")

    chunks = 1 << SKETCH_BITS - CHUNK_BITS
    sums = both.where("chunk IS NOT NULL").select("chunk", "counts").repartition(16, "chunk").mapInArrow(_sum_chunks, "chunk int, logs binary")
    logs = np.zeros((chunks, 1 << CHUNK_BITS - 1), np.uint8)
    for row in sums.collect():  # 2**SKETCH_BITS half bytes whatever the input
        logs[row.chunk] = np.frombuffer(row.logs, np.uint8)
    sketch = spark.sparkContext.broadcast(logs.reshape(-1))

    only = texts.select("text")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = only.mapInArrow(partial(_runs, size=size, num=num, den=den, sketch=sketch, runs=RUNS_PER_PARTITION * partitions), "run int, packed binary")
    marks = np.zeros(1 << SHARED_BITS - 3, np.uint8)
    for row in runs.repartition(partitions, "run").mapInArrow(_twice, "low int, bits binary").collect():  # 2**SHARED_BITS bits whatever the input
        bits = np.frombuffer(zlib.decompress(row.bits), np.uint8)
        marks[row.low : row.low + len(bits)] |= bits
    shared = spark.sparkContext.broadcast(marks)
    postings = only.mapInArrow(partial(_postings, size=size, num=num, den=den, sketch=sketch, shared=shared), "gram long, node long")
    led = postings.groupBy("gram").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader <> last").select("gram", "leader")
    met = postings.join(led, "gram").select("node", "leader").distinct()

    nodes = base.where("sign IS NOT NULL").groupBy("sign").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("node").alias("node"))
    # Sizes of linked sets differ by den/num at most, so their steps by one.
    step = F.floor(F.log(F.col("n")) / float(np.log(den / num)) * 0.999).cast("int")
    met = met.join(nodes.select("sign", "node", "n", "copies"), "node").withColumn("step", step)
    steps = met.select("leader", F.explode(F.array(F.col("step"), F.col("step") + 1)).alias("near")).groupBy("leader", "near").count().where("count > 1")
    steps = steps.select("leader", F.explode(F.array(F.col("near") - 1, F.col("near"))).alias("step")).distinct()
    met = cut_lineage(met.join(steps, ["leader", "step"], "left_semi").select("sign", "node", "n", "copies", "leader"))
    for done in (sketch, shared):  # met is written: nothing reads them again, not even after a loss
        done.destroy()
    del logs, marks
    give_back()

    marks = met.select("node").mapInArrow(_mark, "chunk int, bits binary").repartition(16, "chunk").mapInArrow(_or_chunks, "chunk int, bits binary")
    bits = np.zeros((64, (1 << FILTER_BITS) // 512), np.uint8)
    for row in marks.collect():  # 2**FILTER_BITS bits whatever the input
        bits[row.chunk] = np.frombuffer(row.bits, np.uint8)
    active = spark.sparkContext.broadcast(bits.reshape(-1))

    leaders = F.sort_array(F.collect_set("leader")).alias("leaders")
    member = met.groupBy("sign", "n", "copies").agg(leaders).withColumn("leader", F.explode("leaders"))
    blocks = member.groupBy("leader").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    cut = member.join(blocks, "leader").withColumn("block", F.pmod(F.xxhash64("sign"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = cut.select("leader", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "sign", "block", "copies", "leaders")
    sets = only.mapInArrow(partial(_active_sets, size=size, active=active), "sign binary, grams binary").dropDuplicates(["sign"])
    pairs = pairs.join(sets, "sign")

    def multiply(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _multiply(key, table, num, den)

    found = pairs.groupBy("leader", "left", "right").applyInArrow(multiply, "sign binary, root binary, links long")
    found = cut_lineage(found)
    active.destroy()
    del bits
    give_back()

    classes = connected_components(found.select(F.col("sign").alias("src"), F.col("root").alias("dst")))
    named = nodes.join(classes.withColumnRenamed("node", "sign"), "sign", "left").withColumn("component", F.coalesce("component", "sign"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    links = found.groupBy("sign").agg(F.sum("links").alias("links"))
    named = named.join(least, "component").join(links, "sign", "left")
    named = named.select("sign", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = base.join(named, "sign", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("sign").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def oracle(size: int = 5, num: int = 3, den: int = 4, table: str = "documents") -> str:
    """DuckDB SQL for the rows of ngram_jaccard_classes over a documents table of few rows."""
    grams = f"CASE WHEN len(w) >= {size} THEN list_distinct(list_transform(generate_series(1, len(w) - {size - 1}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"
    return f"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM {table}),
sets AS (SELECT doc_id, coalesce(CASE WHEN w IS NOT NULL THEN {grams} END, []) AS s FROM split),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS c FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT x, y FROM shared WHERE {den} * c >= {num} * (nx + ny - c)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(l.y, s.doc_id)) AS component_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links
FROM sets s LEFT JOIN least l ON s.doc_id = l.x LEFT JOIN degree d ON s.doc_id = d.x"""
