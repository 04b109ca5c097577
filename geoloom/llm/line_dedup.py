"""Line dedup by winnowing over line hashes, in DataFrame operations only.

A window is a least run of whole lines with min_chars characters or more, line ends counted: forward from each line, or
backward from it. Winnowing takes the minimum of the line hashes in every forward window as a fingerprint (the rightmost
of equals), so any run of min_chars characters that two places share holds a shared fingerprint. Fingerprints are joined
on their values; positions of those that come twice or more are extended line by line both ways, to all windows that
hold them. What two places share from a fingerprint on is the union of their equal windows, whatever lies between the
places or around them, and every shared run of min_chars characters is such a union: a line of it lies in the window
forward from it or backward from it, or in one that begins before it and ends behind it. So instead of pairs of places
the windows are grouped by what they hold, and all but the first of a group are deleted: no pair of places is listed,
however often a passage comes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_CHARS = 200


def hash60(text: Column) -> Column:
    """60 bits of MD5 as a whole number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _doc(id_: Column, text: Column) -> Column:
    """128 bits that stand for a row's id and text."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.concat(F.lit("i"), id_.cast("string")), F.lit("n")), F.lit(":"), text)))


def _windows(rows: DataFrame, min_chars: int) -> tuple[DataFrame, Window, Window]:
    """rows of lines with their first character and the one behind their last, and the frames forward and backward."""
    in_order = Window.partitionBy("doc").orderBy("pos", "size")
    rows = rows.withColumn("fin", F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("start", F.col("fin") - F.col("size")).withColumn("fin", F.col("fin") + F.col("own"))
    doc = Window.partitionBy("doc")
    return rows, doc.orderBy("start").rangeBetween(0, min_chars - 1), doc.orderBy("fin").rangeBetween(1 - min_chars, 0)


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, gone): the runs of lines to delete of each text that has any, where doc stands for the row's id and text.

    gone holds (low, high): the first and the last line of a run, counted from 0. Runs don't touch.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    line = lambda x: F.struct(hash60(x).alias("h"), (F.length(x) + 1).cast("long").alias("size"))
    rows = rows.select(_doc(F.col("id"), F.col("text")).alias("doc"), F.struct("id", F.transform(F.split("text", "\n", -1), line).alias("lines")).alias("held"))
    texts = rows.groupBy("doc").agg(F.first("held").alias("held"))  # one shuffle of hashes serves both passes

    lines = texts.select("doc", F.posexplode("held.lines").alias("pos", "line")).select("doc", "pos", "line.h", "line.size", F.lit(0).alias("own"))
    lines, forward, _ = _windows(lines, min_chars)
    least = F.min(F.struct("h", (-F.col("pos")).alias("back"))).over(forward)
    prints = lines.select("doc", "start", F.max("fin").over(forward).alias("stop"), least.alias("least")).where(F.col("stop") - F.col("start") >= min_chars)
    prints = prints.select("doc", F.col("least.h").alias("h"), (-F.col("least.back")).alias("pos")).distinct()
    shared = prints.groupBy("h").count().where("count > 1").select("h")
    met = prints.join(shared, "h").groupBy("doc").agg(F.collect_list("pos").alias("marks"))

    # A mark is a row of no size before its line, so the frames of lines see it.
    own = F.transform("held.lines", lambda x, k: F.struct(k.alias("pos"), x["h"].alias("h"), x["size"].alias("size"), F.lit(0).cast("long").alias("own")))
    mark = F.transform("marks", lambda k: F.struct(k.alias("pos"), F.lit(None).cast("long").alias("h"), F.lit(0).cast("long").alias("size"), F.col("held.lines")[k]["size"].alias("own")))
    near = texts.join(met, "doc").select("doc", F.col("held.id").alias("id"), F.explode(F.concat(own, mark)).alias("line")).select("doc", "id", "line.*")
    near, forward, backward = _windows(near, min_chars)
    held = lambda frame: F.struct(
        F.min("pos").over(frame).alias("low"), F.max("pos").over(frame).alias("high"), F.max("own").over(frame).alias("marked"),
        (F.max("fin").over(frame) - F.min("start").over(frame)).alias("chars"), F.min("h").over(frame).alias("least"), F.xxhash64(F.collect_list("h").over(frame)).alias("all"),
    )
    both = near.select("doc", "id", "own", held(forward).alias("f"), held(backward).alias("b")).where("own = 0")
    runs = both.select("doc", "id", F.explode(F.array("f", "b")).alias("w")).where((F.col("w.marked") > 0) & (F.col("w.chars") >= min_chars))
    runs = runs.select("doc", "id", "w.low", "w.high", "w.least", "w.all")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "doc", "low")
    first = runs.groupBy("least", "all").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("least", "all", "first")
    later = runs.join(first, ["least", "all"]).where("NOT (doc = first.doc AND low = first.low)").select("doc", "low", "high")

    in_order = Window.partitionBy("doc").orderBy("low", "high")
    before = F.max("high").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    later = later.withColumn("fresh", F.when(F.col("low") <= before + 1, 0).otherwise(1))
    later = later.withColumn("run", F.sum("fresh").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    later = later.groupBy("doc", "run").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return later.groupBy("doc").agg(F.collect_list(F.struct("low", "high")).alias("gone"))


def unused(taken: list[str], name: str) -> str:
    """name, or it with as many underscores behind as keep it apart from the names taken, whatever their case."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with its later repeated runs of lines cut from the text, and n_lines, n_removed (lines) beside it.

    A run is one or more whole lines in a row, of min_chars characters or more together, where a line's size is its
    characters and one for its end. A run that equals a run at any earlier place in (id, text, line) order is cut, whether
    that lies in the same text or in another one; null ids come last, and rows of equal id stand in the order of a hash of
    their text. A text whose lines all go becomes empty. Null texts stay null (0 lines). Rows equal in id and text are one
    document: each of them keeps what the others keep. Lines end at \\n alone. Other columns pass through under their
    names, except that n_lines and n_removed replace columns of these names. An empty table gives an empty result.
    """
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    doc, gone_doc, gone, lines = (unused(docs.columns, n) for n in ("doc", "gone_doc", "gone", "lines"))
    runs = repeated_runs(docs, id_col, text_col, min_chars).toDF(gone_doc, gone)
    text = F.col(f"`{text_col}`").cast("string")
    both = docs.withColumn(doc, _doc(F.col(f"`{id_col}`"), text)).join(runs, F.col(doc) == F.col(gone_doc), "left")
    both = both.withColumn(lines, F.split(text, "\n", -1))
    inside = lambda k: F.exists(F.col(gone), lambda run: k.between(run["low"], run["high"]))
    kept = F.array_join(F.filter(F.col(lines), lambda _, k: ~inside(k)), "\n")
    removed = F.aggregate(F.col(gone), F.lit(0), lambda n, run: n + run["high"] - run["low"] + 1)
    cut = F.when(F.col(gone).isNull(), text).otherwise(kept).alias(text_col)
    return both.select(
        *(cut if c == text_col else F.col(f"`{c}`") for c in others),
        F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"), F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
    )


def oracle(min_chars: int = MIN_CHARS, table: str = "documents") -> str:
    """DuckDB SQL for the rows of dedup_lines over a documents table: all windows by their text, without fingerprints."""
    window = lambda frame, order, span: f"SELECT id, doc, min(pos) OVER w AS low, max(pos) OVER w AS high, max(fin) OVER w - min(start) OVER w AS chars, list(line) OVER w AS held FROM lines WINDOW w AS (PARTITION BY doc ORDER BY {order} RANGE BETWEEN {span})"
    doc = "md5(coalesce('i' || doc_id, 'n') || ':' || text)"
    return f"""
WITH raw AS (SELECT DISTINCT doc_id AS id, {doc} AS doc, text FROM {table} WHERE text IS NOT NULL),
split AS (SELECT id, doc, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM raw),
ends AS (SELECT *, CAST(sum(length(line) + 1) OVER (PARTITION BY doc ORDER BY pos) AS BIGINT) AS fin FROM split),
lines AS (SELECT *, fin - length(line) - 1 AS start FROM ends),
runs AS ({window('f', 'start', f'CURRENT ROW AND {min_chars - 1} FOLLOWING')} UNION {window('b', 'fin', f'{min_chars - 1} PRECEDING AND CURRENT ROW')}),
placed AS (SELECT *, row_number() OVER (PARTITION BY held ORDER BY id NULLS LAST, doc, low) AS turn FROM runs WHERE chars >= {min_chars}),
gone AS (SELECT DISTINCT doc, unnest(generate_series(low, high)) AS pos FROM placed WHERE turn > 1),
kept AS (SELECT s.doc, count(*) AS n_lines, count(g.pos) AS n_removed, string_agg(s.line, chr(10) ORDER BY s.pos) FILTER (g.pos IS NULL) AS text
  FROM split s LEFT JOIN gone g ON s.doc = g.doc AND s.pos = g.pos GROUP BY s.doc)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, d.lang, d.source, d.n_chars, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM (SELECT *, {doc} AS doc FROM {table}) d LEFT JOIN kept k ON d.doc = k.doc"""
