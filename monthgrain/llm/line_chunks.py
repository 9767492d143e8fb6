"""Line dedup by content-defined chunks; DataFrame operations only.

A line ends with a line break, with a sentence in a paragraph (a stop and a space), or after LINE_WORDS
words, counted from where it began; it keeps what it ends with, so that lines put together are the text.

Lines that occur once in all documents can't be in a repeated chunk. The others come in stretches; a
stretch also ends where the number of occurrences changes and then stays for two lines, which is where a
passage meets its surroundings if those are repeated too. Within a stretch a hash rolls over the
hashes of WINDOW lines, and a chunk ends where it has a local minimum. So boundaries depend on the
lines around them alone, a passage is cut alike wherever it stands, and, as minima aren't adjacent, a
chunk has two lines at least, and some three. A stretch of one line is none.

Of chunks that are equal byte for byte, the first occurrence (by id, then hash of the text, then place)
stays, and the others are removed. Lines are counted by hash (XXH64), with the least and the greatest MD5 of
each, as two numbers: only where these are the same does the hash stand for its line. The lines of all other hashes,
mostly none, are counted once more, by hash and MD5, which then stand for them (`clashing_lines`). So chunks are equal
if they have the same of these in a row, and are grouped by them.

Hashes of lines are shuffled once, after they are counted on the way (a line that occurs in a third of all
documents sends one row a task), then hashes and places, and the documents once, to take their
chunks out. Frequent lines and chunks are looked up by broadcast (`look_up`).

Defined cases: null texts stay null and have no lines; empty texts have none; rows that are equal in
id and text are one occurrence, and all or none lose a chunk; null ids come after all others; very long
texts are one row like others, cut whole; a document may lose all its lines, and then has an empty
text; an empty table gives an empty result; other columns pass through, but for n_lines and
removed_lines, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, look_up, own_name

LINE_WORDS = 24
WINDOW = 3
#: Base and modulus of the rolling hash.
BASE, MODULUS = 1_000_003, 1_048_573
#: Hashes that stand for several lines and are few enough to be broadcast.
FEW_CLASHES = 50_000
#: A line, for any engine of regular expressions: words that end no sentence, and then one that may. Nothing is
#: repeated in it but single characters, and words a fixed number of times, so long texts need no deep stack.
LINE = rf"(?:[^ \n]*[^ \n.!?] | ){{0,{LINE_WORDS - 1}}}[^ \n]*[ \n]?"


def lines_of(text: Column) -> Column:
    return F.filter(F.regexp_extract_all(text, F.lit(LINE), F.lit(0)), lambda x: x != "")


def _md5(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def _line_hash(line: Column) -> Column:
    """By which lines are counted."""
    return F.xxhash64(line)


def _rolling_hash(digest: Column) -> Column:
    """Of 60 bits, as a number, from a line's MD5."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _text_hash(text: Column) -> Column:
    return F.unhex(_md5(text))


def line_hashes(docs: DataFrame) -> DataFrame:
    """id, th (the hash of the text) and the hashes of its lines, for rows that are equal in both once."""
    rows = docs.select(F.col("doc_id").alias("id"), _text_hash(F.col("text")).alias("th"), F.transform(lines_of(F.col("text")), _line_hash).alias("hashes"))
    return rows.filter("th IS NOT NULL").groupBy("id", "th").agg(F.first("hashes").alias("hashes"))


def repeated_lines(docs: DataFrame, clashes: bool = False) -> DataFrame:
    """h, count and roll (the hash to be rolled) of the lines that occur more than once; with clashes also of the hashes
    that stand for several lines, with null for roll, and else without these."""
    each = docs.select(F.explode(lines_of(F.col("text"))).alias("line")).select(_line_hash(F.col("line")).alias("h"), _md5(F.col("line")).alias("digest"))
    hashed = each.select("h", _rolling_hash(F.col("digest")).alias("roll"), F.xxhash64("digest").alias("check"))
    ends = [f(c).alias(f"{name}_{c}") for c in ("roll", "check") for f, name in ((F.min, "least"), (F.max, "greatest"))]
    counts = hashed.groupBy("h").agg(F.count("*").alias("count"), *ends)
    one = F.expr("least_roll = greatest_roll AND least_check = greatest_check")
    found = counts.filter("count > 1").select("h", "count", F.when(one, F.col("least_roll")).alias("roll"))
    return found if clashes else found.filter("roll IS NOT NULL")


def clashing_lines(docs: DataFrame, clashing: DataFrame) -> DataFrame:
    """id, th, i, h (hash and MD5, as text), n and roll of the lines that occur more than once, of the hashes in clashing
    (h, count)."""
    row = docs.select(F.col("doc_id").alias("id"), _text_hash(F.col("text")).alias("th"), F.posexplode(lines_of(F.col("text"))).alias("i", "line"))
    each = row.select("id", "th", "i", _line_hash(F.col("line")).alias("h"), _md5(F.col("line")).alias("digest"))
    if clashing.count() <= FEW_CLASHES:
        own = each.join(F.broadcast(clashing.select("h")), "h", "left_semi")
    else:
        total = clashing.agg(F.sum("count")).first()[0]
        own = look_up(each, "h", clashing.withColumn("clashes", F.lit(True)), "count", total, ["id", "th", "i"]).filter("clashes")
    lines = cut(own.select("id", "th", "i", F.concat_ws(":", F.col("h").cast("string"), "digest").alias("h"), _rolling_hash(F.col("digest")).alias("roll")))
    counts = cut(lines.groupBy("h").agg(F.count("*").alias("count")).filter("count > 1").withColumn("n", F.col("count")))
    total = counts.agg(F.sum("count")).first()[0] or 0
    return look_up(lines.dropDuplicates(["id", "th", "i"]), "h", counts, "count", total, ["id", "th", "i"]).filter("n IS NOT NULL")


def chunk_places(lined: DataFrame, repeated: DataFrame, clashing: DataFrame | None = None) -> DataFrame:
    """id, th, first (line, from 0), n (lines) and content (what stands for them) of the chunks of repeated lines, those
    of clashing (see clashing_lines) included."""
    each = lined.select("id", "th", F.posexplode("hashes").alias("i", "h"))
    total = repeated.agg(F.sum("count")).first()[0] or 0
    rows = look_up(each, "h", repeated.withColumn("n", F.col("count")), "count", total, ["id", "th", "i"]).filter("n IS NOT NULL")
    if clashing is not None:
        rows = rows.withColumn("h", F.col("h").cast("string")).unionByName(clashing)

    order = Window.partitionBy("id", "th").orderBy("i")
    back = lambda c, k=1: F.lag(c, k).over(order)
    follows = back("i") == F.col("i") - 1
    steady = (back("i", 2) == F.col("i") - 2) & (back("n", 2) == back("n")) & (F.lead("i").over(order) == F.col("i") + 1) & (F.lead("n").over(order) == F.col("n"))
    begins = F.when(follows & ~F.coalesce(steady & (back("n") != F.col("n")), F.lit(False)), 0).otherwise(1)
    stretches = rows.withColumn("begins", begins).withColumn("stretch", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    within = Window.partitionBy("id", "th", "stretch").orderBy("i")
    rolled = sum((F.coalesce(F.lag("roll", k).over(within), F.lit(0)) % MODULUS * (BASE**k % MODULUS) for k in range(WINDOW)), F.lit(0)) % MODULUS
    hashed = stretches.withColumn("rolled", rolled).withColumn("place", F.row_number().over(within)).withColumn("size", F.count("*").over(Window.partitionBy("id", "th", "stretch")))
    least = (F.col("rolled") < F.lag("rolled").over(within)) & (F.col("rolled") < F.lead("rolled").over(within))
    ends = F.when(F.col("place").between(2, F.col("size") - 2) & least, 1).otherwise(0)
    chunks = hashed.filter("size > 1").withColumn("ends", ends).withColumn("chunk", F.coalesce(F.sum("ends").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    spans = chunks.groupBy("id", "th", "stretch", "chunk").agg(F.min("i").alias("first"), F.count("*").cast("int").alias("n"), F.sort_array(F.collect_list(F.struct("i", "h"))).alias("lines"))
    return spans.select("id", "th", "first", "n", F.array_join(F.transform("lines", lambda x: x["h"].cast("string")), " ").alias("content"))


def repeated_spans(places: DataFrame) -> DataFrame:
    """id, th and gone, the spans of its chunks to remove, of each document that loses any."""
    place = F.struct(F.col("id").isNull().alias("nameless"), "id", "th", "first")
    groups = cut(places.groupBy("content").agg(F.count("*").alias("count"), F.min(place).alias("kept")).filter("count > 1"))
    marked = look_up(places, "content", groups, "count", groups.agg(F.sum("count")).first()[0] or 0, ["id", "th", "first"])
    gone = marked.filter(F.col("kept").isNotNull() & ~(F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("th") == F.col("kept.th")) & (F.col("first") == F.col("kept.first"))))
    return gone.groupBy("id", "th").agg(F.sort_array(F.collect_set(F.struct("first", "n"))).alias("gone"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs without their repeated chunks, with n_lines (before) and removed_lines."""
    names = [c for c in docs.columns if c not in ("n_lines", "removed_lines")]
    counted = cut(repeated_lines(docs, clashes=True))
    repeated, several = counted.filter("roll IS NOT NULL"), counted.filter("roll IS NULL")
    clashing = None if several.isEmpty() else clashing_lines(docs, several)
    lined = cut(line_hashes(docs))
    gone = cut(repeated_spans(cut(chunk_places(lined, repeated, clashing))))
    key_id, key_hash, own_gone, size, lines = (own_name(docs, n) for n in ("key_id", "key_hash", "gone_spans", "line_count", "line_texts"))
    sized = lined.select(F.col("id").alias(key_id), F.col("th").alias(key_hash), F.size("hashes").alias(size))
    known = sized.join(gone.select(F.col("id").alias("g"), F.col("th").alias("h"), F.col("gone").alias(own_gone)), F.col(key_id).eqNullSafe(F.col("g")) & (F.col(key_hash) == F.col("h")), "left").drop("g", "h")
    joined = docs.join(known.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col(key_id)) & (_text_hash(F.col("text")) == F.col(key_hash)), "left")
    spans = F.col(own_gone)
    after = lambda j: F.coalesce(F.get(spans, j)["first"] + F.get(spans, j)["n"], F.lit(0))
    left = F.transform(F.sequence(F.lit(0), F.size(spans)), lambda j: F.slice(lines, after(j - 1) + 1, F.coalesce(F.get(spans, j)["first"], F.size(lines)) - after(j - 1)))
    text = F.when(spans.isNotNull(), F.array_join(F.flatten(left), "")).otherwise(F.col("text"))
    cuts = joined.withColumn(lines, F.when(spans.isNotNull(), lines_of(F.col("text"))))
    return cuts.select(
        *(text.alias("text") if c == "text" else F.col(f"`{c}`") for c in names),
        F.coalesce(F.col(size), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.aggregate(spans, F.lit(0), lambda a, s: a + s["n"]), F.lit(0)).cast("long").alias("removed_lines"),
    )


#: DuckDB SQL for the rows of op10_line_chunks.
SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text, md5(text) AS th FROM documents),
split AS (SELECT r, doc_id, th, [x for x in regexp_extract_all(text, '{LINE}') if x <> ''] AS lines FROM docs WHERE text IS NOT NULL),
each AS (SELECT r, doc_id, th, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i FROM split),
counted AS (SELECT *, CAST('0x' || substr(md5(line), 1, 15) AS BIGINT) AS h, count(*) OVER (PARTITION BY line) AS n FROM each),
repeated AS (
  SELECT *, lag(i) OVER d IS NOT DISTINCT FROM i - 1 AS follows,
         coalesce(lag(i, 2) OVER d = i - 2 AND lag(n, 2) OVER d = lag(n) OVER d AND lead(i) OVER d = i + 1 AND lead(n) OVER d = n AND lag(n) OVER d <> n, FALSE) AS changes
  FROM counted WHERE n > 1 WINDOW d AS (PARTITION BY r ORDER BY i)),
stretches AS (SELECT *, sum(CASE WHEN follows AND NOT changes THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS stretch FROM repeated),
hashed AS (
  SELECT *, ({" + ".join(f"coalesce(lag(h, {k}) OVER s, 0) % {MODULUS} * {BASE**k % MODULUS}" for k in range(WINDOW))}) % {MODULUS} AS rolled,
         row_number() OVER s AS place, count(*) OVER (PARTITION BY r, stretch) AS size
  FROM stretches WINDOW s AS (PARTITION BY r, stretch ORDER BY i)),
ended AS (
  SELECT *, place BETWEEN 2 AND size - 2 AND coalesce(rolled < lag(rolled) OVER s AND rolled < lead(rolled) OVER s, FALSE) AS ends
  FROM hashed WINDOW s AS (PARTITION BY r, stretch ORDER BY i)),
numbered AS (SELECT *, coalesce(sum(CAST(ends AS INTEGER)) OVER (PARTITION BY r, stretch ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM ended WHERE size > 1),
chunks AS (
  SELECT r, doc_id, th, stretch, chunk, min(i) AS first, string_agg(line, '' ORDER BY i) AS content FROM numbered GROUP BY ALL),
placed AS (
  SELECT *, (doc_id, th, first) IS DISTINCT FROM first_value((doc_id, th, first)) OVER (PARTITION BY content ORDER BY doc_id NULLS LAST, th, first) AS gone
  FROM chunks),
marked AS (
  SELECT e.r, e.i, e.line, coalesce(p.gone, FALSE) AS gone
  FROM each e LEFT JOIN numbered m ON m.r = e.r AND m.i = e.i LEFT JOIN placed p ON p.r = m.r AND p.stretch = m.stretch AND p.chunk = m.chunk),
texts AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS removed_lines, coalesce(string_agg(line, '' ORDER BY i) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY r)
SELECT d.doc_id, CASE WHEN t.r IS NULL THEN d.text ELSE t.text END AS text, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.removed_lines, 0) AS removed_lines
FROM docs d LEFT JOIN texts t USING (r)
"""
