"""Spelling variants by asymmetric q-chunks; DataFrame operations only.

Two words are near if one inserted, deleted or replaced code point makes one of the other. Of such a pair
the longer word (of equally long ones either) contributes two disjoint chunks, its halves. One edit
leaves one of them whole, and the other word has it among its positional grams of that length: a first half in its
place, a second half in its place or, where the lengths differ, one before. So each word gives its chunks once,
and of all its positional grams those that a chunk of a word as long or one longer may fall on within that
shift; both are joined by their text, place and the words' lengths.

A half is a key that very many words may share (a prefix, an ending). What a kept half leaves has the one edit, so
the same step is taken on it again: its halves are the chunks, of which one is kept. A key is then a word
without a quarter of it, and the pairs that are looked at are words which differ in that quarter alone. Each near pair is
found at the quarter that its first difference is in, and so once, without a distinct; the whole words
are compared before a pair leaves the join. Keys that still have many words are split by Spark (skew join).

A word's form is its most frequent near word, if that is at least `ratio` times as frequent; forms lead to a
root in at most log(greatest count) / log(ratio) steps, so roots take that many joins.

Defined cases: null texts have no words, empty ones none; a null id counts as the empty text where an id is
hashed; very long texts are read whole, and a run of a million letters is a word that gives eight keys like any
other; repeated rows count each time; of near words equally frequent the smallest in code-point order is
meant; words without near words are their own root; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: A letter of a word: ASCII and Latin-1 from U+00C0 on.
LETTER = r"[A-Za-zÀ-ÿ]"
#: Shortest word that is looked at, and least number of its occurrences.
MIN_LENGTH, MIN_COUNT = 7, 2
#: How many times more frequent a word's form is.
RATIO = 10


def runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id and each maximal run of letters of that length or more, with A-Z made lower case."""
    found = F.explode(F.regexp_extract_all("text", F.lit(f"({LETTER}{{{min_length},}})"), F.lit(1)))
    return docs.select("doc_id", found.alias("run")).withColumn("run", F.translate("run", string.ascii_uppercase, string.ascii_lowercase))


def vocabulary(tokens: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n of the tokens (a column word) that are long and frequent enough."""
    return tokens.filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _quarters(length: Column) -> list[tuple[Column, Column]]:
    """Start and end of the parts of a word of that length that its halves and then their halves leave over."""
    half = (length / 2).cast("int")
    first, second = (half / 2).cast("int"), half + ((length - half) / 2).cast("int")
    return [(second, length), (half, second), (first, half), (F.lit(0), first)]


def _keyed(words: DataFrame, longer: bool) -> DataFrame:
    """word, n, key and the letters left out of each of a word's keys: as the longer word of a pair (or either of equally long
    ones), or as the other. A key tells how much longer the longer word is, its length, and which part is left out."""
    size, keys = F.length("word"), []
    for more in (0, 1):
        length = size if longer else size + more
        for part, (start, end) in enumerate(_quarters(length)):
            shift = 0 if longer else more
            before, after = F.substring("word", F.lit(1), start), F.col("word").substr(end - shift + 1, size)
            left = F.col("word").substr(start + 1, end - start)
            keys.append(F.struct(F.xxhash64(F.lit(more), length, F.lit(part), before, after).alias("key"), F.lit(more).alias("more"), left.alias("left")))
    return words.select("word", "n", F.explode(F.array(*keys)).alias("k")).select("word", "n", "k.*")


def near_pairs(words: DataFrame) -> DataFrame:
    """long, long_n, other, other_n: each two words that differ by one edit, once."""
    a = _keyed(words, True).select("key", "more", F.col("left").alias("long_left"), F.col("word").alias("long"), F.col("n").alias("long_n"))
    b = _keyed(words, False).select(F.col("key").alias("other_key"), F.col("left").alias("other_left"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    first_difference_here = F.col("long_left") != F.col("other_left")
    once = (F.col("more") == 1) | (F.col("long") < F.col("other"))
    joined = a.join(b, (F.col("key") == F.col("other_key")) & first_difference_here & once & (F.levenshtein("long", "other", 1) == 1))
    return joined.select("long", "long_n", "other", "other_n")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of words (columns word and n, a row a word)."""
    words = cut(words)
    pairs = near_pairs(words)
    side = lambda a, b: F.struct(F.col(a).alias("word"), F.col(b).alias("near"), F.col(f"{b}_n").alias("near_n"))
    ways = pairs.select(F.explode(F.array(side("long", "other"), side("other", "long"))).alias("w")).select("w.*")
    best = ways.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    found = words.join(best, "word", "left")
    enough = -F.col("best.m") >= F.col("n") * ratio
    formed = found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n"))
    formed = cut(formed)
    return formed.join(roots(formed, ratio), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(formed: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word and root of the words that have a form: its counts grow by ratio with each step, so steps are few."""
    links = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    least, most = formed.agg(F.min("n"), F.max("n")).first()
    steps = math.ceil(math.log(most / least, ratio) - 1e-9) if least else 0
    following = links.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
    for _ in range(steps - 1):
        links = links.join(following, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_next", "root").alias("root"))
    return links


def damaged(docs: DataFrame, every: int = 31) -> DataFrame:
    """The runs of docs as tokens to be grouped, one in `every` (by the checksum of id and run) without one of its letters."""
    rows = runs(docs).withColumn("_h", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary")))
    at = (F.col("_h") % F.length("run")).cast("int")
    cut_out = F.concat(F.substring("run", F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return rows.select(F.when(F.col("_h") % every == 0, cut_out).otherwise(F.col("run")).alias("word"))


#: CRC-32 of texts of ASCII and Latin-1 code points, in DuckDB's SQL: bytes of UTF-8, and the table made by its rule.
CRC_SQL = """crc_table AS (SELECT list_transform(range(256), lambda c: list_reduce(list_prepend(c, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab)"""


def crc_sql(text: str) -> str:
    """CRC-32 of an expression, beside crc_table."""
    point = "CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(192 | (unicode(c) >> 6) AS BIGINT), CAST(128 | (unicode(c) & 63) AS BIGINT)] END"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split({text}, ''), lambda c: {point}))), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"


SQL = f"""WITH RECURSIVE {CRC_SQL},
found AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]{{7,}}')), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run FROM documents),
hashed AS (SELECT run, {crc_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM found, crc_table),
tokens AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, count(*) AS n FROM tokens WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
without AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS near FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
          UNION SELECT word, rest FROM without WHERE rest IN (SELECT word FROM words)
          UNION SELECT rest, word FROM without WHERE rest IN (SELECT word FROM words)),
ranked AS (SELECT p.word, p.near, b.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near, row_number() OVER (PARTITION BY p.word ORDER BY b.n DESC, p.near) AS place FROM pairs p JOIN words b ON b.word = p.near),
formed AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
                        FROM words w LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON r.word = w.word),
steps AS (SELECT word, word AS at FROM formed UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NOT NULL),
ends AS (SELECT s.word, s.at AS root FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN ends USING (word)"""
