"""Benchmark decontamination with DataFrame functions only.

Benchmark items are normalised to lower-case words; every window of ``size``
consecutive words (an item of fewer words is one window) goes into a hash set that
is broadcast when its counted size is within ``max_broadcast``; a larger set is
joined by shuffle. Documents are scanned by token windows: a window is looked up
only where all its words may occur in the benchmark, told by a set of at most
WORD_CELLS hash cells whatever the benchmark's size, which leaves few. A hit is
verified by equality of the window's words, not of hashes.

Everything about one document happens in its row, so no group of copies meets in
one task; only documents' numbers and verified hits are shuffled, by row, and to
drop documents only the digests of those that go.

Defined results: null or empty text and text without words has no words and no
hits; null benchmark texts have no windows; an item with null id marks words but
isn't listed; repeated documents are judged one by one; of very long texts every
window counts; empty tables give no rows, or no hits. Columns of ``docs`` keep
their values whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import ascii_lower, hinted, materialise, read_table, reserved

#: Characters of a word after lower-casing A-Z, and in the text as it stands.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Windows up to which the hash set is broadcast (about 100 bytes each).
MAX_BROADCAST = 1_000_000
#: Cells that benchmark words are hashed to.
WORD_CELLS = 1 << 18


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _window(words: Column, at: Column, n: int) -> Column:
    return F.concat_ws(" ", *[F.get(words, at + k) for k in range(n)])


def benchmark_windows(benchmark: DataFrame, size: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows with their length and the ids of the items they occur in."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("n", F.least(F.size("words"), F.lit(size)))
    at = items.select("item", "n", "words", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("n"))).alias("at"))
    window = reduce(lambda rest, n: F.when(F.col("n") == n, _window(F.col("words"), F.col("at"), n)).otherwise(rest), range(1, size + 1), F.lit(None))
    return at.select("item", "n", window.alias("window")).groupBy("window", "n").agg(F.collect_set("item").alias("items"))


def _candidates(words: Column, known: Column, n: int) -> Column:
    """Windows of ``n`` words that are all known, with their places."""
    places = F.when(F.size(known) >= n, F.sequence(F.lit(0), F.size(known) - n)).otherwise(F.array().cast("array<int>"))
    hit = F.filter(places, lambda p: reduce(lambda x, y: x & y, [F.get(known, p + k) for k in range(n)]))
    return F.transform(hit, lambda p: F.struct(p.alias("at"), F.lit(n).alias("n"), _window(words, p, n).alias("window")))


def _cell(word: Column) -> Column:
    return F.hash(word).bitwiseAND(F.lit(WORD_CELLS - 1))


def _possible(docs: DataFrame, kept: dict[str, Column], windows: DataFrame, text: str) -> tuple[DataFrame, Column]:
    """Rows of ``kept`` with __words, and the column of windows that may be the benchmark's."""
    lengths = [r["n"] for r in windows.select("n").distinct().collect()]  # as many as a window has words, at most
    cells = [r[0] for r in windows.select(F.explode(F.split("window", " ")).alias("w")).select(_cell(F.col("w"))).distinct().collect()]
    rows = docs.select(*[c.alias(name) for name, c in kept.items()], words_of(F.col(f"`{text}`")).alias("__words"))
    rows = rows.withColumn("__known", F.transform("__words", lambda w: _cell(w).isin(cells) if cells else F.lit(False)))
    found = [_candidates(F.col("__words"), F.col("__known"), n) for n in sorted(lengths)]
    return rows, F.concat(*found) if found else F.array().cast("array<struct<at:int,n:int,window:string>>")


def contamination(docs: DataFrame, benchmark: DataFrame, keys: list[str], size: int = 10, text: str = "text", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``keys`` and n_words, hits (array of at, n), items (sorted ids as strings) of each row."""
    windows = materialise(benchmark_windows(benchmark, size))
    named = {f"__k{i}": F.col(f"`{k}`") for i, k in enumerate(keys)}
    rows, possible = _possible(docs, named | {"__row": F.monotonically_increasing_id()}, windows, text)
    # The first entry has no window and keeps a row for each document.
    none = F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).alias("n"), F.lit(None).cast("string").alias("window")))
    found = rows.select(*named, "__row", F.size("__words").cast("long").alias("n_words"), F.explode(F.concat(none, possible)).alias("c"))
    found = found.select(*named, "__row", "n_words", "c.at", F.col("c.n").alias("n"), F.col("c.window").alias("window"))
    sides = windows.select("window", "items")
    found = found.join(F.broadcast(sides) if windows.count() <= max_broadcast else sides, "window", "left")
    found = found.where(F.col("window").isNull() | F.col("items").isNotNull())
    one = F.when(F.col("window").isNotNull(), F.struct("at", "n"))
    judged = found.groupBy(*named, "__row", "n_words").agg(
        F.collect_set(one).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    return judged.select(*[F.col(n).alias(k) for n, k in zip(named, keys)], "n_words", "hits", "items")


def contaminated_digests(docs: DataFrame, benchmark: DataFrame, digest: Column, size: int = 10, text: str = "text", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Distinct ``digest`` of the rows that hold a window: what is shuffled is hits alone."""
    windows = materialise(benchmark_windows(benchmark, size))
    rows, possible = _possible(docs, {"digest": digest}, windows, text)
    sides = windows.select("window")
    found = rows.select("digest", F.explode(possible).alias("c")).select("digest", F.col("c.window").alias("window"))
    return found.join(F.broadcast(sides) if windows.count() <= max_broadcast else sides, "window", "left_semi").select("digest").distinct()


def hit_words(hits: Column) -> Column:
    """Places of the words inside any hit."""
    return F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["at"], h["at"] + h["n"] - 1))))


def decontaminate(docs: DataFrame, benchmark: DataFrame, how: str = "documents", size: int = 10, text: str = "text") -> DataFrame:
    """``docs`` without contaminated documents, or (``how`` = "spans") without their hit words.

    Contamination depends on the text alone, so texts are told apart by digest:
    null and repeated ids do no harm.
    """
    if how not in ("documents", "spans"):
        raise ValueError(how)
    digest = F.md5(F.encode(F.col(f"`{text}`"), "UTF-8"))
    own = reserved(docs, "digest", "cut", "words", "gaps")
    marked = docs.withColumn(own["digest"], digest)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if how == "documents":
        gone = hinted(materialise(contaminated_digests(docs, benchmark, digest, size, text).select(F.col("digest").alias(own["digest"]))))
        return marked.join(gone, own["digest"], "left_anti").select(*columns)
    judged = contamination(docs.select(digest.alias("digest"), F.col(f"`{text}`").alias("text")), benchmark, ["digest"], size).where(F.size("hits") > 0)
    cut = judged.groupBy(F.col("digest").alias(own["digest"])).agg(F.first(hit_words(F.col("hits"))).alias(own["cut"]))
    parts = marked.join(hinted(materialise(cut)), own["digest"], "left").withColumns({
        own["words"]: F.regexp_extract_all(f"`{text}`", F.lit(WORD_ANY_CASE), F.lit(0)),
        own["gaps"]: F.split(F.col(f"`{text}`"), WORD_ANY_CASE, -1),
    })
    word = lambda i: F.when(F.array_contains(own["cut"], i), F.lit("")).otherwise(F.coalesce(F.get(own["words"], i), F.lit("")))
    rebuilt = F.array_join(F.transform(own["gaps"], lambda g, i: F.concat(g, word(i))), "")
    changed = F.when(F.col(own["cut"]).isNull(), F.col(f"`{text}`")).otherwise(rebuilt)
    return parts.withColumn(text, changed).select(*columns)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    judged = contamination(docs, benchmark, ["doc_id"])
    return judged.select(
        "doc_id",
        "n_words",
        F.size(hit_words(F.col("hits"))).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


OP7_SQL = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(words[i + 1 : i + n], ' ') AS win
  FROM (SELECT item_id, words, least(len(words), 10) AS n, unnest(range(0, len(words) - least(len(words), 10) + 1)) AS i
        FROM b WHERE len(words) > 0)
), lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, n, i, array_to_string(words[i + 1 : i + n], ' ') AS win
  FROM (SELECT r, words, n, unnest(range(0, len(words) - n + 1)) AS i FROM w, lens WHERE len(words) >= n)
), h AS (SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
cov AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
"""
