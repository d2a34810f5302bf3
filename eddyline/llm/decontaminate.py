"""Benchmark decontamination: a prefix-filtered join of documents with item-sized windows, in DataFrame functions only.

Every window of an item (10 consecutive words, or the whole item if shorter) is a set of 3-word shingles that a document
must contain entirely. For containment of all tokens the necessary prefix in rarity order is one token, so each window
joins by the one of its shingles that is rarest in the corpus; windows with a shingle that no document has are dropped
at once. A joined position fixes where the window would start; length and position bounds are applied, and the words
themselves are compared.

Two passes over the texts: one counts the benchmark's shingles in the corpus (hash aggregation with map-side combine), one joins
the prefixes and verifies in the same task, so texts are never shuffled. The benchmark's shingles are broadcast only if
they are measured to be small (`MAX_BROADCAST_BYTES`); otherwise both joins shuffle, and a position then carries the few
words around it that verification can need. Occurrences of a passage that many documents share are rows of their own
documents, and joins on such a passage have one row per passage on the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import LOWER, UPPER, fits, join_null_safe, let, lower_ascii, text_hash
from eddyline.llm.registry import query, table
from eddyline.session import cut

WINDOW = 10
SHINGLE = 3
MAX_BROADCAST_BYTES = 8 << 20
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of A-Z-lower-cased text; none for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), "")


def spaced(words: Column, at: Column, n: Column) -> Column:
    """`n` words from 0-based `at`, joined by spaces; no word holds a space, so the string stands for the words."""
    return F.array_join(F.slice(words, at + 1, n), " ")


def token_at(words: Column, at: Column, size: int) -> Column:
    """A shingle's hash: only an index key and a rarity bucket, the words themselves are compared in the end. Words past the
    end are null and skipped, so a short window's only shingle hashes like one of its own size."""
    return F.xxhash64(*(F.get(words, at + k) for k in range(size)))


def windows_of(benchmark: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(item, window, n): a row for every window of every item."""
    items = benchmark.select(F.col(key).cast("string").alias("item"), words_of(F.col(text)).alias("words"))

    def cut_up(words: Column) -> Column:
        n = F.least(F.size(words), F.lit(size))
        return F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.struct(spaced(words, i, n).alias("window"), n.alias("n")))

    every = items.where(F.size("words") > 0).select("item", F.explode(let(F.col("words"), cut_up)).alias("w"))
    return every.select("item", "w.window", "w.n")


def tokens_of(windows: DataFrame, shingle: int) -> DataFrame:
    """(window, n, token, size, offset): the shingles of every window; shorter windows are one shingle."""

    def shingles(words: Column) -> Column:
        size = F.least(F.size(words), F.lit(shingle))
        return F.transform(
            F.sequence(F.lit(0), F.size(words) - size),
            lambda i: F.struct(token_at(words, i, shingle).alias("token"), size.alias("size"), i.alias("offset")),
        )

    each = windows.select("window", "n", F.explode(let(F.split("window", " "), shingles)).alias("t"))
    return each.select("window", "n", "t.token", "t.size", "t.offset")


def positions_of(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """`rows` (with `words`) for every position and shingle size in `sizes`: plus at, token."""

    def at_size(words: Column, size: int) -> Column:
        some = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: token_at(words, i, size))
        return F.when(F.size(words) >= size, some).otherwise(F.array().cast("array<bigint>"))

    def exploded(size: int) -> DataFrame:
        return rows.select(*rows.columns, F.posexplode(at_size(F.col("words"), size)).alias("at", "token"))

    every = exploded(sizes[0])
    for size in sizes[1:]:
        every = every.unionByName(exploded(size))
    return every


def occurrences(documents: DataFrame, windows: DataFrame, size: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(key, text_hash, start, n, window): every occurrence of every distinct window; `documents` has key, text_hash, text."""
    tokens = cut(tokens_of(windows.select("window", "n").distinct(), shingle), "tokens")
    distinct = tokens.select("token").distinct()
    sizes = sorted(r[0] for r in tokens.select("size").distinct().limit(shingle).collect()) or [shingle]
    rows = documents.select("key", "text_hash", words_of(F.col("text")).alias("words"))

    seen = positions_of(rows.select("words"), sizes).select("token")
    if fits(distinct, F.lit(64), MAX_BROADCAST_BYTES):
        counts = seen.join(F.broadcast(distinct), "token").groupBy("token").agg(F.count(F.lit(1)).alias("corpus"))
    else:
        counts = seen.groupBy("token").agg(F.count(F.lit(1)).alias("corpus")).join(distinct, "token")
    ranked = tokens.join(cut(counts, "rarity"), "token", "left")
    rarest = ranked.groupBy("window", "n").agg(F.min(F.struct(F.coalesce("corpus", F.lit(0)).alias("corpus"), F.col("token"), F.col("offset"))).alias("r"))
    prefixes = cut(rarest.where("r.corpus > 0").select("window", "n", "r.token", "r.offset"), "prefixes")

    reach = size - 1
    near = F.slice("words", F.greatest(F.col("at") - reach, F.lit(0)) + 1, 2 * reach + shingle).alias("near")
    every = positions_of(rows.withColumn("n_words", F.size("words")), sizes)
    columns = ["key", "text_hash", "n_words", "at", "token"]
    if fits(prefixes, F.octet_length("window") + 128, MAX_BROADCAST_BYTES):
        # generated positions are joined within one compiled stage: `words` is a reference, copied for matches only
        joined = every.join(F.broadcast(prefixes), "token").select(*columns, "window", "n", "offset", near)
    else:
        joined = every.select(*columns, near).join(prefixes, "token")
    start = F.col("at") - F.col("offset")
    bounded = joined.where((start >= 0) & (start + F.col("n") <= F.col("n_words"))).withColumn("start", start)
    from_near = F.col("start") - F.greatest(F.col("at") - reach, F.lit(0))
    return bounded.where(spaced(F.col("near"), from_near, F.col("n")) == F.col("window")).select("key", "text_hash", "start", "n", "window")


def covered(stretches: Column) -> Column:
    """Positions inside any of the (start, n) stretches."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))

    def step(acc: Column, s: Column) -> Column:
        end = s["start"] + s["n"]
        new = F.greatest(end - F.greatest(acc["end"], s["start"]), F.lit(0))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["hit"] + new).alias("hit"))

    return F.aggregate(F.array_sort(stretches), zero, step, lambda acc: acc["hit"])


def contamination(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", size: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """One row per row of `documents`: key, text_hash, n_words, n_hit, items (sorted strings).

    Null or empty texts have no words; items without words have no window; hits of items with a null id count in n_hit only. Rows
    that repeat get equal results. Keys may be null. An empty benchmark hits nothing. Other columns are not read.
    """
    keyed = documents.select(F.col(key).alias("key"), text_hash(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    windows = cut(windows_of(benchmark, item_key, item_text, size), "windows")
    found = cut(occurrences(keyed, windows, size, shingle), "occurrences")
    hits = found.groupBy("key", "text_hash").agg(covered(F.collect_set(F.struct("start", "n"))).alias("n_hit"))
    held = found.select("key", "text_hash", "window").distinct().join(windows.select("window", "item").distinct(), "window")
    items = held.groupBy("key", "text_hash").agg(F.sort_array(F.collect_set("item")).alias("items"))
    hits = join_null_safe(hits, items, ["key", "text_hash"], "left")
    rows = keyed.select("key", "text_hash", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    return join_null_safe(rows, hits, ["key", "text_hash"], "left").select(
        "key",
        "text_hash",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


WORDS_SQL = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""WITH d AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents),
  b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS_SQL} AS ws FROM benchmark),
  c AS (SELECT item, least(len(ws), {WINDOW}) AS n, ws FROM b WHERE len(ws) > 0),
  w AS (SELECT DISTINCT item, n, unnest(list_transform(range(len(ws) - n + 1), lambda i: array_to_string(ws[i + 1:i + n], ' '))) AS win FROM c),
  s AS (SELECT DISTINCT n FROM w),
  p AS (SELECT doc_id, n, unnest(list_transform(range(len(ws) - n + 1), lambda i: {{'pos': i, 'win': array_to_string(ws[i + 1:i + n], ' ')}})) AS x
    FROM d, s WHERE len(ws) >= n),
  f AS (SELECT doc_id, p.n, x.pos AS pos, item FROM p JOIN w ON x.win = w.win AND p.n = w.n),
  h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS pos FROM f) GROUP BY doc_id),
  i AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM f GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN i ON d.doc_id = i.doc_id"""


@query("op2_decontaminate", SQL)
def op2_decontaminate(spark, sf_dir):
    """All documents against all benchmark items; see `contamination`."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
