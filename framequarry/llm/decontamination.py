"""Benchmark decontamination (8): a prefix-filtered set join of item windows against whole documents, all DataFrame operations.

Words are maximal runs of letters, digits and non-ASCII characters with A-Z lower-cased. An item's windows are its
``window`` consecutive words, or all its words where it has fewer. A window is the set of its word shingles (``shingle``
words, or the whole window where that is shorter), and must be contained whole, so one shingle of it is a sufficient
prefix: the rarest one in the corpus.

1. Rarity: the shingles of all windows are counted over all documents (partial counts on the map side).
2. Prefix join: document positions are joined with each window's rarest shingle. The windows are broadcast only while
   their bytes, counted from above, stay below ``broadcast_bytes``; beyond, the same join is left to a shuffle, with the
   words around a position carried along.
3. Length and position bounds: the window has to start and end inside the document.
4. Verification: the document's words at that place equal the window's words.
5. Hits are united to covered words for each document, in the same aggregation that gathers its items.

Every document also sends one marker row through the join, so documents without hits come back without another join.
Rows are grouped by id and text hash, and repeated rows come back as often as they went in.

Defined results: null or empty text has no words and no hits; items without words never hit; an empty benchmark leaves
every document clean; an empty document table gives an empty result; texts of any length are read whole; shingles of a
window that are equally rare are told apart by their place, the first one is taken; a null id is a group of its own. Columns other than ids and texts are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm.common import table

#: Characters between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: About 200,000 windows of common words.
BROADCAST_BYTES = 64 << 20


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), "")


def shingle_hash(words: str, at: str, k: int) -> str:
    """SQL of the hash of k words from position ``at`` (from 0)."""
    return f"xxhash64({k}, " + ", ".join(f"get({words}, {at} + {j})" for j in range(k)) + ")"


def item_windows(items: DataFrame, item_id: str, text: str, window: int, shingle: int) -> DataFrame:
    """Distinct windows: win (words), len, k, and the ids (as text) of the items that hold them."""
    words = items.select(F.col(item_id).cast("string").alias("item"), word_array(F.col(text)).alias("w")).where("size(w) > 0")
    at = words.select("item", "w", F.expr(f"explode(sequence(0, greatest(size(w) - {window}, 0)))").alias("s"))
    wins = at.select("item", F.expr(f"slice(w, s + 1, least({window}, size(w)))").alias("win"))
    return wins.groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("items")).select("win", F.expr("size(win)").alias("len"), F.expr(f"least({shingle}, size(win))").alias("k"), "items")


def find_windows(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, shingle: int = 3, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per document row: doc_id, text_hash, n_words, n_hit (words covered), hit_items (sorted array of item ids as text)."""
    wins = item_windows(items, item_id, item_text, window, shingle).withColumn("win_id", F.xxhash64("win"))
    # A string in an array takes at most 16 bytes more than its own; 64 bytes are for the rest of a row.
    held = lambda a: F.octet_length(F.array_join(a, "")) + 16 * F.size(a)
    size, ks = wins.agg(F.sum(held("win") + held("items") + 64), F.sort_array(F.collect_set("k"))).first()
    small = (size or 0) <= broadcast_bytes
    near = F.broadcast if small else lambda df: df
    ks = list(ks or [])

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    base = source.select("doc_id", F.xxhash64("text").alias("text_hash"), word_array(F.col("text")).alias("w"))

    # Each shingle hash starts from its length, so one column holds those of all lengths and every document is read in
    # one pass for the counts and one for the join, whatever the lengths of the items.
    of_window = "case " + " ".join(f"when k = {k} then {shingle_hash('win', 'o', k)}" for k in ks) + " end"
    of_position = [f"case when p + {k} <= size(w) then {shingle_hash('w', 'p', k)} end" for k in ks]

    def positions(*columns: str) -> DataFrame:
        at = base.where(f"size(w) >= {ks[0]}").select("doc_id", "text_hash", "w", F.expr(f"explode(sequence(0, size(w) - {ks[0]}))").alias("p"))
        h = of_position[0] if len(ks) == 1 else f"explode(array_compact(array({', '.join(of_position)})))"
        return at.selectExpr(*columns, f"{h} as h")

    found = base.select("doc_id", "text_hash", F.expr("size(w)").alias("n_words"), F.lit(1).alias("row"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("len"), F.lit(None).cast("array<string>").alias("items"))
    if ks:
        # Every shingle of every window, with its place, and how often the documents have it.
        places = wins.select("win_id", "win", "k", F.expr("explode(sequence(0, len - k))").alias("o")).selectExpr("win_id", "o", f"{of_window} as h")
        df = positions().join(near(places.select("h").distinct()), "h").groupBy("h").agg(F.count("*").alias("df"))
        rarest = places.join(df, "h", "left").groupBy("win_id").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), F.col("o"), F.col("h"))).alias("m"))
        # A window with a shingle that no document has can't occur.
        prefix = rarest.where("m.df > 0").selectExpr("win_id", "m.h as h", "m.o as o").join(wins.select("win_id", "win", "len", "items"), "win_id").drop("win_id")
        if small:
            hit = positions("doc_id", "text_hash", "w", "p").join(F.broadcast(prefix), "h")
            hit = hit.where("p >= o and p - o + len <= size(w)").where("slice(w, p - o + 1, len) = win")
        else:
            start = f"greatest(p - {window}, 0)"
            lean = positions("doc_id", "text_hash", "p", "size(w) as n", f"{start} as from", f"slice(w, {start} + 1, {2 * window}) as near")
            hit = lean.join(prefix, "h").where("p >= o and p - o + len <= n").where("slice(near, p - o - from + 1, len) = win")
        found = found.unionByName(hit.select("doc_id", "text_hash", F.lit(0).alias("n_words"), F.lit(0).alias("row"), F.expr("p - o").alias("start"), "len", "items"))

    rows = found.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.sum("row").alias("copies"),
        F.expr("sort_array(collect_set(case when start is not null then struct(start, len) end))").alias("spans"), F.collect_set("items").alias("sets"),
    )
    # Covered words: each span adds what lies beyond the furthest end so far.
    covered = "aggregate(spans, struct(0 as e, 0 as n), (a, s) -> struct(greatest(a.e, s.start + s.len) as e, a.n + greatest(0, s.start + s.len - greatest(a.e, s.start)) as n), a -> a.n)"
    return rows.select("doc_id", "text_hash", "n_words", F.expr(covered).alias("n_hit"), F.expr("array_sort(array_distinct(flatten(sets)))").alias("hit_items"), F.expr("explode(sequence(1L, copies))").alias("copy")).drop("copy")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_windows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


#: The same by plain equality of all windows, for DuckDB.
ORACLE = r"""
with w as (select doc_id, row_number() over () as r, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
i as (select cast(item_id as varchar) as item, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
s as (select item, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) as s from i where len(w) > 0),
win as (select distinct item, list_slice(w, s + 1, s + least(10, len(w))) as win, least(10, len(w)) as n from s),
k as (select distinct n from win),
p as (select r, n, w, unnest(range(0, len(w) - n + 1)) as p from w join k on len(w) >= n),
hit as (select r, p, p.n, item from p join win on p.n = win.n and list_slice(w, p + 1, p + p.n) = win.win),
cov as (select r, count(distinct c) as n_hit from (select r, unnest(range(p, p + n)) as c from hit) group by r),
names as (select r, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct r, item from hit) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join cov using (r) left join names using (r)
"""
