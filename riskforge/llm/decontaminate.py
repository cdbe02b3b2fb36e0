"""Benchmark decontamination by spaced seeds (SQL functions only).

A spaced seed is a fixed mask over a run of tokens; tokens under a 0 are
ignored, so a hit survives substitutions at those places (Ma, Tromp and Li,
"PatternHunter"). Every mask position of the benchmark and of the documents is
hashed, equal hashes are joined, and each alignment (document, item, offset)
that was hit is verified on the whole token lists: it counts if some window of
``WINDOW`` item tokens (the whole item where it is shorter) agrees in at least
``AGREE`` of its tokens.

No alignment that the rule accepts is missed: the masks for a window of n tokens
are chosen so that, whichever tokens of it are substituted (as many as ``AGREE``
lets), some mask lies inside the window on equal tokens only. ``MASKS`` has them
by n, found by search and checked by enumeration in the tests; items longer than
``WINDOW`` have the masks of a whole window at every position. Documents are
hashed with the masks of the lengths that the benchmark has, at most eight.

Tokens are runs of letters and digits (any character beyond ASCII included),
in lower case; in scripts written without spaces (``UNSPACED``) every character
is a token. Items of fewer than 5 tokens are too short to tell inside a longer
text; a document overlaps such an item if its tokens are those of the item.

The benchmark's seeds are broadcast when they are counted to be at most
``BROADCAST_SEEDS``; beyond that the join shuffles both sides by the hash.
Hits are reduced to distinct alignments before anything else is done.

Defined results: null and empty texts have no tokens and match nothing;
repeated rows match alike; an empty table on either side gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskforge.llm.common import fresh, materialize

SHORTEST = 5
WINDOW, AGREE = 16, 0.8
_PAIR = ("11101011", "11001000111")
MASKS = {5: ("111", "1101"), 6: ("1111", "11011"), **dict.fromkeys((7, 8, 9), ("11011",)),
         **dict.fromkeys((10, 11, 12), ("1111", "11101")), 13: (*_PAIR, "1100100111"), 14: _PAIR,
         15: (*_PAIR, "1100100111"), 16: _PAIR}    # by tokens of the window
BROADCAST_SEEDS = 2_000_000              # 24 bytes each
# Thai and Lao, Burmese, Khmer, kana, Han
UNSPACED = (r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}"
            r"\x{F900}-\x{FAFF}\x{20000}-\x{323AF}]")
_MAYBE = r"[\x{0E00}-\x{1FFF}\x{3040}-\x{10FFFF}]"     # all of these and others: two ranges are quicker to look for
SEPARATOR = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"


def token_ids(text: Column) -> Column:
    text = F.coalesce(text.cast("string"), F.lit(""))
    unspaced = (F.octet_length(text) > F.length(text)) & text.rlike(_MAYBE)
    # lower() once in either branch: the array functions around it are not compiled and share no subexpressions
    words = F.split(F.when(unspaced, F.regexp_replace(F.lower(text), f"({UNSPACED})", " $1 ")).otherwise(F.lower(text)), SEPARATOR)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _windows(ids: Column, number: int, mask: str) -> Column:
    """Hash of the unmasked tokens at every position."""
    at = [i for i, c in enumerate(mask) if c == "1"]
    last = F.size(ids) - len(mask)
    hashes = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                         lambda p: F.xxhash64(F.lit(number), *(F.get(ids, p + i) for i in at)))
    return F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


def seeds(ids: Column, masks: list[str]) -> Column:
    """Array of (k: mask number, p: position, h: hash). A list of fewer than ``SHORTEST`` tokens has
    its hash as a whole, under the number behind the masks'."""
    def named(number):
        return lambda h, p: F.struct(F.lit(number).alias("k"), p.alias("p"), h.alias("h"))
    k = len(masks)
    short = (F.size(ids) > 0) & (F.size(ids) < SHORTEST)
    whole = F.when(short, F.array(F.xxhash64(F.lit(-1), ids))).otherwise(F.array().cast("array<bigint>"))
    return F.concat(*(F.transform(_windows(ids, n, mask), named(n)) for n, mask in enumerate(masks)), F.transform(whole, named(k)))


def _once(value: Column) -> Column:
    """``value`` as the one element of an exploded array: Catalyst would otherwise
    put its expression into the lambdas that use it, to be computed for every element."""
    return F.explode(F.array(value))


def _same() -> Column:
    """1 for every item token that the document has at its place of the alignment."""
    return F.transform("item", lambda t, j: F.coalesce(F.get("ids", F.col("diag") + j) == t, F.lit(False)).cast("int"))


def _agreement() -> Column:
    """Most equal tokens in a window along the alignment."""
    return F.array_max(F.transform(F.sequence(F.lit(0), F.size("same") - F.col("n_window")), lambda s: F.aggregate(
        F.slice("same", s + 1, F.col("n_window")), F.lit(0), lambda a, x: a + x)))


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Document-item pairs that overlap: id, thash (hash of the text), item_id, n_equal (tokens
    equal in the best window), n_window."""
    items = materialize(benchmark.select(F.col(item_col).alias("item_id"), token_ids(F.col(item_text)).alias("item"))
                        .filter(F.size("item") > 0).withColumn("ino", F.monotonically_increasing_id()), "dec-items")
    windows = [r[0] for r in items.select(F.least(F.lit(WINDOW), F.size("item"))).distinct().collect()]
    masks = sorted({m for n in windows for m in MASKS.get(n, ())})
    served = F.array(*(F.array(*(F.lit(n) for n in MASKS if m in MASKS[n])) for m in masks), F.array(*map(F.lit, range(1, SHORTEST))))
    wanted = (items.select("ino", F.least(F.lit(WINDOW), F.size("item")).alias("n"), F.explode(seeds(F.col("item"), masks)).alias("s"))
              # a mask serves the items of its lengths only
              .filter(F.array_contains(F.element_at(served, F.col("s.k") + 1), F.col("n")))
              .select("ino", F.col("s.p").alias("ip"), F.col("s.h").alias("h")))
    wanted = materialize(wanted, "dec-seeds")
    if wanted.count() <= BROADCAST_SEEDS:
        wanted = F.broadcast(wanted)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("thash"), token_ids(F.col(text_col)).alias("ids"))
    probe = rows.select("id", "thash", F.explode(seeds(F.col("ids"), masks)).alias("s")).select(
        "id", "thash", F.col("s.p").alias("p"), F.col("s.h").alias("h"))
    hits = materialize(probe.join(wanted, "h").select("id", "thash", "ino", (F.col("p") - F.col("ip")).alias("diag")).distinct(), "dec-hits")
    texts = docs.select(F.col(id_col).alias("i2"), F.xxhash64(text_col).alias("t2"), F.col(text_col).alias("x"))
    found = (hits.join(items, "ino")
             .join(texts, F.col("id").eqNullSafe(F.col("i2")) & (F.col("thash") == F.col("t2")))
             .select("id", "thash", "item_id", "item", "diag", _once(token_ids(F.col("x"))).alias("ids"))
             .select("id", "thash", "item_id", F.least(F.lit(WINDOW), F.size("item")).alias("n_window"), _once(_same()).alias("same"))
             .withColumn("n_equal", _agreement()).filter(F.col("n_equal") >= F.col("n_window") * AGREE))
    return found.groupBy("id", "thash", "item_id").agg(F.max("n_equal").alias("n_equal"), F.max("n_window").alias("n_window"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item."""
    i, t = fresh(docs, "hit_id"), fresh(docs, "hit_text")
    bad = materialize(overlaps(docs, benchmark, id_col, text_col, **kw).select(
        F.col("id").alias(i), F.col("thash").alias(t)).distinct(), "dec-bad")
    return docs.join(bad, docs[id_col].eqNullSafe(F.col(i)) & (F.xxhash64(docs[text_col]) == F.col(t)), "left_anti")


def _oracle() -> str:
    split = ("list_filter(regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '(" + UNSPACED + r")', ' \1 ', 'g'), '"
             + SEPARATOR + "'), lambda x: x <> '')")
    return rf"""
with tok as (select doc_id, {split} ids from documents),
item as (select item_id, {split} item from benchmark),
dt as (select doc_id, unnest(ids) t, unnest(range(len(ids))) p from tok),
it as (select item_id, len(item) n, unnest(item) t, unnest(range(len(item))) j from item where len(item) >= {SHORTEST}),
al as (select doc_id, item_id, p - j diag from dt join it using (t) group by doc_id, item_id, p - j, n
    having count(*) >= least({WINDOW}, n) * {AGREE}),
best as (select a.doc_id, a.item_id, least({WINDOW}, len(i.item)) n_window,
    list_max(list_transform(range(0, len(i.item) - least({WINDOW}, len(i.item)) + 1), lambda s: list_sum(list_transform(
        range(s + 1, s + 1 + least({WINDOW}, len(i.item))), lambda j: case when a.diag + j >= 1 and t.ids[a.diag + j] = i.item[j] then 1 else 0 end)))) n_equal
    from al a join tok t using (doc_id) join item i using (item_id)
    union all select t.doc_id, i.item_id, len(i.item), len(i.item) from tok t join item i on t.ids = i.item
    where len(i.item) between 1 and {SHORTEST - 1})
select doc_id, item_id, cast(max(n_equal) as int) n_equal, cast(max(n_window) as int) n_window from best
where n_equal >= n_window * {AGREE} group by all
"""


#: DuckDB: every alignment with enough equal tokens, no masks.
ORACLE = _oracle()
