"""Mixing sources to target weights by capped water-filling.

Sources in code-point order (null last) get weights 5, 2, 1, repeating, and
share 100 % of all words. A target stops at ``max_epochs`` times its source's
size; the excess is shared again among the others by weight until none is
above. The final level is found from running sums in the order in which
sources reach their cap, one row per source, exactly in integers.

A source with target / size = w + f repeats every document w times and takes
some once more, for the words that are left: in ``PASSES`` passes over the
documents in the order of a seeded hash, each takes those that are no larger than
what is left, up to the first that does not fit. The next pass goes on behind it,
so one very long document does not end the source far from its target. The end of
a pass is one key per source, found from sums of 4,096 hash ranges and an
ordering inside the one range that holds it, so a source with a third of all rows
is never gathered, and the documents are then only compared with the keys.

Defined results: a null text has size 0; documents of size 0 are taken 0
times; a null source is a source; rows with the same id, source and size are
taken alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskforge.llm.common import fresh, materialize, text_or_empty

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
RANGE_DIGITS = 3     # 16**3 hash ranges a source
PASSES = 5           # passes that fill up what is left of a target


def n_words(col: str = "text") -> Column:
    return F.regexp_count(text_or_empty(col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def seeded(id_col: str, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))


def water_fill(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same with ``target``. One row per source."""
    big = "decimal(38,0)"
    ranked = sizes.withColumn("r", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("r") % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * max_epochs)
    # reaching the cap: cap / w ascending, compared without division
    full = Window.orderBy(F.col("cap") / F.col("w"), "r").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy()
    ranked = (ranked.withColumn("left", F.sum("source_size").over(every) - F.sum("cap").over(full) + F.col("cap"))
              .withColumn("ws", F.sum("w").over(every) - F.sum("w").over(full) + F.col("w"))
              .withColumn("over", F.col("cap").cast(big) * F.col("ws") > F.col("left").cast(big) * F.col("w")))
    level = ranked.withColumn("first", F.min(F.when(F.col("over"), F.struct(F.col("cap") / F.col("w"), "r", "left", "ws"))).over(every))
    share = F.col("first.left").cast("double") * F.col("w").cast("double") / F.col("first.ws").cast("double")
    cap = F.col("cap").cast("double")
    return level.select("source", "source_size", F.coalesce(F.least(cap, share), cap).alias("target"))


def _fill(base: DataFrame, state: DataFrame) -> DataFrame:
    """One pass: (s2, cut, got), the key up to which the documents of a source that are no larger than ``room`` and
    stand behind ``after`` are taken, and their words."""
    prefix = F.substring("h", 1, RANGE_DIGITS)
    fits = (F.col("size") > 0) & (F.col("size") <= F.col("room")) & (F.col("after").isNull() | (F.struct("h", "size") > F.col("after")))
    rows = base.join(state.select("s2", "room", "after"), F.col("source").eqNullSafe(F.col("s2"))).filter(fits)
    ranges = rows.groupBy("s2", prefix.alias("b")).agg(F.sum("size").alias("s"), F.max("room").alias("room"))
    ranges = ranges.withColumn("fin", F.sum("s").over(Window.partitionBy("s2").orderBy("b")))      # at most 4,096 rows a source
    ends = ranges.groupBy("s2").agg(F.min(F.when(F.col("fin") > F.col("room"), F.col("b"))).alias("b"),
                                    F.coalesce(F.max(F.when(F.col("fin") <= F.col("room"), F.col("fin"))), F.lit(0)).alias("before"))
    ends = materialize(ends, "mix-ends")
    here = ends.select(F.col("s2").alias("s3"), F.col("b").alias("b3"), "before")
    inside = rows.join(here, F.col("s2").eqNullSafe(F.col("s3")) & (prefix == F.col("b3")))
    inside = inside.withColumn("fin", F.col("before") + F.sum("size").over(Window.partitionBy("s2").orderBy("h", "size")))
    last = (inside.filter(F.col("fin") <= F.col("room")).groupBy(F.col("s2").alias("s3"))
            .agg(F.max(F.struct("h", "size")).alias("last"), F.max("fin").alias("got")))
    edge = F.struct(F.coalesce("b", F.lit("g")).alias("h"), F.lit(0).cast("long").alias("size"))   # "g": behind every hash
    return ends.join(last, F.col("s2").eqNullSafe(F.col("s3")), "left").select(
        "s2", F.coalesce("last", edge).alias("cut"), F.coalesce("got", "before").alias("got"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
         weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Per source: source, source_size, target, whole (repetitions of every
    document) and cuts: by pass, the size and the key up to which documents are
    taken once more."""
    base = materialize(docs.select(F.col(source_col).alias("source"), n_words(text_col).alias("size"),
                                   seeded(id_col, seed).alias("h")), "mix-sizes")
    targets = water_fill(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    targets = materialize(
        targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    state = targets.select(F.col("source").alias("s2"), F.col("part").alias("room"),
                           F.lit(None).cast("struct<h:string,size:bigint>").alias("after"),
                           F.array().cast("array<struct<room:double,cut:struct<h:string,size:bigint>>>").alias("cuts"))
    for _ in range(PASSES):
        done = _fill(base, state).select(F.col("s2").alias("s4"), "cut", "got")
        state = state.join(done, F.col("s2").eqNullSafe(F.col("s4")), "left").select(
            "s2", (F.col("room") - F.coalesce("got", F.lit(0))).alias("room"), F.coalesce("cut", "after").alias("after"),
            F.when(F.col("cut").isNull(), F.col("cuts")).otherwise(F.concat("cuts", F.array(F.struct("room", "cut")))).alias("cuts"))
        state = materialize(state, "mix-state")
        if state.filter("room >= 1").isEmpty():
            break
    state = state.select("s2", "cuts")
    return targets.join(state, F.col("source").eqNullSafe(F.col("s2"))).select("source", "source_size", "target", "whole", "cuts")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
        seed: str = SEED, names: dict[str, str] | None = None, **kw) -> DataFrame:
    """``docs`` with size, source_size, target, taken (words) and times (repetitions),
    under other names if ``names`` says so."""
    per = plan(docs, id_col, text_col, source_col, seed=seed, **kw)
    per = materialize(per, "mix-plan").select(F.col("source").alias(src := fresh(docs, "mixsource")),
                                              F.struct("source_size", "target", "whole", "cuts").alias(p := fresh(docs, "mixplan")))
    size, own = fresh(docs, "mixsize"), fresh(docs, "mixkey")
    rows = docs.withColumn(size, n_words(text_col)).withColumn(own, F.struct(seeded(id_col, seed).alias("h"), F.col(size).alias("size")))
    rows = rows.join(per, F.col(source_col).eqNullSafe(F.col(src)))
    more = F.exists(f"{p}.cuts", lambda c: (F.col(size) <= c["room"]) & (F.col(own) <= c["cut"])).cast("long")
    times = F.when(F.col(size) > 0, F.col(f"{p}.whole") + more).otherwise(0).cast("long")
    made = {"size": F.col(size), "source_size": F.col(f"{p}.source_size"), "target": F.col(f"{p}.target"),
            "taken": times * F.col(size), "times": times}
    names = names or {c: c for c in made if c not in docs.columns}
    return rows.select(*docs.columns, *(made[c].alias(n) for c, n in names.items()))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it."""
    n = fresh(docs, "times")
    rows = mix(docs, id_col, text_col, source_col, names={"times": n}, **kw).filter(F.col(n) > 0)
    return rows.withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).select(*docs.columns)


def _oracle() -> str:
    first, second = ("""
with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) size,
    md5('mix-1:' || coalesce(cast(doc_id as varchar), 'null')) h from documents),
s as (select source, cast(sum(size) as bigint) source_size from d group by source),
r as (select *, [5, 2, 1][((row_number() over (order by source asc nulls last) - 1) % 3) + 1] w,
    row_number() over (order by source asc nulls last) - 1 r from s),
c as (select *, 3 * source_size cap, sum(source_size) over () - sum(3 * source_size) over f + 3 * source_size lft,
    sum(w) over () - sum(w) over f + w ws from r
    window f as (order by 3 * source_size / w, r rows between unbounded preceding and current row)),
l as (select lft, ws from c where cap::hugeint * ws > lft::hugeint * w order by cap / w, r limit 1),
t as (select source, source_size, coalesce(least(cap::double, l.lft::double * w::double / l.ws::double), cap::double) target
    from c left join l on true),
q as (select *, case when source_size > 0 then floor(target / source_size) else 0 end whole,
    target - case when source_size > 0 then floor(target / source_size) else 0 end * source_size part from t),
m0 as (select d.*, q.source_size, q.target, q.whole, q.part room, 0 more from d join q on d.source is not distinct from q.source)
""", f"""
select doc_id, size, source_size, target, cast((case when size > 0 then whole else 0 end + more) * size as bigint) taken from m{PASSES}
""")
    fits = "more = 0 and size > 0 and size <= room"
    passes = "".join(f""",
a{i} as (select *, case when {fits} then sum(case when {fits} then size end) over (partition by source order by h, size) end fin from m{i}),
m{i + 1} as (select doc_id, source, size, h, source_size, target, whole,
    room - coalesce(sum(case when fin <= room then size end) over (partition by source), 0) room,
    case when fin <= room then 1 else more end more from a{i})""" for i in range(PASSES))
    return first + passes + second


#: DuckDB: the same plan from whole-table windows.
ORACLE = _oracle()
