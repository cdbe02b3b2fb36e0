"""Fixity audit of WARC records with Merkle trees.

A replica is a table of WARC records (page, URL, record bytes). Records are
kept by segment (leading hex digits of the MD5 of their name, so many that a
segment has about ``SEGMENT`` records) and in a segment by name; lengths give
every record an offset. A leaf hashes a record's name, offset, length, number
of copies and SHA-256; a node hashes the nodes of an ordered range of ``FAN``
records or nodes below; above the segments the hex digits are the branches.

Two replicas are compared from the root: only children of nodes that differ
are looked at, level by level, until the differing ranges of records are
reached, and only there records are compared by name.

Content is hashed where it lies; shuffles carry names and digests. A node's
children (at most ``FAN``) are the largest group ever gathered, apart from the
running offset of a segment, which is a window over its narrow rows.

Defined results: null html, url or id read as empty, empty and ``null``;
repeated rows are one record with a number of copies; equal names with
different content are separate records; a replica without records has an empty
tree, and every record of the other one is missing or extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskforge.llm.common import materialize

FAN = 16
SEGMENT = 512
CRLF = "\r\n"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a page's WARC record, as a string."""
    html = F.coalesce(html.cast("string"), F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: resource{CRLF}WARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")),
        F.lit(f">{CRLF}WARC-Target-URI: "), F.coalesce(url.cast("string"), F.lit("")),
        F.lit(f"{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(html).cast("string"),
        F.lit(CRLF * 2), html, F.lit(CRLF * 2))


def replica(pages: DataFrame) -> DataFrame:
    """page_id, url, record (bytes) of every page."""
    return pages.select("page_id", "url", record(F.col("page_id"), F.col("url"), F.col("html")).cast("binary").alias("record"))


def manifest(records: DataFrame) -> DataFrame:
    """name, page_id, url, sha256, length, copies: one row per distinct record, without content."""
    name = F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.coalesce("url", F.lit("")))
                 .cast("binary"))
    return (records.select(name.alias("name"), "page_id", "url", F.sha2("record", 256).alias("sha256"),
                           F.octet_length("record").cast("long").alias("length"))
            .groupBy("name", "page_id", "url", "sha256", "length").agg(F.count("*").alias("copies")))


def digits(n: int) -> int:
    """Hex digits that make segments of about SEGMENT records."""
    d = 0
    while n > SEGMENT * 16 ** d:
        d += 1
    return d


class Tree:
    """Leaves (one row per record) and the levels above, lowest first: (segment, node, hash)."""

    def __init__(self, records: DataFrame, name: str, d: int | None = None):
        rows = materialize(manifest(records), f"warc-{name}-manifest")
        self.d = digits(rows.count()) if d is None else d
        order = Window.partitionBy("segment").orderBy("name", "sha256", "length")
        whole = F.col("length") * F.col("copies")
        rows = (rows.withColumn("segment", F.substring("name", 1, self.d))
                .withColumn("node", (F.row_number().over(order) - 1).cast("long"))
                .withColumn("offset", F.sum(whole).over(order.rowsBetween(Window.unboundedPreceding, 0)) - whole))
        self.leaves = materialize(rows.withColumn("hash", F.sha2(F.concat_ws(
            ":", "name", F.col("offset").cast("string"), F.col("length").cast("string"), F.col("copies").cast("string"), "sha256"), 256)),
            f"warc-{name}-leaves")
        self.levels = [self.leaves.select("segment", "node", "hash")]
        most = self.leaves.agg(F.max("node").alias("n")).first()["n"]
        while most:
            most //= FAN
            self._up(name, F.col("segment"), F.floor(F.col("node") / FAN).cast("long"), F.col("node"))
        for i in range(self.d):
            up = F.substring("segment", 1, self.d - 1 - i)
            self._up(name, up, F.lit(0).cast("long"), F.col("segment"))

    def _up(self, name: str, segment: Column, node: Column, order: Column) -> None:
        below = self.levels[-1].select(segment.alias("s"), node.alias("n"), order.alias("o"), "hash")
        kids = F.array_sort(F.collect_list(F.struct("o", "hash")))
        self.levels.append(materialize(below.groupBy(F.col("s").alias("segment"), F.col("n").alias("node")).agg(
            F.sha2(F.concat_ws("", F.transform(kids, lambda k: k["hash"])), 256).alias("hash")), f"warc-{name}-level"))

    def parent(self, level: int) -> tuple[Column, Column]:
        """Where a node of ``level`` hangs, one level above."""
        if level < len(self.levels) - 1 - self.d:
            return F.col("segment"), F.floor(F.col("node") / FAN).cast("long")
        return F.substring("segment", 1, self.d - 1 - (level - (len(self.levels) - 1 - self.d))), F.lit(0).cast("long")


def _differ(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes whose hash is not the same on both sides."""
    b = b.withColumnRenamed("hash", "hash_b")
    return a.join(b, ["segment", "node"], "full").filter(~F.col("hash").eqNullSafe(F.col("hash_b"))).select("segment", "node")


def audit(one: DataFrame, two: DataFrame) -> DataFrame:
    """One row per record: page_id, url, segment, offset, length, sha256 (of replica one, or of two
    where one lacks it) and status: ok, changed, moved (intact at another offset), missing, extra."""
    a = Tree(one, "a")
    b = Tree(two, "b", a.d)
    leaf = a.leaves.select("page_id", "url", "segment", "offset", "length", "sha256", "copies", "name", "node")
    while len(a.levels) != len(b.levels):                 # a segment grew past a power of FAN: give the flatter tree its levels
        t, n = (a, "a") if len(a.levels) < len(b.levels) else (b, "b")
        t.levels.insert(len(t.levels) - t.d, t.levels[len(t.levels) - 1 - t.d])
    wrong = materialize(_differ(a.levels[-1], b.levels[-1]), "warc-differ")
    for level in range(len(a.levels) - 2, -1, -1):
        if wrong.isEmpty():
            return leaf.withColumn("status", F.lit("ok")).drop("name", "node", "copies")
        seg, node = a.parent(level)
        up = wrong.select(F.col("segment").alias("us"), F.col("node").alias("un"))
        below = [t.levels[level].join(up, (seg == F.col("us")) & (node == F.col("un")), "left_semi") for t in (a, b)]
        wrong = materialize(_differ(*below), "warc-differ")
    def inside(t):
        return t.leaves.join(wrong, ["segment", "node"], "left_semi")
    return _records(leaf, inside(a), inside(b), wrong)


def _records(leaf: DataFrame, a: DataFrame, b: DataFrame, wrong: DataFrame) -> DataFrame:
    fine = leaf.join(wrong, ["segment", "node"], "left_anti").withColumn("status", F.lit("ok"))
    cols = ["page_id", "url", "segment", "offset", "length", "sha256"]
    same = Window.partitionBy("name").orderBy("sha256", "length")
    # equal content first; what is left under a name is paired in order
    twin = (a.select("name", "sha256", "length", "copies", F.col("offset").alias("oa"))
            .join(b.select("name", "sha256", "length", "copies", F.col("offset").alias("ob")), ["name", "sha256", "length", "copies"]))
    moved = a.join(twin.select("name", "sha256", "length", "copies", "oa", "ob"), ["name", "sha256", "length", "copies"]).select(
        *cols, F.when(F.col("oa") == F.col("ob"), "ok").otherwise("moved").alias("status"))
    keys = ["name", "sha256", "length", "copies"]
    rest_a = a.join(twin.select(*keys), keys, "left_anti").withColumn("i", F.row_number().over(same))
    rest_b = b.join(twin.select(*keys), keys, "left_anti").withColumn("i", F.row_number().over(same))
    ra = rest_a.select("name", "i", F.struct(*cols).alias("a"))
    rb = rest_b.select("name", "i", F.struct(*cols).alias("b"))
    bad = ra.join(rb, ["name", "i"], "full").select(
        F.coalesce("a", "b").alias("r"),
        F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed").alias("status")).select("r.*", "status")
    return fine.select(*cols, "status").unionByName(moved).unionByName(bad)


def damaged(pages: DataFrame) -> DataFrame:
    """Pages as a bad copy would hold them, by a rule on the id: 1 in 256 each has its first
    character overwritten, lacks its last seven characters, or is lost."""
    x = F.substring(F.md5(F.concat(F.lit("fault:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))).cast("binary")), 1, 2)
    html = F.coalesce("html", F.lit(""))
    return pages.filter(x != "02").withColumn("html", F.when(x == "00", F.concat(F.lit("#"), F.substr(html, F.lit(2))))
                                              .when(x == "01", F.substr(html, F.lit(1), F.greatest(F.length(html) - 7, F.lit(0))))
                                              .otherwise(html))


#: DuckDB: both manifests, compared record by record.
ORACLE = r"""
with n as (select count(*) n from (select distinct page_id, url, html from pages)),
p as (select page_id, url, coalesce(html, '') html, md5(coalesce(cast(page_id as varchar), 'null') || '|' || coalesce(url, '')) name,
    substr(md5('fault:' || coalesce(cast(page_id as varchar), 'null')), 1, 2) x from pages),
c as (select 'a' side, page_id, url, name, html from p union all
    select 'b', page_id, url, name, case x when '00' then '#' || substr(html, 2) when '01' then substr(html, 1, greatest(length(html) - 7, 0)) else html end
    from p where x <> '02'),
r as (select side, page_id, url, name, concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Record-ID: <urn:page:',
    coalesce(cast(page_id as varchar), 'null'), '>', chr(13), chr(10), 'WARC-Target-URI: ', coalesce(url, ''), chr(13), chr(10),
    'Content-Type: text/html; charset=utf-8', chr(13), chr(10), 'Content-Length: ', cast(strlen(html) as varchar), chr(13), chr(10), chr(13), chr(10),
    html, chr(13), chr(10), chr(13), chr(10)) rec from c),
m as (select side, page_id, url, name, sha256(rec) sha256, cast(strlen(rec) as bigint) length, count(*) copies from r group by all),
s as (select *, substr(name, 1, case when n <= 512 then 0 when n <= 8192 then 1 when n <= 131072 then 2 when n <= 2097152 then 3 else 4 end) segment from m, n),
o as (select *, cast(sum(length * copies) over (partition by side, segment order by name, sha256, length rows unbounded preceding) - length * copies as bigint) "offset" from s)
select a.page_id, a.url, a.segment, a."offset", a.length, a.sha256,
    case when b.name is null then 'missing' when a.sha256 <> b.sha256 then 'changed' when a."offset" <> b."offset" then 'moved' else 'ok' end status
from (select * from o where side = 'a') a left join (select * from o where side = 'b') b on a.name = b.name
"""
