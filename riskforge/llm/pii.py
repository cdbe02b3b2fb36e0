"""Personal data by base patterns and bootstrapped contexts.

Base: e-mail addresses, IPv4 addresses, payment cards (16 to 19 digits passing
Luhn) and international phone numbers, leftmost non-overlapping per kind; a
match that fails its check is dropped and not retried.

Contexts: every looser identifier (other address forms, IPv6, phone numbers written
otherwise, card numbers that a base match had swallowed) that overlaps no base
span is a candidate, and so is what has none of these forms but could be an
identifier: runs of digit groups with any separators that hold as many digits as
a phone number (6 to 15) or a card (12 to 19, Luhn), tokens with a sign @, text that
reads as an IPv4 or IPv6 address (``generic``). The words around base entities and
candidates, and their shapes, give lexical patterns, so trusted contexts and shapes
find values that no regex describes. Patterns and
instances (values) form a bipartite graph that Spark scores in rounds until no
further value is trusted: a
pattern's score for a kind is the share of trusted values among its distinct
values, if at least ``SUPPORT`` are trusted; a value's score is the noisy-or of
its patterns; base values are trusted from the start, others from ``TRUST`` on.
Candidates whose value ends up trusted are added to the spans. A run of several
digit groups is a candidate whole, and with every beginning and every end of it that
has as many digits; of those that overlap the best score is added, then the longest.
In a pattern's score such a run counts once as long as it is not trusted.

Texts are scanned once, where they lie. The graph has rows for mentions only;
its sums are partial aggregates, so a pattern that holds a third of all
mentions is not gathered anywhere.

Spans are (kind, start, end) in code points, end exclusive, kinds 0 e-mail,
1 IP, 2 card, 3 phone.

Defined results: a null text is empty and has no spans; repeated rows are
scanned each, their values count once; an empty table gives no rows.
"""

from __future__ import annotations

import ipaddress
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskforge.llm.common import materialize, text_or_empty

KINDS = ("email", "ip", "card", "phone")
SUPPORT, TRUST = 3, 0.6
REACH = 96           # code points of context looked at on either side

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# the base patterns; possessive repeats where a greedy one never gives back
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# looser forms
_LOOSE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}(?:\s?[\[(]at[\])]\s?|@)[A-Za-z0-9-]{2,63}(?:(?:\.|\s?[\[(]dot[\])]\s?)[A-Za-z0-9-]{2,63})*", re.I)
_LOOSE_IP = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_LOOSE_CARD = re.compile(r"(?<![0-9])(?:[0-9]{16,19}|[0-9]{4}(?:[\x20.-][0-9]{4}){3})(?![0-9])")
_LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z])(?:\+?[0-9]{1,3}[\x20.-]?)?\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")

# generic forms: digit groups, tokens with a sign @, addresses; linear in the text
_GROUPS = r"\+?\(?[0-9]++(?:[-./()\u2010-\u2015]{1,3}+\+?[0-9]++)*+\)?"
_RUN = re.compile(rf"(?<![\w@]){_GROUPS}(?:[\x20\t\xa0]{_GROUPS})*+")
_AT = re.compile(r"(?<!\S)[^\s@]*+@\S*+")
_IP6 = re.compile(r"(?:(?<![\w:.])|(?<=[^\W\d_]:))(?=[0-9A-Fa-f]{0,4}:)[0-9A-Fa-f:.]{2,45}+(?![\w:])")
_IP4 = re.compile(r"(?<![\w.])(?:[0-9]{1,3}[\[({]?(?:\.|dot)[\])}]?){3}[0-9]{1,3}(?![\w.])", re.I)
PHONE_DIGITS, CARD_DIGITS = range(6, 16), range(12, 20)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str):
    """[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+ from its @ signs, in linear time."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    found = [(0, a, z) for a, z in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Looser identifiers that overlap no base span."""
    found = []
    low = "@" in text or "at)" in text or "at]" in text
    if low:
        found += [(0, m.start(), m.end()) for m in _LOOSE_EMAIL.finditer(text)]
    if ":" in text:
        found += [(1, m.start(), m.end()) for m in _LOOSE_IP.finditer(text)]
    cards = [(2, m.start(), m.end()) for m in _LOOSE_CARD.finditer(text) if luhn(re.sub("[^0-9]", "", m[0]))]
    found += cards
    found += [(3, m.start(), m.end()) for m in _LOOSE_PHONE.finditer(text)
              if all(m.end() <= a or z <= m.start() for _, a, z in cards)]
    free = _free(base)
    return [c for c in found if free(c[1], c[2])]


def _free(spans: list[tuple[int, int, int]]):
    """Whether a stretch overlaps none of the spans."""
    taken = sorted((a, z) for _, a, z in spans)
    if not taken:
        return lambda a, z: True
    starts, ends = [a for a, _ in taken], np.maximum.accumulate([z for _, z in taken])
    return lambda a, z: not (k := int(np.searchsorted(starts, z))) or ends[k - 1] <= a


def _is_address(value: str) -> bool:
    try:
        return bool(ipaddress.ip_address(value))
    except ValueError:
        return False


def generic(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, bool]]:
    """(kind, start, end, run, main) of what could be an identifier whatever its form, beside the
    spans ``taken``. Spans of different runs do not overlap; one span of a run is its main one."""
    found, free = [], _free(taken)
    if "@" in text:
        for m in _AT.finditer(text):
            core = m[0].rstrip(">)]}\"'.,;:!?")
            at = core.find("@")
            a = max(core.rfind(c, 0, max(at, 0)) for c in "<([{\"':=,;") + 1
            if a < at < len(core) - 1 and free(m.start() + a, m.start() + len(core)):
                found.append((0, m.start() + a, m.start() + len(core)))
    if ":" in text:
        for m in _IP6.finditer(text):
            value = m[0].rstrip(".")
            value = value[:-1] if value.endswith(":") and not value.endswith("::") else value
            if value.count(":") > 1 and _is_address(value) and free(m.start(), m.start() + len(value)):
                found.append((1, m.start(), m.start() + len(value)))
    for m in _IP4.finditer(text):
        if free(*m.span()) and _is_address(re.sub("[^0-9.]", "", re.sub("dot", ".", m[0], flags=re.I))):
            found.append((1, *m.span()))
    out = [(k, a, z, a, True) for k, a, z in found]
    free = _free([*taken, *found]) if found else free
    for m in _RUN.finditer(text):
        if m.end() - m.start() < PHONE_DIGITS[0]:
            continue
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in re.finditer(r"[^\x20\t\xa0]+", m[0])]
        if m.end() < len(text) and (text[m.end()].isalnum() or text[m.end()] in "_@"):
            groups.pop()
        run: list[tuple[int, int]] = []
        for g in [*groups, None]:
            if g and free(*g):
                run.append(g)
            else:
                out += _ends_of(text, run) if run else []
                run = []
    return out


def _ends_of(text: str, run: list[tuple[int, int]]) -> list[tuple[int, int, int, int, bool]]:
    """The beginnings and the ends of a run of digit groups that have as many digits as an identifier."""
    most, spans, first, last = CARD_DIGITS[-1], [], run[0][0], run[-1][1]
    digits = ""
    for a, z in run:
        digits += re.sub("[^0-9]", "", text[a:z])
        if len(digits) > most:
            break
        spans.append((first, z, digits))
    digits = ""
    for a, z in reversed(run):
        digits = re.sub("[^0-9]", "", text[a:z]) + digits
        if len(digits) > most:
            break
        if a > first:
            spans.append((a, last, digits))
    out, main = [], True
    for a, z, d in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
        for kind, fits in ((2, len(d) in CARD_DIGITS and luhn(d)), (3, len(d) in PHONE_DIGITS)):
            if fits:
                out.append((kind, a, z, first, main))
                main = False
    return out


def value_of(kind: int, written: str) -> str:
    value = re.sub(r"[\s().\[\]-]", "", written.lower())
    return re.sub("[^0-9+]", "", value) if kind > 1 else value


def _plain(word: str) -> str:
    return re.sub(r"[0-9]+", "#", word.lower())[-24:]


def shape(value: str) -> str:
    """Digits as 9, words as a, at most 40 characters."""
    return re.sub(r"[^\W\d_]+", "a", re.sub("[0-9]", "9", value))[:40]


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a span: the words around it, and its own shape."""
    left = [_plain(w) for w in text[max(0, start - REACH):start].split()[-3:]]
    right = [_plain(w) for w in text[end:end + REACH].split()[:2]]
    found = [f"SH {shape(text[start:end])}"]
    if left and left[-1][-1] in ":=":
        found.append(f"L1 {left[-1]}")
    if len(left) >= 2:
        found.append(f"L2 {left[-2]} {left[-1]}")
    if len(left) == 3:
        found.append("L3 " + " ".join(left))
    if left and right:
        found.append(f"LR {left[-1]} _ {right[0]}")
    if len(right) == 2:
        found.append(f"R2 {right[0]} {right[1]}")
    return found


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_MENTION = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()),
                      ("run", pa.int64()), ("main", pa.bool_()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])


def _scan(batches):
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 40
    for b in batches:
        spans, mentions = [], []
        for text in b.column("text").to_pylist():
            base = base_spans(text)
            spans.append([{"kind": k, "start": a, "end": z} for k, a, z in base])
            loose = candidates(text, base)
            mentions.append([{"kind": k, "start": a, "end": z, "base": own, "run": run, "main": main, "value": value_of(k, text[a:z]),
                              "patterns": contexts(text, a, z)}
                             for own, group in ((True, [(*s, -1, True) for s in base]), (False, [(*s, -1, True) for s in loose]),
                                                (False, generic(text, base + loose))) for k, a, z, run, main in group])
        n = b.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(first, first + n)), b.column("id"), pa.array(spans, pa.list_(_SPAN)),
             pa.array(mentions, pa.list_(_MENTION))], ["rid", "id", "spans", "mentions"])
        first += n


def trusted_values(mentions: DataFrame, support: int = SUPPORT, trust: float = TRUST) -> DataFrame:
    """(kind, value, score) of the base values and of the values that their contexts speak for."""
    graph = materialize(mentions.select("kind", "value", "base", "main", F.explode("patterns").alias("pattern"))
                        .groupBy("pattern", "kind", "value").agg(F.max("base").alias("base"), F.max("main").alias("main")), "pii-graph")
    seeds = mentions.filter("base").select("kind", "value").distinct()
    score, before, now = seeds.withColumn("score", F.lit(1.0)), None, 0
    while now != before:
        known = graph.join(score, ["kind", "value"], "left").select(
            "pattern", "kind", "value", "main", (F.coalesce("score", F.lit(0.0)) >= trust).alias("trusted"))
        per = known.groupBy("pattern", "kind").agg(F.sum(F.col("trusted").cast("double")).alias("yes"),
                                                   F.sum((F.col("trusted") | F.col("main")).cast("long")).alias("n"))
        every = per.groupBy("pattern").agg(F.sum("n").alias("all_n"))
        strong = per.filter(F.col("yes") >= support).join(every, "pattern").select(
            "pattern", "kind", (F.col("yes") / F.col("all_n")).alias("p")).filter(F.col("p") >= trust)
        said = (graph.filter(~F.col("base")).join(strong, ["pattern", "kind"]).groupBy("kind", "value")
                .agg((1 - F.exp(F.sum(F.log(1 - F.least("p", F.lit(0.999)))))).alias("score")))
        # a score never falls: what is trusted stays so, and the rounds end
        score = materialize(score.unionByName(said.join(seeds, ["kind", "value"], "left_anti"))
                            .groupBy("kind", "value").agg(F.max("score").alias("score")), "pii-scores")
        before, now = now, score.filter(F.col("score") >= trust).count()
    return score.filter(F.col("score") >= trust)


def _apart(spans: Column) -> Column:
    """Of overlapping spans (in order of preference) the first."""
    kept = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return F.aggregate(spans, kept, lambda done, x: F.when(
        F.exists(done, lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"])), done).otherwise(
        F.concat(done, F.array(F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))))))


def _text(spans: Column) -> Column:
    """kind:start:end, by kind, then start."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row per row: id, n_email, n_ip, n_card, n_phone (base spans), n_added, base_sha256, spans."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    span = "struct<kind:int,start:bigint,end:bigint>"
    found = materialize(rows.mapInArrow(_scan, f"rid long, id {kind}, spans array<{span}>, mentions array<struct<"
                                        "kind:int,start:bigint,end:bigint,base:boolean,run:bigint,main:boolean,value:string,patterns:array<string>>>"), "pii-found")
    mentions = found.select("rid", F.explode("mentions").alias("m")).select("rid", "m.*")
    said = mentions.filter(~F.col("base")).join(trusted_values(mentions, **kw), ["kind", "value"])
    picked = (said.filter("run >= 0").groupBy("rid", "run").agg(F.collect_set(F.struct(
        (-F.round("score", 9)).alias("score"), (F.col("start") - F.col("end")).alias("length"), "start", "kind", "end")).alias("spans"))
        .select("rid", F.explode(_apart(F.array_sort("spans"))).alias("s")))
    new = (said.filter("run < 0").select("rid", F.struct("kind", "start", "end").alias("s")).unionByName(picked)
           .groupBy("rid").agg(F.collect_set("s").alias("added")))
    all_ = found.select("rid", "id", "spans").join(new, "rid", "left").withColumn(
        "added", F.coalesce("added", F.array().cast(f"array<{span}>")))
    counts = [F.size(F.filter("spans", _of_kind(i))).cast("long").alias(f"n_{k}")
              for i, k in enumerate(KINDS)]
    return all_.select("id", *counts, F.size("added").cast("long").alias("n_added"),
                       F.sha2(_text(F.col("spans")), 256).alias("base_sha256"),
                       _text(F.concat("spans", "added")).alias("spans"))


def _of_kind(i: int):
    return lambda s: s["kind"] == i
