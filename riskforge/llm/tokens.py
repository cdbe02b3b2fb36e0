"""Token-ID files: Parquet with one list of ids per document.

Documents are put in ascending id order (nulls first; equal ids by a hash of
the text), tokenised inside the range partitions and written as list columns
with a chosen encoding (``dictionary``: bit-packed vocabulary indexes, or
``delta``: DELTA_BINARY_PACKED), row-group size and page size. The Parquet
writer adds column and page indexes, so a reader can fetch the ids of a range
of documents, or only the metadata columns, without touching the other pages.

Columns of a file: id, part and pos (which range, and how many ids precede the
document inside it), n_tokens, tokens, and any metadata columns asked for.
Offsets over the whole corpus need one sum per range, no sort of the rows.

Defined results: null and empty texts have the end id only; repeated rows are
written each; an empty table writes an empty file; metadata columns named like
a file column raise ``ValueError``.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskforge.llm.common import string_buffers, text_or_empty

FILE_COLUMNS = ("id", "part", "pos", "n_tokens", "tokens")
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
SLICE_BYTES = 3 << 20
BROADCAST_RANGES = 100_000   # 16 bytes each
WORDS_KEPT = 1 << 20      # distinct words whose ids a task remembers
#: White space of Unicode other than space, newline, tab and carriage return (Python and the library differ on some).
_OTHER_SPACE = "[" + "".join(map(chr, (
    0x0B, 0x0C, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]"
_SPACES = " \n\t\r"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _flat(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places at, at + 1, ... of runs of the given sizes, one run after the other."""
    end = np.cumsum(size, dtype=np.int64)
    out = np.arange(int(end[-1]) if len(end) else 0)
    out += np.repeat(at - (end - size), size)
    return out


def _keys(words: pa.Array) -> np.ndarray:
    """64 bits of every word from its length and its first and last 32 bytes; what has the same bits is compared."""
    raw, edge = string_buffers(words)
    edge = edge.astype(np.int64)
    width = np.diff(edge)
    key = width.astype(np.uint64) * _MIX
    for at, size in ((edge[:-1], np.minimum(width, 32)), (edge[1:] - 32, np.where(width > 32, 32, 0))):
        power = np.cumprod(np.full(32, _MIX))
        end = np.cumsum(size)
        one = raw[_flat(at, size)].astype(np.uint64) * power[_flat(np.zeros(len(size), np.int64), size)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(one, dtype=np.uint64)])
        key = (key ^ (sums[end] - sums[end - size])) * _MIX
    return key


class _Words:
    """Ids of words, each encoded once while it is remembered. ``lead`` is what stands before every word.

    The words are one Arrow array beside numpy columns, found by a sorted column of their keys that grows
    with them; beyond ``WORDS_KEPT`` the half that was not met for the longest time is forgotten.
    """

    def __init__(self, tok, width: np.ndarray, lead: str):
        self.tok, self.width, self.lead, self.now = tok, width, lead, 0
        self.words = pa.array([], pa.string())
        self.ids, self.size, self.at, self.met = (np.zeros(0, t) for t in (np.int32, np.int32, np.int64, np.int32))
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def codes(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words in the memory; new ones are encoded."""
        if len(self.words) > WORDS_KEPT:
            self.forget()
        self.now += 1
        keys, code, known = _keys(words), np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            maybe = np.flatnonzero(self.keys[at] == keys)
            code[maybe] = self.place[at[maybe]]
            known[maybe] = pc.equal(words.take(pa.array(maybe)), self.words.take(pa.array(code[maybe]))).to_numpy(zero_copy_only=False)
        rest = np.flatnonzero(~known)
        if len(rest):
            code[rest] = len(self.words) + np.arange(len(rest))
            rest = rest[np.argsort(keys[rest], kind="stable")]
            at = np.searchsorted(self.keys, keys[rest])
            self.keys, self.place = np.insert(self.keys, at, keys[rest]), np.insert(self.place, at, code[rest])
            self.learn(words.filter(pa.array(~known)))
        self.met[code] = self.now
        return code

    def forget(self) -> None:
        keep = np.sort(np.argsort(self.met, kind="stable")[len(self.met) // 2:])
        self.ids = self.ids[_flat(self.at[keep], self.size[keep])]
        self.words, self.size, self.met = self.words.take(pa.array(keep)), self.size[keep], self.met[keep]
        self.at = np.cumsum(self.size, dtype=np.int64) - self.size
        moved = np.full(len(self.place), -1, np.int32)
        moved[keep] = np.arange(len(keep))
        kept = moved[self.place] >= 0
        self.keys, self.place = self.keys[kept], moved[self.place[kept]]

    def learn(self, new: pa.Array) -> None:
        raw, edge = string_buffers(new)
        width, first = np.diff(edge), np.zeros(len(new), np.uint8)
        first[width > 0] = raw[edge[:-1][width > 0]]
        # behind a leading space words can stand in one text, told apart again by the ids' byte widths
        alone = (width == 0) | np.isin(first, list(_SPACES.encode())) | (not self.lead)
        flat, sizes = [], np.zeros(len(new), np.int64)
        joined, rest = np.flatnonzero(~alone), np.flatnonzero(alone)
        if len(joined):
            cuts = np.append(np.arange(0, len(joined), 256), len(joined)).astype(np.int32)
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), new.take(pa.array(joined))), self.lead).to_pylist()
            ids = np.concatenate([np.array(e.ids, dtype=np.int32) for e in self.tok.encode_batch_fast(
                [self.lead + t for t in texts], add_special_tokens=False)])
            ends = np.cumsum(width[joined] + len(self.lead.encode()))
            sizes[joined] = np.diff(np.searchsorted(np.cumsum(self.width[ids]), ends), prepend=-1)
            flat.append(ids)
        for i, e in zip(rest, self.tok.encode_batch_fast([self.lead + w for w in new.take(pa.array(rest)).to_pylist()],
                                                         add_special_tokens=False)):
            sizes[i] = len(e.ids)
            flat.append(np.array(e.ids, dtype=np.int32))
        order = np.concatenate([joined, rest])
        at = np.zeros(len(new), np.int64)
        at[order] = len(self.ids) + np.cumsum(sizes[order]) - sizes[order]
        self.words = pa.concat_arrays([self.words, new])
        self.ids = np.concatenate([self.ids, *flat])
        self.size, self.at = np.concatenate([self.size, sizes.astype(np.int32)]), np.concatenate([self.at, at])
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int32)])


class WordEncoder:
    """Encodes with the ``tokenizers`` library, each distinct word once.

    A byte-level BPE splits every text before a space that stands between two
    other characters, so the ids of a text are those of its first word, then those
    of every further word with its space. Texts with special tokens, with white
    space before a space, or with rarer white space go to the library whole.
    """

    _open: dict = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab(with_added_tokens=True)
        width = np.zeros(max(vocab.values()) + 1, np.int64)     # bytes of an id: one character each in the vocabulary
        width[list(vocab.values())] = list(map(len, vocab))
        self.width = width
        self.odd = [*(f"{c} " for c in _SPACES), *(t.content for t in self.tok.get_added_tokens_decoder().values())]
        self.further, self.first = _Words(self.tok, self.width, " "), _Words(self.tok, self.width, "")

    @classmethod
    def of(cls, path: str) -> "WordEncoder":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        odd = pc.match_substring_regex(texts, _OTHER_SPACE)
        for piece in self.odd:
            odd = pc.or_(odd, pc.match_substring(texts, piece))
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        words = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        edge = words.offsets.to_numpy().astype(np.int64)
        flat = words.values.dictionary_encode()
        heads = words.values.take(pa.array(edge[:-1])).dictionary_encode()
        head = self.first.codes(heads.dictionary)[heads.indices.to_numpy()]
        code = self.further.codes(flat.dictionary)[flat.indices.to_numpy()]
        size, at = self.further.size[code], self.further.at[code]
        size[edge[:-1]], at[edge[:-1]] = self.first.size[head], self.first.at[head] + len(self.further.ids)
        total = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        ids = np.concatenate([self.further.ids, self.first.ids])[_flat(at, size)]
        per = total[edge[1:]] - total[edge[:-1]]
        if len(whole):
            parts = np.split(ids, np.cumsum(per)[:-1])
            for i, e in zip(whole, self.tok.encode_batch_fast(texts.take(pa.array(whole)).to_pylist(), add_special_tokens=False)):
                parts[i] = np.array(e.ids, dtype=np.int32)
                per[i] = len(parts[i])
            ids = np.concatenate(parts)
        return ids, per


def _tokenise(path: str, end_id: int, meta: list[str]):
    def run(batches):
        from pyspark import TaskContext

        enc, part, pos = WordEncoder.of(path), TaskContext.get().partitionId(), 0
        for whole in batches:
            sizes = np.diff(string_buffers(whole.column("text"))[1])
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES)) + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]):
                b = whole.slice(a, z - a)
                if not b.num_rows:
                    continue
                ids, per = enc.encode(b.column("text"))
                pa.default_memory_pool().release_unused()     # freed word columns count as the task's memory until then
                n = per + 1
                offs = np.concatenate([[0], np.cumsum(n)])
                full = np.full(int(offs[-1]), end_id, dtype=np.int32)
                keep = np.ones(len(full), dtype=bool)
                keep[offs[1:] - 1] = False
                full[keep] = ids
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(np.full(len(n), part, np.int32)), pa.array(pos + offs[:-1]),
                     pa.array(n.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(full)),
                     *(b.column(c) for c in meta)], [*FILE_COLUMNS, *meta])
                pos += int(offs[-1])
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 0, meta: tuple[str, ...] = (), encoding: str = "dictionary",
                 row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> None:
    """Write the token ids of all documents to ``path``."""
    if clash := {c.lower() for c in meta} & set(FILE_COLUMNS):
        raise ValueError(f"metadata columns named like a file column: {sorted(clash)}")
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), *meta)
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = rows.mapInArrow(_tokenise(tokenizer, end_id, list(meta)), ", ".join(
        [f"id {kind['id']}", "part int", "pos long", "n_tokens int", "tokens array<int>",
         *(f"`{c}` {kind[c]}" for c in meta)]))
    flat = {"parquet.enable.dictionary#tokens.list.element": str(encoding == "dictionary").lower(),
            "parquet.enable.dictionary#pos": "false", "parquet.enable.dictionary#id": "false"}
    (out.write.mode("overwrite").option("compression", "zstd").option("parquet.writer.version", "v2")
     .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes).options(**flat).parquet(path))


def _starts(rows: DataFrame) -> DataFrame:
    """part -> ids before the range: one row per range, i.e. per write task."""
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    return sums.select(F.col("part").alias("__part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("__before"))


def read_tokens(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The chosen file columns (all by default) with ``start``: ids of all documents before."""
    rows = spark.read.parquet(path)
    before = _starts(rows)
    if before.count() <= BROADCAST_RANGES:        # beyond, the join shuffles the rows by range
        before = F.broadcast(before)
    return rows.join(before, F.col("part") == F.col("__part")).withColumn("start", F.col("__before") + F.col("pos")).select(
        *(columns or rows.columns), "start")


def _checksum(batches):
    for b in batches:
        col = b.column("tokens")
        offs = col.offsets.to_numpy()
        flat = memoryview(np.ascontiguousarray(col.values.to_numpy(), dtype="<u4")).cast("B")
        crc = [zlib.crc32(flat[4 * a:4 * z]) for a, z in zip(offs[:-1].tolist(), offs[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), b.column("start"), pa.array(np.diff(offs).astype(np.int64)), pa.array(crc, pa.int64())],
            ["id", "start", "n_tokens", "ids_crc32"])


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """id, start, n_tokens and the CRC-32 of the ids as little-endian 32-bit integers, read from the files."""
    rows = read_tokens(spark, path, "id", "tokens")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_checksum, f"id {kind}, start long, n_tokens long, ids_crc32 long")
