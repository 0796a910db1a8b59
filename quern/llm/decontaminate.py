"""Operator 6: benchmark decontamination by a prefix-filtered set join.

A document holds a window of an item if it holds all of the window's shingles in
place, so it must hold the rarest of them: a prefix of one shingle is enough for
full containment.  Shingles are ordered by how often they occur in all documents,
windows are indexed by their rarest shingle, documents are probed with their own
shingles, and what meets is checked by length, by place and word for word.

The index of a bounded block of items goes to every task; more items make more
blocks, each with a pass of its own, whose hits are united by document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import kernels as K
from quern.store import materialize, table


@dataclass(frozen=True)
class LeakConfig:
    window: int = 10  # consecutive words of an item; a shorter item is one window
    shingle: int = 3  # words of the shingles that windows are indexed by
    block_bytes: int = 16 << 20  # of item texts in one index


def _words(column: pa.Array):
    """(first document, hashes of its words in the chunk, word bounds)."""
    for i, j, raw, bounds in K.chunks(*K.utf8(column)):
        low = K.LOWER[raw]
        starts, ends, first = K.words(low, bounds, K.ALNUM_LOWER)
        yield i, j, K.span_hashes(low, starts, ends), first


class Windows:
    """The distinct windows of some items: hashes of their words, and who has them."""

    def __init__(self, ids: list[str], texts: list[str], config: LeakConfig):
        self.config, self.ids = config, ids
        rows, self.length, owners = [], [], []
        seen: dict[bytes, int] = {}
        for i, _, h, first in _words(pa.array(texts, pa.string())):
            for d in range(len(first) - 1):
                item = h[first[d] : first[d + 1]]
                n = min(config.window, len(item))
                for at in range(len(item) - n + 1 if n else 0):
                    w = item[at : at + n]
                    k = seen.setdefault(w.tobytes(), len(seen))
                    if k == len(rows):
                        rows.append(np.concatenate([w, np.zeros(config.window - n, np.uint64)]))
                        self.length.append(n)
                        owners.append(set())
                    owners[k].add(i + d)
        self.words = np.array(rows, np.uint64).reshape(len(rows), config.window)
        self.length = np.array(self.length, np.int64)
        self.owners = [sorted(o) for o in owners]
        self.shingles()

    def shingles(self) -> None:
        """All shingles of the windows: (window, place in it, hash), by window."""
        window, place, value = [], [], []
        for n in sorted(set(self.length.tolist())):
            k, own = min(self.config.shingle, n), np.flatnonzero(self.length == n)
            for at in range(n - k + 1):
                h = np.zeros(len(own), np.uint64)
                for c in range(k):
                    h += self.words[own, at + c] * K._MIX[c]
                window.append(own)
                place.append(np.full(len(own), at))
                value.append(K.mix(h + K.U64(k)))
        cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        self.of, self.place, self.value = cat(window, np.int64), cat(place, np.int64), cat(value, np.uint64)
        self.vocabulary = np.unique(self.value)
        self.sizes = sorted({min(self.config.shingle, n) for n in self.length.tolist()})

    def index(self, counts: np.ndarray) -> None:
        """Keeps each window's rarest shingle; ``counts``: of ``vocabulary``, in all documents."""
        seen = counts[np.searchsorted(self.vocabulary, self.value)]
        order = np.lexsort((self.place, self.value, seen, self.of))
        first = order[np.unique(self.of[order], return_index=True)[1]]
        first = first[np.argsort(self.value[first], kind="stable")]
        self.key, self.key_window, self.key_place = self.value[first], self.of[first], self.place[first]
        self.keys, self.key_start = np.unique(self.key, return_index=True)
        self.key_end = np.append(self.key_start[1:], len(self.key))
        # a small bit table answers most probes
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.keys >> K.U64(44)).astype(np.int64)] = True
        del self.of, self.place, self.value

    def probe(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, windows) of all occurrences of windows in documents with words ``h``."""
        places, windows = [], []
        doc_end = np.repeat(first[1:], np.diff(first))
        doc_start = np.repeat(first[:-1], np.diff(first))
        for k in self.sizes:
            s = K.window_hashes(h, k)
            at = np.flatnonzero(self.bits[(s >> K.U64(44)).astype(np.int64)])
            slot = np.searchsorted(self.keys, s[at])
            slot[slot == len(self.keys)] = 0
            met = self.keys[slot] == s[at]
            at, slot = at[met], slot[met]
            n = self.key_end[slot] - self.key_start[slot]
            pick = np.repeat(self.key_start[slot] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(int(n.sum()))
            window, begin = self.key_window[pick], np.repeat(at, n) - self.key_place[pick]
            own = np.repeat(at, n)
            length = self.length[window]
            inside = (begin >= doc_start[own]) & (begin + length <= doc_end[own]) & (np.minimum(self.config.shingle, length) == k)
            window, begin, length = window[inside], begin[inside], length[inside]
            for c in range(self.config.window):  # word for word
                far = c < length
                same = ~far | (h[np.minimum(begin + c, len(h) - 1)] == self.words[window, c])
                window, begin, length = window[same], begin[same], length[same]
            places.append(begin)
            windows.append(window)
        return np.concatenate(places or [np.zeros(0, np.int64)]), np.concatenate(windows or [np.zeros(0, np.int64)])


def _count(windows):
    def run(batches):
        index = windows.value
        total = np.zeros(len(index.vocabulary), np.int64)
        bits = np.zeros(1 << 20, bool)
        bits[(index.vocabulary >> K.U64(44)).astype(np.int64)] = True
        for batch in batches:
            for _, _, h, _ in _words(batch.column(0)):
                for k in index.sizes:
                    s = K.window_hashes(h, k)
                    s = s[bits[(s >> K.U64(44)).astype(np.int64)]]
                    at = np.searchsorted(index.vocabulary, s)
                    at[at == len(total)] = 0
                    at = at[index.vocabulary[at] == s]
                    total += np.bincount(at, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["i", "n"])

    return run


_HITS = "row long, doc_id long, n_words long, n_hit long, ranges array<long>, items array<string>"


def _hits(windows):
    """Per document: words, hit words, the ranges of these, and the items that occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = windows.value
        for batch in batches:
            n_words, n_hit, ranges, items = [], [], [], []
            for _, _, h, first in _words(batch.column(2)):
                places, found = index.probe(h, first)
                change = np.zeros(len(h) + 1, np.int64)
                np.add.at(change, places, 1)
                np.add.at(change, places + index.length[found], -1)
                hit = np.cumsum(change[:-1]) > 0
                n_words += np.diff(first).tolist()
                n_hit += K.per_document(hit, first).tolist()
                by_doc: dict[int, set[int]] = {}
                for d, w in np.unique(np.stack([np.searchsorted(first, places, side="right") - 1, found]), axis=1).T.tolist():
                    by_doc.setdefault(d, set()).update(index.owners[w])
                for d in range(len(first) - 1):
                    if d in by_doc:
                        flags = np.diff(np.concatenate(([0], hit[first[d] : first[d + 1]].astype(np.int8), [0])))
                        edges = np.flatnonzero(flags)
                        ranges.append(edges.tolist())
                        items.append(sorted({index.ids[o] for o in by_doc[d]}))
                    else:
                        ranges.append([])
                        items.append([])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(ranges, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                names=["row", "doc_id", "n_words", "n_hit", "ranges", "items"],
            )

    return run


def _united(group: pa.Table) -> pa.Table:
    """One document's hits from several blocks of items."""
    flags = np.zeros(group["n_words"][0].as_py() + 1, np.int64)
    for r in group["ranges"].to_pylist():
        np.add.at(flags, r[0::2], 1)
        np.add.at(flags, r[1::2], -1)
    hit = np.diff(np.concatenate(([0], (np.cumsum(flags)[:-1] > 0).astype(np.int8), [0])))
    items = sorted({x for xs in group["items"].to_pylist() for x in xs})
    edges = np.flatnonzero(hit)
    one = {"row": [group["row"][0].as_py()], "doc_id": pa.array([group["doc_id"][0].as_py()], pa.int64()), "n_words": [len(flags) - 1], "n_hit": [int((edges[1::2] - edges[0::2]).sum())], "ranges": pa.array([edges.tolist()], pa.list_(pa.int64())), "items": pa.array([items], pa.list_(pa.string()))}
    return pa.table(one)


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _n_blocks(items: DataFrame, config: LeakConfig) -> int:
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // config.block_bytes))


def _blocks(items: DataFrame, n: int) -> Iterator[tuple[list[str], list[str]]]:
    """Item texts in ``n`` blocks by a hash of the ids."""
    for b in range(n):
        block = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b)
        rows = block.orderBy("item_id", "text").toArrow()
        if rows.num_rows or b == 0:
            yield rows["item_id"].to_pylist(), rows["text"].to_pylist()


def _indexed(texts: DataFrame, items: DataFrame, n: int, config: LeakConfig):
    """The broadcast windows of each of ``n`` blocks of items, indexed by the counts in ``texts``."""
    spark = texts.sparkSession
    for ids, items_texts in _blocks(items, n):
        windows = Windows(ids, items_texts, config)
        counts = np.zeros(len(windows.vocabulary), np.int64)
        if len(counts):
            shared = spark.sparkContext.broadcast(windows)
            for i, n in texts.mapInArrow(_count(shared), "i long, n long").groupBy("i").agg(F.sum("n")).toLocalIterator():
                counts[i] = n
        windows.index(counts)
        yield spark.sparkContext.broadcast(windows)


def _clean(windows, at: int):
    """The rows whose own text (column ``at``) holds no window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = windows.value
        for batch in batches:
            ok = np.ones(batch.num_rows, bool)
            for i, _, h, first in _words(batch.column(at).cast(pa.string())):
                places, _ = index.probe(h, first)
                ok[i + np.searchsorted(first, places, side="right") - 1] = False
            yield batch.filter(pa.array(ok))

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, config: LeakConfig = LeakConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_hit, ranges (bounds of the
    runs of hit words, in turn start and end), items (ids as strings, sorted).

    * null or empty text: no words, nothing hit.  Items without words have no
      window; rows of the benchmark with a null id are ignored, and rows that share
      an id are one item.
    * repeated rows and null ids of documents are kept; an empty table gives no
      rows, an empty benchmark no hits; further columns are ignored.

    * very long texts and items: all of their words count, each word 8 bytes in one task.

    An index holds 16 MB of item texts; a larger benchmark is worked through in
    such blocks.  The rows are numbered in a written table then, so that hits of all
    passes meet at the same row.
    """
    items = _items(benchmark)
    n = _n_blocks(items, config)
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if n > 1:
        read = materialize(read, "numbered")
    found = [read.mapInArrow(_hits(shared), _HITS) for shared in _indexed(read.select("text"), items, n, config)]
    if len(found) == 1:
        return found[0].drop("row")
    out = found[0]
    for part in found[1:]:
        out = out.unionAll(part.where("n_hit > 0"))
    out = materialize(out, "hits")
    many = out.groupBy(F.col("row").alias("r")).agg(F.count("*").alias("n")).where("n > 1")
    alone = out.join(many, out.row == many.r, "left_anti")
    several = out.join(many, out.row == many.r, "left_semi").groupBy("row").applyInArrow(_united, _HITS)
    return alone.unionAll(several).drop("row")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.array_join(F.array_sort("items"), ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), listed.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, config: LeakConfig = LeakConfig()) -> DataFrame:
    """The pipeline's stage: documents that hold a window of an item go, each row by its own text.

    Rows with a null or empty text or a null id stay unless their own text is hit; very long texts
    count whole; an empty table stays empty, and an empty benchmark removes nothing.
    """
    out, schema, items = docs, docs.schema, _items(benchmark)
    for shared in _indexed(docs.select(F.col("text").cast("string").alias("text")), items, _n_blocks(items, config), config):
        out = out.mapInArrow(_clean(shared, schema.names.index("text")), schema)
    return out
