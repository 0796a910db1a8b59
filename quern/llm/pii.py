"""Operator 8: personal data by fixed shapes, and by contexts that are bootstrapped.

Every text is scanned for the four base kinds.  The words before a found entity
make a lexical pattern.  Other tokens that look like identifiers are candidates.
Patterns that several seeds share are counted in all texts, and those that mostly
stand before other words are dropped.  Spark then scores the graph of patterns and
instances in turns: a pattern is as good as its instances, an instance as good as
its best pattern; seeds stay at 1.
What trusted patterns hold counts as support for further patterns, until nothing is added.
Candidates in the contexts of patterns that end up trusted are reported too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import kernels as K
from quern.store import materialize, table

KINDS = ("email", "ip", "card", "phone", "context")


@dataclass(frozen=True)
class PiiConfig:
    context_words: int = 2  # before an entity, that make its pattern
    rounds: int = 3  # of scores, between two looks for further patterns
    least_support: int = 3  # different seeds or instances of trusted patterns that a pattern must have met
    least_share: float = 0.5  # of all places of a trusted pattern that an identifier follows
    least_score: float = 0.6  # of a trusted pattern
    block_patterns: int = 1_000_000  # hashes of patterns (8 bytes) that are broadcast at once


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGITS = re.compile(r"[0-9][0-9 .-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIM = ".,;:!?()[]{}<>\"'"
_OPEN = "([{<\"'"
_SPACE = frozenset(" \t\n\r\x0b\x0c")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the run of local characters before it (since the last match) and a
    domain after it: the leftmost matches, in time linear in the text."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    cards = []
    for cluster in _DIGITS.finditer(text):
        a, b = cluster.span()
        if b - a < 7:
            continue
        for m in _IP.finditer(text, a, b):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split(".")):
                out.append((1, *m.span()))
        if b - a >= 16:
            for m in _CARD.finditer(text, a, b):
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    cards.append((2, *m.span()))
    out += cards
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


def _pattern(text: str, start: int, words: int) -> str | None:
    """The words before ``start`` and what opens there, lower-cased (A-Z); None where there are fewer or none ends there."""
    while start > 0 and text[start - 1] in _OPEN:
        start -= 1
    if start == 0 or text[start - 1] not in _SPACE:
        return None
    found, end = [], start
    for _ in range(words):
        while end > 0 and text[end - 1] in _SPACE:
            end -= 1
        begin = end
        while begin > 0 and text[begin - 1] not in _SPACE:
            begin -= 1
        if begin == end:
            return None
        found.append(text[begin:end])
        end = begin
    return " ".join(reversed(found)).encode().lower().decode()


def candidates(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens that look like identifiers (6 or more characters, 4 or more digits) and meet no base span."""
    taken = sorted((a, b) for _, a, b in spans)
    done, i = 0, 0
    for cluster in _DIGITS.finditer(text):
        a = cluster.start()
        if a < done:
            continue
        b = a + 1
        while b < len(text) and text[b] not in _SPACE:
            b += 1
        done = b
        while a > 0 and text[a - 1] not in _SPACE:
            a -= 1
        while a < b and text[a] in _TRIM:
            a += 1
        while b > a and text[b - 1] in _TRIM:
            b -= 1
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if b - a >= 6 and sum(c in "0123456789" for c in text[a:b]) >= 4 and not (i < len(taken) and taken[i][0] < b):
            yield a, b


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_SEEN = pa.struct([("pattern", pa.string()), ("instance", pa.string()), ("seed", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())])
_SCANNED = "row long, doc_id long, spans array<struct<kind:int,start:bigint,end:bigint>>, seen array<struct<pattern:string,instance:string,seed:boolean,start:bigint,end:bigint>>"


def _scan(config: PiiConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_spans, all_seen = [], []
            for text in batch.column(2):
                text = text.as_py() or ""
                spans = base_spans(text)
                seen = [(_pattern(text, a, config.context_words), text[a:b].lower(), True, a, b) for _, a, b in spans]
                seen += [(_pattern(text, a, config.context_words), text[a:b].lower(), False, a, b) for a, b in candidates(text, spans)]
                all_spans.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans])
                all_seen.append([dict(zip(("pattern", "instance", "seed", "start", "end"), s, strict=True)) for s in seen])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int64()), pa.array(all_spans, pa.list_(_SPAN)), pa.array(all_seen, pa.list_(_SEEN))], names=["row", "doc_id", "spans", "seen"])

    return run


def _occurrences(shared, words: int):
    """How often each of some patterns (sorted hashes) occurs in the texts."""

    def run(batches):
        hashes = shared.value
        total = np.zeros(len(hashes), np.int64)
        for batch in batches:
            for _, _, raw, bounds in K.chunks(*K.utf8(batch.column(0))):
                low = K.LOWER[raw]
                starts, ends, first = K.words(low, bounds, K.NON_SPACE)
                h = K.span_hashes(low, starts, ends)
                h = K.window_hashes(h, words)[K.window_starts(first, words, len(h))]
                at = np.searchsorted(hashes, h)
                at[at == len(hashes)] = 0
                total += np.bincount(at[hashes[at] == h], minlength=len(hashes))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hashes[some].view(np.int64)), pa.array(total[some])], names=["h", "n"])

    return run


def _hashed(words: int):
    def run(batches):
        for batch in batches:
            raw, bounds = K.utf8(batch.column(0))
            starts, ends, first = K.words(raw, bounds, K.NON_SPACE)
            h = K.window_hashes(K.span_hashes(raw, starts, ends), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h[first[:-1]].view(np.int64))], names=["pattern", "hash"])

    return run


def _specific(patterns: DataFrame, seen: DataFrame, texts: DataFrame, config: PiiConfig) -> DataFrame:
    """The patterns that mostly stand before identifiers: each is counted in all texts.

    Hashes go to the tasks in blocks of at most ``block_patterns``, a pass for each."""
    spark = texts.sparkSession
    hashed = materialize(patterns.mapInArrow(_hashed(config.context_words), "pattern string, hash long"), "supported")
    blocks = -(-hashed.count() // config.block_patterns)
    counts = None
    for block in range(blocks):
        mine = hashed.where(F.pmod("hash", F.lit(blocks)) == block).select("hash").distinct().toPandas()["hash"].to_numpy(np.int64)
        shared = spark.sparkContext.broadcast(np.sort(mine.view(np.uint64)))
        part = texts.mapInArrow(_occurrences(shared, config.context_words), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
        counts = part if counts is None else counts.unionAll(part)
    if counts is None:
        return patterns
    held = seen.groupBy(F.col("pattern").alias("p")).agg(F.count("*").alias("held"))
    out = hashed.join(counts, F.col("hash") == F.col("h")).join(held, F.col("pattern") == F.col("p"))
    return out.where(F.col("held") >= config.least_share * F.col("n")).select("pattern")


def _trusted(seen: DataFrame, texts: DataFrame, config: PiiConfig) -> DataFrame:
    """The patterns that hold identifiers, by turns of scores over the graph.

    Scores only rise as the graph grows, so what is trusted once stays so."""
    edges = materialize(seen.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges")
    seeds = edges.where("seed").select("instance").distinct()
    accepted, scores = seeds, seeds.withColumn("score", F.lit(1.0))
    tried = specific = edges.select("pattern").limit(0)
    trusted, graph, before, turn = tried, None, 0, 0
    while True:
        supported = edges.join(accepted, "instance", "left_semi").groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= config.least_support)
        new = materialize(supported.select("pattern").join(tried, "pattern", "left_anti"), f"supported{turn}")
        n = trusted.count()
        if new.isEmpty() and n == before:
            return trusted.withColumnRenamed("pattern", "trusted")
        before = n
        if not new.isEmpty():
            tried = tried.unionAll(new)
            specific = specific.unionAll(materialize(_specific(new, seen, texts, config), f"specific{turn}"))
            graph = materialize(edges.join(specific, "pattern", "left_semi"), f"graph{turn}")
        for _ in range(config.rounds):
            held = graph.join(scores, "instance", "left")
            patterns = held.groupBy("pattern").agg(F.avg(F.coalesce("score", F.lit(0.0))).alias("mean"), F.count("*").alias("instances"))
            patterns = materialize(patterns.withColumn("trust", F.col("mean") * (1 - F.pow(F.lit(0.5), F.col("instances")))), f"patterns{turn}")
            best = graph.join(patterns, "pattern").groupBy("instance").agg(F.max(F.when(F.col("seed"), 1.0).otherwise(F.col("trust"))).alias("score"))
            scores = materialize(best.unionAll(seeds.withColumn("score", F.lit(1.0))).groupBy("instance").agg(F.max("score").alias("score")), f"instances{turn}")
        trusted = materialize(patterns.where(F.col("trust") >= config.least_score).select("pattern"), f"trusted{turn}")
        accepted = edges.join(trusted, "pattern", "left_semi").select("instance").unionAll(seeds).distinct()
        turn += 1


def find_personal_data(docs: DataFrame, config: PiiConfig = PiiConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id and spans (array of kind, start, end by
    kind, then start; code points, end exclusive).  Kinds: see ``KINDS``; the last
    are the identifiers that contexts have led to.

    * null or empty text: no spans.  Repeated rows and null ids are kept as they
      are; an empty table gives no rows; further columns are ignored.
    * very long texts, words and identifiers count whole; of overlapping kinds each is
      reported, and equal spans of repeated rows once for each row.
    * without seeds no pattern is trusted, and only base kinds are found.
    """
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scanned = materialize(read.mapInArrow(_scan(config), _SCANNED), "scanned")
    seen = scanned.where("size(seen) > 0").select("row", F.explode("seen").alias("s")).select("row", "s.*").where("pattern IS NOT NULL")
    found = seen.where("NOT seed").join(_trusted(seen, read.select("text"), config), F.col("pattern") == F.col("trusted"), "left_semi")
    added = found.groupBy(F.col("row").alias("r")).agg(F.array_sort(F.collect_list(F.struct(F.lit(len(KINDS) - 1).alias("kind"), "start", "end"))).alias("added"))
    out = scanned.select("row", "doc_id", "spans").join(added, F.col("row") == F.col("r"), "left")
    return out.select("doc_id", F.when(F.col("added").isNull(), F.col("spans")).otherwise(F.concat("spans", "added")).alias("spans"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    base = F.filter("spans", lambda x: x["kind"] < len(KINDS) - 1)
    return found.select("doc_id", *[count(k) for k in range(4)], F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first counts."""
    out, last = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if a >= last:
            out += [text[last:a], f"[{kind}]"]
            last = b
    return "".join([*out, text[last:]])
