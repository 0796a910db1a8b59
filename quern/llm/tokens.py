"""Operator 9: token ids in sorted-string-table shards.

Documents are range-partitioned by identifier, so that each partition becomes
one shard, sorted, and the shards follow one another.  Executors write the
shards into the shared folder under names of their own; the manifest holds only
those of the attempts that counted.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm import sstable
from quern.store import materialize, new_dir, table


#: the white space that bytes.split knows
_GAP = re.compile(rb"[ \t\n\r\x0b\x0c]")
#: the settings under which letters and the punctuation after them are split, and ASCII letters change by their case alone
_PLAIN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_TAIL = b".,;:!?"
#: letters that stay one letter in lower case (not \u0130)
_LETTER = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f\u0400-\u0481\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5]")


@dataclass(frozen=True)
class TokenConfig:
    tokenizer: str = public_tokenizers.path("word_bpe_49k.json")
    end_id: int = 1
    cache_words: int = 400_000  # of a generation of the cache; a worker keeps two
    cache_bytes: int = 64 << 20  # of a generation's words and ids
    piece_bytes: int = 1 << 20  # of a text that are split into words at once
    group_bytes: int = 1 << 17  # of short texts whose words are learned together
    shard_bytes: int = 256 << 20  # of texts in a shard, about


class Encoder:
    """Ids of whole texts, word by word.

    For a tokenizer that drops white space, and whose normaliser and
    pre-tokenizer never look across it, a text's ids are those of its words one
    after another, so a word need be encoded only when it is new: a cache of two
    generations keeps those that recur.
    ``by_words`` says whether the file's settings are of that kind; if not, whole
    texts are encoded.
    """

    def __init__(self, config: TokenConfig):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.config, self.tokenizer = config, Tokenizer.from_file(config.tokenizer)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 65536 and config.end_id < 65536 else 4
        self.end = config.end_id.to_bytes(self.width, "little")
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.size = 0
        with open(config.tokenizer, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_words = self._splits(spec)
        # a special token between words keeps their ids apart in one call
        marks = [t["content"] for t in spec.get("added_tokens", []) if t.get("special") and not t["content"].isspace()]
        self.mark = marks[-1] if marks else None
        self.mark_id = self.tokenizer.token_to_id(self.mark) if marks else None
        self.marks = [m.encode() for m in marks]
        # which ids end a run of letters, where the vocabulary says so
        suffix = spec["model"].get("end_of_word_suffix")
        self.ends = None
        if suffix and self.mark is not None:
            self.ends = np.zeros(1 << (8 * self.width) if self.width == 2 else max(self.tokenizer.get_vocab().values()) + 1, bool)
            self.ends[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith(suffix)]] = True
        self.plain = self.by_words and self.ends is not None and self._is_plain(spec)
        if self.plain:  # the same model for lower-case ASCII letters, which the other steps leave alone
            self.letters = Tokenizer(self.tokenizer.model)
            self.letters.pre_tokenizer = WhitespaceSplit()

    @staticmethod
    def _is_plain(spec: dict) -> bool:
        norms = [(n["type"], n.get("pattern"), n.get("content")) for n in spec["normalizer"]["normalizers"]]
        split, *rest = spec["pre_tokenizer"]["pretokenizers"]
        levels = [(x["type"], x.get("add_prefix_space"), x.get("use_regex")) for x in rest]
        return norms == [("NFC", None, None), ("Replace", {"Regex": "\\s+"}, " "), ("Lowercase", None, None)] and split["pattern"]["Regex"] == _PLAIN and levels == [("ByteLevel", False, False)]

    @staticmethod
    def _splits(spec: dict) -> bool:
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = steps[0] if steps else {}
        pattern = (split.get("pattern") or {}).get("Regex", "")
        norms = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        plain = split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True and "\\s" not in pattern.replace("[^\\s", "")
        return plain and set(norms) <= {"NFC", "Replace", "Lowercase"} and not any(t.get("lstrip") or t.get("rstrip") for t in spec.get("added_tokens", []))

    def _ids(self, texts: list[str], tokenizer=None) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=f"<u{self.width}") for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Each word with its ids; many words go to the tokenizer as one text."""
        lower, letters, joined, alone = [], [], [], []
        for w in words:
            if self.plain and w.isalpha() and w.islower():
                lower.append(w)
            elif self.ends is not None and w.decode().isalpha():
                letters.append(w)
            else:
                (alone if self.mark is None or b"<" in w and any(m in w for m in self.marks) else joined).append(w)
        for same, tokenizer in ((lower, self.letters if self.plain else None), (letters, None)):
            for i in range(0, len(same), 4096):
                part = same[i : i + 4096]
                ids = self._ids([b" ".join(part).decode()], tokenizer)[0]
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) == len(part):  # every word has one end at least, so each has just one
                    yield from self._cut(part, ids, [0, *ends[:-1].tolist()], ends.tolist())
                else:
                    joined += part
        for i in range(0, len(joined), 4096):
            part = joined[i : i + 4096]
            ids = self._ids([self.mark.join(w.decode() for w in part)])[0]
            cuts = np.flatnonzero(ids == self.mark_id).tolist()
            if len(cuts) != len(part) - 1:
                raise ValueError("the tokenizer does not keep its special tokens apart")
            yield from self._cut(part, ids, [0, *[c + 1 for c in cuts]], [*cuts, len(ids)])
        if alone:
            for w, ids in zip(alone, self._ids([w.decode() for w in alone]), strict=True):
                yield w, ids.tobytes()

    def _cut(self, words: list[bytes], ids: np.ndarray, starts: list[int], ends: list[int]) -> Iterator[tuple[bytes, bytes]]:
        raw, k = ids.tobytes(), self.width
        return zip(words, [raw[a * k : b * k] for a, b in zip(starts, ends, strict=True)], strict=True)

    def _put(self, found: dict[bytes, bytes]) -> None:
        self.young.update(found)
        self.size += sum(map(len, found)) + sum(map(len, found.values()))

    def _missing(self, words: set[bytes]) -> set[bytes]:
        """Those of ``words`` that neither generation has; the young one has the others afterwards."""
        missing = words.difference(self.young)
        old = self.old
        again = {w: old[w] for w in missing if w in old}
        self._put(again)
        missing.difference_update(again)
        return missing

    def _learn(self, words: Iterable[bytes]) -> None:
        """All of ``words`` are in the young generation afterwards."""
        if len(self.young) > self.config.cache_words or self.size > self.config.cache_bytes:
            self.old, self.young, self.size = self.young, {}, 0
        new = self._missing(set(words))
        made: list[tuple[bytes, bytes, bytes]] = []  # a word, and its start and end, whose ids one after another are the word's
        if self.plain:
            for w in new:
                core = w.rstrip(_TAIL)
                if core.isalpha():
                    core, tail = core.lower(), w[len(core) :]
                    if tail or core != w:
                        made.append((w, core, tail))
                elif core and len(core) < len(w) and (core[-1:].isalpha() or core[-1] > 127 and _LETTER.match(core.decode()[-1])):
                    made.append((w, core, w[len(core) :]))
            new.difference_update([x[0] for x in made])
            new |= self._missing({x for _, *parts in made for x in parts})
            new.discard(b"")
        self._put({b"": b""} | dict(self._encode(list(new))))
        young = self.young
        self._put({w: young[core] + young[tail] for w, core, tail in made})

    def _pieces(self, text: bytes) -> Iterator[bytes]:
        """Parts of a long text, cut at white space."""
        at = 0
        while len(text) - at > self.config.piece_bytes:
            gap = _GAP.search(text, at + self.config.piece_bytes)
            if gap is None:
                break
            yield text[at : gap.start()]
            at = gap.start()
        yield text[at:]

    def __call__(self, text: bytes) -> bytes:
        if not self.by_words:
            return self._ids([text.decode()])[0].tobytes() + self.end
        out = []
        for piece in self._pieces(text):
            words = piece.split()
            self._learn(words)
            out.append(b"".join(map(self.young.__getitem__, words)))
        return b"".join(out) + self.end

    def many(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """Of each text what a call gives; short ones are learned together."""
        group, size = [], 0
        for text in texts:
            if group and size + len(text) > self.config.group_bytes:
                yield from self._group(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        yield from self._group(group)

    def _group(self, texts: list[bytes]) -> Iterator[bytes]:
        if len(texts) < 2 or not self.by_words:
            yield from map(self, texts)
            return
        split = [text.split() for text in texts]
        self._learn(list(itertools.chain.from_iterable(split)))
        known = self.young.__getitem__
        for words in split:
            yield b"".join(map(known, words)) + self.end


@functools.lru_cache(maxsize=1)
def encoder(config: TokenConfig) -> Encoder:
    """One for each worker, whatever number of tasks it runs."""
    return Encoder(config)


_MANIFEST = "path string, size long, first_id long, first_hash long, first_tie long, documents long, ids long"


def _write(config: TokenConfig, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, first, name = None, None, f"{uuid.uuid4().hex}.sst"
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            if batch.num_rows and writer is None:
                encode = encoder(config)
                store.create_dir(root, recursive=True)
                file = store.open_output_stream(f"{root}/{name}")
                writer, first = sstable.Writer(file, encode.width), tuple(batch.column(i)[0].as_py() for i in range(3))
            if batch.num_rows:
                texts = (text.as_py() for text in batch.column(3).cast(pa.binary()))
                for doc_id, ids in zip(batch.column(0).to_pylist(), encode.many(texts), strict=True):
                    writer.add(doc_id, ids)
        if writer is not None:
            writer.close()
            file.close()
            size = store.get_file_info(f"{root}/{name}").size
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "size": [size], "first_id": pa.array([first[0]], pa.int64()), "first_hash": [first[1]], "first_tie": [first[2]], "documents": [len(writer.keys)], "ids": [writer.ids]})

    return run


def write_shards(docs: DataFrame, config: TokenConfig = TokenConfig(), id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Writes the ids of all rows; returns the manifest, one row for each shard:
    path, size, first_id, first_hash, first_tie, documents, ids, start (ids in the shards before).

    ``path``: a folder of a file system that pyarrow knows; shards and the table
    ``manifest`` stay there, and only shards that it names count.  Without one they
    are intermediate and go when the application ends.

    Order: by identifier, nulls first; rows that share it by a hash of the text, then
    by their place in the input, so that not even equal rows must lie in one shard.
    A null text is empty and has the end id alone.  Very long texts are one entry
    each.  Repeated rows are each written; an empty table gives no shard; further
    columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("tie"), text.alias("text"))
    order = ("doc_id", "hash", "tie")
    shards = -(-(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // config.shard_bytes)
    rows = rows.repartitionByRange(shards, *order) if shards > int(spark.conf.get("spark.sql.shuffle.partitions")) else rows.repartitionByRange(*order)
    written = rows.sortWithinPartitions(*order).mapInArrow(_write(config, path.rstrip("/") if path else new_dir(spark, "tokens")), _MANIFEST)
    if path:
        written.write.parquet(f"{path.rstrip('/')}/manifest")
        manifest = spark.read.schema(_MANIFEST).parquet(f"{path.rstrip('/')}/manifest")
    else:
        manifest = materialize(written, "manifest")
    first = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_hash", "first_tie")  # one row a shard
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, size, start in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            store, place = fs.FileSystem.from_uri(path)
            with store.open_input_file(place) as file:
                reader = sstable.Reader(file, size)
                out: list[tuple] = []
                for doc_id, before, ids in reader:
                    whole = np.frombuffer(ids, f"<u{reader.width}").astype("<u4").tobytes()
                    out.append((doc_id, start + before, len(whole) // 4, zlib.crc32(whole)))
                    if len(out) == 10_000:
                        yield _rows(out)
                        out = []
                yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(4)], names=names)


def read_shards(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (all long)."""
    n = max(1, manifest.count())
    return manifest.select("path", "size", "start").repartition(min(n, 10_000)).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_shards(write_shards(table(spark, sf_dir, "documents")))
