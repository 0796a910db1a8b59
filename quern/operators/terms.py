"""Terms of documents counted in Arrow batches: each document's counts are found where it is,
so what is shuffled are sums by term, not a row for each term of each document."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

UNITS_AT_ONCE = 1 << 20  # characters or terms that are counted together
_TABLE = 1 << 24  # numbers below this are ranked by a table, others by sorting

#: row, term, count of each different term of each row (by row), and the terms.
Counts = tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]


def _dense(keys: np.ndarray, below: int) -> tuple[int, np.ndarray]:
    """(how many different keys, the rank of each)."""
    if below > _TABLE:
        values, rank = np.unique(keys, return_inverse=True)
        return len(values), rank
    seen = np.zeros(below, bool)
    seen[keys] = True
    return int(seen.sum()), (np.cumsum(seen) - 1)[keys]


def _runs(row: np.ndarray, term: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys = np.sort(row.astype(np.int64) * max(terms, 1) + term)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    found = keys[starts]
    return found // max(terms, 1), found % max(terms, 1), np.diff(np.append(starts, len(keys)))


def char_counts(least: int, most: int) -> Callable[[pa.Array], Counts]:
    """Of texts: their windows of ``least`` to ``most`` characters."""

    def count(column: pa.Array) -> Counts:
        texts = [t or "" for t in column.to_pylist()]
        whole = "".join(texts)
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        row, end = np.repeat(np.arange(len(texts)), sizes), np.repeat(np.cumsum(sizes), sizes)
        letters, letter = _dense(codes, 0x110000)
        at, rank, ranks = np.arange(len(codes)), letter, letters
        found, names, known = [], [], 0
        for n in range(1, most + 1):
            if n > 1:
                fits = at + n <= end[at]
                at, rank = at[fits], rank[fits]
                ranks, rank = _dense(rank * letters + letter[at + n - 1], ranks * letters)
            if n >= least:
                first = np.zeros(ranks, np.int64)
                first[rank[::-1]] = at[::-1]
                names += [whole[i : i + n] for i in first.tolist()]
                own = _runs(row[at], rank, ranks)
                found.append((own[0], own[1] + known, own[2]))
                known += ranks
        row, term, count = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(row, kind="stable")
        return row[order], term[order], count[order], pa.array(names, pa.string())

    return count


def list_counts(column: pa.Array) -> Counts:
    """Of lists of terms."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    coded = column.flatten().dictionary_encode()
    terms = coded.dictionary
    return *_runs(np.repeat(np.arange(len(column)), sizes), coded.indices.to_numpy(zero_copy_only=False), len(terms)), terms


def _pieces(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Batches of some UNITS_AT_ONCE at most, one row at least."""
    for batch in batches:
        column = batch.column(at)
        size = pa.compute.binary_length(column) if pa.types.is_string(column.type) else pa.compute.list_value_length(column)
        ends = np.cumsum(pa.compute.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + UNITS_AT_ONCE, "right")))
            yield batch.slice(first, last - first)
            first = last


def frequencies(count: Callable[[pa.Array], Counts]):
    """group, term, df, total of the rows (group, text or terms) of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, 1):
            row, term, tf, terms = count(piece.column(1))
            groups = piece.column(0).dictionary_encode(null_encoding="encode")
            key = groups.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row] * max(len(terms), 1) + term
            kept, place, df = np.unique(key, return_inverse=True, return_counts=True)
            total = np.bincount(place, tf, len(kept)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([groups.dictionary.take(pa.array(kept // max(len(terms), 1))), terms.take(pa.array(kept % max(len(terms), 1))), pa.array(df, pa.int64()), pa.array(total)], names=["group", "term", "df", "total"])

    return run


def weighted(count: Callable[[pa.Array], Counts], shared, sublinear: bool):
    """The rows (group, text or terms, further columns) with vector in place of the second:
    term and weight, by term, of length 1; empty where no term is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, 1):
            row, term, tf, terms = count(piece.column(1))
            groups = piece.column(0).dictionary_encode(null_encoding="encode")
            group = groups.indices.to_numpy(zero_copy_only=False)[row]
            parts = []
            for i, name in enumerate(groups.dictionary.to_pylist()):
                if name in shared.value:
                    known, idf = shared.value[name]
                    own = np.flatnonzero(group == i) if len(groups.dictionary) > 1 else np.arange(len(row))
                    place = pa.compute.fill_null(pa.compute.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)[term[own]]
                    own, place = own[place >= 0], place[place >= 0]
                    times = 1 + np.log(tf[own]) if sublinear else tf[own].astype(np.float64)
                    parts.append((row[own], place, times * idf[place], term[own]))
            row, place, weight, term = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 4
            order = np.lexsort((place, row))  # the terms that are known are in order
            row, weight = row[order], weight[order].astype(np.float64)
            norm = np.sqrt(np.bincount(row, weight * weight, piece.num_rows))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=piece.num_rows))])
            items = pa.StructArray.from_arrays([terms.take(pa.array(term[order].astype(np.int64))), pa.array(weight / norm[row])], names=["term", "weight"])
            vector = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)
            yield pa.RecordBatch.from_arrays([piece.column(0), vector, *piece.columns[2:]], names=[piece.schema.names[0], "vector", *piece.schema.names[2:]])

    return run
