"""Removal of byte strings that occur in an earlier document, by suffix order.

Every byte covered by a ``LENGTH``-byte string that also starts in a document
with a smaller doc_id is removed; strings are judged on the input.

1. Equal texts.  All of a later copy's strings are in the first one, so copies
   are removed whole and take no further part.
2. Places.  Winnowing picks the smallest hash among the GRAM-byte strings of
   each LENGTH-byte string, so equal strings pick equal anchors.  An anchor
   that lies in one document only needs no suffixes: this drops most of the
   corpus without losing a repeated string.
3. Contexts.  Every LENGTH-byte string has one anchor, its first smallest
   gram; a repeated anchor's context is the run of the strings that have it.
   Equal contexts are one, with their first and last document.  A context that shares with no other one
   the anchor and half of the rest on either side shares no string either, so
   its own first document is that of all its strings.
4. Suffix order.  The other contexts of an anchor meet in one shard.  There the
   collection's Burrows-Wheeler transform and common-prefix array are built
   column by column (Bauer, Cox, Rosone 2013; Cox et al. 2016): each round
   inserts the next symbol, from the right, of every context at the rank that
   last-to-first mapping gives it, and updates the common prefixes on both
   sides by range minima; transform and prefixes go through sequential files.
   Runs of suffixes with common prefixes of at least LENGTH are the equal
   strings; the least document of a run is the first that holds the string.
5. Each occurrence of a context in a later document removes those strings.

An anchor may stand in a third of all documents with as many contexts.  Hot
anchors (over HOT_DOCUMENTS documents and over one in HOT_ANCHORS of all
anchors: a bounded list) go another way: their contexts are dealt to shards by
their own hash; a shard tells the first document of each string it has seen,
and these are brought together by a map-side combined minimum over strings.

Defined results: a null or empty text has no bytes; texts shorter than LENGTH
lose nothing; very long texts are whole; rows with equal doc_id are not
earlier than one another; rows with a null doc_id are neither earlier than
others nor cut; an empty table gives an empty result; extra columns are kept
by ``dedup``, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from layercake.llm.common import arrow_batches, materialize, steady, text_buffer
from layercake.llm.shingles import mix, powers

LENGTH = 50
GRAM = 20
SHARD_CONTEXTS = 4_000
HOT_DOCUMENTS = 20_000  # of an anchor: below, its contexts fit one task
HOT_ANCHORS = 1 << 18
BLOCK = 1 << 16  # bytes of text at once: the arrays over them stay in a core's cache
FLUSH = 1 << 20
STEP = 8  # of the bytes before an anchor, in telling which contexts may share a string
BROADCAST_IDS = 1_000_000
_BASE = 0xD6E8FEB86659FD93


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` over every ``width`` consecutive entries."""
    step = 1
    while 2 * step <= width:
        x = best(x[:-step], x[step:])
        step *= 2
    return x if step == width else best(x[:len(x) - (width - step)], x[width - step:])


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` consecutive bytes."""
    parts, size, have = {1: data.astype(np.uint64) + np.uint64(1)}, 1, None
    while 2 * size <= gram:
        x = parts[size]
        parts[2 * size] = x[:-size] * np.uint64(pow(_BASE, size, 1 << 64))
        parts[2 * size] += x[size:]
        size *= 2
    at = 0
    for size in sorted(parts, reverse=True):
        if gram & size:
            n = len(data) - gram + 1
            piece = parts[size][at:at + n]
            if have is None:
                have = piece
            else:
                have *= np.uint64(pow(_BASE, size, 1 << 64))
                have += piece
            at += size
    return mix(have)


def _lows(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Hash of every gram; the smallest of each string's, 0 where a string
    would cross into the next text."""
    hashes = _grams(data, gram)
    lows = _slide(hashes, length - gram + 1, np.minimum)  # of the string that starts here
    for end in offsets[1:].tolist():
        lows[max(end - length + 1, 0):end] = 0  # strings do not cross texts
    return hashes, lows


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Positions and hashes of the anchors of texts laid end to end: every
    place that has the smallest hash of a ``length``-byte string."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes, lows = _lows(data, offsets, length, gram)
    beyond = np.zeros(length - gram, np.uint64)
    # the largest low of the strings that hold this gram
    highs = _slide(np.concatenate([beyond, lows, beyond]), length - gram + 1, np.maximum)
    at = np.flatnonzero((highs == hashes) & (hashes != 0))
    return at, hashes[at]


def anchored(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Positions and hashes of the anchors, and the first and last of the
    strings whose first smallest gram each is: every string has one anchor."""
    if len(data) < length:
        return (np.empty(0, np.int64), np.empty(0, np.uint64)) + (np.empty(0, np.int64),) * 2
    hashes, lows = _lows(data, offsets, length, gram)
    window = length - gram + 1
    strings = lows != 0
    # a string has the anchor of the one before it, unless its low is another
    # or that anchor was the first gram of the one before
    heads = strings.copy()
    heads[1:] &= (lows[1:] != lows[:-1]) | (hashes[:len(lows) - 1] == lows[:-1])
    tails = strings.copy()
    tails[:-1] &= heads[1:] | ~strings[1:]
    begin, end = np.flatnonzero(heads), np.flatnonzero(tails)
    low = lows[begin]
    at = begin + window - 1  # a new least hash comes in at the end of its string
    others = np.flatnonzero((begin == 0) | (lows[begin - 1] <= low))
    grams = np.lib.stride_tricks.sliding_window_view(hashes, window)[begin[others]]
    at[others] = begin[others] + (grams == low[others][:, None]).argmax(axis=1)
    return at, low, begin, end


def _text_blocks(column: pa.Array, block: int = BLOCK):
    """(first row, bytes, offsets) of blocks of texts, one text at least."""
    data, offsets = text_buffer(column)
    s, n = 0, len(offsets) - 1
    while s < n:
        e = max(s + 1, int(np.searchsorted(offsets, offsets[s] + block, "right")) - 1)
        yield s, data[offsets[s]:offsets[e]], offsets[s:e + 1] - offsets[s]
        s = e


def suffix_groups(contexts: list[bytes], length: int, folder: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, place, group) of every ``length``-byte string in ``contexts``;
    equal strings have equal groups.  Column-wise construction, see above."""
    m = len(contexts)
    sizes = np.array([len(c) for c in contexts], np.int64)
    most = int(sizes.max(initial=0))
    # right-aligned symbols, a byte plus one (UTF-8 has no byte 255); 0: none left
    columns = np.zeros((most + 1, m), np.uint8)
    flat = np.frombuffer(b"".join(contexts), np.uint8)
    owner = np.repeat(np.arange(m), sizes)
    from_right = np.repeat(np.cumsum(sizes), sizes) - 1 - np.arange(len(flat))
    columns[from_right, owner] = flat + 1
    symbol_file, prefix_file = _File(folder, "symbols"), _File(folder, "prefixes")
    symbol_file.save(columns[0])  # before the empty suffixes stands each context's last symbol
    prefix_file.save(np.zeros(m, np.uint8))
    active, place = np.arange(m), np.arange(m)
    for column in range(1, most + 1):
        symbols, prefixes = symbol_file.load(), prefix_file.load()
        going = symbols[place] > 0
        active, place = active[going], place[going]
        if not len(active):
            break
        order = np.argsort(symbols, kind="stable")  # places by symbol: what last-to-first mapping reads
        bounds = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=256))])
        ended, own = int(bounds[1]), symbols[place].astype(np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        r = rank[place]
        has_left, has_right = r > bounds[own], r + 1 < bounds[own + 1]
        left, right = order[np.where(has_left, r - 1, r)], order[np.where(has_right, r + 1, r)]
        low = _range_minima(prefixes, np.where(has_left, left + 1, place), place)
        high = _range_minima(prefixes, np.where(has_right, place + 1, place), right)
        new = m + r - ended
        old = np.ones(len(symbols) + len(new), bool)
        old[new] = False
        next_symbols, next_prefixes = np.empty(len(old), np.uint8), np.empty(len(old), np.uint8)
        next_symbols[old], next_prefixes[old] = symbols, prefixes
        next_symbols[new] = columns[column, active]
        after = has_right.nonzero()[0]
        next_prefixes[new[after] + 1] = high[after] + 1
        next_prefixes[new] = np.where(has_left, low + 1, 0)
        symbol_file.save(next_symbols)
        prefix_file.save(next_prefixes)
        place = new
    symbols, prefixes = symbol_file.load(), prefix_file.load()
    symbol_file.file.close()
    prefix_file.file.close()
    group = np.cumsum(prefixes < length)
    # last-to-first mapping leads from each empty suffix to the longer ones
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    ended = int((symbols == 0).sum())
    who, place, found = np.arange(m), np.arange(m), []
    for size in range(1, most + 1):
        going = symbols[place] > 0
        who, place = who[going], m + rank[place[going]] - ended
        if size >= length:
            found.append((who, sizes[who] - size, group[place]))
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


class _File:
    """A sequential file of bytes, read and written whole; it only grows, so
    it is overwritten in place."""

    def __init__(self, folder: str, name: str):
        self.file = open(os.path.join(folder, name), "w+b", buffering=0)  # noqa: SIM115
        self.size = 0

    def save(self, values: np.ndarray) -> None:
        self.file.seek(0)
        self.file.write(memoryview(values))
        self.size = len(values)

    def load(self) -> np.ndarray:
        values = np.empty(self.size, np.uint8)
        self.file.seek(0)
        self.file.readinto(memoryview(values))
        return values


def _range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low..high], both included, for every pair."""
    level = np.log2(high - low + 1).astype(np.uint8)
    by, ends = np.argsort(level, kind="stable"), np.cumsum(np.bincount(level)).tolist()
    out = np.empty(len(low), values.dtype)
    table, at = values, 0
    for k, end in enumerate(ends):
        if k:
            table = np.minimum(table[:len(table) - at], table[at:])
        mine = by[ends[k - 1] if k else 0:end]
        out[mine] = np.minimum(table[low[mine]], table[high[mine] - (1 << k) + 1])
        at = 1 << k
    return out


def _anchor_rows(docs: DataFrame, buckets: int, length: int, gram: int, limit: int) -> DataFrame:
    """Documents with the hashes of their repeated anchors: doc, grams
    (several rows a document); with doc null, anchors of over ``limit`` documents."""
    names = ["bucket", "doc", "packed"]

    @steady
    def run(batches):
        held, size = [], 0

        def flush():
            gram_, doc = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((doc, gram_))
            gram_, doc = gram_[order], doc[order]
            new = np.concatenate([[True], (gram_[1:] != gram_[:-1]) | (doc[1:] != doc[:-1])])
            gram_, doc = gram_[new], doc[new]
            heads = np.flatnonzero(np.concatenate([[True], gram_[1:] != gram_[:-1]]))
            count = np.diff(np.append(heads, len(gram_)))
            # anchors of two documents here are repeated for sure: only that is
            # told on, so a bucket gets one entry of an anchor from each flush
            known = np.repeat(count > 1, count)
            yield from by_document(doc[known], gram_[known])
            bucket = ((gram_[heads] >> np.uint64(24)) % np.uint64(buckets)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            heads, count = heads[by], count[by].astype(np.uint32)
            cuts = np.cumsum(np.bincount(bucket, minlength=buckets))
            full = np.flatnonzero(np.diff(cuts, prepend=0))
            parts = [slice(int(cuts[k - 1]) if k else 0, int(cuts[k])) for k in full]
            data = [gram_[heads[p]].tobytes() + doc[heads[p]].tobytes() + count[p].tobytes() for p in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), pa.nulls(len(full), pa.int64()), pa.array(data, pa.binary())], names)

        for b in batches:
            ids = b.column(0).to_numpy()
            for first, data, offsets in _text_blocks(b.column(1)):
                at, grams = anchors(data, offsets, length, gram)
                held.append((grams, ids[first + np.searchsorted(offsets, at, "right") - 1]))
                size += len(at)
                if size > FLUSH:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    def by_document(doc, grams):
        if len(doc):
            order = np.argsort(doc, kind="stable")
            doc, grams = doc[order], grams[order]
            heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            ends = np.append(heads[1:], len(doc))
            yield pa.RecordBatch.from_arrays(
                [pa.array((doc[heads] % buckets).astype(np.int32)), pa.array(doc[heads]),
                 pa.array([grams[s:e].tobytes() for s, e in zip(heads, ends)], pa.binary())], names)

    def one(table: pa.Table) -> pa.Table:
        keep = table.column("doc").is_valid()
        out = [table.filter(keep).select(["doc", "packed"])]
        parts = [np.frombuffer(x, np.uint8) for x in table.filter(pa.compute.invert(keep)).column("packed").to_pylist()]
        if parts:
            gram_, doc, count = (np.concatenate([p[len(p) // 20 * s:len(p) // 20 * e].copy().view(t) for p in parts])
                                 for s, e, t in ((0, 8, np.uint64), (8, 16, np.int64), (16, 20, np.uint32)))
            order = np.lexsort((doc, gram_))
            gram_, doc, count = gram_[order], doc[order], count[order].astype(np.int64)
            heads = np.flatnonzero(np.concatenate([[True], gram_[1:] != gram_[:-1]]))
            ends = np.append(heads[1:], len(gram_)) - 1
            total = np.add.reduceat(count, heads)
            twice = (doc[heads] != doc[ends]) | (np.maximum.reduceat(count, heads) > 1)
            tell = np.repeat(twice, ends - heads + 1) & (count == 1)
            out += [pa.Table.from_batches([b]).select(["doc", "packed"]) for b in by_document(doc[tell], gram_[tell])]
            if (total > limit).any():
                out.append(pa.table({"doc": pa.nulls(1, pa.int64()),
                                     "packed": pa.array([gram_[heads[total > limit]].tobytes()], pa.binary())}))
        return pa.concat_tables(out).rename_columns(["doc", "grams"])

    return (docs.select("doc", "text").mapInArrow(run, "bucket int, doc long, packed binary")
            .repartition(buckets, "bucket").groupBy("bucket").applyInArrow(one, "doc long, grams binary"))


CONTEXT = "hash binary, gram long, context binary, at int, doc long, key long, start int"
SLICE = 1 << 16  # contexts told at once


def _listed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit numbers packed in a column of lists of bytes, and the row of each."""
    parts = column.flatten()
    rows = np.repeat(np.arange(len(column)), pc.list_value_length(column).to_numpy(zero_copy_only=False))
    sizes = pc.binary_length(parts).to_numpy(zero_copy_only=False)
    return np.frombuffer(b"".join(parts.to_pylist()), np.uint64), np.repeat(rows, sizes // 8)


def _cuts(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """data[begin:begin + size] for all of them."""
    ends = np.cumsum(sizes)
    bytes_ = data[np.repeat(begin - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
    bounds = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(bytes_)])


def _contexts(docs: DataFrame, length: int, gram: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """CONTEXT of every repeated anchor of ``docs`` (doc, key, text, grams),
    with bucket: by anchor, or below zero for ``hot`` anchors.  Only the latter
    are told with hash and gram; the others meet as bytes."""
    names = ["hash", "gram", "context", "at", "doc", "key", "start", "bucket"]

    @steady
    def run(batches):
        for b in batches:
            ids, keys = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            grams, owner = _listed(b.column(3))
            for first, data, offsets in _text_blocks(b.column(2)):
                at, found, begin, end = anchored(data, offsets, length, gram)
                row = np.searchsorted(offsets, at, "right") - 1
                low, high = np.searchsorted(owner, [first, first + len(offsets) - 1])
                # by anchor and row at once; where two such sums are equal by chance,
                # a context more is told, and it meets no other
                told = np.flatnonzero(np.isin(found + mix(row.astype(np.uint64)),
                                              grams[low:high] + mix((owner[low:high] - first).astype(np.uint64))))
                for k in range(0, len(told), SLICE):
                    mine = told[k:k + SLICE]
                    p, g, x, r = at[mine], found[mine], begin[mine], row[mine]
                    sizes = end[mine] + length - x
                    spread = np.isin(g, hot) if len(hot) else np.zeros(len(g), bool)
                    hashes = [None] * len(g)
                    for i in np.flatnonzero(spread).tolist():
                        # equal bytes around an anchor elsewhere in them are another context
                        hashes[i] = xxhash.xxh3_128_digest(data[x[i]:x[i] + sizes[i]].tobytes() + bytes([p[i] - x[i]]))
                    bucket = np.where(spread, -1 - x % buckets, (g % np.uint64(buckets)).astype(np.int64))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(hashes, pa.binary()), pa.array(g.view(np.int64), mask=~spread), _cuts(data, x, sizes),
                        pa.array((p - x).astype(np.int32)), pa.array(ids[first + r]), pa.array(keys[first + r]),
                        pa.array((x - offsets[r]).astype(np.int32)), pa.array(bucket.astype(np.int32))], names)

    return docs.select("doc", "key", "text", "grams").mapInArrow(run, CONTEXT + ", bucket int")


def _meet_in_bucket(length: int, gram: int):
    """All contexts of some anchors: the places they remove (doc, key, s, e);
    contexts of hot anchors pass through."""
    rest = length - gram

    def one(table: pa.Table) -> pa.Table:
        spread = pa.compute.less(table.column("bucket"), 0)
        passing = table.filter(spread).drop_columns(["bucket"])
        passing = passing.append_column("s", pa.nulls(len(passing), pa.int64())).append_column(
            "e", pa.nulls(len(passing), pa.int64()))
        table = table.filter(pa.compute.invert(spread))
        if not len(table):
            return passing
        # which context each occurrence has: equal bytes around an anchor elsewhere in them are another one
        code = table.column("context").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
        _, one_of, which = np.unique(code * length + table.column("at").to_numpy(), return_index=True, return_inverse=True)
        doc, key, start = (table.column(c).to_numpy() for c in ("doc", "key", "start"))
        m = len(one_of)
        first, last = np.full(m, np.iinfo(np.int64).max), np.full(m, np.iinfo(np.int64).min)
        np.minimum.at(first, which, doc)
        np.maximum.at(last, which, doc)
        distinct = table.take(pa.array(one_of))
        texts = distinct.column("context").combine_chunks().cast(pa.large_binary())
        sizes = pc.binary_length(texts).to_numpy()
        met = _sharing(texts, distinct.column("at").to_numpy(), sizes, rest, gram)
        meeting, alone = np.flatnonzero(met), np.flatnonzero(~met & (first < last))
        with tempfile.TemporaryDirectory(prefix="suffixes-") as folder:
            who, place, group = suffix_groups(texts.take(pa.array(meeting)).to_pylist(), length, folder)
        who = meeting[who]
        runs = _runs(who, place, _least(group, first[who]), last)
        runs = [np.concatenate(x) for x in zip(runs, (alone, np.zeros(len(alone), np.int64), sizes[alone] - length + 1,
                                                      first[alone]))]
        # every occurrence of a run's context in a later document
        order = np.argsort(which, kind="stable")
        bounds = np.searchsorted(which[order], np.arange(m + 1))
        count = bounds[runs[0] + 1] - bounds[runs[0]]
        run = np.repeat(np.arange(len(count)), count)
        at = order[np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + bounds[runs[0]][run]]
        later = doc[at] > runs[3][run]
        at, run = at[later], run[later]
        n = len(at)
        hits = pa.table({"doc": doc[at], "key": key[at], "s": start[at] + runs[1][run],
                         "e": start[at] + runs[2][run] + length - 1})
        blank = [("hash", pa.binary()), ("gram", pa.int64()), ("context", pa.binary()), ("at", pa.int32()),
                 ("start", pa.int32())]
        for name, kind in blank:
            hits = hits.append_column(name, pa.nulls(n, kind))
        return pa.concat_tables([passing, hits.select(passing.column_names)])

    return one


def _sharing(texts: pa.Array, places: np.ndarray, sizes: np.ndarray, rest: int, gram: int) -> np.ndarray:
    """Whether a context has the anchor and as much of the rest around it as a
    string has at least in common with another one.  Told by 64-bit sums of the
    bytes: two that are equal by chance go through the suffix order in vain."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    power, unit = (powers(np.uint64(x), len(data) + 1) for x in (_BASE | 1, pow(_BASE | 1, -1, 1 << 64)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1])])
    middle, out = offsets[:-1] - offsets[0] + places, np.zeros(len(texts), bool)
    for back in range(0, rest + 1, STEP):  # a string with back .. back + STEP - 1 bytes before the anchor
        past = gram + max(rest - back - STEP + 1, 0)
        mine = np.flatnonzero((places >= back) & (sizes >= places + past))
        start = middle[mine] - back
        side = (sums[middle[mine] + past] - sums[start]) * unit[start]  # where in the data they lie is taken out
        by = np.argsort(side)
        same = np.flatnonzero(side[by[1:]] == side[by[:-1]])
        out[mine[by[same]]] = out[mine[by[same + 1]]] = True
    return out


def _least(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The least value of each row's group."""
    if not len(group):
        return values
    low = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(low, group, values)
    return low[group]


def _runs(who: np.ndarray, place: np.ndarray, low: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """Contexts, places [place, past) and first documents of the runs of
    places with one first document, where a later document has the context."""
    take = low < last[who]
    who, place, low = who[take], place[take], low[take]
    order = np.lexsort((place, who))
    who, place, low = who[order], place[order], low[order]
    if not len(who):
        return [who, place, place, low]
    new = np.concatenate([[True], (who[1:] != who[:-1]) | (low[1:] != low[:-1]) | (place[1:] != place[:-1] + 1)])
    heads = np.flatnonzero(new)
    ends = np.append(heads[1:], len(who)) - 1
    return [who[heads], place[heads], place[ends] + 1, low[heads]]


def _meeting(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """hash of the contexts that may share a string with another one.

    A string holds its anchor and half of the rest on one side at least, so
    two contexts that share a string share the anchor with that many bytes
    before it, or after it.  A context that shares neither with another is a
    collection of its own: all its strings have its own first document."""
    half = (length - gram) // 2
    before = F.when(F.col("at") >= half, F.xxhash64(F.substring("context", F.col("at") - half + 1, F.lit(half + gram))))
    after = F.when(F.octet_length("context") - F.col("at") >= half + gram,
                   F.xxhash64(F.substring("context", F.col("at") + 1, F.lit(half + gram)), F.lit(1)))
    sides = (contexts.select("hash", "gram", F.explode(F.array(before, after)).alias("side")).where("side is not null"))
    twice = sides.groupBy("gram", "side").agg(F.count("*").alias("n")).where("n > 1")
    return sides.join(twice, ["gram", "side"], "left_semi").select("hash").distinct()


def _hot_hits(spark: SparkSession, occurrences: DataFrame, length: int, gram: int) -> DataFrame:
    """doc, key, s, e of what the contexts of hot anchors remove."""
    contexts = materialize(occurrences.groupBy("hash").agg(
        F.first("gram").alias("gram"), F.first("context").alias("context"), F.first("at").alias("at"),
        F.min("doc").alias("first"), F.max("doc").alias("last")), spark, "span_distinct")
    meeting = materialize(_meeting(contexts, length, gram), spark, "span_meeting")
    alone = (contexts.where("first < last").join(meeting, "hash", "left_anti")
             .select("hash", F.lit(0).alias("place"), (F.octet_length("context") - (length - 1)).alias("past"), "first"))
    shards = int(max(1, -(-meeting.count() // SHARD_CONTEXTS)))

    def one(table: pa.Table) -> pa.Table:
        texts, hashes = table.column("context").to_pylist(), table.column("hash").to_pylist()
        with tempfile.TemporaryDirectory(prefix="suffixes-") as folder:
            who, place, group = suffix_groups(texts, length, folder)
        low = _least(group, table.column("first").to_numpy()[who])
        return pa.table({
            "hash": pa.array([hashes[i] for i in who], pa.binary()), "place": pa.array(place.astype(np.int32)),
            "first": pa.array(low, pa.int64()),
            "string": pa.array([xxhash.xxh3_128_digest(texts[i][p:p + length]) for i, p in zip(who, place)], pa.binary())})

    seen = materialize(
        contexts.join(meeting, "hash", "left_semi").withColumn("shard", F.pmod(F.xxhash64("hash"), F.lit(shards)))
        .select("shard", "hash", "context", "first").repartition(shards, "shard").groupBy("shard")
        .applyInArrow(one, "hash binary, place int, first long, string binary"), spark, "span_strings")
    together = seen.groupBy("string").agg(F.min("first").alias("first"))
    runs = (seen.drop("first").join(together, "string")
            .select("hash", "place", (F.col("place") + 1).alias("past"), "first").union(alone))
    return (occurrences.select("hash", "doc", "key", "start").join(runs, "hash").where("doc > first")
            .select("doc", "key", (F.col("start") + F.col("place")).cast("long").alias("s"),
                    (F.col("start") + F.col("past") + (length - 1)).cast("long").alias("e")))


def _few(ids: DataFrame) -> DataFrame:
    """``ids`` to be broadcast while they are known to be few; else for a shuffle join."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def removals(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
             hot_documents: int = HOT_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """For ``docs`` (doc_id, text): later copies (doc, key) of equal texts of
    at least ``length`` bytes, and (doc, key, text, spans) of the other
    documents that lose bytes, spans being [start, end) in order, apart."""
    arrow_batches(spark, 2000)
    base = docs.where("doc_id is not null and octet_length(text) >= %d" % length).select(
        F.col("doc_id").alias("doc"), F.xxhash64("text").alias("key"), "text")
    named = materialize(base.select("doc", "key", F.md5("text").alias("name"), F.octet_length("text").alias("size")),
                        spark, "span_names")
    least = named.groupBy("name").agg(F.min("doc").alias("least"), F.count("*").alias("n")).where("n > 1")
    copies = materialize(named.join(least, "name").where("doc > least").select("doc", "key").distinct(), spark, "span_copies")
    own = base.join(_few(copies), ["doc", "key"], "left_anti")

    total = named.agg(F.sum("size")).first()[0] or 0
    # at most this share of all anchors can be hot, so their list may go to every task
    limit = int(max(hot_documents, total / 16 / HOT_ANCHORS))
    found = materialize(_anchor_rows(own, int(max(32, -(-total // (12 << 20)))), length, gram, limit), spark, "span_anchors")
    hot = np.sort(np.concatenate([np.empty(0, np.uint64)] + [
        np.frombuffer(r[0], np.uint64) for r in found.where("doc is null").select("grams").collect()]))
    grams = found.where("doc is not null").groupBy("doc").agg(F.collect_list("grams").alias("grams"))
    buckets = int(max(32, -(-total // (1 << 20))))
    rows = (_contexts(own.join(grams, "doc"), length, gram, buckets, hot)
            .repartition(buckets, "bucket").groupBy("bucket")
            .applyInArrow(_meet_in_bucket(length, gram), CONTEXT + ", s long, e long"))
    rows = materialize(rows, spark, "span_hits")
    hits = rows.where("hash is null").select("doc", "key", "s", "e")
    if len(hot):
        hits = hits.union(_hot_hits(spark, rows.where("hash is not null"), length, gram))
    joined = materialize(_joined_spans(hits.groupBy("doc", "key").agg(
        F.array_sort(F.collect_set(F.struct("s", "e"))).alias("hits"))), spark, "span_joined")
    # of rows that are equal in doc_id and text one is enough
    lost = base.join(_few(joined.select("doc", "key")), ["doc", "key"], "left_semi").dropDuplicates(["doc", "key"])
    return copies, lost.join(joined, ["doc", "key"])


def _joined_spans(hits: DataFrame) -> DataFrame:
    """doc, key, spans: overlapping and touching hits as maximal runs."""
    @steady
    def run(batches):
        for b in batches:
            lists = b.column(2)
            s, e = (x.to_numpy() for x in lists.flatten().flatten())
            row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
            beyond = int(e.max(initial=0)) + 1
            reach = np.maximum.accumulate(e + row * beyond) - row * beyond  # of the row's hits so far
            new = np.ones(len(s), bool)
            new[1:] = (row[1:] != row[:-1]) | (s[1:] > reach[:-1])
            heads = np.flatnonzero(new)
            spans = pa.StructArray.from_arrays([pa.array(s[heads]), pa.array(reach[np.append(heads, len(s))[1:] - 1])], ["s", "e"])
            bounds = np.searchsorted(row[heads], np.arange(len(lists) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(bounds), spans)], ["doc", "key", "spans"])

    return hits.select("doc", "key", "hits").mapInArrow(run, "doc long, key long, spans array<struct<s:long,e:long>>")


def keep(data: bytes, spans: list[dict]) -> bytes:
    """``data`` without its spans."""
    out, at = [], 0
    for x in spans:
        out.append(data[at:x["s"]])
        at = x["e"]
    return b"".join([*out, data[at:]])


def whole_characters(data: bytes, spans: list[dict]) -> list[dict]:
    """Spans made smaller to whole UTF-8 characters."""
    out = []
    for x in spans:
        s, e = x["s"], x["e"]
        while s < e and data[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(data) and data[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            out.append({"s": s, "e": e})
    return out


def digests(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    copies, cut = removals(spark, docs, length, gram)

    @steady
    def run(batches):
        for b in batches:
            rows = []
            for text, spans in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                rows.append((sum(x["e"] - x["s"] for x in spans), len(spans),
                             hashlib.sha256(keep(text.encode(), spans)).hexdigest()))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.string())], ["doc", "key", "n_removed", "n_spans", "kept_sha256"])

    cut = cut.select("doc", "key", "text", "spans").mapInArrow(
        run, "doc long, key long, n_removed long, n_spans long, kept_sha256 string")
    gone = copies.select("doc", "key", F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                         F.sha2(F.lit(b""), 256).alias("kept_sha256"))
    base = docs.select(F.col("doc_id"), F.xxhash64("text").alias("key"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("own"))
    lost = cut.union(gone).withColumnRenamed("doc", "doc_id")
    return (base.join(lost, ["doc_id", "key"], "left")
            .select("doc_id", "n_bytes",
                    F.coalesce("n_removed", F.when(F.col("n_spans") == 1, F.col("n_bytes")), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
                    F.coalesce("kept_sha256", "own").alias("kept_sha256")))


def dedup(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` without the repeated strings in text; spans are first made
    smaller to whole characters, so that text stays text.  A document of which
    nothing is left stays, with an empty text."""
    copies, cut = removals(spark, docs.select("doc_id", "text"), length, gram)

    @steady
    def run(batches):
        for b in batches:
            texts = []
            for text, spans in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                data = text.encode()
                texts.append(keep(data, whole_characters(data, spans)).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                             ["_doc", "_key", "_text"])

    cut = cut.select("doc", "key", "text", "spans").mapInArrow(run, "_doc long, _key long, _text string")
    changed = cut.union(copies.select("doc", "key", F.lit("")))
    own = docs.withColumns({"_own": F.xxhash64("text"), "_id": F.col("doc_id")})
    return (own.join(changed, (F.col("_id") == F.col("_doc")) & (F.col("_own") == F.col("_key")), "left")
            .withColumn("text", F.coalesce("_text", "text")).drop("_own", "_id", "_doc", "_key", "_text"))
