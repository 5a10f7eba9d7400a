"""Byte-level BPE as a streaming transducer, and its inverse.

Encoding.  A pre-token's bytes enter a window.  The *sufficient lookahead* of
the merge list is the number of bytes after a token's end that can still
change that token: a merge (a, b) stands or falls with an earlier merge that
takes the right end of b for itself, which in turn depends on what follows.
``lookahead`` bounds the longest such chain by one pass over the merges in
order.  Once that many bytes follow a token inside the window, the token is
stable, is emitted, and its bytes leave the window.  So a pre-token of any
length needs a window of constant size: twice the lookahead and two bytes.  At
a stable token boundary no merge crosses, hence encoding goes on from there
without memory of what came before.  The end of a pre-token makes all that is
held stable; words up to 64 characters, far below the window, are emitted there
many at once, and remembered in a cache of bounded size.

The split rule runs over a text in stretches of ``STRETCH`` characters.  A
pre-token is stable once two characters follow it (the longest the rule looks
ahead: an apostrophe and the two letters of 're), and one longer than a stretch
goes through the transducer piece by piece.  So beside the row's text itself
only ``HELD`` characters' words and their ids are in memory, however long the
text: ids go to the digests and the decoder as they come.

Decoding.  Ids become bytes, bytes become text through an incremental UTF-8
state machine that holds back an unfinished character between blocks and puts
U+FFFD for bytes that cannot be text.  An added token stands for its content.

The split rule and added tokens are those of the tokenizers file (byte-level,
``use_regex``); truncation and padding in the file are not used.

Defined results: a null or empty text has no ids and decodes to an empty text;
very long texts and words are encoded whole; repeated rows give equal results;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from layercake.llm import tokens
from layercake.llm.common import arrow_batches

CACHE_WORDS = 1_000_000
STRETCH = 1 << 16  # characters that the split rule reads at once
HELD = 1 << 22     # characters whose words are held at once
AHEAD = 2          # characters after a pre-token that may still change it


def lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a token's end that may still change it.

    chain[a]: the most bytes any merge seen so far that begins with token a
    can depend on beyond a.  A merge (a, b) needs b, and whatever an earlier
    merge could do with a right part of b."""
    right: dict[bytes, bytes] = {}
    chain: dict[bytes, int] = {}
    most = 0
    for a, b in merges:
        reach, part = 0, b
        while True:
            reach = max(reach, chain.get(part, 0))
            if part not in right:
                break
            part = right[part]
        chain[a] = max(chain.get(a, 0), len(b) + reach)
        most = max(most, chain[a])
        right.setdefault(a + b, b)
    return most


class Transducer:
    """Encoder of one tokenizer file; ``encode`` gives ids as little-endian
    unsigned 32-bit integers."""

    def __init__(self, path: str, window: int = 0, stretch: int = STRETCH):
        s = tokens.spec(path)
        model = s["model"]
        self.added = {t["content"]: t["id"] for t in s.get("added_tokens", [])}
        vocab = {tokens.token_bytes(t): i for t, i in model["vocab"].items() if t not in self.added}
        merges = [tuple(map(tokens.token_bytes, m)) for m in tokens.merge_pairs(model)]
        self.single = [vocab.get(bytes([b]), -1) for b in range(256)]
        # left id << 32 | right id -> rank; rank -> made id
        self.rank = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(merges)}
        self.made = [vocab[a + b] for a, b in merges]
        self.singles, self.made_ids = np.array(self.single, np.int64), np.array(self.made, np.int64)
        order = np.argsort(keys := np.fromiter(self.rank, np.int64, len(self.rank)))
        self.pair_keys, self.pair_ranks = keys[order], np.fromiter(self.rank.values(), np.int64, len(keys))[order]
        self.lookahead = lookahead(merges)
        self.window, self.stretch = max(window, 2 * self.lookahead + 2), stretch
        self.text = {i: t for t, i in vocab.items()} | {i: t.encode() for t, i in self.added.items()}
        self.size = {i: len(t) for i, t in self.text.items()}
        self.split = regex.compile(tokens.SPLIT)
        names = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.cache: dict[str, bytes] = {}
        top = max(self.text) + 1
        sizes = np.array([self.size.get(i, 0) for i in range(top)], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.sizes = sizes
        self.data = np.frombuffer(b"".join(self.text.get(i, b"") for i in range(top)), np.uint8)

    def merged(self, data: bytes) -> list[int]:
        """Ids of ``data`` by the merge list: always the lowest rank, leftmost first."""
        ids = [self.single[b] for b in data]
        if len(ids) > 200:
            return self._merged_long(ids)
        find, never = self.rank.get, len(self.made)
        ranks = [find(a << 32 | b, never) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < never:
            i = ranks.index(best)
            ids[i:i + 2] = [made := self.made[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = find(ids[i - 1] << 32 | made, never)
            if i < len(ranks):
                ranks[i] = find(made << 32 | ids[i + 1], never)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and links, for long windows."""
        n, find = len(ids), self.rank.get
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, p) for i, p in enumerate(a << 32 | b for a, b in zip(ids, ids[1:]))
                if (r := find(p)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, pair = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] << 32 | ids[j] != pair:
                continue
            ids[i], alive[j] = self.made[r], False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n:
                    pair = ids[x] << 32 | ids[after[x]]
                    if (r := find(pair)) is not None:
                        heapq.heappush(heap, (r, x, pair))
        return [t for t, ok in zip(ids, alive) if ok]

    def stream(self, chunks):
        """Ids of one pre-token given as byte chunks, emitted as they become stable."""
        held = b""
        for chunk in chunks:
            held += chunk
            while len(held) > self.window:
                end, done = 0, []
                for t in self.merged(held[:self.window]):
                    end += self.size[t]
                    if end > self.window - self.lookahead:
                        end -= self.size[t]
                        break
                    done.append(t)
                if not done:  # cannot be: the window holds more than one token and its lookahead
                    raise AssertionError("window below the sufficient lookahead")
                yield from done
                held = held[end:]
        yield from self.merged(held)

    def _pack(self, ids: list[int]) -> bytes:
        if min(ids, default=0) < 0:
            raise ValueError("a byte is not in the vocabulary")
        return struct.pack(f"<{len(ids)}I", *ids)

    def _slices(self, text: str, start: int, end: int) -> Iterator[bytes]:
        return (text[i:min(i + self.window, end)].encode() for i in range(start, end, self.window))

    def merged_many(self, words: list[bytes]) -> list[bytes]:
        """``merged`` for many short words at once, as little-endian ids: each
        round makes the first of the lowest-ranked merges of every word."""
        sizes = np.array([len(w) for w in words], np.int64)
        ids = self.singles[np.frombuffer(b"".join(words), np.uint8)]
        if len(ids) and ids.min() < 0:
            raise ValueError("a byte is not in the vocabulary")
        owner = np.repeat(np.arange(len(words)), sizes)
        done_ids, done_owner = [], []
        never = len(self.made)

        def rank(at):
            """Rank of the pairs (at, at + 1)."""
            out = np.full(len(at), never, np.int64)
            ok = at + 1 < len(ids)
            ok[ok] = owner[at[ok]] == owner[at[ok] + 1]
            key = ids[at[ok]] << 32 | ids[at[ok] + 1]
            place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            out[ok] = np.where(self.pair_keys[place] == key, self.pair_ranks[place], never)
            return out

        ranks = rank(np.arange(len(ids)))
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lows = np.minimum.reduceat(ranks, starts)
            count = np.diff(np.append(starts, len(ids)))
            live = np.repeat(lows < never, count)
            if not live.all():
                done_ids.append(ids[~live])
                done_owner.append(owner[~live])
                ids, owner, ranks = ids[live], owner[live], ranks[live]
                count, lows = count[lows < never], lows[lows < never]
                if not len(ids):
                    break
            hits = np.flatnonzero(ranks == np.repeat(lows, count))
            at = hits[np.concatenate([[True], owner[hits[1:]] != owner[hits[:-1]]])]
            ids[at] = self.made_ids[ranks[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))
            ids, owner, ranks = ids[keep], owner[keep], ranks[keep]
            ranks[at] = rank(at)
            before = at[at > 0] - 1
            ranks[before] = rank(before)
        if not done_ids:
            return [b""] * len(words)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        data = ids[order].astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(owner, minlength=len(words))) * 4
        return [data[s:e] for s, e in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _words(self, fresh: set[str]) -> dict[str, bytes]:
        """Ids of words that the cache does not hold; short ones enter it."""
        short = [w for w in fresh if len(w) <= 64]
        self.cache.update(zip(short, self.merged_many([w.encode() for w in short])))
        return {w: self._pack(list(self.stream(self._slices(w, 0, len(w))))) for w in fresh if len(w) > 64}

    def _plain(self, text: str, start: int, end: int) -> Iterator[list[str] | tuple[int, int]]:
        """Pre-tokens of a part of ``text`` without added tokens, a stretch at
        a time; the place of one that is longer than a stretch."""
        while start < end:
            stop = min(start + self.stretch, end)
            words = self.split.findall(text, start, stop)
            if stop == end:
                yield words
                return
            place = stop
            while words and place + AHEAD > stop:
                place -= len(words.pop())
            if words:
                yield words
            else:  # the rule covers every character, so a match starts here
                place = self.split.match(text, start, end).end()
                yield start, place
            start = place

    def _parts(self, text: str) -> Iterator[list[str] | tuple[int, int] | int]:
        """``_plain`` for a whole text, with the ids of added tokens between."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield from self._plain(text, at, m.start())
            yield self.added[m.group()]
            at = m.end()
        yield from self._plain(text, at, len(text))

    def encode_stream(self, texts: Iterable[str]) -> Iterator[tuple[int, bytes]]:
        """(number of the text, next ids of it), texts in order; a text's ids
        come in one or more pieces, none if it has none."""
        held, size = [], 0
        for i, text in enumerate(texts):
            for part in self._parts(text):
                if isinstance(part, tuple):
                    yield from self._emit(held)
                    held, size, block = [], 0, []
                    for t in self.stream(self._slices(text, *part)):
                        block.append(t)
                        if len(block) == self.stretch:
                            yield i, self._pack(block)
                            block = []
                    yield i, self._pack(block)
                    continue
                held.append((i, part))
                size += self.stretch if isinstance(part, int) else sum(map(len, part))
                if size > HELD:
                    yield from self._emit(held)
                    held, size = [], 0
        yield from self._emit(held)

    def _emit(self, held: list[tuple[int, list[str] | int]]) -> Iterator[tuple[int, bytes]]:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        known = self.cache
        fresh = {w for _, part in held if not isinstance(part, int) for w in part if w not in known}
        long = self._words(fresh)
        for i, part in held:
            if isinstance(part, int):
                yield i, struct.pack("<I", part)
            elif long:
                yield i, b"".join([long[w] if w in long else known[w] for w in part])
            else:
                yield i, b"".join(map(known.__getitem__, part))

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(ids for _, ids in self.encode_stream([text]))

    def decode(self, blocks: Iterable[np.ndarray]) -> Iterator[str]:
        """Text of ids that come in blocks, block by block."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in blocks:
            if len(ids):
                sizes = self.sizes[ids]
                ends = np.cumsum(sizes)
                places = np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends + sizes, sizes)
                yield machine.decode(self.data[places].tobytes())
        yield machine.decode(b"", final=True)


@lru_cache(2)
def load(path: str) -> Transducer:
    return Transducer(path)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    arrow_batches(docs.sparkSession)

    def digests(coder, pieces):
        """n_tokens and both digests of one text, from its ids as they come."""
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()

        def blocks():
            nonlocal n
            for _, piece in pieces:
                n += len(piece) // 4
                ids.update(piece)
                yield np.frombuffer(piece, "<u4")

        for text in coder.decode(blocks()):
            decoded.update(text.encode())
        return n, ids.hexdigest(), decoded.hexdigest()

    def run(batches):
        for b in batches:
            coder = load(tokenizer)
            rows = [digests(coder, ())] * b.num_rows
            texts = (t.as_py() or "" for t in b.column(1))
            for i, pieces in groupby(coder.encode_stream(texts), itemgetter(0)):
                rows[i] = digests(coder, pieces)
            n, a, d = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
