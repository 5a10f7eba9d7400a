"""Phrase index, mask search and prefix trie against brute force on small, odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from layercake.llm import mask_search, phrase_index, postings, prefix_trie

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id string, uid int, terms int"       # the last three clash with inner names
DOCS = "doc_id long, text string, item_id int, uids string, window string"


def _terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]


def _corpus(seed=3):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß9") for _ in range(rng.randint(1, 13))) for _ in range(60)]
    passage = rng.choices(vocab, k=26)
    items = [" ".join(passage), " ".join(passage), " ".join(rng.choices(vocab, k=14)).upper(), "one Two", "", None, "!?",
             " ".join(rng.choices(vocab, k=120)), "aa aa aa aa aa aa aa aa aa aa aa aa", "x" * 700]
    docs = [" ".join(rng.choices(vocab, k=rng.randint(0, 90))) for _ in range(60)]
    for i in range(0, 60, 4):
        docs[i] += ", " + "-".join(passage[:rng.randint(8, 26)]) + ". " + docs[i + 1]
    docs += [items[2].lower(), "ONE\x00two", "one (two) three", None, "", "...", "aa " * 40, "x" * 700, "x" * 701, docs[0], docs[0],
             items[7]] + [items[7]] * 14
    return docs, items


def _frames(spark, extra=()):
    docs, items = _corpus()
    d = [(i * 3 if i != 5 else None, t, i, "u", "w") for i, t in enumerate(docs)] + list(extra)
    d.append((9, docs[3], 0, "u", "w"))  # a doc_id that comes twice
    it = [(i + 8 if i != 6 else None, t, "d", i, i) for i, t in enumerate(items)]
    it.append((8, items[0], "d", 0, 0))  # an item that comes twice
    return d, it, spark.createDataFrame(d, DOCS).repartition(3), spark.createDataFrame(it, ITEMS)


def _phrases(d, it, n=10):
    found = []
    for doc_id, text, *_ in d:
        w, hit, who = _terms(text), set(), set()
        for item_id, t, *_ in it:
            q = _terms(t)
            for k in range(max(len(q) - n + 1, min(len(q), 1))):
                g = q[k:k + n]
                for i in range(len(w) - len(g) + 1):
                    if w[i:i + len(g)] == g:
                        hit |= set(range(i, i + len(g)))
                        who |= {str(item_id)} - {"None"}
        found.append((doc_id, len(w), tuple(sorted(hit)), tuple(sorted(who))))
    return Counter(found)


@pytest.mark.parametrize("small", [False, True])
def test_phrases(spark, monkeypatch, small):
    if small:  # several blocks of windows and of documents, and slices of one candidate
        monkeypatch.setattr(phrase_index, "WINDOWS", 12)
        monkeypatch.setattr(phrase_index, "CANDIDATES", 1)
        real = postings.build
        monkeypatch.setattr(postings, "build", lambda s, x: real(s, x, words=64, documents=3))
    d, it, docs, items = _frames(spark)
    got = phrase_index.decontaminate(spark, docs, items).collect()
    assert Counter((r.doc_id, r.n_words, tuple(x for s in r.spans for x in range(s.begins, s.ends)), tuple(r.item_ids))
                   for r in got) == _phrases(d, it)
    assert sum(bool(r.spans) for r in got) > 15
    for r in got:
        assert all(a.ends < b.begins for a, b in zip(r.spans, r.spans[1:]))


def test_phrases_of_empty_tables(spark):
    _, _, docs, items = _frames(spark)
    assert phrase_index.decontaminate(spark, docs.limit(0), items).count() == 0
    out = phrase_index.decontaminate(spark, docs, items.limit(0))
    assert out.count() == docs.count() and out.where("size(spans) + size(item_ids) > 0").count() == 0


def test_proximity(spark):
    d, it, docs, items = _frames(spark)
    n, span = 4, 9
    got = {r.doc_id: set(r.item_ids) for r in
           phrase_index.matches(spark, postings.build(spark, docs), items, n, span).collect() if r.doc_id not in (None, 9)}
    wanted = defaultdict(set)
    for doc_id, text, *_ in d:
        w = _terms(text)
        runs = [set(w[i:i + span]) for i in range(max(len(w) - span + 1, min(len(w), 1)))]
        for item_id, t, *_ in it:
            q = _terms(t)
            grams = [set(q[k:k + n]) for k in range(max(len(q) - n + 1, min(len(q), 1)))]
            if item_id is not None and any(g <= r for g in grams for r in runs):
                wanted[doc_id].add(str(item_id))
    assert got == {k: v for k, v in wanted.items() if k not in (None, 9)}


def test_terms_in_slices(monkeypatch):
    docs, _ = _corpus()
    texts = docs + ["é" * 2000, "ab " * 500 + "c" * 900 + " d"]
    whole = [t.tolist() for t in postings.terms_of(pa.array(texts))]
    monkeypatch.setattr(postings, "SLICE", 64)
    assert [t.tolist() for t in postings.terms_of(pa.array(texts))] == whole
    assert [len(t) for t in whole] == [len(_terms(t)) for t in texts]
    names = {}
    for t, numbers in zip(texts, whole):
        for w, x in zip(_terms(t), numbers):
            assert names.setdefault(w, x) == x
    assert len(set(names.values())) == len(names)


def _ranks(d, it, k=10):
    texts = [(doc_id, _terms(t)) for doc_id, t, *_ in d]
    tfs = [Counter(w) for _, w in texts]
    n_docs, n_terms = sum(bool(w) for _, w in texts), sum(len(w) for _, w in texts)
    df = Counter(t for tf in tfs for t in tf)
    out = []
    for item_id, t, *_ in it:
        scores = []
        for (doc_id, w), tf in zip(texts, tfs):
            m = 25 + (75 * len(w) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    * ((1000000000 * tf[x]) // (1000 * tf[x] + 8 * m)) for x in _terms(t))
            if s > 0:
                scores.append((-s, doc_id is not None, doc_id or 0))
        out += [(item_id, i + 1, x if there else None, -s) for i, (s, there, x) in enumerate(sorted(scores)[:k])]
    return Counter(out)


@pytest.mark.parametrize("small", [False, True])
def test_mask_search(spark, monkeypatch, small):
    build = postings.build
    if small:  # several blocks of items, parts of an item each, blocks of three documents
        monkeypatch.setattr(mask_search, "TERMS", 40)
        monkeypatch.setattr(mask_search, "CELLS", 1)
        build = lambda s, x: postings.build(s, x, words=64, documents=3)
    d, it, docs, items = _frames(spark)
    got = mask_search.search(spark, build(spark, docs), items).collect()
    assert Counter(tuple(r) for r in got) == _ranks(d, it)
    assert max(len(_terms(t)) for _, t, *_ in it) > 64  # masks of more than one word


def test_mask_search_of_empty_tables(spark):
    _, _, docs, items = _frames(spark)
    assert mask_search.search(spark, postings.build(spark, docs.limit(0)), items).count() == 0
    assert mask_search.search(spark, postings.build(spark, docs.where("text is null")), items).count() == 0
    assert mask_search.search(spark, postings.build(spark, docs), items.limit(0)).count() == 0


def test_masks_group_by_presence():
    rng = np.random.default_rng(1)
    for terms in (3, 64, 65, 130):
        present = rng.random((40, terms)) < 0.05
        distinct, group = mask_search.masks(present)
        assert (distinct[group] == present).all() and len(np.unique(present, axis=0)) == len(distinct)


CONVS = "conv_id long, turn long, role string, text string, depth int, words string, p0 int"


def _conversations():
    rng, rows = random.Random(2), []
    say = ["hello there", "yes  no", "", None, "a\tb\nc", "why"]
    for c in range(0, 140):
        if c in (40, 63):
            continue
        for t in range(rng.choice([1, 1, 2, 3, 4, 7])):
            rows.append((c, t, rng.choice(["user", None]), say[0] if t == 0 else rng.choice(say)))
    rows += [(500, t, "user", f"long {t % 7}") for t in range(90)]                      # a long conversation, and copies of its prefixes
    rows += [(501 + i, t, "user", f"long {t % 7}") for i in range(30) for t in range(3 * i + 1)]
    rows += [(600 + i, 0, "user", "same") for i in range(50)] + [(600 + i, 1, "bot", "same") for i in range(50)]
    rows += [(700, None, "user", "first"), (700, None, "user", "first"), (700, 3, "b", "tie"), (700, 3, "a", "tie"), (None, 1, "user", "x")]
    return [(*r, 1, "w", 2) for r in rows]


def _nodes(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            said = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, said, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    members, kept = defaultdict(list), {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        kept[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
        for d in range(len(kept[c]) + 1):
            members[tuple(kept[c][:d])].append(c)
    children, out = Counter(k[:-1] for k in members if k), {}
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * words
            leaves[k[:d]] += not children[k]
    for k, m in members.items():
        ended = ",".join(str(c) for c in m if len(kept[c]) == len(k))
        out[(m[0], len(k))] = (members[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k],
                               hashlib.sha256(ended.encode()).hexdigest())
    return out


@pytest.mark.parametrize("rows", [None, 100, 4, 1])
def test_prefix_trie(spark, monkeypatch, rows):
    if rows == 4:  # queues that spill, ids in many texts
        monkeypatch.setattr(prefix_trie, "IDS", 2)
    table = _conversations()
    conversations = spark.createDataFrame(table, CONVS).repartition(3)
    turns, convs = prefix_trie.rebuild(spark, prefix_trie.turns(conversations))
    at = prefix_trie.prefixes(spark, turns, convs)
    ended = prefix_trie.end_digests(prefix_trie.ends(at, convs))
    nodes = prefix_trie.trie(spark, at, convs, rows)
    empty = hashlib.sha256(b"").hexdigest()
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved, r.digest or empty)
           for r in nodes.join(ended, prefix_trie.PREFIX, "left").collect()}
    wanted = _nodes(table)
    assert got == wanted and nodes.count() == len(wanted)
    if rows is None:
        said = prefix_trie.node_turns(nodes, turns)
        assert said.count() == len(wanted) and said.where("depth > 0 and said is null").count() == 0


def test_prefix_trie_of_nothing(spark):
    nothing = spark.createDataFrame([(None, 1, "user", "x", 1, "w", 2)], CONVS)
    turns, convs = prefix_trie.rebuild(spark, prefix_trie.turns(nothing))
    at = prefix_trie.prefixes(spark, turns, convs)
    assert prefix_trie.trie(spark, at, convs).count() == 0
    assert prefix_trie.end_digests(prefix_trie.ends(at, convs)).count() == 0


def test_queue_spills():
    rng = random.Random(4)
    for limit in (1, 2, 7, 1000):
        queue, sums = prefix_trie.Queue(limit), defaultdict(lambda: [0, 0, 0])
        for depth in range(9, 0, -1):  # messages to the level above, read in order
            for conv in range(60):
                assert list(queue.take(depth, conv)) == sums[depth, conv]
                for _ in range(rng.randint(0, 3)):
                    to = (depth - 1, rng.randrange(60))
                    m = [1, rng.randint(0, 9), rng.randint(0, 9)]
                    queue.push((-to[0], to[1], *m))
                    sums[to] = [a + b for a, b in zip(sums[to], m)]
