"""Each operator against a brute-force version on small, odd tables."""

import hashlib
import math
import os
import random
import re
import tempfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row, functions as F

from layercake.llm import (bpe, graph_search, html_text, jaccard_join, line_dedup, packing, span_dedup, token_files,
                           tokens, toxicity, vector_dedup)
from layercake.llm.queries import tokenizer_path
from layercake.session import materialize, shared_root

SCHEMA = "doc_id long, text string, bucket int, hash string"  # the last two clash with inner names


def _texts(seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(60, 160))) for _ in range(12)]
    out = list(base)
    for i in range(40):
        w = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(w))
    passage = " ".join(rng.choices(words, k=30))
    out += [" ".join(rng.choices(words, k=40)) + " " + passage + " " + " ".join(rng.choices(words, k=40)) for _ in range(8)]
    out += [base[0], base[0], "", None, "one", "One", "a b c d", "a b c d e", "x" * 3000, "ab " * 900, "é" * 200 + "😀",
            " \t\n", "a<|endoftext|>b", "\n".join(["l1", "l2", "l3", "l4"] * 3), "l2\nl3\nl4\nz"]
    return out


def _docs(spark):
    return spark.createDataFrame([(i * 3, t, i, "h") for i, t in enumerate(_texts())], SCHEMA)


def _rows(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select(*columns).collect()}


def _components(n, pairs):
    parent = dict(zip(n, n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in n}


def _shingles(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("classes", [1 << 20, 4])
def test_jaccard_join(spark, monkeypatch, classes):
    # few classes and a low bound make most shingles frequent: combinations carry the join
    monkeypatch.setattr(jaccard_join, "CLASSES", classes)
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", 3 if classes == 4 else 50)
    docs = _docs(spark)
    got = _rows(jaccard_join.join(spark, docs), "doc_id", "n_shingles", "component_id")
    sets = {i * 3: _shingles(t) for i, t in enumerate(_texts())}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    parts = _components(list(sets), pairs)
    assert got == {i: (len(sets[i]), parts[i]) for i in sets}


def test_jaccard_join_of_a_set_that_is_not_its_documents_largest(spark):
    same = " ".join(f"w{i}" for i in range(60))
    rows = [(1, same), (1, " ".join(f"v{i}" for i in range(90))), (5, same), (9, same + " more"), (12, "other words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = {(r["doc_id"], r["component_id"]) for r in jaccard_join.join(spark, docs).collect()}
    assert out == {(1, 1), (5, 5), (9, 5), (12, 12)}


def test_combinations_share_a_signature():
    """Sets at the threshold share a signature, whichever tokens are frequent."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(2, 60))
        both = rng.integers(1, 1 << 62, n).astype(np.uint64)
        a = np.unique(np.concatenate([both, rng.integers(1, 1 << 62, int(rng.integers(0, n // 3 + 1))).astype(np.uint64)]))
        b = np.unique(both[int(rng.integers(0, n // 4 + 1)):])
        same = len(np.intersect1d(a, b))
        if len(b) < 1 or 100 * same < 75 * (len(a) + len(b) - same) or np.array_equal(a, b):
            continue
        frequent = np.unique(rng.permutation(np.union1d(a, b))[:int(rng.integers(0, n + 1))])
        (ra, _, ca), (rb, _, cb) = (jaccard_join.signatures(x, frequent) for x in (a, b))
        assert len(np.intersect1d(ra, rb)) or len(np.intersect1d(ca, cb))
        assert jaccard_join.may_link(jaccard_join.bitmap(a), jaccard_join.bitmap(b), len(a), len(b))


@pytest.mark.parametrize("hot", [20_000, 2])
def test_span_dedup(spark, monkeypatch, hot):
    real = span_dedup.removals
    monkeypatch.setattr(span_dedup, "removals", lambda s, d, n=50, g=20: real(s, d, n, g, hot_documents=hot))
    docs = _docs(spark)
    got = _rows(span_dedup.digests(spark, docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    seen, kept = set(), {}
    for i, t in enumerate(_texts()):
        b = (t or "").encode()
        own = {b[k:k + 50] for k in range(len(b) - 49)}
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 49):
            if b[k:k + 50] in seen:
                gone[k:k + 50] = True
        seen |= own
        kept[i * 3] = bytes(c for c, g in zip(b, gone) if not g)
        spans = int((gone[1:] < gone[:-1]).sum())
        assert got[i * 3] == (len(b), int(gone.sum()), spans, hashlib.sha256(kept[i * 3]).hexdigest()), i
    if hot > 2:
        out = span_dedup.dedup(spark, docs)
        assert out.columns == docs.columns
        texts = _rows(out, "doc_id", "text")
        assert all(k not in texts or (texts[k][0] or "").isascii() is False or (texts[k][0] or "").encode() == v
                   for k, v in kept.items())


def test_span_contexts_travel_as_bytes(spark):
    """Every context is cut where its anchor stands; only those of hot anchors carry hash and gram."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcde ") for _ in range(n)) for n in (50, 400, 49, 1000)]
    listed = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        found = span_dedup.anchored(data, np.array([0, len(data)]))[1]
        listed.append([found[:2].tobytes(), found[2:].tobytes()])
    hot = np.sort(np.frombuffer(listed[1][0], np.uint64))
    frame = spark.createDataFrame([(i, i + 7, t, [bytearray(x) for x in g]) for i, (t, g) in enumerate(zip(texts, listed))],
                                  "doc long, key long, text string, grams array<binary>")
    rows = span_dedup._contexts(frame, 50, 20, 5, hot).collect()
    strings = Counter()
    for r in rows:
        text = texts[r["doc"]].encode()
        assert r["key"] == r["doc"] + 7 and r["at"] + 20 <= len(r["context"])
        assert text[r["start"]:r["start"] + len(r["context"])] == r["context"]
        assert (r["hash"] is None) == (r["gram"] is None) == (r["bucket"] >= 0)
        strings.update((r["doc"], r["start"] + k) for k in range(len(r["context"]) - 49))
    assert strings == Counter((i, k) for i, t in enumerate(texts) for k in range(len(t) - 49))
    assert sum(r["hash"] is not None for r in rows) == 2


def test_span_anchors_one_for_every_string():
    """A string's anchor is its first smallest gram, across ties, runs of one byte and text ends."""
    rng = random.Random(4)
    texts = ["a" * 90, "ab" * 60, "", "b" * 49, *("".join(rng.choice("ab") for _ in range(rng.randint(0, 300))) for _ in range(40))]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    found = {}
    for at, hash_, first, last in zip(*(x.tolist() for x in span_dedup.anchored(data, offsets))):
        found |= dict.fromkeys(range(first, last + 1), (at, hash_))
    hashes, want = span_dedup._grams(data, 20).tolist(), {}
    for s, e in zip(offsets.tolist(), offsets[1:].tolist()):
        for k in range(s, e - 49):
            at = min(range(k, k + 31), key=lambda p: (hashes[p], p))
            want[k] = at, hashes[at]
    assert found == want
    assert {*span_dedup.anchors(data, offsets)[0].tolist()} >= {at for at, _ in want.values()}


def test_span_contexts_that_share_a_string_are_told():
    rng = random.Random(5)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(50, 80))) for _ in range(60)]
    texts += [t[:rng.randint(50, len(t))] for t in texts[:20]]
    places = [rng.randint(0, 30) for _ in texts[:60]]
    places = np.array(places + places[:20])
    sides = {}
    for i, (t, p) in enumerate(zip(texts, places.tolist())):
        for back in range(0, 31, span_dedup.STEP):
            past = p + 20 + max(30 - back - span_dedup.STEP + 1, 0)
            if p >= back and len(t) >= past:
                sides.setdefault((back, t[p - back:past]), []).append(i)
    want = {i for group in sides.values() if len(group) > 1 for i in group}
    column = pa.array([b"left out", *texts], pa.large_binary())[1:]
    got = span_dedup._sharing(column, places, np.array([len(t) for t in texts]), 30, 20)
    assert 0 < len(want) < len(texts) and {*np.flatnonzero(got).tolist()} == want


def test_span_hits_are_joined_a_batch_at_once(spark):
    rng = random.Random(6)
    rows = [(d, d % 7, [(s, s + rng.randint(1, 9)) for s in sorted(rng.sample(range(200), rng.randint(1, 30)))]) for d in range(300)]
    frame = spark.createDataFrame(rows, "doc long, key long, hits array<struct<s:long,e:long>>")
    want = {}
    for d, _, hits in rows:
        cover = {x for s, e in hits for x in range(s, e)}
        starts = [x for x in sorted(cover) if x - 1 not in cover]
        want[d] = [(s, next(x for x in range(s, 300) if x not in cover)) for s in starts]
    got = {r["doc"]: [(x["s"], x["e"]) for x in r["spans"]] for r in span_dedup._joined_spans(frame).collect()}
    assert got == want


def test_suffix_groups():
    rng = random.Random(1)
    for _ in range(30):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 12))]
        with tempfile.TemporaryDirectory() as folder:
            who, place, group = span_dedup.suffix_groups(texts, 4, folder)
        strings = {}
        for w, p, g in zip(who, place, group):
            strings.setdefault(g, set()).add(texts[w][p:p + 4])
        assert {*zip(who.tolist(), place.tolist())} == {(i, k) for i, t in enumerate(texts) for k in range(len(t) - 3)}
        assert all(len(s) == 1 for s in strings.values())
        assert len(strings) == len({t[k:k + 4] for t in texts for k in range(len(t) - 3)})


def test_line_dedup(spark):
    docs = _docs(spark)
    out = line_dedup.dedup(docs)
    assert out.columns == [*docs.columns, "n_lines_before", "n_lines_removed"]
    got = _rows(out, "doc_id", "text")
    seen = {}
    for i, t in enumerate(_texts()):
        if t is None:
            assert got[i * 3] == (None,)
            continue
        lines, gone = t.split("\n"), set()
        for k in range(len(lines) - 2):
            if seen.setdefault(tuple(lines[k:k + 3]), (i, k)) != (i, k):
                gone |= {k, k + 1, k + 2}
        assert got[i * 3] == ("\n".join(x for k, x in enumerate(lines) if k not in gone),)


def test_token_files(spark, tmp_path):
    docs = _docs(spark)
    manifest = token_files.write(spark, docs.repartition(5), str(tmp_path / "t"), tokenizer_path(), frame_ids=500)
    got = _rows(token_files.read_index(manifest), "doc_id", "start", "n_tokens", "ids_crc32")
    library, start, want = tokens.load(tokenizer_path()).library, 0, {}
    for i, t in enumerate(_texts()):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want[i * 3] = ids
        assert got[i * 3] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    some = token_files.fetch(manifest, spark.createDataFrame([(6,), (9,), (-1,)], "doc_id long"))
    assert _rows(some, "doc_id", "ids") == {6: (want[6],), 9: (want[9],)}
    path = manifest.first()["path"].removeprefix("file:")
    data = bytearray(open(path, "rb").read())
    data[20] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception):  # noqa: B017 - the checksum, or the decompressor before it
        token_files.read_index(manifest).collect()


def test_token_files_of_repeated_and_null_doc_ids(spark, tmp_path):
    rows = [(None, "b c"), (3, "x"), (None, "a"), (3, "x"), (3, "longer text"), (None, None), (0, "zero")]
    manifest = token_files.write(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "t"),
                                 tokenizer_path())
    library = tokens.load(tokenizer_path()).library
    crc = lambda t: zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
    got = sorted(token_files.read_index(manifest).collect(), key=lambda r: r["start"])
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["ids_crc32"]) for r in got) == sorted(
        (d is not None, d or 0, crc(t)) for d, t in rows)
    assert [r["doc_id"] for r in got] == [None, None, None, 0, 3, 3, 3]  # null first
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))
    some = token_files.fetch(manifest, spark.createDataFrame([(0,), (None,)], "doc_id long")).collect()
    assert [(r["doc_id"], r["ids"][-1]) for r in some] == [(0, 2)]


def test_packing(spark):
    docs = _docs(spark)
    rows = packing.pack(spark, packing.pieces(docs, tokenizer_path(), capacity=256), capacity=256).collect()
    library = tokens.load(tokenizer_path()).library
    own, places = {}, {}
    for r in rows:
        own.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in enumerate(_texts()):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for k, r in enumerate(sorted(own[i * 3], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at) and (k == 0 or r["length"] == 256)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and len(own[i * 3]) == -(-len(ids) // 256)
    for p in places.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:k]) for k in range(len(p))] and sum(n for _, n in p) <= 256


def test_packing_is_dense():
    rng = np.random.default_rng(1)
    lengths = np.minimum(2048, np.maximum(1, rng.lognormal(6, 1.2, 100_000).astype(int)))
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    runs, n = packing.plan(counts, 2048)
    used = np.zeros(n, np.int64)
    for length, _, c, first, offset in runs:
        used[first:first + c] += length
    assert used.max() <= 2048 and runs[:, 2].sum() == len(lengths) and n <= 1.005 * lengths.sum() / 2048


def test_bpe(spark):
    docs = _docs(spark)
    got = _rows(bpe.round_trip(docs, tokenizer_path()), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    library = tokens.load(tokenizer_path()).library
    for i, t in enumerate(_texts()):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[i * 3] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                              hashlib.sha256(text.encode()).hexdigest())


def test_transducer_needs_no_more_than_its_window():
    coder = bpe.Transducer(tokenizer_path(), window=1)
    rng = random.Random(3)
    for alphabet in ("ab", "the", "=-", "abcdefghijklmnopqrstuvwxyz", "é😀a"):
        data = "".join(rng.choice(alphabet) for _ in range(5000)).encode()
        chunks = (data[i:i + 700] for i in range(0, len(data), 700))
        assert list(coder.stream(chunks)) == coder.merged(data)


@pytest.mark.parametrize("stretch", [1, 5, 7, 64])
def test_split_rule_in_stretches(stretch):
    coder, library = bpe.Transducer(tokenizer_path(), stretch=stretch), tokens.load(tokenizer_path()).library
    rng = random.Random(stretch)
    parts = ["'re", "'ve", "'", "'s", " ", "  ", "   ", "\n", "\t", "the", "a", "12", "999999", "!!", "!'", "é", "😀", "'ll",
             "<|endoftext|>", "<|endof", "x" * 40, " " * 30, "'l", "l", "e", "=-" * 20, "日本語"]
    for _ in range(300):
        text = "".join(rng.choices(parts, k=rng.randint(0, 40)))
        ids = np.frombuffer(coder.encode(text), "<u4")
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        at = rng.randint(0, len(ids))
        assert "".join(coder.decode([ids[:at], ids[at:]])) == library.decode(want, skip_special_tokens=False)


def test_bpe_streams_words_longer_than_window_and_stretch(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdefghij", k=bpe.STRETCH + 5000)) + "<|endoftext|> end",
             "a " + "é" * (2 * bpe.STRETCH) + "'re", " " * (bpe.STRETCH + 3) + "x", "=" * 3000 + " b", None, "", "one"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(6, "one"), (None, "two")], "doc_id long, text string")
    library = tokens.load(tokenizer_path()).library
    want = []
    for i, t in [*enumerate(texts), (6, "one"), (None, "two")]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = [tuple(r) for r in bpe.round_trip(docs, tokenizer_path()).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


VECTORS = [[1.0, 0.0, 0.0], [1.0, 0.0, 0.0], [0.99, 0.05, 0.0], [0.0, 1.0, 0.0], None, [0.0, 0.0, 0.0],
           [float("nan"), 1.0, 0.0], [None, 1.0, 0.0], [float("inf"), 0.0, 0.0], [], [2.0, 0.0, 0.0], [1.0, 0.0]]


def _vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((30, 3))
    more = np.concatenate([base, base[:20] + 0.1 * rng.standard_normal((20, 3))]).tolist()
    return [(i, v, 1, "x") for i, v in enumerate(VECTORS + more)], "vec_id long, embedding array<float>, label int, rep string"


def _usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_vector_dedup(spark):
    rows, schema = _vectors(spark)
    got = _rows(vector_dedup.dedup(spark, spark.createDataFrame(rows, schema), block_dim=1, tile_rows=8),
                "vec_id", "n_links", "component_id", "kept")
    good = {i: np.array(v, np.float32).astype(float) for i, v, *_ in rows if _usable(v)}
    pairs = [(a, b) for a in good for b in good if a != b and len(good[a]) == len(good[b])
             and good[a] @ good[b] >= 0.95 * np.linalg.norm(good[a]) * np.linalg.norm(good[b])]
    parts = _components([r[0] for r in rows], pairs)
    for i, *_ in rows:
        assert got[i] == (sum(a == i for a, _ in pairs), parts[i], parts[i] == i), i


def test_vector_dedup_settles_dense_clusters(spark):
    rng = np.random.default_rng(5)
    heart, ring = rng.standard_normal((2, 64))
    spread = np.concatenate([np.full(150, 0.02), np.full(60, 0.22), np.full(40, 0.3)])
    rows = [heart + s * rng.standard_normal(64) for s in spread] + [ring + 0.25 * rng.standard_normal(64) for _ in range(60)]
    rows += [rows[3]] * 4 + list(rng.standard_normal((40, 64)))
    x = np.array(rows, np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist(), i, "x") for i, v in enumerate(x)],
                               "vec_id long, embedding array<float>, size int, rep string")
    c = (x @ x.T) / np.linalg.norm(x, axis=1) / np.linalg.norm(x, axis=1)[:, None]
    linked = c >= 0.95
    np.fill_diagonal(linked, False)
    parts = _components(range(len(x)), list(zip(*np.nonzero(linked))))
    for tile in (4096, 32):
        got = _rows(vector_dedup.dedup(spark, df, tile_rows=tile), "vec_id", "n_links", "component_id", "kept")
        assert got == {i: (int(linked[i].sum()), parts[i], parts[i] == i) for i in range(len(x))}
    usable = df.select(F.col("vec_id").alias("rep"), "embedding").dropDuplicates(["embedding"])
    pairs = {(r["a"], r["b"]) for r in vector_dedup.links(spark, usable).collect()}
    kept = [r["rep"] for r in usable.collect()]
    assert pairs == {(a, b) for a in kept for b in kept if a < b and linked[a, b]}
    # the 150 vectors around one point make 11,175 pairs, and few rows
    heart_rows = vector_dedup.meetings(spark, usable.withColumn("size", F.lit(1).cast("long")).where("rep < 150"))
    assert heart_rows.where("n is null").count() == 0 and heart_rows.count() <= 150 * 8


def _size(*folders):
    return sum(os.path.getsize(os.path.join(d, f)) for folder in folders for d, _, files in os.walk(folder) for f in files)


def test_vector_dedup_disk_grows_with_the_vectors(spark):
    """Not with the tiles that meet: 3,000 vectors in tiles of 50 are written and sent a few times over."""
    x = np.random.default_rng(8).standard_normal((3000, 64)).astype(np.float32)
    vectors = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "rep long, size long, embedding array<float>")
    vectors = materialize(vectors, spark, "test_vectors")
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    folders = [shared_root(spark).removeprefix("file:"), *(d.getPath() for d in local)]
    before = _size(*folders)
    assert vector_dedup.meetings(spark, vectors, tile_rows=50).count() == 0
    assert _size(*folders) - before <= 4 * x.nbytes


def test_vector_dedup_over_tiles_and_lengths(spark):
    """Crowded cells, uneven components, lengths beyond those that are turned to
    their own components, zeros of both signs, extreme values: by brute force."""
    rng = np.random.default_rng(9)
    rows = []
    for dim in (2, 40, 300):
        centres = rng.standard_normal((6, dim)) * rng.choice([0.1, 1, 4], dim) + 1
        near = centres[rng.integers(0, 6, 150)]
        rows += list(near + rng.choice([0.05, 0.2, 0.4], (150, 1)) * rng.standard_normal((150, dim)) * np.abs(near))
    rows += [[0.0, 1.0], [-0.0, 1.0], [0.0, 1e-200], [-1e200, 0.0]]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    unit = [np.array(v) / np.abs(v).max() for v in rows]
    unit = [v / np.linalg.norm(v) for v in unit]
    linked = [[i != j and len(u) == len(v) and bool(u @ v >= 0.95) for j, v in enumerate(unit)] for i, u in enumerate(unit)]
    parts = _components(range(len(rows)), [(i, j) for i, line in enumerate(linked) for j, x in enumerate(line) if x])
    got = _rows(vector_dedup.dedup(spark, df, block_dim=3, tile_rows=40), "vec_id", "n_links", "component_id", "kept")
    assert got == {i: (sum(linked[i]), parts[i], parts[i] == i) for i in range(len(rows))}
    assert 0 < sum(map(sum, linked)) < len(rows) ** 2 / 3


def test_vector_dedup_of_null_and_repeated_vec_ids(spark):
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (3, [1.0, 0.02]), (None, None)]
    out = vector_dedup.dedup(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(out) == len(rows)
    assert all(r["component_id"] == 1 for r in out if r["vec_id"] is not None)
    assert all(r["n_links"] == 0 and r["kept"] for r in out if r["vec_id"] is None)
    assert {r["n_links"] for r in out if r["vec_id"] == 1} == {3}


def test_graph_search(spark):
    rows, schema = _vectors(spark)
    out = graph_search.nearest(spark, spark.createDataFrame(rows, schema), F.col("vec_id") % 5 == 0, k=4).collect()
    good = {i: np.array(v, np.float32).astype(float) for i, v, *_ in rows if _usable(v)}
    got = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == {i for i in good if i % 5 == 0}
    for q, ids in got.items():  # so few vectors that the search is exact
        near = sorted((-(good[q] @ good[i]), i) for i in good if i != q and len(good[i]) == len(good[q]))
        assert ids == [i for _, i in near[:4]]


def test_graph_recall():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 32))
    up = graph_search.lifted(x)
    graph, entry = graph_search.build(up)
    q = x[:200]
    ids, _ = graph_search.beam_search(up, (up * up).sum(1), graph.astype(np.int64), entry,
                                      np.c_[q, np.zeros(200)].astype(np.float32), 128)
    true = np.argsort(-(q @ x.T), 1)[:, :20]
    assert np.mean([len({*a} & {*b}) / 20 for a, b in zip(true.tolist(), ids.tolist())]) > 0.95


@pytest.mark.parametrize("norm", [1, 1e4, 1e6])
def test_graph_search_beside_a_long_vector(spark, norm):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[7] *= norm
    x = x.astype(np.float32)
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = {}
    for r in graph_search.nearest(spark, vectors, F.col("vec_id") % 30 == 0, k=20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    scores = x.astype(float) @ x.astype(float).T
    np.fill_diagonal(scores, -np.inf)
    assert np.mean([len(got[q] & {*np.argsort(-scores[q])[:20].tolist()}) / 20 for q in range(0, 3000, 30)]) > 0.95


def test_html(spark):
    page = ("<html><head><title>t</title></head><body><nav><a>menu</a></nav><div class=ad>buy</div><article><h1>A&amp;B</h1>"
            "<p>x <b>y</b>z<br>w<p>a&nbsp;b<script>if (a</p>) {}</script></article><div id=comments>no</div><footer>f</footer>")
    bare = "<body><div class=x><p>%s</p></div><div class=y>same words</div></body>"
    rows = [(0, "http://a.example/1", page), (1, "http://a.example/2", None), (2, None, ""), (3, "::", "<p>open <i>end"),
            *((10 + k, "http://b.example/%d" % k, bare % f"text {k}") for k in range(8)), (30, "x", "a < b <!-- c"),
            (31, "http://c.example", "<div>" * 3000 + "deep")]
    got = _rows(html_text.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")),
                "page_id", "text", "n_chars")
    assert got[0] == ("A&B x yz w a b", 14) and got[1] == ("", 0) and got[2] == ("", 0) and got[3] == ("open end", 8)
    assert all(got[10 + k][0] == f"text {k}" for k in range(8))  # the site's repeated block goes
    assert got[30][0] == "a < b" and got[31][0] == "deep"


@pytest.mark.parametrize("url", ["http://my_site.example.com/%d", "http://h.example/a b%d", "HTTP://u:p@H.example:80/x|%d",
                                 "http://h.example/?q={%d}", "https://h.example/%%zz%d", "http://[::1]:8/%d"])
def test_html_tree_of_odd_urls(spark, url):
    page = "<body><div class=x><p>text %d</p></div><div class=y>same words</div></body>"
    rows = [(k, url % k, page % k, "clash", k) for k in range(8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, noise int")
    assert _rows(html_text.extract(spark, df), "page_id", "text") == {k: (f"text {k}",) for k in range(8)}


def test_html_hosts(spark):
    urls = {"http://A.b/c": "a.b", "https://u@h:1?x": "h", "http:///x": None, "::": None, "": None, None: None,
            "ftp://h#f": "h", "//h/x": None, "mailto:a@b": None}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r[0]: r[1] for r in df.select("url", html_text.host_of()).collect()} == urls


def test_html_style_tree_against_brute_force(spark):
    rng = random.Random(2)
    menu = "<ul><li>home</li><li>news</li></ul>"
    pages = []
    for k in range(40):
        body = "".join(f"<p>{rng.choice(['shared', f'own {k}', f'pair {k // 2}'])} {i % 3}</p>" for i in range(rng.randrange(1, 5)))
        pages.append((f"http://h{k % 2}.example/{k}", f"<body>{menu}<div class=c>{body}</div><i>by {k % 3}</i></body>"))
    pages += pages[:6]
    got = {(r["host"], r["node"]): (r["pages"], r["importance"]) for r in
           html_text.style_tree(spark.createDataFrame(pages, "url string, html string")).collect()}
    seen = {}
    for url, source in pages:
        page, host = html_text.Page(source), url.split("/")[2]
        blocks = [(b[1][1], html_text._key(2, b[0]), len(b[0])) for b in html_text.candidates(page)[0] if b[1]]
        around = html_text._surroundings(blocks)
        for node, style in page.styles.items():
            if node:
                seen.setdefault((host, node), (set(), set()))[0].add((style, repr(blocks)))
        for node, block, _ in blocks:
            seen.setdefault((host, node), (set(), set()))[1].add((block, around[node]))

    def value(items):
        counts = list(Counter(v for v, _ in items).values())
        m = sum(counts)
        entropy = -sum(n / m * math.log(n / m) for n in counts)  # of the node's places over its values
        return m, entropy / math.log(m) if m > 1 else 1.0

    assert got.keys() == seen.keys() and len(got) > 8
    for key, (styles, blocks) in seen.items():
        style, content = value(styles)[1] if styles else None, value(blocks)[1] if blocks else None
        importance = 1.0 if content is None else (content + max(content, style if style is not None else content)) / 2
        assert got[key] == (max(len(styles), len(blocks)), pytest.approx(importance)), key


def _main_texts(spark, pages):
    rows = [(k, f"http://h.example/{k}", p) for k, p in enumerate(pages)]
    out = _rows(html_text.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id", "text")
    return [out[k][0] for k in range(len(pages))]


def test_html_copies_are_no_menu(spark):
    page = "<body><div class=date>May</div>%s<div class=y>same words</div></body>"
    five = ["".join(f"<p>{name} paragraph {i}</p>" for i in range(5)) for name in ["copy", *(f"own {k}" for k in range(100))]]
    own = [f"<div class=by>writer {k}</div>{x}" for k, x in enumerate(five[1:])]
    texts = _main_texts(spark, [page % x for x in [five[0]] * 900 + own])
    assert all(f"copy paragraph {i}" in texts[0] for i in range(5)) and len({*texts[:900]}) == 1
    assert all(f"own {k} paragraph {i}" in texts[900 + k] for k in range(100) for i in range(5))
    assert not any("same words" in t for t in texts[900:])
    near = [five[0].replace("paragraph 3", f"paragraph 3 edit {k}") for k in range(200)]
    texts = _main_texts(spark, [page % x for x in near + own])
    assert all(f"copy paragraph 3 edit {k}" in t and "copy paragraph 4" in t for k, t in enumerate(texts[:200]))


def test_html_tree_judges_articles(spark):
    page = ("<body><article><h1>Title %d</h1><p>text of page %d</p><div class=x><p>Read more with our plan</p></div>"
            "<p>end %d</p></article><p>outside</p></body>")
    texts = _main_texts(spark, [page % (k, k, k) for k in range(12)])
    assert texts == [f"Title {k} text of page {k} end {k}" for k in range(12)]
    story = "".join(f"<p>sentence {i} {'of the same story ' * 5}</p>" for i in range(8))
    texts = _main_texts(spark, [f"<article><h1>Edition {k}</h1>{story}</article>" for k in range(200)])
    assert all(t.startswith(f"Edition {k} sentence 0") and "sentence 7" in t for k, t in enumerate(texts))


@pytest.mark.parametrize("page", [
    '<article class="post has-comments"><p>long text</p></article>',
    '<p>May</p><div class="container no-sidebar"><article><p>long text</p><div class=ad>buy</div></article></div>',
    '<p>May</p><div id="page" class="header-fixed"><main><p>long text</p></main><div id=comments>no</div></div>',
    '<form action="x"><nav>menu</nav><article><p>long text</p></article><div class="sidebar">s</div></form>',
    '<form><p>long text</p><div class="widget">w</div></form>',
    '<div id="page" class="header-fixed"><p>long text</p><div class=ad>buy</div></div>',
    '<article><p>long text</p></article><div class=related><article><p>a teaser of another page</p></article></div>',
    '<div><p>long text</p></div><div id=comments><article class=comment><p>a longer comment on it</p></article></div>',
    '<div class="noSidebar"><p>long text</p></div><div class="cookie-banner">c</div>'])
def test_html_listed_words_on_wrappers(page):
    text = html_text.main_text(f"<html><body>{page}<footer>f</footer></body></html>")
    assert text == "long text"


def test_toxicity(spark):
    rng = random.Random(4)
    plain = ["".join(rng.choice("bcdfghklmn") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        words, bad = rng.choices(plain, k=30), i % 6 == 0
        for _ in range(3 * bad):
            words[rng.randrange(30)] = rng.choice(["zorgish", "Zorg1sh", "wrexxer", "wrеxxer"])
        rows.append((i, " ".join(words), i, "x"))
        labels.append((i, int(bad)))
    rows += [(700, None, 0, "x"), (701, "", 0, "x"), (702, "zorgish " * 5000, 0, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(spark, docs, marked, ~toxicity.held_out())
    out = toxicity.score(docs, model)
    assert out.columns == [*docs.columns, "score"]
    got = _rows(out, "doc_id", "score")
    right = [(got[i][0] >= 0.5) == bool(y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean(right) > 0.97
    assert got[700] == got[701] and got[700][0] < 0.5 < got[702][0]
    none = toxicity.fit(spark, docs, marked.where("toxic = 0"))
    assert toxicity.score(docs, none).select("score").distinct().count() == 1
    phrase = toxicity.Matcher(toxicity.Lexicon({"trash ": 1.0}, (0, 0, 0)))
    assert phrase.weigh("the trash can")[0] == 0 and phrase.weigh("tra5h!")[0] == 1


def test_toxicity_readings_of_signs():
    words = toxicity.Matcher(toxicity.Lexicon({"idiot ": 1.0, "stupid ": 1.0, "trash ": 1.0}, (0, 0, 0)))
    for text, weight, count in (("idiot!stupid", 2, 2), ("id!ot", 1, 1), ("1d10t!stup1d", 2, 2), ("x idiot4stupid", 2, 3),
                                ("mp3player", 0, 1), ("trash!can", 0, 1), ("!!!", 0, 0), ("", 0, 0)):
        assert words.weigh(text) == (weight, count), text
    for long in ("1" * 300_000, "a" * 300_000, "a1" * 100_000, "idiot " * 50_000 + "trash can " * 20_000):
        assert words.weigh(long)[0] == 50_000 * long.startswith("idiot")


def test_toxicity_against_plain_matching(spark):
    """Weights and scores of a second matcher, without automaton, word by word."""
    rng = random.Random(8)
    weights, exceptions = {"bad ": 1.5, "ba": 0.5, "rude": 2.0, "vile ": 3.0}, ("bad luck", "rude awakening call")
    lexicon = toxicity.Lexicon(weights, (-2.0, 0.7, 0.4), exceptions)
    some = ["bad", "b4d", "BAD", "bat", "rudely", "rude", "vile", "viler", "luck", "awakening", "call", "x", "bаd", "-", "9"]
    texts = [" ".join(rng.choices(some, k=rng.randrange(25))) for _ in range(300)]

    def plain(text):
        words = toxicity._WORD.findall(toxicity.fold(text))
        out, total = set(), 0.0
        for phrase in exceptions:
            p = phrase.split()
            out.update(k + n for k in range(len(words)) if words[k:k + len(p)] == p for n in range(len(p)))
        for k, w in enumerate(words):
            fits = [e for e in weights if (w + " ").startswith(e)]
            if fits and k not in out:
                total += weights[max(fits, key=len)]
        return total, len(words)

    got = _rows(toxicity.score(spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], SCHEMA), lexicon),
                "doc_id", "score")
    for i, text in enumerate(texts):
        w, n = plain(text)
        assert toxicity.Matcher(lexicon).weigh(text) == (pytest.approx(w), n)
        z = -2 + 0.7 * math.log1p(w) + 0.4 * math.log1p(100 * w / max(n, 1))
        assert got[i][0] == pytest.approx(1 / (1 + math.exp(-z)))


def test_toxicity_learns_exceptions(spark):
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, f"zorg you w{i} zorg" if bad else f"zorg beetle w{i}" if i % 40 == 1 else f"plain words w{i}", i, "x"))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.fit(spark, docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "zorg beetle" in model.exceptions and "zorg you" not in model.exceptions
    got = _rows(toxicity.score(docs, model), "doc_id", "score")
    assert all((got[i][0] >= 0.5) == bool(y) for i, y in labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = tokenizer_path()
    for out in (jaccard_join.join(spark, docs), span_dedup.digests(spark, docs), span_dedup.dedup(spark, docs),
                line_dedup.dedup(docs), bpe.round_trip(docs, path), packing.pack(spark, packing.pieces(docs, path)),
                token_files.read_index(token_files.write(spark, docs, token_files.token_folder(spark), path)),
                vector_dedup.dedup(spark, vectors), graph_search.nearest(spark, vectors, F.lit(True)),
                html_text.extract(spark, pages), toxicity.score(docs, toxicity.fit(spark, docs, labels))):
        assert out.count() == 0


def test_pipeline_is_its_stages_chained(spark, tmp_path):
    """The stages of a run against brute force: texts after each, pieces at the end."""
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(6)
    own = [" ".join(rng.choices(["zorgish", "wrexxer", "plain", "some", "thing", "other", "word", "here"], k=40))
           for _ in range(60)]
    clean = [" ".join(rng.choices(["plain", "some", "thing", "other", "word", "here"], k=40)) for _ in range(240)]
    texts = [*_texts(), *clean, *own]
    docs = spark.createDataFrame(
        [Row(doc_id=i * 3, text=t, lang="en", source="s", n_chars=len(t or "")) for i, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i * 3, 1, int(i >= len(texts) - 60)) for i in range(len(texts))],
                                   "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = pipeline.run(spark, str(tmp_path)).collect()

    lexicon = toxicity.fit(spark, docs, labels, ~toxicity.held_out())
    toxic = {r["doc_id"] for r in toxicity.score(docs, lexicon).where("score >= 0.5").collect()}
    assert toxic == {i * 3 for i in range(len(texts) - 60, len(texts))}
    left = {i * 3: t for i, t in enumerate(texts) if i * 3 not in toxic}
    seen = {}
    for d, t in left.items():
        lines, gone = [] if t is None else t.split("\n"), set()
        for k in range(len(lines) - 2):
            if seen.setdefault(tuple(lines[k:k + 3]), (d, k)) != (d, k):
                gone |= {k, k + 1, k + 2}
        left[d] = None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    sets = {d: _shingles(t) for d, t in left.items()}
    parts = _components(list(sets), [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
                                     and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])])
    left = {d: t for d, t in left.items() if parts[d] == d}
    known = set()
    for d, t in left.items():
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 49):
            if b[k:k + 50] in known:
                gone[k:k + 50] = True
        known |= {b[k:k + 50] for k in range(len(b) - 49)}
        at, kept = 0, []
        for c in t or "":
            size = len(c.encode())
            if not gone[at:at + size].all():
                kept.append(c)
            at += size
        left[d] = "".join(kept)
    library = tokens.load(tokenizer_path()).library
    got = {}
    for r in sorted(out, key=lambda r: (r["doc_id"], r["piece"])):
        got.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    want = {}
    for d, t in left.items():
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want[d] = [(s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())) for s in range(0, len(ids), 2048)]
    assert got == want
    places = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in places.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:k]) for k in range(len(p))] and sum(n for _, n in p) <= 2048


def test_pipeline(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.createDataFrame(
        [Row(doc_id=i * 3, text=t, lang="en", source="s", n_chars=len(t or "")) for i, t in enumerate(_texts())],
        "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_jaccard", "suffix_dedup", "packing"]
    out = pipeline.run(spark, str(tmp_path)).collect()
    sets = {i * 3: _shingles(t) for i, t in enumerate(_texts())}
    assert {r["doc_id"] for r in out} < set(sets) and 3 * (len(_texts()) - 1) in {r["doc_id"] for r in out}
    assert 0 in {r["doc_id"] for r in out} and 3 * 60 not in {r["doc_id"] for r in out}  # a copy of the first
