"""N-gram Jaccard self-join with token-combination prefixes (pkwise, Wang et
al. 2016, for whole sets).

A document's tokens are its distinct five-word shingles.  Shingles in very
many documents form the frequent class, all others the rare class; tokens are
ordered rare first, each class by hash.  Two sets that differ in at most d
tokens share a signature if each indexes a prefix of its tokens in which

    (rare tokens) + sum over groups of (frequent tokens - 1)  >=  d + 1:

rare tokens are signatures themselves; frequent ones fall into groups by hash,
and every two of a group that are in the prefix form a signature, so the
prefix is extended for them.  A frequent passage thus proposes only pairs that
share two of its tokens, and only for documents that have not enough rare ones.
Groups depend on the set's size class; a set signs for each class that a
partner's size can have.

Which shingles are frequent follows from counts over all documents: a chunk
reports shingles above its share, sums above one in ``CLASSES`` of all tokens
are frequent.  There are at most ``CLASSES`` of them, whatever the corpus, so
they may be sent to every task, and the posting list of a rare shingle stays
below two such shares.

Links.  Documents with equal sets are one node from the start.  Postings of
rare tokens travel as packed arrays by hash bucket; combinations as rows.
Each signature first proposes its members' links to its smallest member only
(a map-side combined minimum), what is proposed is pruned by parity bitmaps (a
lower bound of the symmetric difference), and the rest verified on the sets
themselves.  That settles large groups of near copies.  Then every pair of
members that share a signature and are still in different components is
proposed, pruned and verified likewise, so no link between different
components is lost.

Defined results: texts without words, empty or null, have size 0 and link with
nothing; fewer than five words are one shingle; very long texts are whole;
equal texts link; ``doc_id`` is taken as key (rows with equal doc_id and equal
words are one document, with different words each the larger set counts); rows
with null doc_id are kept, with component null; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from layercake.llm.common import arrow_batches, connected_components, materialize, steady
from layercake.llm.shingles import mix, shingle_sets

CLASSES = 1 << 20
LEAST_FREQUENT = 50
CHUNK = 1 << 21  # tokens of a count chunk
FLUSH = 1 << 20  # postings packed at a time
BROADCAST_IDS = 1_000_000
PERCENT = 75


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the tokens falling on each bit; about one bit a token, a power of two."""
    bits = 64 << max(0, int(len(tokens) - 1).bit_length() - 6)
    counts = np.bincount((tokens >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def _folded(a: np.ndarray, size: int) -> np.ndarray:
    """A parity bitmap folded to ``size`` bytes (bits fall where a smaller one puts them)."""
    while len(a) > size:
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return a


def may_link(a: bytes, b: bytes, na: int, nb: int, percent: int = PERCENT) -> bool:
    """False only if the sets cannot link."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    differ = int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())
    # symmetric difference D, intersection (na + nb - D) / 2, union (na + nb + D) / 2
    return 100 * (na + nb - differ) >= percent * (na + nb + differ)


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int = PERCENT):
    """Rare signatures with their places in the order, and combinations, of a sorted token set."""
    n = len(tokens)
    none = np.empty(0, np.uint64)
    if n < 2:  # one token: only an equal set can link, and that is one node already
        return none, np.empty(0, np.int32), none
    differ = n - -(-percent * n // 100)
    common = np.zeros(n, bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        common = frequent[at] == tokens
    rare = tokens[~common][:differ + 1]
    places = np.arange(len(rare), dtype=np.int32)
    need = differ + 1 - len(rare)
    if need <= 0:
        return rare, places, none
    usual = tokens[common]
    out = []
    for level in {(-(-percent * n // 100)).bit_length(), n.bit_length(), (100 * n // percent).bit_length()}:
        groups = max(1, (1 << level - 1) // 4)
        group = mix(usual * np.uint64(3)) % np.uint64(groups)
        _, first = np.unique(group, return_index=True)
        repeat = np.ones(len(usual), bool)
        repeat[first] = False
        end = int(np.searchsorted(np.cumsum(repeat), need)) + 1
        if end > len(usual):
            raise AssertionError("prefix cannot be extended far enough")
        order = np.argsort(group[:end], kind="stable")
        g, t = group[:end][order], usual[:end][order]
        step = 1
        while True:
            pair = np.flatnonzero(g[step:] == g[:-step]) if step < end else none
            if not len(pair):
                break
            out.append(mix(mix(t[pair] + np.uint64(level)) * np.uint64(5) + t[pair + step]))
            step += 1
    return rare, places, np.concatenate(out) if out else none


def _documents(docs: DataFrame, words: int) -> DataFrame:
    """Rows of kind 0: doc_id, n, key, bits; of kind 1: token counts of a chunk (token in doc_id, count in n)."""
    names = ["kind", "doc_id", "n", "key", "bits"]

    @steady
    def run(batches):
        held, size = [], 0

        def counts():
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            cut = max(1, size // CLASSES)
            often = n > cut
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(often.sum(), np.int32)), pa.array(tokens[often].view(np.int64)),
                 pa.array(n[often].astype(np.int64)), pa.nulls(often.sum(), pa.binary()),
                 pa.nulls(often.sum(), pa.binary())], names)

        for b in batches:
            sizes, keys, bits = [], [], []
            for _, tokens in shingle_sets(b.column(1), words):
                sizes.append(len(tokens))
                keys.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                bits.append(bitmap(tokens) if len(tokens) else b"")
                held.append(tokens)
                size += len(tokens)
                if size > CHUNK:
                    yield counts()
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(sizes), np.int32)), b.column(0), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(bits, pa.binary())], names)
        if held:
            yield counts()

    return docs.select("doc_id", "text").mapInArrow(run, "kind int, doc_id long, n long, key binary, bits binary")


def _postings(docs: DataFrame, words: int, frequent: np.ndarray, buckets: int, percent: int) -> DataFrame:
    """Packed postings of rare signatures by bucket, and rows (bucket -1) of combinations."""
    names = ["bucket", "signature", "doc_id", "n", "packed"]

    @steady
    def run(batches):
        held, size, seen = [], 0, set()

        def packed():
            sig, doc, n, place = (np.concatenate(c) for c in zip(*held))
            held.clear()
            bucket = ((sig >> np.uint64(24)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            sig, doc, n, place = sig[order], doc[order], n[order], place[order]
            ends = np.cumsum(np.bincount(bucket, minlength=buckets))
            full = np.flatnonzero(np.diff(ends, prepend=0))
            parts = [slice(int(ends[k - 1]) if k else 0, int(ends[k])) for k in full]
            # one column after the other: equal and near numbers side by side compress well
            data = [sig[p].tobytes() + doc[p].tobytes() + n[p].tobytes() + place[p].tobytes() for p in parts]
            k = len(full)
            return pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                 pa.nulls(k, pa.int32()), pa.array(data, pa.binary())], names)

        for b in batches:
            ids = b.column(0).to_pylist()
            for row, tokens in shingle_sets(b.column(1), words):
                if ids[row] is None or len(tokens) < 2:
                    continue
                key = xxhash.xxh3_128_digest(tokens.tobytes())
                if key in seen:  # an equal set of this flush stands for it
                    continue
                seen.add(key)
                rare, places, pairs = signatures(tokens, frequent, percent)
                if len(rare):
                    k = len(rare)
                    held.append((rare, np.full(k, ids[row], np.int64), np.full(k, len(tokens), np.int32), places))
                    size += k
                if len(pairs):
                    k = len(pairs)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, -1, np.int32)), pa.array(pairs.view(np.int64)),
                         pa.array(np.full(k, ids[row], np.int64)), pa.array(np.full(k, len(tokens), np.int32)),
                         pa.nulls(k, pa.binary())], names)
                if size > FLUSH:
                    yield packed()
                    held, size, seen = [], 0, set()
        if held:
            yield packed()

    return docs.select("doc_id", "text").mapInArrow(
        run, "bucket int, signature long, doc_id long, n int, packed binary")


def _shared(packed: DataFrame) -> DataFrame:
    """signature, doc_id, n, place of the postings whose signature has two documents."""
    def one(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint8) for x in table.column("packed").to_pylist()]
        cut = lambda p, s, e, t: p[len(p) // 24 * s:len(p) // 24 * e].view(t)
        sig, doc, n, place = (np.concatenate([cut(p, s, e, t).copy() for p in parts]) for s, e, t in (
            (0, 8, np.uint64), (8, 16, np.int64), (16, 20, np.int32), (20, 24, np.int32)))
        order = np.argsort(sig, kind="stable")
        ordered = sig[order]
        twin = np.zeros(len(sig), bool)
        twin[1:] = ordered[1:] == ordered[:-1]
        twin[:-1] |= twin[1:]
        keep = order[twin]
        return pa.table({"signature": sig[keep].view(np.int64), "doc_id": doc[keep], "n": n[keep], "place": place[keep]})

    return (packed.where("bucket >= 0").select("bucket", "packed").groupBy("bucket")
            .applyInArrow(one, "signature long, doc_id long, n int, place int"))


def _near(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` with a doc_id in ``ids``: by a broadcast while the ids
    are known to be few, by a shuffle join beyond."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def _verified(spark: SparkSession, docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int,
              percent: int) -> DataFrame:
    """Those of the proposed ``pairs`` (a, b: doc_ids of nodes) that link."""
    bits = nodes.select("doc_id", "n", "bits")
    sided = (pairs.join(bits.toDF("a", "na", "bits_a"), "a").join(bits.toDF("b", "nb", "bits_b"), "b")
             .select("a", "b", "na", "nb", "bits_a", "bits_b"))

    @steady
    def prune(batches):
        for batch in batches:
            a, b = (c.to_pylist() for c in batch.columns[4:])
            na, nb = (c.to_pylist() for c in batch.columns[2:4])
            keep = pa.array([may_link(*x, percent) for x in zip(a, b, na, nb)], pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in batch.columns[:2]], ["a", "b"])

    pairs = materialize(sided.mapInArrow(prune, "a long, b long"), spark, "jaccard_pruned")
    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), spark, "jaccard_ids")

    @steady
    def sets(batches):
        for batch in batches:
            got = [t.tobytes() for _, t in shingle_sets(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary())], ["doc_id", "tokens"])

    # of rows with one doc_id the largest set, as in the nodes
    tokens = (_near(docs.select("doc_id", "text"), ids).mapInArrow(sets, "doc_id long, tokens binary")
              .groupBy("doc_id").agg(F.max_by("tokens", F.struct(F.length("tokens"), "tokens")).alias("tokens")))
    tokens = materialize(tokens, spark, "jaccard_sets")
    both = (pairs.join(tokens.toDF("a", "ta"), "a").join(tokens.toDF("b", "tb"), "b").select("a", "b", "ta", "tb"))

    @steady
    def verify(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(u) > len(v):
                    u, v = v, u
                at = np.minimum(np.searchsorted(v, u), len(v) - 1)
                same = int((v[at] == u).sum())
                keep.append(100 * same >= percent * (len(u) + len(v) - same))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in batch.columns[:2]], ["a", "b"])

    return materialize(both.mapInArrow(verify, "a long, b long"), spark, "jaccard_links")


def _block_pairs(spark: SparkSession, members: DataFrame, nodes: DataFrame, percent: int,
                 block: int = 1024) -> DataFrame:
    """Pairs (a, b) of ``members`` (signature, node, part) in one group and
    different parts that the bitmaps allow to link.

    Near copies share most of their signatures, so signatures with the same
    smallest node are one group: its pairs are tested once, not once for each
    signature.  Groups are dealt to blocks of bounded size, and two blocks at
    a time are compared, so neither a group nor its pairs are ever held whole
    and only pairs that pass are emitted."""
    heads = members.groupBy("signature").agg(F.min("node").alias("head"))
    grouped = materialize(members.join(heads, "signature").select("head", "node", "part").distinct(), spark,
                          "jaccard_groups")
    sizes = (grouped.groupBy("head").agg(F.count("*").alias("c"), F.min("part").alias("low"), F.max("part").alias("high"))
             .where("low <> high").select("head", F.ceil(F.col("c") / block).cast("int").alias("blocks")))
    rows = (grouped.join(sizes, "head").join(nodes.toDF("node", "n", "bits"), "node")
            .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
            .select("head", "block", "blocks", "node", "part", "n", "bits"))

    lists = [F.collect_list(F.struct("node", "part", "n", "bits")).alias("rows"), F.first("blocks").alias("blocks")]
    packed = materialize(rows.groupBy("head", "block").agg(*lists).select(  # of about ``block`` rows each
        "head", "block", "blocks", *[F.col(f"rows.{c}").alias(c) for c in ("node", "part", "n", "bits")]), spark, "jaccard_blocks")
    other = packed.select("head", F.col("block").alias("block2"),
                          *[F.col(c).alias(f"{c}2") for c in ("node", "part", "n", "bits")])
    work = (packed.withColumn("block2", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)))
            .join(other, ["head", "block2"]).select("node", "part", "n", "bits", "node2", "part2", "n2", "bits2"))

    def sides(node: list, part: list, n: list, bits: list):
        """(node, part, n, bitmaps) for each bitmap size of a block."""
        node, part, n = (np.array(x, np.int64) for x in (node, part, n))
        size = np.array([len(x) for x in bits], np.int64)
        ends = np.cumsum(size)
        data = np.frombuffer(b"".join(bits), np.uint8)
        for s in np.unique(size):
            at = np.flatnonzero(size == s)
            yield node[at], part[at], n[at], data[(ends[at] - s)[:, None] + np.arange(s)]

    def fold(x: np.ndarray, size: int) -> np.ndarray:
        while x.shape[1] > size:
            x = x[:, :x.shape[1] // 2] ^ x[:, x.shape[1] // 2:]
        return np.ascontiguousarray(x).view(np.uint64)

    @steady
    def meet(batches):
        for batch in batches:
            for pair in zip(*(c.to_pylist() for c in batch.columns)):
                for va, pa_, na, xa in sides(*pair[:4]):
                    for vb, pb, nb, xb in sides(*pair[4:]):
                        if 100 * min(na.max(), nb.max()) < percent * max(na.min(), nb.min()):
                            continue
                        size = min(xa.shape[1], xb.shape[1])
                        fa, fb = fold(xa, size), fold(xb, size)
                        step = max(1, (1 << 22) // (fb.size + 1))
                        for s in range(0, len(va), step):
                            p = slice(s, s + step)
                            differ = np.bitwise_count(fa[p, None, :] ^ fb[None, :, :]).sum(2, dtype=np.int64)
                            both = na[p, None] + nb[None, :]
                            ok = ((pa_[p, None] != pb[None, :])
                                  & (100 * np.minimum(na[p, None], nb) >= percent * np.maximum(na[p, None], nb))
                                  & (100 * (both - differ) >= percent * (both + differ)))
                            i, j = np.nonzero(ok)
                            if not len(i):
                                continue
                            x, y = va[i + s], vb[j]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    arrow_batches(spark, 64)
    return work.repartition(max(2, 2 * spark.sparkContext.defaultParallelism)).mapInArrow(meet, "a long, b long")


def join(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document in ``docs`` (doc_id, text)."""
    arrow_batches(spark)
    docs = docs.select("doc_id", "text")
    first = materialize(_documents(docs, words), spark, "jaccard_documents")
    table = first.where("kind = 0").select("doc_id", "n", "key", "bits")
    total = table.agg(F.sum("n")).first()[0] or 0
    counted = (first.where("kind = 1").groupBy("doc_id").agg(F.sum("n").alias("n"))
               .where(F.col("n") > max(total / CLASSES, LEAST_FREQUENT)).select("doc_id"))
    # sums are at most all tokens, so fewer than CLASSES exceed their share
    frequent = np.sort(np.array([r[0] for r in counted.collect()], np.int64).view(np.uint64))

    buckets = int(max(32, -(-total * 0.3 // 500_000)))
    postings = materialize(_postings(docs, words, frequent, buckets, percent), spark, "jaccard_postings")
    combined = postings.where("bucket < 0").select("signature", "doc_id", "n", F.lit(None).cast("int").alias("place"))

    # equal sets are one node, its smallest document
    known = table.where("n > 0 and doc_id is not null")
    one = known.groupBy("doc_id").agg(F.max_by(F.struct("n", "key", "bits"), F.struct("n", "key")).alias("s")) \
        .select("doc_id", "s.*")
    classes = one.groupBy("key").agg(F.min("doc_id").alias("node"))
    member = materialize(one.select("doc_id", "n", "key", "bits").join(classes, "key")
                         .select("doc_id", "n", "bits", "node", "key"), spark, "jaccard_members")
    nodes = member.where("doc_id = node").select("doc_id", "n", "bits")

    # a posting may stand for equal sets of other documents though its own
    # doc_id has a larger one elsewhere: then it is theirs
    smaller = (known.select("doc_id", "n", "key")
               .join(member.select("doc_id", F.col("key").alias("own")), "doc_id").where("key <> own")
               .select("doc_id", F.col("n").alias("size"), "key").distinct())
    owner = member.select("doc_id", "node", F.col("n").alias("size")).union(
        smaller.join(member.where("doc_id = node").select("node", "key"), "key").select("doc_id", "node", "size"))
    members = materialize(
        _shared(postings).union(combined).join(owner, "doc_id").where("n = size")
        .groupBy("signature", "node").agg(F.min("size").alias("n"), F.min("place").alias("place")),
        spark, "jaccard_signatures")

    def fits(a: str, b: str):
        """Sizes allow a link, and so do the places of a shared rare token."""
        na, nb, pa_, pb = (F.col(c) for c in (f"{a}.n", f"{b}.n", f"{a}.place", f"{b}.place"))
        least = F.ceil(F.lit(percent) * (na + nb) / (100 + percent))
        return ((100 * F.least(na, nb) >= percent * F.greatest(na, nb))
                & (pa_.isNull() | ((pa_ <= na - least) & (pb <= nb - least))))

    heads = members.groupBy("signature").agg(F.min(F.struct("node", "n", "place")).alias("h"), F.count("*").alias("c")) \
        .where("c > 1").select("signature", "h.*")
    star = (members.alias("m").join(heads.alias("h"), "signature").where("m.node <> h.node").where(fits("m", "h"))
            .select(F.col("h.node").alias("a"), F.col("m.node").alias("b")).distinct())
    star = materialize(star, spark, "jaccard_star")
    links = _verified(spark, docs, nodes, star, words, percent)
    parts = connected_components(spark, links, "jaccard_components")

    # pairs of one signature in different components, in blocks
    placed = (members.join(parts.toDF("node", "part"), "node", "left")
              .select("signature", "node", "n", "place", F.coalesce("part", "node").alias("part")))
    mixed = placed.groupBy("signature").agg(F.min("part").alias("low"), F.max("part").alias("high")) \
        .where("low <> high").select("signature")
    open_ = materialize(placed.join(mixed, "signature", "left_semi"), spark, "jaccard_open")
    rest = (_block_pairs(spark, open_.select("signature", "node", "part"), nodes, percent).distinct()
            .join(star, ["a", "b"], "left_anti"))
    rest = materialize(rest, spark, "jaccard_rest")
    arrow_batches(spark)
    more = _verified(spark, docs, nodes, rest, words, percent)
    parts = connected_components(spark, links.union(more), "jaccard_components").toDF("node", "component")

    named = member.join(parts, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component"))
    return (table.select("doc_id", "n").join(named, "doc_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "doc_id").alias("component_id")))
