"""N-gram Jaccard join by a MinHash LSH forest with exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriscope.llm.common import digest, documents, write_table
from veriscope.llm.components import components, least_names, local_roots
from veriscope.llm.shingles import mix, shingle_sets

TREES, DEPTH = 24, 7


def signatures(sets: list[np.ndarray], seed: int) -> np.ndarray:
    """(n, TREES, DEPTH) MinHash values of shingle sets that are not empty, cut to 16 bits."""
    rng = np.random.default_rng(seed)
    mul = (rng.integers(1, 2 ** 31, TREES * DEPTH, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
    add = rng.integers(0, 2 ** 32, TREES * DEPTH, dtype=np.uint32)
    out = np.empty((len(sets), TREES * DEPTH), "<u2")
    starts = np.cumsum([0] + [len(s) for s in sets])
    lo = 0
    while lo < len(sets):                                  # about 64,000 shingles at a time stay in the cache
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + 65536, "right")) - 1)
        x = (np.concatenate(sets[lo:hi]) >> np.uint64(32)).astype(np.uint32)
        at = starts[lo:hi] - starts[lo]
        for f in range(TREES * DEPTH):
            h = x * mul[f] + add[f]
            h ^= h >> np.uint32(15)
            least = np.minimum.reduceat(h * np.uint32(0x2C1B3C6D), at)
            out[lo:hi, f] = (least ^ (least >> np.uint32(16))).astype("<u2")
        lo = hi
    return out


def found_share(similarity: float | np.ndarray, depth: int):
    """Chance that two sets of this similarity share a prefix of ``depth`` in some tree."""
    return 1 - (1 - similarity ** depth) ** TREES


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                   words: int = 5, recall: float = 0.9999, block_rows: int = 2048, block_shingles: int = 1 << 21, seed: int = 5,
                   numbered: bool = False) -> DataFrame:
    """(doc_id, class_id, copy_id, n_shingles, n_links): one row per input row.

    Documents whose sets of word shingles have a Jaccard similarity of ``threshold``
    or more are linked.  ``copy_id`` is the least doc_id with the same set, ``n_links``
    the number of other rows linked directly (copies included), ``class_id`` the
    least doc_id reachable by links.

    Equal sets are one class with a count.  A class's signature is a forest of tries:
    TREES sequences of DEPTH MinHash values, where classes that share a sequence's
    prefix are candidates.  Prefixes are as long as a pair of just the threshold's
    similarity allows, if it is to be found with a chance of ``recall`` or more (0.8
    and 0.9999: 5 values, 0.99993).  A trie node with the same members as another adds
    nothing and is left out.  Then texts meet once: the members of each node in blocks of about ``block_rows`` rows and
    ``block_shingles`` shingles, where a task computes exact similarities and returns link counts and local roots,
    never pairs.  A pair that shares several nodes counts in the first tree only.
    Nodes of any size are handled, by more blocks.

    A null or empty text, or one without words, links with nothing.  Repeated rows
    count as copies; null doc_ids take part but name no class (a class of null ids
    alone has the name null).  ``numbered`` adds ``class_no``, one number for each
    class whatever its ids (null: links with nothing), and the digest ``k1``, ``k2`` of
    (doc_id, text), by which rows can be told apart where ids repeat or are missing.
    """
    spark = docs.sparkSession
    rows = documents(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets, sums = [], []
            for s in shingle_sets(b.column(1), words):
                sets.append((s >> np.uint64(32)) << np.uint64(32))
                with np.errstate(over="ignore"):
                    sums.append((int(np.add.reduce(s)), int(np.add.reduce((s ^ (s >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93))), len(s)))
            some = [i for i, x in enumerate(sums) if x[2]]
            sig = signatures([sets[i] for i in some], seed) if some else np.empty((0, TREES * DEPTH), "<u2")
            at = dict(zip(some, range(len(some))))
            marks = np.array([x[:2] for x in sums], np.uint64).reshape(-1, 2).view("i8")
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array(marks[:, 0]), pa.array(marks[:, 1]), pa.array([x[2] for x in sums], pa.int32()),
                pa.array([sig[at[i]].tobytes() if i in at else None for i in range(len(sums))], pa.binary())],
                ["doc_id", "text", "m1", "m2", "n", "sig"])

    signed = write_table(rows.mapInArrow(sign, "doc_id long, text string, m1 long, m2 long, n int, sig binary"), "signed")
    key = ["m1", "m2", "n"]
    classes = write_table(signed.where("n > 0").groupBy(*key).agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.max("sig").alias("sig"))
        .withColumn("rep", F.monotonically_increasing_id()), "classes")
    # A class goes by a number of its own: a doc_id repeated with different texts names several classes.
    named = classes.select("rep", "copies", "sig", *key, "least")
    # The worst pair decides, whatever the other pairs of the table are; at depth 0 all classes meet.
    depth = next(d for d in range(DEPTH, -1, -1) if found_share(threshold, d) >= recall)
    members, nodes = _nodes(named, depth)
    links = _verified(signed, members, nodes, named, depth, threshold, words, (block_rows, block_shingles))

    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    linked = components(links, "rep", "root")
    joined = least_names(linked, classes.select("rep", "least"))
    extra, marks = [], []
    if numbered:
        joined = joined.join(linked.select(F.col("id").alias("rep"), F.col("component").alias("class_no")), "rep")
        extra, marks = [F.coalesce("class_no", "rep").alias("class_no")], ["class_no", "k1", "k2"]
    result = write_table(classes.join(counted, "rep", "left").join(joined, "rep", "left").select(
        *key, "least", *extra, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "least").alias("class_id")), "joined")
    out = signed.select("doc_id", *key, *(digest("doc_id", "text") if numbered else ())).join(result, key, "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                      F.coalesce("least", "doc_id").alias("copy_id"), F.col("n").alias("n_shingles"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), *marks)


def _nodes(named: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Trie nodes of one depth with two members or more: (their members, one node of each set of members)."""
    key = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(
        t.cast("byte").alias("tree"), F.xxhash64(F.substring("sig", t * (2 * DEPTH) + 1, F.lit(2 * depth))).alias("node")))
    tries = named.select("rep", "n", F.explode(key).alias("k")).select("rep", "n", "k.tree", "k.node")
    met = write_table(tries.groupBy("tree", "node").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles")).where("members > 1"), "nodes")
    # Both sides of this join grow with the corpus: never broadcast, one plan at every size.
    members = write_table(tries.drop("n").join(met.hint("merge"), ["tree", "node"]), "members")
    nodes = members.groupBy("tree", "node", "members").agg(
        F.bit_xor(F.xxhash64("rep")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("x2"))
    nodes = nodes.groupBy("members", "x1", "x2").agg(F.min(F.struct("tree", "node")).alias("n"))
    return members, write_table(nodes.select("members", "x1", "x2", "n.tree", "n.node"), "distinct")


def _dealt(members: DataFrame, nodes: DataFrame, block: tuple[int, int]) -> DataFrame:
    """(rep, tree, own, same, meeting, pack): the blocks of each listed node meet each other and themselves."""
    listed = write_table(members.join(nodes.select("tree", "node").hint("merge"), ["tree", "node"]), "listed")
    blocks = F.ceil(F.greatest(F.col("members") / block[0], F.col("shingles") / block[1])).cast("int")
    own = F.pmod(F.xxhash64(F.lit(3), "rep"), blocks).cast("int")
    dealt = listed.select("tree", "node", "rep", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = dealt.select("rep", "tree", "own", (F.col("own") == F.col("other")).alias("same"),
                         F.xxhash64("tree", "node", F.least("own", "other"), F.greatest("own", "other")).alias("meeting"))
    # About 1,000 rows a pack: many small meetings share a task's call, a large one fills it.
    packs = max(1, dealt.count() // 1000)
    return dealt.withColumn("pack", F.pmod("meeting", F.lit(packs)))


def _verified(signed, members, nodes, named, depth, threshold, words, block) -> DataFrame:
    """(rep, links, root): exact links of the pairs that share a node, counted in the tasks where they meet."""
    dealt = write_table(_dealt(members, nodes, block), "dealt")
    wanted = named.join(dealt.select("rep").distinct().hint("merge"), "rep", "left_semi")
    # All texts are shuffled once, by digest, those of a class's least id (null where it has none) only;
    # those wanted once more, by class.
    key = ["m1", "m2", "n"]
    named = wanted.select(*key, "least").hint("merge")
    texts = signed.select("doc_id", *key, "text").join(named, key).where(F.col("doc_id").eqNullSafe(F.col("least")))
    texts = texts.select(*key, "text").dropDuplicates(key).join(wanted.hint("merge"), key).select("rep", "text", "copies", "sig")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, grams = None, None
        for b in batches:
            ids = b.column(0).to_numpy()
            new = np.concatenate([[True], ids[1:] != ids[:-1]])      # the rows of one document follow each other
            new[:1] = len(ids) > 0 and ids[0] != last
            fresh = shingle_sets(b.column(1).take(pa.array(np.flatnonzero(new))), words)
            sets = []
            for starts in new.tolist():
                if starts:
                    grams = next(fresh).tobytes()
                sets.append(grams)
            last = ids[-1] if len(ids) else last
            yield pa.RecordBatch.from_arrays([*b.columns[:1], *b.columns[2:], pa.array(sets, pa.binary())],
                                             ["rep", "copies", "sig", "tree", "own", "same", "meeting", "pack", "grams"])

    packed = texts.join(dealt.hint("merge"), "rep").select(
        "rep", "text", "copies", "sig", "tree", "own", "same", "meeting", "pack").mapInArrow(
        cut, "rep long, copies long, sig binary, tree byte, own int, same boolean, meeting long, pack long, grams binary")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"rep": [], "links": [], "root": []}, dtype="i8")]
        for _, part in pdf.groupby("meeting", sort=False):
            out.append(_links(part.sort_values(["rep", "own"], kind="stable"), depth, threshold))
        return pd.concat([x for x in out if x is not None])

    return write_table(packed.groupBy("pack").applyInPandas(meet, "rep long, links long, root long"), "links")


def _prefixes(sig: np.ndarray, depth: int) -> np.ndarray:
    """(n, TREES) 64-bit hashes of the prefixes of this depth."""
    odd = mix(np.arange(1, depth + 1, dtype=np.uint64)) | np.uint64(1)
    return mix((sig.reshape(-1, TREES, DEPTH)[:, :, :depth].astype(np.uint64) * odd).sum(2, dtype=np.uint64))


def _first(keys: np.ndarray, i: np.ndarray, j: np.ndarray, tree: int) -> np.ndarray:
    """Whether the pairs, which share a prefix in ``tree``, share none in a tree before it."""
    out = np.ones(len(i), bool)
    early = np.ascontiguousarray(keys[:, :tree])
    for a in range(0, len(i) if tree else 0, 1 << 16):
        out[a:a + (1 << 16)] = ~(early[i[a:a + (1 << 16)]] == early[j[a:a + (1 << 16)]]).any(1)
    return out


def _links(part: pd.DataFrame, depth: int, threshold: float) -> pd.DataFrame | None:
    """Link counts and local roots of one meeting: a block with itself, or two blocks with each other."""
    sets = [np.frombuffer(x, np.uint64) for x in part["grams"]]
    sizes = np.array([len(s) for s in sets])
    i, j = _similar(sets, sizes, None if part["same"].iat[0] else part["own"].to_numpy(), threshold)
    mine = _first(_prefixes(np.frombuffer(b"".join(part["sig"]), "<u2"), depth), i, j, part["tree"].iat[0])
    i, j = i[mine], j[mine]
    if not len(i):
        return None
    rep, copies = part["rep"].to_numpy(), part["copies"].to_numpy()
    links = np.zeros(len(part), "i8")
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    some = links > 0
    return pd.DataFrame({"rep": rep[some], "links": links[some], "root": rep[local_roots(len(part), i, j)][some]})


def _similar(sets, sizes, own, threshold) -> tuple[np.ndarray, np.ndarray]:
    """Pairs inside a block, or between the two blocks that ``own`` names, with Jaccard >= threshold, exactly."""
    if own is not None and (own == own[0]).all():          # the other block is empty
        return np.empty(0, int), np.empty(0, int)
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], True))
        ok = both >= threshold * (sizes[0] + sizes[1] - both)
        return (np.array([0]), np.array([1])) if ok else (np.empty(0, int), np.empty(0, int))
    left = np.arange(len(sets)) if own is None else np.flatnonzero(own == own.min())
    right = left if own is None else np.flatnonzero(own != own.min())
    both = _overlaps(sets, left, right)
    i, j = np.nonzero(both >= threshold * (sizes[left][:, None] + sizes[right][None, :] - both))
    i, j = left[i], right[j]
    return (i[i < j], j[i < j]) if own is None else (i, j)


def _overlaps(sets, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of left with right sets: two 0/1 tables of sets by shared shingles, multiplied some columns at a time."""
    n = len(sets)
    grams = np.concatenate(sets)
    who = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(grams, kind="stable")
    grams, who = grams[order], who[order]
    column = np.cumsum(np.concatenate([[0], (grams[1:] != grams[:-1]).astype("i8")]))
    shared = np.bincount(column)[column] > 1                # a shingle of one set meets nothing
    column, who = column[shared], who[shared]
    out = np.zeros((len(left), len(right)), np.float32)     # counts below 2**24 are exact
    if not len(column):
        return out
    column = np.cumsum(np.concatenate([[0], (np.diff(column) != 0).astype("i8")]))
    step = max(256, (1 << 21) // n)
    for lo in range(0, int(column[-1]) + 1, step):
        a, b = np.searchsorted(column, [lo, lo + step])
        table = np.zeros((n, step), np.float32)
        table[who[a:b], column[a:b] - lo] = 1
        out += table[left] @ table[right].T
    return out
