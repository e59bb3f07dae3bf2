"""Alignment of two tokenizers' tokens over the same bytes, by lockstep vectorised merging.

Both token sequences of a document cover the same bytes.  One numpy state vector holds a
pair of pointers (into the A and the B tokens) for every lane of a batch; each step
compares the two tokens' byte ends in all lanes at once, emits a link and a cut where
they are equal, moves the pointer that is behind, and drops finished lanes.  A long
document is several lanes, divided where both sequences end a token, so that the number
of steps does not follow the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriscope.llm.bpe import byte_bpe, lengths, piece_bpe
from veriscope.llm.common import documents, write_table

#: A tokens after which a lane may end, bytes of text merged at a time, links of a block (one row of work later on).
LANE, BATCH_BYTES, BLOCK_LINKS = 256, 2 << 20, 1 << 22
PAIRS = 1 << 14
MERGED = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs binary, counts binary, found array<struct<a:int,b:int,n:long>>")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, i: np.ndarray, j: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (indices of A and B tokens that end together), in order of A.

    Lane k starts at tokens i[k] and j[k] and is finished when i reaches stop[k]; the
    last A token of a lane ends with a B token."""
    links_a, links_b = [], []
    live = i < stop
    i, j, stop = i[live], j[live], stop[live]
    while len(i):
        a, b = ends_a[i], ends_b[j]
        cut = a == b
        links_a.append(i[cut])
        links_b.append(j[cut])
        i, j = i + (a <= b), j + (b <= a)
        live = i < stop
        if not live.all():
            i, j, stop = i[live], j[live], stop[live]
    if not links_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    links_a, links_b = np.concatenate(links_a), np.concatenate(links_b)
    order = np.argsort(links_a)
    return links_a[order], links_b[order]


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, lane: int = LANE):
    """Starts of lanes in both sequences, and their ends in A: documents, and every ``lane`` A tokens where B ends too."""
    cand = np.arange(lane - 1, len(ends_a), lane)
    at = np.searchsorted(ends_b, ends_a[cand])
    both = (at < len(ends_b)) & (ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a[cand]) if len(ends_b) else np.zeros(len(cand), bool)
    more_a, more_b = cand[both] + 1, at[both] + 1
    inside = more_a < len(ends_a)
    i, keep = np.unique(np.concatenate([first_a, more_a[inside]]), return_index=True)
    j = np.concatenate([first_b, more_b[inside]])[keep]
    return i, j, np.append(i[1:], len(ends_a))


def _numerals(size: int) -> np.ndarray:
    """Decimal ids with each of the three marks after them, as fixed-width bytes: row 3 * id + mark."""
    return np.array([f"{i}{mark}".encode() for i in range(size) for mark in ",|;"])


class Aligner:
    """Merges batches of texts; held once per Python worker."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = byte_bpe(a_path, plain_special=True), piece_bpe(b_path)
        self.len_a, self.len_b = lengths(self.a.bytes_of), lengths(self.b.bytes_of)
        self.base = len(self.b.bytes_of)
        self.numerals = _numerals(max(len(self.len_a), len(self.len_b)))
        self.widths = np.char.str_len(self.numerals)

    def tokens(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of both tokenizers, or none where either loses bytes of space + text."""
        if not text:
            return [], []
        a, b, want = self.a.ids(" " + text), self.b.ids(text), b" " + text.encode()
        same = b"".join(map(self.a.bytes_of.__getitem__, a)) == want == b"".join(map(self.b.bytes_of.__getitem__, b))
        return (a, b) if same else ([], [])

    def merge(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """(n_a, n_b, n_links) per text, digests of the groups, and per link its text's number and pair code."""
        both = [self.tokens(t) for t in texts]
        n_a, n_b = (np.array([len(x[k]) for x in both], np.int64) for k in (0, 1))
        ids_a, ids_b = (np.fromiter((i for x in both for i in x[k]), np.int64, int(n.sum())) for k, n in ((0, n_a), (1, n_b)))
        ends_a, ends_b = np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b])
        stop_a = np.cumsum(n_a)
        full = n_a > 0
        i, j = lockstep(ends_a, ends_b, *lanes(ends_a, ends_b, (stop_a - n_a)[full], (np.cumsum(n_b) - n_b)[full]))
        doc = np.searchsorted(stop_a, i, "right")
        n_links = np.bincount(doc, minlength=len(texts))
        return (np.stack([n_a, n_b, n_links]), self._digests(ids_a, ids_b, i, j, n_a + n_b),
                doc, ids_a[i] * self.base + ids_b[j])

    def _digests(self, ids_a, ids_b, i, j, n) -> list[str]:
        """SHA-256 of each text's groups, written as ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
        place = np.empty(len(ids_a) + len(ids_b), np.int64)
        cut_a, cut_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        cut_a[i], cut_b[j] = 1, 1
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        before_b = np.concatenate([[0], j + 1])                  # B tokens in the groups before each group
        place[np.arange(len(ids_a)) + before_b[group_a]] = 3 * ids_a + cut_a
        place[np.arange(len(ids_b)) + (i + 1)[group_b]] = 3 * ids_b + 2 * cut_b
        data = self.numerals[place].tobytes().translate(None, b"\0")
        at = np.concatenate([[0], np.cumsum(self.widths[place])])[np.concatenate([[0], np.cumsum(n)])]
        return [hashlib.sha256(data[lo:hi - 1]).hexdigest() if hi > lo else "" for lo, hi in zip(at[:-1].tolist(), at[1:].tolist())]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One per Python worker."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _block(number: int, docs: list[tuple], merged: list[tuple], base: int) -> Iterator[pa.RecordBatch]:
    """Rows of one block: its documents with their distinct pairs as places in the block's list, then the list itself."""
    key = np.concatenate([m[0] for m in merged])
    which, code = key // (1 << 40), key % (1 << 40)
    n = np.concatenate([m[1] for m in merged])
    found, place = np.unique(code, return_inverse=True)
    total = np.bincount(place, weights=n, minlength=len(found)).astype(np.int64)
    at = np.searchsorted(which, np.arange(len(docs) + 1))
    shape = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
    step = np.diff(place, prepend=0)                             # rises inside a document: small numbers pack well
    step[at[:-1][at[:-1] < len(place)]] = place[at[:-1][at[:-1] < len(place)]]
    for lo in range(0, len(docs), 4096):
        part = range(lo, min(lo + 4096, len(docs)))
        cols = list(zip(*(docs[k] for k in part)))
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([number] * len(part), pa.int64()),
            **{c: pa.array(v, pa.int64()) for c, v in zip(("doc_id", "n_a", "n_b", "n_groups", "n_links"), cols)},
            "groups_sha256": pa.array(cols[5], pa.string()),
            "pairs": pa.array([step[at[k]:at[k + 1]].astype("<u4").tobytes() for k in part], pa.binary()),
            "counts": pa.array([n[at[k]:at[k + 1]].astype("<u4").tobytes() for k in part], pa.binary()),
            "found": pa.nulls(len(part), pa.list_(shape))})
    for lo in range(0, len(found), PAIRS):
        part = slice(lo, lo + PAIRS)
        rows = pa.StructArray.from_arrays([pa.array((found[part] // base).astype(np.int32)), pa.array((found[part] % base).astype(np.int32)),
                                           pa.array(total[part])], fields=list(shape))
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([number], pa.int64()),
            **{c: pa.nulls(1, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
            "groups_sha256": pa.nulls(1, pa.string()), "pairs": pa.nulls(1, pa.binary()), "counts": pa.nulls(1, pa.binary()),
            "found": pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)})


def merge_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                    block_links: int = BLOCK_LINKS) -> DataFrame:
    """Documents with their groups and links, written once, in blocks of about ``block_links`` links.

    Rows with ``found`` null are documents: ``pairs`` (differences of places in the block's
    ascending list of id pairs) and ``counts`` say which pairs they link and how often.
    The other rows are that list, with each pair's links in the block."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        work, part = aligner(a_path, b_path), TaskContext.get().partitionId()
        rows, merged, held, number = [], [], 0, 0

        def groups() -> Iterator[tuple[list, list]]:
            ids, texts, size = [], [], 0
            for b in batches:
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                    ids.append(doc_id)
                    texts.append(text.as_py())
                    size += len(texts[-1]) + 64
                    if size >= BATCH_BYTES:
                        yield ids, texts
                        ids, texts, size = [], [], 0
            if ids:
                yield ids, texts

        for ids, texts in groups():
            sizes, digests, doc, code = work.merge(texts)
            key, n = np.unique((doc + len(rows)) * (1 << 40) + code, return_counts=True)
            merged.append((key, n))
            rows += zip(ids, sizes[0].tolist(), sizes[1].tolist(), sizes[2].tolist(), sizes[2].tolist(), digests)
            held += len(doc) + len(ids)
            if held >= block_links:
                yield from _block((part << 32) + number, rows, merged, work.base)
                rows, merged, held, number = [], [], 0, number + 1
        if rows:
            yield from _block((part << 32) + number, rows, merged, work.base)

    read = documents(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return write_table(read.mapInArrow(merge, MERGED), "aligned")


def pair_counts(merged: DataFrame) -> DataFrame:
    """(a, b, total, best): links of each id pair in the whole corpus, and whether that is its B id's highest."""
    pairs = write_table(merged.where("found is not null").select(F.inline("found"))
                        .groupBy("a", "b").agg(F.sum("n").alias("total")), "pairs")
    top = pairs.groupBy("b").agg(F.max("total").alias("top")).withColumnRenamed("b", "of")
    return pairs.join(top, F.col("b") == F.col("of")).select("a", "b", "total", (F.col("total") == F.col("top")).alias("best"))


def align_tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                 block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row per input row: token, group and link counts, links that are their B id's most frequent, and summed link counts.

    A text that is null, empty, or that either tokenizer does not give back as space +
    text has no tokens: zeros and ''.  Repeated rows count each, null ids stay null.

    The corpus-wide counts of id pairs are joined to each block's list of distinct pairs
    and not to links, so the join's rows follow blocks times their distinct pairs, a
    frequent pair has one row a block, and a group holds one block only.
    """
    merged = merge_documents(docs, a_path, b_path, id_col, text_col, block_links)
    counts = pair_counts(merged).select(F.col("a").alias("of_a"), F.col("b").alias("of_b"), "total", "best")
    lists = (merged.where("found is not null").select("block", F.inline("found"))
             .join(counts, (F.col("a") == F.col("of_a")) & (F.col("b") == F.col("of_b"))).select(F.col("block").alias("of"), "a", "b", "total", "best"))
    rows = merged.where("found is null").drop("found")

    def look_up(docs: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        pairs = pairs.sort_values(["a", "b"])
        total, best = pairs["total"].to_numpy(np.int64), pairs["best"].to_numpy(bool)
        n_best, count_sum = [], []
        for places, n in zip(docs["pairs"], docs["counts"]):
            at, n = np.cumsum(np.frombuffer(places, "<u4").astype(np.int64)), np.frombuffer(n, "<u4").astype(np.int64)
            n_best.append(int(n[best[at]].sum()))
            count_sum.append(int((n * total[at]).sum()))
        out = docs[["doc_id", "n_a", "n_b", "n_groups", "n_links"]].copy()
        out["doc_id"] = out["doc_id"].astype("Int64")
        out["n_best"], out["count_sum"], out["groups_sha256"] = n_best, count_sum, docs["groups_sha256"].to_numpy()
        return out

    return rows.groupBy("block").cogroup(lists.groupBy("of")).applyInPandas(look_up, RESULT)
