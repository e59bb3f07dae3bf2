"""Phrase collocation mining with Rabin-Karp fingerprints.

Tasks cut texts into words with numpy and hash every n-gram by prefix polynomials (bytes
into words, words into n-grams), so no n-gram is a string at first.

1. Lengths 1 and 2: each task sums its fingerprints, the shuffle sums them over tasks,
   and those that reach the count form the frequent set.  With each fingerprint go a
   pointer (the least 16-bit mark of a piece that holds it) and a check, 32 bits of a
   second polynomial: a fingerprint with two different checks has collided.
2. Each further length: only n-grams whose two (n-1)-grams may be frequent are hashed and summed.
3. A phrase's text is cut out of the pieces that its pointer names, so each frequent
   phrase is materialised about once.  Collided fingerprints are cut out wherever they
   stand and counted anew by their texts, so their phrases are told apart.

Tasks know these sets as Bloom filters of a fixed size (``filter_bits``).  A full filter
lets more rows into the shuffles; it never changes a result.
"""

from __future__ import annotations

import contextlib
import functools
import operator
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veriscope.llm.common import write_table

#: Bytes: A-Z to a-z, the marks that end a piece to a line feed, a tab to a space (the task's rule).
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
MAP = bytes(10 if b in BREAKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Odd bases of the two polynomials, modulo 2^64 (any odd values do).
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
BYTE_CHECK, WORD_CHECK = 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
#: Bytes of text hashed at a time, and n-grams and phrases a task holds before it sums them and hands them on.
CHUNK, HELD, TEXTS = 1 << 18, 1 << 20, 1 << 17
#: A row of the shuffle counts up to this.
MOST = 0xFFFF
PROBES = 4
SEGMENTS = 64
U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads all bits of a polynomial's value over 64 bits."""
    x = (x ^ (x >> U64(32))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(29))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(32))


@functools.cache
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2^64."""
    def powers(b: int) -> np.ndarray:
        out = np.full(n + 1, b, U64)
        out[0] = 1
        return np.cumprod(out, dtype=U64)
    return powers(base), powers(pow(base, -1, 1 << 64))


def _sums(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix polynomial of the values, and the factors that bring any span of it to the start."""
    up, down = _powers(base, CHUNK) if len(values) <= CHUNK else _powers.__wrapped__(base, len(values))
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[:len(values)], dtype=U64, out=out[1:])
    return out, down


class Words:
    """The words of one chunk of normalised bytes, in order, with their fingerprints.

    ``bits`` below 64 weakens the fingerprints, so that tests can force collisions."""

    def __init__(self, blob: bytes, doc_starts: np.ndarray, lang: str = "", bits: int = 64):
        self.blob, self.bits, self.salt = blob, bits, zlib.crc32(lang.encode()) << 8
        self.data = data = np.frombuffer(blob, np.uint8)
        inside = (data != 32) & (data != 10)
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        edge = doc_starts[(doc_starts > 0) & (doc_starts < len(data))]
        first[edge] |= inside[edge]                              # documents touch in the buffer
        last[edge - 1] |= inside[edge - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        ends = np.zeros(len(data) + 1, np.int32)
        ends[1:] = data == 10
        ends[edge] += 1
        self.piece = np.cumsum(ends, dtype=np.int32)[self.start]
        sums, down = _sums(data.astype(U64) + U64(1), BYTE_BASE)
        self.hash = _mix((sums[self.end] - sums[self.start]) * down[self.start])
        self.sums, self.down = _sums(self.hash, WORD_BASE)
        sums, down = _sums(data.astype(U64) + U64(1), BYTE_CHECK)
        self.other = _mix((sums[self.end] - sums[self.start]) * down[self.start])
        self.checks, self.up = _sums(self.other, WORD_CHECK)

    def __len__(self) -> int:
        return len(self.start)

    def places(self, n: int) -> np.ndarray:
        """First words of all n-grams inside pieces."""
        count = max(0, len(self) - n + 1)
        return np.flatnonzero(self.piece[:count] == self.piece[n - 1:n - 1 + count])

    def prints(self, n: int, at: np.ndarray) -> np.ndarray:
        """Fingerprints of the n-grams at these words."""
        out = _mix((self.sums[at + n] - self.sums[at]) * self.down[at] + U64(self.salt + n))
        return out & U64((1 << self.bits) - 1) if self.bits < 64 else out

    def check(self, n: int, at: np.ndarray) -> np.ndarray:
        """32 bits of a second polynomial of the n-grams at these words."""
        return (_mix((self.checks[at + n] - self.checks[at]) * self.up[at]) >> U64(32)).astype(np.uint32).view(np.int32)

    def marks(self) -> np.ndarray:
        """16 bits of the whole piece that each word stands in: a piece is never cut, so every pass finds the same."""
        if not len(self):
            return np.empty(0, np.int32)
        first = np.flatnonzero(np.concatenate([[True], self.piece[1:] != self.piece[:-1]]))
        last = np.append(first[1:], len(self))
        mark = _mix((self.sums[last] - self.sums[first]) * self.down[first]) & U64(0xFFFF)
        return np.repeat(mark.astype(np.int32), last - first)

    def numbers(self) -> np.ndarray:
        """A number for each different word; equal hashes are compared as text, byte by byte."""
        _, rep, number = np.unique(self.hash, return_index=True, return_inverse=True)
        width, other = self.end - self.start, rep[number]
        same = width == width[other]
        live = np.flatnonzero(same & (other != np.arange(len(self))))
        for k in range(int(width.max(initial=0))):
            live = live[width[live] > k]
            if not len(live):
                break
            differ = self.data[self.start[live] + k] != self.data[self.start[other[live]] + k]
            same[live[differ]] = False
            live = live[~differ]
        if not same.all():                                       # a collision: number the texts themselves
            seen: dict[bytes, int] = {}
            number = np.array([seen.setdefault(x, len(seen)) for x in self.texts(np.arange(len(self)), 1)], np.int64)
        return number.astype(np.int64)

    def texts(self, at: np.ndarray, n: int) -> list[bytes]:
        """The n-grams at these words, with one space between words."""
        lo, hi, blob = self.start[at], self.end[at + n - 1], self.blob
        out = [blob[a:b] for a, b in zip(lo.tolist(), hi.tolist())]
        gaps = hi - lo - sum(self.end[at + k] - self.start[at + k] for k in range(n))
        for i in np.flatnonzero(gaps != n - 1).tolist():
            out[i] = b" ".join(x for x in out[i].split(b" ") if x)
        return out


def chunks(texts: pa.StringArray | pa.LargeStringArray, size: int = CHUNK) -> Iterator[tuple[bytes, np.ndarray]]:
    """Normalised bytes of the texts, about ``size`` at a time, with the documents' starts.

    A text is cut only where a piece ends, so memory follows the longest piece."""
    wide = texts.cast(pa.large_binary())
    at = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
    raw, lo, stop = wide.buffers()[2], int(at[0]), int(at[-1])
    while lo < stop:
        hi = min(lo + size, stop)
        if hi < stop:                                            # back to a document's start, else to a piece's end
            last = int(at[np.searchsorted(at, hi, "right") - 1])
            if last > lo:
                hi = last
            else:
                end = int(at[np.searchsorted(at, lo, "right")])
                part = raw[lo:hi].to_pybytes().translate(MAP)
                cut = part.rfind(b"\n")
                while cut < 0 and hi < end:
                    more = min(hi + size, end)
                    cut = raw[hi:more].to_pybytes().translate(MAP).find(b"\n")
                    cut, hi = (cut + hi - lo, hi) if cut >= 0 else (-1, more)
                hi = lo + cut + 1 if cut >= 0 else end
        yield raw[lo:hi].to_pybytes().translate(MAP), at[(at >= lo) & (at < hi)] - lo
        lo = hi


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    """(language, some texts of it) of a batch of (lang, text), 1,024 rows at a time."""
    for lo in range(0, batch.num_rows, 1024):
        part = batch.slice(lo, 1024)
        codes = part.column(0).dictionary_encode()
        number = np.asarray(codes.indices)
        for k, lang in enumerate(codes.dictionary.to_pylist()):
            yield lang, part.column(1).take(pa.array(np.flatnonzero(number == k)))


class Bloom:
    """A Bloom filter of a fixed number of bits (a power of two), as bytes."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def slot(prints: np.ndarray, k: int, size: int) -> np.ndarray:
        """The k-th bit of each fingerprint: two halves of it, the second one k times."""
        return (prints + U64(k) * (prints >> U64(32) | U64(1))) & U64(size - 1)

    def holds(self, prints: np.ndarray) -> np.ndarray:
        live = np.arange(len(prints))
        for k in range(PROBES):
            s = self.slot(prints[live], k, 8 * len(self.bits))
            live = live[(self.bits[(s >> U64(3)).astype(np.int64)] >> (s & U64(7)).astype(np.uint8) & 1).astype(bool)]
        out = np.zeros(len(prints), bool)
        out[live] = True
        return out


def build_filter(frequent: DataFrame, bits: int) -> Bloom:
    """The filter of the column fp: every task sets bits of its rows, segments are joined by bit_or."""
    segment = bits // 8 // SEGMENTS

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 8, np.uint8)
        for b in batches:
            prints = np.asarray(b.column(0)).view(U64)
            for k in range(PROBES):
                s = Bloom.slot(prints, k, bits)
                np.bitwise_or.at(own, (s >> U64(3)).astype(np.int64), np.uint8(1) << (s & U64(7)).astype(np.uint8))
        parts = own.reshape(SEGMENTS, segment)
        full = np.flatnonzero(parts.any(1))
        if len(full):
            yield pa.RecordBatch.from_pydict({"segment": pa.array(full, pa.int32()),
                                              "bits": pa.array([parts[k].tobytes() for k in full], pa.binary())})

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}                          # at most SEGMENTS of them
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own[k] = own[k] | np.frombuffer(x, np.uint8) if k in own else np.frombuffer(x, np.uint8)
        if own:
            yield pa.RecordBatch.from_pydict({"segment": pa.array(list(own), pa.int32()),
                                              "bits": pa.array([x.tobytes() for x in own.values()], pa.binary())})

    shape = "segment int, bits binary"
    rows = (frequent.select("fp").mapInArrow(mark, shape)
            .repartition(8, "segment").mapInArrow(join, shape).collect())      # bits / 8 bytes in all, a fixed size
    out = np.zeros((SEGMENTS, segment), np.uint8)
    for r in rows:
        out[r["segment"]] = np.frombuffer(r["bits"], np.uint8)
    return Bloom(out.reshape(-1))


def count_prints(docs: DataFrame, lengths: list[int], bits: int, known=None) -> DataFrame:
    """(fp, f, at, low, high) of all n-grams of these lengths; with ``known`` (a broadcast filter), of those whose two
    shorter n-grams may be frequent.  A fingerprint holds language and length too."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            fp, at, check = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(fp)
            fp, at, check = fp[order], at[order], check[order]
            first = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
            f = np.diff(np.append(first, len(fp)))
            fp, at = fp[first], np.minimum.reduceat(at, first)
            low, high = np.minimum.reduceat(check, first), np.maximum.reduceat(check, first)
            two = np.flatnonzero(low != high)                   # a collision: a second row with the other check
            fp, f, at, check = (np.concatenate(x) for x in ((fp, fp[two]), (f, 0 * f[two]), (at, at[two]), (low, high[two])))
            some = np.maximum(1, -(-f // MOST))                 # counts over 16 bits are several rows
            which = np.repeat(np.arange(len(fp)), some)
            turn = np.arange(len(which)) - np.repeat(np.cumsum(some) - some, some)
            f = np.minimum(f[which] - turn * MOST, MOST)
            packed = check[which].astype(np.int64) << 32 | at[which].astype(np.int64) << 16 | f
            for lo in range(0, len(which), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                yield pa.RecordBatch.from_pydict({"fp": pa.array(fp[which[part]].view(np.int64)), "m": pa.array(packed[part])})

        for b in batches:
            for lang, texts in _by_lang(b):
                for blob, starts in chunks(texts):
                    words = Words(blob, starts, lang, bits)
                    marks = words.marks()
                    for n in lengths:
                        at = words.places(n)
                        if known is not None:
                            every = words.places(n - 1)
                            fits = np.zeros(len(words) + 1, bool)
                            fits[every[known.value.holds(words.prints(n - 1, every))]] = True
                            at = at[fits[at] & fits[at + 1]]
                        if len(at):
                            held.append((words.prints(n, at), marks[at], words.check(n, at)))
                            size += len(at)
                    if size >= HELD:
                        yield from flush()
                        held, size = [], 0
        if size:
            yield from flush()

    # Tasks have summed their own rows: dealt out first, so that no second sum is held on the map side.
    # A row is two numbers: the fingerprint, and check, pointer and count side by side.
    f, at, c = F.col("m").bitwiseAND(MOST), F.shiftright("m", 16).bitwiseAND(0xFFFF).cast("int"), F.shiftright("m", 32).cast("int")
    return (docs.mapInArrow(count, "fp long, m long").repartition("fp").groupBy("fp")
            .agg(F.sum(f).alias("f"), F.min(at).alias("at"), F.min(c).alias("low"), F.max(c).alias("high")))


def _pointed(fp: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What the filters hold: a fingerprint with its pointer, or with -1 where it is to be found everywhere."""
    return _mix(fp + (at.astype(np.int64).view(U64) + U64(2)) * U64(BYTE_CHECK))


def pointers(frequent: DataFrame) -> DataFrame:
    """The column fp as ``_pointed`` makes it, of (fp, at, low, high)."""
    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = _pointed(np.asarray(b.column(0)).view(U64), np.asarray(b.column(1)))
            yield pa.RecordBatch.from_pydict({"fp": pa.array(fp.view(np.int64))})
    at = F.when(F.col("low") == F.col("high"), F.col("at")).otherwise(F.lit(-1))
    return frequent.select("fp", at.alias("at")).mapInArrow(point, "fp long")


def cut_texts(docs: DataFrame, longest: int, bits: int, known) -> DataFrame:
    """(lang, n, phrase, fp, c, seen): phrases where the filter of pointers lets them through, with the occurrences
    that it let through, and rows of n = 0 with each language's number of words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], dict[tuple[bytes, int, int], int]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, n), found in held.items():
                keys, counts = list(found), list(found.values())
                for lo in range(0, len(keys), 1 << 15):
                    part, prints, checks = zip(*keys[lo:lo + (1 << 15)])
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.repeat(pa.scalar(lang, pa.string()), len(part)), "n": pa.repeat(pa.scalar(n, pa.int32()), len(part)),
                        "phrase": pa.array(part, pa.binary()).cast(pa.string()), "fp": pa.array(np.array(prints, U64).view(np.int64)),
                        "c": pa.array(checks, pa.int32()), "seen": pa.array(counts[lo:lo + (1 << 15)], pa.int64())})

        for b in batches:
            for lang, texts in _by_lang(b):
                for blob, starts in chunks(texts):
                    words = Words(blob, starts, lang, bits)
                    total = held.setdefault((lang, 0), {(b"", 0, 0): 0})
                    total[b"", 0, 0] += len(words)
                    number, marks = words.numbers(), words.marks()
                    everywhere = np.full(len(words), -1, np.int32)
                    base, code = int(number.max(initial=0)) + 1, number    # code: equal exactly where the n words are equal
                    for n in range(1, longest + 1):
                        if n > 1:
                            _, code = np.unique(code[:max(0, len(words) - n + 1)], return_inverse=True)
                            code = code * base + number[n - 1:]
                        at = words.places(n)
                        fp = words.prints(n, at)
                        at = at[known.value.holds(_pointed(fp, marks[at])) | known.value.holds(_pointed(fp, everywhere[at]))]
                        _, first, f = np.unique(code[at], return_index=True, return_counts=True)
                        found, at = held.setdefault((lang, n), {}), at[first]
                        for key, k in zip(zip(words.texts(at, n), words.prints(n, at).tolist(), words.check(n, at).tolist()), f.tolist()):
                            found[key] = found.get(key, 0) + k
                    if sum(map(len, held.values())) >= TEXTS:
                        yield from flush()
                        held = {}
        yield from flush()

    return (docs.mapInArrow(count, "lang string, n int, phrase string, fp long, c int, seen long")
            .groupBy("lang", "n", "phrase", "fp", "c").agg(F.sum("seen").alias("seen")))


def count_phrases(docs: DataFrame, longest: int = 3, least: int = 10, lang_col: str = "lang", text_col: str = "text",
                  filter_bits: int = 1 << 27, print_bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of 1 to ``longest`` words with exact counts, and each language's word count.

    Null texts are empty and null languages are ``und``; repeated rows count each."""
    if filter_bits & (filter_bits - 1) or filter_bits < 8 * SEGMENTS:
        raise ValueError("filter_bits must be a power of two, 512 or more")
    spark = docs.sparkSession
    read = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    with smaller_batches(spark):
        return _count_phrases(read, longest, least, filter_bits, print_bits)


@contextlib.contextmanager
def smaller_batches(spark, rows: int = 2000) -> Iterator[None]:
    """Fewer rows go to the Python workers at a time while the tables of this operator are written."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _count_phrases(read: DataFrame, longest: int, least: int, filter_bits: int, print_bits: int) -> tuple[DataFrame, DataFrame]:
    spark, levels, known = read.sparkSession, [], None
    for n in range(2, max(2, longest) + 1):
        counts = count_prints(read, [1, 2] if n == 2 else [n], print_bits, known)
        levels.append(write_table(counts.where(F.col("f") >= least), "prints"))
        frequent = functools.reduce(DataFrame.unionByName, levels)
        if known is not None:
            known.unpersist()
        if n < longest:
            known = spark.sparkContext.broadcast(build_filter(frequent, filter_bits))
    # Lengths are counted apart, but a fingerprint that two of them share has collided as well.
    merged = write_table(frequent.groupBy("fp").agg(F.sum("f").alias("sum"), F.min("at").alias("at"), F.min("low").alias("low"),
                                                    F.max("high").alias("high")), "merged")
    known = spark.sparkContext.broadcast(build_filter(pointers(merged), filter_bits))
    texts = write_table(cut_texts(read, longest, print_bits, known), "texts")
    one = F.col("low") == F.col("high")
    counts = (texts.where("n > 0").join(merged.withColumnRenamed("fp", "of"), F.col("fp") == F.col("of"))
              .where(~one | (F.col("c") == F.col("low")))
              .select("lang", "n", "phrase", F.when(one, F.col("sum")).otherwise(F.col("seen")).alias("f"))
              .where(F.col("f") >= least))
    known.unpersist()
    return write_table(counts, "phrases"), texts.where("n = 0").select("lang", F.col("seen").alias("n"))


def collocations(phrases: DataFrame, longest: int = 3, least: int = 10, covered: int = 50) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases of 2 words and more, without those that a longer one covers.

    A phrase is cut after each word; the cut with the lowest floor(1000000 a a / (l r))
    counts, the first of equal ones.  Numbers are decimals until the floor, which is
    exact up to 38 digits (counts up to about 10^15).  A phrase is covered by a longer
    one that holds its words in a row and has ``covered`` percent of its count or more.
    """
    words = F.split("phrase", " ")
    known = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    made = phrases.where((F.col("n") >= 2) & (F.col("f") >= least)).withColumn("w", words)
    cuts = made.select("lang", "phrase", "n", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    left = F.array_join(F.slice("w", F.lit(1), F.col("k")), " ")
    right = F.array_join(F.slice("w", F.col("k") + 1, F.col("n") - F.col("k")), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", left.alias("part_l"), right.alias("part_r"))
    for side in ("l", "r"):
        cuts = cuts.join(known.select(F.col("lang").alias("of"), F.col("part").alias("p"), F.col("part_f").alias(side)),
                         (F.col("lang") == F.col("of")) & (F.col(f"part_{side}") == F.col("p"))).drop("of", "p", f"part_{side}")
    score = F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)))"
                   " div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    held = phrases.where((F.col("n") >= 3) & (F.col("f") >= least)).withColumn("w", words)
    if longest < 3:
        return best

    def spans(m: int):
        """All m words in a row of a phrase of more than m words."""
        return F.when(F.col("n") > m, F.transform(F.sequence(F.lit(1), F.col("n") - m + 1),
                                                  lambda i: F.array_join(F.slice("w", i, F.lit(m)), " "))).otherwise(F.array())

    inside = (held.select("lang", "f", F.explode(F.array_distinct(F.concat(*map(spans, range(2, longest))))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
              .select(F.col("lang").alias("of"), F.col("phrase").alias("p"), "longer"))
    joined = best.join(inside, operator.and_(F.col("lang") == F.col("of"), F.col("phrase") == F.col("p")), "left")
    return joined.where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a"))).drop("of", "p", "longer")


def top_phrases(docs: DataFrame, longest: int = 3, least: int = 10, covered: int = 50, top: int = 2000, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best collocations, score, count and phrase deciding."""
    phrases, totals = count_phrases(docs, longest, least, **options)
    best = collocations(phrases, longest, least, covered)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return (ranked.join(totals.select(F.col("lang").alias("of"), "n"), F.col("lang") == F.col("of"))
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
