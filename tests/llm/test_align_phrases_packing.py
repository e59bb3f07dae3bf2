"""Alignment, phrases and packing against brute force: edge cases, forced collisions, whole tables."""
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from tests.llm.conftest import LOWER

import __spark_entry__ as E
from veriscope.llm import alignment, bpe, packing, phrases
from veriscope.llm.catalog import public_file

SF = "/root/testdata/sf0.001"
A, B = public_file("byte_bpe_50k.json"), public_file("piece_bpe_32k.model")
ODD = [None, "", "a▁b", "ﬁ Å é <|endoftext|> <s> <0x41>", "  two  spaces\t\n", "x", "\0", "日本語 テキスト 🙂🙂", " " * 5000 + "y",
       "word, " * 4000, "Word word. WORD", "a" * 3000]


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], "k", 1) for i, t in enumerate(ODD * 2)] + [(None, "null id", "en", "k", 1)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, block string, n int")


def library():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, SentencePieceProcessor(model_file=B)


def brute_alignment(docs):
    t, sp = library()
    letters = bpe.byte_letters()
    rows, links = [], []
    for doc_id, text in docs:
        a = t.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        ba = [bytes(letters[c] for c in t.id_to_token(i)) for i in a]
        bb = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(ba) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
            rows.append((doc_id, 0, 0, ""))
            links.append([])
            continue
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        at = {e: k for k, e in enumerate(eb)}
        cuts = [(i, at[e]) for i, e in enumerate(ea) if e in at]
        groups, la, lb = [], 0, 0
        for i, j in cuts:
            groups.append(",".join(map(str, a[la:i + 1])) + "|" + ",".join(map(str, b[lb:j + 1])))
            la, lb = i + 1, j + 1
        rows.append((doc_id, len(a), len(b), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append([(a[i], b[j]) for i, j in cuts])
    count = collections.Counter(x for row in links for x in row)
    top = collections.Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return sorted(((r[0], r[1], r[2], len(x), len(x), sum(count[p] == top[p[1]] for p in x), sum(count[p] for p in x), r[3])
                   for r, x in zip(rows, links)), key=repr)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_odd_texts(odd_docs):
    want = brute_alignment([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert rows_of(alignment.align_tokens(odd_docs, A, B), *ALIGNED) == want
    assert rows_of(alignment.align_tokens(odd_docs, A, B, block_links=3), *ALIGNED) == want       # a block a batch
    assert alignment.align_tokens(odd_docs.limit(0), A, B).count() == 0


def test_alignment_edge_docs(edge_docs, no_docs):
    want = brute_alignment([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert rows_of(alignment.align_tokens(edge_docs, A, B), *ALIGNED) == want
    assert alignment.align_tokens(no_docs, A, B).count() == 0


def test_alignment_query_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(E.queries()["op11_token_alignment"](spark, SF), *ALIGNED) == brute_alignment([tuple(r) for r in docs])


def test_lanes_do_not_change_links():
    rng = random.Random(3)
    for lane in (1, 2, 7, 1000):
        ends_a, ends_b, first = [], [], ([], [])
        base = 0
        for _ in range(30):
            n = rng.choice([1, 2, 5, 300])
            first[0].append(len(ends_a))
            first[1].append(len(ends_b))
            for ends in (ends_a, ends_b):
                ends += sorted({base + n, *(base + x for x in range(1, n) if rng.random() < 0.4)})
            base += n
        a, b = np.array(ends_a), np.array(ends_b)
        i, j = alignment.lockstep(a, b, *alignment.lanes(a, b, np.array(first[0]), np.array(first[1]), lane))
        both = sorted(set(ends_a) & set(ends_b))
        assert a[i].tolist() == both and b[j].tolist() == both


def test_byte_encoder_equals_the_library():
    t, _ = library()
    enc = bpe.byte_bpe(A, True)
    assert enc.fast is not None
    rng = random.Random(5)
    alphabets = ["abc '", "été ß  \t\n", "0123456789 .,!?-", "日本語かな ", "🙂👍🏽 a‍́", "'re've'll 'S"]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    assert [enc.ids(x) for x in texts] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    with_special = bpe.byte_bpe(A, False)
    t.encode_special_tokens = False
    assert with_special.ids("a <|endoftext|> b") == t.encode("a <|endoftext|> b", add_special_tokens=False).ids


def brute_phrases(docs, longest=3, least=10, covered=50, top=2000):
    n, f = collections.Counter(), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    made = collections.defaultdict(list)
    cover = collections.Counter()
    for (lang, p), a in f.items():
        for m in range(2, len(p)) if a >= least else ():
            for i in range(len(p) - m + 1):
                cover[lang, p[i:i + m]] = max(cover[lang, p[i:i + m]], a)
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least or 100 * cover[lang, p] >= covered * a:
            continue
        score, _, left, right = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                    for k in range(1, len(p)))
        made[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, r, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0])
                  for lang, rows in made.items() for r, x in enumerate(sorted(rows)[:top], 1))


PHRASE = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def phrase_docs(spark):
    rng = random.Random(9)
    voc = ["New", "york", "city", "die", "é", "of", "the", "a-b", "9", "日本"]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(voc) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n"]) for _ in range(rng.choice([0, 3, 60, 200])))
        rows.append((rng.choice(["en", "de", None, "und"]), text, "x", 1, "y"))
    rows += [("en", None, "x", 1, "y"), (None, None, None, None, None), ("fr", "only once here", "x", 1, "y"), rows[5], ("en", "new york " * 30000, "x", 1, "y")]
    return spark.createDataFrame(rows, "lang string, text string, phrase string, f int, part string")


@pytest.mark.parametrize("options", [{}, {"print_bits": 10, "filter_bits": 1 << 10}, {"print_bits": 0 + 1}])
def test_phrases_exact_whatever_collides(spark, options):
    docs = phrase_docs(spark)
    want = brute_phrases([(r.lang, r.text) for r in docs.collect()])
    assert len(want) > 100
    assert rows_of(phrases.top_phrases(docs, **options), *PHRASE) == sorted(want, key=repr)


def test_phrases_longer_and_limits(spark):
    docs = phrase_docs(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert rows_of(phrases.top_phrases(docs, longest=4, least=5, top=7), *PHRASE) == sorted(brute_phrases(rows, 4, 5, 50, 7), key=repr)
    assert rows_of(phrases.top_phrases(docs, longest=2), *PHRASE) == sorted(brute_phrases(rows, 2), key=repr)


def test_phrases_edge_docs(edge_docs, no_docs):
    want = brute_phrases([(r.lang, r.text) for r in edge_docs.collect()])
    assert rows_of(phrases.top_phrases(edge_docs), *PHRASE) == sorted(want, key=repr)
    assert phrases.top_phrases(no_docs).count() == 0


def test_phrase_chunks_cut_nothing():
    import pyarrow as pa
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab  .\n,\t") for _ in range(rng.choice([0, 1, 5, 400]))) for _ in range(50)] + ["long " * 500 + "."]
    want = collections.Counter(" ".join(w[i:i + 2]) for t in texts for p in re.split(r"[.,;:!?\x0A-\x0D]", t)
                               for w in [re.findall(r"[^\x20\x09]+", p)] for i in range(len(w) - 1))
    for size in (1, 7, 64, 1 << 20):
        got = collections.Counter()
        for data, starts in phrases.chunks(pa.array(texts), size):
            words = phrases.Words(data, starts)
            got.update(x.decode() for x in words.texts(words.places(2), 2))
        assert got == want


def test_colliding_words_are_told_apart():
    words = phrases.Words(b"aa bb aa cc bb " * 3, np.array([0]))
    words.hash = np.full(len(words), 7, np.uint64)
    number = words.numbers()
    texts = words.texts(np.arange(len(words)), 1)
    assert len({*zip(number.tolist(), texts)}) == len(set(texts)) == len(set(number.tolist()))


def brute_packing(docs, longest=2048):
    t, _ = library()
    t.encode_special_tokens = False
    return {(i, k): np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4") for k, (i, x) in enumerate(docs)}


def check_packing(rows, docs, longest=2048):
    """Pieces cover each document once, every sequence is one piece of a power-of-two length, numbers have no gaps."""
    want = collections.Counter((i, x.tobytes()) for (i, _), x in brute_packing(docs, longest).items())
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    assert [r.length for r in sorted(rows, key=lambda r: r.sequence_id)] == sorted(r.length for r in rows)
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= longest and len(r.ids) == 4 * r.length for r in rows)
    pieces = collections.Counter((r.doc_id, r.start, r.doc_tokens, bytes(r.ids)) for r in rows)
    for (i, ids), copies in want.items():
        at = 0
        for n in packing.piece_lengths(len(ids) // 4, longest):
            pieces[i, at, len(ids) // 4, ids[4 * at:4 * (at + n)]] -= copies
            at += n
        assert 4 * at == len(ids)
    assert not any(pieces.values())


def test_packing(spark, odd_docs, edge_docs, no_docs):
    for docs, longest in ((odd_docs, 2048), (odd_docs, 8), (odd_docs, 1), (edge_docs, 2048)):
        path = packing.write_sequences(docs, A, longest)
        check_packing(packing.sequences(spark, path).collect(), [(r.doc_id, r.text) for r in docs.collect()], longest)
    assert packing.sequences(spark, packing.write_sequences(no_docs, A)).count() == 0
    path = packing.write_sequences(odd_docs, A)
    assert {r.length for r in packing.read_bucket(spark, path, 64).collect()} == {64}
    with pytest.raises(ValueError):
        packing.write_sequences(odd_docs, A, 100)


def test_packing_query_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: x for (i, _), x in brute_packing(docs).items()}
    rows = E.queries()["op13_packing"](spark, SF).collect()
    assert sum(r.length for r in rows) == sum(map(len, want.values())) and {r.doc_id for r in rows} == set(want)
    for r in rows:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())


def test_counts_over_a_row_are_several_rows(spark, monkeypatch):
    docs = spark.createDataFrame([("en", "a b c " * 700)], "lang string, text string")
    read, _ = phrases.count_phrases(docs)
    assert {r["phrase"]: r["f"] for r in read.collect()}["a b c"] == 700
    big = spark.createDataFrame([("en", "x y. " * 70_000)], "lang string, text string")
    read, totals = phrases.count_phrases(big)
    assert {r["phrase"]: r["f"] for r in read.collect()} == {"x": 70_000, "y": 70_000, "x y": 70_000}
    assert totals.collect()[0]["n"] == 140_000
