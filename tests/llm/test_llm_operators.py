"""Operators against brute force on small fixtures: edge cases, repeated rows, empty tables."""
import random
import re
import zlib

import numpy as np
import pytest
from tests.llm.conftest import LOWER

from veriscope.llm import (components, decontam, embeddings, jaccard, lines, mixing, quality, shards, suffix, tokens, urls)
from veriscope.llm.catalog import tokenizer_path


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def brute_lines(docs):
    keys = {}
    for i, t in docs:
        for x in (t or "").split("\n"):
            k = x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            if len(k) >= 40:
                keys.setdefault(k, set()).add(i)
    out = []
    for i, t in docs:
        parts = (t or "").split("\n")
        keep = [x for x in parts for k in [x.strip(" \t\n\x0b\x0c\r").translate(LOWER)]
                if not (len(k) >= 40 and len(keys[k]) >= 5 and max(keys[k]) != i)]
        out.append((i, len(parts), len(parts) - len(keep), "\n".join(keep)))
    return sorted(out)


def test_lines(edge_docs, no_docs):
    docs = rows_of(edge_docs, "doc_id", "text")
    assert sorted(rows_of(lines.dedup_lines(edge_docs), "doc_id", "n_lines", "n_dropped", "kept")) == brute_lines(docs)
    assert lines.dedup_lines(no_docs).count() == 0


def test_urls(spark):
    rules = spark.createDataFrame([("allow", "org", "/"), ("block", "example.org", "/en/1"), ("allow", "example.org", "/en/1")],
                                  "action string, host string, path string")
    pages = spark.createDataFrame([(1, "http://A.Example.ORG/en/12?x", "q"), (2, "https://org/a", "q"), (3, None, "q"), (4, "nothing", "q"),
                                   (4, "nothing", "q"), (5, "x://borg/", "q"), (6, "http://example.org", None), (7, "", "q")],
                                  "page_id long, url string, rule string")
    got = {r[0]: tuple(r)[1:] for r in urls.filter_pages(pages, rules).collect()}
    assert got[1] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[2] == ("org", "/a", "org/", "allow") and got[3] == got[4] == got[7] == ("", "", None, "allow")
    assert got[5][2] is None and got[6] == ("example.org", "", None, "allow")
    assert urls.filter_pages(pages, rules).count() == 8 and urls.filter_pages(pages.limit(0), rules).count() == 0


def word_list(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def test_decontamination(spark, edge_docs, no_docs):
    rng = random.Random(1)
    voc = [f"w{i}" for i in range(12)] + ["Été", "9"]
    items = [(i, " ".join(rng.choice(voc) for _ in range(rng.choice([3, 9, 10, 14, 25])))) for i in range(12)]
    items += [(50, None), (51, "!!"), (52, items[0][1]), (53, items[4][1] + " more"), (None, items[5][1])]
    texts = [" ".join(rng.choice(voc) for _ in range(rng.choice([0, 5, 40]))) + " " + rng.choice(items)[1].__str__() + "! tail" * rng.randint(0, 3)
             for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(90, None), (91, ""), (3, texts[3])], "doc_id long, text string")
    got = sorted(rows_of(decontam.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")),
                         "doc_id", "n_words", "n_hit", "items"))
    want = []
    for i, t in rows_of(docs, "doc_id", "text"):
        ws, hit, its = word_list(t), set(), set()
        for item, text in items:
            iw = word_list(text)
            for w in {tuple(iw[s:s + 10]) for s in range(max(1, len(iw) - 9))} if iw else ():
                for s in range(len(ws) - len(w) + 1):
                    if tuple(ws[s:s + len(w)]) == w:
                        hit.update(range(s, s + len(w)))
                        if item is not None:
                            its.add(str(item))
        want.append((i, len(ws), len(hit), sorted(its)))
    assert got == sorted(want)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.decontaminate(no_docs, bench).count() == 0
    assert decontam.decontaminate(edge_docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_shards(edge_docs, no_docs):
    got = shards.shard_documents(edge_docs, 4).toPandas()
    assert len(got) == edge_docs.count()
    assert ((got["text"].fillna("").str.encode("utf-8").str.len() + 8) == got["size"]).all()
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    assert shards.shard_documents(no_docs, 4).count() == 0


def test_shard_sizes_are_near_equal_with_a_hot_group(spark):
    docs = spark.createDataFrame([(i, "same text " * 20 if i % 3 == 0 else f"text {i} " * 20) for i in range(6000)],
                                 "doc_id long, text string")
    sizes = shards.shard_documents(docs, 8).groupBy("shard").sum("size").toPandas()["sum(size)"]
    assert len(sizes) == 8 and sizes.max() / sizes.mean() < 1.03 and sizes.min() / sizes.mean() > 0.97


def test_mixing(edge_docs, no_docs):
    got = mixing.mix(edge_docs).toPandas()
    assert len(got) == edge_docs.count() and abs(got.drop_duplicates("source")["target"].sum() - got["size"].sum()) < 1e-6
    assert got["repeats"].max() <= 3 and (got["target"] <= 3 * got["source_size"] + 1e-9).all()
    for _, g in got.groupby("source", dropna=False):
        assert abs((g["size"] * g["repeats"]).sum() - g["target"].iloc[0]) <= g["size"].max() / 2 + 1e-6
    again = mixing.mix(edge_docs).toPandas()
    assert sorted(got["repeats"]) == sorted(again["repeats"]) and mixing.mix(no_docs).count() == 0
    assert set(mixing.repeated(edge_docs, mixing.mix(edge_docs.dropDuplicates(["doc_id"]))).columns) == set(edge_docs.columns)


def test_quality(spark, edge_docs, no_docs):
    rng = random.Random(2)
    good = ["the cat sat on a mat and the dog ran home", "we like to read a good book at night", "water runs down the old hill"]
    texts = [(i, " ".join(rng.choice(good) for _ in range(12)) if i % 2 else "".join(rng.choice("#$%&! QXZ") for _ in range(400)))
             for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").unionByName(edge_docs.select("doc_id", "text").where("doc_id > 400"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    got = quality.score_quality(docs, model).toPandas()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    held = got[got["held_out"]]
    assert ((held["predicted"] == held["doc_id"] % 2).mean()) > 0.95 and got["score"].between(0, 1).all()
    assert quality.score_quality(edge_docs, model).count() == edge_docs.count()
    assert quality.keep_good(edge_docs, model).columns == edge_docs.columns
    empty = quality.fit_quality(no_docs, labels.limit(0))
    assert quality.score_quality(no_docs, empty).count() == 0 and quality.score_quality(edge_docs, empty).count() == 19


def brute_links(sets, threshold, copies=True):
    n = len(sets)
    root, links = list(range(n)), [0] * n
    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and len(a & b) >= threshold * len(a | b):
                links[i] += 1
                links[j] += 1
                ri, rj = root[i], root[j]
                root = [min(ri, rj) if x in (ri, rj) else x for x in root]
    return links, root


def test_jaccard(spark, edge_docs, no_docs):
    rng = random.Random(4)
    base = [[f"w{rng.randint(0, 500)}" for _ in range(rng.choice([3, 30, 80]))] for _ in range(12)]
    texts = []
    for _ in range(120):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"z{rng.randint(0, 9)}"
        texts.append(" ".join(w))
    texts += [None, "", "...", texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in map(word_list, texts)]
    links, root = brute_links(sets, 0.8)
    got = jaccard.join_documents(docs, block_rows=16).orderBy("doc_id").toPandas()
    assert got["n_links"].tolist() == links and got["class_id"].tolist() == root
    assert jaccard.join_documents(edge_docs).count() == edge_docs.count() and jaccard.join_documents(no_docs).count() == 0


def brute_windows(strings, span):
    seen, out = set(), []
    for i, t in enumerate(strings):
        for s in range(len(t) - span + 1):
            out += [(i, s)] if t[s:s + span] in seen else []
            seen.add(t[s:s + span])
    return out


def test_column_wise_construction():
    rng = random.Random(3)
    for _ in range(60):
        span, base = rng.choice([3, 5, 8]), bytes(rng.choice(b"ab") for _ in range(40))
        strings = [base[a:a + rng.randint(0, 12)] + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 6)))
                   for a in (rng.randint(0, 30) for _ in range(rng.randint(1, 12)))]
        assert [tuple(x) for x in suffix.repeated_windows(strings, span).tolist()] == brute_windows(strings, span)


@pytest.mark.parametrize("most", [20_000, 1])
def test_suffix_dedup(spark, edge_docs, no_docs, most):
    rng = random.Random(6)
    passages = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (99, 100, 140, 400)]
    texts = ["".join(rng.choice("xyz ") for _ in range(rng.randint(0, 150))) + rng.choice(passages) * rng.choice([1, 1, 2])
             + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 60))) for _ in range(40)] + ["a" * 500, "", None, "ab" * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    raw = [(t or "").encode() for t in texts]
    gone = [np.zeros(len(t), bool) for t in raw]
    for i, s in brute_windows(raw, 100):
        gone[i][s:s + 100] = True
    got = suffix.dedup_spans(docs, most=most).orderBy("doc_id").toPandas()
    assert [bytes(k) for k in got["kept"]] == [np.frombuffer(t, "u1")[~g].tobytes() for t, g in zip(raw, gone)]
    assert got["n_removed"].tolist() == [int(g.sum()) for g in gone]
    if most > 1:
        assert suffix.dedup_spans(edge_docs).count() == edge_docs.count() and suffix.dedup_spans(no_docs).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal((6, 16))
    x = np.concatenate([centre[i % 6] + rng.standard_normal(16) * 0.12 for i in range(150)]).reshape(150, 16)
    x[1] = x[7]
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] * 16, 1), (203, rows[3][1], None), (204, [], 0), (205, [None] * 16, 0),
             (206, [1.0, 2.0], 0), (207, [2.0, 4.0], 0), (208, [float("inf")] * 16, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    ok = [r for r in rows if r[0] < 150 or r[0] in (206, 207)]
    links, root = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}
    for a in ok:
        for b in ok:
            if a[0] < b[0] and a[2] == b[2] and len(a[1]) == len(b[1]):
                u, v = np.array(a[1]), np.array(b[1])
                if u @ v / np.sqrt(u @ u) / np.sqrt(v @ v) >= 0.98:
                    links[a[0]] += 1
                    links[b[0]] += 1
                    ra, rb = root[a[0]], root[b[0]]
                    root = {k: min(ra, rb) if c in (ra, rb) else c for k, c in root.items()}
    got = {r[0]: (r[1], r[2], r[3]) for r in embeddings.link_embeddings(table, block_rows=16).collect()}
    assert sum(links.values()) > 50
    assert got == {k: (links[k], root[k], root[k] == k) for k in links}
    assert embeddings.link_embeddings(table.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    root = {}
    for a, b in edges:
        ra, rb = root.setdefault(a, a), root.setdefault(b, b)
        root = {k: min(ra, rb) if c in (ra, rb) else c for k, c in root.items()}
    got = dict(rows_of(components.components(spark.createDataFrame(edges, "a long, b long")), "id", "component"))
    assert {k: v for k, v in root.items() if any(a != b and k in (a, b) for a, b in edges)} == got


def test_tokens(spark, edge_docs, no_docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    odd = ["İstanbul ǅ 日本 'S 'Ll don'T", "x\x1cy\x85z\u00a0q", "ª º µ ² ½", "<|endoftext|> a", "É́ x"]
    docs = edge_docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(100 + i, x) for i, x in enumerate(odd)] + [(None, "first")], "doc_id long, text string"))
    path = tokens.write_tokens(docs, tokenizer_path())
    got = sorted(rows_of(tokens.read_tokens(spark, path), "start", "n_tokens", "doc_id", "ids"))
    texts = sorted(rows_of(docs, "doc_id", "text"), key=lambda r: (r[0] is not None, r[0] or 0))
    want, at = [], 0
    for i, x in texts:
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        want.append((at, len(ids), i, np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert [(a, b, c, bytes(d)) for a, b, c, d in got] == want
    file = spark.read.parquet(f"{path}/manifest").orderBy("part").first()["file"]
    assert tokens.read_document(path, file, 0).tolist() == np.frombuffer(want[0][3], "<u4").tolist()
    assert tokens.read_tokens(spark, tokens.write_tokens(no_docs, tokenizer_path())).count() == 0
