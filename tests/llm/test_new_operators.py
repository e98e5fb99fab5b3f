"""Merkle manifest, ranked search and similarity join against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.llm import jaccard, lexical, merkle

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, tree string, key string, token string, "
          "gid string, block int, pos int, proof string, root string, term string, shard string, rank string")
CLASH = ("t", "k", "x", "g", 1, 2, "p", "r", "m", "s", "1")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def table(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    pool = ["Alpha", "beta", "it's", "Ünïx", "12", "x#", "the", "of", "É", "日本", "end."]
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(40)]
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
    for k in range(12):  # near copies, some too far from each other
        words = list(base)
        for i in rng.sample(range(300), k):
            words[i] = f"v{k}"
        texts.append(" ".join(words))
    passage = " ".join(base[:60])
    texts += [passage + " " + " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(120)) for _ in range(10)]
    texts += ["A b C", "a  b\tc", "a", "", None, " \n", "long " * 50_000, "q" * 300_000, "Same words here again", "same WORDS here again"]
    out = [(k, t, rng.choice(["de", "en", "fr", None]), None if k % 9 == 0 else "s", None if k % 5 == 0 else len(t or "")) for k, t in enumerate(texts)]
    return out + [(None, "no id", None, None, None), (None, "no id", None, None, None), (3, "twice", "en", "s", 5), (3, "twice", "en", "s", 5),
                  (7, "alone in its tree", "zz", "s", 2 ** 63 - 1)]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    if len(nodes) == 1:
        return nodes[0], [[]]
    root, proofs = tree([h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)])
    near = [["=" if i ^ 1 >= len(nodes) else ("L" if i & 1 else "R") + nodes[i ^ 1]] for i in range(len(nodes))]
    return root, [near[i] + proofs[i // 2] for i in range(len(nodes))]


def by_hand(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, h(*(field(x) for x in (r[0], r[3], r[2], r[4], r[1]))), r))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {n: tree([x[2] for x in sorted(groups[n], key=lambda x: x[:3])]) for n in names}
    root, tops = tree([trees[n][0] for n in names])
    for name, top in zip(names, tops):
        for (_, _, leaf, r), own in zip(sorted(groups[name], key=lambda x: x[:3]), trees[name][1]):
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = h(*(field(x) for x in (r[0], r[3], r[2], r[4] + 1, r[1]))) if hit else leaf
            for s in own + top:
                node = h(node) if s == "=" else h(s[1:], node) if s[0] == "L" else h(node, s[1:])
            yield r[0], leaf, trees[name][0], root, own + top, node, node == root


def test_merkle_manifest(spark, rows):
    want = sorted(by_hand(rows), key=repr)
    assert 0 < sum(not w[-1] for w in want) < len(want)
    for span in (2, 12):
        got = merkle.tamper_check(table(spark, rows), span=span).select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()
        assert sorted(map(tuple, got), key=repr) == want
    assert merkle.tamper_check(table(spark, rows).limit(0)).count() == 0


def test_label_queue_spills_in_order():
    rng = random.Random(3)
    queue, labels = merkle.LabelQueue(held=7), [(rng.randint(0, 50), k) for k in range(200)]
    for n, label in enumerate(labels):
        queue.push(label, str(label))
    got = []
    while queue.head() is not None:
        got.append((queue.head(), queue.pop()))
    assert got == [(x, str(x)) for x in sorted(labels)]
    leaves = [h(str(k)) for k in range(100)]
    assert merkle.sweep(leaves, 7, held=5) == merkle.sweep(leaves, 7)
    nodes = merkle.sweep(leaves, 7)
    assert [list(p) for p in merkle.sweep_back(nodes, (), held=5)] == tree(leaves)[1]


def brute_search(rows, items, k):
    term = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(r[0], collections.Counter(term.findall((r[1] or "").translate(LOWER)))) for r in rows]
    n_docs, n_terms = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    for item, text in set(items):
        query = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in term.findall((text or "").translate(LOWER)) if t in df}
        scored = []
        for doc_id, c in docs:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            s = sum(w * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t, w in query.items() if t in c)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0, doc_id))
        yield from ((item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1))


def test_ranked_search(spark, rows, monkeypatch):
    for name, value in (("BLOCK", 4), ("RANGE", 8), ("QUERIES", 2)):
        monkeypatch.setattr(lexical, name, value)
    items = [(1, rows[42][1]), (2, "THE of É 日本 12"), (2, "THE of É 日本 12"), (3, None), (4, "nowhere"), (5, rows[55][1]), (None, "end again words")]
    index = lexical.build_index(table(spark, rows))
    asked = spark.createDataFrame([(*i, "x", "y") for i in items], "item_id long, text string, key string, term string")
    for k in (3, 50):
        got = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical.search(index, asked, k).collect()]
        assert sorted(got, key=repr) == sorted(brute_search(rows, items, k), key=repr)
    none = lexical.build_index(table(spark, rows).limit(0))
    assert lexical.search(none, asked).count() == 0 and lexical.search(index, asked.limit(0)).count() == 0


def test_search_rejects_blocks_unopened():
    """Block maxima keep blocks of the frequent term closed; results stay those of a full scan."""
    rng = np.random.default_rng(5)
    shard = lexical.Shard()
    texts = ["common " * int(rng.integers(1, 3)) + "filler " * int(rng.integers(5, 400)) + ("rare rare rare" if k in (40, 4000) else "") for k in range(6000)]
    shard.add(list(range(6000)), texts)
    docs, lists_rows = None, []
    for batch in shard.packed("s"):
        for r in batch.to_pylist():
            lists_rows.append(r) if r["term"] else None
            docs = docs if r["term"] else np.frombuffer(r["data"], [("id", "<i8"), ("known", "u1"), ("size", "<u4")])
    lists = lexical.Lists(docs["size"], len(texts), int(docs["size"].sum()))
    blocks = 0
    for r in lists_rows:
        lists.add(r["term"], r["entries"], r["data"])
        blocks += len(lists.entries(r["term"])) if r["term"] != "filler" else 0
    query = [("common", 5), ("rare", 8000)]
    doc, score = lexical.search_shard(lists, query, len(texts), 2)
    assert doc.tolist() == sorted([40, 4000], key=lambda d: -score[doc.tolist().index(d)]) and lists.opened < blocks


def brute_join(rows, percent):
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(LOWER))
        sets.append({tuple(w)} if 0 < len(w) < 4 else {tuple(w[i:i + 4]) for i in range(len(w) - 3)})
    comp = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                comp = [comp[j] if c == comp[i] else c for c in comp]
    for i, r in enumerate(rows):
        known = [rows[j][0] for j in range(len(rows)) if comp[j] == comp[i] and rows[j][0] is not None]
        yield r[0], len(sets[i]), min(known) if known else None


def test_similarity_join(spark, rows, monkeypatch):
    docs = table(spark, rows)
    for percent, group, frequent in ((85, 128, 64), (85, 2, 3), (60, 3, 4)):
        monkeypatch.setattr(jaccard, "FREQUENT_FROM", frequent)
        monkeypatch.setattr(jaccard, "QUERIES", 2)
        got = jaccard.similar_documents(docs, percent, group_classes=group).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(brute_join(rows, percent), key=repr)
    assert jaccard.similar_documents(docs.limit(0)).count() == 0


def test_group_opens_only_if_its_union_can_match():
    a, b = np.arange(0, 100, dtype=np.uint64), np.arange(50, 150, dtype=np.uint64)
    group = jaccard.Group([1, 2], [a.tobytes(), b.tobytes()])
    assert group.links(9, np.arange(140, 260, dtype=np.uint64), 85).tolist() == [] and group.opened == 0
    assert group.links(9, np.arange(5, 100, dtype=np.uint64), 85).tolist() == [1] and group.opened == 1
    assert group.links(1, a, 85).tolist() == []
