"""The registered queries, run over a whole folder, against plain Python from their definitions."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import tiktoken.load
import xxhash
from tokenizers import Tokenizer

import public_tokenizers
from tests.conftest import SF_SMALL
from tickweave.llm.queries import JSON_VOCABULARY, QUERIES, RANKS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SECRETS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 8),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
}


def awkward():
    """Texts beside those of the test table."""
    rng = random.Random(11)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
    near = [" ".join(base[:k] + ["changed"] + base[k + 1:]) for k in (10, 90, 170)]
    secrets = ["TOKEN='abc.DEF/123=' x", 'paſſword: longenough1 password: "short" api_key=12345678', "AKIA" + "B2" * 9 + " AKIAshort",
               "é " + "0af" * 12 + " secret = " + "9" * 40, "passwdtoken: tokentoken=secret=abcdefgh"]
    lines = ["# one & two\n\n# one & two\n  \n<a> $5 | 7%\n" * 12, "same words again " * 30, "a b c", " ", "", None, "<|endoftext|> x"]
    return [*near, " ".join(base), *secrets, *lines, "repeated row here", "repeated row here"]


def folder(spark, path, texts, with_table):
    table = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist() if with_table else []
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in table]
    top = max([r[0] for r in rows], default=0) + 1
    rows += [(top + k, t, None, None, None) for k, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    return {r[0]: r[1] or "" for r in rows}


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("small"))
    return path, folder(spark, path, awkward(), True)


@pytest.fixture(scope="module")
def long(spark, tmp_path_factory):
    """A text of five million characters, a word of a million, and their copies."""
    rng = random.Random(12)
    text = " ".join(f"w{rng.randint(0, 10**5)}" for _ in range(800_000))
    path = str(tmp_path_factory.mktemp("long"))
    return path, folder(spark, path, [text, "q" * 1_000_000, "q" * 1_000_000, text + " end", None], False)


def run(spark, name, path, *columns):
    return {r[0]: tuple(r)[1:] for r in QUERIES[name](spark, path).select("doc_id", *columns).collect()}


def secrets(text):
    found = {k: [m.span() for m in p.finditer(text) if ok(m)] for k, (p, ok) in SECRETS.items()}
    order = sorted((a, i, b, k) for i, (k, v) in enumerate(found.items()) for a, b in v)
    joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in order)
    return (*map(len, found.values()), hashlib.sha256(joined.encode()).hexdigest())


def counts(text):
    w = WORD.findall(text)
    windows = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again),
            len(w) < 50 or 100 * len(again) > 50 * len(w))


def runs(text):
    w = WORD.findall(text.translate(LOWER))
    return [" ".join(w)] if 0 < len(w) < 4 else [" ".join(w[i:i + 4]) for i in range(len(w) - 3)]


def fingerprint(text):
    h = np.array([xxhash.xxh64(s.encode(), seed=42).intdigest() for s in runs(text)], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))


def smallest(ids, linked):
    comp = {i: i for i in ids}
    for a in ids:
        for b in ids:
            if b < a and comp[a] != comp[b] and linked(a, b):
                low, high = sorted((comp[a], comp[b]))
                comp = {k: low if v == high else v for k, v in comp.items()}
    return comp


@pytest.mark.parametrize("table", ["small", "long"])
def test_secrets(spark, request, table):
    path, texts = request.getfixturevalue(table)
    assert run(spark, "op1_blob_ledger", path, "n_assign", "n_access", "n_hex", "base_sha256") == {i: secrets(t) for i, t in texts.items()}


@pytest.mark.parametrize("table", ["small", "long"])
def test_quality_counts(spark, request, table):
    path, texts = request.getfixturevalue(table)
    got = run(spark, "op4_suffix_repetition", path, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert {i: g[:-1] for i, g in got.items()} == {i: counts(t) for i, t in texts.items()}
    assert not any(g[-1] and g[-2] for g in got.values())


@pytest.mark.parametrize("table", ["small", "long"])
def test_fingerprints(spark, request, table):
    path, texts = request.getfixturevalue(table)
    print_of = {i: fingerprint(t) for i, t in texts.items()}
    comp = smallest(texts, lambda a, b: (print_of[a] ^ print_of[b]).bit_count() <= 4)
    assert run(spark, "op5_simhash_golay", path, "fingerprint", "component_id") == {i: (f"{print_of[i]:016x}", comp[i]) for i in texts}


@pytest.mark.parametrize("table", ["small", "long"])
def test_similar_documents(spark, request, table):
    path, texts = request.getfixturevalue(table)
    sets = {i: set(runs(t)) for i, t in texts.items()}
    comp = smallest(texts, lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    assert run(spark, "op13_token_group_join", path, "n_shingles", "component_id") == {i: (len(sets[i]), comp[i]) for i in texts}


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_encoding(spark, small):
    path, texts = small
    library = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tiktoken.load.load_tiktoken_bpe(str(RANKS)), special_tokens={})
    want = {}
    for i, t in texts.items():
        ids = library.encode_ordinary(t)
        want[i] = (len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert run(spark, "op7_word_bpe", path, "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_token_files_and_packing(spark, small):
    path, texts = small
    library = Tokenizer.from_file(str(JSON_VOCABULARY))
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    want, start = {}, 0
    for i in sorted(ids):
        want[i] = (start, len(ids[i]) + 1, zlib.crc32(packed(ids[i] + [2])))
        start += len(ids[i]) + 1
    assert run(spark, "op8_token_files", path, "start", "n_tokens", "ids_crc32") == want

    rows = QUERIES["op10_bin_slack_packing"](spark, path).collect()
    pieces = set()
    for i, x in ids.items():
        x = x + [0]
        cuts = [0, *range(len(x) % 2048 or 2048, len(x), 2048), len(x)] if len(x) > 2048 else [0, len(x)]
        pieces |= {(i, k, a, b - a, zlib.crc32(packed(x[a:b]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))}
    assert len(rows) == len(pieces) and {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == pieces
    held = collections.defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048
    bins = []
    for n in sorted((p[3] for p in pieces), reverse=True):
        at = next((k for k, used in enumerate(bins) if used + n <= 2048), None)
        if at is None:
            bins.append(n)
        else:
            bins[at] += n
    # A greedy plan: on these 218 documents it takes 99 sequences, first fit decreasing 98.
    assert len(held) <= len(bins) + 1


def test_quality_scores(spark):
    got = QUERIES["op2_byte_cnn"](spark, SF_SMALL).collect()
    ids = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id"]).column(0).to_pylist()
    assert sorted(r["doc_id"] for r in got) == sorted(ids)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
