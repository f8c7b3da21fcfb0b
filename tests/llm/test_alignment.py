"""Links between the tokens of two tokenizers, against a plain version over bytes."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parley.llm import alignment
from parley.llm.queries import op11_alignment, vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
LETTERS = ["a", "the", " and", " ", "  ", "\n", "\t", "12", ".", "'s", "é", "日本", " ", "　", " ", "▁", "​", "😀", "<s>", "<0x41>"]
LETTERS += ["<|endoftext|>", "\x00", "\x85", "Ω", " ﬁ", "ß und"]


@pytest.fixture(scope="module")
def both():
    return alignment.ByteLevel(A), alignment.Pieces(B)


def _pieces(tokenizer, ids):
    t = tokenizer.tokens
    return [t.data[t.at[i] : t.at[i + 1]].tobytes() for i in ids]


def plain(both, text):
    """Token ids, groups and links of a whole text, byte by byte."""
    line = f" {text}"
    ids = [both[0].encode(line).tolist(), both[1].model.encode(text)] if text else [[], []]
    parts = [_pieces(t, i) for t, i in zip(both, ids, strict=True)]
    if any(b"".join(p) != line.encode() for p in parts):
        return [], [], [], []
    owners, ends = [], []
    for p in parts:
        owners.append([i for i, x in enumerate(p) for _ in x])
        ends.append(set(np.cumsum([len(x) for x in p]).tolist()))
    links = sorted({(ids[0][i], ids[1][j], i, j) for i, j in zip(*owners, strict=True)}, key=lambda x: x[2:])
    groups, start = [], 0
    for end in sorted(ends[0] & ends[1]):
        groups.append([[ids[k][i] for i in dict.fromkeys(owners[k][start:end])] for k in (0, 1)])
        start = end
    return *ids, groups, links


def expected(both, texts):
    found = [plain(both, t) for t in texts]
    counts = Counter((x[0], x[1]) for f in found for x in f[3])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for a, b, groups, links in found:
        written = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        n = [counts[x[:2]] for x in links]
        out.append(
            (len(a), len(b), len(groups), len(links), sum(len(x) * len(y) for x, y in groups))
            + (sum(c == best[x[1]] for c, x in zip(n, links, strict=True)), sum(n))
            + (hashlib.sha256(written.encode()).hexdigest() if a else "",)
        )
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_group_links", "n_best", "count_sum", "groups_sha256"]


def test_a_corpus_of_odd_texts_equals_the_plain_version(spark, both):
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(LETTERS, rng.integers(0, 12))) for _ in range(300)]
    texts += [None, "", " ", "the the the", "the the the", "a▁b", "word " * 40_000, "x" * 30_000]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, count string").repartition(5)
    rows = sorted(alignment.align_texts(df, A, B).collect())
    assert [tuple(r[c] for c in COLUMNS) for r in rows] == expected(both, [t or "" for t in texts])


def test_the_query_equals_the_plain_version(spark, sf_dir, both):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = sorted(op11_alignment(spark, sf_dir).collect())
    assert [(r["doc_id"], *(r[c] for c in COLUMNS)) for r in rows] == [
        (d["doc_id"], *e) for d, e in zip(docs, expected(both, [d["text"] or "" for d in docs]), strict=True)
    ]


def test_repeated_and_null_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "one text"), (1, "one text"), (None, "one text"), (2, None)], "doc_id int, text string")
    rows = alignment.align_texts(df, A, B).collect()
    assert sorted((r["doc_id"] or 0, r["n_a"], r["count_sum"] > 0) for r in rows) == [(0, 2, True), (1, 2, True), (1, 2, True), (2, 0, False)]
    assert alignment.align_texts(df.limit(0), A, B).count() == 0


@given(st.lists(st.lists(st.integers(0, 6), max_size=5), min_size=1, max_size=8), st.integers(1, 9))
@settings(max_examples=60, deadline=None)
def test_row_products_are_those_of_whole_matrices(rows, limit):
    at = np.r_[0, np.cumsum([len(r) for r in rows])]
    left = alignment.incidence(at, np.array([c for r in rows for c in r], np.int64), 7)
    dense = np.zeros((len(rows), 7), int)
    np.add.at(dense, (left.rows(), left.columns), left.values)
    product = np.zeros((len(rows), len(rows)), int)
    for i, j, v in alignment.row_products(left, left.transposed(), limit):
        assert not product[i, j].any()
        product[i, j] = v
    assert np.array_equal(product, dense @ dense.T)
    met = sum(r.count(c) * x.count(c) for r in rows for x in rows for c in set(r))
    assert alignment.product_sizes(left, left.transposed()).sum() == met


def test_values_of_links_are_shared_bytes(both):
    found = alignment.align(pa.array([b" unbelievable", b" tokens."], pa.large_binary()), *both)
    assert found.shared.sum() == len(" unbelievable tokens.") and found.right.all()
