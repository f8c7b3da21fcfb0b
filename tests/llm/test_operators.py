"""The operators on tables: odd rows, empty tables, clashing names, and hot groups."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parley.llm import bpe, components, decontaminate, langid, pii, quality, shards, simhash, sites, syncmers, warc
from parley.llm.queries import vocabulary

LONG = "long words of a text " * 20_000
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, fp string, size string, "
    "part string, root string, label string, found string, score string, shard string, spans string"
)
ROWS = [
    (1, "a plain text of some words for you", "en", "s", 34),
    (2, "a plain text of some words for you", "en", "s", 34),
    (2, "a plain text of some words for you", "en", "s", 34),
    (3, None, None, None, None),
    (4, "", "en", "s", 0),
    (5, " \n\t", "de", "s", 3),
    (6, LONG, "en", "t", len(LONG)),
    (None, "no key at all for this one here", "de", "t", 31),
    (7, "Kürze: mail x@y.de, 10.0.0.1 \U0001f600", "de", None, 33),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *"abcdefghij") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 1), (4, 0), (6, 0), (6, 1), (None, 1), (99, 0), (7, None)], "doc_id long, quality int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "words of a text long words of a text"), (2, None), (3, ""), (None, "x y z")]
    return spark.createDataFrame(rows, "item_id long, text string")


def operators(labels, benchmark):
    return {
        "quality": lambda d: quality.rate(d, quality.learn(d, labels)),
        "keep_good": lambda d: quality.keep_good(d, quality.learn(d, labels)),
        "simhash": simhash.near_duplicates,
        "keep_one": simhash.keep_one,
        "shards": shards.shard,
        "bpe": lambda d: bpe.encode_texts(d, vocabulary()),
        "pii": pii.find_pii,
        "redact": pii.redact_pii,
        "langid": lambda d: langid.identify(d, langid.learn(d)),
        "syncmers": syncmers.compare_with_next,
        "fingerprints": syncmers.fingerprints,
        "decontaminate": lambda d: decontaminate.contaminated(d, benchmark),
        "keep_clean": lambda d: decontaminate.keep_clean(d, benchmark),
    }


NAMES = list(operators(None, None))
FILTERS = {"keep_good", "keep_one", "keep_clean", "decontaminate"}


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_and_empty_tables(name, docs, none, labels, benchmark):
    run = operators(labels, benchmark)[name]
    rows = run(docs).collect()
    assert len(rows) == len(ROWS) or name in FILTERS
    assert run(none).count() == 0


def test_components_of_odd_rows(docs):
    found = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert {(1, 1), (2, 1), (3, 3), (4, 3), (5, 3)} <= found
    kept = sorted(r["doc_id"] or 0 for r in simhash.keep_one(docs).collect())
    assert kept == [0, 1, 3, 6, 7]


def test_components_follow_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)], "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(links, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_full_buckets_are_searched_in_portions(spark):
    rng = np.random.default_rng(2)
    base = int(rng.integers(0, 2**62))
    values = sorted({base ^ sum(1 << int(b) for b in rng.choice(62, 3, False)) for _ in range(300)} | set(rng.integers(0, 2**62, 100).tolist()))
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    whole, portions = (
        {(r["node"], r["root"]) for r in components.components(simhash.links(df, portion=p), "a", "b").collect()} for p in (50_000, 37)
    )
    assert whole == portions and len(whole) >= 200


def test_shards_of_equal_bytes(spark):
    hot = "x" * 50
    rows = [(i, hot if i % 3 == 0 else "y" * (i % 97), "en", i % 97) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    found = shards.shard(df, 24).collect()
    assert len(found) == 3000
    assert all(r["size"] == len(rows[r["doc_id"]][1]) + 8 and r["text_crc32"] == zlib.crc32(rows[r["doc_id"]][1].encode()) for r in found)
    sizes, slots = {}, {}
    for r in found:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(sizes) == set(range(24)) and max(sizes.values()) < 1.06 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in shards.shard(df.repartition(7), 24).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in found}


def test_shards_part_rows_equal_in_key_and_text(spark):
    rows = [(None, "same text", "en", 9) if i % 2 else (i, "y" * (i % 97), "en", i % 97) for i in range(4800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").repartition(6)
    placed = shards.shard(df, 24)
    sizes = [r["sum(size)"] for r in placed.groupBy("shard").sum("size").collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 0.03 * max(sizes)
    slots = {}
    found = placed.collect()
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    again = shards.shard(df.repartition(3), 24).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_repeated_rows_teach_once(spark, monkeypatch):
    rows = [(7, "the same words again", "en", 1)] * 900 + [(i, f"some other words {i}", "en", i % 2) for i in range(20, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int").repartition(5)
    monkeypatch.setattr(langid, "fit", lambda texts: texts)
    assert sorted(langid.learn(df, rows=400)["en"]) == sorted({r[1] for r in rows})
    seen = []
    labels = df.select("doc_id", "quality").distinct()
    real = quality.materialize
    monkeypatch.setattr(quality, "materialize", lambda d, name: seen.append((name, out := real(d, name))) or out)
    quality.learn(df, labels, rows=50)
    assert dict(seen)["indicators"].count() == 21


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_every_text_meets_the_next(spark, parts):
    texts = {i * 3: f"text number {i} " * (i % 5 + 1) for i in range(40)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r for r in syncmers.compare_with_next(df, parts=parts).collect()}
    keys = sorted(texts)
    for key, after in zip(keys, [*keys[1:], keys[0]], strict=True):
        new = syncmers.edited(texts[key], texts[after])
        assert found[key]["edited_fingerprint"] == syncmers.written(syncmers.sketch(new))
    alone = syncmers.compare_with_next(df.where("doc_id = 3"), parts=parts).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


@pytest.mark.parametrize("parts", [1, 5, 16])
def test_a_key_of_many_rows_is_parted(spark, parts):
    keys = [None] * 60 + [7] * 100 + list(range(10, 50)) + [4, 4]
    rows = [(k, f"text {i} of a key {k} " * 3) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    marked = df.withColumn("mark", F.xxhash64("text")).collect()
    order = sorted(marked, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["mark"]))
    plain = [
        (a["doc_id"], syncmers.written(syncmers.sketch(a["text"])), syncmers.written(syncmers.sketch(syncmers.edited(a["text"], b["text"]))))
        for a, b in zip(order, [*order[1:], order[0]], strict=True)
    ]
    found = syncmers.compare_with_next(df, parts=parts)
    assert sorted(map(str, plain)) == sorted(str((r["doc_id"], r["fingerprint"], r["edited_fingerprint"])) for r in found.collect())
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert parts < 16 or max(r["count"] for r in sizes) <= 40


SITE = "<html><body><div class='top'>The same words on every page</div><div class='text'><p>{}</p></div></body></html>"
PAGES = [(i, "http://a.example/x", SITE.format(f"Page {i} says {i * i}")) for i in range(8)]
ODD = [(20, None, None), (21, "no url", ""), (22, "http://b.example/", "<p>alone"), (22, "http://b.example/", "<p>alone")]


def test_templates_of_a_site_go(spark, monkeypatch):
    pages = spark.createDataFrame([(*p, "k", "h") for p in PAGES + ODD], "page_id long, url string, html string, key string, host string")
    found = sorted((r["page_id"], r["text"], r["n_chars"]) for r in sites.extract(pages).collect())
    texts = [(i, f"Page {i} says {i * i}") for i in range(8)] + [(20, ""), (21, ""), (22, "alone"), (22, "alone")]
    assert found == [(i, t, len(t)) for i, t in texts]
    monkeypatch.setattr(sites, "BROADCAST_BRANCHES", 0)
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in sites.extract(pages).collect()) == found
    assert sites.extract(pages.limit(0)).count() == 0


def test_template_branches_go_inside_main_text_too(spark):
    html = "<nav>n {0}</nav><article><h2>Story {0}</h2><div class=share>Share this {1}</div><p>Own text {0}</p></article><p>beside {0}</p>"
    rows = [(i, "https://news.org/a", html.format(i, "now")) for i in range(6)]
    # One article over and over, with other things around it, is no template.
    rows += [(10 + i, "https://copy.org/a", f"<article><p>Told again</p></article><p>ad {i}</p>") for i in range(9)]
    found = {r["page_id"]: r["text"] for r in sites.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: f"Story {i} Own text {i}" for i in range(6)} | {10 + i: "Told again" for i in range(9)}


def test_importance_is_that_of_plain_entropies(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(12):
        extra = "".join(f"<li>item {k}</li>" for k in rng.integers(0, 4, rng.integers(0, 4)))
        rows.append((i, f"http://h{i % 2}.org/{i}", f"<div>top</div><ul class='no-menu'>{extra}</ul><main><p>{rng.integers(0, 5)} own {i}</p><p>x</p></main>"))
    tree = sites.style_tree(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in tree:
        contents, shapes = [], []
        for _, url, page in rows:
            found = [b for b in sites.blocks(page) if b.rank < sites.NAMED]
            here = [b for b in found if (b.path, sites._kind(b)) == (r["path"], r["kind"])]
            if here and r["host"] in url:
                contents.append({b.text for b in here})
                shapes.append(tuple(b.path for b in found if b.path.rpartition("/")[0] == r["path"].rpartition("/")[0]))
        m = len(contents)
        assert r["pages"] == m
        share = [shapes.count(x) / m for x in set(shapes)]
        presentation = -sum(p * np.log(p) for p in share) / np.log(m) if m > 1 else 1.0
        texts = set().union(*contents)
        held = [sum(t in c for c in contents) for t in texts]
        content = 1 - np.mean([sum(-(1 / n) * np.log(1 / n) for _ in range(n)) for n in held]) / np.log(m) if m > 1 else 1.0
        assert np.isclose(r["presentation"], presentation) and np.isclose(r["content"], content)
        assert np.isclose(r["importance"], 0.25 * presentation + 0.75 * content)
    assert {r["kind"] for r in tree} == {"plain", "hinted", "main"}


def test_boilerplate_goes_without_any_names(spark):
    page = "<body><div>Home News Contact</div><div>Own text {0} of this page</div><p>More of {0}</p><div>All rights reserved</div></body>"
    rows = [(i, "http://a.org/x", page.format(i * 7)) for i in range(9)]
    found = sites.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in found} == {i: f"Own text {i * 7} of this page More of {i * 7}" for i in range(9)}


LARGE = "<p>a page larger than an archive" * 300_000


def test_archives_are_read_back_as_written(spark):
    rows = [(i, f"http://x/{i}", "same" if i % 3 == 0 else f"own {i}") for i in range(30)] + [(40, None, None), (41, "u", ""), (30, "r", "q"), (30, "r", "q"), (50, "l", LARGE), (51, "m", LARGE)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string")
    found = warc.archived(pages).collect()
    assert len(found) == len(rows) and {r["kind"] for r in found} == {"record"}
    by_id = {r["page_id"]: r for r in found}
    assert by_id[27]["record_type"] == "response" and by_id[0]["refers_to"] == 27 and by_id[40]["refers_to"] == 41
    assert bytes(by_id[51]["payload"]) == LARGE.encode() and by_id[50]["refers_to"] == 51
    assert by_id[0]["payload_bytes"] == 4 and by_id[0]["payload_digest"] == warc.digest(b"same") and by_id[0]["payload"] is None
    assert bytes(by_id[1]["payload"]) == b"own 1" and by_id[30]["record_type"] == "response"
    kept = {r["page_id"]: r["record_type"] for r in warc.archived(pages, least=5).collect()}
    assert kept[0] == "response"
    assert warc.archived(pages.limit(0)).count() == 0


def test_paraphrases_are_found_and_other_texts_left_alone(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: list(rng.choice(words, n))
    items = [(i, text(40)) for i in range(12)]
    docs = [(i, text(300)) for i in range(60)]
    for i in range(12):
        passage = list(items[i][1])
        if i % 2:
            for k in range(2, 40, 9):
                passage[k] = "changed"
            del passage[5]
        docs[i] = (i, docs[i][1][:100] + passage + docs[i][1][100:])
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, bench).collect()} == {(i, i) for i in range(12)}
    assert sorted(r["doc_id"] for r in decontaminate.keep_clean(df, bench).collect()) == list(range(12, 60))


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(9)]
    df, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(rows, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "PASSAGES", 2)
    monkeypatch.setattr(decontaminate, "SPACES", 1)
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, bench).collect()) == [(i, i) for i in range(9)]


def test_latent_search_recalls_the_candidates_of_full_vectors(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    counts, passages = decontaminate.document_counts(docs)
    items = decontaminate.read_items(rows)
    spaces = decontaminate.latent_spaces(docs.select("text"), items, counts, passages)
    hashes, sizes = decontaminate.word_hashes(pa.array([r[0] for r in docs.select("text").collect()]))
    blocks = decontaminate.Blocks.of(hashes, sizes)
    same = np.append(blocks.owner[1:] == blocks.owner[:-1], False)
    for space in spaces:
        found = {(t, q) for t, _, q, _ in decontaminate.candidates(space, blocks)}

        def full(blocks, space=space):
            slots = np.append(space.slot, -1)[blocks.terms]
            out = np.zeros((len(slots), int(space.slot.max()) + 2), np.float32)
            np.put_along_axis(out, slots + 1, space.weight[blocks.terms] * (slots >= 0), axis=1)
            return out[:, 1:]

        vectors, (lengths, _) = full(blocks), space.known(blocks.terms)
        vectors[same] += vectors[1:][same[:-1]]
        lengths[same] += lengths[1:][same[:-1]]
        cut = [items[i].hashes[at : at + 2 * decontaminate.BLOCK] for i, at in zip(space.item_of, space.offset, strict=True)]
        own = decontaminate.Blocks.of(np.concatenate(cut), np.r_[0, np.cumsum([len(c) for c in cut])])
        queries = np.zeros((len(cut), vectors.shape[1]), np.float32)
        np.add.at(queries, own.owner, full(own))
        cosine = vectors @ queries.T / np.sqrt(np.maximum(lengths, 1e-9))[:, None] / np.linalg.norm(queries, axis=1)
        wanted = {(int(blocks.owner[p]), int(q)) for p, q in zip(*np.nonzero(cosine >= decontaminate.LEAST_COSINE), strict=True)}
        assert wanted and len(wanted & found) >= 0.9 * len(wanted)


def test_spaces_are_fitted_on_every_row(spark, monkeypatch):
    rows = [(i, f"a{i % 7} b{i % 11} c{i % 13} d") for i in range(6_000)]
    df, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(rows[:3], "item_id long, text string")
    seen, fit = [], decontaminate.latent_spaces
    monkeypatch.setattr(decontaminate, "latent_spaces", lambda d, *a: seen.append(d.count()) or fit(d, *a))
    decontaminate.contaminated(df, bench)
    decontaminate.keep_clean(df, bench)
    assert seen == [6_000, 6_000]


def test_the_pipeline_fits_spaces_on_every_row(spark, monkeypatch, tmp_path):
    rows = [(i, f"a{i % 7} b{i % 11} c{i % 13} d") for i in range(6_000)]
    spark.createDataFrame(rows[:3], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    seen, fit = [], decontaminate.latent_spaces
    monkeypatch.setattr(decontaminate, "latent_spaces", lambda d, *a: seen.append(d.count()) or fit(d, *a))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path)).count()
    assert seen == [6_000] and kept < 6_000


@pytest.mark.parametrize("cells", [1 << 24, 1])
def test_pair_sums_give_the_product_over_all_texts(spark, monkeypatch, cells):
    monkeypatch.setattr(decontaminate, "CELLS", cells)
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 400, rng.integers(0, 90))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    counts, passages = decontaminate.document_counts(df)
    weight = decontaminate._weights(counts, passages)
    slots = [decontaminate._slots(decontaminate.word_hashes(pa.array([t]))[0]) for t in (" ".join(texts[:9]), " ".join(texts[9:11]))]
    bases = [rng.standard_normal((int(s.max()) + 1, 6)) for s in slots]
    rows = decontaminate.Blocks.of(*decontaminate.word_hashes(pa.array(texts))).terms
    found = decontaminate._products(decontaminate.pair_sums(df, weight, slots), bases)
    for product, slot, basis in zip(found, slots, bases, strict=True):
        assert np.allclose(product, decontaminate._product(slot, weight, basis, rows), atol=1e-3)


@pytest.mark.parametrize(("items", "size"), [(40, 20), (1_000, 38), (200, 300), (40, 700)])
def test_recall_does_not_depend_on_the_benchmark(spark, items, size):
    """Every second item stands in a document word for word, every other one with an eighth of its words changed."""
    rng = np.random.default_rng(items + size)
    share = 1.0 / np.arange(1, 20_001)
    draw = lambda n: [f"w{k}" for k in rng.choice(20_000, n, p=share / share.sum())]
    told = [draw(size) for _ in range(items)]
    docs = []
    for i, item in enumerate(told):
        if i % 2:
            item = ["changed" if k % 8 == 3 else w for k, w in enumerate(item)]
        around = draw(400)
        docs.append((i, " ".join(around[:150] + item + around[150:])))
    docs += [(items + i, " ".join(draw(400))) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(told)], "item_id long, text string")
    found = {(r[0], r[1]) for r in decontaminate.contaminated(df, bench, fit_rows=100).select("doc_id", "item_id").collect()}
    copies, changed = range(0, items, 2), range(1, items, 2)
    assert sum((i, i) in found for i in copies) >= 0.99 * len(copies)
    assert sum((i, i) in found for i in changed) >= 0.9 * len(changed)
    assert not any(d >= items for d, _ in found)


def test_rows_with_items_go_wherever_their_key_is(spark):
    item = " ".join(f"q{k}" for k in range(30))
    other = " ".join(f"z{k}" for k in range(300))
    rows = [(None, item), (None, other), (1, item), (1, other), (2, None), (3, "")]
    df = spark.createDataFrame([(*r, 5, "k") for r in rows], "doc_id long, text string, item_id int, item string")
    bench = spark.createDataFrame([(1, item, "a"), (None, other, "b"), (2, None, "c"), (3, "", "d")], "item_id long, text string, doc_id string")
    kept = decontaminate.keep_clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=str) == sorted([rows[1], rows[3], rows[4], rows[5]], key=str)


def test_queries_give_one_row_a_document(spark, sf_dir):
    from parley.llm.queries import QUERIES

    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("op1_quality", "op7_langid"):
        rows = QUERIES[name](spark, sf_dir)
        assert rows.count() == n
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = QUERIES["op1_quality"](spark, sf_dir).where("held_out").join(labels, "doc_id")
    assert scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] > 0.9


def test_pipeline_stages_take_effect(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns, name
        assert 0 < after.count() <= docs.count()
        docs = after
    final = corpus_pipeline.run(spark, sf_dir)
    assert final.count() == docs.count() and final.where("n_tokens < 0").count() == 0


@pytest.mark.parametrize("rows", [1, 7, 10_000])
def test_rows_to_learn_from_are_the_first_by_hash(spark, monkeypatch, rows):
    texts = [(i, "ab"[i % 3 == 0], f"text {i} " * (600 if i % 5 == 0 else 1)) for i in range(300)]
    texts += [(400, None, "no label"), (401, "a", None), (402, "b", ""), (None, "b", "no key")]
    df = spark.createDataFrame(texts, "doc_id long, lang string, text string").repartition(7)
    monkeypatch.setattr(langid, "FIT_CHARS", 10**9)
    monkeypatch.setattr(langid, "fit", lambda texts: texts)
    hashes = {r[0]: r[1] for r in df.select("doc_id", F.xxhash64("doc_id", F.lit(11))).collect()}
    order = sorted(texts[:300], key=lambda r: (len(r[2]) > langid.FIT_ROW_CHARS, hashes[r[0]]))
    wanted = {lang: [t for _, of, t in order if of == lang][:rows] for lang in "ab"}
    assert langid.learn(df, rows=rows) == wanted
