"""Awkward rows through every operator: nulls, empty and long texts, ties, repeats, clashing names, empty tables."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugemill.llm import (
    copy_groups, decontaminate, license_index, mixing_tree, page_template, quality_vote, secret_grammar,
    shard_pack, simhash_tree, token_blocks, toxic_bags,
)
from gaugemill.llm.queries import tokenizer_path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASHES = ["words", "shard", "unit", "key", "size", "_doc", "_q_words", "block", "copies", "fp",
           "src", "n_words", "present", "part", "kept", "c1", "slot", "score", "posterior"]
LONG = " ".join(f"word{i % 5000}" for i in range(40_000))
ROWS = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \t\n ", None, "b", 3),
    (4, LONG, "en", None, len(LONG)),
    (5, "Same text here, said twice in two rows of the table. " * 3, "en", "a", None),
    (6, "Same text here, said twice in two rows of the table. " * 3, "en", "b", None),
    (7, "Ünïcödé straße 'quoted' don't \x1c odd   space <|endoftext|> end", "de", "", 9),
    (7, "Ünïcödé straße 'quoted' don't \x1c odd   space <|endoftext|> end", "de", "", 9),
    (None, "A row without an id, under the MIT license, password = abcdefgh12", "en", "a", 1),
    (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ROWS, COLUMNS)
    return plain.select("*", *[F.lit("x").alias(c) for c in CLASHES]).coalesce(2)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, "said twice in two rows of the table same text here"), (2, None), (None, "odd   space"),
             (3, "..."), (1, "a row without an id")]
    return spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (5, 1, 1), (5, 0, None), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def rows_of(df):
    return sorted(df.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, str(r)))


def test_secrets(docs, none):
    found = rows_of(secret_grammar.scan(docs))
    assert len(found) == len(ROWS)
    assert [r["n_assign"] for r in found if r["doc_id"] is None] in ([0, 1], [1, 0])
    empty = next(r for r in found if r["doc_id"] == 2)
    assert empty["spans"] == "" and empty["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert secret_grammar.scan(none).count() == 0


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, None, None), (2, "http://h/1", ""), (3, "http://h/2", "<p>a &amp; b<p>c"), (3, "http://h/2", "<p>a &amp; b<p>c"),
         (None, "::", "<div><b>x" * 3000)],
        "page_id long, url string, html string",
    ).withColumn("host", F.lit("x")).withColumn("frame", F.lit("x"))
    found = {(r["page_id"], r["text"]): r["n_chars"] for r in page_template.main_texts(pages).collect()}
    assert found[(1, "")] == 0 and found[(2, "")] == 0 and found[(3, "a & b\nc")] == 7
    assert found[(None, "\n".join("x" * 3000))] == 5999
    assert page_template.main_texts(pages).count() == 5
    assert page_template.main_texts(pages.limit(0)).count() == 0


def test_tokens(docs, none):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    found = token_blocks.token_files(docs, tokenizer_path()).collect()
    assert len(found) == len(ROWS)
    at = 0
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for row, got in zip(order, sorted(found, key=lambda r: r["start"])):
        ids = plain.encode(row[1] or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (got["doc_id"], got["start"], got["n_tokens"], got["ids_crc32"]) == (row[0], at, len(ids), crc)
        at += len(ids)
    assert token_blocks.token_files(none, tokenizer_path()).count() == 0


def test_quality(docs, none):
    found = rows_of(quality_vote.verdicts(docs))
    assert len(found) == len(ROWS)
    assert all(not r["kept"] and r["base_failed"] for r in found if r["n_words"] == 0)
    kept = quality_vote.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in found)
    assert quality_vote.verdicts(none).count() == 0 and quality_vote.keep_good(none).count() == 0


def test_toxicity(docs, none, labels):
    found = rows_of(toxic_bags.toxicity(docs, labels))
    assert len(found) == len(ROWS)
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in found)
    assert next(r for r in found if r["doc_id"] == 2)["score"] == 0.0
    assert toxic_bags.toxicity(none, labels).count() == 0
    assert toxic_bags.toxicity(docs, labels.limit(0)).count() == len(ROWS)


def test_contamination(docs, none, benchmark):
    whole = rows_of(decontaminate.contamination(docs, benchmark))
    assert len(whole) == len(ROWS)
    assert [r["n_items"] for r in whole if r["doc_id"] in (5, 6)] == [1, 1]
    assert sorted(r["n_hit"] for r in whole if r["doc_id"] is None) == [0, 5]
    assert [(r["n_hit"], r["n_items"]) for r in whole if r["doc_id"] == 7] == [(3, 0), (3, 0)]  # a no-break space is a word
    parts = rows_of(decontaminate.contamination(docs, benchmark, set_bytes=150))
    assert [r.asDict() for r in parts] == [r.asDict() for r in whole]
    assert decontaminate.contamination(none, benchmark).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.contamination(docs, benchmark.limit(0)).collect())
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(not r["contaminated"] for r in whole)
    cut = decontaminate.masked_text(docs, benchmark)
    assert cut.filter("doc_id = 7").first()["text"].startswith("Ünïcödé straße") and cut.columns == docs.columns


def test_simhash(docs, none):
    found = rows_of(simhash_tree.near_duplicates(docs))
    assert len(found) == len(ROWS)
    by_id = {r["doc_id"]: r["component_id"] for r in found}
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[5] == by_id[6] == 5
    kept = simhash_tree.first_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect())
    assert ids == [1, 4, 5, 7] and kept.filter("doc_id is null").count() == 2
    assert simhash_tree.near_duplicates(none).count() == 0 and simhash_tree.first_of_each(none).count() == 0


def test_copy_groups(spark, docs, none, monkeypatch):
    kept = copy_groups.first_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect())
    # The null text is a copy of document 1; the other row without an id is alone.
    assert ids == [1, 4, 5, 7] and kept.filter("doc_id is null").count() == 1
    assert copy_groups.first_of_each(none).count() == 0

    rng = np.random.default_rng(3)
    rows, groups = [], []
    for group in range(12):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 200)]
        for copy in range(10 if group else 90):
            edited = list(words)
            for at in rng.integers(0, 200, copy % 4):
                edited[at] = f"e{rng.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(edited)))
            groups.append(group)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    first = [groups.index(g) for g in groups]
    for limit in (4096, 32):  # the second deals the largest group into parts
        monkeypatch.setattr(copy_groups, "BUCKET_ROWS", limit)
        monkeypatch.setattr(copy_groups, "LEADERS", 8)
        found = {r["doc_id"]: r["component_id"] for r in copy_groups.copy_groups(df).collect()}
        assert [found[i] for i in range(len(rows))] == first


def test_linked_classes_follow_paths():
    row = np.arange(128)
    chain = np.stack([np.where(row < 20 * k, row + 1000, row) for k in range(5)]).astype("<u4")
    alone = (row + 10**6).astype("<u4")[None]
    label = copy_groups.linked_classes(np.concatenate([chain, alone, alone]))
    assert len(set(label[:5])) == 1 and label[5] == label[6] != label[0]


def alike_by_force(texts):
    """Smallest row reached over all pairs within two fingerprint bits or alike to 0.8."""
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for t in texts)]
    prints = [simhash_tree.fingerprint(t) for t in texts]
    root = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            both = len(sets[a] & sets[b])
            if root[a] != root[b] and (
                5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both) or (prints[a] ^ prints[b]).bit_count() <= 2
            ):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return root


def test_copy_groups_by_force(spark):
    rng, texts = np.random.default_rng(7), []
    for pair in range(240):
        words = [f"w{x}" for x in rng.integers(0, 10**7, 304)]
        # 2 * cut of 600 + cut shingles differ: alike to (300 - cut) / (300 + cut), 0.70 to 0.85.
        cut = 25 + pair % 28
        texts += [" ".join(words), " ".join([*words[: 304 - cut], *[f"e{pair}x{i}" for i in range(cut)]])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in copy_groups.copy_groups(df).collect()}
    first = alike_by_force(texts)
    assert 240 < len(set(first)) < 480
    assert [found[i] for i in range(len(texts))] == first


def test_copy_groups_of_a_hot_bucket(spark, monkeypatch):
    # Copies alike to their original only, dealt into many parts with few shared nodes.
    rng, texts = np.random.default_rng(5), []
    words = [f"w{x}" for x in rng.integers(0, 10**7, 304)]
    for copy in range(160):
        edited = list(words)
        for at in rng.choice(np.arange(4, 300, 5), 6 if copy else 0, replace=False):
            edited[at] = f"e{copy}x{at}"
        texts.append(" ".join(edited))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(copy_groups, "BUCKET_ROWS", 16)
    monkeypatch.setattr(copy_groups, "LEADERS", 2)
    first = alike_by_force(texts)
    found = {r["doc_id"]: r["component_id"] for r in copy_groups.copy_groups(df).collect()}
    assert set(first) == {0} and [found[i] for i in range(len(texts))] == first


def test_shards(docs, none):
    found = shard_pack.placed(docs).collect()
    assert len(found) == len(ROWS)
    for shard in {r["shard"] for r in found}:
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(
            range(sum(r["shard"] == shard for r in found)))
    assert shard_pack.placed(none).count() == 0


def test_mix(docs, none):
    found = rows_of(mixing_tree.mix_plan(docs))
    assert len(found) == len(ROWS)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in found)
    mixed = mixing_tree.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(len(r["copies"]) for r in found)
    assert mixing_tree.mix_plan(none).count() == 0 and mixing_tree.mixed(none).count() == 0


def test_licences(docs, none):
    found = rows_of(license_index.scan(docs))
    assert len(found) == len(ROWS)
    assert sorted((r["labels"], r["first_word"]) for r in found if r["doc_id"] is None) == [("", None), ("mit", 5)]
    assert license_index.scan(none).count() == 0
