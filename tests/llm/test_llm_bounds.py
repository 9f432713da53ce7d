"""Results that must not depend on block sizes, memory bounds or the length of a text."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugemill.llm import decontaminate, token_blocks, toxic_bags
from gaugemill.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def overlapping(spark):
    """Items that overlap in a document, so that no block alone sees the whole hit."""
    words = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(words[5:17])), (2, " ".join(words[12:25])), (3, " ".join(words[23:34])), (4, "short item")]
    docs = [
        (1, " ".join(words)), (2, "a " * 30 + " ".join(words[5:25])), (3, "nothing here"), (4, None), (5, ""),
        (1, "the same id, short item, another text"), (None, "Short; ITEM!"), (None, "Short; ITEM!"),
    ]
    return (spark.createDataFrame(docs, "doc_id long, text string").withColumn("_doc", F.lit("x")).repartition(3),
            spark.createDataFrame(items, "item_id long, text string"))


def shown(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("name, options", [
    ("masked_text", {}), ("drop_contaminated", {}), ("drop_contaminated", {"max_share": 0.4}),
    ("drop_contaminated", {"max_share": 0.6}), ("contamination", {}),
])
def test_blocks_agree(overlapping, name, options):
    docs, items = overlapping
    run = getattr(decontaminate, name)
    one = shown(run(docs, items, **options))
    assert len(decontaminate.item_blocks(items, 100)) > 2
    for size in (100, 250):
        assert shown(run(docs, items, set_bytes=size, **options)) == one


def test_overlapping_items_are_cut_as_one(overlapping):
    docs, items = overlapping
    got = {r.text for r in decontaminate.masked_text(docs, items, set_bytes=100).filter("doc_id = 1").collect()}
    words = [f"w{i}" for i in range(40)]
    assert got == {" ".join(words[:5]) + "  " + " ".join(words[34:]), "the same id, , another text"}


def test_a_window_set_is_small():
    import pickle

    rng = random.Random(0)
    vocabulary = [f"v{i:x}" for i in range(60_000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(400))) for i in range(1_500)]
    found = decontaminate.WindowSet(items)
    size = sum(len(t) for _, t in items)
    assert len(pickle.dumps(found)) < 6 * size
    hit, own = found.probe(decontaminate.fold_words("x y " + items[7][1] + " z"))
    assert own == {7} and hit.sum() == 400 and not hit[:2].any() and not hit[-1]


def test_equal_windows_of_several_items():
    text = " ".join(f"w{i}" for i in range(12))
    found = decontaminate.WindowSet([(3, text), (None, text), (1, text), (3, text), (9, "w1 w2")])
    hit, own = found.probe(decontaminate.fold_words(text))
    assert own == {1, 3, 9} and hit.all()


def test_a_long_clean_text_is_not_toxic(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    model = toxic_bags.train(toxic_bags.training_bags(docs, labels))
    held = toxic_bags.scores(docs, model).join(
        labels.filter(toxic_bags.held_out(F.col("doc_id"))).select("doc_id", "toxic"), "doc_id").collect()
    clean = [r.doc_id for r in held if r.toxic == 0]
    quiet = {r.doc_id for r in held if r.toxic == 0 and r.score < 0.5}
    assert len(quiet) > 0.99 * len(clean)
    texts = [r.text or "" for r in docs.filter(F.col("doc_id").isin(list(quiet))).orderBy("doc_id").collect()]
    joined = "\n".join(texts)
    assert len(joined) > 1_500_000 and model.score(joined)[0] < 0.5
    assert model.score("Neutral words without meaning to the model, zq zx. " * 50_000)[0] == 0
    toxic, plain = ([r.score for r in held if r.toxic == t] for t in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in plain])
    assert auc > 0.95


def test_memo_generations_change_nothing(spark, sf_dir, monkeypatch):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    texts += ["Don't DON'T don't", "É é e", "<|endoftext|> a<|b", "x\x1cy", "ª ǅ ﬁ", "A.B a.b ..", ""]
    whole = token_blocks.Encoder(tokenizer_path()).ids(texts)
    monkeypatch.setattr(token_blocks, "MEMO_ENTRIES", 50)
    small = token_blocks.Encoder(tokenizer_path())
    assert [x for t in texts for x in small.ids([t])] == whole
    want = small.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in whole] == [e.ids for e in want]
