"""Every operator against a plain version of its contract, over the whole smallest tables."""

import collections
import hashlib
import html
import re
import zlib

import numpy as np
import pytest

from gaugemill.llm import (
    decontaminate, license_index, mixing_tree, page_template, quality_vote, queries,
    secret_grammar, simhash_tree, token_blocks, toxic_bags,
)

WHITE = re.compile("[^\x20\x09-\x0D]+")
ASCII = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def result(spark, sf_dir, name, key="doc_id"):
    return {r[key]: r for r in queries.QUERIES[name](spark, sf_dir).collect()}


def test_op1(spark, sf_dir, texts):
    found = result(spark, sf_dir, "op1_secret_grammar")
    words = "password|passwd|secret|token|api_?key"
    either = re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", words)
    kinds = [
        ("assign", re.compile(rf"""({either})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
        ("hex", re.compile("[0-9a-f]+"), 0, 32),
    ]
    for doc_id, text in texts.items():
        spans = sorted(
            (m.start(), n, m.end(), kind)
            for n, (kind, pattern, group, least) in enumerate(kinds)
            for m in pattern.finditer(text or "") if len(m[group]) >= least
        )
        flat = [f"{k}:{a}:{b}" for a, _, b, k in spans]
        row = found[doc_id]
        assert row["base_sha256"] == hashlib.sha256(",".join(flat).encode()).hexdigest()
        assert set(flat) <= set(row["spans"].split(",")) | {""}


def test_op1_grammar_learns_a_format():
    rng = np.random.default_rng(0)
    hexes = ["".join("0123456789abcdef"[i] for i in rng.integers(0, 16, 40)) for _ in range(200)]
    plain = [f"page{rng.integers(0, 99)}.section-{rng.integers(0, 9)}.html" for _ in range(200)]
    grammar = secret_grammar.Grammar({"hex": hexes}, plain)
    assert grammar.score("9f8e7d6c5b4a39281706fedc") > secret_grammar.MIN_LOG_ODDS
    assert grammar.score("page12.section-3.html") < secret_grammar.MIN_LOG_ODDS
    assert grammar.score("ZZZZ-QQQQ-1111-KKKK") < secret_grammar.MIN_LOG_ODDS
    # Compatible states were merged: far fewer are in use than the prefix tree had.
    used, pending = {0}, [0]
    automaton = grammar.formats["hex"]
    while pending:
        for target, _ in automaton.steps[pending.pop()].values():
            if target not in used:
                used.add(target)
                pending.append(target)
    assert len(used) < sum(map(len, hexes)) / 5


def test_op2(spark, sf_dir):
    found = result(spark, sf_dir, "op2_page_template", "page_id")
    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", row["html"] or "", re.S)
        parts = re.split(r"</?(?:p|h1)>", article[1]) if article else []
        clean = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", p))).strip() for p in parts]
        assert found[row["page_id"]]["text"] == "\n".join(p for p in clean if p)


def test_op2_template_of_a_host_without_articles(spark):
    page = ("<html><head><title>t</title></head><body><div class=top>Our site</div><div>{}</div>"
            "<div class=sidebar>Side {}</div><div>All about us</div>"
            "<script>var x='</p>';</script><ul class='comments'><li>nice</ul></body></html>")
    rows = [(n, f"https://a.example/{n}", page.format(f"Story number {n}<p>with a &lt;part&gt;\n {n}", n)) for n in range(9)]
    rows.append((99, "https://b.example/1", "<body><div>Our site</div><p>One page</body>"))
    found = page_template.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    text = {r["page_id"]: r["text"] for r in found.collect()}
    assert all(text[n] == f"Story number {n}\nwith a <part> {n}" for n in range(9))
    assert text[99] == "Our site\nOne page"


def test_op2_template_decides_inside_articles(spark):
    notice = "Please read our terms. " * 12
    page = ("<body><div><p>Top</div><article><h1>Title {0}</h1><p>First text of number {0}.</p>"
            "<p>" + notice + "</p><p>Last text of number {0}.</p><div>Write to us</div></article>"
            "<div><p>Bottom</div></body>")
    rows = [(n, f"https://a.example/{n}", page.format(f"{n}{n}")) for n in range(8)]
    # Without the template's article, by its own elements; a text in changing places is no template.
    rows.append((8, "https://a.example/8", "<body><main><p>Write to us</p><p>Other page</p></main></body>"))
    moved = ("<body><i></i><article><h1>One {0}</h1><p>Moves</p><section>Text {0}</section></article></body>",
             "<body><i></i><article><h1>One {0}</h1><section>Text {0}</section><p>Moves</p></article></body>")
    rows += [(20 + n, f"https://b.example/{n}", moved[n % 2].format(n)) for n in range(6)]
    # Near copies: what they share is their article.
    copy = "<body><article><h1>Same head</h1><p>A long text that all of them have.</p><p>No {}</p></article></body>"
    rows += [(30 + n, f"https://c.example/{n}", copy.format(n)) for n in range(5)]
    found = page_template.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"))
    text = {r["page_id"]: r["text"] for r in found.collect()}
    for n in range(8):
        assert text[n] == f"Title {n}{n}\nFirst text of number {n}{n}.\nLast text of number {n}{n}."
    assert text[8] == "Write to us\nOther page"
    for n in range(6):
        parts = [f"Text {n}", "Moves"] if n % 2 else ["Moves", f"Text {n}"]
        assert text[20 + n] == "\n".join([f"One {n}", *parts])
    assert all(text[30 + n] == f"Same head\nA long text that all of them have.\nNo {n}" for n in range(5))


def test_op3_coding():
    rng = np.random.default_rng(5)
    for ids in (
        [], [0], [7] * 3, rng.integers(0, 50_000, 10_001), rng.integers(0, 2**63, 700),
        rng.integers(0, 2, 5000) * rng.integers(0, 2**62, 5000), [0] * 1000, 2 ** rng.integers(0, 32, 3000),
    ):
        ids = np.array(ids, np.uint64)
        assert (token_blocks.decode_ids(token_blocks.encode_ids(ids)) == ids).all()


def test_op3(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_path())
    found, at = result(spark, sf_dir, "op3_token_blocks"), 0
    for doc_id in sorted(texts):
        ids = plain.encode(texts[doc_id] or "", add_special_tokens=False).ids + [2]
        row = found[doc_id]
        assert (row["start"], row["n_tokens"]) == (at, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_op4(spark, sf_dir, texts):
    found = result(spark, sf_dir, "op4_quality_votes")
    for doc_id, text in texts.items():
        text = text or ""
        words = WHITE.findall(text)
        seen = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        again = {
            j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)
        }
        lines = [x for x in text.split("\n") if WHITE.search(x)]
        row = found[doc_id]
        assert [row[k] for k in quality_vote.STATS] == [
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(again),
        ]
        assert row["base_failed"] == (len(words) < 20 or 100 * len(again) > 30 * len(words))
        assert not (row["kept"] and row["base_failed"])


def test_op4_agrees_with_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = result(spark, sf_dir, "op4_quality_votes")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    good = [found[r["doc_id"]] for r in labels if r["quality"] == 1]
    bad = [found[r["doc_id"]] for r in labels if r["quality"] == 0]
    assert all(r["kept"] or r["base_failed"] or r["n_words"] < 100 for r in good)
    assert sum(not r["kept"] for r in bad) > 0.9 * len(bad)


def test_op4_model_finds_careless_rules():
    patterns = [((1, 1, 0), 40), ((0, 0, 0), 900), ((0, 0, 1), 30), ((1, 1, 1), 20), ((None, 0, 0), 50)]
    model = quality_vote.fit(patterns)
    assert 0.02 < model.bad_share < 0.2
    assert quality_vote._good(model, (1, 1, 0)) < 0.5 < quality_vote._good(model, (0, 0, 0))


def test_op5_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = result(spark, sf_dir, "op5_toxic_bags")
    rows = [(found[r["doc_id"]], r["toxic"]) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()]
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0) for row, _ in rows)
    bad = np.array([r["score"] for r, y in rows if y == 1 and r["held_out"]])
    good = np.array([r["score"] for r, y in rows if y == 0 and r["held_out"]])
    assert (bad[:, None] > good).mean() + 0.5 * (bad[:, None] == good).mean() > 0.8


def test_op5_locates_sentences():
    bags = [(f"Nice day number{i}. Some more words{i % 7}.", 0) for i in range(200)]
    bags += [(f"Nice day number{i}. You rotten fool. Some more words{i % 7}.", 1) for i in range(60)]
    model = toxic_bags.train(bags)
    text = "All is well. You rotten fool! Good bye."
    score, known = model.score(text)
    assert score > 0.5 and [text[a:b].strip() for a, b, p in known if p > 0.5] == ["You rotten fool"]
    assert model.score("All is well. Nice day.")[0] < 0.5


def test_op6(spark, sf_dir, texts):
    owners = {}
    for item in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        words = ASCII.findall(lower(item["text"]))
        width = min(10, len(words))
        for i in range(len(words) - width + 1 if width else 0):
            owners.setdefault(tuple(words[i : i + width]), set()).add(item["item_id"])
    found, hits = result(spark, sf_dir, "op6_decontaminate"), 0
    for doc_id, text in texts.items():
        words, hit, items = ASCII.findall(lower(text)), set(), set()
        for width in {len(w) for w in owners}:
            for i in range(len(words) - width + 1):
                own = owners.get(tuple(words[i : i + width]))
                if own is not None:
                    hit |= set(range(i, i + width))
                    items |= own
        digest = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        row = found[doc_id]
        assert (row["n_words"], row["n_hit"], row["n_items"], row["items_sha256"], row["contaminated"]) == (
            len(words), len(hit), len(items), digest, bool(hit))
        hits += bool(hit)
    assert hits


def test_op6_cuts_spans():
    windows = decontaminate.WindowSet([(1, "one two three")], window=3)
    assert decontaminate.cut_spans("Ä. One, (two) THREE! four", windows) == "Ä. ! four"
    assert decontaminate.cut_spans("one two four", windows) == "one two four"


def test_op7(spark, sf_dir, texts):
    import xxhash

    def mark(text):
        words = WHITE.findall(lower(text))
        if not words:
            return 0
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    ids = sorted(texts)
    values = np.array([mark(texts[i]) for i in ids], np.uint64)
    near = np.bitwise_count(values[:, None] ^ values) <= 2
    least = np.array(ids)
    while True:
        lower_ = np.array([least[n].min() for n in near])
        if (lower_ == least).all():
            break
        least = lower_
    found = result(spark, sf_dir, "op7_simhash_tree")
    for i, v, c in zip(ids, values, least):
        assert (found[i]["fingerprint"], found[i]["component_id"]) == (f"{int(v):016x}", c)


@pytest.mark.parametrize("limit", [1, 4096])
def test_op7_links_survive_second_dealing(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash_tree, "SHARD_ROWS", limit)
    rng = np.random.default_rng(limit)
    values = set()
    for base in rng.integers(0, 2**63, 15):
        for _ in range(40):
            value = int(base)
            for bit in rng.integers(0, 63, rng.integers(0, 5)):
                value ^= 1 << int(bit)
            values.add(value)
    values = sorted(values)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = {r["node"]: r["root"] for r in simhash_tree.components(simhash_tree.shard_edges(df)).collect()}
    array = np.array(values, np.uint64)
    near = np.bitwise_count(array[:, None] ^ array) <= 2
    least = np.arange(len(values))
    while True:
        again = np.array([least[n].min() for n in near])
        if (again == least).all():
            break
        least = again
    assert [roots.get(v, v) for v in values] == [values[i] for i in least]


def test_op8(spark, sf_dir, texts):
    found = result(spark, sf_dir, "op8_shard_pack")
    sizes, slots, homes = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for doc_id, text in texts.items():
        row, raw = found[doc_id], (text or "").encode()
        assert (row["size"], row["text_crc32"], row["law"]) == (len(raw) + 1, zlib.crc32(raw), "bytes")
        sizes[row["shard"]] += row["size"]
        slots[row["shard"]].append(row["slot"])
        homes[text].add(row["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(sizes) == 8
    assert max(sizes.values()) - min(sizes.values()) <= 0.02 * sum(sizes.values()) / 8
    assert all(len(s) == 1 for s in homes.values())


def test_op9(spark, sf_dir, texts):
    found = result(spark, sf_dir, "op9_mixing_tree")
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    size, taken, largest = (collections.Counter() for _ in range(3))
    for doc_id, text in texts.items():
        row = found[doc_id]
        assert row["size"] == len(WHITE.findall(text or ""))
        assert row["taken"] % max(1, row["size"]) == 0 and row["taken"] <= 3 * row["size"]
        size[source[doc_id]] += row["size"]
        largest[source[doc_id]] = max(largest[source[doc_id]], row["size"])
        taken[source[doc_id]] += row["taken"]
    names = sorted(size, key=lambda s: (s is None, s or ""))
    targets = dict(zip(names, mixing_tree.water_fill([size[s] for s in names])))
    for doc_id in texts:
        row = found[doc_id]
        assert row["source_size"] == size[source[doc_id]] and abs(row["target"] - targets[source[doc_id]]) < 1e-6
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 for s in names)
    again = result(spark, sf_dir, "op9_mixing_tree")
    assert all(again[i]["taken"] == found[i]["taken"] for i in texts)


def test_op9_targets_and_quotas():
    assert mixing_tree.water_fill([100, 100, 100]) == [187.5, 75.0, 37.5]
    assert mixing_tree.water_fill([10, 100, 100]) == [30.0, 120.0, 60.0]
    assert mixing_tree.water_fill([]) == [] and mixing_tree.water_fill([0, 0]) == [0.0, 0.0]
    quotas = np.array(mixing_tree.split_quotas([10, 0, 33], 8, seed=1))
    assert quotas.sum(axis=1).tolist() == [10, 0, 33] and quotas.min() >= 0
    assert quotas.sum(axis=0).max() - quotas.sum(axis=0).min() <= 1
    assert quotas.tolist() == mixing_tree.split_quotas([10, 0, 33], 8, seed=1)


def test_op10(spark, sf_dir, texts):
    found = result(spark, sf_dir, "op10_license_index")
    for doc_id, text in texts.items():
        words, at, labels = ASCII.findall(lower(text)), [], set()
        for phrase, label in license_index.BASE.items():
            phrase = phrase.split()
            places = [i for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
            at += places
            labels |= {label} if places else set()
        row = found[doc_id]
        assert (row["n_words"], row["n_base"]) == (len(words), len(at))
        assert (row["first_word"], row["last_word"]) == ((min(at), max(at)) if at else (None, None))
        assert row["base_labels"] == ",".join(sorted(labels))
        assert labels <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1


def test_op10_verifies_key_phrases(spark):
    rows = [
        (1, "x y This work is licensed under the GNU General Public License, version 3. z"),
        (2, "general public license gnu version 3 in another order; licensed under this work"),
        (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
        (4, "All rights reserved. Redistribution and use in source and binary forms, with or without modification"),
    ]
    found = license_index.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["labels"] for r in found} == {
        1: "gpl-3", 2: "", 3: "mit", 4: "all-rights-reserved,bsd-3"}


def test_op10_finds_every_key_phrase(spark):
    notices = license_index.NOTICES
    filler = "some ordinary words of a text " * 300
    mit = notices[1][1]
    rows = [f"{filler} {mit} {filler} {words} {filler}" for _, words, _ in notices]
    rows += [" ".join(words for _, words, _ in notices), " ".join(words for _, words, _ in notices[::-1])]
    every = " ".join(sorted({w for _, words, _ in notices for w in words.split()}))
    rows += [f"{every} {words} {filler}" for _, words, _ in notices]
    found = license_index.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    for r in found.collect():
        text = f" {' '.join(rows[r['doc_id']].split())} "
        labels = {label for label, _, key in notices if f" {key} " in text}
        labels |= {label for key, label in license_index.BASE.items() if f" {key} " in text}
        assert r["labels"] == ",".join(sorted(labels)), r["doc_id"]


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0.5 * sizes[0]
    clean = simhash_tree.near_duplicates(docs.dropDuplicates(["doc_id"]))
    assert clean.filter("doc_id <> component_id").count() == 0
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert decontaminate.contamination(docs, items).filter("contaminated").count() == 0
    assert corpus_pipeline.run(spark, sf_dir).count() == sizes[-1]
