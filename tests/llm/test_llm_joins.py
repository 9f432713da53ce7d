"""Vector codes, the grouped prefix join and phrase mining against plain versions and awkward rows."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugemill.llm import code_bounds, grouped_join, phrase_trie

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


# ---- vector codes ---------------------------------------------------------------------------

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """{vec_id: (code, error)} and the books, by whole integer k-means."""
    kept = sorted((i, [math.floor(4096 * x) for x in v]) for i, v in rows)
    n = len(kept[0][1]) // parts
    piece = {(i, p): v[p * n : (p + 1) * n] for i, v in kept for p in range(parts)}
    books = [[piece[i, p] for i, _ in kept[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            mine = collections.defaultdict(list)
            for i, _ in kept:
                mine[nearest(p, piece[i, p])[1]].append(piece[i, p])
            for e, xs in mine.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    found = {}
    for i, _ in kept:
        best = [nearest(p, piece[i, p]) for p in range(parts)]
        found[i] = ("".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best))
    return found, books


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


@pytest.mark.parametrize("kind, spread", [("clusters", 0.02), ("ties", 0), ("large", 3000.0)])
def test_codes(spark, kind, spread):
    rng = np.random.default_rng(3)
    if kind == "ties":
        data = rng.integers(-2, 3, (300, 16)) / 4096
    else:
        data = rng.normal(size=(12, 16))[rng.integers(0, 12, 300)] + rng.normal(size=(300, 16)) * spread
    data = data.astype(np.float32).astype(float)
    rows = [(7 * i % 300, v.tolist()) for i, v in enumerate(data)]
    want, books = plain_codes(rows)
    found = code_bounds.compress(vectors(spark, [(i, v, i % 3) for i, v in rows]).repartition(4))
    assert {r.vec_id: (r.code, r.error) for r in found.codes.collect()} == want
    assert code_bounds.books_text(found.books) == ",".join(str(x) for b in books for c in b for x in c)
    # Later rounds settle parts by their bounds alone.
    if kind == "clusters":
        b, depths = found.trace[-1]
        assert depths[0] > 0 and depths[16] < sum(depths) / 2


def test_bounds_decide_nothing_wrong():
    """Bounds moved and narrowed over many random rounds never hide the nearest entry."""
    rng = np.random.default_rng(5)
    rows = rng.integers(-50, 50, (500, 4))
    book = rows[:16].copy()
    known = code_bounds.Bounds.unknown(500, 4)
    seen = collections.Counter()
    for turn in range(12):
        seen.update(code_bounds.settle(rows, book, known).tolist())
        exact = code_bounds.squared(rows, book)
        assert (known.near[:, 0] == exact.argmin(axis=1)).all()
        moved = book + rng.integers(-2, 3, book.shape)
        drift = np.sqrt(((moved - book) ** 2).sum(axis=1))
        known, book = known.moved(drift).narrowed(4 if turn < 6 else 2), moved
    assert seen[0] and seen[1] and seen[16]


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    flat = [0.5] * 8
    rows = [(1, flat, None), (1, flat, None), (None, flat, 2), (2, None, 1), (3, [0.5] * 7 + [None], 1),
            (4, [nan] * 8, 1), (5, [inf] * 8, 1), (6, [1.0] * 5, 1), (7, [], 1), (8, [1e30] * 8, 1)]
    df = vectors(spark, rows).withColumn("near", F.lit(1)).withColumn("code", F.lit("x"))
    got = sorted(code_bounds.vector_codes(df).select("vec_id", "code", "error", "label_error").collect(), key=str)
    one = ("00" * 8, 0, 0)
    assert sorted(map(tuple, got), key=str) == sorted([
        (1, *one), (1, *one), (None, *one), (6, None, None, None), (7, None, None, None), (8, None, None, None),
    ], key=str)
    assert code_bounds.vector_codes(df.limit(0)).collect() == []
    assert [r.code for r in code_bounds.vector_codes(vectors(spark, [(None, flat, 1)])).collect()] == [None]


def test_label_totals_of_many_labels(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).tolist(), None if i % 5 == 0 else i % 4) for i in range(200)]
    wide = code_bounds.vector_codes(vectors(spark, rows)).orderBy("vec_id").collect()
    monkeypatch.setattr(code_bounds, "BROADCAST_LABELS", 0)
    assert code_bounds.vector_codes(vectors(spark, rows)).orderBy("vec_id").collect() == wide


# ---- grouped prefix join ---------------------------------------------------------------------

def plain_components(rows, percent=90):
    sets = {}
    for i, text in rows:
        words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))} if words else set()
    least = {i: i for i in sets}
    while True:
        before = dict(least)
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and sets[b]:
                    least[a] = least[b] = min(least[a], least[b])
        if before == least:
            return {i: (len(s), least[i]) for i, s in sets.items()}


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def families(rng):
    """Families of near copies around the threshold, short texts, and a passage that all share."""
    passage = [f"common{i}" for i in range(40)]
    texts = []
    for f in range(12):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(40, 160))] + passage * (f % 3)
        texts += [edited(words, rng, rng.randrange(0, 1 + len(words) // 50)) for _ in range(9)]
    texts += [f"tiny {i % 5}" for i in range(10)] + ["One", "one", "a b c", "A b C", "a b c d", None, "", " \t "]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("hot_rows, hot_entries, blocks", [(128, 1 << 20, 1024), (3, 1 << 20, 2), (3, 50, 2)])
def test_components(spark, monkeypatch, hot_rows, hot_entries, blocks):
    monkeypatch.setattr(grouped_join, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(grouped_join, "HOT_ENTRIES", hot_entries)
    monkeypatch.setattr(grouped_join, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(grouped_join, "PAIRS_A_BLOCK", 7)
    rows = families(random.Random(hot_rows + hot_entries))
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], COLUMNS).repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in grouped_join.similar_documents(df).collect()}
    want = plain_components(rows)
    assert len({c for _, c in want.values()}) < len(want) - 30
    assert got == want


def test_links_need_prefix_votes(spark):
    """Sets of every similarity from 0.8 up: those that link share the votes asked in their prefixes."""
    rng, cases = np.random.default_rng(1), []
    for size in [1, 2, 3, 9, 10, 11, 19, 57, 200] * 9:
        for drop in range(0, size // 5 + 1):
            one = np.unique(rng.integers(0, 2**62, size, dtype=np.int64).astype(np.uint64))
            other = np.unique(np.concatenate([one[drop:], rng.integers(0, 2**62, drop // 2).astype(np.uint64)]))
            if not grouped_join.linked(one, other):
                continue
            found = [grouped_join.prefix_of(x, len(x), one[:0], one[:0].astype(np.int64), 90)[0] for x in (one, other)]
            shared = len(np.intersect1d(*found))
            assert shared >= min(grouped_join.votes_asked(len(x)) for x in (one, other))
            cases.append((len(one), len(other), shared))
    sizes = spark.createDataFrame(cases, "a long, b long, shared long")
    need = grouped_join._votes(F.col("a"), F.col("b"), 90)
    assert len(cases) > 40 and sizes.filter(need > F.col("shared")).isEmpty()


def test_parities_turn_down_only_what_cannot_link(spark, monkeypatch):
    rng = np.random.default_rng(3)
    sets, rows = {}, []
    for family in range(40):
        n = int(rng.integers(1, 600))
        base = rng.integers(0, 2**64, n, dtype=np.uint64)
        for share in (0, 0.02, 0.05, 0.06, 0.12):
            other = base.copy()
            some = rng.permutation(n)[: int(share * n)]
            other[some] = rng.integers(0, 2**64, len(some), dtype=np.uint64)
            sets[len(sets)] = np.unique(other)
    for a in sets:
        for b in range(a // 5 * 5, a):
            one, other = sets[a], sets[b]
            differ = sum(int(x).bit_count() for x in
                         grouped_join.parity(one).view(np.uint64) ^ grouped_join.parity(other).view(np.uint64))
            assert differ <= len(np.setxor1d(one, other))
            rows.append((a, b, grouped_join.parity(one).tolist(), grouped_join.parity(other).tolist(), len(one), len(other)))
    near = grouped_join._near("p", "q", F.col("n"), F.col("m"), 90)
    df = spark.createDataFrame(rows, "a long, b long, p array<long>, q array<long>, n long, m long")
    got = {(r.a, r.b): r.near for r in df.select("a", "b", near.alias("near")).collect()}
    links = {k for k in got if grouped_join.linked(sets[k[0]], sets[k[1]])}
    assert links and all(got[k] for k in links)
    assert sum(not x for x in got.values()) > 0.8 * (len(got) - len(links))


def test_family_of_unlike_copies_is_turned_down_without_texts(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(400)]
    rows = [(i, edited(base, rng, 10)) for i in range(12)] + [(50, edited(base, rng, 1)), (51, " ".join(base))]
    asked = []
    plain = grouped_join.texts_of
    monkeypatch.setattr(grouped_join, "texts_of", lambda nodes, docs: asked.append(nodes.count()) or plain(nodes, docs))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in grouped_join.similar_documents(df).collect()}
    assert got == plain_components(rows) and got[51] == (398, 50)
    # The base and its like, and texts whose prefix needs all their shingles; none for pairs alike to 0.86.
    assert sum(asked) <= 4


@pytest.mark.parametrize("edits, most", [((6, 7), 0), ((2, 6), 40)])
def test_family_of_near_copies_makes_few_pairs_of_groups(spark, monkeypatch, edits, most):
    """Nearly all of 60 * 59 / 2 pairs share enough shingles; none, or some of them, link."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(400)]
    rows = [(i, edited(base, rng, rng.randrange(*edits))) for i in range(60)]
    found = []
    plain = grouped_join.group_pairs

    def counted(*args):
        pairs = plain(*args)
        found.append(pairs.count())
        return pairs

    monkeypatch.setattr(grouped_join, "group_pairs", counted)
    monkeypatch.setattr(grouped_join, "NEAR_ROWS", 20)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in grouped_join.similar_documents(df).collect()}
    assert got == plain_components(rows)
    assert sum(found) <= most


@pytest.mark.parametrize("blocks, at_once", [(1024, 1 << 15), (3, 5)])
def test_pairs_of_groups_keep_all_that_may_link(spark, monkeypatch, blocks, at_once):
    """Groups of several members, in cells cut over batches: every pair of groups with linked
    members of different classes is found, and no pair of groups of one class."""
    monkeypatch.setattr(grouped_join, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(grouped_join, "PAIRS_AT_ONCE", at_once)
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**64, 200, dtype=np.uint64)
    members, nodes, met, classes, sets = [], [], [], [], {}
    for gid in range(30):
        own = []
        for _ in range(1 + gid % 3):
            held = base.copy()
            some = rng.permutation(200)[: rng.integers(0, 18)]
            held[some] = rng.integers(0, 2**64, len(some), dtype=np.uint64)
            own.append(np.unique(held))
        sets[gid] = own
        of = [(0 if gid < 4 else gid).to_bytes(16, "little")] * len(own)
        for k, held in enumerate(own):
            members.append((f"{gid} {k}".encode(), gid))
            nodes.append((members[-1][0], grouped_join.parity(held).tolist()))
        classes.append((gid, min(of), max(of)))
        met += [(token, 0, 30, gid, 200, token) for token in range(31)] + [(99, 0, 1, gid, 10**6, 0)] * (gid == 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        sketched = grouped_join.sketches(
            spark.createDataFrame(members, "node binary, gid long"), spark.createDataFrame(nodes, "node binary, odd array<long>"))
        rows = spark.createDataFrame(met, "token long, salt int, rows long, gid long, size long, pos int").drop("salt").join(
            spark.createDataFrame(classes, "gid long, least binary, most binary"), "gid")
        pairs = [tuple(r) for r in grouped_join.group_pairs(rows, sketched).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = set(pairs)
    every = {(a, b) for b in range(30) for a in range(b) if b > 3}
    links = {(a, b) for a, b in every if any(grouped_join.linked(x, y) for x in sets[a] for y in sets[b])}
    assert len(got) == len(pairs) and links <= got <= every
    assert links and len(got) < len(every)


def test_awkward_documents(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(3, text, "en", "a", 1), (3, text, "en", "a", 1), (2, text + " more", "en", "a", 1), (None, text, None, None, None),
            (None, "of its own, without any id", None, None, None), (5, "", None, None, None), (None, None, None, None, None),
            (9, "x " * 30_000, "en", "b", 2), (9, "another text under the same id", "en", "b", 2)]
    df = spark.createDataFrame(rows, COLUMNS).withColumn("node", F.lit("x")).withColumn("size", F.lit(1))
    got = sorted([tuple(r) for r in grouped_join.similar_documents(df).collect()], key=str)
    assert got == sorted([(3, 58, 2), (3, 58, 2), (2, 59, 2), (None, 58, 2), (None, 4, None), (5, 0, 5), (None, 0, None),
                          (9, 1, 9), (9, 4, 9)], key=str)
    assert grouped_join.similar_documents(df.limit(0)).collect() == []


# ---- phrases ---------------------------------------------------------------------------------

def plain_phrases(rows, min_count, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    out = []
    for lang in n:
        found = []
        for key, a in f.items():
            if key[0] != lang or len(key) < 3 or a < min_count:
                continue
            longer = [x for x, c in f.items() if c >= min_count and x[0] == lang and len(x) == 4 and len(key) == 3
                      and key[1:] in (x[1:3], x[2:4]) and 100 * c >= 50 * a]
            if longer:
                continue
            score, _, left, right = min(
                (10**6 * a * a // (f[key[: k + 1]] * f[(lang, *key[k + 1 :])]), k, f[key[: k + 1]], f[(lang, *key[k + 1 :])])
                for k in range(1, len(key) - 1))
            found.append((-score, -a, " ".join(key[1:]).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(rng, docs=120):
    words = ["the", "of", "New", "york", "city", "café", "naïve", "x-y", "日本", "\x1c", "a\x00b", "red", "Fox"]
    rows = []
    for i in range(docs):
        text = ""
        for _ in range(rng.randrange(0, 60)):
            text += rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ; "])
        rows.append((text if i % 17 else None, rng.choice(["en", "en", "de", None, "und", ""])))
    return rows


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_phrases(spark, monkeypatch, block):
    monkeypatch.setattr(phrase_trie, "BLOCK_PHRASES", block)
    rows = corpus(random.Random(4), 120 if block > 7 else 60)
    df = spark.createDataFrame([(None, t, g, None, 0) for t, g in rows], COLUMNS).withColumn("l", F.lit(1)).repartition(3)
    least = 3 if block > 7 else 4
    got = sorted(tuple(r) for r in phrase_trie.collocations(df, min_count=least, top=40).collect())
    assert got == plain_phrases(rows, least, top=40) and got


def test_no_documents_no_phrases(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert phrase_trie.collocations(none).collect() == []
    few = spark.createDataFrame([(1, "only a few words", "en", None, 1)], COLUMNS)
    assert phrase_trie.collocations(few).collect() == []


def test_trie_counts_every_phrase():
    rng = np.random.default_rng(2)
    alphabet = rng.integers(1, 2**63, 700, dtype=np.int64).astype(np.uint64)
    phrases = {tuple(alphabet[rng.zipf(1.3, k) % 700]) for k in (1, 2, 3) for _ in range(3000)}
    rows = np.array([(7, *p, *[0] * (3 - len(p))) for p in phrases], np.uint64)
    trie = phrase_trie.Trie.build(rows)
    # no two edges share a slot
    assert (trie.check >= 0).sum() == len(np.unique(np.nonzero(trie.check >= 0)[0]))
    words = alphabet[rng.zipf(1.3, 5000) % 700]
    absent = np.uint64(2**64 - 5)
    assert trie.symbols(np.array([0, absent, rows[0, 1]], np.uint64)).tolist()[:2] == [-1, -1]
    symbols = trie.symbols(np.where(np.arange(5000) % 50, words, 0).astype(np.uint64))
    root = trie.advance(np.ones(1, np.int64), trie.symbols(np.array([7], np.uint64)))
    found = trie.counts(symbols, np.repeat(root, len(symbols)), 3)
    want = collections.Counter(
        tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)
        if all(j % 50 for j in range(i, i + k)))
    assert {tuple(r[1 : 1 + np.count_nonzero(r[1:])]): n for r, n in zip(rows, found.tolist()) if n} == {
        p: n for p, n in want.items() if p in phrases}


def test_buckets_are_sent_in_few_rows_however_many_there_are(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(" ".join(f"v{x}" for x in rng.integers(0, 60, 900)), "en") for _ in range(20)]
    df = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    every = np.full(1 << 10, -1, np.int64)
    sent = []
    monkeypatch.setattr(phrase_trie, "bitmap", lambda found: sorted(r.g for r in found.collect()))

    def common():
        return phrase_trie.common_buckets(df, every, 2, 0, 5, 22)

    wide = common()
    monkeypatch.setattr(phrase_trie, "CHUNK_BITS", 2)
    assert common() == wide
    hasher, level = phrase_trie.Hasher(0), phrase_trie.Level(every, 2)
    for text, lang in rows:
        sent.append(phrase_trie._buckets(level.occurrences(hasher.words([text], [lang]))[0], 22))
    at, n = np.unique(np.concatenate(sent), return_counts=True)
    assert len(wide) > 100 and wide == sorted(phrase_trie.mixed(at[n >= 5]).view(np.int64).tolist())


def test_texts_are_hashed_in_small_slices():
    rows = [("word " * 50_000, "en")] * 12
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["text", "lang"])
    found = list(phrase_trie.slices(iter([batch]), phrase_trie.Hasher(0)))
    assert max(len(x.octets) for x in found) < 1.3 * 2**20
    assert sum(np.count_nonzero(x.hashes) for x in found) == 600_000


def test_words_and_their_hashes(monkeypatch):
    """Hashes go by the word alone, whatever stands around it and however texts are sliced."""
    rng = random.Random(9)
    rows = [(t or "", g or "und") for t, g in corpus(rng, 200)] + [(";;", "en"), ("", "de"), ("end", "en")]
    found = phrase_trie.Hasher(0).words([t for t, _ in rows], [g for _, g in rows])
    want, at = [], 0
    for text, _ in rows:
        for piece in re.split("[.,;:!?\x0A-\x0D]", text.lower() if text.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), text)):
            if words := re.findall("[^\x20\x09]+", piece):
                want += [w.encode() for w in words] + [None]
    got = [found.octets[a:b] if h else None for h, a, b in zip(found.hashes.tolist(), found.starts, found.ends)]
    assert got == want
    by_word = collections.defaultdict(set)
    for word, h in zip(got, found.hashes.tolist()):
        by_word[word].add(h)
    assert all(len(v) == 1 for v in by_word.values()) and len(set.union(*by_word.values())) == len(by_word)
    alone = phrase_trie.Hasher(0).words(["x York"], ["en"])
    assert alone.hashes[1] in by_word[b"york"] and phrase_trie.Hasher(1).words(["york"], ["en"]).hashes[0] not in by_word[b"york"]
    # counts across tally limits
    tally = phrase_trie.Tally(1)
    monkeypatch.setattr(phrase_trie, "TALLY_ROWS", 5)
    out = collections.Counter()
    for _ in range(30):
        h = np.array([rng.randrange(12) for _ in range(9)], np.uint64)
        for g, r, n in tally.add(h, h[:, None]):
            assert (g == r[:, 0]).all()
            out.update(dict(zip(g.tolist(), n.tolist())))
    for g, _, n in tally.flush():
        out.update(dict(zip(g.tolist(), n.tolist())))
    assert sum(out.values()) == 270


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 99_999_999_999_999, 100_000_000_000_000, 299_999_999_999_999
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(phrase_trie.score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 10**6 * a * a // (left * right)


def test_texts_are_read_once_however_many_blocks(spark, monkeypatch):
    """Every pass of the tries over the texts counts its rows here."""
    rng = random.Random(8)
    rows = [(" ".join(f"w{min(rng.randrange(30), rng.randrange(30))}" for _ in range(200)), "en") for _ in range(40)]
    want = collections.Counter()
    for text, _ in rows:
        words = text.split()
        want.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    hasher = phrase_trie.Hasher(0)
    phrases = [p for p, n in want.items() if n >= 5 or len(p) == 3 and n == 1] + [("w1", "none"), ("none",)]
    lang = int(hasher.words(["x"], ["en"]).langs[0])
    hashed = [(lang, *(int(hasher.words([w], ["en"]).hashes[0]) for w in p), *[0] * (3 - len(p))) for p in phrases]
    keys = [(i, *(x or None for x in r)) for i, r in enumerate(np.array(hashed, np.uint64).view(np.int64).tolist())]
    candidates = spark.createDataFrame(keys, "id long, l long, h1 long, h2 long, h3 long")
    met = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(2).mapInArrow(noted, "text string, lang string")
    monkeypatch.setattr(phrase_trie, "BLOCK_PHRASES", 50)
    found = {phrases[r.id]: r.f for r in phrase_trie.counted(docs, candidates, 3, 0).collect()}
    assert len(phrases) > 500 and found == {p: want[p] for p in phrases if want[p]}
    assert met.value == len(rows)


def test_tallied_phrases_are_packed_whole():
    """Bodies keep every row, those of a part together; rows that share a hash stay apart."""
    rng = np.random.default_rng(3)
    rows = np.column_stack([np.full(5000, 9), rng.integers(1, 40, (5000, 2)), np.zeros(5000), np.arange(5000)]).astype(np.uint64)
    rows[::7, 2] = 0
    g = np.zeros(len(rows), np.uint64)
    for at, h in phrase_trie.phrase_hashes(rows[:, :-1]):
        g[at] = h
    order = np.argsort(g, kind="stable")
    batch = phrase_trie.packed(g[order], rows[order], 5, 1)
    tables = list(phrase_trie.unpacked(iter([batch.slice(0, 30), batch.slice(30)]), 5))
    assert [(p, kind) for p, kind, _ in tables] == [(p, 1) for p in range(5)]
    assert (np.concatenate([x for _, _, x in tables]) == rows[order]).all()
    one = collections.Counter()
    for row, n in zip(rows[:, :-1].tolist(), rows[:, -1].tolist()):
        one[tuple(row)] += n
    for hashes in (g, np.zeros_like(g)):
        _, each, n = phrase_trie.summed_rows(hashes, rows[:, :-1], rows[:, -1])
        assert dict(zip(map(tuple, each.tolist()), n.tolist())) == one


def test_common_rows_stay_in_the_tally(monkeypatch):
    monkeypatch.setattr(phrase_trie, "TALLY_ROWS", 50)
    tally, sent = phrase_trie.Tally(1), []
    for i in range(200):
        h = np.array([1, 1, 2, *range(100 + 40 * i, 140 + 40 * i)], np.uint64)
        sent += list(tally.add(h, h[:, None]))
    assert sum(1 in g for g, _, _ in sent) == 0
    sent += list(tally.flush())
    assert sum(int(n.sum()) for _, _, n in sent) == 200 * 43
    assert [int(n[g == 1][0]) for g, _, n in sent if 1 in g] == [400]
