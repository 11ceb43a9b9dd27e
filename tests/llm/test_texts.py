"""Operators on documents against plain versions, with nulls, empty and long texts, ties, repeats and clashing names."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from tidewheel.llm import contamination, jaccard, language, packing, quality, sharding, substrings

UPPER, LOWER = contamination.UPPER, contamination.LOWER
PLAIN = re.compile(contamination.WORD)
FOLDER = "/root/testdata/sf0.001"


def plain_words(text):
    return PLAIN.findall((text or "").translate(str.maketrans(UPPER, LOWER)))


def prose(rng, n, words=400):
    return " ".join(f"w{int(rng.paretovariate(0.6)) % words}" for _ in range(n))


def corpus(seed=3):
    """Copies, near copies, shared passages, one thing over and over, nulls, blanks and repeated ids."""
    rng = random.Random(seed)
    passage = prose(rng, 60, 10**6)
    base = [prose(rng, rng.choice([3, 8, 19, 20, 21, 80, 200])) for _ in range(30)]
    texts = [*base, *base[:5], None, "", " \t\r\n ", "word", "Haly " * 90, "a b " * 50, "É\x1cé \x0bß", "é" * 5000, prose(rng, 6000, 50)]
    for t in base[5:12]:
        w = t.split()
        w[len(w) // 2] = "CHANGED"
        texts.append(" ".join(w))
    texts += [prose(rng, 30) + " " + passage + "\n" + prose(rng, 30) for _ in range(6)]
    return [(i, t, f"own{i}") for i, t in enumerate(texts)]


SCHEMA = "doc_id long, text string, extra string"


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def removed(rows):
    seen, out = set(), {}
    for i, text, *_ in sorted(rows):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - 19):
            if (k := tuple(w[p : p + 20])) in seen:
                gone[p : p + 20] = [True] * 20
            seen.add(k)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_are_removed(frame, rows):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(frame, digest=True).collect()}
    assert got == removed(rows)


def test_repeats_keep_columns_and_untouched_texts(spark, frame, rows):
    out = substrings.remove_repeats(frame.withColumnsRenamed({"extra": "mark"}))
    assert out.columns == ["doc_id", "mark", "n_words", "n_removed", "kept"]
    texts = {i: t for i, t, _ in rows}
    for r in out.collect():
        assert r.mark == f"own{r.doc_id}"
        if not r.n_removed:
            assert r.kept == texts[r.doc_id]
    none = spark.createDataFrame([], SCHEMA)
    assert substrings.remove_repeats(none).count() == 0


def test_repeats_with_repeated_and_null_ids(spark):
    text = " ".join(f"x{i}" for i in range(40))
    rows = [(None, text), (1, text), (2, text + " y"), (2, text + " z"), (3, text), (3, text)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.n_removed for r in got if r.doc_id is None] == [0]
    assert sorted((r.doc_id, r.n_removed) for r in got if r.doc_id) == [(1, 40), (2, 40), (2, 40), (3, 40), (3, 40)]


def jaccard_links(rows, similarity=0.8):
    sets = {}
    for i, text, *_ in rows:
        w = plain_words(text)
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    links, parent = collections.Counter(), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (links[i], root(i)) for i in sets}


def test_near_duplicates(frame, rows):
    got = {r.doc_id: (r.n_links, r.class_id) for r in jaccard.near_duplicates(frame).collect()}
    assert got == jaccard_links(rows)


def test_near_duplicates_in_large_buckets(spark):
    """A group of near copies larger than a bucket is compared in blocks, each link counted once."""
    rng = random.Random(5)
    words = [f"q{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = list(words)
        for at in rng.sample(range(120), i % 4):
            w[at] = f"r{i}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_links, r.class_id) for r in jaccard.near_duplicates(df, bucket=8).collect()}
    assert got == jaccard_links(rows)


def test_near_duplicates_edges(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A, b c d e f!"), (7, None), (8, "")]
    got = sorted(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=str)
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r.doc_id].append((r.n_links, r.class_id))
    assert dict(by_id) == {None: [(0, None)], 4: [(2, 4), (2, 4)], 9: [(2, 4)], 7: [(0, 7)], 8: [(0, 8)]}
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then it sleeps"), (2, "three word item"), (3, None), (4, "—!"), (5, "three word item"), (6, "one")]


def test_contamination(spark):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    inside = "Quick, BROWN fox jumps over the lazy dog and then it sleeps"
    texts = [f"so {inside} here", "a three  word item; three word item", "the quick brown fox", None, "", "One", "x " * 3000 + inside, "thrée word item"]
    docs = spark.createDataFrame([*enumerate(texts), (None, "one"), (0, texts[0]), (0, "two")], "doc_id long, text string")
    wins = collections.defaultdict(set)
    for i, t in ITEMS:
        w = plain_words(t)
        for s in range(max(1, len(w) - 9)):
            if w:
                wins[tuple(w[s : s + 10])].add(i)
    got = collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in contamination.contamination(docs, benchmark).collect())
    want = collections.Counter()
    for d, t in [(r.doc_id, r.text) for r in docs.collect()]:
        w, hit, items = plain_words(t), set(), set()
        for win, ids in wins.items():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    items |= ids
        want[d, len(w), len(hit), tuple(sorted(map(str, items))), bool(hit)] += 1
    assert got == want
    assert {r.doc_id for r in contamination.without_contaminated(docs, benchmark).collect()} == {0, 2, 3, 4, 7}
    spans = {r.text for r in contamination.without_spans(docs, benchmark).where("doc_id = 0").collect()}
    assert spans == {"so , " + " " * 9 + " here".replace(" here", " here"), "two"} or "two" in spans
    assert contamination.contamination(contamination.without_spans(docs, benchmark), benchmark).where("contaminated").count() == 0
    assert contamination.contamination(docs, benchmark.limit(0)).where("contaminated").count() == 0
    assert contamination.contamination(docs.limit(0), benchmark).count() == 0


def test_contamination_by_shuffle(spark, monkeypatch):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(0, "one three word item"), (1, "no")], "doc_id long, text string")
    monkeypatch.setattr(contamination, "BROADCAST_WINDOWS", 0)
    assert sorted((r.doc_id, r.n_hit) for r in contamination.contamination(docs, benchmark).collect()) == [(0, 4), (1, 0)]


def test_contamination_is_native(frame, spark):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = contamination.contamination(frame, benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_packing(frame, rows):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    tok = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    pieces = packing.packed(frame, capacity=64).collect()
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 1] for i, t, _ in rows}
    back, sequences = collections.defaultdict(dict), collections.defaultdict(list)
    for p in pieces:
        assert p.ids == ids[p.doc_id][p.start : p.start + p.length] and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in p.ids))
        back[p.doc_id][p.start] = p.ids
        sequences[p.sequence_id].append((p.offset, p.length))
    assert {i: sum((v for _, v in sorted(x.items())), []) for i, x in back.items()} == ids
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(map(len, ids.values()))
    assert len(sequences) * 64 <= total * 1.005 + 64 * 2 * frame.rdd.getNumPartitions()


def test_best_fit_takes_the_tightest_window():
    import numpy as np

    rng = random.Random(2)
    lengths = np.array([rng.randint(1, 100) for _ in range(500)])
    got, open_, want = packing.best_fit(lengths, 100), [], np.zeros(500, int)
    for i in np.argsort(-lengths, kind="stable"):
        fit = [w for w in range(len(open_)) if open_[w] >= lengths[i]]
        room = min((open_[w] for w in fit), default=None)
        assert (room is None) == (got[i] >= len(open_))
        if room is None:
            open_.append(100)
        assert open_[got[i]] == (100 if room is None else room)
        open_[got[i]] -= lengths[i]


def test_packing_ids_are_those_of_the_tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    tok, ids = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.tokenizer()
    tok.encode_special_tokens = True  # a document that names an added token is ordinary text
    added = [t.content for t in tok.get_added_tokens_decoder().values()]
    texts = [f"a {x} b{x}{x}" for x in added] + [x[:-1] for x in added] + ["\x00\x1f   x  \n\n y\t\tz", "é ﬁ ½ 𝕏 👩‍👩‍👧", "'S 'LL don't", " " * 500 + "a", "x" * 3000]
    for text in texts:
        assert ids(text).tolist() == tok.encode(text, add_special_tokens=False).ids


def test_the_packing_query_has_the_ids_of_the_tokenizer_as_loaded(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    import numpy as np
    import public_tokenizers

    from tidewheel.llm import catalog

    tok = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    added = [t.content for t in tok.get_added_tokens_decoder().values()]
    texts = [f"a {x} b{x}{x}" for x in added] + [x[:-1] for x in added] + ["\x00\x1f   x  \n\n y\t\tz", "é ﬁ ½ 𝕏 👩‍👩‍👧", "'S 'LL don't", " " * 500 + "a"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    for r in catalog.op3_packing(spark, str(tmp_path)).collect():
        ids = [*tok.encode(texts[r.doc_id], add_special_tokens=False).ids, packing.END_ID]
        assert (r.doc_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()))


def test_packing_edges(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, " " * 20000 + "x" * 20000), (3, "<|endoftext|>")]
    out = packing.packed(spark.createDataFrame(rows, "doc_id long, text string"), ids=False).collect()
    assert sorted((r.doc_id or -1, r.doc_tokens) for r in out if r.doc_id != 2)[:3] == [(-1, 1), (1, 1), (1, 1)]
    assert sum(r.doc_tokens for r in out if r.doc_id == 3) == 8
    assert packing.packed(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_language_scores(frame, rows):
    learn = language.trained_on(frame["doc_id"])
    got = {r.doc_id: r for r in language.scored(frame, learn).collect()}
    texts = {i: [*(t or "").translate(str.maketrans(UPPER, LOWER)).encode().split(), None] for i, t, _ in rows}
    counts = collections.Counter(w for i, ws in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in texts.items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert got[i].base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        assert got[i].score < 0


def test_language_counts_of_rare_words_are_joined(frame, monkeypatch):
    learn = language.trained_on(frame["doc_id"])
    want = {r.doc_id: r for r in language.scored(frame, learn).collect()}
    monkeypatch.setattr(language, "vocabulary", lambda counts, f=language.vocabulary: f(counts, 1000))
    for r in language.scored(frame, learn).collect():
        assert (r.n_known, r.n_tokens) == (want[r.doc_id].n_known, want[r.doc_id].n_tokens)
        assert r.base_score == pytest.approx(want[r.doc_id].base_score)


def test_language_model_is_normalised_and_learns():
    import numpy as np

    rng = np.random.default_rng(1)
    size = 40
    truth = rng.dirichlet(np.full(size, 0.1), size)
    pairs = np.stack([rng.multinomial(2000, p) for p in truth])
    logs = language.estimated(pairs.astype(float), steps=400, dim=40).astype(float)
    assert np.allclose((10**logs).sum(1), 1, atol=1e-5)
    share = pairs / pairs.sum()
    unigram = np.log10(pairs.sum(0) / pairs.sum())
    assert (share * logs).sum() > 0.7 * (share * unigram).sum()


def test_language_edges(spark):
    rows = [(None, None), (2, ""), (2, "new words"), (3, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = language.scored(df, df["doc_id"] == -1).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens) for r in out) == [(-1, 1, 0, 0), (2, 1, 0, 0), (2, 3, 0, 0), (3, 2, 0, 0)]
    assert language.scored(df.limit(0), df["doc_id"] == 1).count() == 0


def test_sharding(spark, frame):
    rows = [(i % 7, "same", i) for i in range(500)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int").withColumn("w", frame.sparkSession.range(1).select().count() * 0 + sharding.F.lit(1000))
    once, twice = (sharding.sharded(df.select("doc_id", "text", "w"), "w", shards=16, bucket_bytes=50_000).collect() for _ in range(2))
    assert sorted(map(str, once)) == sorted(map(str, twice))
    by = collections.defaultdict(list)
    for r in once:
        by[r.shard].append(r.slot)
    assert len(once) == 503 and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert collections.Counter((r.doc_id, r.text) for r in once) == collections.Counter((a, b) for a, b, _ in rows)
    assert sharding.sharded(df, "w").columns == ["doc_id", "text", "w", "shard", "slot"]
    assert sharding.sharded(df.limit(0), "w").count() == 0


def test_shards_are_uniform_and_written(spark, tmp_path):
    df = spark.range(0, 8000, 1, 4).selectExpr("id AS doc_id", "1 AS w")
    placed = sharding.sharded(df, "w", bucket_bytes=200_000)
    low = placed.where("doc_id < 4000").groupBy("shard").count().collect()
    assert all(190 < r["count"] < 310 for r in low)
    sharding.write_shards(placed, str(tmp_path / "shards"))
    again = spark.read.parquet(str(tmp_path / "shards"))
    assert again.count() == 8000 and again.select("shard").distinct().count() == 16


def test_the_sharding_query_places_and_writes_texts(spark, tmp_path, monkeypatch):
    from tidewheel.llm import catalog

    rows = [(i % 90 if i else None, None if i % 7 == 0 else f"text {i} " * (i % 50), "en", "web", 1) for i in range(300)] + [(1000, "é" * 3_000_000, "fr", "web", 3_000_000)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    paths = []
    monkeypatch.setattr(sharding, "write_shards", lambda placed, path, f=sharding.write_shards: (paths.append(path), f(placed, path)))
    got = catalog.op8_sharding(spark, str(tmp_path)).collect()
    again = spark.read.parquet(*paths).select("doc_id", "text", "shard", "slot").collect()
    by_slot = {(r.shard, r.slot): r for r in again}
    assert len(again) == len(by_slot) == len(got) == 301
    assert sorted(((r.doc_id, r.text) for r in again), key=str) == sorted(((r[0], r[1]) for r in rows), key=str)
    for r in got:
        text = (by_slot[r.shard, r.slot].text or "").encode()
        assert (r.doc_id, r.size, r.text_crc32) == (by_slot[r.shard, r.slot].doc_id, len(text) + 1, zlib.crc32(text))


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = quality.scored(docs, quality.fit(docs, labels)).join(labels, "doc_id")
    held = [r for r in out.where(~quality.trained_on(out["doc_id"])).collect()]
    right = sum((r.score >= quality.THRESHOLD) == (r.quality == 1) for r in held)
    assert right >= 0.93 * len(held) and len(held) > 50
    assert all(0 <= r.score <= 1 for r in held)


def test_quality_edges(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(frame, none) is None
    assert {r.score for r in quality.scored(frame, None).collect()} == {1.0}
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(frame.withColumnRenamed("extra", "quality"), labels)
    assert quality.scored(frame, model).count() == frame.count()
    assert set(quality.accepted(frame, model).columns) == set(frame.columns)
