"""Filter audit, vector codes and token counts against plain versions."""

import collections
import hashlib
import itertools
import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest

from tidewheel.llm import audit, catalog, tokencounts, veccodes
from tidewheel.llm.tables import read

FOLDER = "/root/testdata/sf0.001"

# --- filter audit ---

DOCS = "doc_id long, text string, source string, part string, failed int, labelled long"
LABELS = "doc_id long, quality int, toxic int, n long"


def words_of(rng, n, pool=10**6):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


def audit_rows():
    rng = random.Random(5)
    long = words_of(rng, 250)
    texts = [None, "", " \t\n", long, long, long + " $", "A" * 30 + " " + long, words_of(rng, 300, 20), "é\x1cÉ " * 260, words_of(rng, 199), words_of(rng, 200), "x" * 5000]
    texts += [words_of(rng, rng.choice([10, 220]), rng.choice([9, 10**6])) + rng.choice(["", " A|B", " AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA"]) for _ in range(40)]
    rows = [(i, t, rng.choice(["s", "t", "", None]), "x", 3, 7) for i, t in enumerate(texts)]
    rows += [(i, t, "copies", None, None, None) for i, t in enumerate([long] * 30 + [None] * 3, 1000)]
    return rows + [(3, long, "s", None, None, None), (3, long, "t", None, None, None), (None, long, "s", None, None, None), (None, "only", "s", None, None, None), (-5, "only", None, None, None, None)]


def plain_audit(docs, labels):
    good, toxic = ({i for i, *m in labels if i is not None and m[k] == 1} for k in (0, 1))
    least = {}
    for i, t, *_ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    judged = collections.defaultdict(list)
    for i, t, source, *_ in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least[t] < i}
        judged[source or ""].append(({f for f in fails if fails[f]}, i in good, i in toxic))
    out = []
    for part, rows in judged.items():
        total = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                failing = sum(f in r[0] for r in rows)
                left = [r for r in left if f not in r[0]]
                total[f] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)])
        out = [r if r[0] != part or len(r) > 9 else [*r, total[r[1][r[2] - 1]]] for r in out]
    return sorted(map(tuple, out))


def test_audit_equals_every_order_applied(spark):
    docs = audit_rows()
    labels = [(i, i % 2, i % 3 == 0, 1) for i in range(0, 60)] + [(3, 1, 1, 1), (3, None, 0, 1), (None, 1, 1, 1)]
    labels = [(i, q, None if t is None else int(t), n) for i, q, t, n in labels]
    got = audit.audited(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(labels, LABELS))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == plain_audit(docs, [r[:3] for r in labels])


def test_audit_of_nothing(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit.audited(docs, labels).count() == 0
    one = audit.audited(spark.createDataFrame([(1, None, None, None, None, None)], DOCS), labels).collect()
    assert len(one) == 600 and {(r.part, r.good_lost, r.toxic_lost) for r in one} == {("", 0, 0)}


def test_shares_are_shapley_values():
    rng = random.Random(2)
    v = [0] + [rng.randrange(1000) for _ in range(31)]
    for i, got in enumerate(audit.shares(v)):
        want = Fraction(0)
        for s in range(32):
            if not s >> i & 1:
                size = s.bit_count()
                want += Fraction(math.factorial(size) * math.factorial(4 - size), 120) * (v[s | 1 << i] - v[s])
        assert got == want


# --- vector codes ---

VECTORS = "vec_id long, embedding array<double>, label int, ints int"


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(Fraction(x) * 256) for x in v], label) for i, v, label, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = {i: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for i, v, _ in kept}
    books = [[cut[i][p] for i in sorted(cut)[:entries]] for p in range(parts)]

    def dist(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign():
        return {i: [min((dist(v[p], b), e) for e, b in enumerate(books[p])) for p in range(parts)] for i, v in cut.items()}

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut[i][p] for i in cut if found[i][p][1] == e]
                if mine:
                    books[p][e] = tuple(sum(c) // len(mine) for c in zip(*mine, strict=True))
    found = assign()
    error = {i: sum(d for d, _ in f) for i, f in found.items()}
    by_label = collections.Counter()
    for i, _, label in kept:
        by_label[label] += error[i]
    sha = hashlib.sha256(",".join(str(n) for b in books for e in b for n in e).encode()).hexdigest()
    return {i: ("".join(f"{e:02x}" for _, e in found[i]), error[i], by_label[label], sha) for i, _, label in kept}


def vector_rows(n, dim, scale, seed):
    rng = random.Random(seed)
    points = [[rng.gauss(0, scale) for _ in range(dim)] for _ in range(n // 3)]
    rows = [(i, [x + rng.choice([0, 0, rng.gauss(0, scale / 8)]) for x in rng.choice(points)], rng.choice([1, 1, 1, 2, None]), 0) for i in range(n)]
    bad = [None, [None] + [0.0] * (dim - 1), [math.nan] * dim, [math.inf] + [1.0] * (dim - 1)]
    return rows + [(n + k, v, 1, 0) for k, v in enumerate(bad)]


def collected(frame):
    return {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in frame.collect()}


@pytest.mark.parametrize(("n", "dim", "scale"), [(400, 32, 0.3), (150, 16, 0.004), (40, 48, 3.0)])
def test_codes_equal_plain_lloyd(spark, n, dim, scale):
    rows = vector_rows(n, dim, scale, n)
    got = veccodes.codes(spark.createDataFrame(rows, VECTORS).repartition(4))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert collected(got) == plain_codes(rows)


def test_codes_of_huge_numbers_are_exact(spark):
    rows = vector_rows(90, 16, 3e6, 4) + [(500, [1e15] * 16, 3, 0), (501, [-1e300] + [0.0] * 15, 4, 0)]
    want = plain_codes(rows)
    # what doesn't fit a long is null
    want = {i: (c, *[x if x < 1 << 63 else None for x in (e, s)], h) for i, (c, e, s, h) in want.items()}
    assert collected(veccodes.codes(spark.createDataFrame(rows, VECTORS))) == want


def test_active_entries_compare_as_a_full_scan_does():
    rng = np.random.default_rng(1)
    x = rng.integers(-6, 6, (500, 3)).astype(float)
    old = rng.integers(-6, 6, (20, 3)).astype(float)
    new = old.copy()
    new[[3, 4, 11]] = rng.integers(-6, 6, (3, 3))
    at, d = veccodes.nearest(x, old)
    got_at, got_d, done = veccodes.reassigned(x, old, new, at, d)
    want_at, want_d = veccodes.nearest(x, new)
    assert (got_at == want_at).all() and (got_d == want_d).all() and done < len(x) * len(new) / 2
    assert veccodes.reassigned(x, old, old, at, d)[2] == 0


def test_codes_edges(spark):
    frame = spark.createDataFrame([], VECTORS)
    assert veccodes.codes(frame).count() == 0 and veccodes.codes(frame).columns[0] == "vec_id"
    # null and repeated ids, other lengths, a length that is no multiple of 16, empty vectors, hot and rare labels
    rows = [(None, [1.0] * 16, 1, 0), (7, [1.0] * 16, 1, 0), (7, [2.0] * 16, None, 0), (8, [0.5] * 17, None, 0), (9, [], 1, 0)]
    got = veccodes.codes(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(got) == 5 and all(r.error == 0 and r.label_error == 0 for r in got)
    assert len({r.codebooks_sha256 for r in got}) == 3
    assert sorted(r.code[:2] for r in got if r.vec_id is None or r.vec_id == 7) == ["00", "00", "01"]  # equal entries: the lower one


def test_rare_labels_are_summed_too(spark):
    rows = [(i, [math.sin(i * j) for j in range(16)], None if i < 900 else i // 2, 0) for i in range(2300)]
    assert collected(veccodes.codes(spark.createDataFrame(rows, VECTORS))) == plain_codes(rows)


# --- token counts ---

TEXTS = "doc_id long, text string, key string, row long"
ODD = [
    None,
    "",
    " ",
    "   ",
    "a ",
    "  two  spaces ",
    "line\nline\r\n\n\tx\t y",
    "▁low ▁ ▁▁line▁",
    "<s> </s> <unk> <0x41> [INST]",
    "ﬁ ① Ａ é é  x　y ​",
    "\0nul \x1c\x85",
    "日本語のテキスト" * 40,
    "🎉🏳️‍🌈 " * 30,
    "x" * 20_000,
    " " * 5_000,
    "no-space-" * 3_000,
    "word " * 20_000,
]


@pytest.fixture(scope="module")
def sentencepiece_count():
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return lambda text: len(model.encode(text or ""))


@pytest.mark.parametrize("known", [0, 3, tokencounts.KNOWN])
def test_counts_equal_the_library(spark, sentencepiece_count, known):
    rng = random.Random(3)
    alphabet = "ab é\n\t▁<s>日🎉́ ."
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(150)]
    rows = [(i, t, "k", 1) for i, t in enumerate(texts)]
    got = tokencounts.counted(spark.createDataFrame(rows, TEXTS).repartition(3), known=known)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = {i: (len((t or "").encode()), n := sentencepiece_count(t), n > 4096) for i, t in enumerate(texts)}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()} == want


def test_counts_of_rows_with_many_segments(spark, monkeypatch, sentencepiece_count):
    text = words_of(random.Random(4), 10_000)
    rows = [(None, text, "", 0), (1, text, "", 0), (1, text, "", 0), (1, "other", "", 0)]
    got = tokencounts.counted(spark.createDataFrame(rows, TEXTS), known=5)
    many = sentencepiece_count(text)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect()) == sorted([(0, many), (1, many), (1, many), (1, sentencepiece_count("other"))])
    assert tokencounts.counted(spark.createDataFrame([], TEXTS)).count() == 0


def test_registered_counts_equal_the_library(spark, sentencepiece_count):
    texts = {r.doc_id: r.text for r in read(spark, FOLDER, "documents").select("doc_id", "text").collect()}
    got = catalog.QUERIES["op13_token_counts"](spark, FOLDER).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: sentencepiece_count(t) for i, t in texts.items()}
