"""Filter orders, hard negatives and BPE against brute force, SQL and the tokenizers library."""

import collections
import hashlib
import itertools
import math
import random
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SCHEMA, frame, prose, words

from postline.llm import audit, bpe, queries, residues

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- op11


def brute_audit(docs, labels):
    """Each order walked filter by filter over the rows themselves."""
    good = {r["doc_id"] for r in labels if r["quality"] == 1 and r["doc_id"] is not None}
    toxic = {r["doc_id"] for r in labels if r["toxic"] == 1 and r["doc_id"] is not None}
    first = {}
    for r in docs:
        if r["doc_id"] is not None:
            t = r["text"] or ""
            first[t] = min(first.get(t, r["doc_id"]), r["doc_id"])
    rows = []
    for r in docs:
        t, i = r["text"] or "", r["doc_id"]
        found = WORD.findall(t)
        failed = {
            "A": len(found) < 50, "B": 100 * len(set(found)) < 65 * len(found), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t],
        }
        rows.append((r["source"] or "", {c for c, f in failed.items() if f}, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        total = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, c in enumerate(order, 1):
                removed = [r for r in left if c in r[1]]
                left = [r for r in left if c not in r[1]]
                total[c] += len(removed)
                failing = [r for r in own if c in r[1]]
                out[part, "".join(order), step] = [
                    len(left), len(removed), len(failing) - len(removed), sum(r[1] == {c} for r in own), sum(r[2] for r in removed), sum(r[3] for r in removed)
                ]
        for (p, order, step), figures in out.items():
            if p == part:
                figures.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def got_audit(rows):
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[f] for f in audit.FIGURES) for r in rows}
    assert len(out) == len(rows)
    return out


LABELS = "doc_id long, quality int, toxic int, part string, n string"


def test_orders_equal_brute_force(spark):
    text = prose(80, 1)
    loud, signs = text.upper(), text + " 5 % & more"
    data = [(r[0], r[1], r[2], r[3], *r[4:]) for r in frame(spark).collect()]
    extra = [(20, text, "a"), (21, text, "a"), (21, text, "b"), (None, text, "a"), (22, loud, None), (23, signs, ""), (24, "same same " * 40, "b"), (25, loud + " $", "b")]
    data += [(i, t, "en", s, 0, *["x"] * 10) for i, t, s in extra]
    docs = spark.createDataFrame(data, SCHEMA)
    labels = [(20, 1, 0, "x", "x"), (21, 0, 1, "x", "x"), (21, 1, None, "x", "x"), (24, 1, 1, "x", "x"), (None, 1, 1, "x", "x"), (999, 1, 1, "x", "x"), (22, None, None, "x", "x")]
    marks = spark.createDataFrame(labels, LABELS)
    want = brute_audit(docs.collect(), marks.collect())
    assert got_audit(audit.audit(docs, marks).collect()) == want
    assert audit.audit(docs.limit(0), marks).count() == 0
    assert got_audit(audit.audit(docs, marks.limit(0)).collect()).keys() == want.keys()


def test_orders_of_given_tables_equal_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = got_audit(queries.queries()["op11_path_counts"](spark, SF).collect())
    assert got == brute_audit(docs.collect(), labels.collect())


def test_path_counts_of_the_lattice():
    lattice = audit.Lattice("ABCDE")
    assert len(lattice.edges) == 80 and len(lattice.orders) == 120
    for (state, _), paths in zip(lattice.edges, lattice.paths, strict=True):
        size = state.bit_count()
        assert paths == math.factorial(size) * math.factorial(4 - size)
    assert np.array_equal(np.bincount(lattice.walks.ravel(), minlength=80), lattice.paths)
    small = audit.Lattice("AB")
    counts = np.array([[[4, 3, 2, 1]] * 3])  # none, A, B, both
    steps = small.steps(counts)
    assert small.orders == ["AB", "BA"]
    assert steps["kept"].tolist() == [[[6, 4], [7, 4]]] and steps["removed"].tolist() == [[[4, 2], [3, 3]]]
    assert steps["redundant"].tolist() == [[[0, 1], [0, 1]]] and steps["shapley"].tolist() == [[[7, 5], [5, 7]]]


# ---- op12


def brute_negatives(rows):
    seen = {}
    for vec_id, e, label in rows:
        if vec_id is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        if sum((256 * x) ** 2 for x in e) >= 1 << 60:
            continue
        label = int(math.fmod(label + 1, 10)) if vec_id % 7 == 0 else label
        seen[vec_id, label, tuple(math.floor(256 * x) for x in e)] = None
    own = list(seen)
    out = []
    for i, (a, label, q) in enumerate(own):
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p, strict=False)), b, lb == label) for j, (b, lb, p) in enumerate(own) if j != i)
        for p, pos, same in [s for s in scored if s[2]][:5]:
            window = [(s, b) for s, b, ok in scored if not ok and 80 * -p <= 100 * -s <= 100 * -p][:5]
            out += [(a, pos, k, b, -p, -s) for k, (s, b) in enumerate(window, 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, row string, score string, q string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, label, "x", "x", "x") for i, e, label in rows], VECTORS)


def mined(df):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect())


def as_float32(rows):
    return [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e], label) for i, e, label in rows]


def odd_vectors():
    r = random.Random(3)
    near = lambda base: [x + r.gauss(0, 0.05) for x in base]
    bases = [[r.gauss(0, 0.3) for _ in range(12)] for _ in range(6)]
    rows = [(i, near(bases[i % 6]), i % 3) for i in range(0, 420)]
    rows += [(500, rows[0][1], 0), (500, rows[0][1], 0), (501, rows[0][1], 1), (502, rows[0][1], 1), (503, rows[0][1], 2), (500, rows[1][1], 1)]
    rows += [(600, None, 1), (601, bases[0], None), (None, bases[0], 1), (602, [None, *bases[0][1:]], 1), (603, [float("nan")] * 12, 1), (700, [float("inf")] * 12, 2)]
    rows += [(800, [], 1), (801, bases[0][:5], 1), (900, [0.0] * 12, 2), (901, [0.0] * 12, 0), (902, [1e30] * 12, 0), (1000, [-x for x in bases[1]], 1)]
    rows += [(1100, [3e4] * 12, 1), (1101, [2.9e4] * 12, 1), (1102, [2.8e4] * 12, 2), (1103, [-3e4] * 12, 2)]
    return as_float32(rows)


def test_negatives_equal_brute_force(spark, monkeypatch):
    rows = odd_vectors()
    df = vectors(spark, rows)
    want = brute_negatives(rows)
    assert len(want) > 50
    assert mined(residues.hard_negatives(df)) == want
    monkeypatch.setattr(residues, "BLOCK_VALUES", 12 * 40)  # many blocks and stripes
    monkeypatch.setattr(residues, "LEAST_ROWS", 30)
    monkeypatch.setattr(residues, "ROWS_AT_ONCE", 16)
    monkeypatch.setattr(residues, "ANCHORS_AT_ONCE", 2)
    assert mined(residues.hard_negatives(df)) == want
    assert mined(residues.hard_negatives(df.limit(0))) == []
    assert mined(residues.hard_negatives(df.where("vec_id = 500"))) == brute_negatives([x for x in rows if x[0] == 500])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_negatives_of_given_tables_equal_brute_force_and_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    got = mined(residues.hard_negatives(spark.read.parquet(f"{path}/embeddings.parquet")))
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got == brute_negatives(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet'")
    assert got == sorted(con.execute(residues.SQL).fetchall())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 2500), st.integers(0, 30), st.randoms(use_true_random=False))
def test_residue_products_are_exact(width, bits, r):
    top = min(1 << bits, math.isqrt((1 << 60) // width))
    left, right = ([[r.randint(-top, top) for _ in range(width)] for _ in range(3)] for _ in range(2))
    left[0], right[0] = [top] * width, [-top] * width
    bound = max(sum(x * x for x in v) for v in left + right)
    primes = residues.primes_for(bound, width)
    a, b = (residues.residues(np.array(v, dtype=np.int64), primes) for v in (left, right))
    got = residues.exact_scores(a, b, primes)
    assert got.tolist() == [[sum(x * y for x, y in zip(u, v, strict=True)) for v in right] for u in left]
    assert all(m.dtype == np.float32 for m in a) and all((p // 2) ** 2 * min(width, residues.PART) <= residues.EXACT for p in primes)


# ---- op13


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path())


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(None)()


ODD = [
    "", " ", "  ", "a  b", "'s", "'sabc", "don't we'll 'tis 'S 'll've", "''s", "!'s", " 's", "\n's", "x's's", "'", "' ", "x'", "'r", "'re", "'l",
    "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|", "s<|endoftext|>  <|endoftext|>\n", "<|endoftext|>'s", "　x", "a　　b", "a" * 5000,
    "\x00\x01", "é 漢 ☃", "\x85\x1c \x1d", "1 2  3", " \n \n", "՘a \U000107bb1", "ab" * 2000, "漢字仮名" * 300, "é \U0001F600\U0001F3FD",
]


def test_ids_and_texts_equal_the_library(codec, library, spark):
    real = [r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    r = random.Random(5)
    signs = ["a", "b", "e", "s", "t", "l", "v", "r", "m", "d", "'", " ", " ", "\n", "1", "!", "é", "漢", "　", "\U0001F600", "՘", "\x85", "<|endoftext|>", "\t"]
    mixed = ["".join(r.choice(signs) for _ in range(r.randrange(1, 40))) for _ in range(4000)]
    spread = ["".join(chr(r.choice([r.randrange(1, 0xD800), r.randrange(0xE000, 0x110000)])) for _ in range(30)) for _ in range(1000)]
    long = ["".join(r.choice("abcdefgh漢字") for _ in range(3000)) for _ in range(5)]
    texts = ODD + mixed + spread + long + real
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = codec.encode(texts)
    assert [g.tolist() for g in got] == want
    assert [codec.decode(g) for g in got] == [library.decode(w, skip_special_tokens=False) for w in want]
    for w in want[: len(ODD) + 500]:  # parts of ids, with cut characters
        assert codec.decode(np.array(w[1:-1], dtype=np.int64)) == library.decode(w[1:-1], skip_special_tokens=False)
    assert codec.decode(np.array([-1, 10**6])) == ""


def test_character_classes_equal_the_library(codec, library):
    """Every code point, after a letter, a number and a sign."""
    splitter = library.pre_tokenizer
    for begin in range(0, 0x110000, 1 << 14):
        points = [c for c in range(begin, begin + (1 << 14)) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)}\n" for c in points if c not in (0x27, 0x0A))
        if text:
            cuts = bpe.code_points(text)
            first = np.zeros(len(cuts), dtype=bool)
            first[0] = True
            assert np.flatnonzero(codec.word_starts(cuts, first)).tolist() == [a for _, (a, _) in splitter.pre_tokenize_str(text)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab'st \n1é漢!\x85", max_size=60), max_size=5))
def test_any_text_equals_the_library(texts):
    from tokenizers import Tokenizer

    key = "library"
    if key not in KEPT:
        KEPT[key] = Tokenizer.from_file(bpe.vocabulary_path()), bpe.codec(None)()
    tokenizer, own = KEPT[key]
    assert [g.tolist() for g in own.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


KEPT: dict = {}


def test_long_texts_and_long_words(codec, library, monkeypatch):
    text = prose(3000, 12) + " <|endoftext|> " + " ".join(words(500, 4)) + "漢" * 4000
    whole = codec.encode([text])[0].tolist()
    assert whole == library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(bpe, "AT_ONCE", 300)
    monkeypatch.setattr(bpe, "LONG", 8)
    monkeypatch.setattr(bpe, "BLOCK", 4)
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    codec.forget()
    assert codec.encode([text, "", text])[2].tolist() == whole
    letters = "".join(random.Random(1).choice("abcdefgh") for _ in range(2000))
    for word in (letters, "a" * 777, "ab" * 301, "aab" * 200):
        assert codec.encode([word])[0].tolist() == library.encode(word, add_special_tokens=False).ids
    codec.forget()


def test_round_trip_of_tables(spark, library):
    docs = frame(spark)
    want = collections.Counter()
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        hashes = (hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
        want[(r["doc_id"], len(ids), *hashes)] += 1
    assert collections.Counter(map(tuple, bpe.round_trip(docs).collect())) == want
    encoded = bpe.encode(docs)
    decoded = bpe.decode(encoded).collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in decoded) == collections.Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert bpe.round_trip(docs.limit(0)).count() == 0 and bpe.encode(docs.limit(0)).count() == 0
    assert bpe.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")).collect() == [(1, ""), (2, "")]
    broken = docs.selectExpr("1L AS doc_id", "cast(unhex('61FF62') AS string) AS text").limit(1)
    assert bpe.decode(bpe.encode(broken)).first()["text"] == "a�b"


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="no plain byte-level BPE"):
        bpe.read_file(public_tokenizers.path("word_bpe_49k.json"))
