"""Near duplicates and repeated passages against brute force; components; the pipeline."""

import collections
import hashlib
import random

import numpy as np
import pytest
from llm_cases import frame, prose, rows, words

from postline.llm import bagminhash, itq, paragraphs, suffixes
from postline.llm.components import components


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark)


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


def copies(n, size, changes, seed):
    """Texts that each differ from one text in a few words."""
    base, r = words(size, seed), random.Random(seed)
    out = [" ".join(base)]
    for _ in range(n - 1):
        w = list(base)
        for _ in range(changes):
            w[r.randrange(size)] = f"w{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


# ---- components


@pytest.mark.parametrize("shape", ["random", "chain", "star", "cycle"])
def test_components_against_union(spark, shape):
    r = random.Random(4)
    pairs = {
        "random": [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(5, 5), (None, 3), (3, None)],
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(500, i) for i in range(60)],
        "cycle": [(i, (i + 1) % 9) for i in range(9)],
    }[shape]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    real = [(a, b) for a, b in pairs if a is not None and b is not None and a != b]
    assert got == union(real, {n for p in real for n in p})


# ---- op4


def test_vectors_against_brute_force(spark):
    random_ = np.random.default_rng(6)
    data = []
    for _ in range(40):
        center = random_.normal(size=32)
        data += [center + random_.normal(size=32) * s for s in random_.uniform(0, 0.3, random_.integers(1, 12))]
    data = [v.astype(np.float32).tolist() for v in data]
    data += [data[0], data[0], [2 * x for x in data[3]], [0.0] * 32, None, [], [float("nan")] * 32, [None] * 32, [float("inf")] + [1.0] * 31, [1.0, 2.0], [1.0, 2.1]]
    table = [(i, v, 1, "x") for i, v in enumerate(data)] + [(None, data[1], 2, "x")]
    frame_ = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int, node string")
    usable = {i: np.array(v) for i, v in enumerate(data) if v and None not in v and np.isfinite(v).all() and any(v)}
    usable["none"] = np.array(data[1])
    links = [(a, b) for a in usable for b in usable if str(a) < str(b) and len(usable[a]) == len(usable[b])
             and usable[a] @ usable[b] / np.sqrt((usable[a] @ usable[a]) * (usable[b] @ usable[b])) >= 0.95]
    degree = collections.Counter(n for p in links for n in p)
    got = itq.near_duplicates(frame_).collect()
    assert len(got) == len(table)
    known = sum(r["n_links"] for r in got)
    assert 0.97 * 2 * len(links) <= known <= 2 * len(links)
    for r in got:
        name = "none" if r["vec_id"] is None else r["vec_id"]
        assert r["n_links"] <= degree[name]
        if name not in usable:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, r["vec_id"], True)
        assert r["kept"] == (r["component_id"] == r["vec_id"])
    assert itq.near_duplicates(frame_.where("false")).count() == 0
    assert itq.near_duplicates(frame_.where("embedding is null")).count() == 1


def test_recall_of_the_tables_at_the_threshold():
    """Pairs right at the threshold meet in some table in nine cases of ten or more."""
    random_ = np.random.default_rng(9)
    base = random_.normal(size=(4000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = random_.normal(size=base.shape)
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    other = 0.95 * base + np.sqrt(1 - 0.95**2) * side
    model = itq.fit(base)
    one, two = itq.encode(base, *model), itq.encode(other, *model)
    differ = one.view(np.uint64) ^ two.view(np.uint64)
    met = np.zeros(len(base), dtype=bool)
    for code, first, width in itq.tables(64, 10**6, itq.CODES):
        met |= np.bitwise_count((differ[:, code] >> np.uint64(first)) & np.uint64((1 << width) - 1)) <= 1
    assert met.mean() >= 0.9


@pytest.mark.parametrize("rows_", [10**4, 65_537, 10**6, 3 * 10**6, 10**8])
def test_recall_holds_for_any_number_of_vectors(rows_):
    random_ = np.random.default_rng(9)
    base = random_.normal(size=(4000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = random_.normal(size=base.shape)
    side -= (side * base).sum(1, keepdims=True) * base
    other = 0.95 * base + np.sqrt(1 - 0.95**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    rate = itq.differing(base, itq.fit(base, 1))
    codes = itq.codes_for(64, rows_, rate)
    parts = itq.tables(64, rows_, codes)
    assert itq.missed(parts, rate) < 0.01
    assert {w for _, _, w in parts} == {int(np.ceil(np.log2(rows_)))}
    model = itq.fit(base, codes)
    differ = itq.encode(base, *model).view(np.uint64) ^ itq.encode(other, *model).view(np.uint64)
    met = np.zeros(len(base), dtype=bool)
    for code, first, width in parts:
        met |= np.bitwise_count((differ[:, code] >> np.uint64(first)) & np.uint64((1 << width) - 1)) <= 1
    assert met.mean() > 0.99


@pytest.mark.parametrize("bits", [1, 2, 3, 8, 32])
def test_vectors_of_few_dimensions_have_tables(bits):
    for n in (2, 10**4, 10**8):
        assert itq.missed(itq.tables(bits, n, itq.codes_for(bits, n, 0.1011)), 0.1011) < 0.01


def test_no_places_of_vectors_go_through_the_driver(spark, monkeypatch):
    """What is joined after an explode, or pairs with ids that repeat, is larger than its files: no side is broadcast, however small those are."""
    from pyspark.sql import functions as F

    from postline.llm import components as linked

    random_ = np.random.default_rng(3)
    data = np.repeat(random_.normal(size=(60, 16)), 3, axis=0) + random_.normal(size=(180, 16)) * 0.02
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, vector array<double>")
    vectors = itq.stage(vectors.withColumn("node", F.unhex(F.md5(F.col("vec_id").cast("string")))).select("node", "vector"))
    plans = []

    def noted(frame_, *rest):
        plans.append(frame_._jdf.queryExecution().executedPlan().toString())
        return original(frame_, *rest)

    original = itq.stage
    monkeypatch.setattr(itq, "stage", noted)
    monkeypatch.setattr(linked, "stage", noted)
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) >= 2**20
    found = noted(itq.links(vectors))
    assert found.count() >= 150
    noted(linked.components(found)).count()
    joins = [p for p in plans if "Join" in p]
    assert len(joins) >= 4 and not any("Broadcast" in p for p in joins)


def test_few_vectors_are_sent_for_the_sample(spark):
    """The sample is that of the smallest hashes, of rows that are few before tasks send them."""
    from pyspark.sql import functions as F

    vectors = spark.range(20_000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("node"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"))
    want = [r["vector"] for r in vectors.orderBy(F.xxhash64("node")).limit(100).collect()]
    assert itq.smallest_hashes(vectors, 20_000, 100).tolist() == want
    assert 100 <= itq.low_hashes(vectors, 20_000, 100).count() <= 300
    assert len(itq.smallest_hashes(vectors.limit(150), 150, 100)) == 100


# ---- op5


def cut_by_hand(text):
    """The paragraphs of a text by their definition, one place at a time."""
    found = text.split()
    h = [int(x) for x in paragraphs.rolled(paragraphs.hashed(text.encode(), *paragraphs.words_at(text.encode())), 3)]
    starts = [0] + [i for i in range(1, len(h)) if all(h[i] < x for x in h[max(0, i - 11) : i]) and all(h[i] <= x for x in h[i + 1 : i + 12])]
    out = []
    for a, b in zip(starts, [*starts[1:], len(found)], strict=True):
        step = 32 if b - a > 64 else 64
        out += [(k, found[k : min(k + step, b)]) for k in range(a, b, step)]
    return [(k, p) for k, p in out if len(p) >= 12]


def test_paragraphs_against_brute_force(spark):
    r = random.Random(2)
    shared = [" ".join(words(60, 50 + k)) for k in range(4)]
    close = shared[0].split()
    close[20] = "other"
    data = []
    for i in range(30):
        lines = [" ".join(words(r.randrange(5, 60), 1000 + 10 * i + k)) for k in range(4)] + r.sample([*shared, " ".join(close), "short line"], 2)
        r.shuffle(lines)
        data.append((i, "\n".join(lines)))
    data += [(None, data[0][1]), (0, data[0][1]), (40, None), (41, ""), (42, "short line"), (43, "so " * 200), (44, "then " + "so " * 150)]
    frame_ = spark.createDataFrame([(*row, "x") for row in data], "doc_id long, text string, place string")
    items = {(i is None, i or 0, k): set(zip(*(p[j:] for j in range(5)), strict=False)) for i, t in data for k, p in cut_by_hand(t or "")}
    pairs = [(a, b) for a in items for b in items if a < b and len(items[a] & items[b]) * 100 >= 80 * len(items[a] | items[b])]
    root = union(pairs, items)
    gone, some = collections.Counter(), collections.Counter()
    for n in {n for p in pairs for n in p}:
        some[n[:2]] += 1
        gone[n[:2]] += root[n] != n
    assert sum(gone.values()) > 40
    for row in paragraphs.removal(frame_).collect():
        name = (row["doc_id"] is None, row["doc_id"] or 0)
        assert (row["n_repeated"], row["n_removed"]) == (some[name], gone[name])
        if not row["n_removed"]:
            assert row["n_bytes"] == row["n_bytes_kept"]
    assert paragraphs.removal(frame_.where("false")).count() == 0


def test_passages_over_short_lines_and_inside_long_ones(spark):
    r, n = random.Random(9), 120
    passages = [words(60 + 5 * (k % 9), 300 + k) for k in range(n)]
    data = []
    for k, passage in enumerate(passages):
        before, after = words(40 + k % 30, 5000 + k, 10**6), words(50, 7000 + k, 10**6)
        data.append((2 * k, " ".join([*before, *passage, *after])))
        broken = "".join(w + r.choice(["\n", " ", " ", " "]) for w in passage)
        data.append((2 * k + 1, "\n".join([" ".join(words(7, 9000 + k, 10**6)), broken, " ".join(after[:9][::-1])])))
    data += [(2 * n + k, " ".join(words(200, 20_000 + k, 10**6))) for k in range(60)]
    got = {x["doc_id"]: x for x in paragraphs.removal(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    caught = sum(got[2 * k]["n_repeated"] > 0 and got[2 * k + 1]["n_removed"] > 0 for k in range(n))
    assert caught >= 0.95 * n
    assert all(got[2 * n + k]["n_repeated"] == 0 for k in range(60))


def test_text_without_its_ranges(spark):
    text = " ".join(words(300, 1)) + " été 漢字 " + " ".join(words(300, 2))
    before, after = prose(40, 3), prose(40, 4) + " end ☃"
    rows_ = paragraphs.deduplicated(spark.createDataFrame([(1, text), (2, f"{before} {text}\n\t{after}")], "doc_id long, text string")).collect()
    by_id = {x["doc_id"]: x for x in rows_}
    assert by_id[1]["__kept"] == text
    left = by_id[2]["__kept"]
    assert left.startswith(before[:20]) and left.endswith(after[-20:]) and len(left) < len(text) / 2


def test_blocks_of_a_long_text_change_nothing(monkeypatch):
    data = ("  " + prose(3000, 5) + "\t\r\n").encode()
    starts, stops = paragraphs.words_at(data)
    assert [data[a:b] for a, b in zip(starts, stops, strict=True)] == data.split()
    whole = paragraphs.hashed(data, starts, stops)
    monkeypatch.setattr(paragraphs, "BLOCK", 50)
    assert (paragraphs.hashed(data, starts, stops) == whole).all()
    assert len(set(zip(whole.tolist(), data.split(), strict=True))) == len(set(whole.tolist())) == len(set(data.split()))


def test_tuned_bands_reach_the_recall():
    rows_ = paragraphs.tuned_rows()
    s = paragraphs.SIMILARITY / 100
    chance = lambda r: 1 - (1 - s**r) ** (paragraphs.PLACES // r)
    assert chance(rows_) >= paragraphs.RECALL > chance(rows_ + 1)


def test_paragraphs_of_odd_texts(spark, docs):
    got = paragraphs.removal(docs).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] not in (2, 4, 12, None)}
    # short lines are compared too: 2 is a copy of 1, 3 one with a word changed
    assert by_id[1]["n_repeated"] > 5 and by_id[1]["n_removed"] == 0
    assert [r["n_removed"] for r in got if r["doc_id"] == 2] == [by_id[1]["n_repeated"]] * 2
    assert by_id[3]["n_removed"] > 0
    assert by_id[11]["n_removed"] == 0 and by_id[11]["n_repeated"] > 0
    assert sorted(r["n_removed"] > 0 for r in got if r["doc_id"] == 12) == [False, True]


# ---- op9


def brute_removal(data, length):
    seen = collections.Counter(t[o : o + length] for _, t in data for o in range(len(t) - length + 1))
    out = []
    for i, t in data:
        gone = bytearray(len(t))
        for o in range(len(t) - length + 1):
            if seen[t[o : o + length]] > 1:
                gone[o : o + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i is None, i or 0, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def passages(seed):
    """Texts of passages that overlap, nest and follow each other, some at the very ends."""
    r = random.Random(seed)
    stock = [" ".join(words(40, 300 + k)) for k in range(8)]
    out = []
    for i in range(60):
        parts = []
        for _ in range(r.randrange(1, 5)):
            s = r.choice(stock)
            a = r.randrange(len(s) // 2)
            parts += [s[a : a + r.randrange(10, len(s))], r.choice(["", " ", " ".join(words(r.randrange(1, 9), r.random()))])]
        out.append((i, "".join(parts)))
    return [*out, (70, "ab" * 300), (71, "é漢" * 150 + "x"), (72, None), (73, ""), (None, out[3][1]), (4, out[4][1])]


@pytest.mark.parametrize(("group", "most"), [(suffixes.GROUP, suffixes.SORTED), (suffixes.GROUP, 2), (2, 2)])
def test_removal_against_brute_force(spark, group, most):
    """Small groups are sorted, larger ones hashed in the task, the largest by Spark; the result is the same."""
    data = passages(11)
    frame_ = spark.createDataFrame([(*row, "x", "y") for row in data], "doc_id long, text string, doc string, spans string")
    found = suffixes.without_repeats(frame_, ["doc_id"], length=24, key=9, group=group, most=most).collect()
    got = sorted((r["row"]["doc_id"] is None, r["row"]["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in found)
    assert got == brute_removal([(i, (t or "").encode()) for i, t in data], 24)


def test_removal_of_odd_texts(spark, docs):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, *r[1:]) for r in suffixes.removal(docs).collect())
    assert got == brute_removal([(r[0], (r[1] or "").encode()) for r in rows()], 200)
    assert suffixes.removal(frame(spark, [])).count() == 0


def test_long_texts_are_sampled_in_pieces(monkeypatch):
    data = np.frombuffer(prose(4000, 21).encode(), dtype=np.uint8)
    rolling = suffixes.Rolling(len(data))
    hashes, begin, size, _ = suffixes.sampled(data, rolling)
    runs = [(int(h), b + k) for h, b, s in zip(hashes, begin, size, strict=True) for k in range(s - suffixes.LENGTH + 1)]
    assert [at for _, at in runs] == list(range(len(data) - suffixes.LENGTH + 1))
    part = suffixes.sampled(data[1000:3000], rolling)
    again = [(int(h), b + k + 1000) for h, b, s in zip(*part[:3], strict=True) for k in range(s - suffixes.LENGTH + 1)]
    assert again == runs[1000 : 1000 + len(again)]


def test_intervals_are_the_maximal_repeats():
    texts = [b"xabcdefy", b"zabcdefw", b"qbcdefq", b"abcabcabc"]
    found = {(n, frozenset(zip(s.tolist(), o.tolist(), strict=True))) for n, s, o in suffixes.maximal_repeats(texts, np.zeros(4, int), 3)}
    want = set()
    every = [(i, o) for i, t in enumerate(texts) for o in range(len(t))]
    for i, o in every:
        for n in range(3, len(texts[i]) - o + 1):
            s = texts[i][o : o + n]
            at = [(j, p) for j, p in every if texts[j][p : p + n] == s]
            left = {texts[j][p - 1] if p else None for j, p in at}
            right = {texts[j][p + n] if p + n < len(texts[j]) else None for j, p in at}
            if len(at) > 1 and (len(left) > 1 or None in left) and (len(right) > 1 or None in right):
                want.add((n, frozenset(at)))
    assert want == found


# ---- op10


def multiset(text):
    w = (text or "").encode().split()
    n = min(5, len(w))
    return collections.Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if n else None


def test_groups_against_brute_force(spark):
    data = [(i, t) for i, t in enumerate(copies(25, 120, 2, 1) + copies(15, 60, 1, 2) + copies(10, 300, 25, 3) + [prose(40, k) for k in range(100, 120)])]
    data += [(100, data[3][1]), (100, data[3][1]), (101, None), (102, ""), (103, "  "), (104, "a b"), (105, "a b"), (106, "a " * 400), (107, "a " * 410), (None, data[2][1])]
    frame_ = spark.createDataFrame([(*row, "x", "y") for row in data], "doc_id long, text string, node string, kept string")
    bags = {}
    for k, (i, t) in enumerate(data):
        bags[(i is None, i or 0, k)] = multiset(t)
    pairs = [(a, b) for a in bags for b in bags if a < b and bags[a] and bags[b]
             and (c := sum((bags[a] & bags[b]).values())) * 100 >= 80 * (sum((bags[a] | bags[b]).values())) and c]
    root = union(pairs, bags)
    want = sorted((a[0], a[1], root[a][1]) for a in bags)
    got = bagminhash.near_duplicates(frame_).collect()
    assert want == sorted((r["doc_id"] is None, r["doc_id"] or 0, r["cluster_id"]) for r in got)
    kept = bagminhash.keep_one_of_each(frame_)
    assert kept.columns == frame_.columns
    assert kept.count() == len(set(root.values()))
    assert bagminhash.near_duplicates(frame_.where("false")).count() == 0


def test_signatures_estimate_weighted_similarity():
    r = random.Random(3)
    errors = []
    for k in range(30):
        a = collections.Counter({x: r.randrange(1, 9) for x in range(120)})
        b = collections.Counter({x: max(1, v + r.choice([0, 0, 1, -1, 4])) for x, v in a.items() if r.random() < 0.9})
        want = sum((a & b).values()) / sum((a | b).values())
        element = np.array([x for bag in (a, b) for x in bag], dtype=np.uint64) + np.uint64(1000 * k)
        weight = np.array([v for bag in (a, b) for v in bag.values()])
        owner = np.repeat([0, 1], [len(a), len(b)])
        first = bagminhash.signatures(bagminhash.mix(element), weight, owner, 2)
        errors.append((first[0] == first[1]).mean() - want)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_signature_does_not_depend_on_the_neighbours():
    found = [bagminhash.shingles(t) for t in (prose(100, 1), "a " * 500, prose(9, 2))]
    owner = np.repeat(np.arange(3), [len(e) for e, _ in found])
    every = bagminhash.signatures(np.concatenate([e for e, _ in found]), np.concatenate([w for _, w in found]), owner, 3)
    for k, (e, w) in enumerate(found):
        assert (bagminhash.signatures(e, w, np.zeros(len(e), int), 1)[0] == every[k]).all()


def test_open_pairs_join_what_the_stars_leave(spark):
    """A chain whose ends are not alike is one group, whoever is the centre."""
    base = words(100, 77)
    chain = [" ".join(base[6 * k : 6 * k + 64]) for k in range(6)]
    frame_ = spark.createDataFrame(list(enumerate(chain)), "doc_id long, text string")
    similar = bagminhash.similar(bagminhash.shingles(chain[0]), bagminhash.shingles(chain[1]))
    got = {r["cluster_id"] for r in bagminhash.near_duplicates(frame_).collect()}
    assert similar and got == {0}


# ---- pipeline


def test_pipeline_handles_odd_rows(spark, tmp_path):
    import corpus_pipeline

    sf = str(tmp_path)
    data = [(*row[:4], len(row[1] or "")) for row in rows()]
    data += [(200 + k, prose(60, 500 + k), "en", "a", 0) for k in range(40)] + [(300 + k, "%%% ### " * 40, "en", "b", 0) for k in range(20)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    marks = [(200 + k, 1) for k in range(40)] + [(300 + k, 0) for k in range(20)]
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "mixing", "packing"]
    from postline.llm.common import stage

    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, stage(step(spark, docs, sf))
        if name == "quality":
            assert docs.where("doc_id >= 300").count() == 0 and docs.where("doc_id between 200 and 240").count() == 40
        if name == "near_duplicates":
            assert docs.where("doc_id = 1").count() == 1 and docs.where("doc_id in (2, 3)").count() == 0
        if name == "repeated_passages":
            assert docs.count() == before.count()
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert docs.count() > 0
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{sf}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{sf}/none").count() == 0
