"""Operators over groups of rows: mixing, toxicity, MinHash, embeddings, repeated strings, components, and the pipeline."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SMOKE
from pyspark.sql import functions as F

import corpus_pipeline
from funnel_engine.llm import embedding_dedup as emb
from funnel_engine.llm import suffix_dedup as suffix
from funnel_engine.llm import toxicity as tox
from funnel_engine.llm.components import connected_components
from funnel_engine.llm.minhash_dedup import (
    band_keys,
    bucket_links,
    drop_near_duplicates,
    estimate,
    minima,
    near_duplicates,
    op10_minhash,
    packed,
    shingler,
)
from funnel_engine.llm.mixing import document_levels, mix, mix_plan, n_words

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, name):
    return spark.read.parquet(f"{SMOKE}/{name}.parquet")


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def smallest(ids, links):
    parent = {i: i for i in ids}
    for a, b in links:
        x, y = find(parent, a), find(parent, b)
        parent[max(x, y)] = min(x, y)
    return {i: find(parent, i) for i in ids}


# -- components -----------------------------------------------------------


def test_components_against_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2000 + i) for i in range(50)]
    want = smallest({x for e in links for x in e}, links)
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.id: r.component for r in connected_components(df).collect()}
    assert got == {i: c for i, c in want.items() if i in {x for a, b in links if a != b for x in (a, b)}}
    assert connected_components(df.limit(0)).count() == 0


# -- mixing ---------------------------------------------------------------


def water_fill(budget, children):
    """name -> (weight, capacity): fill by weight; what a child cannot use goes to its siblings."""
    given, open_ = {}, dict(children)
    while open_:
        left = budget - sum(given.values())
        total = sum(w for w, _ in open_.values())
        full = [k for k, (w, c) in open_.items() if c * total <= w * left]
        if not full:
            return given | {k: w * left // total for k, (w, c) in open_.items()}
        for k in full:
            given[k] = open_.pop(k)[1]
    return given


def test_mix_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["en", "de", None]), f"src{rng.randint(0, 9)}", 0) for i in range(600)]
    rows += [(7, rows[7][1], rows[7][2], rows[7][3], 0), (None, "a b", "en", "src1", 0)]
    df = spark.createDataFrame(rows, DOCS).withColumn("mix_tokens", F.lit("own")).withColumn("_leaf", F.lit(1)).withColumn("_doc", F.lit(2))
    weights = {"domain": {"web": 9, "forum": 1, "reference": 3}, "lang": {"en": 1, "de": 8}}
    plan = mix_plan(df, document_levels(), n_words(F.col("text")), weights, percent=90, max_epochs=2, piece=16).collect()
    ranged = mix_plan(df, document_levels(), n_words(F.col("text")), weights, percent=90, max_epochs=2, piece=16, siblings=1)
    assert sorted(map(tuple, ranged.collect())) == sorted(map(tuple, plan))
    domain = lambda s: "web" if s[-1] in "0123" else "forum" if s[-1] in "456" else "reference"
    leaves = collections.Counter()
    for _, t, lang, s, _ in rows:
        leaves[domain(s), lang or "(none)", s] += len(t.split())
    leaves = {k: n for k, n in leaves.items()}
    total = sum(leaves.values())

    def split(prefix, budget):
        depth = len(prefix)
        names = {k[depth] for k in leaves if k[:depth] == prefix}
        level = ["domain", "lang", "source"][depth]
        children = {n: (weights.get(level, {}).get(n, 1), 2 * sum(v for k, v in leaves.items() if k[: depth + 1] == (*prefix, n))) for n in names}
        given = water_fill(budget, children)
        return given if depth == 2 else {k: split((*prefix, k), g) for k, g in given.items()}

    want = split((), min(total * 90 // 100, 2 * total))
    for r in plan:
        assert r.share == want[r._domain][r._lang][r._source]
        assert (r.epochs, r.prefix) == divmod(r.share, r.tokens)
    out = mix(df, document_levels(), n_words(F.col("text")), weights, percent=90, max_epochs=2)
    assert out.columns[: len(df.columns) - 1] == [c for c in df.columns if c != "mix_tokens"]
    taken = collections.Counter()
    for r in out.collect():
        taken[domain(r.source), r.lang or "(none)", r.source] += r.mix_taken
        assert 0 < r.mix_taken <= r.mix_tokens == len(r.text.split())
    repeated = (domain(rows[7][3]), rows[7][2] or "(none)", rows[7][3])
    for r in plan:
        leaf = (r._domain, r._lang, r._source)
        if leaf != repeated:  # rows with one id go together, so that leaf may exceed its share
            assert taken[leaf] == r.share
    # The order of the last epoch is the seeded one.
    for r in plan:
        if not r.prefix:
            continue
        place = lambda i: hashlib.md5(f"7:{r.epochs + 1}:{'' if i is None else i}".encode()).hexdigest()  # noqa: E731, B023
        ids = {i for i, t, lang, s, _ in rows if (domain(s), lang or "(none)", s) == (r._domain, r._lang, r._source) and t.split()}
        chosen = {x.doc_id for x in out.where(F.col("mix_epoch") == r.epochs + 1).where(F.col("source") == r._source).where(F.coalesce("lang", F.lit("(none)")) == r._lang).collect()}
        assert chosen == {i for i in ids if place(i) <= r.last}
    assert mix(df.limit(0), document_levels(), n_words(F.col("text"))).count() == 0


def test_very_many_siblings(spark):
    """100,000 sources of one language: the shares are those of a list of all, which no task sees."""
    from funnel_engine.llm.mixing import RANGES, share_out

    rng = random.Random(9)
    rows = [("en", f"s{i}", rng.choice([0, 7, 7, rng.randint(1, 50_000)]), rng.choice([1, 1, 2, 5]), 900_000_000) for i in range(100_000)]
    rows += [("de", f"s{i}", 100, 1, 4_321) for i in range(50)] + [("fr", "a", 5, 1, 100), ("fr", "b", 0, 3, 100), ("it", "a", 0, 1, 0)]
    nodes = spark.createDataFrame(rows, "lang string, name string, capacity bigint, weight bigint, budget bigint")
    got = share_out(nodes, ["lang"])
    assert got.columns == [*nodes.columns, "given"]
    given = {(r.lang, r.name): r.given for r in got.collect()}
    for lang in ("en", "de", "fr", "it"):
        own = [r for r in rows if r[0] == lang]
        want = water_fill(own[0][4], {r[1]: (r[3], r[2]) for r in own})
        assert {n: given[lang, n] for _, n, *_ in own} == want
    # The windows read sums of ranges and the one range where the level ends; that one is small.
    ratios = sorted({c / w for lang, n, c, w, _ in rows if lang == "en" and given[lang, n] == c and c})
    level = np.floor(np.log2(ratios[-1]) * RANGES)
    assert sum(np.floor(np.log2(c / w) * RANGES) == level for lang, _, c, w, _ in rows if lang == "en" and c) < 1000
    # Without parents there is one family.
    alone = share_out(nodes.where("lang = 'de'").drop("lang"), [])
    assert {r.given for r in alone.collect()} == {86}


def test_shortage_stays_below_its_parent(spark):
    """A short source's tokens go to its sibling, and not to another language."""
    rows = [(1, "w " * 10, "en", "src0", 0), (2, "w " * 1000, "en", "src1", 0), (3, "w " * 1000, "de", "src2", 0)]
    plan = mix_plan(spark.createDataFrame(rows, DOCS), document_levels(), n_words(F.col("text")), {"lang": {"en": 1, "de": 1}}, percent=50, max_epochs=1).collect()
    assert {r._source: r.share for r in plan} == {"src0": 10, "src1": 492, "src2": 502}


# -- toxicity -------------------------------------------------------------


def test_held_out_rows_are_never_learnt(spark):
    ids = spark.range(2000).select("id", tox.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in ids)
    docs, labels = table(spark, "documents"), table(spark, "labels")
    flipped = labels.withColumn("toxic", F.when(tox.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = tox.train(docs, labels), tox.train(docs, flipped)
    assert a == b and a.weights


def test_non_negative_risk_separates():
    rng = random.Random(5)
    clean = [" ".join(rng.choice("abcdefghij") * 4 for _ in range(40)) for _ in range(900)]
    toxic = [t + " vile" for t in clean[:60]]
    f = tox.features
    model = tox.fit([f(t) for t in toxic[:40]], [f(t) for t in clean[100:700]] + [f(t) for t in toxic[40:]], prior=0.05)
    score = tox.scorer(model)
    assert min(score(t) for t in toxic) >= 0.7 and max(score(t) for t in clean) < 0.5
    assert tox.scorer(tox.fit([], [f("a")]))("vile") == 0.0


def test_toxicity_accuracy_on_held_out_rows(spark):
    """On the largest table of the box: accuracy against labels that were never learnt."""
    folder = SMOKE.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = tox.op2_toxicity(spark, folder).where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").toPandas()
    toxic = got.toxic == 1
    rank = got.score.rank()
    auc = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert docs.count() == tox.op2_toxicity(spark, folder).count()
    assert auc > 0.93 and got.predicted[toxic].mean() > 0.75 and got.predicted[~toxic].mean() < 0.04


def test_toxicity_odd_rows(spark):
    rows = [(1, None, "en", "a", 0), (1, "", "en", "a", 0), (None, "moron " * 50_000, None, None, None), (4, "x", "", "", 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("own"))
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    model = tox.train(docs, none)
    assert [r.score for r in tox.score_texts(docs, model).collect()] == [0.0] * 4
    model = tox.Model({x: 5.0 for x in tox.word_features(b"moron")[:1]}, -3.0)
    assert sorted(r.predicted for r in tox.score_texts(docs, model).collect()) == [0, 0, 0, 1]
    kept = tox.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 3
    assert tox.score_texts(docs.limit(0), model).count() == 0


def test_a_repeated_id_counts_once_in_the_fit(spark, monkeypatch):
    rows = [(i, f"clean{i} words{i % 7} moron{'s' * (i % 3)}" if i % 5 == 0 else f"clean{i} words{i % 7}") for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(60)], "doc_id bigint, toxic int")
    learnt = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    hot = [min(i for i in learnt if i % 5 == 0), min(i for i in learnt if i % 5)]  # one confirmed, one other
    repeats = [(i, f"another text {k}") for i in hot for k in range(300)]
    docs = spark.createDataFrame(rows + repeats, "doc_id bigint, text string")
    fitted = []
    monkeypatch.setattr(tox, "fit", lambda p, u, **k: fitted.append((len(p), len(u), sorted(x.tobytes() for x in p + u))))
    tox.train(docs, labels)
    tox.train(spark.createDataFrame((rows + repeats)[::-1], docs.schema).repartition(3), labels)
    assert fitted[0] == fitted[1] and fitted[0][:2] == (sum(i % 5 == 0 for i in learnt), len(learnt))
    tox.train(docs, labels, most_positive=2, most_unlabelled=10)
    assert fitted[2][:2] == (2, 10)


def test_rare_kind_in_a_large_sample(spark, monkeypatch):
    """A kind of toxicity in 6 of 3,600 confirmed texts, none of them among the first 2,000 in the sample's order."""
    ids = spark.range(5400).select(F.col("id").cast("string").alias("i")).where(~tox.held_out(F.col("i"))).orderBy(F.xxhash64("i", F.lit(17)), "i")
    confirmed = [int(r.i) for r in ids.collect()][:3600]
    assert len(confirmed) > 3500
    kinds = dict.fromkeys(confirmed, "moron") | dict.fromkeys(confirmed[-6:], "blackguard")
    rows = [(i, f"plain{i % 50} talk {kinds.get(i, '')}") for i in range(24_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    fitted, fit = [], tox.fit
    monkeypatch.setattr(tox, "fit", lambda p, u, **k: fitted.append((p, u)) or fit(p, u, steps=20, **k))
    model = tox.train(docs, spark.createDataFrame([(i, 1) for i in confirmed], "doc_id bigint, toxic int"), prior=0.3)
    (p, u), rare = fitted[0], set(tox.word_features(b"blackguard"))
    assert (len(p), sum(bool(rare & set(x.tolist())) for x in p), len(u)) == (len(confirmed), 6, 8_000)
    assert rare & set(model.weights) and set(tox.word_features(b"moron")) & set(model.weights)
    texts = dict(rows)
    full = [tox.features(texts[i]) for i in confirmed]
    others = [r.i for r in spark.range(24_000).select(F.col("id").cast("string").alias("i")).where(~tox.held_out(F.col("i"))).orderBy(F.xxhash64("i", F.lit(17)), "i").limit(8000).collect()]
    assert tox.telling(p, u) == tox.telling(full, [tox.features(texts[int(i)]) for i in others])  # nothing is lost on the way
    assert sum(map(len, p + u)) < sum(map(len, full))


# -- MinHash --------------------------------------------------------------


def shingle_sets(rows, n):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    return sets


def similar(sets, percent):
    where = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    for i, s in sets.items():
        for j, k in collections.Counter(j for g in s for j in where[g] if j < i).items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                yield i, j


def test_minhash_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").select("doc_id", "text").collect()]
    sets = shingle_sets(rows, 3)
    want = smallest(sets, similar(sets, 85))
    got = op10_minhash(spark, SMOKE).collect()
    assert len(got) == len(rows) and len(set(want.values())) < len(want)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), c, c == i) for i, c in want.items()}


def test_near_copies_of_one_text(spark):
    """A large group whose members link only here and there: nothing may be lost to the shortcut over the first."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        w = list(base)
        for k in rng.sample(range(120), rng.randint(0, 9)):
            w[k] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, rows[i][1].upper()) for i in range(40)]
    sets = shingle_sets(rows, 3)
    want = smallest(sets, similar(sets, 85))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for block in (512, 50):
        got = {r.doc_id: r.component_id for r in near_duplicates(df, 3, 85, block=block).collect()}
        assert got == want


def test_minhash_odd_rows(spark):
    long = "word " * 100_000 + "end"
    rows = [(1, None), (2, ""), (3, "A b"), (4, "a B"), (4, "a B"), (5, "a b c"), (None, "a b"), (6, long), (7, long), (8, " \n"), (9, "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("component", F.lit(1)).withColumn("digest", F.lit("d"))
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, 3, 85).collect()]
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False), (4, 1, 3, False), (5, 1, 5, True), (None, 1, None, True), (6, 2, 6, True), (7, 2, 6, False), (8, 0, 8, True), (9, 1, 9, True)]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = drop_near_duplicates(df, 3, 85)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x or 0)) == [1, 2, 3, 5, 6, 8, 9, None]
    assert near_duplicates(df.limit(0)).count() == 0


def test_one_id_on_several_texts(spark):
    """The sets of each text count, not those of an arbitrary one of the id's."""
    text = lambda k: " ".join(f"{k}w{i}" for i in range(60))
    rows = [(1, text(k)) for k in range(8)] + [(10 + k, text(k) + " more") for k in range(8)] + [(20, text(30)), (30, text(31)), (30, text(30)), (40, text(31) + " x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(df, 3, 85).collect()}
    near = {(10 + k, 1, False) for k in range(8)}
    assert got == {(1, 1, True), *near, (20, 20, True), (30, 30, True), (30, 20, False), (40, 30, False)}
    assert sorted(map(tuple, drop_near_duplicates(df, 3, 85).collect())) == sorted([*rows[:8], (20, text(30)), (30, text(31))])


def test_rows_of_a_mixed_bucket_grow_with_its_members(spark, monkeypatch):
    """Thousands of near copies and a few members that link with the first only through others."""
    from funnel_engine.llm import minhash_dedup

    rng = random.Random(8)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*base, f"t{i}"])) for i in range(3000)]
    for i in range(12):  # near some copies of this kind, not near the first
        w = list(base)
        for k in rng.sample(range(100), 3):
            w[k] = f"x{i}{k}"
        rows.append((5000 + i, " ".join([*w, f"u{i}"])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sizes = {}
    real = minhash_dedup._compare_buckets

    def counted(percent):
        inner = real(percent)

        def run(batches):
            def seen():
                for b in batches:
                    total.add(b.num_rows)
                    yield b

            yield from inner(seen())

        return run

    for block in (512, 64):
        total = spark.sparkContext.accumulator(0)
        monkeypatch.setattr(minhash_dedup, "_compare_buckets", counted)
        got = {r.doc_id: r.component_id for r in near_duplicates(df, 3, 85, block=block).collect()}
        sizes[block] = total.value
        assert all(got[i] == 0 for i in range(3000))
    # 25 bands: each member goes to the few blocks of outside members, not to all blocks of its bucket.
    assert sizes[64] < 25 * 2 * 3100, sizes
    some = [r for r in rows if r[0] < 60 or r[0] >= 5000]
    sets = shingle_sets(some, 3)
    want = smallest(sets, similar(sets, 85))
    assert all((got[i] == 0) == (want[i] == 0) for i in sets)


def test_estimate_is_close_to_the_similarity(spark):
    rng = np.random.RandomState(2)
    for share in (0.5, 0.85):
        errors = []
        for _ in range(60):
            both = rng.randint(0, 1 << 62, 1000).astype(np.uint64)
            n = int(1000 * share)
            rest = (1000 - n) // 2
            a, b = np.unique(both[: n + rest]), np.unique(np.concatenate([both[:n], both[n + rest :]]))
            low = packed(np.stack([minima(a), minima(b)]))
            row = spark.createDataFrame([(low[0].tolist(), low[1].tolist())], "a array<bigint>, b array<bigint>")
            if not errors:
                errors.append(row.select(estimate(F.col("a"), F.col("b"))).first()[0] - share)
            x = (low[0] ^ low[1]).view(np.uint64)
            odd = np.uint64(0x5555555555555555)
            differing = int(np.bitwise_count((x | (x >> np.uint64(1))) & odd).sum())
            errors.append((1 - differing / 128 - 0.25) / 0.75 - share)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_bucket_links_compare_across_sides_only():
    shingles = shingler(3)
    sets = [shingles(" ".join(f"w{k}" for k in range(50)) + tail) for tail in ("", " x", " y", " z")]
    least = np.stack([minima(s) for s in sets])
    keys, low = band_keys(least), packed(least)
    shared = next(int(k) for k in keys[0] if all(k in row for row in keys))
    first = int(np.flatnonzero(keys[0] == shared)[0])
    keys[:, :first] = np.arange(4 * first).reshape(4, first)  # no earlier common band
    rows = [(i % 2, i, i, i > 0, keys[i].tolist(), low[i].tolist(), sets[i].view(np.int64)) for i in range(4)]
    links = bucket_links(shared, rows, 85)
    assert links and all(a % 2 != b % 2 for a, b in links)


# -- embeddings -----------------------------------------------------------


def brute_vectors(rows, cosine=0.98):
    """(id, vector, label) with usable vectors."""
    links, count = [], collections.Counter()
    for label in {r[2] for r in rows}:
        own = [r for r in rows if r[2] == label]
        v = np.array([r[1] for r in own], np.float64)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        for i, j in zip(*np.nonzero(np.triu(v @ v.T >= cosine, 1)), strict=True):
            links.append((own[i][0], own[j][0]))
            count[own[i][0]] += 1
            count[own[j][0]] += 1
    return count, smallest([r[0] for r in rows], links)


def cluster(rng, n, dim, noise):
    centre = rng.standard_normal(dim)
    return [centre + noise * rng.standard_normal(dim) for _ in range(n)]


def test_vectors_against_brute_force(spark):
    rng = np.random.RandomState(7)
    vectors = list(rng.standard_normal((300, 48))) + cluster(rng, 60, 48, 0.1) + cluster(rng, 60, 48, 0.15) + cluster(rng, 30, 48, 0.2)
    vectors += vectors[:5]
    rows = [(i, [float(np.float32(x)) for x in v], i % 2) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    count, component = brute_vectors(rows)
    for block in (512, 20):
        got = emb.near_vectors(df, block=block).collect()
        found = sum(r.n_links for r in got) / sum(count.values())
        assert all(r.n_links <= count[r.vec_id] for r in got) and found > 0.99
        assert sum(component[r.vec_id] != r.component_id for r in got) <= 0.01 * len(got)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("largest", [500, 5000, 1_000_000])
def test_recall_at_the_threshold(largest):
    rng = np.random.RandomState(11)
    words, share = emb.sizing(largest)
    x = rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((1500, 64))
    y -= (y * x).sum(1, keepdims=True) * x
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    pairs = zip(emb.listed(x, words, share), emb.listed(y, words, share), strict=True)
    assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in pairs]) > 0.99


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 2), (4, [1.0, 0.0, 0.0], None), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0, 0.0], 1), (8, [None, 1.0, 0.0], 1), (9, [nan, 1.0, 0.0], 1), (10, [inf, 0.0, 0.0], 1), (11, [1.0, 0.0], 1),
        (1, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0, 0.0], 1), (12, [1e300, 0.0, 0.0], 1), (13, [1.0, 0.0, -0.0], 2), (14, [3.0], 3), (15, [5.0], 3),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("v", F.lit(1)).withColumn("key", F.lit(2))
    got = sorted({(r.vec_id, r.n_links, r.component_id, r.kept) for r in emb.near_vectors(df).collect()}, key=lambda r: (r[0] is None, r[0] or 0))
    alone = lambda *ids: {(i, 0, i, True) for i in ids}
    want = alone(4, 5, 6, 7, 8, 9, 10, 11) | {(1, 2, 1, True), (2, 2, 1, False), (12, 2, 1, False), (3, 1, 3, True), (13, 1, 3, False), (14, 1, 14, True), (15, 1, 14, False), (None, 0, None, True)}
    assert set(got) == want
    assert emb.near_vectors(df).count() == len(rows)
    assert emb.near_vectors(df.limit(0)).count() == 0


def test_one_id_on_several_vectors_and_labels(spark):
    x, y = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, x, 1), (2, x, 1), (1, y, 2), (3, y, 2), (4, y, 2), (1, y, 1), (5, [0.0, 1.0, 0.01], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = collections.Counter(tuple(r) for r in emb.near_vectors(df).collect())
    assert got == collections.Counter(
        [(1, 1, 1, True), (2, 1, 1, False), (1, 2, 1, True), (3, 2, 1, False), (4, 2, 1, False), (1, 1, 1, True), (5, 1, 1, False)]
    )


def test_large_tight_group_grows_with_its_members(spark):
    """A core of near copies, a rim around it and strangers: links and components as by brute force, rows in proportion."""
    rng = np.random.RandomState(5)
    centre = rng.standard_normal(32)
    centre /= np.linalg.norm(centre)

    def at(cosine, n):
        d = rng.standard_normal((n, 32))
        d -= (d @ centre)[:, None] * centre
        d /= np.linalg.norm(d, axis=1, keepdims=True)
        return list(cosine * centre + np.sqrt(1 - cosine**2) * d)

    vectors = at(0.9995, 500) + at(0.989, 60) + list(rng.standard_normal((40, 32)))
    rows = [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[i][1], 1) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    count, component = brute_vectors(rows)
    for block in (512, 40):
        got = emb.near_vectors(df, block=block).collect()
        assert all(r.n_links <= count[r.vec_id] for r in got)
        assert sum(r.n_links for r in got) > 0.995 * sum(count.values())
        assert all(component[r.vec_id] == r.component_id for r in got)


# -- repeated strings -----------------------------------------------------


def brute_repeats(rows, length):
    first = {}
    for d, t in rows:
        if d is not None:
            for i in range(len(t) - length + 1):
                w = t[i : i + length]
                first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        mark = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if d is not None and first[t[i : i + length]] < d:
                mark[i] += 1
                mark[i + length] -= 1
        gone = np.cumsum(mark)[: len(t)] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def test_merged_transforms_against_brute_force():
    rng = random.Random(3)
    for _ in range(80):
        length = rng.choice([4, 6, 10])
        segments = list({bytes(rng.choice(b"ab") if rng.random() < 0.9 else 200 for _ in range(rng.randint(length, length + 8))) for _ in range(rng.randint(1, 40))})
        docs = np.array([rng.randint(0, 50) for _ in segments])
        least = {}
        for s, d in zip(segments, docs, strict=True):
            for i in range(len(s) - length + 1):
                least[s[i : i + length]] = min(least.get(s[i : i + length], 10**9), d)
        got = suffix.smallest_documents(segments, docs, length, rng.randint(1, 6))
        for s, g in zip(segments, got, strict=True):
            assert g.tolist() == [least[s[i : i + length]] for i in range(len(s) - length + 1)]


def test_repeats_query_against_brute_force(spark):
    rows = [(r.doc_id, (r.text or "").encode()) for r in table(spark, "documents").select("doc_id", "text").collect()]
    got = [tuple(r) for r in suffix.op6_suffix_dedup(spark, SMOKE).collect()]
    assert sorted(got) == sorted(brute_repeats(rows, 50))
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("hot", [2, 1000])
def test_repeats_on_small_alphabets(spark, hot):
    """Texts full of near repeats; a low ``hot`` sends every shared anchor's windows one by one."""
    rng = random.Random(6)
    passage = "".join(rng.choice("abc") for _ in range(40))
    rows = []
    for i in range(120):
        t = "".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))
        t += passage if i % 3 == 0 else passage[: rng.randint(0, 40)]
        t += "".join(rng.choice("xé") for _ in range(rng.randint(0, 10))) + ("z" * 30 if i % 7 == 0 else "")
        rows.append((i * 5 % 121, t))
    rows += [(rows[0][0], rows[3][1]), (3, "a" * 80), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("bucket", F.lit(9)).withColumn("row", F.lit("r"))
    got = suffix.remove_repeats(df, length=12, k=5, bucket_bytes=1500, hot=hot, merge_bytes=500).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute_repeats([(d, t.encode()) for d, t in rows], 12), key=key)


def test_repeats_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 1000)  # workers import anew; the driver's check below uses small pieces
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh ") for _ in range(700_000))
    rows = [(5, long), (1, long[100_000:100_200] + "!"), (9, "x" + long[300_000:]), (2, None), (3, ""), (4, "short"), (4, "short"), (7, "\x00" * 200), (8, "\x00" * 120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.n_bytes): r for r in suffix.remove_repeats(df).collect()}
    assert got[5, 700_000].n_removed == 200 and got[5, 700_000].n_spans == 1
    assert got[9, 400_001].n_removed == 400_000 and got[1, 201].n_removed == 0
    assert got[8, 120].n_removed == 120 and got[7, 200].n_removed == 0
    assert got[2, 0].kept_sha256 == got[3, 0].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert suffix.remove_repeats(df).count() == len(rows)
    assert suffix.remove_repeats(df.limit(0)).count() == 0
    pieces = [(int(f) + int(o), int(last) + int(o)) for _, _, lo, hi, _, off in suffix.anchors([long[:5000].encode()]) for f, last, o in zip(lo, hi, off, strict=True)]
    windows = [w for a, b in pieces for w in range(a, b + 1)]
    assert windows == list(range(5000 - 50 + 1))  # every window has one anchor, also across pieces


def test_op2_scores_against_a_refit(spark):
    """The query's rows from a fit on plain lists: all confirmed texts, all texts that are not held out, scores summed one by one."""
    docs = {r.doc_id: r.text or "" for r in table(spark, "documents").collect()}
    free = lambda d: zlib.crc32(str(d).encode()) % 3 != 1
    labels = {r.doc_id: r.toxic for r in table(spark, "labels").collect() if free(r.doc_id)}
    share = np.mean([t for t in labels.values() if t in (0, 1)])
    own = lambda ids: [np.array(sorted({f for w in tox.words(docs[i]) for f in tox.word_features(w)}), np.int64) for i in ids]
    model = tox.fit(own([i for i in docs if labels.get(i) == 1]), own([i for i in docs if free(i)]), prior=share)
    got = {r.doc_id: r for r in tox.op2_toxicity(spark, SMOKE).collect()}
    assert set(got) == set(docs)
    for i, t in docs.items():
        logit = model.bias + sum(model.weights.get(int(f), 0.0) for f in tox.features(t))
        assert got[i].score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-6)
        assert (got[i].held_out, got[i].predicted) == (not free(i), int(got[i].score >= 0.7))
    assert len({r.predicted for r in got.values()}) == 2


def test_prior_is_the_share_of_toxic_labels(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(tox, "fit", lambda p, u, prior: seen.append(prior) or tox.Model({}, 0.0))
    rows = [(i, f"text {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    free = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    for toxic in (0.75, 0.004):
        n = round(toxic * len(free))
        labels = spark.createDataFrame([(d, int(k < n)) for k, d in enumerate(free)], "doc_id bigint, toxic int")
        tox.train(docs, labels)
        assert seen[-1] == pytest.approx(n / len(free))


# -- pipeline -------------------------------------------------------------


def test_pipeline_stage_by_stage(spark):
    import sentencepiece

    from funnel_engine.llm.common import stored
    from funnel_engine.llm.secret_scan import all_spans, infer_formats, labelled_values, masked
    from funnel_engine.llm.sentencepiece_codec import model_path

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "secrets", "mix", "encode"]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = table(spark, "documents")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(stored(stage(spark, steps[-1], SMOKE), f"test-{name}"))
        if name != "encode":
            assert steps[-1].columns == columns and steps[-1].dtypes == docs.dtypes
    rows = [[(r.doc_id, r.text) for r in s.collect()] for s in steps[:5]]
    score = tox.scorer(tox.train(docs, table(spark, "labels")))
    assert sorted(rows[1]) == sorted(r for r in rows[0] if score(r[1]) < tox.THRESHOLD)
    sets = shingle_sets(rows[1], 5)
    component = smallest(sets, similar(sets, 80))
    assert sorted(rows[2]) == sorted(r for r in rows[1] if component[r[0]] == r[0])
    formats = infer_formats(labelled_values(steps[2]))
    assert sorted(rows[3]) == sorted((i, masked(t, all_spans(t, formats), "[SECRET]")) for i, t in rows[2])
    assert all(r.n_chars == len(r.text) for r in steps[3].collect())
    assert set(rows[4]) <= set(rows[3]) and len(rows[4]) > 0.5 * len(rows[3])
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path())
    want = sorted((i, hashlib.sha256(",".join(map(str, sp.encode(t))).encode()).hexdigest()) for i, t in rows[4])
    assert sorted((r.doc_id, r.ids_sha256) for r in steps[5].collect()) == want


def test_pipeline_on_odd_and_empty_tables(spark, scratch_dir):
    rows = [(1, None, None, None, None), (2, "", "en", "src1", 0), (3, "a b c", "en", "src1", 5), (3, "a b c", "en", "src1", 5), (4, "token=abcdef0123456789 z", None, "src2", 24)]
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{scratch_dir}/labels.parquet")
    rows += [(5, "word " * 100_000 + "end", "en", "src3", 500_003), (3, "another text under one id", "en", "src1", 25)]
    clashing = ["component", "_text", "_gone", "row", "text_digest", "_doc", "_leaf", "_tokens", "positive", "score"]
    spark.createDataFrame(rows, DOCS).select("*", *[F.lit(1).alias(c) for c in clashing]).write.parquet(f"{scratch_dir}/documents.parquet")
    got = corpus_pipeline.run(spark, scratch_dir).collect()
    assert {r.doc_id for r in got} <= {3, 4, 5}
    empty = f"{scratch_dir}/empty"
    labels.limit(0).write.parquet(f"{empty}/labels.parquet")
    spark.createDataFrame([], DOCS).write.parquet(f"{empty}/documents.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
