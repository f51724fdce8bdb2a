"""Operators against brute force on small tables with nulls, empty texts, ties, repeats and extra columns."""

import itertools
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from waymeld.llm import components, decontaminate, deleted_interpolation, exact_dedup, jaccard_join, language_id, passage_chains, preference_chat, quality_cnn, queries, source_mix, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, key long, n long"


def words(n, seed):
    g = random.Random(seed)
    return " ".join(f"{g.choice('abcdefgh')}{g.randrange(400)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base = [words(60, i) for i in range(12)]
    near = [t.replace(t.split()[30], "Changed", 1) for t in base[:5]]
    texts = [*base, *near, *base[:3], None, "", "  \t", "one", "One", "two words", "x " * 300, base[0].upper(), words(30, 99) + " " + base[7] + " " + words(30, 98)]
    return [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None)[i % 3], 1, 2) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_exact_dedup(spark, docs, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    for hot in (32, 2):  # with and without a broadcast group
        got = by_id(exact_dedup.exact_dedup(docs, min_hot=hot))
        assert len(got) == len(rows)
        for ids in groups.values():
            assert all((got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (max(ids), len(ids), i == max(ids)) for i in ids)
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0
    assert exact_dedup.kept_documents(docs).columns == docs.columns


def test_kept_documents_of_repeated_and_null_ids(spark):
    rows = [(1, "copy"), (2, "copy"), (1, "alone"), (None, "copy"), (None, "none has an id"), (3, None), (4, "")]
    got = exact_dedup.kept_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == {(2, "copy"), (1, "alone"), (None, "none has an id"), (4, "")} and len(got) == 4


def test_subset_sum_and_plan():
    g = random.Random(1)
    for _ in range(60):
        sizes = np.array(sorted(g.sample(range(1, 30), 4)))
        counts = np.array([g.randrange(4) for _ in sizes])
        budget = g.randrange(0, 80)
        best = max(s for c in itertools.product(*[range(n + 1) for n in counts]) if (s := int(sum(a * b for a, b in zip(c, sizes)))) <= budget)
        took = source_mix.subset_sum(sizes, counts, budget)
        assert (took <= counts).all() and int((took * sizes).sum()) == best


def test_source_mix(spark, docs, rows):
    got = by_id(source_mix.source_mix(docs))
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    assert {i: r["size"] for i, r in got.items()} == size
    total = defaultdict(int)
    for r in rows:
        total[r[3]] += size[r[0]]
    goal, left, names = {}, 1.5 * sum(total.values()), sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    while names:
        share = {s: left * weight[s] / sum(weight[x] for x in names) for s in names}
        over = [s for s in names if share[s] > 2 * total[s]]
        goal |= {s: 2.0 * total[s] for s in over} if over else share
        left -= sum(2 * total[s] for s in over)
        names = [s for s in names if s not in over] if over else []
    taken = defaultdict(int)
    for r in rows:
        assert math.isclose(got[r[0]]["target"], goal[r[3]], rel_tol=1e-9)
        assert got[r[0]]["taken"] <= 2 * size[r[0]]
        taken[r[3]] += got[r[0]]["taken"]
    assert all(abs(taken[s] - goal[s]) <= max(size[r[0]] for r in rows if r[3] == s) for s in total)
    assert {i: r["taken"] for i, r in by_id(source_mix.source_mix(docs.repartition(3))).items()} == {i: r["taken"] for i, r in got.items()}
    assert source_mix.source_mix(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("shingle", "percent", "block"), [(3, 90, 512), (5, 80, 2)])
def test_jaccard_groups(spark, docs, rows, shingle, percent, block):
    sets = {r[0]: jaccard_join.shingle_set(r[1], shingle) for r in rows}
    root = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root[a], root[b]))
            root = {i: x if r == y else r for i, r in root.items()}
    got = by_id(jaccard_join.jaccard_groups(docs, shingle, percent, block))
    assert {i: r["component_id"] for i, r in got.items()} == root
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert jaccard_join.jaccard_groups(docs.limit(0)).count() == 0


def test_one_of_each_group_of_repeated_and_null_ids(spark):
    base, other = words(80, 20), words(80, 21)
    near = base.replace(base.split()[0], "changed", 1)
    rows = [(1, base), (2, near), (2, other), (None, near + " end"), (None, words(80, 22)), (3, None)]
    got = jaccard_join.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == {rows[0], rows[2], rows[4], rows[5]} and len(got) == 4


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_leaks(spark):
    item = "the train leaves at 9 and arrives after 40 km near Bristol while the slow bus goes on for two more hours today"
    other = item.replace("9", "11").replace("40", "75").replace("Bristol", "Leeds")
    texts = [words(40, 1) + " " + item + " " + words(40, 2), "So " + other + " end", words(90, 3), None, "", item.upper()]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(5, item), (6, None), (7, "too short")], "item_id long, text string")
    for most in (1000, 0):
        got = by_id(decontaminate.leaks(docs, items, max_broadcast=most))
        assert {0, 1} <= set(got) <= {0, 1, 5} and got[1]["changed"] == 3 and got[0]["changed"] == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0 and decontaminate.leaks(docs.limit(0), items).count() == 0
    assert [r["doc_id"] for r in decontaminate.clean_documents(docs, items).orderBy("doc_id").collect()][:1] == [2]


def test_leaks_judges_each_occurrence(spark):
    item = "the train leaves at 5 and the slow bus leaves town after 9 on every other working day of spring"
    boxes = "a shop sells 6 boxes and some 6 apples each morning while other people queue outside with bags"
    pears = boxes.replace("6", "5", 1).replace("6", "9").replace("apples", "pears").replace("shop", "stall")
    texts = [f"{item} so {item.replace('9', '14')}", f"{item.replace('5', '3')} or {item.replace('9', '14')}", boxes.replace("6", "4", 1).replace("6", "7"), pears.replace("5", "8").replace("9", "8"), words(60, 4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, boxes), (3, pears)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(docs, items).collect()}
    assert {(0, 1), (1, 1), (2, 2), (3, 3)} <= set(got) and 4 not in {d for d, _ in got}
    assert [got[k]["changed"] for k in ((0, 1), (1, 1), (2, 2), (3, 3))] == [0, 1, 2, 2]


def test_leaks_in_any_case(spark):
    item = "on market days, traders, carters, brewers and two smiths, carry 40 kg, then 5kg of iron, salt, wool over the hill"
    texts = [item.upper(), item.title().replace(" ", "  "), words(60, 5).upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(decontaminate.leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")))
    assert set(got) == {0, 1} and all(r["changed"] == 0 and r["windows_hit"] == r["n_windows"] for r in got.values())


def test_leaks_of_few_literal_words(spark):
    item = "Sort the numbers 12 45 78 23 56 90 11 34 67 88 from least to greatest"
    texts = ["first " + item + " now", item.replace("45", "46").replace("90", "91").replace("34", "35"), words(60, 6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(decontaminate.leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")))
    assert set(got) == {0} and got[0]["windows_hit"] == got[0]["n_windows"]


def test_preferences(spark):
    turns = [(1, s, k, r, t) for s, more in ((0, "yes"), (1, "no")) for k, r, t in ((0, "user", "hi <|x"), (1, "assistant", None), (2, "user", "q"), (3, "assistant", more))]
    turns += [(2, 0, 0, None, "alone"), (3, 0, 0, "user", "a"), (3, 1, 0, "user", "a")]
    got = {r["pair_id"]: r for r in preference_chat.preference_pairs(spark.createDataFrame(turns, "pair_id long, side int, turn long, role string, text string")).collect()}
    one = got[1]
    assert (one["shared_turns"], one["status"], got[2]["status"], got[3]["status"]) == (3, "pair", "single", "same")
    assert one["prompt"] == "<|user|>\nhi < |x<|end|>\n<|assistant|>\n<|end|>\n<|user|>\nq<|end|>\n"
    start, end = map(int, one["chosen_mask"].split(":"))
    assert one["chosen"][start:end] == "yes<|end|>\n" and got[3]["chosen"] == ""


def test_deleted_interpolation(spark, docs, rows):
    from pyspark.sql import functions as F

    tokens = {r[0]: [*(r[1] or "").encode().lower().split(), None] for r in rows}
    train = [i for i in tokens if zlib.crc32(str(i).encode()) % 5 != 1]
    count = Counter(w for i in train for w in tokens[i])
    n, v = sum(count.values()), len(count)
    got = by_id(deleted_interpolation.lm_scores(docs.withColumn("train", F.col("doc_id").isin(train))))
    for i, t in tokens.items():
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(t), sum(count[w] > 0 for w in t), n)
        assert math.isclose(got[i]["base_score"], sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), rel_tol=1e-9)
    # The mixture by its definition: weights from deleted counts, learned on the same histogram cells.
    d = deleted_interpolation
    pairs = Counter((a, b) for i in train for a, b in zip(["start", *tokens[i]], tokens[i]))
    starts, one = len(train), lambda c: len(train) if c == "start" else count[c]
    cells = defaultdict(lambda: [0, 0.0, 0.0])
    step = lambda x: min(int(-math.log2(x) * d.STEPS) + 1, d.OCTAVES * d.STEPS) if x > 0 else 0
    bucket = lambda c: min(math.frexp(c)[1] if c > 0 else 0, d.CONTEXTS - 1)
    for i in train:
        for a, b in zip(["start", *tokens[i]], tokens[i]):
            c = (starts if a == "start" else count[a]) - 1
            p2, p1 = ((pairs[a, b] - 1) / c if c > 0 else 0.0), (count[b] - 1) / (n - 1)
            cell = cells[(bucket(c) * (d.OCTAVES * d.STEPS + 1) + step(p2)) * (d.OCTAVES * d.STEPS + 1) + step(p1)]
            cell[0], cell[1], cell[2] = cell[0] + 1, cell[1] + p2, cell[2] + p1
    w = d.mixture([(k, *x) for k, x in sorted(cells.items())], v)
    for i, t in tokens.items():
        p = [w[bucket(one(a))] @ [pairs[a, b] / one(a) if one(a) else 0.0, count[b] / n, 1 / (v + 1)] for a, b in zip(["start", *t], t)]
        assert math.isclose(got[i]["score"], sum(map(math.log10, p)), rel_tol=1e-9)
    assert deleted_interpolation.lm_scores(docs.limit(0).withColumn("train", F.lit(True))).count() == 0


def test_lattice_sums_all_segmentations():
    vocabulary = [b"a", b"b", b" ", b"ab", b" a", b"ba", b"aba"]
    lattice = language_id.Lattice(*language_id.trie(vocabulary), 3)
    p = np.linspace(0.05, 0.2, len(vocabulary))[:, None]

    def total(w):
        return 1.0 if not w else sum(p[i, 0] * total(w[len(x):]) for i, x in enumerate(vocabulary) if w.startswith(x))

    for w in (b" aba", b" abab", b" bbaabababababababababab"):
        got = lattice.forward(np.frombuffer(w, np.uint8)[None], p)[0, 0]
        assert math.isclose(got, math.log(total(w)), rel_tol=1e-9)
        assert math.isclose(lattice.forward_long(np.frombuffer(w, np.uint8), p)[0], got, rel_tol=1e-9)


def test_language_of_a_word_without_end(spark):
    train = spark.createDataFrame([(i, ("abcde" if i % 2 else "vwxyz") * 9 + " " + "q" * 300, "en" if i % 2 else "fr") for i in range(20)], "doc_id long, text string, lang string")
    began = time.time()
    got = by_id(language_id.predict(spark.createDataFrame([(1, "abcde" * 40_000), (2, "vwxyz" * 100), (3, "9" * 50_000)], "doc_id long, text string"), language_id.fit(train)))
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["en", "fr", "und"] and time.time() - began < 60


def test_language(spark):
    make = lambda letters, i: " ".join("".join(random.Random(i * 50 + k).choices(letters, k=5)) for k in range(30))
    train = spark.createDataFrame([(i, make("abcde" if i % 2 else "vwxyz", i), "en" if i % 2 else "fr") for i in range(60)], "doc_id long, text string, lang string")
    model = language_id.fit(train)
    asked = [(1, make("abcde", 900)), (2, make("vwxyz", 901)), (3, None), (4, "12 34 !"), (5, ""), (6, "é")]
    got = by_id(language_id.predict(spark.createDataFrame(asked, "doc_id long, text string"), model))
    assert [got[i]["lang_pred"] for i in range(1, 6)] == ["en", "fr", "und", "und", "und"] and got[6]["lang_pred"] != "und"
    assert language_id.predict(train, language_id.fit(train.limit(0))).first()["lang_pred"] == "und"


def test_toxicity(spark):
    texts = [(i, words(40, i) + (" you idiot zorgblat" if i % 4 == 0 else "") + " " + words(40, i + 500), int(i % 4 == 0)) for i in range(160)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in texts if i < 120] + [(5, None)], "doc_id long, toxic int")
    got = by_id(toxicity.score(docs, toxicity.fit(docs, labels)))
    assert all(got[i]["predicted"] == y for i, _, y in texts) and got[900]["score"] == got[901]["score"] < 0.3
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).count() == len(texts) + 2


def test_quality_gradients_and_chunks():
    net, g = quality_cnn.Network(1), np.random.default_rng(0)
    data = g.integers(97, 123, 700).astype(np.uint8)
    x, row = quality_cnn.chunks(data, np.array([0, 0, 500, 700]))
    assert row.tolist() == [0, 1, 1, 1, 2] and (x[1][:256] == data[:256]).all() and (x[2][:64] == data[192:256]).all() and not x[0].any()
    y = np.array([0, 1, 0], dtype=np.float32)
    loss = lambda: float(np.mean(np.log1p(np.exp(z := net.forward(x, row, 3)[0])) - y * z))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    grads = net.gradients(x, row, y)
    for name in ("o", "h", "a", "e"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        net.p[name][at] += 1e-5
        up = loss()
        net.p[name][at] -= 2e-5
        assert math.isclose((up - loss()) / 2e-5, grads[name][at], rel_tol=0.02)
        net.p[name][at] += 1e-5


def test_passages(spark, docs, rows):
    shared = [words(60, 7000 + i) for i in range(2)]
    texts = [words(80, 100 + i) + " " + shared[i % 2] + " " + words(50, 300 + i) for i in range(6)] + [words(200, 77), None, ""]
    fuzzy = texts[0].split()
    fuzzy[100] = "edited"
    texts.append(" ".join(fuzzy))
    got = passage_chains.fuzzy_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got} | {r["partner_id"] for r in got} == {0, 1, 2, 3, 4, 5, 9}
    for r in got:
        a, b = texts[r["doc_id"]].split()[r["start_word"] : r["end_word"]], texts[r["partner_id"]].split()[r["partner_start"] : r["partner_end"]]
        assert (a == b) == (r["identity"] == 1.0) and len(a) >= 60
    assert passage_chains.fuzzy_passages(docs.limit(0)).count() == 0


def test_passages_go_on_after_a_larger_difference(spark):
    copy, shared, line = words(400, 50).split(), words(200, 51), words(20, 52)
    texts = [" ".join(copy), " ".join(copy[:200] + words(12, 53).split() + copy[200:])]
    texts += [f"{words(30, 60 + i)} {line} {words(12, 70 + i)} {shared} {words(30, 80 + i)}" for i in range(2)]
    got = passage_chains.fuzzy_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    spans = {(r["doc_id"], r["start_word"], r["end_word"], r["partner_start"], r["partner_end"], r["equal_words"]) for r in got}
    assert spans == {(1, 0, 200, 0, 200, 200), (1, 212, 412, 200, 400, 200), (3, 62, 262, 62, 262, 200)}


def test_passages_of_common_lines(spark):
    lines, g = [words(22, 4000 + i) for i in range(40)], random.Random(9)
    common = [" ".join(g.choice(lines) + " " + words(8, 10_000 + 40 * i + k) for k in range(8)) for i in range(120)]
    shared = [" ".join(g.sample(lines, 3)) for _ in range(6)]
    held = [[f"{words(30, 90_000 + 2 * k + i)} {x} {words(30, 95_000 + 2 * k + i)}" for k, x in enumerate(shared)] for i in range(2)]
    texts = [*common[:60], *held[0], *common[60:], *held[1]]  # between the two that share a passage, others have each of its lines
    got = passage_chains.fuzzy_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {(r["doc_id"], r["partner_id"]) for r in got if r["start_word"] <= 30 and r["end_word"] >= 96}
    assert {(126 + k, 60 + k) for k in range(6)} <= found


def test_best_chain():
    pos, ppos = np.arange(0, 100, 10), np.array([5, 15, 400, 25, 35, 45, 3, 55, 65, 75])
    assert passage_chains.chains(pos, ppos)[0] == (0, 96, 5, 81)


def test_pipeline_near_duplicates(spark):
    import corpus_pipeline

    base = words(120, 31).split()
    near = [*base[:40], "new", "pair", *base[42:80], "other", "two", *base[82:]]
    alike = [len(x & y) / len(x | y) for x, y in ([jaccard_join.shingle_set(" ".join(w), k) for w in (base, near)] for k in (3, 5))]
    assert alike[0] < 0.9 and alike[1] >= 0.8
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near)), (3, words(120, 32))], "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()} == {1, 3}


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").filter("toxic = 1").collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, sf).collect(), docs.schema)
        assert kept.columns == docs.columns, name
    ids = {r["doc_id"] for r in kept.collect()}
    assert len({text[i] for i in ids}) == len(ids)
    sets = {i: jaccard_join.shingle_set(text[i]) for i in ids}
    assert not [1 for a, b in itertools.combinations(ids, 2) if 100 * len(sets[a] & sets[b]) >= 90 * max(1, len(sets[a] | sets[b]))]
    assert not [i for i in ids if any(x in " ".join(text[i].lower().split()) for x in items)]
    assert len(ids & toxic) < len(toxic)
    mix = corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()
    assert {r["doc_id"] for r in mix} == ids and all(r["taken"] <= 2 * r["size"] for r in mix)


def test_mixture_finds_the_weights():
    d = deleted_interpolation
    # Tokens drawn by bigram, unigram or uniform with known shares, each estimate certain of its own tokens.
    cells = [((5 * (d.OCTAVES * d.STEPS + 1) + k) * (d.OCTAVES * d.STEPS + 1), n, s2, s1) for k, (n, s2, s1) in enumerate([(7000, 7000 * 0.5, 0.0), (2500, 0.0, 2500 * 0.5), (500, 0.0, 0.0)])]
    got = d.mixture(cells, 1_000_000, 400)[5]
    assert np.abs(got - [0.7, 0.25, 0.05]).max() < 0.01


def test_odd_sketch_never_says_too_much():
    g = np.random.default_rng(4)
    for _ in range(60):
        n, edits = int(g.integers(1, 900)), int(g.integers(0, 40))
        a = np.unique(g.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[min(edits, len(a) - 1) :], g.integers(0, 1 << 62, edits).astype(np.uint64)]))
        x, y = jaccard_join.odd_sketch(a).tobytes(), jaccard_join.odd_sketch(b).tobytes()
        longs = min(len(x), len(y)) // 8
        differ = int(np.bitwise_count(jaccard_join.folded([x], longs) ^ jaccard_join.folded([y], longs)).sum())
        assert differ <= len(np.setxor1d(a, b))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert jaccard_join.may_link(differ, len(a) + len(b), 80)


def test_groups_whose_centre_links_with_none(spark):
    # A bucket of sets around several centres: only the comparison of open buckets can find these links.
    texts = [f"{words(120, 5)} {words(5, k // 3)} {words(2, 900 + k)}" for k in range(24)]
    rows = [(0, words(120, 5) + " " + words(30, 77)), *enumerate(texts, 1), (99, None)]
    for block in (512, 4):
        got = by_id(jaccard_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, block))
        sets = {i: jaccard_join.shingle_set(t) for i, t in rows}
        root = {i: i for i in sets}
        for _ in sets:
            for i, j in itertools.combinations(sets, 2):
                both = len(sets[i] & sets[j])
                if both and 100 * both >= 90 * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
        assert {i: got[i]["component_id"] for i in sets} == root


def test_label_model_without_labels():
    g = np.random.default_rng(3)
    y = (g.random(4000) < 0.2).astype(int)
    rates = g.uniform(0.5, 0.9, 8)
    fires = (g.random((4000, 8)) < np.where(y[:, None] == 1, rates, 0.03)).astype(float)
    fires = np.hstack([fires, np.repeat(fires[:, :1], 6, axis=1)])  # seven voters that say the same
    post, weight = toxicity.label_model(fires, np.full(4000, -1))
    assert ((post > 0.5) == (y == 1)).mean() > 0.97 and weight[8:].max() < 0.2 and weight[1:8].min() > 0.5
    swapped, _ = toxicity.label_model(fires, np.where(np.arange(4000) < 500, y, -1))
    assert ((swapped > 0.5) == (y == 1)).mean() > 0.97


def test_quality(spark):
    good = lambda k: " ".join(random.Random(k).choices(["river", "meadow", "the", "of", "village", "stone"], k=60)) + "."
    bad = lambda k: " ".join(random.Random(k).choices(["$$$", "CLICK", "!!!", "win9", "www"], k=60))
    texts = [(i, good(i) if i % 2 else bad(i), 7, i % 2) for i in range(120)]
    docs = spark.createDataFrame([(i, t, k, "x") for i, t, k, _ in texts] + [(500, None, 1, None), (501, "", 1, "y"), (502, good(9) * 400, 1, "y"), (3, texts[3][1], 7, "x")], "doc_id long, text string, y long, score string")
    labels = spark.createDataFrame([(i, q) for i, _, _, q in texts if i < 90] + [(1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    got = quality_cnn.score(docs, quality_cnn.fit(docs, labels))
    assert got.columns == ["doc_id", "score", "predicted"] and got.count() == 124
    got = by_id(got)
    assert all(got[i]["predicted"] == q for i, _, _, q in texts) and got[502]["predicted"] == 1 and got[500]["score"] == got[501]["score"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    one = quality_cnn.fit(docs, labels.filter("quality = 1"))
    assert len({r["score"] for r in quality_cnn.score(docs, one).collect()}) == 1
    assert quality_cnn.score(docs.limit(0), quality_cnn.fit(docs.limit(0), labels.limit(0))).count() == 0


def test_swapped_replies(spark):
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "assistant", "c"), (2, 1, "assistant", "d"), (3, None, None, None), (None, 0, "user", "x")]
    table = spark.createDataFrame([(*t, 5) for t in turns], "conv_id long, turn long, role string, text string, pair_id long")
    got = {r["pair_id"]: r for r in preference_chat.preference_pairs(preference_chat.swapped_replies(table)).collect()}
    assert sorted(got) == [1, 2, 3] and [got[k]["status"] for k in (1, 2, 3)] == ["pair", "pair", "same"]
    assert got[1]["prompt"] == "<|user|>\na<|end|>\n" and got[1]["rejected"] == "<|assistant|>\nd<|end|>\n"
    assert preference_chat.preference_pairs(preference_chat.swapped_replies(table.limit(0))).count() == 0


CONTRACTS = {
    "op2_source_mix": ("doc_id size:bigint source_size:bigint target:double taken:bigint", None),
    "op3_toxicity": ("doc_id held_out:boolean score:double predicted:int", (4, 2)),
    "op4_jaccard_groups": ("doc_id n_shingles:bigint component_id:bigint", None),
    "op5_deleted_interpolation": ("doc_id held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double", (5, 1)),
    "op6_exact_dedup": ("doc_id keep_id:bigint group_size:bigint kept:boolean text_sha256:string", None),
    "op9_quality_cnn": ("doc_id held_out:boolean score:double predicted:int", (3, 1)),
    "op10_language": ("doc_id held_out:boolean lang_pred:string score:double", (3, 1)),
}


@pytest.mark.parametrize("name", CONTRACTS)
def test_contract(spark, tmp_path, name):
    """The registered query over a table with nulls, empty, very long and repeated texts, ties and clashing columns."""
    columns, held = CONTRACTS[name]
    texts = [(i, words(20 + i % 30, i % 37), ("en", "fr")[i % 2], ("a", "b", None)[i % 3]) for i in range(150)]
    texts += [(200, None, None, None), (201, "", "en", "a"), (202, " \t", "en", "b"), (203, words(30_000, 7), "fr", "a"), (204, "x", None, "c")]
    spark.createDataFrame([(*t, 0.5, True) for t in texts], "doc_id long, text string, lang string, source string, score double, held_out boolean").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(100)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = queries.QUERIES[name](spark, str(tmp_path))
    types = dict(found.dtypes)
    for c in columns.split()[1:]:
        column, kind = c.split(":")
        assert types[column] == kind
    got = by_id(found)
    assert len(got) == len(texts) == found.count()
    if held:
        assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % held[0] == held[1]) for i, r in got.items())
    if "predicted" in types:
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= (0.3 if name.startswith("op3") else 0.5)) for r in got.values())


def test_tokens_and_targets_of_every_source(spark, docs, rows):
    got = by_id(source_mix.source_mix(docs))
    size = lambda t: len((t or "").encode().split())
    for i, t, _, source, *_ in rows:
        assert got[i]["size"] == size(t) and got[i]["taken"] <= 2 * got[i]["size"]
        assert got[i]["source_size"] == sum(size(r[1]) for r in rows if r[3] == source)
