"""Decontamination, the pipeline's stages and passages against plain Python that shares nothing with them."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import regex

from waymeld.llm import decontaminate, jaccard_join, passage_chains, preference_chat, quality_cnn

UNITS = set("km m cm mm kg g mg lb oz l ml s ms min h hr hour hours minute minutes second seconds day days week weeks month months year years mile miles feet ft inches dollar dollars euro euros cent cents percent".split())


def tokens(text):
    return regex.findall(r"[^\x20\x09-\x0D]+", (text or "").replace("\x01", ""))


def forms(text):
    """Words with names as slots, without, and as they stand: (slot kind or '', word)."""
    words = tokens(text)
    kinds = []
    for i, w in enumerate(words):
        low = w.lower()
        if low.rstrip(")].,;:!?") in UNITS or low in UNITS:
            kinds.append("u")
        elif regex.fullmatch(r"[(\[$€£+\-]{0,3}\d[\d.,:/]*(?:%|st|nd|rd|th|[km]?[gmls])?[)\].,;:!?]*", low):
            kinds.append("n")
        elif i and regex.fullmatch(r"\p{Lu}[\p{L}'’\-]*[)\].,;:!?]*", w) and regex.search(r"[\p{Ll}\p{N},;]$", words[i - 1]):
            kinds.append("p")
        else:
            kinds.append("")
    low = [w.lower() for w in words]
    tpl = lambda names: tuple(("", x) if k == "" or (k == "p" and not names) else (k, "") for x, k in zip(low, kinds))
    return tpl(True), tpl(False), tuple(("", x) for x in low), low


def leak(doc, item, window=8, literals=4, enough=6, part=0.5):
    """Whether a text leaks an item, by all windows held against all windows."""
    named, bare, raw, low = forms(doc)
    inamed, ibare, iraw, ilow = forms(item)
    if len(ilow) < literals:
        return False
    w = min(window, len(ilow))
    hits = []
    for ipos in range(len(ilow) - w + 1):
        known = {}
        for form, named_form in ((inamed, True), (ibare, False)):
            piece = form[ipos : ipos + w]
            poor = sum(k == "" for k, _ in piece) < literals
            if poor and not named_form:
                known[iraw[ipos : ipos + w]] = ()
            elif not poor:
                known[piece] = tuple((k, ilow[ipos + k]) for k in range(w) if piece[k][0])
        for pos in range(len(low) - w + 1):
            for form in (named, bare, raw):
                if form[pos : pos + w] in known:
                    if form is raw and sum(k == "" for k, _ in bare[pos : pos + w]) >= literals and raw[pos : pos + w] not in (named[pos : pos + w], bare[pos : pos + w]):
                        continue
                    hits.append((pos - ipos, ipos, tuple((ipos + k, v, low[pos + k]) for k, v in known[form[pos : pos + w]])))
    need = min(enough, int(np.ceil((len(ilow) - w + 1) * part)))
    for kind, spot in ((0, lambda s: s), (1, lambda s: s // 16), (2, lambda s: (s + 8) // 16), (3, lambda s: 0)):
        groups = {}
        for shift, ipos, values in hits:
            g = groups.setdefault(spot(shift), (set(), set()))
            g[0].add(ipos)
            g[1].update(values)
        for at, values in groups.values():
            if len(at) >= need and (kind == 0 or len({a for a, *_ in values}) == len(values)):
                return True
    return False


def sentence(g, n):
    pool = ["the", "river", "town", "sells", "boxes", "near", "Bristol", "London", "7", "12.5", "km", "hours", "$30", "walks", "green", "apples", "before", "Friday", "counts", "of", "and"]
    return [g.choice(pool) for _ in range(n)]


@pytest.fixture(scope="module")
def leaky():
    g = random.Random(8)
    items = [(k, " ".join(sentence(g, g.choice((5, 9, 14, 25))))) for k in range(12)]
    docs = []
    for i in range(60):
        body = sentence(g, g.randrange(0, 40))
        if i % 3:
            copy = items[i % 12][1].split()
            for _ in range(i % 4):
                k = g.randrange(len(copy))
                copy[k] = g.choice(["9", "Leeds", "miles", "slowly"])
            if i % 5 == 0:
                copy.insert(len(copy) // 2, "indeed")
            body[len(body) // 2 : len(body) // 2] = copy
        text = " ".join(body)
        docs.append((i, text.upper() if i % 10 == 1 else text))
    return [*docs, (70, None), (71, ""), (None, items[0][1])], items


def test_leaks_by_brute_force(spark, leaky):
    docs, items = leaky
    want = {(i, k) for i, t in docs for k, x in items if i is not None and leak(t, x)}
    table = spark.createDataFrame([(*d, 3, "n", 1) for d in docs], "doc_id long, text string, item_id int, h string, g long")
    for most in (200_000, 0):
        got = decontaminate.leaks(table, spark.createDataFrame(items, "item_id long, text string"), max_broadcast=most)
        assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want and got.count() == len(want) > 10


def test_stages_by_brute_force(spark, leaky, tmp_path):
    """Exact dedup, near duplicates and decontamination one after the other, rows and columns as the rules say."""
    import corpus_pipeline

    g, (leaks, items) = random.Random(3), leaky
    base = [" ".join(f"w{g.randrange(300)}" for _ in range(g.choice((3, 40, 90)))) for _ in range(25)]
    texts = [t for _, t in leaks[:30]] + base + base[:6] + [" ".join([*t.split()[:-2], "x"]) for t in base[:15]] + [None, "", "", " "]
    rows = [(i, t, "en", "ab"[i % 2], 9) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, schema)

    kept = {}
    for r in rows:
        kept[r[1] or ""] = max(kept.get(r[1] or "", r), r)
    one = sorted(kept.values())
    assert sorted(map(tuple, corpus_pipeline.one_of_each_text(spark, docs, "").collect())) == one

    sets = {r[0]: jaccard_join.shingle_set(r[1], 5) for r in one}
    root = {i: i for i in sets}
    for _ in sets:
        for i, j in itertools.combinations(sets, 2):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[i] = root[j] = min(root[i], root[j])
    two = [r for r in one if root[r[0]] == r[0]]
    assert sorted(map(tuple, corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(one, schema), "").collect())) == two and len(two) < len(one)

    three = [r for r in two if not any(leak(r[1], x) for _, x in items)]
    assert sorted(map(tuple, corpus_pipeline.without_leaks(spark, spark.createDataFrame(two, schema), str(tmp_path)).collect())) == three and len(three) < len(two)


def test_passages_hold_what_they_say(spark):
    """Every passage's equal words are there, and every planted run of 50 words or more is met, also in rows with clashing names."""
    g = random.Random(6)
    fresh = lambda n: [f"v{g.randrange(4000)}" for _ in range(n)]
    shared = [fresh(g.randrange(50, 90)) for _ in range(20)]
    docs = [(i, fresh(g.randrange(0, 60)) + shared[i % 20] + fresh(g.randrange(0, 60))) for i in range(60)]
    table = spark.createDataFrame([(i, " ".join(t), 1, 2, "x") for i, t in docs] + [(90, None, 1, 1, ""), (91, "", 1, 1, ""), (92, "a b", 1, 1, "")], "doc_id long, text string, pos int, seed long, w string")
    got = passage_chains.fuzzy_passages(table).collect()
    text = dict(docs)
    for r in got:
        a, b = text[r["doc_id"]][r["start_word"] : r["end_word"]], text[r["partner_id"]][r["partner_start"] : r["partner_end"]]
        row = [0] * (len(b) + 1)
        for x in a:  # longest common subsequence
            last = 0
            for j, y in enumerate(b):
                row[j + 1], last = max(row[j + 1], row[j], last + 1 if x == y else 0), row[j + 1]
        assert min(len(a), len(b)) >= 40 and r["equal_words"] <= row[-1] <= r["equal_words"] + 8
    found = {r["doc_id"] for r in got} | {r["partner_id"] for r in got}
    assert found >= {i for i, _ in docs} and not found & {90, 91, 92}
    assert passage_chains.fuzzy_passages(table.limit(0)).count() == 0


def test_no_pair_of_texts_with_a_shared_passage_is_left_out(spark):
    """in groups of many texts every pair with 50 equal words shares a class, and every pair that aligns has a row, a class or a partner in common."""
    g = random.Random(10)
    fresh = lambda n: [f"v{g.randrange(4000)}" for _ in range(n)]
    edited = lambda t, rare: [f"e{g.randrange(4000)}" if g.random() < 1 / rare else x for x in t]
    long, short, line = fresh(140), fresh(60), fresh(20)
    docs = [(i, fresh(g.randrange(30)) + edited(long, 70) + fresh(g.randrange(30))) for i in range(36)]
    docs += [(100 + i, fresh(30) + short + fresh(30)) for i in range(7)] + [(200 + i, fresh(40) + line + fresh(40)) for i in range(15)]
    docs += [(300, fresh(5) + ["same"] * 62 + fresh(90)), (301, ["same"] * 51 + fresh(90)), (302, None)]
    g.shuffle(docs)
    table = spark.createDataFrame([(i, " ".join(t) if t else None) for i, t in docs], "doc_id long, text string")
    rows = passage_chains.linked_passages(table).collect()
    text = {i: t for i, t in docs if t}

    def runs(n):
        own = {i: {tuple(t[k : k + n]) for k in range(len(t) - n + 1)} for i, t in text.items()}
        return {(i, j) for i, j in itertools.combinations(sorted(text), 2) if own[i] & own[j]}

    direct = {tuple(sorted((r["doc_id"], r["partner_id"]))) for r in rows if r["partner_id"] is not None}
    held, beside = {}, {}
    for r in rows:
        if r["partner_id"] is None:
            held.setdefault(r["class_id"], set()).add(r["doc_id"])
        else:
            beside.setdefault(r["partner_id"], []).append((r["doc_id"], r["partner_start"], r["partner_end"]))
            beside.setdefault(r["doc_id"], []).append((r["partner_id"], r["start_word"], r["end_word"]))
    classes = {p for ids in held.values() for p in itertools.combinations(sorted(ids), 2)}
    met = {tuple(sorted((x[0], y[0]))) for own in beside.values() for x, y in itertools.combinations(own, 2) if min(x[2], y[2]) - max(x[1], y[1]) >= 20}
    fifty = runs(50)
    assert len(fifty - direct) > 20
    assert fifty <= classes
    assert classes <= runs(40)
    assert {p for p in direct if p[0] >= 100} == set(itertools.combinations(range(100, 107), 2)) | ({(300, 301)} & direct)

    seed, row, place, _, _ = passage_chains.occurrences(pa.array([" ".join(text[i]) for i in sorted(text)]))
    at = {i: {} for i in sorted(text)}
    for s, r, p in zip(seed.tolist(), row.tolist(), place.tolist()):
        at[sorted(text)[r]][s] = p
    align = {i: passage_chains.words(pa.array([" ".join(t)])).hash for i, t in text.items()}
    whole = set()
    for i, j in itertools.combinations(sorted(text), 2):
        x = sorted({(at[i][s] + k, at[j][s] + k) for s in at[i].keys() & at[j].keys() for k in ((0, 34) if s & 1 else (0,))})
        pos, ppos = np.array([p for p, _ in x], dtype=np.int64), np.array([q for _, q in x], dtype=np.int64)
        for own in passage_chains.chained_seeds(pos, ppos):
            if pos[own[-1]] - pos[own[0]] >= 10 and list(passage_chains.passages(align[i], align[j], passage_chains.equal_runs(pos[own], ppos[own]))):
                whole.add((i, j))
    assert len(whole - direct) > 100 and whole <= direct | classes | met


def test_clashing_columns_and_empty_tables(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a", 1, 1, "p"), (1, 1, "assistant", "b", 2, 2, "q")], "conv_id long, turn long, role string, text string, side int, k int, last string")
    assert preference_chat.preference_pairs(preference_chat.swapped_replies(turns)).first()["chosen_mask"] == "14:23"
    docs = spark.createDataFrame([(1, "good", 5, 1), (2, None, 5, 0)], "doc_id long, text string, quality int, y int")
    labels = spark.createDataFrame([(1, 1, "t"), (2, 0, "t")], "doc_id long, quality int, text string")
    assert quality_cnn.score(docs, quality_cnn.fit(docs, labels.drop("text"))).count() == 2
