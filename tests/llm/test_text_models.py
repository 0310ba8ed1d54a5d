import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlode.llm import decontaminate, pii, queries, secrets, toxicity
from silverlode.llm.spans import Covered


# ---- toxicity


def test_ordinal_fit_orders_severity():
    rng = np.random.default_rng(0)
    x = (rng.random((600, 6)) < 0.3).astype(float)
    grade = np.clip(x[:, :3].sum(axis=1), 0, 3).astype(int)
    w, cuts = toxicity.fit_ordinal(x, grade, 3)
    model = toxicity.OrdinalModel(tuple("abcdef"), w, cuts)
    s = model.severity(x)
    assert (np.diff(cuts) > 0).all() and w[:3].min() > 5 * np.abs(w[3:]).max()
    assert [s[grade == g].mean() for g in range(4)] == sorted(s[grade == g].mean() for g in range(4))
    assert (model.above(x)[:, 0] > 0.5).mean() == pytest.approx((grade > 0).mean(), abs=0.05)


def test_gradient_matches_likelihood():
    x, grade = np.array([[1.0], [0.0], [1.0], [0.0]]), np.array([1, 0, 2, 1])
    w, cuts = toxicity.fit_ordinal(x, grade, 2, l2=0.0, steps=3000, rate=0.02)

    def loss(w, cuts):
        up = 1 / (1 + np.exp(-(cuts[None, :] - (x @ w)[:, None])))
        b = np.concatenate([np.zeros((4, 1)), up, np.ones((4, 1))], axis=1)
        return -np.log(b[np.arange(4), grade + 1] - b[np.arange(4), grade]).sum()

    for dw, dc in ((0.05, [0, 0]), (-0.05, [0, 0]), (0, [0.05, 0]), (0, [-0.05, 0]), (0, [0, 0.05]), (0, [0, -0.05])):
        assert loss(w + dw, cuts + np.array(dc)) > loss(w, cuts) - 1e-3


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    even = labels.where("doc_id % 2 = 0")
    model = toxicity.train(docs, even)
    odd = toxicity.score(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").select("toxicity.toxic", "lang", labels["toxic"].alias("label"), "text").collect()
    marked = [r for r in odd if r["label"] == 1 and len(re.findall(r"(?i)\b(idiot|moron|scum|clown|trash|loser|stupid|pathetic|worthless|disgusting)\b", r["text"])) >= 2]
    assert len(marked) > 80 and sum(r["toxic"] for r in marked) >= 0.95 * len(marked)
    # of all that are labelled so, fitted on 218: words that the other half does not hold five times cannot be known
    every = [r for r in odd if r["label"] == 1]
    assert len(every) > 200 and sum(r["toxic"] for r in every) >= 0.85 * len(every)
    clean = [r for r in odd if r["label"] == 0]
    assert sum(r["toxic"] for r in clean) <= 0.01 * len(clean)


def test_graded_labels_are_what_is_fitted(spark):
    rng = random.Random(4)
    mild, harsh = [f"mild{w}" for w in "abcde"], [f"harsh{w}" for w in "abcde"]

    def row(i):
        grade = i % 3
        words = [f"w{rng.randrange(300)}" for _ in range(20)] + rng.sample(mild, 2) * (grade == 1) + rng.sample(harsh, 2) * (grade == 2)
        return i, " ".join(words), grade * 5  # grades may be any ordered numbers

    rows = [row(i) for i in range(600)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows[:300]], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, model).collect()}
    held = [(got[i], grade // 5) for i, _, grade in rows[300:]]
    # one weight for each word, shared by the thresholds: a word that is the mark of a middle grade ends between them
    assert sum(t["grade"] == g for t, g in held) >= 0.95 * len(held)
    mean = [np.mean([t["severity"] for t, of in held if of == g]) for g in range(3)]
    assert mean[0] < 0.1 < 0.8 < mean[1] < 1.2 < 1.8 < mean[2]


def test_grades_follow_the_labels():
    label, none = np.array([0, 7, 2, 7, 9, 0]), np.zeros((6, 1))
    assert toxicity.ordered_grades(label, none, 3).tolist() == [0, 2, 1, 2, 3, 0]
    assert toxicity.ordered_grades(label, none, 2).tolist() == [0, 1, 1, 1, 2, 0]
    assert toxicity.ordered_grades(np.minimum(label, 1), np.array([[0, 0], [1, 0], [1, 1], [1, 0], [1, 1], [0, 0]]), 2).tolist() == [0, 1, 2, 1, 2, 0]


def test_toxicity_query_against_brute_force(spark):
    """Features, their choice and every document's severity, spelled out; the fit itself has its own test above."""
    path = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    model = toxicity.train(docs, labels)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}

    def found(text):
        out = set()
        for word in re.split(r"[\W\d_]+", text.lower()):
            if word:
                out |= {word} | {"^" + word[:n] for n in (3, 4, 5, 6) if n < len(word)}
        return out

    rows = [(found(texts[r["doc_id"]]), r["toxic"]) for r in labels.collect() if r["toxic"] in (0, 1) and r["doc_id"] in texts]
    bad, good = sum(t for _, t in rows), sum(1 - t for _, t in rows)
    hits = {1: Counter(f for fs, t in rows if t == 1 for f in fs), 0: Counter(f for fs, t in rows if t == 0 for f in fs)}
    chosen = []
    for f, a in hits[1].items():
        b = hits[0][f]
        if a >= toxicity.LEAST and a * good > toxicity.RATIO * b * bad:
            chosen.append((-((a * (good - b) - b * (bad - a)) ** 2) * (bad + good) / max(1, bad * good * (a + b) * (bad + good - a - b)), f))
    assert set(model.names) == {f for _, f in sorted(chosen)[: toxicity.FEATURES]}
    weight = dict(zip(model.names, model.weights))
    got = {r["doc_id"]: r for r in queries.op3_toxicity(spark, path).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        z = sum(weight.get(f, 0.0) for f in found(text))
        above = [1 / (1 + np.exp(c - z)) for c in model.thresholds]
        assert got[i]["severity"] == pytest.approx(sum(above), abs=1e-5)
        assert got[i]["grade"] == sum(p > 0.5 for p in above) and got[i]["toxic"] == (above[0] > 0.5)


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(i, f"word{i} filler {'vile ' if i % 2 else ''}text", 1.0) for i in range(60)] + [(None, None, 2.0), (100, "", 2.0), (101, "vile " * 200_000, 2.0)], "doc_id bigint, text string, severity double")
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(60)] * 2 + [(None, 1, None), (5000, 1, None), (3, None, None), (4, -1, None)], "doc_id bigint, toxic int, text string")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["toxicity"]["toxic"] for r in toxicity.score(docs, model).collect()}
    assert all(got[i] == bool(i % 2) for i in range(60)) and got[101] and not got[100] and not got[None]
    none = toxicity.train(docs, labels.limit(0))
    assert not any(r["toxicity"]["toxic"] for r in toxicity.score(docs, none).collect())
    assert toxicity.score(docs.limit(0), model).count() == 0


# ---- decontamination

ITEM = "A train travels 120 km in 3 hours while Maria walks 12 km towards the station. How far apart are they after the train has stopped?"
FILLER = "the quick brown dog jumped over several lazy cats and kept running along the river bank until dusk came"


def leaks(spark, items, texts):
    """For each text, the items it holds."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = {r["doc_id"]: [x["item"] for x in r["leaks"]] for r in decontaminate.with_leaks(docs, bench).collect()}
    return [got[i] for i in range(len(texts))]


def test_templates(spark):
    other = ITEM.replace("120", "90.5").replace("12 ", "7 ").replace("3 ", "2 ").replace("Maria", "Johan")
    held = [f"{FILLER}. {ITEM} {FILLER}", f"{FILLER}. {ITEM.upper()}", f"{FILLER}. {other}"]
    assert leaks(spark, [(1, ITEM)], [*held, FILLER, None, "", ITEM[:40]]) == [[1]] * 3 + [[]] * 4


def brute_windows(text):
    """Windows of a text, spelled out: each coding of each capital, three words at least."""
    out = {}
    toks = decontaminate.tokens(text)
    for p in range(len(toks) - 4):
        options = [{"number": ["#"], "unit": ["@"], "word": [f], "name": [f, "^"]}[k] for f, k in toks[p : p + 5]]
        for w in itertools.product(*options):
            if sum(x not in "#@^" for x in w) >= 3:
                out.setdefault(w, set()).add(p)
    return out


def test_windows_meet_as_they_do_spelled_out():
    """Two texts share windows by hash exactly where they share them as sequences, with and without a map of words."""
    rng = random.Random(12)
    parts = ["Maria", "maria", "A", "a", "train", "Train", "TRAIN", "Zoë", "zoë", "5", "5.5", "1,000", "km", "Km", "%", "Ünder", "İ", "ß", "ǅa", "٣", "house", "goes", "by"]
    for _ in range(400):
        one, two = (" ".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(2))
        words = np.zeros(1 << (decontaminate.WORD_BITS - 6), np.uint64)
        for form, kind in decontaminate.tokens(one):
            slot = decontaminate.word_slot(decontaminate._word_code(form))
            words[slot >> 6] |= np.uint64(1 << (slot & 63))
        found = []
        for text, memory in ((one, decontaminate._Typed()), (two, decontaminate._Typed(words.tobytes()))):
            at, h, _ = decontaminate.template_windows(decontaminate._codes(decontaminate.forms_of(text), memory))
            found.append({(int(x), int(p)) for p, x in zip(at, h)})
        want = {(p, q) for w, ps in brute_windows(one).items() for p in ps for q in brute_windows(two).get(w, ())}
        assert {(p, q) for x, p in found[0] for y, q in found[1] if x == y} == want


def test_shorter_patterns_find_the_same_tokens():
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choices(["a", "Zß", "9", "٣", "².", "1,5", "_", " ", "€", "%", "ñ", "東", "ท", "é́", "x_y", "½", "$"], k=rng.randint(0, 9)))
        assert decontaminate.forms_of(text) == decontaminate._TOKEN.findall(text), text


def test_names_are_judged_without_the_other_items(spark):
    item = "Tom gives 3 apples to Ann. Ann then gives 2 apples to Tom. How many apples has Tom left?"
    other = item.replace("Tom", "Bob").replace("Ann", "Sue").replace("3", "8").replace("2", "5")
    inside = "In the morning Tom walks 3 blocks with Ann towards the park and then they walk 2 more blocks home."
    texts = [f"{FILLER}. {other} {FILLER}", item, item.lower(), item.upper(), item.title(), other.replace("to Bob", "to Max").replace("has Bob", "has Joe")]
    for items in ([(1, item)], [(1, item), (2, inside)]):
        assert leaks(spark, items, texts) == [[1]] * 5 + [[]]
    assert leaks(spark, [(2, inside), (1, item)], [inside.replace("Tom", "Bob").replace("Ann", "Sue")]) == [[2]]


def test_items_of_few_windows_match_whole(spark):
    items = [(1, "12 + 7 * 3 - 4 = 29 mod 5"), (2, "He was born in 1990."), (3, "two plus two"), (4, "東京タワーの高さは333メートルです。完成したのは何年ですか"), (5, "日本の首都は"), (6, "+ = ?"), (7, "ประเทศไทย"), (8, "Add 3 km to 4 km and 5 km: 12 km?"), (9, "7 + 8 kg minus 9 kg equals 5 kg and 6 km")]
    verbatim = [f"{FILLER}. {text} {FILLER}" for _, text in items]
    others = {
        "He was born in 1985. 12 + 7 * 3 - 4 = 29 mod 6. Two plus three.": [], "問題日本の首都は東京です": [5], "そして東京タワーの高さは250メートルです。完成したのは何年ですかと聞く": [4], "He was born in 1990": [2], "two plus two": [3],
        "two plus": [], "日本の首": [], "Add 3 km to 4 km and 5 km": [], "two plus three plus two": [],
    }
    assert leaks(spark, items, [*verbatim, *others]) == [[i] if i != 6 else [] for i, _ in items] + list(others.values())


def test_slots_have_to_agree_wherever_chance_windows_stand(spark):
    item = "Take 5 apples and 5 pears then add 5 plums to the bowl and eat 5 of them before noon on sunday"
    mixed = item.replace("5 apples", "1 apples").replace("5 pears", "2 pears").replace("5 plums", "3 plums").replace("5 of", "4 of")
    copy, decoy = item.replace("5", "8"), "Take 3 apples and 3 pears."
    assert leaks(spark, [(1, item)], [copy, mixed, f"{decoy} {copy}", f"{copy} {decoy}", f"{decoy} {copy} {decoy}", decoy]) == [[1], [], [1], [1], [1], []]
    two = "Add 7 red tiles to 9 blue tiles and then take 7 green tiles from the 9 that were left on the floor"
    same = two.replace("7", "4").replace("9", "4")
    assert leaks(spark, [(1, two)], [two.replace("7", "2").replace("9", "6"), same]) == [[1], []]


def test_a_share_of_a_long_item_is_needed(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(300)]
    bend = [w if i % 60 else "odd" for i, w in enumerate(words)]
    assert leaks(spark, [(1, " ".join(words))], [" ".join(words[50:62]), " ".join(words[:200]), " ".join(bend), f"{FILLER} {' '.join(words[:285])}"]) == [[], [], [1], [1]]


def test_planted_variants_are_found_and_mixtures_are_not(spark):
    """By construction: values exchanged one for one are a leak; values exchanged each time anew are none."""
    rng = random.Random(4)
    verbs, nouns = "counts buys paints loses finds packs".split(), "boxes lamps coins cards tents bolts".split()
    items, texts, want = [], [], []
    for i in range(30):
        parts = [f"{rng.choice(['Lena', 'Omar', 'Ines'])} {rng.choice(verbs)} {rng.randint(10, 99)} {rng.choice(nouns)} item{i} before the next {rng.choice(nouns)} come in" for _ in range(4)]
        items.append((i, ". ".join(parts)))
        number, name = {}, {}
        swap = lambda m: str(number.setdefault(m[0], 100 + 7 * len(number) + rng.randint(0, 6)))
        rename = lambda m: name.setdefault(m[0], ["Petra", "Hugo", "Zara", ""][len(name)])
        texts.append(f"{FILLER}. " * rng.randint(0, 3) + re.sub("Lena|Omar|Ines", rename, re.sub(r"\b\d\d\b", swap, items[-1][1])) + f" {FILLER}")
        want.append([i])
        thrice = re.sub(r"\b\d\d\b", "11", items[-1][1])
        texts.append(re.sub(r"\b11\b", lambda m: str(rng.randint(1000, 9999)), thrice) if len(set(re.findall(r"\b\d\d\b", items[-1][1]))) < 3 else FILLER)
        want.append([])
    assert leaks(spark, items, texts) == want


def test_leaks_column(spark):
    rows = [(1, f"{FILLER} {ITEM}", "a"), (2, FILLER, "b"), (3, None, None), (4, "", "c"), (1, f"{FILLER} {ITEM}", "a"), (6, f"{FILLER} " * 4000 + ITEM, "z"), (None, ITEM, "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, Leaks string")
    bench = spark.createDataFrame([(10, ITEM), (11, ITEM), (11, ITEM), (12, None), (13, ""), (None, "never once in these documents"), (None, f"{FILLER.title()} again")], "item_id bigint, text string")
    out = decontaminate.with_leaks(docs, bench)
    assert out.columns == ["doc_id", "text", "Leaks", "leaks_"]
    got = sorted((r["doc_id"] or 0, r["Leaks"] or "", [x["item"] for x in r["leaks_"]]) for r in out.collect())
    assert got == [(0, "n", [10, 11]), (1, "a", [10, 11]), (1, "a", [10, 11]), (2, "b", []), (3, "", []), (4, "c", []), (6, "z", [10, 11])]
    lost = decontaminate.with_leaks(docs, spark.createDataFrame([(None, FILLER)], "item_id bigint, text string")).where("doc_id = 2").first()
    assert [x["item"] for x in lost["leaks_"]] == [None]
    assert decontaminate.with_leaks(docs, bench.limit(0)).where("size(leaks_) > 0").count() == 0
    assert decontaminate.with_leaks(docs.limit(0), bench).count() == 0


def test_leak_query_against_brute_force(spark, data):
    """Every document that holds a whole item, whatever stands between its words, and none without thirteen of its words in a row."""
    from silverlode.llm.queries import op4_decontamination

    split = lambda t: re.findall(r"[^\W_]+", t.lower())
    bench = [(r["item_id"], split(r["text"])) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    got = {r["doc_id"]: set(r["item_ids"]) for r in op4_decontamination(spark, data).collect()}
    leaked = 0
    for r in spark.read.parquet(f"{data}/documents.parquet").collect():
        words = split(r["text"])
        text = f" {' '.join(words)} "
        whole = {i for i, w in bench if f" {' '.join(w)} " in text}
        leaked += bool(whole)
        assert whole <= got[r["doc_id"]]
        if got[r["doc_id"]] - whole:
            assert any(f" {' '.join(w[k : k + 10])} " in text for i, w in bench for k in range(len(w) - 9))
    assert leaked


# ---- personal data

EMAIL, IP = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD, PHONE = r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"


def plain_pii(text):
    out = [(0, m.start(), m.end()) for m in re.finditer(EMAIL, text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    for k, p, lo, hi in ((2, CARD, 16, 19), (3, PHONE, 8, 15)):
        for m in re.finditer(p, text):
            d = re.sub(r"[^0-9]", "", m[0])
            if lo <= len(d) <= hi and (k == 3 or sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0):
                out.append((k, m.start(), m.end()))
    return sorted(out)


def test_pii_patterns_equal_plain_regex():
    rng = random.Random(4)
    parts = ["a", "Z9", "@", "@@", ".", "..", "-", "+", "%", "_", " ", "  ", "é", "1", "12", "255", "256", "4111111111111111", "4041894974608795", "(", ")", "x@y.co", "1.2.3.4", "+1 (415) 555-0132", "\n", "b.c"]
    for _ in range(20_000):
        t = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        assert pii.base_spans(t) == plain_pii(t), t


def test_pii_patterns_are_linear():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 200_000, "a@" * 200_000, "+1 " * 100_000, "@" * 300_000, "1 " * 200_000):
        pii.base_spans(t)


@pytest.mark.parametrize("unit", ["x 10.2.3.4 y ", "1 ", "1.2.", "at 5 dot ", "(415) 555 0132 ", "call a@b.co or 4111 1111 1111 1111, ", "deadbeef01 token=abcdef12 x9y8z7 ", "9", "a.", "@1 "])
def test_spans_take_time_in_proportion_to_the_text(unit, field, formats):
    """Texts dense in triggers, candidates and known spans."""
    import time

    took = []
    for size in (40_000, 160_000):
        text = unit * (size // len(unit))
        began = time.perf_counter()
        pii.added_spans(text, pii.base_spans(text), field)
        secrets.added_spans(text, secrets.base_spans(text), formats)
        took.append(time.perf_counter() - began)
    assert took[1] < 8 * took[0] + 0.5, took


def test_lattice_holds_every_segment():
    """Against all pieces tried with all kinds."""
    rng, m = random.Random(14), pii.SemiMarkov({})
    parts = ["at", "dot", "@", ".", " ", "  ", "\n", "-", "+", "(", ")", "1", "22", "555", "4111", "0123456789", "abc", "é", "_"]
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        cuts, got = m.lattice(text)
        want = []
        for i in range(len(cuts) - 1):
            for j in range(i + 1, min(i + pii.LONGEST, len(cuts) - 1) + 1):
                s = text[cuts[i] : cuts[j]]
                if "\n" in s:
                    break
                if not s[0].isspace() and s[0].isascii() and s[-1].isascii():
                    want += [(i, j, k) for k in range(4) if pii.plausible(k, s) and len(re.sub("[^0-9]", "", s)) <= (10**6 if k == 0 else 19)]
        assert [x[:3] for x in got] == want, text


def test_covered_stretches():
    rng = random.Random(15)
    for _ in range(500):
        spans = [(0, a, a + rng.randint(1, 6)) for a in (rng.randint(0, 30) for _ in range(rng.randint(0, 5)))]
        c = Covered(spans)
        for a in range(36):
            for b in range(a + 1, a + 5):
                assert c.meets(a, b) == any(a < y and x < b for _, x, y in spans)


def pii_corpus(n=220):
    rng = random.Random(8)
    out = []
    for _ in range(n):
        pan = "4" + "".join(rng.choices("0123456789", k=14))
        pan += next(c for c in "0123456789" if pii.luhn(pan + c))
        s = rng.choice([f"{rng.choice('abcdef')}lan.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com", ".".join(str(rng.randint(1, 255)) for _ in range(4)), pan, f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"])
        text = f"some words here {s} and other words version {rng.randint(1, 9)}.0 of it"
        out.append((text, pii.base_spans(text)))
    return out


@pytest.fixture(scope="module")
def field():
    return pii.fit(pii_corpus())


@pytest.mark.parametrize("text, kind", [("please call (415) 555-0132 today", 3), ("write 4041.8949.7460.8795 here", 2), ("at +1 (569) 555-6633 4795326016703902 it", 2)])
def test_pii_field_adds(field, text, kind):
    assert kind in {k for k, _, _ in pii.added_spans(text, pii.base_spans(text), field)}


@pytest.mark.parametrize("text", ["licensed under version 2.0 of it", "in 1999 there were 12 of 300", "CC BY-NC 4.0", "", "at noon we dot the page", "number 1234567890123456 x"])
def test_pii_field_leaves_alone(field, text):
    assert pii.added_spans(text, pii.base_spans(text), field) == []


def test_segment_likelihood_is_exact():
    """Forward and backward sums against all segmentations of a small lattice: the gradient moves as a sum over them says."""
    m = pii.SemiMarkov({})
    cuts, segments = [0, 1, 2, 3], [(0, 1, 1, ["a"]), (0, 2, 2, ["b"]), (1, 3, 1, ["c"]), (2, 3, 3, ["d"])]
    m.weights = {"a": 0.3, "b": -0.2, "c": 0.9, "d": 0.1}
    before, total, mass = dict(m.weights), 0.0, dict.fromkeys("abcd", 0.0)
    for bits in range(16):
        chosen = [s for i, s in enumerate(segments) if bits >> i & 1]
        if all(x[1] <= y[0] or y[1] <= x[0] for x in chosen for y in chosen if x is not y):
            w = np.exp(sum(before[s[3][0]] for s in chosen))
            total += w
            for s in chosen:
                mass[s[3][0]] += w
    m.step(cuts, segments, {(1, 3, 1)}, 1.0)
    for f in "abcd":
        assert m.weights[f] == pytest.approx(before[f] + (f == "c") - mass[f] / total - pii.L2 * before[f])


# ---- secrets


def plain_secrets(text):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"""(?a)(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 6]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(2, m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_secret_patterns_equal_plain_regex():
    rng = random.Random(6)
    parts = ["password", "PassWd", "token", "api_key", "APIKEY", "ſecret", "secret", "=", ":", " ", '"', "'", "abc123", "AKIA", "QWERTY12", "deadbeef", "0123456789abcdef", ".", "-", "é", "g", "x"]
    for _ in range(20_000):
        t = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        assert secrets.base_spans(t) == plain_secrets(t), t


@pytest.fixture(scope="module")
def formats():
    rng = random.Random(9)
    hexes = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    known = [(0, hexes(18)) for _ in range(80)] + [(1, "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16))) for _ in range(80)] + [(2, hexes(40)) for _ in range(80)]
    ordinary = [f"user.{i}@mail".replace("@", ".") + ".example.com" for i in range(200)] + ["".join(rng.choices("0123456789", k=16)) for _ in range(200)] + ["therewithal", "considerations", "version-2.0"] * 60
    return secrets.fit(known, ordinary)


def test_automata_merge_and_judge(formats):
    assert all(len(a.states) < 60 for a in formats.automata.values()) and len(formats.automata[1].states) >= 5
    rng = random.Random(10)
    new = ["".join(rng.choices("0123456789abcdef", k=18)) for _ in range(100)]
    assert sum(formats.judge(t) is not None for t in new) >= 95
    assert formats.judge("AKIAZZ34QRSTUVWXY2") == 1
    assert sum(formats.judge("".join(rng.choices("0123456789", k=16))) is not None for _ in range(100)) <= 5
    assert formats.judge("user.77.mail.example.com") is None


@pytest.mark.parametrize("token, kind", [("AKIAZZQRSTUVWXYZAB", 1), ("9f3b07d1c8e6", 0), ("9f3b07d1", 0), ("considerations", None), ("therewithal", None), ("version-2.0", None), ("201904", None)])
def test_short_and_digit_free_tokens_are_scored(formats, token, kind):
    got = secrets.added_spans(f"see {token} here", [], formats)
    assert [(a, b) for _, a, b in got] == ([] if kind is None else [(4, 4 + len(token))]) and (kind != 1 or got[0][0] == 1)


def test_automaton_is_a_distribution():
    a = secrets.Automaton(["ab", "ab", "aab", "b"] * 20)
    assert a.log_likelihood("ab") > a.log_likelihood("bb") and a.log_likelihood("ab") > a.log_likelihood("zz")


@pytest.mark.parametrize("module, query, id_kind", [(pii, "op7_pii", 4), (secrets, "op10_secrets", 3)])
def test_span_queries_keep_the_base(spark, data, module, query, id_kind):
    import hashlib

    from silverlode.llm import queries

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    plain = plain_pii if module is pii else plain_secrets
    for r in getattr(queries, query)(spark, data).collect():
        base = plain(texts[r["doc_id"]])
        names = [f"{module.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert [r[1 + k] for k in range(id_kind)] == [sum(x[0] == k for x in base) for k in range(id_kind)]
        assert r["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(r["spans"].split(",")) | {""}


def test_span_edges(spark):
    long = "word a@b.co 1.2.3.4 token=abcdef " * 40_000
    docs = spark.createDataFrame([(1, None, "p"), (2, "", "q"), (None, "mail a@b.co", "r"), (2, "", "q"), (3, "mail a@b.co", "r"), (4, long, "s")], "doc_id bigint, text string, PII string").withColumn("secrets", F.lit(1)).withColumn("toxicity", F.lit(2))
    found = pii.with_spans(docs, pii.train(docs)).collect()
    assert [(r["PII"], r["pii_"]["n_email"]) for r in found] == [("p", 0), ("q", 0), ("r", 1), ("q", 0), ("r", 1), ("s", 40_000)]
    found = secrets.with_spans(docs, secrets.train(docs)).collect()
    assert [(r["secrets"], r["secrets_"]["n_assign"]) for r in found] == [(1, 0)] * 5 + [(1, 40_000)]
    scored = toxicity.score(docs, toxicity.OrdinalModel((), np.zeros(0), np.full(3, 30.0)))
    assert scored.columns[-2:] == ["toxicity", "toxicity_"] and {r["toxicity"] for r in scored.collect()} == {2}
    assert pii.with_spans(docs.limit(0), pii.train(docs.limit(0))).count() == 0
