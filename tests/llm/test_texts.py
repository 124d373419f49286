"""Repetition, look-alikes, packing, leakage and residue against brute force, and their edge cases."""

import pickle
import random
import unicodedata

import numpy as np
import pandas as pd
import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from clipweave.llm import codes, leakage, lookalike, packing, repetition, residue


def words_of(text):
    kind, plain = codes.kinds(), codes.plain([text])
    return "".join(" " if kind[ord(c)] == codes.BREAK else c for c in plain if kind[ord(c)] != codes.DROP).split()


def brute_share(text):
    """The repeated share by looking at every passage and every square."""
    w = words_of(text)
    s = "".join(w)
    at = np.cumsum([0] + [len(x) for x in w])
    hit = [False] * len(s)
    for i in range(len(w) - 3):
        if any(w[j : j + 4] == w[i : i + 4] for j in range(i)):
            hit[at[i] : at[i + 4]] = [True] * int(at[i + 4] - at[i])
    for p in range(1, len(s) // 2 + 1):
        for i in range(len(s) - 2 * p + 1):
            if s[i : i + p] == s[i + p : i + 2 * p]:
                hit[i + p : i + 2 * p] = [True] * p
    return sum(hit) / len(s) if s else 0.0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abا بَ.[x]\n", max_size=60), max_size=6))
def test_shares_equal_brute_force(texts):
    got = repetition.shares(texts)
    assert np.allclose(got[:, 0], [brute_share(t) for t in texts])


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 4))
def test_long_squares_equal_short_ones(seed, unit, times):
    rng = np.random.default_rng(seed)
    piece = rng.integers(0, 3, unit)
    s = np.concatenate([rng.integers(0, 2, rng.integers(0, 30)), *[piece] * times, rng.integers(0, 3, rng.integers(0, 30))]).astype(np.uint32)
    want = repetition._squares(s, np.zeros(len(s), int), 3, len(s))
    assert (repetition._long_squares(s, 3, len(s), held=50) == want).all()


def test_a_long_text_without_blanks_takes_no_time():
    rng = np.random.default_rng(0)
    word = "".join(map(chr, rng.integers(ord("a"), ord("z"), 150_000)))
    assert repetition.shares([word + word])[0, 0] == pytest.approx(0.52, abs=0.01)


def test_half_of_a_group_is_enough_for_its_estimate():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0.1, 0.03, (560, 4)), rng.normal(0.9, 0.02, (440, 4))])
    got = repetition._starts(pd.DataFrame(x).assign(_g="g"))
    assert np.allclose(got["_m"][0], 0.1, atol=0.02) and len(got) >= 1


def test_shares_of_loops():
    texts = ["هي جربت رخيص " * 12, "hahahaha", "one two zwei four five. ONE two, zwei four [laughs] five", "a long text without any repeats", "", "x" * 5000, ("abcdefgh " * 3).strip()]
    got = repetition.shares(texts)[:, 0]
    assert got[0] > 0.9 and got[1] == 0.75 and got[2] == 0.5 and got[3] < 0.1 and got[4] == 0 and got[5] > 0.99 and got[6] == pytest.approx(2 / 3)


def documents(spark, n=400):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("بتثجحخدذرزسشصضطظعغفقكلمنهوي") for _ in range(rng.randrange(3, 8))) for _ in range(400)]
    out = []
    for i in range(n):
        loop = i % 10 == 0
        text = " ".join(rng.choice(vocabulary) for _ in range(30)) if not loop else " ".join([*rng.sample(vocabulary, 5)] * 8)
        out.append((i, text, "s1" if i % 3 else "s2", loop))
    return out


def test_repetitive_documents_are_outliers_of_their_group(spark):
    data = documents(spark)
    df = spark.createDataFrame([d[:3] for d in data], "id long, text string, source string")
    got = {r["id"]: r for r in repetition.repetitive(df).collect()}
    assert len(got) == len(data)
    assert all(got[i]["rejected"] for i, *_, loop in data if loop)
    assert sum(got[i]["rejected"] for i, *_, loop in data if not loop) < 0.1 * len(data)


def test_a_group_broken_as_a_whole_is_still_rejected(spark):
    data = documents(spark)
    df = spark.createDataFrame([(i, t, "bad" if loop else "good") for i, t, _, loop in data] + [(10_000 + i, "كلمة تانية " * 20, "bad") for i in range(80)], "id long, text string, source string")
    got = repetition.repetitive(df)
    assert got.where("source = 'bad' AND NOT rejected").count() == 0


@pytest.mark.parametrize("share", [0.3, 0.5, 0.7])
def test_however_many_of_a_group_loop_the_loops_are_rejected(spark, share):
    sound = [(d[0], d[1]) for d in documents(spark) if not d[3]]
    data = [(i, t, "main") for i, t in sound] + [(10_000 + i, t, "small") for i, t in sound[: int(100 * (1 - share))]]
    data += [(20_000 + i, " ".join(t.split()[:3]) + "desert" * 12, "small") for i, (_, t) in enumerate(sound[: int(100 * share)])]
    got = repetition.repetitive(spark.createDataFrame(data, "id long, text string, source string"))
    assert got.where("repeated >= 0.5").count() == int(100 * share) and got.where("repeated >= 0.5 AND NOT rejected").count() == 0


def test_repetition_takes_odd_input(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", "s"), (3, "[tag]", "s"), (4, "ab " * 30_000, "s")], "id long, text string, source string")
    got = {r["id"]: r for r in repetition.repetitive(df).collect()}
    assert [got[i]["repeated"] for i in (1, 2, 3)] == [0, 0, 0] and got[4]["repeated"] > 0.99 and not got[1]["rejected"]
    assert repetition.repetitive(df.limit(0)).count() == 0


#: As the public table has them; `test_public_table_of_look_alikes` holds them against it.
LOOKS = lookalike.Looks(dict(zip("аеорсухіјѕһԁԛԝѵАВЕКМНОРСТХІЈЅԌԜονΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijshdqwvABEKMHOPCTXIJSGWovABEZHIKMNOPTYX")))


def test_public_table_of_look_alikes(spark):
    table = lookalike.other_scripts(spark)
    missing = {a: b for a, b in LOOKS.alike.items() if a not in "کیەɡɑ" and table.get(a) != b}
    assert missing == {} and len(table) > 100 and all(b.isascii() for b in table.values())
    assert not {"ى", "ي", "ا", "ه", "é", "ﺍ"} & set(table) and pickle.loads(pickle.dumps(LOOKS)).table == LOOKS.table


def test_fold_brings_look_alikes_together():
    same = [("ﻟﺎ", "لا"), ("ｔｅｓｔ．", "test."), ("раураl", "paypal"), ("أ", "أ"), ("کی", "كي"), ("a​b­", "ab"), ("ﻷ", "لأ"), ("ئ", "ئ"), ("یٔ", "ئ"), ("é", "é")]
    for a, b in same:
        assert LOOKS.fold(a) == LOOKS.fold(b) == b if b.isascii() else LOOKS.fold(a) == LOOKS.fold(b), (a, b)
    different = [("ا", "أ"), ("ه", "ة"), ("ى", "ي"), ("a", "A"), ("a", "à"), ("كَ", "ك"), ("x²", "x2"), (".", "،")]
    for a, b in different:
        assert LOOKS.fold(a) != LOOKS.fold(b), (a, b)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aаééﻟﺎلاأٔییي‏ｔ  \n", max_size=12))
def test_fold_is_idempotent_and_canonical_is_stable(text):
    form = LOOKS.fold(text)
    assert LOOKS.fold(form) == form
    c = lookalike.Canonical(["paypal", "сор"], LOOKS)
    assert c(c(text)) == c(text) == c(unicodedata.normalize("NFD", text))


def test_tries():
    t = lookalike.WordTries(["cat", "сор", "cart", "وﻷن", "a\u200bb", "étude"], LOOKS)
    assert t.match("сat") == ("cat", 0) and t.match("cop") == ("сор", 0) and t.match("c\u200dat") == ("cat", 0) and t.match("cot") is None
    assert t.match("ولأن") == ("وﻷن", 0) and t.match("ab") == ("a\u200bb", 0) and t.match("e\u0301tude") == ("étude", 0) and t.match("etude") is None
    assert t.match("cot", 1) == ("cat", 1) and t.match("carts", 1) == ("cart", 1) and t.match("at", 1) == ("a\u200bb", 1) and t.match("dog", 1) is None
    assert t.match("etude", 0.5) == ("étude", 0.5) and t.match("ca\u0301t", 0.5) == ("cat", 0.5) and t.match("сät", 0) is None


def test_alike_pairs(spark):
    texts = ["سؤال جديد", "سؤال جديد", "سؤال  جديد", "سؤال جدید", "سؤال جديدة", None, "", "​", "A b", "Ａ b", "a b", "x", "x"]
    df = spark.createDataFrame([(f"t{i:02}", t, None if i else "[laughs] x", "clash") for i, t in enumerate(texts)] + [("t00", texts[0], "[laughs] x", "clash")], "id string, text string, text_tagged string, form string")
    c = lookalike.canonical_texts(df, ["text", "text_tagged"])
    got = rows(lookalike.alike_pairs(c))
    group = [i for i in range(4)]
    want = {(f"t{i:02}", f"t{j:02}") for i in group for j in group if i < j and texts[i] != texts[j]} | {("t08", "t09")}
    assert set(got) == want
    assert lookalike.alike_pairs(lookalike.canonical_texts(df.limit(0), ["text"])).count() == 0


def test_pack(spark):
    rng = random.Random(0)
    sizes = [(i, rng.choice([0, -3, None, 5, 33, 100, 101, 250, 777])) for i in range(500)]
    got = packing.pack(spark.createDataFrame(sizes, "doc_id long, tokens long"), capacity=100).toPandas()
    assert got.groupby("container")["used"].sum().max() <= 100
    used = got.groupby("doc_id")["used"].sum().to_dict()
    assert used == {i: s for i, s in sizes if s and s > 0}
    parts = got.groupby("doc_id").size()
    assert all(parts[i] == (1 if s <= 100 else -(-s // 100)) for i, s in sizes if s and s > 0)
    for _, g in got.sort_values("offset").groupby("container"):
        assert (g["offset"].to_numpy() == np.concatenate([[0], g["used"].cumsum()[:-1]])).all()
    assert packing.pack(spark.createDataFrame([], "doc_id long, tokens long")).count() == 0


def test_pack_leaves_little_room(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHELF", 500)
    rng = random.Random(1)
    df = spark.createDataFrame([(i, int(min(2000, rng.lognormvariate(5, 1)) + 1)) for i in range(3000)], "doc_id long, tokens long")
    got = packing.pack(df, capacity=1024).toPandas()
    assert got["used"].sum() / (1024 * got["container"].nunique()) > 0.97


def test_sum_of_squares_choice():
    p = packing.SumOfSquares(10)
    assert p.put(6) == 0 and p.put(4) == 0 and p.open.sum() == 0 and p.put(10) == 1


def test_token_counts(spark):
    got = dict(rows(packing.token_counts(spark.createDataFrame([(1, "hello world"), (2, None), (3, "")], "doc_id long, text string"))))
    assert got == {1: 2, 2: 0, 3: 0}


def leak_corpus():
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [say(n) for n in (40, 20, 13, 12, 9, 5, 1)] + [["ab"], ["a", "b"]]
    docs = []
    for i in range(120):
        d = say(rng.randrange(0, 80))
        it = items[rng.randrange(len(items))]
        if i % 2:
            k = rng.choice([11, 12, 13, 30])
            s = rng.randrange(max(1, len(it) - k + 1))
            piece = it[s : s + k]
            if i % 3 == 0:
                piece = [x.upper() + rng.choice(["", ",", "!", "‍"]) for x in piece]
            at = rng.randrange(len(d) + 1)
            d = d[:at] + piece + d[at:]
        docs.append(rng.choice([" ", "  ", "\n"]).join(d))
    return docs, [" ".join(i) for i in items]


def test_leaks_equal_brute_force(spark):
    docs, items = leak_corpus()
    want = set()
    for i, t in enumerate(docs):
        w = words_of(t)
        for j, u in enumerate(items):
            x = words_of(u)
            n = min(12, len(x))
            grams = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)}
            if any(tuple(w[k : k + n]) in grams for k in range(len(w) - n + 1)):
                want.add((i, j))
    d = spark.createDataFrame([*enumerate(docs), (0, docs[0]), (998, None), (999, "")], "doc_id long, text string")
    e = spark.createDataFrame([*enumerate(items), (50, None), (51, "..."), (0, items[0])], "item_id long, text string")
    assert set(rows(leakage.leaks(d, e))) == want
    assert leakage.leaks(d.limit(0), e).count() == 0 and leakage.leaks(d, e.limit(0)).count() == 0


def test_items_in_blocks_find_the_same(spark, monkeypatch):
    docs, items = leak_corpus()
    d, e = spark.createDataFrame([*enumerate(docs)], "doc_id long, text string"), spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    whole = rows(leakage.leaks(d, e))
    monkeypatch.setattr(leakage, "BLOCK_LETTERS", 100)
    assert rows(leakage.leaks(d, e)) == whole


def edits(a, b):
    """Least edits between `a` and any piece of `b`."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


@pytest.mark.parametrize("budget", [0, 1, 3])
def test_aligned_passages_equal_plain_alignment(budget, monkeypatch):
    monkeypatch.setattr(leakage, "ALIGNED", 7)
    monkeypatch.setattr(leakage, "HITS_HELD", 50)
    rng = random.Random(budget)
    items = ["".join(rng.choice("abcdefgh") for _ in range(5)) + " " + " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(4, 8))) for _ in range(rng.randrange(11, 15))) for _ in range(12)]
    texts = []
    for i in range(60):
        letters = list(rng.choice(items))
        for _ in range(rng.randrange(0, 5)):
            at = rng.randrange(len(letters))
            letters[at : at + rng.choice([0, 1])] = rng.choice(["", "h", "a"])
        texts.append(" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(rng.randrange(0, 6))) + " " + "".join(letters))
    want = set()
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            w = item.split()
            if any(edits("".join(w[s : s + 12]), "".join(text.split())) <= budget for s in range(max(1, len(w) - 11))):
                want.add((t, i))
    index = leakage.ItemIndex.build(list(range(len(items))), items, budget)
    words = codes.Words(texts)
    passages = leakage.candidate_passages(index, words, budget)
    got = {(int(t), int(i)) for t, i, _, _ in passages[leakage.aligned(index, words, passages, budget)]}
    assert got == want and len(want) > 10
    if budget:
        assert set(leakage.leaks_in(index, texts, budget)) == want


def test_leaks_with_edits(spark):
    item = "the quick brown foxes jumped over seven lazy dogs near the river bank today"
    near = item.replace("foxes", "foxen").replace("lazy", "lzy")
    d = spark.createDataFrame([(1, "well " + near + " indeed"), (2, "nothing of the kind was ever said here by anyone at all today")], "doc_id long, text string")
    e = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert leakage.leaks(d, e).count() == 0 and rows(leakage.leaks(d, e, edits=2)) == [(1, 7)]


RESIDUE = [
    "Title - {{ guest_name }} and more", "مدة التسجيل ${Duration}", "Guest: [INSERT HOST HERE]", "Title - «ضع المدة هنا»", "see <FIRST_NAME> there", "Listen at TODO: add link",
    "x " + "Lorem ipsum dolor sit amet consectetur adipiscing elit", "well asdf asdf qwer xxx abc foo today", "XXXX xx Xxxxx xxx xxxx", "Your summary will go here.", "هذا نص مؤقت يمكن استبداله لاحقا",
    "404 Not Found", "Home | Episodes | About\nError 500: Internal Server Error", "Please enable JavaScript to view this page.", "<noscript>You need to allow scripts to load this player.</noscript>",
    "يلزم تفعيل جافاسكريبت في المتصفح لعرض المحتوى", "عفوا حدث خطأ غير متوقع أعد المحاولة لاحقا. رقم 1c8ee5", "Too many requests. Slow down and come back in 23 seconds.", "[object Object] null null NaN", "This recording is private.",
]
SOUND = [
    "we discuss what a 503 error tells an engineer about a small server and why it came back", "someone asked when to enable JavaScript in a reader and when to leave it alone",
    "her first website showed error 404 for two days and she laughed loud about it later", "the engineer explains why printers put lorem ipsum in early drafts of every poster",
    "الكود كان مكتوب فيه while n { n--; } وده اللي عمل المشكلة في المشروع كله", 'my json looked like {"a": 1, "b": [2, 3]} that day and nobody knew why', "السعر كان 20% أقل و $12 بس للحلقة", "كلمة undefined في البرمجة معناها إن القيمة لسه متحددتش",
    "أول مرة أشوف رسالة access denied كانت في الشغل القديم وكنت لوحدي", "[laughs] a plain caption, [pause] and more", "", None, "<b>bold</b> text of a page",
]


def test_residue_tells_messages_from_talk(spark):
    data = [(i, t, f"s{i % 3}") for i, t in enumerate(RESIDUE + SOUND)]
    df = spark.createDataFrame([*data, data[0]], "doc_id long, text string, source string")
    got = {r["doc_id"] for r in residue.residue(df).collect()}
    assert [RESIDUE[i] for i in range(len(RESIDUE)) if i not in got] == [] and [t for i, t, _ in data[len(RESIDUE) :] if i in got] == []
    assert residue.residue(df.limit(0)).count() == 0


def test_residue_counts_sources_of_masked_messages(spark):
    df = spark.createDataFrame([(i, f"Sorry, something broke on our end. Ticket no. {n}", s) for i, (n, s) in enumerate([("456292", "a"), ("0812aa", "b"), ("1", None)])], "doc_id long, text string, source string")
    assert {(r["sources"], r["by"]) for r in residue.residue(df).collect()} == {(3, "recurrence")}
    assert [r["by"] for r in residue.residue(df.limit(1)).collect()] == ["phrase"]


#: Pieces that no list of triggers named: filler without its first words, notices at the start, bare codes, marks within a word.
UNLISTED = [
    "Sed do eiusmod tempor incididunt ut labore", "Ut enim ad minim veniam, quis nostrud", "Scripts are required.", "JS is required", "400 Bad Request", "N/A",
    "This is some\u200b sam\u200bple content", "err\u200bor 502: oops", "هـــذا نَصّ مُؤَقَّت",
]
RULES = [residue.PLACEHOLDERS, residue.BLIND, residue.WEAK, *residue.STRONG.values()]


def test_scanner_passes_the_examples_of_the_rules(spark):
    assert [t for t in RESIDUE + UNLISTED if not residue._may_hold(residue._tidy(t))] == []
    df = spark.createDataFrame([*enumerate(UNLISTED)], "doc_id long, text string").selectExpr("*", "'s' AS source")
    got = {r["doc_id"] for r in residue.residue(df).collect()}
    assert [t for i, t in enumerate(UNLISTED) if i not in got] == []


@settings(max_examples=1000, deadline=None)
@given(st.one_of([st.from_regex(r) for r in RULES]))
def test_scanner_passes_whatever_a_rule_matches(text):
    tidy = residue._tidy(text)
    if any(r.search(line) for r in RULES for line in [tidy, *tidy.split("\n")]):
        assert residue._may_hold(tidy)


def test_any_weak_line_counts_where_it_recurs_across_sources(spark):
    talk = "a long caption about something else altogether that people said on the day, and then some more of it"
    lines = ["Error 404", "(401 Unauthorized)", "400 Bad Request", "410 Gone", "undefined undefined", "coming soon", "error 403 - forbidden"]
    twice = [f"{talk}\n{x}\n{talk}" for x in lines for _ in "ab"]
    others = [f"{talk}\nJavaScript\n{talk}", *[f"{talk}\nour error 404 page\n{talk}"] * 2]
    df = spark.createDataFrame([(i, x, "ab"[i % 2]) for i, x in enumerate(twice + others)], "doc_id long, text string, source string")
    got = {r["doc_id"] for r in residue.residue(df).collect()}
    assert got == set(range(len(twice)))
