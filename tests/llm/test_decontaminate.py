import random

from framewright.llm import decontaminate
from framewright.llm.decontaminate import drop_leaks, edit_search, find_leaks, normalise

from .util import ALL_IDS, documents, ids


def distance(pattern, text):
    """Least edits of the pattern against any part of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_edit_search_against_the_table():
    rng = random.Random(1)
    for _ in range(300):
        pattern = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 80)))
        text = "".join(rng.choice("ab c") for _ in range(rng.randint(0, 90)))
        if rng.random() < 0.5:
            edited = list(pattern)
            for _ in range(3):
                edited[rng.randrange(len(edited))] = "x"
            text = text[:20] + "".join(edited) + text[20:]
        budget, want = rng.randint(0, 20), distance(pattern, text)
        got = edit_search(pattern, text, budget)
        assert (got is None) == (want > budget) and (got is None or got[0] == want)


def edit(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(["", "q", "zz"[:1] + text[at]]) + text[at + 1 :]
    return text


def planted(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 8)))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(25)]
    docs = []
    for i in range(120):
        text = " ".join(word() for _ in range(rng.randrange(60)))
        if i % 3 == 0:
            item = rng.choice(items)[1]
            text += "  " + edit(rng, item, rng.randrange(0, 14)).upper() + "\n" + text
        docs.append((i, text))
    return items, docs


def test_against_brute_force(spark, monkeypatch):
    items, docs = planted()
    want = {}
    for d, text in docs:
        for i, item in items:
            n = distance(normalise(item), normalise(text))
            if n <= int(len(normalise(item)) * decontaminate.ERROR_RATE):
                want[d, i] = n
    assert len(want) > 20
    questions = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")
    frame = documents(spark, [(*d, None) for d in docs], extra=("item", "distance"))
    for block in (20_000, 7):
        monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", block)
        assert {(r.doc_id, r.item_id): r.distance for r in find_leaks(frame, questions).collect()} == want
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 900)
    assert {(r.doc_id, r.item_id): r.distance for r in find_leaks(frame, questions).collect()} == want
    kept = {r.doc_id for r in drop_leaks(frame, questions).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_hard_cases(spark):
    questions = spark.createDataFrame([(None, "long words " * 5), (1, None), (2, ""), (3, "short"), (4, "long words " * 5), (4, "long words " * 5)], "item_id long, text string")
    got = find_leaks(documents(spark), questions).collect()
    assert [(r.doc_id, r.item_id, r.distance) for r in got] == [(5, 4, 0)]
    assert ids(r.doc_id for r in drop_leaks(documents(spark), questions).collect()) == [i for i in ALL_IDS if i != 5]
    assert find_leaks(documents(spark).limit(0), questions).count() == 0
    assert find_leaks(documents(spark), questions.limit(0)).count() == 0
    assert drop_leaks(documents(spark), questions.limit(0)).count() == len(ALL_IDS)


def test_short_items_are_whole_words(spark):
    benchmark = spark.createDataFrame([(1, "What is  H2O?"), (2, "cat"), (3, " \n"), (4, "= 5 kg"), (5, "a question of 23 chars.")], "item_id long, text string")
    texts = {10: "Cat, what\nis h2o? A cat.", 11: "concatenate cats; 3 = 5 kgs", 12: "the tomcat and x= 5 kg", 13: "a question of 23 chars!", 14: "Cats. A QUESTION of 23 chars.", 15: ""}
    docs = documents(spark, [(i, t, None) for i, t in texts.items()])
    got = sorted(tuple(r) for r in find_leaks(docs, benchmark).collect())
    assert got == [(10, 1, 0, 17), (10, 2, 0, 3), (12, 4, 0, 22), (14, 5, 0, 29)]
    assert sorted(r.doc_id for r in drop_leaks(docs, benchmark).collect()) == [11, 13, 15]
