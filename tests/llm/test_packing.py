import random
import sys
import zlib
from collections import defaultdict
from fractions import Fraction
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from framewright.llm import packing, shingles
from framewright.llm.packing import Schedule, WordTokenizer, pack
from framewright.llm.queries import tokenizer_file

from .util import ROWS, documents


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(tokenizer_file())


def test_schedule_is_the_sorted_order_of_due_times():
    rng = random.Random(0)
    for _ in range(150):
        totals = [rng.randint(1, 60) for _ in range(rng.randint(1, 6))]
        rates = totals if rng.random() < 0.5 else [rng.randint(1, 5) for _ in totals]
        window, place = rng.randint(1, 20), {}
        order = sorted((Fraction(2 * t + 1, rates[q]), q, t) for q in range(len(totals)) for t in range(totals[q]))
        for w in range(-(-len(order) // window)):
            for i, (q, t) in enumerate(sorted((q, t) for _, q, t in order[w * window : (w + 1) * window])):
                place[q, t] = w * window + i
        schedule = Schedule(totals, rates, window)
        assert all(schedule.place(q, t)[0] == at for (q, t), at in place.items())


def test_every_window_has_the_mixture():
    totals, window = [700_000, 200_000, 99_990, 10], 2048 * 8
    schedule = Schedule(totals, totals, window)
    for w in range(-(-sum(totals) // window)):
        done = min((w + 1) * window, sum(totals))
        assert all(abs(s - t * done / sum(totals)) <= 1 for s, t in zip(schedule.served(w + 1), totals, strict=True))


def test_short_way_is_the_tokenizer(reference):
    rng = random.Random(5)
    letters = "aAzZé É İıſßẞ'sS tT rRe\n\t   ́éΣσςÅKÅ한글नि12٣²½<|endoftext|>…—!?,.;:\"'#_-\x1c\x85😀ǅñÑİ·ªº"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["it's don't we'll 'sabc ''s o'reilly's x'", "<|startoftext|> a<|endoftext|>b", "y" * 5000, "", " \n ", "Word. word, WORD!"]
    ours = WordTokenizer(tokenizer_file())
    assert ours.pattern
    for _ in range(2):
        got = [np.frombuffer(x, ours.width).tolist() for x in ours.encode(texts)]
        assert got == [reference.encode(t, add_special_tokens=False).ids for t in texts]


def check(rows, pieces, reference, sequence=2048):
    by, seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by[p.doc_id].append(p)
        seq[p.sequence_id].append(p)
    want = defaultdict(list)
    for i, t in rows:
        want[i].append([*reference.encode(t or "", add_special_tokens=False).ids, packing.END_ID])
    for i, texts in want.items():
        got = [tuple(np.frombuffer(p.ids, "<u4").tolist()) for p in by[i]]
        assert sum(map(len, got)) == sum(map(len, texts))
        for p, x in zip(by[i], got, strict=True):
            assert p.length == len(x) and any(len(t) == p.doc_tokens and tuple(t[p.start : p.start + p.length]) == x for t in texts)
    assert sorted(seq) == list(range(len(seq)))
    for s, ps in seq.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == sequence or s == len(seq) - 1 and at <= sequence


def test_round_trip(spark, reference):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["alpha", "Beta", "g4mma,", "δ"]) for _ in range(rng.randrange(900))), rng.choice(["a", "a", "a", "b", None, ""])) for i in range(300)]
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for shares in (None, {"a": 1, "b": 5}):
        out = pack(df.repartition(7), tokenizer_file(), shares, window_sequences=2)
        check([r[:2] for r in rows], out.collect(), reference)
    got = out.selectExpr("crc32(ids) c", "ids").first()
    assert got.c == zlib.crc32(got.ids)


def tokens_by_source(rows, pieces, sequences):
    source, out = {i: s for i, _, s in rows}, defaultdict(int)
    for p in pieces:
        if p.sequence_id in sequences:
            out[source[p.doc_id]] += p.length
    return out


@pytest.mark.parametrize("max_queues", [4096, 5])
def test_stated_shares_hold_with_many_other_sources(spark, reference, max_queues):
    """8 : 1 : 1 among the named ones, and 1 for each of the others, in a queue of its own or in one of a few."""
    rows = [(i, "text " * (i % 40), f"s{i}") for i in range(80)] + [(1000 + i, "alpha beta " * 200, "abc"[i % 3]) for i in range(90)]
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    shares = {"a": 80, "b": 10, "c": 10, **{f"s{i}": 0 for i in range(40)}}
    pieces = pack(df, tokenizer_file(), shares, sequence=100, window_sequences=3, max_queues=max_queues).collect()
    check([r[:2] for r in rows], pieces, reference, 100)
    window = max(3, len({p[2] for p in rows}) if max_queues > 100 else 3 + 40 + 5)
    got = tokens_by_source(rows, pieces, range(window))
    assert abs(got["a"] - 8 * got["b"]) <= 9 and abs(got["b"] - got["c"]) <= 1 and got["b"]
    assert not any(got[f"s{i}"] for i in range(40)) and any(got[f"s{i}"] for i in range(40, 80))


def test_a_share_of_nothing_comes_last(spark, reference):
    rows = [(i, "word " * 300, "abc"[i % 3]) for i in range(60)]
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    pieces = pack(df, tokenizer_file(), {"a": 0}, window_sequences=1, sequence=512).collect()
    check([r[:2] for r in rows], pieces, reference, 512)
    whole = 40 * 301 // (3 * 512) * 3  # sequences of windows of three, one a queue
    assert tokens_by_source(rows, pieces, range(whole))["a"] == 0
    with pytest.raises(ValueError):
        pack(df, tokenizer_file(), {"a": -1})


def test_schedule_is_a_deficit_round_robin():
    """Against the literal algorithm: every window credits each queue its part, serves whole tokens, and carries what is left."""
    rng = random.Random(8)
    for _ in range(60):
        rates = [rng.randint(1, 30) for _ in range(rng.randint(2, 6))]
        window = rng.randint(20, 400)
        totals = [10_000 * r for r in rates]  # none runs dry here
        schedule, deficit, served = Schedule(totals, rates, window), [Fraction(0)] * len(rates), [0] * len(rates)
        for w in range(1, 30):
            deficit = [d + Fraction(window * r, sum(rates)) for d, r in zip(deficit, rates, strict=True)]
            send = [int(d) for d in deficit]
            for s in sorted(range(len(rates)), key=lambda s: (send[s] - deficit[s], s))[: window - sum(send)]:
                send[s] += 1  # the window is filled by those to whom most is owed
            deficit = [d - n for d, n in zip(deficit, send, strict=True)]
            served = [a + n for a, n in zip(served, send, strict=True)]
            assert sum(served) == w * window == sum(schedule.served(w))
            assert all(abs(a - b) <= 1 for a, b in zip(served, schedule.served(w), strict=True))


def test_hard_cases(spark, reference):
    out = pack(documents(spark, extra=("before", "ids", "base", "begin")), tokenizer_file())
    check([r[:2] for r in ROWS], out.collect(), reference)
    assert pack(documents(spark).limit(0), tokenizer_file()).count() == 0


def test_the_tokenizer_remembers_a_bounded_number_of_pieces(monkeypatch, reference):
    monkeypatch.setattr(packing, "PIECES_HELD", 500)
    ours, rng = WordTokenizer(tokenizer_file()), random.Random(6)
    for _ in range(5):
        texts = [" ".join("".join(rng.choices("abcdé", k=7)) + rng.choice(["", ",", "'s"]) for _ in range(100)) for _ in range(4)] + ["z" * 300, None]
        got = [np.frombuffer(x, ours.width).tolist() for x in ours.encode(texts)]
        assert got == [reference.encode(t or "", add_special_tokens=False).ids for t in texts]
        pieces = {x for t in texts if t for x in t.split(" ")}
        for memory in (ours.known, ours.words):
            assert len(memory.keys) == len(memory.values) <= 500 + len(pieces)
            assert "z" * 300 not in memory.keys.to_pylist()


def test_python_does_not_see_known_pieces_one_by_one():
    ours, calls = WordTokenizer(tokenizer_file()), []
    texts = pa.array([f"Word, of text {i % 7}\nand more." for i in range(5000)])
    first, _ = ours.encode_column(texts)
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        again, ends = ours.encode_column(texts)
    finally:
        sys.setprofile(None)
    assert len(calls) < 1000 and again.tolist() == first.tolist() and len(ends) == 5001 and ends[-1] == len(again)


def test_portions_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(packing, "PORTION_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"body": ["x" * n if n is not None else None for n in (4, 6, 0, None, 1, 30, 9, 2)]})
    parts = list(packing._portions([batch, batch.slice(0, 0), batch.slice(5, 2)], 0))
    assert [p.num_rows for p in parts] == [4, 1, 1, 1, 1, 1, 1]
    assert pa.Table.from_batches(parts) == pa.Table.from_batches([batch, batch.slice(5, 2)])


def test_a_worker_gives_free_memory_back_after_a_task(monkeypatch):
    given = []
    pool = SimpleNamespace(release_unused=lambda: given.append(True))
    monkeypatch.setattr(shingles, "pa", SimpleNamespace(default_memory_pool=lambda: pool))
    batch = pa.RecordBatch.from_pydict({"x": list(range(600))})
    assert [b.num_rows for b in shingles.slices([batch])] == [250, 250, 100] and given
