import random
import struct

import xxhash

from framewright.llm.line_dedup import DIVISOR, LEAST_WORDS, LONG_LINE, PASSAGE_WORDS, WINDOW, Rules, dedup_lines

from .util import ALL_IDS, documents, ids

MASK = (1 << 64) - 1


def counted(text):
    """Lines, and words of each; a blank line has none."""
    lines = text.split("\n")
    return lines, [x.strip(" ").count(" ") + 1 if x.strip(" ") else 0 for x in lines]


def chunks(text):
    """Chunks by a plain loop: (first line, lines, may be removed)."""
    lines, words = counted(text)
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in lines]
    out, run = [], []
    for at in range(len(lines)):
        run.append(at)
        rolled = 0
        for back in range(min(WINDOW, at + 1)):
            x = hashes[at - back]
            rolled ^= ((x << back) | (x >> (64 - back))) & MASK if back else x
        mixed = xxhash.xxh64_intdigest(struct.pack("<Q", rolled), seed=42)
        mixed -= (mixed >> 63) << 64
        if at == len(lines) - 1 or words[at] >= LONG_LINE or words[at + 1] >= LONG_LINE or mixed % DIVISOR == 0:
            total = sum(words[i] for i in run)
            out.append((run[0], len(run), len(run) > 1 and total >= LEAST_WORDS or total >= LONG_LINE))
            run = []
    return out


def passages(text):
    """(first line, lines) of the least runs of short lines with PASSAGE_WORDS, from each line on and from each line back."""
    _, words = counted(text)
    found = set()
    for begin in range(len(words)):
        for step in (1, -1):
            total, at = 0, begin
            while words[begin] and 0 <= at < len(words) and words[at] < LONG_LINE:
                total += words[at]
                if total >= PASSAGE_WORDS:
                    found.add((min(begin, at), abs(at - begin) + 1))
                    break
                at += step
    return found


def brute(rows):
    """Texts without the lines of repeated chunks and passages, by a plain loop; of equal ones the first stays with what it overlaps."""
    first, units = {}, {}
    for i, text in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        lines = text.split("\n")
        units[i] = [("chunk", s, n) for s, n, may in chunks(text) if may] + [("passage", s, n) for s, n in passages(text)]
        for kind, start, n in sorted(units[i], key=lambda u: u[1]):
            first.setdefault((kind, "\n".join(lines[start : start + n])), (i, start))
    out = {}
    for i, text in rows:
        if text is not None:
            lines, gone = text.split("\n"), set()
            for kind, start, n in units[i]:
                doc, at = first[kind, "\n".join(lines[start : start + n])]
                if doc != i or start >= at + n:
                    gone.update(range(start, start + n))
            out[i] = "\n".join(line for at, line in enumerate(lines) if at not in gone)
    return out


def test_against_brute_force(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    passage = " ".join(f"word{i}" for i in range(60))
    rows = []
    for i in range(200):
        lines = [rng.choice(pool) + (str(rng.randrange(50)) if rng.random() < 0.6 else "") for _ in range(rng.randrange(12))]
        if rng.random() < 0.4:
            lines.insert(rng.randrange(len(lines) + 1), passage)
        if rng.random() < 0.3:
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = pool[:8]
        rows.append((i, "\n".join(lines)))
    want = brute(rows)
    got = {r.doc_id: r for r in dedup_lines(documents(spark, [(*r, None) for r in rows])).collect()}
    assert {i: r.text for i, r in got.items()} == want
    changed = [r for r in got.values() if r.removed_chunks]
    assert changed and all(r.copies_of and r.removed_lines >= r.removed_chunks for r in changed)
    assert sum(passage in r.text for r in got.values()) == 1
    assert all((r.text != dict(rows)[r.doc_id]) == (r.removed_chunks > 0) for r in got.values())


def test_hard_cases(spark):
    got = dedup_lines(documents(spark, extra=("mark", "copies_of", "again", "numbers", "_bucket", "_chunks"))).collect()
    assert ids(r.doc_id for r in got) == ALL_IDS
    assert all(r.removed_chunks == 0 and r["mark"] == "clash" for r in got)
    line = " ".join(["w"] * 80)
    twice = [(1, line, None), (1, line, None), (2, f"{line}\n{line}", None), (None, line, None)]
    got = dedup_lines(documents(spark, twice)).collect()
    assert sorted((r.doc_id or 0, len(r.text)) for r in got) == [(0, len(line)), (1, 0), (1, 0), (2, 0)]
    assert dedup_lines(documents(spark).limit(0)).count() == 0


def test_passages_of_short_lines(spark):
    """Runs of 2 to 6 short lines that hold 50 words go whole; those of fewer words, and what is around, stay."""
    rng = random.Random(7)

    def line(words):
        return " ".join(f"w{rng.randrange(10**9)}" for _ in range(words))

    rows, want = [], []
    for case, (lines, words) in enumerate([(2, 30), (2, 25), (3, 40), (4, 30), (5, 10), (6, 9), (6, 30)]):
        passage = [line(words) for _ in range(lines)]
        uneven = [*passage[:1], "", *passage[1:], line(3)]
        for copy in range(6):
            around = [line(30), line(30)], [line(30), line(30)]
            rows.append((100 * case + copy, "\n".join([*around[0], *uneven, *around[1]])))
            want.append("\n".join([*around[0], *(() if copy else uneven), *around[1]]))
    got = {r.doc_id: r for r in dedup_lines(documents(spark, [(*r, None) for r in rows])).collect()}
    for (i, _), text in zip(rows, want):
        assert got[i].text == text, i
        assert (i // 100 * 100 in got[i].copies_of) == (got[i].removed_chunks > 0) == (i % 100 > 0), i

    pair = [line(24), line(24)]  # a passage only with a line that differs; chunks may take it, passages may not
    apart = [(i, "\n".join([line(30), *pair, line(30)])) for i in range(8)]
    got = {r.doc_id: r.text for r in dedup_lines(documents(spark, [(*r, None) for r in apart])).collect()}
    assert got == brute(apart)


def test_a_passage_within_its_own_text(spark):
    """The first copy stays whole, whatever overlaps it, and blank lines are no words."""
    one = " ".join(f"w{i}" for i in range(10))
    text = "\n".join([one] * 20)
    blanks = [(i, f"head{i}\n" + "\n" * 60 + f"tail{i}") for i in (2, 3)]
    got = {r.doc_id: r for r in dedup_lines(documents(spark, [(1, text, None), *((*r, None) for r in blanks)])).collect()}
    assert got[1].text == "\n".join([one] * 5) and got[1].removed_lines == 15 and got[1].copies_of == [1]
    assert {i: got[i].text for i, _ in blanks} == brute(blanks)


def test_a_short_repeat_of_two_lines(spark):
    """Two lines of a word each are a repeat like any; blank lines alone never are, and `least_words` can ask for more."""
    rng = random.Random(3)
    alone = lambda: " ".join(f"w{rng.randrange(10**9)}" for _ in range(60))
    rows = [(i, f"{alone()}\nyes\nno\n{alone()}") for i in range(20)] + [(i, f"{alone()}\n\n\n{alone()}") for i in (100, 101)]
    df = documents(spark, [(*r, None) for r in rows])
    got = {r.doc_id: r.text for r in dedup_lines(df).collect()}
    assert got == brute(rows)
    whole = [i for i, t in rows if any((s, n) == (1, 2) for s, n, _ in chunks(t)) and i < 20]  # no boundary falls between the two
    assert len(whole) > 2 and [i for i in whole if "yes" in got[i]] == whole[:1]
    assert {r.doc_id: r.text for r in dedup_lines(df, rules=Rules(least_words=3)).collect()} == dict(rows)


def test_a_hot_chunk(spark):
    """A passage in two thirds of many rows, with some bytes longer than others."""
    passage = "\n".join(" ".join(f"p{i}x{j}" for j in range(20)) for i in range(4))
    rows = [(i, f"only{i} a b c\n{passage}" if i % 3 else f"only{i} d e f\ng{i}") for i in range(3600)]
    got = {r.doc_id: r.text for r in dedup_lines(documents(spark, [(*r, None) for r in rows])).collect()}
    assert got == brute(rows)
