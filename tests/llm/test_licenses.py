import random
import textwrap

from framewright.llm import licenses
from framewright.llm.licenses import CONTAINMENT, TEMPLATES, scan_licenses
from framewright.llm.shingles import windows


def brute(text):
    """Templates of which the whole text holds enough within a run of twice the template's length."""
    shingles = windows(licenses._words((text or "").encode()), 3)
    found = set()
    for i, (_, template) in enumerate(TEMPLATES):
        want = set(windows(licenses._words(template.encode()), 3).tolist())
        if len(want.intersection(shingles.tolist())) < CONTAINMENT * len(want):
            continue  # not even the whole text holds enough
        for at in range(max(1, len(shingles))):
            if len(want & set(shingles[at : at + len(want)].tolist())) >= CONTAINMENT * len(want) and len(shingles):
                found.add(i)
    return found


def test_planted_notices_are_found_and_nothing_else(spark):
    rng = random.Random(3)
    words = ["all", "rights", "license", "the", "under", "licensed", "version", "x", "y", "z", "public"]
    rows = []
    for i in range(300):
        body = [rng.choice(words) for _ in range(rng.randrange(0, 400))]
        for t in rng.sample(range(len(TEMPLATES)), rng.randrange(3)):
            at = rng.randrange(len(body) + 1)
            body[at:at] = TEMPLATES[t][1].upper().split() if rng.random() < 0.5 else TEMPLATES[t][1].split()
        rows.append((i, " ".join(body)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {}
    for r in scan_licenses(docs).collect():
        found.setdefault(r.doc_id, set()).add(r.template)
        assert 0 <= r.first_word <= r.last_word and r.containment >= CONTAINMENT
    missed = sum(len(brute(t) - found.get(i, set())) for i, t in rows)
    total = sum(len(brute(t)) for _, t in rows)
    assert total > 200 and missed <= total * 0.005


def test_nulls_ties_and_empty(spark):
    docs = spark.createDataFrame(
        [(None, "All rights reserved."), (1, None), (2, ""), (3, "all RIGHTS, reserved!"), (3, "All rights reserved. " * 50_000)],
        "doc_id long, text string",
    ).selectExpr("*", "'z' license", "'q' template")
    out = sorted(str((r.doc_id, r.license, r.containment)) for r in scan_licenses(docs).collect())
    assert out == ["(3, 'proprietary', 1.0)", "(3, 'proprietary', 1.0)", "(None, 'proprietary', 1.0)"]
    assert scan_licenses(docs.limit(0)).count() == 0


def test_complete_texts(spark):
    """Every complete text is found, wrapped and with other words around, and so is the notice that it begins with."""
    whole = [(i, n, t) for i, (n, t) in enumerate(TEMPLATES) if len(t) > 500]
    assert {"MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "Unlicense", "Apache-2.0", "GPL-3.0"} <= {n for _, n, _ in whole}
    rows = [(i, "some words before\n" + "\n    ".join(textwrap.wrap(t, 60)) + "\nand after it") for i, _, t in whole]
    found = {(r.doc_id, r.template) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {(i, i) for i, _, _ in whole} <= found
    assert (11, 7) in found and TEMPLATES[11][0] == "MIT"
