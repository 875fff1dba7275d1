import hashlib
from collections import defaultdict

from framewright.llm import common
from framewright.llm.exact_dedup import exact_dedup

from .util import ALL_IDS, ROWS, documents, ids

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_against_brute_force(spark):
    rows = ROWS + [(100 + i, f"{'A' if i % 2 else 'a'} text of group {i // 7}", None) for i in range(60)] + [(200, "É", None), (201, "é", None)]
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()].append(i)
    got = exact_dedup(documents(spark, rows), digest=True).collect()
    assert len(got) == len(rows)
    for r in got:
        members = groups[r.text_sha256]
        keep = max((m for m in members if m is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(members), r.doc_id == keep)


def test_without_digests_and_empty(spark):
    got = exact_dedup(documents(spark))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept"]
    assert ids(r.doc_id for r in got.collect()) == ALL_IDS
    assert exact_dedup(documents(spark).limit(0), digest=True).count() == 0


def test_a_hot_group(spark, monkeypatch):
    """A third of all rows with one text, more than a task should get, among unique ones that meet no join."""
    monkeypatch.setattr(common, "HOT_ROWS", 100)
    rows = [(i, "Copied text" if i % 3 == 0 else f"unique {i}", None) for i in range(3000)]
    got = {r.doc_id: r for r in exact_dedup(documents(spark, rows)).collect()}
    assert len(got) == 3000
    assert all((r.keep_id, r.group_size, r.kept) == ((2997, 1000, i == 2997) if i % 3 == 0 else (i, 1, True)) for i, r in got.items())
