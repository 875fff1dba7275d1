import random

from framewright.llm import quality
from framewright.llm.empirical_bayes import STRENGTH
from framewright.llm.quality import filter_quality, score_documents

from .util import ALL_IDS, documents, ids


def corpus(n=1200, seed=2):
    """Clean, toxic, shouting and repeating documents; half of them labelled."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(500)]
    toxic = ["vilefoo", "crudbar", "nastyqux"]
    rows, labels = [], []
    for i in range(n):
        words, kind = [rng.choice(vocabulary) for _ in range(rng.randrange(30, 200))], rng.random()
        bad = tox = False
        if kind < 0.15:
            words[rng.randrange(len(words))] = rng.choice(toxic)
            words[rng.randrange(len(words))] = rng.choice(toxic) + rng.choice(vocabulary)
            tox = True
        elif kind < 0.25:
            words, bad = [w.upper() + "!!" for w in words], True
        elif kind < 0.32:
            words, bad = words[:2] * 40, True
        rows.append((i, " ".join(words), None))
        labels.append((i, int(not bad), int(tox)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    known = spark.createDataFrame(labels[:800], "doc_id long, quality int, toxic int").selectExpr("*", "'clash' text")
    kept = {r.doc_id for r in filter_quality(documents(spark, rows, extra=("p_site",)), known).collect()}
    held = labels[800:]
    bad = [i for i, q, t in held if not q or t]
    clean = [i for i, q, t in held if q and not t]
    assert sum(i not in kept for i in bad) >= 0.95 * len(bad)
    assert sum(i in kept for i in clean) >= 0.99 * len(clean)


def test_sparse_sites_shrink_towards_the_corpus(spark):
    rows, labels = corpus(600)
    source = {i: "bad" if (not q or t) and i % 2 else f"site{i % 5}" if i % 50 else f"lone{i}" for i, q, t in labels}
    df = spark.createDataFrame([(i, t, "en", source[i], 0) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = score_documents(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    sites = {r.source: r.p_site for r in got}
    overall = sum(r.p_document for r in got) / len(got)
    assert sites["bad"] > 0.9
    lone = [(r.p_document, r.p_site) for r in got if r.source.startswith("lone")]
    assert all(abs(s - overall) < abs(p - overall) for p, s in lone if abs(p - overall) > 0.05)


def plain_shrink(level, parent, up):
    """Posterior mean and prior strength of each site, by a plain loop; level and parent are name -> (n, bad) and name -> mean."""
    seen = [(n, bad, parent[up(s)]) for s, (n, bad) in level.items()]
    q = sum(n * (bad / n - m) ** 2 for n, bad, m in seen)
    e0, e1 = sum(m * (1 - m) for _, _, m in seen), sum(n * m * (1 - m) for n, _, m in seen)
    k = min(max((e1 - e0) / (q - e0) - 1, STRENGTH[0]), STRENGTH[1]) if q > e0 else STRENGTH[1]
    return {s: (parent[up(s)] * k + bad) / (k + n) for s, (n, bad) in level.items()}, k


def test_posteriors_against_plain_loops(spark, monkeypatch):
    """p_site and p_bad from p_document alone, leaving each document out of its path and host; both ways of the join."""
    rng = random.Random(5)
    rows, labels = corpus(500, 7)
    site = {i: (rng.choice(["a", "a", "a", "b", f"lone{i}"]), rng.choice(["x", "x", "y", f"p{i}"])) for i, _, _ in rows}
    df = spark.createDataFrame([(i, t, site[i][1], site[i][0], 0) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for short in (True, False):
        if not short:
            monkeypatch.setattr(quality, "small", lambda d: d)
        got = {r.doc_id: r for r in score_documents(df, known, columns=["doc_id"]).collect()}
        p = {i: round(min(max(r.p_document, 1e-6), 1 - 1e-6) * 1e6) / 1e6 for i, r in got.items()}
        paths, hosts = {}, {}
        for i, (h, d) in site.items():
            for table, key in ((paths, (h, d)), (hosts, h)):
                n, bad = table.get(key, (0, 0.0))
                table[key] = n + 1, bad + p[i]
        whole = (sum(p.values()) + 0.5) / (len(p) + 1)
        host_means, host_k = plain_shrink(hosts, {0: whole}, lambda _: 0)
        _, path_k = plain_shrink(paths, host_means, lambda s: s[0])
        for i, (h, d) in site.items():
            n, bad = hosts[h]
            above = (whole * host_k + bad - p[i]) / (host_k + n - 1)
            n, bad = paths[h, d]
            mean = (above * path_k + bad - p[i]) / (path_k + n - 1)
            odds = got[i].p_document / (1 - got[i].p_document) * mean / (1 - mean) * (1 - whole) / whole
            assert abs(got[i].p_site - mean) < 1e-6 and abs(got[i].p_bad - odds / (1 + odds)) < 1e-6
        kept = {r.doc_id: r for r in filter_quality(df, known).collect()}
        assert set(kept) == {i for i, r in got.items() if r.p_bad < quality.REJECT} and len(kept) < len(rows)
        assert all(kept[i].text == t and kept[i].source == site[i][0] for i, t, _ in rows if i in kept)


def test_a_lone_site_does_not_confirm_itself(spark):
    rows, labels = corpus(400, 3)
    df = spark.createDataFrame([(i, t, "en", f"site{i}", 0) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = score_documents(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert max(r.p_site for r in got) - min(r.p_site for r in got) < 0.01


def test_short_words_are_features(spark):
    rows, labels = corpus(600, 4)
    rows = [(i, t + (" zq" if i % 9 == 0 else ""), None) for i, t, _ in rows]
    labels = [(i, q, int(t or i % 9 == 0)) for i, q, t in labels]
    model = quality.train(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert "zq" in model.words


def test_hard_cases(spark):
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = score_documents(documents(spark, extra=("_host", "_whole", "p_bad")), nothing).collect()
    assert ids(r.doc_id for r in got) == ALL_IDS and len({r.p_document for r in got}) == 1
    odd = spark.createDataFrame([(None, 1, 0), (3, None, 1), (4, 0, 1), (4, 0, 1), (5, 1, 0), (2, 1, 0)], nothing.schema)
    got = score_documents(documents(spark).selectExpr("* except (source, lang)", "cast(null as string) source", "cast(null as string) lang"), odd).collect()
    assert ids(r.doc_id for r in got) == ALL_IDS and all(0 < r.p_bad < 1 for r in got)
    assert score_documents(documents(spark).limit(0), odd).count() == 0
    kept = filter_quality(documents(spark, extra=("p_bad", "p_document", "k")), nothing)
    assert kept.columns == documents(spark, extra=("p_bad", "p_document", "k")).columns and set(ids(r.doc_id for r in kept.collect())) <= set(ALL_IDS)


def test_features_take_whole_texts():
    model = quality.Classifier({"vilefoo": 9.0}, [], [], 0.5)
    assert model.features(b"word " * 100_000 + b"VILEFOO!")[0] == 9.0
