"""URL rules and nearest vectors against brute force."""

import numpy as np

from obsflow.llm import nearest, url_filter

URLS = [
    None, "", "no scheme", "http://", "http:///x", "https://A.Example.NET/en/x", "https://example.net/en", "https://net/",
    "http://xnet/", "http://a.b.net/de/?q=://x", "x://y://net/", "http://example.com/de/a/b/c", "http://example.com/de",
    "http://org/fr/", "http://a.org#f", "http://é.org/fr/x", "http://www.example.net./en/", "http://..net/", "http://net?x/",
    "http://" + "a." * 500 + "net/" + "p" * 5000,
]
RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/x", "block"), ("example.com", "/de/", "block"),
    ("example.com", "/de/a/", "allow"), ("example.com", "/de/a/b", "block"), ("org", "/fr/", "allow"), ("org", "", "block"),
    ("NET", "/", "allow"), (None, "/", "block"), ("example.com", "/de/b/", "allow"), ("com", "/de/", "block"),
]


def brute(url, rules):
    rest = url.partition("://")[2] if url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    actions = {}
    for h, p, a in rules:
        if h is not None:
            actions[h.lower(), p] = max(a, actions.get((h.lower(), p), ""))
    fits = [(len(h + p), len(h), h + p, a) for (h, p), a in actions.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_paths_with_the_last_character(spark):
    rules = [("net", "a", "block"), ("net", "a\U0010ffffb", "allow"), ("net", "a\U0010ffff", "block"), ("net", "a\U0010ffff\U0010ffff", "allow")]
    rules = [(h, "/" + p, a) for h, p, a in rules]
    urls = ["http://x.net/a\U0010ffffc", "http://net/a\U0010ffff\U0010ffffc", "http://net/a\U0010ffffb/x", "http://net/ab", "http://net/b"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = url_filter.filter_urls(pages, spark.createDataFrame(rules, "host string, path string, action string"))
    assert sorted(tuple(r) for r in found.collect()) == [(i, *brute(u, rules)) for i, u in enumerate(urls)]


def test_urls(spark):
    rows = [(i, u, "x", "clash") for i, u in enumerate(URLS)] + [(5, URLS[5], "x", "clash"), (None, URLS[9], "x", "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rule string").repartition(3)
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    out = sorted((tuple(r) for r in url_filter.filter_urls(pages, rules).collect()), key=repr)
    assert out == sorted(((i, *brute(u, RULES)) for i, u, *_ in rows), key=repr)
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages, rules.limit(0)).collect()} == {"allow"}


def exact(rows, every, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if i % every == 0:
            scored = sorted(((-float(v @ w), j) for j, w in good if j != i))
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def test_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(1200)]
    rows += [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] * 8), (2003, [None] * 8), (None, [1.0] * 8)]
    rows += [(3000 + i, rows[7][1]) for i in range(30)]  # ties
    frame = spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id long, embedding array<float>, rank int, score string").repartition(3)
    rows = [(i, [None if x is None else float(np.float32(x)) for x in v] if v else v) for i, v in rows]
    found = {}
    for r in nearest.nearest_vectors(frame, recall=1.0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    true = exact(rows, 20, 20)
    assert set(found) == set(true)
    hits = 0
    for q, rows_ in found.items():
        rows_.sort()
        assert [r for r, _, _ in rows_] == list(range(1, 21))
        hits += len({v for _, v, _ in rows_} & {v for v, _ in true[q]})
    assert hits / (20 * len(true)) > 0.97
    few = frame.where("vec_id IN (0, 3, 2001)")
    assert [(r.query_id, r.vec_id) for r in nearest.nearest_vectors(few).collect()] == [(0, 3)]
    assert nearest.nearest_vectors(frame.limit(0)).count() == 0
    assert nearest.nearest_vectors(frame.where("vec_id = 3")).count() == 0


def test_every_query_gets_k_rows(spark):
    both = lambda k: np.tile(np.eye(4)[k], 2)
    rows = [(i, both(i % 2).tolist()) for i in range(1, 1500)]  # two groups of copies
    rows += [(3000, (-0.01 * both(2)).tolist())]  # outliers, short so that they are no one's neighbours
    rows += [(3020, (-0.01 * both(3)).tolist())] * 30  # more rows of its own than k
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    counts = {r.query_id: r["count"] for r in nearest.nearest_vectors(frame).groupBy("query_id").count().collect()}
    assert counts == {i: 20 for i, _ in rows if i % 20 == 0}


def test_few_candidates_are_all_found(spark):
    rng = np.random.default_rng(5)
    for n in (2, 9, 21):
        rows = [(20 * i, rng.standard_normal(8).tolist()) for i in range(n)]
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
        found = {}
        for r in nearest.nearest_vectors(frame).collect():
            found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
        assert {q: [v for _, v in sorted(x)] for q, x in found.items()} == {q: [v for v, _ in x] for q, x in exact(rows, 20, 20).items()}


def test_query_recall(spark, sf_dir):
    from obsflow.llm.queries import QUERIES

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    true, found = exact(rows, 20, 20), {}
    for r in QUERIES["op9_nearest_vectors"](spark, sf_dir).collect():
        found.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = sum(len(found[q].keys() & {v for v, _ in best}) for q, best in true.items())
    assert hits / sum(map(len, true.values())) >= 0.9


def test_ties_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(12)
    base = rng.standard_normal((800, 64)).astype(np.float32).astype(float)
    rows = [(i, base[i].tolist()) for i in range(800)] + [(800 + i, base[3 + i % 2].tolist()) for i in range(400)]  # two vectors, 201 times each
    rows += [(5000, []), (5001, [1.0] * 63), (5020, [1.0] * 65)]
    true = exact([r for r in rows if r[0] < 5000], 20, 20)
    for parts in (1, 7):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)
        found = {}
        for r in nearest.nearest_vectors(frame, recall=1.0).collect():
            found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        assert set(found) == set(true)
        for q, got in found.items():
            v = np.array(dict(rows)[q])
            ordered = [(i, s) for _, i, s in sorted(got)]
            assert ordered == sorted(ordered, key=lambda x: (-x[1], x[0]))
            score = {}
            for i, s in ordered:
                assert abs(s - float(v @ np.array(rows[i][1]))) < 1e-9
                score.setdefault(tuple(rows[i][1]), set()).add(s)
            assert all(len(s) == 1 for s in score.values())  # equal vectors, equal scores
            for same in (3, 4):
                copies = [same, *range(797 + same, 1200, 2)]
                taken = [i for i, _ in ordered if i in copies]
                assert taken == [i for i in copies if i != q][: len(taken)]
