"""Operators over whole small tables, against brute force."""

import collections
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from colloquy.llm import ann, components, curriculum, gam_quality, simhash, url_boost

SMALL = "/root/testdata/sf0.001"


def reachable(items, linked):
    """Smallest item reachable from each, by walking all pairs."""
    root = {}
    for item in sorted(items):
        if item in root:
            continue
        todo = [item]
        while todo:
            at = todo.pop()
            if at not in root:
                root[at] = item
                todo += [x for x in items if x not in root and linked(at, x)]
    return root


def test_components_of_long_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)]
    found = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    both = collections.defaultdict(set)
    for a, b in edges:
        if a != b:
            both[a].add(b)
            both[b].add(a)
    assert found == reachable(set(both), lambda x, y: y in both[x])
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for gap in "\t\n\x0b\x0c\r":
        words = words.replace(gap, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("bucket", [2, 2048])
def test_simhash_finds_every_link(spark, bucket):
    rng = random.Random(3)
    rows = []
    for group in range(6):
        base = [f"w{rng.randrange(999)}" for _ in range(180)]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(180)] = "X"
            rows.append(" ".join(copy))
    rows += [None, "", " \n", "one", "One", "ÀB c", "àb c", rows[0]]
    rng.shuffle(rows)
    table = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.grouped(table.withColumn("fp", F.lit("x")), bucket=bucket).collect()}
    prints = [slow_fingerprint(t) for t in rows]
    assert [got[i].fp % 2**64 for i in range(len(rows))] == prints
    near = lambda x, y: (prints[x] ^ prints[y]).bit_count() <= 4
    assert {i: got[i].component_id for i in got} == reachable(range(len(rows)), near)


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.masks()
    assert len(masks) == 31
    rng = random.Random(2)
    for _ in range(20_000):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
        assert any(m & flips == 0 for m in masks)


def test_one_of_each_keeps_the_smallest_key(documents):
    text = " ".join(f"w{i}" for i in range(90))
    rows = [(5, text, "a"), (None, text, "a"), (3, text, "b"), (3, text, "b"), (9, "other words here now", None), (None, None, None), (None, "", None)]
    got = simhash.one_of_each(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == [(0, ""), (3, text), (9, "other words here now")]
    assert simhash.one_of_each(documents([])).count() == 0


def reshared(sizes, weights, budget):
    """Targets by sharing excess again and again."""
    left, open_, target = budget, set(sizes), dict.fromkeys(sizes, 0.0)
    while True:
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / total > 2 * sizes[s] + 1e-9} if total else set()
        if not over:
            return target | {s: left * weights[s] / total for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over


def test_mix_meets_targets_in_schedule_order(documents):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(1, 60), rng.choice(["a"] * 9 + ["b", "c", "d", "é", None])) for i in range(1500)]
    rows += [(1, "w w", "a"), (1, "w w", "a"), (2000, None, "b"), (None, "w", "c")]
    got = [r.asDict() for r in curriculum.mixed(documents(rows), ["doc_id"]).collect()]
    assert got == [r.asDict() for r in curriculum.mixed(documents(rows[::-1]).repartition(7), ["doc_id"]).collect()]
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    expected = reshared(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    taken = collections.Counter()
    by_size = {(r["source_size"], round(r["target"], 6)) for r in got}
    assert by_size == {(sizes[s], round(expected[s], 6)) for s in sizes}
    for r in got:
        taken[r["source_size"], round(r["target"], 6)] += r["taken"]
        assert r["taken"] == r["size"] * r["copies"] and r["copies"] in (0, 1, 2)
    assert all(abs(t - n) <= 60 for (_, t), n in taken.items())
    times = [r["position"] for r in got if r["position"] is not None]
    assert times == sorted(times) and 0 <= times[0] and times[-1] <= 1
    assert curriculum.mixed(documents([]), ["doc_id"]).count() == 0
    assert curriculum.mixed(documents([(1, None, "a"), (2, "", None)]), ["doc_id"]).count() == 2


@pytest.mark.parametrize("knots", curriculum.SCHEDULES)
def test_schedule_time_inverts_the_integral(spark, knots):
    row = spark.range(101).select(curriculum.schedule_time(F.col("id") / 100, knots).alias("t")).collect()
    grid = np.linspace(0, 1, 20_001)
    weight = np.interp(grid, *zip(*knots))
    area = np.concatenate([[0], np.cumsum((weight[1:] + weight[:-1]) / 2)])
    found = np.interp([r.t for r in row], grid, area / area[-1])
    assert np.allclose(found, np.arange(101) / 100, atol=1e-6)


def test_training_order_repeats_rows(documents):
    rows = [(i, "w " * 10, "a" if i % 3 else "b") for i in range(60)]
    got = curriculum.in_training_order(documents(rows).withColumn("size", F.lit(1)))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "size"]
    assert abs(got.count() - 90) <= 2


def test_training_order_agrees_with_the_mix(documents):
    """Clashing columns, null and repeated rows: copies and order are those of ``mixed``."""
    rows = [(i, f"{i} " * (1 + i % 7), ["a", "b", None][i % 3]) for i in range(90)]
    rows += [(5, "x y", "a")] * 3 + [(None, "z", None), (None, None, "c"), (7, "", "b")]
    clash = {c: F.lit(0) for c in ("of", "range", "h", "k", "tie", "position", "target", "time")}
    docs = documents(rows).withColumns(clash)
    got = [r.doc_id for r in curriculum.in_training_order(docs).collect()]
    mix = curriculum.mixed(docs, ["doc_id"]).collect()
    times = sorted(t for r in mix for t in (r.position, r.position2) if t is not None)
    assert len(got) == len(times)
    assert collections.Counter(got) == collections.Counter(r.doc_id for r in mix for _ in range(r.copies))
    at = collections.defaultdict(set)
    for r in mix:
        at[r.doc_id] |= {r.position, r.position2}
    assert all(t in at[i] for i, t in zip(got, times))
    assert curriculum.in_training_order(docs.limit(0)).count() == 0


def test_urls_parse_and_rules_fit(spark):
    rules = [url_boost.UrlRule("allow", "com/"), url_boost.UrlRule("block", "a.com/x/")]
    urls = {
        "http://A.com/x/1?q=/y": ("a.com", "/x/1", "a.com/x/", "block"),
        "https://b.A.COM/X/1#z": ("b.a.com", "/X/1", "com/", "allow"),
        "ba.com/x/": ("", "", None, None),
        "x://ba.com/x/": ("ba.com", "/x/", "com/", "allow"),
        "http://c.com": ("c.com", "", None, None),
        "http://c.com?://d.com/": ("c.com", "", None, None),
        "http://ÀB.com/é": ("Àb.com", "/é", "com/", "allow"),
        "": ("", "", None, None),
        None: ("", "", None, None),
    }
    table = spark.createDataFrame([(u, "clash") for u in urls], "url string, host string")
    got = {r.u: r for r in url_boost.judged(table.withColumn("u", F.col("url")), ["u"], rules).collect()}
    for url, (host, path, rule, verdict) in urls.items():
        r = got[url]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert url_boost.judged(table.limit(0).withColumn("u", F.col("url")), ["u"], rules).count() == 0


def test_url_trees_learn_what_features_tell(spark):
    rng = random.Random(4)
    rows = []
    for i in range(1200):
        bad = rng.random() < 0.5
        path = "".join(rng.choice("0123456789") for _ in range(rng.randrange(8, 14))) if bad else "/".join(rng.choice(["about", "news", "team"]) for _ in range(3))
        known = "known" if i % 2 else "fresh"
        rows.append((i, f"http://{known}.org/{path}", bad))
    table = spark.createDataFrame(rows, "i long, url string, bad boolean")
    featured = url_boost.with_features(table, ["i", "bad"], "url", [])
    featured = featured.withColumn("ruled", F.expr("case when host = 'known.org' then if(bad, 'block', 'allow') end"))
    model = url_boost.fit(featured)
    got = model.joined(featured).where("ruled is null").select("bad", (model.margin() > 0).alias("said")).collect()
    assert np.mean([r.bad == r.said for r in got]) > 0.97


def test_suffix_alone_does_not_decide(spark):
    """Rules that follow the suffix: an unseen suffix is judged by what else tells the two apart."""
    rng = random.Random(6)
    rows = []
    for i in range(1500):
        suffix = rng.choice(["com", "net", "org"])
        bad = suffix == "net" or (suffix == "org" and rng.random() < 0.5)
        word = "".join(rng.choice("0123456789" if bad else "abcdefgh") for _ in range(8))
        rows.append((i, f"http://h{rng.randrange(40)}.{suffix}/{word}", bad))
    rules = [url_boost.UrlRule("allow", "com/"), url_boost.UrlRule("block", "net/")]
    table = spark.createDataFrame(rows, "i long, url string, bad boolean")
    got = [r for r in url_boost.judged(table, ["i", "bad"], rules).collect() if r.rule is None]
    assert np.mean([(r.verdict == "block") == r.bad for r in got]) > 0.97 and len({r.verdict for r in got}) == 2


def slow_lexical(url):
    rest = url.partition("://")[2] if "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    digits = lambda x: sum(c in "0123456789" for c in x)
    query = url.partition("?")[2].partition("#")[0]
    counts = collections.Counter(url)
    values = [
        len(url), len(host), len(path), len([x for x in path.split("/") if x]), host.count(".") + 1 if host else 0,
        digits(url) / len(url) if url else 0, digits(host) / len(host) if host else 0,
        -sum(n / len(url) * math.log2(n / len(url)) for n in counts.values()),
        len([x for x in query.split("&") if x]), host.count("-"),
        len(path.split("/")[1]) if path.startswith("/") else 0,
    ]
    return dict(zip(url_boost.LEXICAL, values)), host.rpartition(".")[2]


def test_url_scores_equal_a_walk_down_the_trees(spark):
    rng = random.Random(13)
    make = lambda: f"http://{rng.choice(['a-b', 'C9', 'd.e'])}.{rng.choice(['com', 'net', 'org'])}/" + "".join(
        rng.choice("ab12/&?=#") for _ in range(rng.randrange(25))
    )
    urls = ["", "x", "http://", *{make() for _ in range(400)}]
    featured = url_boost.with_features(spark.createDataFrame([(u,) for u in urls], "url string"), ["url"], "url", [])
    featured = featured.withColumn("ruled", F.when(F.col("f_digit_ratio") > 0.15, "block").when(F.col("f_depth") > 1, "allow"))
    model = url_boost.fit(featured)
    known = {r["__suffix"]: (r.s_rate, r.s_count) for r in model.suffixes.collect()}

    def walk(tree, x):
        while isinstance(tree, url_boost.Split):
            tree = tree.left if x[url_boost.FEATURES[tree.feature]] <= tree.edge else tree.right
        return tree

    assert model.trees
    for r in model.joined(featured).withColumn("m", model.margin()).collect():
        x, suffix = slow_lexical(r.url)
        assert all(abs(r[f"f_{k}"] - v) < 1e-9 for k, v in x.items()), r
        rate, count = known.get(suffix, (model.rate, 0))
        x |= {"suffix_rate": rate, "suffix_log_count": math.log1p(count), "entropy": r.f_entropy}
        assert abs(r.m - model.base - sum(walk(t, x) for t in model.trees)) < 1e-9


def slow_tree(g, h, leaves):
    spans = [list(range(len(g)))]
    worth = lambda s: sum(g[i] for i in s) ** 2 / (sum(h[i] for i in s) + gam_quality.SHRINK)
    while len(spans) < leaves:
        options = [(worth(s[:c]) + worth(s[c:]) - worth(s), s, c) for s in spans for c in range(1, len(s))]
        gain, s, c = max(options, key=lambda o: o[0], default=(0, None, 0))
        if gain <= 1e-9:
            break
        spans.remove(s)
        spans += [s[:c], s[c:]]
    return {i: sum(g[j] for j in s) / (sum(h[j] for j in s) + gam_quality.SHRINK) for s in spans for i in s}


def test_quality_trees_and_scores_equal_plain_sums():
    rng = np.random.default_rng(14)
    for leaves in (2, 3, 5):
        for _ in range(60):
            g, h = rng.normal(size=9), rng.random(9)
            slow = slow_tree(g.tolist(), h.tolist(), leaves)
            assert np.allclose(gam_quality._tree(g, h, leaves), [slow[i] for i in range(9)])
    x = rng.normal(size=(600, 4)).round(1)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = gam_quality.fit_gam(x, y)
    for row, score in zip(x.tolist(), model.score(x)):
        total = model.base
        for f, (edges, table) in enumerate(zip(model.edges, model.tables)):
            total += table[sum(e < row[f] for e in edges.tolist())]
        for a, b, table in model.pairs:
            total += table[sum(e < row[a] for e in model.coarse[a].tolist()), sum(e < row[b] for e in model.coarse[b].tolist())]
        assert abs(score - 1 / (1 + math.exp(-max(-30, min(30, total))))) < 1e-12
    assert np.mean((model.score(x) > 0.5) == y) > 0.9


def test_quality_model_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/../sf0.01/{t}.parquet") for t in ("documents", "labels"))
    usable = F.expr("crc32(cast(doc_id as string)) % 4 <> 2")
    scores = {r.doc_id: r.score for r in gam_quality.quality_scores(docs, labels, usable=usable).collect()}
    held = labels.where(~usable).collect()
    assert np.mean([(scores[r.doc_id] >= 0.7) == (r.quality == 1) for r in held]) > 0.95
    assert all(0 <= s <= 1 for s in scores.values()) and len(scores) == docs.count()


def test_quality_model_without_labels(spark, documents):
    labels = spark.createDataFrame([(0, None), (1, 7)], "doc_id long, quality int")
    docs = documents([None, "", "a b", "a b"]).withColumn("score", F.lit("x"))
    got = gam_quality.quality_scores(docs, labels).collect()
    assert len(got) == 4 and {r.score for r in got} == {0.5}
    assert gam_quality.quality_scores(documents([]), labels).count() == 0


def exact_nearest(rows, k):
    good = {i: np.array(v, float) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in good:
        if q % 20 == 0:
            scored = sorted((-float(good[q] @ v), i) for i, v in good.items() if i != q)
            out[q] = [i for _, i in scored[:k]]
    return out


def test_ann_ties_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(6)
    hot = [1.0, 0.5, 0.0, 0.25]
    rows = [(i, hot if i % 3 == 0 else (rng.integers(-4, 5, 4) / 4).tolist()) for i in range(300)]
    rows += [(400, None), (420, [0.0] * 4), (440, [1.0, None, 0.0, 0.0]), (460, [float("nan"), 1.0, 0.0, 0.0]), (480, [float("inf"), 1.0, 0.0, 0.0]), (0, hot)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    found = collections.defaultdict(list)
    for r in sorted(ann.nearest(table, F.col("id") % 20 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append(r.vec_id)
    assert found == exact_nearest(rows[:-1], 20)
    assert ann.nearest(table.limit(0), F.col("id") % 20 == 0).count() == 0


def test_ann_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 100)
    monkeypatch.setattr(ann, "QUERIES", 10)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.select("vec_id", "embedding").collect()]
    monkeypatch.setattr(ann, "PART", 150)
    best = exact_nearest(rows, 20)
    found = collections.defaultdict(set)
    for r in ann.nearest(table, F.col("id") % 20 == 0).collect():
        found[r.query_id].add(r.vec_id)
    assert np.mean([len(found[q] & set(ids)) / len(ids) for q, ids in best.items()]) >= 0.9


@pytest.mark.parametrize("most, budget", [(3, 2.5), (5, 4.2), (1, 0.6)])
def test_mix_takes_as_many_copies_as_it_is_allowed(documents, most, budget):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randrange(1, 40), rng.choice("aab")) for i in range(1200)]
    got = curriculum.mixed(documents(rows), ["doc_id"], most=most, budget=budget).collect()
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    assert max(r.copies for r in got) == most and all(len(r.positions) == r.copies for r in got)
    for source in "ab":
        own = [r for r in got if rows[r.doc_id][2] == source]
        assert own[0].target <= most * sizes[source] + 1e-6
        assert abs(sum(r.taken for r in own) - own[0].target) <= 40 * 2
    assert abs(sum(r.taken for r in got) - budget * sum(sizes.values())) < 200
    order = curriculum.in_training_order(documents(rows), most=most, budget=budget)
    assert order.count() == sum(r.copies for r in got)


@pytest.mark.parametrize("radius", [1, 3, 5])
def test_odd_radii_in_large_buckets(spark, radius):
    rng = random.Random(radius)
    points = [rng.getrandbits(64) for _ in range(4)]
    for _ in range(36):
        at = rng.choice(points)
        for b in rng.sample(range(64), rng.randint(1, radius + 1)):
            at ^= 1 << b
        points.append(at)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    points = sorted({signed(p) for p in points})
    fps = spark.createDataFrame([(p,) for p in points], "fp long")
    near = lambda x, y: ((x ^ y) % 2**64).bit_count() <= radius
    found = [tuple(r) for r in simhash.links(fps, radius, bucket=2).collect()]
    assert all(near(a, b) for a, b in found)
    linked = collections.defaultdict(set)
    for a, b in found:
        linked[a].add(b)
        linked[b].add(a)
    assert reachable(points, lambda x, y: y in linked[x]) == reachable(points, near)
