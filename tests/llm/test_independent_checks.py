"""Ring, quality score and URL automaton against slow, plain versions of the same methods."""

import math
import random

import numpy as np
import pytest
from conftest_llm import prose
from pyspark.sql import functions as F
from usagetide.llm import frames, neardup, quality, queries, ring, rules, text as T, urlfilter


# ---------------------------------------------------------------- ring


def walk(keys, shards, vnodes):
    """Shard and slot of every (hash, key, spread), one key at a time, clockwise from its own point."""
    place, owner = ring.points(shards, vnodes)
    arcs = [[] for _ in place]
    for row in sorted(keys, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2])):
        position = (row[0] % 2**64) >> 32
        arcs[next((k for k, p in enumerate(place) if p >= position), 0)].append(row)
    room = [len(keys) // shards + (k < len(keys) % shards) for k in range(shards)]
    filled, found = [0] * shards, {}
    for step in range(len(arcs)):
        for arc, waiting in enumerate(arcs):
            shard = owner[(arc + step) % len(arcs)]
            while waiting and filled[shard] < room[shard]:
                found[waiting.pop(0)] = (int(shard), filled[shard])
                filled[shard] += 1
    return found


@pytest.mark.parametrize("rows, shards, vnodes", [(1000, 7, 5), (3, 7, 5), (400, 24, 16)])
def test_ring_equals_a_walk_of_single_keys(shared, rows, shards, vnodes):
    keys = shared.range(rows).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("doc_id"), F.crc32(F.col("id").cast("string")).alias("crc"))
    hashed = keys.select(ring.key_hash("doc_id", F.col("crc")).alias("h"), "doc_id", "crc").collect()
    want = walk([tuple(r) for r in hashed], shards, vnodes)
    got = ring.assign(keys, "doc_id", "crc", shards, vnodes).collect()
    assert {(r.doc_id, r.crc): (r.shard, r.slot) for r in got} == {(k[1], k[2]): v for k, v in want.items()}


def test_ring_keeps_columns_of_any_name(shared):
    names = ["ring_hash", "ring_arc", "ring_rank", "rank_cell", "rank_base", "rank_n", "row"]
    rows = shared.range(40).select(F.col("id").alias("doc_id"), F.lit(0).alias("crc"), *[(F.col("id") + k).alias(n) for k, n in enumerate(names)])
    got = ring.assign(rows, "doc_id", "crc", 3, cell_rows=4)
    assert got.columns == [*rows.columns, "shard", "slot"]
    assert sorted(r[:-2] for r in got.collect()) == sorted(map(tuple, rows.collect()))


# ---------------------------------------------------------------- quality


def plain_isotonic(points):
    """Least-squares monotone levels of (value, weight) by the max-min formula."""
    mean = lambda i, j: sum(v * w for v, w in points[i : j + 1]) / sum(w for _, w in points[i : j + 1])
    n = len(points)
    return [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]


def plain_scores(rows, wanted, s):
    """Scores of ``wanted`` from ``rows`` (stats, label, fold): one row at a time, one feature at a time."""
    d = len(quality.STATISTICS)
    rng = np.random.default_rng(s.seed)
    directions = rng.normal(0, 1 / (s.width * math.sqrt(d)), (d, s.features)) * math.sqrt(2)
    phases = rng.uniform(0, 2 * math.pi, s.features)
    mean = [sum(r[0][k] for r in rows) / len(rows) for k in range(d)]
    spread = [max(math.sqrt(sum((r[0][k] - mean[k]) ** 2 for r in rows) / len(rows)), 1e-6) for k in range(d)]

    def lift(x):
        z = [(x[k] - mean[k]) / spread[k] for k in range(d)]
        return [math.sqrt(2 / s.features) * math.cos(sum(z[k] * directions[k][f] for k in range(d)) + phases[f]) for f in range(s.features)] + [1.0]

    def ridge(part):
        z, y = np.array([lift(r[0]) for r in part]), np.array([r[1] for r in part], float)
        # Ridge as least squares over the rows and one more row for each weight.
        extra = math.sqrt(s.ridge * len(part)) * np.eye(s.features + 1)
        return np.linalg.lstsq(np.vstack((z, extra)), np.concatenate((y, np.zeros(s.features + 1))), rcond=None)[0]

    bins = {}
    for fold in range(s.folds):
        weights = ridge([r for r in rows if r[2] != fold])
        for r in rows:
            if r[2] == fold:
                at = min(max(int((np.dot(lift(r[0]), weights) + 0.5) / 2 * s.bins), 0), s.bins - 1)
                one, n = bins.get(at, (0, 0))
                bins[at] = (one + r[1], n + 1)
    places = sorted(bins)
    levels = plain_isotonic([(bins[b][0] / bins[b][1], bins[b][1]) for b in places])
    weights = ridge(rows)
    return [float(np.interp(np.dot(lift(x), weights), [(b + 0.5) / s.bins * 2 - 0.5 for b in places], levels)) for x in wanted]


def test_quality_scores_match_a_plain_fit(shared):
    s = quality.Settings(features=24, ridge=1e-2, bins=64, partition_rows=50)
    rng = random.Random(4)
    rows = [(k, prose(k, rng.randint(20, 200)) + " ### !" * rng.randint(0, 30)) for k in range(160)]
    docs = shared.createDataFrame(rows, "doc_id long, text string")
    labels = shared.createDataFrame([(k, int(t.count("###") + rng.randint(0, 12) < 16)) for k, t in rows], "doc_id long, quality int")
    train = T.fold("doc_id", 4) != 2
    stats = quality.statistics(docs)
    fold = F.pmod(F.xxhash64(F.lit(s.seed), "stats", "doc_id"), F.lit(s.folds)).alias("fold")
    known = stats.where(train).join(labels, "doc_id").select("stats", F.col("quality"), fold).collect()
    every = stats.collect()
    want = dict(zip([r.doc_id for r in every], plain_scores([tuple(r) for r in known], [r.stats for r in every], s)))
    got = {r.doc_id: r.score for r in quality.train_and_score(docs, labels, train, settings=s).collect()}
    assert got.keys() == want.keys() and len(got) == 160
    # A raw score at the very edge of a bin may fall into either.
    assert sum(abs(got[k] - want[k]) > 1e-6 for k in got) <= 2


@pytest.mark.parametrize("n", [1, 2, 5])
def test_quality_of_few_labels(shared, n):
    docs = shared.createDataFrame([(k, prose(k, 60)) for k in range(8)], "doc_id long, text string")
    labels = shared.createDataFrame([(k, k % 2) for k in range(n)], "doc_id long, quality int")
    got = quality.train_and_score(docs, labels, F.lit(True)).collect()
    assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)


def test_statistics_of_a_text_without_words(shared):
    docs = shared.createDataFrame([(1, None), (2, ""), (3, " \n ")], "doc_id long, text string")
    assert all(all(map(math.isfinite, r.stats)) for r in quality.statistics(docs).collect())
    assert rules.ledger(docs).count() == 3


# ---------------------------------------------------------------- URLs


def test_long_urls_end_like_short_ones(monkeypatch):
    rng = random.Random(9)
    automaton = urlfilter.Automaton([r.pattern for r in queries.URL_RULES] + ["*" + "ab?" * 30 + "*\x01*"])
    urls = [("." + "".join(rng.choice("ab.example.org/") for _ in range(rng.randint(0, 400))) + "\x01/" + rng.choice(["en/1", "login/", "x.png", ""])).encode()
            for _ in range(120)]
    urls += [b".example.org\x01/" + b"/login" * 200, b"", b".x.com\x01/de/" + b"q" * 5000]
    mixed = automaton.match(urls)
    monkeypatch.setattr(urlfilter, "IN_STEP", 0)
    assert (automaton.match(urls) == mixed).all() and mixed.any()


def test_url_of_megabytes(shared):
    urls = ["http://a.net/" + "p/" * 1_500_000 + "login", "http://a.net/" + "p/" * 1_500_000, "http://x.example.org/es/" + "é" * 500_000]
    pages = shared.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = urlfilter.judge(pages, queries.URL_RULES).select("rule", "verdict").orderBy("page_id").collect()
    assert [tuple(r) for r in got] == [(None, "block"), (None, "allow"), ("example.org/es/", "block")]


# ---------------------------------------------------------------- near-duplicates


def loose_family(seed, n, length, changed, exact):
    """Texts of one template with ``changed`` words of their own each, and for each of ``exact`` a copy with its last word changed."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for k in range(n):
        w = list(base)
        for at in rng.sample(range(length), changed):
            w[at] = f"x{seed}y{rng.randrange(10**9)}"
        out.append(" ".join(w))
    return out + [t.rsplit(" ", 1)[0] + f" z{k}" for k, t in enumerate(out[:exact])]


def linked_by_force(texts):
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {k: find(k) for k in range(len(texts))}


def test_a_long_chain_is_cut_by_bands(shared, monkeypatch):
    # Every text is loosely like its neighbours and shares nothing with those far away; some have a near copy.
    rng = random.Random(3)
    line = [f"w{rng.randrange(10**6)}" for _ in range(3_000)]
    texts = [" ".join(line[k * 22 : k * 22 + 200]) for k in range(120)]
    texts += [t + f" more{k}" for k, t in enumerate(texts[::10])]
    moved, cuts, verified, cut = [], [], neardup._verified, neardup._cut

    def counted(parts, s):
        parts = frames.materialize(parts)
        moved.append(parts.count())
        return verified(parts, s)

    def noted(mixed, bands, level, s):
        out = cut(mixed, bands, level, s)
        cuts.append(out[1].count())
        return out

    monkeypatch.setattr(neardup, "_verified", counted)
    monkeypatch.setattr(neardup, "_cut", noted)
    docs = shared.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = neardup.near_duplicates(docs, settings=neardup.Settings(bucket_nodes=4, most_copies=8)).collect()
    want = linked_by_force(texts)
    assert {r.doc_id: r.component_id for r in got} == want and sum(k != v for k, v in want.items()) == 12
    # Some 33 blocks in pairs would move every text 32 times.
    assert sum(cuts) >= 1 and sum(moved) < 20 * len(texts)


@pytest.mark.parametrize("least", [True, False])
def test_links_of_a_loose_family_whatever_is_cut(shared, monkeypatch, least):
    texts = loose_family(1, 50, 160, 3, 10) + loose_family(2, 20, 120, 2, 5)
    docs = shared.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    if not least:  # cut even where that moves more
        cut = neardup._cut
        monkeypatch.setattr(neardup, "_cut", lambda mixed, *rest: cut(mixed.withColumn("moves", F.lit(1 << 40)), *rest))
    got = neardup.near_duplicates(docs, settings=neardup.Settings(bucket_nodes=6, most_copies=1)).collect()
    want = linked_by_force(texts)
    assert {r.doc_id: r.component_id for r in got} == want and len(set(want.values())) > 40
