"""Every operator against brute force on a small table of odd rows, and on an empty one."""

import base64
import hashlib
import io
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import SMALL, prose, words
from pyspark.sql import functions as F
from usagetide.llm import (
    classlm, components, decontaminate, frames, language, neardup, packing, quality, queries, ring, rules, text as T, urlfilter, warc,
)


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# ---------------------------------------------------------------- 1


def test_language_learns_and_rejects(shared, odd_docs, no_docs):
    french = "le la les de des et un une que qui dans pour pas sur avec est sont cette être aux".split()
    import random

    rng = random.Random(4)
    rows = [(k, prose(k, 40), "en") for k in range(60)] + [(100 + k, " ".join(rng.choice(french) for _ in range(40)), "fr") for k in range(60)]
    docs = shared.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs.where(T.fold("doc_id", 5) != 0))
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 and got[i].accepted for i, _, lang in rows)
    odd = language.identify(odd_docs, model).collect()
    assert len(odd) == odd_docs.count()
    for r in odd:
        if r.doc_id in (4, 5, 6, 14):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        elif r.doc_id is not None:
            assert r.lang_pred in ("en", "fr")
    assert language.accept(odd_docs, model).columns == odd_docs.columns
    assert language.identify(no_docs, model).count() == 0
    empty = language.identify(odd_docs, language.fit(no_docs)).collect()
    assert {r.lang_pred for r in empty} == {"und"}


def test_language_of_texts_above_the_buffer(shared):
    size = 3 << 20
    spaced = (prose(7, 1000) + " ") * (size // 5000)
    texts = [spaced[:size], "x" * size, "日本語" * (size // 9), " " * size + "le chat", spaced[: T.BUFFER_BYTES], spaced[: T.BUFFER_BYTES + 1]]
    table = np.random.default_rng(1).normal(size=(language.BUCKETS, 3)).astype(np.float32)
    for t in texts:
        data = t.encode()
        total, count = language._sums([data], table)
        want = np.concatenate([language.grams(b"\n" + data + b"\n", order, len(table))[1] for order in language.ORDERS])
        assert total.shape == (1, 3) and count.tolist() == [len(want)]
        close = 1e-6 if len(data) > T.BUFFER_BYTES else 1e-2  # up to the buffer, sums are of single precision
        assert np.allclose(total[0], np.bincount(want, minlength=len(table)) @ table.astype(float), rtol=close, atol=close * len(want))
    model = language.LanguageModel(["a", "b", "c"], table, np.zeros(3))
    got = {r.doc_id: r for r in language.identify(shared.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).collect()}
    assert sorted(got) == list(range(len(texts))) and all(r.lang_pred in "abc" for r in got.values())


# ---------------------------------------------------------------- 2


def test_ledger_measures_match_brute_force(odd_docs, no_docs):
    book = rules.ledger(odd_docs)
    got = sorted(map(tuple, book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()), key=str)
    want = []
    for i, t in rows_of(odd_docs):
        w = words(t or "")
        grams, hit = Counter(zip(w, w[1:], w[2:])), set()
        for k in range(len(w) - 2):
            if grams[tuple(w[k : k + 3])] > 1:
                hit |= {k, k + 1, k + 2}
        lines = [x for x in (t or "").split("\n") if words(x)]
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit)))
    assert got == sorted(want, key=str)
    assert rules.ledger(no_docs).count() == 0
    kept = rules.accept(odd_docs, rules.POLICIES["v1"])
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} >= {1, 2, 3, 17}


def test_ablation_counts_bits(odd_docs):
    policy = rules.POLICIES["v1"]
    bits = [r.fail_bits & policy.mask() for r in rules.ledger(odd_docs).collect()]
    for r in rules.ablation(rules.ledger(odd_docs), policy).collect():
        own = next(1 << x.bit for x in rules.RULES if x.name == r.rule)
        assert (r.n_failed, r.n_failed_alone, r.n_kept_without) == (
            sum(b & own != 0 for b in bits), sum(b == own for b in bits), sum(b & ~own == 0 for b in bits))


# ---------------------------------------------------------------- 3


def test_automaton_equals_regular_expressions():
    patterns = [".a*\x01*", "*.org\x01/*", ".?b\x01/x*y", "*\x01*", ".a\x01/\\*", "*" + "z" * 70 + "\x01*"]
    urls = [".a\x01/", ".ab.org\x01/x", ".bb\x01/xqy", ".bb\x01/xqyz", ".a\x01/*", ".a\x01/b", "." + "z" * 70 + "\x01/p", "", "." + "q" * 3000 + ".org\x01/x\x01y"]
    found = urlfilter.Automaton(patterns).match([u.encode() for u in urls])
    for k, p in enumerate(patterns):
        host, path = p.split("\x01")
        expression = "".join("[^\x01]*" if c == "*" else "[^\x01]" if c == "?" else re.escape(c) for c in host) + "\x01"
        i = 0
        while i < len(path):
            c = path[i]
            if c == "\\":
                i += 1
                expression += re.escape(path[i])
            else:
                expression += ".*" if c == "*" else "." if c == "?" else re.escape(c)
            i += 1
        assert [bool(re.fullmatch(expression, u, re.S)) for u in urls] == found[:, k].tolist(), p


def test_site_rules_and_odd_urls(shared):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/en/1x?q#f", "https://example.org/es/", "https://notexample.org/es/",
            "ftp://x.com/de/a", "ftp://x.com/fr", "x://com/fr/y", "http://u@h.net:80?x=/login", "http://ads.net/" + "p" * 50_000, "a://b.net/\x01.org/"]
    pages = shared.createDataFrame([(k, u, "r") for k, u in enumerate(urls)], "page_id long, url string, rule string")
    got = [(r.host, r.rule, r.verdict) for r in urlfilter.judge(pages, queries.URL_RULES).orderBy("page_id").collect()]
    assert got[:4] == [("", None, "block")] * 4
    assert got[4:11] == [("a.example.org", "example.org/en/1", "block"), ("example.org", "example.org/es/", "block"), ("notexample.org", "org/", "allow"),
                         ("x.com", "com/de/", "block"), ("x.com", None, "allow"), ("com", "com/fr/", "allow"), ("u@h.net:80", None, "allow")]
    assert got[11][2] == "block" and got[12] == ("b.net", None, "allow")
    assert urlfilter.judge(pages.limit(0), queries.URL_RULES).count() == 0


# ---------------------------------------------------------------- 4


def test_ring_is_exact_and_moves_little(shared, odd_docs, no_docs):
    sized = odd_docs.select("doc_id", F.crc32(F.coalesce(T.utf8("text"), F.lit(b""))).alias("crc"))
    got = ring.assign(sized, "doc_id", "crc", 7, cell_rows=3).collect()
    by = Counter(r.shard for r in got)
    assert len(got) == sized.count() and max(by.values()) - min(by.get(k, 0) for k in range(7)) <= 1
    assert all(sorted(r.slot for r in got if r.shard == k) == list(range(n)) for k, n in by.items())
    assert ring.assign(no_docs.select("doc_id", F.lit(0).alias("crc")), "doc_id", "crc", 7).count() == 0
    many = shared.range(5000).select(F.col("id").alias("doc_id"), F.lit(0).alias("crc"))
    one = {r.doc_id: r.shard for r in ring.assign(many, "doc_id", "crc", 24).collect()}
    two = {r.doc_id: r.shard for r in ring.assign(many, "doc_id", "crc", 25).collect()}
    assert sum(one[k] != two[k] for k in one) < 5000 * 0.35  # rehashing would move 24 of 25


# ---------------------------------------------------------------- 5


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_hold_all_ids(odd_docs, no_docs):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    plain = Tokenizer.from_file(path)
    want = Counter()
    for i, t in rows_of(odd_docs):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048 if len(ids) > 2048 else len(ids)
        cuts = [0, *range(first, len(ids), 2048), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    got = packing.pack_documents(odd_docs, path).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    check_packing(got, 2048)
    assert packing.pack_documents(no_docs, path).count() == 0


def test_ids_are_those_of_the_tokenizer(shared):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    plain = Tokenizer.from_file(path)
    texts = ["<|endoftext|> it's here", "a<|endoftext|><|endoftext|>", "<|endoftext|", " " * 1_500_000 + "b", "a" + "\n" * 1_500_000, "a \u3000\u0085" * 50, "x" * 1_000_000, ""]
    docs = shared.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {}
    for r in sorted(packing.pieces(docs, path).collect(), key=lambda r: (r.doc_id, r.piece)):
        got[r.doc_id] = got.get(r.doc_id, b"") + r.ids
    for k, t in enumerate(texts):
        assert got[k] == np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes(), k


def test_bin_completion_reaches_the_optimum():
    def fewest(items, capacity):
        best = [len(items)]

        def go(k, bins):
            if len(bins) >= best[0]:
                return
            if k == len(items):
                best[0] = len(bins)
                return
            for room in set(bins):
                if room >= items[k]:
                    rest = list(bins)
                    rest.remove(room)
                    go(k + 1, [*rest, room - items[k]])
            go(k + 1, [*bins, capacity - items[k]])

        go(0, [])
        return best[0]

    rng = np.random.default_rng(3)
    for _ in range(40):
        items = sorted(rng.integers(5, 50, 11).tolist(), reverse=True)
        counts = np.bincount(items, minlength=65)
        plan = packing.complete(counts, 64)
        used = Counter()
        for times, sizes in plan:
            assert sum(sizes) <= 64
            for x in sizes:
                used[x] += times
        assert used == Counter(items) and sum(n for n, _ in plan) == fewest(items, 64)
        assert packing.lower_bound(counts, 64) <= fewest(items, 64)


def test_completion_on_wide_histograms():
    rng = np.random.default_rng(1)
    shapes = {
        "narrow": np.clip(rng.lognormal(6, 0.8, 20_000), 1, 2048).astype(int),
        "all lengths": np.repeat(np.arange(1, 2049), 3),
        "no small ones": rng.integers(300, 1101, 400),
        "one length": np.full(1000, 700),
        "tiny": np.full(5000, 3),
    }
    won = {}
    for name, lengths in shapes.items():
        counts = np.bincount(lengths, minlength=2049)
        found = packing.search(counts, 2048)
        used = Counter()
        for times, sizes in found.plan:
            assert times > 0 and 0 < sum(sizes) <= 2048
            used.update({x: n * times for x, n in Counter(sizes).items()})
        assert used == Counter(lengths.tolist()) and found.sequences == sum(n for n, _ in found.plan)
        simple = sum(n for n, _ in packing.best_fit(counts, 2048))
        assert found.bound <= found.sequences <= simple
        assert (found.found_by == "best fit") == (found.sequences == simple)
        assert found == packing.search(counts, 2048)
        won[name] = found
    assert won["narrow"].sequences == won["narrow"].bound and won["narrow"].found_by == "completion of parts"
    assert won["all lengths"].sequences == won["all lengths"].bound
    assert won["no small ones"].found_by != "best fit"
    assert packing.search(np.zeros(2049, dtype=np.int64), 2048).plan == []


def test_exact_fillings_are_exact_and_available():
    rng = np.random.default_rng(3)
    for _ in range(300):
        counts = np.bincount(rng.integers(1, 40, rng.integers(1, 30)), minlength=65)
        before, gap = counts.copy(), int(rng.integers(1, 64))
        for items in packing.exact_fillings(counts, gap, 3):
            assert sum(items) == gap and all(n <= counts[x] for x, n in Counter(items).items())
        assert (counts == before).all()


# ---------------------------------------------------------------- 6


def groups_by_force(rows):
    sets = []
    for i, t in rows:
        w = words(low(t))
        sets.append((i, frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                p, q = label[a], label[b]
                label = [min(p, q) if v in (p, q) else v for v in label]
    out = []
    for k, (i, z) in enumerate(sets):
        ids = [sets[j][0] for j in range(len(sets)) if label[j] == label[k] and sets[j][0] is not None]
        least = min(ids, default=None) if z else i
        out.append((i, len(z), least, i == least))
    return sorted(out, key=str)


def test_near_duplicates_match_brute_force(odd_docs, no_docs):
    got = neardup.near_duplicates(odd_docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == groups_by_force(rows_of(odd_docs))
    assert neardup.near_duplicates(no_docs).count() == 0
    one = neardup.deduplicate(odd_docs)
    assert one.columns == odd_docs.columns
    left = [r.doc_id for r in one.collect()]
    assert left.count(1) == 1 and 2 not in left and 3 not in left and 8 in left and 9 not in left


def test_near_duplicates_in_small_blocks(shared):
    rng = np.random.default_rng(5)
    rows, k = [], 0
    for g in range(3):
        base = prose(50 + g, 150).split()
        for _ in range(25):
            w = list(base)
            for at in rng.integers(0, 150, rng.integers(0, 6)):
                w[at] = f"v{rng.integers(1000)}"
            rows.append((k, " ".join(w)))
            k += 1
    docs = shared.createDataFrame(rows, "doc_id long, text string")
    tight = neardup.Settings(bucket_nodes=8, block_shingles=900)
    want = groups_by_force(rows)
    for settings in (neardup.Settings(), tight):
        got = neardup.near_duplicates(docs, settings=settings).select("doc_id", "n_shingles", "component_id", "kept").collect()
        assert sorted(map(tuple, got), key=str) == want


def test_near_copies_of_a_short_text_stay_in_blocks(shared, monkeypatch):
    base, other = prose(60, 19), prose(61, 19)
    rows = [(k, f"{base} last{k}") for k in range(400)] + [(400 + k, f"{other} end{k}") for k in range(60)] + [(500, prose(62, 40))]
    runs = []
    verified = neardup._verified

    def counted(parts, s):
        parts = neardup.frames.materialize(parts)
        runs.extend(r["count"] for r in parts.groupBy("cluster", "i", "j").count().collect())
        return verified(parts, s)

    monkeypatch.setattr(neardup, "_verified", counted)
    docs = shared.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(docs, settings=neardup.Settings(bucket_nodes=32)).collect()
    want = {k: 0 if k < 400 else 400 if k < 460 else 500 for k, _ in rows}
    assert {r.doc_id: r.component_id for r in got} == want
    # No task holds much more than a block, and texts are not repeated for every pair of blocks.
    assert max(runs) <= 3 * 32 and sum(runs) <= 2 * len(rows)


def test_cut_clusters_give_the_links_of_whole_ones(shared):
    # Two families whose signatures are close and whose texts are not similar enough, and a chain between blocks.
    rng = np.random.default_rng(8)
    base = prose(70, 120).split()
    rows = []
    for k in range(120):
        w = list(base)
        for at in rng.integers(0, 120, rng.integers(1, 4)):
            w[at] = f"v{rng.integers(40)}"
        rows.append((k, " ".join(w)))
    docs = shared.createDataFrame(rows, "doc_id long, text string")
    want = groups_by_force(rows)
    got = neardup.near_duplicates(docs, settings=neardup.Settings(bucket_nodes=9)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert len({r[2] for r in want}) > 3 and sorted(map(tuple, got), key=str) == want


def test_exact_links_need_no_square_matrix():
    import tracemalloc

    n, s = 20_000, neardup.Settings()
    shared_part = np.arange(100, 115, dtype=np.uint64)
    sets = [np.append(shared_part, np.uint64(1000 + k)) for k in range(n)]
    tracemalloc.start()
    found = neardup._exact_links(np.arange(n), sets, np.zeros((n, s.longs), np.uint64), np.repeat([0, 1], n // 2), s)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 1 and peak < 50e6  # n x n booleans are 400 MB


def test_components_of_a_long_chain(shared):
    edges = shared.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 100), (200, 201), (201, 200)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 200: 200, 201: 200}


# ---------------------------------------------------------------- 7


def test_class_model_counts_and_sums_to_one(odd_docs, no_docs):
    small = classlm.Settings(top_words=8, endings=4, classes=5, head_words=20)
    train = odd_docs.where("doc_id % 3 <> 0 OR doc_id IS NULL")
    model = classlm.fit(train, settings=small)
    counts = Counter()
    for _, t in rows_of(train):
        counts.update([*words(low(t)), None])
    n, v = sum(counts.values()), len(counts)
    assert (model.tokens, model.vocabulary) == (n, v)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in classlm.score(odd_docs, model).collect()), key=str)
    want = []
    for i, t in rows_of(odd_docs):
        w = [*words(low(t)), None]
        want.append((i, len(w), sum(counts[x] > 0 for x in w), round(sum(np.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6)))
    assert got == sorted(want, key=str)
    assert np.allclose((10**model.moves).sum(axis=1), 1)
    # Words of all classes, and one unseen word each, share the mass: n + 0.1 * (v + classes).
    assert np.isclose((10**model.mass).sum(), n + 0.1 * (v + small.classes))
    assert classlm.score(no_docs, model).count() == 0
    assert all(r.n_known == 0 and r.base_score == 0 for r in classlm.score(odd_docs, classlm.fit(no_docs, settings=small)).collect())


def test_exchange_ends_where_no_move_helps():
    def likelihood(b, of, k):
        hot = np.zeros((len(b), k))
        hot[np.arange(len(b)), of] = 1
        n = hot.T @ b @ hot
        return classlm._g(n).sum() - classlm._g(n.sum(axis=0)).sum() - classlm._g(n.sum(axis=1)).sum()

    rng = np.random.default_rng(2)
    b = rng.poisson(3, (20, 20)) * rng.integers(0, 9, (20, 1)).astype(float)
    start, of = classlm.exchange(b, 4, 0), classlm.exchange(b, 4, 50)
    reached = likelihood(b, of, 4)
    assert reached > likelihood(b, start, 4) and of[-1] == 3 and 3 not in of[:-1]
    for i in range(19):
        for c in range(3):
            assert likelihood(b, np.where(np.arange(20) == i, c, of), 4) <= reached + 1e-6


# ---------------------------------------------------------------- 8


def test_isotonic_is_the_best_monotone_fit():
    level = quality.isotonic(np.array([1, 0, 1, 1, 0, 2]), np.array([1, 1, 2, 1, 1, 2]))
    assert np.allclose(level, [0.5, 0.5, 0.5, 0.5, 0.5, 1]) and (np.diff(level) >= 0).all()


def test_quality_scores_separate(shared, odd_docs, no_docs):
    rows = [(k, prose(k, 80) if k % 3 else "### $$$ | " * 40) for k in range(240)]
    docs = shared.createDataFrame(rows, "doc_id long, text string")
    labels = shared.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(240)] + [(None, 1, 0), (3, None, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in quality.train_and_score(docs, labels, T.fold("doc_id", 4) != 2).collect()}
    assert all((s >= 0.7) == (k % 3 > 0) and 0 <= s <= 1 for k, s in got.items()) and len(got) == 240
    odd = quality.train_and_score(odd_docs, labels, F.lit(True)).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in quality.train_and_score(odd_docs, labels.limit(0), F.lit(True)).collect()} == {0.5}
    assert quality.train_and_score(no_docs, labels, F.lit(True)).count() == 0


# ---------------------------------------------------------------- 9


def test_contamination_matches_brute_force(shared, odd_docs, no_docs):
    passage = prose(1, 120).split()
    items = [(1, " ".join(passage[10:40])), (2, "Two WORDS!"), (3, None), (4, "..."), (5, "one"), (None, " ".join(passage[50:70])), (6, "É"), (10, " ".join(passage[10:40]))]
    bench = shared.createDataFrame(items, "item_id long, text string")
    alnum = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in items:
        w = alnum.findall(low(t))
        for k in range(max(len(w) - 12, 1) if w else 0):
            windows.setdefault(tuple(w[k : k + 13]), set()).update({str(i)} if i is not None else set())
    want = []
    for i, t in rows_of(odd_docs):
        w, hit, names = alnum.findall(low(t)), set(), set()
        for k in range(len(w)):
            for n in {len(x) for x in windows}:
                if k + n <= len(w) and tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    names |= windows[tuple(w[k : k + n])]
        want.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    for limit in (decontaminate.frames.HOT_LEAST, 1):
        found = decontaminate.contamination(odd_docs, bench, hot_rows=limit)
        got = found.select("doc_id", "n_words", "n_hit", "n_items", decontaminate.items_digest().alias("h"), "contaminated").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    clean = decontaminate.clean(odd_docs, bench)
    assert clean.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(x[0]) for x in want if not x[5])
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(odd_docs, bench.limit(0)).collect()} == {0}


def test_one_plan_splits_a_hot_prefix_shingle(shared, monkeypatch):
    """A window made of frequent words: its rarest shingle is hot. Also a bitmap so small that most places pass."""
    from pyspark.sql import functions as F

    hot = "one two " * 6 + "one"
    bench = shared.createDataFrame([("b1", hot), ("b2", "two one two"), ("b3", prose(5, 40))], "item_id string, text string")
    docs = shared.range(60).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("one two " * 40)).when(F.col("id") % 3 == 1, F.lit(prose(5, 40))).otherwise(F.lit("two one. one two")).alias("text"))
    got = {}
    for rows in (1, 64):
        monkeypatch.setattr(decontaminate, "BITMAP_ROWS", rows)
        found = decontaminate.contamination(docs, bench, hot_rows=5)
        got[rows] = {r.doc_id: (r.n_words, r.n_hit, r.items) for r in found.collect()}
    assert got[1] == got[64]
    n = len(prose(5, 40).split())
    for i, r in got[1].items():
        if i % 3 == 0:
            assert r == (80, 80, ["b1", "b2"])
        elif i % 3 == 1:
            assert r[1:] == (r[0], ["b3"]) and n <= r[0]
        else:
            assert r == (4, 0, [])


# ---------------------------------------------------------------- 10


def test_archives_round_trip(shared):
    html = [(3, "http://a/\r\nX: y", "<p>é</p>"), (1, None, "<p>é</p>"), (1, "u", "<p>é</p>"), (2, "u", None), (4, "u", ""), (None, "u", "<p>é</p>"), (9, "u", "z" * 300_000), (8, "v w", "q")]
    pages = shared.createDataFrame([(*h, 0) for h in html], "page_id long, url string, html string, payload_bytes int")
    files = warc.write_archives(pages, warc.archive_folder(shared), roll_bytes=400)
    assert files.count() > 1
    got = warc.read_archives(files).collect()
    first = {"<p>é</p>": "1", "": "2", "z" * 300_000: "9", "q": "8"}
    want = []
    for i, u, h in html:
        data, key = (h or "").encode(), "" if i is None else str(i)
        same = key == first[h or ""]
        want.append((key, "response" if same else "revisit", u or "", None if same else first[h or ""], base64.b32encode(hashlib.sha1(data).digest()).decode(), len(data), data if same else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert warc.read_archives(warc.write_archives(pages.limit(0), warc.archive_folder(shared))).count() == 0


def test_reader_refuses_damage():
    good = warc.member(warc.record("1", "u", b"hello", None)) + warc.member(warc.record("2", "u", b"hello", "1"))
    assert [r["payload_bytes"] for r in warc.records(io.BytesIO(good))] == [5, 5]
    plain = warc.record("1", "u", b"hello", None)
    for bad in (good[:-5], warc.member(plain.replace(b"hello", b"hellp")), warc.member(plain + plain), warc.member(b"x\r\n\r\n"), b"junk" + good):
        with pytest.raises(warc.WarcError):
            list(warc.records(io.BytesIO(bad)))


# ---------------------------------------------------------------- pipeline


def test_pipeline_against_plain_loops(shared, tmp_path):
    import corpus_pipeline

    rows = [(k, prose(k, 200), "en") for k in range(20)]
    rows += [(20, rows[0][1], "en"), (21, "123 456", "en"), (22, "### *** " * 60, "en"), (23, prose(23, 30), "en")]
    item = " ".join(prose(3, 200).split()[20:60])
    docs = shared.createDataFrame([(*r, "s", len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    shared.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(shared, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == set(range(20)) - {3}
    check_packing(out, 2048)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_duckdb(shared, name):
    import duckdb

    connection = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = connection.sql(queries.SQL[name])
    got = queries.QUERIES[name](shared, SMALL)
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    # Values as they are: pandas would turn whole numbers beside nulls into floating-point ones.
    place = [want.columns.index(c) for c in columns]
    rows = [[r[k] for k in place] for r in want.fetchall()]
    assert sorted(map(str, map(list, got.select(*columns).collect()))) == sorted(map(str, rows))


def test_hot_join_keeps_every_row(shared, monkeypatch):
    monkeypatch.setattr(frames, "HOT_LEAST", 5)
    rows = shared.range(300).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 5 == 0, None).otherwise(F.col("id")).alias("k"))
    one = shared.range(200).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    rows = rows.withColumn("k", F.col("k").cast("int"))
    for how in ("left", "inner"):
        got = sorted(map(tuple, frames.hot_join(rows, one, ["k"], ["id"], how).select("id", "k", "v").collect()), key=str)
        assert got == sorted(map(tuple, rows.join(one, "k", how).select("id", "k", "v").collect()), key=str)
