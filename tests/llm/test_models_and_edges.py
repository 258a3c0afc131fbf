"""Language models and language ID against plain loops; columns and odd tables in the stages of the pipeline."""

import random
from collections import Counter

import numpy as np
import pytest
from conftest_llm import prose, words
from pyspark.sql import Row, functions as F
from usagetide.llm import classlm, decontaminate, language, neardup, rules, text as T


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


# ---------------------------------------------------------------- class n-grams


def test_class_scores_match_a_plain_loop(odd_docs):
    s = classlm.Settings(top_words=8, endings=4, classes=6, head_words=40, least_count=2)
    train = odd_docs.where("doc_id % 3 <> 0 OR doc_id IS NULL")
    model = classlm.fit(train, settings=s)
    assert model.clustered > 8
    counts = Counter()
    for r in train.select("text").collect():
        counts.update([*words(low(r.text)), None])
    head = {int(h): int(c) for h, c in zip(model.head, model.head_classes)}

    def class_of(word):
        hashes, endings, _ = classlm.tokens([word.encode()], s.endings)
        return head.get(int(hashes[0]), int(model.ending_classes[endings[0]]))

    got = {}
    for r in classlm.score(odd_docs, model).collect():
        got.setdefault(r.doc_id, []).append(round(r.score, 5))
    want = {}
    for r in odd_docs.select("doc_id", "text").collect():
        before, total = model.end_class, 0.0
        for w in [*words(low(r.text)), None]:
            c = model.end_class if w is None else class_of(w)
            total += model.moves[before, c] + np.log10(counts[w] + s.add) - model.mass[c]
            before = c
        want.setdefault(r.doc_id, []).append(round(total, 5))
    assert {k: sorted(v) for k, v in got.items()} == {k: pytest.approx(sorted(v), abs=2e-5) for k, v in want.items()}


def test_words_take_the_class_of_greatest_likelihood():
    rng = np.random.default_rng(3)
    bigrams = rng.integers(1, 50, (5, 5)).astype(float)
    rows = [(w, side, c, int(rng.integers(1, 9))) for w in range(30) for side in (0, 1) for c in range(5) if rng.random() < 0.7]
    rows = [r for r in rows] + [(30, 0, 1, 4), (30, 1, 2, 4)]
    found, best = classlm.best_classes(*(np.array(c) for c in zip(*rows)), bigrams)

    def likelihood(b):
        g = lambda x: sum(v * np.log(v) for v in np.ravel(x) if v > 0)
        return g(b) - g(b.sum(axis=0)) - g(b.sum(axis=1))

    for w, k in zip(found, best):
        gains = []
        for c in range(4):
            with_w = bigrams.copy()
            before = after = 0
            for _, side, ctx, n in (r for r in rows if r[0] == w):
                if side == 0:
                    with_w[ctx, c] += n
                    before += n
                else:
                    with_w[c, ctx] += n
                    after += n
            # Sums that divide: into the class by words before it, out of it by words after it.
            g = lambda x: x * np.log(x) if x > 0 else 0.0
            gain = sum(g(a) - g(b) for a, b in zip(np.ravel(with_w), np.ravel(bigrams)))
            gain -= g(bigrams[:, c].sum() + before) - g(bigrams[:, c].sum()) + g(bigrams[c].sum() + after) - g(bigrams[c].sum())
            gains.append(gain)
        assert gains[k] == pytest.approx(max(gains))


def test_head_is_what_reaches_the_cut_off(shared):
    rng = random.Random(2)
    n = [rng.choice([1, 2, 3, 7, 511, 512, 513, 1000, 1001, 5000, 10**9]) for _ in range(300)]
    counts = shared.createDataFrame([(k, k % 4, c) for k, c in enumerate(n)], "word long, ending int, n long")
    for most in (1000, 200, 100, 30, 0):
        head, endings, freq = classlm.head_words(counts, most)
        assert len(head) <= most and (np.diff(head.astype(np.int64)) > 0).all()
        assert [n[int(h)] for h in head] == freq.tolist() and (head % 4 == endings).all()
        left = sorted(set(n) - set(freq.tolist()))
        assert not left or not len(freq) or max(left) < min(freq)
        if most >= 300:
            assert len(head) == 300
    assert len(classlm.head_words(counts.limit(0), 10)[0]) == 0


# ---------------------------------------------------------------- language ID


def invented(seed, n_words, letters):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n_words))


def test_few_texts_are_enough_for_a_language(shared):
    alphabets = {"aa": "abcdeno", "bb": "abcdenoñ", "cc": "fghiklé", "dd": "fghiklmü"}
    rows = [(k * 100 + i, invented(k * 100 + i, 30, a).upper() if i % 3 == 0 else invented(k * 100 + i, 30, a), lang)
            for k, (lang, a) in enumerate(alphabets.items()) for i in range(15 if lang != "aa" else 90)]
    docs = shared.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs.where(T.fold("doc_id", 5) != 0))
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, model).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) >= len(rows) - 1


def test_prediction_matches_a_plain_sum_over_the_table(shared):
    rows = [(k, invented(k, 20, "abcde" if k % 2 else "vwxyz"), "x" if k % 2 else "y") for k in range(40)]
    docs = shared.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    for r in language.identify(docs, model).collect():
        data = b"\n" + rows[r.doc_id][1].encode() + b"\n"
        total, n = np.zeros(2), 0
        for order in language.ORDERS:
            for bucket in language.grams(data, order, len(model.scores))[1]:
                total += model.scores[bucket]
                n += 1
        z = (total / n + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r.lang_pred == model.langs[int(p.argmax())] and r.score == pytest.approx(p.max(), abs=1e-3)


def test_sample_of_many_languages_is_bounded():
    s = language.Settings()
    for langs in (1, 4, 100, 1000):
        span = s.span(langs)
        assert s.piece_bytes <= span <= s.span_bytes
        pieces = span + (s.piece_bytes if span > s.piece_bytes else 0)
        if langs <= 100:
            assert langs * s.per_lang * pieces * 4 * len(language.ORDERS) < 100e6


def test_capitals_of_latin_1_are_folded():
    t = "ÀÉÑÖØÞ×÷ßÿ ABC Ωд日"
    want = "".join(c.lower() if c < "Ā" else c for c in t)
    assert language.folded(t.encode()).decode() == want


# ---------------------------------------------------------------- stages


@pytest.fixture(scope="module")
def clashing(shared, odd_docs):
    names = ["nd_text", "nd_own", "nd_key", "nd_hash", "dc_hash", "dc_length", "dc_own", "dc_key", "doc", "doc_text", "text_hash", "row"]
    return odd_docs.select("*", *[F.lit(f"own {n}").alias(n) for n in names])


def test_stages_keep_columns_of_any_name(shared, clashing):
    bench = shared.createDataFrame([(1, prose(3, 600)), (2, None)], "item_id int, text string")
    whole = {tuple(r) for r in clashing.collect()}
    for kept in (neardup.deduplicate(clashing), decontaminate.clean(clashing, bench), rules.accept(clashing, rules.POLICIES["v1"])):
        assert kept.columns == clashing.columns
        rows = kept.collect()
        assert rows and {tuple(r) for r in rows} <= whole
        assert all(r.nd_text == "own nd_text" and r.dc_length == "own dc_length" for r in rows)
    assert 17 not in {r.doc_id for r in decontaminate.clean(clashing, bench).collect()}


def test_stages_of_an_empty_table(shared, no_docs, clashing):
    bench = shared.createDataFrame([(1, prose(3, 60))], "item_id int, text string")
    model = language.fit(clashing)
    none = clashing.limit(0)
    for kept in (language.accept(none, model), rules.accept(none, rules.POLICIES["v1"]), neardup.deduplicate(none), decontaminate.clean(none, bench)):
        assert kept.columns == none.columns and kept.count() == 0
    assert decontaminate.clean(clashing, bench.limit(0)).count() == clashing.count()


@pytest.mark.parametrize("kind", ["odd", "empty", "no benchmark"])
def test_pipeline_of_odd_tables(shared, tmp_path, kind):
    import corpus_pipeline

    long = [(k, prose(k, 90), "en" if k % 5 else None, "s", 1) for k in range(30)]
    odd = [(None, prose(99, 80), None, None, None), (50, None, "en", "s", 0), (51, "", "en", "s", 0), (1, prose(1, 90), "en", "s", 1),
           (60, prose(7, 90), "en", "t", 1), (61, prose(200, 5000), "en", "s", 1)]
    kinds = "doc_id long, text string, lang string, source string, n_chars int"
    docs = shared.createDataFrame([] if kind == "empty" else long + odd, kinds)
    docs = docs.select("*", *[F.lit(n).alias(n) for n in ("piece", "nd_text", "dc_hash", "dc_length", "accepted", "fail_bits")])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items = [Row(item_id=1, text=prose(7, 90)), Row(item_id=2, text=None)]
    shared.createDataFrame([] if kind == "no benchmark" else items, "item_id int, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(shared, str(tmp_path)).collect()
    if kind == "empty":
        assert not out
        return
    ids = {r.doc_id for r in out}
    # Texts without letters go; of two equal texts one stays; a benchmark passage goes where there is one.
    assert ids >= set(range(30)) - {7} and 61 in ids and not ids & {50, 51, 60}
    assert (7 in ids) == (kind == "no benchmark")
    assert sum(r.piece == 0 for r in out) == len({(r.doc_id, r.piece) for r in out if r.piece == 0})
