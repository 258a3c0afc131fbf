"""Conversation repair, SimHash groups and fill-in-middle against brute force, on odd rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest_llm import SMALL, prose, words
from pyspark.sql import functions as F
from usagetide.llm import fim, frames, queries, repair, simhash, text as T


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


# ---------------------------------------------------------------- conversation repair

SPACE = "[\x20\x09-\x0d]"


def cheapest(letters):
    """Every sequence of edits within the best cost, by depth-first search."""
    best = None

    def go(i, state, cost, audit):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(letters) and state in repair.FINAL and (best is None or (cost, audit) < best):
            best = (cost, audit)
        role, more = (letters[i].lower(), letters[i].isupper()) if i < len(letters) else ("", 0)
        if role:
            go(i + 1, state, cost + 3, audit + "D")
        for (p, r), q in repair.STEP.items():
            if p != state:
                continue
            if role and role != "d" and r == role:
                go(i + 1, q, cost + more, audit + "K")
            if role and role != "d" and r in "ua":
                go(i + 1, q, cost + more + 2, audit + "R")
            if r in "ua" and cost + 2 <= 3 * len(letters):
                go(i, q, cost + 2, audit + "I")

    go(0, repair.NOTHING, 0, "")
    return best


def test_chart_holds_the_cheapest_edits_with_the_least_audit():
    rng = random.Random(3)
    for _ in range(400):
        letters = "".join(rng.choice("suaxSUAXd") for _ in range(rng.randint(0, 5)))
        assert repair.cheapest(repair.chart(letters)) == cheapest(letters), letters


def test_spans_cut_anywhere_give_the_cells_of_the_chart():
    rng = random.Random(4)
    for _ in range(40):
        letters = "".join(rng.choice("suaxSUAXduaua") for _ in range(rng.randint(0, 70)))
        row_by_row, by_parts, at = repair.Spans(), repair.Spans(), 0
        for c in letters:
            row_by_row.add(c)
        while at < len(letters):
            end = at + rng.randint(1, 20)
            by_parts.append(repair.chart(letters[at:end]))
            at = end
        whole = repair.chart(letters)
        assert row_by_row.cells() == whole and by_parts.cells() == whole


def judged(rows):
    """Contract values of one conversation's rows, by plain left-to-right search over states."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    faults, seen = [], set()
    for _, role, text in rows:
        last = re.findall(f"[^{SPACE[1:]}", text)
        if not last:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if last[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    now = {repair.NOTHING: (0, "", ())}

    def settle(cells):
        for _ in range(4):
            for p, (cost, audit, made) in list(cells.items()):
                for (s, r), q in repair.STEP.items():
                    if s == p and r in "ua":
                        role = "user" if r == "u" else "assistant"
                        option = (cost + 2, audit + "I", (*made, f"{role}:"))
                        if q not in cells or option < cells[q]:
                            cells[q] = option
        return cells

    settle(now)
    for (_, role, text), fault in zip(rows, faults):
        new, more = {}, fault == "truncated"

        def put(q, option):
            if q not in new or option < new[q]:
                new[q] = option

        for p, (cost, audit, made) in now.items():
            put(p, (cost + 3, audit + "D", made))
            if fault in ("blank", "duplicate"):
                continue
            for (s, r), q in repair.STEP.items():
                if s == p and r == role[:1]:
                    put(q, (cost + more, audit + "K", (*made, f"{role}:{text}")))
                if s == p and r in "ua":
                    put(q, (cost + more + 2, audit + "R", (*made, f"{'user' if r == 'u' else 'assistant'}:{text}")))
        now = settle(new)
    cost, audit, made = min(now[q] for q in repair.FINAL if q in now)
    count = Counter(faults)
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(made).encode()).hexdigest(), made)


def damaged(rows):
    spelled = lambda v: " " if v is None else str(v)
    out = {}
    for conv, turn, role, text in rows:
        role, text = spelled(role), spelled(text)
        pick = zlib.crc32(f"{spelled(conv)}:{spelled(turn)}".encode()) % 20
        got = out.setdefault(conv, [])
        if pick == 0:
            continue
        text = "" if pick == 1 else re.sub("[.!?]", "", text) if pick == 2 else text
        got += [(turn, "user" if pick == 4 else role, text)] * (2 if pick == 3 else 1)
    return out


@pytest.fixture(scope="module")
def talks(shared):
    rng = random.Random(8)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "umpire", "User"]
    texts = ["Yes.", "Why?", "cut off", "ends here. \n", " \t", "", None, "Same line!", "日本語。", "é.", "x" * 50_000 + "."]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t} of {c}.") for c in range(60, 80) for t in range(6)]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (90, None, "user", "No turn."), (90, None, None, None), (90, 5, "assistant", "Far.")]
    rows += [(91, 3, "user", "Tie one."), (91, 3, "user", "Tie two."), (91, 3, "assistant", "Tie three."), (91, 3, "user", "Tie one.")]
    # One conversation with most of the rows, repeated rows among them.
    rows += [(99, t // 2, rng.choice(roles[:6]), rng.choice(texts[:4]) if t % 3 else f"Said {t}.") for t in range(700)]
    table = [(c, t, r, x, "k", 1, 2, "d") for c, t, r, x in rows]
    kinds = "conv_id long, turn long, role string, text string, audit string, cost int, kind int, digest string"
    return shared.createDataFrame(table, kinds).repartition(5)


def test_report_matches_plain_search(shared, talks):
    rows = [tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()]
    want = {c: judged(r)[:8] for c, r in damaged(rows).items()}
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = repair.report(talks, repair.damage(talks)).select("conv_id", *columns).collect()
    assert len(got) == len(want) == len({r.conv_id for r in got})
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id


def test_one_conversation_lies_in_many_ranges(shared, talks):
    before = shared.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    shared.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    shared.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        ranged = repair.marked(repair.whole_rows(talks)).repartitionByRange(*repair.ORDER)
        parts = ranged.where("conv_id = 99").select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 3
        plan = repair.plans(repair.damage(talks)).where("conv_id = 99").first()
    finally:
        shared.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        shared.conf.set("spark.sql.shuffle.partitions", "4")
    rows = damaged([tuple(r) for r in talks.where("conv_id = 99").select("conv_id", "turn", "role", "text").collect()])[99]
    want = judged(rows)
    assert (plan.n, plan.gaps, plan.blank, plan.duplicate, plan.truncated, plan.illegal, plan.cost, plan.audit) == (len(rows), *want[:7])


def test_repaired_rows_are_legal_and_hash_alike(shared, talks):
    made = {}
    for r in repair.repaired(talks, repair.damage(talks)).orderBy("conv_id", "place").collect():
        made.setdefault(r.conv_id, []).append(r)
    hashes = {r.conv_id: r.repaired_sha256 for r in repair.report(talks, repair.damage(talks)).collect()}
    for conv, digest in hashes.items():
        rows = made.get(conv, [])
        assert [r.place for r in rows] == list(range(len(rows)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in rows))
        assert all((r.edit == "I") == (r.turn is None and r.text == "") or r.turn is None for r in rows)
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in rows).encode()).hexdigest() == digest


def test_repair_of_nothing(talks):
    none = talks.limit(0)
    assert repair.report(none).count() == 0 and repair.repaired(none).count() == 0 and repair.damage(none).count() == 0
    gone = repair.report(talks.where("conv_id = 60"), talks.limit(0)).collect()
    assert [tuple(r)[1:] for r in gone] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest(), 0)]


def test_undamaged_talk_needs_no_edit(shared):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Hi.")]
    r = repair.report(shared.createDataFrame(rows, "conv_id string, turn int, role string, text string")).first()
    assert (r.conv_id, r.audit, r.cost, r.gaps) == ("1", "KKK", 0, 0)


# ---------------------------------------------------------------- SimHash


def plain_print(t):
    w = words(low(t))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Smallest id reachable, by comparing all pairs of distinct fingerprints."""
    values = sorted({fp for _, fp in prints})
    u = np.array(values, dtype=np.uint64)
    label = list(range(len(u)))
    near = [np.flatnonzero(np.bitwise_count(x ^ u) <= 3).tolist() for x in u]
    changed = True
    while changed:
        changed = False
        for k, around in enumerate(near):
            least = min(label[j] for j in around)
            changed |= least < label[k]
            label[k] = least
    least = {}
    for i, fp in prints:
        if i is not None:
            g = label[values.index(fp)]
            least[g] = min(i, least.get(g, i))
    return [(i, least.get(label[values.index(fp)])) for i, fp in prints]


def test_simhash_groups_match_brute_force(odd_docs, no_docs):
    prints = [(r.doc_id, plain_print(r.text)) for r in odd_docs.select("doc_id", "text").collect()]
    got = simhash.near_duplicates(odd_docs).collect()
    key = lambda row: tuple((x is None, x) for x in row)
    want = sorted(((i, f"{fp:016x}", c) for (i, fp), (_, c) in zip(prints, plain_groups(prints))), key=key)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=key) == want
    assert simhash.near_duplicates(no_docs).count() == 0


def test_simhash_query_on_the_small_tables(shared):
    docs = shared.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, plain_print(r.text)) for r in docs]
    got = queries.op12_multi_index_hashing(shared, SMALL).collect()
    want = {i: (f"{fp:016x}", c) for (i, fp), (_, c) in zip(prints, plain_groups(prints))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want


def test_prints_of_long_texts_go_on_across_parts(monkeypatch):
    monkeypatch.setattr(T, "BUFFER_BYTES", 64)
    monkeypatch.setattr(T.cut, "__defaults__", (64,))
    rng = random.Random(5)
    for _ in range(60):
        t = " ".join(rng.choice(["a", "Bb", "é\n", "\t", "y" * rng.randint(1, 90)]) for _ in range(rng.randint(1, 90)))
        assert simhash.text_prints([t.encode().lower()]) == [plain_print(t)]


@pytest.mark.parametrize("most", [4096, 3])
def test_links_of_a_dense_cluster_and_chains(shared, most):
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(0, 1 << 62, 40)]
    prints = set(base) | {base[0] ^ int(x) for x in rng.integers(0, 1 << 11, 500)}
    for b in base[1:20]:
        for _ in range(12):
            for k in rng.integers(0, 63, rng.integers(1, 4)):
                b ^= 1 << int(k)
            prints.add(b)
    prints = sorted(prints)
    found = simhash.links(shared.createDataFrame([(p,) for p in prints], "fp long"), simhash.Settings(most_entries=most))
    got = {r.node: r.component for r in simhash.components(found).collect()}
    want = plain_groups([(k, p) for k, p in enumerate(prints)])
    by_want, by_got = {}, {}
    for (k, c), p in zip(want, prints):
        by_want.setdefault(c, set()).add(k)
        by_got.setdefault(got.get(p, p), set()).add(k)
    assert sorted(map(sorted, by_got.values())) == sorted(map(sorted, by_want.values()))


def test_links_grow_with_rows_not_pairs(shared):
    prints = shared.range(2048).select(F.col("id").alias("fp"))  # eleven free bits in one half: over 200,000 linked pairs
    found = simhash.links(prints)
    assert found.count() < 40 * 2048 and simhash.components(found).select("component").distinct().count() == 1


# ---------------------------------------------------------------- fill-in-middle


def units(t):
    return re.findall("[A-Za-z]+|[^A-Za-z]", t)


def test_frames_seek_like_the_units(monkeypatch):
    rng = random.Random(1)
    for size in (5, 64):
        for _ in range(120):
            t = "".join(rng.choice(["a", "Bc", " ", "é", "日", "\n", ".", "xyz", "😀"]) for _ in range(rng.randint(0, 150)))
            data, step, writer = t.encode(), rng.randint(1, 50), fim.FrameWriter(size)
            for at in range(0, len(data), step):
                writer.write(data[at : at + step])
            reader, parts = fim.FrameReader(writer.finish()), units(t)
            assert (reader.units, reader.chars, reader.bytes) == (len(parts), len(t), len(data))
            for u in range(len(parts) + 1):
                before = "".join(parts[:u])
                assert reader.place(u) == (len(before.encode()), len(before))


def test_seeking_opens_only_the_frames_of_the_cut():
    writer = fim.FrameWriter()
    writer.write((prose(1, 200_000)).encode())
    reader = fim.FrameReader(writer.finish())
    reader.place(reader.units // 2)
    assert len(reader.frames) > 30 and reader.read == 1


def test_damaged_frames_are_noticed():
    writer = fim.FrameWriter()
    writer.write(prose(2, 500).encode())
    (frame,) = writer.finish()
    bad = bytearray(frame.data)
    bad[len(bad) // 2] ^= 255
    with pytest.raises(Exception):
        b"".join(fim.FrameReader([frame._replace(data=bytes(bad))]).span(0, frame.bytes))


def middled(i, t):
    t = t or ""
    n = len(units(t))
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units(t)[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_of_odd_rows(shared, odd_docs, no_docs):
    more = [(100 + k, prose(k, 30) + tail, None, None, 0, None, 0, None, 0, 0) for k, tail in enumerate(["<P>", "<S", "P>", "<", "😀 <M>", "é", "\x00", "<P"] * 8)]
    docs = odd_docs.unionByName(shared.createDataFrame(more, odd_docs.schema)).withColumn("frames", F.lit(1)).withColumn("marked", F.lit("?"))
    stored = frames.written(fim.store(docs), "frames")
    done = fim.transform(stored)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        n, form, p, m, out = middled(r.doc_id, r.text)
        want[(r.doc_id, n, form, p, m, sha(out), sha(r.text or ""), out)] += 1
    got = Counter()
    for r in fim.opened(done, "output", "out").collect():
        got[(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256, bytes(r.out).decode())] += 1
    assert got == want
    assert {k[2] for k in want} == {"plain", "psm", "spm"}
    assert fim.transform(fim.store(no_docs)).count() == 0
