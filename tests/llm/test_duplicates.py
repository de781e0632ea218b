"""Line dedup, substring removal, decontamination and the Jaccard join against brute force."""

import hashlib
import random
from itertools import combinations

import pytest

from apportia.llm import components, decontamination, jaccard, lines, substrings
from apportia.llm.toxicity import TOKENS


def sentence(pick, n):
    return " ".join(pick.choice(["ba", "ko", "mi", "tu", "re", "sol", "fa", "ut"]) + str(pick.randint(0, 400)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Fresh, copied, edited and overlapping texts, some of them odd."""
    pick = random.Random(4)
    texts = [sentence(pick, pick.randint(1, 150)) for _ in range(60)]
    texts = ["\n".join(" ".join(t.split()[i : i + 14]) for i in range(0, len(t.split()), 14)) for t in texts]
    passage = sentence(pick, 70)
    for i in range(0, 40, 4):
        texts[i] += "\n" + passage + "\n" + sentence(pick, 9)
    for i in range(30):
        words = pick.choice(texts[:60]).split(" ")
        for _ in range(pick.randint(0, 4)):
            words[pick.randrange(len(words))] = "edit"
        texts.append(" ".join(words))
    base = sentence(pick, 120)
    for i in range(40):
        texts.append(base + f" tail{i} {i}")
    texts += [None, "", " \n", "!!!", "!!!", "one two", "One  two", "two one", "x" * 1500, "ab" * 900, "é" * 700, "é" * 699]
    return list(enumerate(texts))


def frame(spark, rows, *more):
    return spark.createDataFrame([(d, t, "x", "y") for d, t in [*rows, *more]], "doc_id long, text string, row string, n_links string")


def test_substrings_brute(spark, corpus):
    rows = [*corpus, (5, corpus[5][1])]
    df = frame(spark, rows)
    for length in (400, 64):
        want = {}
        for (d, t), spans in zip(rows, substrings.brute_spans([t for _, t in rows], length)):
            want.setdefault((d, t), []).append(spans)
        got = substrings.without_repeats(df, length).collect()
        assert len(got) == len(rows)
        for r in got:
            body, spans = (r.row.text or "").encode(), [(s.start, s.stop) for s in r.spans]
            assert spans in want[r.row.doc_id, r.row.text], (length, r.row.doc_id)
            kept = b"".join(body[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(body)]))
            assert bytes(r.kept) == kept and r.n_bytes == len(body) and r.n_removed == len(body) - len(kept)
    assert substrings.without_repeats(df.limit(0)).collect() == []


def test_anchors_cross_segments(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SEGMENT", 700)
    pick = random.Random(9)
    long = sentence(pick, 900)
    rows = [(1, long), (2, sentence(pick, 50) + long[1000:4000] + sentence(pick, 80))]
    got = {r.row.doc_id: [(s.start, s.stop) for s in r.spans] for r in substrings.without_repeats(frame(spark, rows)).collect()}
    assert [got[1], got[2]] == substrings.brute_spans([t for _, t in rows], 400)


def brute_lines(rows, rare_words):
    """Kept text of each (id, text): leaders by scanning, blocks from all links."""
    keys = {}
    for d, t in rows:
        if t is not None and d is not None:
            keys.setdefault((d, t), list(lines.keys_of(t, rare_words)))
    lead = {}
    for (d, t), found in sorted(keys.items()):
        for key, number, _, _ in found:
            lead.setdefault(key, (d, t, number))
    out = {}
    for (d, t), found in keys.items():
        links = [(*lead[k], n, p, rare) for k, n, p, rare in found if lead[k][:2] != (d, t)]
        gone = {i for a, b, _ in lines.blocks(links) for i in range(a, b + 1)}
        out[d, t] = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    return out


def test_lines_brute(spark, corpus):
    rows = [*corpus, (5, corpus[5][1]), (None, corpus[4][1])]
    got = lines.deduplicated(frame(spark, rows)).collect()
    want = brute_lines(rows, lines.RARE_WORDS)
    assert len(got) == len(rows)
    for r in got:
        key = (r.row.doc_id, r.row.text)
        assert r.kept == want.get(key, r.row.text), key
    assert sum(len(r.gone) > 0 for r in got) > 30
    assert lines.deduplicated(frame(spark, []).limit(0)).collect() == []


def test_line_blocks(spark):
    a, b, c = (f"line {x} with more than eight words in it, really" for x in "abc")
    rows = [(1, f"{a}\nyes.\n\n{b}\nno."), (2, f"new one\n{a}\nyes.\n \n{b}\nend here"), (3, f"{b}\n{a}"), (4, "yes.\nno."), (5, f"  {c} \n{a} x"),
            (6, c.replace(" ", "  "))]
    got = {r.row.doc_id: r.kept for r in lines.deduplicated(frame(spark, rows)).collect()}
    assert got == {1: rows[0][1], 2: "new one\nend here", 3: b, 4: "yes.\nno.", 5: rows[4][1], 6: ""} or got[3] == a
    assert {got[1], got[2], got[4], got[5], got[6]} == {rows[0][1], "new one\nend here", "yes.\nno.", rows[4][1], ""}


def test_lines_left_over_are_aligned_with_later_partners(spark):
    x = [f"line {i} with more than eight words in it, really" for i in range(6)]
    copy, turned = "\n".join(x), "\n".join(x[::-1])
    halves = "\n".join([*x[3:], *x[:3]])
    rows = [(1, turned), *[(i, copy) for i in range(2, 9)], (9, "ahead\n" + copy), (10, halves), (11, "\n".join([x[5], x[1], x[4], x[0]])), (12, halves + "\nend")]
    got = {r.row.doc_id: r.kept for r in lines.deduplicated(frame(spark, rows)).collect()}
    assert got[1] == turned and len(got[2].split("\n")) == 5
    assert [got[i] for i in range(3, 10)] == [""] * 6 + ["ahead"] and got[12] == "end"

    pick = random.Random(3)
    rows = [(i, "\n".join(pick.sample(x, pick.randint(2, 6)))) for i in range(60)]
    keys = {d: {k: (n, p) for k, n, p, _ in lines.keys_of(t, lines.RARE_WORDS)} for d, t in rows}
    for r in lines.deduplicated(frame(spark, rows)).collect():
        d, gone = r.row.doc_id, {i for b in r.gone for i in range(b["first"], b["last"] + 1)}
        for p in range(d):
            pairs = [(keys[p][k][0], keys[d][k][1]) for k in keys[d] if k in keys[p]]
            assert set(lines.patience(pairs)) <= gone, (d, p)


def test_passages_of_short_lines(spark):
    verse = "\n".join(f"verse {i} has only six words" for i in range(9))
    few = "\n".join(f"few {i} has only six words" for i in range(8))
    long = "a line of more than eight words that is rare"
    han = "\n".join("".join(chr(0x4E00 + 31 * i + j) for j in range(20)) for i in range(2))
    rows = [(1, "before\n" + verse), (2, "other\nlines\n" + verse + "\nafter"), (3, "one\n" + few), (4, few + "\ntwo"),
            (5, "x\nyes.\nno.\n" + long), (6, "y\nyes.\nno.\n" + long), (7, "a\n" + han), (8, han + "\nb")]
    got = {r.row.doc_id: r.kept for r in lines.deduplicated(frame(spark, rows)).collect()}
    assert got == dict(rows) | {2: "other\nlines\nafter", 6: "y", 8: "b"}


def test_patience_is_longest_rise():
    assert lines.patience([(0, 5), (1, 1), (2, 2), (3, 9), (4, 3), (5, 4)]) == [1, 2, 3, 4]
    assert lines.patience([(0, 1), (0, 2), (1, 0)]) in ([1], [2], [0]) and lines.patience([]) == []


def test_every_deleted_line_stays_once(spark, corpus):
    got = lines.deduplicated(frame(spark, corpus)).collect()
    left = {" ".join(x.split()) for r in got if r.kept for x in r.kept.split("\n")}
    assert all(" ".join(x.split()) in left for _, t in corpus if t for x in t.split("\n") if len(x.split()) >= lines.RARE_WORDS)


def test_decontamination_brute(spark, corpus):
    pick = random.Random(8)
    items = [(i, sentence(pick, n)) for i, n in enumerate([5, 6, 9, 13, 30, 60])] + [(6, None), (7, ""), (8, None)]
    docs = [r for r in corpus if r[0] < 30]
    for n, (_, item) in enumerate(items[:6]):
        words = item.split()
        for step in (100, 5, 6, 3, 2):
            changed = [("swap" if j % step == step - 1 else x.upper()) for j, x in enumerate(words)]
            docs.append((1000 + 10 * n + step % 10, sentence(pick, 20) + "\n" + ", ".join(changed) + "\n" + sentence(pick, 20)))
        docs.append((2000 + n, sentence(pick, 12) + " " + " ".join(words[: len(words) * 2 // 3])))
    df = frame(spark, [*docs, docs[-1], (None, items[5][1]), (3000, items[5][1] + " word" * 100_000)])
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, seed string")
    got = {(r.doc_id, r.item_id) for r in decontamination.overlaps(df, bench).collect()}
    assert got == decontamination.brute_overlaps(docs, items) | {(3000, 5)}
    assert decontamination.overlaps(df.limit(0), bench).collect() == []
    assert decontamination.overlaps(df, bench.limit(0)).collect() == []


def test_masks_find_every_run():
    for unequal in combinations(range(decontamination.WINDOW), 2):
        assert any(
            all(s + k not in unequal for k, c in enumerate(m) if c == "1")
            for m in decontamination.MASKS[:2] for s in range(decontamination.WINDOW - len(m) + 1)
        )


def test_short_items_are_found_by_every_allowed_pattern(spark):
    pick, docs, items, want = random.Random(13), [], [], set()
    for n in range(1, 13):
        words = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(words)))
        allowed = n - -(-4 * n // 5)
        for spoilt in range(allowed + 2):
            for unequal in combinations(range(n), spoilt):
                changed = " ".join("swap" if i in unequal else x for i, x in enumerate(words))
                docs.append((len(docs), changed if pick.random() < 0.5 else f"{sentence(pick, 3)} {changed} {sentence(pick, 3)}"))
                want |= {(docs[-1][0], n)} if spoilt <= allowed else set()
    cut = [(len(docs) + n, " ".join(items[n - 1][1].split()[1:])) for n in range(5, 13)]
    want |= {(d, n) for n, (d, _) in zip(range(5, 13), cut)}
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.overlaps(frame(spark, [*docs, *cut]), bench).collect()}
    assert got == want
    assert decontamination.brute_overlaps(cut, items) == {x for x in want if x[0] >= len(docs)}


def brute_classes(rows, least=0.8):
    sets, keys = {}, {}
    for n, (d, t) in enumerate(rows):
        w = TOKENS.findall((t or "").lower())
        s = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        sets[n] = s or frozenset([("w", *w)] if w else [("t", t)] if (t or "").strip() else [("d", d)])
        keys[n] = sets[n]
    near = lambda a, b: bool(a) and len(a & b) >= least * len(a | b)
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    links = {n: set() for n in sets}
    for i in sets:
        for j in range(i):
            if near(sets[i], sets[j]):
                up[root(i)] = root(j)
                if sets[i] != sets[j]:
                    links[i].add(sets[j])
                    links[j].add(sets[i])
    members = {}
    for i in sets:
        members.setdefault(root(i), []).append(rows[i][0])
    return sorted(
        (rows[i][0], min(members[root(i)]), sum(keys[j] == keys[i] for j in keys), len(links[i])) for i in sets
    )


def test_jaccard_brute(spark, corpus, monkeypatch):
    rows = [*corpus, (5, corpus[5][1]), (7, "another text under an id that is taken, long enough")]
    want = brute_classes(rows)
    assert sorted(map(tuple, jaccard.classes(frame(spark, rows)).collect())) == want
    monkeypatch.setattr(jaccard, "cells", lambda m, g, block=8, whole=jaccard.cells: whole(m, g, 8))
    assert sorted(map(tuple, jaccard.classes(frame(spark, [*rows, (None, "x")])).collect())) == want
    assert jaccard.classes(frame(spark, rows).limit(0)).collect() == []
    assert [tuple(r) for r in jaccard.classes(frame(spark, [(1, None)])).collect()] == [(1, 1, 1, 0)]


def test_prefixes_shorten_until_recall():
    depths = [jaccard.prefix_depth(0.8, r) for r in (0.5, 0.9, 0.995, 0.99999)]
    assert depths == sorted(depths, reverse=True) and depths[0] == jaccard.DEPTH and depths[-1] < depths[1]
    k = jaccard.prefix_depth(0.8, 0.995)
    assert 1 - (1 - 0.8**k) ** jaccard.TREES >= 0.995 > 1 - (1 - 0.8 ** (k + 1)) ** jaccard.TREES


def test_components(spark):
    pick = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, x) for x in range(300, 400)] + [(5000, 5000)]
    edges += [(pick.randint(6000, 6100), pick.randint(6000, 6100)) for _ in range(60)]
    up = {}
    root = lambda x: x if up.setdefault(x, x) == x else root(up[x])
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    want = {x: root(x) for a, b in edges if a != b for x in (a, b)}
    pick.shuffle(edges)
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["class"] for r in got} == want and len(got) == len(want)


def test_digest_of_kept_is_stable():
    assert substrings.digest(b"") == int.from_bytes(hashlib.blake2b(b"", digest_size=8).digest(), "big", signed=True)
