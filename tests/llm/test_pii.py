"""Base spans against the patterns as stated, and what the trees add."""

import random
import re
from collections import Counter

import pytest

from apportia.llm import pii

STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum((2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0


def passes(kind, text):
    d = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        return 16 <= len(d) <= 19 and luhn(d)
    return kind == "email" or 8 <= len(d) <= 15


def plain(text):
    return [(k, m.start(), m.end()) for k, p in STATED.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, row string, base string")


def base_of(spark, texts, trees=None):
    rows = pii.found_in(frame(spark, texts), trees or pii.Trees([])).collect()
    return {r.row.doc_id: [(s.kind, s.start, s.stop) for s in r.base] for r in rows}, rows


def test_base_spans_of_random_texts(spark):
    pick = random.Random(12)
    texts = ["".join(pick.choices("a@.b-+ 0123456789().%_é😀\n", k=pick.randint(0, 160))) for _ in range(1500)]
    texts += ["".join(pick.choices("0123456789 -.+", k=pick.randint(10, 120))) for _ in range(1500)]
    texts += ["".join(pick.choices("a.@-_b", k=pick.randint(5, 60))) for _ in range(1500)]
    for _ in range(300):
        number = [pick.choice("0123456789") for _ in range(pick.randint(15, 20))]
        for c in "0123456789":
            number[-1] = c
            if luhn("".join(number)):
                break
        texts.append(pick.choice(["é ", "", "1", "- "]) + "".join(c + pick.choice(["", "", " ", "-"]) for c in number) + pick.choice(["", "x", ".5"]))
    texts += [".".join(str(pick.choice([0, 7, 99, 100, 199, 200, 249, 250, 255, 256, 999, "007", "0255", "0256"])) for _ in range(pick.randint(3, 6))) for _ in range(500)]
    got, _ = base_of(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == plain(t), t


@pytest.mark.parametrize("text, counts", [
    (None, {}), ("", {}), ("a" * 300_000, {}), ("1" * 300_000, {}), ("1 " * 150_000, {}), ("1." * 20_000, {"ip": 5_000}), ("+" * 100_000, {}),
    ("+1" + " " * 200_000, {}), ("a@" * 100_000, {}), ("a@b" + ".c" * 100_000, {"email": 1}),
    ("word " * 60_000 + "x@y.zz +1 202 555 0100, 10.0.0.1", {"email": 1, "ip": 1, "phone": 1}),
    ("é" * 60_000 + " 4111-1111-1111-1111", {"card": 1}),
])
def test_long_and_empty_texts(spark, text, counts):
    got, rows = base_of(spark, [text])
    assert Counter(k for k, _, _ in got[0]) == counts and rows[0].added == []


def test_no_rows_and_repeated_rows(spark):
    assert pii.found_in(frame(spark, []).limit(0), pii.Trees([])).collect() == []
    assert pii.fit(frame(spark, []).limit(0)).parts == []
    same = frame(spark, ["x@y.zz"]).union(frame(spark, ["x@y.zz"]))
    assert [len(r.base) for r in pii.found_in(same, pii.Trees([])).collect()] == [1, 1]


def test_trees_add_what_looks_alike(spark):
    """Numbers written like phones but without a plus have no label; they are taken, dates are not."""
    pick = random.Random(5)
    number = lambda: f"{pick.randint(20, 99)} {pick.randint(100, 999)} {pick.randint(1000, 9999)}"
    texts = [f"call me at +{number()} soon" for _ in range(300)] + [f"on {pick.randint(1900, 2030)}-0{pick.randint(1, 9)}-{pick.randint(10, 28)} it rained" for _ in range(300)]
    texts += [f"sum {' '.join(str(pick.randint(1000, 9999)) for _ in range(4))}1 paid" for _ in range(200)]
    texts += [f"call me at {number()} soon" for _ in range(30)]
    df = frame(spark, texts)
    trees = pii.fit(df)
    assert trees.parts and trees.threshold <= 1
    rows = pii.found_in(df, trees).collect()
    added = {r.row.doc_id: [(s.start, s.stop) for s in r.added] for r in rows}
    assert not any(added[i] for i in range(300, 600)) and not any(added[i] for i in range(300))
    assert sum(bool(added[i]) for i in range(800, 830)) >= 25
    for r in rows:
        assert all(r.row.text[s.start : s.stop] == s.text for s in [*r.base, *r.added])
        assert not any(a.start < b.stop and b.start < a.stop for a in r.added for b in r.base)


def test_secrets_are_whole_and_lookalikes_stay(spark):
    """Forms of which the fit knows no text: what is added is the whole value, and nothing inside other runs."""
    pick = random.Random(9)
    hexed = lambda n: "".join(pick.choices("0123456789abcdef", k=n))
    words = lambda: " ".join(pick.choices("ein weg the por calle enon rue house".split(), k=12))
    def failing():
        while luhn(n := "".join(pick.choices("0123456789", k=16))):
            pass
        return n
    cases = [("secret", f'token = "{{}}"', hexed(40)) for _ in range(40)] + [("secret", 'PASSWORD="{}"', "Zq7x" + hexed(20)) for _ in range(40)]
    cases += [("mail", "write to {} please", f"jo{i}[at]mailer[dot]org") for i in range(40)]
    cases += [("none", "commit {} was", hexed(40)) for _ in range(40)] + [("none", "und {} ist", failing()) for _ in range(80)]
    cases += [("none", "am {} kam", f"{pick.randint(1950, 2020)}-0{pick.randint(1, 9)}-1{pick.randint(0, 9)}") for _ in range(40)]
    cases += [("none", "order no. {} came", str(pick.randint(10**8, 10**9))) for _ in range(40)]
    texts = [f"{words()} {form.format(value)} {words()}" for _, form, value in cases]
    trees = pii.fit(frame(spark, texts + [words() for _ in range(400)]))
    rows = pii.found_in(frame(spark, texts), trees).collect()
    added = {r.row.doc_id: [s.text for s in r.added] for r in rows}
    wanted = [i for i, c in enumerate(cases) if c[0] != "none"]
    assert all(set(added[i]) <= {cases[i][2]} for i in wanted)
    assert sum(added[i] == [cases[i][2]] for i in wanted) >= 0.9 * len(wanted)
    assert sum(bool(added[i]) for i, c in enumerate(cases) if c[0] == "none") <= 0.02 * len(cases)


def test_account_check(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("DE89 3704 0044 0532 0130 00",), ("GB82WEST12345698765432",), ("DE88370400440532013000",), ("",)], "t string")
    assert [r[0] == 1 for r in df.select(pii.mod97(F.col("t"))).collect()] == [True, True, False, False]


def test_long_runs_of_every_generator(spark):
    """Runs without end or that just miss a pattern take time in proportion and are never cut."""
    texts = ["a1" * 100_000, "A1" * 100_000, "1-" * 100_000, 'x="' + "b" * 200_000, "é" * 200_000 + "@", "AB12" + " CD34" * 40_000, "=" * 100_000, "1." * 50_000]
    df = frame(spark, texts)
    from pyspark.sql import functions as F

    found = df.select("doc_id", F.explode(pii.candidates("text")).alias("c")).select("doc_id", "c.kind", "c.start", "c.stop").collect()
    whole = {(r.doc_id, r.kind): (r.start, r.stop) for r in found}
    assert whole[0, "code_like"] == (0, 200_000) and whole[1, "code_like"] == (0, 200_000) and whole[2, "number_like"] == (0, 199_999)
    assert whole[5, "account_like"] == (0, len(texts[5])) and not any(r.doc_id in (4, 6) for r in found)


def test_listing(spark):
    from pyspark.sql import functions as F

    row = pii.found_in(frame(spark, ["é x@y.zz 10.0.0.1"]), pii.Trees([])).select(pii.listed(F.col("base"))).first()
    assert row[0] == "email:2:8,ip:9:17"
