"""Personal data: base patterns, and spans that boosted trees select among proposed candidates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportia.llm.common import stored

# The base patterns, written so that each place of a text is tried once. A look-behind, or the
# end of the match before, stands for the starts that a longer run has already ruled out.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Quick tests that a text without any match of a kind fails.
HINTS = {"email": "@", "ip": ".", "card": r"[0-9](?:[\x20-]?[0-9]){15}+", "phone": "+"}
OCTETS = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?(?:\.|$)){4}$"
KINDS = tuple(PATTERNS)
#: Generators of candidates: many more spans than are personal data, overlapping. None starts or ends inside a
#: longer run of its own signs, and none cuts a run off.
AT, DOT = r"(?:@|\x20@\x20|\x20?[\[(]at[\])]\x20?)", r"(?:\.|\x20\.\x20|\x20?[\[(]dot[\])]\x20?)"
GENERATORS = {
    "email_like": rf"(?:(?<![\p{{L}}0-9._%+-])|\G)[\p{{L}}0-9._%+-]++{AT}[\p{{L}}0-9-]++(?:{DOT}[\p{{L}}0-9-]++)++",
    "number_like": r"(?<![\p{L}0-9_])[+(]?[0-9](?:[\x20()./-]{0,3}[0-9]){6,}+(?![\p{L}0-9_])",
    "dotted_like": r"(?<![\p{L}0-9_.])[0-9]{1,3}(?:\x20?\.\x20?[0-9]{1,3}){3}(?![\p{L}0-9_])",
    "code_like": r"(?<![\p{L}0-9+/_=-])(?=[^\s0-9]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}+=*+(?![\p{L}0-9])",
    "quoted_like": r"(?<=[=:]\x20{0,2}[\x22\x27])[^\s\x22\x27]{8,}+(?=[\x22\x27])",
    "account_like": r"(?<![\p{L}0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,}+(?:\x20?[A-Z0-9]{1,3})?+(?![\p{L}0-9_])",
}
GENERATOR_HINTS = {
    "email_like": r"@|[\[(]at[\])]", "number_like": r"[0-9](?:[\x20()./-]{0,3}[0-9]){6}+", "dotted_like": r"[0-9]\x20?\.\x20?[0-9]",
    "code_like": r"[A-Za-z0-9+/_-]{16}", "quoted_like": r"[=:]\x20{0,2}[\x22\x27]", "account_like": r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
}
DATE = r"^(?:[0-9]{4}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./][0-9]{4})(?:[^0-9].*)?$"
CONTEXT = {"mail": r"mail|contact|write", "call": r"phone|tel|call|fax|mobile", "pay": r"card|visa|account|pay", "net": r"\bip\b|host|server|addr",
    "secret": r"token|secret|passw|api.?key|access.?key|auth|credential|bearer", "bank": r"iban|account|bank",
    "other": r"commit|sha|md5|hash|checksum|etag|order|invoice|item|version|release|isbn|href|class|page|sum|total|part|file",
}
BEFORE = 24
PLANTED_PER_DOC, AROUND = 4, 40
SAMPLE_DOCS, ROUNDS, TREE_DEPTH, PRECISION = 10_000, 10, 3, 0.98
MATCH = "array<struct<kind: string, start: int, stop: int, text: string, fine: boolean>>"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the digits of a text pass the check sum of payment cards."""
    d = F.reverse(digits(text))
    at = lambda i: F.substring(d, i, F.lit(1)).cast("int")
    twice = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda s, i: s + F.when(i % 2 == 0, twice(at(i))).otherwise(at(i))
    )
    return total % 10 == 0


def valid(kind: str, text: Column) -> Column:
    n = F.length(digits(text))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return text.rlike(OCTETS)
    if kind == "card":
        return F.when(n.between(16, 19), luhn(text)).otherwise(F.lit(False))
    return n.between(8, 15)


def matches(text: str, kind: str, pattern: str, fine, hint: Column) -> Column:
    """All matches of a pattern with their places in code points: what lies between matches gives the places."""
    col = F.col(text)
    found = F.zip_with(
        F.regexp_extract_all(col, F.lit(pattern), F.lit(0)), F.split(col, pattern, -1),
        lambda m, gap: F.struct(m.alias("m"), F.length(gap).alias("gap")),
    )
    step = lambda acc, x: F.when(x["m"].isNull(), acc).otherwise(F.struct(
        (acc["at"] + x["gap"] + F.length(x["m"])).alias("at"),
        F.concat(acc["out"], F.array(F.struct(
            F.lit(kind).alias("kind"), (acc["at"] + x["gap"]).alias("start"),
            (acc["at"] + x["gap"] + F.length(x["m"])).alias("stop"), x["m"].alias("text"),
            F.coalesce(fine(x["m"]), F.lit(False)).alias("fine"),
        ))).alias("out"),
    ))
    none = F.array().cast(MATCH)
    listed = F.aggregate(found, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(hint, listed).otherwise(none)


def base_matches(text: str) -> Column:
    """Matches of all base patterns, in the order of the kinds, those that fail their check marked."""
    hint = lambda k: F.col(text).contains(HINTS[k]) if len(HINTS[k]) == 1 else F.col(text).rlike(HINTS[k])
    return F.concat(*[matches(text, k, p, lambda m, k=k: valid(k, m), hint(k)) for k, p in PATTERNS.items()])


def candidates(text: str) -> Column:
    return F.concat(*[
        matches(text, k, p, lambda m: F.lit(True), F.col(text).rlike(GENERATOR_HINTS[k])) for k, p in GENERATORS.items()
    ])


def mod97(text: Column) -> Column:
    """Remainder of the check of bank account numbers: the first four signs go last, letters count from ten."""
    plain = F.regexp_replace(F.upper(text), "[^A-Z0-9]", "")
    signs = F.split(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4)), "")
    value = lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(
        F.filter(signs, lambda c: c != ""), F.lit(0), lambda acc, c: ((acc * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97).cast("int")
    )


def overlapping(spans: Column, c: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"]))


def features(text: str, c: Column) -> dict[str, Column]:
    """Format of a candidate and what stands around it, without the signs that the base patterns ask for."""
    body = c["text"]
    near = F.lower(F.substring(F.col(text), F.greatest(c["start"] - BEFORE + 1, F.lit(1)), F.least(c["start"], F.lit(BEFORE))))
    after = F.substring(F.col(text), c["stop"] + 1, F.lit(1))
    count = lambda chars: F.length(body) - F.length(F.regexp_replace(body, chars, ""))
    yes = lambda x: F.when(x, 1).otherwise(0)
    n = F.length(digits(body))
    out = {k: yes(c["kind"] == k) for k in GENERATORS if k != "number_like"} | {
        "length": F.length(body), "digits": n, "letters": count(r"\p{L}"), "capitals": count(r"\p{Lu}"), "dots": count(r"\."), "dashes": count("-"),
        "blanks": count(" "), "slashes": count("/"), "brackets": count(r"[()\[\]]"),
        "luhn": yes(n.between(16, 19) & luhn(body)), "octets": yes(F.regexp_replace(body, " ", "").rlike(OCTETS)),
        "mod97": yes(body.rlike(r"^[A-Z]{2}[0-9]{2}") & F.length(body).between(12, 60) & (mod97(body) == 1)),
        "distinct": F.size(F.array_distinct(F.split(F.lower(body), ""))), "switches": F.size(F.regexp_extract_all(body, F.lit(r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])"), F.lit(0))),
        "hex": yes(body.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")), "date": yes(body.rlike(DATE)),
        "word_before": yes(near.rlike(r"[\p{L}0-9]$")), "word_after": yes(after.rlike(r"[\p{L}0-9]")),
        "assigned": yes(near.rlike(r"[=:]\x20{0,2}[\x22\x27]?$")), "quote_before": yes(near.rlike(r"[\x22\x27]$")), "quote_after": yes(after.rlike(r"[\x22\x27]")),
    }
    return out | {f"near_{k}": yes(near.rlike(p)) for k, p in CONTEXT.items()}


def one_of(seed: Column, *choices: str | Column) -> Column:
    """One of the choices, by a digest."""
    return F.element_at(F.array(*[F.lit(c) if isinstance(c, str) else c for c in choices]), (F.pmod(seed, F.lit(len(choices))) + 1).cast("int"))


def planted(pick) -> list[tuple]:
    """Made examples as (before, value, after, label). ``pick(n)`` are digests that choose forms.

    Signs come from the columns hx (64 hexadecimal), dg (30 decimal), coded (40 of base 64), card (16 decimal that
    pass the check sum), uncard (that fail it), bban and iban (without and with check digits).
    """
    cut = lambda *ends: F.concat(*[F.lit(e) if isinstance(e, str) else F.substring("dg", *e) for e in ends])
    hexed = lambda n: F.substring("hx", 1, n)
    secret = one_of(
        pick(1), hexed(40), F.col("hx"), hexed(32), F.upper(hexed(40)), F.col("coded"), F.substring("coded", 3, 24),
        F.concat(F.lit("k_"), F.regexp_replace(F.substring("coded", 1, 30), "[+/]", "x")),
    )
    name = one_of(pick(2), "token", "api_key", "secret", "password", "auth token", "access_key", "credential", "TOKEN", "Secret")
    octets = [F.pmod(pick(30 + i), F.lit(256)).cast("string") for i in range(4)]
    fours = lambda col, sep, n: F.concat_ws(sep, *[F.substring(col, 1 + 4 * i, 4) for i in range(n)])
    user = F.concat(one_of(pick(4), "ana", "j.doe", "info", "maria_k"), cut((1, 2)))
    day = F.date_add(F.lit("1990-01-01").cast("date"), F.pmod(pick(5), F.lit(14_000)).cast("int"))
    blank = F.lit(" ")
    good = [
        (F.concat(name, one_of(pick(6), ' = "', ': "', '="', "='", ' : "')), secret, one_of(pick(6), '"', '"', '"', "'", '"')),
        (F.concat(name, one_of(pick(7), ": ", " = ", "=", " ")), secret, blank),
        (one_of(pick(8), "call ", "phone: ", "tel. ", "mobile ", "fax "), one_of(
            pick(9), cut((1, 3), " ", (4, 3), " ", (7, 4)), cut("(", (1, 3), ") ", (4, 3), "-", (7, 4)), cut((1, 3), "-", (4, 3), "-", (7, 4)),
        ), blank),
        (one_of(pick(10), "write to ", "mail ", "contact "), F.concat(
            user, one_of(pick(11), " [at] ", " (at) ", " @ ", "[at]"), F.lit("host"), one_of(pick(11), " [dot] ", " (dot) ", " . ", "[dot]"), one_of(pick(12), "com", "org", "net"),
        ), blank),
        (one_of(pick(13), "host ", "server ", "ip "), F.concat_ws(" . ", *octets), blank),
        (one_of(pick(14), "account ", "IBAN ", "bank: "), one_of(pick(15), F.col("iban"), fours("iban", " ", 6)), blank),
        (one_of(pick(16), "card ", "visa ", "pay with "), one_of(pick(17), fours("card", ".", 4), fours("card", "/", 4), fours("card", " - ", 4)), blank),
    ]
    bad = [
        (one_of(pick(18), "commit ", "sha1 ", "md5: ", "checksum: ", "etag "), one_of(pick(19), hexed(40), hexed(32), F.col("hx")), blank),
        (one_of(pick(20), 'sha256 = "', 'checksum: "', 'hash="'), F.col("hx"), F.lit('"')),
        (one_of(pick(21), "order no. ", "invoice ", "item ", "total ", "isbn "), one_of(pick(22), cut((1, 8)), cut((1, 10)), cut((1, 3), "-", (4, 9)), cut((1, 7))), blank),
        (one_of(pick(23), "on ", "since ", "at "), one_of(pick(24), F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "dd.MM.yyyy"), F.date_format(day, "yyyy-MM-dd HH")), blank),
        (one_of(pick(25), "version ", "release "), cut((1, 1), ".", (2, 2), ".", (4, 1), ".", (5, 2)), blank),
        (one_of(pick(26), 'href = "', 'class="', 'file: "', 'page = "'), F.concat(one_of(pick(27), "section-heading-", "archive/", "img_page_", "/docs/part-"), cut((1, 3), "-text")), F.lit('"')),
        (one_of(pick(28), "see ", "in ", "file "), cut("/archive/", (1, 4), "/section-heading-", (5, 2)), blank),
        (one_of(pick(34), "card ", "visa ", "number ", "and ", "see "), one_of(pick(35), F.col("uncard"), F.col("uncard"), fours("uncard", ".", 4), fours("uncard", " ", 4), F.col("dg")), blank),
        (one_of(pick(29), "part ", "item "), fours(F.concat(F.lit("AB"), F.substring("dg", 1, 18)), " ", 5), blank),
    ]
    return [(*example, label) for label, made in ((1.0, good), (0.0, bad)) for example in made]


def planted_candidates(sample: DataFrame) -> DataFrame:
    """Labelled candidates of made examples, each put where a word ends in its document's text.

    A document gets PLANTED_PER_DOC of the examples, with AROUND signs of its text on both sides. Candidates
    that are the whole value of a positive example have label 1; those that are part of it or reach beyond it,
    and all over a negative one, 0; others have none.
    """
    pick = lambda n: F.xxhash64("doc_id", "k", F.lit(n))
    examples = planted(pick)
    at = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.length("text") + 1).cast("int")
    placed = sample.select(
        "doc_id", F.regexp_replace(F.substring("text", F.greatest(at - AROUND + 1, F.lit(1)), F.least(at, F.lit(AROUND))), r"\S+$", "").alias("left"),
        F.regexp_replace(F.substring("text", at + 1, F.lit(AROUND)), r"^\S+", "").alias("right"),
        F.explode(F.transform(
            F.sequence(F.lit(0), F.lit(PLANTED_PER_DOC - 1)), lambda j: F.pmod(F.xxhash64("doc_id", F.lit("kinds")) + 4 * j, F.lit(len(examples))).cast("int"),
        )).alias("k"),
    ).withColumn("hx", F.sha2(F.concat_ws("/", F.lit("planted"), "k", F.col("doc_id").cast("string")), 256))
    signed = stored(placed.withColumn("dg", F.rpad(F.regexp_replace("hx", "[a-f]", ""), 30, "7203481956")).withColumn(
        "coded", F.substring(F.base64(F.unhex("hx")), 1, 40)
    ).withColumn("bban", F.concat(one_of(pick(3), "DE", "ES", "FR", "IT"), F.lit("00"), F.substring("dg", 1, 18))))
    head = F.substring("dg", 1, 15)
    check = F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: i.cast("string")), lambda i: luhn(F.concat(head, i)))
    made = stored(signed.withColumn("check", F.element_at(check, 1).cast("int")).withColumn("card", F.concat(head, F.col("check").cast("string"))).withColumn(
        "uncard", F.concat(head, ((F.col("check") + 1) % 10).cast("string"))
    ).withColumn(
        "iban", F.concat(F.substring("bban", 1, 2), F.lpad((98 - mod97(F.col("bban"))).cast("string"), 2, "0"), F.substring("bban", 5, 18))
    ))
    chosen = lambda i: F.coalesce(*[F.when(F.col("k") == k, e[i]) for k, e in enumerate(examples)])
    texts = stored(made.select("doc_id", "left", "right", *[chosen(i).alias(n) for i, n in enumerate(("before", "value", "after"))], F.element_at(
        F.array(*[F.lit(e[3]) for e in examples]), F.col("k") + 1
    ).alias("sort")).select(
        "doc_id", "sort", (F.length("left") + F.length("before")).alias("start"), F.length("value").alias("size"),
        F.concat("left", "before", "value", "after", "right").alias("text"),
    ))
    found = texts.withColumn("c", F.explode(candidates("text")))
    whole = (F.col("c.start") == F.col("start")) & (F.col("c.stop") == F.col("start") + F.col("size"))
    touches = (F.col("c.start") < F.col("start") + F.col("size")) & (F.col("start") < F.col("c.stop"))
    return found.where(touches).withColumn("label", F.when(whole, F.col("sort")).otherwise(0.0)).select("doc_id", "text", "c", "label")


def weak_label(base: str, c: Column) -> Column:
    """1 over a base span, 0 over a match that failed its check and over dates; other candidates have no label."""
    ok = F.filter(base, lambda b: b["fine"])
    failed = F.filter(base, lambda b: ~b["fine"])
    return F.when(overlapping(ok, c), 1.0).when(overlapping(failed, c) | c["text"].rlike(DATE), 0.0)


@dataclass
class Trees:
    """Boosted trees as nested choices, with the score from which a candidate is taken."""

    parts: list[tuple[float, object]]
    threshold: float = 2.0

    def score(self, values: list[Column]) -> Column:
        def choice(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, bound, left, right = node
            return F.when(values[feature] <= bound, choice(left)).otherwise(choice(right))

        total = F.lit(0.0)
        for weight, tree in self.parts:
            total = total + F.lit(weight) * choice(tree)
        return 1 / (1 + F.exp(-2 * total))


def read_tree(node):
    """A fitted tree as (feature, bound, left, right) or a leaf's value."""
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), read_tree(node.leftChild()), read_tree(node.rightChild())


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, precision: float = PRECISION) -> Trees:
    """Boosted trees on the candidates of at most ``sample_docs`` documents, those of the least id digest.

    Labels come from examples planted into their texts (planted_candidates) and from the base patterns
    (weak_label). Half of the documents are learnt from; on the others
    the threshold is set, the least score from which the labels agree to ``precision``, candidates over base
    spans left out, since these are never added. Without labels of
    both sorts nothing is learnt and no candidate is taken.
    """
    ids = docs.where("doc_id is not null and text is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    seen = (
        sample.withColumn("base", base_matches("text")).withColumn("c", F.explode(candidates("text")))
        .withColumn("label", weak_label("base", F.col("c"))).where("label is not null").select("doc_id", "text", "c", "label")
    )
    found = seen.withColumn("apart", F.col("label") == 0).unionByName(planted_candidates(sample).withColumn("apart", F.lit(True)))
    named = features("text", F.col("c"))
    rows = stored(found.select(
        (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)) == 0).alias("learn"), "apart", "label", *[v.cast("double").alias(k) for k, v in named.items()]
    ))
    if rows.where("learn").select("label").distinct().count() < 2:
        return Trees([])
    ready = VectorAssembler(inputCols=list(named), outputCol="features").transform(rows.where("learn"))
    fitted = GBTClassifier(maxIter=ROUNDS, maxDepth=TREE_DEPTH, seed=11, subsamplingRate=1.0).fit(ready)
    parts = [
        (w, read_tree(t._call_java("rootNode"))) for w, t in zip(fitted.treeWeights, fitted.trees)
    ]
    trees = Trees(parts)
    scores = rows.where("not learn and apart").select("label", F.floor(trees.score([F.col(k) for k in named]) * 100).alias("score"))
    kept = good = 0
    for row in scores.groupBy("score").agg(F.count("*").alias("n"), F.sum("label").alias("good")).orderBy(F.desc("score")).collect():
        kept, good = kept + row["n"], good + row["good"]
        if good < precision * kept:
            break
        trees.threshold = row["score"] / 100
    return trees


def selected(text: str, base: str, cands: str, trees: Trees) -> Column:
    """Candidates apart from base spans that score enough; of those that overlap, the first."""
    if not trees.parts:
        return F.array().cast(MATCH)
    apart = F.filter(cands, lambda c: ~overlapping(F.filter(base, lambda b: b["fine"]), c))
    known = F.transform(apart, lambda c: F.struct(c.alias("c"), F.array(*[v.cast("double") for v in features(text, c).values()]).alias("x")))
    values = lambda k: [k["x"][i] for i in range(len(features(text, k["c"])))]
    enough = F.transform(F.filter(known, lambda k: trees.score(values(k)) >= trees.threshold), lambda k: k["c"])
    rank = F.array_sort(enough, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["stop"] - a["stop"]))
    return F.aggregate(
        rank, F.array().cast(MATCH),
        lambda acc, c: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] > c["start"]), acc).otherwise(F.concat(acc, F.array(c))),
    )


def found_in(docs: DataFrame, trees: Trees) -> DataFrame:
    """Each row of docs as ``row``, with ``base`` and ``added``: kind, start, stop (code points), text.

    base: matches of the base patterns that pass their checks, by kind as listed, then by start. added: what
    the trees select besides. Null and empty texts have no spans; repeated rows are each searched; an empty
    table gives no rows; other columns, whatever their names, stay in ``row``.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce("text", F.lit("")).alias("body"))
    some = packed.withColumn("all", base_matches("body")).withColumn("cands", candidates("body"))
    return some.select("row", F.filter("all", lambda m: m["fine"]).alias("base"), selected("body", "all", "cands", trees).alias("added"))


def of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def listed(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
