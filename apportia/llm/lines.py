"""Line dedup: overlapping documents found by shared rare lines, aligned by patience diff."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apportia.llm.common import lean, stored

RARE_WORDS = 8
#: Aligned lines that follow each other go without a rare line among them where they have this many words together.
BLOCK_WORDS = 50
#: Consecutive short lines that are compared together; 50 words in lines of up to 7 are 8 lines, all in windows.
WINDOW_LINES = 4
#: Letters of scripts that leave no space between words.
UNSPACED = re.compile("[\u0e00-\u0eff\u0f40-\u0fbc\u1000-\u109f\u1780-\u17d3\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003134f]")
KEY_COLUMNS = "key,doc_id,digest,line,place,words"
DOC = ["doc_id", "digest"]


def words_of(line: str) -> int:
    """Words between spaces; of scripts without spaces, two letters count as one."""
    spaced = len(line.split())
    return spaced if line.isascii() else max(spaced, len(UNSPACED.findall(line)) // 2)


def keys_of(text: str, rare_words: int) -> Iterator[tuple[int, int, int, int]]:
    """(key, line number, number among lines that are not blank, words) of each line that is not blank.

    A line of ``rare_words`` words or more is rare: it stands for itself, with its number among equal lines
    of the document. A shorter line says little alone and has several keys: all lines back to the last rare
    one, all lines on to the next rare one, and, among short lines, the windows that it begins and ends.
    """
    seen: Counter[bytes] = Counter()
    rows = [(number, " ".join(words)) for number, line in enumerate(text.split("\n")) if (words := line.split())]
    own = [x.encode("utf-8", "surrogatepass") for _, x in rows]
    size = [words_of(x) for _, x in rows]

    def chains(order: Iterable[int], mark: bytes) -> dict[int, bytes]:
        found, chain = {}, None
        for i in order:
            if size[i] >= rare_words:
                chain = hashlib.blake2b(own[i], digest_size=16).digest()
            elif chain is not None:
                chain = found[i] = hashlib.blake2b(mark + chain + b"\n" + own[i], digest_size=16).digest()
        return found

    back, on = chains(range(len(rows)), b""), chains(range(len(rows) - 1, -1, -1), b"on")
    windows, run = {}, 0
    for i in range(len(rows)):
        run = run + 1 if size[i] < rare_words else 0
        if run >= WINDOW_LINES:
            windows[i] = hashlib.blake2b(b"\n".join(own[i + 1 - WINDOW_LINES : i + 1]), digest_size=16).digest()
    for i, (number, _) in enumerate(rows):
        if size[i] >= rare_words:
            digests = [hashlib.blake2b(own[i], digest_size=16).digest()]
        else:
            first, last = windows.get(i + WINDOW_LINES - 1), windows.get(i)
            digests = [back.get(i), on.get(i), first and b"first" + first, last and b"last" + last]
        for digest in digests:
            if digest is not None:
                seen[digest] += 1
                key = hashlib.blake2b(digest + seen[digest].to_bytes(4, "big"), digest_size=8).digest()
                yield int.from_bytes(key, "big", signed=True), number, i, size[i]


def keyed(rare_words: int):
    def rows_of(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = [
                (key, doc, digest, number, place, words)
                for doc, digest, text in zip(rows["doc_id"], rows["digest"], rows["text"]) if text
                for key, number, place, words in keys_of(text, rare_words)
            ]
            yield pd.DataFrame(out, columns=KEY_COLUMNS.split(","))

    return rows_of


def patience(pairs: list[tuple[int, int]]) -> list[int]:
    """Second numbers of the longest run of pairs that rises in both, by patience sorting."""
    pairs = sorted(set(pairs), key=lambda p: (p[0], -p[1]))
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        if at == len(tops):
            tops.append(b)
            piles.append(i)
        else:
            tops[at], piles[at] = b, i
        back.append(piles[at - 1] if at else -1)
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i][1])
        i = back[i]
    return out[::-1]


def aligned(matches: Iterable[tuple]) -> set[int]:
    """Own places that are aligned with one earlier document at least; matches as for ``blocks``."""
    partners: dict[tuple, list[tuple[int, int]]] = {}
    for doc, digest, theirs, _, place, _ in matches:
        partners.setdefault((doc, digest), []).append((theirs, place))
    return {place for pairs in partners.values() for place in patience(pairs)}


def runs(lines: Iterable[tuple[int, int, int]], rare_words: int) -> list[tuple[int, int, int]]:
    """Runs of aligned lines (place, line, words) with a rare line or many words: (first line, last line, lines)."""
    out, run = [], []
    for row in [*sorted(lines), None]:
        if run and (row is None or row[0] != run[-1][0] + 1):
            sizes = [words for _, _, words in run]
            if max(sizes) >= rare_words or sum(sizes) >= BLOCK_WORDS:
                out.append((run[0][1], run[-1][1], len(run)))
            run = []
        run.append(row)
    return out


def blocks(matches: list[tuple], rare_words: int = RARE_WORDS) -> list[tuple[int, int, int]]:
    """Runs of lines to delete from a document: (first line, last line, lines that are not blank).

    matches: (earlier document's id, its digest, its line, own line, own place, own words).
    """
    about = {place: (place, line, words) for _, _, _, line, place, words in matches}
    return runs([about[p] for p in aligned(matches)], rare_words)


def first_aligned(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each document its aligned lines, and the keys of lines that are left over."""
    fields = ("lead_id", "lead_digest", "lead_line", "line", "place", "words")
    for rows in batches:
        found, left = [], []
        for matches in rows["matches"]:
            places = aligned([tuple(m[k] for k in fields) for m in matches])
            about = {m["place"]: {k: m[k] for k in ("place", "line", "words")} for m in matches if m["place"] in places}
            found.append(list(about.values()))
            left.append([{k: m[k] for k in ("key", "place", "line", "words")} for m in matches if m["place"] not in places])
        yield rows.drop(columns="matches").assign(found=found, left_over=left)


def pair_aligned(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Aligned places of each pair of documents."""
    for rows in batches:
        found = [patience([(m["theirs"], m["place"]) for m in shared]) for shared in rows["shared"]]
        yield rows[DOC].assign(places=found)


def deletions(rare_words: int):
    def rows_of(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [
                runs({(m["place"], m["line"], m["words"]) for part in (a, b) if part is not None for m in part}, rare_words)
                for a, b in zip(rows["found"], rows["more"])
            ]
            out = rows[DOC].assign(gone=[[{"first": a, "last": b, "lines": n} for a, b, n in x] for x in found])
            yield out[[len(x) > 0 for x in found]]

    return rows_of


def realigned(keys: DataFrame, left: DataFrame) -> DataFrame | None:
    """Lines of ``left`` that an earlier document than their first holder is aligned with: doc_id, digest, more.

    Round by round the next holders of each key that is left over, four times as many as the round before,
    are aligned with the documents that have lines left, over all lines that the two share. Lines found go;
    rounds end when no line is left or all earlier holders of what is left have been tried.
    """
    held = stored(keys.join(left.select("key").distinct(), "key", "left_semi").select("key", *DOC).distinct())
    most = held.groupBy("key").count().agg(F.max("count")).first()[0] or 0
    nth = F.row_number().over(Window.partitionBy("key").orderBy(*DOC))
    tried, upto, parts = 1, 4, []
    while tried < most:
        some = held.withColumn("nth", nth).where(F.col("nth") <= upto).where(F.col("nth") > tried)
        partner = some.select("key", F.col("doc_id").alias("their_id"), F.col("digest").alias("their_digest"))
        pairs = stored(
            left.join(partner, "key").where("their_id < doc_id or their_id = doc_id and their_digest < digest")
            .select(*DOC, "their_id", "their_digest").distinct()
        )
        theirs = pairs.select("their_id", "their_digest").distinct().join(
            keys.select("key", F.col("doc_id").alias("their_id"), F.col("digest").alias("their_digest"), F.col("line").alias("theirs")),
            ["their_id", "their_digest"],
        )
        shared = (
            pairs.join(keys.select("key", *DOC, "place"), DOC).join(theirs, ["their_id", "their_digest", "key"])
            .groupBy(*DOC, "their_id", "their_digest").agg(F.collect_set(F.struct("theirs", "place")).alias("shared"))
        )
        found = stored(
            shared.mapInPandas(lean(pair_aligned), "doc_id long, digest long, places array<int>")
            .select(*DOC, F.explode("places").alias("place")).distinct()
        )
        parts.append(left.join(found, [*DOC, "place"], "left_semi").select(*DOC, "place", "line", "words"))
        left = stored(left.join(found, [*DOC, "place"], "left_anti"))
        if left.isEmpty():
            break
        tried, upto = upto, 4 * upto
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts).groupBy(*DOC).agg(F.collect_set(F.struct("place", "line", "words")).alias("more"))


def repeated_blocks(docs: DataFrame, rare_words: int = RARE_WORDS) -> DataFrame:
    """Blocks of lines to delete: doc_id, digest (of the text), gone (first and last line, lines that are not blank).

    Each line of a document is matched with the first document, by id, that has the line: one link for a
    line, however many documents share it. The links to one earlier document are aligned by patience
    sorting; lines that this leaves over are tried with the other earlier documents that have them (see
    ``realigned``). Aligned lines that follow each other are a block; blocks with a rare line or of 50 words
    are deleted. A line that is deleted is still in the first document that has it, which keeps it. First
    documents are stored before they are joined, so that Spark can split the join where one line is very
    common.
    """
    texts = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("digest"), "text")
    keys = stored(texts.mapInPandas(
        lean(keyed(rare_words)), "key long, doc_id long, digest long, line int, place int, words int"
    ))
    lead = stored(
        keys.groupBy("key").agg(F.min(F.struct("doc_id", "digest", "line")).alias("lead"), F.count("*").alias("n"))
        .where("n > 1").select("key", "lead")
    )
    matches = (
        keys.join(lead, "key").where("lead.doc_id <> doc_id or lead.digest <> digest")
        .groupBy("doc_id", "digest").agg(F.collect_list(F.struct(
            F.col("lead.doc_id").alias("lead_id"), F.col("lead.digest").alias("lead_digest"),
            F.col("lead.line").alias("lead_line"), "key", "line", "place", "words",
        )).alias("matches"))
    )
    first = stored(matches.mapInPandas(
        lean(first_aligned), "doc_id long, digest long, found array<struct<place: int, line: int, words: int>>, "
        "left_over array<struct<key: long, place: int, line: int, words: int>>"
    ))
    left = stored(first.select(*DOC, F.explode("left_over").alias("x")).select(*DOC, "x.*"))
    more = None if left.isEmpty() else realigned(keys, left)
    found = first.select(*DOC, "found")
    if more is None:
        found = found.withColumn("more", F.lit(None).cast("array<struct<place:int,line:int,words:int>>"))
    else:
        found = found.join(stored(more), DOC, "left")
    return found.mapInPandas(
        lean(deletions(rare_words)), "doc_id long, digest long, gone array<struct<first: int, last: int, lines: int>>"
    )


def deduplicated(docs: DataFrame, rare_words: int = RARE_WORDS) -> DataFrame:
    """Every row of docs as the column ``row``, with ``kept``, its text less repeated blocks, and ``gone``.

    Lines count as equal after trimming and with single spaces; blank lines are not lines, and go where a
    block goes that they lie in. A null text stays null and an empty one empty; rows with the same id and
    text are one document and are not compared with each other; rows without an id are kept whole; an
    empty table gives no rows; other columns, whatever their names, stay in ``row``.
    """
    gone = stored(repeated_blocks(docs, rare_words))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", F.xxhash64("text").alias("digest"))
    joined = rows.join(gone, ["doc_id", "digest"], "left")
    stays = lambda line, at: ~F.exists("gone", lambda b: (at >= b["first"]) & (at <= b["last"]))
    kept = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.filter(F.split("row.text", "\n"), stays), "\n")
    )
    return joined.select("row", kept.alias("kept"), F.coalesce("gone", F.array().cast("array<struct<first:int,last:int,lines:int>>")).alias("gone"))
