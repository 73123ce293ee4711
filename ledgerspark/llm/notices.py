"""License scans: fuzzy search for short notices.

A notice of words may occur with up to k edits of characters. Split into k + 1 pieces, at least one piece of
every such occurrence is unharmed (pigeonhole), so exact occurrences of the pieces give the candidates. The window
around each goes to bounded-error matching by itself, which confirms the edits and reports the span; it is too short for
two occurrences side by side. Of spans that overlap, those with fewer edits stay.
Notices with no edits allowed take the same way with one piece, the notice itself.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import NOT_WORD, Texts, record, slices

#: The base notices, found without edits, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notices, found with one edit for every EDIT_SHARE characters, and their labels.
NOTICES = {
    "licensed under the apache license": "apache",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "creative commons attribution": "cc-by",
    "released under the public domain": "public-domain",
    "gnu general public license": "gpl",
    "all rights reserved": "reserved",
    "used with permission": "permission",
    "general public license": "gpl",
}
EDIT_SHARE = 10


class Notice:
    def __init__(self, words: str, label: str, edits: int):
        self.words, self.label, self.edits = words, label, edits
        cuts = [round(i * len(words) / (edits + 1)) for i in range(edits + 2)]
        #: (place in the notice, piece)
        self.seeds = [(a, words[a:b]) for a, b in zip(cuts, cuts[1:])]
        body = "".join(regex.escape(c) for c in words)
        self.pattern = regex.compile(f"(?<= )(?:{body}){{e<={edits}}}(?= )", regex.BESTMATCH) if edits else None


def notices(base: dict[str, str] = BASE, fuzzy: dict[str, str] = NOTICES, edit_share: int = EDIT_SHARE) -> tuple[list[Notice], list[Notice]]:
    return [Notice(w, x, 0) for w, x in base.items()], [Notice(w, x, len(w) // edit_share) for w, x in fuzzy.items()]


def candidates(text: str, notice: Notice) -> list[tuple[int, int]]:
    """The windows of the seeds that stand in the text; one of them holds each occurrence. text has a blank before and after each word."""
    found = set()
    for at, seed in notice.seeds:
        place = text.find(seed)
        while place >= 0:
            found.add((max(0, place - at - notice.edits - 1), min(len(text), place + len(notice.words) - at + notice.edits + 1)))
            place = text.find(seed, place + 1)
    return sorted(found)


def apart(matches: dict[tuple[int, int], int]) -> list[tuple[int, int, int]]:
    """The matches with the fewest edits, of those that overlap a better one none; ties go to the first, then the shortest."""
    starts: list[int] = []
    kept: list[tuple[int, int, int]] = []
    for (a, b), edits in sorted(matches.items(), key=lambda m: (m[1], m[0])):
        i = bisect.bisect_left(starts, a)
        if (i == 0 or kept[i - 1][1] <= a) and (i == len(kept) or b <= kept[i][0]):
            starts.insert(i, a)
            kept.insert(i, (a, b, edits))
    return kept


def spans(text: str, notice: Notice) -> list[tuple[int, int, int]]:
    """(start, end, edits) of the notice's occurrences at whole words. Exact ones may overlap, those with edits do not."""
    if notice.pattern is None:
        out, at = [], text.find(f" {notice.words} ")
        while at >= 0:
            out.append((at + 1, at + 1 + len(notice.words), 0))
            at = text.find(f" {notice.words} ", at + 1)
        return out
    matches = {}
    for low, high in candidates(text, notice):
        m = notice.pattern.search(text, low, high)
        if m:
            matches[m.start(), m.end()] = sum(m.fuzzy_counts)
    return apart(matches)


class Words:
    """Numbers of the words of a text, from its places; the blanks are looked for once."""

    def __init__(self, text: str):
        self.text, self.blanks = text, None

    def before(self, place: int) -> int:
        if self.blanks is None:
            self.blanks = np.flatnonzero(np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
        return int(np.searchsorted(self.blanks, place))


def scan(docs: DataFrame, base: dict[str, str] = BASE, fuzzy: dict[str, str] = NOTICES, edit_share: int = EDIT_SHARE) -> DataFrame:
    """One row for every row of docs: word count, base places, labels, score and the spans found.

    A null text is an empty one: no words, no labels, score 0. The score is 1 for a text with a base place, else
    1 - edits / length of its best fuzzy notice. Spans are (label, first word, end word, edits), by first word.
    Repeated rows are scanned each; other columns are not read.
    """
    exact, near = notices(base, fuzzy, edit_share)
    item = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("edits", pa.int32())])
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
        + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(item))]
    )

    def one(text: str) -> tuple:
        found, labels, score, places, words = [], set(), 0.0, [], Words(text)
        for notice in exact:
            for a, _, _ in spans(text, notice):
                word = words.before(a) - 1
                places.append((word, notice.label))
                found.append({"label": notice.label, "first_word": word, "end_word": word + notice.words.count(" ") + 1, "edits": 0})
                score = 1.0
        for notice in near:
            for a, b, edits in spans(text, notice):
                word = words.before(a) - 1
                labels.add(notice.label)
                score = max(score, 1 - edits / len(notice.words))
                found.append({"label": notice.label, "first_word": word, "end_word": words.before(b), "edits": edits})
        base_labels = {x for _, x in places}
        found.sort(key=lambda x: (x["first_word"], x["end_word"], x["label"], x["edits"]))
        first, last = (min(places)[0], max(places)[0]) if places else (None, None)
        return len(places), first, last, ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels)), score, found

    def run(batches):
        for piece in slices(batches):
            texts = Texts(piece.column("text"), NOT_WORD)
            # words with one blank before, between and after: what parts words becomes one blank
            lone = texts.data.copy()
            lone[NOT_WORD[lone]] = 32
            rows = []
            for i in range(texts.n):
                words = lone[texts.bounds[i] : texts.bounds[i + 1]].tobytes().decode("utf-8", "replace").split(" ")
                rows.append(one(" " + " ".join(w for w in words if w) + " "))
            yield record(schema, piece.column("doc_id"), texts.counts, *[list(c) for c in zip(*rows)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label: string, first_word: long, end_word: long, edits: int>>",
    )
