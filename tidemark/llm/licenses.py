"""License scans: parts of a text against templates by Dice coefficient over word bigrams.

Texts and templates are normalised alike: lower case, words of letters and digits only,
copyright statements dropped. The parts of a text begin and end where a line or a sentence
does, wherever in a line that is; and a part may also begin with the first bigram of a template
and end with the last one of a template, in the midst of a sentence. Other ends inside a
sentence are no parts, as leaving out what contradicts a template (another version, say) would
make a match of it. Only templates of whose bigrams the text has enough are looked for.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import by_bytes, table
from tidemark.llm.license_templates import TEMPLATES

THRESHOLD = 0.92
BATCH_BYTES = 8 << 20
#: Words of a part, repeated ones counted, in lengths of the longest template it may match.
LENGTHS = 2
#: Windows of words whose parts a text's scan remembers.
REMEMBERED = 100_000

_WORD = re.compile(r"[^\W_]+")
#: The start of a copyright statement, not of a wrapped sentence on copyright holders and the like.
_COPYRIGHT = re.compile(
    r"\s*(?:copyright\b(?!\s+(?:notices?|holders?|owners?|licen[sc]es?|laws?|statements?|on|or|and)\b)"
    r"|©|\(c\)\s)",
    re.IGNORECASE,
)
#: Between two words: the end of a sentence, and what joins them to one (2.1, BY-SA).
_SENTENCE = re.compile(r"[^\w\s]*[.!?;:][^\w\s]*\s")
_JOINT = re.compile(r"[._'’-]")

Bigram = tuple[str, str]


class Match(NamedTuple):
    dice: float
    license: str
    first: int
    last: int


def normal_lines(text: str) -> list[list[str]]:
    """The words of each line; a copyright line has none."""
    return [
        [] if _COPYRIGHT.match(line) else _WORD.findall(line) for line in text.lower().split("\n")
    ]


def bigrams(words: list[str]) -> set[Bigram]:
    return set(zip(words, words[1:], strict=False))


class Templates:
    """Templates by size, then name, and what is known of their bigrams."""

    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> None:
        self.threshold = threshold
        parts = [
            (name, [word for line in normal_lines(text) for word in line]) for name, text in templates
        ]
        sized = sorted(
            ((len(bigrams(words)), name, words) for name, words in parts if len(words) > 1),
            key=lambda t: t[:2],
        )
        self.sizes = [size for size, _, _ in sized]
        self.names = [name for _, name, _ in sized]
        self.lengths = [len(words) for _, _, words in sized]
        self.firsts = [tuple(words[:2]) for _, _, words in sized]
        self.lasts = [tuple(words[-2:]) for _, _, words in sized]
        sets = [bigrams(words) for _, _, words in sized]
        #: Templates that have each bigram.
        self.owners: dict[Bigram, list[int]] = {}
        for number, bigrams_of_one in enumerate(sets):
            for pair in bigrams_of_one:
                self.owners.setdefault(pair, []).append(number)
        self.known = set(self.owners)
        #: Starts that end a copyright statement on the same line.
        self.opening = {pair for pair in self.firsts if pair != ("all", "rights")}
        #: Templates of another licence that hold all of a template and more, as BSD's third clause.
        self.around = [
            [k for k, big in enumerate(sets) if one < big and self.names[k] != name]
            for one, name in zip(sets, self.names, strict=True)
        ]

    def most_words(self, candidates: list[int]) -> int:
        """Words of a part that is compared with these: twice those of the longest one. A part
        that repeats itself beyond that is told as several."""
        return LENGTHS * max((self.lengths[number] for number in candidates), default=0)

    def candidates(self, present: set[Bigram]) -> list[int]:
        """Templates that a part of a text with these known bigrams can reach.

        With n bigrams in the template, m in the part and c in both, m is at least c, so that
        2 c / (n + m) reaches the threshold t only if c is at least n t / (2 - t).
        """
        counts: dict[int, int] = {}
        for pair in present:
            for number in self.owners[pair]:
                counts[number] = counts.get(number, 0) + 1
        t = self.threshold
        return sorted(
            number for number, count in counts.items() if count * (2 - t) >= t * self.sizes[number] - 1e-9
        )


def _stated(words: list[str], templates: Templates) -> int:
    """How many words of a copyright line belong to its statement: those before a template."""
    starts = (k for k, pair in enumerate(zip(words, words[1:], strict=False)) if pair in templates.opening)
    return next(starts, len(words))


class _Part(NamedTuple):
    dice: float
    template: int
    start: int
    end: int
    first: int
    last: int


def _parts(lines: list[str], templates: Templates, candidates: list[int]) -> list[_Part]:
    """All parts that reach the threshold for a candidate, each with its best one.

    Each start looks at a bounded number of words, and equal stretches are looked at once, so
    time grows with the text, however it repeats itself."""
    words: list[str] = []
    at_line: list[int] = []
    breaks, joined = {0}, set()  # words that begin a sentence or line, or belong to the one before
    for number, line in enumerate(lines):
        spans = [(m.start(), m.end()) for m in _WORD.finditer(line)]
        own = [line[a:b] for a, b in spans]
        skip = _stated(own, templates) if _COPYRIGHT.match(line) else 0
        breaks.add(len(words))
        for k in range(skip, len(own)):
            if k > skip:
                between = line[spans[k - 1][1] : spans[k][0]]
                if _SENTENCE.match(between):
                    breaks.add(len(words))
                elif _JOINT.fullmatch(between):
                    joined.add(len(words))
            words.append(own[k])
            at_line.append(number)
    pairs = list(zip(words, words[1:], strict=False))
    wanted = set(candidates)
    places = {number: k for k, number in enumerate(candidates)}
    owners = {
        pair: [places[number] for number in templates.owners[pair] if number in wanted]
        for pair in templates.known.intersection(pairs)
    }
    firsts = {templates.firsts[number] for number in candidates}
    lasts = {templates.lasts[number] for number in candidates}
    # The next bigram that a candidate has and the next break, from each word on.
    starts = []
    next_known = next_break = len(words)
    for k in range(len(pairs) - 1, -1, -1):
        if k + 1 in breaks:
            next_break = k + 1
        if owners.get(pairs[k]):
            next_known = k
        if (k in breaks and next_known < next_break) or (pairs[k] in firsts and k not in joined):
            starts.append(k)
    sizes = [templates.sizes[number] for number in candidates]
    t = templates.threshold
    largest = int(max(sizes) * (2 - t) / t + 1e-9)  # Dice is at most 2 * smaller / (smaller + larger)
    most = templates.most_words(candidates)
    # What follows a start, with its breaks, decides on its parts: repeated text is looked at once.
    numbers: dict[tuple[str, bool, bool], int] = {}
    window = np.fromiter(
        (numbers.setdefault((w, k in breaks, k in joined), len(numbers)) for k, w in enumerate(words)),
        np.int32,
        len(words),
    )
    known: dict[bytes, list[tuple[float, int, int]]] = {}
    found = []
    for start in reversed(starts):
        key = hashlib.blake2b(window[start : start + most + 1].tobytes(), digest_size=16).digest()
        parts = known.get(key)
        if parts is None:
            parts = []
            part: set[Bigram] = set()
            counts = [0] * len(sizes)
            best: tuple[float, int] | None = None
            stale = True
            for k in range(start, min(len(pairs), start + most - 1)):
                pair = pairs[k]
                if pair not in part:
                    part.add(pair)
                    if len(part) > largest:
                        break
                    stale = True
                    for place in owners.get(pair, ()):
                        counts[place] += 1
                end = k + 1
                if end + 1 in breaks or end + 1 == len(words) or (pair in lasts and end + 1 not in joined):
                    if stale:
                        best, stale = None, False
                        for place, count in enumerate(counts):
                            dice = 2 * count / (len(part) + sizes[place])
                            if dice >= t and (best is None or dice > best[0]):
                                best = (dice, candidates[place])
                    if best:
                        parts.append((*best, end - start))
            if len(known) >= REMEMBERED:
                known.clear()
            known[key] = parts
        for dice, number, length in parts:
            end = start + length
            found.append(_Part(dice, number, start, end, at_line[start], at_line[end]))
    return found


class _Holders:
    """Parts of some templates, by start, to ask whether one of them holds a part."""

    def __init__(self, parts: list[_Part]) -> None:
        parts = sorted((part.start, part.end) for part in parts)
        self.starts = [start for start, _ in parts]
        self.ends = list(accumulate((end for _, end in parts), max))

    def hold(self, part: _Part) -> bool:
        before = bisect_right(self.starts, part.start)
        return before > 0 and self.ends[before - 1] >= part.end


def scan(text: str | None, templates: Templates) -> list[Match]:
    """Matches that share no word, the best first chosen, in order; lines count from 0.

    A match gives way to one around it of another licence whose template holds its own and more. Of
    equally good parts the one with more lines wins, then the earlier line, then more words.
    """
    if not text:
        return []
    lines = text.lower().split("\n")
    words: list[str] = []
    for line in lines:
        own = _WORD.findall(line)
        words += own[_stated(own, templates) :] if _COPYRIGHT.match(line) else own
    present = templates.known.intersection(zip(words, words[1:], strict=False))
    candidates = templates.candidates(present)
    if not candidates:
        return []
    found = _parts(lines, templates, candidates)
    of_template: dict[int, list[_Part]] = {}
    for part in found:
        of_template.setdefault(part.template, []).append(part)
    holders = {
        number: _Holders([p for other in templates.around[number] for p in of_template.get(other, ())])
        for number in of_template
    }
    found = [part for part in found if not holders[part.template].hold(part)]
    found.sort(key=lambda m: (-m.dice, m.first - m.last, m.first, m.start - m.end, m.start))
    taken = bytearray(len(words))  # chosen parts share no word, so no word is marked twice
    chosen: list[_Part] = []
    for part in found:
        # One that overlaps a chosen part and has neither end in it holds it whole.
        if not taken[part.start] and not taken[part.end] and not taken.count(1, part.start, part.end):
            chosen.append(part)
            taken[part.start : part.end + 1] = b"\x01" * (part.end + 1 - part.start)
    return [
        Match(part.dice, templates.names[part.template], part.first, part.last)
        for part in sorted(chosen, key=lambda m: m.start)
    ]


def license_scan(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: doc_id, n_lines, n_matches, licenses, best_dice, matches.

    `licenses` are the distinct names, sorted; `matches` is an array of (license, first
    line, last line, dice). Null and empty texts have no lines and no match. Rows are
    judged one by one, so repeated ids and rows are fine; other columns are not read.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, threshold)
        kind = pa.list_(
            pa.struct(
                [
                    ("license", pa.string()),
                    ("first_line", pa.int64()),
                    ("last_line", pa.int64()),
                    ("dice", pa.float64()),
                ]
            )
        )
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            texts = batch.column("text").to_pylist()
            found = [scan(text, known) for text in texts]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([text.count("\n") + 1 if text else 0 for text in texts], pa.int64()),
                    pa.array([len(matches) for matches in found], pa.int64()),
                    pa.array([",".join(sorted({m.license for m in matches})) for matches in found]),
                    pa.array([max((m.dice for m in matches), default=0.0) for matches in found]),
                    pa.array(
                        [
                            [
                                {
                                    "license": m.license,
                                    "first_line": m.first,
                                    "last_line": m.last,
                                    "dice": m.dice,
                                }
                                for m in matches
                            ]
                            for matches in found
                        ],
                        kind,
                    ),
                ],
                ["doc_id", "n_lines", "n_matches", "licenses", "best_dice", "matches"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        look,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_lines long, n_matches long, "
        "licenses string, best_dice double, "
        "matches array<struct<license:string,first_line:bigint,last_line:bigint,dice:double>>",
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
