import random
import textwrap

import pytest

from tests.llm.frames import empty, messy, prose, vocabulary
from tidemark.llm import licenses
from tidemark.llm.license_templates import BSD_THIRD, BSD_TWO, BSD_WARRANTY, MIT, TEMPLATES


def brute(text, templates, threshold):
    """Best runs of lines that do not overlap, from all runs and all templates."""
    lines = licenses.normal_lines(text)
    known = licenses.Templates(templates, threshold)
    present = known.known & licenses.bigrams([w for line in lines for w in line])
    most = known.most_words(known.candidates(present))
    found = []
    for first in range(len(lines)):
        for last in range(first, len(lines)):
            if not lines[first] or not lines[last]:
                continue
            words = [w for line in lines[first : last + 1] for w in line]
            if len(words) > most:
                continue
            part = licenses.bigrams(words)
            best = max(
                (
                    (2 * len(part & t) / (len(part) + len(t)), name)
                    for name, t in ((n, licenses.bigrams([w for x in licenses.normal_lines(s) for w in x])) for n, s in templates)
                    if part
                ),
                default=(0, ""),
            )
            if best[0] >= threshold:
                found.append((best[0], first, last))
    found.sort(key=lambda m: (-m[0], m[1] - m[2], m[1]))
    chosen = []
    for m in found:
        if all(m[2] < o[1] or m[1] > o[2] for o in chosen):
            chosen.append(m)
    return sorted((first, last, dice) for dice, first, last in chosen)


SHORT = [t for t in TEMPLATES if len(t[1]) < 120]


@pytest.mark.parametrize("seed", range(6))
def test_matches_equal_brute_force(seed):
    rng, known = random.Random(seed), vocabulary()
    lines = []
    for _ in range(14):
        part = rng.choice(SHORT)[1]
        kind = rng.randrange(5)
        if kind == 0:
            part = part.replace(" ", "\n", 1)
        elif kind == 1:
            part = part.upper().replace(" ", "  ")
        elif kind == 2:
            part = " ".join(part.split()[:-1])
        elif kind == 3:
            part = prose(rng, 5, known)
        lines.append(part)
    text = "\n".join(lines)
    for threshold in (0.92, 0.7):
        got = licenses.scan(text, licenses.Templates(SHORT, threshold))
        assert [(m.first, m.last, m.dice) for m in got] == brute(text, SHORT, threshold)


def test_a_licence_is_found_inside_a_document():
    rng, known = random.Random(1), vocabulary()
    text = f"{prose(rng, 50, known)}\nMIT License\n\nCopyright (c) 2019 Somebody\n\n{MIT}\n{prose(rng, 9, known)}"
    found = licenses.scan(text, licenses.Templates())
    assert [m.license for m in found] == ["MIT"]
    assert found[0].dice > 0.97
    assert licenses.scan(prose(rng, 5000, known), licenses.Templates()) == []


def test_versions_are_told_apart():
    known = licenses.Templates()
    for name, wording in TEMPLATES:
        (match,) = licenses.scan(wording, known)
        assert match.license == name, wording
    assert licenses.scan("This work is licensed under the GNU General Public License, version 9.", known) == []


def test_messy_and_empty_tables(spark):
    docs = messy(spark)
    rows = licenses.license_scan(docs).collect()
    assert len(rows) == docs.count()
    assert all(r["n_matches"] == 0 and r["licenses"] == "" for r in rows)
    assert licenses.license_scan(empty(spark)).collect() == []
    notice = docs.selectExpr("doc_id", "'a\n\nReleased under the MIT License.\nb' AS text")
    assert {(r["licenses"], r["best_dice"], r["matches"][0]["first_line"]) for r in licenses.license_scan(notice).collect()} == {("MIT", 1.0, 2)}


def names(text):
    return [m.license for m in licenses.scan(text, licenses.Templates())]


@pytest.mark.parametrize("name, wording", TEMPLATES)
def test_notices_are_found_in_the_midst_of_a_line(name, wording):
    rng, known = random.Random(7), vocabulary()
    flat = " ".join(wording.split())
    prosaic = f"{prose(rng, 30, known)}. {flat} {prose(rng, 30, known)}."
    assert names(prosaic) == [name]
    assert names(f"{prose(rng, 30, known)} {flat}\n{prose(rng, 5, known)}") == [name]
    assert names("Copyright (c) 2019 Some Body. " + flat) == ([] if name == "All rights reserved" else [name])


@pytest.mark.parametrize("width", [30, 50, 72, 78])
@pytest.mark.parametrize("name, wording", [t for t in TEMPLATES if len(t[1]) > 120])
def test_notices_are_found_in_usual_line_breaks(name, wording, width):
    text = "\n".join(f" * {line}" for line in textwrap.wrap(wording, width, break_long_words=False))
    (match,) = licenses.scan(text, licenses.Templates())
    assert match.license == name and match.dice > 0.99


@pytest.mark.parametrize(
    "text, want",
    [
        ("This file is licensed under the MIT License.", ["MIT"]),
        ("Licensed under the MIT License. See LICENSE for details.", ["MIT"]),
        ("First Released under the MIT License. Then all of it Licensed under CC BY 4.0.", ["MIT", "CC-BY-4.0"]),
        ("Yes. This work is licensed under the GNU Lesser General Public License, version 2.1.", ["LGPL-2.1"]),
        ("Ours is licensed under CC BY 4.0.1 or so", []),
        ("It says: This work is licensed under the GNU General Public License, version 9.", []),
    ],
)
def test_notices_inside_sentences(text, want):
    assert names(text) == want


def test_the_longer_licence_wins_over_the_one_inside_it():
    text = "\n".join([BSD_TWO, BSD_THIRD.replace("the copyright holder", "Some Body"), BSD_WARRANTY])
    assert names(text) == ["BSD-3-Clause"]


def brute_words(text, templates, threshold):
    """Best parts of a text without copyright lines and joints, from all pairs of ends: where a
    sentence or line ends, or at a template's own first or last bigram."""
    import re

    known = licenses.Templates(templates, threshold)
    words, breaks = [], {0}
    for line in text.lower().split("\n"):
        breaks.add(len(words))
        for sentence in re.split(r"(?<=[.!?;:])\s+", line):
            breaks.add(len(words))
            words += re.findall(r"[^\W_]+", sentence)
    breaks.add(len(words))
    pairs = list(zip(words, words[1:]))
    candidates = known.candidates(known.known & set(pairs))
    sets = {k: {p for p, owners in known.owners.items() if k in owners} for k in candidates}
    firsts, lasts = ({getattr(known, x)[k] for k in candidates} for x in ("firsts", "lasts"))
    most, found = known.most_words(candidates), []
    for a in range(len(words)):
        if not (a in breaks or (a < len(pairs) and pairs[a] in firsts)):
            continue
        for b in range(a + 1, min(len(words), a + most)):
            if not (b + 1 in breaks or pairs[b - 1] in lasts):
                continue
            part = set(pairs[a:b])
            best = max(((2 * len(part & s) / (len(part) + len(s)), -k) for k, s in sets.items()), default=(0, 0))
            if best[0] >= threshold:
                found.append((best[0], a, b))
    return max((f[0] for f in found), default=0.0), {w for f in found for w in range(f[1], f[2] + 1)}


@pytest.mark.parametrize("seed", range(8))
def test_ends_inside_lines_equal_brute_force(seed):
    """The best Dice is that of all parts, every match is one, and no part is without a match."""
    rng, known = random.Random(seed), vocabulary()
    pieces = []
    for _ in range(8):
        part = " ".join(rng.choice(SHORT)[1].split())
        part = part.replace("-", " ").replace("'", "").replace("_", " ")
        pieces.append(rng.choice([part, f"{prose(rng, 3, known)}. {part}", f"so {part} and {prose(rng, 2, known)}", part + "."]))
    text = "".join(p + rng.choice(["\n", " ", ". "]) for p in pieces)
    text = "".join(c for c in text if c not in "©()/\"" and not c == "\t")
    if "copyright" in text.lower():
        text = text.lower().replace("copyright", "right")
    for number in range(10):
        text = text.replace(f"{number}.", f"{number} ")
    got = licenses.scan(text, licenses.Templates(SHORT, 0.92))
    best, covered = brute_words(text, SHORT, 0.92)
    assert max((m.dice for m in got), default=0.0) == pytest.approx(best)
    assert bool(got) == bool(covered)


def test_time_grows_with_the_text_however_it_repeats_itself():
    import time

    known = licenses.Templates(TEMPLATES)
    line = " ".join(MIT.split()[:12])
    spent = []
    for lines in (2_000, 16_000):
        start = time.process_time()
        licenses.scan(MIT + "\n" + "\n".join([line] * lines), known)
        licenses.scan("\n".join(["Licensed under the MIT License."] * lines), known)
        spent.append(time.process_time() - start)
    assert spent[1] < 16 * spent[0] + 2  # 8 times the text; once it was the square of that


def test_repeated_notices_are_told_one_by_one():
    text = "\n".join(["Licensed under the MIT License."] * 30)
    found = licenses.scan(text, licenses.Templates(TEMPLATES))
    covered = {line for m in found for line in range(m.first, m.last + 1)}
    assert {m.license for m in found} == {"MIT"} and covered == set(range(30))
