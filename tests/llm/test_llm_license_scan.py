import random
import re
import time

from ledgerlens.llm import license_scan
from ledgerlens.llm.license_rules import Rule, rules


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected(text, table):
    w = words(text)
    places = [
        (k, label) for phrase, label in license_scan.BASE_PHRASES
        for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()
    ]
    norm = f" {' '.join(w)} " if w else " "
    found = []
    for r in table:
        for m in re.finditer(rf"(?<= )(?:{r.pattern})(?= )", norm):
            found.append((m.start(), -m.end(), r.priority, r.label, r.weight))
    kept, cover = [], None
    for d in sorted(found):
        if cover is None or d[0] >= -cover[1]:
            kept.append(d)
            cover = d
        elif d[1] >= cover[1]:
            if d[2] < cover[2] and (d[0] >= -kept[-1][1] or d[2] < kept[-1][2]):
                kept.append(d)
        elif d[2] < cover[2]:
            kept = [k for k in kept if k != cover] + [d]
            cover = d
    best = {}
    for d in kept:
        best[d[3]] = max(best.get(d[3], 0.0), d[4])
    left = 1.0
    for x in best.values():
        left *= 1 - x
    base = {label for _, label in places}
    starts = [k for k, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | set(best))), round(1 - left, 9), len(kept))


TEXTS = [
    "CC BY cc-by cc, by; cc by", "All rights reserved. all RIGHTS   reserved", "ccby cc bye accby",
    "the general public license general public license", "Licensed under the Apache License, Version 2.0 and CC BY-NC 4.0.",
    "SPDX-License-Identifier: MIT\nreleased under the MIT License", "GNU Affero General Public License version 3 or later",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of it", "x" * 3000 + " GPLv3 " + "y " * 4000,
    "licensed under cc by nc sa 4 0 licensed under cc by nc sa 4 0", "Copyright (c) 2020 someone. No rights reserved",
    "All rights reserved Ünï général public license", " ".join(["released under the mit license"] * 200),
]


def test_scan_matches_brute_force(frame, odd_rows):
    rows = odd_rows + [(100 + k, t) for k, t in enumerate(TEXTS)]
    out = license_scan.license_scan(frame(rows)).collect()
    got = sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9),
                      r.n_detections)) for r in out)
    assert got == sorted(str((i, *expected(t, rules()))) for i, t in rows)


def test_many_detections_of_one_text(frame):
    """100,000 places in one text, many of them overlapping."""
    text = " ".join(["licensed under cc by nc sa 4 0 released under the mit license gplv3 or later"] * 25_000)
    begin = time.monotonic()
    got = license_scan.license_scan(frame([(1, text)])).collect()[0]
    assert time.monotonic() - begin < 60
    few = license_scan.license_scan(frame([(1, text[: len(text) // 1000])])).collect()[0]
    assert (got.labels, round(got.score, 9)) == expected(text[: len(text) // 1000], rules())[5:7]
    assert got.n_detections == 1000 * few.n_detections and got.n_detections >= 50_000


def test_random_overlaps(frame):
    rng = random.Random(11)
    letters = "abcd"
    table = tuple(
        Rule(rng.randint(1, 4), f"l{k % 7}", p.split()[0], p, rng.choice((0.25, 0.5, 0.75)))
        for k, p in enumerate(" ".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(20))
    )
    rows = [(k, " ".join(rng.choices(letters + "e", k=rng.randint(0, 40)))) for k in range(200)]
    out = license_scan.license_scan(frame(rows), table).collect()
    got = {r.doc_id: (r.labels, round(r.score, 9), r.n_detections) for r in out}
    assert got == {k: expected(t, table)[5:] for k, t in rows}


def test_priority_and_containment(frame):
    table = (
        Rule(1, "strong", "core", r"core", 0.5), Rule(2, "long", "wide", r"wide core wide", 0.5),
        Rule(3, "weak", "wide", r"wide", 0.5), Rule(2, "tail", "end", r"wide end", 0.5),
    )
    texts = ["wide core wide", "wide core wide end", "core wide end", "wide wide", "end"]
    rows = list(enumerate(texts))
    out = {r.doc_id: r.labels for r in license_scan.license_scan(frame(rows), table).collect()}
    assert out == {k: expected(t, table)[5] for k, t in rows}
    assert out[0] == "long,strong"


def test_signatures_are_many_and_gated():
    table = rules()
    assert len(table) > 200
    for r in table:  # every pattern has its keyword in each text it matches
        re.compile(r.pattern)
    assert {r.priority for r in table} == {1, 2, 3, 4}


def test_no_rules_and_empty_table(frame):
    out = license_scan.license_scan(frame([(1, "all rights reserved mit license")]), ())
    assert [(r.base_labels, r.labels, r.score) for r in out.collect()] == [("reserved", "reserved", 0.0)]
    assert license_scan.license_scan(frame([])).count() == 0


def variants(pattern):
    """Texts that the pattern matches, as choices that are put together: each
    part is a list of its alternatives, an optional part both ways."""

    def ways(parsed):
        out = [""]
        for op, arg in parsed:
            name = str(op)
            if name == "LITERAL":
                some = [chr(arg)]
            elif name == "IN":
                some = [x for kind, v in arg for x in {
                    "LITERAL": lambda: [chr(v)], "RANGE": lambda: [chr(v[0]), chr(v[1])],
                    "CATEGORY": lambda: {"CATEGORY_DIGIT": ["7"], "CATEGORY_NOT_SPACE": ["q"]}[str(v)],
                }[str(kind)]()]
            elif name == "SUBPATTERN":
                some = ways(arg[3])
            elif name == "BRANCH":
                some = [x for branch in arg[1] for x in ways(branch)]
            elif name == "MAX_REPEAT":
                low, high, body = arg
                some = [x * k for k in sorted({low, min(high, low + 1)}) for x in (ways(body) if k else [""])]
            else:
                raise AssertionError(name)
            out = list(dict.fromkeys(a + b for a in out for b in some))
        return out

    return ways(re._parser.parse(pattern))


def test_each_matched_text_passes_the_gate():
    for r in rules():
        for text in variants(r.pattern):
            assert re.fullmatch(r.pattern, text), (r, text)
            assert f" {r.keyword}" in f" {text} ", (r, text)


def test_each_alternative_is_found_as_by_an_ungated_scan(frame):
    table = rules()
    texts = set()
    for r in table:
        # The grants of one template differ in their first words only.
        name = r.pattern if r.priority != 2 else "licensed under " + r.pattern.split(r"(?:the )?(?:terms of )?(?:the )?", 1)[1]
        texts |= set(variants(name))
    texts = sorted(texts) + ["do not copy without the prior written consent of the owner", "see www.gnu.org/copyleft/gpl.html"]
    rows = list(enumerate(texts))
    out = license_scan.license_scan(frame(rows)).collect()
    got = {r.doc_id: (r.labels, round(r.score, 9), r.n_detections) for r in out}
    assert got == {k: expected(t, table)[5:] for k, t in rows}
    assert got[len(rows) - 2][0] == "proprietary" and got[len(rows) - 1][0] == "gpl"
