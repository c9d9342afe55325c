import random
from fractions import Fraction

import pytest

from ledgerlens.llm import jaccard_join


def shingles(text, n):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def expected(rows, t=Fraction(8, 10), n=5):
    sets = [(i, shingles(text, n)) for i, text in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if i is not None and j is not None and x and y and len(x & y) >= t * len(x | y):
                parent[find(a)] = find(b)
    lowest = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            lowest[find(k)] = min(lowest.get(find(k), i), i)
    return sorted(
        ((i, len(s), lowest[find(k)] if i is not None else None) for k, (i, s) in enumerate(sets)), key=str
    )


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def corpus(seed):
    """Chains of edits, groups of copies, a passage most texts share, and
    texts right at the threshold."""
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randrange(400)}"
    passage = [word() for _ in range(30)]
    rows = []
    for _ in range(12):
        text = [word() for _ in range(rng.choice([6, 20, 60]))]
        if rng.random() < 0.7:
            text += passage
        for _ in range(rng.randrange(1, 7)):
            rows.append((" ".join(text)).upper() if rng.random() < 0.3 else "  ".join(text))
            for _ in range(rng.randrange(0, 3)):
                text[rng.randrange(len(text))] = word()
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(order[k], r) for k, r in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(frame, odd_rows, seed):
    rows = corpus(seed) + [(None if i is None else i + 1000, t) for i, t in odd_rows]
    assert got(jaccard_join.jaccard_join(frame(rows))) == expected(rows)


def test_other_threshold_and_length(frame):
    rows = corpus(3)
    assert got(jaccard_join.jaccard_join(frame(rows), Fraction(1, 2), 3)) == expected(rows, Fraction(1, 2), 3)


def test_threshold_is_met_exactly(frame):
    base = [f"w{k}" for k in range(22)]  # 18 shingles; two more words: 2 more shingles
    rows = [(1, " ".join(base)), (2, " ".join(base + ["x", "y"])), (3, " ".join(base + ["p", "q", "r", "s"])),
            (4, " ".join(base + ["p", "q", "r", "s", "t"]))]
    assert got(jaccard_join.jaccard_join(frame(rows))) == expected(rows)


@pytest.mark.parametrize("t", [Fraction(1, 2), Fraction(9, 10), Fraction(1)])
def test_thresholds_match_brute_force(frame, t):
    rows = corpus(4)
    assert got(jaccard_join.jaccard_join(frame(rows), t)) == expected(rows, t)


def test_pairs_across_are_those_the_filters_pass(spark):
    """The band join of one shingle against all pairs, place by place."""
    t = Fraction(8, 10)
    rng = random.Random(6)
    rows = [(rng.randrange(3), c, n, rng.randrange(0, n - (4 * n + 4) // 5 + 1), c % 5) for c in range(120) for n in [rng.randrange(1, 60)]]
    known = spark.createDataFrame(rows, "token long, class long, n int, pos int, label long")
    found = [tuple(sorted((r.a, r.b))) for r in jaccard_join._met_across(known, t).select("a", "b").collect()]
    want = []
    for k, (tok, a, na, pa, la) in enumerate(rows):
        for tok2, b, nb, pb, lb in rows[:k]:
            rest = min(na - pa, nb - pb)
            if tok == tok2 and la != lb and min(na, nb) * 5 >= max(na, nb) * 4 and rest * 9 >= 4 * (na + nb):
                want.append((b, a))
    assert sorted(found) == sorted(want)


def test_a_passage_alone_makes_no_pairs(spark):
    """Texts of 60 words that share 50 are not 0.8 alike; the shared shingles
    of their prefixes give no rows at all, however many texts there are."""
    n = 56  # shingles; the passage's 46 come last, two of them in the prefix of 12
    rows = [(7, c, n, pos, c) for c in range(4000) for pos in (10,)]
    known = spark.createDataFrame(rows, "token long, class long, n int, pos int, label long")
    assert jaccard_join._met_across(known, Fraction(8, 10)).count() == 0
    prefixes = spark.createDataFrame([(c, n, [1000 + c, 7]) for c in range(50)], "class long, n int, prefix array<long>")
    assert jaccard_join._shared_entries(prefixes, Fraction(8, 10)).count() == 50
    prefixes = spark.createDataFrame(
        [(c, n, [1000 + 20 * c + k for k in range(10)] + [7]) for c in range(50)], "class long, n int, prefix array<long>"
    )
    assert jaccard_join._shared_entries(prefixes, Fraction(8, 10)).count() == 0


def test_one_of_each_group_stays(frame):
    text = " ".join(f"w{k}" for k in range(60))
    docs = frame([(5, text), (3, text + " tail"), (9, text.upper()), (1, "other words"), (2, None), (4, "")])
    out = jaccard_join.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 3, 4]


def test_one_row_of_each_group_stays_of_odd_rows(frame, odd_rows):
    # Id 70 has two texts, one of which loses to a smaller id; 80 is
    # repeated; the near copy of 90 and both rows of the last text lack ids.
    text = " ".join(f"v{k}" for k in range(60))
    rows = odd_rows + [(70, "a text of its own"), (70, "shared text"), (69, "Shared  text")] + [(80, "again")] * 9
    rows += [(90, text), (None, text + " tail"), (None, "only null"), (None, "only NULL")]
    out = [(r.doc_id, r.text) for r in jaccard_join.keep_one(frame(rows)).collect()]
    empty = [(i, t) for i, t in rows if not (t or "").strip()]  # these link with nothing
    texts = {i: t for i, t in odd_rows if i in (4, 7, 8, 9, 10)}
    want = empty + [*texts.items(), (70, "a text of its own"), (69, "Shared  text"), (80, "again"), (90, text)]
    (null,) = [x for x in out if x[0] is None and (x[1] or "").lower() == "only null"]
    assert sorted(out, key=str) == sorted([*want, null], key=str)


def test_empty_table(frame):
    assert jaccard_join.jaccard_join(frame([])).count() == 0
