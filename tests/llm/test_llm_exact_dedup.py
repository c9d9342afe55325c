import hashlib
from collections import defaultdict

import pytest

from ledgerlens.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("support", [0.002, 0.2, 0.9])
def test_groups_on_both_sides_of_the_split(frame, odd_rows, support):
    rows = odd_rows + [(100 + k, "hot") for k in range(60)] + [(200 + k, f"cold {k % 7}") for k in range(20)]
    assert got(exact_dedup.exact_dedup(frame(rows), support)) == expected(rows)


def test_frequent_digests_are_found_and_bounded(frame):
    rows = [(k, "hot" if k % 3 == 0 else f"text {k}") for k in range(300)]
    table = exact_dedup.digests(frame(rows))
    names = exact_dedup.frequent_digests(table, 0.1)
    assert hashlib.sha256(b"hot").hexdigest() in names and len(names) <= 10


def test_one_row_of_each_group_stays_with_its_columns(frame):
    rows = [(k, "hot") for k in range(50)] + [(60, "b"), (61, "b"), (62, "c"), (63, None), (64, "")]
    docs = frame(rows)
    out = exact_dedup.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [49, 61, 62, 64]


def test_one_row_of_each_text_stays_of_odd_rows(frame, odd_rows):
    # Id 70 has two texts, one of which loses to a larger id; 80 is repeated.
    rows = odd_rows + [(70, "unique"), (70, "shared"), (71, "shared")] + [(80, "again")] * 9 + [(None, "only null")] * 3
    last = {}
    for i, t in rows:
        last[t or ""] = max(last.get(t or "", -1), -1 if i is None else i)
    out = exact_dedup.keep_one(frame(rows)).collect()
    assert sorted((r.text or "", -1 if r.doc_id is None else r.doc_id) for r in out) == sorted(last.items())


def test_empty_table(frame):
    assert exact_dedup.exact_dedup(frame([])).count() == 0
    assert exact_dedup.keep_one(frame([])).count() == 0
