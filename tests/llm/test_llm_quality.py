import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np
import pyarrow as pa

from ledgerlens.llm import quality
from ledgerlens.llm.words import text_chunks


def expected(text, rules=quality.Rules()):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(lines)
    out["n_dup_lines"] = len(lines) - len(seen)
    out["dup_line_chars"] = sum(
        sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", x))) for x in lines if seen[x] > 1
    )

    def covered(n):
        grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
        count, hit = Counter(grams), set()
        for k, g in enumerate(grams):
            if count[g] > 1:
                hit.update(range(k, k + n))
        return hit

    out["n_repeat_words"] = len(covered(3))
    for n, _ in rules.max_gram_chars:
        out[f"dup_{n}gram_chars"] = sum(len(words[k]) for k in covered(n))
    out["base_failed"] = len(words) < 50 or 100 * out["n_repeat_words"] > 50 * len(words)
    ok = out["dup_line_chars"] <= rules.max_line_chars * out["word_chars"]
    ok = ok and all(out[f"dup_{n}gram_chars"] <= m * out["word_chars"] for n, m in rules.max_gram_chars)
    out["kept"] = not out["base_failed"] and ok
    return out


def measured(texts, limit):
    out = []
    for _, _, data, offsets in text_chunks(pa.array(texts, pa.string()), limit):
        m = quality.measure(data, offsets, quality.Rules())
        out += [{k: np.asarray(v)[r].item() for k, v in m.items()} for r in range(len(offsets) - 1)]
    return out


words = st.sampled_from(["a", "b", "c", "dé", "#x", "日"])
texts = st.lists(st.tuples(words, st.sampled_from([" ", "\n", "\t", "  ", "\n\n"])), max_size=140).map(
    lambda x: "".join(a + b for a, b in x)
)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), texts), max_size=6), st.sampled_from([1, 60, 1 << 20]))
def test_measures_match_brute_force(rows, limit):
    assert measured(rows, limit) == [expected(t) for t in rows]


def test_coverage_rejects_below_the_base_rule():
    def text(repeated, once):
        line = " ".join(f"r{k:03}" for k in range(repeated // 2))
        return "\n".join([line, line, *(f"o{k:03}" for k in range(once))])

    low, lines, half = measured([text(40, 60), text(46, 54), text(52, 48)], 1 << 20)
    assert not low["base_failed"] and low["kept"]
    assert not lines["base_failed"] and not lines["kept"]
    assert half["base_failed"] and not half["kept"]


def test_rows_of_a_table(spark, frame, odd_rows):
    rows = quality.quality_rules(frame(odd_rows)).collect()
    want = sorted((str(i), str(expected(t))) for i, t in odd_rows)
    assert sorted((str(r.doc_id), str({k: r[k] for k in expected("")})) for r in rows) == want


def test_kept_rows_keep_all_columns(frame):
    good = " ".join(f"w{k}" for k in range(80))
    docs = frame([(1, good), (2, "short"), (3, None), (4, "same line here\n" * 40), (5, good)])
    out = quality.keep_good(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 5]


def test_empty_table(frame):
    assert quality.quality_rules(frame([])).count() == 0
    assert quality.keep_good(frame([])).count() == 0
