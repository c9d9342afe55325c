import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import token_counts
from ledgerlens.llm.queries import END_OF_TEXT


def expected(ids, end):
    out, start = [], 0
    for k, x in enumerate(ids):
        if x == end:
            out.append((len(out), start, k - start, True))
            start = k + 1
    return out + ([(len(out), start, len(ids) - start, False)] if start < len(ids) else [])


def scanned(spark, path, end, block):
    files = token_counts.file_sizes(spark.createDataFrame([(str(path),)], "path string"))
    rows = token_counts.token_counts(files, end, block_bytes=block).collect()
    return sorted((r.document, r.start, r.n_tokens, r.closed) for r in rows)


@pytest.mark.parametrize("block", [2, 3, 10, 64, 1 << 20])
@pytest.mark.parametrize("ids", [[], [9], [1], [9, 9], [1, 9, 2, 2, 2, 2, 2, 9, 9, 3], [1] * 40, [1] * 40 + [9]])
def test_any_block_size(spark, tmp_path, ids, block):
    path = tmp_path / "flat.bin"
    np.array(ids, "<u2").tofile(path)
    assert scanned(spark, path, 9, block) == expected(ids, 9)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from([1, 2, 9, 9]), max_size=60), st.sampled_from([2, 6, 32]))
def test_random_files(spark, tmp_path_factory, ids, block):
    path = tmp_path_factory.mktemp("flat") / "f.bin"
    np.array(ids, "<u2").tofile(path)
    assert scanned(spark, path, 9, block) == expected(ids, 9)


def test_half_an_id_is_an_error(spark, tmp_path):
    path = tmp_path / "odd.bin"
    path.write_bytes(b"\1\2\3")
    with pytest.raises(Exception, match="whole ids"):
        scanned(spark, path, 9, 64)


def test_counts_of_a_table(frame, odd_rows, word_file):
    rows = odd_rows + [(50, "x <|endoftext|> y")]
    out = token_counts.document_token_counts(frame(rows), word_file, END_OF_TEXT).collect()
    tok = Tokenizer.from_file(word_file)
    tok.encode_special_tokens = True
    want = sorted(str((i, len(tok.encode(t or "", add_special_tokens=False).ids))) for i, t in rows)
    assert sorted(str((r.doc_id, r.n_tokens)) for r in out) == want


def test_empty_table(frame, word_file):
    assert token_counts.document_token_counts(frame([]), word_file, END_OF_TEXT).count() == 0


def test_paths_of_object_stores():
    assert token_counts._uri("s3a://bucket/a/b.bin") == "s3://bucket/a/b.bin"
    assert token_counts._uri("hdfs://host:9000/a") == "hdfs://host:9000/a"
    assert token_counts._uri("file:/tmp/x") == "file:/tmp/x"
    assert token_counts._uri("/tmp/x") == "file:///tmp/x"
