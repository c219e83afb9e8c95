from hypothesis import given, settings
from hypothesis import strategies as st

from dealscope.llm import token_edits as E
from dealscope.llm.queries import COUNT_TOKENIZER, op9_token_edits

from .rows import by_id, documents

FOLDER = "/root/testdata/sf0.001"
COUNTS = E.CountCache(COUNT_TOKENIZER)
PIECES = st.sampled_from(
    ["a", "don't", "'s", " ", "  ", "\n", "\n\n ", "\t", "\xa0", "\x1c", "\x85", " ", "é",
     "12", "!?", "word", "<|endoftext|>", "İ", "日本"]
)
TEXT = st.lists(PIECES, max_size=60).map("".join)


def whole(text):
    return len(COUNTS.tokenizer.encode(text, add_special_tokens=False).ids)


def replaced(text, start, end, new):
    start = min(max(0, start), len(text))
    return text[:start] + new + text[min(max(start, end), len(text)) :]


@settings(max_examples=60, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(-2, 90), st.integers(-2, 90), TEXT), max_size=6), st.sampled_from([1, 3, 32]))
def test_counts_equal_a_full_encoding(text, edits, leaf):
    before = E.LEAF, E._LONG_LEAF
    E.LEAF, E._LONG_LEAF = leaf, 40
    try:
        doc = E.Document(text, COUNTS)
        assert doc.total == whole(text)
        for start, end, new in edits:
            doc.edit(start, end, new)
            text = replaced(text, start, end, new)
            assert doc.text == text and doc.total == whole(text)
            assert doc.chars.total == len(text)
    finally:
        E.LEAF, E._LONG_LEAF = before


def test_only_the_touched_region_is_encoded_again():
    doc = E.Document("some words here " * 20_000, COUNTS)
    doc.edit(160_000, 160_004, "other")
    assert 0 < doc.encoded <= 3 * E.LEAF


def test_tree_finds_leaves():
    tree = E.SegmentTree([3, 0, 2, 5])
    assert [tree.find(i) for i in (0, 2, 3, 4, 5, 9)] == [(0, 0), (0, 0), (2, 3), (2, 3), (3, 5), (3, 5)]
    tree.put(1, 4)
    assert tree.total == 14 and tree.find(3) == (1, 3)


def test_small_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    out = by_id(op9_token_edits(spark, FOLDER))
    assert len(out) == len(docs)
    for d in docs:
        text = d["text"] or ""
        size = len(text) + len(d["lang"]) + 1
        low, high = int(size * 0.45), int(size * 0.55)
        edited = f"{d['lang']} {text}"
        edited = edited[:low] + d["source"] + edited[high:]
        edited = edited[: int(len(edited) * 0.95)]
        r = out[d["doc_id"]]
        assert (r["tokens_before"], r["tokens_after"]) == (whole(text), whole(edited))


def test_edges(spark):
    frame = spark.createDataFrame(
        [
            (0, None, None), (1, "", [(0, 0, "new text")]), (2, "abc", []),
            (3, "abc", [None, (0, None, "x "), (99, 200, " end"), (None, 2, None)]),
            (4, "abc def", [(0, 99, "")]), (4, "abc def", [(0, 99, "")]),
        ],
        "doc_id long, text string, edits array<struct<start:long,end:long,replacement:string>>",
    ).selectExpr("*", "'x' as edited")
    out = E.count_with_edits(frame, COUNT_TOKENIZER)
    assert out.columns.count("edited") == 1
    rows = by_id(out)
    assert [rows[i]["edited"] for i in range(5)] == ["", "new text", "abc", "abc end", ""]
    for i in range(5):
        assert rows[i]["tokens_after"] == whole(rows[i]["edited"])
    assert out.count() == 6 and E.count_with_edits(frame.where("false"), COUNT_TOKENIZER).count() == 0
