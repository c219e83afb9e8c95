import bisect
import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from dealscope.llm import token_alignment as A
from dealscope.llm.common import written
from dealscope.llm.queries import ALIGN_TOKENIZERS, op11_token_alignment

from .rows import by_id, documents

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(ALIGN_TOKENIZERS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=ALIGN_TOKENIZERS[1])
    return a, b


def bytes_of_b(model, i):
    piece = model.id_to_piece(i)
    if piece.startswith("<0x") and piece.endswith(">") and len(piece) == 6:
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def brute(tokenizers, texts):
    """(n_a, n_b, groups, links) of each text, token by token."""
    model_a, model_b = tokenizers
    level = {v: k for k, v in _byte_characters().items()}
    rows = []
    for text in texts:
        if not text:
            rows.append((0, 0, [], []))
            continue
        data = (" " + text).encode()
        a = model_a.encode(" " + text, add_special_tokens=False).ids
        b = model_b.encode(text)
        sides = [
            [bytes(level[c] for c in model_a.id_to_token(i)) for i in a],
            [bytes_of_b(model_b, i) for i in b],
        ]
        if any(b"".join(s) != data for s in sides):
            rows.append((0, 0, [], []))
            continue
        ends = []
        for side in sides:
            at, made = 0, []
            for token in side:
                at += len(token)
                made.append(at)
            ends.append(made)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, x, y = [], 0, 0
        for cut in cuts:
            p, q = bisect.bisect_right(ends[0], cut), bisect.bisect_right(ends[1], cut)
            groups.append((a[x:p], b[y:q]))
            x, y = p, q
        where = dict(zip(ends[1], b))
        links = [(i, where[e]) for i, e in zip(a, ends[0]) if e in where]
        rows.append((len(a), len(b), groups, links))
    return rows


def _byte_characters():
    """Printable bytes stand for themselves, the others for the characters from 256 on."""
    made, extra = {}, 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            made[byte] = chr(byte)
        else:
            made[byte] = chr(extra)
            extra += 1
    return made


def expected(tokenizers, texts):
    rows = brute(tokenizers, texts)
    counts = Counter(link for *_, links in rows for link in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    made = []
    for n_a, n_b, groups, links in rows:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        n_best = sum(counts[x] == best[x[1]] for x in links)
        total = sum(counts[x] for x in links)
        made.append((n_a, n_b, len(groups), len(links), digest, n_best, total))
    return made


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def test_given_documents_equal_brute_force(spark, tokenizers):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    got = by_id(op11_token_alignment(spark, FOLDER))
    want = expected(tokenizers, [t for _, t in docs])
    assert [tuple(got[i][f] for f in FIELDS) for i, _ in docs] == want


TEXTS = [
    None,
    "",
    " ",
    "  two  spaces ",
    "plain words and more plain words",
    "plain words and more plain words",
    "\n\n\ttabs\n and lines\r\n",
    "a ▁ mark",
    "<s> </s> <unk> <|endoftext|> <0x0A>",
    "café naïve 字字 \U0001f600\U0001f600 x́",
    "\x00 zero",
    "x" * 3000,
    " " * 400_000,
    "字" * 5000,
]


@pytest.mark.parametrize("most", [10**6, 0])
def test_edge_texts_equal_brute_force_by_array_and_by_join(spark, tokenizers, most):
    docs = documents(spark, TEXTS).withColumnRenamed("lang", "n_best")
    aligned = written(
        A.align_documents(docs, *ALIGN_TOKENIZERS, public_tokenizers.PATTERN), "aligned"
    )
    pairs = written(A.link_counts(aligned), "pairs")
    got = by_id(A.score_links(aligned, pairs, most=most))
    for k, want in enumerate(expected(tokenizers, TEXTS)):
        row = got[k]
        digest = hashlib.sha256(row["groups"].encode()).hexdigest() if row["n_a"] else ""
        assert (*(row[f] for f in FIELDS[:4]), digest, row["n_best"], row["count_sum"]) == want, k


def test_repeated_rows_empty_table_and_clashing_columns(spark):
    docs = documents(spark, ["same text", "same text"]).selectExpr("1L doc_id", "text", "2 groups", "3 `n.a`")
    aligned = written(
        A.align_documents(docs, *ALIGN_TOKENIZERS, public_tokenizers.PATTERN), "aligned"
    )
    pairs = written(A.link_counts(aligned), "pairs")
    rows = A.score_links(aligned, pairs).collect()
    assert len(rows) == 2 and rows[0] == rows[1]
    assert rows[0]["count_sum"] == 2 * rows[0]["n_links"] and rows[0]["n_best"] == rows[0]["n_links"]
    empty = aligned.where("false")
    for most in (10, -1):
        assert A.score_links(empty, pairs.where("false"), most=most).collect() == []


def test_windows_with_one_code_are_told_apart(monkeypatch):
    monkeypatch.setattr(A.Windows, "codes", lambda self, side: self.sizes.astype("uint64"))
    both = A.Aligner(*ALIGN_TOKENIZERS, public_tokenizers.PATTERN)
    texts = ["red green blue", "other words here"]
    clashing = [list(map(str, c)) for c in both.align_all(texts)]
    monkeypatch.undo()
    assert clashing == [list(map(str, c)) for c in both.align_all(texts)]
