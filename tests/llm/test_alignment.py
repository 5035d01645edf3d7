import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from cascara.llm.alignment import _MEASURES, align, default_model
from cascara.llm.catalog import QUERIES
from cascara.llm.encode import default_tokenizer
from cascara.sources.tables import load_table
from llm_fixtures import docs, no_docs  # noqa: F401
from conftest import SF_SMALL

COLS = (*_MEASURES, "n_best", "count_sum", "groups_sha256")


class Brute:
    """Measures by plain library calls and loops over tokens."""

    def __init__(self):
        self.a = Tokenizer.from_file(default_tokenizer())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=default_model())
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        self.letters = {chr(x if x in shown else next(other)): x for x in range(256)}

    def tokens(self, text):
        if not text:
            return [], []
        raw = (" " + text).encode()
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i)))
             for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        return (a, b) if all(b"".join(x for _, x in s) == raw for s in (a, b)) else ([], [])

    def one(self, text):
        a, b = self.tokens(text)
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((at, at + len(x), i))
                at += len(x)
            spans.append(out)
        links, j0 = [], 0
        for s, e, i in spans[0]:
            while spans[1][j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(spans[1]) and spans[1][j][0] < e:
                links.append((i, spans[1][j][2]))
                j += 1
        both = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, at = [], [0, 0]
        for end in both:
            part = []
            for k in (0, 1):
                ids = []
                while at[k] < len(spans[k]) and spans[k][at[k]][1] <= end:
                    ids.append(str(spans[k][at[k]][2]))
                    at[k] += 1
                part.append(",".join(ids))
            groups.append("|".join(part))
        return len(a), len(b), len(both), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""

    def table(self, texts):
        one = {t: self.one(t) for t in set(texts)}
        n = Counter(x for t in texts for x in one[t][3])
        top = Counter()
        for (_, b), c in n.items():
            top[b] = max(top[b], c)
        return {t: (na, nb, g, len(links), sum(n[x] == top[x[1]] for x in links), sum(n[x] for x in links), sha)
                for t, (na, nb, g, links, sha) in one.items()}


@pytest.fixture(scope="module")
def brute():
    return Brute()


def check(frame, out, brute):
    want = brute.table([r["text"] for r in frame.select("text").collect()])
    got = out.collect()
    assert len(got) == frame.count()
    for r in got:
        assert tuple(r[c] for c in COLS) == want[r["text"]], r["text"]


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 1000, "shard_bytes": 20_000}])
def test_edge_cases(spark, docs, brute, sizes):
    more = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["x▁y", "▁", "a  b ", " ", "\n\n a\tb", "\x00é日本🙂", "<s> </s><0x0A>", "ﬁ　z \xa0 ", "same", "same", "same"])],
        "doc_id long, text string")
    for frame in (docs, more):
        out = align(frame, **sizes)
        assert out.columns == [*frame.columns, *COLS]
        check(frame, out, brute)


def test_query(spark, brute):
    table = load_table(spark, SF_SMALL, "documents")
    out = QUERIES["op13_token_alignment"](spark, SF_SMALL)
    check(table, out.join(table.select("doc_id", "text"), "doc_id"), brute)


def test_result_columns_are_replaced_and_empty_tables_pass(spark, no_docs):
    frame = spark.createDataFrame([(1, "a b", "old", 7)], "doc_id long, text string, n_a string, content int")
    out = align(frame)
    assert sorted(out.columns) == sorted(["doc_id", "text", "content", *COLS])
    assert out.first()["n_a"] == 2 and out.first()["content"] == 7
    assert align(no_docs).count() == 0
    assert align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).agg(
        {"n_links": "sum"}).first()[0] == 0
