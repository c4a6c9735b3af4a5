"""Aligned tokens against offsets compared one by one."""

import hashlib
import json
import random
from bisect import bisect_left
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketry.llm import alignment
from basketry.llm.pieces import vocabulary
from tests.llm.test_operators import DOCS, prose

TOKENIZERS = alignment.Tokenizers.read(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
LIBRARY = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
LIBRARY.encode_special_tokens = True
ENDS = st.sets(st.integers(1, 60), max_size=40).map(lambda s: np.array(sorted(s), dtype=np.int64))


def brute_groups(text):
    """Groups of (ids of A, ids of B) of one text by sets of offsets."""
    whole = " " + text
    ids_a = LIBRARY.encode(whole, add_special_tokens=False).ids
    ids_b = TOKENIZERS.second.encode(text)
    sides = []
    for ids, content in ((ids_a, TOKENIZERS.first_bytes), (ids_b, TOKENIZERS.second_bytes)):
        if not text or b"".join(content[i] for i in ids) != whole.encode():
            return []
        at, ends = 0, []
        for i in ids:
            at += len(content[i])
            ends.append((at, i))
        sides.append(ends)
    common = sorted({e for e, _ in sides[0]} & {e for e, _ in sides[1]})
    groups = [([], []) for _ in common]
    for k, side in enumerate(sides):
        for end, i in side:
            groups[bisect_left(common, end)][k].append(i)
    return groups


def brute_force(rows):
    groups = [brute_groups(text or "") for _, text in rows]
    links = [Counter((a, b) for g in gs for a in g[0] for b in g[1]) for gs in groups]
    count = Counter(pair for held in links for pair in held)
    highest = {}
    for (a, _), n in count.items():
        highest[a] = max(highest.get(a, 0), n)
    found = []
    for (doc_id, _), gs, held in zip(rows, groups, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        found.append((
            doc_id, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), sum(held.values()),
            sum(n for p, n in held.items() if count[p] == highest[p[0]]), sum(n * count[p] for p, n in held.items()),
            hashlib.sha256(said.encode()).hexdigest() if gs else "",
        ))
    return sorted(found, key=str)


def found_rows(frame):
    assert frame.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {t for _, t in frame.dtypes} == {"bigint", "string"}
    return sorted((tuple(r) for r in frame.collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(ENDS, ENDS, st.integers(1, 9))
def test_common_ends_in_pieces_of_any_size(a, b, work):
    i, j = alignment.common_ends(a, b, work)
    assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
    cut_a, cut_b = alignment.merge_path(a, b, work)
    assert set(np.diff(cut_a + cut_b)[:-1].tolist()) <= {work}
    merged = sorted([(v, 0) for v in a.tolist()] + [(v, 1) for v in b.tolist()])
    for x, y in zip(cut_a.tolist(), cut_b.tolist()):
        assert sum(side == 0 for _, side in merged[: x + y]) == x


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="ab's  \n\t1é한\u00a0\u2003\u0301.", max_size=80)))
def test_both_ways_to_encode_agree(text):
    text = text.encode(errors="replace").decode()
    assert TOKENIZERS.first(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_another_vocabulary_file_goes_through_its_library():
    file = json.loads(Path(vocabulary("byte_bpe_50k.json")).read_text())
    file["model"]["merges"].reverse()
    other = alignment.Tokenizers(json.dumps(file), TOKENIZERS.b)
    library = Tokenizer.from_str(other.a)
    assert other.first("some text of words") == library.encode("some text of words").ids


def test_wide_groups_pair_equal_ids_once():
    a, b = np.array([5] * 40 + [6] * 2 + [7]), np.array([1] * 30 + [2, 3])
    doc, x, y, n = alignment.linked_pairs(a, b, np.array([0, 42, 43]), np.array([0, 31, 32]), np.array([3, 3]))
    wanted = Counter([(i, j) for i in a[:42].tolist() for j in b[:31].tolist()] + [(7, 3)])
    assert dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == wanted
    assert set(doc.tolist()) == {3}


TEXTS = [
    None, "", " ", "  two  blanks ", "\n\n\ta", "a\0b\x7f", "▁x", "a ▁ b", "<|endoftext|> </s><s>", "한 😀 é ﬁ 　 ½", "�",
    "a" * 5_000, " " * 3_000, "=" * 999 + "\n" * 77, "don't it's 12345 %&/ 0x00", "ünïcode ſ É",
]


@pytest.mark.parametrize("frequent", [0, 7, 1 << 19])
def test_documents(spark, monkeypatch, frequent):
    rng = random.Random(9)
    monkeypatch.setattr(alignment, "CHARS", 3_000)
    texts = TEXTS + [prose(rng, n) for n in (1, 12, 80, 700)] + [prose(rng, 8_000)]
    rows = list(enumerate(texts)) + [(17, texts[17]), (17, texts[17]), (None, texts[18]), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(3)
    for name in ("a", "b", "n", "row", "pair", "docs", "a.b", "n_a"):
        docs = docs.withColumn(name, F.lit("other"))
    assert found_rows(alignment.align_documents(docs, TOKENIZERS, frequent)) == brute_force(rows)


def test_empty_table(spark):
    assert found_rows(alignment.align_documents(spark.createDataFrame([], DOCS), TOKENIZERS)) == []


def test_query_over_a_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert found_rows(alignment.op12_token_alignment(spark, sf_dir)) == brute_force(rows)


def test_bytes_of_entries_follow_the_other_form_of_the_vocabulary():
    import base64

    lines = Path(vocabulary("byte_bpe_50k.tiktoken")).read_bytes().splitlines()
    ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    assert all(TOKENIZERS.first_bytes[rank] == token for rank, token in ranks.items())
