"""Encoding by the table of last tokens against the library and against plain merging."""

import hashlib
import random
from pathlib import Path

import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from basketry.llm import pieces
from tests.llm.test_operators import DOCS, prose

PATH = pieces.vocabulary("piece_bpe_32k.model")
MODEL = pieces.PieceModel.parse(Path(PATH).read_bytes())
ENCODER = pieces.Encoder(MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = "ab  the▁\n\t\r\0\x1f\x85éÉß한😀.,:;()[]0123456789_-=+<>/\\\"'ﬁ²​�　"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=ODD, max_size=60), st.text(alphabet="aeinst \n", max_size=200)))
def test_ids_equal_the_library(text):
    text = text.encode(errors="replace").decode()
    found = list(ENCODER.encode(text))
    assert found == LIBRARY.encode(text)
    assert ENCODER.decode(found) == LIBRARY.decode(found)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, MODEL.size - 1)), max_size=12))
def test_any_ids_decode_as_in_the_library(ids):
    assert ENCODER.decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("around", [("", ""), ("the", "of"), ("#", "\n"), ("\n", "a")])
def test_runs_of_blanks_whose_scores_tie(around):
    for n in range(1, 120):
        text = around[0] + " " * n + around[1]
        assert list(ENCODER.encode(text)) == LIBRARY.encode(text)


def test_every_prefix_ends_in_its_last_token():
    rng = random.Random(3)
    for _ in range(60):
        text = "▁" + "".join(rng.choice("aeinrst.,▁") for _ in range(24))
        texts = sorted([text, text[:9] + "era", text[:15] + "e.st", "zu"])
        last = iter(ENCODER.last_tokens(texts))
        for one in texts:
            for end in range(1, len(one) + 1):
                assert ENCODER.token[next(last)] == pieces.merged(list(one[:end]), MODEL.scores)[-1]
            assert next(last) == pieces._FREE  # the mark, and the entry of nothing at all


def test_exactly_one_match_fits():
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choice("ainsthe") for _ in range(20))
        last = ["", *(ENCODER.token[i] for i in ENCODER.last_tokens([text])[:-1])]
        for end in range(1, len(text) + 1):
            fitting = [
                t for n in range(1, end + 1) if (t := text[end - n : end]) in MODEL.ids and ENCODER.compatible(last[end - n], t)
            ]
            assert fitting == [last[end]]


def test_pairs_fit_as_merging_says():
    rng = random.Random(8)
    names = sorted(MODEL.ids)
    for _ in range(20_000):
        a, b = rng.choice(names), rng.choice(names)
        if ENCODER.edges(a).whole:
            assert ENCODER.compatible(a, b) == (pieces.merged(list(a + b), MODEL.scores) == [a, b])


def test_unsupported_models_are_named():
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto.FromString(Path(PATH).read_bytes())
    model.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError, match="blanks removed"):
        pieces.PieceModel.parse(model.SerializeToString())


def test_documents(spark, monkeypatch):
    rng = random.Random(2)
    texts = [None, "", " ", "\n", "a\0b", "▁x ▁▁", "<s>x<0x0A></s>", "Ünïcode 한 😀  end ", prose(rng, 400)]
    texts += [prose(rng, 30_000), "".join(rng.choice("abcdefgh0123+/") for _ in range(60_000)), " " * 5_000]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(8, texts[8], "en", "s", 1), (None, "null id", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(2)
    for name in ("ids", "decoded", "a.b", "n_tokens"):
        docs = docs.withColumn(name, F.lit("other"))
    read = pieces.decode_ids(pieces.encode_texts(docs, MODEL), MODEL)
    found = sorted(((r.doc_id, r.ids, r.decoded) for r in read.collect()), key=str)
    wanted = [(i, LIBRARY.encode(t or ""), LIBRARY.decode(LIBRARY.encode(t or ""))) for i, t, *_ in rows]
    assert found == sorted(wanted, key=str)
    nothing = spark.createDataFrame([], DOCS)
    assert pieces.decode_ids(pieces.encode_texts(nothing, MODEL), MODEL).collect() == []


def test_wrong_ids_are_errors_and_missing_lists_read_as_nothing(spark):
    for wrong in ([264, -1], [264, MODEL.size]):
        with pytest.raises((ValueError, IndexError)):
            ENCODER.decode(wrong)
    rows = spark.createDataFrame([(1, None), (2, []), (3, [264])], "doc_id long, ids array<int>").coalesce(1)
    assert [(r.doc_id, r.decoded) for r in pieces.decode_ids(rows, MODEL).collect()] == [(1, ""), (2, ""), (3, "a")]


def test_query_over_a_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = {tuple(r) for r in pieces.op13_sentencepiece(spark, sf_dir).collect()}
    wanted = set()
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = LIBRARY.encode(row.text or "")
        wanted.add((row.doc_id, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))))
    assert found == wanted


def test_frequent_segments_stay_when_the_remembered_ones_are_too_many(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED", 50)
    encoder, learned = pieces.Encoder(MODEL), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda texts: (learned.extend(texts), learn(texts)))
    for k in range(100):
        text = "the house " + " ".join(f"w{k}x{i}" for i in range(20))
        assert encoder.encode(text) == LIBRARY.encode(text)
    assert learned.count("▁house") == 1
    assert len(encoder.segments) + len(encoder.older) < 2 * 50 + 2 * 30
