"""The filter audit against counting each order document by document."""

import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import filteraudit
from tests.llm.test_operators import DOCS, prose

LABELS = "doc_id long, quality int, toxic int"


def _failed(text, doc_id, smaller):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": doc_id is not None and smaller.get(text, doc_id) < doc_id,
    }


def brute_force(docs, labels):
    smaller = {}
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            smaller[text or ""] = min(smaller.get(text or "", doc_id), doc_id)
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    parts = {}
    for doc_id, text, lang, *_ in docs:
        parts.setdefault(lang or "", []).append((doc_id, _failed(text, doc_id, smaller)))
    found = []
    for part, members in parts.items():
        shapley, steps = dict.fromkeys("ABCDE", 0), []
        for order in map("".join, permutations("ABCDE")):
            left = members
            for step, name in enumerate(order, 1):
                gone = [m for m in left if m[1][name]]
                before = len([m for m in members if m[1][name]]) - len(gone)
                left = [m for m in left if not m[1][name]]
                alone = [m for m in members if m[1][name] and sum(m[1].values()) == 1]
                shapley[name] += len(gone)
                known = [m[0] for m in gone if m[0] is not None]
                counts = (len(left), len(gone), before, len(alone))
                steps.append((part, order, step, *counts, sum(d in good for d in known), sum(d in toxic for d in known)))
        found += [(*s, shapley[s[1][s[2] - 1]]) for s in steps]
    return sorted(found)


def _documents():
    rng = random.Random(6)
    long = prose(rng, 260)
    texts = [None, "", " \t\n", long, long, long.upper(), long + " # |", prose(rng, 30), "the same words " * 90,
             "ÀÉ" * 40 + " Ab", long + " x", prose(rng, 60_000), "A" * 200_000, "É a\x85b c\x1fd"]
    rows = [(i, t, ("en", "fr", None, "")[i % 4], None, 0) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], rows[7], (None, long, "en", None, 1), (None, None, None, None, None), (-5, texts[7], "de", "", 2)]
    rows += [(100 + i, texts[rng.randrange(len(texts))], rng.choice(("en", "fr")), "hot", 1) for i in range(60)]
    return rows


def test_audit_equals_counting(spark):
    rows = _documents()
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 140, 1)] + [(4, 0, 1), (None, 1, 1), (6, None, None), (999, 1, 1)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    for name in ("part", "mask", "digest", "n", "good", "a.b", "step"):
        docs = docs.withColumn(name, F.lit("other"))
    named = spark.createDataFrame(labels, LABELS).withColumn("part", F.lit(1))
    found = filteraudit.audit(docs, named)
    assert sorted(map(tuple, found.collect())) == brute_force(rows, labels)
    assert dict(found.dtypes)["step"] == "int" and dict(found.dtypes)["shapley"] == "bigint"


def test_audit_of_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert filteraudit.audit(spark.createDataFrame([], DOCS), none).collect() == []
    one = spark.createDataFrame([(1, "few words", None, None, 1)], DOCS)
    found = filteraudit.audit(one, none).collect()
    assert len(found) == 600
    assert {(r.part, r.good_lost) for r in found} == {("", 0)}
    assert all(r.removed == (r.filter_order[r.step - 1] == "A") for r in found)


def test_min_plus_is_the_least_sum():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 9, (7, 4)), rng.integers(0, 9, (4, 6))
    wanted = [[min(a[i, k] + b[k, j] for k in range(4)) for j in range(6)] for i in range(7)]
    assert filteraudit.min_plus(a, b).tolist() == wanted


@pytest.mark.parametrize("names", ["AB", "ABC", "ABCDE"])
def test_positions_invert_the_orders(names):
    orders, place = filteraudit.positions(names)
    assert all(order[place[i, names.index(c)]] == c for i, order in enumerate(orders) for c in names)
