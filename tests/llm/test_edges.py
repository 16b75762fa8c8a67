"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, with the results the docstrings state."""

import math

import pytest

from quillon.llm import op1_toxicity, op2_licenses, op3_pii, op4_lines, op5_katz, op6_quality, op7_decontaminate, op8_suffixes, op9_pieces, op10_minhash
from quillon.llm.queries import tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, label int, kept boolean, component_id long, band int, text2 string"
LONG = "the quick brown fox jumps over the lazy dog and runs away from all of it " * 3000


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, 1.0, 1, False, 7, 1, "x") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None, "a b c d e f", "s"), (1, None, None), (2, "", "s"), (3, " \n\t ", "s"), (4, "a b c d e f", "s"), (4, "a b c d e f", "s"), (4, "other words", "t"), (5, LONG, "s"), (6, LONG + "!", None)]
    return frame(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 1), (4, None, 0), (4, 1, 1), (None, 1, 1), (9, 1, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, None), (None, "d e f"), (3, ""), (4, "brown fox")], "item_id long, text string")


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_toxicity(docs, none, labels):
    got = by_id(op1_toxicity.scored(docs, labels))
    assert sum(map(len, got.values())) == 9 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for own in got.values() for r in own)
    assert op1_toxicity.scored(none, labels).count() == 0
    assert all(r.score < 0.5 for r in op1_toxicity.scored(docs, labels.where("doc_id > 100")).collect())
    assert op1_toxicity.kept(docs, labels.where("doc_id > 100")).columns == docs.columns


def test_licenses(docs, none):
    got = by_id(op2_licenses.scanned(docs))
    assert sum(map(len, got.values())) == 9 and got[1][0].n_matches == 0 and got[1][0].coverage == 0
    assert op2_licenses.scanned(none).count() == 0


def test_pii(spark, docs, none):
    assert sum(map(len, by_id(op3_pii.found(docs)).values())) == 9
    assert op3_pii.found(none).count() == 0
    r = op3_pii.found(frame(spark, [(1, "call +1 (222) 555-1234 or 1 (222) 555-1234 now", "s")])).first()
    assert r.n_phone == 1 and r.spans.startswith("phone:5:22") and r.n_added >= 1
    assert op3_pii.found(frame(spark, [(1, "9" * 200_000, "s")])).first().n_card == 0


def test_lines(docs, none):
    got = by_id(op4_lines.report(docs))
    assert sum(map(len, got.values())) == 9 and got[2][0].n_lines == 0 and got[3][0].n_lines == 0
    assert op4_lines.report(none).count() == 0
    assert op4_lines.removed(docs).columns == docs.columns and op4_lines.removed(docs).count() == 9
    assert op4_lines.removed(docs.where("doc_id = 1")).first().text is None


def test_katz(docs, none):
    got = by_id(op5_katz.scored(docs))
    assert sum(map(len, got.values())) == 9 and got[1][0].n_tokens == 1 and got[5][0].n_tokens == len(LONG.split()) + 1
    assert all(math.isfinite(r.score) and r.score <= 0 for own in got.values() for r in own)
    assert op5_katz.scored(none).count() == 0


def test_quality(docs, none):
    got = by_id(op6_quality.judged(docs))
    assert sum(map(len, got.values())) == 9 and got[1][0].base_failed and not got[1][0].kept and got[5][0].n_repeat_words == len(LONG.split())
    assert op6_quality.judged(none).count() == 0


def test_contamination(spark, docs, none, items):
    got = by_id(op7_decontaminate.contamination(docs, items))
    assert sum(map(len, got.values())) == 9 and not got[1][0].contaminated and got[4][0].n_words in (6, 2)
    assert [r.n_hit for r in got[None]] == [3] and got[5][0].n_items == 1
    assert op7_decontaminate.contamination(none, items).count() == 0
    assert op7_decontaminate.contamination(docs, items.where("item_id > 9")).where("contaminated").count() == 0
    kept = op7_decontaminate.removed(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 4}


def test_suffixes(spark, docs, none):
    got = by_id(op8_suffixes.deduplicated(docs))
    assert sum(map(len, got.values())) == 9 and got[1][0].n_bytes == 0 and got[5][0].n_removed == 0 and got[6][0].n_removed == len(LONG)
    assert op8_suffixes.deduplicated(none).count() == 0


def test_pieces(docs, none):
    got = by_id(op9_pieces.encoded(docs, tokenizer(), with_ids=True))
    assert sum(map(len, got.values())) == 9 and got[1][0].ids == [] and got[5][0].decoded == LONG
    assert op9_pieces.encoded(none, tokenizer()).count() == 0


def test_near_duplicates(docs, none):
    got = by_id(op10_minhash.duplicates(docs))
    assert sum(map(len, got.values())) == 9
    assert got[6][0].component_id == 5 and not got[6][0].kept and got[2][0].kept and got[None][0].component_id is None
    assert op10_minhash.duplicates(none).count() == 0
    assert op10_minhash.kept(docs).columns == docs.columns
