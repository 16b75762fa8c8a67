"""Each stage of the pipeline, on what the one before it kept, against a plain version; and on odd rows."""

import pyarrow.parquet as pq
import pytest
import sentencepiece

import corpus_pipeline
from quillon.llm import op1_toxicity
from quillon.llm.common import stored
from quillon.llm.op7_decontaminate import WINDOW, without
from quillon.llm.queries import tokenizer

from . import brute

DATA = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def spans_of(hit):
    return [(a, b) for a in sorted(hit) if a - 1 not in hit for b in [next(x for x in range(a, a + len(hit) + 2) if x not in hit)]]


def cut_lines(docs):
    gone = brute.repeated_lines(docs)
    out = []
    for i, t in docs:
        kept, k = [], 0
        for line in (t or "").split("\n"):
            own = bool(brute.WORD.search(line))
            if not (own and k in gone[i]):
                kept.append(line)
            k += own
        if not gone[i]:
            out.append((i, t))
        elif brute.WORD.search("\n".join(kept)):
            out.append((i, "\n".join(kept)))
    return out


def near(docs):
    groups = brute.near_duplicates(docs, 5)
    return [(i, t) for i, t in docs if groups[i][1] == i]


def clean(docs):
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{DATA}/benchmark.parquet").to_pylist()]
    of = {}
    for i, t in items:
        w = brute.split(t)
        n = min(WINDOW, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            of[tuple(w[a : a + n])] = n
    out = []
    for i, t in docs:
        w = brute.split(t)
        hit = {k for n in set(of.values()) for a in range(len(w) - n + 1) if tuple(w[a : a + n]) in of for k in range(a, a + n)}
        if not hit or 20 * len(hit) < len(w):
            out.append((i, without(t, spans_of(hit)) if hit else t))
    return out


def test_stages_against_plain_versions(spark):
    columns = spark.read.parquet(f"{DATA}/documents.parquet").columns
    docs, steps = spark.read.parquet(f"{DATA}/documents.parquet"), dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "minhash near-dedup", "benchmark decontamination", "sentencepiece"]
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rejected = {r.doc_id for r in op1_toxicity.scored(docs, labels).where("predicted = 1").collect()}
    plain = [(i, t) for i, t in texts(docs) if i not in rejected]
    for name, want in (("toxicity", lambda d: plain), ("line dedup", cut_lines), ("minhash near-dedup", near), ("benchmark decontamination", clean)):
        expected = want(texts(docs)) if name != "toxicity" else plain
        docs = stored(steps[name](spark, docs, DATA))
        assert docs.columns == columns and sorted(texts(docs)) == sorted(expected), name
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer())
    got = {r.doc_id: (r.ids, r.decoded) for r in steps["sentencepiece"](spark, docs, DATA).collect()}
    assert got == {i: (model.encode(t or ""), model.decode(model.encode(t or ""))) for i, t in texts(docs)}
    assert {r.doc_id for r in corpus_pipeline.run(spark, DATA).collect()} == set(got)


ROWS = [(None, "a b c d e f"), (1, None), (2, ""), (3, " \n\t "), (4, "a b c d e f g"), (4, "a b c d e f g"), (4, "other words"), (5, "w " * 40000), (6, None)]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(spark, name, empty):
    """Nulls, empty and long texts, repeated rows, an empty table, and columns of the names that stages use."""
    more = "n_chars long, score double, label int, kept boolean, own array<long>, cls long, mark long, cut string"
    rows = [] if empty else [(i, t, "en", "s", 1, 0.5, 1, True, [1], 2, 3, "x") for i, t in ROWS]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {more}")
    got = dict(corpus_pipeline.STAGES)[name](spark, docs, DATA)
    if name == "sentencepiece":
        assert got.count() == len(rows)
        return
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(kept, key=str) == sorted([] if empty else ROWS, key=str)  # none of them is a reason to go or to change
